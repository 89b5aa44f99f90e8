"""One quota for all tasks of a deployment: requests come in as a stream, grants go out.

Every deployment has its state in one place, so its limits hold however many
tasks ask. Requests wait in the state, in the order of their time and id, and
nothing is granted early. A refused call (status 429)
holds back all grants of its deployment, also those that were asked for before.

Requests that arrive out of order are put in order as long as the watermark
has not passed them; later ones are dropped by Spark. A request that alone
exceeds the limit of tokens is answered at once, without a grant.
"""

from __future__ import annotations

from array import array
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from ..operators.quota import Pace
from .in_order import Blocks, InOrder, rows_of

OUTPUT = "deployment string, request long, asked_ms long, granted_ms long, tokens double"
GRANTED = Row("deployment", "request", "asked_ms", "granted_ms", "tokens")


@dataclass
class Queue:
    """Requests that wait, as columns: of some millions most may have to."""

    pace: Pace
    ts: array = field(default_factory=lambda: array("q"))
    request: array = field(default_factory=lambda: array("q"))
    tokens: array = field(default_factory=lambda: array("d"))
    served: int = 0

    def ask(self, ts: int, request: int, tokens: float) -> None:
        for column, value in ((self.ts, ts), (self.request, request), (self.tokens, tokens)):
            column.append(value)


class Grants(InOrder):
    """Rows of request, ts_ms, tokens and status (200: asks; 429: was refused) of one deployment."""

    EVENT, COLUMNS = "ts_ms long, request long, tokens double, status int", ("ts_ms", "request", "tokens", "status")

    def __init__(self, requests: int, tokens: float, period_ms: int, delay_ms: int):
        self.limits, self.delay = (requests, tokens, period_ms), delay_ms

    def open(self, handle) -> None:
        self.waiting = Blocks(handle, "waiting", "ts_ms long, request long, tokens double")
        self.log = handle.getListState("log", "at long, tokens double")
        self.pace = handle.getValueState("pace", "last long, cooldown long, multiplier double")

    def load(self) -> Queue:
        state = tuple(self.pace.get()) if self.pace.exists() else (0, 0, 1.0)
        queue = Queue(Pace(*self.limits, *state, log=tuple(tuple(r) for r in self.log.get())))
        for row in rows_of(self.waiting.read()):
            queue.ask(*row)
        return queue

    def save(self, state: Queue) -> None:
        left = [pa.array(memoryview(c)[state.served :], kind) for c, kind in zip((state.ts, state.request, state.tokens), self.waiting.schema.types, strict=True)]
        self.waiting.replace(pa.Table.from_arrays(left, schema=self.waiting.schema))
        log = list(state.pace.log)
        self.log.put(log) if log else self.log.clear()
        self.pace.update((state.pace.last, state.pace.cooldown, state.pace.multiplier))

    def due(self, state: Queue) -> int | None:
        if state.served == len(state.ts):
            return None
        return state.pace.earliest(state.ts[state.served], state.tokens[state.served])

    def at_event(self, key, state: Queue, event) -> list[Row]:
        ts, request, tokens, status = event
        if status == 429:
            state.pace.refused(ts, self.delay)
        elif tokens > state.pace.tokens:
            return [GRANTED(key[0], request, ts, None, tokens)]
        else:
            state.ask(ts, request, tokens)
        return []

    def at_due(self, key, state: Queue, now: int) -> list[Row]:
        ts, request, tokens = state.ts[state.served], state.request[state.served], state.tokens[state.served]
        state.served += 1
        state.pace.grant(now, tokens)
        return [GRANTED(key[0], request, ts, now, tokens)]


def grants(requests: DataFrame, per_period: int, tokens: float, period_ms: int = 60_000, delay_ms: int = 2_000, late: str = "10 minutes") -> DataFrame:
    """Grants for a stream of deployment, request, ts (an instant), tokens and status; needs ``in_order.use_store``."""
    rows = requests.withWatermark("ts", late).withColumn("ts_ms", F.unix_millis("ts"))
    named = rows.select("deployment", "request", "ts", "ts_ms", F.col("tokens").cast("double").alias("tokens"), F.col("status").cast("int").alias("status"))
    return named.groupBy("deployment").transformWithState(Grants(per_period, tokens, period_ms, delay_ms), OUTPUT, "Append", "EventTime")
