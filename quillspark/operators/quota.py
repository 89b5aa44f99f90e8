"""A token bucket for requests and tokens, with a shared cooldown."""

from __future__ import annotations

from dataclasses import dataclass, replace

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Bucket:
    """State at ``last`` (seconds). A limit of 0 means none. Refilling goes on from ``last``,
    so asking in vain changes nothing."""

    rpm: float
    tpm: float
    batch_tokens: float
    requests: float = 0.0
    tokens: float = 0.0
    last: float = 0.0
    cooldown: float = 0.0
    multiplier: float = 1.0

    def refilled(self, now: float) -> tuple[float, float]:
        seconds = max(0.0, now - self.last)
        grow = lambda have, room, a_minute: min(room, have + seconds * a_minute * self.multiplier / 60)
        return grow(self.requests, max(1.0, self.rpm / 6), self.rpm), grow(self.tokens, max(self.batch_tokens, self.tpm / 6), self.tpm)

    def ask(self, now: float, tokens: float) -> tuple[Bucket, float]:
        """The bucket after the request, and the seconds to wait (0: granted)."""
        r, t = self.refilled(now)
        waits = [0.0, self.cooldown - now]
        if self.rpm and r < 1:
            waits.append((1 - r) * 60 / (self.rpm * self.multiplier))
        if self.tpm and t < tokens:
            waits.append((tokens - t) * 60 / (self.tpm * self.multiplier))
        if (wait := max(waits)) > 0:
            return self, wait
        return replace(self, requests=r - 1 if self.rpm else r, tokens=t - tokens if self.tpm else t, last=now), 0.0

    def refused(self, now: float, delay: float) -> Bucket:
        """After a 429: a cooldown for all, and a slower refill."""
        return replace(self, cooldown=max(self.cooldown, now + min(120.0, max(0.1, delay))), multiplier=max(0.2, self.multiplier * 0.8))

    def succeeded(self) -> Bucket:
        return replace(self, multiplier=min(1.0, self.multiplier + 0.002))


@dataclass
class Pace:
    """Grants of one deployment, of which any ``period`` holds at most so many requests and tokens.

    It keeps the grants of the last period, so at most ``requests`` of them. A
    refused call lowers both limits for a while and stops all grants until its
    delay is over; every grant raises them again. Times are whole milliseconds.
    """

    requests: int
    tokens: float
    period: int = 60_000
    last: int = 0
    cooldown: int = 0
    multiplier: float = 1.0
    log: tuple[tuple[int, float], ...] = ()

    def earliest(self, at: int, tokens: float) -> int:
        """When so many tokens may be granted, not before ``at`` or the last grant."""
        most, room = max(1, int(self.requests * self.multiplier)), self.tokens * self.multiplier
        first = max(at, self.last, self.cooldown)
        if len(self.log) < most and sum(n for _, n in self.log) + tokens <= room:
            return first
        for t in sorted({first, *(g + self.period for g, _ in self.log if g + self.period > first)}):
            inside = [n for g, n in self.log if g > t - self.period]
            if not inside or (len(inside) < most and sum(inside) + tokens <= room):
                break
        return t

    def grant(self, at: int, tokens: float) -> None:
        self.log = (*((g, n) for g, n in self.log if g > at - self.period), (at, tokens))
        self.last, self.multiplier = at, min(1.0, self.multiplier + 0.002)

    def refused(self, at: int, delay: int) -> None:
        self.cooldown, self.multiplier = max(self.cooldown, at + delay), max(0.2, self.multiplier * 0.8)


def schedule(requests: DataFrame, per_period: int, tokens: float, period_ms: int = 60_000) -> DataFrame:
    """request, tokens and slot_ms of requests (request, tokens) that all wait from the start: when each
    may be sent, in the order of request. A limit of 0 means none.

    The list is folded in one task; a row stands for a whole request, not for its texts.
    """

    def run(batches):
        pace = Pace(per_period or 1 << 30, tokens or float("inf"), period_ms)
        for batch in batches:
            at = []
            for n in batch.column(1).to_pylist():
                at.append(pace.earliest(0, n))
                pace.grant(at[-1], n)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(at, pa.int64())], names=["request", "tokens", "slot_ms"])

    listed = requests.select(F.col("request").cast("long").alias("request"), F.col("tokens").cast("double").alias("tokens"))
    return listed.repartition(1).sortWithinPartitions("request").mapInArrow(run, "request long, tokens double, slot_ms long")
