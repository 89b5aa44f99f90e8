"""Leases of tasks that end by themselves: claims, renewals and ends come in as a stream, what became of them goes out.

A task is claimed by an owner for a time; the owner may renew the lease or
finish the task, and if it does neither until the lease is over, the end of the
lease is an event of its own, at its time, and others may claim the task. Claims
of a held task, and renewals and results of an owner that does not hold it
(any more), are answered as refused and change nothing.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from .in_order import InOrder

OUTPUT = "task string, at_ms long, what string, owner string, until_ms long"
EVENT = Row("task", "at_ms", "what", "owner", "until_ms")
KINDS = ("claim", "renew", "finish")


@dataclass
class Lease:
    owner: str | None = None
    until: int | None = None
    done: bool = False


class Leases(InOrder):
    """Rows of ts_ms, event (its id), kind (one of KINDS) and owner of one task."""

    EVENT, COLUMNS = "ts_ms long, event long, kind string, owner string", ("ts_ms", "event", "kind", "owner")

    def __init__(self, lease_ms: int):
        self.lease = lease_ms

    def open(self, handle) -> None:
        self.held = handle.getValueState("held", "owner string, until long, done boolean")

    def load(self) -> Lease:
        return Lease(*self.held.get()) if self.held.exists() else Lease()

    def save(self, state: Lease) -> None:
        self.held.update((state.owner, state.until, state.done))

    def due(self, state: Lease) -> int | None:
        return state.until

    def at_event(self, key, state: Lease, event) -> list[Row]:
        ts, _, kind, owner = event
        takes = state.owner is None and not state.done if kind == "claim" else state.owner == owner
        if not takes:
            return [EVENT(key[0], ts, f"{kind} refused", owner, state.until)]
        if kind == "finish":
            state.owner, state.until, state.done = None, None, True
        else:
            state.owner, state.until = owner, ts + self.lease
        return [EVENT(key[0], ts, kind, owner, state.until)]

    def at_due(self, key, state: Lease, now: int) -> list[Row]:
        owner, state.owner, state.until = state.owner, None, None
        return [EVENT(key[0], now, "expired", owner, None)]


def leases(events: DataFrame, lease_ms: int, late: str = "10 minutes") -> DataFrame:
    """What became of a stream of task, event, ts (an instant), kind and owner; needs ``in_order.use_store``."""
    rows = events.withWatermark("ts", late).withColumn("ts_ms", F.unix_millis("ts"))
    return rows.select("task", "event", "ts", "ts_ms", "kind", "owner").groupBy("task").transformWithState(Leases(lease_ms), OUTPUT, "Append", "EventTime")
