"""State that changes by events in the order of their time, and by itself when a moment has come.

Rows of a key may arrive in any order; they wait in the state until the
watermark has passed them, so what comes out does not depend on micro-batches.
Something may be due in between (a grant, the end of a lease): one event-time
timer a key stands at the next event or due moment, so nothing is polled.

What waits is kept in Arrow blocks, in the state and in the task, and only some rows at a time are
Python's objects; what comes out is passed on row by row.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import islice

import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Row, SparkSession
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

#: State of this kind needs a store with column families.
STORE = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}


def use_store(spark: SparkSession) -> None:
    for name, value in STORE.items():
        spark.conf.set(name, value)


#: Rows of a block.
BLOCK = 8192
KINDS = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "string": pa.string()}


class Blocks:
    """Rows in the state of a key, read and written by blocks."""

    def __init__(self, handle: StatefulProcessorHandle, name: str, schema: str):
        self.schema = pa.schema([(column, KINDS[kind]) for column, kind in (c.split() for c in schema.split(", "))])
        self.kept, self.count = handle.getMapState(name, "n long", "block binary"), handle.getValueState(f"{name}Blocks", "n long")

    def read(self) -> pa.Table:
        n = self.count.get()[0] if self.count.exists() else 0
        blocks = (pa.ipc.open_stream(bytes(self.kept.getValue((i,))[0])).read_all() for i in range(n))
        return pa.concat_tables([self.schema.empty_table(), *blocks])

    def append(self, rows: pa.Table) -> None:
        n = self.count.get()[0] if self.count.exists() else 0
        for start in range(0, rows.num_rows, BLOCK):
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, self.schema) as out:
                out.write_table(rows.slice(start, BLOCK).combine_chunks())
            self.kept.updateValue((n,), (sink.getvalue().to_pybytes(),))
            n += 1
        if rows.num_rows:
            self.count.update((n,))

    def replace(self, rows: pa.Table) -> None:
        if self.count.exists():
            self.kept.clear()
            self.count.clear()
        self.append(rows)


def rows_of(table: pa.Table) -> Iterator[tuple]:
    for b in table.to_batches(max_chunksize=BLOCK):
        yield from zip(*(c.to_pylist() for c in b.columns), strict=True)


class InOrder(StatefulProcessor):
    """Subclasses name the columns of an event, time (milliseconds) first, and say how a key's state is
    read (``load``), written (``save``), when something is due, and what an event or a due moment does.

    At one moment events go first, in the order of their columns.
    """

    EVENT: str
    COLUMNS: tuple[str, ...]

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.coming = Blocks(handle, "coming", self.EVENT)
        self.timer = handle.getValueState("timer", "at long")
        self.open(handle)

    def open(self, handle: StatefulProcessorHandle) -> None:
        raise NotImplementedError

    def load(self):
        raise NotImplementedError

    def save(self, state) -> None:
        raise NotImplementedError

    def due(self, state) -> int | None:
        raise NotImplementedError

    def at_event(self, key: tuple, state, event: tuple) -> list[Row]:
        raise NotImplementedError

    def at_due(self, key: tuple, state, now: int) -> list[Row]:
        raise NotImplementedError

    def _set_timer(self, at: int | None) -> None:
        old = self.timer.get()[0] if self.timer.exists() else None
        if old == at:
            return
        if old is not None:
            self.handle.deleteTimer(old)
            self.timer.clear()
        if at is not None:
            self.handle.registerTimer(at)
            self.timer.update((at,))

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        at, new = None, (tuple(r[c] for c in self.COLUMNS) for r in rows)
        while block := list(islice(new, BLOCK)):
            columns = [pa.array(c, kind) for c, kind in zip(zip(*block, strict=True), self.coming.schema.types, strict=True)]
            self.coming.append(pa.Table.from_arrays(columns, schema=self.coming.schema))
            at = min(r[0] for r in block) if at is None else min(at, *(r[0] for r in block))
        if not self.timer.exists() or self.timer.get()[0] > at:
            self._set_timer(at)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        now = timerValues.getCurrentWatermarkInMs()
        self.timer.clear()
        coming = self.coming.read().sort_by([(c, "ascending") for c in self.coming.schema.names])
        passed = pa.compute.sum(pa.compute.less_equal(coming.column(0), now)).as_py() or 0
        ready, rest = rows_of(coming.slice(0, passed)), coming.slice(passed)
        state, event = self.load(), next(ready, None)
        while True:
            due = self.due(state)
            if event is not None and (due is None or event[0] <= due):
                yield from self.at_event(key, state, event)
                event = next(ready, None)
            elif due is not None and due <= now:
                yield from self.at_due(key, state, due)
            else:
                break
        self.coming.replace(rest)
        self.save(state)
        ahead = [t for t in (rest.column(0)[0].as_py() if rest.num_rows else None, due) if t is not None]
        self._set_timer(min(ahead) if ahead else None)

    def close(self) -> None:
        pass
