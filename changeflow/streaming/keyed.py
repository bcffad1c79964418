"""Current state and first writes kept on a stream: Spark's state store holds each key, the output is what changes.

The state of a key is its last operation with its order, deletes included, so a late record loses by its order, whatever batch it
comes in. Following the output gives the same table as ``latest_by_key`` or ``first_by_key`` over all records.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

from pyspark.sql import DataFrame, Row
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from changeflow.functions.columns import checked_op
from changeflow.functions.schema import OP
from changeflow.operators.state import ORDER

ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class _Net(StatefulProcessor):
    """What both kinds share: the row that was there, the one that is, and the changes between them."""

    def __init__(self, schema: T.StructType, order: tuple[str, ...], op_col: str, before: bool):
        self.schema, self.names, self.before = schema, schema.names, before
        self.at = [self.names.index(c) for c in order]
        self.op = self.names.index(op_col)

    def place(self, row: tuple) -> tuple:
        return tuple((row[k] is not None, row[k]) for k in self.at)

    def net(self, old: tuple | None, new: tuple | None) -> Iterator[Row]:
        if old == new:
            return
        shown = lambda op, row: Row(**{n: op if k == self.op else v for k, (n, v) in enumerate(zip(self.names, row, strict=True))})
        if new is None:
            yield shown("d", old)
        elif old is None:
            yield shown("i", new)
        else:
            if self.before:
                yield shown("d", old)
            yield shown("u", new)

    def live(self, row: tuple | None) -> tuple | None:
        return None if row is None or row[self.op] == "d" else row

    def close(self) -> None:
        pass


class _Latest(_Net):
    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", self.schema)

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:  # noqa: N803
        saved = tuple(self.last.get()) if self.last.exists() else None
        top, at = saved, None if saved is None else self.place(saved)
        for row in map(tuple, rows):
            place = self.place(row)
            if at is None or place > at:
                top, at = row, place
        if top is not saved:
            self.last.update(top)
            yield from self.net(self.live(saved), self.live(top))


class _First(_Net):
    """The last delete and the writes after it: a delete that comes late can bring back a later write."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.gone = handle.getValueState("gone", self.schema)
        self.writes = handle.getListState("writes", self.schema)

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:  # noqa: N803
        gone = tuple(self.gone.get()) if self.gone.exists() else None
        writes = [tuple(r) for r in self.writes.get()] if self.writes.exists() else []
        was = min(writes, key=self.place, default=None)
        known, fresh = {self.place(w) for w in writes}, []
        for row in map(tuple, rows):
            if row[self.op] == "d":
                if gone is None or self.place(row) > self.place(gone):
                    gone = row
                    self.gone.update(row)
            elif self.place(row) not in known:
                known.add(self.place(row))
                fresh.append(row)
        after = lambda w: gone is None or self.place(w) > self.place(gone)
        kept, fresh = [w for w in writes if after(w)], [w for w in fresh if after(w)]
        if len(kept) < len(writes):
            self.writes.put(kept + fresh) if kept or fresh else self.writes.clear()
        elif fresh:
            self.writes.appendList(fresh)
        yield from self.net(was, min(kept + fresh, key=self.place, default=None))


def keyed_changes(changes: DataFrame, keys: list[str], *, on_conflict: str = "update", order: tuple[str, ...] = ORDER, emit_update_before: bool = False, op_col: str = OP) -> DataFrame:
    """The net changes of a stream of change rows, in update mode: i, u and d of the table that the rows so far make.

    ``update``: the last operation of a key counts; ``nothing``: the first write after its last delete. A record that changes nothing
    (late, repeated, a delete of what isn't there) gives no row. A d row has the image that goes; with ``emit_update_before`` an
    update gives one first, as running totals need. State is a row for each key, and with ``nothing`` each write since its
    last delete. The session's state store is set to RocksDB, which keeps state on disk; a null operation is an error.
    """
    if on_conflict not in ("update", "nothing"):
        raise ValueError(f"on_conflict must be update or nothing, not {on_conflict!r}")
    if not keys:
        raise ValueError("keyed state needs keys")
    changes.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS)
    rows = checked_op(changes, op_col)
    kind = _Latest if on_conflict == "update" else _First
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in rows.schema.fields])
    return rows.groupBy(*keys).transformWithState(kind(schema, tuple(order), op_col, emit_update_before), schema, "Update", "None")
