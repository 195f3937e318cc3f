"""Near-duplicate items of a stream: groups with state of their own and timers.

A group lasts ``minutes`` from its first item. Once the watermark has passed its end,
no item can join it or come before it, so its newest items go out and the rest is
forgotten. A place holds the items of groups that aren't over yet: what arrives
within a group's length and the lateness allowed, however long the stream runs.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

#: The store that timers and lists need.
STORE = ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


def close_groups(rows: list, reach: int, until: int) -> tuple[list[tuple[int, object]], list]:
    """((first time, row) of the newest rows of groups that end by ``until``, rows held on): ``rows`` have _t, the time, and _u, the update."""
    rows = sorted(rows, key=lambda r: r["_t"])
    out, i = [], 0
    while i < len(rows) and rows[i]["_t"] + reach <= until:
        first, j = rows[i]["_t"], i
        while j < len(rows) and rows[j]["_t"] <= first + reach:
            j += 1
        newest = max((r["_u"] for r in rows[i:j] if r["_u"] is not None), default=None)
        out += [(first, r) for r in rows[i:j] if r["_u"] == newest]
        i = j
    return out, rows[i:]


class Groups(StatefulProcessor):
    """The open groups of a place."""

    def __init__(self, held: T.StructType, names: list[str], reach: int):
        self.schema, self.names, self.reach = held, names, reach

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getListState("held", self.schema)

    def _wake(self, first: int) -> None:
        self.handle.registerTimer((first + self.reach) // 1000 + 1)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        first, new = None, []
        for r in rows:
            first = r["_t"] if first is None else min(first, r["_t"])
            new.append(tuple(r[n] for n in self.names))
        if new:
            self.held.appendList(new)
            self._wake(first)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        held = [dict(zip(self.names, r, strict=True)) for r in self.held.get()]
        done, rest = close_groups(held, self.reach, timerValues.getCurrentWatermarkInMs() * 1000)
        if done:
            if rest:
                self.held.put([tuple(r[n] for n in self.names) for r in rest])
            else:
                self.held.clear()
        if rest:
            self._wake(rest[0]["_t"])
        for first, r in done:
            yield Row(_first=first, **{n: v for n, v in r.items() if n != "_u"})

    def close(self) -> None:
        pass


def near_duplicates(stream: DataFrame, place: list[str], time: str = "event_time", updated: str = "updated", minutes: float = 60, late: str | None = "60 minutes") -> DataFrame:
    """``items.near_duplicates`` of a stream: each group goes out once the watermark has passed its end.

    ``late`` is how much later than others an item may arrive (None: the stream has
    its watermark); later ones are dropped. Over all items that weren't late the
    result is that of the table. Items without a time have no place in the order and
    are dropped; a null update is older than all others; repeated rows all stay. At
    a stream's end the last groups of places stay open until later items come. The
    session's state store becomes STORE; a stream that goes on from a checkpoint
    keeps the one it began with.
    """
    spark = stream.sparkSession
    spark.conf.set(*STORE)
    marked = (stream.withWatermark(time, late) if late else stream).where(F.col(time).isNotNull())
    rows = marked.withColumns({"_t": F.unix_micros(F.col(time).cast("timestamp")), "_u": F.col(updated)})
    names = [c for c in rows.columns if c != time]
    held = T.StructType([T.StructField(n, rows.schema[n].dataType) for n in names])
    # the state holds an item's time once, as a number
    out = T.StructType([T.StructField("_first", T.LongType()), *(f for f in held.fields if f.name != "_u")])
    groups = rows.groupBy(*place).transformWithState(Groups(held, names, round(minutes * 60_000_000)), out, "append", "eventTime")
    kind = stream.schema[time].dataType
    back = groups.withColumn(time, F.timestamp_micros("_t").cast(kind)).withColumn("group_start", F.timestamp_micros("_first").cast("timestamp_ntz"))
    return back.select(*stream.columns, "group_start")
