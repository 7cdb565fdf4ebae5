"""Streams of observations: deduplicated by key within a watermark, windowed, in sessions, joined in time, compared with their last version, merged batch by batch."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from ..operators.state import last_by
from ..session import ship
from ..sources.store import Store, ingest


def distinct_observations(stream: DataFrame, at: str, keys: list[str], delay: str = "10 minutes") -> DataFrame:
    return stream.withWatermark(at, delay).dropDuplicatesWithinWatermark(keys)


def windowed(stream: DataFrame, at: str, size: str, by: list[str], delay: str = "10 minutes", slide: str | None = None) -> DataFrame:
    grouped = stream.withWatermark(at, delay).groupBy(F.window(at, size, slide) if slide else F.window(at, size), *by)
    return grouped.agg(F.count(F.lit(1)).alias("n"))


def sessions(stream: DataFrame, at: str, gap: str, by: list[str], delay: str = "10 minutes") -> DataFrame:
    """Runs of observations of which none is ``gap`` or more after the one before: session (start and end), ``by``, n.

    An observation later than ``delay`` behind the newest one is left out.
    """
    return stream.withWatermark(at, delay).groupBy(F.session_window(at, gap).alias("session"), *by).agg(F.count(F.lit(1)).alias("n"))


def followed(first: DataFrame, first_at: str, then: DataFrame, then_at: str, key: str, within: str, delay: str = "10 minutes") -> DataFrame:
    """Each observation of one stream with those of another that follow it within a time, by key; other columns must have different names.

    Both sides have watermarks, so a row is forgotten once nothing can follow it any more; rows
    later than ``delay`` behind their stream may find nothing.
    """
    a, b = first.withWatermark(first_at, delay).alias("a"), then.withWatermark(then_at, delay).alias("b")
    near = F.expr(f"a.`{key}` = b.`{key}` AND b.`{then_at}` >= a.`{first_at}` AND b.`{then_at}` <= a.`{first_at}` + INTERVAL {within}")
    return a.join(b, near).select("a.*", *[f"b.`{c}`" for c in then.columns if c != key])


class _Versions(StatefulProcessor):
    """The last content of a key and when it was seen; a timer makes a tombstone of what isn't seen again in time."""

    def __init__(self, key: str, content: str, at: str, after_ms: int):
        self.key, self.content, self.at, self.after_ms = key, content, at, after_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("last", "content string, due long, live boolean")

    def _row(self, key: tuple, change: str, content: str | None) -> pd.DataFrame:
        return pd.DataFrame({self.key: [key[0]], "change_type": [change], self.content: [content]})

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        found = pd.concat(list(rows)).sort_values([self.at, self.content])
        content, due, live = self.state.get() if self.state.exists() else (None, None, False)
        timer, changes = due if live else None, []
        for now in found[self.content]:
            changes.append("inserted" if not live else "reused" if content == now else "changed")
            content, live = now, True
        # only the last row's timer can stand
        due = int(found[self.at].iloc[-1].timestamp() * 1000) + self.after_ms
        if due != timer:
            if timer is not None:
                self.handle.deleteTimer(timer)
            self.handle.registerTimer(due)
        self.state.update((content, due, True))
        yield pd.DataFrame({self.key: [key[0]] * len(changes), "change_type": changes, self.content: found[self.content].to_numpy()})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        last = self.state.get()
        if last is not None and last[2] and expiredTimerInfo.getExpiryTimeInMs() >= last[1]:
            self.state.update((last[0], last[1], False))
            yield self._row(key, "deleted", last[0])

    def close(self) -> None:
        pass


def versions(stream: DataFrame, key: str, content: str, at: str, after_ms: int, delay: str = "0 seconds") -> DataFrame:
    """(key, change_type, content) of each observation against the last of its key: inserted, changed or reused; deleted once a key isn't seen for ``after_ms``.

    State is kept by key in RocksDB, so the session must name that state store.  ``content`` is text.
    """
    ship(stream.sparkSession)
    kind = dict(stream.dtypes)[key]
    rows = stream.select(key, F.col(content).cast("string").alias(content), at).withWatermark(at, delay)
    out = f"`{key}` {kind}, change_type string, `{content}` string"
    return rows.groupBy(key).transformWithStateInPandas(_Versions(key, content, at, after_ms), out, "Append", "EventTime")


def merge_stream(stream: DataFrame, store: Store, name: str, key: str, content: str, order: str, checkpoint: str, once: bool = False) -> StreamingQuery:
    """Merges each micro-batch; of a key's rows in a batch the one with the largest ``order`` wins.

    A stream shows no absence, so it makes no tombstones.  ``order`` must be a column of the
    events themselves, so that a batch that is run again after a failure merges alike.  With
    ``once`` the query ends when all that is there has been merged.
    """

    def merge(batch: DataFrame, _: int) -> None:
        ingest(store, name, last_by(batch.where(F.col(key).isNotNull()), [key], order), key, content, snapshot=False)

    writer = stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


def publish_stream(stream: DataFrame, store: Store, name: str, checkpoint: str, mode: str = "complete", once: bool = False) -> StreamingQuery:
    """Publishes a stream's result: the whole table at each batch in complete mode, closed rows added in append mode."""

    def write(batch: DataFrame, _: int) -> None:
        if mode == "complete" or name not in store.names():
            store.replace(name, batch)
        elif not batch.isEmpty():
            store.add(name, batch)

    writer = stream.writeStream.outputMode(mode).foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()
