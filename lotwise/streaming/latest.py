"""The latest row of each key of a stream: keyed state with expiry, changes as they come, and a table folded from them."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import DateType, StructType, TimestampType

#: State store that keyed processors need; it spills to disk and checkpoints changes alone.
STORE = ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


class _Latest(StatefulProcessor):
    """Keeps the order of a key's newest row; a later row is given out and its order kept, an older or equal one is not.

    With ``keep`` milliseconds the state of a key goes once the watermark is so far beyond its newest row.
    """

    def __init__(self, names: list[str], order: StructType, keep: int | None):
        self.names, self.order, self.keep = names, order, keep

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("order", self.order)

    @staticmethod
    def _rank(values) -> tuple:
        return tuple((v is not None, 0 if v is None else v) for v in values)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        best = self._rank(self.state.get()) if self.state.exists() else None
        new = None
        for row in rows:
            rank = self._rank(row[c] for c in self.order.names)
            if best is None or rank > best:
                best, new = rank, row
        if new is None:
            return
        self.state.update(tuple(new[c] for c in self.order.names))
        if self.keep is not None and new["__time"] is not None:
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
            self.handle.registerTimer(new["__time"] + self.keep)
        yield Row(**{c: new[c] for c in self.names})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self.state.clear()
        yield from ()

    def close(self) -> None:
        pass


def _comparable(df: DataFrame, name: str) -> Column:
    """A column as state keeps it: times and days as numbers."""
    kind = df.schema[name].dataType
    if isinstance(kind, TimestampType):
        return F.unix_micros(name)
    return F.unix_date(name) if isinstance(kind, DateType) else F.col(name)


def latest_changes(stream: DataFrame, keys: list[str], order: list[str], time: str | None = None, late: str | None = None, keep_days: float | None = None) -> DataFrame:
    """A stream of the rows that became the newest of their key, to be written in update mode.

    Newest by ``order``, column after column, nulls first; of equal rows the first stays. Rows with a null in
    a key have no key and drop out (see ``keyless``). State is the order of one row a key. With ``time``, ``late`` and
    ``keep_days`` a key's state goes when the watermark (``late`` behind the newest time) has passed its row by that much: a
    key that comes again afterwards is given out anew, and ``folded`` still keeps the newest. Rows behind the
    watermark are left out.
    """
    spark = stream.sparkSession
    spark.conf.set(*STORE)
    rows = stream.where(" and ".join(f"`{k}` is not null" for k in keys))
    timed = time is not None and late is not None and keep_days is not None
    if timed:
        rows = rows.withWatermark(time, late).withColumn("__time", F.unix_millis(time))
    rows = rows.withColumns({f"__order_{i}": _comparable(stream, c) for i, c in enumerate(order)})
    kept = StructType([f for f in rows.schema if f.name.startswith("__order_")])
    processor = _Latest(stream.columns, kept, int(keep_days * 86_400_000) if timed else None)
    return rows.groupBy(*keys).transformWithState(processor, stream.schema, "Update", "EventTime" if timed else "None")


def keyless(stream: DataFrame, keys: list[str]) -> DataFrame:
    """The rows without a key, which are all kept."""
    return stream.where(" or ".join(f"`{k}` is null" for k in keys))


def changes_to(path: str) -> Callable[[DataFrame, int], None]:
    """A sink that writes the changes of each batch in a folder of its own; a repeated batch replaces itself, nothing else is rewritten."""

    def sink(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    return sink


def folded(changes: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The newest row of each key from its changes, by an aggregation that combines before it shuffles; of equal ones the first batch's."""
    names = [c for c in changes.columns if c != "batch"]
    first = [-F.col("batch")] if "batch" in changes.columns else []
    newest = F.max_by(F.struct(*names), F.struct(*(x for c in order for x in (F.col(c).isNotNull(), F.col(c))), *first))
    return changes.groupBy(*(F.col(k).alias(f"__{k}") for k in keys)).agg(newest.alias("row")).select("row.*")


def compacted(spark: SparkSession, path: str, into: str, keys: list[str], order: list[str]) -> DataFrame:
    """``folded`` changes written as a table of their own, so that readers needn't fold them again."""
    folded(spark.read.parquet(path), keys, order).write.mode("overwrite").parquet(into)
    return spark.read.parquet(into)
