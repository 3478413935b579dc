"""Incremental ingestion with Structured Streaming: new files once, rolling months, period changes, retries. Latest rows by key are in ``latest``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lotwise.functions.numbers import add_months


def new_files(spark: SparkSession, folder: str, schema, per_run: int = 6, kind: str = "parquet") -> DataFrame:
    """A stream of a folder's files; each is read once over all runs that share a checkpoint."""
    return spark.readStream.format(kind).schema(schema).option("maxFilesPerTrigger", per_run).option("recursiveFileLookup", "true").load(folder)


def drain(stream: DataFrame, checkpoint: str, sink: Callable[[DataFrame, int], None]) -> StreamingQuery:
    """All that is available now, in batches; what the sink has taken isn't read again."""
    query = stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(sink).start()
    query.awaitTermination()
    return query


def append_to(path: str, partition: list[str] = ()) -> Callable[[DataFrame, int], None]:
    """A sink that writes each batch in a folder of its own number, so a repeated batch replaces itself."""

    def sink(batch: DataFrame, number: int) -> None:
        writer = batch.write.mode("overwrite")
        (writer.partitionBy(*partition) if partition else writer).parquet(f"{path}/batch={number}")

    return sink


def rolling(df: DataFrame, months: int, period: str = "yyyymm") -> DataFrame:
    """Rows of the last months, counted back from the last one there is."""
    last = df.agg(add_months(F.max(period), 1 - months).alias("__from"))
    return df.join(F.broadcast(last), F.col(period) >= F.col("__from")).drop("__from")


def windowed(stream: DataFrame, time: str, late: str, width: str, keys: list[str], value: str) -> DataFrame:
    """Counts and sums of event-time windows; rows later than ``late`` behind the newest are left out."""
    return stream.withWatermark(time, late).groupBy(F.window(time, width), *keys).agg(F.count(F.lit(1)).alias("n"), F.sum(value).alias("total"))


def period_changed(current: DataFrame, known: DataFrame, period: str = "yyyymm") -> bool:
    """Whether a source has a period beyond the one that is known."""
    now, old = current.agg(F.max(period)).first()[0], known.agg(F.max(period)).first()[0]
    return now is not None and (old is None or now > old)


def retried(first: DataFrame, again: DataFrame, key: str) -> DataFrame:
    """Results of a second try in place of those of the first, by key."""
    return again.unionByName(first.join(again.select(key).distinct(), key, "left_anti"), allowMissingColumns=True)
