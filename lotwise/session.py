"""Sessions with the settings that the engine expects."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def session(app: str = "lotwise", master: str | None = None, **settings: str) -> SparkSession:
    """A session in UTC with adaptive execution. ``settings`` override, with dots written as double underscores."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    base = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    for key, value in (base | {k.replace("__", "."): v for k, v in settings.items()}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names; one of this machine's is made only where driver and executors are one process."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        named = sc.getConf().get("spark.checkpoint.dir")
        if not named and not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise RuntimeError("spark.checkpoint.dir names no folder that driver and executors share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="checkpoint-"))
    return sc.getCheckpointDir()


def spread(df: DataFrame) -> DataFrame:
    """``df`` dealt out over all cores: for few bytes with much work a row, which would else stay in one task."""
    return df.repartition(2 * df.sparkSession.sparkContext.defaultParallelism)


def settled(df: DataFrame) -> DataFrame:
    """``df`` as a reliable checkpoint, for what several parts of a plan read."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def stored(df: DataFrame) -> DataFrame:
    """As ``settled``, but as a compressed Parquet table in that folder: for many rows of plain columns."""
    path = f"{shared_folder(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
