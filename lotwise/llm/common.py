"""Shared pieces of the corpus operators: row keys, checkpoints, batches, components."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that a Python worker turns into arrays at a time.
CHUNK_BYTES = 1 << 20
#: Rows of an Arrow batch that holds whole texts; Spark's default of 10 000 rows takes too much memory on both sides.
BATCH_ROWS = 2000
#: And so many bytes, for long texts.
BATCH_BYTES = 16 << 20
# Freed batches go back to the system instead of a worker's pool.
pa.set_memory_pool(pa.system_memory_pool())


def bounded_batches(spark: SparkSession) -> None:
    """Smaller Arrow batches for the session, unless it asks for still smaller ones."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= BATCH_ROWS:
        spark.conf.set(name, BATCH_ROWS)
    size = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(size, None) in (None, "-1", "0") or spark.conf.get(size).isdigit() and int(spark.conf.get(size)) > BATCH_BYTES:
        spark.conf.set(size, str(BATCH_BYTES))


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    bounded_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder the session names for checkpoints; one of this machine's only where driver and executors are one process."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        named = sc.getConf().get("spark.checkpoint.dir")
        if not named and not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise RuntimeError("spark.checkpoint.dir names no folder that driver and executors share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="checkpoint-"))
    return sc.getCheckpointDir()


def checkpoint(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the folder the session names; a folder of its own only where none is set."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def stash(df: DataFrame) -> DataFrame:
    """As ``checkpoint``, but as a compressed table in that folder: for intermediate results of many rows."""
    path = f"{shared_folder(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete the files of a table that ``stash`` has written, once nothing will read it again."""
    jvm = df.sparkSession.sparkContext._jvm
    conf = df.sparkSession.sparkContext._jsc.hadoopConfiguration()
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if re.search(r"/table-[0-9a-f]{32}$", folder):
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(conf).delete(path, True)


#: Rows up to which a counted side of a join is broadcast.
BROADCAST_ROWS = 500_000


def small(df: DataFrame) -> DataFrame:
    """``df``, broadcast if a count of it shows that it is small; a larger one is shuffled."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def split_copies(docs: DataFrame, least: int) -> tuple[DataFrame, DataFrame]:
    """(docs without exact copies, copies): of equal texts of at least ``least`` bytes the first row stays.

    Copies: rid, first (the row that stays), n_bytes. Texts are compared by SHA-256;
    counting combines before the shuffle, so a group may hold any share of the rows.
    """
    bodies = checkpoint(docs.where(F.octet_length("text") >= least).select("rid", F.unhex(F.sha2("text", 256)).alias("body"), F.octet_length("text").cast("long").alias("n_bytes")))
    firsts = bodies.groupBy("body").agg(F.min("rid").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    copies = checkpoint(bodies.join(firsts, "body").where("rid > first").select("rid", "first", "n_bytes"))
    return docs.join(small(copies.select("rid")), "rid", "left_anti"), copies


#: Column of the row key, named so that no table's column clashes.
KEY = "__lotwise_row_key"


def with_key(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``df`` with a column ``KEY``: a unique long, in the order of ids, ties by text.

    Ids that are unique and not null are their own keys. Otherwise (repeated rows,
    null ids) rows are numbered in the order (id, nulls first, then text), and the
    numbering is checkpointed so that every later pass sees the same keys.
    """
    if KEY in df.columns:
        return df
    key = F.col(id_col).cast("long")
    odd = df.groupBy(key.alias("id")).agg(F.count(F.lit(1)).alias("n")).where((F.col("n") > 1) | F.col("id").isNull())
    if odd.isEmpty():
        return df.withColumn(KEY, key)
    return checkpoint(df.orderBy(key.asc_nulls_first(), F.col(text_col).asc_nulls_first()).withColumn(KEY, F.monotonically_increasing_id()))


def keyed(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Columns ``rid`` (as of ``with_key``), ``id`` (long) and ``text`` (empty for null)."""
    kept = [id_col, text_col] + [KEY] * (KEY in df.columns)
    rows = with_key(df.select(*kept), id_col, text_col)
    return rows.select(F.col(KEY).alias("rid"), F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def raw_bytes(column: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of a string column; null is empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def slices(batch: pa.RecordBatch, column: str, limit: int = CHUNK_BYTES) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Runs of rows whose texts together have about ``limit`` bytes; one long text stays whole."""
    col = batch.column(column)
    sizes = np.asarray(pc.fill_null(pc.binary_length(col), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    if not len(sizes):
        return
    cut = np.cumsum(sizes) // limit
    edges = [0, *(np.nonzero(np.diff(cut))[0] + 1).tolist(), len(sizes)]
    for a, b in zip(edges, edges[1:]):
        part = batch.slice(a, b - a)
        yield part, raw_bytes(part.column(column))


def words_of(raw: bytes) -> list[bytes]:
    """Lower-cased (A-Z only) words between the white space x20, x09-x0D."""
    return raw.lower().split()


def mix(h: np.ndarray) -> np.ndarray:
    """Finalizer that spreads every input bit over 64 output bits."""
    with np.errstate(over="ignore"):
        h = h ^ (h >> np.uint64(33))
        h = h * np.uint64(0xFF51AFD7ED558CCD)
        h = h ^ (h >> np.uint64(29))
        h = h * np.uint64(0xC4CEB9FE1A85EC53)
        return h ^ (h >> np.uint64(32))


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """Connected components of ``edges`` (a, b longs) by alternating large and small stars.

    Returns (id, component) for every id that has an edge; the component is its
    smallest id. Each round is two joins on a node key, cut by a table, so no
    task and no driver ever holds a component. Rounds grow with the logarithm of a path; if ``rounds`` don't do, it raises.
    """
    e = stash(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u > v").distinct())
    state = None
    for _ in range(rounds):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v").distinct()
        small = large.groupBy("u").agg(F.min("v").alias("m"))
        linked = large.join(small, "u")
        e = linked.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v").unionByName(linked.select("u", F.col("m").alias("v"))).distinct()
        e = stash(e)
        now = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    roots = e.select(F.col("v").alias("id")).distinct().select("id", F.col("id").alias("component"))
    return e.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(roots)
