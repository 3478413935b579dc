"""Exact top-k inner products: norm-sorted blocks, SVD-rotated partial sums, Cauchy-Schwarz bounds."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lotwise.llm.common import checkpoint

K = 20
SCALE = 64
QUERY_EVERY = 20
#: Rows of the order that a block of queries is taken from, and of a block of candidates.
QUERIES, CANDIDATES = 16384, 4096
#: Rotated components that the first partial sums take.
LEAD = 16
#: Largest magnitude of a component, so that 2^10 products add up exactly in a double.
EXACT = 2**21


def _matrix(column: pa.Array, dim: int, kind=np.float64) -> np.ndarray:
    """Rows of a list column, filled with zeros up to ``dim`` components."""
    n, size = len(column), pc.list_value_length(column).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if len(flat) == n * dim and (size == dim).all():
        return flat.reshape(n, dim).astype(kind)
    out = np.zeros((n, dim), dtype=kind)
    row = np.repeat(np.arange(n), size)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)] = flat
    return out


def vectors(df: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """(vec_id, v, norm): floor(scale * x) of each component x as a double. Null ids and null or non-finite components drop out."""
    x = F.col(vector_col)
    bad = F.exists(x, lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == float("inf")))
    rows = df.where(F.col(id_col).isNotNull() & x.isNotNull()).where(~bad)
    v = F.transform(x, lambda e: F.floor(F.lit(scale) * e.cast("double")).cast("long"))
    rows = rows.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v"))
    return rows.withColumn("norm", F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, e: a + e.cast("double") * e.cast("double"))))


def rotation(rows: DataFrame, dim: int) -> np.ndarray:
    """Right singular vectors of all the rows, from the sum of their outer products (dim x dim numbers)."""

    def run(batches):
        total = np.zeros((dim, dim))
        for batch in batches:
            x = _matrix(batch.column("v"), dim)
            total += x.T @ x
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(dim)), pa.array(list(total), pa.list_(pa.float64()))], names=["at", "row"])

    parts = rows.select("v").mapInArrow(run, "at long, row array<double>")
    sums = parts.groupBy("at").agg(*(F.sum(F.col("row")[i]).alias(str(i)) for i in range(dim))).collect()
    gram = np.zeros((dim, dim))
    for r in sums:
        gram[r["at"]] = [r[str(i)] for i in range(dim)]
    return np.linalg.eigh(gram)[1][:, ::-1].copy()


def _exact(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Integer inner products of all rows of q and x."""
    top = max(int(np.abs(q).max(initial=0)), int(np.abs(x).max(initial=0)))
    if top < EXACT and q.shape[1] <= 1024:
        return np.rint(q.astype(np.float64) @ x.astype(np.float64).T).astype(np.int64)
    return q @ x.T


def _best(score: np.ndarray, ids: np.ndarray, rows: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    order = np.lexsort((rows, ids, -score))[:k]
    return score[order], ids[order], rows[order]


def search(q: np.ndarray, qid: np.ndarray, x: np.ndarray, xid: np.ndarray, xrow: np.ndarray, qrow: np.ndarray, turn: np.ndarray, floor: np.ndarray, k: int, lead: int = LEAD, step: int = 512):
    """For each query the up to k best rows of x that reach ``floor``: lists of (query index, score, id, row).

    x comes by descending length. Runs of ``step`` rows are taken in turn; a query passes over a
    run if the product of lengths can't reach its k-th score so far, and over a row
    if the partial sum of the leading rotated components and the product of the
    residual lengths can't. Rows that are left get their integer product.
    """
    qf, xf = q.astype(np.float64), x.astype(np.float64)
    qr, xr = qf @ turn, xf @ turn
    qn, xn = np.sqrt((qf * qf).sum(1)), np.sqrt((xf * xf).sum(1))
    qt, xt = np.sqrt((qr[:, lead:] ** 2).sum(1)), np.sqrt((xr[:, lead:] ** 2).sum(1))
    need = floor.astype(np.float64).copy()
    kept = [(np.zeros(0, np.int64),) * 3 for _ in range(len(q))]
    for s in range(0, len(x), step):
        e = min(s + step, len(x))
        slack = 1e-9 * (1 + qn * xn[s])
        live = np.nonzero(qn * xn[s] + slack >= need)[0]
        if not len(live):
            break  # later rows are shorter
        bound = qr[live, :lead] @ xr[s:e, :lead].T + qt[live, None] * xt[None, s:e] + slack[live, None]
        open_ = bound >= need[live, None]
        touched = np.nonzero(open_.any(axis=1))[0]
        if not len(touched):
            continue
        columns = np.nonzero(open_[touched].any(axis=0))[0]
        scores = _exact(q[live[touched]], x[s:e][columns])
        good = open_[np.ix_(touched, columns)] & (scores >= need[live[touched], None]) & (qrow[live[touched], None] != xrow[s:e][columns][None, :])
        for a in np.nonzero(good.any(axis=1))[0].tolist():
            i = live[touched[a]]
            at = columns[good[a]]
            old = kept[i]
            kept[i] = _best(np.append(old[0], scores[a][good[a]]), np.append(old[1], xid[s:e][at]), np.append(old[2], xrow[s:e][at]), k)
            if len(kept[i][0]) == k:
                need[i] = max(need[i], kept[i][0][-1])
    return [(i, *map(int, t)) for i, f in enumerate(kept) for t in zip(*f)], need


def _small(v: np.ndarray) -> np.ndarray:
    """The same integers in the smallest type that holds them."""
    top = int(np.abs(v).max(initial=0))
    return v.astype(next(t for t in (np.int8, np.int16, np.int32, np.int64) if top <= np.iinfo(t).max))


def _blocks(rows: DataFrame, size: int, dim: int, prefix: str) -> DataFrame:
    """Blocks of up to ``size`` rows that follow each other in the order: their ids, row keys and components as bytes."""

    def run(batches):
        for batch in batches:
            out = []
            for block, members in zip(batch.column("block").to_pylist(), batch.column("members")):
                members = members.values
                v = _small(_matrix(members.field("v"), dim, np.int64))
                ids, keys = members.field("vec_id").to_numpy(), members.field("row").to_numpy()
                order = np.argsort(keys)
                out.append((block, ids[order].tobytes(), keys[order].tobytes(), v.dtype.str, v[order].tobytes(), float(members.field("norm").to_numpy().max())))
            types = [pa.int64(), pa.binary(), pa.binary(), pa.string(), pa.binary(), pa.float64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*out)) or [()] * 6, types)], names=names)

    names = [prefix + n for n in ("block", "ids", "rows", "type", "data", "top")]
    schema = "{0}block long, {0}ids binary, {0}rows binary, {0}type string, {0}data binary, {0}top double".format(prefix)
    return rows.groupBy(F.floor(F.col("row") / size).alias("block")).agg(F.collect_list(F.struct("row", "vec_id", "norm", "v")).alias("members")).mapInArrow(run, schema)


def _load(row: dict, prefix: str, dim: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    ids, keys = np.frombuffer(row[prefix + "ids"], dtype=np.int64), np.frombuffer(row[prefix + "rows"], dtype=np.int64)
    return np.frombuffer(row[prefix + "data"], dtype=row[prefix + "type"]).reshape(len(ids), dim).astype(np.int64), ids, keys


def numbered(rows: DataFrame) -> DataFrame:
    """``rows``, checkpointed, with ``row``: their number in the order of (norm descending, vec_id) over all partitions.

    The driver gets one number for each partition.
    """
    parts = checkpoint(rows.orderBy(F.desc("norm"), "vec_id").withColumn("at", F.monotonically_increasing_id()))
    sizes = sorted((r["part"], r["n"]) for r in parts.groupBy(F.shiftright("at", 33).alias("part")).agg(F.count(F.lit(1)).alias("n")).collect())
    before, start = 0, []
    for part, n in sizes:
        start.append((part, before))
        before += n
    starts = parts.sparkSession.createDataFrame(start, "part long, before long")
    joined = parts.withColumn("part", F.shiftright("at", 33)).join(F.broadcast(starts), "part")  # a row a partition
    return joined.withColumn("row", F.col("before") + F.col("at").bitwiseAND((1 << 33) - 1)).select("vec_id", "v", "norm", "row")


#: Lengths, evenly spaced in the order of the blocks, that tell up to which block a query block has to look.
MARKS = 4096


def block_pairs(blocks: DataFrame, floors: DataFrame) -> DataFrame:
    """(c_block, q_block): all pairs whose greatest lengths can reach the queries' least floor.

    Blocks come by descending length, so a query block needs those up to some number; the first of
    at most MARKS evenly spaced lengths that falls short bounds it before any pair is made.
    """
    many = blocks.count()
    step = -(-many // MARKS) if many else 1
    marks = [r["c_top"] for r in blocks.where(F.col("c_block") % step == 0).orderBy("c_block").select("c_top").collect()]  # at most MARKS
    reach = F.col("q_top") * (1 + 1e-9)
    open_marks = F.size(F.filter(F.array(*map(F.lit, marks)) if marks else F.array().cast("array<double>"), lambda top: reach * top >= F.col("q_low")))
    turns = floors.select("q_block", "q_top", "q_low", open_marks.alias("n")).where("n > 0")
    each = turns.select("q_block", "q_top", "q_low", F.explode(F.sequence(F.lit(0).cast("long"), F.least(F.col("n") * step, F.lit(many)) - 1)).alias("c_block"))
    return each.join(blocks.select("c_block", "c_top"), "c_block").where(F.col("q_top") * F.col("c_top") * (1 + 1e-9) >= F.col("q_low")).select("c_block", "q_block")


def top_k(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = K, every: int = QUERY_EVERY, scale: int = SCALE) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` best rows for each row whose id ``every`` divides.

    Score: inner product of the components floor(scale * x). Candidates are all rows but
    the query's own; ties go to the smaller id, all are given if fewer than ``k`` are there.
    Rows with a null id, a null vector, or a null or non-finite component take no part;
    shorter vectors are filled with zeros; repeated rows are rows of their own. An empty
    table gives no rows; other columns are not read.

    Rows are numbered by descending length and cut into blocks of CANDIDATES rows, however they are
    partitioned. A first pass over the block of the longest rows gives each query a score that its k-th must
    reach. Only pairs of blocks that can reach it by the product of their greatest lengths are
    made; each is searched in one bounded task.
    """
    rows = numbered(vectors(df, id_col, vector_col, scale))
    dim = max(1, rows.agg(F.max(F.size("v"))).first()[0] or 1)
    turn, lead = rotation(rows, dim), min(LEAD, dim)
    blocks = checkpoint(_blocks(rows, CANDIDATES, dim, "c_"))
    longest = blocks.where("c_block = 0").withColumn("c_block", F.lit(0))
    queries = _blocks(rows.where(F.col("vec_id") % every == 0), QUERIES, dim, "q_").withColumn("c_block", F.lit(0))

    def first(batches):
        for batch in batches:
            need = []
            for row in batch.to_pylist():
                (q, qid, qrow), (x, xid, xrow) = _load(row, "q_", dim), _load(row, "c_", dim)
                need.append(search(q, qid, x, xid, xrow, qrow, turn, np.full(len(q), -np.inf), k, lead)[1])
            names = [n for n in batch.schema.names if n.startswith("q_")]
            low = [float(n.min()) for n in need]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), pa.array([n.tobytes() for n in need], pa.binary()), pa.array(low, pa.float64())], names=[*names, "q_need", "q_low"])

    q_schema = "q_block long, q_ids binary, q_rows binary, q_type string, q_data binary, q_top double"
    floors = queries.join(F.broadcast(longest), "c_block").drop("c_block")  # one block
    floors = checkpoint(floors.mapInArrow(first, q_schema + ", q_need binary, q_low double"))
    pairs = block_pairs(blocks, floors).join(floors, "q_block").join(blocks, "c_block")

    def second(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                (q, qid, qrow), (x, xid, xrow) = _load(row, "q_", dim), _load(row, "c_", dim)
                found = search(q, qid, x, xid, xrow, qrow, turn, np.frombuffer(row["q_need"]), k, lead)[0]
                at, score, ids, keys = (np.array(c, dtype=np.int64) for c in (zip(*found) if found else [()] * 4))
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in (qrow[at], qid[at], ids, keys, score)], names=["own", "query_id", "vec_id", "row", "score"])

    hits = pairs.mapInArrow(second, "own long, query_id long, vec_id long, row long, score long")
    order = Window.partitionBy("own").orderBy(F.desc("score"), "vec_id", "row")
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
