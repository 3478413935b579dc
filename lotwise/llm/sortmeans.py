"""Sort-means: k-means whose scans follow the other centroids by distance and stop by the triangle inequality."""

from __future__ import annotations

from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotwise.llm.common import checkpoint, discard, stash
from lotwise.llm.topk import _matrix

DIM, SCALE, CENTROIDS, ROUNDS, SEED = 64, 256, 40, 5, "2"
#: Greatest magnitude of a component: squared distances of 64 of them fit a long.
GREATEST = 1 << 27


def kept(df: DataFrame, id_col: str, vector_col: str, dim: int, scale: int) -> DataFrame:
    """(vec_id, v): floor(scale * x) of the components of the vectors that have ``dim`` of them, none null or non-finite."""
    x = F.col(vector_col)
    bad = F.exists(x, lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == float("inf")))
    rows = df.where(F.size(x) == dim).where(~bad).select(F.col(id_col).cast("long").alias("vec_id"), F.transform(x, lambda e: F.floor(F.lit(scale) * e.cast("double"))).alias("v"))
    small = F.forall("v", lambda e: F.abs(e) <= GREATEST)
    return rows.withColumn("v", F.when(small, F.col("v")).otherwise(F.raise_error(f"a component times {scale} is over {GREATEST}: its distances don't fit a long").cast("array<long>")))


def start(vectors: DataFrame, k: int, seed: str) -> np.ndarray:
    """The ``k`` vectors with the smallest SHA-256 of "seed:id"; equal ids by their components, null ids last."""
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    first = vectors.select(order.alias("h"), "v").orderBy(F.asc_nulls_last("h"), "v").limit(k).collect()  # k rows
    return np.array([r["v"] for r in first], dtype=np.int64)


def nearest(x: np.ndarray, before: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """For each row of x the nearest centroid (ties: the smaller number), its squared distance, and the distances computed.

    A row scans the centroids in the order of their distance from that of ``before``, and stops
    strictly beyond twice its own distance from it: what lies there is farther from the row than that.
    Rows with the same centroid before go together; those that scan longest come first, so
    each step of the scan takes a leading part of them.
    """
    gaps = ((centroids[:, None, :] - centroids[None, :, :]) ** 2).sum(axis=2)
    best, found, made = np.empty(len(x), dtype=np.int64), np.empty(len(x), dtype=np.int64), len(x)
    order = np.argsort(before, kind="stable")
    edges = np.searchsorted(before[order], np.arange(len(centroids) + 1))
    for c in range(len(centroids)):
        rows = order[edges[c] : edges[c + 1]]
        if not len(rows):
            continue
        own = ((x[rows] - centroids[c]) ** 2).sum(axis=1)
        others = np.argsort(gaps[c], kind="stable")
        others = others[others != c]
        scans = np.searchsorted(gaps[c][others], 4 * own, side="right")  # gap <= 2 * distance, both squared
        turn = np.argsort(-scans, kind="stable")
        rows, own, scans = rows[turn], own[turn], scans[turn]
        low, at = own.copy(), np.full(len(rows), c, dtype=np.int64)
        for j in range(int(scans[0])):
            n = int(np.searchsorted(-scans, -j))  # rows that scan more than j centroids
            d = ((x[rows[:n]] - centroids[others[j]]) ** 2).sum(axis=1)
            made += n
            nearer = (d < low[:n]) | ((d == low[:n]) & (others[j] < at[:n]))
            low[:n][nearer], at[:n][nearer] = d[nearer], others[j]
        best[rows], found[rows] = at, low
    return best, found, made


def assigned(state: DataFrame, centroids: np.ndarray) -> DataFrame:
    """``state`` (vec_id, v, cluster) with the cluster of each vector among ``centroids``, and its squared distance."""
    dim = centroids.shape[1]

    def run(batches):
        for batch in batches:
            x = _matrix(batch.column("v"), dim, np.int64)
            best, found, _ = nearest(x, batch.column("cluster").to_numpy(zero_copy_only=False).astype(np.int64), centroids)
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("v"), pa.array(best, pa.int32()), pa.array(found)], names=["vec_id", "v", "cluster", "distance"])

    return state.select("vec_id", "v", "cluster").mapInArrow(run, "vec_id long, v array<int>, cluster int, distance long")


def means(state: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Componentwise floors of the clusters' exact means; a cluster without vectors keeps its centroid.

    Each task adds up its vectors to one row a cluster, so the shuffle holds k rows a task.
    """
    k, dim = centroids.shape

    def run(batches):
        total, count = np.zeros((k, dim), dtype=np.int64), np.zeros(k, dtype=np.int64)
        for batch in batches:
            cluster = batch.column("cluster").to_numpy(zero_copy_only=False)
            order = np.argsort(cluster, kind="stable")
            numbers, first = np.unique(cluster[order], return_index=True)
            if len(numbers):
                total[numbers] += np.add.reduceat(_matrix(batch.column("v"), dim, np.int64)[order], first, axis=0)
            count += np.bincount(cluster, minlength=k)
        there = np.nonzero(count)[0]
        yield pa.RecordBatch.from_arrays([pa.array(there, pa.int32()), pa.array(count[there]), pa.array(list(total[there]), pa.list_(pa.int64()))], names=["cluster", "n", "total"])

    parts = state.select("cluster", "v").mapInArrow(run, "cluster int, n long, total array<long>")
    sums = parts.groupBy("cluster").agg(F.sum("n").alias("n"), F.array(*(F.sum(F.col("total")[i].cast("decimal(38,0)")) for i in range(dim))).alias("total"))
    new = centroids.copy()
    for r in sums.collect():  # at most k rows
        new[r["cluster"]] = [int(t) // r["n"] for t in r["total"]]
    return new


def cluster(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", dim: int = DIM, scale: int = SCALE, k: int = CENTROIDS, rounds: int = ROUNDS, seed: str = SEED) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of every kept vector.

    Vectors that are null, of another length, or with a null or non-finite component take no part.
    Repeated rows, repeated ids and null ids are vectors of their own (a null id starts no cluster
    before all others have). With fewer than ``k`` vectors each starts one; equal ones share
    the smaller number. An empty table gives no rows. A finite component over 2^27 after scaling raises: its
    squared distance has no long. Other columns are not read.

    Vectors and their cluster go from round to round in a table of the shared folder, the one
    before is deleted; the driver holds the k centroids and k sums.
    """
    vectors = kept(df, id_col, vector_col, dim, scale)
    centroids = start(vectors, k, seed)
    if not len(centroids):
        return vectors.select("vec_id", F.lit(0).alias("cluster"), *(F.lit(0).cast("long").alias(c) for c in ("distance", "cluster_inertia", "inertia")), F.lit("").alias("centroid_sha256"))
    state = stash(vectors.select("vec_id", F.col("v").cast("array<int>").alias("v"), F.lit(0).alias("cluster")))
    for _ in range(rounds):
        after = stash(assigned(state, centroids))
        discard(state)
        state, centroids = after, means(after, centroids)
    last = checkpoint(assigned(state, centroids).drop("v"))
    discard(state)
    sums = {r["cluster"]: r["inertia"] for r in last.groupBy("cluster").agg(F.sum("distance").alias("inertia")).collect()}  # at most k rows
    facts = [(i, sums.get(i, 0), sum(sums.values()), sha256(",".join(map(str, c.tolist())).encode()).hexdigest()) for i, c in enumerate(centroids)]
    facts = df.sparkSession.createDataFrame(facts, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return last.join(F.broadcast(facts), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
