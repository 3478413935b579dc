"""Array kernels: prefix polynomial hashes, window minima, and the repeated-key step of the substring operators."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotwise.llm.common import mix, slices

BASE = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(BASE, -1, 1 << 64)
SYMBOL = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03))
_powers: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE^i and BASE^-i modulo 2^64 for i up to n."""
    if len(_powers.get("up", ())) <= n:
        size = 1 << max(16, n.bit_length())
        with np.errstate(over="ignore"):
            for name, base in (("up", BASE), ("down", INVERSE)):
                _powers[name] = np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(size, base, dtype=np.uint64))])
    return _powers["up"][: n + 1], _powers["down"][: n + 1]


class Prefixes:
    """Prefix hashes of a byte array: the hash of any range in constant time, the same wherever its bytes stand."""

    def __init__(self, data: np.ndarray):
        self.data = data
        up, self.down = powers(len(data))
        with np.errstate(over="ignore"):
            self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(SYMBOL[data] * up[: len(data)])])

    def range(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return (self.sums[end] - self.sums[start]) * self.down[start]


def argmin(h: np.ndarray, width: int) -> np.ndarray:
    """For each window of ``width`` (at most 127) following hashes the place of the least one, the first of equals.

    Minima of blocks' heads and tails give every window in a constant number of passes;
    hashes are compared by their upper 57 bits, the lower ones carry the place.
    """
    n = len(h)
    if n < width:
        return np.zeros(0, dtype=np.int64)
    blocks = -(-n // width)
    v = np.full(blocks * width, np.iinfo(np.uint64).max, dtype=np.uint64)
    v[:n] = h & ~np.uint64(127)
    v = v.reshape(blocks, width)
    v[:] = (v & ~np.uint64(127)) | np.arange(width, dtype=np.uint64)
    head = np.minimum.accumulate(v, axis=1).ravel()
    tail = np.minimum.accumulate(v[:, ::-1], axis=1)[:, ::-1].ravel()
    start = np.arange(n - width + 1)
    a, b = tail[: n - width + 1], head[width - 1 : n]
    left = (a >> np.uint64(7)) <= (b >> np.uint64(7))
    low = np.uint64(127)
    return np.where(left, start // width * width + (a & low).astype(np.int64), (start + width - 1) // width * width + (b & low).astype(np.int64))


def runs(valid: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last of each maximal run of following places in ``valid`` on which all ``values`` stay the same."""
    if not len(valid):
        return valid, valid
    change = np.diff(valid) != 1
    for v in values:
        change |= np.diff(v[valid]) != 0
    edge = np.nonzero(change)[0]
    return valid[np.append(0, edge + 1)], valid[np.append(edge, len(valid) - 1)]


def repeated(keys: DataFrame) -> DataFrame:
    """From (key, rid): (rid, keys) with the keys of each row that occur in at least two rows of ``keys``, and how often.

    Counting combines before the shuffle; the join back is on a key whose hot values
    Spark splits. A row's list is bounded by its own text.
    """
    often = keys.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return keys.join(often, "key").groupBy("rid").agg(F.collect_set(F.struct("key", "n")).alias("keys"))


#: Counts that a task holds at a time, and the least number of texts of a frequent key.
ENTRIES, OFTEN = 1 << 19, 16


def added(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """(keys, counts) of several such pairs; of more than ENTRIES the next largest count is taken off all (Misra and Gries)."""
    names, at = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
    n = np.bincount(at, weights=np.concatenate([n for _, n in parts])).astype(np.int64)
    if len(n) > ENTRIES:
        n = n - np.partition(n, len(n) - ENTRIES - 1)[len(n) - ENTRIES - 1]
    return names[n > 0], n[n > 0]


def _counted(distinct: Callable[[list[bytes]], np.ndarray]):
    def run(batches):
        held, waiting, size = (np.zeros(0, np.uint64), np.zeros(0, np.int64)), [], 0
        for batch in batches:
            for _, raws in slices(batch, "text"):
                waiting.append(np.unique(distinct(raws), return_counts=True))
                size += len(waiting[-1][0])
                if size > ENTRIES:
                    held, waiting, size = added([held, *waiting]), [], 0
        keys, n = added([held, *waiting])
        yield pa.RecordBatch.from_arrays([pa.array(keys[n > 1].view(np.int64)), pa.array(n[n > 1])], names=["key", "n"])

    return run


def frequent_keys(text: DataFrame, distinct: Callable[[list[bytes]], np.ndarray], most: int) -> tuple[np.ndarray, np.ndarray]:
    """Up to ``most`` keys of the most texts, and of how many, OFTEN at least, counted over all texts.

    ``distinct`` gives the distinct keys of each of some texts, one after the other. A task that meets N of them counts a
    key short by N / ENTRIES at most, and leaves out those of a single text.
    """
    counts = text.select("text").mapInArrow(_counted(distinct), "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
    often = counts.where(F.col("n") >= OFTEN).orderBy(F.desc("n"), "key").limit(most).toArrow()
    return often.column("key").to_numpy().view(np.uint64), often.column("n").to_numpy()
