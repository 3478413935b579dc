"""Packing of tokenized documents: a configuration linear program over the length histogram, then rounding."""

from __future__ import annotations

import math
import os
import sys
import unicodedata
import zlib
from array import array
from collections import Counter
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain, filterfalse

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lotwise.llm.common import checkpoint, keyed, slices

CAPACITY = 4096
END = 1
#: Words whose ids a worker remembers.
MEMO = 700_000
#: Marks that part from the letters or digits before them as a token of the tokenizer's own splitting.
MARKS = b"""!"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"""
#: A configuration is used while its value is at most TOLERANCE under the best one's. Used, it covers SHARE of its scarcest
#: length, and a length's weight falls by exp(-RATE * share). PHASES knapsacks are solved in each of ROUNDS rounds of rounding.
TOLERANCE, SHARE, RATE, PHASES, ROUNDS = 0.01, 0.25, 1.0, 60, 3
#: Room that a rounded configuration may leave; the plan of the one with fewer sequences is taken.
ROOMS = (4, 32)


def _byte_letters() -> list[str]:
    """The letter that stands for each byte in a byte-level vocabulary: printable Latin-1 itself, the others from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


@lru_cache(maxsize=1)
def encoder(vocabulary: str):
    """A function from UTF-8 texts to their ids, as little-endian unsigned 32-bit numbers, each text ended by END.

    The tokenizer drops white space and never joins what it parts, so ids are those of
    the parts between white space (ASCII's), which a worker remembers over its tasks. Letters are
    lowered first, as the tokenizer does, unless a text may hold a special token's
    name. A part of letters and ASCII marks after them is known by its letters and by
    its marks; letters that need no more normalizing go to the vocabulary's merges at once.
    """
    from tokenizers import Tokenizer

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    tokenizer = Tokenizer.from_file(vocabulary)
    merges, letters = tokenizer.model, _byte_letters()
    memo: dict[bytes, bytes] = {}
    end = np.array([END], dtype="<u4").tobytes()

    def learn(new: set[bytes]) -> None:
        odd = []
        for w in new:
            text = w.decode("utf-8", "replace")
            if text.isascii():
                plain = text.isalpha() and text.islower()
            else:
                plain = text.isalpha() and text == text.lower() and unicodedata.is_normalized("NFC", text)
                text = "".join([letters[b] for b in w]) if plain else text
            if plain:
                ids = array("I", [t.id for t in merges.tokenize(text)])
                if sys.byteorder == "big":
                    ids.byteswap()
                memo[w] = ids.tobytes()
            else:
                odd.append(w)
        for w, e in zip(odd, tokenizer.encode_batch_fast([w.decode("utf-8", "replace") for w in odd], add_special_tokens=False)):
            memo[w] = np.array(e.ids, dtype="<u4").tobytes()

    def encode(raws: list[bytes]) -> list[bytes]:
        if len(memo) > MEMO:
            memo.clear()
        words, edge = [], [0]
        for raw in raws:
            words += (raw if b"<|" in raw else raw.lower()).split()
            edge.append(len(words))
        parts = list(map(memo.get, words))
        lacking = [i for i, p in enumerate(parts) if p is None]
        if lacking:
            split, whole = {}, set()
            for w in {words[i] for i in lacking}:
                core = w.rstrip(MARKS)
                if len(core) < len(w) and (core.isalnum() if core.isascii() else core.decode("utf-8", "replace").isalnum()):
                    split[w] = (core, w[len(core) :])
                else:
                    whole.add(w)
            learn(set(filterfalse(memo.__contains__, chain(whole, *split.values()))))
            for w, (core, marks) in split.items():
                memo[w] = memo[core] + memo[marks]
            for i in lacking:
                parts[i] = memo[words[i]]
        return [b"".join(parts[a:b]) + end for a, b in zip(edge, edge[1:])]

    return encode


def pieces(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY) -> DataFrame:
    """(rid, id, piece, start, length, ids_crc32): each document's ids, cut where they are more than ``capacity``."""

    def run(batches):
        encode = encoder(vocabulary)
        for batch in batches:
            out = []
            rids, ids = batch.column("rid").to_pylist(), batch.column("id").to_pylist()
            at = 0
            for _, raws in slices(batch, "text"):
                for data in encode(raws):
                    for k, s in enumerate(range(0, len(data), 4 * capacity)):
                        part = data[s : s + 4 * capacity]
                        out.append((rids[at], ids[at], k, s // 4, len(part) // 4, zlib.crc32(part)))
                    at += 1
            columns = list(zip(*out)) or [()] * 6
            types = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["rid", "id", "piece", "start", "length", "ids_crc32"])

    return docs.select("rid", "id", "text").mapInArrow(run, "rid long, id long, piece int, start long, length long, ids_crc32 long")


class Knapsack:
    """Dynamic program over all capacities: the best value of lengths (repeats allowed) that fit, and one set that has it."""

    def __init__(self, value: np.ndarray):
        """value: of each length from 0 up to the capacity; -inf for a length that can't be used. Of equal values the longest counts."""
        cap = len(value) - 1
        self.best, self.last = np.zeros(cap + 1), np.zeros(cap + 1, dtype=np.int64)
        least = int(np.argmax(value > -np.inf)) if (value > -np.inf).any() else cap + 1
        back, best = value[::-1].copy(), self.best
        for c in range(least, cap + 1):
            v = back[cap - c : cap - least + 1] + best[: c - least + 1]
            k = int(v.argmax())
            if v[k] > best[c - 1]:
                best[c], self.last[c] = v[k], c - k
            else:
                best[c] = best[c - 1]

    def fill(self, room: int) -> list[int]:
        out = []
        while room > 0:
            if not self.last[room]:
                room -= 1  # the same value with less room
                continue
            out.append(int(self.last[room]))
            room -= out[-1]
        return out


def fractional(demand: np.ndarray) -> tuple[list[tuple[Counter, float]], np.ndarray, float]:
    """The covering program (fewest configurations that hold each length l ``demand[l]`` times) by multiplicative weights.

    Returns configurations with how often each is used, how often each length is held,
    and a lower bound of the program. The weight of a length starts as its volume and is multiplied by
    exp(-RATE * a * step / demand) whenever a configuration that holds it ``a`` times is used
    for a step. A knapsack prices the configurations; as weights only fall, its
    value stays an upper bound, so those within TOLERANCE of it are still near the best and are
    used, one for each length, before the next knapsack is solved. Weights scaled by the
    knapsack's value are a solution of the dual, which bounds the program.
    """
    cap = len(demand) - 1
    lengths = np.nonzero(demand)[0]
    weight = np.full(cap + 1, -np.inf)
    weight[lengths] = lengths
    covered, found, bound = np.zeros(cap + 1), {}, 0.0
    for _ in range(PHASES):
        sack = Knapsack(weight)
        top = sack.best[cap]
        bound = max(bound, float(demand[lengths] @ weight[lengths]) / top)
        if (covered[lengths] >= demand[lengths]).all():
            break
        level = (1 - TOLERANCE) * top
        for length in lengths[weight[lengths] + sack.best[cap - lengths] >= level][::-1].tolist():
            if weight[length] + sack.best[cap - length] < level:
                continue
            config = Counter([length, *sack.fill(cap - length)])
            if sum(weight[k] * a for k, a in config.items()) < level:
                continue
            step = min(SHARE * demand[k] / a for k, a in config.items())
            for k, a in config.items():
                covered[k] += a * step
                weight[k] *= math.exp(-RATE * a * step / demand[k])
            key = tuple(sorted(config.items()))
            found[key] = found.get(key, 0.0) + step
    return [(Counter(dict(k)), x) for k, x in found.items()], covered, bound


def _best_fit(rest: dict[int, int], capacity: int) -> list[tuple[Counter, int]]:
    """Best-fit decreasing on the histogram: equal bins move together, so the work doesn't grow with the counts."""
    rooms: dict[int, dict[tuple, int]] = {}
    open_ = np.zeros(capacity + 1, dtype=bool)

    def put(room: int, config: tuple, n: int) -> None:
        own = rooms.setdefault(room, {})
        own[config] = own.get(config, 0) + n
        open_[room] = True

    for length in sorted(rest, reverse=True):
        n = rest[length]
        while n:
            fits = np.nonzero(open_[length:])[0]
            if not len(fits):
                k = capacity // length
                if n >= k:
                    put(capacity - k * length, ((length, k),), n // k)
                if n % k:
                    put(capacity - n % k * length, ((length, n % k),), 1)
                break
            room = length + int(fits[0])
            bins = rooms.pop(room)
            open_[room] = False
            for config, m in bins.items():
                take = min(n, m)
                if take:
                    held = dict(config)
                    held[length] = held.get(length, 0) + 1
                    put(room - length, tuple(sorted(held.items())), take)
                    n -= take
                if m > take:
                    put(room, config, m - take)
    return [(Counter(dict(config)), n) for own in rooms.values() for config, n in own.items()]


def _rounded(counts: dict[int, int], capacity: int, room: int) -> tuple[list[tuple[Counter, int]], float]:
    """A plan from configurations that leave at most ``room``, and the program's lower bound."""
    out: list[tuple[Counter, int]] = []
    left, bound = np.zeros(capacity + 1), 0.0
    for length, n in counts.items():
        left[length] = n
    if left[capacity]:
        out.append((Counter({capacity: 1}), int(left[capacity])))
        bound, left[capacity] = left[capacity], 0
    for turn in range(ROUNDS):
        lengths, before = np.nonzero(left)[0], left.sum()
        if not before:
            break
        configs, covered, least = fractional(left)
        bound += least if turn == 0 else 0
        # The solution is scaled so that, by volume, the lengths are held as often as they are there.
        scale = 1 / max(1e-9, float(np.average(covered[lengths] / left[lengths], weights=lengths * left[lengths])))
        configs.sort(key=lambda x: (-sum(k * a for k, a in x[0].items()), -x[1], sorted(x[0].items())))
        for whole in (math.floor, math.ceil):
            for config, x in configs:
                if capacity - sum(k * a for k, a in config.items()) > room:
                    break
                n = int(min(whole(x * scale + 1e-9), *(left[k] // a for k, a in config.items())))
                if n > 0:
                    out.append((config, n))
                    for k, a in config.items():
                        left[k] -= n * a
        if left.sum() > 0.97 * before:
            break
    return out + _best_fit({int(k): int(left[k]) for k in np.nonzero(left)[0]}, capacity), bound


def solve(counts: dict[int, int], capacity: int = CAPACITY) -> tuple[list[tuple[Counter, int]], float]:
    """Configurations (length: times) and how often each is used, and a lower bound of the number of sequences.

    Together the configurations hold each length as often as it is there. Round by round the
    program over what is left is solved, and its scaled solution rounded down, then up, as far as pieces are
    left; whole sequences need no program. What the last round leaves is packed by best fit.
    """
    plans = [_rounded(counts, capacity, room) for room in ROOMS]
    return min((p for p, _ in plans), key=lambda p: sum(n for _, n in p)), max(b for _, b in plans)


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[Counter, int]]:
    """The configurations of ``solve``."""
    return solve(counts, capacity)[0]


@dataclass(frozen=True)
class Layout:
    """Where the r-th piece of a length goes: runs of ranks, each filling one configuration's places for that length."""

    key: np.ndarray  # length * 2^42 + first rank, ascending
    sequence: np.ndarray  # first sequence of the run
    times: np.ndarray  # places for the length in each sequence
    offset: np.ndarray  # of the first place

    @staticmethod
    def of(configs: list[tuple[Counter, int]]) -> Layout:
        used, rows, sequence = Counter(), [], 0
        for config, n in configs:
            offset = 0
            for length, a in sorted(config.items(), reverse=True):
                rows.append((length << 42 | used[length], sequence, a, offset))
                used[length] += n * a
                offset += length * a
            sequence += n
        return Layout(*(np.array(c, dtype=np.int64) for c in zip(*sorted(rows)))) if rows else Layout(*[np.zeros(0, dtype=np.int64)] * 4)

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.searchsorted(self.key, (length << 42) + rank, side="right") - 1
        r = rank - (self.key[at] & ((1 << 42) - 1))
        return self.sequence[at] + r // self.times[at], self.offset[at] + length * (r % self.times[at])


def ranked(parts: DataFrame, salts: int) -> DataFrame:
    """``parts`` with ``rank``: from 0 within each length, by salt, row key and piece. A length is never in one task."""
    salted = parts.withColumn("salt", F.pmod(F.xxhash64("rid", "piece"), F.lit(salts)))
    sizes = salted.groupBy("length", "salt").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("length", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    own = Window.partitionBy("length", "salt").orderBy("rid", "piece")
    return salted.withColumn("own", F.row_number().over(own) - 1).join(starts, ["length", "salt"]).withColumn("rank", F.col("before") + F.col("own")).drop("salt", "own", "before")


def pack(df: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """(id, piece, start, length, ids_crc32, sequence_id, offset) for every piece of every row.

    The driver gets the histogram of lengths, at most ``capacity`` numbers, and sends
    back a layout of as many runs as the configurations have lengths, which doesn't
    grow with the documents. A null or empty text is one piece, the end alone; repeated rows
    and rows without an id are packed each; an empty table gives no rows; other
    columns are not read.
    """
    parts = checkpoint(pieces(keyed(df, id_col, text_col), vocabulary, capacity))
    counts = {r["length"]: r["n"] for r in parts.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    layout = Layout.of(plan(counts, capacity))

    @F.pandas_udf("sequence_id long, offset long")
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        sequence, offset = layout.place(length.to_numpy(), rank.to_numpy())
        return pd.DataFrame({"sequence_id": sequence, "offset": offset})

    salts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = ranked(parts, salts).withColumn("p", place("length", "rank"))
    return placed.select("id", "piece", "start", "length", "ids_crc32", "p.sequence_id", "p.offset")
