"""SimHash fingerprints and near-duplicate links by covering locality-sensitive hashing."""

from __future__ import annotations

import math
import random
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotwise.llm.common import checkpoint, components, keyed, mix, raw_bytes, slices, small, split_copies, stash, words_of
from lotwise.llm.passages import word_hashes
from lotwise.llm.windows import frequent_keys

#: Members of a bucket that one task compares; larger buckets are split by further masks.
BUCKET = 4096
SEED = 42
#: The order of near_dedup's shingles: up to COMMON shingles that occur in many texts come last.
COMMON = 200_000
#: Members of a key whose pairs are checked at once, and turns in which larger keys are checked against one member.
FEW, STARS = 16, 4


def shingles(words: list[bytes], size: int) -> list[bytes]:
    """All runs of ``size`` words, repeats included; a shorter text is one run; no words, none."""
    if len(words) <= size:
        return [b" ".join(words)] if words else []
    return [b" ".join(x) for x in zip(*(words[i:] for i in range(size)))]


def hashes(grams: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, grams, repeat(SEED)), dtype=np.uint64, count=len(grams))


def fold(h: np.ndarray) -> int:
    """The fingerprint: a bit is one if it is set in over half the hashes."""
    if not len(h):
        return 0
    ones = np.zeros(64, dtype=np.int64)
    for a in range(0, len(h), 1 << 14):
        part = h[a : a + (1 << 14)]
        ones += np.unpackbits(part.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits((2 * ones > len(h)).astype(np.uint8), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, size: int) -> DataFrame:
    """(rid, id, fp): the fingerprint of each text of (rid, id, text)."""

    def run(batches):
        for batch in batches:
            fps = []
            for _, raws in slices(batch, "text"):
                for raw in raws:
                    fps.append(fold(hashes(shingles(words_of(raw), size))))
            yield pa.RecordBatch.from_arrays([batch.column("rid"), batch.column("id"), pa.array(np.array(fps, dtype=np.uint64).view(np.int64))], names=["rid", "id", "fp"])

    return docs.select("rid", "id", "text").mapInArrow(run, "rid long, id long, fp long")


def masks(radius: int, level: int = 0) -> list[int]:
    """The 2^(radius+1) - 1 masks of a covering family over 64 bits.

    Every bit gets a nonzero vector of radius+1 bits; mask v keeps the bits whose
    vector has an odd product with v. The vectors of any ``radius`` bits leave some
    v orthogonal to all of them, so that mask keeps none of those bits: a pair that
    differs in at most ``radius`` bits agrees under it.
    """
    top = 1 << (radius + 1)
    rng = random.Random(1000 * radius + level)
    vectors: list[int] = []
    while len(vectors) < 64:
        deck = list(range(1, top))
        rng.shuffle(deck)
        vectors += deck
    vectors = vectors[:64]
    return [sum(1 << i for i, m in enumerate(vectors) if bin(m & v).count("1") % 2) for v in range(1, top)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _links(radius: int):
    """For each bucket (a list of fingerprints): real links that span each of its linked groups."""

    def run(batches):
        for batch in batches:
            a, b = [], []
            lists = batch.column("members")
            flat, ends = lists.flatten().to_numpy(zero_copy_only=False).view(np.uint64), np.cumsum([0, *pc.list_value_length(lists).to_pylist()])
            for s, t in zip(ends, ends[1:]):
                x = np.unique(flat[s:t])
                for left, right in spanning(x, radius):
                    a.append(left)
                    b.append(right)
            yield pa.RecordBatch.from_arrays([pa.array(np.array(a, dtype=np.uint64).view(np.int64)), pa.array(np.array(b, dtype=np.uint64).view(np.int64))], names=["a", "b"])

    return run


def spanning(x: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Pairs within the radius, to the nearest and to the first earlier member, and what else joins groups."""
    n, out = len(x), []
    top = list(range(n))

    def find(i):
        while top[i] != i:
            top[i] = top[top[i]]
            i = top[i]
        return i

    for i in range(1, n):
        d = np.bitwise_count(x[:i] ^ x[i])
        near = np.nonzero(d <= radius)[0]
        if not len(near):
            continue
        chosen = {int(near[0]), int(near[np.argmin(d[near])])}
        for j in chosen:
            top[max(find(i), find(j))] = min(find(i), find(j))
        for j in near.tolist():
            if find(i) != find(j):
                chosen.add(j)
                top[max(find(i), find(j))] = min(find(i), find(j))
        out += [(int(x[j]), int(x[i])) for j in sorted(chosen)]
    return out


def links(fps: DataFrame, radius: int) -> DataFrame:
    """Links (a, b) between distinct fingerprints (column fp) that give the components of all pairs within the radius.

    Buckets of one mask hold fingerprints that agree under it. A bucket of up to
    BUCKET members is compared in one task and gives a spanning set of its links;
    a larger one is keyed again by another covering family, level by level, which
    keeps the guarantee and needs no cap.
    """
    found = None
    keys = fps.select("fp", F.lit(0).cast("long").alias("k"))
    for level in range(64):
        cover = [F.xxhash64("k", F.lit(level), F.lit(t), F.col("fp").bitwiseAND(F.lit(_signed(m)))) for t, m in enumerate(masks(radius, level))]
        keys = keys.select("fp", F.explode(F.array(*cover)).alias("k"))
        sizes = keys.groupBy("k").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        shared = keys.join(sizes, "k")
        small = shared.where(F.col("n") <= BUCKET).groupBy("k").agg(F.collect_list("fp").alias("members"))
        part = small.select("members").mapInArrow(_links(radius), "a long, b long").distinct()
        found = part if found is None else found.unionByName(part)
        keys = shared.where(F.col("n") > BUCKET).select("fp", "k")
        if sizes.where(F.col("n") > BUCKET).isEmpty():
            return found.distinct()
        keys = checkpoint(keys)
    raise RuntimeError("buckets of distinct fingerprints did not split")


def near_components(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 3, radius: int = 2) -> DataFrame:
    """(id, fingerprint, component_id): fingerprints linked at ``radius`` or fewer differing bits.

    Null and empty texts have fingerprint zero and are linked like any other;
    fewer words than ``size`` are one shingle; repeated rows stay as rows of the same
    component. A row without an id takes its component from the ids it is linked
    to (null if there are none). An empty table gives an empty result. Columns
    besides the id and the text are not read.
    """
    fps = checkpoint(fingerprints(keyed(df, id_col, text_col), size).select("id", "fp"))
    groups = fps.groupBy("fp").agg(F.min("id").alias("least"))
    reach = components(links(groups.select("fp"), radius)).select(F.col("id").alias("fp"), F.col("component").alias("root"))
    rooted = groups.join(reach, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    of = rooted.join(least, "root").select("fp", "component_id")
    return fps.join(of, "fp").select("id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def _jaccard(size: int, least: float):
    """Keeps the pairs of texts whose sets of shingles have that Jaccard similarity."""

    def run(batches):
        last, kept = None, None
        for batch in batches:
            good = []
            for x, y in zip(raw_bytes(batch.column("text_a")), raw_bytes(batch.column("text_b"))):
                if x != last:
                    last, kept = x, set(shingles(words_of(x), size))
                other = set(shingles(words_of(y), size))
                both = len(kept & other)
                good.append(both >= least * (len(kept) + len(other) - both))
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    return run


def shingle_set(raw: bytes, size: int) -> np.ndarray:
    """The hashes of the distinct shingles of a text, sorted; a shorter text is one shingle."""
    words = word_hashes(raw)
    if not len(words):
        return np.zeros(0, dtype=np.uint64)
    size = min(size, len(words))
    h = np.zeros(len(words) - size + 1, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for i in range(size):
            h = h * np.uint64(0x100000001B3 * 2 + 1) + words[i : i + len(h)]
    return np.unique(mix(h))


def _prefixes(size: int, least: float, common: np.ndarray, counts: np.ndarray):
    """The first shingles of each text in one order of all shingles, the common ones last: two sets of that
    similarity share one of their first n - ceil(least * n) + 1."""

    def first(h: np.ndarray) -> np.ndarray:
        often = np.zeros(len(h), dtype=np.int64)
        if len(common):
            at = np.minimum(np.searchsorted(common, h), len(common) - 1)
            often = np.where(common[at] == h, counts[at], 0)
        return h[np.lexsort((h, often))[: len(h) - math.ceil(least * len(h) - 1e-9) + 1]]

    def run(batches):
        for batch in batches:
            for part, raws in slices(batch, "text"):
                sets = [shingle_set(raw, size) for raw in raws]
                # Texts without words share a key of their own.
                firsts = [first(h) if len(h) else np.zeros(1, dtype=np.uint64) for h in sets]
                many = np.array([len(f) for f in firsts])
                place = np.concatenate([np.arange(n) for n in many]) if len(many) else many
                columns = (np.concatenate(firsts).view(np.int64), np.repeat(part.column("rid").to_numpy(), many), np.repeat([len(h) for h in sets], many), place)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.int32(), pa.int32()))], names=["key", "rid", "n", "place"])

    return run


def candidates(docs: DataFrame, size: int, least: float) -> DataFrame:
    """(key, rid, n, place): shared shingles among the first ones of texts; all pairs of texts whose sets of
    shingles have the similarity share a key. n: shingles of the text.

    Any order of the shingles gives all pairs. Those that occur in many texts, counted over all of them, come last,
    so that a common line is no key of the texts that hold it.
    """
    common, counts = frequent_keys(docs, lambda raws: np.concatenate([shingle_set(raw, size) for raw in raws]), COMMON)
    order = np.argsort(common)
    keys = stash(docs.select("rid", "text").mapInArrow(_prefixes(size, least, common[order], counts[order]), "key long, rid long, n int, place int"))
    shared = keys.groupBy("key").agg(F.count(F.lit(1)).alias("members")).where("members > 1").select("key")
    return stash(keys.join(shared, "key"))


def _near(a: str, b: str, least: float):
    """Sizes and places that let two texts have the similarity if this is the first shingle they share."""
    n, m = F.col(f"{a}.n"), F.col(f"{b}.n")
    rest = F.least(n - F.col(f"{a}.place"), m - F.col(f"{b}.place"))
    return (rest * (1 + least) >= least * (n + m) - 1e-6) | ((n == 0) & (m == 0))


def linked(docs: DataFrame, radius: int) -> DataFrame:
    """(a, b), a below b: pairs of rows whose fingerprints link at ``radius`` or fewer differing bits.

    Of each fingerprint the first row stands for it in links with others, and is linked to its other rows.
    """
    fps = stash(fingerprints(docs, 3).select("rid", "fp"))
    heads = stash(fps.groupBy("fp").agg(F.min("rid").alias("head")))
    same = fps.join(heads, "fp").where("rid > head").select(F.col("head").alias("a"), F.col("rid").alias("b"))
    far = links(heads.select("fp"), radius).join(heads.select(F.col("fp").alias("a"), F.col("head").alias("x")), "a").join(heads.select(F.col("fp").alias("b"), F.col("head").alias("y")), "b")
    return same.unionByName(far.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))).distinct()


def _checked(pairs: DataFrame, text: DataFrame, size: int, least: float) -> DataFrame:
    """The pairs (a, b) of rows whose texts have the similarity."""
    full = pairs.join(text.select(F.col("rid").alias("b"), F.col("text").alias("text_b")), "b").join(text.select(F.col("rid").alias("a"), F.col("text").alias("text_a")), "a")
    return checkpoint(full.select("a", "b", "text_a", "text_b").mapInArrow(_jaccard(size, least), "a long, b long"))


def verified_groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5, least: float = 0.8, radius: int = 2) -> DataFrame:
    """(rid, id, component): documents in groups of near copies, each link checked on its texts.

    Two texts are near if their sets of ``size``-word shingles have a Jaccard similarity of
    at least ``least``; the groups are the components of all near pairs. Equal texts
    are one node; texts without words are near each other.

    SimHash comes first: fingerprints within ``radius`` bits are linked, and each link is checked on two texts (``linked``). What it
    doesn't join is found by shared shingles: all near pairs share a key of ``candidates``. The members of a key are checked against
    the first of them; then the pairs of members that no verified link has joined are checked, in
    keys of over FEW members one further member against the others at a time, for STARS turns.
    A pair is left out only if it is in one component already.
    """
    docs, copies = split_copies(keyed(df, id_col, text_col), 0)
    same = copies.select(F.col("first").alias("a"), F.col("rid").alias("b"))
    rows = candidates(docs, size, least)
    ids = checkpoint(rows.select("rid").distinct())
    text = stash(docs.select("rid", "text").join(small(ids), "rid", "left_semi"))
    tried = stash(linked(docs, radius))
    found = same.unionByName(_checked(tried, docs, size, least))
    for turn in range(STARS + 1):
        if turn:
            root = components(found).withColumnRenamed("id", "rid")
            rooted = rows.drop("root").join(root, "rid", "left").withColumn("root", F.coalesce("component", "rid")).drop("component")
            open_keys = rooted.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.count(F.lit(1)).alias("members")).where("lo < hi").select("key", "members")
            rows = stash(rooted.drop("members").join(open_keys, "key"))
        else:
            rows = rows.withColumn("root", F.col("rid")).withColumn("members", F.lit(None).cast("long"))
        every = F.col("members") <= FEW if turn < STARS else F.lit(turn > 0)
        stars = rows.where(~F.coalesce(every, F.lit(False)))
        heads = stars.groupBy("key").agg(F.min(F.struct("rid", "n", "place", "root")).alias("x"))
        pairs = stars.select("key", F.struct("rid", "n", "place", "root").alias("y")).join(heads, "key").where("x.rid < y.rid")
        if turn:
            whole = rows.where(every).select("key", F.struct("rid", "n", "place", "root").alias("x"))
            pairs = pairs.unionByName(whole.join(whole.withColumnRenamed("x", "y"), "key").where("x.rid < y.rid").select("key", "y", "x"))
        pairs = pairs.where(F.col("x.root") != F.col("y.root")).where(_near("x", "y", least)).select(F.col("x.rid").alias("a"), F.col("y.rid").alias("b")).distinct()
        pairs = stash(pairs.join(tried, ["a", "b"], "left_anti"))
        tried = tried.unionByName(pairs)
        found = found.unionByName(_checked(pairs, text, size, least))
        rest = rows.join(heads.select("key", F.col("x.rid").alias("rid")), ["key", "rid"], "left_anti")
        rows = stash(rest.where(~every) if turn else rest)
        if rows.isEmpty():
            break
    return components(found).withColumnRenamed("id", "rid")
