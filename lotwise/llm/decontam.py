"""Benchmark decontamination with DataFrame functions alone: SimHash windows, multi-index blocks, exact check."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotwise.llm.common import KEY, checkpoint, keyed, small, with_key

SIZE = 5
SIMILARITY = 0.8
#: Fingerprints of windows and items are compared up to this many differing bits.
RADIUS = 23
#: Blocks of the fingerprint; of RADIUS differing bits some block has at most RADIUS // BLOCKS.
BLOCKS, WIDTH = 8, 8
LANES = sum(1 << (16 * i) for i in range(4))


def words(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), "[\\x20\\x09-\\x0D]+"), "")


def grams(w: Column, size: int) -> Column:
    """Hashes of all runs of ``size`` words; none if there are fewer."""
    each = F.transform(F.sequence(F.lit(0), F.size(w) - size), lambda i: F.xxhash64(*(F.get(w, i + k) for k in range(size))))
    return F.when(F.size(w) >= size, each).otherwise(F.array().cast("array<long>"))


def fingerprint(hashes: Column) -> Column:
    """A bit is one if more than half of the hashes have it; sixteen sums of four 16-bit counters each."""
    lanes = lambda h: F.array(*(F.shiftrightunsigned(h, b).bitwiseAND(F.lit(LANES)) for b in range(16)))
    zero = F.array(*([F.lit(0).cast("long")] * 16))

    def bits(sums: Column) -> Column:
        def set_(acc: Column, i: Column) -> Column:
            count = F.call_function("shiftrightunsigned", F.get(sums, F.pmod(i, F.lit(16))), F.floor(i / 16).cast("int") * 16).bitwiseAND(F.lit(0xFFFF))
            return F.when(count * 2 > F.size(hashes), acc.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), i))).otherwise(acc)

        return F.aggregate(F.sequence(F.lit(0), F.lit(63)), F.lit(0).cast("long"), set_)

    return F.aggregate(hashes, zero, lambda acc, h: F.zip_with(acc, lanes(h), lambda a, b: a + b), bits)


def block(fp: Column, at: int) -> Column:
    return F.shiftrightunsigned(fp, at * WIDTH).bitwiseAND(F.lit((1 << WIDTH) - 1)).cast("int")


def shared(window: Column, item: Column) -> Column:
    """Sum over distinct hashes of the smaller of both counts."""
    count = lambda x, h: F.size(F.filter(x, lambda y: y == h))
    return F.aggregate(F.array_distinct(F.array_intersect(window, item)), F.lit(0), lambda a, h: a + F.least(count(window, h), count(item, h)))


def _items(benchmark: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(key, item_id, n, size, h): the items with words; ``size`` words in a shingle, all of them where there are fewer than SIZE."""
    rows = benchmark.select(F.col(id_col).cast("long").alias("item_id"), words(F.coalesce(F.col(text_col), F.lit(""))).alias("w"))
    rows = rows.where(F.size("w") > 0).orderBy("item_id", "w").withColumn("key", F.monotonically_increasing_id()).withColumn("n", F.size("w"))
    h = F.when(F.col("n") >= SIZE, grams(F.col("w"), SIZE))
    for size in range(1, SIZE):
        h = h.when(F.col("n") == size, grams(F.col("w"), size))
    return checkpoint(rows.withColumn("h", h).select("key", "item_id", "n", F.least("n", F.lit(SIZE)).alias("size"), "h"))


def _hits(docs: DataFrame, items: DataFrame, size: int) -> DataFrame:
    """(rid, key, at): a shingle of the document at which the item's shingles of that size put the item's first word."""
    mine = items.where(F.col("size") == size).select("key", F.posexplode("h").alias("i", "h"))
    own = docs.select("rid", words(F.col("text")).alias("w")).select("rid", F.posexplode(grams(F.col("w"), size)).alias("p", "h"))
    return own.join(small(mine), "h").select("rid", "key", (F.col("p") - F.col("i")).alias("at")).distinct()


def leaks(df: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """(rid, id, item_id, start, similarity): documents with a window like an item, and the best window of each pair.

    A window has as many words as the item (the whole text if that is shorter).
    Windows start where a five-word shingle that the document shares with an item puts
    that item's first word; one without a shared shingle has similarity zero. Window
    fingerprints are looked up by blocks: an item is entered under every block value within
    RADIUS // BLOCKS bits, so every pair within RADIUS meets in some block. Pairs within the
    radius are kept if the weighted Jaccard similarity of their shingles (weight: how often
    one occurs) is at least ``similarity``. Items of fewer than five words are one shingle.

    Null and empty texts and items leak nothing; repeated rows, and items with the same
    id, are compared each; empty tables give no rows; other columns are not read.
    """
    docs = keyed(df, id_col, text_col)
    items = _items(benchmark, item_id, item_text)
    sizes = [r["size"] for r in items.select("size").distinct().collect()]  # at most SIZE values
    hits = None
    for size in sorted(sizes) or [SIZE]:
        part = _hits(docs, items, size)
        hits = part if hits is None else hits.unionByName(part)
    sized = items.select("key", "n", "size")
    hits = checkpoint(hits.join(small(sized), "key").select("rid", "at", "n", "size").distinct())
    at = hits.groupBy("rid").agg(F.collect_list(F.struct("at", "n", "size")).alias("windows"))
    rows = docs.join(small(at), "rid").withColumn("w", words(F.col("text"))).select("rid", "id", "windows", F.size("w").alias("len"), *(grams(F.col("w"), s).alias(f"h{s}") for s in sorted(sizes) or [SIZE]))

    def window(x: Column) -> Column:
        start = F.greatest(F.lit(0), F.least(x["at"], F.col("len") - x["n"]))
        h = None
        for s in sorted(sizes) or [SIZE]:
            own = F.slice(F.col(f"h{s}"), start + 1, x["n"] - s + 1)
            h = F.when(x["size"] == s, own) if h is None else h.when(x["size"] == s, own)
        return F.struct(start.alias("start"), x["n"].alias("n"), x["size"].alias("size"), h.alias("h"))

    found = rows.select("rid", "id", F.explode(F.array_distinct(F.transform("windows", window))).alias("x")).select("rid", "id", "x.*")
    found = found.where(F.size("h") > 0).withColumn("fp", fingerprint(F.col("h")))
    flips = [sum(1 << b for b in c) for k in range(RADIUS // BLOCKS + 1) for c in combinations(range(WIDTH), k)]
    table = items.withColumn("item_fp", fingerprint(F.col("h")))
    near = F.array(*(F.lit(x) for x in flips))
    table = table.select("key", "item_id", F.col("n").alias("item_n"), F.col("h").alias("item_h"), "item_fp")
    cells = lambda fp: F.explode(F.array(*(F.struct(F.lit(b).alias("b"), block(F.col(fp), b).alias("v")) for b in range(BLOCKS))))
    index = table.select("key", "item_n", near.alias("near"), cells("item_fp").alias("e"))
    index = index.select("key", F.col("item_n").alias("n"), "e.b", F.col("e.v").alias("own"), F.explode("near").alias("flip")).select("key", "n", "b", F.col("own").bitwiseXOR(F.col("flip")).alias("v"))
    looked = found.select("rid", "id", "start", "n", "h", "fp", cells("fp").alias("e")).select("rid", "id", "start", "n", "h", "fp", "e.*")
    met = looked.join(small(checkpoint(index)), ["n", "b", "v"]).select("rid", "id", "start", "h", "fp", "key")
    pairs = met.groupBy("rid", "start", "key").agg(F.first("id").alias("id"), F.first("h").alias("h"), F.first("fp").alias("fp"))
    full = pairs.join(small(table), "key").where(F.bit_count(F.col("fp").bitwiseXOR(F.col("item_fp"))) <= RADIUS)
    both = full.withColumn("both", shared(F.col("h"), F.col("item_h")))
    scored = both.withColumn("similarity", F.col("both") / (F.size("h") + F.size("item_h") - F.col("both"))).where(F.col("similarity") >= similarity)
    best = scored.groupBy("rid", "key").agg(F.first("id").alias("id"), F.first("item_id").alias("item_id"), F.max(F.struct("similarity", (-F.col("start")).alias("back"))).alias("x"))
    return best.select("rid", "id", "item_id", (-F.col("x.back")).alias("start"), "x.similarity")


def clean(df: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``df`` without a leak, with all their columns."""
    rows = with_key(df, id_col, text_col)
    bad = checkpoint(leaks(rows, benchmark, id_col, text_col).select(F.col("rid").alias(KEY)).distinct())
    return rows.join(small(bad), KEY, "left_anti").select(*df.columns)
