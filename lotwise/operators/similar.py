"""Similarity join of short labels by token-set ratio: only labels meet that can reach the least ratio."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotwise.functions.text import token_set_ratio
from lotwise.session import settled

GRAM = 2


def _sorted_words(c: Column) -> Column:
    return F.array_sort(F.array_distinct(F.array_remove(F.split(c, r"\s+"), "")))


def _grams(words: Column) -> Column:
    """Letter pairs of the words, each word behind a space, numbered among equal ones; their order in the text doesn't matter."""
    pairs = F.flatten(F.transform(words, lambda w: F.transform(F.sequence(F.lit(1), F.length(w)), lambda i: F.substring(F.concat(F.lit(" "), w), i, F.lit(GRAM)))))
    return F.transform(pairs, lambda g, i: F.concat(g, F.lit("#"), F.size(F.filter(F.slice(pairs, F.lit(1), i), lambda h: h == g)).cast("string")))


def _spread(shortfall: float, length: Column) -> Column:
    """Most letters to take out of a text of this length and any partner that still reaches the ratio.

    With u letters out of x + y the ratio is 1 - u / (x + y), and y is at most x (1 + s) / (1 - s) for a shortfall s.
    """
    return F.floor(length * (2 * shortfall / (1 - shortfall)) + 1e-9).cast("int")


def _signed(labels: DataFrame, counts_words: DataFrame, counts_grams: DataFrame, shortfall: float) -> DataFrame:
    """(block, label, ws, joined, rare, grams): a label's words, and the parts that every partner shares one of.

    Words, rarest first, until those left hold too few letters to reach the ratio alone; letter pairs,
    rarest first, one more than the letters to take out can destroy.
    """
    rows = labels.withColumn("ws", _sorted_words(F.col("label"))).where(F.size("ws") > 0).withColumn("joined", F.array_join("ws", " "))
    words = rows.select("block", "label", "joined", F.explode("ws").alias("word")).join(counts_words, ["block", "word"], "left")
    words = words.groupBy("block", "label").agg(F.array_sort(F.collect_list(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "word"))).alias("w"))
    least = F.col("spread") + 1
    # The partner lacks at most ``spread`` letters (a word lacks its space, too): a word beyond them is shared.
    taken = F.transform("w", lambda x, i: F.aggregate(F.slice("w", F.lit(1), i), F.lit(0), lambda a, y: a + F.length(y["word"]) + 1) < least)
    grams = rows.select("block", "label", F.explode(_grams(F.col("ws"))).alias("gram")).join(counts_grams, ["block", "gram"], "left")
    grams = grams.groupBy("block", "label").agg(F.array_sort(F.collect_list(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "gram"))).alias("g"))
    rows = rows.withColumn("spread", _spread(shortfall, F.length("joined"))).join(words, ["block", "label"]).join(grams, ["block", "label"])
    return rows.select(
        "block", "label", "ws", "joined", F.length("joined").alias("size"), F.transform(F.filter(F.zip_with("w", taken, lambda x, t: F.struct(x["word"].alias("word"), t.alias("t"))), lambda z: z["t"]), lambda z: z["word"]).alias("rare"),
        F.transform(F.slice("g", F.lit(1), GRAM * F.col("spread") + 1), lambda z: z["gram"]).alias("grams"),
    )


def similar(left: DataFrame, right: DataFrame, least: float = 90.0) -> DataFrame:
    """(block, label, other, score) of all labels of either side with the same block and a token-set ratio of at least ``least``.

    Both sides: block, label; repeats count once, nulls and labels without a word take no part. The ratio is the best of
    three: the words of both sides against all words of either side, and all words of the sides against each other.
    For the first two one of the rarest words of a side is a word of the other. For the third the lengths are close, and
    u letters to take out destroy at most 2u letter pairs: one of the 2u + 1 rarest of either side is
    shared. So no block makes all pairs, and no pair is lost. Under a ratio of 89 letter pairs promise
    nothing for labels of short words, so a lower one is refused.
    """
    if not 89 <= least <= 100:
        raise ValueError("the least ratio must be 89 or more")
    shortfall = 1 - least / 100
    clean = lambda df: df.select("block", "label").where("block is not null and label is not null").distinct()
    others = clean(right)
    words = others.select("block", F.explode(_sorted_words(F.col("label"))).alias("word")).groupBy("block", "word").agg(F.count(F.lit(1)).alias("n"))
    grams = others.select("block", F.explode(_grams(_sorted_words(F.col("label")))).alias("gram")).groupBy("block", "gram").agg(F.count(F.lit(1)).alias("n"))
    a = settled(_signed(clean(left), words, grams, shortfall))
    b = settled(_signed(others, words, grams, shortfall)).withColumnsRenamed({"label": "other", "ws": "ws2", "rare": "rare2", "joined": "joined2", "grams": "grams2", "size": "size2"})
    one = a.select("block", "label", F.explode("rare").alias("word")).join(b.select("block", "other", F.explode("ws2").alias("word")), ["block", "word"]).select("block", "label", "other")
    two = a.select("block", "label", F.explode("ws").alias("word")).join(b.select("block", "other", F.explode("rare2").alias("word")), ["block", "word"]).select("block", "label", "other")
    x = a.select("block", "label", "size", F.explode("grams").alias("gram"))
    y = b.select("block", "other", "size2", F.explode("grams2").alias("gram"))
    near = F.abs(F.col("size") - F.col("size2")) <= F.floor((F.col("size") + F.col("size2")) * shortfall + 1e-9)
    three = x.join(y, ["block", "gram"]).where(near).select("block", "label", "other")
    pairs = one.unionByName(two).unionByName(three).distinct()
    return pairs.withColumn("score", token_set_ratio("label", "other")).where(F.col("score") >= least)
