"""Filter interaction audit: what each filter takes alone, after others, and in every order of all of them."""

from __future__ import annotations

from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lotwise.llm.common import checkpoint

SPACE = r"[\x20\x09-\x0D]+"
#: The filters' letters; bit i of a mask stands for letter i.
FILTERS = "ABCDE"
FULL = (1 << len(FILTERS)) - 1
LEAST_WORDS = 50
MARKS = "[#$%&*|]"


def failures(text: Column) -> dict[str, Column]:
    """Failure conditions of the four filters that look at the text alone."""
    words = F.array_remove(F.split(text, SPACE), "")
    n = F.size(words)
    capitals = F.octet_length(F.regexp_replace(text, "[^A-Z]+", ""))
    return {
        "A": n < LEAST_WORDS,
        "B": F.size(F.array_distinct(words)) * 100 < n * 65,
        "C": capitals.cast("long") * 100 > F.char_length(text).cast("long") * 5,
        "D": text.rlike(MARKS),
    }


def flagged(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """(part, A, B, C, D, E, n, good, toxic): the counts of documents with the same part and the same failures.

    E compares each text's SHA-256 with those of smaller ids. Rows are added up by (text,
    id) and then by (text, part, labels) before the least id of a text is joined back,
    so copies weigh as one row a part, however many there are.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"), text.alias("text"))
    flags = rows.select("id", "part", F.unhex(F.sha2("text", 256)).alias("body"), *(c.alias(k) for k, c in failures(F.col("text")).items()))
    own = ["A", "B", "C", "D"]
    each = flags.groupBy("body", "id", "part", *own).agg(F.count(F.lit(1)).alias("n"))
    known = labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("id")).agg(
        F.coalesce(F.max(F.col("quality") == 1), F.lit(False)).alias("good"), F.coalesce(F.max(F.col("toxic") == 1), F.lit(False)).alias("toxic")
    )
    # Rows without an id meet no label; the text's hash deals them out.
    salt = F.when(F.col("id").isNull(), F.xxhash64("body")).otherwise(F.lit(0).cast("long"))
    each = each.withColumn("salt", salt).join(known.withColumn("salt", F.lit(0).cast("long")), ["id", "salt"], "left")
    marks = [F.coalesce(F.col(c), F.lit(False)).alias(c) for c in ("good", "toxic")]
    alike = each.select("body", "part", *own, *marks, "id", "n").groupBy("body", "part", *own, "good", "toxic").agg(
        F.sum("n").alias("n"),
        F.min(F.when(F.col("id").isNotNull(), F.struct("id", F.col("n").alias("same")))).alias("first"),
        F.sum(F.when(F.col("id").isNull(), F.col("n")).otherwise(0)).alias("nameless"),
    )
    least = alike.groupBy("body").agg(F.min("first.id").alias("least"))
    joined = alike.join(least, "body")
    fresh = F.col("nameless") + F.when(F.col("first.id") == F.col("least"), F.col("first.same")).otherwise(0)
    both = F.explode(F.array(F.struct(F.lit(False).alias("E"), fresh.alias("m")), F.struct(F.lit(True).alias("E"), (F.col("n") - fresh).alias("m"))))
    split = joined.select("part", *own, "good", "toxic", both.alias("x")).select("part", *own, "good", "toxic", "x.E", "x.m").where("m > 0")
    return split.groupBy("part", *FILTERS).agg(
        F.sum("m").alias("n"), F.sum(F.when(F.col("good"), F.col("m")).otherwise(0)).alias("good"), F.sum(F.when(F.col("toxic"), F.col("m")).otherwise(0)).alias("toxic")
    )


def survivors(counts: DataFrame) -> DataFrame:
    """(part, mask, n, good, toxic): what is left of each part once the filters of the mask have run, zeros included.

    The grouping set that holds the mask's flags gives it in the row where all of them are false.
    """
    cube = counts.cube("part", *FILTERS).agg(F.sum("n").alias("n"), F.sum("good").alias("good"), F.sum("toxic").alias("toxic"), *(F.grouping(c).alias(f"without_{c}") for c in ("part", *FILTERS)))
    passed = F.lit(True)
    mask = F.lit(0)
    for i, c in enumerate(FILTERS):
        passed = passed & ((F.col(f"without_{c}") == 1) | ~F.col(c))
        mask = mask + (1 - F.col(f"without_{c}")) * (1 << i)
    found = cube.where((F.col("without_part") == 0) & passed).select("part", mask.cast("int").alias("mask"), "n", "good", "toxic")
    grid = counts.select("part").distinct().withColumn("mask", F.explode(F.sequence(F.lit(0), F.lit(FULL))))
    return grid.join(found, ["part", "mask"], "left").na.fill(0, ["n", "good", "toxic"])


def audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """One row for each part, order of the five filters and step.

    Columns: part, filter_order, step (from 1), kept, removed, redundant, unique_fails, good_lost,
    toxic_lost, shapley, as counts of documents of the part. Null texts are empty; a null part is the
    empty string; repeated rows count each. A document without an id repeats nothing and has no label,
    rows of one id don't repeat each other; a document is good (toxic) if any of its labels says so, so null and
    repeated labels do no harm. Texts of any length are taken whole. An empty table gives no rows;
    other columns are not read.

    Documents are added up to at most 32 rows a part before the cube over the five failure flags and the
    part. Its survivors of two subsets that differ by one filter are joined: their difference is
    what the filter takes there, whatever the order before it was.
    """
    left = survivors(checkpoint(flagged(docs, labels, id_col, text_col, part_col)))
    spark = docs.sparkSession
    n = len(FILTERS)
    pairs = [(m, m | 1 << i, FILTERS[i], factorial(m.bit_count()) * factorial(n - 1 - m.bit_count())) for m in range(FULL + 1) for i in range(n) if not m >> i & 1]
    pairs = spark.createDataFrame(pairs, "mask int, after int, letter string, orders long")  # 80 rows
    after = left.select("part", F.col("mask").alias("after"), F.col("n").alias("kept"), F.col("good").alias("good_after"), F.col("toxic").alias("toxic_after"))
    moves = left.join(F.broadcast(pairs), "mask").join(after, ["part", "after"])
    moves = moves.select("part", "mask", "letter", "orders", "kept", (F.col("n") - F.col("kept")).alias("removed"), (F.col("good") - F.col("good_after")).alias("good_lost"), (F.col("toxic") - F.col("toxic_after")).alias("toxic_lost"))
    whole = Window.partitionBy("part", "letter")  # 16 rows
    alone = F.max(F.when(F.col("mask") == 0, F.col("removed"))).over(whole)
    last = F.max(F.when(F.bit_count("mask") == n - 1, F.col("removed"))).over(whole)
    moves = moves.select("*", (alone - F.col("removed")).alias("redundant"), last.alias("unique_fails"), F.sum(F.col("orders") * F.col("removed")).over(whole).alias("shapley"))
    bit = {c: 1 << i for i, c in enumerate(FILTERS)}
    steps = [("".join(o), k + 1, o[k], sum(bit[c] for c in o[:k])) for o in permutations(FILTERS) for k in range(n)]
    steps = spark.createDataFrame(steps, "filter_order string, step int, letter string, mask int")  # 600 rows
    return moves.join(F.broadcast(steps), ["letter", "mask"]).select("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
