"""Profiles of all columns of a table by mergeable sketches, kept by partition: a new month is added, not the rest read again."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StructType

#: Sizes of the sketches: 2^LG buckets of the distinct count (a standard error of about 0.8 / sqrt(2^LG)), KLL's k, and tracked values.
LG, K, TRACKED = 14, 400, 1000


def _numeric(schema: StructType, name: str) -> bool:
    return isinstance(schema[name].dataType, NumericType)


def _exact(c: Column) -> Column:
    """The sum of decimals, the same in any order; null unless each number is what its decimal says and the sum holds them."""
    one = c.try_cast("decimal(38,18)")
    return F.when(F.count_if(c.isNotNull() & ~F.coalesce(one.cast("double") == c, F.lit(False))) == 0, F.try_sum(one))


def sketched(df: DataFrame, by: list[str], columns: list[str] | None = None) -> DataFrame:
    """(by, column, n, n_null, low, high, low_text, high_text, total, exact, distinct, quantiles, top): a row for each partition and column.

    One aggregation over the table takes all columns at once and combines before the shuffle; a partition's row
    holds sketches of fixed size. Numbers have low, high, total and a quantile sketch, others low and high as texts; NaN
    counts as a number above all. Complex columns are profiled as their text.
    """
    names = columns or [c for c in df.columns if c not in by]

    def of(name: str) -> Column:
        c, number = F.col(f"`{name}`"), _numeric(df.schema, name)
        text = c.cast("string")
        none = F.lit(None).cast("double")
        return F.struct(
            F.lit(name).alias("column"), F.count(F.lit(1)).alias("n"), F.count_if(c.isNull()).alias("n_null"), (F.min(c.cast("double")) if number else none).alias("low"), (F.max(c.cast("double")) if number else none).alias("high"),
            (F.lit(None).cast("string") if number else F.min(text)).alias("low_text"), (F.lit(None).cast("string") if number else F.max(text)).alias("high_text"), (F.sum(c.cast("double")) if number else none).alias("total"),
            (_exact(c.cast("double")) if number else F.lit(None).cast("decimal(38,18)")).alias("exact"),
            F.hll_sketch_agg(text, LG).alias("distinct"), (F.kll_sketch_agg_double(c.cast("double"), K) if number else F.lit(None).cast("binary")).alias("quantiles"), F.expr(f"approx_top_k_accumulate(CAST(`{name}` AS STRING), {TRACKED})").alias("top"),
        )

    wide = df.groupBy(*by).agg(*(of(c).alias(f"__{i}") for i, c in enumerate(names)))
    return wide.select(*by, F.explode(F.array(*(F.col(f"__{i}") for i in range(len(names))))).alias("p")).select(*by, "p.*")


def merged(sketches: DataFrame, keys: list[str] = (), quantiles: tuple[float, ...] = (0.25, 0.5, 0.75), top: int = 5) -> DataFrame:
    """(keys, column, n, n_null, low, high, low_text, high_text, mean, n_distinct, quantiles, top) over the partitions of ``sketches``.

    Counts, bounds and means are exact; a mean of numbers that aren't decimals of up to 18 places is that of their doubles, in the order
    in which they are added up. The distinct count has the sketch's error, quantiles a rank
    error of about 2.3 / K^0.9, top values (value, count) are exact up to TRACKED different ones.
    """
    if "exact" not in sketches.columns:  # a profile from before
        sketches = sketches.withColumn("exact", F.lit(None).cast("decimal(38,18)"))
    each = sketches.groupBy(*keys, "column").agg(
        F.sum("n").alias("n"), F.sum("n_null").alias("n_null"), F.min("low").alias("low"), F.max("high").alias("high"), F.min("low_text").alias("low_text"), F.max("high_text").alias("high_text"), F.sum("total").alias("total"), F.when(F.count("total") == F.count("exact"), F.try_sum("exact")).alias("exact"),
        F.hll_sketch_estimate(F.hll_union_agg("distinct")).alias("n_distinct"), F.kll_merge_agg_double("quantiles").alias("k"), F.expr(f"approx_top_k_combine(top, {TRACKED})").alias("t"),
    )
    many = F.col("n") - F.col("n_null")
    # A quotient of 18 places has all digits of a double unless it is small.
    whole, rough = F.try_divide(F.col("exact"), many.cast("decimal(20,0)")).cast("double"), F.try_divide(F.coalesce(F.col("exact").cast("double"), F.col("total")), many)
    found = each.withColumn("mean", F.when(F.abs(whole) >= 0.01, whole).otherwise(rough))
    cut = F.when(F.col("low").isNotNull(), F.kll_sketch_get_quantile_double("k", F.array(*(F.lit(float(q)) for q in quantiles))))
    return found.select(*keys, "column", "n", "n_null", "low", "high", "low_text", "high_text", "mean", "n_distinct", cut.alias("quantiles"), F.expr(f"approx_top_k_estimate(t, {int(top)})").alias("top"))


def ranks(df: DataFrame, values: DataFrame, columns: list[str]) -> DataFrame:
    """(column, below, not_above): how many numbers of each column are below its value of ``values`` (column, value), and not above it.

    One scan that counts, so what a task holds doesn't grow with the table.
    """
    asked = values.where(F.col("column").isin(*columns)).groupBy().agg(*(F.max(F.when(F.col("column") == c, F.col("value"))).alias(f"__v{i}") for i, c in enumerate(columns)))
    number = lambda c: F.col(f"`{c}`").cast("double")
    counts = [F.struct(F.count_if(number(c) < F.col(f"__v{i}")).alias("below"), F.count_if(number(c) <= F.col(f"__v{i}")).alias("not_above")).alias(f"__c{i}") for i, c in enumerate(columns)]
    wide = df.select(*(F.col(f"`{c}`") for c in columns)).crossJoin(F.broadcast(asked)).agg(*counts)
    return wide.select(F.explode(F.array(*(F.struct(F.lit(c).alias("column"), F.col(f"__c{i}").alias("c")) for i, c in enumerate(columns)))).alias("p")).select("p.column", "p.c.*")


def add(spark: SparkSession, df: DataFrame, by: str, path: str) -> DataFrame:
    """Sketch the partitions of ``df`` (a new month, say) into the profile at ``path``; those that are there are replaced, others stay as they are."""
    sketched(df, [by]).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(path)
    return spark.read.parquet(path)
