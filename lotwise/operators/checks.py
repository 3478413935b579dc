"""Quality reports over enriched tables; each is one aggregation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def sanity(df: DataFrame, columns: list[str], most: float = 0.7) -> DataFrame:
    """(column, n_rows, n_null, null_rate, warn) for each of the columns."""
    counts = df.agg(F.count(F.lit(1)).alias("n_rows"), *(F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in columns))
    rate = F.try_divide(F.col("n_null").cast("double"), F.col("n_rows").cast("double"))
    return counts.unpivot(["n_rows"], columns, "column", "n_null").withColumn("null_rate", rate).withColumn("warn", F.coalesce(rate > most, F.lit(False)))


def consistency(df: DataFrame, shares: list[str], rank: str, flag: str, part: str) -> DataFrame:
    """Shares outside 0 to 1, the least rank, and whether flagged rows are their group's best."""
    bad = [F.count_if(~F.col(f"`{c}`").between(0, 1 + 1e-9)).alias(f"bad_{c}") for c in shares]
    return df.agg(*bad, F.min(rank).alias("least_rank"), F.coalesce(F.bool_and(F.when(F.col(flag) == 1, F.abs(F.col(f"`{part}`") - 1) < 1e-9)), F.lit(True)).alias("best_is_best"))


def coverage(df: DataFrame, by: str, flags: list[str]) -> tuple[DataFrame, DataFrame]:
    """Rows by kind, and the share of each flag."""
    kinds = df.groupBy(F.coalesce(F.col(by), F.lit("NONE")).alias(by)).agg(F.count(F.lit(1)).alias("n"))
    shares = df.agg(*(F.avg(F.coalesce(F.col(f).cast("int"), F.lit(0))).alias(f) for f in flags)).unpivot([], flags, "flag", "share")
    return kinds, shares


def returns_by_model(df: DataFrame, keys: list[str], price: str = "price_id") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.count(price).alias("n_matched"), F.avg("margin_abs").alias("margin_abs_mean"), F.avg("margin_pct").alias("margin_pct_mean"))


def failures(audit: DataFrame, steps: list[str]) -> DataFrame:
    """How often each step failed at each stage; the stages are columns of the audit."""
    kept = audit.select(*(F.col(s).cast("string") for s in steps))
    return kept.unpivot([], steps, "stage", "step").where("step is not null").groupBy("stage", "step").agg(F.count(F.lit(1)).alias("n"))


def sheets(df: DataFrame, keys: list[str], top: int = 50) -> dict[str, DataFrame]:
    """The tables of the analysis workbook."""
    matched = df.where(F.col("price_id").isNotNull())
    kinds, flags = coverage(df, "matching_type", ["matched"])
    order = lambda c: matched.orderBy(F.desc_nulls_last(c), "lot_id").limit(top)
    return {"roi_by_model": returns_by_model(df, keys), "coverage": kinds, "flags": flags, "top_margin_abs": order("margin_abs"), "top_margin_pct": order("margin_pct")}
