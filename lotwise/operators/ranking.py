"""Rankings of makes and models in a place and period."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lotwise.functions.canon import fuel_code
from lotwise.functions.numbers import ratio
from lotwise.operators.filters import Filters, apply, previous_period


def ranking(df: DataFrame, keys: list[str], top: int | None = None, units: str = "unidades") -> DataFrame:
    """Units of each key with rank, share and running share in percent; keys with nulls are kept.

    The total is a window over the groups, whose number is that of makes and models, not of rows.
    """
    sums = df.groupBy(*keys).agg(F.sum(units).alias("unidades"))
    order = Window.orderBy(F.desc("unidades"), *(F.asc_nulls_first(k) for k in keys))
    share = 100 * ratio(F.col("unidades"), F.sum("unidades").over(Window.partitionBy()))
    out = sums.withColumn("rank", F.row_number().over(order).cast("long")).withColumn("share_%", share)
    out = out.withColumn("share_acum_%", F.sum("share_%").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    return out.where(F.col("rank") <= top) if top else out


def hhi(ranked: DataFrame) -> DataFrame:
    """Concentration of a ranking, 0 to 10 000."""
    return ranked.agg((F.sum(F.pow(F.col("share_%") / 100, F.lit(2))) * 10000).alias("hhi"))


def fuel_mix(df: DataFrame, fuel: str = "combustible", units: str = "unidades") -> DataFrame:
    sums = df.groupBy(fuel_code(F.col(fuel)).alias("fuel")).agg(F.sum(units).alias("unidades"))
    return sums.withColumn("share_%", 100 * ratio(F.col("unidades"), F.sum("unidades").over(Window.partitionBy())))


def time_series(df: DataFrame, keys: list[str], period: str = "yyyymm", units: str = "unidades") -> DataFrame:
    return df.groupBy(period, *keys).agg(F.sum(units).alias("unidades")).orderBy(period, *keys)


def versus_previous(df: DataFrame, f: Filters, keys: list[str], top: int, legacy: bool = False, **names: str) -> DataFrame:
    """The ranking of the filter's years beside the years just before: units, share, rank, and their changes.

    Both periods come from one scan. legacy: the previous ranking is cut to its own
    top rows, so keys beyond them count as absent.
    """
    start, end = f.years or (f.year, f.year)
    before = previous_period(start, end)
    year = names.get("year", "anio")
    rows = apply(df, Filters(f.codes, None, (before[0], end), f.make, f.model, f.fuel), **names)
    now = ranking(rows.where(F.col(year).between(start, end)), keys, top)
    old = ranking(rows.where(F.col(year).between(*before)), keys, top if legacy else None)
    old = old.select(*(F.col(k).alias(f"p_{k}") for k in keys), F.col("unidades").alias("unidades_prev"), F.col("share_%").alias("share_prev_%"), F.col("rank").alias("rank_prev"))
    joined = now.join(old, [F.col(k).eqNullSafe(F.col(f"p_{k}")) for k in keys], "left").drop(*(f"p_{k}" for k in keys))
    gone = F.coalesce(F.col("unidades_prev"), F.lit(0))
    return joined.withColumns({
        "delta_unidades": F.col("unidades") - gone,
        "delta_share_pp": F.col("share_%") - F.coalesce(F.col("share_prev_%"), F.lit(0.0)),
        "delta_rank": F.col("rank_prev") - F.col("rank"),
        "var_%": 100 * F.try_divide(F.col("unidades") - gone, F.col("unidades_prev")),
    })
