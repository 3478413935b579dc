"""Landed price and return."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotwise.functions.numbers import number
from lotwise.operators.columns import require, resolve

PARTS = {
    "base": ["vehicle_base_price_eur", "winning_bid_eur", "winning_bid"],
    "transport": ["transport_eur", "transport_price_eur"],
    "commission": ["commission_total_eur", "bca_commission_eur"],
}


def fixed_costs(df: DataFrame, country: str | None = None) -> DataFrame:
    """One row with the sum of the fixed costs, of the country if one is given."""
    rows = df if country is None else df.where(F.upper(F.trim("pais")) == country.upper())
    return rows.agg(F.coalesce(F.sum(number(F.col("valor_eur"))), F.lit(0.0)).alias("fijos_eur"))


def landed(lots: DataFrame, costs: DataFrame) -> DataFrame:
    """``lots`` with the fixed costs and the final price: base, transport, commission and fixed costs, nulls as zero."""
    found = {k: resolve(lots.columns, names, "exact") for k, names in PARTS.items()}
    missing = [k for k, v in found.items() if v is None]
    if missing:
        raise ValueError(f"landed price: no column for {missing}")
    total = F.col("fijos_eur")
    for c in found.values():
        total = total + F.coalesce(number(F.col(c)), F.lit(0.0))
    one = costs.withColumn("__one", F.lit(1))  # a single row
    return lots.withColumn("__one", F.lit(1)).join(F.broadcast(one), "__one").drop("__one").withColumn("precio_final_eur", total)


def direct_or_mean(lots: DataFrame, direct: str = "transport_direct", fallback: str = "transport_fallback", out: str = "transport_eur") -> DataFrame:
    return lots.withColumn(out, F.when(F.col(direct) > 0, F.col(direct)).otherwise(F.coalesce(F.col(fallback), F.lit(0.0))))


def margins(df: DataFrame, final: str = "precio_final_eur", sale: str = "precio_venta_ganvam") -> DataFrame:
    """``df`` with margin_abs and margin_pct, where they aren't there."""
    require(df, [final, sale], "margins")
    out = df if "margin_abs" in df.columns else df.withColumn("margin_abs", F.col(sale) - F.col(final))
    return out if "margin_pct" in out.columns else out.withColumn("margin_pct", F.try_divide(F.col("margin_abs"), F.col(final)))
