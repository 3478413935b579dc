"""Export of a period: the monthly aggregates of its months and its summaries, as files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotwise.operators.market import SUMMARIES, summary_set
from lotwise.session import settled

#: Files of the summaries; those of the focus are tables alone.
FILES = {"rank_marcas": "rank_marcas", "rank_modelos": "rank_modelos", "rank_provincias": "rank_provincias", "rank_combustible": "rank_combustible", "mix_comb_prov": "mix_combustible_provincia"}


def tables(monthly: DataFrame, start: int, end: int, place: str, top: int = 20) -> dict[str, DataFrame]:
    """The nine tables of a period by name, cut from one settled set of summaries, and its rows as ``period_df``."""
    found = settled(summary_set(monthly, start, end, place, top))
    out = {}
    for name, keys in SUMMARIES.items():
        more = ["share_prov"] if name == "mix_comb_prov" else []
        out[name] = found.where(F.col("tabla") == name).orderBy("posicion").select(*(k for k in keys if k != "focus"), "unidades", *more)
    out["period_df"] = monthly.where(F.col("yyyymm").between(start, end))
    return out


def period(monthly: DataFrame, start: int, end: int, place: str, folder: str, by_code: DataFrame | None = None, top: int = 20) -> list[str]:
    """Write a period below ``folder``: the aggregate as Parquet and CSV, that by place code likewise, the summaries as CSV and the keys for joins.

    Returns the names that were written. Raises if the period has no row; a place-code aggregate without one is left out.
    """
    found = tables(monthly, start, end, place, top)
    rows = found["period_df"]
    if rows.isEmpty():
        raise ValueError(f"no data from {start} to {end}")
    written = []

    def put(df: DataFrame, name: str, *kinds: str) -> None:
        for kind in kinds:
            writer = df.write.mode("overwrite")
            (writer.option("header", True) if kind == "csv" else writer).format(kind).save(f"{folder}/{name}.{kind}")
            written.append(f"{name}.{kind}")

    put(rows, "agg_transmisiones", "parquet", "csv")
    if by_code is not None:
        own = by_code.where(F.col("yyyymm").between(start, end))
        if not own.isEmpty():
            put(own, "agg_transmisiones_ine", "parquet", "csv")
    for name, file in FILES.items():
        put(found[name].coalesce(1), file, "csv")
    put(rows, "keys_for_join", "parquet")
    return written
