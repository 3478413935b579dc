"""Prioritized match of lots to market features: place before fuel, exact before substitute."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotwise.functions.numbers import ratio

# Regions that are tried for a region, in order.
GEO = {"BCN": ("BCN", "CAT", "ESP"), "CAT": ("CAT", "ESP"), "ESP": ("ESP",)}
# Substitutes are tried in this order for every lot; what differs by the lot's fuel is which of them count.
ORDER = ("petrol", "diesel", "electric", "hev", "phev", "cng", "lpg", "unknown")
# Substitutes by the lot's fuel.
ALLOWED = {
    "petrol": ("diesel", "electric", "hev", "phev", "unknown"),
    "hev": ("petrol", "diesel", "electric", "phev", "unknown"),
    "phev": ("petrol", "diesel", "electric", "hev", "unknown"),
    "diesel": ("petrol", "electric", "hev", "phev", "unknown"),
    "electric": ("phev", "hev", "petrol", "diesel", "unknown"),
    "cng": ("lpg", "petrol", "diesel", "unknown"),
    "lpg": ("cng", "petrol", "diesel", "unknown"),
}
EXACT, BEST, NO_FUEL = 0, 9, 10


NAMES = ("marca", "modelo", "anio")


def tier(own: Column, found: Column, best: Column, allowed: dict[str, tuple[str, ...]] = ALLOWED, order: tuple[str, ...] = ORDER) -> Column:
    """0 for the lot's own fuel, 1 to 8 for a substitute that its fuel allows, 9 for the best fuel, 10 for none; null: no match."""
    table = F.create_map(*chain.from_iterable((F.lit(k), F.array(*(F.lit(x) for x in v)).cast("array<string>")) for k, v in allowed.items()))
    mine = F.coalesce(F.try_element_at(table, own), F.array_except(F.array(*(F.lit(x) for x in order)), F.array(F.coalesce(own, F.lit("unknown")))))
    place = F.array_position(F.array(*(F.lit(x) for x in order)), found)
    return (
        F.when(own.eqNullSafe(found), EXACT)
        .when(F.array_contains(mine, found), place.cast("int"))
        .when(found.eqNullSafe(best), BEST)
    )


def pooled(lots: DataFrame, with_fuel: DataFrame, without_fuel: DataFrame, metrics: list[str], regions: tuple[str, ...]) -> DataFrame:
    """``lots`` with ``__pool``: the candidates of their make, model and year in the regions, by one null-safe join.

    The array holds at most regions by fuels.
    """
    own = [m for m in metrics if m != "best_fuel"]
    fuel = with_fuel.select("region", *NAMES, "combustible", "best_fuel", *own)
    bare = without_fuel.select("region", *NAMES, F.lit(None).cast("string").alias("combustible"), "best_fuel", *((F.col(m) if m in without_fuel.columns else F.lit(None).cast(with_fuel.schema[m].dataType)).alias(m) for m in own))
    pool = fuel.withColumn("bare", F.lit(False)).unionByName(bare.withColumn("bare", F.lit(True)))
    pool = pool.where(F.col("region").isin(*regions) & F.col("units_abs").isNotNull())
    candidate = F.struct(F.col("region").alias("region"), F.col("combustible").alias("fuel"), F.col("best_fuel").alias("best"), "bare", F.struct("best_fuel", *own).alias("found"))
    right = pool.groupBy(*(F.col(n).alias(f"__{n}") for n in NAMES)).agg(F.collect_list(candidate).alias("__pool"))
    return lots.join(right, [F.col(n).eqNullSafe(F.col(f"__{n}")) for n in NAMES], "left").drop(*(f"__{n}" for n in NAMES))


def least(places: tuple[str, ...], **options) -> Column:
    """The best candidate of ``__pool`` for the row's fuel: the least of (place, tier), so a nearer place beats a better tier."""
    listed = F.array(*(F.lit(p) for p in places))

    def order(c: Column) -> Column:
        step = F.when(c["bare"], NO_FUEL).otherwise(tier(F.col("combustible"), c["fuel"], c["best"], **options))
        priority = (F.array_position(listed, c["region"]) * 100 + step).cast("int")
        return F.struct(priority.isNull().alias("none"), priority.alias("priority"), c["fuel"].isNull().alias("last"), c["fuel"].alias("fuel"), step.alias("tier"), c["region"].alias("region"), c["found"].alias("found"))

    return F.array_min(F.transform(F.filter("__pool", lambda c: F.array_contains(listed, c["region"])), order))


def _told(best: str, metrics: list[str], end: str = "") -> list[Column]:
    """The metrics of a best candidate, how it was matched and where; null if there is none."""
    hit = F.col(f"{best}.priority").isNotNull()
    kind = F.when(F.col(f"{best}.tier") == EXACT, "exact").when(F.col(f"{best}.tier") == NO_FUEL, "no_fuel").when(hit, "fuel_fallback")
    return [*(F.when(hit, F.col(f"{best}.found.`{m}`")).alias(m + end) for m in metrics), F.when(hit, kind).alias("match_kind" + end), F.when(hit, F.lower(f"{best}.region")).alias("geo_fallback" + end)]


def match(lots: DataFrame, key: str, with_fuel: DataFrame, without_fuel: DataFrame, metrics: list[str], target: str, geo: dict[str, tuple[str, ...]] = GEO, **options) -> DataFrame:
    """One row for each lot: the metrics of its best candidate, ``match_kind`` and ``geo_fallback``; null if it has none.

    Lots: ``key``, marca, modelo, anio, combustible. Features: region and the same.
    """
    rows = pooled(lots.select(key, *NAMES, "combustible"), with_fuel, without_fuel, metrics, geo[target])
    return rows.withColumn("__best", least(geo[target], **options)).select(key, *_told("__best", metrics))


def match_all(lots: DataFrame, with_fuel: DataFrame, without_fuel: DataFrame, metrics: list[str], geo: dict[str, tuple[str, ...]] = GEO, **options) -> DataFrame:
    """``lots`` with the match for each target region, its columns ending in the region, and the ratios of units.

    The candidates of all targets come by one join, and each row takes the least of them once for each target, so rows
    need no key and repeated ones stay.
    """
    rows = pooled(lots, with_fuel, without_fuel, metrics, tuple(dict.fromkeys(chain.from_iterable(geo.values()))))
    rows = rows.withColumns({f"__best_{t}": least(places, **options) for t, places in geo.items()})
    out = rows.select(*lots.columns, *chain.from_iterable(_told(f"__best_{t}", metrics, f"_{t.lower()}") for t in geo))
    a, b, c = (t.lower() for t in geo)
    out = out.withColumn(f"ratio_{a}_{b}_%", ratio(F.col(f"units_abs_{a}"), F.col(f"units_abs_{b}"), zero=False))
    return out.withColumn(f"ratio_{b}_{c}_%", ratio(F.col(f"units_abs_{b}"), F.col(f"units_abs_{c}"), zero=False))
