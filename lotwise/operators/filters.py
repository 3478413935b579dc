"""Row predicates and filters of the queries."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotwise.functions.canon import fuel_label, gearbox, sold
from lotwise.functions.text import ascii_upper, upper_key


@dataclass(frozen=True)
class Filters:
    """Scope of a ranking: places, years, and optionally make, model and fuel."""

    codes: tuple[str, ...] = ()
    year: int | None = None
    years: tuple[int, int] | None = None
    make: str | None = None
    model: str | None = None
    fuel: str | None = None


def _same(column: str, value: str | None) -> Column:
    return F.upper(F.trim(F.col(column))) == value.strip().upper() if value else F.lit(True)


def apply(df: DataFrame, f: Filters, code: str = "codigo_ine", year: str = "anio", make: str = "marca", model: str = "modelo", fuel: str = "combustible") -> DataFrame:
    """Conjunction of the filters that are set; the comparisons of codes and years reach the scan."""
    out = df
    if f.codes:
        out = out.where(F.col(code).isin(*f.codes))
    if f.years:
        out = out.where(F.col(year).between(*f.years))
    elif f.year is not None:
        out = out.where(F.col(year) == f.year)
    return out.where(_same(make, f.make) & _same(model, f.model) & _same(fuel, f.fuel))


def relaxed(df: DataFrame, f: Filters, **names: str) -> tuple[DataFrame, list[str]]:
    """``apply``, dropping fuel, then model, then make while nothing is left; and the steps that were dropped.

    One aggregation counts all levels at once.
    """
    col = {"make": "marca", "model": "modelo", "fuel": "combustible"} | {k: v for k, v in names.items() if k in ("make", "model", "fuel")}
    scope = apply(df, Filters(f.codes, f.year, f.years), **names)
    levels = [("make", "model", "fuel"), ("make", "model"), ("make",), ()]
    tests = []
    for level in levels:
        test = F.lit(True)
        for k in level:
            test = test & F.coalesce(_same(col[k], getattr(f, k)), F.lit(False))
        tests.append(test)
    counts = scope.agg(*(F.count_if(t).alias(str(i)) for i, t in enumerate(tests))).first()
    chosen = next((i for i in range(len(levels)) if counts[i]), len(levels) - 1)
    return scope.where(tests[chosen]), ["fuel", "model", "make"][:chosen]


def previous_period(start: int, end: int) -> tuple[int, int]:
    """The years of equal number just before."""
    n = end - start + 1
    return start - n, start - 1


def period(text: str) -> tuple[int, int]:
    """Years of ``YYYY``, ``YYYYMM`` or ``a-b`` of these."""
    parts = [int(p) for p in re.split(r"\s*[-:]\s*", text.strip())]
    years = [p // 100 if p > 9999 else p for p in parts]
    return min(years), max(years)


def find_places(places: DataFrame, name: str, province: str | None = None, region: str | None = None, policy: str = "all", code: str = "codigo_ine", place: str = "municipio") -> DataFrame:
    """Codes of the places that the name names: equal before prefix before part, accents and case aside.

    policy: ``all`` keeps every place of the best kind, ``first`` the smallest code, ``fail`` raises if there are several.
    """
    key, wanted = upper_key(F.col(place)), upper_key(F.lit(name))
    out = places
    if province:
        out = out.where(upper_key(F.col("provincia")) == upper_key(F.lit(province)))
    if region:
        out = out.where(upper_key(F.col("ccaa")) == upper_key(F.lit(region)))
    tier = F.when(key == wanted, 0).when(F.startswith(key, wanted), 1).when(F.contains(key, wanted), 2)
    ranked = out.withColumn("tier", tier).where("tier is not null")
    best = ranked.agg(F.min("tier").alias("best"))
    found = ranked.join(F.broadcast(best), F.col("tier") == F.col("best")).drop("best")
    if policy == "first":
        return found.orderBy(code).limit(1)
    if policy == "fail" and found.limit(2).count() > 1:
        raise ValueError(f"several places for {name!r}")
    return found


def vehicle_types(df: DataFrame, include: list[str], column: str = "tipo_vehiculo") -> DataFrame:
    """Rows whose type holds one of the words, in any case, or is null. No words: all rows."""
    words = [w for w in include if w.strip()]
    if not words:
        return df
    pattern = "(?i)" + "|".join(f"\\Q{w.strip()}\\E" for w in words)
    return df.where(F.col(column).isNull() | F.col(column).rlike(pattern))


def _filled(values) -> list[str]:
    if values is None:
        return []
    return [v for v in ([values] if isinstance(values, str) else values) if v and v.strip()]


FUEL_NAMES = {"ELECTRIC": "BEV"}


def by_fuel(df: DataFrame, include=None, exclude=None, column: str = "combustible_norm") -> DataFrame:
    """By canonical fuel label; lists of blank texts are no filter. A null fuel is an empty label."""
    label = fuel_label(F.col(column))
    names = lambda values: [FUEL_NAMES.get(v.strip().upper(), v.strip().upper()) for v in _filled(values)]
    if names(include):
        df = df.where(label.isin(*names(include)))
    if names(exclude):
        df = df.where(~label.isin(*names(exclude)))
    return df


def by_gearbox(df: DataFrame, want=None, column: str = "transmission") -> DataFrame:
    wanted = [w.strip().lower() for w in _filled(want)]
    wanted = ["automatic" if "auto" in w else "manual" if "man" in w else w for w in wanted]
    return df.where(gearbox(F.col(column)).isin(*wanted)) if wanted else df


@dataclass(frozen=True)
class GlobalFilters:
    transmission: object = None
    fuel_include: object = None
    fuel_exclude: object = None
    max_margin_ratio: float | None = None
    only_sold: bool = False
    max_year_gap: int | None = None


def globally(df: DataFrame, g: GlobalFilters) -> DataFrame:
    """Filters that all queries of a run share; comparisons with null drop the row."""
    if "transmission" in df.columns:
        df = by_gearbox(df, g.transmission)
    if "combustible_norm" in df.columns:
        df = by_fuel(df, g.fuel_include, g.fuel_exclude)
    if g.max_margin_ratio is not None:
        df = df.where(F.try_divide(F.col("margin_abs"), F.col("precio_final_eur")) <= g.max_margin_ratio)
    if g.only_sold and "lot_status" in df.columns:
        df = df.where(sold(F.col("lot_status")))
    if g.max_year_gap is not None and {"year_bca", "anio"} <= set(df.columns):
        df = df.where(F.abs(F.col("year_bca") - F.col("anio")) <= g.max_year_gap)
    return df


@dataclass(frozen=True)
class Listing:
    """Filters of listing queries. Texts match anywhere and in any case, as patterns; accents aside for segments."""

    model: str | None = None
    make: str | None = None
    segment_in: tuple[str, ...] = ()
    segment_out: tuple[str, ...] = ()
    years: tuple[int, int] | None = None
    year: tuple[int, ...] = ()
    max_age: int | None = None
    as_of: int | None = None
    price: tuple[float | None, float | None] = (None, None)
    mileage: tuple[float | None, float | None] = (None, None)
    fuels: tuple[str, ...] = ()
    gearbox: object = None
    names: dict[str, str] = field(default_factory=lambda: {"model": "modelo", "make": "marca", "segment": "segmento", "year": "anio", "price": "precio_final_eur", "mileage": "mileage", "fuel": "combustible_norm"})


def _range(df: DataFrame, column: str, bounds: tuple[float | None, float | None]) -> DataFrame:
    low, high = bounds
    if low is not None:
        df = df.where(F.col(column) >= low)
    return df.where(F.col(column) <= high) if high is not None else df


def listings(df: DataFrame, f: Listing) -> DataFrame:
    n = f.names
    if f.model:
        df = df.where(F.col(n["model"]).rlike("(?i)" + f.model))
    if f.make:
        df = df.where(F.col(n["make"]).rlike("(?i)" + f.make))
    segment = lambda: ascii_upper(F.trim(F.col(n["segment"])))
    if _filled(f.segment_in):
        df = df.where(segment().isin(*(s.strip().upper() for s in _filled(f.segment_in))))
    if _filled(f.segment_out):
        df = df.where(~F.coalesce(segment(), F.lit("")).isin(*(s.strip().upper() for s in _filled(f.segment_out))))
    if f.year:
        df = df.where(F.col(n["year"]).isin(*f.year))
    elif f.years:
        df = df.where(F.col(n["year"]).between(*f.years))
    if f.max_age is not None and f.as_of is not None:
        df = df.where(F.lit(f.as_of) - F.col(n["year"]) <= f.max_age)
    df = _range(_range(df, n["price"], f.price), n["mileage"], f.mileage) if n["mileage"] in df.columns else _range(df, n["price"], f.price)
    if f.fuels:
        df = by_fuel(df, list(f.fuels), column=n["fuel"])
    return by_gearbox(df, f.gearbox) if f.gearbox else df


def calendar(df: DataFrame, today: str, names_out: tuple[str, ...], countries: tuple[str, ...], icons_out: tuple[str, ...]) -> DataFrame:
    """Sales that end on the day (dd/MM), of the countries, without the names and icons that are barred."""
    barred = "(?i)" + "|".join(f"\\Q{x}\\E" for x in names_out) if names_out else None
    out = df.where(F.contains(F.col("sale_date"), F.lit(today)) & F.upper(F.trim("country")).isin(*(c.upper() for c in countries)))
    if barred:
        out = out.where(~F.coalesce(F.col("name"), F.lit("")).rlike(barred))
    if icons_out:
        out = out.where(~F.arrays_overlap(F.split(F.lower(F.coalesce("icons", F.lit(""))), "\\s*,\\s*"), F.array(*(F.lit(i.lower()) for i in icons_out))))
    return out


def all_blank(*columns: Column) -> Column:
    """Whether every column is null or blank."""
    return F.forall(F.array(*(F.coalesce(F.trim(c.cast("string")), F.lit("")) for c in columns)), lambda x: x == "")


def any_blank(*columns: Column) -> Column:
    return F.exists(F.array(*(F.coalesce(F.trim(c.cast("string")), F.lit("")) for c in columns)), lambda x: x == "")


def with_links(df: DataFrame, link: str, lot: str) -> DataFrame:
    """Rows whose link and lot number are both filled."""
    return df.where(~any_blank(F.col(link), F.col(lot)))


def without_types(df: DataFrame, types: tuple[str, ...], column: str = "tipo_vehiculo") -> DataFrame:
    return df.where(~F.coalesce(F.upper(F.trim(F.col(column))), F.lit("")).isin(*types))


# Kinds of resources and ends of addresses that a page can do without.
HEAVY_KINDS = ("image", "font", "stylesheet", "media")
HEAVY_ENDS = (".png", ".jpg", ".jpeg", ".gif", ".webp", ".svg", ".woff", ".woff2", ".ttf", ".otf", ".css")


def heavy_resource(url: Column, kind: Column) -> Column:
    """Whether a page's resource is left out of a load: by its kind, or by how its address ends. Null counts as empty."""
    ends = F.lower(F.coalesce(url, F.lit("")))
    return F.coalesce(kind.isin(*HEAVY_KINDS), F.lit(False)) | F.exists(F.array(*map(F.lit, HEAVY_ENDS)), lambda e: F.endswith(ends, e))
