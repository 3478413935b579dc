"""Queries from a configuration: global filters, then a registered plan for each, then a table for each."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame

from lotwise.functions.text import file_safe
from lotwise.operators import recommend
from lotwise.operators.columns import conform
from lotwise.operators.filters import GlobalFilters, Listing, globally
from lotwise.session import settled


@dataclass(frozen=True)
class Plan:
    name: str
    frame: DataFrame
    extra: DataFrame | None = None


def _first(d: dict, *names, default=None):
    for n in names:
        v = d.get(n)
        if v is not None and v != "" and v != [""] and v != []:
            return v
    return default


def _tuple(v) -> tuple:
    return () if v is None else tuple(v) if isinstance(v, (list, tuple)) else (v,)


def _listing(filters: dict, years: tuple[int | None, int | None] = (None, None), km: float | None = None, as_of: int | None = None, **more) -> Listing:
    low, high = _first(filters, "min_year", "year_from", default=years[0]), _first(filters, "max_year", "year_to", default=years[1])
    return Listing(
        years=(low or 0, high or 9999) if low or high else None,
        year=_tuple(_first(filters, "year_exact")),
        mileage=(_first(filters, "mileage_min"), _first(filters, "max_km", "mileage_max", default=km)),
        price=(_first(filters, "min_price"), _first(filters, "max_price")),
        fuels=_tuple(_first(filters, "fuel_include", "combustible_include")),
        gearbox=_first(filters, "gearbox", "transmission"),
        segment_in=_tuple(_first(filters, "segment", "segment_include")),
        segment_out=_tuple(_first(filters, "segment_exclude")),
        max_age=_first(filters, "max_age_years"),
        as_of=as_of,
        **more,
    )


def _q1(df, q, cfg, as_of):
    f = _listing(q.get("filters", {}), (2018, 2024), model=_first(q, "model", "modelo_base"))
    top, sales = recommend.best_auction(df, f, q.get("top_n", 20))
    return top, sales


def _q2(df, q, cfg, as_of):
    return recommend.within_brand(df, _listing(q.get("filters", {}), (2020, None), 100000, make=q["brand"]), q.get("mode", "cheapest")), None


def _q3(df, q, cfg, as_of):
    filters = dict(q.get("filters", {}), segment=q["segment"])
    return recommend.within_segment(df, q.get("region", "bcn"), _listing(filters, (2020, 2025)), cfg, q.get("mode", "cheapest"), q.get("top_n", 20)), None


def _q4(df, q, cfg, as_of):
    filters = dict(q.get("filters", {}))
    if q.get("year"):
        filters["year_exact"] = q["year"]
    if q.get("fuel"):
        filters["fuel_include"] = list(_tuple(q["fuel"]))
    return recommend.attractiveness(df, q.get("region", "bcn"), _listing(filters, (2020, 2024), model=_first(q, "modelo_base", "model")), cfg), None


def _q5(df, q, cfg, as_of):
    f = Listing(model=_first(q, "modelo_base", "model"), year=(_first(q, "year", "anio", "año"),))
    return recommend.best_fuel_gap(df, f), None


def _generic(df, q, cfg, as_of):
    """The filters come first here, so scores are scaled within what they leave."""
    from lotwise.operators.filters import listings

    f = _listing(q.get("filters", {}), as_of=as_of, model=_first(q.get("filters", {}), "modelo_base", "model"))
    cluster = q.get("cluster", {})
    picked = recommend.best(
        listings(df, f), q.get("region", "bcn"), cfg, Listing(), q.get("selection", "cheapest"), q.get("top_n", 20),
        cluster.get("include_sale_country", False), cluster.get("include_sale_name", False), q.get("min_listings_per_group", 1),
        q.get("ignore_rotation", False), q.get("prefer_fast", False),
    )
    return picked, None


PLANS: dict[str, Callable] = {"q1": _q1, "q2": _q2, "q3": _q3, "q4": _q4, "q5": _q5, "generic": _generic}
ALIASES = {"best_auction": "q1", "brand_order": "q2", "segment_order": "q3", "attractiveness": "q4", "best_fuel": "q5", "recommend_best": "generic"}
LISTED = {"q1", "q2", "q3"}


def plans(df: DataFrame, config: dict, as_of: int | None = None, shared: bool = True) -> list[Plan]:
    """A plan for each query of the configuration; an unknown type raises.

    What all queries share, the listing under the global filters, is settled once if there are several, so its
    joins and filters run once and each plan reads the checkpoint. ``shared`` off plans each from the source.
    """
    for q in config.get("queries", []):
        kind = str(q.get("type", "generic")).lower()
        if ALIASES.get(kind, kind) not in PLANS:
            raise ValueError(f"unknown query type {kind!r}")
    g = config.get("global_filters", {})
    rows = globally(df, GlobalFilters(g.get("transmission"), g.get("fuel_include"), g.get("fuel_exclude"), g.get("margin_cap_ratio"), bool(g.get("sold_only")), g.get("max_year_gap")))
    if shared and len(config.get("queries", [])) > 1:
        rows = settled(rows)
    d = config.get("demand", {})
    cfg = recommend.Config(float(config.get("alpha", 0.6)), float(config.get("rotation_boost", 0.0)), recommend.Demand(**d))
    out = []
    for i, q in enumerate(config.get("queries", [])):
        kind = str(q.get("type", "generic")).lower()
        kind = ALIASES.get(kind, kind)
        frame, extra = PLANS[kind](rows, q, cfg, as_of)
        out.append(Plan(q.get("name", f"query {i + 1}"), conform(frame) if kind in LISTED else frame, extra))
    return out


def load(path: str) -> dict:
    """A configuration file, YAML where that can be read, else JSON."""
    import json

    with open(path, encoding="utf-8") as f:
        text = f.read()
    try:
        import yaml
    except ImportError:
        return json.loads(text)
    return yaml.safe_load(text)


def write(spark, found: list[Plan], folder: str) -> DataFrame:
    """Each plan's rows as a CSV table, and an index of them."""
    rows = []
    for i, p in enumerate(found, 1):
        for suffix, frame in (("", p.frame), ("_subastas", p.extra)):
            if frame is not None:
                path = f"{folder}/{i:02d}_{file_safe(p.name)}{suffix}"
                frame.write.mode("overwrite").option("header", True).csv(path)
                rows.append((i, p.name + suffix, path))
    index = spark.createDataFrame(rows, "number int, name string, path string")
    index.coalesce(1).write.mode("overwrite").option("header", True).csv(f"{folder}/index")
    return index
