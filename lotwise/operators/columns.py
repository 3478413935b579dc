"""Resolving and conforming columns. All of it looks at schemas alone and starts no job."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotwise.functions.canon import fuel_label


def _name(x: str) -> str:
    plain = "".join(c for c in unicodedata.normalize("NFKD", x.replace(" ", " ")) if not unicodedata.combining(c))
    return " ".join(re.sub(r"[^0-9a-z]+", " ", plain.lower()).split())


def resolve(columns: list[str], candidates: list[str], mode: str = "normalized") -> str | None:
    """The first column that a candidate names.

    exact: equal; ci: equal in any case; normalized: equal without accents, case and
    punctuation; contains: as ci, else as a part of the name in any case.
    """
    trimmed = {c: c.strip("\r\n ") for c in columns}
    for wanted in candidates:
        if mode == "exact":
            hits = [c for c in columns if c == wanted]
        elif mode == "normalized":
            hits = [c for c in columns if _name(c) == _name(wanted)]
        else:
            hits = [c for c, t in trimmed.items() if t.lower() == wanted.lower()]
            if mode == "contains" and not hits:
                hits = [c for c, t in trimmed.items() if wanted.lower() in t.lower()]
        if hits:
            return hits[0]
    return None


def rename_synonyms(df: DataFrame, synonyms: dict[str, list[str]]) -> DataFrame:
    """Columns under their canonical names; a canonical name that is there is not overwritten."""
    renames = {}
    for canonical, names in synonyms.items():
        if canonical in df.columns:
            continue
        found = resolve([c for c in df.columns if c not in renames], names, "ci")
        if found:
            renames[found] = canonical
    return df.withColumnsRenamed(renames)


def require(df: DataFrame, names: list[str], what: str = "table") -> DataFrame:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"{what}: missing columns {missing}")
    return df


@dataclass(frozen=True)
class Layout:
    """A fixed list of columns, and for some of them the columns they are taken from where they are missing."""

    columns: tuple[str, ...]
    sources: dict[str, tuple[str, ...]]
    #: Columns that are made from the source they are taken from.
    made: dict[str, Callable[[Column], Column]] = field(default_factory=dict)


# Columns of the listing layout, and where they are taken from.
LISTING = Layout(
    (
        "link_ficha", "make_clean", "modelo_base_x", "segmento", "year_bca", "mileage", "combustible_norm", "sale_name", "winning_bid",
        "precio_final_eur", "precio_venta_ganvam", "margin_abs", "vat_type", "units_abs_bcn", "units_abs_cat", "units_abs_esp", "YoY_weighted_esp",
    ),
    {
        "year_bca": ("year", "anio", "Año"),
        "mileage": ("km", "kilometros", "odometro"),
        "combustible_norm": ("fuel_type",),
        "modelo_base_x": ("modelo_base", "modelo_base_y", "modelo_base_match", "modelo"),
        "sale_name": ("auction_name",),
    },
)


# Columns of the query results' layout, and where they are taken from.
RESULTS = Layout(
    (
        "link_ficha", "make_clean", "modelo_base_x", "segmento", "year", "mileage", "combustible_norm", "auction_name", "winning_bid",
        "precio_final_eur", "precio_venta_ganvam", "margin_abs", "vat_type", "units_abs_bcn", "units_abs_cat", "units_abs_esp", "YoY_weighted_esp",
    ),
    {
        "auction_name": ("sale_name",),
        "year": ("anio", "Año", "year_bca"),
        "mileage": ("km", "kilometros", "kilómetros", "odometro", "odómetro"),
        "combustible_norm": ("fuel_type",),
        "modelo_base_x": ("modelo_base", "modelo_base_y", "modelo_base_match", "modelo"),
    },
    {"combustible_norm": fuel_label},
)


def conform(df: DataFrame, layout: Layout = LISTING) -> DataFrame:
    """The layout's columns in its order: as they are, from the first of their sources that is there, or null."""

    def pick(name: str):
        if name in df.columns:
            return F.col(f"`{name}`").alias(name)
        for c in layout.sources.get(name, ()):
            if c in df.columns:
                return layout.made.get(name, lambda x: x)(F.col(f"`{c}`")).alias(name)
        return F.lit(None).cast("string").alias(name)

    return df.select(*(pick(c) for c in layout.columns))


def drop_case_twins(df: DataFrame, names: tuple[str, ...] = ("MARCA", "MODELO")) -> DataFrame:
    """Without the columns whose names differ from another's by case alone; needs a case-sensitive session."""
    twins = [n for n in names if n in df.columns and any(c != n and c.lower() == n.lower() for c in df.columns)]
    return df.select(*(F.col(f"`{c}`") for c in df.columns if c not in twins))


def drop_empty(df: DataFrame, prefix: str = "Unnamed") -> DataFrame:
    """Without the columns of that prefix that hold no value; one aggregation over all of them."""
    names = [c for c in df.columns if c.startswith(prefix)]
    if not names:
        return df
    seen = df.agg(*(F.count(F.col(f"`{c}`")).alias(str(i)) for i, c in enumerate(names))).first()
    return df.drop(*(c for i, c in enumerate(names) if not seen[i]))


def text_cells(df: DataFrame) -> DataFrame:
    """Every cell as text."""
    from lotwise.functions.web import cell_text

    return df.select(*(cell_text(F.col(f"`{c}`"), kind).alias(c) for c, kind in df.dtypes))
