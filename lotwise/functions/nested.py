"""Nested JSON of unknown shape: blobs in scripts, all keys at any depth, labels of several languages under one name."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotwise.functions.canon import lookup
from lotwise.functions.text import lower_key

# Labels after folding, by field.
LABELS = {
    "bastidor": (
        "bastidor", "vin", "vehicle identification number", "num vin", "n vin", "chasis", "chassis", "chassis number", "numero de chasis", "n chasis", "rahmennummer", "fahrgestellnummer", "numero de chassis", "numero di telaio", "frame", "frame number",
    ),
    "caja cambios": (
        "caja de cambios", "transmision", "transmission", "gearbox", "gear box", "getriebe", "schaltgetriebe", "automatikgetriebe", "boite de vitesses", "cambio", "tipo de cambio", "tipo caja", "gear", "trans",
    ),
    "pais subasta": ("pais subasta", "sale country", "country", "land", "pays", "paese"),
    "ubicacion": ("ubicacion", "location", "locatie", "standort", "emplacement", "plaats", "ort", "lugar", "localizacion"),
}
# Fields of a vehicle in a page's data.
VEHICLE = {"make": "make", "model": "model", "fuel_type": "fuelType", "sale_country": "saleCountry", "sale_code": "saleCode", "lot": "lot"}
#: Levels of objects and arrays that a walk goes down.
DEPTH = 8
_ENTRY = "struct<at:array<int>,key:string,up:string,v:variant>"


def label_name(c: Column) -> Column:
    """The field that a label stands for, else the folded label itself."""
    key = lower_key(c)
    return lookup(key, {word: name for name, words in LABELS.items() for word in words}, key)


def blobs(html: Column, name: str = "digitalData") -> Column:
    """JSON texts that scripts push on an array or set it to, pushes first."""
    pushed = F.regexp_extract_all(html, F.lit(rf"(?is){name}\.push\(\s*(\{{.*?\}})\s*\)\s*;"), F.lit(1))
    first = F.regexp_extract_all(html, F.lit(rf"(?is)window\.{name}\s*=\s*(\[[^\]]*\]|\{{.*?\}});"), F.lit(1))
    return F.coalesce(F.concat(pushed, first), F.array().cast("array<string>"))


def _members(v: Column) -> Column:
    return F.try_variant_get(v, "$", "map<string,variant>")


def _below(e: Column) -> Column:
    """What an entry holds: an object's values by key (in the order of keys), an array's elements under the array's own key.

    An object with a label, name or key and a value gives that pair, too, ahead of its own keys.
    """
    members = _members(e["v"])
    own = F.transform(F.map_entries(members), lambda x, i: F.struct(F.concat(e["at"], F.array(i)).alias("at"), x["key"].alias("key"), e["key"].alias("up"), x["value"].alias("v")))
    texts = [F.nullif(F.try_variant_get(F.try_element_at(members, F.lit(k)), "$", "string"), F.lit("")) for k in ("label", "name", "key")]
    label, value = F.coalesce(*texts), F.try_element_at(members, F.lit("value"))
    pair = F.filter(F.array(F.struct(F.concat(e["at"], F.array(F.lit(-1))).alias("at"), label.alias("key"), F.lit("value").alias("up"), value.alias("v"))), lambda p: p["key"].isNotNull() & p["v"].isNotNull())
    items = F.transform(F.try_variant_get(e["v"], "$", "array<variant>"), lambda x, i: F.struct(F.concat(e["at"], F.array(i)).alias("at"), F.lit(None).cast("string").alias("key"), e["key"].alias("up"), x.alias("v")))
    return F.coalesce(F.concat(pair, own), items, F.array().cast(f"array<{_ENTRY}>")).cast(f"array<{_ENTRY}>")


def walked(df: DataFrame, json: str, out: str = "entries", depth: int = DEPTH) -> DataFrame:
    """``df`` with ``out``: (at, key, up, value) of every key at up to ``depth`` levels of an array of JSON texts, in the order of a walk that goes down first.

    ``at`` is the path of places from the text's number on, ``up`` the key above (an element of an array is under
    the array's), value the text of what is there, JSON for objects and arrays. ``out``_deeper says whether
    there is more below. Texts that are no JSON, null ones and empty arrays give no entries. All of it is in the row, level by
    level over arrays, so nothing is shuffled; a row needs memory for its own texts.
    """
    roots = F.transform(json, lambda t, i: F.struct(F.array(i).alias("at"), F.lit(None).cast("string").alias("key"), F.lit(None).cast("string").alias("up"), F.try_parse_json(t).alias("v")))
    rows = df.withColumn("__0", F.coalesce(F.filter(roots, lambda e: e["v"].isNotNull()), F.array()).cast(f"array<{_ENTRY}>"))
    for i in range(depth):
        # A pair stands for a value that the walk meets under its own key; it isn't gone down twice.
        rows = rows.withColumn(f"__{i + 1}", F.flatten(F.transform(F.filter(f"__{i}", lambda e: F.element_at(e["at"], -1) >= 0), _below)))
    deeper = F.exists(f"__{depth}", lambda e: (F.element_at(e["at"], -1) >= 0) & (F.size(_below(e)) > 0))
    all_ = F.flatten(F.array(*(F.transform(f"__{i}", lambda e: F.struct(e["at"].alias("at"), e["key"].alias("key"), e["up"].alias("up"), F.try_variant_get(e["v"], "$", "string").alias("value"))) for i in range(1, depth + 1))))
    rows = rows.withColumn(out, F.array_sort(F.filter(all_, lambda e: e["key"].isNotNull()))).withColumn(f"{out}_deeper", deeper)
    return rows.drop(*(f"__{i}" for i in range(depth + 1)))


def picked(entries: Column) -> Column:
    """The fields of ``LABELS`` as a struct: of each the last entry of a walk under one of its labels that isn't blank, nan or None."""
    def last(name: str) -> Column:
        hits = F.filter(entries, lambda e: (label_name(e["key"]) == name) & e["value"].isNotNull() & ~F.trim(e["value"]).isin("", "nan", "None"))
        return F.trim(F.try_element_at(hits, F.lit(-1))["value"])

    return F.struct(*(last(name).alias(name.replace(" ", "_")) for name in LABELS))


def labels(entries: Column, most: int = 8) -> Column:
    """The first different labels of a walk, under their fields' names."""
    return F.slice(F.array_distinct(F.filter(F.transform(entries, lambda e: label_name(e["key"])), lambda k: k != "")), 1, most)


def vehicle(entries: Column) -> Column:
    """The fields of ``VEHICLE`` of the last vehicle of a product, at any depth of a walk."""
    found = F.try_element_at(F.filter(entries, lambda e: (e["key"] == "vehicle") & (e["up"] == "product") & e["value"].startswith("{")), F.lit(-1))["value"]
    return F.struct(*(F.get_json_object(found, f"$.{path}").alias(name) for name, path in VEHICLE.items()))
