"""Canonical labels: fuels, gearboxes, bodies, countries, auctions, codes."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotwise.functions.text import blank_to_null, lower_key, plain_lower, upper_key

# Fuel labels after folding, by canonical fuel.
FUELS = {
    "electric": ("bev", "electric", "electrico", "electrica", "ev", "elc"),
    "phev": ("phev", "phevpetrol", "diesel y electrico", "gasolina y electrico", "dye", "gye"),
    "hev": ("hev", "hevdiesel", "hevpetrol", "hybrid", "hibrido", "hibrida", "mhevpetrol"),
    "diesel": ("diesel", "mhevdiesel", "d"),
    "petrol": ("petrol", "gasolina", "gasolina95", "gasolina98", "flexfuel", "cngpetrol", "g", "petrolethanol"),
    "cng": ("cng", "gnc", "gnl", "m"),
    "lpg": ("lpg", "glp", "s"),
    "hydrogen": ("hydrogen", "h2", "hidrogeno"),
}

# Labels of the ranking tables in upper case, accents as they are written, by short label.
FUEL_CODES = {
    "BEV": ("ELECTRICO", "ELÉCTRICO", "EV", "BEV"),
    "HEV": ("HIBRIDO", "HÍBRIDO", "HEV"),
    "PHEV": ("HÍBRIDO ENCHUFABLE", "HIBRIDO ENCHUFABLE", "PHEV"),
    "MHEV": ("MHEV",),
    "GLP": ("GLP",),
    "GNC": ("GNC",),
    "ICE": ("GASOLINA", "DIESEL", "DIÉSEL", "GASÓLEO", "ICE"),
    "FCEV": ("HIDROGENO", "HIDRÓGENO", "FCEV"),
}


def lookup(key: Column, values: dict, default: Column | None = None) -> Column:
    """The value of a literal map of at most a few hundred entries."""
    table = F.create_map(*chain.from_iterable((F.lit(k), F.lit(v)) for k, v in values.items()))
    found = F.try_element_at(table, key)
    return found if default is None else F.coalesce(found, default)


def _inverted(groups: dict[str, tuple[str, ...]]) -> dict[str, str]:
    return {word: name for name, words in groups.items() for word in words}


def fuel(c: Column) -> Column:
    """Canonical fuel; ``unknown`` for null and for labels without one."""
    return lookup(F.lower(upper_key(c)), _inverted(FUELS), F.lit("unknown"))


def fuel_aliased(c: Column, aliases: dict[str, str]) -> Column:
    """Fuel of an alias table; upper case as it is where there is none."""
    return lookup(lower_key(c), {k.lower(): v for k, v in aliases.items()}, F.upper(F.trim(c)))


def fuel_label(c: Column) -> Column:
    """BEV, DIESEL, GASOLINA, PHEV or HEV by the first whose pattern the label holds, else the label in upper case; empty for null."""
    low = F.lower(F.trim(F.coalesce(c, F.lit(""))))
    # Patterns by label, accents as they are written.
    return (
        F.when(low.rlike("bev|eléctr|electric"), "BEV")
        .when(low.rlike("diesel|diésel"), "DIESEL")
        .when(low.contains("gas") & low.contains("lina"), "GASOLINA")
        .when(low.rlike("phev|plug-in") | (low.contains("híbr") & low.contains("ench")), "PHEV")
        .when(low.rlike("hibr|hybrid"), "HEV")
        .otherwise(F.upper(low))
    )


def fuel_code(c: Column) -> Column:
    """Short label of a fuel in upper case; OTROS for null and for all others."""
    return lookup(F.upper(F.trim(c)), _inverted(FUEL_CODES), F.lit("OTROS"))


def fuel_bucket(c: Column) -> Column:
    """Fuel by patterns in the folded label, OTROS for none."""
    u = upper_key(c)
    # Patterns by fuel, in order.
    return (
        F.when(u.rlike("PHEV|PLUG"), "PHEV")
        .when(u.rlike("HEV|HIBRIDO|MHEV"), "HEV")
        .when(u.rlike("ELECTRICO|EV|BEV"), "BEV")
        .when(u.rlike("DIESEL|GASOIL"), "DIESEL")
        .when(u.rlike("GASOLINA|PETROL|BENZINA"), "GASOLINA")
        .otherwise("OTROS")
    )


def gearbox(c: Column) -> Column:
    """``automatic``, ``manual`` or the trimmed lower-case label."""
    low = F.lower(F.trim(c))
    return F.when(low.contains("auto"), "automatic").when(low.contains("man"), "manual").otherwise(low)


def region_code(c: Column) -> Column:
    u = upper_key(c)
    return (
        F.when(u.isin("BCN", "BARCELONA") | u.contains("BARCELONA"), "BCN")
        .when((u == "CAT") | u.contains("CATAL"), "CAT")
        .when(u.contains("ESP") | u.contains("NACIO") | u.contains("TOTAL"), "ESP")
        .otherwise(u)
    )


def sold(c: Column, legacy: bool = False) -> Column:
    """Whether a lot's status says it is sold; ``not sold`` doesn't unless ``legacy``."""
    low = F.lower(F.trim(F.coalesce(c, F.lit(""))))
    hit = low.rlike("sold|vendido|sale ended|closed")
    return hit if legacy else hit & ~low.rlike("\\b(not|no|un) ?-?(sold|vendido)")


def sold_exact(c: Column) -> Column:
    return F.coalesce(F.lower(F.trim(c)) == "sold", F.lit(False))


GENERIC_ORIGINS = ("", "eu", "ue", "europe", "europa", "nan", "none", "global")


def aliased(df: DataFrame, key: Column, table: DataFrame, table_key: str, value: str, out: str, default: Column) -> DataFrame:
    """``df`` with ``out``: the value that a small dimension table has for the folded key, or the default.

    The table has one row for each folded key (the least value where it has several).
    """
    dim = table.select(lower_key(F.col(table_key)).alias("__key"), F.col(value).alias("__value")).groupBy("__key").agg(F.min("__value").alias("__value"))
    joined = df.withColumn("__own", lower_key(key)).join(dim, F.col("__own") == F.col("__key"), "left")
    return joined.withColumn(out, F.coalesce("__value", default)).drop("__own", "__key", "__value")


def origin_country(df: DataFrame, country: str, place: str, countries: DataFrame, places: DataFrame, out: str = "origin") -> DataFrame:
    """Canonical country; where that is generic, the country of the place's head, as a place or as a country."""
    from lotwise.functions.text import location_head

    step = aliased(df, F.col(country), countries, "variant", "country_canonical", "__c", F.col(country))
    head = location_head(F.col(place))
    step = aliased(step, head, places, "location_head", "country_canonical", "__p", F.lit(None).cast("string"))
    step = aliased(step, head, countries, "variant", "country_canonical", "__h", head)
    generic = plain_lower(F.col("__c")).isin(*GENERIC_ORIGINS)
    return step.withColumn(out, F.when(generic, F.coalesce("__p", blank_to_null(F.col("__h")), F.col("__c"))).otherwise(F.col("__c"))).drop("__c", "__p", "__h")


def auction(c: Column, aliases: dict[str, str]) -> Column:
    """Canonical auction name: the alias, else by words of the name, else the trimmed name; ``Otros`` if blank."""
    key = lower_key(c)
    return F.coalesce(
        lookup(key, {k.lower(): v for k, v in aliases.items()}) if aliases else F.lit(None).cast("string"),
        F.when(key.rlike("\\b(online|digital)\\b"), F.lit("Online")),
        blank_to_null(c),
        F.lit("Otros"),
    )


def auction_confidence(c: Column, aliases: dict[str, str]) -> Column:
    key = lower_key(c)
    exact = key.isin(*(k.lower() for k in aliases)) if aliases else F.lit(False)
    return F.when(exact, 1.0).when(key.rlike("\\b(online|digital)\\b"), 0.6).when(key != "", 0.3).otherwise(0.0)


def is_electric(c: Column, table: dict[str, bool] | None = None) -> Column:
    known = lookup(lower_key(c), table) if table else F.lit(None).cast("boolean")
    return F.coalesce(known, lower_key(c).isin("electric", "ev", "bev"))


# Words of body styles.
BODY_WORDS = {"suv": "suv|estate|station|touring|allroad", "lcv": "van|furg|lcv|box|chasis|chassis|pickup|transporter"}


def body_category(*labels: Column, words: dict[str, list[str]] | None = None, patterns: list[tuple[str, str]] | None = None) -> Column:
    """passenger_car, suv or lcv: by configured words, then configured patterns, then common words."""
    text = plain_lower(F.concat_ws(" ", *labels))
    out = None
    rules = [(cat, "|".join(f"\\Q{w.lower()}\\E" for w in own if w)) for cat, own in (words or {}).items() if any(own)]
    rules += [(cat, f"(?i){p}") for p, cat in patterns or []]
    rules += list(BODY_WORDS.items())
    for cat, pattern in rules:
        out = F.when(text.rlike(pattern), cat) if out is None else out.when(text.rlike(pattern), cat)
    return out.otherwise("passenger_car")


# Codes of the registration files.
REGISTRY_FUELS = {"0": "Gasolina", "1": "Diesel", "2": "Electrico", "3": "Otros", "4": "Butano", "5": "Solar", "6": "Gas Licuado de Petroleo", "7": "Gas Natural Comprimido", "8": "Gas Natural Licuado", "9": "Hidrogeno", "A": "Biometano", "B": "Etanol", "C": "Biodiesel"}
REGISTRY_TYPES = {"40": "Turismo", "50": "Motocicleta", "20": "Furgoneta", "25": "Todoterreno", "90": "Ciclomotor"}


def registry_fuel(code: Column) -> Column:
    return lookup(F.upper(F.trim(code)), REGISTRY_FUELS, F.lit("Otros"))


def registry_type(code: Column) -> Column:
    return lookup(F.trim(code), REGISTRY_TYPES, F.lit("Otros"))


def longest_prefix(c: Column, table: dict[str, str]) -> Column:
    """The value of the longest run of leading words that the table has."""
    words = F.split(F.upper(F.trim(c)), "\\s+")
    most = max((k.count(" ") + 1 for k in table), default=1)
    tries = [lookup(F.array_join(F.slice(words, 1, n), " "), {k.upper(): v for k, v in table.items()}) for n in range(most, 0, -1)]
    return F.coalesce(*tries)
