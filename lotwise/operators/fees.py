"""Auction fees by banded rules of country, sale and component."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lotwise.functions.numbers import number, to_euros
from lotwise.functions.text import plain_lower

COMPONENTS = ("adquisicion", "exportacion", "documentos", "tramitacion", "diagnostico")
GLOBAL = ("europa", "europe", "todos", "all", "global", "")
ANY_SALE = ("otros", "other", "")


def rules(df: DataFrame) -> DataFrame:
    """A rule table in the engine's columns, with an explicit order; names are folded, numbers read."""
    text = lambda c: plain_lower(F.col(c)) if c in df.columns else F.lit("")
    value = lambda c: number(F.col(c)) if c in df.columns else F.lit(None).cast("double")
    currency = F.coalesce(*(F.nullif(F.upper(F.trim(F.col(c))), F.lit("")) for c in ("moneda_origen_valor", "moneda") if c in df.columns), F.lit("EUR"))
    out = df.select(
        text("pais").alias("scope"),
        text("categoria").alias("component"),
        text("subasta_o_tipo").alias("sale"),
        value("precio_min").alias("low"),
        value("precio_max").alias("high"),
        text("tasa_unidad").alias("unit"),
        value("tasa_valor").alias("fee"),
        value("importe_minimo").alias("least"),
        currency.alias("currency"),
        *([F.col("orden").cast("long").alias("ord")] if "orden" in df.columns else []),
    )
    if "ord" not in out.columns:  # a table of some hundred rules
        out = out.withColumn("ord", F.row_number().over(Window.orderBy("scope", "component", "sale", F.asc_nulls_first("low"), F.asc_nulls_first("high"), "fee")).cast("long"))
    return out


def amount(price: Column, rule: Column) -> Column:
    """The fee of a rule for a price, in euros: a percentage with its minimum, or a fixed sum."""
    part = F.greatest(rule["fee"] * price / 100, F.coalesce(rule["least"], F.lit(0.0)))
    return F.when(rule["unit"].isin("%", "porcentaje", "percent"), part).otherwise(to_euros(rule["fee"], rule["currency"]))


def band(price: Column, rule: Column) -> Column:
    """Order of the bands: finite and around the price, the smallest span first; then the nearest lower bound below;
    then the nearest above; then unbounded; then any."""
    low, high, none = rule["low"], rule["high"], F.lit(0.0)
    return (
        F.when((price >= low) & (price <= high), F.struct(F.lit(0).alias("t"), (high - low).alias("a"), low.alias("b")))
        .when(low <= price, F.struct(F.lit(1).alias("t"), (-low).alias("a"), none.alias("b")))
        .when(low > price, F.struct(F.lit(2).alias("t"), low.alias("a"), none.alias("b")))
        .when(low.isNull() & high.isNull(), F.struct(F.lit(3).alias("t"), none.alias("a"), none.alias("b")))
        .otherwise(F.struct(F.lit(4).alias("t"), none.alias("a"), none.alias("b")))
    )


def _with_rules(lots: DataFrame, table: DataFrame, price: str, country: str, sale: str) -> DataFrame:
    """``lots`` with the price, the folded sale and the rules that may hold, each with how far its scope is: no row is multiplied or moved."""
    rule = F.struct("component", "scope", "sale", "low", "high", "unit", "fee", "least", "currency", "ord")
    own = table.groupBy(F.col("scope").alias("__scope")).agg(F.collect_list(rule).alias("__own"))
    wide = table.where(F.col("scope").isin(*GLOBAL)).agg(F.collect_list(rule).alias("__wide")).withColumn("__one", F.lit(1))
    out = lots.withColumns({"__p": F.col(price).cast("double"), "__c": plain_lower(F.col(country)), "__s": plain_lower(F.col(sale)), "__one": F.lit(1)})
    out = out.join(F.broadcast(own), F.col("__c") == F.col("__scope"), "left").join(F.broadcast(wide), "__one", "left")  # some hundred rules in all
    near = F.transform(F.coalesce("__own", F.array()), lambda r: F.struct(F.lit(0).alias("far"), r.alias("rule")))
    far = F.transform(F.filter("__wide", lambda r: ~r["scope"].eqNullSafe(F.col("__c"))), lambda r: F.struct(F.lit(1).alias("far"), r.alias("rule")))
    return out.withColumn("__rules", F.concat(near, far)).drop("__own", "__wide", "__scope", "__one")


def _chosen(component: str) -> Column:
    """The first of the rules for a component: (far, sale tier, band, order, rule); null without one."""

    def order(x: Column) -> Column:
        rule = x["rule"]
        tier = F.when(rule["sale"].isin(*ANY_SALE), 1).otherwise(2)
        if component == "adquisicion":
            tier = F.when(rule["sale"] == F.col("__s"), 0).otherwise(tier)
        return F.struct(x["far"].alias("far"), tier.alias("tier"), band(F.col("__p"), rule).alias("band"), rule["ord"].alias("ord"), rule.alias("rule"))

    mine = F.filter("__rules", lambda x: x["rule"]["component"] == component)
    return F.when(F.col("__p").isNotNull(), F.array_min(F.transform(mine, order)))


# A sale of electric vehicles alone takes the country's rules in this country only.
ELECTRIC_SALE, OWN_RULES = "bev", "dinamarca"


def _older(component: str) -> Column:
    """As ``_chosen`` in the older way: the rules of the lot's sale, else those for any sale, else all, are tried alone; of
    those around the price unbounded ones come first, then the order. The global rules stand in for the country's
    where these give no fee for acquisition, and for all components of sales of electric vehicles outside OWN_RULES."""
    price, own = F.col("__p"), F.col("__s")

    def among(far: int) -> Column:
        mine = F.filter("__rules", lambda x: (x["rule"]["component"] == component) & (x["far"] == far))
        exact, open_ = F.filter(mine, lambda x: x["rule"]["sale"] == own), F.filter(mine, lambda x: x["rule"]["sale"].isin(*ANY_SALE))
        tier = F.when(F.size(exact) > 0, 0).when(F.size(open_) > 0, 1).otherwise(2)
        tried = F.when(F.size(exact) > 0, exact).when(F.size(open_) > 0, open_).otherwise(mine)
        fits = F.filter(tried, lambda x: F.coalesce(price >= x["rule"]["low"], F.lit(True)) & F.coalesce(price <= x["rule"]["high"], F.lit(True)))
        first = F.array_min(F.transform(fits, lambda x: F.struct((x["rule"]["low"].isNotNull() | x["rule"]["high"].isNotNull()).alias("bounded"), x["rule"]["ord"].alias("ord"), x["rule"].alias("rule"))))
        return F.when(first.isNotNull(), F.struct(F.lit(far).alias("far"), tier.alias("tier"), first["rule"].alias("rule")))

    near, far = among(0), among(1)
    chosen = F.when(amount(price, near["rule"]) > 0, near).otherwise(far) if component == "adquisicion" else near
    return F.when(price.isNotNull(), F.when((own == ELECTRIC_SALE) & (F.col("__c") != OWN_RULES), far).otherwise(chosen))


def _scope(best: Column) -> Column:
    return F.when(best["far"] == 0, best["rule"]["scope"]).otherwise("global")


def _sale(best: Column) -> Column:
    return F.when(best["tier"] == 0, F.col("__s")).otherwise("otros")


def lookup(lots: DataFrame, key: str, table: DataFrame, price: str, country: str, sale: str, components: tuple[str, ...] = COMPONENTS, legacy: bool = False) -> DataFrame:
    """(key, component, fee_eur, scope_used, sale_used, low, high, unit, fee): the rule for each lot and component.

    The country's rules come before the global ones; of these, for acquisition the lot's own sale, then
    the rules for any sale, then all; for the others any sale, then all; then the
    order of bands. The rules (some hundred) come to the lots as arrays, and each row picks its own: nothing is shuffled.
    legacy: the older choice of rules (see ``_older``).
    """
    rows = _with_rules(lots.select(F.col(key).alias("__k"), F.col(price).alias("__price"), F.col(country).alias("__country"), F.col(sale).alias("__sale")), table, "__price", "__country", "__sale")
    each = F.array(*(F.struct(F.lit(c).alias("component"), (_older(c) if legacy else _chosen(c)).alias("best")) for c in components))
    one = rows.select("__k", "__p", "__s", F.explode(each).alias("x")).select("__k", "__p", "__s", "x.component", "x.best").where("best is not null")
    best = F.col("best")
    return one.select(F.col("__k").alias(key), "component", amount(F.col("__p"), best["rule"]).alias("fee_eur"), _scope(best).alias("scope_used"), _sale(best).alias("sale_used"), "best.rule.low", "best.rule.high", "best.rule.unit", "best.rule.fee")


def bundle(lots: DataFrame, key: str, table: DataFrame, price: str, country: str, sale: str, electric: str | None = None, sold: str | None = None, legacy: bool = False) -> DataFrame:
    """(key, commission_<component>_eur ..., commission_total_eur, rules, error): all components of each lot in one row.

    Diagnosis applies to electric vehicles alone; lots that aren't sold have a total
    of zero. ``rules`` is a map from component to what was used; ``error`` names the components without a rule.
    legacy: the older choice of rules (see ``_older``), and the error says whether acquisition has a fee.
    """
    names = {"__k": F.col(key), "__price": F.col(price), "__country": F.col(country), "__sale": F.col(sale)}
    names |= {"__electric": F.coalesce(F.col(electric), F.lit(False))} if electric is not None else {}
    names |= {"__sold": F.col(sold)} if sold is not None else {}
    rows = _with_rules(lots.select(*(c.alias(n) for n, c in names.items())), table, "__price", "__country", "__sale")
    for c in COMPONENTS:
        best = _older(c) if legacy else _chosen(c)
        if sold is not None:
            best = F.when(F.col("__sold"), best)
        if electric is not None and c == "diagnostico":
            best = F.when(F.col("__electric"), best)
        rows = rows.withColumn(f"__{c}", best)
    bound = lambda c: F.coalesce(c.cast("string"), F.lit(""))

    def used(best: Column) -> Column:
        rule = best["rule"]
        return F.concat_ws("|", _scope(best), _sale(best), F.concat(F.lit("["), bound(rule["low"]), F.lit(","), bound(rule["high"]), F.lit("]")), rule["unit"], rule["fee"].cast("string"))

    entries = F.array_compact(F.array(*(F.when(F.col(f"__{c}").isNotNull(), F.struct(F.lit(c).alias("component"), used(F.col(f"__{c}")).alias("used"))) for c in sorted(COMPONENTS))))
    out = rows.select(
        F.col("__k").alias(key), *([F.col("__sold").alias(sold)] if sold else []),
        *(F.when(F.col(f"__{c}").isNotNull(), amount(F.col("__p"), F.col(f"__{c}")["rule"])).alias(f"commission_{c}_eur") for c in COMPONENTS),
        F.when(F.size(entries) > 0, F.map_from_entries(entries)).alias("rules"),
    )
    total = sum((F.coalesce(F.col(f"commission_{c}_eur"), F.lit(0.0)) for c in COMPONENTS[1:]), F.coalesce(F.col(f"commission_{COMPONENTS[0]}_eur"), F.lit(0.0)))
    wanted = [c for c in COMPONENTS if c in ("adquisicion", "exportacion", "documentos")]
    lacking = F.array_compact(F.array(*(F.when(F.col(f"commission_{c}_eur").isNull(), F.lit(f"sin_regla_{c}")) for c in wanted)))
    error = F.when(F.coalesce(F.col("commission_adquisicion_eur"), F.lit(0.0)) <= 0, "sin_adquisicion_valida").otherwise("") if legacy else F.array_join(lacking, ";")
    if sold:
        error = F.when(F.col(sold), error).otherwise("")
    return out.withColumn("commission_total_eur", total).withColumn("error", error)


def as_json(bundled: DataFrame) -> DataFrame:
    return bundled.withColumn("commission_rules_json", F.to_json("rules")).drop("rules")
