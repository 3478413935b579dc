"""Market aggregates and features of registrations by make, model, year, fuel and place."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lotwise.functions.canon import fuel, fuel_bucket, lookup
from lotwise.functions.numbers import add_months, no_nan, padded_code, parse_date, ratio, registration_year, year_of
from lotwise.functions.text import upper_key
from lotwise.operators.columns import rename_synonyms, resolve
from lotwise.operators.filters import vehicle_types

KEYS = ["marca", "modelo", "anio", "combustible", "provincia", "codigo", "yyyymm"]
COHORT = ["region", "marca", "modelo", "anio", "combustible"]

# Names under which the files bring their columns.
SYNONYMS = {
    "marca": ["MARCA", "make", "marca_itv"],
    "modelo": ["MODELO", "model", "modelo_itv"],
    "fecha_mat": ["FEC_MATRICULA", "fecha_matriculacion", "fecha"],
    "combustible": ["COD_PROPULSION", "propulsion", "fuel"],
    "provincia": ["PROVINCIA", "province"],
    "codigo_ine": ["COD_INE", "codigo_municipio", "ine"],
    "codigo_provincia": ["COD_PROVINCIA", "cod_prov"],
    "tipo_vehiculo": ["COD_TIPO", "tipo"],
    "antiguedad_anios": ["antiguedad", "age_years"],
}


def standardized(df: DataFrame, brands: DataFrame | None = None, fuels: DataFrame | None = None, period: int | None = None) -> DataFrame:
    """Transfer records in the engine's columns.

    Both sides of the brand and the fuel map go through the same folding. A fuel
    that the map doesn't have is OTROS; without a map fuels are found by patterns. The registration year is the
    first of date, own year column and period; codes keep their leading zeros.
    """
    t = rename_synonyms(df, SYNONYMS)
    has = lambda c: c in t.columns
    text = lambda c: F.col(c) if has(c) else F.lit(None).cast("string")
    date = parse_date(text("fecha_mat"))
    code = padded_code(text("codigo_ine"), 5)
    t = t.select(
        upper_key(text("marca")).alias("marca_key"),
        upper_key(text("modelo")).alias("modelo"),
        upper_key(text("combustible")).alias("fuel_key"),
        text("combustible").alias("fuel_raw"),
        upper_key(text("provincia")).alias("provincia"),
        code.alias("codigo_ine"),
        F.coalesce(padded_code(text("codigo_provincia"), 2), F.substring(code, 1, 2)).alias("codigo"),
        text("tipo_vehiculo").alias("tipo_vehiculo"),
        no_nan(text("antiguedad_anios").try_cast("double")).alias("antiguedad_anios"),
        date.alias("fecha"),
        F.coalesce(text("yyyymm").try_cast("long"), F.lit(period).cast("long"), F.date_format(date, "yyyyMM").try_cast("long")).alias("yyyymm"),
        text("anio").alias("anio_raw"),
    )
    t = t.withColumn("anio", registration_year(F.year("fecha"), F.col("anio_raw"), year_of(F.col("yyyymm"))).cast("long"))
    if brands is not None:
        b = brands.select(upper_key(F.col("alias")).alias("marca_key"), upper_key(F.col("canonical")).alias("__b")).groupBy("marca_key").agg(F.min("__b").alias("__b"))
        t = t.join(b, "marca_key", "left").withColumn("marca", F.coalesce("__b", "marca_key")).drop("__b")
    else:
        t = t.withColumn("marca", F.col("marca_key"))
    if fuels is not None:
        m = fuels.select(upper_key(F.col("alias")).alias("fuel_key"), F.col("canonical").alias("__f")).groupBy("fuel_key").agg(F.min("__f").alias("__f"))
        t = t.join(m, "fuel_key", "left").withColumn("combustible", F.coalesce("__f", F.lit("OTROS"))).drop("__f")
    else:
        t = t.withColumn("combustible", fuel_bucket(F.col("fuel_raw")))
    return t.drop("marca_key", "fuel_key", "fuel_raw", "anio_raw", "fecha")


def aggregate_month(df: DataFrame, keys: list[str] = KEYS, age: str = "antiguedad_anios", types: list[str] = (), units: Column | None = None) -> DataFrame:
    """Units, mean and quartiles of age, and shares of ages up to 3, over 3 to 7 and over 7, for each key of a known month.

    Quartiles are linear; shares are of all rows and rounded to two places.
    """
    rows = df.where(F.col("yyyymm").isNotNull())
    if types and "tipo_vehiculo" in df.columns:
        rows = vehicle_types(rows, list(types))
    a = F.col(age)
    n = F.count(F.lit(1))
    part = lambda test: F.round(100 * F.count_if(test) / n, 2)
    return rows.groupBy(*keys).agg(
        (n if units is None else F.sum(units)).alias("unidades"),
        F.avg(a).alias("antiguedad_media"),
        F.percentile(a, 0.25).alias("p25_antiguedad"),
        F.percentile(a, 0.5).alias("p50_antiguedad"),
        F.percentile(a, 0.75).alias("p75_antiguedad"),
        part(a <= 3).alias("%_0_3"),
        part((a > 3) & (a <= 7)).alias("%_4_7"),
        part(a > 7).alias("%_8_mas"),
    )


def add_yoy(df: DataFrame, keys: list[str] = KEYS, period: str = "yyyymm", units: str = "unidades", legacy: bool = False) -> DataFrame:
    """``df`` with the units of the same key a year before and the change in percent.

    legacy: the sign of the shift turned round, so the year after is compared.
    """
    others = [k for k in keys if k != period]
    before = df.groupBy(*others, add_months(F.col(period), -12 if legacy else 12).alias(period)).agg(F.sum(units).alias("unidades_prev"))
    change = F.round(100 * F.try_divide(F.col(units) - F.col("unidades_prev"), F.col("unidades_prev")), 2)
    return df.join(before, keys, "left").withColumn("YoY_unidades_%", change)


def add_shares(df: DataFrame, units: str = "unidades", province: str = "codigo", period: str = "yyyymm") -> DataFrame:
    """``df`` with the share of each row in its province's and in the nation's month, in percent."""
    local, whole = Window.partitionBy(period, province), Window.partitionBy(period)
    share = lambda w: F.round(100 * F.try_divide(F.col(units), F.sum(units).over(w)), 3)
    return df.withColumn("share_prov_%", share(local)).withColumn("share_esp_%", share(whole))


def summaries(df: DataFrame, start: int, end: int, place: str | None = None, top: int = 20) -> dict[str, DataFrame]:
    """Total, leading makes and models, provinces, fuels, the fuel mix by province, and a place's leaders, of a span of months."""
    rows = df.where(F.col("yyyymm").between(start, end))
    total = lambda *keys: rows.groupBy(*keys).agg(F.sum("unidades").alias("unidades"))
    ranked = lambda frame, *keys: frame.orderBy(F.desc("unidades"), *keys).limit(top)
    mix = total("provincia", "combustible").withColumn("mix_%", F.round(100 * F.try_divide(F.col("unidades"), F.sum("unidades").over(Window.partitionBy("provincia"))), 2))
    out = {
        "kpi_total": rows.agg(F.coalesce(F.sum("unidades"), F.lit(0)).alias("unidades")),
        "top_marcas": ranked(total("marca"), "marca"),
        "top_modelos": ranked(total("marca", "modelo"), "marca", "modelo"),
        "provincias": total("provincia").orderBy(F.desc("unidades"), "provincia"),
        "combustibles": total("combustible").orderBy(F.desc("unidades"), "combustible"),
        "mix": mix.orderBy("provincia", F.desc("mix_%"), "combustible"),
    }
    if place:
        here = rows.where(upper_key(F.col("provincia")) == upper_key(F.lit(place)))
        out["focus_marcas"] = ranked(here.groupBy("marca").agg(F.sum("unidades").alias("unidades")), "marca")
        out["focus_modelos"] = ranked(here.groupBy("marca", "modelo").agg(F.sum("unidades").alias("unidades")), "marca", "modelo")
    return out


#: Tables of a period with their keys; ``focus`` marks the rows of one place.
SUMMARIES = {
    "kpi": (),
    "rank_marcas": ("marca",),
    "rank_modelos": ("modelo",),
    "rank_provincias": ("provincia",),
    "rank_combustible": ("combustible",),
    "rank_marcas_focus": ("focus", "marca"),
    "rank_modelos_focus": ("focus", "modelo"),
    "mix_comb_prov": ("provincia", "combustible"),
}
#: Tables that end after ``top`` rows.
LEADERS = ("rank_marcas", "rank_modelos", "rank_marcas_focus", "rank_modelos_focus")


def summary_set(df: DataFrame, start: int, end: int, place: str, top: int = 20, units: str = "unidades") -> DataFrame:
    """(tabla, posicion, marca, modelo, provincia, combustible, unidades, share_prov): all summaries of a span of months.

    One scan: units are summed by all keys, and the sums again over one grouping set for each table, told apart
    by its grouping id, so null keys stay keys. Places are by descending units, ties by the keys, nulls
    last; leaders end after ``top``. The mix has its share in the province and goes by province, then share.
    A span without a row gives no rows.
    """
    keys = ["marca", "modelo", "provincia", "combustible"]
    focus = F.coalesce(F.upper(F.trim("provincia")) == place.strip().upper(), F.lit(False))
    cells = df.where(F.col("yyyymm").between(start, end)).groupBy(*keys).agg(F.sum(units).alias("u")).withColumn("focus", focus)
    all_keys = [*keys, "focus"]
    sets = cells.groupingSets([[F.col(k) for k in own] for own in SUMMARIES.values()], *(F.col(k) for k in all_keys)).agg(F.grouping_id(*all_keys).alias("id"), F.sum("u").alias("unidades"))
    number = {name: sum(1 << (len(all_keys) - 1 - i) for i, k in enumerate(all_keys) if k not in own) for name, own in SUMMARIES.items()}
    tables = sets.withColumn("tabla", lookup(F.col("id"), {v: k for k, v in number.items()})).where(F.coalesce("focus", F.lit(True)))
    share = F.round(100 * F.try_divide(F.col("unidades"), F.sum("unidades").over(Window.partitionBy("tabla", "provincia"))), 2)
    tables = tables.withColumn("share_prov", F.when(F.col("tabla") == "mix_comb_prov", share))
    mixed = F.when(F.col("tabla") == "mix_comb_prov", F.col("provincia"))
    order = [mixed.asc_nulls_last(), F.desc("share_prov"), F.desc("unidades"), *(F.asc_nulls_last(k) for k in keys)]
    placed = tables.withColumn("posicion", F.row_number().over(Window.partitionBy("tabla").orderBy(*order)))
    return placed.where(~F.col("tabla").isin(*LEADERS) | (F.col("posicion") <= top)).select("tabla", "posicion", *keys, "unidades", "share_prov")


def support(df: DataFrame, keys: list[str], least: int = 10) -> DataFrame:
    return df.groupBy(*keys).agg(F.sum("unidades").alias("unidades")).withColumn("low_support", F.col("unidades") < least)


def bounds(df: DataFrame, period: str = "yyyymm") -> DataFrame:
    return df.agg(F.min(period).alias("first"), F.max(period).alias("last"), F.count_if(F.col(period).isNull()).alias("n_null"))


def by_region(df: DataFrame, inner: Column, middle: Column, names: tuple[str, str, str] = ("BCN", "CAT", "ESP")) -> DataFrame:
    """Each row once for every nested region that it is in; one pass instead of three unions.

    Sums are additive over rows, so aggregate before this where that is possible.
    """
    every = F.array(F.when(inner, names[0]), F.when(inner | middle, names[1]), F.lit(names[2]))
    return df.withColumn("region", F.explode(F.array_compact(every)))


def normalized_places(df: DataFrame, places: DataFrame) -> DataFrame:
    """Aggregates by place code with the province of the code; a code that the places lack has none.

    Raises at run time on a code that is not a number of up to five digits.
    """
    code = padded_code(F.col("codigo_ine"), 5)
    checked = F.when(F.col("codigo_ine").isNotNull() & code.isNull(), F.raise_error(F.concat(F.lit("bad place code: "), F.col("codigo_ine").cast("string")))).otherwise(code)
    dim = places.select(padded_code(F.col("codigo_ine"), 5).alias("codigo_ine"), upper_key(F.col("provincia")).alias("provincia_norm")).distinct()
    return df.withColumn("codigo_ine", checked).join(dim, "codigo_ine", "left")


def normalized_lots(df: DataFrame) -> DataFrame:
    """Keys of auction lots: folded make and model, registration year, canonical fuel."""
    names = {k: resolve(df.columns, v) for k, v in {"marca": ["make_clean", "make", "marca"], "modelo": ["modelo_base_y", "modelo_base", "modelo", "model"], "fecha": ["Fecha Matriculación", "fecha_matriculacion", "fecha"], "fuel": ["fuel_type", "combustible"]}.items()}
    missing = [k for k, v in names.items() if v is None]
    if missing:
        raise ValueError(f"lots: missing columns for {missing}")
    col = lambda k: F.col(f"`{names[k]}`")
    date = parse_date(col("fecha"))
    return df.withColumns({"marca": upper_key(col("marca")), "modelo": upper_key(col("modelo")), "fecha_matriculacion": date, "anio": F.year(date).cast("long"), "combustible_norm": fuel(col("fuel"))})


def trends(annual: DataFrame, by_calendar: bool = False) -> DataFrame:
    """Growth against the year before and three years before, damped growth, a flag of +-10 %, and the rank of the year.

    Years are those that the cohort has; ``by_calendar`` compares calendar years instead.
    """
    key = ["region", "marca", "modelo", "combustible"]
    if by_calendar:
        w = Window.partitionBy(*key).orderBy("anio")
        back = lambda n: F.first("units_abs").over(w.rangeBetween(-n, -n))
    else:
        w = Window.partitionBy(*key).orderBy("anio")
        back = lambda n: F.lag("units_abs", n).over(w)
    rows = annual.withColumn("units_prev", back(1)).withColumn("units_prev3", back(3))
    growth = lambda prev: F.when(F.coalesce(F.col(prev), F.lit(0)) != 0, (F.col("units_abs") - F.col(prev)) / F.col(prev))
    rows = rows.withColumn("YoY_%", growth("units_prev")).withColumn("Growth_3a_%", growth("units_prev3"))
    rows = rows.withColumn("YoY_weighted", F.col("YoY_%") * F.least(F.lit(1.0), F.coalesce(F.col("units_prev"), F.lit(0)) / 20.0))
    rows = rows.withColumn("trend_flag", F.when(F.col("YoY_%") > 0.10, 1).when(F.col("YoY_%") < -0.10, 0))
    rank = F.dense_rank().over(Window.partitionBy(*key).orderBy(F.desc_nulls_last("units_abs")))
    return rows.withColumn("year_rank_in_model", rank.cast("long"))


def stability(df: DataFrame) -> DataFrame:
    """Spread of the monthly units of a cohort: sample deviation, mean, months, and their ratio."""
    monthly = df.where(F.col("yyyymm").isNotNull()).groupBy(*COHORT, "yyyymm").agg(F.sum("unidades").alias("u"))
    found = monthly.groupBy(*COHORT).agg(F.stddev_samp("u").alias("stddev_mensual_units"), F.avg("u").alias("mean_mensual_units"), F.count("u").alias("meses_observados"))
    return found.withColumn("coef_var_%", F.try_divide(F.col("stddev_mensual_units"), F.col("mean_mensual_units")))


def annual(df: DataFrame) -> DataFrame:
    return df.groupBy(*COHORT).agg(F.sum("unidades").alias("units_abs"))


def _known(*keys: str) -> Column:
    test = F.lit(True)
    for k in keys:
        test = test & F.col(k).isNotNull()
    return test


def features(df: DataFrame) -> DataFrame:
    """Features of each cohort (region, make, model, year, fuel) of normalized regional rows.

    Totals, ranks, shares, best fuel and concentration are windows over the annual sums;
    cohorts with a null in a total's key have no total and share zero. Monthly spread and
    ages join by the cohort, null-safe.
    """
    a = annual(df)
    models = a.groupBy("region", "marca", "modelo", "anio").agg(F.sum("units_abs").alias("units_model_year"))
    make_year = Window.partitionBy("region", "marca", "anio")
    models = models.withColumns({
        "total_marca_year": F.when(_known("marca", "anio"), F.sum("units_model_year").over(make_year)),
        "rank_general": F.dense_rank().over(Window.partitionBy("region", "anio").orderBy(F.desc_nulls_last("units_model_year"))).cast("long"),
        "rank_brand_year": F.dense_rank().over(make_year.orderBy(F.desc_nulls_last("units_model_year"))).cast("long"),
    })
    share = ratio(F.col("units_model_year"), F.col("total_marca_year"))
    models = models.withColumn("dominancia_modelo_marca_%", share).withColumn("is_top3_brand_year", (F.col("rank_brand_year") <= 3).cast("int"))
    models = models.withColumn("HHI_marca", F.when(_known("marca", "anio"), F.sum(F.pow("dominancia_modelo_marca_%", F.lit(2))).over(make_year)))
    t = trends(a)
    cell = Window.partitionBy("region", "anio", "combustible")
    model_year = Window.partitionBy("region", "marca", "modelo", "anio")
    t = t.withColumns({
        "total_combustible_year": F.when(_known("anio", "combustible"), F.sum("units_abs").over(cell)),
        "total_year": F.when(_known("anio"), F.sum("units_abs").over(Window.partitionBy("region", "anio"))),
        "rank_year_fuel_model": F.dense_rank().over(cell.orderBy(F.desc_nulls_last("units_abs"))).cast("long"),
        "best_fuel": F.first("combustible", ignorenulls=True).over(model_year.orderBy(F.desc_nulls_last("units_abs"), "combustible").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)),
        "best_fuel_units": F.max("units_abs").over(model_year),
    })
    m = models.select(*(F.col(k).alias(f"m_{k}") for k in ("region", "marca", "modelo", "anio")), "total_marca_year", "rank_general", "rank_brand_year", "is_top3_brand_year", "dominancia_modelo_marca_%", "HHI_marca")
    on = [F.col(k).eqNullSafe(F.col(f"m_{k}")) for k in ("region", "marca", "modelo", "anio")]
    joined = t.join(m, on, "left").drop("m_region", "m_marca", "m_modelo", "m_anio")
    s = stability(df).select(*(F.col(k).alias(f"s_{k}") for k in COHORT), "stddev_mensual_units", "coef_var_%")
    joined = joined.join(s, [F.col(k).eqNullSafe(F.col(f"s_{k}")) for k in COHORT], "left").drop(*(f"s_{k}" for k in COHORT))
    joined = ages(joined, df)
    return joined.withColumns({
        "share_marca_%": ratio(F.col("units_abs"), F.col("total_marca_year")),
        "share_combustible_%": ratio(F.col("units_abs"), F.col("total_combustible_year")),
        "share_cohorte_%": ratio(F.col("units_abs"), F.col("total_combustible_year")),
        "share_año_%": ratio(F.col("units_abs"), F.col("total_year")),
        "is_best_fuel": (F.col("combustible") == F.col("best_fuel")).cast("int"),
        "row_vs_best_fuel_%": ratio(F.col("units_abs"), F.col("best_fuel_units"), zero=False),
    }).drop("units_prev", "units_prev3")


def ages(cohorts: DataFrame, df: DataFrame) -> DataFrame:
    """``cohorts`` with the mean age columns of the cohort, and the mix of ages of the model over all its years, weighted by units."""
    age = [c for c in ("antiguedad_media", "p50_antiguedad", "p75_antiguedad") if c in df.columns]
    mix = [c for c in ("mix_0_3_%", "mix_4_7_%", "mix_8mas_%") if c in df.columns]
    if age:
        a = df.groupBy(*(F.col(k).alias(f"a_{k}") for k in COHORT)).agg(*(F.avg(c).alias(c) for c in age))
        cohorts = cohorts.join(a, [F.col(k).eqNullSafe(F.col(f"a_{k}")) for k in COHORT], "left").drop(*(f"a_{k}" for k in COHORT))
    if mix:
        key = ["region", "marca", "modelo", "combustible"]
        weighted = lambda c: 100 * F.try_divide(F.sum(F.col("unidades") * F.coalesce(F.col(c), F.lit(0.0)) / 100), F.sum("unidades"))
        m = df.groupBy(*(F.col(k).alias(f"x_{k}") for k in key)).agg(*(weighted(c).alias(c) for c in mix))
        cohorts = cohorts.join(m, [F.col(k).eqNullSafe(F.col(f"x_{k}")) for k in key], "left").drop(*(f"x_{k}" for k in key))
    return cohorts


def without_fuel(f: DataFrame) -> DataFrame:
    """Features of a model and year over all fuels: sums, values that all fuels share, and means."""
    shared = ["total_marca_year", "total_year", "rank_general", "rank_brand_year", "is_top3_brand_year", "dominancia_modelo_marca_%", "HHI_marca", "best_fuel_units", "best_fuel"]
    means = [c for c in ("antiguedad_media", "p50_antiguedad", "p75_antiguedad", "stddev_mensual_units", "coef_var_%") if c in f.columns]
    out = f.groupBy("region", "marca", "modelo", "anio").agg(F.sum("units_abs").alias("units_abs"), *(F.max(c).alias(c) for c in shared), *(F.avg(c).alias(c) for c in means))
    return out.withColumns({
        "share_marca_%": ratio(F.col("units_abs"), F.col("total_marca_year")),
        "share_año_%": ratio(F.col("units_abs"), F.col("total_year")),
        "row_vs_best_fuel_%": ratio(F.col("units_abs"), F.col("best_fuel_units"), zero=False),
    })
