"""Queries over the driver's tables, one or more for each operator family, with the SQL they are held against."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lotwise.functions import canon, nested, numbers, text, web
from lotwise import model_queries
from lotwise.operators import cascade, checks, columns, fees, filters, linkage, lookup, market, price, ranking, recommend, routes
from lotwise.plans import runner
from lotwise.session import settled, shared_folder
from lotwise.sources import profile, readers
from lotwise.sources import transfers as transfer_files
from lotwise.streaming import ingest, latest
from lotwise.views import LOTS_SQL, MARKET_SQL, REGIONAL_SQL, lots, market as market_rows, regional, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE_SQL[f.__name__] = sql
        return f

    return register


def _rounded(df: DataFrame, *names: str, to: int = 6) -> DataFrame:
    return df.withColumns({n: F.round(F.col(f"`{n}`"), to) for n in names})


# --- rankings -------------------------------------------------------------------------------------------------------

@query(f"""
    WITH {MARKET_SQL}, n AS (SELECT min(n_name) AS name FROM nation JOIN supplier ON n_nationkey = s_nationkey),
    r AS (SELECT marca, modelo, anio, sum(unidades) AS u FROM market, n WHERE provincia = n.name AND anio IN (1997, 1998) GROUP BY ALL),
    now AS (SELECT marca, modelo, u, CAST(row_number() OVER (ORDER BY u DESC, marca, modelo) AS BIGINT) AS rank, 100 * u / sum(u) OVER () AS share FROM r WHERE anio = 1998),
    old AS (SELECT marca, modelo, u, CAST(row_number() OVER (ORDER BY u DESC, marca, modelo) AS BIGINT) AS rank, 100 * u / sum(u) OVER () AS share FROM r WHERE anio = 1997)
    SELECT now.marca, now.modelo, now.u AS unidades, now.rank AS rank, round(now.share, 6) AS share_pct,
           round((SELECT sum(x.share) FROM now x WHERE x.rank <= now.rank), 6) AS share_acum_pct, old.u AS unidades_prev, old.rank AS rank_prev,
           now.u - coalesce(old.u, 0) AS delta_unidades, round(now.share - coalesce(old.share, 0), 6) AS delta_share_pp, old.rank - now.rank AS delta_rank
    FROM now LEFT JOIN old ON now.marca = old.marca AND now.modelo = old.modelo WHERE now.rank <= 20
""")
def ranking_versus_previous(spark, sf_dir):
    """Flagship: the leading models of a province and year with share and running share, beside the year before."""
    places = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "supplier"), F.col("n_nationkey") == F.col("s_nationkey"))
    name = places.agg(F.min("n_name").alias("provincia"))
    rows = market_rows(spark, sf_dir).join(F.broadcast(name), "provincia")
    found = ranking.versus_previous(rows, filters.Filters(year=1998), ["marca", "modelo"], 20)
    return found.select(
        "marca", "modelo", "unidades", "rank", F.round("share_%", 6).alias("share_pct"), F.round("share_acum_%", 6).alias("share_acum_pct"), "unidades_prev", "rank_prev",
        "delta_unidades", F.round("delta_share_pp", 6).alias("delta_share_pp"), "delta_rank",
    )


@query(f"""
    WITH {MARKET_SQL}, r AS (SELECT marca, sum(unidades) AS u FROM market GROUP BY ALL), s AS (SELECT 100 * u / sum(u) OVER () AS share FROM r)
    SELECT round(sum((share / 100) * (share / 100)) * 10000, 6) AS hhi FROM s
""")
def ranking_concentration(spark, sf_dir):
    return _rounded(ranking.hhi(ranking.ranking(market_rows(spark, sf_dir), ["marca"])), "hhi")


@query(f"""
    WITH {MARKET_SQL}, m AS (SELECT CASE combustible WHEN 'A' THEN 'ICE' WHEN 'N' THEN 'BEV' ELSE 'OTROS' END AS fuel, unidades FROM market)
    SELECT fuel, sum(unidades) AS unidades, round(100 * sum(unidades) / sum(sum(unidades)) OVER (), 6) AS share_pct FROM m GROUP BY fuel
""")
def ranking_fuel_mix(spark, sf_dir):
    label = F.when(F.col("combustible") == "A", "Diésel").when(F.col("combustible") == "N", "eléctrico").otherwise("steam")
    found = ranking.fuel_mix(market_rows(spark, sf_dir).withColumn("combustible", label))
    return found.select("fuel", "unidades", F.round("share_%", 6).alias("share_pct"))


@query(f"WITH {MARKET_SQL} SELECT yyyymm, marca, modelo, sum(unidades) AS unidades FROM market WHERE anio = 1998 GROUP BY ALL")
def ranking_time_series(spark, sf_dir):
    return ranking.time_series(filters.apply(market_rows(spark, sf_dir), filters.Filters(year=1998)), ["marca", "modelo"])


@query(f"""
    WITH {MARKET_SQL}, s AS (SELECT * FROM market WHERE anio BETWEEN 1996 AND 1997 AND place IN (1, 2, 3)), b AS (SELECT min(marca) AS m FROM s),
    c AS (SELECT s.* FROM s, b WHERE upper(trim(marca)) = upper(trim(b.m)))
    SELECT marca, modelo, sum(unidades) AS unidades, 1 AS n_relaxed FROM c GROUP BY marca, modelo
""")
def ranking_relaxed_filters(spark, sf_dir):
    """A fuel that isn't there gives way, the make stays."""
    rows = market_rows(spark, sf_dir)
    make = rows.where(F.col("anio").between(1996, 1997) & F.col("place").isin(1, 2, 3)).agg(F.min("marca")).first()[0]
    found, steps = filters.relaxed(rows, filters.Filters((1, 2, 3), None, (1996, 1997), make, None, "none such"), code="place")
    return found.groupBy("marca", "modelo").agg(F.sum("unidades").alias("unidades")).withColumn("n_relaxed", F.lit(len(steps)))


@query("""
    WITH t AS (SELECT n_nationkey, n_name, CASE WHEN upper(n_name) = 'NATION_1' THEN 0 WHEN starts_with(upper(n_name), 'NATION_1') THEN 1 WHEN contains(upper(n_name), 'NATION_1') THEN 2 END AS tier FROM nation)
    SELECT n_nationkey, n_name, tier FROM t WHERE tier = (SELECT min(tier) FROM t)
""")
def place_resolution(spark, sf_dir):
    places = table(spark, sf_dir, "nation").withColumn("municipio", F.regexp_replace("n_name", "_", "_"))
    return filters.find_places(places, "nation_1", code="n_nationkey").select("n_nationkey", "n_name", "tier")


# --- market aggregates ----------------------------------------------------------------------------------------------

_MONTH = """
    SELECT marca, modelo, anio, combustible, provincia, codigo, yyyymm, count(*) AS unidades, round(avg(antiguedad_anios), 6) AS antiguedad_media,
           round(quantile_cont(antiguedad_anios, 0.25), 6) AS p25, round(quantile_cont(antiguedad_anios, 0.5), 6) AS p50, round(quantile_cont(antiguedad_anios, 0.75), 6) AS p75,
           round(100.0 * count(*) FILTER (antiguedad_anios <= 3) / count(*), 2) AS a_0_3, round(100.0 * count(*) FILTER (antiguedad_anios > 3 AND antiguedad_anios <= 7) / count(*), 2) AS a_4_7,
           round(100.0 * count(*) FILTER (antiguedad_anios > 7) / count(*), 2) AS a_8
    FROM market GROUP BY ALL
"""


def _month(spark, sf_dir):
    return market.aggregate_month(market_rows(spark, sf_dir))


@query(f"WITH {MARKET_SQL} {_MONTH}")
def market_month(spark, sf_dir):
    m = _month(spark, sf_dir)
    names = {"antiguedad_media": "antiguedad_media", "p25_antiguedad": "p25", "p50_antiguedad": "p50", "p75_antiguedad": "p75"}
    return m.select(*market.KEYS, "unidades", *(F.round(k, 6).alias(v) for k, v in names.items()), F.col("%_0_3").alias("a_0_3"), F.col("%_4_7").alias("a_4_7"), F.col("%_8_mas").alias("a_8"))


@query(f"""
    WITH {MARKET_SQL}, m AS ({_MONTH})
    SELECT a.marca, a.modelo, a.anio, a.combustible, a.provincia, a.yyyymm, a.unidades, b.unidades AS unidades_prev, round(100.0 * (a.unidades - b.unidades) / b.unidades, 2) AS yoy_pct
    FROM m a LEFT JOIN m b ON a.marca = b.marca AND a.modelo = b.modelo AND a.combustible = b.combustible AND a.provincia = b.provincia AND a.codigo = b.codigo
         AND a.anio = b.anio + 1 AND a.yyyymm = b.yyyymm + 100
""")
def market_yoy(spark, sf_dir):
    m = market_rows(spark, sf_dir).groupBy(*market.KEYS).agg(F.count(F.lit(1)).alias("unidades"))
    shifted = m.withColumn("anio0", F.col("anio")).withColumn("anio", F.lit(0).cast("long"))
    found = market.add_yoy(shifted.select(*market.KEYS, "unidades", "anio0"))
    return found.select("marca", "modelo", F.col("anio0").alias("anio"), "combustible", "provincia", "yyyymm", "unidades", "unidades_prev", F.col("YoY_unidades_%").alias("yoy_pct"))


@query(f"""
    WITH {MARKET_SQL}, m AS (SELECT marca, provincia, codigo, yyyymm, count(*) AS unidades FROM market GROUP BY ALL)
    SELECT marca, provincia, yyyymm, unidades, round(100.0 * unidades / sum(unidades) OVER (PARTITION BY yyyymm, codigo), 3) AS share_prov, round(100.0 * unidades / sum(unidades) OVER (PARTITION BY yyyymm), 3) AS share_esp FROM m
""")
def market_shares(spark, sf_dir):
    m = market_rows(spark, sf_dir).groupBy("marca", "provincia", "codigo", "yyyymm").agg(F.count(F.lit(1)).alias("unidades"))
    return market.add_shares(m).select("marca", "provincia", "yyyymm", "unidades", F.col("share_prov_%").alias("share_prov"), F.col("share_esp_%").alias("share_esp"))


_SPAN = f"WITH {MARKET_SQL}, s AS (SELECT * FROM market WHERE yyyymm BETWEEN 199701 AND 199712)"


def _summary(name):
    def run(spark, sf_dir):
        return market.summaries(market_rows(spark, sf_dir), 199701, 199712)[name]

    return run


@query(f"{_SPAN} SELECT sum(unidades) AS unidades FROM s")
def summary_total(spark, sf_dir):
    return _summary("kpi_total")(spark, sf_dir)


@query(f"{_SPAN} SELECT marca, modelo, sum(unidades) AS unidades FROM s GROUP BY ALL ORDER BY unidades DESC, marca, modelo LIMIT 20")
def summary_top_models(spark, sf_dir):
    return _summary("top_modelos")(spark, sf_dir)


@query(f"{_SPAN} SELECT provincia, combustible, sum(unidades) AS unidades, round(100 * sum(unidades) / sum(sum(unidades)) OVER (PARTITION BY provincia), 2) AS mix_pct FROM s GROUP BY provincia, combustible")
def summary_fuel_mix(spark, sf_dir):
    return _summary("mix")(spark, sf_dir).withColumnRenamed("mix_%", "mix_pct")


_RANKED = """SELECT '{0}' AS tabla, row_number() OVER (ORDER BY sum(unidades) DESC, {1}) AS posicion, {2}, sum(unidades) AS unidades, CAST(NULL AS DOUBLE) AS share_prov FROM {3} GROUP BY {1}"""


def _ranked_sql(name: str, key: str, rows: str = "s", top: int | None = None) -> str:
    shown = ", ".join(f"{k if k == key else 'CAST(NULL AS VARCHAR)'} AS {k}" for k in ("marca", "modelo", "provincia", "combustible"))
    found = _RANKED.format(name, key, shown, rows)
    return f"SELECT * FROM ({found}) WHERE posicion <= {top}" if top else found


@query(f"""
    {_SPAN}, f AS (SELECT * FROM s WHERE upper(provincia) = 'NATION_6'), m AS (SELECT provincia, combustible, sum(unidades) AS unidades, round(100 * sum(unidades) / sum(sum(unidades)) OVER (PARTITION BY provincia), 2) AS share_prov FROM s GROUP BY provincia, combustible)
    SELECT tabla, CAST(posicion AS INTEGER) AS posicion, marca, modelo, provincia, combustible, unidades, share_prov FROM (
    SELECT 'kpi' AS tabla, 1 AS posicion, NULL AS marca, NULL AS modelo, NULL AS provincia, NULL AS combustible, sum(unidades) AS unidades, NULL AS share_prov FROM s
    UNION ALL {_ranked_sql("rank_marcas", "marca", top=20)} UNION ALL {_ranked_sql("rank_modelos", "modelo", top=20)} UNION ALL {_ranked_sql("rank_provincias", "provincia")} UNION ALL {_ranked_sql("rank_combustible", "combustible")}
    UNION ALL {_ranked_sql("rank_marcas_focus", "marca", "f", 20)} UNION ALL {_ranked_sql("rank_modelos_focus", "modelo", "f", 20)}
    UNION ALL SELECT 'mix_comb_prov', row_number() OVER (ORDER BY provincia, share_prov DESC, unidades DESC, combustible), NULL, NULL, provincia, combustible, unidades, share_prov FROM m)
""")
def summary_set(spark, sf_dir):
    """All summaries of a year from one scan."""
    return market.summary_set(market_rows(spark, sf_dir), 199701, 199712, "nation_6")


@query(f"WITH {MARKET_SQL} SELECT marca, provincia, sum(unidades) AS unidades, sum(unidades) < 3000 AS low_support FROM market GROUP BY ALL")
def market_support(spark, sf_dir):
    return market.support(market_rows(spark, sf_dir), ["marca", "provincia"], 3000)


@query(f"WITH {MARKET_SQL} SELECT min(yyyymm) AS first, max(yyyymm) AS last, count(*) FILTER (yyyymm IS NULL) AS n_null FROM market")
def market_bounds(spark, sf_dir):
    return market.bounds(market_rows(spark, sf_dir))


# --- regional features ----------------------------------------------------------------------------------------------


@query(f"WITH {REGIONAL_SQL} SELECT * FROM annual")
def regional_annual(spark, sf_dir):
    return market.annual(regional(spark, sf_dir))


@query(f"""
    WITH {REGIONAL_SQL}, t AS (
        SELECT *, lag(units_abs, 1) OVER w AS p1, lag(units_abs, 3) OVER w AS p3, CAST(dense_rank() OVER (PARTITION BY region, marca, modelo, combustible ORDER BY units_abs DESC) AS BIGINT) AS yr
        FROM annual WINDOW w AS (PARTITION BY region, marca, modelo, combustible ORDER BY anio)
    )
    SELECT region, marca, modelo, anio, combustible, round(CASE WHEN coalesce(p1, 0) <> 0 THEN (units_abs - p1) / p1 END, 6) AS yoy, round(CASE WHEN coalesce(p3, 0) <> 0 THEN (units_abs - p3) / p3 END, 6) AS growth3,
           round(CASE WHEN coalesce(p1, 0) <> 0 THEN (units_abs - p1) / p1 END * least(1.0, coalesce(p1, 0) / 20.0), 6) AS yoy_weighted,
           CASE WHEN coalesce(p1, 0) <> 0 AND (units_abs - p1) / p1 > 0.10 THEN 1 WHEN coalesce(p1, 0) <> 0 AND (units_abs - p1) / p1 < -0.10 THEN 0 END AS trend_flag, yr AS year_rank_in_model
    FROM t
""")
def regional_trends(spark, sf_dir):
    t = market.trends(market.annual(regional(spark, sf_dir)))
    return t.select(*market.COHORT, F.round("YoY_%", 6).alias("yoy"), F.round("Growth_3a_%", 6).alias("growth3"), F.round("YoY_weighted", 6).alias("yoy_weighted"), "trend_flag", "year_rank_in_model")


@query(f"""
    WITH {REGIONAL_SQL}, m AS (SELECT region, marca, modelo, anio, combustible, yyyymm, sum(unidades) AS u FROM regional GROUP BY ALL)
    SELECT region, marca, modelo, anio, combustible, round(stddev_samp(u), 6) AS sd, round(avg(u), 6) AS mean, count(u) AS months, round(CASE WHEN avg(u) <> 0 THEN stddev_samp(u) / avg(u) END, 6) AS cv
    FROM m GROUP BY ALL
""")
def regional_stability(spark, sf_dir):
    s = market.stability(regional(spark, sf_dir))
    return s.select(*market.COHORT, F.round("stddev_mensual_units", 6).alias("sd"), F.round("mean_mensual_units", 6).alias("mean"), F.col("meses_observados").alias("months"), F.round("coef_var_%", 6).alias("cv"))


_FEATURES = f"""
    WITH {REGIONAL_SQL},
    models AS (SELECT region, marca, modelo, anio, sum(units_abs) AS u FROM annual GROUP BY ALL),
    ranked AS (
        SELECT *, sum(u) OVER (PARTITION BY region, marca, anio) AS tmy, CAST(dense_rank() OVER (PARTITION BY region, anio ORDER BY u DESC) AS BIGINT) AS rank_general,
               CAST(dense_rank() OVER (PARTITION BY region, marca, anio ORDER BY u DESC) AS BIGINT) AS rank_brand_year FROM models
    ),
    conc AS (SELECT *, u / tmy AS dom, sum((u / tmy) * (u / tmy)) OVER (PARTITION BY region, marca, anio) AS hhi FROM ranked),
    fuels AS (
        SELECT *, sum(units_abs) OVER (PARTITION BY region, anio, combustible) AS tcy, sum(units_abs) OVER (PARTITION BY region, anio) AS ty,
               CAST(dense_rank() OVER (PARTITION BY region, anio, combustible ORDER BY units_abs DESC) AS BIGINT) AS rank_year_fuel_model,
               first_value(combustible) OVER (PARTITION BY region, marca, modelo, anio ORDER BY units_abs DESC, combustible) AS best_fuel, max(units_abs) OVER (PARTITION BY region, marca, modelo, anio) AS best_fuel_units
        FROM annual
    ),
    features AS (
        SELECT f.region, f.marca, f.modelo, f.anio, f.combustible, f.units_abs, c.tmy, f.ty, f.tcy, c.rank_general, c.rank_brand_year, CAST(c.rank_brand_year <= 3 AS INTEGER) AS is_top3, f.rank_year_fuel_model,
               f.best_fuel, f.best_fuel_units, c.dom, c.hhi
        FROM fuels f JOIN conc c ON f.region = c.region AND f.marca = c.marca AND f.modelo = c.modelo AND f.anio = c.anio
    )
"""


@query(_FEATURES + """
    SELECT region, marca, modelo, anio, combustible, units_abs, rank_general, rank_brand_year, is_top3, rank_year_fuel_model, best_fuel, best_fuel_units, round(units_abs / tmy, 6) AS share_marca,
           round(units_abs / tcy, 6) AS share_combustible, round(units_abs / ty, 6) AS share_anio, round(dom, 6) AS dominancia, round(hhi, 6) AS hhi, CAST(combustible = best_fuel AS INTEGER) AS is_best_fuel,
           round(units_abs / best_fuel_units, 6) AS row_vs_best
    FROM features
""")
def regional_features(spark, sf_dir):
    f = market.features(regional(spark, sf_dir))
    return f.select(
        *market.COHORT, "units_abs", "rank_general", "rank_brand_year", F.col("is_top3_brand_year").alias("is_top3"), "rank_year_fuel_model", "best_fuel", "best_fuel_units",
        F.round("share_marca_%", 6).alias("share_marca"), F.round("share_combustible_%", 6).alias("share_combustible"), F.round("share_año_%", 6).alias("share_anio"),
        F.round("dominancia_modelo_marca_%", 6).alias("dominancia"), F.round("HHI_marca", 6).alias("hhi"), "is_best_fuel", F.round("row_vs_best_fuel_%", 6).alias("row_vs_best"),
    )


@query(_FEATURES + """
    SELECT region, marca, modelo, anio, sum(units_abs) AS units_abs, max(rank_general) AS rank_general, max(best_fuel) AS best_fuel, round(sum(units_abs) / max(tmy), 6) AS share_marca,
           round(sum(units_abs) / max(ty), 6) AS share_anio, round(sum(units_abs) / max(best_fuel_units), 6) AS row_vs_best
    FROM features GROUP BY region, marca, modelo, anio
""")
def regional_features_without_fuel(spark, sf_dir):
    f = market.without_fuel(market.features(regional(spark, sf_dir)))
    return f.select("region", "marca", "modelo", "anio", "units_abs", "rank_general", "best_fuel", F.round("share_marca_%", 6).alias("share_marca"), F.round("share_año_%", 6).alias("share_anio"), F.round("row_vs_best_fuel_%", 6).alias("row_vs_best"))


@query(f"""
    WITH {MARKET_SQL}, r AS (
        SELECT 'ESP' AS region, marca, modelo, combustible, unidades, CASE WHEN antiguedad_anios <= 3 THEN 100.0 ELSE 0.0 END AS mix FROM market
    )
    SELECT marca, modelo, combustible, round(100 * sum(unidades * mix / 100) / sum(unidades), 6) AS mix_0_3 FROM r GROUP BY ALL
""")
def regional_age_mix(spark, sf_dir):
    rows = market_rows(spark, sf_dir).withColumn("region", F.lit("ESP")).withColumn("mix_0_3_%", F.when(F.col("antiguedad_anios") <= 3, 100.0).otherwise(0.0))
    cohorts = rows.select("region", "marca", "modelo", "combustible").distinct().withColumn("anio", F.lit(None).cast("long"))
    return market.ages(cohorts, rows).select("marca", "modelo", "combustible", F.round("mix_0_3_%", 6).alias("mix_0_3"))


_CASCADE = _FEATURES + """,
    lot AS (SELECT DISTINCT p_brand AS marca, p_type AS modelo, CAST(year(l_shipdate) AS BIGINT) AS anio, CASE WHEN l_linenumber = 1 THEN 'N' WHEN l_linenumber = 2 THEN 'R' ELSE 'X' END AS combustible FROM lineitem JOIN part ON l_partkey = p_partkey),
    pool AS (
        SELECT region, marca, modelo, anio, combustible AS fuel, best_fuel, units_abs, false AS bare FROM features
        UNION ALL SELECT region, marca, modelo, anio, NULL, max(best_fuel), sum(units_abs), true FROM features GROUP BY region, marca, modelo, anio
    ),
    cand AS (
        SELECT lot.*, pool.region, pool.units_abs, pool.fuel, CASE WHEN bare THEN 10 WHEN lot.combustible = fuel THEN 0 WHEN lot.combustible <> 'X' AND fuel = 'A' THEN 1 WHEN fuel = best_fuel THEN 9 END AS tier,
               CASE pool.region WHEN 'BCN' THEN 1 WHEN 'CAT' THEN 2 ELSE 3 END AS geo
        FROM lot LEFT JOIN pool ON lot.marca = pool.marca AND lot.modelo = pool.modelo AND lot.anio = pool.anio
    ),
    best AS (SELECT *, row_number() OVER (PARTITION BY marca, modelo, anio, combustible ORDER BY geo * 100 + tier NULLS LAST, fuel NULLS LAST) AS i FROM cand)
    SELECT marca, modelo, anio, combustible, CASE WHEN tier IS NOT NULL THEN units_abs END AS units_abs,
           CASE WHEN tier = 0 THEN 'exact' WHEN tier = 10 THEN 'no_fuel' WHEN tier IS NOT NULL THEN 'fuel_fallback' END AS match_kind, CASE WHEN tier IS NOT NULL THEN lower(region) END AS geo_fallback
    FROM best WHERE i = 1
"""


@query(_CASCADE)
def cascade_match(spark, sf_dir):
    """Nearest region first; own fuel, then the allowed substitute, then the best fuel, then no fuel."""
    f = market.features(regional(spark, sf_dir))
    rows = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
    fuel = F.when(F.col("l_linenumber") == 1, "N").when(F.col("l_linenumber") == 2, "R").otherwise("X")
    keys = rows.select(F.col("p_brand").alias("marca"), F.col("p_type").alias("modelo"), F.year("l_shipdate").cast("long").alias("anio"), fuel.alias("combustible")).distinct()
    keys = keys.withColumn("lot", F.concat_ws("|", "marca", "modelo", "anio", "combustible"))
    found = cascade.match(keys, "lot", f, market.without_fuel(f), ["units_abs"], "BCN", order=("A",), allowed={"N": ("A",), "R": ("A",), "X": ()})
    return found.join(keys, "lot").select("marca", "modelo", "anio", "combustible", "units_abs", "match_kind", "geo_fallback")


def _target_sql(target: str, places: tuple[str, ...]) -> str:
    geo = " ".join(f"WHEN '{p}' THEN {i}" for i, p in enumerate(places))
    return f"""
        SELECT marca, modelo, anio, combustible, n, '{target}' AS target, CASE WHEN tier IS NOT NULL THEN units_abs END AS units_abs, CASE WHEN tier = 0 THEN 'exact' WHEN tier = 10 THEN 'no_fuel' WHEN tier IS NOT NULL THEN 'fuel_fallback' END AS match_kind,
            CASE WHEN tier IS NOT NULL THEN lower(region) END AS geo_fallback
        FROM (SELECT *, row_number() OVER (PARTITION BY marca, modelo, anio, combustible ORDER BY CASE region {geo} END * 100 + tier NULLS LAST, fuel NULLS LAST) AS i FROM cand WHERE region IN ({", ".join(f"'{p}'" for p in places)}) OR region IS NULL) WHERE i = 1"""


_TARGETS_SQL = _CASCADE.split("    best AS (SELECT")[0].replace("lot AS (SELECT DISTINCT p_brand", "lot AS (SELECT p_brand").replace(
    "FROM lot LEFT JOIN pool", "FROM (SELECT *, count(*) AS n FROM lot GROUP BY ALL) lot LEFT JOIN pool"
) + f"""
    each AS ({" UNION ALL ".join(_target_sql(t, places) for t, places in cascade.GEO.items())}),
    every AS (SELECT k.*, t.target FROM (SELECT marca, modelo, anio, combustible, count(*) AS n FROM lot GROUP BY ALL) k, (VALUES ('BCN'), ('CAT'), ('ESP')) t(target)),
    full_ AS (SELECT e.*, x.units_abs, x.match_kind, x.geo_fallback FROM every e LEFT JOIN each x USING (marca, modelo, anio, combustible, target)),
    wide AS (SELECT marca, modelo, anio, combustible, n, max(units_abs) FILTER (target = 'BCN') AS b, max(units_abs) FILTER (target = 'CAT') AS c, max(units_abs) FILTER (target = 'ESP') AS e,
        max(match_kind) FILTER (target = 'BCN') AS kind_bcn, max(match_kind) FILTER (target = 'CAT') AS kind_cat, max(match_kind) FILTER (target = 'ESP') AS kind_esp,
        max(geo_fallback) FILTER (target = 'BCN') AS geo_bcn, max(geo_fallback) FILTER (target = 'CAT') AS geo_cat FROM full_ GROUP BY ALL)
    SELECT marca, modelo, anio, combustible, CAST(n AS BIGINT) AS n, b AS units_bcn, c AS units_cat, e AS units_esp, kind_bcn, kind_cat, kind_esp, geo_bcn, geo_cat, round(b / nullif(c, 0), 6) AS bcn_in_cat, round(c / nullif(e, 0), 6) AS cat_in_esp FROM wide
"""


@query(_TARGETS_SQL)
def cascade_all_targets(spark, sf_dir):
    """The matches of all line items for the three regions, by one join."""
    f = market.features(regional(spark, sf_dir))
    rows = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
    fuel = F.when(F.col("l_linenumber") == 1, "N").when(F.col("l_linenumber") == 2, "R").otherwise("X")
    lots_ = rows.select(F.col("p_brand").alias("marca"), F.col("p_type").alias("modelo"), F.year("l_shipdate").cast("long").alias("anio"), fuel.alias("combustible"))
    lots_ = lots_.groupBy(*lots_.columns).agg(F.count(F.lit(1)).alias("n"))
    found = cascade.match_all(lots_, f, market.without_fuel(f), ["units_abs"], order=("A",), allowed={"N": ("A",), "R": ("A",), "X": ()})
    return found.select(
        "marca", "modelo", "anio", "combustible", "n", *(F.col(f"units_abs_{t}").alias(f"units_{t}") for t in ("bcn", "cat", "esp")), *(F.col(f"match_kind_{t}").alias(f"kind_{t}") for t in ("bcn", "cat", "esp")),
        *(F.col(f"geo_fallback_{t}").alias(f"geo_{t}") for t in ("bcn", "cat")), F.round("ratio_bcn_cat_%", 6).alias("bcn_in_cat"), F.round("ratio_cat_esp_%", 6).alias("cat_in_esp"),
    )


# --- fees, routes, prices -------------------------------------------------------------------------------------------

_RULES = [
    ("NATION_1", "adquisicion", "1-URGENT", 0.0, 50000.0, "EUR", 100.0, "EUR", None),
    ("NATION_1", "adquisicion", "otros", 0.0, 20000.0, "EUR", 3.0, "%", 90.0),
    ("NATION_1", "adquisicion", "otros", 20000.0, None, "EUR", 2.0, "%", 150.0),
    ("europa", "adquisicion", "otros", 0.0, 100000.0, "EUR", 1.5, "%", 50.0),
    ("europa", "adquisicion", "otros", 50000.0, 90000.0, "EUR", 700.0, "EUR", None),
    ("europa", "exportacion", "otros", None, None, "DKK", 1000.0, "DKK", None),
    ("NATION_2", "documentos", "otros", None, None, "EUR", 75.0, "EUR", None),
]
_RULE_COLUMNS = ["pais", "categoria", "subasta_o_tipo", "precio_min", "precio_max", "moneda", "tasa_valor", "tasa_unidad", "importe_minimo"]


def _sql_value(v) -> str:
    return "NULL" if v is None else f"'{v}'" if isinstance(v, str) else repr(v)


_RULES_SQL = "rules(pais, categoria, subasta, low, high, currency, fee, unit, least, ord) AS (VALUES " + ", ".join("(" + ", ".join(map(_sql_value, (*r, i))) + ")" for i, r in enumerate(_RULES)) + ")"
_FEES = f"""
    WITH {_RULES_SQL}, lot AS (
        SELECT o_orderkey AS lot, o_totalprice AS p, lower(n_name) AS c, lower(o_orderpriority) AS s FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
    ), j AS (
        SELECT lot, p, lower(r.categoria) AS component, r.*, CASE WHEN lower(r.pais) = lot.c THEN 0 ELSE 1 END AS far,
               CASE WHEN r.categoria = 'adquisicion' AND lower(r.subasta) = lot.s THEN 0 WHEN r.subasta = 'otros' THEN 1 ELSE 2 END AS sale_tier,
               CASE WHEN p >= r.low AND p <= r.high THEN 0 WHEN r.low <= p THEN 1 WHEN r.low > p THEN 2 WHEN r.low IS NULL AND r.high IS NULL THEN 3 ELSE 4 END AS t
        FROM lot JOIN rules r ON lower(r.pais) = lot.c OR r.pais = 'europa'
    ), b AS (
        SELECT *, row_number() OVER (PARTITION BY lot, component ORDER BY far, sale_tier, t, CASE t WHEN 0 THEN high - low WHEN 1 THEN -low WHEN 2 THEN low ELSE 0 END, CASE t WHEN 0 THEN low ELSE 0 END, ord) AS i FROM j
    ), f AS (
        SELECT lot, component, CASE WHEN unit = '%' THEN greatest(fee * p / 100, coalesce(least, 0)) WHEN currency = 'DKK' THEN fee * 0.134 ELSE fee END AS eur FROM b WHERE i = 1
    )
"""


def _rules(spark):
    rows = [(*r, i) for i, r in enumerate(_RULES)]
    return fees.rules(spark.createDataFrame(rows, "pais string, categoria string, subasta_o_tipo string, precio_min double, precio_max double, moneda string, tasa_valor double, tasa_unidad string, importe_minimo double, orden long"))


def _orders(spark, sf_dir):
    t = lambda n: table(spark, sf_dir, n)
    return t("orders").join(t("customer"), F.col("o_custkey") == F.col("c_custkey")).join(t("nation"), F.col("c_nationkey") == F.col("n_nationkey"))


@query(_FEES + "SELECT lot, component, round(eur, 6) AS fee_eur FROM f")
def fee_bands(spark, sf_dir):
    found = fees.lookup(_orders(spark, sf_dir), "o_orderkey", _rules(spark), "o_totalprice", "n_name", "o_orderpriority")
    return found.select(F.col("o_orderkey").alias("lot"), "component", F.round("fee_eur", 6).alias("fee_eur"))


@query(_FEES + """
    SELECT lot.lot, round(max(eur) FILTER (component = 'adquisicion'), 6) AS adquisicion, round(max(eur) FILTER (component = 'exportacion'), 6) AS exportacion, round(max(eur) FILTER (component = 'documentos'), 6) AS documentos,
           round(coalesce(max(eur) FILTER (component = 'adquisicion'), 0) + coalesce(max(eur) FILTER (component = 'exportacion'), 0) + coalesce(max(eur) FILTER (component = 'documentos'), 0), 6) AS total
    FROM lot LEFT JOIN f ON lot.lot = f.lot GROUP BY lot.lot
""")
def fee_bundle(spark, sf_dir):
    found = fees.bundle(_orders(spark, sf_dir), "o_orderkey", _rules(spark), "o_totalprice", "n_name", "o_orderpriority")
    names = {f"commission_{c}_eur": c for c in ("adquisicion", "exportacion", "documentos")} | {"commission_total_eur": "total"}
    return found.select(F.col("o_orderkey").alias("lot"), *(F.round(k, 6).alias(v) for k, v in names.items()))


_ROUTES = [
    ("NATION_1", "ES", 28000, "Aachen North", 300.0, 350.0, None, 500.0, 5),
    ("NATION_1", "ES", 28000, "Urgent Yard", 320.0, 360.0, 480.0, None, 4),
    ("NATION_2", "ES", 28000, "Low Bay", None, 410.0, None, 620.0, 6),
    ("NATION_3", "ES", 28000, "High Street", 280.0, None, None, None, 7),
]
_ROUTES_SQL = "routes(o, d, zip, compound, passenger, suv, lcv1, lcv2, days, route) AS (VALUES " + ", ".join("(" + ", ".join(map(_sql_value, (*r, i + 1))) + ")" for i, r in enumerate(sorted(_ROUTES, key=lambda r: (r[0].lower(), r[1].lower(), r[3])))) + ")"


@query(f"""
    WITH {_ROUTES_SQL}, lot AS (
        SELECT o_orderkey AS lot, n_name AS o, o_orderpriority AS u, CASE WHEN c_mktsegment = 'BUILDING' THEN 'lcv' WHEN c_mktsegment = 'MACHINERY' THEN 'suv' ELSE 'passenger_car' END AS cat
        FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
    ), price AS (
        SELECT o, 'passenger_car' AS cat, passenger AS p FROM routes UNION ALL SELECT o, 'suv', suv FROM routes UNION ALL SELECT o, 'lcv', coalesce(lcv2, lcv1) FROM routes
    ), j AS (
        SELECT lot, cat, CASE cat WHEN 'lcv' THEN coalesce(lcv2, lcv1) WHEN 'suv' THEN suv ELSE passenger END AS p, days, route,
               len(list_intersect(list_distinct(string_split_regex(lower(u), '[^0-9a-z]+')), list_distinct(string_split_regex(lower(compound), '[^0-9a-z]+')))) AS score
        FROM lot JOIN routes ON lower(lot.o) = lower(routes.o)
    ), d AS (SELECT lot, p, days, row_number() OVER (PARTITION BY lot ORDER BY score DESC, route) AS i FROM j),
    m AS (SELECT o, cat, avg(p) AS p FROM price WHERE p IS NOT NULL GROUP BY o, cat), g AS (SELECT cat, avg(p) AS p FROM price WHERE p IS NOT NULL GROUP BY cat)
    SELECT lot.lot, round(coalesce(d.p, m.p, g.p, 0), 4) AS transport_eur, CAST(CASE WHEN d.p IS NOT NULL THEN 1.0 WHEN m.p IS NOT NULL THEN 0.5 WHEN g.p IS NOT NULL THEN 0.3 ELSE 0.0 END AS DOUBLE) AS confidence, CASE WHEN d.p IS NOT NULL THEN d.days END AS days
    FROM lot LEFT JOIN d ON lot.lot = d.lot AND d.i = 1 LEFT JOIN m ON lower(lot.o) = lower(m.o) AND lot.cat = m.cat LEFT JOIN g ON lot.cat = g.cat
""")
def transport_price(spark, sf_dir):
    names = "pais_origen string, pais_destino string, destino_zip long, origen_compound string, precio_passenger_car_eur double, precio_suv_eur double, precio_lcv1_eur double, precio_lcv2_eur double, dias_single_cars int"
    table_ = routes.routes(spark.createDataFrame(_ROUTES, names))
    cat = F.when(F.col("c_mktsegment") == "BUILDING", "lcv").when(F.col("c_mktsegment") == "MACHINERY", "suv").otherwise("passenger_car")
    found = routes.priced(_orders(spark, sf_dir).withColumn("cat", cat), "o_orderkey", table_, "n_name", "o_orderpriority", "cat", "ES")
    return found.select(F.col("o_orderkey").alias("lot"), F.round("transport_eur", 4).alias("transport_eur"), F.col("transport_confidence").alias("confidence"), F.col("transport_days").alias("days"))


@query("""
    SELECT o_orderkey AS lot, round(o_totalprice + 150.0 + 25.5 + coalesce(c_acctbal, 0), 4) AS precio_final_eur, round(2 * o_totalprice - round(o_totalprice + 150.0 + 25.5 + coalesce(c_acctbal, 0), 4), 4) AS margin_abs
    FROM orders JOIN customer ON o_custkey = c_custkey
""")
def landed_price(spark, sf_dir):
    t = lambda n: table(spark, sf_dir, n)
    costs = price.fixed_costs(spark.createDataFrame([("ES", "150,0"), ("ES", "25.5"), ("FR", "9")], "pais string, valor_eur string"), "ES")
    rows = t("orders").join(t("customer"), F.col("o_custkey") == F.col("c_custkey")).withColumns({"winning_bid": F.col("o_totalprice"), "transport_eur": F.lit(None).cast("double"), "commission_total_eur": F.col("c_acctbal"), "precio_venta_ganvam": 2 * F.col("o_totalprice")})
    found = price.margins(_rounded(price.landed(rows, costs), "precio_final_eur", to=4))
    return found.select(F.col("o_orderkey").alias("lot"), "precio_final_eur", F.round("margin_abs", 4).alias("margin_abs"))


# --- recommendations ------------------------------------------------------------------------------------------------

_SCORED = f"""
    WITH {LOTS_SQL}, x AS (
        SELECT *, CASE WHEN max(mix) OVER () > 1 THEN mix / 100 ELSE mix END AS rotation, CASE WHEN max(margin_abs) OVER () = min(margin_abs) OVER () THEN 0 ELSE (margin_abs - min(margin_abs) OVER ()) / (max(margin_abs) OVER () - min(margin_abs) OVER ()) END AS mu,
               (units - min(units) OVER ()) / (max(units) OVER () - min(units) OVER ()) AS uu, (share - min(share) OVER ()) / (max(share) OVER () - min(share) OVER ()) AS su FROM lots
    ), scored AS (SELECT *, 0.5 * su + 0.5 * uu AS demand, 0.6 * mu * (0.5 * su + 0.5 * uu) + 0.4 * (rotation - min(rotation) OVER ()) / (max(rotation) OVER () - min(rotation) OVER ()) AS score FROM x)
"""


@query(_SCORED + """
    , c AS (SELECT *, row_number() OVER (PARTITION BY marca, modelo, anio, combustible_norm ORDER BY precio_final_eur, round(score, 9) DESC, lot_id) AS i FROM scored WHERE anio BETWEEN 1996 AND 1998)
    SELECT marca, modelo, anio, combustible_norm, lot_id, precio_final_eur, round(score, 6) AS score FROM c WHERE i = 1 ORDER BY round(c.score, 9) DESC, margin_abs DESC, lot_id LIMIT 40
""")
def recommend_cheapest(spark, sf_dir):
    found = recommend.best(lots(spark, sf_dir), "esp", f=filters.Listing(years=(1996, 1998)), selection="cheapest", n=40)
    return found.select("marca", "modelo", "anio", "combustible_norm", "lot_id", "precio_final_eur", F.round("score", 6).alias("score"))


@query(f"""
    WITH {LOTS_SQL}, g AS (SELECT marca, modelo, anio, combustible_norm, avg(margin_abs) AS m, avg(precio_final_eur) AS p, count(*) AS n_listings FROM lots WHERE anio = 1997 GROUP BY ALL)
    SELECT marca, modelo, anio, combustible_norm, round(m, 4) AS margin_abs, round(p, 4) AS precio_final_eur, n_listings FROM g ORDER BY g.m DESC, marca, modelo, anio, combustible_norm LIMIT 30
""")
def recommend_means(spark, sf_dir):
    found = recommend.best(lots(spark, sf_dir), "esp", f=filters.Listing(year=(1997,)), selection="mean", n=30, ignore_rotation=True)
    return found.select("marca", "modelo", "anio", "combustible_norm", F.round("margin_abs", 4).alias("margin_abs"), F.round("precio_final_eur", 4).alias("precio_final_eur"), "n_listings")


@query(f"""
    WITH {LOTS_SQL}, f AS (SELECT *, median(precio_final_eur) OVER (PARTITION BY marca, modelo, anio, combustible_norm) AS med FROM lots), w AS (SELECT * FROM f WHERE regexp_matches(modelo, '(?i)standard') AND anio BETWEEN 1996 AND 1999),
    r AS (SELECT *, row_number() OVER (PARTITION BY anio ORDER BY margin_abs DESC, lot_id) AS y FROM w),
    t AS (SELECT * FROM r ORDER BY (y = 1) DESC, CASE WHEN y = 1 THEN anio END NULLS LAST, margin_abs DESC, lot_id LIMIT 50),
    s AS (SELECT sale_name, 100.0 * count(*) / sum(count(*)) OVER () AS rep, avg(100 * (med - precio_final_eur) / med) AS adv FROM t GROUP BY sale_name)
    SELECT sale_name, round(rep, 6) AS representation_pct, round(adv, 6) AS price_adv_pct FROM s
""")
def recommend_best_auction(spark, sf_dir):
    _, sales = recommend.best_auction(lots(spark, sf_dir), filters.Listing(model="standard", years=(1996, 1999)), 50)
    return sales.select("sale_name", F.round("representation_pct", 6).alias("representation_pct"), F.round("price_adv_pct", 6).alias("price_adv_pct"))


@query(f"""
    WITH {LOTS_SQL}, b AS (SELECT min(marca) AS m FROM lots), r AS (SELECT l.*, row_number() OVER (PARTITION BY modelo ORDER BY precio_final_eur, lot_id) AS i FROM lots l, b WHERE marca = b.m AND anio >= 1997 AND mileage <= 100000)
    SELECT modelo, lot_id, precio_final_eur FROM r WHERE i = 1
""")
def recommend_within_brand(spark, sf_dir):
    rows = lots(spark, sf_dir)
    make = rows.agg(F.min("marca")).first()[0]
    found = recommend.within_brand(rows, filters.Listing(make=f"^{make}$", years=(1997, 9999), mileage=(None, 100000)))
    return found.select("modelo", "lot_id", "precio_final_eur")


@query(f"""
    WITH {LOTS_SQL}, r AS (SELECT *, row_number() OVER (PARTITION BY marca, modelo, anio, combustible_norm ORDER BY margin_abs DESC, precio_final_eur, lot_id) AS i FROM lots WHERE segmento = 'BUILDING' AND anio BETWEEN 1995 AND 1999)
    SELECT lot_id, marca, margin_abs FROM r WHERE i <= 2 ORDER BY margin_abs DESC, precio_final_eur, lot_id LIMIT 20
""")
def recommend_within_segment(spark, sf_dir):
    rows = lots(spark, sf_dir).drop("units_abs_esp", "share_marca_%_esp", "mix_0_3_%_esp")
    cfg = recommend.Config(alpha_margin=0.0)
    found = recommend.within_segment(rows, "esp", filters.Listing(segment_in=("building",), years=(1995, 1999)), cfg, "max_margin", 20)
    return found.select("lot_id", "marca", "margin_abs")


@query(_SCORED + """
    , m AS (SELECT * FROM scored WHERE regexp_matches(modelo, '(?i)promo') AND anio BETWEEN 1996 AND 1998)
    SELECT count(*) AS n_lotes, round(avg(score), 6) AS score_mean, round(avg(demand), 6) AS demand_mean, round(avg(rotation), 6) AS rotation_mean, CASE WHEN avg(score) IS NULL THEN 'SIN_DATOS' WHEN avg(score) < 0.4 THEN 'BAJO' WHEN avg(score) < 0.7 THEN 'MEDIO' ELSE 'ALTO' END AS bucket,
           coalesce(string_agg(DISTINCT upper(combustible_norm), ',' ORDER BY upper(combustible_norm)), '') AS fuel
    FROM m
""")
def recommend_attractiveness(spark, sf_dir):
    a = recommend.attractiveness(lots(spark, sf_dir), "esp", filters.Listing(model="promo", years=(1996, 1998)))
    return a.select("n_lotes", F.round("score_mean", 6).alias("score_mean"), F.round("demand_factor_mean", 6).alias("demand_mean"), F.round("rotation_proxy_mean", 6).alias("rotation_mean"), F.col("attractiveness_bucket").alias("bucket"), "fuel")


@query(f"""
    WITH {LOTS_SQL}, m AS (SELECT * FROM lots WHERE anio = 1997), c AS (SELECT combustible_norm, count(*) AS n FROM m GROUP BY 1)
    SELECT 'esp' AS region, (SELECT combustible_norm FROM c ORDER BY n DESC, combustible_norm LIMIT 1) AS best_fuel, round(1 - avg(mix) / CASE WHEN max(mix) > 1 THEN 100.0 ELSE 1.0 END, 6) AS gap FROM m
""")
def recommend_best_fuel_gap(spark, sf_dir):
    rows = lots(spark, sf_dir).withColumn("best_fuel_esp", F.col("combustible_norm")).withColumn("row_vs_best_fuel_%_esp", F.col("`mix_0_3_%_esp`"))
    found = recommend.best_fuel_gap(rows, filters.Listing(year=(1997,)))
    return found.select("region", "best_fuel", F.round("gap_vs_rest_mean", 6).alias("gap"))


@query(f"WITH {LOTS_SQL} SELECT marca, sale_country, sale_name, count(*) AS n, CAST(sum(CASE WHEN lot_status = 'Sold' THEN 1 ELSE 0 END) AS BIGINT) AS n_sold FROM lots WHERE lot_status = 'Sold' AND margin_abs / precio_final_eur <= 0.1 AND combustible_norm <> 'A' GROUP BY ALL")
def global_filters(spark, sf_dir):
    g = filters.GlobalFilters(fuel_exclude=["A", ""], max_margin_ratio=0.1, only_sold=True)
    return filters.globally(lots(spark, sf_dir), g).groupBy("marca", "sale_country", "sale_name").agg(F.count(F.lit(1)).alias("n"), F.sum(canon.sold(F.col("lot_status")).cast("long")).alias("n_sold"))


@query(f"WITH {LOTS_SQL}, s AS (SELECT *, count(*) OVER (PARTITION BY marca, modelo, anio) AS g FROM lots) SELECT marca, modelo, anio, count(*) AS n FROM s WHERE g >= 5 GROUP BY ALL")
def group_size_filter(spark, sf_dir):
    return lookup.in_groups(lots(spark, sf_dir), ["marca", "modelo", "anio"], 5).groupBy("marca", "modelo", "anio").agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {LOTS_SQL} SELECT marca, modelo, anio, combustible_norm, sale_country, round(avg(precio_final_eur), 7) AS precio_medio FROM lots GROUP BY ALL")
def price_means(spark, sf_dir):
    return _rounded(recommend.price_means(lots(spark, sf_dir))[0], "precio_medio", to=7)


# --- record linkage and model names ---------------------------------------------------------------------------------


def _versions(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    make, model = F.col("p_brand"), F.col("p_type")
    prices = p.select(F.col("p_partkey").cast("string").alias("price_id"), make.alias("make"), model.alias("model"), (F.col("p_size") + 1990).alias("year"), F.lit("x").alias("fuel"), F.col("p_size").cast("double").alias("power"), F.col("p_name").alias("text"), F.lit(None).cast("int").alias("start"), F.lit(None).cast("int").alias("end"), F.col("p_retailprice").alias("price"))
    rows = table(spark, sf_dir, "lineitem").select("l_partkey", F.year("l_shipdate").alias("year")).distinct().join(p, F.col("l_partkey") == F.col("p_partkey"))
    lots_ = rows.select(F.concat_ws("-", "l_partkey", "year").alias("lot_id"), make.alias("make"), model.alias("model"), "year", F.lit("x").alias("fuel"), F.col("p_size").cast("double").alias("power"), F.col("p_name").alias("text"))
    return lots_, prices


@query("""
    WITH lot AS (SELECT DISTINCT concat_ws('-', l_partkey, year(l_shipdate)) AS lot_id, p_brand, p_type, year(l_shipdate) AS y, p_size AS pw, p_name AS t FROM lineitem JOIN part ON l_partkey = p_partkey),
    c AS (SELECT lot.*, q.p_size + 1990 AS qy, q.p_size AS qpw, q.p_name AS qt FROM lot JOIN part q ON lot.p_brand = q.p_brand AND lot.p_type = q.p_type),
    a AS (SELECT *, max(CAST(y = qy AS INTEGER)) OVER (PARTITION BY lot_id) AS any_y FROM c), b AS (SELECT * FROM a WHERE any_y = 0 OR y = qy OR (y < 2013 AND any_y = 0)),
    d AS (SELECT *, max(CAST(pw = qpw AS INTEGER)) OVER (PARTITION BY lot_id) AS any_p FROM b), e AS (SELECT * FROM d WHERE any_p = 0 OR pw = qpw),
    f AS (SELECT *, len(list_intersect(list_distinct(list_filter(string_split_regex(lower(t), '[^a-z0-9]+'), lambda x: x <> '')), list_distinct(list_filter(string_split_regex(lower(qt), '[^a-z0-9]+'), lambda x: x <> '')))) AS o FROM e)
    SELECT lot_id, CAST(count(*) FILTER (o >= 1) > 0 AS BOOLEAN) AS strict, CAST(coalesce(max(o), 0) AS INTEGER) AS most_words FROM f GROUP BY lot_id
""")
def linkage_strict(spark, sf_dir):
    """Whether a lot has a candidate of its make and model after the filters, and the words in common with the best."""
    lots_, prices = _versions(spark, sf_dir)
    best, _ = linkage.match(lots_, prices)
    strict = best.matching_type == "KEY_STRICT"
    return best.select("lot_id", F.coalesce(strict, F.lit(False)).alias("strict"), F.when(strict, F.col("token_overlap")).otherwise(0).cast("int").alias("most_words"))


_AS_QUERIES = {
    "auctions": ("recommend_best_auction", "count(*)", "sum(representation_pct)"), "brand": ("recommend_within_brand", "count(*)", "CAST(NULL AS DOUBLE)"), "attractive": ("recommend_attractiveness", "count(*)", "sum(n_lotes)"), "fuels": ("recommend_best_fuel_gap", "count(*)", "sum(gap)"),
}


@query(" UNION ALL ".join(f"SELECT '{name}' AS name, {n} AS n, round(CAST({total} AS DOUBLE), 4) AS total FROM ({ORACLE_SQL[q]})" for name, (q, n, total) in _AS_QUERIES.items()) + " UNION ALL SELECT 'segment', 20, NULL")
def configured_queries(spark, sf_dir):
    """Five queries of one configuration over all lots; what they share is computed once."""
    rows = lots(spark, sf_dir).withColumn("best_fuel_esp", F.col("combustible_norm")).withColumn("row_vs_best_fuel_%_esp", F.col("`mix_0_3_%_esp`"))
    config = {"queries": [
        {"name": "auctions", "type": "q1", "model": "standard", "top_n": 50, "filters": {"min_year": 1996, "max_year": 1999}}, {"name": "brand", "type": "q2", "brand": "^Brand#1$", "filters": {"min_year": 1997}},
        {"name": "segment", "type": "segment_order", "segment": "building", "region": "esp", "top_n": 20, "filters": {"min_year": 1995, "max_year": 1999}}, {"name": "attractive", "type": "q4", "model": "promo", "region": "esp", "filters": {"min_year": 1996, "max_year": 1998}},
        {"name": "fuels", "type": "q5", "year": 1997},
    ]}
    totals = {"auctions": "representation_pct", "attractive": "n_lotes", "fuels": "gap_vs_rest_mean"}
    out = None
    for p in runner.plans(rows, config):
        frame = p.extra if p.name == "auctions" else p.frame
        total = F.round(F.sum(F.round(totals[p.name], 6)).cast("double"), 4) if p.name in totals else F.lit(None).cast("double")
        one = frame.agg(F.count(F.lit(1)).alias("n"), total.alias("total")).select(F.lit(p.name).alias("name"), "n", "total")
        out = one if out is None else out.unionByName(one)
    return out


# --- text, labels, pages, records -----------------------------------------------------------------------------------


@query("SELECT doc_id, upper(trim(regexp_replace(regexp_replace(strip_accents(replace(trim(text), 'ß', 'ss')), '[^A-Za-z0-9_\\s]', '', 'g'), '\\s+', ' ', 'g'))) AS key, len(list_filter(string_split_regex(lower(strip_accents(text)), '[^a-z0-9]+'), lambda x: x <> '')) AS n_words FROM documents")
def text_keys(spark, sf_dir):
    """Folded keys and words of all texts."""
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", text.upper_key(F.col("text")).alias("key"), F.size(text.tokens(F.col("text"))).cast("long").alias("n_words"))


@query("SELECT event_type, user_id, CAST(count(*) AS BIGINT) AS n, CAST(user_id % 97 AS BIGINT) AS m FROM events GROUP BY ALL")
def repeat_counts(spark, sf_dir):
    e = lookup.repeats(table(spark, sf_dir, "events").withColumn("k", F.concat_ws("|", "event_type", "user_id")), "k")
    return e.select("event_type", "user_id", F.col("n_apariciones").alias("n"), (F.col("user_id") % 97).alias("m")).distinct()


@query("SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS i FROM events) WHERE i = 1")
def latest_rows(spark, sf_dir):
    return lookup.latest(table(spark, sf_dir, "events"), "user_id", [F.desc("ts"), F.desc("event_id")]).select("user_id", "event_id", "event_type")


@query("""
    SELECT page_id, lower(regexp_extract(url, '^https?://([^/?#]+)', 1)) AS host, nullif(regexp_extract(url, '[?&]page=([^&#]*)', 1), '') AS page,
           nullif(trim(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1)), '') AS title, len(list_distinct(regexp_extract_all(html, '<a\\s[^>]*href="([^"]+)"', 1))) AS n_links
    FROM pages
""")
def page_fields(spark, sf_dir):
    p = table(spark, sf_dir, "pages")
    return p.select("page_id", web.host(F.col("url")).alias("host"), web.query_value(F.col("url"), "page").alias("page"), web.title(F.col("html")).alias("title"), F.size(web.links(F.col("html"))).cast("long").alias("n_links"))


@query("""
    WITH y AS (SELECT DISTINCT p_brand, year(l_shipdate) AS y FROM lineitem JOIN part ON l_partkey = p_partkey WHERE l_quantity >= 49),
    b AS (SELECT p_brand, min(y) AS a, max(y) AS b, list(y) AS ys FROM y GROUP BY p_brand)
    SELECT p_brand, CAST(a AS INTEGER) AS first_year, CAST(b AS INTEGER) AS last_year, CAST(len(list_filter(range(a, b + 1), lambda x: NOT list_contains(ys, x))) AS BIGINT) AS n_missing FROM b
""")
def year_coverage(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").where("l_quantity >= 49").join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey")).withColumn("y", F.year("l_shipdate"))
    return lookup.year_gaps(rows, ["p_brand"], "y").select("p_brand", "first_year", "last_year", "n_missing")


@query("SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')")
def missing_keys(spark, sf_dir):
    t = lambda n: table(spark, sf_dir, n)
    return lookup.missing_from(t("customer").select("c_custkey"), t("orders").where("o_orderstatus = 'P'").withColumnRenamed("o_custkey", "c_custkey"), ["c_custkey"])


@query("SELECT p_partkey, category, price FROM (SELECT p_partkey, 'retail' AS category, p_retailprice AS price FROM part UNION ALL SELECT p_partkey, 'size', CAST(p_size AS DOUBLE) FROM part) WHERE price IS NOT NULL")
def long_prices(spark, sf_dir):
    return lookup.long_prices(table(spark, sf_dir, "part"), ["p_partkey"], {"retail": "p_retailprice", "size": "p_size"})


@query("""
    SELECT c_custkey, CASE c_mktsegment WHEN 'BUILDING' THEN 'B' WHEN 'MACHINERY' THEN 'M' ELSE 'none' END AS segmento FROM customer
""")
def segment_lookup(spark, sf_dir):
    dim = spark.createDataFrame([("Building", "x", "B"), (" machinery ", "X", "M")], "make_clean string, modelo_base string, segmento string")
    rows = table(spark, sf_dir, "customer").withColumn("m", F.lit(" x"))
    return lookup.segments(rows, dim, "c_mktsegment", "m").select("c_custkey", F.coalesce("segmento", F.lit("none")).alias("segmento"))


@query("SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN c_acctbal ELSE o_totalprice END AS amount FROM orders JOIN customer ON o_custkey = c_custkey")
def write_back(spark, sf_dir):
    t = lambda n: table(spark, sf_dir, n)
    left = t("orders").withColumn("amount", F.col("o_totalprice"))
    right = t("customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_acctbal").alias("amount"))
    return lookup.written_back(left, right, "o_custkey", ["amount"], F.col("o_orderstatus") == "F").select("o_orderkey", "amount")


@query("SELECT c_custkey, CASE WHEN c_acctbal > 0 THEN c_acctbal ELSE CAST(n_regionkey AS DOUBLE) END AS value FROM customer JOIN nation ON c_nationkey = n_nationkey")
def fill_missing(spark, sf_dir):
    t = lambda n: table(spark, sf_dir, n)
    left = t("customer").withColumn("value", F.when(F.col("c_acctbal") > 0, F.col("c_acctbal")))
    right = t("nation").select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_regionkey").cast("double").alias("value"))
    return lookup.filled_from(left, right, "c_nationkey", ["value"]).select("c_custkey", "value")


@query("SELECT l_returnflag, CAST(year(l_shipdate) * 100 + month(l_shipdate) AS BIGINT) AS yyyymm, CAST(year(l_shipdate + INTERVAL 5 MONTH) * 100 + month(l_shipdate + INTERVAL 5 MONTH) AS BIGINT) AS later, count(*) AS n FROM lineitem GROUP BY ALL")
def period_arithmetic(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").withColumn("yyyymm", numbers.period_of(F.date_format("l_shipdate", "dd/MM/yyyy")))
    return rows.groupBy("l_returnflag", "yyyymm", numbers.add_months(F.col("yyyymm"), 5).alias("later")).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT count(*) AS n_rows, count(*) FILTER (c_acctbal < 0) AS n_null FROM customer")
def sanity_report(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").withColumn("balance", F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")))
    return checks.sanity(rows, ["balance"]).select("n_rows", "n_null")


@query(f"""
    {_FEATURES}, t AS (SELECT units_abs / sum(units_abs) OVER (PARTITION BY region, anio) AS s FROM annual)
    SELECT count(*) FILTER (s < 0 OR s > 1.000000001) AS bad, (SELECT min(rank_general) FROM features) AS least_rank, (SELECT bool_and(units_abs = best_fuel_units) FROM features WHERE combustible = best_fuel) AS best_is_best FROM t
""")
def consistency_report(spark, sf_dir):
    f = market.features(regional(spark, sf_dir))
    return checks.consistency(f, ["share_año_%"], "rank_general", "is_best_fuel", "row_vs_best_fuel_%").select(F.col("bad_share_año_%").alias("bad"), "least_rank", "best_is_best")


@query(f"WITH {LOTS_SQL} SELECT marca, count(*) AS n, count(CASE WHEN margin_abs > 0 THEN lot_id END) AS n_matched, round(avg(margin_abs), 7) AS margin_abs_mean FROM lots GROUP BY marca")
def returns_by_model(spark, sf_dir):
    rows = price.margins(lots(spark, sf_dir)).withColumn("price_id", F.when(F.col("margin_abs") > 0, F.col("lot_id")))
    return checks.returns_by_model(rows, ["marca"]).select("marca", "n", "n_matched", F.round("margin_abs_mean", 7).alias("margin_abs_mean"))


@query("SELECT n_name, CASE WHEN n_nationkey % 2 = 0 THEN 'Par' ELSE upper(n_name) END AS label FROM nation")
def alias_lookup(spark, sf_dir):
    n = table(spark, sf_dir, "nation")
    aliases = n.where("n_nationkey % 2 = 0").select(F.lower("n_name").alias("alias"), F.lit("Par").alias("canonical"))
    return canon.aliased(n, F.col("n_name"), aliases, "alias", "canonical", "label", F.upper("n_name")).select("n_name", "label")


@query(f"WITH {LOTS_SQL} SELECT lot_id AS link_ficha, CAST(NULL AS VARCHAR) AS make_clean, CAST(anio AS VARCHAR) AS year_bca, combustible_norm, margin_abs FROM lots WHERE anio = 1998")
def listing_layout(spark, sf_dir):
    rows = lots(spark, sf_dir).where("anio = 1998").withColumn("link_ficha", F.col("lot_id"))
    return columns.conform(rows).select("link_ficha", "make_clean", F.col("year_bca").cast("string").alias("year_bca"), "combustible_norm", "margin_abs")


@query(f"WITH {LOTS_SQL} SELECT lot_id AS link_ficha, modelo AS modelo_base_x, anio AS year, mileage, CASE combustible_norm WHEN 'A' THEN 'DIESEL' WHEN 'N' THEN 'BEV' ELSE 'R' END AS combustible_norm, sale_name AS auction_name, margin_abs, segmento IS NULL AS no_segment FROM lots")
def results_layout(spark, sf_dir):
    """All lots in the layout of query results: names of the columns they are taken from, the fuel's label made of its type."""
    fuel = F.when(F.col("combustible_norm") == "A", "Diésel turbo").when(F.col("combustible_norm") == "N", "Eléctrico").otherwise(F.col("combustible_norm"))
    rows = lots(spark, sf_dir).withColumn("fuel_type", fuel).drop("combustible_norm").withColumnsRenamed({"lot_id": "link_ficha", "mileage": "km"})
    return columns.conform(rows, columns.RESULTS).select("link_ficha", "modelo_base_x", "year", F.col("mileage"), "combustible_norm", "auction_name", "margin_abs", F.col("segmento").isNull().alias("no_segment"))


# --- canonical labels -----------------------------------------------------------------------------------------------

# Labels as they come.
_FUEL_LABELS = [
    "Eléctrico", "BEV", " electric ", "Diésel", "DIESEL", "Gasóleo", "gasoleo", "Gasolina 95", "gasolina", "Petrol", "PHEV", "Híbrido enchufable", "Hibrido", "Hybrid", "MHEV", "GLP", "LPG", "GNC", "CNG", "Hidrógeno", "H2", "Hydrogen", "ICE", "FCEV",
    "steam", "gasolina y eléctrico", "Plug-in Hybrid", "Benzina", "",
]


def _pick(number, values):
    """One of the values by a number, in turn."""
    return F.element_at(F.array(*(F.lit(v) for v in values)), (number % len(values) + 1).cast("int"))


def _pick_sql(number: str, values) -> str:
    return f"[{', '.join(_sql_value(v) for v in values)}][1 + {number} % {len(values)}]"


@query(f"""
    WITH o AS (SELECT {_pick_sql("o_orderkey", _FUEL_LABELS)} AS raw, count(*) AS n FROM orders GROUP BY 1),
    k AS (SELECT *, lower(trim(raw)) AS low, upper(trim(raw)) AS up, upper(strip_accents(trim(raw))) AS folded FROM o), u AS (SELECT *, regexp_replace(folded, '[^A-Z0-9_ ]', '', 'g') AS key FROM k)
    SELECT raw, n,
        CASE WHEN lower(key) IN ('bev', 'electric', 'electrico', 'electrica', 'ev', 'elc') THEN 'electric' WHEN lower(key) IN ('phev', 'phevpetrol', 'diesel y electrico', 'gasolina y electrico', 'dye', 'gye') THEN 'phev'
            WHEN lower(key) IN ('hev', 'hevdiesel', 'hevpetrol', 'hybrid', 'hibrido', 'hibrida', 'mhevpetrol') THEN 'hev' WHEN lower(key) IN ('diesel', 'mhevdiesel', 'd') THEN 'diesel'
            WHEN lower(key) IN ('petrol', 'gasolina', 'gasolina95', 'gasolina98', 'flexfuel', 'cngpetrol', 'g', 'petrolethanol') THEN 'petrol' WHEN lower(key) IN ('cng', 'gnc', 'gnl', 'm') THEN 'cng' WHEN lower(key) IN ('lpg', 'glp', 's') THEN 'lpg'
            WHEN lower(key) IN ('hydrogen', 'h2', 'hidrogeno') THEN 'hydrogen' ELSE 'unknown' END AS fuel,
        CASE WHEN contains(low, 'bev') OR contains(low, 'eléctr') OR contains(low, 'electric') THEN 'BEV' WHEN contains(low, 'diesel') OR contains(low, 'diésel') THEN 'DIESEL' WHEN contains(low, 'gas') AND contains(low, 'lina') THEN 'GASOLINA'
            WHEN contains(low, 'phev') OR (contains(low, 'híbr') AND contains(low, 'ench')) OR contains(low, 'plug-in') THEN 'PHEV' WHEN contains(low, 'hibr') OR contains(low, 'hybrid') THEN 'HEV' ELSE upper(low) END AS label,
        CASE WHEN up IN ('ELECTRICO', 'ELÉCTRICO', 'EV', 'BEV') THEN 'BEV' WHEN up IN ('HIBRIDO', 'HÍBRIDO', 'HEV') THEN 'HEV' WHEN up IN ('HÍBRIDO ENCHUFABLE', 'HIBRIDO ENCHUFABLE', 'PHEV') THEN 'PHEV' WHEN up IN ('MHEV', 'GLP', 'GNC') THEN up
            WHEN up IN ('GASOLINA', 'DIESEL', 'DIÉSEL', 'GASÓLEO', 'ICE') THEN 'ICE' WHEN up IN ('HIDROGENO', 'HIDRÓGENO', 'FCEV') THEN 'FCEV' ELSE 'OTROS' END AS code,
        CASE WHEN regexp_matches(key, 'PHEV|PLUG') THEN 'PHEV' WHEN regexp_matches(key, 'HEV|HIBRIDO|MHEV') THEN 'HEV' WHEN regexp_matches(key, 'ELECTRICO|EV|BEV') THEN 'BEV' WHEN regexp_matches(key, 'DIESEL|GASOIL') THEN 'DIESEL'
            WHEN regexp_matches(key, 'GASOLINA|PETROL|BENZINA') THEN 'GASOLINA' ELSE 'OTROS' END AS bucket,
        lower(folded) IN ('electric', 'ev', 'bev') AS electric
    FROM u
""")
def fuel_labels(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").groupBy(_pick(F.col("o_orderkey"), _FUEL_LABELS).alias("raw")).agg(F.count(F.lit(1)).alias("n"))
    raw = F.col("raw")
    return rows.select("raw", canon.fuel(raw).alias("fuel"), canon.fuel_label(raw).alias("label"), canon.fuel_code(raw).alias("code"), canon.fuel_bucket(raw).alias("bucket"), canon.is_electric(raw).alias("electric"), "n")


# Gearbox, body, region, auction and sale status as they come, each in a turn of its own length.
_LISTING_LABELS = (
    ["Automático", "manual 6v", "CVT", " AUTO ", "MANUAL"], ["Range Estate", "Furgón", "Sedan", "Pickup", "Touring wagon", "Allroad SUV", "chassis cab"], ["Barcelona", "Cataluña", "España", "total nacional", "Aragón", "bcn", "prov. Barcelona"],
    ["Online Sale", " Ayvens ", "bca madrid", "", "Digital", "BCA Madrid"], ["Sold", "not sold", "Vendido", "Sale ended", "no vendido", "closed", "unsold", "open", " SOLD "],
)


@query(f"""
    WITH o AS (SELECT {", ".join(f"{_pick_sql('o_orderkey', values)} AS {name}" for name, values in zip(("box", "style", "area", "sale", "status"), _LISTING_LABELS))} FROM orders),
    k AS (SELECT box, lower(strip_accents(trim(box))) AS b, lower(strip_accents(style)) AS s, upper(strip_accents(trim(area))) AS a, sale, trim(lower(sale)) AS l, lower(trim(status)) AS t FROM o),
    f AS (SELECT box, CASE WHEN contains(b, 'auto') THEN 'automatic' WHEN contains(b, 'man') THEN 'manual' ELSE b END AS gearbox,
            CASE WHEN regexp_matches(s, 'suv|estate|station|touring|allroad') THEN 'suv' WHEN regexp_matches(s, 'van|furg|lcv|box|chasis|chassis|pickup|transporter') THEN 'lcv' ELSE 'passenger_car' END AS body,
            CASE WHEN a = 'BCN' OR contains(a, 'BARCELONA') THEN 'BCN' WHEN a = 'CAT' OR contains(a, 'CATAL') THEN 'CAT' WHEN contains(a, 'ESP') OR contains(a, 'NACIO') OR contains(a, 'TOTAL') THEN 'ESP' ELSE a END AS region,
            CASE WHEN l = 'bca madrid' THEN 'BCA' WHEN contains(l, 'online') OR contains(l, 'digital') THEN 'Online' WHEN l = '' THEN 'Otros' ELSE trim(sale) END AS auction,
            (contains(t, 'sold') OR contains(t, 'vendido') OR contains(t, 'sale ended') OR contains(t, 'closed')) AND t NOT IN ('not sold', 'no vendido', 'unsold') AS sold, t = 'sold' AS sold_exact FROM k)
    SELECT *, count(*) AS n FROM f GROUP BY ALL
""")
def listing_labels(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select(*(_pick(F.col("o_orderkey"), values).alias(name) for name, values in zip(("box", "style", "area", "sale", "status"), _LISTING_LABELS)))
    c = F.col
    found = rows.select("box", canon.gearbox(text.fold(c("box"))).alias("gearbox"), canon.body_category(c("style")).alias("body"), canon.region_code(c("area")).alias("region"), F.trim(canon.auction(c("sale"), {"BCA Madrid": "BCA"})).alias("auction"), canon.sold(c("status")).alias("sold"), canon.sold_exact(c("status")).alias("sold_exact"))
    return found.groupBy(*found.columns).agg(F.count(F.lit(1)).alias("n"))


@query("""
    SELECT l_linenumber, CASE l_linenumber % 4 WHEN 0 THEN 'Gasolina' WHEN 1 THEN 'Diesel' WHEN 2 THEN 'Electrico' ELSE 'Otros' END AS fuel, CASE WHEN l_linenumber = 4 THEN 'Turismo' WHEN l_linenumber = 5 THEN 'Motocicleta' WHEN l_linenumber = 2 THEN 'Furgoneta' ELSE 'Otros' END AS kind,
           lpad(CAST(l_suppkey % 100 AS VARCHAR), 5, '0') AS code, CASE WHEN p_brand = 'Brand#11' THEN 'first' WHEN starts_with(p_brand, 'Brand#') THEN 'own' END AS family, count(*) AS n
    FROM lineitem JOIN (SELECT p_partkey, p_brand FROM part) ON l_partkey = p_partkey GROUP BY ALL
""")
def registry_codes(spark, sf_dir):
    """Codes of the registration files, place codes, and makes by their longest known beginning."""
    rows = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
    spaced = F.regexp_replace("p_brand", "#", " ")
    found = rows.select(
        "l_linenumber", canon.registry_fuel((F.col("l_linenumber") % 4).cast("string")).alias("fuel"), canon.registry_type((F.col("l_linenumber") * 10).cast("string")).alias("kind"),
        numbers.padded_code((F.col("l_suppkey") % 100).cast("double"), 5).alias("code"), canon.longest_prefix(spaced, {"Brand": "own", "Brand 11": "first"}).alias("family"),
    )
    return found.groupBy(*found.columns).agg(F.count(F.lit(1)).alias("n"))


@query("""
    SELECT doc_id, TRY_CAST(nullif(regexp_extract(text, '((?:19|20)[0-9]{2})', 1), '') AS INTEGER) AS year, nullif(regexp_extract(text, '\\b([0-9]{4,6})\\b', 1), '') AS zip,
           regexp_replace(trim(CAST(CAST(doc_id AS DOUBLE) AS VARCHAR)), '\\.0$', '') AS id_text, coalesce(nullif(trim(source), ''), lang) AS first_filled, concat_ws(' - ', nullif(trim(source), ''), nullif(trim(lang), '')) AS pair
    FROM documents
""")
def text_fields(spark, sf_dir):
    """Years, codes and ids in all texts."""
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", text.year_in(F.col("text")).alias("year"), text.zip_candidate(F.col("text")).alias("zip"), text.id_text(F.col("doc_id").cast("double").cast("decimal(20,1)")).alias("id_text"), text.first_filled(F.col("source"), F.col("lang")).alias("first_filled"), text.labelled_pair(F.col("source"), F.col("lang")).alias("pair"))


@query("""
    WITH u AS (SELECT page_id, regexp_replace(url, '[?#].*$', '') || '/?Page=' || page_id || '&b=2&A=1#top' AS url FROM pages)
    SELECT page_id, regexp_replace(lower(split_part(url, '?', 1)), '/+$', '') || '?a=1&b=2&page=' || page_id AS sorted, 'lot:' || page_id AS lot, 'https://' || lower(regexp_extract(url, '^https?://([^/?#]+)', 1)) || '/Lot?id=' || page_id AS canonical,
           split_part(url, '#', 1) || '&n=' || page_id AS with_n
    FROM u
""")
def url_keys(spark, sf_dir):
    """Addresses in their sorted form, their stable keys, and with a parameter set."""
    bare = F.regexp_replace("url", "[?#].*$", "")
    p = table(spark, sf_dir, "pages").select("page_id", F.concat(bare, F.lit("/?Page="), "page_id", F.lit("&b=2&A=1#top")).alias("url"), F.concat(bare, F.lit("/view?id="), "page_id").alias("lot_url"))
    url, lot = F.col("url"), F.col("lot_url")
    return p.select("page_id", web.sorted_url(url).alias("sorted"), web.stable_key(lot).alias("lot"), web.lot_url(lot).alias("canonical"), web.with_query(url, "n", F.col("page_id")).alias("with_n"))


# --- standardization and places -------------------------------------------------------------------------------------


@query("""
    WITH r AS (
        SELECT CASE WHEN p_brand IN ('Brand#11', 'Brand#12') THEN 'FIRST MAKE' ELSE replace(upper(p_brand), '#', '') END AS marca, upper(replace(p_type, '#', '')) AS modelo, CASE l_returnflag WHEN 'A' THEN 'DIESEL' WHEN 'N' THEN 'BEV' ELSE 'OTROS' END AS combustible,
               CAST(year(l_shipdate) AS BIGINT) AS anio, CAST(year(l_shipdate) * 100 + month(l_shipdate) AS BIGINT) AS yyyymm, lpad(CAST(l_suppkey % 52 AS VARCHAR), 5, '0') AS codigo_ine
        FROM lineitem JOIN part ON l_partkey = p_partkey
    )
    SELECT marca, modelo, combustible, anio, yyyymm, codigo_ine, left(codigo_ine, 2) AS codigo, count(*) AS n FROM r GROUP BY ALL
""")
def standardized_records(spark, sf_dir):
    """Transfer records under their own column names: dates, months, years, folded keys, codes, mapped makes and fuels."""
    rows = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
    raw = rows.select(
        F.col("p_brand").alias("marca"), F.lower("p_type").alias("modelo"), F.when(F.col("l_returnflag") == "N", " Eléctrico").otherwise(F.col("l_returnflag")).alias("combustible"),
        F.date_format("l_shipdate", "dd/MM/yyyy").alias("fecha_mat"), (F.col("l_suppkey") % 52).cast("string").alias("codigo_ine"),
    )
    brands = spark.createDataFrame([("brand#11", "First make"), ("BRAND 12", "nobody"), ("Bránd#12", "first make")], "alias string, canonical string")
    fuels = spark.createDataFrame([("a", "DIESEL"), ("ELECTRICO", "BEV")], "alias string, canonical string")
    found = market.standardized(raw, brands, fuels)
    names = ["marca", "modelo", "combustible", "anio", "yyyymm", "codigo_ine", "codigo"]
    return found.groupBy(*names).agg(F.count(F.lit(1)).alias("n"))


@query(f"""
    WITH {MARKET_SQL} SELECT lpad(CAST(place AS VARCHAR), 5, '0') AS codigo_ine, yyyymm, count(*) AS unidades, round(avg(antiguedad_anios), 6) AS age, CASE WHEN place % 2 = 0 THEN 'EVEN ' || place END AS province FROM market GROUP BY place, yyyymm
""")
def places_month(spark, sf_dir):
    """Months by place code, with the province of those codes that the place table has."""
    rows = market_rows(spark, sf_dir).withColumn("codigo_ine", F.col("place").cast("string"))
    months = market.aggregate_month(rows, ["codigo_ine", "yyyymm"])
    places = table(spark, sf_dir, "nation").where("n_nationkey % 2 = 0").select(F.col("n_nationkey").cast("double").alias("codigo_ine"), F.concat(F.lit("éven "), "n_nationkey").alias("provincia"))
    found = market.normalized_places(months, places)
    return found.select("codigo_ine", "yyyymm", "unidades", F.round("antiguedad_media", 6).alias("age"), F.col("provincia_norm").alias("province"))


@query(f"""
    WITH {REGIONAL_SQL}, y AS (
        SELECT marca, modelo, anio, combustible, yyyymm, avg(antiguedad_anios) AS a, quantile_cont(antiguedad_anios, 0.75) AS q FROM market GROUP BY ALL
    )
    SELECT marca, modelo, anio, combustible, round(avg(a), 6) AS antiguedad_media, round(avg(q), 6) AS p75 FROM y GROUP BY ALL
""")
def cohort_ages(spark, sf_dir):
    """Means of the months' mean ages, each month counting the same."""
    months = market.aggregate_month(market_rows(spark, sf_dir), ["marca", "modelo", "anio", "combustible", "yyyymm"]).withColumn("region", F.lit("ESP"))
    months = months.withColumnRenamed("p75_antiguedad", "p75_antiguedad")
    cohorts = months.select(*market.COHORT).distinct()
    found = market.ages(cohorts, months)
    return found.select("marca", "modelo", "anio", "combustible", F.round("antiguedad_media", 6).alias("antiguedad_media"), F.round("p75_antiguedad", 6).alias("p75"))


# --- picks, reports, filters ----------------------------------------------------------------------------------------


@query("""
    SELECT c_custkey, CASE WHEN c_acctbal > 5000 THEN 'rich' ELSE 'all' END AS origin, CASE WHEN c_acctbal > 5000 THEN NULL ELSE c_mktsegment END AS segment FROM customer
""")
def first_of_frames(spark, sf_dir):
    """Each key from the first frame that has it; columns that a frame lacks are null."""
    c = table(spark, sf_dir, "customer")
    rich = c.where("c_acctbal > 5000").select("c_custkey", F.lit("rich").alias("origin"))
    every = c.select("c_custkey", F.lit("all").alias("origin"), F.col("c_mktsegment").alias("segment"))
    return lookup.first_of([rich, every], "c_custkey", ["origin"]).select("c_custkey", "origin", "segment")


@query(f"""
    WITH {LOTS_SQL}, k AS (SELECT CASE WHEN margin_abs > 20000 THEN 'KEY_STRICT' WHEN margin_abs > 0 THEN 'HINT' ELSE 'NONE' END AS kind, CASE WHEN margin_abs > 0 THEN 1 ELSE 0 END AS m FROM lots)
    SELECT 'kind' AS part, kind AS name, CAST(count(*) AS DOUBLE) AS value FROM k GROUP BY kind
    UNION ALL SELECT 'flag', 'matched', round(avg(m), 6) FROM k
    UNION ALL SELECT 'stage', 'exact:' || kind, CAST(count(*) AS DOUBLE) FROM k WHERE kind <> 'NONE' GROUP BY kind
""")
def match_coverage(spark, sf_dir):
    """Lots by kind of match, the share of a flag, and the counts of failed steps."""
    margin = F.col("margin_abs")
    rows = lots(spark, sf_dir).withColumns({"matching_type": F.when(margin > 20000, "KEY_STRICT").when(margin > 0, "HINT"), "matched": margin > 0})
    kinds, flags = checks.coverage(rows, "matching_type", ["matched"])
    steps = checks.failures(rows.withColumn("exact", F.col("matching_type")), ["exact"])
    out = kinds.select(F.lit("kind").alias("part"), F.col("matching_type").alias("name"), F.col("n").cast("double").alias("value"))
    out = out.unionByName(flags.select(F.lit("flag").alias("part"), F.col("flag").alias("name"), F.round("share", 6).alias("value")))
    return out.unionByName(steps.select(F.lit("stage").alias("part"), F.concat_ws(":", "stage", "step").alias("name"), F.col("n").cast("double").alias("value")))


@query(f"WITH {LOTS_SQL} SELECT lot_id, round(margin_abs, 6) AS margin_abs FROM lots WHERE margin_abs > 0 ORDER BY lots.margin_abs DESC, lot_id LIMIT 50")
def top_margins(spark, sf_dir):
    """The analysis table of the fifty greatest margins among matched lots."""
    rows = price.margins(lots(spark, sf_dir)).withColumns({"price_id": F.when(F.col("margin_abs") > 0, F.col("lot_id")), "matching_type": F.lit("HINT"), "matched": F.col("margin_abs") > 0})
    return checks.sheets(rows, ["marca"])["top_margin_abs"].select("lot_id", F.round("margin_abs", 6).alias("margin_abs"))


@query("""
    SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN o_totalprice ELSE coalesce(CASE WHEN o_orderkey % 3 = 1 THEN 7.5 END, 0.0) END AS transport_eur FROM orders
""")
def direct_or_mean_price(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey") % 3
    rows = o.withColumns({"transport_direct": F.when(k == 0, F.col("o_totalprice")).when(k == 1, F.lit(0.0)), "transport_fallback": F.when(k == 1, F.lit(7.5))})
    return price.direct_or_mean(rows).select("o_orderkey", "transport_eur")


@query(f"""
    WITH {LOTS_SQL}
    SELECT lot_id, anio, mileage FROM lots WHERE 1998 - anio <= 2 AND precio_final_eur BETWEEN 10000 AND 60000 AND mileage <= 100000 AND sale_country <> 'NATION_3' AND combustible_norm IN ('N', 'R')
""")
def listing_filters(spark, sf_dir):
    """Age, price, mileage, type words, barred types and fuels, one after the other."""
    rows = lots(spark, sf_dir).withColumn("tipo_vehiculo", F.when(F.col("sale_country") != "NATION_3", F.lit("TURISMO")).otherwise("Moto"))
    f = filters.Listing(max_age=2, as_of=1998, price=(10000, 60000), mileage=(None, 100000), fuels=("N", "R"))
    found = filters.without_types(filters.vehicle_types(filters.listings(rows, f), ["turismo", "moto"]), ("MOTO",))
    return filters.with_links(found, "lot_id", "marca").select("lot_id", "anio", "mileage")


# --- nested data of pages -------------------------------------------------------------------------------------------


@query("""
    SELECT page_id, 'V' || page_id AS vin, CASE page_id % 3 WHEN 0 THEN 'auto' WHEN 1 THEN 'manual' END AS gearbox, 'land ' || page_id % 7 AS country, 'http' || page_id % 11 AS place, 'make' || page_id % 5 AS make, CAST(page_id AS VARCHAR) AS lot,
        CASE page_id % 3 WHEN 2 THEN 14 ELSE 15 END AS n_keys, length(url) AS n_url
    FROM pages
""")
def page_data(spark, sf_dir):
    """Data in scripts of all pages, made of their fields: keys at any depth, labels of several languages, the vehicle of the product."""
    n = F.col("page_id").cast("string")
    box = F.when(F.col("page_id") % 3 == 0, "auto").when(F.col("page_id") % 3 == 1, "manual")
    blob = F.to_json(F.struct(
        F.struct(F.struct(F.concat(F.lit("make"), (F.col("page_id") % 5).cast("string")).alias("make"), F.col("page_id").alias("lot"), F.col("url").alias("page")).alias("vehicle")).alias("product"),
        F.array(F.struct(F.lit("Numéro de châssis").alias("label"), F.concat(F.lit("V"), n).alias("value"))).alias("specs"),
        F.struct(F.array(F.array(F.struct(F.concat(F.lit("land "), (F.col("page_id") % 7).cast("string")).alias("Pays"), box.alias("Gear-Box")))).alias("deep")).alias("z"),
    ))
    first = F.to_json(F.struct(F.struct(F.concat(F.lit("http"), (F.col("page_id") % 11).cast("string")).alias("Standort")).alias("where")))
    html = F.concat(F.lit("<script>digitalData.push( "), blob, F.lit(" ) ;\nwindow.digitalData = "), first, F.lit(";</script>"), F.coalesce("html", F.lit("")))
    pages = table(spark, sf_dir, "pages").select("page_id", "url", html.alias("html"))
    rows = nested.walked(pages.withColumn("json", nested.blobs(F.col("html"))), "json")
    e = F.col("entries")
    found = rows.select("page_id", nested.picked(e).alias("p"), nested.vehicle(e).alias("v"), F.size("entries").alias("n_keys"), F.filter(e, lambda x: x["key"] == "page").alias("u"))
    return found.select("page_id", F.col("p.bastidor").alias("vin"), F.col("p.caja_cambios").alias("gearbox"), F.col("p.pais_subasta").alias("country"), F.col("p.ubicacion").alias("place"), F.col("v.make").alias("make"), F.col("v.lot").alias("lot"), "n_keys", F.length(F.get("u", F.lit(0))["value"]).cast("long").alias("n_url"))


# --- calendars, origins, tables and payloads of pages, files --------------------------------------------------------


@query("""
    WITH o AS (SELECT o_orderkey, strftime(o_orderdate, '%d/%m') AS day, CASE o_orderkey % 3 WHEN 0 THEN 'Spain ' WHEN 1 THEN 'france' ELSE 'Italy' END AS country, o_orderpriority || CASE WHEN o_orderkey % 5 = 0 THEN ' Sealed Bid' ELSE '' END AS name,
        CASE o_orderkey % 4 WHEN 0 THEN 'icon--live' WHEN 1 THEN 'icon--live, ICON--SEALED' ELSE NULL END AS icons, CASE o_orderkey % 7 WHEN 0 THEN ' ' WHEN 1 THEN NULL ELSE 'x' END AS a, CASE o_orderkey % 2 WHEN 0 THEN '' ELSE 'y' END AS b FROM orders)
    SELECT country, coalesce(trim(a), '') = '' AND trim(b) = '' AS all_blank, coalesce(trim(a), '') = '' OR trim(b) = '' AS any_blank, o_orderkey % 6 < 2 OR o_orderkey % 10 = 0 AS heavy, count(*) AS n FROM o
    WHERE day = '14/03' AND country IN ('Spain ', 'france') AND NOT contains(lower(name), 'sealed bid') AND NOT contains(lower(coalesce(icons, '')), 'icon--sealed') GROUP BY ALL
""")
def sale_calendar(spark, sf_dir):
    """Orders as sales of a day: barred names and icons, countries, blank fields, resources that a load leaves out."""
    key = F.col("o_orderkey")
    rows = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.date_format("o_orderdate", "dd/MM").alias("sale_date"), F.when(key % 3 == 0, "Spain ").when(key % 3 == 1, "france").otherwise("Italy").alias("country"), F.concat("o_orderpriority", F.when(key % 5 == 0, " Sealed Bid").otherwise("")).alias("name"),
        F.when(key % 4 == 0, "icon--live").when(key % 4 == 1, "icon--live, ICON--SEALED").alias("icons"), F.when(key % 7 == 0, " ").when(key % 7 > 1, "x").alias("a"), F.when(key % 2 == 0, "").otherwise("y").alias("b"),
        F.when(key % 6 == 0, "image").when(key % 6 == 1, "font").otherwise("xhr").alias("kind"), F.concat(F.lit("http://h/"), key.cast("string"), F.when(key % 10 == 0, ".PNG").otherwise("/x")).alias("url"),
    )
    found = filters.calendar(rows, "14/03", ("sealed bid",), ("Spain", "France"), ("icon--sealed",))
    out = found.select("country", filters.all_blank(F.col("a"), F.col("b")).alias("all_blank"), filters.any_blank(F.col("a"), F.col("b")).alias("any_blank"), filters.heavy_resource(F.col("url"), F.col("kind")).alias("heavy"))
    return out.groupBy(*out.columns).agg(F.count(F.lit(1)).alias("n"))


@query("""
    WITH c AS (SELECT c_custkey, c_nationkey, CASE c_custkey % 4 WHEN 0 THEN 'Europe' WHEN 1 THEN '' WHEN 2 THEN 'NATION ' || c_nationkey ELSE 'nowhere' END AS country, CASE c_custkey % 3 WHEN 0 THEN 'Town ' || c_nationkey WHEN 1 THEN 'Nation-' || c_nationkey ELSE 'Far, land' END AS place FROM customer)
    SELECT CASE WHEN country IN ('Europe', '') THEN CASE WHEN starts_with(place, 'Far') THEN 'Far' ELSE n_name END WHEN starts_with(country, 'NATION') THEN n_name ELSE country END AS origin, count(*) AS n
    FROM c JOIN nation ON c_nationkey = n_nationkey GROUP BY 1
""")
def sale_origins(spark, sf_dir):
    """Countries of all customers: aliases first, a generic one by its place's head, as a place or as a country."""
    nation = table(spark, sf_dir, "nation")
    key, own = F.col("c_custkey"), F.col("c_nationkey").cast("string")
    country = F.when(key % 4 == 0, "Europe").when(key % 4 == 1, "").when(key % 4 == 2, F.concat(F.lit("nation-"), own)).otherwise("nowhere")
    place = F.when(key % 3 == 0, F.concat(F.lit("Town "), own, F.lit(" – dock 4"))).when(key % 3 == 1, F.concat(F.lit("Nation-"), own, F.lit(", hall"))).otherwise("Far, land")
    rows = table(spark, sf_dir, "customer").select(country.alias("country"), place.alias("place"))
    countries = nation.select(F.concat(F.lit("NATION "), F.col("n_nationkey").cast("string")).alias("variant"), F.col("n_name").alias("country_canonical"))
    places = nation.select(F.concat(F.lit("town "), F.col("n_nationkey").cast("string")).alias("location_head"), F.col("n_name").alias("country_canonical"))
    return canon.origin_country(rows, "country", "place", countries, places).groupBy("origin").agg(F.count(F.lit(1)).alias("n"))


@query("""
    SELECT page_id, CAST(page_id * 1000 + 500 AS BIGINT) AS km, CAST(90 + page_id % 100 AS INTEGER) AS hp, CAST(page_id % 200 AS INTEGER) AS co2, 'Auto ' || page_id AS gearbox, 3 AS n_pairs FROM pages
""")
def page_tables(spark, sf_dir):
    """Tables in front of all pages, read by patterns and by a parser, and the figures in them."""
    n = F.col("page_id")
    km = F.concat((n + 0).cast("string"), F.lit(".500 km"))
    front = F.concat(
        F.lit("<table><tr><td>Km</td><td> "), km, F.lit(" </td></tr><tr><th>Power</th><td><b>"), (90 + n % 100).cast("string"), F.lit(" CV</b> / "), (n % 200).cast("string"), F.lit(" g/km</td></tr><tr><td>alone</td></tr><tr><td>Getriebe</td><td>Auto "), n.cast("string"), F.lit("</td></tr></table>"),
    )
    rows = table(spark, sf_dir, "pages").select("page_id", web.two_column_table(front).alias("m"), web.table_pairs(front).alias("p"))
    return rows.select("page_id", web.mileage(F.col("m")["Km"]).alias("km"), web.horsepower(F.col("m")["Power"]).alias("hp"), web.co2(F.col("m")["Power"]).alias("co2"), F.get(F.filter("p", lambda x: nested.label_name(x["label"]) == "caja cambios"), F.lit(0))["value"].alias("gearbox"), F.size("p").alias("n_pairs"))


@query("SELECT CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS k, event_type AS kind, count(*) AS n FROM events GROUP BY ALL")
def event_payloads(spark, sf_dir):
    """Fields of all events' payloads, each the first of its paths that is there."""
    e = table(spark, sf_dir, "events")
    body = F.concat(F.lit('{"a":{"type":'), F.when(F.col("event_id") % 2 == 0, F.concat(F.lit('"'), "event_type", F.lit('"'))).otherwise(F.lit('""')), F.lit('},"type":"'), "event_type", F.lit('",'), F.substring("props", 2, 1000))
    k, kind = web.payload_fields(body, "a struct<type: string>, type string, k long", {"k": ("k",), "kind": ("a.type", "type")})
    return e.select(k, kind).groupBy("k", "kind").agg(F.count(F.lit(1)).alias("n"))


@query("""
    SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'Año ' ELSE 'Preis € ' END || o_orderpriority AS note, CASE WHEN o_orderkey % 3 = 1 THEN NULL ELSE o_orderstatus END AS status FROM orders
""")
def mixed_text_files(spark, sf_dir):
    """All orders written as text tables of three encodings and separators, and read back as one."""
    root = f"{shared_folder(spark)}/texts-{uuid.uuid4().hex}"
    key = F.col("o_orderkey")
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.concat(F.when(key % 3 == 0, "Año ").otherwise("Preis € "), "o_orderpriority").alias("note"), F.col("o_orderstatus").alias("status"))
    c1252 = F.translate("note", "€", "\x80")
    for i, (part, sep, encoding) in enumerate((
        (o.where(key % 3 == 0), ";", "ISO-8859-1"), (o.where(key % 3 == 1).select("o_orderkey", c1252.alias("note")), "|", "ISO-8859-1"), (o.where(key % 3 == 2), ",", "UTF-8"),
    )):
        part.write.option("header", True).option("sep", sep).option("encoding", encoding).csv(f"{root}/{i}")
    return readers.read_any(spark, [f"{root}/{i}" for i in range(3)], "csv").select(F.col("o_orderkey").cast("long").alias("o_orderkey"), "note", "status")


# --- profiles -------------------------------------------------------------------------------------------------------


def _profile_sql(column: str, number: bool) -> str:
    bounds = f"CAST(min({column}) AS DOUBLE) AS low, CAST(max({column}) AS DOUBLE) AS high, CAST(NULL AS VARCHAR) AS low_text, CAST(NULL AS VARCHAR) AS high_text, round(avg(CAST({column} AS DOUBLE)), 6) AS mean" if number else f"NULL, NULL, min({column}), max({column}), NULL"
    return f"SELECT '{column}' AS column_name, count(*) AS n, count(*) - count({column}) AS n_null, {bounds}, true AS near FROM lineitem"


_PROFILED = {"l_orderkey": True, "l_quantity": True, "l_extendedprice": True, "l_discount": True, "l_linenumber": True, "l_returnflag": False}


@query(" UNION ALL ".join(_profile_sql(c, number) for c, number in _PROFILED.items()))
def column_profile(spark, sf_dir):
    """Columns of all line items, sketched by month of shipping and merged; ``near`` says that the distinct count and the median hold their errors."""
    rows = table(spark, sf_dir, "lineitem").select(F.date_format("l_shipdate", "yyyyMM").alias("month"), *_PROFILED)
    found = settled(profile.merged(profile.sketched(rows, ["month"])))
    exact = rows.agg(*(F.count_distinct(c).alias(c) for c in _PROFILED)).unpivot([], list(_PROFILED), "column", "exact")
    middle = profile.ranks(rows, found.select("column", F.get("quantiles", F.lit(1)).alias("value")), [c for c, number in _PROFILED.items() if number])
    last = F.col("n") - F.col("n_null") - 1
    # The estimate is one of the values, so it lies between these two percentiles if its places do.
    between = (F.col("not_above") > F.ceil(last * 0.46)) & (F.col("below") <= F.floor(last * 0.54))
    near = (F.abs(F.col("n_distinct") - F.col("exact")) <= 0.04 * F.col("exact")) & F.coalesce(between, F.col("quantiles").isNull())
    return found.join(exact, "column").join(middle, "column", "left").select(F.col("column").alias("column_name"), "n", "n_null", "low", "high", "low_text", "high_text", F.round("mean", 6).alias("mean"), near.alias("near"))


# --- transfer files -------------------------------------------------------------------------------------------------


@query(r"""
    WITH r AS (SELECT strftime(l_shipdate, '%d/%m/%Y') AS fecha_mat, 'M' || replace(p_brand, 'Brand#', '') AS marca, upper(p_type) AS modelo, upper(p_type || ' ' || p_name) AS submodelo, year(l_shipdate) AS y,
        l_linenumber % 2 = 0 AS masked, l_partkey, l_linenumber, CASE l_returnflag WHEN 'A' THEN 'GASOLINA' WHEN 'N' THEN 'DIESEL' ELSE 'ELECTRICO' END AS fuel, lpad(CAST(l_suppkey % 52 + 1 AS VARCHAR), 2, '0') AS province
        FROM lineitem JOIN part ON l_partkey = p_partkey)
    SELECT fecha_mat, marca, modelo, submodelo, CASE WHEN masked THEN 'V' || lpad(CAST(l_partkey AS VARCHAR), 10, '0') || '***********' ELSE '1V' || lpad(CAST(l_partkey AS VARCHAR), 16, '0') END AS vin, fuel AS combustible, province || '001' AS codigo_ine,
        CASE WHEN l_linenumber % 3 = 0 THEN 'TURISMO' ELSE 'FURGONETA' END AS tipo_vehiculo, CASE WHEN masked THEN '2025-03' ELSE '2024-12' END AS transmision, 2025 - y AS antiguedad_anios, province AS codigo_provincia, count(*) AS n
    FROM r GROUP BY ALL
""")
def transfer_records(spark, sf_dir):
    """Line items written as transfer files of both layouts, and their records read back."""
    rows = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
    fuel = F.when(F.col("l_returnflag") == "A", "GASOLINA").when(F.col("l_returnflag") == "N", "DIESEL").otherwise("ELECTRICO")
    masked = F.col("l_linenumber") % 2 == 0
    key = F.col("l_partkey").cast("string")
    rows = rows.select(
        masked.alias("masked"), F.date_format("l_shipdate", "dd/MM/yyyy").alias("fecha_mat"), F.concat(F.lit("M"), F.replace("p_brand", F.lit("Brand#"), F.lit(""))).alias("marca"), F.upper(F.concat_ws(" ", "p_type", "p_name")).alias("submodelo"),
        F.when(masked, F.concat(F.lit("V"), F.lpad(key, 10, "0"))).otherwise(F.concat(F.lit("1V"), F.lpad(key, 16, "0"))).alias("vin"), F.when(F.col("l_linenumber") % 3 == 0, "TURISMO").otherwise("FURGONETA").alias("tipo_vehiculo"), fuel.alias("combustible"),
        F.concat(F.lpad((F.col("l_suppkey") % 52 + 1).cast("string"), 2, "0"), F.lit("001")).alias("codigo_ine"), F.lit("LOCALIDAD").alias("localidad"),
    )
    root = f"{shared_folder(spark)}/transfers-{uuid.uuid4().hex}"
    month = F.when(F.col("masked"), "202503").otherwise("202412")
    # One scan writes the folders of both months.
    transfer_files.as_lines(rows, F.col("masked"), month.alias("transmisiones")).write.partitionBy("transmisiones").text(root)
    found = transfer_files.records(transfer_files.lines(spark, root, "folder"), 2025)
    keys = ["fecha_mat", "marca", "modelo", "submodelo", "vin", "combustible", "codigo_ine", "tipo_vehiculo", "transmision", "antiguedad_anios", "codigo_provincia"]
    return found.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


# --- streams --------------------------------------------------------------------------------------------------------


@query("""
    SELECT user_id, event_id, event_type, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS i FROM events) WHERE i = 1
""")
def stream_latest_events(spark, sf_dir):
    """All events as a stream of six files, a batch each: keyed state gives the changes, folded to the latest row of each user."""
    root = f"{shared_folder(spark)}/stream-{uuid.uuid4().hex}"
    events = table(spark, sf_dir, "events")
    events.repartitionByRange(6, "event_id").write.parquet(f"{root}/in")
    stream = latest.latest_changes(ingest.new_files(spark, f"{root}/in", events.schema, per_run=1), ["user_id"], ["ts", "event_id"])
    stream.writeStream.option("checkpointLocation", f"{root}/mark").trigger(availableNow=True).outputMode("update").foreachBatch(latest.changes_to(f"{root}/out")).start().awaitTermination()
    return latest.folded(spark.read.parquet(f"{root}/out"), ["user_id"], ["ts", "event_id"]).select("user_id", "event_id", "event_type", "value")


# --- model names and linkage ----------------------------------------------------------------------------------------

QUERIES.update(model_queries.QUERIES)
ORACLE_SQL.update(model_queries.ORACLE_SQL)
