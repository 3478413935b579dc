"""Views of the driver's star schema under the engine's names."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def market(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as registrations: make, model, fuel, year, month, units, age, province and its code.

    Supplier, nation and region are small dimensions that the planner broadcasts by their statistics.
    """
    t = lambda n: table(spark, sf_dir, n)
    places = t("supplier").join(t("nation"), F.col("s_nationkey") == F.col("n_nationkey")).join(t("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    rows = t("lineitem").join(t("part"), F.col("l_partkey") == F.col("p_partkey")).join(places, F.col("l_suppkey") == F.col("s_suppkey"))
    day = F.col("l_shipdate")
    return rows.select(
        F.col("p_brand").alias("marca"), F.col("p_type").alias("modelo"), F.col("l_returnflag").alias("combustible"),
        F.year(day).cast("long").alias("anio"), (F.year(day) * 100 + F.month(day)).cast("long").alias("yyyymm"),
        F.col("l_quantity").alias("unidades"), (F.col("p_size") / 5.0).alias("antiguedad_anios"),
        F.col("n_name").alias("provincia"), F.lpad(F.col("n_nationkey").cast("string"), 2, "0").alias("codigo"), F.col("r_name").alias("area"), F.col("n_nationkey").alias("place"),
    )


MARKET_SQL = """
    market AS (
        SELECT p_brand AS marca, p_type AS modelo, l_returnflag AS combustible, CAST(year(l_shipdate) AS BIGINT) AS anio,
               CAST(year(l_shipdate) * 100 + month(l_shipdate) AS BIGINT) AS yyyymm, l_quantity AS unidades, p_size / 5.0 AS antiguedad_anios,
               n_name AS provincia, lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS codigo, r_name AS area, n_nationkey AS place
        FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
        JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
    )
"""


def regional(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly units of each cohort in the nested regions BCN (one nation), CAT (its area) and ESP (all).

    Units are summed before the rows are repeated for each region.
    """
    from lotwise.operators.market import by_region

    sums = market(spark, sf_dir).groupBy("place", "area", "marca", "modelo", "anio", "combustible", "yyyymm").agg(F.sum("unidades").alias("unidades"))
    return by_region(sums, F.col("place") == 6, F.col("area") == "ASIA")


REGIONAL_SQL = MARKET_SQL + """,
    regional AS (
        SELECT 'BCN' AS region, marca, modelo, anio, combustible, yyyymm, unidades FROM market WHERE place = 6
        UNION ALL SELECT 'CAT', marca, modelo, anio, combustible, yyyymm, unidades FROM market WHERE place = 6 OR area = 'ASIA'
        UNION ALL SELECT 'ESP', marca, modelo, anio, combustible, yyyymm, unidades FROM market
    ), annual AS (
        SELECT region, marca, modelo, anio, combustible, sum(unidades) AS units_abs FROM regional GROUP BY ALL
    )
"""


#: Rows of a task that drops repeated lots.
LOTS_A_TASK = 250_000


def lots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with their line items as auction lots with final price, sale price and margin.

    Lots are dealt out by their id before repeated ones drop out, and to more tasks the more line items there are: hardly one
    is repeated, so a task that combined them before the shuffle would hold all that it reads.
    """
    t = lambda n: table(spark, sf_dir, n)
    rows = t("lineitem").join(t("orders"), F.col("l_orderkey") == F.col("o_orderkey")).join(t("part"), F.col("l_partkey") == F.col("p_partkey"))
    rows = rows.join(t("supplier"), F.col("l_suppkey") == F.col("s_suppkey")).join(t("nation"), F.col("s_nationkey") == F.col("n_nationkey")).join(t("customer"), F.col("o_custkey") == F.col("c_custkey"))
    bid = F.round(F.col("l_extendedprice") * (1 - F.col("l_discount")), 6)
    final = F.round(F.col("l_extendedprice") * (1 - F.col("l_discount")) * (1 + F.col("l_tax")), 6)
    sale = F.round(F.col("p_retailprice") * F.col("l_quantity"), 6)
    lot = F.concat_ws("-", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", F.col("l_quantity").cast("int"), F.date_format("l_shipdate", "yyyyMMdd"), (F.round(F.col("l_extendedprice") * 100)).cast("long"), (F.round(F.col("l_discount") * 100)).cast("int"), (F.round(F.col("l_tax") * 100)).cast("int"))
    found = rows.select(
        lot.alias("lot_id"), F.col("p_brand").alias("marca"), F.col("p_type").alias("modelo"), F.year("l_shipdate").cast("long").alias("anio"), F.col("l_returnflag").alias("combustible_norm"),
        F.col("c_mktsegment").alias("segmento"), F.col("n_name").alias("sale_country"), F.col("o_orderpriority").alias("sale_name"), F.when(F.col("o_orderstatus") == "F", "Sold").otherwise("Not sold").alias("lot_status"),
        bid.alias("winning_bid"), final.alias("precio_final_eur"), sale.alias("precio_venta_ganvam"), F.round(sale - final, 6).alias("margin_abs"), (F.col("p_size") * 4000).cast("double").alias("mileage"),
        F.col("l_quantity").alias("units_abs_esp"), (F.col("p_size") / 50.0).alias("share_marca_%_esp"), (F.col("l_linenumber") * 10.0).alias("mix_0_3_%_esp"),
    )
    tasks = t("lineitem").count() // LOTS_A_TASK
    many = tasks > int(spark.conf.get("spark.sql.shuffle.partitions"))
    return (found.repartition(tasks, "lot_id") if many else found.repartition("lot_id")).distinct()


LOTS_SQL = """
    lots AS (
        SELECT DISTINCT concat_ws('-', l_orderkey, l_partkey, l_suppkey, l_linenumber, CAST(l_quantity AS INTEGER), strftime(l_shipdate, '%Y%m%d'), CAST(round(l_extendedprice * 100) AS BIGINT), CAST(round(l_discount * 100) AS INTEGER), CAST(round(l_tax * 100) AS INTEGER)) AS lot_id,
               p_brand AS marca, p_type AS modelo, CAST(year(l_shipdate) AS BIGINT) AS anio, l_returnflag AS combustible_norm, c_mktsegment AS segmento, n_name AS sale_country,
               o_orderpriority AS sale_name, CASE WHEN o_orderstatus = 'F' THEN 'Sold' ELSE 'Not sold' END AS lot_status, round(l_extendedprice * (1 - l_discount), 6) AS winning_bid,
               round(l_extendedprice * (1 - l_discount) * (1 + l_tax), 6) AS precio_final_eur, round(p_retailprice * l_quantity, 6) AS precio_venta_ganvam,
               round(round(p_retailprice * l_quantity, 6) - round(l_extendedprice * (1 - l_discount) * (1 + l_tax), 6), 6) AS margin_abs, CAST(p_size * 4000 AS DOUBLE) AS mileage,
               l_quantity AS units, p_size / 50.0 AS share, l_linenumber * 10.0 AS mix
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
        JOIN nation ON s_nationkey = n_nationkey JOIN customer ON o_custkey = c_custkey
    )
"""
