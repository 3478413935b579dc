"""Summaries of a period from one scan, and their files."""

import os

import pytest
from pyspark.sql import functions as F

from lotwise.operators import market
from lotwise.plans import export

SCHEMA = "marca string, modelo string, provincia string, combustible string, yyyymm long, unidades long, extra string"


def monthly(spark, rows):
    return spark.createDataFrame([(*r, "x") for r in rows], SCHEMA)


ROWS = [
    ("A", "m1", "Barcelona", "d", 202401, 5), ("A", "m1", "Madrid", "d", 202402, 7), ("B", "m2", "Barcelona", "e", 202401, 12), ("B", "m3", "BARCELONA ", None, 202402, 1), (None, "m1", None, "d", 202402, 4), ("C", None, "Madrid", "e", 202402, 7), ("Z", "m9", "Madrid", "d", 202312, 99),
    ("B", "m2", "Barcelona", "e", None, 50),
]


def test_summary_set(spark):
    found = market.summary_set(monthly(spark, ROWS), 202401, 202412, " barcelona ", top=2)
    got = {}
    for r in found.orderBy("tabla", "posicion").collect():
        got.setdefault(r["tabla"], []).append(tuple(r[k] for k in ("marca", "modelo", "provincia", "combustible") if k in market.SUMMARIES[r["tabla"]]) + (r["unidades"],))
    assert got == {
        "kpi": [(36,)], "rank_marcas": [("B", 13), ("A", 12)], "rank_modelos": [("m1", 16), ("m2", 12)], "rank_provincias": [("Barcelona", 17), ("Madrid", 14), (None, 4), ("BARCELONA ", 1)], "rank_combustible": [("e", 19), ("d", 16), (None, 1)],
        "rank_marcas_focus": [("B", 13), ("A", 5)], "rank_modelos_focus": [("m2", 12), ("m1", 5)],
        "mix_comb_prov": [("BARCELONA ", None, 1), ("Barcelona", "e", 12), ("Barcelona", "d", 5), ("Madrid", "d", 7), ("Madrid", "e", 7), (None, "d", 4)],
    }
    shares = {(r["provincia"], r["combustible"]): r["share_prov"] for r in found.where("tabla = 'mix_comb_prov'").collect()}
    assert shares[("Barcelona", "e")] == 70.59 and shares[(None, "d")] == 100.0
    assert market.summary_set(monthly(spark, []), 202401, 202412, "x").count() == 0


def test_one_scan(spark, tmp_path):
    monthly(spark, ROWS).write.parquet(str(tmp_path / "m"))
    plan = market.summary_set(spark.read.parquet(str(tmp_path / "m")), 202401, 202412, "x")._jdf.queryExecution().executedPlan().toString()
    first = plan.split("== Initial Plan ==")[0]
    assert first.count("FileScan parquet") <= 1 and plan.count("Expand") >= 1 and "extra" not in plan.split("ReadSchema")[1]


def test_files_of_a_period(spark, tmp_path):
    rows = monthly(spark, ROWS)
    names = export.period(rows, 202401, 202402, "Barcelona", str(tmp_path / "out"), rows.withColumn("codigo_ine", F.lit("08019")))
    assert sorted(names) == sorted(os.listdir(tmp_path / "out")) and len(names) == 10
    assert spark.read.parquet(str(tmp_path / "out" / "keys_for_join.parquet")).count() == 6
    assert [tuple(r) for r in spark.read.option("header", True).csv(str(tmp_path / "out" / "rank_marcas.csv")).collect()][0] == ("B", "13")
    with pytest.raises(ValueError):
        export.period(rows, 203001, 203012, "Barcelona", str(tmp_path / "none"))
    assert set(export.tables(rows, 202401, 202402, "Barcelona")) == {*market.SUMMARIES, "period_df"}
