"""Profiles: exact parts equal the data, sketches within their error, months added one by one."""

import inspect
import random
from decimal import Decimal

from pyspark.sql import functions as F

from lotwise import queries
from lotwise.sources import profile, readers

SCHEMA = "month int, price double, model string, seats int, note array<int>"


def rows(month, n, seed):
    rng = random.Random(seed)
    return [(month, rng.choice([None, rng.uniform(0, 1000), rng.uniform(0, 1000)]), rng.choice([None, f"m{rng.randint(0, 5000)}", "golf", "golf", "ibiza"]), rng.randint(2, 7), [rng.randint(0, 2)]) for _ in range(n)]


def test_profile_by_month(spark, tmp_path):
    path, months = str(tmp_path / "p"), {202401: rows(202401, 3000, 1), 202402: rows(202402, 2000, 2), 202403: rows(202403, 10, 3)}
    profile.add(spark, spark.createDataFrame(months[202401] + months[202402][:50], SCHEMA), "month", path)
    first = spark.read.parquet(path).where("month = 202401").select("column", "n", "total").collect()
    profile.add(spark, spark.createDataFrame(months[202402] + months[202403], SCHEMA), "month", path)
    kept = spark.read.parquet(path)
    assert sorted(map(str, first)) == sorted(map(str, kept.where("month = 202401").select("column", "n", "total").collect()))
    got = {r["column"]: r for r in profile.merged(kept).collect()}
    data = [r for m in months.values() for r in m]
    price = sorted(r[1] for r in data if r[1] is not None)
    assert set(got) == {"price", "model", "seats", "note"} and all(r["n"] == len(data) for r in got.values())
    p, m, s = got["price"], got["model"], got["seats"]
    assert (p["n_null"], p["low"], p["high"]) == (len(data) - len(price), price[0], price[-1]) and abs(p["mean"] - sum(price) / len(price)) < 1e-6
    for q, x in zip((0.25, 0.5, 0.75), p["quantiles"]):
        assert abs(sum(v <= x for v in price) / len(price) - q) < 0.02
    models = [r[2] for r in data if r[2] is not None]
    assert abs(m["n_distinct"] - len(set(models))) <= 0.04 * len(set(models)) and m["low_text"] == min(models) and m["quantiles"] is None
    assert (m["top"][0][0], m["top"][1][0]) == ("golf", "ibiza") and abs(m["top"][0][1] - models.count("golf")) <= 0.05 * len(models)
    assert s["n_distinct"] == 6 and s["quantiles"][1] in (4.0, 5.0) and sum(t[1] for t in s["top"]) <= len(data)
    by_month = {(r["month"], r["column"]): r["n"] for r in profile.merged(kept, ["month"]).collect()}
    assert by_month[(202403, "price")] == 10 and len(by_month) == 12


def test_one_pass(spark, tmp_path):
    spark.createDataFrame(rows(1, 50, 1), SCHEMA).write.parquet(str(tmp_path / "t"))
    plan = profile.sketched(spark.read.parquet(str(tmp_path / "t")), ["month"])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 1 and plan.count("Aggregate [") == 1 and "Expand" not in plan
    assert profile.merged(profile.sketched(spark.createDataFrame([], SCHEMA), ["month"])).count() == 0


def test_every_metric_is_described(spark):
    found = readers.dictionary(spark)
    assert len(readers.DICTIONARY) == 29 and len(readers.RATIOS) == 2 and found.count() == 3 * 29 + 2
    assert found.where("formula is null or description is null").count() == 0
    assert found.where(F.col("column") == "ratio_bcn_cat_%").count() == 1


def test_means_do_not_depend_on_the_order_of_addition(spark):
    # The mean is 0.0499185 and rounds up; added up as doubles it falls below the tie in some orders.
    values = [0.1 * (i % 3) + 0.01 for i in range(3)] + [0.3, 1e9, -1e9, 0.07, 1e-9]
    for seed in range(4):
        data = values * 20
        random.Random(seed).shuffle(data)
        frame = spark.createDataFrame([(i % 5, v) for i, v in enumerate(data)], "month int, x double")
        got = profile.merged(profile.sketched(frame, ["month"])).first()
        assert got["mean"] == float(sum(map(Decimal, map(str, data))) / len(data))
    odd = spark.createDataFrame([(1, 1e300), (1, 1e300), (2, 2e-25)], "month int, x double")
    assert profile.merged(profile.sketched(odd, ["month"])).first()["mean"] == 2e300 / 3


def test_ranks_are_counted(spark):
    frame = spark.createDataFrame([(float(v), None if v % 2 else v) for v in [3, 1, 2, 2, 5]], "a double, b int")
    got = profile.ranks(frame, spark.createDataFrame([("a", 2.0), ("b", 2.0)], "column string, value double"), ["a", "b"])
    assert {tuple(r) for r in got.collect()} == {("a", 1, 3), ("b", 0, 2)}
    # No aggregate holds the values of a column.
    assert "F.percentile(" not in inspect.getsource(queries.column_profile)
