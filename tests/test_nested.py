"""Walks of nested JSON against a recursive loop."""

import json
import random

from pyspark.sql import functions as F

from lotwise.functions import nested


def loop(obj, depth, at=(), up=None, key=None):
    """(at, key, up, value) of a walk down first, keys in alphabetical order."""
    out = []
    if depth == 0:
        return out
    if isinstance(obj, dict):
        label = next((text(obj[k]) for k in ("label", "name", "key") if text(obj.get(k))), None)
        if label is not None and "value" in obj:
            out.append(((*at, -1), label, "value", obj["value"]))
        for i, k in enumerate(sorted(obj)):
            out.append(((*at, i), k, key, obj[k]))
            out += loop(obj[k], depth - 1, (*at, i), key, k)
    elif isinstance(obj, list):
        for i, x in enumerate(obj):
            out += loop(x, depth - 1, (*at, i), key, None)
    return out


def text(v):
    return None if v is None else v if isinstance(v, str) else json.dumps(v, separators=(",", ":"), sort_keys=True, ensure_ascii=False)


def tree(rng, depth):
    kind = rng.random()
    if depth == 0 or kind < 0.3:
        return rng.choice(["x", "", 1, 2.5, True, None, "VIN 1"])
    if kind < 0.5:
        return [tree(rng, depth - 1) for _ in range(rng.randint(0, 3))]
    return {rng.choice(["label", "value", "name", "VIN", "Gear Box", "país subasta", "a", "b", "Standort"]): tree(rng, depth - 1) for _ in range(rng.randint(0, 4))}


def test_walk_equals_a_loop(spark):
    rng = random.Random(3)
    trees = [[tree(rng, 6) for _ in range(rng.randint(0, 2))] for _ in range(120)]
    df = spark.createDataFrame([(i, [json.dumps(t) for t in ts]) for i, ts in enumerate(trees)], "id int, j array<string>")
    for depth in (2, 7):
        got = {r["id"]: r for r in nested.walked(df, "j", depth=depth).collect()}
        for i, ts in enumerate(trees):
            want = sorted(((n, *e[0]), e[1], e[3]) for n, t in enumerate(ts) for e in [(x[0], x[1], x[2], text(x[3])) for x in loop(t, depth)] if e[1] is not None)
            assert [(tuple(e["at"]), e["key"], e["value"]) for e in got[i]["entries"]] == [tuple(w) for w in want], ts
            assert got[i]["entries_deeper"] == any(len(loop(t, depth + 1)) > len(loop(t, depth)) or deeper_arrays(t, depth) for t in ts)


def deeper_arrays(obj, depth):
    """Whether an array lies below with elements that hold no keys."""
    if depth == 0:
        return bool(obj) if isinstance(obj, list | dict) else False
    inside = obj.values() if isinstance(obj, dict) else obj if isinstance(obj, list) else ()
    return any(deeper_arrays(x, depth - 1) for x in inside)


def test_blobs_fields_and_vehicles(spark):
    html = """<script>digitalData.push({"product":{"vehicle":{"make":"Seat","lot":7,"fuelType":"D"}},"s":[{"label":"Gear  Box","value":" auto "},{"name":"n","VIN":"V1"}]});
        DIGITALDATA.push( {"deep":{"a":[{"Standort":"Köln"},{"Standort":"nan"}],"land":""}} ) ; digitalData.push({broken}); window.digitalData = [{"product":{"vehicle":{"make":"Opel","saleCode":"c"}}}];</script>"""
    df = spark.createDataFrame([(1, html), (2, None), (3, "no data")], "id int, html string").withColumn("j", nested.blobs(F.col("html")))
    rows = nested.walked(df, "j").select("id", F.size("j").alias("n"), nested.picked(F.col("entries")).alias("p"), nested.vehicle(F.col("entries")).alias("v"), nested.labels(F.col("entries"), 3).alias("l")).orderBy("id").collect()
    assert [r["n"] for r in rows] == [4, 0, 0]
    assert tuple(rows[0]["p"]) == ("V1", "auto", None, "Köln")
    assert rows[0]["v"].asDict() == {"make": "Opel", "model": None, "fuel_type": None, "sale_country": None, "sale_code": "c", "lot": None}
    assert rows[0]["l"] == ["product", "vehicle", "fueltype"] and rows[1]["l"] == [] and tuple(rows[2]["p"]) == (None,) * 4
