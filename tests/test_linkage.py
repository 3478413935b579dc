"""Similarity join and linkage against all pairs."""

import random

import pytest
from pyspark.sql import functions as F

from lotwise.functions import text
from lotwise.operators import linkage, similar


def labels(spark, rows):
    return spark.createDataFrame(rows, "block string, label string")


@pytest.mark.parametrize("least", [89.0, 90.0, 97.0])
def test_similar_labels_equal_all_pairs(spark, least):
    rng = random.Random(int(least))
    words = ["serie", "3", "gran", "turismo", "golf", "golff", "plus", "variant", "a", "b", "i", "sportback", "sportsback", "touring", "tourings", "x5", "clase", "klasse"]
    draw = lambda: " ".join(rng.choice(words) for _ in range(rng.randint(1, 4)))
    bent = lambda t: "".join(c * rng.choice([1] * 30 + [0, 2]) for c in t)
    left = [("m", bent(draw())) for _ in range(150)] + [("n", draw()) for _ in range(30)] + [("m", None), (None, "golf"), ("m", " "), ("m", "golf"), ("m", "golf")]
    right = [("m", draw()) for _ in range(150)] + [("n", bent(draw())) for _ in range(30)] + [("m", None), ("m", "")]
    got = {(r["block"], r["label"], r["other"]) for r in similar.similar(labels(spark, left), labels(spark, right), least).collect()}
    want = {(b, x, y) for b, x in set(left) for c, y in set(right) if b is not None and b == c and x and y and text._token_set(x, y) >= least}
    assert got == want and len(want) > 100


def test_similar_makes_few_pairs(spark):
    rng = random.Random(1)
    names = [("m", "".join(rng.choice("abcdefghijklmnopqrst") for _ in range(9)) + " line") for _ in range(1500)]
    found = similar.similar(labels(spark, names), labels(spark, names))
    plan = found._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert {(r["label"], r["other"]) for r in found.collect()} >= {(n, n) for _, n in names}
    with pytest.raises(ValueError):
        similar.similar(labels(spark, names), labels(spark, names), 80.0)


def versions(spark, seed):
    rng = random.Random(seed)
    words = ["sport", "line", "gt", "5p", "touring", "pack", "sportline", "x"]
    say = lambda: " ".join(rng.choice(words) for _ in range(rng.randint(0, 4)))
    maybe = lambda x, p=0.15: None if rng.random() < p else x
    models_ = ["golf", "golf plus", "serie 3", "clase c", "golff"]
    prices = [(f"p{i:03d}", maybe(rng.choice("ABC"), 0.05), maybe(rng.choice(models_[:4]), 0.05), maybe(rng.randint(2008, 2014)), maybe(rng.choice("de")), maybe(float(rng.choice([90, 110, 150]))), maybe(say(), 0.05), maybe(2005, 0.5), maybe(rng.choice([2009, 2012]), 0.5), float(i)) for i in range(60)]
    lots = [(f"l{i:03d}", maybe(rng.choice("ABCD"), 0.05), maybe(rng.choice([*models_, "none", "golf variant"]), 0.05), maybe(rng.randint(2006, 2015)), maybe(rng.choice("deg")), maybe(float(rng.choice([90, 110, 130, 81]))), maybe(say(), 0.05)) for i in range(150)]
    frames = spark.createDataFrame(lots, "lot_id string, make string, model string, year int, fuel string, power double, text string"), spark.createDataFrame(prices, "price_id string, make string, model string, year int, fuel string, power double, text string, start int, end int, price double")
    return lots, prices, frames


def one_lot(lot, prices, rules):
    """The ranked candidates of a lot, from a loop over all prices."""
    i, make, model, year, fuel, power, words = lot

    def keep(rows, test):
        good = [p for p in rows if test(p)]
        return (good, False) if good else (rows, True)

    def stage(rows):
        exact, dropped = keep(rows, lambda p: year is not None and p[3] == year)
        if dropped:
            exact, dropped = keep(rows, lambda p: year is not None and year < rules.range_before and (p[7] or 0) <= year <= (p[8] or 9999))
        rows, _ = keep(exact, lambda p: fuel is not None and p[4] == fuel)
        same = lambda p: power is not None and p[5] is not None and (power == p[5] or rules.kw_too and (round(power * 1.35962) == p[5] or round(p[5] * 1.35962) == power))
        rows, no_power = keep(rows, same)
        a, ranked = (words or "").split(), []
        for p in rows:
            b = (p[6] or "").split()
            n = len(set(a) & set(b))
            x, y = " ".join(a), " ".join(b)
            if n >= rules.least_tokens:
                ranked.append((-n, -int(x in y or y in x), -round(max(text._token_set(x, y), text._partial(x, y)), 4), p[0], p))
        ranked.sort(key=lambda r: r[:4])
        if no_power and power is not None:
            head = sorted(ranked[: rules.power_top], key=lambda r: (abs(r[4][5] - power) if r[4][5] is not None else float("inf"), r[:4]))
            ranked = head + ranked[rules.power_top :]
        return [(r[3], -r[0], -r[1]) for r in ranked[: rules.top]]

    if make is None:
        return None, []
    own = [p for p in prices if p[1] == make]
    found = stage([p for p in own if model is not None and p[2] == model]) if model is not None else []
    if found:
        return "EXACT", found
    if rules.use_fuzzy and model is not None:
        like = sorted((-text._token_set(model, p[2]), p[0], p) for p in own if p[2] is not None and text._token_set(model, p[2]) >= rules.fuzzy_least)
        if like:
            own = [p for *_, p in like[: rules.fuzzy_top]]
    return "BRAND", stage(own)


@pytest.mark.parametrize("rules", [linkage.Rules(), linkage.Rules(use_fuzzy=False, kw_too=True, top=3)])
def test_linkage_equals_a_loop_over_all_prices(spark, rules):
    lots, prices, frames = versions(spark, 5)
    best, audit = linkage.match(*frames, rules)
    got = {}
    for r in audit.orderBy("lot_id", "cand_rank").collect():
        got.setdefault(r["lot_id"], []).append((r["stage"], r["price_id"], r["token_overlap"], r["substring_hit"], r["decision"]))
    kinds = set()
    for lot in lots:
        stage, want = one_lot(lot, prices, rules)
        rows = [(stage, *w, "candidate" if k else "selected") for k, w in enumerate(want)] or [(None, None, None, None, "unmatched")]
        assert got[lot[0]] == rows, lot
        kinds.add((stage, bool(want)))
    assert {("EXACT", True), ("BRAND", True), ("BRAND", False)} <= kinds
    chosen = {r["lot_id"]: (r["price_id"], r["matched"]) for r in best.collect()}
    assert chosen == {k: (v[0][1], v[0][1] is not None) for k, v in got.items()}


def test_no_stage_joins_lots_and_prices_by_make_alone(spark):
    _, _, (lots, prices) = versions(spark, 6)
    left = lots.select("lot_id", "make", "model", *(F.col(c).alias(f"l_{c}") for c in ("year", "fuel", "power", "text")))
    right = prices.select("price_id", F.col("make").alias("p_make"), F.col("model").alias("p_model"), *(F.col(c).alias(f"p_{c}") for c in ("year", "fuel", "power", "text", "start", "end", "price")))
    plan = linkage.whole_make(left, right, linkage.Rules())._jdf.queryExecution().optimizedPlan().toString()
    assert "Cartesian" not in plan and "Cross" not in plan
    with pytest.raises(ValueError):
        linkage.whole_make(left, right, linkage.Rules(least_tokens=0))


def test_one_make_and_model_makes_few_pairs(spark, monkeypatch):
    lots = spark.range(600).selectExpr("concat('l', id) AS lot_id", "'A' AS make", "'golf' AS model", "2000 AS year", "'d' AS fuel", "CAST(id % 7 AS DOUBLE) AS power", "element_at(array('gt line', 'gt', 'line x'), CAST(id % 3 + 1 AS INT)) AS text")
    prices = spark.range(600).selectExpr("concat('p', lpad(CAST(id AS STRING), 4, '0')) AS price_id", "'A' AS make", "'golf' AS model", "2000 AS year", "'d' AS fuel", "CAST(id % 5 AS DOUBLE) AS power", "element_at(array('gt', 'line'), CAST(id % 2 + 1 AS INT)) AS text", "CAST(NULL AS INT) AS start", "CAST(NULL AS INT) AS end", "CAST(id AS DOUBLE) AS price")
    sizes, stored = [], linkage.stored
    monkeypatch.setattr(linkage, "stored", lambda df: sizes.append((t := stored(df)).count()) or t)
    best, audit = linkage.match(lots, prices)
    assert best.where("matched").count() == 600 and audit.where("decision != 'unmatched'").count() == 3000
    # A row a lot and its candidates, not one for each of the 360 000 pairs.
    assert max(sizes) <= 3000
