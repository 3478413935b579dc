"""Model names: the index against all models of the make, each rule, odd rows, and the plan."""

import random
import re

import pytest
from pyspark.sql import functions as F

from lotwise.operators import models


def whitelist(spark, *rows):
    return spark.createDataFrame([(*r, None)[:3] for r in rows], "MARCA string, MODELO string, DISPLAY string")


def named(spark, rows, known, **options):
    df = spark.createDataFrame([(i, m, t, "x", "y") for i, (m, t) in enumerate(rows)], "id long, make string, text string, b string, cand string")
    found = models.fused(df, "id", "make", "text", whitelist(spark, *known), **options).collect()
    return {r["id"]: r for r in found}


def brute(text, known, weights=models.WEIGHTS):
    """(best, second, lead) over all models of a make that no rule knows; the models are upper case words."""
    tt = [w for w in text.split() if w not in models.NOISE] or text.split()
    related = lambda a, b: a.startswith(b) or b.startswith(a)

    def points(cand):
        words, own = set(cand.split()), {w for w in text.split() if w not in models.POINT_NOISE}
        n = 100 * (cand == text) + 60 * (cand in text) + 40 * (words <= own) + min(len(cand), 40) // 2
        return n + 15 * (bool(re.search(r"\d", cand)) and bool(re.search(r"\d", text))) - 10 * bool(words & set(models.POINT_NOISE))

    top = min(known, key=lambda c: (-points(c), c))
    pick = top if points(top) >= 50 else None

    def score(cand):
        ct = cand.split()
        places = [next(i for i, x in enumerate(tt) if related(x, c)) for c in ct if any(related(x, c) for x in tt)]
        f = {
            "recall": sum(any(related(x, c) for x in tt) for c in ct) / len(ct),
            "pref": float(related(tt[0], ct[0])), "length": 1 / (1 + 0.15 * len(cand)), "subset": float(set(ct) <= set(tt)), "digits": float(bool(re.search(r"\d", cand)) and bool(re.search(r"\d", " ".join(tt)))),
            "guard": 0.0, "v2flag": float(cand == pick), "family": 0.0, "lex": len(set(tt) & set(ct)) / len(set(tt) | set(ct)), "first_token": float(tt[0] == ct[0]),
            "pref_pos": sum(models.PLACES[p] if p < 6 else models.BEYOND for p in places) / len(places) if places else 0.0, "present": float(set(ct) <= set(tt)), "coupe": 0.0,
        }
        return round(sum(weights[k] * v for k, v in f.items()), 9)

    order = sorted(known, key=lambda c: (-score(c), c))
    return order[0], order[1] if len(order) > 1 else None, round(max(0.0, score(order[0]) - (score(order[1]) if len(order) > 1 else 0.0)), 6)


@pytest.mark.parametrize("rare", [1, 4])
def test_index_finds_the_two_best_of_all(spark, rare):
    rng = random.Random(rare)
    pool = ["AX", "AXON", "BO", "BOLT", "CE", "CERO", "C4", "C45", "D", "DUNE", "EVO", "7", "70", "SPORT", "GRAND"]
    known = sorted({" ".join(rng.choice(pool) for _ in range(rng.randint(1, 3))) for _ in range(60)})
    texts = [" ".join(rng.choice([*pool, "ZZ", "AXO", "BOLTED", "C", "45", "X" * 3]) for _ in range(rng.randint(1, 5))) for _ in range(90)]
    got = named(spark, [("Kart", t.lower()) for t in texts], [("KART", k) for k in known], rare=rare)
    for i, t in enumerate(texts):
        best, second, lead = brute(t, known)
        assert (got[i]["model"], got[i]["second"], got[i]["confidence"]) == (best, second, pytest.approx(lead, abs=1e-6)), t


def test_rules_decide(spark):
    known = [
        ("BMW", "Serie 3"), ("BMW", "X5"), ("BMW", "iX"), ("BMW", "iX3"), ("BMW", "Z4"), ("BMW", "i3"), ("Mercedes-Benz", "Clase C"), ("Mercedes-Benz", "Clase C Coupe"), ("Mercedes-Benz", "GLC"), ("Mercedes-Benz", "GLC Coupe"), ("Mercedes-Benz", "Vito"),
        ("Mercedes-Benz", "Marco Polo"), ("Mercedes-Benz", "Clase CLA"), ("Volvo", "V60"), ("Volvo", "XC90"), ("Mazda", "2"), ("Mazda", "3"), ("Mazda", "CX-5"), ("Mazda", "CX 30"), ("VW", "ID.3"), ("VW", "Golf"), ("VW", "Golf Plus"), ("MG", "HS"), ("MG", "ZS"),
        ("Land Rover", "Defender"), ("Land Rover", "Discovery"), ("DS", "DS 7"), ("DR", "DR 5.0"), ("Nissan", "X-Trail"), ("Nissan", "Juke"), ("Kia", "Proceed"), ("Kia", "Ceed"), ("MINI", "Countryman"), ("MINI", "Mini Electric"), ("MINI", "Cooper"), ("Peugeot", "308"), ("Peugeot", "3008"), ("Fiat", "500"), ("Fiat", "500X"),
        ("Citroën", "C-Elysée", "C-Elysée show"), ("Alfa Romeo", "Tonale"),
    ]
    cases = {
        ("bmw", "320d xDrive"): "SERIE 3", ("B.M.W", "X 5 30d"): "X5", ("BMW", "ix 3 inspiring"): "IX3", ("BMW", "iX xDrive40"): "IX", ("BMW", "Z4 roadster"): "Z4", ("mercedes", "C 220 d"): "CLASE C", ("Mercedes Benz", "C220 Coupé"): "CLASE C COUPE",
        ("MERCEDES-BENZ", "GLC 300 coupe"): "GLC COUPE", ("Mercedes", "GLC 220"): "GLC", ("Mercedes", "e-Vito tourer"): "VITO", ("Mercedes", "V Marco  Polo"): "MARCO POLO", ("Mercedes", "CLA 200"): "CLA", ("Volvo", "V 60 Cross Country"): "V60", ("volvo", "xc90 T8"): "XC90",
        ("Mazda", "Mazda2 1.5"): "2", ("MAZDA", "mazda 3 sedan"): "3", ("Mazda", "cx-5 2.2"): "CX-5", ("Mazda", "CX 30 skyactiv"): "CX-30", ("volkswagen", "ID.3 pro"): "ID.3", ("VW", "golf plus 1.6"): "GOLF PLUS", ("VW", "golf variant"): "GOLF", ("MG", "eHS plug-in"): "HS",
        ("Land Rover", "D350 x"): "DEFENDER", ("DS Automobiles", "DS7 crossback"): "DS 7", ("DR Automobiles", "DR 5.0 evo"): "DR 5.0", ("Nissan", "xtrail 1.7"): "X-TRAIL", ("Kia", "proceed gt"): "PROCEED", ("Mini", "countyman all4"): "COUNTRYMAN", ("MINI", "Cooper SE"): "MINI ELECTRIC",
        ("Peugeot", "308 sw"): "308", ("FIAT", "500 lounge"): "500", ("citroen", "c elysee"): "C-Elysée show", ("Alfa  Romeo", "tonale veloce"): "TONALE",
    }
    got = named(spark, list(cases), known)
    assert {k: got[i]["model"] for i, k in enumerate(cases)} == cases
    by = {k: got[i] for i, k in enumerate(cases)}
    assert by[("Mazda", "Mazda2 1.5")]["confidence"] == 1.0 and by[("Mazda", "Mazda2 1.5")]["second"] is None
    assert by[("VW", "golf plus 1.6")]["family"] == "GOLF" and by[("MG", "eHS plug-in")]["family"] == "HS"


def test_rules_can_be_given(spark):
    what = models.Knowledge(hard=(models.Rule("KART", r"\bZZ(\d)\b", "AXON $1", unless="OLD"),), make_weights={"KART": {"present": 5.0}})
    got = named(spark, [("kart", "zz7 bolt"), ("kart", "old zz7 bolt"), ("kart", "bolt axon")], [("Kart", "Axon 7"), ("Kart", "Bolt"), ("Kart", "Axon bolt dune")], what=what)
    assert [got[i]["model"] for i in range(3)] == ["AXON 7", "BOLT", "BOLT"]
    assert got[2]["confidence"] > 4


def test_odd_rows(spark):
    known = [("Kart", "Bolt"), (None, "Bolt"), ("Kart", None), ("Kart", "---"), ("", "x"), ("Solo", "Only"), ("Kart", "BOLT"), ("Kart", "Évora ñ"), ("Ünder", "Söl")]
    rows = [("Kart", None), ("Kart", ""), ("Kart", "..."), (None, "bolt"), ("Nobody", "bolt"), ("Solo", "other words"), ("kart", "bolt " * 400), ("kart", "evora"), ("under", "sol"), ("Kart", "bolt"), ("Kart", "bolt"), ("mercedes", "c 200")]
    got = named(spark, rows, known)
    assert len(got) == len(rows)
    assert [got[i]["model"] for i in range(len(rows))] == [None, None, None, None, None, "ONLY", "BOLT", "ÉVORA Ñ", "SÖL", "BOLT", "BOLT", None]
    assert got[0]["confidence"] == 0 and got[3]["make"] is None and got[4]["make"] == "NOBODY"
    assert named(spark, rows, [])[9]["model"] is None
    none = spark.createDataFrame([], "id long, make string, text string")
    assert models.fused(none, "id", "make", "text", whitelist(spark, *known)).count() == 0


def test_no_text_meets_a_whole_make(spark):
    """3000 models of one make: a text of two rare words meets theirs and the few that stand for the rest."""
    known = [("Kart", f"M{i:04d} {'SPORT' if i % 3 else 'GRAND'} LINE") for i in range(3000)]
    df = spark.createDataFrame([(i, "Kart", f"m{i:04d} line {i}") for i in range(200)], "id long, make string, text string")
    met = models.candidates(df, "make", "text", models.known(whitelist(spark, *known))).groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.max(F.when(F.col("rank") == 1, F.col("cand"))).alias("best")).collect()
    assert len(met) == 200 and max(r["n"] for r in met) <= 20
    assert all(r["best"].split()[0] == r["key"].split()[0] for r in met)
    plan = models.fused(df, "id", "make", "text", whitelist(spark, *known))._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "Python" not in plan


def test_sub_models_of_mercedes_come_first(spark):
    rows = [("Mercedes-Benz", "Clase C", "C 220"), ("MERCEDES", "Clase C", " "), ("BMW", "Serie 3", "320")]
    df = spark.createDataFrame(rows, "m string, model string, sub string")
    assert [r[0] for r in df.select(models.choose_text(F.col("model"), F.col("sub"), F.col("m"))).collect()] == ["C 220", "Clase C", "Serie 3"]


def test_rows_that_are_written_alike_are_read_once(spark, monkeypatch):
    """The work on texts grows with the distinct ones, and is dealt out; null texts and repeats keep their rows."""
    dealt, spread = [], models.spread
    monkeypatch.setattr(models, "spread", lambda df: dealt.append(df.count()) or spread(df))
    rows = spark.createDataFrame([(i, "Mini", "cooper SE" if i % 2 else None) for i in range(200)], "id int, make string, text string")
    white = spark.createDataFrame([("MINI", "Cooper"), ("MINI", "Mini Electric")] * 100, "MARCA string, MODELO string")
    found = models.fused(rows, "id", "make", "text", white).collect()
    assert sorted(r["id"] for r in found) == list(range(200)) and {(r["id"] % 2, r["make"], r["model"] is None) for r in found} == {(0, "MINI", True), (1, "MINI", False)}
    assert max(dealt) == 2
    assert spread(rows).rdd.getNumPartitions() > 1
