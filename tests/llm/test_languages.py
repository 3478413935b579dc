"""Language identification: gradients, the network against a plain loop, sampling, held-out accuracy and odd rows."""

import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from lotwise.llm import languages

SCHEMA = "doc_id long, text string, lang string, source string, id long, h long, share double, pieces string"
PARTS = {"aa": "the ing tion er ou th ed of and".split(), "bb": "eau ez que les é oi ment à un".split(), "cc": "sch ung keit der ü ein ß und ch".split()}


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, k, "s", 1, 2, 3.0, "x") for i, t, k in rows], SCHEMA)


def text_in(rng, lang, n):
    return " ".join("".join(rng.choice(PARTS[lang]) for _ in range(rng.randint(1, 3))) for _ in range(n))


def held(i):
    return zlib.crc32(("" if i is None else str(i)).encode()) % 3 == 1


def test_gradients_equal_differences():
    rng = np.random.default_rng(0)
    net = languages.Network.drawn(("a", "b", "c"), 5, 3)
    codes, label = rng.integers(90, 130, (7, 4)).astype(np.intp), np.array([0, 1, 2, 1])
    _, grads = net.gradients(codes, label)
    for w, g in zip(net.weights, grads):
        for i in np.argsort(-np.abs(g).ravel())[:4]:
            old, ends = w.flat[i], []
            for e in (0.01, -0.01):
                w.flat[i] = old + e
                ends.append(net.gradients(codes, label)[0])
            w.flat[i] = old
            assert float(g.flat[i]) == pytest.approx((ends[0] - ends[1]) / 0.02, rel=0.02, abs=2e-5)


def plain(net, raw):
    """Probabilities at each position, one byte after the other."""
    s, out = lambda x: 1 / (1 + np.exp(-x)), []
    hidden = net.gate.shape[2]
    for a in range(0, len(raw), languages.WIDTH):
        row = raw[a : a + languages.WIDTH].lower().ljust(languages.WIDTH, b"\0")
        states = np.zeros((2, len(row), hidden))
        for way in (0, 1):
            h = np.zeros(hidden)
            for t in range(len(row)) if way == 0 else reversed(range(len(row))):
                p, q = net.table[way][:, row[t]].astype(float), net.gate[way].astype(float) @ h
                z, r = s(p[:hidden] + q[:hidden]), s(p[hidden : 2 * hidden] + q[hidden : 2 * hidden])
                h = (1 - z) * np.tanh(p[2 * hidden :] + r * q[2 * hidden :]) + z * h
                states[way, t] = h
        x = net.out.astype(float) @ np.concatenate([states[0], states[1]], axis=1).T + net.bias
        e = np.exp(x - x.max(axis=0))
        out.append((e / e.sum(axis=0)).T[: len(raw) - a])
    return np.concatenate(out) if out else np.zeros((0, len(net.languages)))


def test_pools_every_letter_of_the_whole_text():
    rng = random.Random(1)
    net = languages.Network.drawn(("aa", "bb", "cc"), 4, 8)
    raws = [t.encode() for t in ("", "x", text_in(rng, "cc", 3), "12 !?", text_in(rng, "bb", 90), "Aé" * 200, text_in(rng, "aa", 40))]
    got = languages.pooled(net, raws)
    for raw, row in zip(raws, got):
        p, letters = plain(net, raw), np.array([bool(re.match(rb"[a-zA-Z\x80-\xff]", bytes([b]))) for b in raw], dtype=bool)
        assert row == pytest.approx(p[letters].mean(axis=0) if letters.any() else np.zeros(3), abs=1e-4)
        runs = languages.labelled_runs(net, raw)
        assert [k for a, b, k in runs for _ in range(b - a)] == [net.languages[i] for i in p.argmax(axis=1)]
    assert languages.pooled(net, []).shape == (0, 3)


def test_held_out_accuracy_and_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(languages, "STEPS", 120)
    monkeypatch.setattr(languages.fit, "__defaults__", (languages.HIDDEN, 120, 1))
    rng = random.Random(2)
    rows = [(i, text_in(rng, k := rng.choice(list(PARTS)), rng.choice([4, 30, 200])), k) for i in range(240)]
    rows += [(i, t.upper(), k) for i, t, k in rows[:20]] + [(None, rows[0][1], rows[0][2])] + [(1000 + i, rows[1][1], rows[1][2]) for i in range(50)]
    odd = [(2000, None, "aa"), (2001, "", "aa"), (2002, " 12 – !", "bb"), (2003, text_in(rng, "bb", 20), None), (2004, text_in(rng, "cc", 60_000), "cc"), (None, None, None), (2005, "日本", "cc"), (2006, "\x00\x00", None)]
    got = languages.identify(docs_of(spark, rows + odd)).collect()
    assert len(got) == len(rows + odd) and all(0 <= r["score"] <= 1 for r in got)
    assert sorted((str(r["id"]), r["held_out"]) for r in got) == sorted((str(i), held(i)) for i, _, _ in rows + odd)
    by = {r["id"]: r for r in got}
    assert [by[i]["lang_pred"] for i in (2000, 2001, 2002, 2006)] == ["und"] * 4 and by[2000]["score"] == 0
    assert [by[i]["lang_pred"] for i in (2003, 2004)] == ["bb", "cc"] and by[2005]["lang_pred"] in PARTS
    want = {i: k for i, _, k in rows if held(i)}
    assert sum(by[i]["lang_pred"] == k for i, k in want.items()) >= 0.97 * len(want)


def test_held_out_labels_have_no_say(spark, monkeypatch):
    monkeypatch.setattr(languages.fit, "__defaults__", (languages.HIDDEN, 5, 1))
    rng = random.Random(3)
    rows = [(i, text_in(rng, "aa" if i % 2 else "bb", 20), "aa" if i % 2 else "bb") for i in range(40)]
    one = languages.train(docs_of(spark, rows), "doc_id", "text", "lang")
    two = languages.train(docs_of(spark, [(i, t, "zz" if held(i) else k) for i, t, k in reversed(rows)]).repartition(7), "doc_id", "text", "lang")
    assert one.languages == two.languages == ("aa", "bb")
    assert all((a == b).all() for a, b in zip(one.weights, two.weights))


def test_samples_are_bounded_and_copies_count_once(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(languages, "fit", lambda pieces, label, known: seen.append((len(pieces), known)))
    rng = random.Random(4)
    rows = [(i, text_in(rng, "aa", 5)[:60], "aa") for i in range(900) if not held(i)] + [(0, "the same", "bb")] * 500
    languages.train(docs_of(spark, rows), "doc_id", "text", "lang", documents=100)
    assert seen == [(101, ("aa", "bb"))]


def test_nothing_to_learn_from(spark):
    rows = [(1, "abc", None), (2, None, None)]
    got = languages.identify(docs_of(spark, rows), runs=True).orderBy("id").collect()
    assert [(r["id"], r["lang_pred"], r["score"], r["runs"]) for r in got] == [(1, "und", 0.0, []), (2, "und", 0.0, [])]
    assert languages.identify(docs_of(spark, [])).count() == 0


def test_runs_of_a_text_in_two_languages(spark, monkeypatch):
    monkeypatch.setattr(languages.fit, "__defaults__", (languages.HIDDEN, 120, 1))
    rng = random.Random(5)
    rows = [(i, text_in(rng, k := rng.choice(["aa", "cc"]), 60), k) for i in range(120)]
    first, second = text_in(rng, "aa", 50), text_in(rng, "cc", 50)
    found = languages.identify(docs_of(spark, rows + [(500, first + " " + second, None)]), runs=True).where("id = 500").select(F.explode("runs").alias("r")).select("r.*").collect()
    assert [found[0]["start"], found[-1]["end"]] == [0, len((first + " " + second).encode())]
    cut = len(first.encode())
    before = sum(min(r["end"], cut) - r["start"] for r in found if r["lang"] == "aa" and r["start"] < cut)
    after = sum(r["end"] - max(r["start"], cut) for r in found if r["lang"] == "cc" and r["end"] > cut)
    assert before >= 0.9 * cut and after >= 0.9 * len(second.encode())
