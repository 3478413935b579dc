"""The filter audit against every document in every order, with odd rows."""

import random
import re
from itertools import permutations

from lotwise.llm import interactions

SCHEMA = "doc_id long, text string, source string, id long, part string, n long, body string, mask int, least long, salt long"


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, s, 1, "x", 2, "y", 3, 4, 5) for i, t, s in rows], SCHEMA)


def brute(rows, labels):
    plain = [(i, t or "", s or "") for i, t, s in rows]
    good = {i for i, q, _ in labels if i is not None and q == 1}
    toxic = {i for i, _, x in labels if i is not None and x == 1}
    seen = {}
    for i, t, _ in plain:
        if i is not None:
            seen[t] = min(seen.get(t, i), i)
    docs = []
    for i, t, s in plain:
        words = re.findall("[^\x20\x09-\x0d]+", t)
        fails = {
            "A": len(words) < 50,
            "B": 100 * len(set(words)) < 65 * len(words),
            "C": 100 * len(re.findall("[A-Z]", t)) > 5 * len(t),
            "D": re.search("[#$%&*|]", t) is not None,
            "E": i is not None and seen[t] < i,
        }
        docs.append((s, fails, i in good, i in toxic))
    out = []
    for part in {d[0] for d in docs}:
        mine, rows, shapley = [d for d in docs if d[0] == part], [], dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left = mine
            for k, f in enumerate(order):
                lost, kept = [d for d in left if d[1][f]], [d for d in left if not d[1][f]]
                failing = [d for d in mine if d[1][f]]
                alone = sum(sum(d[1].values()) == 1 for d in failing)
                rows.append((part, "".join(order), k + 1, len(kept), len(lost), len(failing) - len(lost), alone, sum(d[2] for d in lost), sum(d[3] for d in lost)))
                shapley[f] += len(lost)
                left = kept
        out += [(*r, shapley[r[1][r[2] - 1]]) for r in rows]
    return sorted(out)


def case():
    rng = random.Random(4)
    words = "alpha Beta gamma DELTA épsilon zeta eta theta# iota kappa% lambda mu nu xi".split(" ")
    rows = []
    for i in range(80):
        n = rng.choice([0, 1, 10, 49, 50, 51, 90])
        pool = rng.sample(words, rng.randint(1, len(words))) + [f"w{k}" for k in range(rng.choice([0, 60]))]
        sep = rng.choice([" ", "\n", " \t", "\x0b\x0c", " "])
        rows.append((rng.choice([i, i, i, None, 7]), sep.join(rng.choice(pool) for _ in range(n)), rng.choice(["a", "b", "a", None, "", "Ä"])))
    rows += [(200 + k, rows[3][1], "copies") for k in range(6)] + [(200, rows[3][1], "copies"), (None, rows[3][1], None), (300, None, "a"), (301, "", "b"), (302, None, "b")]
    rows += [(400, " ".join(f"w{k}" for k in range(60)), "clean"), (401, "x" * 300_000 + " y" * 90_000, "long")]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i, _, _ in rows if rng.random() < 0.7] + [(None, 1, 1), (3, 0, 0), (3, 1, 1), (9999, 1, 1)]
    return rows, labels


def test_equals_every_document_in_every_order(spark):
    rows, labels = case()
    got = interactions.audit(docs_of(spark, rows), spark.createDataFrame([(*x, 1) for x in labels], "doc_id long, quality int, toxic int, n long"))
    want = brute(rows, labels)
    assert got.columns == ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    assert sorted(map(tuple, got.collect())) == want
    assert len(want) == 600 * len({s or "" for _, _, s in rows})


def test_empty_tables_and_no_labels(spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert interactions.audit(docs_of(spark, []), none).count() == 0
    rows = [(1, "a b", None), (2, "a b", None)]
    assert sorted(map(tuple, interactions.audit(docs_of(spark, rows), none).collect())) == brute(rows, [])


def test_failures_are_found_in_the_jvm_and_added_up_before_the_cube(spark):
    rows, labels = case()
    flags = interactions.flagged(docs_of(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    plan = flags._jdf.queryExecution().toString()
    assert "MapInArrow" not in plan and "ArrowEvalPython" not in plan
    found = flags.collect()
    assert sum(r["n"] for r in found) == len(rows)
    assert len(found) == len({(r["part"], *(r[c] for c in "ABCDE")) for r in found})
