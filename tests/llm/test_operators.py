"""The ten operators against brute force, on small tables with nulls, empty and long texts, ties, repeated rows and clashing columns."""

import hashlib
import html as markup
import math
import random
import re
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from lotwise.llm import decontam, html, lm, packing, passages, quality, secrets, simhash, substrings, topk, windows
from lotwise.llm.common import components

SYLLABLES = "ba co di fu ge ha ki lo mu ne pa ri so tu ve wi za".split()
CLASH = "id long, rid long, key long, n long, keys string, lo long, fp long, w string, h long, __one long"


def prose(rng, n):
    return " ".join("".join(rng.choice(SYLLABLES) for _ in range(rng.randint(1, 4))) for _ in range(n))


def table(spark, rows, id_name="doc_id", text_name="text"):
    """Rows with further columns whose names the operators use inside."""
    data = [(i, t, 1, 2, 3, 4, "x", 5, 6, "y", 7, 8) for i, t in rows]
    return spark.createDataFrame(data, f"{id_name} long, {text_name} string, {CLASH}")


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(5)
    base = [prose(rng, rng.choice([3, 40, 120, 400])) for _ in range(30)]
    shared = prose(rng, 70)
    rows = list(enumerate(base))
    rows += [(100, base[2]), (101, base[2]), (102, base[5].replace(" ", "  ", 1)), (103, None), (104, ""), (105, " \n\t"), (106, "ba"), (107, "Ba CO"), (108, "é ü ß " * 60), (109, "x" * 350)]
    rows += [(200 + k, prose(rng, 60) + " " + shared + " " + prose(rng, 50)) for k in range(4)]
    words = base[7].split() if len(base[7].split()) > 100 else (base[7] + " " + prose(rng, 200)).split()
    rows += [(300, " ".join(words)), (301, " ".join(words[:50] + ["changed"] + words[51:]))]
    rows += [(400, prose(rng, 9000))]
    return rows


def with_repeats(rows):
    """Rows with null ids and the same id more than once."""
    return rows + [(None, rows[2][1]), (None, rows[2][1]), (3, rows[3][1]), (4, "another text of the same id " * 12)]


EMPTY = []


# --- helpers --------------------------------------------------------------------------------------------------------


def test_argmin_takes_the_first_of_equals():
    rng = np.random.default_rng(1)
    for width in (1, 2, 46, 77, 127):
        h = rng.integers(0, 6, 500, dtype=np.uint64) << np.uint64(20)
        found = windows.argmin(h, width)
        assert found.tolist() == [int(i + np.argmin(h[i : i + width])) for i in range(len(h) - width + 1)]
    assert len(windows.argmin(np.zeros(3, np.uint64), 4)) == 0


def test_prefix_hashes_depend_on_content_alone():
    data = np.frombuffer(b"abcabcabxabc", dtype=np.uint8)
    p = windows.Prefixes(data)
    a, b = np.array([0, 0, 0]), np.array([3, 9, 6])
    assert (p.range(a, a + 3) == p.range(b, b + 3)).tolist() == [True, True, False]


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 5000), (5000, 101), (7, 7)] + [(200, 200 + k) for k in range(1, 300)]
    found = {r["id"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(found[i] == 0 for i in range(41)) and found[101] == found[5000] == 100 and all(found[200 + k] == 200 for k in range(300))
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# --- 9 --------------------------------------------------------------------------------------------------------------


def brute_fingerprint(text, size=3):
    words = (text or "").encode().lower().split()
    grams = [b" ".join(words[i : i + size]) for i in range(len(words) - size + 1)] if len(words) >= size else [b" ".join(words)] if words else []
    h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)) if h else 0


@pytest.mark.parametrize("radius", [0, 1, 2, 3])
def test_covering_masks_catch_every_pair_within_the_radius(radius):
    rng = random.Random(radius)
    for level in (0, 1):
        family = simhash.masks(radius, level)
        assert len(family) == 2 ** (radius + 1) - 1
        for _ in range(400):
            flips = sum(1 << b for b in rng.sample(range(64), radius))
            assert any(flips & m == 0 for m in family)


def test_near_components(spark, corpus):
    rows = with_repeats(corpus)
    found = simhash.near_components(table(spark, rows)).collect()
    prints = [brute_fingerprint(t) for _, t in rows]
    group = list(range(len(rows)))

    def top(i):
        while group[i] != i:
            i = group[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 2:
                a, b = top(i), top(j)
                group[max(a, b)] = min(a, b)
    least = defaultdict(list)
    for i in range(len(rows)):
        least[top(i)].append(rows[i][0])
    want = sorted((str(rows[i][0]), f"{prints[i]:016x}", min(x for x in least[top(i)] if x is not None)) for i in range(len(rows)))
    assert sorted((str(r["id"]), r["fingerprint"], r["component_id"]) for r in found) == want
    assert simhash.near_components(table(spark, EMPTY)).count() == 0


def test_large_buckets_split_and_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(simhash, "BUCKET", 8)
    rng = random.Random(3)
    centre = rng.getrandbits(64)
    prints = sorted({centre ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 3))) for _ in range(120)})
    links = simhash.links(spark.createDataFrame([(simhash._signed(x),) for x in prints], "fp long"), 2)
    found = {r["id"]: r["component"] for r in components(links).collect()}
    near = {x: [y for y in prints if x != y and (x ^ y).bit_count() <= 2] for x in prints}
    seen, groups = set(), []
    for x in prints:
        if x in seen or not near[x]:
            continue
        stack, own = [x], set()
        while stack:
            y = stack.pop()
            if y not in own:
                own.add(y)
                stack += near[y]
        seen |= own
        groups.append(own)
    assert sorted(map(sorted, groups)) == sorted(sorted(x for x in prints if found.get(simhash._signed(x)) == c) for c in set(found.values()))


def test_verified_groups_keep_one_of_each_group(spark, corpus):
    found = {r["rid"]: r["component"] for r in simhash.verified_groups(table(spark, corpus)).collect()}
    assert found[100] == found[101] == found[2] == 2 and found[301] == found[300]
    assert not {0, 1, 4, 200, 400} & set(found)
    assert simhash.verified_groups(table(spark, EMPTY)).count() == 0


def brute_groups(rows, size=5, least=0.8):
    """The component of each text by all pairs, and how many pairs of different texts are near."""
    sets = []
    for _, t in rows:
        words = t.encode().lower().split()
        sets.append({tuple(words[k : k + size]) for k in range(max(1, len(words) - size + 1))})
    top, near = list(range(len(rows))), 0
    for i in range(len(rows)):
        for j in range(i):
            if len(sets[i] & sets[j]) >= least * len(sets[i] | sets[j]):
                near += 1
                top = [min(top[i], top[j]) if x in (top[i], top[j]) else x for x in top]
    return {rows[i][0]: rows[x][0] for i, x in enumerate(top) if top.count(x) > 1}, near


def test_verified_groups_find_every_kind_of_near_copy(spark):
    rng = random.Random(11)
    rows = []
    for k in range(16):
        words = prose(rng, rng.choice([100, 150, 300])).split()
        n = len(words)
        at = rng.randrange(n // 2)
        block = words[:at] + prose(rng, n // 16).split() + words[at + n // 16 :]
        longer = words + prose(rng, n // 5).split()
        edited = [rng.choice(SYLLABLES) + "x" if i % 50 == 20 else w for i, w in enumerate(words)]
        rows += [(10 * k + i, " ".join(w)) for i, w in enumerate((words, block, longer, edited))]
    want, near = brute_groups(rows)
    assert near >= 48
    found = {r["rid"]: r["component"] for r in simhash.verified_groups(table(spark, rows)).collect()}
    assert found == want


@pytest.mark.parametrize("few, stars", [(16, 4), (2, 1), (2, 3)])
def test_verified_groups_lose_no_link_of_a_failed_head(spark, monkeypatch, few, stars):
    monkeypatch.setattr(simhash, "FEW", few)
    monkeypatch.setattr(simhash, "STARS", stars)
    rng = random.Random(12)
    words = prose(rng, 100).split()
    # The first text has the same distinct words as the next ones and shares half of their shingles.
    half = words[:50] + rng.sample(words[50:], 50)
    rows = [(0, " ".join(half)), (1, " ".join(words)), (2, " ".join(words[:98] + words[:97:-1]))]
    # Texts that share most of their words, around the similarity.
    base = prose(rng, 120).split()
    for k in range(40):
        at = rng.randrange(100)
        rows.append((100 + k, " ".join(base[:at] + prose(rng, rng.randint(2, 8)).split() + base[at + rng.randint(0, 6) :])))
    want, near = brute_groups(rows)
    assert want[1] == want[2] == 1 and 0 not in want and 20 < near < 780
    found = {r["rid"]: r["component"] for r in simhash.verified_groups(table(spark, rows)).collect()}
    assert found == want


# --- 2 --------------------------------------------------------------------------------------------------------------


def brute_removal(rows, length=100):
    seen, out = set(), []
    for i, text in rows:
        b = (text or "").encode()
        gone = np.zeros(len(b), bool)
        for p in range(len(b) - length + 1):
            w = b[p : p + length]
            if w in seen:
                gone[p : p + length] = True
            seen.add(w)
        runs = int((np.diff(np.concatenate([[0], gone.astype(int), [0]])) == 1).sum())
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out.append((str(i), len(b), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def _removed(df):
    return sorted((str(r["id"]), r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in substrings.dedup(df).collect())


def test_substring_dedup(spark, corpus):
    assert _removed(table(spark, corpus)) == brute_removal(corpus)
    assert _removed(table(spark, EMPTY)) == []


def test_substring_dedup_orders_repeated_rows_by_text(spark, corpus):
    rows = with_repeats(corpus)
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, (r[1] or "").encode()))
    assert _removed(table(spark, rows)) == brute_removal(order)


def test_substring_dedup_splits_large_groups(spark, monkeypatch, corpus):
    monkeypatch.setattr(substrings, "BUCKET", 2)
    monkeypatch.setattr(substrings, "ITEMS", 200)
    rng = random.Random(8)
    line = prose(rng, 40)
    rows = [(i, prose(rng, 30) + " " + line + " " + prose(rng, 30)) for i in range(25)]
    assert _removed(table(spark, rows + [(90, line)])) == brute_removal(rows + [(90, line)])


def test_suffix_sort_orders_suffixes():
    rng = random.Random(2)
    raw = bytes(rng.choice(b"ab") for _ in range(3000))
    data = np.frombuffer(raw, dtype=np.uint8)
    start = np.array([rng.randrange(0, 2900) for _ in range(700)])
    segment = np.sort(np.array([rng.randrange(0, 5) for _ in range(700)]))
    order = substrings.suffix_sort(windows.Prefixes(data), start, segment, 100)
    keys = [(int(segment[i]), raw[start[i] : start[i] + 100], i) for i in order.tolist()]
    assert keys == sorted(keys)


def test_collided_hashes_are_told_apart(monkeypatch):
    data = np.frombuffer(b"aaaabbbbaaaacccc", dtype=np.uint8)
    monkeypatch.setattr(windows.Prefixes, "range", lambda self, a, b: np.zeros(len(a), np.uint64))
    found = substrings.classes(data, np.array([0, 4, 8, 12]), np.zeros(4, int), 4)
    assert found[0] == found[2] and len(set(found.tolist())) == 3


def test_long_texts_are_read_in_pieces(monkeypatch):
    monkeypatch.setattr(substrings, "CHUNK_BYTES", 256)
    rng = random.Random(4)
    raw = prose(rng, 400).encode()
    covered = []
    for _, doc, _, lo, hi in substrings.anchors([b"short", raw, raw[:100]]):
        for d, a, b in zip(doc.tolist(), lo.tolist(), hi.tolist()):
            covered += [(d, x) for x in range(a, b + 1)]
    assert sorted(covered) == [(1, x) for x in range(len(raw) - 99)] + [(2, 0)]


# --- 1 --------------------------------------------------------------------------------------------------------------


def test_compact_windows_are_the_nodes_of_the_cartesian_tree():
    rng = np.random.default_rng(6)
    v = rng.integers(0, 2**63, 400, dtype=np.uint64) & ~np.uint64(127)
    least = windows.argmin(v, passages.LEAST)
    left, centre, right = passages.compact(v, least, np.arange(len(least)))
    covered = Counter()
    for a, c, b in zip(left.tolist(), centre.tolist(), right.tolist()):
        assert v[c] == v[a : b + 1].min() and (a == 0 or v[a - 1] < v[c]) and (b == len(v) - 1 or v[b + 1] < v[c])
        covered[c] += sum(1 for i in range(a, c + 1) for j in range(max(c, i + passages.LEAST - 1), b + 1))
    assert sum(covered.values()) == sum(1 for i in range(len(v)) for j in range(i + passages.LEAST - 1, len(v)))


def test_near_passages(spark, corpus):
    found = passages.near_passages(table(spark, corpus)).collect()
    runs = defaultdict(set)
    words = {i: (t or "").encode().lower().split() for i, t in corpus}
    for i, w in words.items():
        for p in range(len(w) - 49):
            runs[tuple(w[p : p + 50])].add(i)
    repeated = set().union(*(s for s in runs.values() if len(s) > 1))
    assert repeated <= {r["id"] for r in found}
    shingles = lambda w: {tuple(w[k : k + 5]) for k in range(len(w) - 4)}
    for r in found:
        own = shingles(words[r["id"]][r["start"] : r["end"]])
        assert r["end"] - r["start"] >= 50 and r["similarity"] >= 0.8 and own & shingles(words[r["other_id"]])
    of = {r["id"]: r["class_id"] for r in found}
    assert of[200] == of[201] == of[202] == of[203] == 200 and of[300] == of[301]
    assert not {0, 1, 106, 400} & set(of)
    assert passages.near_passages(table(spark, EMPTY)).count() == 0


def edited(rng, words, every):
    """The words with one in ``every`` replaced, left out or followed by another."""
    out = []
    for w in words:
        kind = rng.random() * every
        out += [w] if kind >= 1 else [w + "x"] if kind < 0.4 else [] if kind < 0.7 else [w, w + "y"]
    return out


def random_words(rng, n):
    return [f"{rng.getrandbits(40):x}" for _ in range(n)]


def test_near_passages_are_whole(spark):
    rng = random.Random(21)
    rows, want, exact = [], {}, {}
    for k, n in enumerate((50, 51, 60, 80, 120, 300, 700, 3000)):
        for every in (10**9, 80):
            passage = random_words(rng, n)
            a, b = random_words(rng, rng.randint(0, 150)), random_words(rng, rng.randint(0, 150))
            other = edited(rng, passage, every)
            i, j = len(rows), len(rows) + 1
            rows += [(i, " ".join(a + passage + random_words(rng, rng.randint(1, 90)))), (j, " ".join(b + other + random_words(rng, rng.randint(1, 90))))]
            (exact if every > 1000 else want)[i, j] = (len(a), len(a) + n, len(b), len(b) + len(other))
    found = defaultdict(dict)
    for r in passages.near_passages(table(spark, rows)).collect():
        found[r["id"], r["other_id"]][r["start"], r["end"]] = r["similarity"]
    for (i, j), (a, b, c, d) in exact.items():
        assert list(found[i, j].items()) == [((a, b), 1.0)] and list(found[j, i].items()) == [((c, d), 1.0)]
    near = 0
    for (i, j), (a, b, c, d) in want.items():
        w, x = rows[i][1].split()[a:b], rows[j][1].split()[c:d]
        s, t = ({tuple(y[k : k + 5]) for k in range(len(y) - 4)} for y in (w, x))
        if len(s & t) >= 0.8 * len(s | t):
            near += 1
            assert any(hi - lo >= 0.95 * (b - a) for lo, hi in found[i, j]), (i, j, b - a, found[i, j])
    assert near >= 5 and set(found) <= {p for i, j in (*want, *exact) for p in ((i, j), (j, i))}


def test_repeated_passages_of_a_pair_are_all_found(spark):
    rng = random.Random(22)
    one, two = random_words(rng, 90), random_words(rng, 120)
    gap = lambda: random_words(rng, 200)
    rows = [(1, " ".join(gap() + one + gap() + two + gap())), (2, " ".join(two + gap() + one + gap() + one)), (3, " ".join(one * 40)), (4, " ".join(one * 15))]
    found = defaultdict(set)
    for r in passages.near_passages(table(spark, rows)).collect():
        found[r["id"]].add((r["start"], r["end"]))
    covered = lambda i, a, b: any(lo <= a and hi >= b for lo, hi in found[i])
    assert covered(1, 200, 290) and covered(1, 490, 610) and covered(2, 0, 120) and covered(2, 320, 410) and covered(2, 610, 700)
    # A text of repeats is covered by passages, one after the other.
    for i, n in ((3, 3600), (4, 1350)):
        words = set().union(*(range(a, b) for a, b in found[i]))
        assert len(words) >= n - 90


@pytest.mark.parametrize("few, turns", [(16, 4), (2, 1), (3, 3)])
def test_members_that_fail_with_the_first_are_checked_further(spark, monkeypatch, few, turns):
    monkeypatch.setattr(passages, "FEW", few)
    monkeypatch.setattr(passages, "TURNS", turns)
    rng = random.Random(23)
    line = random_words(rng, 30)  # in all texts, too short to be a passage
    text = lambda: random_words(rng, 40) + line + random_words(rng, 40)
    rows = [text() for _ in range(40)]
    for k in (10, 20, 30):
        rows[k + 1] = rows[k][:20] + random_words(rng, 5) + rows[k][20:]
        rows[k + 2] = rows[k][:100] + random_words(rng, 9)
    found = {r["id"]: r["class_id"] for r in passages.near_passages(table(spark, [(i, " ".join(w)) for i, w in enumerate(rows)])).collect()}
    assert found == {k + j: k for k in (10, 20, 30) for j in range(3)}


def test_longest_passage_equals_all_pairs_of_windows():
    rng = random.Random(24)
    for turn in range(60):
        x = [rng.randint(0, 10**6) for _ in range(40)]
        y = edited(rng, [str(v) for v in x], 9)
        y = [int(re.sub("[xy]", "", v)) + (v[-1] in "xy") for v in y]
        at = [(i, j) for i in range(len(x)) for j in range(len(y)) if x[i] == y[j]]
        if not at:
            continue
        p, q = at[len(at) // 2]
        best = 0
        for a in range(p + 1):
            for b in range(p + 1, len(x) + 1):
                for c in range(q + 1):
                    for d in range(q + 1, len(y) + 1):
                        if min(b - a, d - c) > best and x[a] == y[c] and x[b - 1] == y[d - 1]:
                            s, t = set(x[a:b]), set(y[c:d])
                            if len(s & t) >= 0.8 * len(s | t):
                                best = min(b - a, d - c)
        found = passages.best_passage(np.array(x, dtype=np.uint32), np.array(y, dtype=np.uint32), p, q, least=1)
        assert min(found[1] - found[0], found[3] - found[2]) == best and found[4] >= 0.8


def test_stretches_of_one_word_give_few_pairs_of_places(spark, monkeypatch):
    rng = random.Random(25)
    # Too short with their surroundings to be passages: 30 places of each text would meet 30 of each other one.
    rows = [random_words(rng, 60) + ["tion"] * (30 + k) + random_words(rng, 60) for k in range(8)]
    rows += [random_words(rng, 40) + ["tion"] * 300 + random_words(rng, 40) for _ in range(2)]
    met, checked = [], passages._checked
    monkeypatch.setattr(passages, "_checked", lambda text, pairs: met.append(pairs.distinct().count()) or checked(text, pairs))
    found = passages.near_passages(table(spark, [(i, " ".join(w)) for i, w in enumerate(rows)])).collect()
    assert {r["id"]: r["class_id"] for r in found} == {8: 8, 9: 8}
    for i in (8, 9):
        assert set(range(40, 340)) <= set().union(*(range(r["start"], r["end"]) for r in found if r["id"] == i))
    places = sum(max(0, w.count("tion") - passages.SIZE + 1) for w in rows)
    assert sum(met[1:]) <= 16 * 45 + places


def test_places_inside_stretches():
    unit = np.arange(1, 8, dtype=np.uint64)
    h = np.concatenate([np.full(6, 99, np.uint64), np.tile(unit, 7), np.arange(50, 60, dtype=np.uint64), unit, np.arange(70, 75, dtype=np.uint64), unit])
    place = np.array([*range(6), *range(6, 55, 7), 65, 77])
    stretch, inner = passages._stretches(h, np.repeat([1, 2], [6, 9]), place)
    assert stretch.tolist() == [0] * 6 + [6] * 7 + [65, 77]
    assert place[inner].tolist() == [2, 3, 20, 27, 34]


def test_places_that_are_not_dense_have_no_passage():
    rng, seen = random.Random(26), set()
    for turn in range(150):
        x = [rng.randint(0, 30 if turn % 3 else 10**6) for _ in range(60)]
        y = np.array([int(re.sub("[xy]", "", v)) + (v[-1] in "xy") for v in edited(rng, [str(v) for v in x], rng.choice((3, 6, 12)))])
        x = np.array(x)
        dense, other = passages._dense(x, np.sort(y), least=20), passages._dense(y, np.sort(x), least=20)
        for p in range(0, len(x), 4):
            for q in np.nonzero(y == x[p])[0].tolist()[:2]:
                found = passages.best_passage(x, y, p, q, least=20)
                assert not found or (dense[p] and other[q])
                seen.add((bool(found), bool(dense[p] and other[q])))
    assert {(True, True), (False, False)} <= seen


def test_places_around_a_failed_one_need_no_check(monkeypatch):
    rng = random.Random(27)
    line = random_words(rng, 30)
    one, two = (random_words(rng, 40) + line + random_words(rng, 40) for _ in range(2))
    calls, best = [], passages.best_passage
    monkeypatch.setattr(passages, "best_passage", lambda *a, **k: calls.append(a) or best(*a, **k))
    monkeypatch.setattr(passages, "_dense", lambda x, y: np.ones(len(x), dtype=bool))
    context = passages._short(passages.tokens([" ".join(two).encode()])[0])
    columns = {"rid": [1], "text": [" ".join(one)], "other": [0], "other_n": [len(context)], "width": [256], "base": [0], "context": [context.tobytes()]}
    batch = pa.RecordBatch.from_pydict(columns | {"anchors": [[{"place": p, "other_place": p} for p in range(40, 66)]]})
    assert sum(b.num_rows for b in passages._verify([batch])) == 0 and len(calls) == 1


def test_near_passages_with_repeated_rows(spark, corpus):
    rows = with_repeats(corpus)
    found = passages.near_passages(table(spark, rows)).collect()
    long = [r for r in rows if r[1] and len(r[1].split()) >= 50]
    assert any(r["id"] is None for r in found) == any(i is None for i, _ in long)


# --- 3 --------------------------------------------------------------------------------------------------------------


def brute_spans(text):
    text, out = text or "", []
    for m in re.finditer(r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text):
        if len(m[2]) >= 12:
            out.append((m.start(), 0, m.end()))
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    return sorted(out)


def test_secret_scan(spark, corpus):
    rng = random.Random(9)
    random_run = "".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/") for _ in range(48))
    extra = [
        (900, "é api_key = 'abcd-1234.efgh' and PASSWORD:hunter2hunter2 token token=token=abcdefghijkl"),
        (901, "AKIA" + "Q" * 14 + " AKIA" + "Q" * 13 + " deadbeefdeadbeef deadbeefdeadbee " + "0" * 40),
        (902, "secret: a token: abcdefghijklm passwd=short password:token:abcdefghijklmnop"),
        (903, "ſecret=abcdefghijklmnop toKen=abcdefghijklmnop"),
        (904, f"see {random_run} here"),
        (905, "x" * 20_000 + " api-key=abcdefghijklmnop"),
    ]
    rows = with_repeats(corpus) + extra
    found = secrets.scan(table(spark, rows)).collect()
    assert len(found) == len(rows)
    by = defaultdict(list)
    for r in found:
        by[r["id"]].append(r)
    for i, text in rows:
        base = brute_spans(text)
        text_of = ",".join(f"{secrets.KINDS[k]}:{s}:{e}" for s, k, e in base)
        match = [r for r in by[i] if r["base_sha256"] == hashlib.sha256(text_of.encode()).hexdigest()]
        assert match, (i, text_of)
        assert [match[0][c] for c in ("n_assign", "n_access", "n_hex")] == [sum(k == x for _, k, _ in base) for x in range(3)]
        kept = [s for s in match[0]["spans"].split(",") if s and not s.startswith("random")]
        assert ",".join(kept) == text_of
    assert any(s.startswith("random:4:52") for s in by[904][0]["spans"].split(","))
    assert sum(r["n_random"] for r in found) <= 2
    assert secrets.scan(table(spark, EMPTY)).count() == 0


def test_battery_refutes_order_and_accepts_chance():
    rng = np.random.default_rng(3)
    p = secrets.battery(rng.integers(0, 16, (2000, 60)), 16)
    assert p.shape == (2000, 3) and all(0.02 < (p[:, i] < 0.05).mean() < 0.09 for i in range(3))
    totals = secrets.fisher(p)
    assert np.mean([secrets.refuted(t) for t in totals]) < 0.01
    for odd in (np.arange(64) % 16, np.zeros(40, int), np.tile([1, 14], 20)):
        assert secrets.refuted(secrets.fisher(secrets.battery(odd[None, :], 16))[0])
    one = np.random.default_rng(4).integers(0, 16, (1, 40))
    seen = np.bincount(one[0], minlength=16)
    chi = ((seen - 2.5) ** 2 / 2.5).sum()
    draws = rng.integers(0, 16, (20_000, 40))
    above = np.mean([((np.bincount(d, minlength=16) - 2.5) ** 2 / 2.5).sum() >= chi for d in draws])
    assert abs(secrets.battery(one, 16)[0, 0] - above) < 0.02


def test_evidence_grows_with_length_and_is_none_for_ordinary_runs():
    rng = random.Random(2)
    counts = np.full((secrets.STATES, secrets.STATES), 0.5)
    text = secrets.NUMBER[np.frombuffer(prose(rng, 20_000).encode(), dtype=np.uint8)]
    np.add.at(counts, (text[:-1], text[1:]), 1)
    ordinary = secrets.Ordinary.of(counts / counts.sum(axis=1, keepdims=True))
    letters = secrets.UPPER + secrets.LOWER + secrets.DIGITS
    found = [np.median([ordinary.evidence("".join(rng.choice(letters) for _ in range(n))) for _ in range(30)]) for n in (20, 32, 64)]
    assert 5 < found[0] < found[1] < found[2]
    words = [prose(rng, 40).replace(" ", "")[:n] for n in (20, 32, 64) for _ in range(30)]
    assert sum(ordinary.evidence(w) > 6 for w in words) <= 1
    assert ordinary.evidence("ab" * 20) == -math.inf


def test_redaction(spark):
    rows = [(1, "key AKIA" + "Z" * 16 + " end"), (2, None), (3, "clean"), (4, "token=" + "ab12" * 6)]
    found = {r["doc_id"]: r["text"] for r in secrets.redact(table(spark, rows)).collect()}
    assert found == {1: "key [SECRET] end", 2: None, 3: "clean", 4: "[SECRET]"}


# --- 4 --------------------------------------------------------------------------------------------------------------


def test_main_text_of_generated_pages():
    model, rng = html.trained(), random.Random(77)
    right = total = 0
    for _ in range(120):
        page = html._sample_page(rng)
        nodes = html.Nodes()
        nodes.page(page)
        own = [t for t in nodes.text if t and html.OWN in t]
        total += 1
        right += html.main_texts([page.replace(html.OWN, "")], model)[0] == "\n\n".join(t.replace(html.OWN, "").strip() for t in own)
    assert right / total > 0.8


GERMAN = "Der Absatz %d erzählt eine lange Geschichte über Wasser, Wind und Zeit, die niemand so recht glauben mag, und endet hier. Wer sie hört, geht nach Hause und denkt noch lange daran. "


def tuning_page(names, extra=""):
    """A page of none of the generator's layouts: other words, every part a div. PULL, NAMING and PAGES were chosen
    with these pages in view, so they show what the model was made to do, not how well it does on pages unseen."""
    top, main, talk, foot = (f' class="{n}"' if n else "" for n in names)
    text = "".join(f"<p>{GERMAN % k}</p>" for k in range(5))
    return (
        f"<html><body><div{top}><a href=/>Start</a> <a href=/n>Nachrichten</a> <a href=/s>Sport</a></div><div{main}><h1>Eine Überschrift</h1>{extra}{text}</div>"
        f"<div{talk}><h3>Kommentare</h3><div><b>Anna</b> Sehr schön.</div><div><b>Ben</b> Finde ich auch, danke.</div></div><div{foot}>&copy; 2020 Beispiel <a href=/i>Impressum</a></div></body></html>"
    )


@pytest.mark.parametrize("names", [("kopfzeile", "inhalt", "kommentare", "fusszeile"), ("a", "b", "c", "d"), ("", "", "", ""), ("header", "content", "comments", "footer")])
def test_main_text_does_not_hang_on_names(names):
    blocks = [(GERMAN % k).strip() for k in range(5)]
    extras = {
        "": None,
        "<svg width=1><path d=1>": None,
        "<object data=x>": None,
        "<p title=it's>Ein Absatz mit Titel, der wichtig ist und lang genug wird.</p>": "Ein Absatz mit Titel, der wichtig ist und lang genug wird.",
        "<p>Formel <math><mi>x</mi><mo>=</mo><mn>2</mn></math> gilt hier immer, sagt man.</p>": "Formel x=2 gilt hier immer, sagt man.",
    }
    for extra, block in extras.items():
        want = "\n\n".join(["Eine Überschrift", *([block] if block else []), *blocks])
        assert html.main_texts([tuning_page(names, extra)], html.trained()) == [want], extra


@pytest.mark.parametrize("page", ["<a title='" * 100_000, "<p>x " + "<svg>" * 100_000, "<p>x " + "<svg " * 100_000 + ">", "<p>x " + '<!-- <a b="' * 60_000 + ">", "<a b=\"" * 99_999 + ">", "<" * 300_000 + ">"])
def test_broken_markup_takes_linear_time(page):
    html.trained()
    began = time.perf_counter()
    html.main_texts([page], html.trained())
    assert time.perf_counter() - began < 2


def test_tokens_of_names_are_told_apart_by_their_weights():
    weights = html.trained().weights
    of = lambda w: weights[zlib.crc32(w.encode()) % html.TOKENS]
    assert min(of("content"), of("article")) > 0 > max(of("sidebar"), of("werbung"), of("commentaires"))


def test_decoding_has_no_contradictions():
    nodes, rng = html.Nodes(), np.random.default_rng(0)
    nodes.page("<body><div><p>a</p><div><p>b</p></div></div><ul><li>c<li>d</ul></body>")
    for _ in range(50):
        keep = html.decode(nodes, rng.normal(0, 3, len(nodes.tag)))
        assert all(not k or p < 0 or keep[p] for k, p in zip(keep, nodes.parent))


PAGE = (
    '<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p><p>no</p>";</script></head><body><nav><ul><li><a href="/a">Menu one</a></li><li><a href="/b">Menu two</a></li></ul></nav>'
    '<!-- <p>ad</p> --><div class="ad">Buy now, buy this.</div><article><h1>Fish &amp; chips&nbsp;today</h1><p><b>First   line of text, that is long enough.<br><p>Second &lt;line&gt; of text\n goes on, and on &am and on.</p></article>'
    "<footer>&copy; example.com &middot; All rights.</footer>"
)


def test_extraction_of_pages(spark):
    rows = [(1, PAGE), (2, None), (3, ""), (4, "<p>"), (1, PAGE), (None, PAGE + "</body></html>"), (5, "<div <b> &#x; < >" * 50)]
    data = [(i, "u", h, 1, 2) for i, h in rows]
    found = html.extract(spark.createDataFrame(data, "page_id long, url string, html string, text long, n_chars long")).collect()
    want = "Fish & chips today\n\nFirst line of text, that is long enough.\n\nSecond <line> of text goes on, and on &am and on."
    assert [r["text"] for r in found if r["page_id"] in (1, None)] == [want] * 3
    assert all(r["n_chars"] == len(r["text"]) for r in found) and {r["page_id"]: r["text"] for r in found}[2] == ""
    assert html.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


# --- 5 --------------------------------------------------------------------------------------------------------------


def weighted(a, b, size=5):
    grams = lambda w: Counter(tuple(w[i : i + size]) for i in range(len(w) - size + 1))
    x, y = grams(a), grams(b)
    both = sum((x & y).values())
    return both / (sum(x.values()) + sum(y.values()) - both)


def test_leaks(spark, corpus):
    rng = random.Random(12)
    items = [(1, prose(rng, 30)), (2, prose(rng, 80)), (3, "one two"), (4, None), (5, ""), (6, prose(rng, 12)), (6, prose(rng, 14))]
    w = items[1][1].split()
    near = " ".join(w[:20] + ["odd"] + w[21:])
    rows = with_repeats(corpus) + [(500, prose(rng, 50) + " " + items[0][1].upper() + " " + prose(rng, 9)), (501, prose(rng, 20) + "\n" + near), (502, items[0][1]), (503, " ".join(items[0][1].split()[:15]) + " " + prose(rng, 40)), (504, "say one two three"), (505, prose(rng, 8) + " " + items[5][1] + " " + items[6][1])]
    bench = spark.createDataFrame([(i, t, 1, 2) for i, t in items], "item_id long, text string, n long, h long")
    found = {(r["id"], r["item_id"], round(r["similarity"], 9)) for r in decontam.leaks(table(spark, rows), bench).collect()}
    want = set()
    for i, text in rows:
        d = (text or "").lower().split()
        for k, item in items:
            b = (item or "").lower().split()
            if not b:
                continue
            size, n = min(5, len(b)), min(len(b), len(d))
            best = max((weighted(d[s : s + n], b, size) for s in range(len(d) - n + 1)), default=0.0) if n >= size else 0.0
            if best >= 0.8:
                want.add((i, k, round(best, 9)))
    assert {x[:2] for x in found} == {x[:2] for x in want} and {(500, 1, 1.0), (502, 1, 1.0), (504, 3, 1.0)} <= found
    assert (501, 2) in {x[:2] for x in found} and 503 not in {x[0] for x in found}
    assert decontam.leaks(table(spark, EMPTY), bench).count() == 0
    assert decontam.leaks(table(spark, rows), bench.limit(0)).count() == 0


def test_leaks_run_no_python(spark, corpus):
    bench = spark.createDataFrame([(1, corpus[5][1])], "item_id long, text string")
    plan = decontam.leaks(table(spark, corpus), bench)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|InArrow|ArrowEval", plan)


def test_fingerprint_of_arrays(spark):
    rng = random.Random(1)
    lists = [[rng.getrandbits(64) - (1 << 63) for _ in range(n)] for n in (1, 2, 7, 40)]
    df = spark.createDataFrame([(x,) for x in lists], "h array<long>").select(decontam.fingerprint(F.col("h")).alias("fp"))
    want = [simhash._signed(sum(1 << b for b in range(64) if 2 * sum((v >> b) & 1 for v in x) > len(x))) for x in lists]
    assert [r["fp"] for r in df.collect()] == want


def test_clean_keeps_rows_as_they_are(spark, corpus):
    bench = spark.createDataFrame([(1, corpus[5][1])], "item_id long, text string")
    df = table(spark, with_repeats(corpus))
    kept = decontam.clean(df, bench)
    assert kept.columns == df.columns and 5 not in {r["doc_id"] for r in kept.collect()} and kept.count() >= df.count() - 3


# --- 6 --------------------------------------------------------------------------------------------------------------


def test_grades_of_held_out_rows(spark):
    rng = random.Random(20)
    rows, labels = [], []
    for i in range(600):
        kind = i % 3
        text = prose(rng, rng.randint(20, 200))
        if kind == 0:
            text = " ".join(w.upper() + "!!" for w in text.split())
        elif kind == 1:
            w = text.split()
            w[rng.randrange(len(w))] = rng.choice(["idiot", "moron,", "Trash"])
            text = " ".join(w)
        rows.append((i, text))
        if i < 450:
            labels.append((i, int(kind != 0), int(kind == 1)))
    labels += [(None, 1, 0), (7, None, 1), (2, 1, None)]
    frame = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    rows += [(1000, None), (1001, ""), (3, rows[3][1]), (None, rows[5][1])]
    found = quality.grade(table(spark, rows), frame).collect()
    assert len(found) == len(rows)
    held = {r["id"]: r for r in found if r["id"] is not None and 450 <= r["id"] < 600}
    right = sum(r["accepted"] == (i % 3 == 2) for i, r in held.items())
    assert right / len(held) > 0.95
    assert all(0 <= r["p_good"] <= r["expected_grade"] <= 2 for r in found)
    order = [np.mean([r["expected_grade"] for i, r in held.items() if i % 3 == k]) for k in (0, 1, 2)]
    assert order[0] < order[1] < order[2]
    df = table(spark, rows)
    assert quality.accept(df, frame).columns == df.columns
    assert quality.accept(df, frame).count() == sum(r["accepted"] for r in found)
    assert quality.grade(table(spark, EMPTY), frame).count() == 0
    assert all(r["accepted"] for r in quality.grade(table(spark, rows[:3]), frame.limit(0)).collect())


def test_cuts_are_ordered_and_tails_fall():
    rng = random.Random(2)
    rows = [([g + 10 * k for k in range(3)] + [rng.randrange(100, 200)], g) for g in (0, 1, 2) for _ in range(60)]
    m = quality.fit(quality.Sample.of([np.array(f) for f, _ in rows], [g for _, g in rows]))
    assert list(m.cuts) == sorted(m.cuts)
    tail = m.tail(np.array([-2.0, 0.0, 3.0]))
    assert (np.diff(tail, axis=0) >= 0).all() and (tail[:, 0] >= tail[:, 1]).all()


def test_only_telling_features_reach_the_driver(spark):
    """The model is that of all features, though the driver gets only those that tell grades apart."""
    rng = random.Random(5)
    rows = [(i, " ".join([["bad", "rude", "fine"][i % 3], "same"] + [f"w{rng.randrange(3000)}" for _ in range(30)])) for i in range(300)]
    labels = spark.createDataFrame([(i, int(i % 3 > 0), int(i % 3 == 1)) for i, _ in rows], "doc_id long, quality int, toxic int")
    sample = quality.labelled(table(spark, rows), labels)
    full = quality.Sample.of([np.array(quality.features(text.encode()), dtype=np.int32) for _, text in rows], [i % 3 for i, _ in rows])
    assert set(sample.feature.tolist()) == set(quality._screened(full).tolist()) and len(sample.feature) < len(full.feature) / 10
    assert quality.fit(sample) == quality.fit(full)


def test_frequent_shingles_are_counted_over_all_texts(spark, monkeypatch):
    """A line of 70 texts is found wherever those stand; a task that holds few counts is short by a bound."""
    line = " ".join(f"c{k}" for k in range(5))
    rows = [(i, f"{line} " * (1 + i % 2) + " ".join(f"w{i}x{k}" for k in range(20))) for i in range(70)]
    key = passages._distinct([line.encode()])
    found, n = windows.frequent_keys(table(spark, rows), passages._distinct, 10)
    # Every second text has the line twice, and so the four shingles across its ends.
    assert found[0] == key[0] and n.tolist() == [70, 35, 35, 35, 35]
    assert len(windows.frequent_keys(table(spark, rows[:12]), passages._distinct, 10)[0]) == 0
    monkeypatch.setattr(windows, "ENTRIES", 4)
    parts = [(np.array([7, 10 * k + 1, 10 * k + 2, 10 * k + 3], dtype=np.uint64), np.ones(4, dtype=np.int64)) for k in range(1, 30)]
    held = parts[0]
    for part in parts[1:]:
        held = windows.added([held, part])
    assert len(held[0]) <= 4 and held[1][held[0] == 7].item() >= 29 - 29 * 4 / 5


# --- 7 --------------------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("head", [3, 1 << 18])
def test_base_scores(spark, corpus, head):
    rows = with_repeats(corpus)
    found = lm.scores(table(spark, rows), head=head).collect()
    counts = Counter()
    for i, text in rows:
        if zlib.crc32(("" if i is None else str(i)).encode()) % 7 != 2:
            counts.update((text or "").encode().lower().split() + [None])
    n, v = sum(counts.values()), len(counts)
    want = []
    for i, text in rows:
        tokens = (text or "").encode().lower().split() + [None]
        held = zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2
        want.append((str(i), held, len(tokens), sum(counts[t] > 0 for t in tokens), n, round(sum(math.log10((counts[t] + 1) / (n + v + 1)) for t in tokens), 6)))
    got = [(str(r["id"]), r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in found]
    assert sorted(got) == sorted(want)
    assert all(r["score"] < 0 for r in found)
    assert lm.scores(table(spark, EMPTY)).count() == 0


def test_exchange_raises_the_likelihood_and_finds_classes():
    rng = np.random.default_rng(4)
    size, movable = 24, 20
    follows = np.zeros((size, size))
    for _ in range(20_000):  # words of one half are followed by words of the other
        a = rng.integers(0, movable)
        follows[a, rng.integers(movable // 2, movable) if a < movable // 2 else rng.integers(0, movable // 2)] += 1
    follows[movable:, :movable] += 1

    def fit(of):
        member = np.eye(int(of.max()) + 1)[of]
        n = member.T @ follows @ member
        x = lambda v: (v * np.log(np.where(v > 0, v, 1))).sum()
        return x(n) - x(n.sum(0)) - x(n.sum(1))

    start = np.concatenate([np.arange(movable) % 2, 2 + np.arange(size - movable)])
    of = lm.exchange(follows, movable, classes=2)
    assert fit(of) > fit(start)
    assert len(set(of[: movable // 2])) == 1 and len(set(of[movable // 2 : movable])) == 1 and of[0] != of[-5]


def test_model_is_a_distribution():
    words = {f"w{i}".encode(): i for i in range(6)}
    symbols = lm.Symbols(words, 6)
    pairs = np.random.default_rng(1).integers(0, 9, (symbols.size, symbols.size)).astype(float)
    m = lm.model(symbols, pairs, np.array([9.0, 8, 7, 6, 5, 4]), 3, 11)
    assert np.allclose((10**m.step).sum(axis=1), 1)
    for c in set(m.of[:6]):
        assert np.isclose(sum(10 ** m.head[i] for i in range(6) if m.of[i] == c), 1)
    assert np.isclose(sum((c + 0.5) / m.rare_total for c in (5, 4, 2)) + 10**m.rare_floor, 1)


def test_model_beats_the_base_on_held_out_texts(spark):
    rng = random.Random(31)
    nouns, verbs = [f"n{i}" for i in range(60)], [f"v{i}" for i in range(60)]
    rows = [(i, " ".join(x for _ in range(60) for x in (rng.choice(nouns), rng.choice(verbs)))) for i in range(150)]
    held = [r for r in lm.scores(table(spark, rows)).collect() if r["held_out"]]
    assert held and sum(r["score"] for r in held) > sum(r["base_score"] for r in held) + 50 * len(held) * 0.2


def test_scores_equal_a_direct_class_bigram(spark):
    """Every head word in an exchanged class, found again by moving each word and taking the whole likelihood, and scores by loops."""
    rng = random.Random(12)
    kinds = [[f"{c}{i}" for i in range(9)] for c in "nva"]
    rows = [(i, " ".join(rng.choice(kinds[j % 3])[: rng.choice((2, 2, 2, 3))] for j in range(40)) + " n0 n0" * (i % 3) + f" once{i} more" * (i % 2)) for i in range(90)] + [(90, ""), (91, None)]
    head, clustered = 20, 6
    texts = {i: (text or "").split() for i, text in rows}
    train = {i: t for i, t in texts.items() if zlib.crc32(str(i).encode()) % 7 != 2}
    counts = Counter(w for t in train.values() for w in t)
    top = [w for w, _ in sorted(((w, c) for w, c in counts.items() if c > 1), key=lambda x: (-x[1], x[0]))[:head]]
    assert len(top) == head
    symbols = lm.Symbols({w.encode(): i for i, w in enumerate(top)}, clustered)
    rank = {w: i for i, w in enumerate(top)}

    def table(of_word, end, size):
        n = np.zeros((size, size))
        for t in train.values():
            x = [end, *map(of_word, t), end]
            for a, b in zip(x, x[1:]):
                n[a, b] += 1
        return n

    numbers = symbols.of_rank()
    pairs = table(lambda w: numbers[rank.get(w, head)], symbols.end, symbols.size)
    of = lm.exchange(pairs, clustered)
    k, end = int(of.max()) + 1, int(of[symbols.end])
    start = {w: int(of[numbers[i]]) for i, w in enumerate(top)}
    rare = int(of[symbols.rare])

    def likelihood(classes):
        n = table(lambda w: classes.get(w, rare), end, k)
        x = lambda v: (v * np.log(np.where(v > 0, v, 1))).sum()
        return x(n) - x(n.sum(0)) - x(n.sum(1))

    found = dict(start)
    for w in top[clustered:]:
        found[w] = max(range(int(of[:clustered].max()) + 1), key=lambda b: round(likelihood(start | {w: b}), 6))
    assert set(start.values()) != set(found.values())
    n = table(lambda w: found.get(w, rare), end, k)
    base = [(n[:, c].sum() + 0.1) / (n.sum() + 0.1 * k) for c in range(k)]
    in_class = Counter()
    for w in top:
        in_class[found[w]] += counts[w]
    others = {w: c for w, c in counts.items() if w not in rank}

    def step(a, b):
        seen = (n[a] > 0).sum() + 1
        return (n[a, b] + seen * base[b]) / (n[a].sum() + seen)

    def word(w):
        return counts[w] / in_class[found[w]] if w in rank else (others.get(w, 0) + 0.5) / (sum(others.values()) + 0.5 * (len(others) + 1))

    def score(t):
        x = [end, *(found.get(w, rare) for w in t), end]
        return sum(math.log10(step(a, b)) for a, b in zip(x, x[1:])) + sum(math.log10(word(w)) for w in t)

    got = {r["id"]: r["score"] for r in lm.scores(spark.createDataFrame(rows, "doc_id long, text string"), head=head, clustered=clustered).collect()}
    assert got.keys() == texts.keys()
    for i, t in texts.items():
        assert math.isclose(got[i], score(t), rel_tol=1e-9), i


# --- 8 --------------------------------------------------------------------------------------------------------------


def vocabulary():
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def test_packing(spark, corpus):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(vocabulary())
    odd = [(910, "İstanbul ΣΑΣ don't it's 'S <|endoftext|> x<|startoftext|>y <|ENDOFTEXT|>"), (911, "a\x1cb\x85c\xa0d é ́x 12 ½ ab12!!c."), (912, prose(random.Random(1), 30_000))]
    rows = with_repeats(corpus) + odd
    found = packing.pack(table(spark, rows), vocabulary()).collect()
    by = defaultdict(list)
    for r in found:
        by[r["id"]].append((r["piece"], r["start"], r["length"], r["ids_crc32"]))
    want = defaultdict(list)
    for i, text in rows:
        ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [1], dtype="<u4")
        for k, s in enumerate(range(0, len(ids), 4096)):
            want[i].append((k, s, len(ids[s : s + 4096]), zlib.crc32(ids[s : s + 4096].tobytes())))
    assert {i: sorted(x) for i, x in by.items()} == {i: sorted(x) for i, x in want.items()}
    places = defaultdict(list)
    for r in found:
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    for own in places.values():
        own.sort()
        assert own[0][0] == 0 and all(a + b == c for (a, b), (c, _) in zip(own, own[1:])) and sum(n for _, n in own) <= 4096
    assert len(places) <= -(-sum(r["length"] for r in found) // 4096) + 1
    assert packing.pack(table(spark, EMPTY), vocabulary()).count() == 0


@pytest.mark.parametrize("seed", range(6))
def test_plans_hold_each_length_and_fit(seed):
    rng = random.Random(seed)
    counts = {rng.choice([rng.randint(1, 64), rng.randint(1, 4096), rng.randint(1900, 2200)]): rng.choice([1, 3, 50, 2000]) for _ in range(rng.choice([1, 5, 200]))}
    plan = packing.plan(counts)
    held = Counter()
    for config, n in plan:
        assert 0 < sum(k * a for k, a in config.items()) <= 4096
        for k, a in config.items():
            held[k] += a * n
    assert held == Counter(counts)
    used, bound = sum(n for _, n in plan), packing.solve(counts)[1]
    assert -(-sum(k * n for k, n in counts.items()) // 4096) <= math.ceil(bound - 1e-6) <= used
    assert used <= sum(n for _, n in packing._best_fit(counts, 4096)) * 1.01 + 1
    layout = packing.Layout.of(plan)
    for k in list(counts)[:20]:
        rank = np.arange(counts[k])
        sequence, offset = layout.place(np.full(len(rank), k), rank)
        assert len(set(zip(sequence.tolist(), offset.tolist()))) == len(rank)


def test_program_beats_best_fit_where_configurations_matter():
    rng = random.Random(1)
    counts = Counter(rng.randint(1000, 2200) for _ in range(5000))
    found, bound = packing.solve(counts)
    assert bound <= sum(n for _, n in found) <= 0.99 * sum(n for _, n in packing._best_fit(counts, 4096))


def test_weights_are_multiplied_and_bound_the_program():
    demand = np.zeros(11)
    demand[[3, 4, 6]] = 10, 20, 10
    configs, covered, bound = packing.fractional(demand)  # 4 + 6, 3 + 3 + 4, 4 + 4: the program needs 20 / 1 and less
    assert all(sum(k * a for k, a in c.items()) <= 10 for c, _ in configs) and 15 <= bound <= 17.5 + 1e-9
    held = Counter()
    for c, x in configs:
        for k, a in c.items():
            held[k] += a * x
    assert all(abs(held[k] - covered[k]) < 1e-6 for k in (3, 4, 6))


def test_knapsack_is_best():
    rng = np.random.default_rng(2)
    value = np.full(41, -np.inf)
    value[[3, 7, 11, 19]] = rng.random(4) * 10
    sack = packing.Knapsack(value)
    best = [0.0] * 41
    for c in range(1, 41):
        best[c] = max([best[c - 1]] + [best[c - k] + value[k] for k in (3, 7, 11, 19) if k <= c])
        assert np.isclose(sack.best[c], best[c]) and np.isclose(sum(value[k] for k in sack.fill(c)), best[c]) and sum(sack.fill(c)) <= c


# --- 10 -------------------------------------------------------------------------------------------------------------


def brute_top(rows, k=20):
    out = []
    good = [(i, [math.floor(64 * float(x)) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    for q, (i, v) in enumerate(good):
        if i % 20:
            continue
        scored = sorted(((-sum(a * b for a, b in zip(v, w)), j) for c, (j, w) in enumerate(good) if c != q))[:k]
        out += [(i, r, j, -s) for r, (s, j) in enumerate(scored, 1)]
    return sorted(out)


def _top(spark, rows):
    df = spark.createDataFrame([(i, v, 1, 2.0, 3) for i, v in rows], "vec_id long, embedding array<float>, row long, norm double, v long")
    return sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in topk.top_k(df).collect())


def test_top_k(spark, monkeypatch):
    monkeypatch.setattr(topk, "CANDIDATES", 64)
    monkeypatch.setattr(topk, "QUERIES", 100)
    rng = np.random.default_rng(7)
    v = np.float32(rng.normal(0, 1, (700, 12)) * rng.gamma(2, 1, (700, 1)))
    rows = [(int(i), [float(x) for x in r]) for i, r in enumerate(v)]
    rows += [(1000, rows[5][1]), (1020, rows[5][1]), (1040, [0.0] * 12), (1060, None), (1080, [1.0] * 11 + [None]), (1100, [float("nan")] * 12), (1120, [float("inf")] + [0.0] * 11), (None, rows[0][1])]
    assert _top(spark, rows) == brute_top(rows)


def test_top_k_of_few_and_of_repeated_rows(spark):
    few = [(20, [1.0, -0.5]), (3, [0.25, 2.0]), (4, [0.25, 2.0])]
    assert _top(spark, few) == brute_top(few)
    twice = few + [(20, [1.0, -0.5])]
    assert _top(spark, twice) == brute_top(twice)
    assert _top(spark, []) == []
    big = [(20, [3.0e7, 1.0]), (21, [2.9e7, -1.0]), (22, [-3.0e7, 0.0])]
    assert _top(spark, big) == brute_top(big)


def test_verified_groups_take_simhash_links_first(spark, monkeypatch):
    rng = random.Random(77)
    base = [prose(rng, 120) for _ in range(6)]
    rows = [(i, t) for i, t in enumerate(base)] + [(10 + i, t.replace(" ", "  ", 1)) for i, t in enumerate(base)]
    docs = table(spark, rows)
    links = {(r["a"], r["b"]) for r in simhash.linked(simhash.keyed(docs, "doc_id", "text"), 2).collect()}
    assert {(i, 10 + i) for i in range(6)} <= links and all(a < b for a, b in links)
    seen, linked = [], simhash.linked
    monkeypatch.setattr(simhash, "linked", lambda *args: seen.append(1) or linked(*args))
    found = {r["rid"]: r["component"] for r in simhash.verified_groups(docs).collect()}
    assert seen and found == {k: i for i in range(6) for k in (i, 10 + i)}
