"""Near-duplicate passages: compact windows of token min-hashes, joined where enough hashes agree."""

from __future__ import annotations

from bisect import bisect_left
from functools import lru_cache, partial
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lotwise.llm.common import BROADCAST_ROWS, CHUNK_BYTES, checkpoint, components, discard, keyed, mix, slices, small, split_copies, stash
from lotwise.llm.windows import Prefixes, argmin, frequent_keys, repeated, runs

#: Words of a shingle, the token that is hashed.
SIZE = 5
#: Least shingles of a passage: 50 words.
LEAST = 46
SIMILARITY = 0.8
#: Hash functions; a candidate agrees in two of them.
HASHES = 3
#: Least reach of a check, in shingles on each side of an agreeing place; it doubles up to what the shorter text can need.
REACH = 64
#: Members of a cell whose open pairs are all checked at once, and turns in which larger ones are checked against one member.
FEW, TURNS = 128, 4
#: Places that stay at either end of a stretch that repeats itself.
ENDS = 2
#: Shingles on each side of a place by which large cells are split, and how many two passages around it have in common at least.
NEAR, COMMON = LEAST - 1, 41
SPACE = np.zeros(256, dtype=bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
SEEDS = mix(np.arange(11, 11 + HASHES, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def word_hashes(raw: bytes) -> np.ndarray:
    """A hash of each lower-cased (A-Z) word."""
    out, at, raw = [], 0, raw.lower()
    while at < len(raw):
        end = min(len(raw), at + CHUNK_BYTES)
        while end < len(raw) and not SPACE[raw[end]]:
            end += 1
        data = np.frombuffer(raw[at:end], dtype=np.uint8)
        inside = np.concatenate([[False], ~SPACE[data], [False]])
        edge = np.nonzero(inside[1:] != inside[:-1])[0]
        out.append(mix(Prefixes(data).range(edge[::2], edge[1::2]) + (edge[1::2] - edge[::2]).astype(np.uint64)))
        at = end
    return np.concatenate(out) if out else np.zeros(0, dtype=np.uint64)


def tokens(raws: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Shingle hashes of texts one after the other, how many each text has, and where each text's begin.

    The place of a shingle is that of its first word; the last SIZE - 1 words of a text begin none,
    their places are left out.
    """
    joined = b"\n".join(raws)
    if len(raws) == 1 or len(joined) > 8 * CHUNK_BYTES:
        each = [word_hashes(raw) for raw in raws]
        words, count = np.concatenate(each) if each else np.zeros(0, np.uint64), np.array([len(e) for e in each], dtype=np.int64)
    else:
        words = word_hashes(joined)
        count = np.array([len(raw.split()) for raw in raws], dtype=np.int64)
    n = max(0, len(words) - SIZE + 1)
    h = np.zeros(n, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for i in range(SIZE):
            h = h * np.uint64(0x100000001B3 * 2 + 1) + words[i : n + i]
    h = mix(h)
    many = np.maximum(0, count - SIZE + 1)
    start = np.cumsum(count) - count
    places = np.repeat(start - (np.cumsum(many) - many), many) + np.arange(int(many.sum()))
    return h[places], many, np.cumsum(many) - many


#: The order of the shingles: up to FREQUENT shingles that occur in many texts come after all others.
FREQUENT = 200_000
#: Bits of the table of frequent shingles; another shingle that falls on the same bit comes late, too.
BITS = 22


#: Upper bits of a shingle that are not counted; while the shingles are sorted the number of the text takes their room.
TEXT_BITS = np.uint64(16)


def _distinct(raws: list[bytes]) -> np.ndarray:
    """The distinct shingles of each text, ascending."""
    h, many, _ = tokens(raws)
    doc = np.repeat(np.arange(len(many)).astype(np.uint16).astype(np.uint64), many)
    h = np.sort(h << TEXT_BITS | doc)
    return h[np.append(True, h[1:] != h[:-1])] >> TEXT_BITS if len(h) else h


def frequent(text: DataFrame) -> bytes:
    """A table of the shingles that come last in every order of the hash functions, so that a common line gives no least values.

    They are counted over all texts. Passages near each other have least values in common under any order.
    """
    keys, _ = frequent_keys(text, _distinct, FREQUENT)
    table = np.zeros(1 << BITS, dtype=np.uint8)
    table[keys & np.uint64((1 << BITS) - 1)] = 1
    return np.packbits(table).tobytes()


@lru_cache(maxsize=2)
def _table(packed: bytes) -> np.ndarray:
    return np.unpackbits(np.frombuffer(packed, dtype=np.uint8)).astype(np.uint64) << np.uint64(63)


def _ordered(h: np.ndarray, many: np.ndarray, start: np.ndarray, late: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray], np.ndarray]:
    """For each hash function its values and the least place of each window of LEAST shingles; the windows within a text."""
    inside = np.zeros(len(h) + 1, dtype=np.int64)
    long = many >= LEAST
    np.add.at(inside, start[long], 1)
    np.add.at(inside, start[long] + many[long] - LEAST + 1, -1)
    valid = np.nonzero(np.cumsum(inside[:-1]) > 0)[0]
    last = late[h & np.uint64((1 << BITS) - 1)]
    values = [(mix(h ^ s) >> np.uint64(1)) | last for s in SEEDS]
    return values, [argmin(v, LEAST) for v in values], valid


def compact(v: np.ndarray, least: np.ndarray, valid: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Compact windows (left, centre, right) of one text part: all passages of at least LEAST shingles within
    left..right that hold the centre have it as their least value.

    Centres are the least places of windows of LEAST; the node of the Cartesian tree over
    the values reaches to the next smaller value on either side, which is again a centre.
    """
    lo, hi = runs(valid, least)
    centre = least[lo]
    # Centres of one text follow each other; runs with a gap between them belong to different texts.
    part = np.append(0, np.cumsum(lo[1:] != hi[:-1] + 1)) if len(lo) else lo
    first = lo.copy()
    last = hi + LEAST - 1
    begin = first[np.searchsorted(part, part, side="left")] if len(part) else first
    finish = last[np.searchsorted(part, part, side="right") - 1] if len(part) else last
    left, right = begin.copy(), finish.copy()
    stack: list[int] = []
    value = (v[centre] & ~np.uint64(127)).tolist()
    of = part.tolist()
    spot = centre.tolist()
    for i in range(len(spot)):
        while stack and of[stack[-1]] == of[i] and value[stack[-1]] > value[i]:
            right[stack.pop()] = spot[i] - 1
        if stack and of[stack[-1]] != of[i]:
            stack.clear()
        if stack:
            left[i] = spot[stack[-1]] + 1
        stack.append(i)
    return left, centre, right


def _named(v: np.ndarray, f: int) -> np.ndarray:
    """Least values of the function ``f`` as keys that tell it."""
    return (v & ~np.uint64(3) | np.uint64(f)).view(np.int64)


def _keys(batches, packed):
    late = _table(packed)
    for batch in batches:
        for part, raws in slices(batch, "text"):
            rid = part.column("rid").to_numpy()
            h, many, start = tokens(raws)
            values, leasts, valid = _ordered(h, many, start, late)
            for f, (v, least) in enumerate(zip(values, leasts)):
                if not len(valid):
                    continue
                centre = least[runs(valid, least)[0]]
                doc = np.searchsorted(start + many, centre, side="right")
                key = _named(v[centre], f)
                order = np.argsort(key, kind="stable")
                key, doc = key[order], doc[order]
                # Texts follow each other, so equal keys of one text do, too.
                new = np.append(True, (key[1:] != key[:-1]) | (doc[1:] != doc[:-1]))
                yield pa.RecordBatch.from_arrays([pa.array(key[new]), pa.array(rid[doc[new]])], names=["key", "rid"])


CELLS = "cell long, rid long, place long, n long, stretch long, inner boolean"


def _stretches(h: np.ndarray, group: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each place of a group (of the same text and cell, ascending): the first place of its stretch, and whether it is inside.

    A stretch repeats itself from place to place. ENDS places at either end are not inside.
    """
    if len(place) < 3:
        return place, np.zeros(len(place), dtype=bool)
    gap = np.where(group[1:] == group[:-1], np.diff(place), 0)
    # again[i]: what reaches from place i to the next is repeated from there to the one after.
    again = np.append((gap[1:] == gap[:-1]) & (gap[1:] > 0), [False, False])
    for i in np.nonzero(again[:-2] & (gap[:-1] > 1))[0].tolist():
        a, b, c = place[i], place[i + 1], place[i + 2]
        again[i] = (h[a:b] == h[b:c]).all()
    linked = again.copy()  # with the next place
    linked[1:] |= again[:-1]
    first = np.append(True, ~linked[:-1])
    inner = np.zeros(len(place), dtype=bool)
    inner[ENDS:] = True
    for k in range(ENDS + 1):
        inner[ENDS:] &= again[k : len(again) - ENDS + k]
    return place[np.nonzero(first)[0][np.cumsum(first) - 1]], inner


def _cells(batches, packed):
    """Places where compact windows of two hash functions, each shared with another text, have passages in common:
    the interval join of their windows, keyed by both least values. n: shingles of the text."""
    late = _table(packed)
    for batch in batches:
        lists = batch.column("keys")
        keys, ends = lists.flatten().field("key").to_numpy(), np.cumsum([0, *pc.list_value_length(lists).to_pylist()])
        row = 0
        for part, raws in slices(batch, "text"):
            rid = part.column("rid").to_numpy()
            own = np.unique(keys[ends[row] : ends[row + len(raws)]])
            row += len(raws)
            h, many, start = tokens(raws)
            values, leasts, valid = _ordered(h, many, start, late)
            if not len(valid):
                continue
            again = [np.isin(_named(v, f), own) for f, v in enumerate(values)]
            windows = []
            for v, least in zip(values, leasts):
                left, centre, right = compact(v, least, valid)
                a, b = np.zeros(len(h), dtype=np.int64), np.zeros(len(h), dtype=np.int64)
                a[centre], b[centre] = left, right
                windows.append((a, b))
            found = []
            for f, g in combinations(range(HASHES), 2):
                both = valid[again[f][leasts[f][valid]] & again[g][leasts[g][valid]]]
                lo, hi = runs(both, leasts[f], leasts[g])
                if not len(lo):
                    continue
                cf, cg = leasts[f][lo], leasts[g][lo]
                left = np.maximum(windows[f][0][cf], windows[g][0][cg])
                right = np.minimum(windows[f][1][cf], windows[g][1][cg])
                with np.errstate(over="ignore"):
                    cell = mix(values[f][cf] * np.uint64(2 * f + 3) + mix(values[g][cg]) + np.uint64(g))
                long = right - left + 1 >= LEAST
                found.append((cell[long].view(np.int64), cf[long]))
            if not found:
                continue
            cell, place = (np.concatenate(x) for x in zip(*found))
            doc = np.searchsorted(start + many, place, side="right")
            order = np.lexsort((place, doc, cell))
            cell, doc, place = cell[order], doc[order], place[order]
            other = np.append(True, (cell[1:] != cell[:-1]) | (doc[1:] != doc[:-1]))
            new = other | np.append(True, place[1:] != place[:-1])
            group, cell, doc, place = np.cumsum(other)[new], cell[new], doc[new], place[new]
            stretch, inner = _stretches(h, group, place)
            base = start[doc]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (cell, rid[doc], place - base, many[doc], stretch - base, inner)], names=["cell", "rid", "place", "n", "stretch", "inner"])


def _short(h: np.ndarray) -> np.ndarray:
    """What a check compares of shingle hashes."""
    return (h >> np.uint64(32)).astype(np.uint32)


def _contexts(batches):
    """For each listed (width, part) of a text the shingles that a place of the part can reach."""
    for batch in batches:
        lists = batch.column("parts")
        flat, ends = lists.flatten(), np.cumsum([0, *pc.list_value_length(lists).to_pylist()])
        width, at, row = flat.field("width").to_numpy(), flat.field("part").to_numpy(), 0
        for part, raws in slices(batch, "text"):
            rid = part.column("rid").to_pylist()
            h, many, start = tokens(raws)
            h, out = _short(h), []
            for i in range(len(raws)):
                own = h[start[i] : start[i] + many[i]]
                for k in range(ends[row], ends[row + 1]):
                    w, p = int(width[k]), int(at[k])
                    base = max(0, (p - 1) * w)
                    out.append((rid[i], w, p, base, own[base : (p + 2) * w].tobytes()))
                row += 1
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*out)) or [()] * 5, kinds)], names=["other", "width", "part", "base", "context"])


def _rising(j: np.ndarray) -> np.ndarray:
    """Places of a longest rising subsequence."""
    if (np.diff(j) > 0).all():
        return np.arange(len(j))
    tails, at, before = [], [], []
    for i, v in enumerate(j.tolist()):
        k = bisect_left(tails, v)
        before.append(at[k - 1] if k else -1)
        if k == len(tails):
            tails.append(v)
            at.append(i)
        else:
            tails[k], at[k] = v, i
    out, i = [], at[-1]
    while i >= 0:
        out.append(i)
        i = before[i]
    return np.array(out[::-1])


def _once(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The hashes that occur once, ascending, and where."""
    order = np.argsort(h, kind="stable")
    v = h[order]
    new = np.concatenate([[True], v[1:] != v[:-1], [True]])
    alone = new[1:] & new[:-1]
    return v[alone], order[alone]


def _matches(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places (in x ascending, in y) of the shingles that both texts have once."""
    ux, fx = _once(x)
    uy, fy = _once(y)
    if not len(ux) or not len(uy):
        return fx[:0], fy[:0]
    at = np.minimum(np.searchsorted(uy, ux), len(uy) - 1)
    same = uy[at] == ux
    i, j = fx[same], fy[at[same]]
    order = np.argsort(i)
    return i[order], j[order]


def _side(x: np.ndarray, y: np.ndarray, i: np.ndarray, j: np.ndarray, similarity: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Both texts read on from equal shingles x[0] and y[0]: ends (in x, in y) after each equal pair, and what each is worth.

    Matches (i, j) in a rising chain tell how far the texts are apart, up to the next of them.
    A pair is worth 1 + similarity, a shingle of either side costs similarity, so passages have
    the similarity (equal pairs over all) where the worth is not negative.
    """
    i, j = np.append(0, i), np.append(0, j)
    chain = _rising(j)
    i, j = i[chain], j[chain]
    all_ = np.arange(min(len(x), int(i[-1]) + len(y) - int(j[-1])))
    k = np.searchsorted(i, all_, side="right") - 1
    other = j[k] + all_ - i[k]
    good = other < np.append(j[1:], len(y))[k]
    good[good] = x[all_[good]] == y[other[good]]
    ex, ey = all_[good] + 1, other[good] + 1
    return ex, ey, (1 + similarity) * np.arange(1, len(ex) + 1) - similarity * (ex + ey)


def best_passage(x: np.ndarray, y: np.ndarray, p: int, q: int, least: int = LEAST, similarity: float = SIMILARITY, matches: tuple[np.ndarray, np.ndarray] | None = None) -> tuple[int, int, int, int, float] | None:
    """The longest passages around the equal shingles x[p] and y[q] that have the similarity: their ranges and it.

    Of all ends to the right and all beginnings to the left, by the chains of ``_side``, the pair that
    gives the longest passages whose worths add up to no less than zero. The result's similarity is that of the shingle sets.
    """
    if x[p] != y[q]:
        return None
    i, j = matches or _matches(x, y)
    after, before = (i > p) & (j > q), (i < p) & (j < q)
    ex, ey, right = _side(x[p:], y[q:], i[after] - p, j[after] - q, similarity)
    bx, by, left = _side(x[p::-1], y[q::-1], p - i[before][::-1], q - j[before][::-1], similarity)
    if min(ex[-1] + bx[-1], ey[-1] + by[-1]) <= least:
        return None
    left = left - (1 + similarity) + 2 * similarity  # the place itself counts on the right alone
    farthest = np.maximum.accumulate(left[::-1])[::-1]
    k = len(left) - np.searchsorted(farthest[::-1], -right - 1e-9, side="left") - 1
    held = np.nonzero(k >= 0)[0]
    if not len(held):
        return None
    size = np.minimum(ex[held] + bx[k[held]] - 1, ey[held] + by[k[held]] - 1)
    for at in np.argsort(-size, kind="stable")[:3].tolist():
        if size[at] < least:
            return None
        e, s = held[at], k[held[at]]
        a, b, c, d = p - int(bx[s]) + 1, p + int(ex[e]), q - int(by[s]) + 1, q + int(ey[e])
        if b - a == d - c and (x[a:b] == y[c:d]).all():
            return a, b, c, d, 1.0
        s, t = set(x[a:b].tolist()), set(y[c:d].tolist())
        both = len(s & t)
        now = both / (len(s) + len(t) - both)
        if now >= similarity:
            return a, b, c, d, now
    return None


def _dense(x: np.ndarray, y: np.ndarray, least: int = LEAST, similarity: float = SIMILARITY) -> np.ndarray:
    """The places of x that lie in some ``least`` or more following shingles of which the share ``similarity`` is in y.

    Passages near each other have it: with e equal pairs (1 + similarity) e >= similarity (m + n), and the other passage has n >= e shingles.
    """
    at = np.searchsorted(y, x)
    there = y[np.minimum(at, len(y) - 1)] == x
    worth = np.append(0.0, np.cumsum(there - similarity))
    mark = np.zeros(len(x) + 1, dtype=np.int64)
    if len(x) >= least:
        # The farthest end that is worth no less than the beginning.
        farthest = np.maximum.accumulate(worth[::-1])[::-1]
        begin = np.nonzero(farthest[least:] >= worth[: len(worth) - least] - 1e-6)[0]
        end = len(worth) - np.searchsorted(farthest[::-1], worth[begin] - 1e-6, side="left") - 1
        mark[begin] += 1
        np.subtract.at(mark, end, 1)
    return np.cumsum(mark[:-1]) > 0


CHECKED = "rid long, other long, lo long, hi long, other_lo long, other_hi long, similarity double, edge boolean"


def _verify(batches):
    """The passages of each pair of texts around its places; a place within one that is found needs no check,
    nor does one that equal shingles join to a place that failed: any passages around it could be grown to hold that place.

    edge: a passage that ends where the context does, though the text goes on.
    """
    names = [c.split()[0] for c in CHECKED.split(", ")]
    kinds = [pa.int64()] * 6 + [pa.float64(), pa.bool_()]
    last, own = None, None
    for batch in batches:
        out = []
        lists = batch.column("anchors")
        flat, ends = lists.flatten(), np.cumsum([0, *pc.list_value_length(lists).to_pylist()])
        places, other_places = flat.field("place").to_numpy(), flat.field("other_place").to_numpy()
        columns = [batch.column(n).to_pylist() for n in ("rid", "other", "other_n", "width", "base", "context")]
        for i, (rid, other, other_n, width, base, context) in enumerate(zip(*columns)):
            if rid != last:
                last, own = rid, _short(tokens([batch.column("text")[i].as_py().encode()])[0])
            y = np.frombuffer(context, dtype=np.uint32)
            p, q = places[ends[i] : ends[i + 1]], other_places[ends[i] : ends[i + 1]]
            order = np.lexsort((q, p))
            p, q = p[order], q[order]
            wanted, k, until = np.ones(len(p), dtype=bool), 0, -1
            while wanted[k:].any():
                k += int(wanted[k:].argmax())
                place, other_place = int(p[k]), int(q[k])
                if place + width > until:
                    first, until = max(0, place - 2 * width), place + 6 * width
                    x = own[first:until]
                    near = _matches(x, y)
                    reached = np.arange(k, np.searchsorted(p, until - width, side="right"))
                    wanted[reached] &= _dense(x, np.sort(y))[p[reached] - first] & _dense(y, np.sort(x))[q[reached] - base]
                    continue
                wanted[k] = False
                best = best_passage(x, y, place - first, other_place - base, matches=near)
                if best:
                    a, b, c, d, similarity = best
                    wanted &= (p < a + first) | (p >= b + first) | (q < base + c) | (q >= base + d)
                    edge = (c == 0 and base > 0) or (d == len(y) and base + d < other_n) or (a == 0 and first > 0) or (b == len(x) and first + b < len(own))
                    out.append((rid, other, a + first, b + first + SIZE - 1, base + c, base + d + SIZE - 1, similarity, edge))
                else:
                    ahead, other_ahead = x[place - first :], y[other_place - base :]
                    size = min(len(ahead), len(other_ahead))
                    unlike = np.nonzero(ahead[:size] != other_ahead[:size])[0]
                    wanted &= (q - p != other_place - place) | (p < place) | (p >= place + (int(unlike[0]) if len(unlike) else size))
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*out)) or [()] * 8, kinds)], names=names)


def _checked(text: DataFrame, pairs: DataFrame) -> DataFrame:
    """Passages of pairs of places (rid, place, n, other, other_place, other_n) that have the similarity, over their whole length.

    A passage of the shorter text can't be near one of over n / SIMILARITY shingles, so places reach that far, rounded
    up to REACH times a power of two; a place's part of its text is read, with the parts beside it. Repeats within a
    text could make a passage longer than that: those that end at an edge are checked with four times the reach, until none is left.
    """
    found, width = None, F.lit(float(REACH)) * F.pow(2.0, F.ceil(F.log2(F.greatest(F.lit(1.0), (F.least("n", "other_n") / SIMILARITY + 2 * SIZE) / REACH))))
    rows = pairs.withColumn("width", width.cast("long"))
    while True:
        part = F.floor(F.col("other_place") / F.col("width"))
        grouped = stash(rows.groupBy("rid", "other", "width", part.alias("part")).agg(F.max("n").alias("n"), F.max("other_n").alias("other_n"), F.collect_set(F.struct("place", "other_place")).alias("anchors")))
        wanted = grouped.groupBy(F.col("other").alias("rid")).agg(F.collect_set(F.struct("width", "part")).alias("parts"))
        contexts = stash(text.join(_few(wanted, "parts"), "rid").select("rid", "text", "parts").mapInArrow(_contexts, "other long, width long, part long, base long, context binary"))
        full = grouped.join(contexts, ["other", "width", "part"]).join(text, "rid")
        good = stash(full.select("rid", "text", "other", "other_n", "width", "base", "context", "anchors").mapInArrow(_verify, CHECKED))
        ended = good.where(~F.col("edge")).drop("edge")
        found = ended if found is None else found.unionByName(ended)
        cut = good.where("edge").select("rid", "other", F.col("lo").alias("from"), F.col("hi").alias("to"))
        if cut.isEmpty():
            return found
        again = grouped.select("rid", "other", "n", "other_n", "width", F.explode("anchors").alias("x")).select("rid", "other", "n", "other_n", (4 * F.col("width")).alias("width"), "x.place", "x.other_place")
        rows = stash(again.join(cut, ["rid", "other"]).where("place >= from and place < to").drop("from", "to").distinct())


def _locals(batches):
    """(cell, rid, place, n, open, near, first, last, many): each shingle near each listed place of a text, where it is, and how many there are."""
    names = ["cell", "rid", "place", "n", "open", "near", "first", "last", "many"]
    for batch in batches:
        lists = batch.column("places")
        flat, ends, row = lists.flatten(), np.cumsum([0, *pc.list_value_length(lists).to_pylist()]), 0
        cell, place, open_ = (flat.field(k).to_numpy(zero_copy_only=False) for k in ("cell", "place", "open"))
        for part, raws in slices(batch, "text"):
            rid = part.column("rid").to_pylist()
            h, many, start = tokens(raws)
            for i in range(len(raws)):
                own = h[start[i] : start[i] + many[i]]
                for k in range(ends[row], ends[row + 1]):
                    around = own[max(0, place[k] - NEAR) : place[k] + NEAR + 1]
                    near, first = np.unique(around, return_index=True)
                    last = len(around) - 1 - np.unique(around[::-1], return_index=True)[1]
                    columns = (cell[k], rid[i], place[k], many[i], open_[k], near.view(np.int64), first, last, len(near))
                    yield pa.RecordBatch.from_arrays([pa.array(c if isinstance(c, np.ndarray) else np.full(len(near), c)) for c in columns], names=names)
                row += 1


def _split(text: DataFrame, large: DataFrame) -> DataFrame:
    """Large cells (cell, rid, place, n, open) split by the rarer shingles around their places.

    Two passages of LEAST shingles and the similarity that hold the places have COMMON of the shingles near them in common, so they
    share one of the first ``many`` - COMMON + 1 in any one order; the order is how many members of the cell have it.
    Members whose shingles that others have span fewer than LEAST are left out: a common line alone is no passage.
    """
    listed = large.groupBy("rid").agg(F.collect_list(F.struct("cell", "place", "open")).alias("places"))
    near = stash(text.join(listed, "rid").select("rid", "text", "places").mapInArrow(_locals, "cell long, rid long, place long, n long, open boolean, near long, first long, last long, many long"))
    often = near.groupBy("cell", "near").agg(F.count(F.lit(1)).alias("often")).where("often > 1")
    member = Window.partitionBy("cell", "rid", "place")
    shared = near.join(often, ["cell", "near"]).withColumn("rank", F.row_number().over(member.orderBy("often", "near"))).withColumn("own", F.count(F.lit(1)).over(member))
    # A passage begins and ends with shingles that another member has, too.
    shared = shared.withColumn("span", F.max("last").over(member) - F.min("first").over(member) + 1).where((F.col("span") >= LEAST) & (F.col("own") >= COMMON - 4))
    kept = shared.where(F.col("rank") + F.col("many") - F.col("own") <= F.greatest(F.lit(1), F.col("many") - COMMON + 1))
    return kept.select(F.xxhash64("cell", "near").alias("cell"), "rid", "place", "n", "open")


def _few(df: DataFrame, lists: str) -> DataFrame:
    """``df``, broadcast if the rows and what their lists hold are few."""
    rows, held = df.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.size(lists)), F.lit(0))).first()
    return F.broadcast(df) if max(rows, held) <= BROADCAST_ROWS else df


def _whole(docs: DataFrame, copies: DataFrame) -> DataFrame:
    """Links of exact copies of at least 50 words to the text that stays, over the whole of it."""
    words = F.size(F.array_remove(F.split("text", "[\\x20\\x09-\\x0D]+"), "")).cast("long")
    few = copies.count() <= BROADCAST_ROWS
    rows = docs.join(F.broadcast(copies) if few else copies, "rid").select("rid", F.col("first").alias("other"), words.alias("n")).where(F.col("n") >= LEAST + SIZE - 1)
    zero = F.lit(0).cast("long")
    return rows.select("rid", "other", zero.alias("lo"), F.col("n").alias("hi"), zero.alias("other_lo"), F.col("n").alias("other_hi"), F.lit(1.0).alias("similarity"))


def _groups(text: DataFrame, cells: DataFrame) -> DataFrame:
    """The checked passages of all cells (cell, rid, place, n).

    The members of a cell are checked against the first. Those whose place no found passage of this pair holds are open, unless a passage
    with another text holds it and links of passages join the pair already. Open members are checked
    against all other members: at once where a cell has up to FEW members; larger cells
    are split first, and what is still larger is checked against one open member at a
    time for TURNS turns, then at once. Of a stretch that repeats itself only the ends are members here: passages around a place inside
    could be grown to hold an end. The places inside follow (``_inside``). No open member is dropped unchecked.
    """
    members = cells.groupBy("cell").agg(F.min(F.struct("rid", "place", "n")).alias("head"), F.max("rid").alias("last")).where("last > head.rid")
    rows = stash(cells.join(members, "cell").select("cell", "rid", "place", "n", "stretch", "inner", "head"))
    against = lambda df, head: df.where(F.col("rid") != F.col(f"{head}.rid")).select("cell", "rid", "place", "n", F.col(f"{head}.rid").alias("other"), F.col(f"{head}.place").alias("other_place"), F.col(f"{head}.n").alias("other_n"))
    found = _checked(text, against(rows, "head"))
    open_ = _settled(_open(against(rows, "head"), found), found)
    # Places inside a stretch that repeats itself come last, where a passage has been found for its ends.
    hold = rows.where(~F.col("inner")).select("cell", "rid", "place", "n", "stretch").join(open_.select("cell", "rid", "place", F.lit(True).alias("open")), ["cell", "rid", "place"], "left").withColumn("open", F.coalesce("open", F.lit(False)))
    ends = stash(hold.join(open_.select("cell").distinct(), "cell", "left_semi"))
    if ends.isEmpty():
        return found
    sized = ends.drop("stretch").join(ends.groupBy("cell").agg(F.count(F.lit(1)).alias("members")), "cell")
    large = sized.where(F.col("members") > FEW).drop("members")
    # The first member has been checked against all.
    firsts = members.select("cell", F.col("head.rid").alias("rid"), F.col("head.place").alias("place"))
    rest = sized.where(F.col("members") <= FEW).drop("members").join(firsts, ["cell", "rid", "place"], "left_anti")
    if not large.isEmpty():
        rest = rest.unionByName(_split(text, large))
    late = found.limit(0)
    for turn in range(TURNS + 1):
        sized = rest.groupBy("cell").agg(F.count(F.lit(1)).alias("members"), F.min(F.when(F.col("open"), F.struct("rid", "place", "n"))).alias("head")).where("members > 1 and head is not null")
        rest = stash(rest.join(sized, "cell"))
        if rest.isEmpty():
            break
        once = rest if turn == TURNS else rest.where(F.col("members") <= FEW)
        left = once.where("open").select("cell", "rid", "place", "n")
        right = once.select("cell", F.col("rid").alias("other"), F.col("place").alias("other_place"), F.col("n").alias("other_n"), F.col("open").alias("other_open"))
        # A pair of open members is met twice: once is enough.
        pairs = left.join(right, "cell").where((F.col("rid") != F.col("other")) & (~F.col("other_open") | (F.col("rid") < F.col("other")))).drop("other_open", "cell")
        more = rest.where((F.col("members") > FEW) & F.lit(turn < TURNS)).drop("members")
        stars = against(more, "head")
        good = _checked(text, pairs.unionByName(stars.drop("cell")).distinct())
        late = late.unionByName(good)
        if turn == TURNS or more.isEmpty():
            break
        still = _open(stars, good).select("cell", "rid", "place", F.lit(True).alias("still"))
        rest = more.where((F.col("rid") != F.col("head.rid")) | (F.col("place") != F.col("head.place"))).drop("head").join(still, ["cell", "rid", "place"], "left")
        rest = rest.withColumn("open", F.col("open") & F.coalesce("still", F.lit(False))).drop("still")
    return found.unionByName(late).unionByName(_inside(text, rows, open_, ends, late))


def _inside(text: DataFrame, rows: DataFrame, open_: DataFrame, ends: DataFrame, late: DataFrame) -> DataFrame:
    """The passages around open places inside stretches, checked against the text that has the longest passage with an end of the stretch."""
    inner = rows.where("inner").select("cell", "rid", "place", "n", "stretch").join(open_.select("cell", "rid", "place"), ["cell", "rid", "place"], "left_semi")
    mirrored = late.select(F.col("other").alias("rid"), F.col("rid").alias("other"), F.col("other_lo").alias("lo"), F.col("other_hi").alias("hi"), F.col("lo").alias("other_lo"), F.col("hi").alias("other_hi"))
    passages = late.select(*mirrored.columns).unionByName(mirrored)
    mine = ends.select("cell", "rid", "place", "stretch").join(inner.select("cell", "rid", "stretch").distinct(), ["cell", "rid", "stretch"], "left_semi")
    held = mine.join(passages, "rid").where("place >= lo and place < hi").select("cell", "rid", "stretch", "other", (F.col("hi") - F.col("lo")).alias("size"), "other_lo", "other_hi")
    theirs = ends.select("cell", F.col("rid").alias("other"), F.col("place").alias("other_place"), F.col("n").alias("other_n"))
    best = held.join(theirs, ["cell", "other"]).where("other_place >= other_lo and other_place < other_hi").groupBy("cell", "rid", "stretch").agg(F.min(F.struct(-F.col("size"), "other", "other_place", "other_n")).alias("to"))
    pairs = inner.join(best, ["cell", "rid", "stretch"]).select("rid", "place", "n", "to.other", "to.other_place", "to.other_n")
    return _checked(text, pairs.distinct())


def _open(tied: DataFrame, found: DataFrame) -> DataFrame:
    """The pairs of places that no found passages of the pair of texts hold."""
    held = found.select("rid", "other", "lo", "hi", "other_lo", "other_hi")
    return stash(tied.join(held, (tied.rid == held.rid) & (tied.other == held.other) & (tied.place >= held.lo) & (tied.place < held.hi) & (tied.other_place >= held.other_lo) & (tied.other_place < held.other_hi), "left_anti"))


def _settled(open_: DataFrame, found: DataFrame) -> DataFrame:
    """``open_`` without the places that some found passage holds and whose pair found passages have joined."""
    if open_.isEmpty():
        return open_
    root = components(found.select(F.col("rid").alias("a"), F.col("other").alias("b")))
    spans = found.select("rid", "lo", "hi").unionByName(found.select(F.col("other").alias("rid"), F.col("other_lo").alias("lo"), F.col("other_hi").alias("hi"))).distinct()
    same = open_.join(root.select(F.col("id").alias("rid"), "component"), "rid").join(root.select(F.col("id").alias("other"), F.col("component").alias("other_component")), "other").where("component = other_component")
    held = same.join(spans.withColumnRenamed("rid", "r"), (F.col("rid") == F.col("r")) & (F.col("place") >= F.col("lo")) & (F.col("place") < F.col("hi")), "left_semi")
    return stash(open_.join(held.select("cell", "rid", "place").distinct(), ["cell", "rid", "place"], "left_anti"))


def near_passages(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, start, end, other_id, similarity, class_id): passages that other documents have, too.

    A passage has at least 50 words (LEAST five-word shingles), from word ``start`` up to
    word ``end``; its Jaccard similarity over the shingles to a passage of
    document ``other_id`` is at least 0.8. ``class_id`` is the smallest id that links of such
    passages reach. Documents without one have no row.

    Exact copies are linked to the first of their texts, which alone is searched further.
    Candidates agree in the least values of two of HASHES hash functions within their compact windows.
    Each place of a group is checked against the first (``_groups``); those it doesn't hold for are checked
    further until none is left. Passages are given in their whole length, wherever they are in a text.
    A pair that agrees in fewer than two of the functions is no candidate; see the README for how often that is.

    Null, empty and short texts have no passages, the longest texts are read whole; repeated rows are documents of their own; a row
    without an id has a null ``id``; empty tables give no rows; other columns are not read.
    """
    docs = keyed(df, id_col, text_col)
    fresh, copies = split_copies(docs, 2 * 50 - 1)
    whole = checkpoint(_whole(docs, copies))
    text = fresh.select("rid", "text")
    packed = frequent(text)
    keys = stash(text.mapInArrow(partial(_keys, packed=packed), "key long, rid long"))
    # A cell takes keys of two functions.
    lists = stash(repeated(keys).where(F.size(F.array_distinct(F.transform("keys", lambda k: k["key"].bitwiseAND(F.lit(3))))) > 1))
    discard(keys)
    again = stash(text.join(small(lists.select("rid")), "rid", "left_semi"))
    cells = stash(again.join(lists, "rid").select("rid", "text", "keys").mapInArrow(partial(_cells, packed=packed), CELLS))
    discard(lists)
    found = whole.unionByName(_groups(again, cells))
    classes = components(found.select(F.col("rid").alias("a"), F.col("other").alias("b")))
    mine = found.select("rid", F.col("lo").alias("start"), F.col("hi").alias("end"), "other", "similarity")
    theirs = found.select(F.col("other").alias("rid"), F.col("other_lo").alias("start"), F.col("other_hi").alias("end"), F.col("rid").alias("other"), "similarity")
    spans = mine.unionByName(theirs).groupBy("rid", "start", "end").agg(F.max(F.struct("similarity", (-F.col("other")).alias("other"))).alias("x"))
    spans = spans.select("rid", "start", "end", (-F.col("x.other")).alias("other"), "x.similarity")
    name = docs.select(F.col("rid"), "id")
    named = spans.join(classes.withColumnRenamed("id", "rid"), "rid").join(name, "rid")
    named = named.join(name.select(F.col("rid").alias("other"), F.col("id").alias("other_id")), "other").join(name.select(F.col("rid").alias("component"), F.col("id").alias("class_id")), "component")
    return named.select("id", "start", "end", "other_id", "similarity", "class_id")
