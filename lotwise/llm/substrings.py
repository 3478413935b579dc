"""Exact substring dedup: hash-compared suffix sort of windows that may repeat."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lotwise.llm.common import CHUNK_BYTES, keyed, mix, slices, split_copies, stash
from lotwise.llm.windows import Prefixes, argmin, repeated, runs

LENGTH = 100
#: Bytes of an anchor. A window's anchor is the least-hashed of the grams in it, so equal windows have equal anchors.
GRAM = 24
#: Members of an anchor's group that one task sorts; larger groups are split and their windows met again by content.
BUCKET = 4096
#: Suffixes that are sorted at a time.
ITEMS = 300_000
#: Bytes of contexts that a task remembers to drop equal ones before the shuffle.
MEMO_BYTES = 48 << 20


def _segments(raws: list[bytes], length: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(bytes, document, place of the piece in it, piece's first place in the bytes): long texts in pieces that share length - 1 bytes."""
    parts, doc, at, size = [], [], [], 0
    for i, raw in enumerate(raws):
        if len(raw) < length:
            continue
        for s in range(0, len(raw) - length + 1, CHUNK_BYTES):
            part = raw[s : s + CHUNK_BYTES + length - 1]
            parts.append(part)
            doc.append(i)
            at.append(s)
            size += len(part)
            if size >= CHUNK_BYTES:
                yield _joined(parts, doc, at)
                parts, doc, at, size = [], [], [], 0
    if parts:
        yield _joined(parts, doc, at)


def _joined(parts: list[bytes], doc: list[int], at: list[int]):
    first = np.cumsum([0, *map(len, parts)])
    return np.frombuffer(b"".join(parts), dtype=np.uint8), np.array(doc), np.array(at), first


def anchors(raws: list[bytes], length: int = LENGTH, gram: int = GRAM):
    """(hash, document, anchor, first window, last window): each window of ``length`` bytes belongs to one anchor of its document."""
    for data, doc, at, first in _segments(raws, length):
        prefix = Prefixes(data)
        start = np.arange(len(data) - gram + 1)
        h = mix(prefix.range(start, start + gram))
        least = argmin(h, length - gram + 1)
        inside = np.zeros(len(data) + 1, dtype=np.int64)
        np.add.at(inside, first[:-1], 1)
        np.add.at(inside, first[1:] - length + 1, -1)
        valid = np.nonzero(np.cumsum(inside[: len(least)]) > 0)[0]
        lo, hi = runs(valid, least)
        piece = np.searchsorted(first, lo, side="right") - 1
        shift = at[piece] - first[piece]
        yield h[least[lo]].view(np.int64), doc[piece], least[lo] + shift, lo + shift, hi + shift


def _anchor_keys(batches):
    for batch in batches:
        for part, raws in slices(batch, "text"):
            rid = part.column("rid").to_numpy()
            for h, doc, *_ in anchors(raws):
                yield pa.RecordBatch.from_arrays([pa.array(h), pa.array(rid[doc])], names=["key", "rid"])


CONTEXT = "key long, sub long, wide boolean, rid long, at long, lo long, hi long, context binary"


def _contexts(bucket: int):
    """Contexts (all bytes of an anchor's windows) of anchors that occur again; without a context: windows that are
    removed, because the task has met the same context earlier in the order."""

    def run(batches):
        kinds = [pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
        names = [x.split()[0] for x in CONTEXT.split(", ")]
        memo: dict[tuple[int, bytes], tuple] = {}
        held, gone = 0, []

        def out():
            nonlocal held
            rows = list(memo.values()) + gone
            memo.clear()
            gone.clear()
            held = 0
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*rows)) or [()] * 8, kinds)], names=names)

        for batch in batches:
            lists = batch.column("keys")
            flat = lists.flatten()
            ends = np.cumsum([0, *pc.list_value_length(lists).to_pylist()])
            keys, often = flat.field("key").to_numpy(), flat.field("n").to_numpy()
            row = 0
            for part, raws in slices(batch, "text"):
                rid = part.column("rid").to_numpy()
                # The part's keys by (document, key), to look its anchors up at once.
                doc_of = np.repeat(np.arange(len(raws)), np.diff(ends[row : row + len(raws) + 1]))
                k, n = keys[ends[row] : ends[row + len(raws)]], often[ends[row] : ends[row + len(raws)]]
                row += len(raws)
                order = np.lexsort((k, doc_of))
                wanted = dict(zip(zip(doc_of[order].tolist(), k[order].tolist()), n[order].tolist()))
                for h, doc, at, lo, hi in anchors(raws):
                    for key, d, p, a, b in zip(h.tolist(), doc.tolist(), at.tolist(), lo.tolist(), hi.tolist()):
                        count = wanted.get((d, key))
                        if count is None:
                            continue
                        r, context = int(rid[d]), raws[d][a : b + LENGTH]
                        parts = -(-count // bucket)
                        sub = ((r * 0x9E3779B1 + a) & 0x7FFFFFFF) % parts if parts > 1 else 0
                        new = (key, sub, parts > 1, r, p - a, a, b, context)
                        old = memo.get((key, context))
                        if old is None:
                            memo[key, context] = new
                            held += len(context) + 200
                            continue
                        if (old[3], old[5]) > (r, a):
                            memo[key, context], old, new = new, new, old
                        gone.append((key, 0, False, new[3], new[4], new[5], new[6], None))
                if held > MEMO_BYTES or len(gone) > 500_000:
                    yield out()
        yield out()

    return run


def common_prefix(prefix: Prefixes, a: np.ndarray, b: np.ndarray, length: int) -> np.ndarray:
    """Length, at most ``length``, of the longest common prefix of the suffixes at a and b, by binary search over hashes."""
    low, high = np.zeros(len(a), dtype=np.int64), np.full(len(a), length, dtype=np.int64)
    while (low < high).any():
        mid = (low + high + 1) // 2
        same = prefix.range(a, a + mid) == prefix.range(b, b + mid)
        low, high = np.where(same, mid, low), np.where(same, high, mid - 1)
    return low


def suffix_sort(prefix: Prefixes, start: np.ndarray, segment: np.ndarray, length: int) -> np.ndarray:
    """Order of the suffixes by (segment, first ``length`` bytes, place in the input): a merge sort by hashed comparisons.

    ``segment`` ascends. All merges of a level run at once: each suffix finds its place
    in its partner run by binary search, each probe compares by ``common_prefix``.
    """
    n = len(start)
    order = np.arange(n)
    first = np.searchsorted(segment, segment, side="left")
    size = np.searchsorted(segment, segment, side="right") - first
    data = prefix.data
    width, most = 1, int(size.max(initial=1))
    while width < most:
        place = np.arange(n)
        local = place - first
        block = local // width
        other = np.where(block % 2 == 0, block + 1, block - 1) * width + first
        end = np.minimum(other + width, first + size)
        low, high = np.minimum(other, end), end.copy()
        base = low.copy()
        right = block % 2 == 1
        while True:
            live = np.nonzero(low < high)[0]
            if not len(live):
                break
            mid = (low[live] + high[live]) // 2
            x, y = start[order[live]], start[order[mid]]
            same = common_prefix(prefix, x, y, length)
            tie = same >= length
            at = np.minimum(same, length - 1)
            before = np.where(tie, right[live], data[y + at] < data[x + at])  # the probe stands before the suffix
            low[live] = np.where(before, mid + 1, low[live])
            high[live] = np.where(before, high[live], mid)
        own = local - block * width
        target = first + np.where(right, block - 1, block) * width + own + (low - base)
        moved = np.empty_like(order)
        moved[target] = order
        order = moved
        width *= 2
    return order


def _equal(data: np.ndarray, a: np.ndarray, b: np.ndarray, length: int) -> np.ndarray:
    """Whether the bytes themselves are equal."""
    out, steps = np.ones(len(a), dtype=bool), np.arange(length)
    for s in range(0, len(a), 50_000):
        x, y = a[s : s + 50_000, None] + steps, b[s : s + 50_000, None] + steps
        out[s : s + 50_000] = (data[x] == data[y]).all(axis=1)
    return out


def classes(data: np.ndarray, start: np.ndarray, segment: np.ndarray, length: int) -> np.ndarray:
    """A number for each suffix: equal ones are those whose segment and first ``length`` bytes are equal."""
    order = suffix_sort(Prefixes(data), start, segment, length)
    a, b = order[:-1], order[1:]
    near = segment[a] == segment[b]
    hashed = near & (common_prefix(Prefixes(data), start[a], start[b], length) >= length)
    same = hashed.copy()
    same[hashed] = _equal(data, start[a[hashed]], start[b[hashed]], length)
    out = np.empty(len(start), dtype=np.int64)
    out[order] = np.append(0, np.cumsum(~same)) if len(order) else order
    bad = np.unique(segment[a[hashed & ~same]])
    if len(bad):  # hashes that collided: the segment's classes from its bytes
        for s in bad.tolist():
            here, seen = np.nonzero(segment == s)[0], {}
            top = int(out.max()) + 1
            for i in here.tolist():
                out[i] = top + seen.setdefault(data[start[i] : start[i] + length].tobytes(), len(seen))
    return out


FOUND = "rid long, lo long, hi long, content binary"


def _sharing(group: list[tuple]) -> list[tuple]:
    """The members that may share a window with another: a window holds half of its bytes beside the anchor either
    before it or after it, so these must be the same in both. A part of a split group stays whole."""
    if group[0][2]:
        return group
    if len(group) < 2:
        return []
    half = (LENGTH - GRAM) // 2
    sides = [(r[7][r[4] - half : r[4]] if r[4] >= half else None, b"+" + r[7][r[4] + GRAM : r[4] + GRAM + half] if len(r[7]) - r[4] - GRAM >= half else None) for r in group]
    seen: dict[bytes, int] = {}
    for pair in sides:
        for side in pair:
            if side is not None:
                seen[side] = seen.get(side, 0) + 1
    kept = [r for r, pair in zip(group, sides) if any(side is not None and seen[side] > 1 for side in pair)]
    return kept if len(kept) > 1 else []


def _decide(rows: list[tuple]) -> tuple[list[tuple], list[tuple]]:
    """(removed windows, first windows of split groups) of whole groups, which come by (key, sub, rid, lo)."""
    removed, met = [], []
    groups: list[list[tuple]] = []
    seen: dict[bytes, tuple] = {}
    last = None
    for row in rows:
        if (row[0], row[1]) != last:
            last, seen = (row[0], row[1]), {}
            groups.append([])
        if row[7] in seen:
            removed.append((row[3], row[5], row[6]))
        else:
            seen[row[7]] = row
            groups[-1].append(row)
    wide = [g for g in map(_sharing, groups) if g]
    at = 0
    while at < len(wide):
        part, count = [], 0
        while at < len(wide) and (not part or count < ITEMS):
            part.append(wide[at])
            count += sum(r[6] - r[5] + 1 for r in wide[at])
            at += 1
        members = [r for g in part for r in g]
        group = np.repeat(np.arange(len(part)), [len(g) for g in part])
        base = np.cumsum([0, *(len(r[7]) for r in members)])
        data = np.frombuffer(b"".join(r[7] for r in members), dtype=np.uint8)
        lo, hi, anchor = (np.array([r[i] for r in members]) for i in (5, 6, 4))
        many = hi - lo + 1
        who = np.repeat(np.arange(len(members)), many)
        shift = np.arange(len(who)) - np.repeat(np.cumsum(many) - many, many)
        key = group[who] * 256 + anchor[who] - shift  # the anchor's place in the window
        order = np.argsort(key, kind="stable")  # members, and so windows, stay in the order (rid, lo)
        who, shift, key = who[order], shift[order], key[order]
        number = classes(data, base[who] + shift, key, LENGTH)
        first = np.unique(number, return_index=True)[1]
        is_first = np.zeros(len(who), dtype=bool)
        is_first[first] = True
        gone = np.nonzero(~is_first)[0]
        back = np.lexsort((shift[gone], who[gone]))
        w, s = who[gone][back], shift[gone][back]
        if len(w):
            edge = np.nonzero((np.diff(w) != 0) | (np.diff(s) != 1))[0]
            for a, b in zip(np.append(0, edge + 1).tolist(), np.append(edge, len(w) - 1).tolist()):
                removed.append((members[w[a]][3], int(lo[w[a]] + s[a]), int(lo[w[a]] + s[b])))
        for i in first.tolist():
            r = members[who[i]]
            if r[2]:
                met.append((r[3], int(lo[who[i]] + shift[i]), r[7][shift[i] : shift[i] + LENGTH]))
    return removed, met


def _sorted_groups(batches):
    pending: list[tuple] = []

    def out(rows):
        removed, met = _decide(rows)
        rid, lo, hi, content = [], [], [], []
        for r, a, b in removed:
            rid.append(r)
            lo.append(a)
            hi.append(b)
            content.append(None)
        for r, a, c in met:
            rid.append(r)
            lo.append(a)
            hi.append(a)
            content.append(hashlib.blake2b(c, digest_size=20).digest())
        return pa.RecordBatch.from_arrays([pa.array(rid, pa.int64()), pa.array(lo, pa.int64()), pa.array(hi, pa.int64()), pa.array(content, pa.binary())], names=["rid", "lo", "hi", "content"])

    for batch in batches:
        pending += list(zip(*(c.to_pylist() for c in batch.columns)))
        if len(pending) >= 20_000:
            cut = len(pending) - 1
            while cut and pending[cut - 1][:2] == pending[-1][:2]:
                cut -= 1
            if cut:
                yield out(pending[:cut])
                pending = pending[cut:]
    if pending:
        yield out(pending)


def removals(docs: DataFrame) -> DataFrame:
    """(rid, lo, hi): runs of first bytes of windows that an earlier equal window stands before.

    All windows of an exact copy stand earlier in the first of its texts, and none of
    them is the first of its kind, so copies take no further part.
    """
    docs, copies = split_copies(docs, LENGTH)
    whole = copies.select("rid", F.lit(0).cast("long").alias("lo"), (F.col("n_bytes") - LENGTH).alias("hi"))
    at = stash(repeated(docs.select("rid", "text").mapInArrow(_anchor_keys, "key long, rid long")))
    rows = docs.join(at, "rid").select("rid", "text", "keys").mapInArrow(_contexts(BUCKET), CONTEXT)
    many = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartition(many, F.when(F.col("context").isNull(), F.col("rid")).otherwise(F.col("key")), "sub").sortWithinPartitions("key", "sub", "rid", "lo")

    def decide(batches):
        def kept():
            for batch in batches:
                yield batch.filter(pc.is_valid(batch.column("context")))
                known = batch.filter(pc.is_null(batch.column("context")))
                done.append(known)

        done: list[pa.RecordBatch] = []
        for found in _sorted_groups(kept()):
            yield found
            while done:
                known = done.pop()
                yield pa.RecordBatch.from_arrays([known.column("rid"), known.column("lo"), known.column("hi"), known.column("context")], names=["rid", "lo", "hi", "content"])
        while done:
            known = done.pop()
            yield pa.RecordBatch.from_arrays([known.column("rid"), known.column("lo"), known.column("hi"), known.column("context")], names=["rid", "lo", "hi", "content"])

    found = dealt.mapInArrow(decide, FOUND)
    if at.where(F.exists("keys", lambda k: k["n"] > BUCKET)).isEmpty():
        return found.select("rid", "lo", "hi").unionByName(whole)
    found = stash(found)
    order = Window.partitionBy("content").orderBy("rid", "lo")  # at most a row for each part of a split group
    again = found.where(F.col("content").isNotNull()).withColumn("i", F.row_number().over(order)).where("i > 1")
    return found.where(F.col("content").isNull()).select("rid", "lo", "hi").unionByName(again.select("rid", "lo", "hi")).unionByName(whole)


def _cover(lo: np.ndarray, hi: np.ndarray, size: int) -> list[tuple[int, int]]:
    """Maximal runs of bytes that windows starting at lo..hi cover."""
    out: list[list[int]] = []
    for a, b in sorted(zip(lo.tolist(), (hi + LENGTH).tolist())):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, min(b, size)) for a, b in out]


def dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept_sha256, spans) of every row.

    A byte of a text (UTF-8; null: empty) is removed if a string of LENGTH bytes that
    covers it also starts earlier: in a row with a smaller id, or earlier in the same
    row; matches never cross rows, and all are judged on the input. Of rows with
    the same id the one with the smaller text is earlier; rows without an id come first. ``spans``
    lists the maximal removed runs as start and end. Shorter texts keep all bytes; an empty table gives
    no rows; other columns are not read.
    """
    docs = keyed(df, id_col, text_col)
    spans = removals(docs).groupBy("rid").agg(F.collect_list(F.struct("lo", "hi")).alias("windows"))

    def run(batches):
        for batch in batches:
            lists = batch.column("windows")
            flat, ends = lists.flatten(), np.cumsum([0, *pc.fill_null(pc.list_value_length(lists), 0).to_pylist()])
            lo, hi = flat.field("lo").to_numpy(zero_copy_only=False), flat.field("hi").to_numpy(zero_copy_only=False)
            rows, row = [], 0
            for _, raws in slices(batch, "text"):
                for raw in raws:
                    a, b = ends[row], ends[row + 1]
                    row += 1
                    cut = _cover(lo[a:b], hi[a:b], len(raw)) if b > a else []
                    digest, at = hashlib.sha256(), 0
                    for s, e in cut:
                        digest.update(raw[at:s])
                        at = e
                    digest.update(raw[at:])
                    rows.append((len(raw), sum(e - s for s, e in cut), len(cut), digest.hexdigest(), [{"start": s, "end": e} for s, e in cut]))
            types = [pa.int64()] * 3 + [pa.string(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))]
            columns = [pa.array(c, t) for c, t in zip(list(zip(*rows)) or [()] * 5, types)]
            yield pa.RecordBatch.from_arrays([batch.column("id"), *columns], names=["id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"])

    schema = "id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<start: long, end: long>>"
    return docs.join(spans, "rid", "left").select("id", "text", "windows").mapInArrow(run, schema)
