"""Quality classifier: ordinal cumulative-link regression over hashed text features."""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotwise.llm.common import slices, stash, words_of

BITS = 20
#: Bound of the labelled rows that the model is fitted on, those with the smallest hashed ids.
SAMPLE = 12_000
GRADES = 3
#: A feature is kept if its documents' share above a cut is that many standard errors off, and it has that many documents.
LEAST_Z, LEAST_DOCS = 4.0, 5
STRIP = b""".,;:!?"'()[]{}<>|*#%&$@~^_=+-/\\"""
MEMO = 100_000


def _shape(raw: bytes, words: list[bytes]) -> list[bytes]:
    """Binned shares of the text's bytes and words, named so that no word can equal them."""
    x = np.bincount(np.frombuffer(raw, dtype=np.uint8), minlength=256)
    n, w = max(1, len(raw)), max(1, len(words))
    upper, digit = x[65:91].sum() / n, x[48:58].sum() / n
    marks = x[[33, 35, 36, 37, 38, 42, 64, 94, 126]].sum() / n
    bars, breaks = x[124] / w, x[10] / w
    again = sum(a == b for a, b in zip(words, words[1:])) / w
    fresh = len(set(words)) / w
    length = (n - x[32]) / w
    part = lambda name, v, edges: b" %s %d" % (name, int(np.searchsorted(edges, v, side="right")))
    return [
        part(b"upper", upper, [0.01, 0.05, 0.1, 0.2, 0.3, 0.5]),
        part(b"digit", digit, [0.01, 0.05, 0.1, 0.2]),
        part(b"marks", marks, [0.002, 0.01, 0.03, 0.06, 0.12, 0.2]),
        part(b"bars", bars, [0.02, 0.1, 0.3, 0.6]),
        part(b"breaks", breaks, [0.01, 0.05, 0.2]),
        part(b"again", again, [0.02, 0.1, 0.3, 0.6]),
        part(b"fresh", fresh, [0.05, 0.15, 0.3, 0.5]),
        part(b"length", length, [3, 4, 5, 6, 7, 9, 12]),
        part(b"words", w, [1, 5, 20, 50]),
    ]


def _numbers(word: bytes) -> list[int]:
    """A word without its outer marks, and its beginnings of 4 to 6 bytes (marked by a space, as no word has one)."""
    core = word.strip(STRIP) or word
    return [zlib.crc32(x) & ((1 << BITS) - 1) for x in (core, *(b" " + core[:n] for n in (4, 5, 6) if len(core) >= n))]


def features(raw: bytes) -> list[int]:
    """The text's features: hashed distinct words and their beginnings, and its shape. A feature is there or not."""
    words = words_of(raw)
    return sorted({k for w in set(words) for k in _numbers(w)} | {zlib.crc32(s) & ((1 << BITS) - 1) for s in _shape(raw, words)})


@dataclass(frozen=True)
class Model:
    """P(grade <= k) = sigmoid(cuts[k] - score), the score a sum of weights shared by all grades."""

    weights: dict[int, float]
    cuts: tuple[float, ...]

    def tail(self, score: np.ndarray) -> np.ndarray:
        """P(grade >= k) for k from 1."""
        return 1 / (1 + np.exp(np.clip(np.array(self.cuts)[None, :] - score[:, None], -50, 50)))


@dataclass(frozen=True)
class Sample:
    """Grades of texts, and their features as pairs (text, feature) of small integers."""

    grades: np.ndarray
    text: np.ndarray
    feature: np.ndarray

    @staticmethod
    def of(features: list[np.ndarray], grades: list[int]) -> Sample:
        sizes = np.array([len(f) for f in features], dtype=np.int64)
        flat = np.concatenate([np.asarray(f, dtype=np.int32) for f in features]) if len(features) else np.zeros(0, np.int32)
        return Sample(np.array(grades, dtype=np.int64), np.repeat(np.arange(len(features), dtype=np.int32), sizes), flat)


def _telling(by: np.ndarray, graded: np.ndarray) -> np.ndarray:
    """Which features have documents whose share of grades above some cut is far from that of all documents.

    by: for each grade the documents of each feature; graded: all documents of each grade.
    """
    docs, z = by.sum(axis=0), np.zeros(by.shape[1])
    for k in range(1, GRADES):
        share = float(graded[k:].sum() / max(1, graded.sum()))
        spread = max(np.sqrt(share * (1 - share)), 1e-3)
        z = np.maximum(z, np.abs(by[k:].sum(axis=0) / np.maximum(docs, 1) - share) * np.sqrt(docs) / spread)
    return (z >= LEAST_Z) & (docs >= LEAST_DOCS)


def _screened(s: Sample) -> np.ndarray:
    """The features of a sample that tell its grades apart."""
    names, at = np.unique(s.feature, return_inverse=True)
    by = np.stack([np.bincount(at[s.grades[s.text] == g], minlength=len(names)) for g in range(GRADES)])
    return names[_telling(by, np.bincount(s.grades, minlength=GRADES))]


def _minimize(loss, x: np.ndarray, steps: int, memory: int = 10) -> np.ndarray:
    """Limited-memory quasi-Newton steps with backtracking on a convex function that gives its value and gradient."""
    value, slope = loss(x)
    past: list[tuple[np.ndarray, np.ndarray, float]] = []
    for _ in range(steps):
        way, mix = -slope, []
        for s, y, r in reversed(past):
            a = r * float(s @ way)
            mix.append(a)
            way = way - a * y
        if past:
            s, y, _r = past[-1]
            way = way * float(s @ y) / float(y @ y)
        for (s, y, r), a in zip(past, reversed(mix)):
            way = way + (a - r * float(y @ way)) * s
        size, fall = 1.0 if past else min(1.0, 1 / np.abs(slope).sum()), float(slope @ way)
        for _ in range(30):
            new = x + size * way
            now, grad = loss(new)
            if now <= value + 1e-4 * size * fall:
                break
            size /= 2
        else:
            break
        s, y = new - x, grad - slope
        if float(s @ y) > 1e-12:
            past = [*past[1 - memory :], (s, y, 1 / float(s @ y))]
        done = value - now < 1e-7
        x, value, slope = new, now, grad
        if done:
            break
    return x


def fit(s: Sample, steps: int = 150, ridge: float = 1e-4) -> Model:
    """Maximum likelihood with a squared penalty. Without rows or with one grade the weights are zero."""
    grades, n = s.grades, len(s.grades)
    share = np.array([(np.sum(grades > k) + 0.5) / (n + 1) if n else 1 - 1e-6 for k in range(GRADES - 1)])
    cuts = -np.log(share / (1 - share))
    if len(np.unique(grades)) < 2:
        return Model({}, tuple(cuts.tolist()))
    kept = _screened(s)
    slot = np.full(1 << BITS, -1, dtype=np.int32)
    slot[kept] = np.arange(len(kept))
    use = slot[s.feature] >= 0
    at, col, one = s.text[use], slot[s.feature[use]], np.arange(n)

    def loss(x: np.ndarray) -> tuple[float, np.ndarray]:
        w, gaps = x[: len(kept)], np.exp(np.clip(x[len(kept) + 1 :], -12, 12))
        c = x[len(kept)] + np.append(0.0, np.cumsum(gaps))
        score = np.bincount(at, weights=w[col], minlength=n)
        below = np.ones((n, GRADES + 1))
        below[:, 0] = 0
        below[:, 1:GRADES] = 1 / (1 + np.exp(np.clip(score[:, None] - c[None, :], -50, 50)))
        a, b = below[one, grades + 1], below[one, grades]
        p = np.maximum(a - b, 1e-12)
        dc = np.zeros(GRADES + 1)
        np.add.at(dc, grades + 1, -a * (1 - a) / p)
        np.add.at(dc, grades, b * (1 - b) / p)
        dw = np.bincount(col, weights=(1 - a - b)[at], minlength=len(kept)) / n + ridge * w
        after = np.cumsum(dc[1:GRADES][::-1])[::-1] / n  # a gap moves all cuts behind it
        return float(-np.log(p).mean() + ridge / 2 * (w @ w)), np.concatenate([dw, after[:1], gaps * after[1:]])

    # The first cut, and the logarithms of the gaps between cuts, so that these stay in order.
    start = np.concatenate([np.zeros(len(kept)), cuts[:1], np.log(np.maximum(np.diff(cuts), 0.1))])
    x = _minimize(loss, start, steps)
    cuts = x[len(kept)] + np.append(0.0, np.cumsum(np.exp(np.clip(x[len(kept) + 1 :], -12, 12))))
    return Model({int(k): float(v) for k, v in zip(kept, x)}, tuple(cuts.tolist()))


def labelled(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Sample:
    """Grade and telling features of a bounded sample of labelled documents.

    Grade 0: quality 0; 1: toxic; 2: neither. Labels with a null are not used; a document with
    several takes the lowest grade. The sample is the ``sample`` smallest hashed ids.
    """
    grade = F.when(F.col("quality") == 0, 0).when(F.col("toxic") == 1, 1).otherwise(2)
    graded = labels.where("doc_id is not null and quality is not null and toxic is not null").groupBy("doc_id").agg(F.min(grade).alias("grade"))
    chosen = graded.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")  # at most ``sample`` rows of two numbers

    def run(batches):
        for batch in batches:
            found = [np.array(features(raw), dtype=np.int32) for _, raws in slices(batch, "text") for raw in raws]
            out = pa.ListArray.from_arrays(np.cumsum([0, *map(len, found)], dtype=np.int32), np.concatenate(found) if found else np.zeros(0, np.int32))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), out, batch.column("grade")], names=["doc_id", "features", "grade"])

    whole = stash(rows.select("doc_id", "text", "grade").mapInArrow(run, "doc_id long, features array<int>, grade int"))
    # The driver gets counts of features, then of each text the features that tell grades apart; no others enter the model.
    graded = dict(whole.groupBy("grade").count().collect())
    of = [F.count_if(F.col("grade") == g).alias(f"g{g}") for g in range(GRADES)]
    counts = whole.select("grade", F.explode("features").alias("feature")).groupBy("feature").agg(F.count(F.lit(1)).alias("n"), *of).where(F.col("n") >= LEAST_DOCS).drop("n").toArrow()
    by = np.stack([counts.column(f"g{g}").to_numpy() for g in range(GRADES)])
    kept = np.sort(counts.column("feature").to_numpy()[_telling(by, np.array([graded.get(g, 0) for g in range(GRADES)]))])

    def keep(batches):
        for batch in batches:
            out = [np.intersect1d(x, kept, assume_unique=True).astype(np.int32).tobytes() for x in (f.values.to_numpy() for f in batch.column("features"))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out, pa.binary()), batch.column("grade")], names=["doc_id", "features", "grade"])

    found = whole.mapInArrow(keep, "doc_id long, features binary, grade int").toArrow().sort_by([("doc_id", "ascending"), ("features", "ascending")])
    arrays = [np.frombuffer(x.as_buffer(), dtype=np.int32) for x in found.column("features")]
    return Sample.of(arrays, found.column("grade").to_pylist())


def _scorer(model: Model):
    """A function from texts to their scores; it keeps the numbers of words it has met, up to a bound."""
    memo: dict[bytes, tuple[int, ...]] = {}

    def one(raw: bytes) -> float:
        if len(memo) > MEMO:
            memo.clear()
        words, hit = words_of(raw), set()
        for word in set(words):
            known = memo.get(word)
            if known is None:
                memo[word] = known = tuple(k for k in _numbers(word) if k in model.weights)
            if known:
                hit.update(known)
        hit |= {k for s in _shape(raw, words) if (k := zlib.crc32(s) & ((1 << BITS) - 1)) in model.weights}
        return sum(model.weights[k] for k in sorted(hit))

    def scores(batch: pa.RecordBatch, column: str) -> tuple[np.ndarray, np.ndarray]:
        s = np.array([one(raw) for _, raws in slices(batch, column) for raw in raws], dtype=float)
        return s, model.tail(s) if len(s) else np.zeros((0, GRADES - 1))

    return scores


def _train(df: DataFrame, labels: DataFrame, id_col: str, text_col: str, sample: int) -> Model:
    docs = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return fit(labelled(docs, labels.select(F.col("doc_id").cast("long").alias("doc_id"), "quality", "toxic"), sample))


def grade(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE) -> DataFrame:
    """(id, score, expected_grade, p_good, accepted) of every row, by a model fitted on the labelled rows.

    ``accepted``: the probability of the top grade is at least a half. Null and
    empty texts are scored by their shape alone; repeated rows and rows without an id
    get a row each; an empty table gives none. Without usable labels every weight
    is zero and the probability is the labels' share (near one if there are none).
    Columns besides the id and the text are not read.
    """
    model = _train(df, labels, id_col, text_col, sample)

    def run(batches):
        scores = _scorer(model)
        for batch in batches:
            s, tail = scores(batch, "text")
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(s), pa.array(tail.sum(axis=1)), pa.array(tail[:, -1]), pa.array(tail[:, -1] >= 0.5)], names=["id", "score", "expected_grade", "p_good", "accepted"])

    return df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(run, "id long, score double, expected_grade double, p_good double, accepted boolean")


def accept(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE) -> DataFrame:
    """The rows of ``df`` that ``grade`` accepts, with all their columns."""
    model = _train(df, labels, id_col, text_col, sample)

    def run(batches):
        scores = _scorer(model)
        for batch in batches:
            yield batch.filter(pa.array(scores(batch, text_col)[1][:, -1] >= 0.5))

    return df.mapInArrow(run, df.schema)
