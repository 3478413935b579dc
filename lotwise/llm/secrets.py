"""Secret scan: fixed patterns, and a randomness battery under false-discovery control."""

from __future__ import annotations

import hashlib
import math
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotwise.llm.common import slices

KINDS = ("assign", "access", "hex", "random")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
WORDS = (b"passw", b"secret", b"token", b"api")
#: Runs that can hold access keys, hexadecimal runs or candidates of the battery.
RUN = re.compile(r"[A-Za-z0-9+/_-]{16,}={0,2}")
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"[0-9a-f]{16,}")

DIGITS, LOWER, UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Encodings by size of their alphabet; a run has the first that holds all its symbols.
ENCODINGS = tuple(
    (name, {c: i for i, c in enumerate(alphabet)})
    for name, alphabet in (
        ("decimal", DIGITS),
        ("hex", DIGITS + LOWER[:6]),
        ("HEX", DIGITS + UPPER[:6]),
        ("lower", LOWER),
        ("upper", UPPER),
        ("base32", UPPER + "234567"),
        ("base36", DIGITS + LOWER),
        ("BASE36", DIGITS + UPPER),
        ("letters", UPPER + LOWER),
        ("base62", DIGITS + UPPER + LOWER),
        ("base64", UPPER + LOWER + DIGITS + "+/"),
        ("base64url", UPPER + LOWER + DIGITS + "-_"),
        ("mixed", UPPER + LOWER + DIGITS + "+/-_"),
    )
)
SYMBOLS = UPPER + LOWER + DIGITS + "+/-_"
#: Symbol number of each byte; all other bytes share the last number.
NUMBER = np.full(256, len(SYMBOLS), dtype=np.int64)
NUMBER[np.frombuffer(SYMBOLS.encode(), dtype=np.uint8)] = np.arange(len(SYMBOLS))
STATES = len(SYMBOLS) + 1

MIN_LENGTH = 20
#: Lower ends of the length classes, each under its own false-discovery control.
CLASSES = (20, 24, 32, 48, 96)
FDR = 0.01
REFUTED = 0.001
STEP, TOP = 0.25, 4000
#: Runs drawn for each encoding to learn what the battery gives for ordinary text.
DRAWS = 1500


def base_spans(text: str, low: bytes) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the fixed patterns in code points; low: the lower-cased bytes of the text."""
    found = []
    if any(w in low for w in WORDS):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    return found


def _tail(z: float) -> float:
    return 0.5 * math.erfc(z / math.sqrt(2))


_tails = np.frompyfunc(_tail, 1, 1)


def battery(x: np.ndarray, size: int) -> np.ndarray:
    """P-values (a row each) of the tests that rows of symbols are uniform and independent over an alphabet of that size.

    Chi-squared uniformity (Wilson-Hilferty), runs about the middle, and lag-one serial correlation.
    """
    rows, n = x.shape
    tail = lambda z: np.clip(_tails(z).astype(float), 1e-300, 0.5)
    seen = np.bincount((np.arange(rows)[:, None] * size + x).ravel(), minlength=rows * size).reshape(rows, size)
    chi, free = ((seen - n / size) ** 2).sum(axis=1) * size / n, size - 1
    uniform = np.clip(_tails(((chi / free) ** (1 / 3) - (1 - 2 / (9 * free))) / math.sqrt(2 / (9 * free))).astype(float), 1e-300, 1.0)
    high = x * 2 >= size
    a = high.sum(axis=1)
    b = n - a
    mean = 2 * a * b / n + 1
    spread = np.sqrt(np.maximum((mean - 1) * (mean - 2) / (n - 1), 1e-9))
    changes = 1 + (high[:, 1:] != high[:, :-1]).sum(axis=1)
    runs = np.where((a > 0) & (b > 0), 2 * tail(np.abs(changes - mean) / spread), max(2.0 ** (1 - n), 1e-300))
    y = x - (size - 1) / 2
    serial = 2 * tail(np.abs((y[:, 1:] * y[:, :-1]).sum(axis=1)) / (math.sqrt(n - 1) * (size * size - 1) / 12))
    return np.stack([uniform, runs, serial], axis=1)


def fisher(p: np.ndarray) -> np.ndarray:
    """Fisher's sum of each row of p-values; of three uniform ones it is chi-squared with six degrees of freedom."""
    return -2 * np.log(p).sum(axis=1)


def refuted(total: float) -> bool:
    """Whether the battery as a whole rejects uniform symbols."""
    h = total / 2
    return math.exp(-min(h, 700)) * (1 + h + h * h / 2) < REFUTED


def encoding(body: str) -> int:
    used = set(body)
    return next(i for i, (_, alphabet) in enumerate(ENCODINGS) if used <= alphabet.keys())


@dataclass(frozen=True)
class Ordinary:
    """What the battery gives for ordinary text: by encoding and length class the logarithms of Fisher's sum, sorted."""

    logs: np.ndarray  # encodings x classes x DRAWS

    @staticmethod
    def of(step: np.ndarray) -> Ordinary:
        """From the chances of a symbol after another in the corpus: runs that follow them within each alphabet."""
        rng = np.random.default_rng(5)
        logs = np.zeros((len(ENCODINGS), len(CLASSES), DRAWS))
        for e, (_, alphabet) in enumerate(ENCODINGS):
            at = np.array([SYMBOLS.index(c) for c in alphabet])
            up = np.cumsum(step[np.ix_(np.append(at, STATES - 1), at)], axis=1)
            up /= up[:, -1:]
            x, state = np.zeros((DRAWS, CLASSES[-1]), dtype=np.int64), np.full(DRAWS, len(at))
            for i, u in enumerate(rng.random((CLASSES[-1], DRAWS))):
                state = np.minimum((up[state] < u[:, None]).sum(axis=1), len(at) - 1)
                x[:, i] = state
            for c, n in enumerate(CLASSES):
                logs[e, c] = np.sort(np.log(np.maximum(fisher(battery(x[:, :n], len(at))), 1e-9)))
        return Ordinary(logs)

    def evidence(self, run: str) -> float:
        """-log of the chance that ordinary text of its encoding and length class looks as random; -inf if the battery refutes chance.

        The chance is the greater of the share of drawn runs and a normal tail of their logarithms,
        which goes on where no drawn run does.
        """
        body = run.rstrip("=")
        e = encoding(body)
        alphabet = ENCODINGS[e][1]
        total = float(fisher(battery(np.array([[alphabet[c] for c in body]]), len(alphabet)))[0])
        if refuted(total):
            return -math.inf
        own, value = self.logs[e, length_class(len(run))], math.log(max(total, 1e-9))
        z = (value - own.mean()) / max(own.std(), 0.05)
        normal = -math.log(_tail(-z)) if z > -30 else z * z / 2 + math.log(-z * math.sqrt(2 * math.pi))
        share = np.searchsorted(own, value, side="right") / DRAWS
        return min(normal, -math.log(share)) if share else normal


def length_class(n: int) -> int:
    return max(i for i, c in enumerate(CLASSES) if n >= c)


def spans(text: str, raw: bytes, ordinary: Ordinary) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int, float]]]:
    """Base spans (start, kind, end), and the battery's candidates (start, end, length class, evidence)."""
    base, tests = base_spans(text, raw.lower()), []
    for m in RUN.finditer(text):
        s, run = m.start(), m[0]
        if "AKIA" in run:
            base += [(s + k.start(), 1, s + k.end()) for k in ACCESS.finditer(run)]
        base += [(s + k.start(), 2, s + k.end()) for k in HEX.finditer(run)]
        if len(run) >= MIN_LENGTH:
            tests.append((s, m.end(), length_class(len(run)), ordinary.evidence(run)))
    return sorted(base), tests


def ordinary_text(docs: DataFrame, text_col: str) -> Ordinary:
    """The battery on ordinary text: chances of a symbol after another in all the texts, from counts over every byte."""

    def run(batches):
        total = np.zeros(STATES * STATES, dtype=np.int64)
        for batch in batches:
            for _, raws in slices(batch, "text"):
                x = NUMBER[np.frombuffer(b"\n".join(raws), dtype=np.uint8)]
                total += np.bincount(x[:-1] * STATES + x[1:], minlength=STATES * STATES)
        at = np.nonzero(total)[0]
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["pair", "n"])

    pairs = docs.select(F.col(text_col).alias("text")).mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    counts = np.full(STATES * STATES, 0.5)
    for row in pairs.collect():  # at most STATES^2 rows
        counts[row["pair"]] += row["n"]
    counts = counts.reshape(STATES, STATES)
    return Ordinary.of(counts / counts.sum(axis=1, keepdims=True))


def thresholds(docs: DataFrame, text_col: str, ordinary: Ordinary) -> list[float]:
    """Least evidence that counts as a discovery in each length class: the battery's p-values under Benjamini and Hochberg's rule.

    The rule takes all candidates of all documents; they are counted in steps of
    STEP, rounded down, so the collected histogram has a fixed bound.
    """

    def run(batches):
        for batch in batches:
            kind, step = [], []
            for _, raws in slices(batch, "text"):
                for raw in raws:
                    for *_, c, e in spans(raw.decode("utf-8", "replace"), raw, ordinary)[1]:
                        kind.append(c)
                        step.append(0 if e == -math.inf else min(TOP, int(e / STEP)))
            yield pa.RecordBatch.from_arrays([pa.array(kind, pa.int32()), pa.array(step, pa.int32())], names=["kind", "step"])

    hist = docs.select(F.col(text_col).alias("text")).mapInArrow(run, "kind int, step int").groupBy("kind", "step").agg(F.count(F.lit(1)).alias("n"))
    rows = sorted(((r["kind"], r["step"], r["n"]) for r in hist.collect()), reverse=True)
    least = [math.inf] * len(CLASSES)
    for kind in range(len(CLASSES)):
        own = [(s, n) for k, s, n in rows if k == kind]
        tests, found = sum(n for _, n in own), 0
        for s, n in own:
            found += n
            if s and s * STEP >= math.log(tests / (FDR * found)):
                least[kind] = s * STEP
    return least


def _scanner(ordinary: Ordinary, least: list[float]):
    def scan(raw: bytes) -> list[tuple[int, int, int]]:
        base, tests = spans(raw.decode("utf-8", "replace"), raw, ordinary)
        more = [(s, 3, e) for s, e, c, x in tests if x >= least[c] and not any(a < e and s < b for a, _, b in base)]
        return sorted(base + more)

    return scan


def _fit(docs: DataFrame, text_col: str):
    ordinary = ordinary_text(docs, text_col)
    return _scanner(ordinary, thresholds(docs, text_col, ordinary))


def scan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_assign, n_access, n_hex, n_random, base_sha256, spans) of every row of ``df``.

    ``spans`` has kind:start:end (code points, end exclusive) by start, then kind, joined by
    commas. Besides the fixed patterns, a run that no pattern touches is a span
    ``random`` if the battery doesn't refute chance and the chance that ordinary text does as
    well passes the false-discovery control of its length class over all documents. Null and empty texts have no
    spans and the digest of an empty string; repeated rows and rows without id give a
    row each; an empty table gives none; other columns are not read.
    """
    find = _fit(df, text_col)

    def run(batches):
        for batch in batches:
            rows = []
            for _, raws in slices(batch, "text"):
                for raw in raws:
                    all_ = find(raw)
                    name = [f"{KINDS[k]}:{s}:{e}" for s, k, e in all_]
                    base = ",".join(x for x, (_, k, _) in zip(name, all_) if k < 3)
                    count = [sum(k == i for _, k, _ in all_) for i in range(4)]
                    rows.append((*count, hashlib.sha256(base.encode()).hexdigest(), ",".join(name)))
            columns = list(zip(*rows)) or [()] * 6
            types = [pa.int64()] * 4 + [pa.string()] * 2
            yield pa.RecordBatch.from_arrays([batch.column("id"), *(pa.array(c, t) for c, t in zip(columns, types))], names=["id", *names])

    names = ["n_assign", "n_access", "n_hex", "n_random", "base_sha256", "spans"]
    schema = "id long, n_assign long, n_access long, n_hex long, n_random long, base_sha256 string, spans string"
    return df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(run, schema)


def redact(df: DataFrame, text_col: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """``df`` with every span of its texts replaced by ``mark``; touching or overlapping spans become one mark.

    All rows and columns stay as they are but for the texts with secrets; null texts stay null.
    """
    find, names = _fit(df, text_col), df.columns

    def run(batches):
        for batch in batches:
            texts = batch.column(text_col)
            new, at = [], 0
            for part, raws in slices(batch, text_col):
                for raw in raws:
                    found = find(raw)
                    if found:
                        text, out, end = raw.decode("utf-8", "replace"), [], 0
                        for s, _, e in found:
                            if s > end or not out:
                                out += [text[end:s], mark]
                            end = max(end, e)
                        new.append("".join(out) + text[end:])
                    else:
                        new.append(texts[at].as_py())
                    at += 1
            yield pa.RecordBatch.from_arrays([pa.array(new, pa.string()) if n == text_col else batch.column(n) for n in names], names=names)

    return df.mapInArrow(run, df.schema)
