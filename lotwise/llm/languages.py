"""Language identification: a bidirectional gated recurrent network over bytes, trained by backpropagation through time."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lotwise.llm.common import slices

#: Bounds of the labelled rows that the network is fitted on: languages (the most frequent labels), documents of each, pieces of a document, bytes of a piece.
LANGUAGES, DOCUMENTS, PIECES, PIECE = 200, 600, 8, 64
HIDDEN = 12
STEPS, BATCH, RATE = 400, 256, 0.01
#: Bytes that the network reads in a row, and so many rows at a time.
WIDTH, ROWS = 128, 2048
UNKNOWN = "und"

FOLD = np.arange(256, dtype=np.uint8)
FOLD[65:91] += 32
LETTER = np.zeros(256, dtype=bool)
LETTER[97:123] = LETTER[128:] = True


@dataclass(frozen=True)
class Network:
    """Two directions (first axis) of ``h' = (1 - z) n + z h`` with z, r = sigmoid(table + gate h), n = tanh(table + r gate h).

    table (2, 3H, 256) holds what a byte adds to z, r and n; gate is (2, 3H, H); out (L, 2H) and
    bias (L, 1) give the languages' scores of a position from both states there.
    """

    languages: tuple[str, ...]
    table: np.ndarray
    gate: np.ndarray
    out: np.ndarray
    bias: np.ndarray

    @property
    def weights(self) -> tuple[np.ndarray, ...]:
        return self.table, self.gate, self.out, self.bias

    @staticmethod
    def drawn(languages: tuple[str, ...], hidden: int, seed: int) -> Network:
        rng, f = np.random.default_rng(seed), np.float32
        table = rng.normal(0, 0.3, (2, 3 * hidden, 256)).astype(f)
        return Network(languages, table, rng.normal(0, hidden**-0.5, (2, 3 * hidden, hidden)).astype(f), rng.normal(0, 0.1, (len(languages), 2 * hidden)).astype(f), np.zeros((len(languages), 1), f))

    def states(self, codes: np.ndarray, trace: list | None = None) -> np.ndarray:
        """(T, 2, H, N) states at each of the positions of ``codes`` (T, N); ``trace`` collects what the way back needs."""
        steps, rows = codes.shape
        hidden = self.gate.shape[2]
        h, a = np.zeros((2, hidden, rows), np.float32), np.empty((2, 3 * hidden, rows), np.float32)
        p, out = np.empty_like(a), np.empty((steps, 2, hidden, rows), np.float32)
        half = np.array([0.5] * (2 * hidden) + [1.0] * hidden, dtype=np.float32)[None, :, None]
        table, gate = self.table * half, self.gate * half  # sigmoid(x) is (1 + tanh(x / 2)) / 2
        for t in range(steps):
            np.take(table[0], codes[t], axis=1, out=p[0], mode="clip")
            np.take(table[1], codes[steps - 1 - t], axis=1, out=p[1], mode="clip")
            np.matmul(gate, h, out=a)
            zr, n = a[:, : 2 * hidden], a[:, 2 * hidden :]
            zr += p[:, : 2 * hidden]
            np.tanh(zr, out=zr)
            zr *= 0.5
            zr += 0.5
            if trace is not None:
                q, before = n.copy(), h.copy()
            n *= zr[:, hidden:]
            n += p[:, 2 * hidden :]
            np.tanh(n, out=n)
            h -= n
            h *= zr[:, :hidden]
            h += n
            if trace is not None:
                trace.append((before, zr.copy(), q, n.copy()))
            out[t, 0], out[steps - 1 - t, 1] = h
        return out

    def probabilities(self, states: np.ndarray) -> np.ndarray:
        """(T, L, N) probabilities of the languages at each position."""
        steps, _, hidden, rows = states.shape
        p = np.matmul(self.out, states.reshape(steps, 2 * hidden, rows))
        p += self.bias
        p -= p.max(axis=1, keepdims=True)
        np.exp(p, out=p)
        p /= p.sum(axis=1, keepdims=True)
        return p

    def gradients(self, codes: np.ndarray, label: np.ndarray) -> tuple[float, tuple[np.ndarray, ...]]:
        """Mean cross entropy of the letters' positions of ``codes`` (T, N) with languages ``label`` (N, or T, N), and its gradient of all weights."""
        trace: list = []
        states = self.states(codes, trace)
        steps, _, hidden, rows = states.shape
        p = self.probabilities(states)
        mask = LETTER[codes]
        count = max(1, int(mask.sum()))
        at = np.broadcast_to(label, (steps, rows))[:, None, :]
        own = np.take_along_axis(p, at, axis=1)
        loss = float(-(np.log(np.maximum(own[:, 0], 1e-30)) * mask).sum() / count)
        np.put_along_axis(p, at, own - 1, axis=1)
        p *= (mask / np.float32(count))[:, None, :].astype(np.float32)
        flat = states.reshape(steps, 2 * hidden, rows)
        d_out, d_bias = np.einsum("tln,thn->lh", p, flat, optimize=True), p.sum(axis=(0, 2))[:, None]
        d_states = np.matmul(self.out.T, p).reshape(steps, 2, hidden, rows)
        d_gate, d_table, dh = np.zeros_like(self.gate), np.zeros_like(self.table), np.zeros((2, hidden, rows), np.float32)
        d_input = np.empty((steps, 2, 3 * hidden, rows), np.float32)
        back = self.gate.transpose(0, 2, 1)
        for t in reversed(range(steps)):
            before, zr, q, n = trace[t]
            z, r = zr[:, :hidden], zr[:, hidden:]
            dh[0] += d_states[t, 0]
            dh[1] += d_states[steps - 1 - t, 1]
            d = d_input[t]
            d_n = dh * (1 - z) * (1 - n * n)
            d[:, :hidden] = dh * (before - n) * z * (1 - z)
            d[:, hidden : 2 * hidden] = d_n * q * r * (1 - r)
            d[:, 2 * hidden :] = d_n
            inner = d.copy()
            inner[:, 2 * hidden :] *= r
            dh = dh * z + np.matmul(back, inner)
            d_gate += np.matmul(inner, before.transpose(0, 2, 1))
        for way in (0, 1):
            at = (codes if way == 0 else codes[::-1]).ravel()
            order = np.argsort(at, kind="stable")
            there, first = np.unique(at[order], return_index=True)
            d_table[way][:, there] = np.add.reduceat(d_input[:, way].transpose(1, 0, 2).reshape(3 * hidden, -1)[:, order], first, axis=1)
        return loss, (d_table, d_gate, d_out, d_bias)


def fit(pieces: list[bytes], label: list[int], languages: tuple[str, ...], hidden: int = HIDDEN, steps: int = STEPS, seed: int = 1) -> Network:
    """Adam with a falling rate on batches in which all languages have the same share.

    Half of a batch goes over from one piece to another somewhere, so that a state doesn't outlive its language.
    """
    net, rng = Network.drawn(languages, hidden, seed), np.random.default_rng(seed)
    by = np.array(label, dtype=np.int64)
    codes = FOLD[np.frombuffer(b"".join(p[:PIECE].ljust(PIECE, b"\0") for p in pieces), dtype=np.uint8).reshape(-1, PIECE)].astype(np.intp)
    groups = [np.nonzero(by == k)[0] for k in range(len(languages))]
    mean = [np.zeros_like(w) for w in net.weights]
    square = [np.zeros_like(w) for w in net.weights]
    for step in range(1, steps + 1):
        chosen = np.concatenate([rng.choice(groups[k], n) for k, n in enumerate(np.bincount(rng.integers(0, len(languages), BATCH), minlength=len(languages))) if n])
        other, half = rng.permutation(len(chosen)), len(chosen) // 2
        cut = np.where(rng.permutation(len(chosen)) < half, rng.integers(0, PIECE, len(chosen)), PIECE)
        first = np.arange(PIECE)[:, None] < cut
        _, grads = net.gradients(np.where(first, codes[chosen].T, codes[chosen][other].T), np.where(first, by[chosen], by[chosen][other]))
        scale = min(1.0, 1.0 / (1e-9 + float(np.sqrt(sum((g.astype(float) ** 2).sum() for g in grads)))))
        rate = RATE * min(1.0, 2 * (1 - (step - 1) / steps))
        for w, g, m, s in zip(net.weights, grads, mean, square):
            g = g * np.float32(scale)
            m += 0.1 * (g - m)
            s += 0.01 * (g * g - s)
            w -= (rate * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
    return net


def held_out(id_column: Column) -> Column:
    """Documents not to learn from: crc32 of the id as text, modulo 3, is 1 (an id that is null counts as empty text)."""
    return F.crc32(F.coalesce(id_column.cast("string"), F.lit("")).cast("binary")) % 3 == 1


def train(df: DataFrame, id_col: str, text_col: str, lang_col: str, documents: int = DOCUMENTS) -> Network | None:
    """The network of the labelled rows that aren't held out; None without any.

    Of each language up to ``documents`` rows are taken by their hash (equal rows once) from
    all rows, and PIECES pieces spread over the whole text from each.
    """
    text, lang = F.col(text_col), F.col(lang_col).cast("string")
    h = F.xxhash64(F.col(id_col).cast("long"), text)
    rows = df.where(~held_out(F.col(id_col)) & text.isNotNull() & lang.isNotNull())
    sizes = rows.groupBy(lang.alias("lang")).agg(F.approx_count_distinct(h).alias("n"), F.min(h).alias("least")).orderBy(F.desc("n"), "lang").limit(LANGUAGES).collect()
    if not sizes:
        return None
    share = df.sparkSession.createDataFrame([(r["lang"], 2.0 * documents / r["n"], r["least"]) for r in sizes], "lang string, share double, least long")
    raw, gap = text.cast("binary"), (F.greatest(F.octet_length(text) - PIECE, F.lit(0)) / (PIECES - 1)).cast("int")
    cut = F.array(*(F.substring(raw, gap * i + 1, F.lit(PIECE)) for i in range(PIECES)))
    some = rows.select(lang.alias("lang"), h.alias("h"), text.alias(text_col)).join(F.broadcast(share), "lang").where((F.pmod("h", F.lit(1 << 32)) < F.col("share") * (1 << 32)) | (F.col("h") == F.col("least")))
    some = some.select("lang", "h", F.when(gap == 0, F.slice(cut, 1, 1)).otherwise(cut).alias("pieces")).groupBy("lang", "h").agg(F.first("pieces").alias("pieces"))
    # About twice ``documents`` rows a language reach the window.
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("h"))
    found = some.withColumn("rank", rank).where(F.col("rank") <= documents).select("lang", "h", "pieces").toArrow().sort_by([("lang", "ascending"), ("h", "ascending")])
    langs, cuts = found.column("lang").to_pylist(), found.column("pieces").to_pylist()
    known = tuple(sorted(set(langs)))
    number = {k: i for i, k in enumerate(known)}
    pairs = [(p, number[k]) for k, pieces in zip(langs, cuts) for p in pieces if p]
    for k in set(range(len(known))) - {k for _, k in pairs}:
        pairs.append((b"", k))  # all its texts are empty
    return fit([p for p, _ in pairs], [k for _, k in pairs], known)


def _laid(raws: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Rows of WIDTH folded bytes, every text from a row of its own on, filled with zeros; and the number of rows of each text."""
    rows = np.array([-(-len(r) // WIDTH) for r in raws], dtype=np.int64)
    return FOLD[np.frombuffer(b"".join(r.ljust(n * WIDTH, b"\0") for r, n in zip(raws, rows.tolist())), dtype=np.uint8)].reshape(-1, WIDTH), rows


def positions(net: Network, raws: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Codes (T, N) and probabilities (T, L, N) of all positions, ROWS rows at a time."""
    laid, _ = _laid(raws)
    for a in range(0, len(laid), ROWS):
        codes = np.ascontiguousarray(laid[a : a + ROWS].T).astype(np.intp)
        yield codes, net.probabilities(net.states(codes))


def pooled(net: Network, raws: list[bytes]) -> np.ndarray:
    """Mean probabilities of the languages over the letters of each text; zeros for a text without letters."""
    rows = _laid(raws)[1]
    sums, letters = [np.zeros((0, len(net.languages)))], [np.zeros(0)]
    for codes, p in positions(net, raws):
        mask = LETTER[codes]
        sums.append(np.einsum("tln,tn->nl", p, mask.astype(np.float32), optimize=True).astype(float))
        letters.append(mask.sum(axis=0).astype(float))
    of = np.repeat(np.arange(len(raws)), rows)
    total = np.zeros((len(raws), len(net.languages)))
    np.add.at(total, of, np.concatenate(sums))
    return total / np.maximum(1, np.bincount(of, weights=np.concatenate(letters), minlength=len(raws)))[:, None]


def labelled_runs(net: Network, raw: bytes) -> list[tuple[int, int, str]]:
    """(start, end, language) of the runs of following bytes whose positions have the same most likely language."""
    best = np.concatenate([np.zeros(0, np.int64), *(p.argmax(axis=1).T.ravel() for _, p in positions(net, [raw]))])[: len(raw)]
    if not len(best):
        return []
    edge = np.concatenate([[0], np.nonzero(np.diff(best))[0] + 1, [len(best)]]).tolist()
    return [(a, b, net.languages[int(best[a])]) for a, b in zip(edge, edge[1:])]


def identify(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", runs: bool = False) -> DataFrame:
    """(id, held_out, lang_pred, score) of every row; with ``runs`` also the labelled runs of the text's UTF-8 bytes.

    The score is the mean probability of the predicted language over the letters' positions of the
    whole text. ``und`` and 0 for a null text, a text without a letter, and if nothing is
    labelled. Null and repeated ids and repeated rows get a row each; rows with a null language are
    predicted, not learned from; an empty table gives no rows. A text of any length is read whole, in
    rows of WIDTH bytes, ROWS at a time. Columns besides the id, the text and the language are not read.
    """
    net = train(df, id_col, text_col, lang_col)
    text = F.col(text_col)
    rows = df.select(F.col(id_col).cast("long").alias("id"), held_out(F.col(id_col)).alias("held_out"), text.alias("text"))
    lettered = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    kind = "id long, held_out boolean, lang_pred string, score double" + ", runs array<struct<start:int,end:int,lang:string>>" * runs
    if net is None:
        none = rows.select("id", "held_out", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
        return none.withColumn("runs", F.array().cast("array<struct<start:int,end:int,lang:string>>")) if runs else none

    def run(batches):
        for batch in batches:
            for part, raws in slices(batch, "text"):
                p = pooled(net, raws)
                some = np.array(part.column("lettered").to_pylist(), dtype=bool)
                pred = [net.languages[k] if ok else UNKNOWN for k, ok in zip(p.argmax(axis=1).tolist(), some)]
                score = np.where(some, np.clip(np.round(p.max(axis=1), 6), 0, 1), 0.0)
                arrays = [part.column("id"), part.column("held_out"), pa.array(pred, pa.string()), pa.array(score, pa.float64())]
                names = ["id", "held_out", "lang_pred", "score"]
                if runs:
                    names.append("runs")
                    arrays.append(pa.array([[{"start": a, "end": b, "lang": k} for a, b, k in labelled_runs(net, raw)] for raw in raws], pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("lang", pa.string())]))))
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    return rows.select("id", "held_out", "text", lettered.alias("lettered")).mapInArrow(run, kind)
