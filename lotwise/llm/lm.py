"""Language-model scores: a Brown class bigram model beside an add-one unigram base."""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotwise.llm.common import checkpoint, keyed, slices, words_of

#: Words kept by every worker, the most frequent ones; the others are joined.
HEAD = 1 << 18
#: Of these, the ones that are exchanged until none moves; the others start in a class by rank and are then exchanged once.
CLUSTERED = 1024
CLASSES = 32
BANDS = 6
SWEEPS = 12
FLUSH = 600_000
#: Words whose moves a task weighs at a time, and words whose contexts it gives out at a time.
TOGETHER, GIVEN = 512, 1 << 14


def train_rows() -> F.Column:
    """Documents to learn from: crc32 of the id as text, modulo 7, is not 2 (an id that is null counts as empty text)."""
    return F.crc32(F.coalesce(F.col("id").cast("string"), F.lit("")).cast("binary")) % 7 != 2


def counts(docs: DataFrame) -> DataFrame:
    """(word, n) over the texts."""

    def run(batches):
        seen: dict[bytes, int] = {}
        schema = pa.schema([("word", pa.string()), ("n", pa.int64())])

        def out():
            words = pa.array(list(seen), pa.binary()).cast(pa.string())
            found = pa.RecordBatch.from_arrays([words, pa.array(list(seen.values()), pa.int64())], schema=schema)
            seen.clear()
            return found

        for batch in batches:
            for _, raws in slices(batch, "text"):
                for raw in raws:
                    for w in words_of(raw):
                        seen[w] = seen.get(w, 0) + 1
                if len(seen) > FLUSH:
                    yield out()
        yield out()

    return docs.select("text").mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


@dataclass(frozen=True)
class Symbols:
    """Numbers of the model's symbols: clustered words, rank bands, rare words, the end."""

    words: dict[bytes, int]  # head words by rank
    clustered: int

    @property
    def size(self) -> int:
        return self.clustered + BANDS + 2

    def of_rank(self) -> np.ndarray:
        """Symbol of each rank, then the symbol of any other word."""
        n = len(self.words)
        rank = np.arange(n)
        band = np.minimum(BANDS - 1, np.log2(np.maximum(rank, 1) / CLUSTERED).clip(0).astype(int)) if n else rank
        return np.append(np.where(rank < self.clustered, rank, self.clustered + band), self.clustered + BANDS).astype(np.int64)

    @property
    def rare(self) -> int:
        return self.clustered + BANDS

    @property
    def end(self) -> int:
        return self.clustered + BANDS + 1


def _ranks(raw: bytes, words: dict[bytes, int], other: int) -> tuple[list[bytes], np.ndarray]:
    tokens = words_of(raw)
    get = words.get
    return tokens, np.fromiter((get(t, other) for t in tokens), dtype=np.int64, count=len(tokens))


def _numbers(raws: list[bytes], words: dict[bytes, int], end: int) -> np.ndarray:
    """Ranks of the words of texts, len(words) for any other; an end (its number) before, between and after the texts."""
    parts = [np.array([end])]
    for raw in raws:
        parts += [_ranks(raw, words, len(words))[1], parts[0]]
    return np.concatenate(parts)


def _follows(docs: DataFrame, words: dict[bytes, int], table: np.ndarray, size: int) -> np.ndarray:
    """Counts of symbol after symbol over all the texts; ``table`` has the symbol of each rank, of any other word and of the end."""

    def run(batches):
        total = np.zeros(size * size, dtype=np.int64)
        for batch in batches:
            for _, raws in slices(batch, "text"):
                x = table[_numbers(raws, words, len(words) + 1)]
                total += np.bincount(x[:-1] * size + x[1:], minlength=size * size)
        at = np.nonzero(total)[0]
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["pair", "n"])

    pairs = docs.select("text").mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    found = np.zeros(size * size)
    table_ = pairs.toArrow()  # at most size^2 rows, about a million
    found[table_.column("pair").to_numpy()] = table_.column("n").to_numpy()
    return found.reshape(size, size)


def bigrams(docs: DataFrame, symbols: Symbols) -> np.ndarray:
    """Counts of symbol after symbol over all the texts; each text starts after and ends with the end."""
    return _follows(docs, symbols.words, np.append(symbols.of_rank(), symbols.end), symbols.size)


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.where(x > 0, x, 1))


def _gains(n: np.ndarray, out: np.ndarray, into: np.ndarray, own: np.ndarray, classes: int) -> np.ndarray:
    """What the likelihood of the class bigrams gains by each word in each of the first ``classes`` classes.

    For each word: n, the counts without it; out and into, what follows it and what it follows, by class and
    without itself; own, how often it follows itself.
    """
    rows, cols = n.sum(axis=2) + into, n.sum(axis=1) + out  # what the word adds wherever it goes
    near = np.arange(classes)
    to, back, alone = out[:, :classes], into[:, :classes], own[:, None]
    gain = (_xlogx(n[:, :classes] + out[:, None, :]) - _xlogx(n[:, :classes])).sum(axis=2) + (_xlogx(n[:, :, :classes] + into[:, :, None]) - _xlogx(n[:, :, :classes])).sum(axis=1)
    both = n[:, near, near]
    gain += _xlogx(both + to + back + alone) - _xlogx(both) - (_xlogx(both + to) - _xlogx(both)) - (_xlogx(both + back) - _xlogx(both))
    gain -= _xlogx(rows[:, :classes] + out.sum(axis=1)[:, None] + alone) - _xlogx(rows[:, :classes])
    gain -= _xlogx(cols[:, :classes] + into.sum(axis=1)[:, None] + alone) - _xlogx(cols[:, :classes])
    return gain


def exchange(pairs: np.ndarray, movable: int, classes: int = CLASSES, sweeps: int = SWEEPS) -> np.ndarray:
    """Class of each symbol: words 0..movable-1 are exchanged between ``classes`` classes, the rest have one each.

    Each word moves to the class that raises the likelihood of the class bigrams the
    most, until a sweep moves none.
    """
    size = len(pairs)
    classes = min(classes, max(1, movable))
    of = np.concatenate([np.arange(movable) % classes, classes + np.arange(size - movable)]).astype(int)
    k = classes + size - movable
    member = np.zeros((size, k))
    member[np.arange(size), of] = 1
    to, back = pairs @ member, pairs.T @ member  # by symbol: what follows it, what stands before it
    n = member.T @ to
    for _ in range(sweeps):
        moved = 0
        for w in range(movable):
            a, out, into, own = of[w], to[w].copy(), back[w].copy(), pairs[w, w]
            if not out.sum() + into.sum():
                continue
            out[a] -= own
            into[a] -= own
            n[a] -= out
            n[:, a] -= into
            n[a, a] -= own
            gain = _gains(n[None], out[None], into[None], np.array([own]), classes)[0]
            b = int(np.argmax(gain))
            if gain[b] <= gain[a] + 1e-9:
                b = a
            n[b] += out
            n[:, b] += into
            n[b, b] += own
            if b != a:
                moved += 1
                of[w] = b
                to[:, a] -= pairs[:, w]
                to[:, b] += pairs[:, w]
                back[:, a] -= pairs[w]
                back[:, b] += pairs[w]
        if not moved:
            break
    return of


def contexts(docs: DataFrame, symbols: Symbols, of: np.ndarray) -> DataFrame:
    """(word, at, n) of the head words beyond the clustered ones: how often class ``at`` follows the word (at < k), class
    at - k comes before it, and (at = 2k) it follows itself. A task counts in an array of len(words) * (2k + 1) numbers."""
    words, clustered, k = symbols.words, symbols.clustered, int(of.max()) + 1
    table, width, other = of[np.append(symbols.of_rank(), symbols.end)], 2 * k + 1, len(symbols.words)

    def run(batches):
        total = np.zeros((other - clustered) * width, dtype=np.uint32)
        for batch in batches:
            for _, raws in slices(batch, "text"):
                x = _numbers(raws, words, other + 1)
                at = np.nonzero((x >= clustered) & (x < other))[0]  # never the first or the last, which are ends
                mine, after, before = (x[at] - clustered) * width, x[at + 1], x[at - 1]
                same = after == x[at]
                np.add.at(total, np.where(same, mine + 2 * k, mine + table[after]), 1)
                apart = before != x[at]
                np.add.at(total, (mine + k + table[before])[apart], 1)
        for first in range(0, other - clustered, GIVEN):
            part = total[first * width : (first + GIVEN) * width]
            at = np.nonzero(part)[0]
            yield pa.RecordBatch.from_arrays([pa.array(at // width + clustered + first, pa.int32()), pa.array(at % width, pa.int32()), pa.array(part[at], pa.int64())], names=["word", "at", "n"])

    # One shuffle by the word serves both the sums and the lists that are made of them.
    return docs.select("text").mapInArrow(run, "word int, at int, n long").repartition("word").groupBy("word", "at").agg(F.sum("n").alias("n"))


def exchanged(docs: DataFrame, symbols: Symbols, pairs: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Class of each rank and of any other word, and the counts of class after class, once every head word is in an exchanged class.

    Each word beyond the clustered ones moves from its class by rank to the class that raises the likelihood of the class bigrams the
    most, all others staying where they are; its contexts are counted and weighed by the executors.
    """
    ranks, k = of[symbols.of_rank()], int(of.max()) + 1
    member = np.eye(k)[of]
    n = member.T @ pairs @ member
    if len(symbols.words) == symbols.clustered:
        return ranks, n
    classes, start = int(of[: symbols.clustered].max()) + 1, ranks.copy()

    def run(batches):
        for batch in batches:
            word, lists = batch.column("word").to_numpy(), batch.column("seen")
            flat, ends = lists.flatten(), np.cumsum([0, *pc.list_value_length(lists).to_pylist()])
            at, many = flat.field("at").to_numpy(), flat.field("n").to_numpy()
            for first in range(0, len(word), TOGETHER):
                w = word[first : first + TOGETHER]
                s, t = ends[first], ends[first + len(w)]
                seen = np.zeros((len(w), 2 * k + 1))
                seen[np.repeat(np.arange(len(w)), np.diff(ends[first : first + len(w) + 1])), at[s:t]] = many[s:t]
                out, into, own, each, a = seen[:, :k], seen[:, k : 2 * k], seen[:, 2 * k], np.arange(len(w)), start[w]
                without = np.repeat(n[None], len(w), axis=0)
                without[each, a] -= out
                without[each, :, a] -= into
                without[each, a, a] -= own
                best = _gains(without, out, into, own, classes).argmax(axis=1)
                yield pa.RecordBatch.from_arrays([pa.array(w, pa.int32()), pa.array(best, pa.int32())], names=["word", "class"])

    listed = contexts(docs, symbols, of).groupBy("word").agg(F.collect_list(F.struct("at", "n")).alias("seen"))  # at most 2k + 1 each
    moved = listed.mapInArrow(run, "word int, class int").toArrow()  # a row for each word of the head
    ranks[moved.column("word").to_numpy()] = moved.column("class").to_numpy()
    return ranks, _follows(docs, symbols.words, np.append(ranks, of[symbols.end]), k)


@dataclass(frozen=True)
class Model:
    """log10 probabilities: step[class, class]; head[rank] of a word in its class; the rest of a rare word is joined."""

    of: np.ndarray  # class of each symbol
    ranks: np.ndarray  # class of each rank, then of any other word
    step: np.ndarray
    head: np.ndarray
    rare_floor: float  # of a word that no training text has, in the rare class
    rare_total: float


def model(symbols: Symbols, pairs: np.ndarray, head: np.ndarray, rare_kinds: int, rare_tokens: int, train: DataFrame | None = None) -> Model:
    """Class transitions interpolated with class frequencies; emissions by frequency in the class, rare ones add a half.

    ``train``: the texts, needed where the head has words beyond the clustered ones.
    """
    of = exchange(pairs, symbols.clustered)
    ranks, n = exchanged(train, symbols, pairs, of)
    k = len(n)
    base = (n.sum(axis=0) + 0.1) / (n.sum() + 0.1 * k)
    kinds = (n > 0).sum(axis=1, keepdims=True) + 1
    step = (n + kinds * base) / (n.sum(axis=1, keepdims=True) + kinds)
    in_class = np.bincount(ranks[:-1], weights=head, minlength=k)
    total = rare_tokens + 0.5 * (rare_kinds + 1)
    return Model(of, ranks, np.log10(step), np.log10(head / in_class[ranks[:-1]]) if len(head) else head, math.log10(0.5 / total), total)


def scores(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", head: int = HEAD, clustered: int = CLUSTERED) -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row.

    Tokens are the words of the lower-cased (A-Z) text and one end. The base and the
    class model learn from the rows that are not held out, over their whole texts. The
    ``head`` most frequent words are kept by every worker; the counts of all other
    words stay in a table that the documents' other words are joined with, so the
    vocabulary has no bound. Words seen once are never kept: their class stands for
    what is new, and its share of the training text is the estimate of new words. Of the head,
    the ``clustered`` most frequent words are exchanged between the classes until none moves; every further
    word then moves once to the class that suits its contexts best (``exchanged``).

    Null and empty texts are an end alone, the longest texts are read whole; repeated rows are
    scored, and counted, each; a null id is an empty text to the split; an empty table
    gives no rows. Columns besides the id and the text are not read.
    """
    docs = keyed(df, id_col, text_col)
    train = docs.where(train_rows())
    table = checkpoint(counts(train))
    tokens, kinds, = table.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    texts = train.count()
    n, v = tokens + texts, kinds + (texts > 0)
    top = table.where("n > 1").orderBy(F.desc("n"), "word").limit(head).toArrow()  # at most ``head`` rows
    frequency = np.array(top.column("n").to_pylist(), dtype=float)
    symbols = Symbols({w: i for i, w in enumerate(top.column("word").cast(pa.binary()).to_pylist())}, min(clustered, top.num_rows))
    m = model(symbols, bigrams(train, symbols), frequency, kinds - top.num_rows, tokens - int(frequency.sum()), train)

    floor = n + v + 1
    base_head = np.log10((np.append(frequency, -1) + 1).clip(1e-300) / floor)  # the last, of other words, is replaced
    base_head[-1] = 0.0
    own_head = np.append(m.head, 0.0)
    of_rank = m.ranks
    base_end, end_class, other = math.log10((texts + 1) / floor), int(m.of[symbols.end]), len(symbols.words)

    def run(batches):
        for batch in batches:
            size, known, base, own, rest, many = [], [], [], [], [], []
            for _, raws in slices(batch, "text"):
                for raw in raws:
                    words, rank = _ranks(raw, symbols.words, other)
                    classes = np.concatenate([[end_class], of_rank[rank], [end_class]])
                    size.append(len(words) + 1)
                    known.append(int((rank < other).sum()) + (texts > 0))
                    base.append(float(base_head[rank].sum()) + base_end)
                    own.append(float(m.step[classes[:-1], classes[1:]].sum()) + float(own_head[rank].sum()))
                    seen: dict[bytes, int] = {}
                    for i in np.nonzero(rank == other)[0].tolist():
                        seen[words[i]] = seen.get(words[i], 0) + 1
                    rest.append([x.decode("utf-8", "replace") for x in seen])
                    many.append(list(seen.values()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("rid"), batch.column("id"), pa.array(size, pa.int64()), pa.array(known, pa.int64()), pa.array(base, pa.float64()), pa.array(own, pa.float64()), pa.array(rest, pa.list_(pa.string())), pa.array(many, pa.list_(pa.int64()))],
                names=["rid", "id", "size", "known", "base", "own", "rest", "many"],
            )

    own = docs.mapInArrow(run, "rid long, id long, size long, known long, base double, own double, rest array<string>, many array<long>")
    # One pass gives both a document's own sums, on a row whose word (with a space) no count has, and its other words.
    mark = F.struct(F.concat(F.lit(" "), F.col("rid").cast("string")).alias("word"), F.lit(0).cast("long").alias("times"), "size", "known", "base", "own")
    none = [F.lit(0).cast("long").alias("size"), F.lit(0).cast("long").alias("known"), F.lit(0.0).alias("base"), F.lit(0.0).alias("own")]
    each = F.transform(F.arrays_zip("rest", "many"), lambda x: F.struct(x["rest"].alias("word"), x["many"].alias("times"), *none))
    rows = own.select("rid", "id", F.explode(F.concat(F.array(mark), each)).alias("x")).select("rid", "id", "x.*")
    joined = rows.join(table.select("word", F.col("n").alias("c")), "word", "left").withColumn("c", F.coalesce("c", F.lit(0)))
    found = joined.groupBy("rid").agg(
        F.first("id", ignorenulls=True).alias("id"),
        F.sum("size").alias("n_tokens"),
        F.sum(F.col("known") + F.when(F.col("c") > 0, F.col("times")).otherwise(0)).alias("n_known"),
        F.sum(F.col("base") + F.col("times") * F.log10((F.col("c") + 1) / F.lit(float(floor)))).alias("base_score"),
        F.sum(F.col("own") + F.col("times") * F.log10((F.col("c") + 0.5) / F.lit(float(m.rare_total)))).alias("score"),
    )
    return found.select("id", (~train_rows()).alias("held_out"), "n_tokens", "n_known", F.lit(int(n)).cast("long").alias("train_tokens"), "base_score", "score")
