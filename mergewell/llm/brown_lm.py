"""Language-model scores by a Brown class bigram model.

Words are counted over all training documents.  The most frequent ``SEEDS`` words are put into classes by
exchange clustering: each word moves to the class that raises the likelihood of the class bigrams most,
until a round moves none.  Then every other training word is exchanged against these classes: Spark sums
its own bigrams with the seeds' classes, and it joins the class that they gain most in, to the first
order.  A token's probability is its class given its history, times the word given its class; the history
is the class of the word before, one symbol for all words outside the head, or the start.  A class keeps
a share for words never seen, from its words seen once; an unseen word has the shares of all
classes that may follow.

Scale: counting, the seeds' bigrams, the bigrams of all words, the class bigrams and scoring are five
passes that leave texts where they are.  Counts and classes of the ``HEAD`` most frequent words are sent to the
workers; that bound holds at every size.  Rarer words meet their counts and classes in joins on the word,
one row per document, word and history; no such word can be hot, for hot words are in the head.  The driver holds the
head, the bigrams of the seeds and the table of classes, all of fixed size.

Defined results: a null text is empty and scores its end alone; without training documents every
word is unknown; rows that repeat an id each give a row; null ids count as the empty text in the
split; other columns are ignored; words of no use to any class go to the first.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop_materialized, id_remainder, lean, materialize, whole_texts

HEAD = 150_000
SEEDS = 1000
CLASSES = 40
#: Weight, in tokens, of the overall shares when a class's neighbours are smoothed.
PRIOR = 10.0
REMEMBERED = 300_000
#: Events that a worker holds before it counts them, and those that it counts into one batch, so that no batch is large on either side.
HELD = 2_000_000
PIECE = 50_000
#: Stands between documents; no word holds white space.
END = b"\n"


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = [pa.binary(), pa.int64()]
    found: Counter = Counter()

    def out() -> pa.RecordBatch:
        row = pa.RecordBatch.from_arrays([pa.array(list(found), kind[0]), pa.array(list(found.values()), kind[1])], names=["word", "c"])
        found.clear()
        return row

    for batch in batches:
        for i in range(0, batch.num_rows, 500):
            for t in batch.column(0).slice(i, 500).cast(pa.binary()).to_pylist():
                found.update(t.lower().split())
            if len(found) > REMEMBERED:
                yield out()
    yield out()


class _Numbers(dict):
    """Numbers of words: those given come first, then the end, then others in order of appearance."""

    def __init__(self, lead: list[bytes]):
        super().__init__((w, i) for i, w in enumerate([*lead, END]))
        self.lead = len(lead)
        self.others: list[bytes] = []

    def __missing__(self, word: bytes) -> int:
        self.others.append(word)
        n = self[word] = self.lead + len(self.others)
        return n

    def forget(self) -> None:
        for w in self.others:
            del self[w]
        self.others.clear()


def _sequences(batches: Iterator[pa.RecordBatch], numbers: _Numbers, grow: bool = True, texts: int = 1000) -> Iterator[np.ndarray]:
    """Numbers of the tokens of some documents, an end before the first and after each; unless they grow, words without a number share the next one."""
    number, other = numbers.__getitem__, repeat(numbers.lead + 1)
    for batch in batches:
        for i in range(0, batch.num_rows, texts):
            row = [numbers.lead]
            for t in batch.column(0).slice(i, texts).cast(pa.binary()).to_pylist():
                row.extend(map(number, t.lower().split()) if grow else map(numbers.get, t.lower().split(), other))
                row.append(numbers.lead)
            yield np.array(row, dtype=np.int64)


_TABLE = "pair long, n long"
_EVENTS = "word binary, symbol int, n long"


def _pairs(seeds: list[bytes]):
    """Counts of adjacent symbols: the seeds, all other words, the end."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = _Numbers(seeds)
        size = len(seeds) + 2
        total = np.zeros(size * size, np.int64)
        # The end comes right after the seeds in the numbers; as a symbol it is the last.
        symbol = np.array([*range(len(seeds)), size - 1, size - 2])
        for a in _sequences(batches, numbers, grow=False):
            a = symbol[a]
            total += np.bincount(a[:-1] * size + a[1:], minlength=size * size)
        at = np.flatnonzero(total)
        for i in range(0, len(at), PIECE):
            part = at[i : i + PIECE]
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.int64()), pa.array(total[part], pa.int64())], names=["pair", "n"])

    return run


class _Events:
    """Counts of ``(other word, symbol)``, handed out as rows ``word, symbol, n`` when they are many."""

    def __init__(self, numbers: _Numbers, symbols: int):
        self.numbers, self.symbols = numbers, symbols
        self.codes: list[np.ndarray] = []
        self.held = 0

    def add(self, numbers: np.ndarray, symbols: np.ndarray) -> None:
        codes = (numbers - self.numbers.lead - 1) * self.symbols + symbols
        self.codes.append(codes.astype(np.int32) if len(self.numbers.others) * self.symbols < 2**31 else codes)
        self.held += len(numbers)

    def full(self) -> bool:
        return self.held > HELD or len(self.numbers.others) > REMEMBERED

    def rows(self) -> Iterator[pa.RecordBatch]:
        """All counts, in batches; read to the end before more is added."""
        codes = np.concatenate([np.zeros(0, np.int32), *self.codes])
        self.codes.clear()
        self.held = 0
        codes.sort()
        words = pa.array(self.numbers.others, pa.binary())
        self.numbers.forget()
        at = 0
        while at < len(codes):
            to = int(codes.searchsorted(codes[min(at + PIECE, len(codes)) - 1], "right"))  # equal codes stay together
            part = codes[at:to]
            first = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
            found = part[first]
            yield pa.RecordBatch.from_arrays(
                [words.take(pa.array(found // self.symbols)), pa.array(found % self.symbols, pa.int32()), pa.array(np.diff(first, append=len(part)), pa.int64())],
                names=["word", "symbol", "n"],
            )
            at = to


def _neighbours(seeds: list[bytes], of: np.ndarray, classes: int):
    """Seeds' classes, and the end, beside every other word: before it, and after it from ``classes + 2`` on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = _Numbers(seeds)
        other, size = classes, classes + 2
        symbol = np.array([*of, size - 1, other])
        events = _Events(numbers, 2 * size)
        for a in _sequences(batches, numbers):
            kinds = symbol[np.minimum(a, len(seeds) + 1)]
            mine = np.flatnonzero(a > len(seeds))
            before, after = kinds[mine - 1], kinds[mine + 1]
            events.add(a[mine[before != other]], before[before != other])
            events.add(a[mine[after != other]], size + after[after != other])
            if events.full():
                yield from events.rows()
        yield from events.rows()

    return run


def neighbour_logs(table: np.ndarray, classes: int) -> np.ndarray:
    """``[symbol, class]``: log of a symbol's share before a class, and, below, after it."""
    share_before = (table.sum(1) + 0.5) / (table.sum() + 0.5 * len(table))
    share_after = (table.sum(0) + 0.5) / (table.sum() + 0.5 * len(table))
    before = (table[:, :classes] + PRIOR * share_before[:, None]) / (table[:, :classes].sum(0) + PRIOR)
    after = (table[:classes] + PRIOR * share_after) / (table[:classes].sum(1, keepdims=True) + PRIOR)
    return np.log(np.concatenate([before, after.T]))


def _assign(logs: np.ndarray):
    """Adds the class ``k`` to rows ``word, c, symbols, ns``; neighbours that no row counts are other words."""
    size = len(logs) // 2
    other = size - 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 500):
                part = batch.slice(i, 500)
                symbols, ns = part.column(2), part.column(3)
                sizes = np.diff(symbols.offsets.to_numpy())
                symbol, n = symbols.flatten().to_numpy(), ns.flatten().to_numpy().astype(float)
                row = np.repeat(np.arange(part.num_rows), sizes)
                c = part.column(1).to_numpy().astype(float)
                score = np.zeros((part.num_rows, logs.shape[1]))
                np.add.at(score, row, n[:, None] * logs[symbol])
                for side in (0, 1):
                    known = np.bincount(row, weights=n * (symbol // size == side), minlength=part.num_rows)
                    score += (c - known)[:, None] * logs[side * size + other]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(score.argmax(1), pa.int32())], names=["word", "c", "k"])

    return run


def _follows(head: list[bytes], kind: np.ndarray, classes: int):
    """Rows ``word, symbol, n``: histories of rare words, and, without a word, codes of history and class of head words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = _Numbers(head)
        rare, size = classes, classes + 2
        symbol = np.array([*kind, size - 1, rare])
        total = np.zeros(size * size, np.int64)
        events = _Events(numbers, size)
        for a in _sequences(batches, numbers):
            kinds = symbol[np.minimum(a, len(head) + 1)]
            before, now = kinds[:-1], kinds[1:]
            total += np.bincount(before * size + now, minlength=size * size)
            at = np.flatnonzero(now == rare)
            events.add(a[1:][at], before[at])
            if events.full():
                yield from events.rows()
        yield from events.rows()
        total = total.reshape(size, size)
        total[:, rare] = 0
        at = np.flatnonzero(total.ravel())
        yield pa.RecordBatch.from_arrays([pa.nulls(len(at), pa.binary()), pa.array(at, pa.int32()), pa.array(total.ravel()[at], pa.int64())], names=["word", "symbol", "n"])

    return run


def exchange_classes(pairs: np.ndarray, words: int, classes: int) -> np.ndarray:
    """Class of every symbol; symbols from ``words`` on keep a class of their own.

    ``pairs[a, b]`` counts symbol b after symbol a.  The objective is the class-bigram likelihood.
    """

    def f(x: np.ndarray) -> np.ndarray:
        return x * np.log(np.maximum(x, 1.0))

    symbols = len(pairs)
    classes = max(1, min(classes, words))
    of = np.concatenate([np.arange(words) % classes, classes + np.arange(symbols - words)])
    n = classes + symbols - words
    one = np.zeros((symbols, n))
    one[np.arange(symbols), of] = 1
    table = one.T @ pairs @ one
    least = 1e-12 * float(f(pairs.sum()))  # well above the rounding of a gain at any number of tokens
    moved = 1
    while moved:  # every move raises the likelihood, so this ends
        moved = 0
        for w in range(words):
            own = of[w]
            itself = pairs[w, w]
            after = np.bincount(of, weights=pairs[w], minlength=n)
            before = np.bincount(of, weights=pairs[:, w], minlength=n)
            after[own] -= itself
            before[own] -= itself
            # Take the word out of its class, then gain of putting it into each class.
            table[own] -= after
            table[:, own] -= before
            table[own, own] -= itself
            rows, cols = table[:classes], table[:, :classes].T
            i = np.arange(classes)
            gain = (f(rows + after) - f(rows)).sum(1) + (f(cols + before) - f(cols)).sum(1)
            diagonal = table[i, i]
            gain -= f(diagonal + after[i]) + f(diagonal + before[i]) - 2 * f(diagonal)
            gain += f(diagonal + after[i] + before[i] + itself) - f(diagonal)
            # A class's tokens, counted with the word out of its class but still beside their neighbours.
            left, right = rows.sum(1) + before[:classes], cols.sum(1) + after[:classes]
            gain -= f(left + after.sum() + itself) - f(left) + f(right + before.sum() + itself) - f(right)
            best = int(gain.argmax())
            if gain[best] <= gain[own] + least:
                best = own
            moved += best != own
            of[w] = best
            table[best] += after
            table[:, best] += before
            table[best, best] += itself
    return of


def _score(model: dict):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, of, base, emit, step = model["place"], model["class"], model["base"], model["emit"], model["step"]
        end = len(step) - 1
        rare = end - 1
        get = place.get
        for batch in batches:
            for i in range(0, batch.num_rows, 500):
                part = batch.slice(i, 500)
                n, known, low, high, words_out, histories, times = [], [], [], [], [], [], []
                for t in part.column(2).cast(pa.binary()).to_pylist():
                    words = t.lower().split()
                    at = np.array([get(w, -1) for w in words], dtype=np.int64)
                    seen = at >= 0
                    kinds = np.where(seen, of[at], rare)
                    path = np.concatenate([[end], kinds, [end]])
                    inside = at[seen]
                    follows = np.concatenate([kinds != rare, [True]])
                    n.append(len(words) + 1)
                    known.append(len(inside) + model["end_known"])
                    low.append(float(base[inside].sum()) + model["end_base"])
                    high.append(float(emit[inside].sum() + step[path[:-1][follows], path[1:][follows]].sum()))
                    few = Counter((words[j], int(path[j])) for j in np.flatnonzero(~seen))
                    words_out.append([w for w, _ in few])
                    histories.append([h for _, h in few])
                    times.append(list(few.values()))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(n, pa.int64()), pa.array(known, pa.int64()), pa.array(low, pa.float64()), pa.array(high, pa.float64()), pa.array(words_out, pa.list_(pa.binary())), pa.array(histories, pa.list_(pa.int32())), pa.array(times, pa.list_(pa.int64()))],
                    names=["doc_id", "held_out", "n_tokens", "known", "low", "high", "rare", "history", "times"],
                )

    return run


def word_classes(train: DataFrame, counts: DataFrame, seeds: list[bytes], classes: int) -> tuple[np.ndarray, DataFrame]:
    """Classes of the seeds, and ``word, c, k`` of every other word (written)."""
    spark, size = train.sparkSession, len(seeds) + 2
    found = train.mapInArrow(lean(_pairs(seeds)), _TABLE).groupBy("pair").agg(F.sum("n").alias("n")).toArrow()  # at most size * size rows
    pairs = np.zeros(size * size)
    pairs[found.column("pair").to_numpy()] = found.column("n").to_numpy()
    of = exchange_classes(pairs.reshape(size, size), len(seeds), classes)
    one = np.zeros((size, classes + 2))
    one[np.arange(size), np.where(np.arange(size) < len(seeds), of, classes + np.arange(size) - len(seeds))] = 1
    logs = neighbour_logs(one.T @ pairs.reshape(size, size) @ one, classes)
    of = of[: len(seeds)]
    beside = train.mapInArrow(lean(_neighbours(seeds, of, classes)), _EVENTS).groupBy("word", "symbol").agg(F.sum("n").alias("n"))
    # At most two rows for each class and word.
    beside = beside.groupBy("word").agg(F.collect_list(F.struct("symbol", "n")).alias("x")).select("word", F.col("x.symbol").alias("symbols"), F.col("x.n").alias("ns"))
    none = F.array()
    lead = spark.createDataFrame([(bytearray(w),) for w in seeds], "word binary")
    others = counts.join(F.broadcast(lead), "word", "left_anti").join(beside, "word", "left")  # at most ``SEEDS`` rows
    others = others.select("word", "c", F.coalesce("symbols", none.cast("array<int>")).alias("symbols"), F.coalesce("ns", none.cast("array<bigint>")).alias("ns"))
    return of, materialize(others.mapInArrow(lean(_assign(logs)), "word binary, c long, k int"), "classes")


def lm_scores(docs: DataFrame, clustered: int = SEEDS, classes: int = CLASSES, head: int = HEAD) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, perplexity``.

    ``clustered`` is the number of seeds; ``classes`` of them, at most, are the classes of all words.
    """
    spark = docs.sparkSession
    docs = whole_texts(docs).withColumn("held_out", id_remainder(F.col("doc_id"), 10) == 0)
    train = docs.where(~F.col("held_out")).select("text")
    counts = train.mapInArrow(lean(_count), "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))
    counts = materialize(counts, "words")
    trained = train.count()
    words, vocabulary = counts.agg(F.sum("c"), F.count("*")).first()
    tokens = (words or 0) + trained
    types = vocabulary + (1 if trained else 0)
    # The least count whose words fit the head, from a histogram over 1/8 octaves.
    octave = F.floor(F.log2("c") * 8).cast("int")
    histogram = counts.groupBy(octave.alias("o")).agg(F.count("*").alias("v"), F.min("c").alias("c")).orderBy(F.desc("o")).collect()
    least, room = 2**62, head
    for r in histogram:
        room -= r["v"]
        if room < 0:
            break
        least = r["c"]
    first = counts.where(F.col("c") >= least).orderBy(F.desc("c"), "word").limit(clustered).collect()  # the seeds
    seeds = [bytes(r["word"]) for r in first]
    classes = max(1, min(classes, len(seeds)))
    of, others = word_classes(train, counts, seeds, classes)
    top = others.where(F.col("c") >= least).toArrow()  # at most ``head`` rows
    order = [*zip(seeds, (r["c"] for r in first), of.tolist()), *sorted(zip(top.column("word").to_pylist(), top.column("c").to_pylist(), top.column("k").to_pylist()), key=lambda x: (-x[1], x[0]))]
    names, c, kind = [w for w, _, _ in order], np.array([n for _, n, _ in order], dtype=float), np.array([k for _, _, k in order], dtype=np.int64)
    # Class bigrams: of the head's words from the workers, of rarer words through their classes.
    size = classes + 2
    rare_words = others.where(F.col("c") < least)
    follows = materialize(train.mapInArrow(lean(_follows(names, kind, classes)), _EVENTS).groupBy("word", "symbol").agg(F.sum("n").alias("n")), "follows")
    code = F.when(F.col("word").isNull(), F.col("symbol")).otherwise(F.col("symbol") * size + F.col("k"))
    found = follows.join(rare_words.select("word", "k"), "word", "left").groupBy(code.alias("code")).agg(F.sum("n").alias("n")).collect()  # at most size * size rows
    table = np.zeros(size * size)
    for r in found:
        table[r["code"]] = r["n"]
    table = table.reshape(size, size)
    live = [k for k in range(size) if k != classes]  # nothing is followed by the symbol of all rare words
    share = np.zeros(size)
    share[live] = (table.sum(0)[live] + 0.5) / (table.sum() + 0.5 * len(live))
    chance = (table + PRIOR * share) / (table.sum(1, keepdims=True) + PRIOR)
    # Tokens, and words seen once, of each class.
    of_class, once = np.zeros(classes), np.zeros(classes)
    for r in others.groupBy("k").agg(F.sum("c").alias("n"), F.sum((F.col("c") == 1).cast("long")).alias("once")).collect():
        of_class[r["k"]], once[r["k"]] = r["n"], r["once"]
    np.add.at(of_class, of, [r["c"] for r in first])
    np.add.at(once, of, [r["c"] == 1 for r in first])
    unseen = (once + 1) / (of_class + 2)
    with np.errstate(divide="ignore"):
        step = np.log10(chance)
        seen_share = np.log10((1 - unseen) / np.maximum(of_class, 1))
    floor = tokens + 0.1 * (types + 1)
    model = {
        "place": {w: i for i, w in enumerate(names)},
        "class": kind if len(kind) else np.zeros(1, np.int64),
        "base": np.log10((c + 0.1) / floor),
        "emit": np.log10(c) + seen_share[kind] if len(c) else c,
        "step": step,
        "end_known": int(trained > 0),
        "end_base": float(np.log10((trained + 0.1) / floor)),
    }
    scored = docs.select("doc_id", "held_out", "text").mapInArrow(
        lean(_score(model)), "doc_id long, held_out boolean, n_tokens long, known long, low double, high double, rare array<binary>, history array<int>, times array<long>"
    )
    scored = materialize(scored.withColumn("row", F.monotonically_increasing_id()), "scored")
    tail = scored.select("row", F.explode(F.arrays_zip("rare", "history", "times")).alias("x")).select("row", F.col("x.rare").alias("word"), F.col("x.history").alias("history"), F.col("x.times").alias("times"))
    tail = tail.join(rare_words, "word", "left").withColumn("k", F.coalesce("k", F.lit(-1)))
    # What a history gives a word of a class besides its count, and, as class -1, an unseen word.
    gives = [(h, k, float(step[h, k] + seen_share[k])) for h in range(size) for k in range(classes)] + [(h, -1, float(np.log10(chance[h, :classes] @ unseen))) for h in range(size)]
    gives = spark.createDataFrame(gives, "history int, k int, gives double")
    tail = tail.join(F.broadcast(gives), ["history", "k"])  # a row for each pair of classes
    seen = F.col("c").isNotNull()
    low = F.log10((F.coalesce("c", F.lit(0)) + 0.1) / F.lit(float(floor)))
    high = F.col("gives") + F.when(seen, F.log10("c")).otherwise(0.0)
    sums = tail.groupBy("row").agg(F.sum(F.when(seen, F.col("times")).otherwise(0)).alias("more_known"), F.sum(low * F.col("times")).alias("more_low"), F.sum(high * F.col("times")).alias("more_high"))
    out = scored.drop("rare", "history", "times").join(sums, "row", "left")
    score = F.col("high") + F.coalesce("more_high", F.lit(0.0))
    drop_materialized(follows, counts)
    return out.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(int(tokens)).cast("long").alias("train_tokens"),
        (F.col("low") + F.coalesce("more_low", F.lit(0.0))).alias("base_score"),
        score.alias("score"),
        F.pow(F.lit(10.0), -score / F.col("n_tokens")).alias("perplexity"),
    )
