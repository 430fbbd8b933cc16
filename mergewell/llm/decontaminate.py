"""Benchmark decontamination: exact bounds on words, then Smith-Waterman alignment.

A document and an item are aligned by words (Smith-Waterman with linear gaps); the score is the best local
alignment over the item's length, so edited and paraphrased copies score as much as they share.  No seeds choose
the pairs: a pair is passed over only where one of two bounds shows that its score can't reach the threshold.
The score is at most the words that both have, counted with repeats; and at most the best stretch of the
document, each of its words counting as a match if the item has it anywhere, else as the least loss.

Scale: a document is read once, where it lies.  Items go to the workers in blocks of about ``BLOCK_WORDS``
words, one block after another, so neither side's size is assumed; texts are never shuffled.  What leaves a
worker is a row per matching document.  Nothing is capped: a passage that a third of all documents share is
that many rows.

Defined results: a null text is empty and never contaminated; items with fewer than three words match
nothing; items of up to ``SHORT`` words must be matched in whole; repeated items count each, the
least item id wins a tie; rows that share id and text share the result; an empty benchmark or an
empty table gives clean or no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, packed

LEAST_WORDS = 3
SHORT = 8
BLOCK_WORDS = 300_000
THRESHOLD = 0.5
MATCH, MISMATCH, GAP = 1.0, -0.5, -0.5
REMEMBERED = 100_000
#: Places of a document times items whose bounds are computed at once.
CELLS = 1_000_000
#: Rows of a hit table up to which it is broadcast; a row is an id and a hash.
BROADCAST_HITS = 200_000
_EDGE = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum())


def bare(word: bytes) -> str:
    return word.decode(errors="replace").lower().strip(_EDGE)


class _Numbers(dict):
    """Number of a raw word in a vocabulary of bare words: -1 outside it, -2 for punctuation alone."""

    def __init__(self, vocabulary: dict[str, int]):
        self.vocabulary = vocabulary

    def __missing__(self, word: bytes) -> int:
        w = bare(word)
        n = self.vocabulary.get(w, -1) if w else -2
        if len(self) < REMEMBERED:
            self[word] = n
        return n


class Items:
    """A block of test items as numbers; each word is posted with the items that hold it, and how often."""

    def __init__(self, rows: list[tuple[int, str]]):
        self.vocabulary: dict[str, int] = {}
        self.ids, self.words = [], []
        for item, text in rows:
            w = [b for b in map(bare, text.encode().split()) if b]
            if len(w) >= LEAST_WORDS:
                self.ids.append(item)
                self.words.append(np.array([self.vocabulary.setdefault(x, len(self.vocabulary)) for x in w], dtype=np.int64))
        self.lengths = np.array([len(w) for w in self.words], dtype=np.int64)
        n = max(1, len(self.words))
        owners = np.repeat(np.arange(len(self.words)), self.lengths)
        pairs, self.times = np.unique(np.concatenate([np.zeros(0, np.int64), *self.words]) * n + owners, return_counts=True)
        self.posted = pairs % n
        self.starts = np.searchsorted(pairs // n, np.arange(len(self.vocabulary) + 1))

    def needed(self, threshold: float) -> np.ndarray:
        """Score from which each item counts as held."""
        return np.where(self.lengths <= SHORT, self.lengths, threshold * self.lengths) - 1e-9


def numbered(text: bytes, numbers: _Numbers) -> np.ndarray:
    n = np.array(list(map(numbers.__getitem__, text.split())), dtype=np.int64)
    return n[n != -2]


def align(item: np.ndarray, passage: np.ndarray) -> tuple[float, int]:
    """Best local alignment score, and where it ends in the passage."""
    n = len(passage)
    slope = -GAP * np.arange(n + 1)
    row = np.zeros(n + 1)
    best, end = 0.0, 0
    for w in item:
        step = np.maximum(row + GAP, 0.0)
        np.maximum(step[1:], row[:-1] + np.where(passage == w, MATCH, MISMATCH), out=step[1:])
        row = np.maximum.accumulate(step + slope) - slope
        j = int(row.argmax())
        if row[j] > best:
            best, end = float(row[j]), j
    return best, end


def within_reach(numbers: np.ndarray, items: Items, needed: np.ndarray) -> np.ndarray:
    """Items whose score in a document may be ``needed``; every other item's is surely less."""
    inside = np.flatnonzero(numbers >= 0)
    words, local, held = np.unique(numbers[inside], return_inverse=True, return_counts=True)
    sizes = items.starts[words + 1] - items.starts[words]
    word = np.repeat(np.arange(len(words)), sizes)
    at = np.arange(len(word)) + np.repeat(items.starts[words] - np.cumsum(sizes) + sizes, sizes)
    item = items.posted[at]
    common = np.bincount(item, weights=np.minimum(items.times[at], held[word]), minlength=len(items.ids))
    near = np.flatnonzero((common > 0) & (MATCH * common >= needed))
    if not len(near):
        return near
    place = np.full(len(numbers), len(words))
    place[inside] = local
    rank = np.full(len(items.ids), -1)
    rank[near] = np.arange(len(near))
    known = rank[item] >= 0
    row, word = rank[item[known]], word[known]
    order = np.argsort(row, kind="stable")
    row, word = row[order], word[order]
    best, rows = np.zeros(len(near)), max(1, CELLS // len(numbers))
    for i in range(0, len(near), rows):
        a, b = np.searchsorted(row, (i, i + rows))
        gain = np.full((min(rows, len(near) - i), len(words) + 1), max(MISMATCH, GAP), dtype=np.float32)
        gain[row[a:b] - i, word[a:b]] = MATCH
        total = gain[:, place].cumsum(axis=1, dtype=np.float64)
        best[i : i + rows] = (total - np.minimum(np.minimum.accumulate(total, axis=1), 0.0)).max(axis=1)
    return near[best >= needed[near]]


def matches(numbers: np.ndarray, items: Items, needed: np.ndarray) -> list[tuple[int, float, int]]:
    """``(item id, score, end)`` of the items that a document holds."""
    out = []
    for k in within_reach(numbers, items, needed).tolist():
        best, end = align(items.words[k], numbers)
        if best >= needed[k]:
            out.append((items.ids[k], best / len(items.words[k]), end))
    return out


def _align_all(items: Items, threshold: float):
    needed = items.needed(threshold)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = _Numbers(items.vocabulary)
        for batch in batches:
            rows = []
            for i in range(0, batch.num_rows, 500):
                part = batch.slice(i, 500)
                for doc, key, t in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), part.column(2).cast(pa.binary()).to_pylist()):
                    found = matches(numbered(t, numbers), items, needed)
                    if found:
                        item, score, end = min(found, key=lambda x: (-x[1], x[0]))
                        rows.append((doc, key, item, score, end, len(found)))
            kinds = (("doc_id", pa.int64()), ("key", pa.int64()), ("item_id", pa.int64()), ("score", pa.float64()), ("end", pa.int64()), ("n_items", pa.int64()))
            yield pa.RecordBatch.from_pydict({c: pa.array([r[i] for r in rows], t) for i, (c, t) in enumerate(kinds)})

    return run


def text_key() -> Column:
    return F.xxhash64(F.coalesce(F.col("text"), F.lit("")))


def contaminated(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Hits, one row per id and text: ``doc_id, key, item_id, score, end_word, n_items`` (written)."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_key().alias("key"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").where("text is not null")
    words = items.agg(F.sum(F.size(F.split("text", r"\s+")))).first()[0] or 0
    blocks = max(1, -(-words // block_words))
    hits = None
    for b in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b).orderBy("item_id", "text").collect()  # one block
        block = Items([(r[0], r[1]) for r in rows])
        if not block.ids:
            continue
        found = docs.mapInArrow(_align_all(block, threshold), "doc_id long, key long, item_id long, score double, end long, n_items long")
        hits = found if hits is None else hits.unionAll(found)
    if hits is None:
        hits = docs.sparkSession.createDataFrame([], "doc_id long, key long, item_id long, score double, end long, n_items long")
    best = F.min(F.struct((-F.col("score")).alias("less"), "item_id", "end")).alias("best")
    # A block's hit of a repeated row is repeated too; distinct keeps one.
    one = hits.distinct().groupBy("doc_id", "key").agg(best, F.sum("n_items").alias("n_items"))
    return materialize(one.select("doc_id", "key", F.col("best.item_id").alias("item_id"), (-F.col("best.less")).alias("score"), F.col("best.end").alias("end_word"), "n_items"), "hits")


def _side(hits: DataFrame) -> DataFrame:
    return F.broadcast(hits) if hits.count() <= BROADCAST_HITS else hits


def decontamination(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``doc_id, contaminated, item_id, score, n_items``, a row per row of ``docs``."""
    hits = _side(contaminated(docs, benchmark, threshold, block_words)).alias("h")
    all_docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_key().alias("key")).alias("d")
    out = all_docs.join(hits, F.col("d.doc_id").eqNullSafe(F.col("h.doc_id")) & (F.col("d.key") == F.col("h.key")), "left")
    return out.select("d.doc_id", F.col("h.key").isNotNull().alias("contaminated"), "item_id", F.coalesce("score", F.lit(0.0)).alias("score"), F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"))


def clean_documents(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that hold no test item, with all their columns, whatever their names."""
    hits = _side(contaminated(docs, benchmark, threshold).select(F.col("doc_id").alias("hit_id"), F.col("key").alias("hit_key")))
    rows = packed(docs, F.col("doc_id").cast("long").alias("id"), text_key().alias("key"))
    return rows.join(hits, F.col("id").eqNullSafe(F.col("hit_id")) & (F.col("key") == F.col("hit_key")), "left_anti").select("row.*")
