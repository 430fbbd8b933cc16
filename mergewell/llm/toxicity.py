"""Toxicity scores from class-conditional Kneser-Ney bigram models.

One model is counted on toxic documents, one on ordinary ones.  A bigram backs off to its word, a word to
its first six letters, these to the first four.  Each class discounts its own counts by ``DISCOUNT``, and what
that takes goes to the lower order; the lowest order is shared by both classes and counts continuations: in how
many distinct bigrams of either class the words below a prefix end.  Each expression's class estimates are mixed
(log-linearly) with the backoff by the posterior probability that the classes differ in it at all: a beta-binomial
split of its documents against the split of its history, with prior odds of one to the number of expressions; where
the evidence is not for a difference, the backoff holds, as for every expression of one document.  So a rare
expression says little more than its backoff, without a least count.  A document counts an expression once, and
texts that repeat count once.  A document's score is a logistic curve over the difference of its
length-normalised log-likelihoods, fitted by two-fold cross-scoring, so that no document calibrates a model that has counted it.

Scale: the classifier learns from a bounded sample of labelled rows (``SAMPLE``, dealt by a hash of the
id), whose ids are the only thing broadcast; the models are estimated in Spark, and the driver gets only
expressions of that sample whose log ratio differs by ``DIGITS`` from their backoff's.  Scoring is one pass that leaves
texts where they are.

Defined results: a null or empty text has no evidence and gets the curve's value at 0; with no label,
or labels of one class only, every score is the share of toxic labels (0 without labels); ids with
labels that differ count as toxic; null ids and null labels teach nothing; a score at the threshold is predicted
toxic; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import drop_materialized, forget, id_remainder, materialize, whole_texts

SAMPLE = 20_000
#: Taken off every count of a class; what it takes is dealt by the lower order.
DISCOUNT = 0.75
#: Weight, in documents, of the history's split when an expression's own is estimated.
STRENGTH = 2.0
#: Log ratios nearer than this to their backoff's are taken for equal.
DIGITS = 1e-3
THRESHOLD = 0.3
REMEMBERED = 100_000
_EDGE = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum())


#: Lengths of the prefixes that a word backs off to, longest first.
PREFIXES = (6, 4)


def word_nodes(word: bytes) -> tuple[int, ...]:
    """64-bit ids of a word, without case and outer punctuation, and of its prefixes; 0 for punctuation alone."""
    bare = word.decode(errors="replace").lower().strip(_EDGE)
    if not bare:
        return (0,) * (1 + len(PREFIXES))
    return tuple(xxhash.xxh3_64_intdigest(x) - 2**63 for x in (bare, *(f"{k}<{bare[:k]}" for k in PREFIXES)))


class _Ids(dict):
    def __missing__(self, word: bytes) -> tuple[int, ...]:
        n = word_nodes(word)
        if len(self) < REMEMBERED:
            self[word] = n
        return n


#: Above the shortest prefixes, and before the first word.
ROOT, START = 1, 2
#: Kinds of counts: what follows a word, and what stands below a prefix, the shortest prefix last.
BIGRAM, WORD = 0, 1


def _distinct(*columns: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """The distinct rows of some columns, and how often each stands there."""
    order = np.lexsort(columns[::-1])
    columns = [c[order] for c in columns]
    new = np.ones(len(order), bool)
    new[1:] = False
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    at = np.flatnonzero(new)
    return [c[at] for c in columns], np.diff(at, append=len(order))


def _grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows ``(kind, h, w, slot, n)``: what follows a word, and what stands below a prefix, by class and fold."""
    forget()
    ids, held = _Ids(), []

    def out() -> pa.RecordBatch:
        (kind, h, w, slot), n = _distinct(*(np.concatenate(c) for c in zip(*held)))
        held.clear()
        return pa.RecordBatch.from_arrays([pa.array(kind, pa.int32()), pa.array(h), pa.array(w), pa.array(slot, pa.int32()), pa.array(n, pa.int64())], names=["kind", "h", "w", "slot", "n"])

    for batch in batches:
        for i in range(0, batch.num_rows, 50):
            part = batch.slice(i, 50)
            paths = [_ids_of(t, ids) for t in part.column(0).cast(pa.binary()).to_pylist()]
            slots = np.array([2 * fold + (0 if toxic else 1) for toxic, fold in zip(part.column(1).to_pylist(), part.column(2).to_pylist())], dtype=np.int8)
            sizes = np.array([len(p) for p in paths])
            doc, path = np.repeat(np.arange(len(paths)), sizes), np.concatenate(paths)
            before = np.roll(path[:, 0], 1)
            before[(np.cumsum(sizes) - sizes)[sizes > 0]] = START
            columns = [*path.T, np.full(len(path), ROOT)]
            pairs = [(before, path[:, 0]), *zip(columns[1:], columns)]
            for kind, (h, w) in enumerate(pairs):  # ``BIGRAM``, then ``WORD`` and its prefixes
                (d, h, w), _ = _distinct(doc, h, w)  # a document counts it once
                held.append((np.full(len(d), kind, np.int8), h, w, slots[d]))
            if sum(len(k) for k, *_ in held) > 500_000:
                yield out()
    if held:
        yield out()


def _log_gamma(x: Column) -> Column:
    """Stirling's series after seven steps up."""
    z = x + 7
    out = (z - 0.5) * F.log(z) - z + 0.9189385332046727 + 1 / (12 * z) - 1 / (360 * z * z * z)
    for i in range(7):
        out = out - F.log(x + i)
    return out


def _evidence(t: Column, o: Column, all_t: Column, all_o: Column) -> Column:
    """Log Bayes factor of a split of its own (beta-binomial) against the split ``all_t, all_o``."""
    q = all_t / (all_t + all_o)
    a, b, s = q * STRENGTH, (1 - q) * STRENGTH, F.lit(STRENGTH)
    own = _log_gamma(t + a) - _log_gamma(a) + _log_gamma(o + b) - _log_gamma(b) - _log_gamma(t + o + s) + _log_gamma(s)
    return F.when((all_t > 0) & (all_o > 0), own - t * F.log(q) - o * F.log(1 - q)).otherwise(0.0)


#: The models: one of each fold's other half, and one of all.
FITS = ((1,), (0,), (0, 1))


def class_ratios(grams: DataFrame) -> DataFrame:
    """``fit, kind, h, w, ratio, lower``: log ratio of the classes for nodes and bigrams of every model, and that of the backoff."""
    sums = [F.struct(F.lit(i).alias("fit"), sum(F.col(f"t{f}") for f in folds).cast("double").alias("t"), sum(F.col(f"o{f}") for f in folds).cast("double").alias("o")) for i, folds in enumerate(FITS)]
    used = grams.select("kind", "h", "w", F.explode(F.array(*sums)).alias("x")).select("x.fit", "kind", "h", "w", "x.t", "x.o").where("t + o > 0")
    taken = lambda c: F.sum(F.least(c, F.lit(DISCOUNT)))
    above = used.groupBy("fit", "kind", "h").agg(F.sum("t").alias("all_t"), F.sum("o").alias("all_o"), taken("t").alias("taken_t"), taken("o").alias("taken_o"), F.count("*").alias("children"))
    above = materialize(above, "histories")
    sizes = above.groupBy("fit", "kind").agg(F.sum("children").alias("expressions"))

    def weighed(rows: DataFrame) -> DataFrame:
        """``rows`` with their history's counts and ``sure``, the probability that the classes differ."""
        rows = rows.join(above.drop("children"), ["fit", "kind", "h"]).join(F.broadcast(sizes), ["fit", "kind"])  # a row for each model and kind
        evidence = F.when((F.col("t") + F.col("o") > 1) & (F.col("all_t") > 0) & (F.col("all_o") > 0), _evidence(F.col("t"), F.col("o"), F.col("all_t"), F.col("all_o"))).otherwise(0.0)
        return rows.withColumn("evidence", evidence).withColumn("sure", F.when(F.col("evidence") > 1e-6, 1 / (1 + F.col("expressions") * F.exp(-F.col("evidence")))).otherwise(0.0))

    def log_share(c: str, low: Column) -> Column:
        """Log of the class's discounted estimate, mixed with the log of ``low``."""
        kneser_ney = (F.greatest(F.col(c) - DISCOUNT, F.lit(0.0)) + F.col(f"taken_{c}") * F.exp(low)) / F.col(f"all_{c}")
        return F.when(F.col("sure") > 0, F.col("sure") * F.log(kneser_ney) + (1 - F.col("sure")) * low).otherwise(low)

    # Continuations: distinct bigrams that end in the words below a node.
    ends = used.where(F.col("kind") == BIGRAM).groupBy("fit", "w").agg(F.count("*").alias("n"))
    levels = []
    for k in range(len(PREFIXES) + 1):
        edges = materialize(used.where(F.col("kind") == WORD + k).join(ends, ["fit", "w"]), "nodes")
        levels.append(edges)
        ends = edges.groupBy("fit", F.col("h").alias("w")).agg(F.sum("n").alias("n"))
    told, parent = [], ends.select("fit", F.col("w").alias("h"), F.col("n").alias("of"), F.lit(0.0).alias("up_t"), F.lit(0.0).alias("up_o"))
    for edges in reversed(levels):
        low = F.log(F.col("n") / F.col("of"))
        level = weighed(edges).join(parent, ["fit", "h"]).select("fit", "kind", "h", "w", "n", (F.col("up_t") + log_share("t", low)).alias("pt"), (F.col("up_o") + log_share("o", low)).alias("po"), (F.col("up_t") - F.col("up_o")).alias("lower"))
        level = materialize(level, "level")
        parent = level.select("fit", F.col("w").alias("h"), F.col("n").alias("of"), F.col("pt").alias("up_t"), F.col("po").alias("up_o"))
        told.append(level.drop("n"))
    pairs = weighed(used.where((F.col("kind") == BIGRAM) & (F.col("t") + F.col("o") > 1))).where("sure > 0")
    pairs = pairs.join(parent.select("fit", F.col("h").alias("w"), "up_t", "up_o"), ["fit", "w"])
    told.append(pairs.select("fit", "kind", "h", "w", log_share("t", F.col("up_t")).alias("pt"), log_share("o", F.col("up_o")).alias("po"), (F.col("up_t") - F.col("up_o")).alias("lower")))
    out = told[0]
    for more in told[1:]:
        out = out.unionByName(more)
    return out.select("fit", "kind", "h", "w", (F.col("pt") - F.col("po")).alias("ratio"), "lower")


def _codes(h: np.ndarray, w: np.ndarray) -> np.ndarray:
    """One 64-bit code for each bigram."""
    return (h.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) ^ (w.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F) + np.uint64(1))


class KneserNey:
    """Log-likelihood ratios of the two class models, for the nodes of words and for bigrams."""

    def __init__(self, kind: np.ndarray, h: np.ndarray, w: np.ndarray, ratio: np.ndarray):
        node = kind != BIGRAM
        order = np.argsort(w[node])
        self.nodes, self.ratio = w[node][order], ratio[node][order]
        code = _codes(h[~node], w[~node])
        order = np.argsort(code)
        self.code, self.pair = code[order], ratio[~node][order]

    def document(self, paths: np.ndarray) -> tuple[float, int]:
        """Sum of the ratios over the words, a row of ids each, and their number."""
        n = len(paths)
        if not n:
            return 0.0, 0
        ratio = np.zeros(n)
        if len(self.nodes):
            for column in range(paths.shape[1] - 1, -1, -1):  # the deepest known node holds
                at = np.minimum(np.searchsorted(self.nodes, paths[:, column]), len(self.nodes) - 1)
                ratio = np.where(self.nodes[at] == paths[:, column], self.ratio[at], ratio)
        if len(self.code):
            code = _codes(np.concatenate([[START], paths[:-1, 0]]), paths[:, 0])
            at = np.minimum(np.searchsorted(self.code, code), len(self.code) - 1)
            ratio = np.where(self.code[at] == code, self.pair[at], ratio)
        return float(ratio.sum()), n


def _features(total: float, n: int) -> tuple[float, float]:
    """Log-likelihood difference by word, and by the square root of the length."""
    return (total / n, total / n**0.5) if n else (0.0, 0.0)


def _ids_of(text: bytes, ids: _Ids) -> np.ndarray:
    found = np.array(list(map(ids.__getitem__, text.split())), dtype=np.int64).reshape(-1, 1 + len(PREFIXES))
    return found[found[:, 0] != 0]


def fit_curve(x: np.ndarray, y: np.ndarray, rounds: int = 50) -> np.ndarray:
    """Logistic regression by Newton steps with a small ridge; slopes are never negative."""
    scale = np.maximum(x.std(0), 1e-9)
    use = [0, 1]
    w = np.zeros(3)
    while True:
        a = np.column_stack([x[:, use] / scale[use], np.ones(len(x))])
        b = np.zeros(a.shape[1])
        ridge = np.full(a.shape[1], 1e-2)
        for _ in range(rounds):
            p = 1 / (1 + np.exp(-np.clip(a @ b, -30, 30)))
            grad = a.T @ (p - y) + ridge * b
            hess = (a * (p * (1 - p))[:, None]).T @ a + np.diag(ridge)
            step = np.linalg.solve(hess, grad)
            b -= np.clip(step, -2, 2)
            if abs(step).max() < 1e-8:
                break
        falling = [k for k, v in zip(use, b) if v < 0]
        if falling and len(use) > 1:
            use = [k for k in use if k not in falling] or [0]
            continue
        w[use] = b[:-1] / scale[use]
        w[2] = b[-1]
        return w


def _models(grams: DataFrame) -> list[KneserNey]:
    ratios = class_ratios(grams)
    told = ratios.where(F.abs(F.col("ratio") - F.col("lower")) > DIGITS).select("fit", "kind", "h", "w", "ratio").toArrow()  # of the sample's expressions
    columns = [told.column(c).to_numpy() for c in ("fit", "kind", "h", "w", "ratio")]
    return [KneserNey(*(c[columns[0] == i] for c in columns[1:])) for i in range(len(FITS))]


def toxicity_model(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE):
    """A function of a word-id array, or a constant; learns from ids whose remainder is not 2."""
    usable = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).where("doc_id is not null and toxic is not null")
    usable = usable.where(id_remainder(F.col("doc_id"), 4) != 2).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    usable = materialize(usable, "labels")
    rows, toxic = usable.agg(F.count("*"), F.sum("toxic")).first()
    if not rows or not toxic or toxic == rows:
        return None, float(toxic or 0) / rows if rows else 0.0
    share = min(1.0, sample / rows)
    bucket = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000))
    chosen = usable.where(bucket < int(share * 1_000_000)).select("doc_id", "toxic")
    texts = whole_texts(docs).join(F.broadcast(chosen), "doc_id").select("text", "toxic").distinct().withColumn("fold", F.pmod(F.xxhash64("text"), F.lit(2)).cast("int"))  # about ``sample`` ids at most
    slots = {f"{c}{f}": F.sum(F.when(F.col("slot") == 2 * f + k, F.col("n")).otherwise(0)) for f in (0, 1) for k, c in enumerate("to")}
    grams = materialize(texts.mapInArrow(_grams, "kind int, h long, w long, slot int, n long").groupBy("kind", "h", "w").agg(*[v.alias(k) for k, v in slots.items()]), "grams")
    *halves, model = _models(grams)
    drop_materialized(grams)

    def score_folds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        ids = _Ids()
        for batch in batches:
            out = [(*_features(*halves[fold].document(_ids_of(t, ids))), toxic) for t, toxic, fold in zip(batch.column(0).cast(pa.binary()).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist())]
            yield pa.RecordBatch.from_pydict({"a": pa.array([r[0] for r in out], pa.float64()), "b": pa.array([r[1] for r in out], pa.float64()), "y": pa.array([r[2] for r in out], pa.int32())})

    seen = texts.mapInArrow(score_folds, "a double, b double, y int").toArrow()  # about ``sample`` rows at most
    x = np.column_stack([seen.column("a").to_numpy(), seen.column("b").to_numpy()])
    y = seen.column("y").to_numpy().astype(float)
    if not len(y) or y.min() == y.max():
        return None, float(toxic) / rows
    curve = fit_curve(x, y)
    return (model, curve), 0.0


def with_toxicity(docs: DataFrame, text_docs: DataFrame, labels: DataFrame, column: str = "score") -> DataFrame:
    """``docs`` with the score of its ``text`` in ``column``; ``text_docs`` is what the model may read."""
    model, constant = toxicity_model(text_docs, labels)
    if model is None:
        return docs.withColumn(column, F.lit(constant).cast("double"))
    ratios, curve = model

    @F.pandas_udf("double")
    def score(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        forget()
        ids = _Ids()
        for part in texts:
            x = np.array([_features(*ratios.document(_ids_of(t.encode() if t else b"", ids))) for t in part]).reshape(-1, 2)
            yield pd.Series(1 / (1 + np.exp(-np.clip(x @ curve[:2] + curve[2], -30, 30))))

    return docs.withColumn(column, score(F.coalesce(F.col("text"), F.lit(""))))


def toxicity_scores(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, held_out, score, predicted``, a row per row of ``docs``."""
    docs = whole_texts(docs)
    scored = with_toxicity(docs, docs, labels).select("doc_id", (id_remainder(F.col("doc_id"), 4) == 2).alias("held_out"), "score")
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
