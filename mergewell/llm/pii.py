"""Personal data spans by weak supervision.

Exact base patterns (email, ip, card, phone) always stay.  Looser candidates around them are
voted on by labelers - shape patterns, a gazetteer of cue words, the characters around the
span, checksums - and expectation-maximisation over the vote patterns of all spans estimates how
reliable each labeler is.  The posteriors train a softmax span classifier over hashed features of the
votes, of the span's shape and of the words around it, which decides the added spans.

Scale: the text is read once, in Python workers that hold one batch; what leaves them is a row of
spans per document with a vote pattern and hashed features for each.  Patterns come from a fixed grid,
so the table of pattern counts that reaches the driver is bounded by the grid, never by the number of
documents.  The classifier is fitted on the driver to a sample of some ``SAMPLE`` spans of each pattern, weighted by the
pattern's count over all documents.  Finding spans takes a time of n log n in a text's length.

Defined results: a null text is an empty text and gives zero counts, the hash of the empty string
and ``spans = ''``; repeated rows each give a row; null ids stay null; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop_materialized, materialize, whole_texts

KINDS = ("email", "ip", "card", "phone")
CLASSES = (*KINDS, "none")
NONE = len(KINDS)

_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL_END = re.compile(r"[A-Za-z0-9._%+-]+\Z")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# A quad can only begin where a run of digits begins, which keeps long runs linear.
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")

_SPELT_AT = re.compile(r"[\[({]\s?at\s?[\])}]", re.I)
_SPELT_EMAIL = re.compile(
    r"[A-Za-z0-9._%+-]{1,64}\s?[\[({]\s?at\s?[\])}]\s?[A-Za-z0-9-]{1,63}(?:(?:\s?[\[({]\s?dot\s?[\])}]\s?|\.)[A-Za-z0-9-]{1,63}){1,8}", re.I
)
_NUMBER = re.compile(r"\(?[0-9][0-9\x20().-]{5,30}[0-9]")
_RUN = re.compile(r"(?<![0-9])[0-9]{13,19}(?![0-9])")
_IPV6 = re.compile(r"(?<![0-9A-Za-z:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Za-z:])")

#: Cue words before a span and the class they speak for.
GAZETTEER = {
    "email": "email mail e-mail contact courriel correo",
    "ip": "ip ipv4 ipv6 host server addr",
    "card": "card visa mastercard amex credit karte carte tarjeta",
    "phone": "phone tel call mobile fax cell telefon telephone movil portable whatsapp",
    "none": "version isbn doi token key order invoice page section license id no nr number ref year",
}
_CUES = {w: CLASSES.index(k) for k, words in GAZETTEER.items() for w in words.split()}
_CUE_WORD = re.compile(r"[^\W\d_]+(?:-[^\W\d_]+)*")
_DATE = re.compile(r"\(?(?:[12][0-9]{3}[-. ][01]?[0-9][-. ][0-3]?[0-9]|[0-3]?[0-9][-. ][01]?[0-9][-. ][12][0-9]{3})")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        total += n if i % 2 == 0 else (n * 2 - 9 if n > 4 else n * 2)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(start, kind, end)`` of the base patterns, sorted; leftmost and non-overlapping per kind."""
    out = []
    if "@" in text:
        last = 0
        for m in _DOMAIN.finditer(text):
            start = m.start()
            while start > last and text[start - 1] in _LOCAL:
                start -= 1
            if start < m.start():
                out.append((start, 0, m.end()))
                last = m.end()
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m[0].split(".")):
                out.append((m.start(), 1, m.end()))
        for m in _CARD.finditer(text):
            if 12 <= m.end() - m.start():
                digits = m[0].replace(" ", "").replace("-", "")
                if 12 <= len(digits) <= 19 and luhn(digits):
                    out.append((m.start(), 2, m.end()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 9 <= sum("0" <= c <= "9" for c in m[0]) <= 15:
                    out.append((m.start(), 3, m.end()))
    return sorted(out)


def candidates(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Looser ``(start, proposed kind, end)`` spans that touch no base span and no earlier candidate."""
    found, first = [], []
    if _SPELT_AT.search(text):
        found += [(m.start(), 0, m.end()) for m in _SPELT_EMAIL.finditer(text)]
    if _DIGIT.search(text):
        if text.count(":") >= 7:
            found += [(m.start(), 1, m.end()) for m in _IPV6.finditer(text)]
        # Numbers that a space joins to another make one failing base match; each may be a card.
        first = [(m.start(), 2, m.end()) for m in _RUN.finditer(text) if luhn(m[0])]
        for m in _NUMBER.finditer(text):
            n = sum("0" <= c <= "9" for c in m[0])
            if n >= 7:
                found.append((m.start(), 2 if n >= 13 else 3, m.end()))
    free = _outside([(s, e) for s, _, e in base])
    out = [x for x in first if free(x[0], x[2])]
    free, last = _outside([(s, e) for s, _, e in [*base, *out]]), 0
    for s, k, e in sorted(found, key=lambda x: (x[0], -x[2], x[1])):
        if s >= last and free(s, e):
            last = e
            out.append((s, k, e))
    return sorted(out)


def _outside(spans: list[tuple[int, int]]):
    """A test whether an interval overlaps none of ``spans``, by bisection of their union."""
    starts, ends = [], []
    for s, e in sorted(spans):
        if ends and s < ends[-1]:
            ends[-1] = max(ends[-1], e)
        else:
            starts.append(s), ends.append(e)

    def free(s: int, e: int) -> bool:
        i = bisect_left(starts, e) - 1
        return i < 0 or ends[i] <= s

    return free


LABELERS = 6


def pattern(text: str, s: int, k: int, e: int, is_base: bool) -> str:
    """Votes of the labelers and the classifier's features, as a short code from a fixed grid.

    One letter for each labeler (class digit or ``-``), then: proposed kind, bucket of digits,
    number of groups, separators, what stands on either side.
    """
    span = text[s:e]
    digits = "".join(c for c in span if "0" <= c <= "9")
    left, right = text[max(0, s - 1) : s], text[e : e + 1]
    groups = len(re.findall(r"[0-9]+", span))
    glued = left.isalnum() or right.isalnum() or left in ('"', "'", "#", "$", "_", "=", "/") or right in ('"', "'", "_", "/")
    votes = ["-"] * LABELERS
    if is_base:
        votes[0] = str(k)
    elif k == 0 or k == 1:
        votes[0] = str(k)
    elif k == 3 and (groups >= 3 or span.startswith(("(", "00"))) and 9 <= len(digits) <= 13:
        votes[0] = "3"
    elif k == 2 and (groups == 4 and len(digits) == 16 or groups == 1 and luhn(digits)):
        votes[0] = "2"
    if k >= 2 and len(digits) >= 12:
        votes[1] = "2" if luhn(digits) and len(digits) <= 19 else str(NONE)
    for w in _CUE_WORD.findall(text[max(0, s - 24) : s].lower())[-2:]:
        if w in _CUES:
            votes[2] = str(_CUES[w])
    if glued:
        votes[3] = str(NONE)
    if not is_base and _DATE.match(span):
        votes[4] = str(NONE)
    if not is_base and k >= 2 and groups == 1 and votes[0] == "-":
        votes[5] = str(NONE)
    seps = "".join(sorted({c for c in span if not c.isalnum() and c in "-.( "}))[:2] or "_"
    side = ("a" if left.isalnum() else "s" if left.isspace() or not left else "p") + ("a" if right.isalnum() else "s" if right.isspace() or not right else "p")
    return "".join(votes) + f"{'b' if is_base else 'c'}{k}{min(len(digits), 20) // 3}{min(groups, 5)}{side}{seps}"


#: Buckets of the classifier's features; the first is always on.
BUCKETS = 4096
#: Spans of each pattern that the classifier learns from, on average.
SAMPLE = 200
_SHAPE = re.compile(r"[0-9]+|[^\W\d_]+|.", re.S)


def span_features(text: str, s: int, e: int, code: str) -> list[int]:
    """Hashed features of a span: its votes and grid code, its shape, and the words around it."""
    parts = [f"d{min(len(p), 7)}" if p[0].isdigit() else "a" if p[0].isalpha() else p for p in _SHAPE.findall(text[s : min(e, s + 80)])]
    before = _CUE_WORD.findall(text[max(0, s - 40) : s].lower())[-2:]
    after = _CUE_WORD.findall(text[e : e + 24].lower())[:1]
    names = [f"{i}{c}" for i, c in enumerate(code[: LABELERS + 6])] + ["s" + code[LABELERS + 6 :], "w" + "".join(parts)]
    names += ["b" + a + b for a, b in zip(parts, parts[1:])][:12] + ["l" + w for w in before] + ["r" + w for w in after]
    return [0, *sorted({1 + crc32(n.encode(errors="replace")) % (BUCKETS - 1) for n in names})]


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32()), ("pattern", pa.string()), ("features", pa.list_(pa.int32()))]))

    def rows(text: str, spans: list[tuple[int, int, int]], is_base: bool) -> list[dict]:
        out = []
        for s, k, e in spans:
            code = pattern(text, s, k, e, is_base)
            out.append({"start": s, "kind": k, "end": e, "pattern": code, "features": span_features(text, s, e, code)})
        return out

    for batch in batches:
        for i in range(0, batch.num_rows, 500):
            part = batch.slice(i, 500)
            base, cand = [], []
            for t in part.column(1).to_pylist():
                b = base_spans(t)
                base.append(rows(t, b, True))
                cand.append(rows(t, candidates(t, b), False))
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(base, kind), pa.array(cand, kind)], names=["doc_id", "base", "cand"])


_SPAN = "array<struct<start:int,kind:int,end:int,pattern:string,features:array<int>>>"


def estimate_reliability(patterns: dict[str, int], rounds: int = 50) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """Expectation-maximisation over vote patterns: posteriors by pattern, and labeler accuracies.

    Each labeler that votes is right with its own probability and otherwise spreads evenly over
    the other classes.  A base pattern's own vote is an anchor, so classes keep their names.
    """
    K = len(CLASSES)
    keys = sorted(patterns)
    n = np.array([patterns[k] for k in keys], dtype=float)
    votes = np.array([[-1 if c == "-" else int(c) for c in k[:LABELERS]] for k in keys]).reshape(-1, LABELERS)
    proposed = np.array([int(k[LABELERS + 1]) for k in keys], dtype=int)
    possible = np.zeros((len(keys), K), bool)
    possible[:, NONE] = True
    if len(keys):
        possible[np.arange(len(keys)), proposed] = True
        for j in range(LABELERS):
            seen = votes[:, j] >= 0
            possible[np.flatnonzero(seen), votes[seen, j]] = True
    acc, prior = np.full(LABELERS, 0.8), np.full(K, 1.0 / K)
    post = np.zeros((len(keys), K))
    for _ in range(rounds if len(keys) else 0):
        log = np.tile(np.log(prior), (len(keys), 1))
        for j in range(LABELERS):
            seen = np.flatnonzero(votes[:, j] >= 0)
            like = np.full((len(seen), K), np.log((1 - acc[j]) / (K - 1)))
            like[np.arange(len(seen)), votes[seen, j]] = np.log(acc[j])
            log[seen] += like
        log[~possible] = -np.inf
        post = np.exp(log - log.max(1, keepdims=True))
        post /= post.sum(1, keepdims=True)
        for j in range(LABELERS):
            seen = np.flatnonzero(votes[:, j] >= 0)
            right = (n[seen] * post[seen, votes[seen, j]]).sum()
            acc[j] = min(0.99, max(0.55, (right + 8) / (n[seen].sum() + 10)))
        prior = (n @ post + 1) / (n.sum() + K)
    return dict(zip(keys, post)), acc


def train_classifier(features: list[list[int]], target: np.ndarray, weight: np.ndarray, rounds: int = 150) -> np.ndarray:
    """Weights ``(BUCKETS, classes)`` of a softmax regression of posteriors on sparse binary features, fitted with Adam."""
    w = np.zeros((BUCKETS, len(CLASSES)))
    if not features:
        return w
    sizes = np.array([len(f) for f in features])
    row, column = np.repeat(np.arange(len(features)), sizes), np.concatenate([np.array(f) for f in features])
    weight = (weight / weight.sum())[:, None]
    first, second = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, rounds + 1):
        p = class_shares(w, row, column, len(features))
        pull = weight * (p - target)
        grad = np.stack([np.bincount(column, weights=pull[row, k], minlength=BUCKETS) for k in range(w.shape[1])], axis=1) + 1e-5 * w
        first = 0.9 * first + 0.1 * grad
        second = 0.99 * second + 0.01 * grad**2
        w -= 0.1 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
    return w


def class_shares(w: np.ndarray, row: np.ndarray, column: np.ndarray, rows: int) -> np.ndarray:
    z = np.stack([np.bincount(row, weights=w[column, k], minlength=rows) for k in range(w.shape[1])], axis=1)
    p = np.exp(z - z.max(1, keepdims=True))
    return p / p.sum(1, keepdims=True)


def classify(w: np.ndarray, features: list[list[int]]) -> list[int]:
    """The class of every span; one other than none needs over half of the mass."""
    if not features:
        return []
    sizes = np.array([len(f) for f in features])
    p = class_shares(w, np.repeat(np.arange(len(features)), sizes), np.concatenate([np.array(f) for f in features]), len(features))
    best = p.argmax(1)
    return np.where(p[np.arange(len(p)), best] > 0.5, best, NONE).tolist()


def _write_spans(w: np.ndarray):
    def joined(spans: list[tuple[int, int, int]]) -> str:
        return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in sorted(spans))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[] for _ in range(7)]
            found = batch.column(2).to_pylist()
            classes = iter(classify(w, [x["features"] for cand in found for x in cand]))
            for base, cand in zip(batch.column(1).to_pylist(), found):
                kept = [(x["start"], x["kind"], x["end"]) for x in base]
                more = [(x["start"], c, x["end"]) for x, c in zip(cand, classes) if c != NONE]
                count = Counter(k for _, k, _ in kept)
                for i in range(4):
                    out[i].append(count[i])
                out[4].append(hashlib.sha256(joined(kept).encode()).hexdigest())
                out[5].append(joined(kept + more))
                out[6].append(len(more))
            kinds = [pa.int64()] * 4 + [pa.string(), pa.string(), pa.int64()]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(o, t) for o, t in zip(out, kinds))], names=["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_added"])

    return run


def pii_spans(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: counts and hash of the base spans, and all spans."""
    scanned = materialize(whole_texts(docs).mapInArrow(_scan, f"doc_id long, base {_SPAN}, cand {_SPAN}"), "pii")
    spans = scanned.select("doc_id", F.explode(F.concat("base", "cand")).alias("x")).select("doc_id", "x.*")
    counts = materialize(spans.groupBy("pattern").count(), "piipatterns")
    patterns = {r[0]: r[1] for r in counts.collect()}  # rows of a fixed feature grid
    post, _ = estimate_reliability(patterns)
    bucket = F.pmod(F.xxhash64("doc_id", "start", "end", "features"), F.lit(1_000_000))
    chosen = spans.join(F.broadcast(counts), "pattern").where(bucket * F.col("count") < F.lit(SAMPLE * 1_000_000))
    # About ``SAMPLE`` spans of each pattern of the grid; copies of a span hash alike only within a document.
    sample = sorted((r["pattern"], r["features"]) for r in chosen.select("pattern", "features").collect())
    taken = Counter(p for p, _ in sample)
    weight = np.array([np.log1p(patterns[p]) / taken[p] for p, _ in sample])
    w = train_classifier([f for _, f in sample], np.array([post[p] for p, _ in sample]), weight)
    drop_materialized(counts)
    return scanned.select("doc_id", "base", "cand").mapInArrow(
        _write_spans(w),
        "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long",
    )
