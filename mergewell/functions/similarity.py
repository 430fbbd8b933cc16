"""String similarity and merge decisions on batches of pairs.

Ratios are twice the longest common subsequence over the summed lengths.  Subsequences are found for
a whole batch at once: a table holds, for each pair and sign, the sign's places in the shorter string as the
bits of a 64-bit word, and every step looks one sign up for all pairs or windows.  Longer strings go
through Python integers.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from . import vocabulary as V

_WORD = 64


def lcs_length(a: str, b: str) -> int:
    """Length of the longest common subsequence."""
    if len(a) > len(b):
        a, b = b, a
    masks: dict[str, int] = {}
    for i, c in enumerate(a):
        masks[c] = masks.get(c, 0) | 1 << i
    full = (1 << len(a)) - 1
    rest = full
    for c in b:
        m = rest & masks.get(c, 0)
        rest = (rest + m | rest - m) & full
    return len(a) - rest.bit_count()


class _Pairs:
    """Pairs of strings as numbered signs, 0 behind the end, with the places of signs in the shorter ones."""

    def __init__(self, short: list[str], long: list[str]):
        n = len(short)
        self.m, self.n = (np.fromiter(map(len, x), np.int64, n) for x in (short, long))
        width = max(int(self.m.max()), 1), max(int(self.n.max()), 1)
        flat = np.frombuffer("".join([s.ljust(w, "\0") for w, side in zip(width, (short, long)) for s in side]).encode("utf-32-le", "surrogatepass"), np.uint32)
        signs, numbers = np.unique(np.concatenate([np.zeros(1, np.uint32), flat]), return_inverse=True)
        x, self.y = numbers[1 : 1 + n * width[0]].reshape(n, -1), numbers[1 + n * width[0] :].reshape(n, -1)
        self.size = len(signs)
        self.places = np.zeros(n * self.size, np.uint64)
        self.base = np.arange(n) * self.size
        for k in range(width[0]):
            self.places[self.base + x[:, k]] |= np.uint64(1 << k)
        self.places[self.base] = 0  # the end is no sign, whatever the strings hold
        self.full = (np.uint64(1) << self.m.astype(np.uint64)) - np.uint64(1)

    def common(self, rows: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Longest common subsequences of the short strings of ``rows`` and the long ones from ``start`` to ``end``."""
        base, full = self.base[rows], self.full[rows]
        flat, at, rest = self.y.ravel(), rows * self.y.shape[1] + start, full.copy()
        size = end - start
        for k in range(int(size.max()) if len(size) else 0):
            sign = flat[np.minimum(at + k, len(flat) - 1)]
            m = rest & np.where(k < size, self.places[base + sign], np.uint64(0))
            rest = (rest + m | rest - m) & full
        return np.bitwise_count(full).astype(np.int64) - np.bitwise_count(rest).astype(np.int64)


def _batches(rows: list[int], size: int = 4096) -> Iterator[list[int]]:
    for at in range(0, len(rows), size):
        yield rows[at : at + size]


def lcs_lengths(a: list[str], b: list[str]) -> np.ndarray:
    """``lcs_length`` of every pair; the shorter side of a pair must fit a word to be vectorised."""
    out = np.zeros(len(a), np.int64)
    pairs = [(x, y) if len(x) <= len(y) else (y, x) for x, y in zip(a, b)]
    fits = []
    for i, (x, y) in enumerate(pairs):
        if len(x) >= _WORD or len(y) > 256 or "\0" in y:
            out[i] = lcs_length(x, y)
        elif x:
            fits.append(i)
    for part in _batches(fits):
        p = _Pairs([pairs[i][0] for i in part], [pairs[i][1] for i in part])
        out[part] = p.common(np.arange(len(part)), np.zeros(len(part), np.int64), p.n)
    return out


def ratios(a: list[str], b: list[str]) -> np.ndarray:
    size = np.array([len(x) + len(y) for x, y in zip(a, b)])
    return np.where(size > 0, 2 * lcs_lengths(a, b) / np.maximum(size, 1), 1.0)


@lru_cache(maxsize=200_000)
def ratio(a: str, b: str) -> float:
    return 2 * lcs_length(a, b) / (len(a) + len(b)) if a or b else 1.0


@lru_cache(maxsize=100_000)
def token_sort(s: str) -> str:
    return " ".join(sorted(s.split()))


def token_set_ratios(a: list[str], b: list[str]) -> np.ndarray:
    out = np.zeros(len(a))
    left, right, of = [], [], []
    for i, (x, y) in enumerate(zip(a, b)):
        s, t = set(x.split()), set(y.split())
        both, only_s, only_t = sorted(s & t), sorted(s - t), sorted(t - s)
        if not s or not t:
            continue
        if both and not (only_s and only_t):
            out[i] = 1.0
            continue
        base, p, q = " ".join(both), " ".join(both + only_s), " ".join(both + only_t)
        for u, v in ((p, q), (base, p), (base, q)) if both else ((p, q),):
            left.append(u), right.append(v), of.append(i)
    if of:
        np.maximum.at(out, of, ratios(left, right))
    return out


def _window_ratios(short: list[str], long: list[str]) -> np.ndarray:
    """Best ratio of each short string, of under 64 signs, against the windows of the long one, of up to 256."""
    p = _Pairs(short, long)
    best = np.zeros(len(short))
    width = p.y.shape[1]
    # A window that begins or ends on a sign the shorter string lacks is never the best, but for the whole.
    known = np.zeros((len(short), width + 1), bool)
    known[:, 1:] = p.places[p.base[:, None] + p.y] != 0  # known[:, e]: the sign before e
    e = np.arange(width + 1)[None, :]
    m, n = p.m[:, None], p.n[:, None]
    begins = np.concatenate([known[:, 1:], np.zeros((len(short), 1), bool)], axis=1)  # begins[:, s]: the sign at s
    last = np.take_along_axis(known, np.minimum(e + m, width), axis=1)
    whole = (e + m <= n) & (begins | last | (m == n))
    for rows, start, end in (
        (*np.nonzero((e >= 1) & (e < m) & (e <= n) & known), None),
        (*np.nonzero(whole), p.m),
        (*np.nonzero((e + m > n) & (e < n) & begins), p.n),
    ):
        start, end = (np.zeros_like(rows), start) if end is None else (start, start + end[rows] if end is p.m else end[rows])
        for at in range(0, len(rows), 100_000):
            r, s, t = rows[at : at + 100_000], start[at : at + 100_000], end[at : at + 100_000]
            np.maximum.at(best, r, 2 * p.common(r, s, t) / (p.m[r] + t - s))
    return best


def _slow_partial(x: str, y: str) -> float:
    """The best ratio for strings of any length, window by window."""
    m = len(x)
    windows = {y[max(0, e - m) : e] for e in range(1, len(y) + 1)} | {y[s : s + m] for s in range(len(y))}
    return max((2 * lcs_length(x, w) / (m + len(w)) for w in windows), default=0.0) if x else 0.0


def partial_ratios(a: list[str], b: list[str]) -> np.ndarray:
    """Best ratio of the shorter string against windows of the longer, cut windows at the ends too."""
    out = np.zeros(len(a))
    short, long, of = [], [], []
    for i, (x, y) in enumerate(zip(a, b)):
        if len(x) > len(y):
            x, y = y, x
        for u, v in ((x, y), (y, x)) if len(x) == len(y) else ((x, y),):  # equal lengths both ways
            if len(u) >= _WORD or len(v) > 256 or "\0" in u + v:
                out[i] = max(out[i], _slow_partial(u, v))
            elif u:
                short.append(u), long.append(v), of.append(i)
    for part in _batches(list(range(len(of))), 2048):
        np.maximum.at(out, [of[k] for k in part], _window_ratios([short[k] for k in part], [long[k] for k in part]))
    return out


def composite(a: list[str], b: list[str], weights: tuple[float, float, float, float], floor: float = 0.0) -> pd.DataFrame:
    """Columns ``tsr, tse, rat, par, score``; a score that can't reach ``floor`` is 0, and what is not needed for that null."""
    tsr = ratios([token_sort(x) for x in a], [token_sort(x) for x in b])
    rat = ratios(a, b)
    wa, wb, wc, wd = weights
    some = np.array([bool(x) and bool(y) for x, y in zip(a, b)], dtype=bool)
    # A window is at least as long as what it shares, and shares no more than the whole string.
    short = np.array([min(len(x), len(y)) for x, y in zip(a, b)])
    common = np.round(rat * np.array([len(x) + len(y) for x, y in zip(a, b)]) / 2)
    most = 2 * common / np.maximum(1, short + common)
    near = np.flatnonzero(some & (wa * tsr + wb + wc * rat + wd * most >= floor - 1e-9))
    tse = np.full(len(a), np.nan)
    tse[near] = token_set_ratios([a[i] for i in near], [b[i] for i in near])
    live = near[wa * tsr[near] + wb * tse[near] + wc * rat[near] + wd * most[near] >= floor - 1e-9]
    par = np.full(len(a), np.nan)
    par[live] = partial_ratios([a[i] for i in live], [b[i] for i in live])
    score = np.where(np.isnan(par), 0.0, wa * tsr + wb * np.nan_to_num(tse) + wc * rat + wd * np.nan_to_num(par))
    return pd.DataFrame({"tsr": tsr, "tse": tse, "rat": rat, "par": par, "score": score})


# --- decisions on one scored pair ---


def _core(norm: str, stop: frozenset[str], most: int | None = None) -> list[str]:
    return [w for w in norm.split() if w not in stop and len(w) > 1][:most]


def _near_any(word: str, others: list[str], least: float) -> bool:
    return any(2 * min(len(word), len(o)) >= least * (len(word) + len(o)) and ratio(word, o) >= least for o in others)


def _unpaired(a: set[str], b: set[str], least: float = 0.8) -> tuple[set[str], set[str]]:
    """What is left of two word sets after typing variants are paired off, in order of the alphabet."""
    left, right = [], sorted(b)
    for w in sorted(a):
        twin = next((o for o in right if _near_any(w, [o], least)), None)
        if twin is None:
            left.append(w)
        else:
            right.remove(twin)
    return set(left), set(right)


_STOP = frozenset(V.STOPWORDS)


def merge_core_tokens(a: str, b: str, score: float) -> bool:
    """The rule of the ``improved`` profile: the first two significant words must agree."""
    if score < 0.80:
        return False
    if a == b or score >= 0.92:
        return True
    x, y = _core(a, _STOP, 2), _core(b, _STOP, 2)
    if not x or not y:
        return score >= 0.85
    if set(x) == set(y):
        return True
    return sum(_near_any(w, y, 0.75) for w in x) >= min(len(x), len(y))


def business_conflict(a: str, b: str, score: float) -> bool:
    """Do words of their own make two names different companies?"""
    x, y = set(_core(a, _STOP)), set(_core(b, _STOP))
    if not x & y or x == y:
        return False
    own_x, own_y = _unpaired(x - y, y - x)
    if own_x and own_y:
        limit = 0.95 if (own_x | own_y) & V.BUSINESS else 0.90
        return score < limit
    return bool((own_x | own_y) & V.STRONG) and score < 0.93


def merge_guarded(a: str, b: str, score: float) -> bool:
    """The rule of the ``balanced`` profile: thresholds, generic words, business words, then overlap."""
    if score < 0.80:
        return False
    if a == b:
        return True
    words_a, words_b = _core(a, _STOP), _core(b, _STOP)
    if min(len(words_a), len(words_b)) <= 1 and score < 0.95:
        return False
    x, y = set(words_a), set(words_b)
    shared = x & y
    if shared and shared <= V.GENERIC_INDUSTRY:
        own_x, own_y = _unpaired(x - y, y - x)
        if own_x and own_y:
            return False
        if (own_x | own_y) - V.GENERIC_INDUSTRY and score < 0.95:
            return False
    if business_conflict(a, b, score):
        return False
    if score >= 0.91 or x == y:
        return True
    if not x or not y:
        return False
    return sum(_near_any(w, words_b, 0.8) for w in x) / max(len(x), len(y)) >= 0.65


RULES = {"threshold": None, "core_tokens": merge_core_tokens, "guarded": merge_guarded}


def scored_pair(weights: tuple[float, float, float, float], threshold: float, rule: str = "threshold"):
    """A pandas UDF ``(a, b, ab, ba)`` to ``(score, merge)``.

    ``ab`` and ``ba`` say in which order records of the two names meet; a rule that counts from one
    side is asked in each of these orders.
    """
    decide = RULES[rule]

    @F.pandas_udf("score double, merge boolean")
    def run(parts: Iterator[tuple[pd.Series, pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for a, b, ab, ba in parts:
            left, right = a.tolist(), b.tolist()
            score = composite(left, right, weights, threshold)["score"].to_numpy()
            merge = score >= threshold
            if decide is not None:
                for i in np.flatnonzero(merge):
                    merge[i] = bool((ab[i] and decide(left[i], right[i], score[i])) or (ba[i] and decide(right[i], left[i], score[i])))
            yield pd.DataFrame({"score": score, "merge": merge})

    return run


def score_column(a: Column, b: Column, weights: tuple[float, float, float, float], floor: float = 0.0) -> Column:
    """The composite score of two names; 0 if either is empty or the score can't reach ``floor``."""

    @F.pandas_udf("double")
    def run(x: pd.Series, y: pd.Series) -> pd.Series:
        return composite(x.tolist(), y.tolist(), weights, floor)["score"]

    return run(a, b)


def metric_columns(a: Column, b: Column, weights: tuple[float, float, float, float]) -> Column:
    """A struct of the four ratios and the weighted score."""

    @F.pandas_udf("tsr double, tse double, rat double, par double, score double")
    def run(x: pd.Series, y: pd.Series) -> pd.DataFrame:
        return composite(x.tolist(), y.tolist(), weights)

    return run(a, b)
