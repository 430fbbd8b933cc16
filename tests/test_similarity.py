import random

import pytest

from mergewell.functions import similarity as S

DEDUP = (0.30, 0.30, 0.20, 0.20)


def slow_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b):
            last, row[j + 1] = row[j + 1], last + 1 if x == y else max(row[j], row[j + 1])
    return row[-1]


def slow_partial(a, b):
    a, b = (a, b) if len(a) <= len(b) else (b, a)

    def best(s, t):
        windows = [t[max(0, e - len(s)) : e] for e in range(1, len(t) + 1)] + [t[i : i + len(s)] for i in range(len(t))]
        return max(2 * slow_lcs(s, w) / (len(s) + len(w)) for w in windows)

    return max(best(a, b), best(b, a)) if len(a) == len(b) else best(a, b)


def test_ratios_against_slow_ones():
    rng = random.Random(5)
    words = ["".join(rng.choice("abcé ") for _ in range(rng.randint(1, 14))) for _ in range(160)]
    left, right = words[:80], words[80:]
    assert S.lcs_lengths(left, right).tolist() == [slow_lcs(a, b) for a, b in zip(left, right)]
    assert S.partial_ratios(left, right) == pytest.approx([slow_partial(a, b) for a, b in zip(left, right)])
    long = ["ab" * 50, "x" * 300]
    assert S.lcs_lengths(long, ["ba" * 50, "x" * 10]).tolist() == [slow_lcs("ab" * 50, "ba" * 50), 10]


@pytest.mark.parametrize(
    "a, b, score",
    [
        ("palo alto networks", "palo auto network", 0.920),
        ("nyanza reproductive health society kenya africa", "nyanza reproductive health society", 0.920),
    ],
)
def test_published_scores(a, b, score):
    assert S.composite([a], [b], DEDUP)["score"][0] == pytest.approx(score, abs=5e-4)


def test_floor_changes_no_score_above_it():
    rng = random.Random(7)
    words = [" ".join("".join(rng.choice("abc") for _ in range(4)) for _ in range(3)) for _ in range(200)]
    whole = S.composite(words[:100], words[100:], DEDUP)["score"]
    cut = S.composite(words[:100], words[100:], DEDUP, 0.6)["score"]
    assert all(x == pytest.approx(y) for x, y in zip(whole, cut) if x >= 0.6) and all(y < 0.6 for x, y in zip(whole, cut) if x < 0.6)


def test_empty_scores_nothing():
    assert S.composite(["", "a"], ["a", ""], DEDUP)["score"].tolist() == [0, 0]


@pytest.mark.parametrize(
    "a, b",
    [
        ("cholamandalam home finance", "cholamandalam dbs finance"),
        ("reliance industries", "reliance capital"),
        ("tata motors", "tata steel"),
        ("apollo consulting", "zenith consulting"),
    ],
)
def test_balanced_keeps_apart(a, b):
    score = S.composite([a], [b], (0.30, 0.25, 0.30, 0.15))["score"][0]
    assert not S.merge_guarded(a, b, score)


def test_decisions():
    assert S.merge_guarded("infosys limited", "infosys limited", 1.0)
    assert not S.business_conflict("titan induatries", "titan industries", 0.95)
    assert S.business_conflict("tata motors", "tata motors finance", 0.9)
    assert S.merge_core_tokens("acme widgets", "acme widget", 0.85) and not S.merge_core_tokens("acme", "acme", 0.5)
