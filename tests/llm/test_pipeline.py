"""The pipeline's stages against the operators' brute force, on the smallest tables."""

import corpus_pipeline as P
import pytest

from mergewell.llm.common import table

from .test_operators import brute_near


@pytest.fixture(scope="module")
def stages(spark, sf):
    docs, out = table(spark, sf, "documents"), []
    out.append(docs.cache())
    for _, stage in P.STAGES:
        docs = stage(spark, docs, sf).cache()
        out.append(docs)
    return out


def test_columns(stages):
    for before in stages[1:-1]:
        assert before.columns == stages[0].columns


def test_near_duplicates_leave_one(stages):
    before = [(r["doc_id"], r["text"]) for r in stages[1].collect()]
    want = {i for i, root in brute_near(before).items() if i == root}
    assert sorted(r["doc_id"] for r in stages[2].collect()) == sorted(want)


def test_no_item_is_left(spark, sf, stages):
    items = [r["text"] for r in table(spark, sf, "benchmark").collect()]
    before = {r["doc_id"]: r["text"] for r in stages[2].collect()}
    after = {r["doc_id"] for r in stages[3].collect()}
    assert not any(any(t in before[i] for t in items) for i in after)
    assert all(any(t.split()[0] in before[i] for t in items) for i in set(before) - after)


def test_mixing_loses_nothing(stages):
    assert {r["doc_id"] for r in stages[3].collect()} == {r["doc_id"] for r in stages[4].collect()}


def test_tokens_of_all(stages):
    rows = stages[5].collect()
    assert len(rows) == stages[4].count() and all(r["n_tokens"] >= 1 for r in rows)


HOSTILE = [
    (1, "one two three four five six seven", "s"),
    (1, "one two three four five six seven", "s"),
    (2, None, None),
    (3, "", "s"),
    (4, " \t ", None),
    (5, "long " * 200_000 + "end", "s"),
    (6, "x" * 1_000_000, "t"),
    (None, "no id here", "t"),
    (7, "seven words that stand in the item here", "t"),
    (8, "One two three four five six SEVEN", "t"),
]
NAMES = "rest cut passes last _weight weight copies n_tokens mix row _dropped _again id count _hit _key key hit_id _toxicity score toxic fold _copy at places salt n_chars".split()


def hostile_rows():
    return [(i, t, s, *[f"{c}{k}" for c in NAMES]) for k, (i, t, s) in enumerate(HOSTILE)]


@pytest.fixture
def hostile(spark, tmp_path):
    schema = "doc_id long, text string, source string, " + ", ".join(f"{c} string" for c in NAMES)
    spark.createDataFrame(hostile_rows(), schema).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(i, None) for i in range(4)] + [(99, 1)], "doc_id long, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, "seven words that stand in the item here"), (2, None), (3, "")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    return str(tmp_path)


def test_hostile_rows_through_every_stage(spark, hostile):
    """Nulls, empty and very long texts, repeated rows and clashing columns; each stage on all that the one before kept."""
    docs, counts = table(spark, hostile, "documents"), []
    for name, stage in P.STAGES[:-1]:
        out = stage(spark, docs, hostile).cache()
        assert out.columns == docs.columns, name
        # A row that stays is as it was, in every column.
        assert {tuple(r) for r in out.collect()} <= set(hostile_rows()), name
        counts.append(sorted(r["doc_id"] or -1 for r in out.collect()))
        docs = out
    # No label counts for these ids but one of a document that is not there: the share of toxic labels is 1, so all go.
    assert counts == [[], [], [], []]
    assert P.STAGES[-1][1](spark, docs, hostile).count() == 0


def test_hostile_rows_from_the_second_stage_on(spark, hostile):
    docs = table(spark, hostile, "documents")
    kept = P.remove_near_duplicates(spark, docs, hostile)
    assert sorted(r["doc_id"] or -1 for r in kept.collect()) == [-1, 1, 2, 3, 4, 5, 6, 7]
    clean = P.remove_benchmark_leaks(spark, kept, hostile)
    assert sorted(r["doc_id"] or -1 for r in clean.collect()) == [-1, 1, 2, 3, 4, 5, 6]
    mixed = P.mix_sources(spark, clean, hostile)
    assert {r["doc_id"] for r in mixed.collect()} == {None, 1, 2, 3, 4, 5, 6} and {tuple(r) for r in mixed.collect()} <= set(hostile_rows())
    tokens = P.write_tokens(spark, mixed, hostile).collect()
    assert len(tokens) == mixed.count() and max(r["n_tokens"] for r in tokens) > 200_000
    empty = docs.limit(0)
    for _, stage in P.STAGES:
        assert stage(spark, empty, hostile).count() == 0


def test_toxicity_stage_is_the_operator(spark, sf, stages):
    from mergewell.llm import toxicity

    scored = toxicity.toxicity_scores(stages[0], table(spark, sf, "labels")).collect()
    assert sorted(r["doc_id"] for r in scored if r["score"] < toxicity.THRESHOLD) == sorted(r["doc_id"] for r in stages[1].collect())


def test_mixing_stage_against_brute_force(stages):
    from .test_operators import brute_mix

    before = [(r["doc_id"], r["text"], r["source"]) for r in stages[3].collect()]
    want = [(p, i) for (i, _, _, _, places), n in brute_mix(before, P.REPETITION_LIMIT).items() for p in places for _ in range(n)]
    assert sorted(r["doc_id"] for r in stages[4].collect()) == sorted(i for _, i in want)


def test_token_stage_against_the_tokenizer(stages):
    import zlib

    import numpy as np
    from tokenizers import Tokenizer

    from mergewell.llm import token_output

    whole = Tokenizer.from_file(token_output.default_vocabulary())
    want = []
    for r in stages[4].collect():
        ids = [*whole.encode(r["text"] or "", add_special_tokens=False).ids, 1]
        want.append((r["doc_id"], len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    rows = sorted(stages[5].collect(), key=lambda r: r["start"])
    assert sorted((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in rows) == sorted(want)
    assert [r["start"] for r in rows] == [sum(x["n_tokens"] for x in rows[:k]) for k in range(len(rows))] and [r["doc_id"] for r in rows] == sorted(r["doc_id"] for r in rows)
