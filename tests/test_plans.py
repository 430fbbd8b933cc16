import random

import pytest

from mergewell.functions.similarity import scored_pair
from mergewell.operators import blocking
from mergewell.operators.components import connected_components
from mergewell.plans import analytics as A
from mergewell.plans import pipelines as L
from mergewell.plans import profiles as P
from mergewell.plans import queries as Q
from mergewell.sources import masters as S
from mergewell.sources import sinks


def brute_components(edges):
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {x: root(x) for x in list(parent)}


@pytest.mark.parametrize("n, m", [(0, 1), (40, 60), (300, 200)])
def test_components(spark, n, m):
    rng = random.Random(n)
    edges = [(rng.randrange(m), rng.randrange(m)) for _ in range(n)]
    df = spark.createDataFrame(edges or [(1, 1)], "id_a long, id_b long")
    got = {r["id"]: r["component"] for r in connected_components(df).collect()}
    want = brute_components([e for e in edges if e[0] != e[1]])
    assert got == want


def test_components_with_hubs(spark):
    """Nodes with over a thousandth of the edges, as the least and as the greatest of their neighbours, beside nodes with few."""
    edges = [(0, k) for k in range(1, 1500)] + [(9_999, k) for k in range(2_000, 3_000)] + [(k, k + 3) for k in range(5_000, 6_500)] + [(700, 2_500)]
    got = {r["id"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "id_a long, id_b long")).collect()}
    assert got == brute_components(edges) and got[9_999] == 0 and len(set(got.values())) == 4


def test_components_of_a_chain(spark):
    df = spark.range(60).selectExpr("id AS id_a", "id + 1 AS id_b")
    assert {r["component"] for r in connected_components(df).collect()} == {0}


def test_components_of_all_lines(spark, tmp_path):
    rng = random.Random(5)
    lines = [(rng.randrange(1, 60_000), rng.randrange(1, 900)) for _ in range(500)]
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long").write.parquet(str(tmp_path / "lineitem.parquet"))
    got = {r["id"]: r["component"] for r in Q.QUERIES["connected_components"](spark, str(tmp_path)).collect()}
    assert max(o for o, _ in lines) >= 2000 and got == brute_components([(o, p + 1_000_000) for o, p in lines])


@pytest.mark.parametrize("name", ["aggressive", "ultra", "improved", "balanced"])
def test_result_invariants(spark, sf, name):
    profile = P.PROFILES[name]
    masters = S.derived_masters(spark, sf)
    source = masters.where("type = 'Company'") if profile.companies_only else masters
    rows = L.build_result(masters, profile).collect()
    assert sorted(r["id"] for r in rows) == sorted(r["id"] for r in source.select("id").collect())
    groups = {}
    for r in rows:
        if not r["is_valid"]:
            assert r["group_id"] == r["id"] and r["is_primary"] == 0 and r["filter_reason"]
        else:
            groups.setdefault(r["group_id"], []).append(r)
    for g, members in groups.items():
        assert [r["id"] for r in members if r["is_primary"]] == [g]


def test_pruning_changes_nothing(spark, sf):
    names = blocking.names_of(L.flagged_records(S.derived_masters(spark, sf), P.BALANCED).where("filter_reason IS NULL")).cache()
    members = blocking.usable_members(names, P.BALANCED).cache()
    udf = scored_pair(P.BALANCED.weights, P.BALANCED.threshold, P.BALANCED.rule)

    def merged(prune):
        pairs = blocking.candidate_pairs(members, P.BALANCED, prune)
        return {(r["a"], r["b"]) for r in pairs.withColumn("s", udf("a", "b", "ab", "ba")).where("s.merge").collect()}

    assert merged(True) == merged(False)


def _masters(spark, labels, kind="Company"):
    return spark.createDataFrame([(i, x, kind) for i, x in enumerate(labels, 1)], "id long, label string, type string")


def test_oversize_blocks_merge_nothing(spark):
    labels = ["zap"] * 501
    rows = L.build_result(_masters(spark, labels), P.AGGRESSIVE_ALL).collect()
    assert all(r["group_id"] == r["id"] for r in rows)


def test_validated_dedup(spark):
    labels = ["Palo Alto Networks", "Palo auto network", "Stallion Nigeria Limited", "Stallion Group of Nigeria", None, "x", "zzz qqq ltd", "ZZZ QQQ LTD"]
    marked = {r["id"]: r for r in L.validated_dedup(_masters(spark, labels)).collect()}
    assert marked[2]["duplicate_of"] == 1 and float(marked[2]["duplicate_score"]) == pytest.approx(0.920)
    assert {marked[3]["duplicate_status"], marked[4]["duplicate_status"]} == {"primary", "duplicate"}
    assert marked[5]["duplicate_status"] is None and marked[6]["duplicate_status"] is None
    final = {r["id"]: r for r in L.final_result(L.validated_dedup(_masters(spark, labels))).collect()}
    assert final[2]["group_id"] == 1 and final[2]["is_primary"] == 0 and final[5]["is_primary"] == 1


def test_signature_patch_joins_spacing(spark):
    masters = _masters(spark, ["Big Basket Kart", "Bigbasketkart", "Other Name"])
    rows = {r["id"]: r for r in L.signature_patch(L.exact_result(masters)).collect()}
    assert rows[1]["group_id"] == rows[2]["group_id"] == 1 and rows[1]["is_primary"] + rows[2]["is_primary"] == 1
    assert rows[3]["group_id"] == 3 and rows[3]["is_primary"] == 1


def test_sinks(spark, tmp_path):
    m = sinks.ensure_columns(_masters(spark, ["a"]))
    assert set(sinks.STATUS_COLUMNS) <= set(m.columns)
    sinks.write_result(m, str(tmp_path / "t"))
    sinks.write_result(m, str(tmp_path / "t"))
    assert S.read_masters(spark, str(tmp_path / "t")).count() == 1
    assert sinks.run_audit(m, "apply").first()["total_company_rows"] == 1


def test_summary_of_nothing(spark):
    empty = L.exact_result(_masters(spark, ["a"]).limit(0))
    assert A.summary(empty).first()["dedup_percent"] is None
