import pytest

from mergewell.plans import analytics as A
from mergewell.sources import masters as S
from mergewell.sources import sinks


def test_sources_are_tried_again(spark):
    waits, tries = [], []

    def read():
        tries.append(1)
        if len(tries) < 3:
            raise OSError("not up yet")
        return spark.range(2)

    assert S.with_retries(read, wait=waits.append).count() == 2 and waits == [5.0, 10.0]
    with pytest.raises(OSError):
        S.with_retries(lambda: (_ for _ in ()).throw(OSError("down")), attempts=2, wait=waits.append)


def test_declared_columns(spark):
    df = spark.createDataFrame([(1, 7, "n", 7, 1, "more")], "id int, group_id int, company_name string, master_id long, is_primary long, extra string")
    assert sinks.conform(df, sinks.FINAL_SCHEMA).dtypes == [tuple(c.split()) for c in sinks.FINAL_SCHEMA.split(", ")]
    with pytest.raises(ValueError):
        sinks.conform(df, sinks.RESULT_SCHEMA)


def test_tables_are_listed(spark):
    spark.range(1).createOrReplaceTempView("listed_here")
    assert ("listed_here", True) in [(r["name"], r["temporary"]) for r in S.tables_of(spark).collect()]
    spark.catalog.dropTempView("listed_here")


def test_report_as_text(spark):
    row = "primary_id long, primary_label string, member_id long, member_label string, member_role string, duplicate_score decimal(5,3), ai_decision string"
    rows = [(i, f"p{i}", 100 * i + k, f"m{k}", "duplicate", round(0.75 + i / 100, 3), "{}" if i < 3 else None) for i in range(1, 20) for k in range(i % 3 + 1)]
    from decimal import Decimal

    df = spark.createDataFrame([(*r[:5], Decimal(str(r[5])), r[6]) for r in rows], row)
    groups = sorted(A.report_groups(df).collect(), key=lambda r: r["number"])
    # Both validated groups, the ten best plain ones, then the next best.
    assert [r["primary_id"] for r in groups] == [2, 1, 19, 18, 17, 16, 15, 14, 13, 12, 11, 10, 9, 8, 7]
    lines = [r["line"] for r in sorted(A.report_lines(df).collect())]
    assert lines[:3] == ["Group 1 (AI-validated):", '  Primary: ID=2, Label="p2"', '  Duplicate: ID=200, Label="m0", Score=0.770, AI={}'] and "Group 3:" in lines
