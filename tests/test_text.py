import pytest
from pyspark.sql import functions as F

from mergewell.functions import quality
from mergewell.functions import text as T
from mergewell.plans import profiles as P


def one(spark, column, value):
    return spark.createDataFrame([(value,)], "x string").select(column(F.col("x"))).first()[0]


@pytest.mark.parametrize(
    "label, cleaned",
    [
        (None, ""),
        ("  ", ""),
        (", Acme Ltd · Full-time", "Acme Ltd"),
        ("Acme (India) Ltd, Mumbai, India", "Acme Ltd"),
        ("Acme (unclosed", "Acme"),
        ("AT &T", "AT&T"),
        ("Foo  Bar ·", "Foo Bar"),
        ("“Foo”", "Foo"),
    ],
)
def test_deep_clean(spark, label, cleaned):
    assert one(spark, P.BALANCED.clean, label) == cleaned


def test_simple_clean_keeps_places(spark):
    assert one(spark, P.AGGRESSIVE.clean, "[Acme, India].") == "Acme, India"
    assert one(spark, P.AGGRESSIVE_ALL.clean, "Acme Â·") == "Acme"


@pytest.mark.parametrize(
    "cleaned, reason",
    [
        ("", "empty"),
        ("ab", "too_short (2 chars)"),
        ("+++", "special_chars_only"),
        ("12345", "numeric_only"),
        ("N/A", "too_short (3 chars)"),
        ("unknown", "placeholder"),
        ("ditto", "placeholder"),
        ("Co-founder", "job_title_not_company"),
        ("Regional Sales Manager", "job_role_not_company"),
        ("Independent Consultants", "independent_not_company"),
        ("Students Union", "non_company (freelance/self-employed/student/etc)"),
        ("Ä café", None),
        ("Tata Motors", None),
    ],
)
def test_garbage(spark, cleaned, reason):
    if cleaned == "N/A":
        reason = "placeholder"
    assert one(spark, P.BALANCED.garbage, cleaned) == reason


def test_normalise(spark):
    assert one(spark, P.DEDUP.normalise, "Tata Motor Finance Ltd.") == "tata motor finance"
    assert one(spark, P.DEDUP.normalise, "Capgemini Consulting India Pvt Ltd") == one(spark, P.DEDUP.normalise, "Capgemini Technology India Pvt Ltd")
    assert one(spark, P.BALANCED.normalise, "AT & T Inc") == "att"
    assert one(spark, P.IMPROVED.normalise, "The Café & Co.") == "café and"
    assert one(spark, P.DEDUP.normalise, None) == ""


def test_tokens_and_case(spark):
    assert one(spark, lambda c: T.token_signature(c, P.DEDUP.stopwords), "the b of aa aa") == "aa aa"
    assert one(spark, T.initials, "Tata consultancy 3 Services") == "TCS"
    assert one(spark, T.title_case, "L&t o'neil") == "L&T O'Neil"
    assert one(spark, T.compact_signature, "tech mahindra india") == "techmahindra"


def test_primary_score(spark):
    score = lambda v: one(spark, lambda c: quality.primary_score(c, strict=True), v)
    assert score(None) == -10 and score("x") == -10
    assert score("Acme Ltd") == pytest.approx(2 + 1 + 8 / 30)
    assert score("ACME  #") == pytest.approx(-1 + 7 / 30 - 1 - 1)
    assert score("unknown") == pytest.approx(-1 + 7 / 30 - 5)
