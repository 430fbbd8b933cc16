"""Registered queries of the engine, with SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions import vocabulary as V
from ..functions.similarity import metric_columns
from ..operators import blocking
from ..operators.components import connected_components
from ..sources import masters as S
from ..sources import sinks
from ..storage import materialize
from . import analytics as A
from . import oracle as O
from . import pipelines as L
from . import profiles as P

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}

_RESULT = "WITH " + O.exact_result(P.IMPROVED) + " "
_KEYWORDS = ["gear", "bolt", "finance", "steel"]


def _add(name: str, query: Query, sql: str | None = None) -> None:
    QUERIES[name] = query
    if sql is not None:
        ORACLE_SQL[name] = sql


def _on_masters(f: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, d: f(S.derived_masters(spark, d))


def _on_result(f: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, d: f(L.exact_result(S.derived_masters(spark, d), P.IMPROVED))


def _flagged(m: DataFrame, p: P.Profile) -> DataFrame:
    """Cleaned records as a written table, so that later expressions never repeat the cleaning."""
    return materialize(L.flagged_records(m, p), "flagged")


def _lists() -> str:
    stop = ", ".join(f"'{w}'" for w in V.STOPWORDS)
    return f"list_filter(string_split(norm, ' '), lambda w: w <> '' AND w NOT IN ({stop}) AND length(w) > 1)"


# Scans.
_M = f"WITH masters AS ({S.masters_sql()}) "
_add("scan_companies", _on_masters(S.companies), _M + "SELECT id, label FROM masters WHERE type = 'Company'")
_add("scan_all_types", _on_masters(S.all_types), _M + "SELECT id, label, type FROM masters")
_add("scan_not_blank", _on_masters(S.not_blank), _M + "SELECT id, label, type FROM masters WHERE label IS NOT NULL AND trim(label) <> ''")
_add("scan_valid_rows", _on_result(lambda r: S.valid_rows(r).select("id", "company_name", "group_id")), _RESULT + "SELECT id, company_name, group_id FROM result WHERE is_valid = 1")
_add("scan_label_samples", _on_masters(S.sample_labels), _M + "SELECT DISTINCT trim(label) AS label FROM masters WHERE trim(label) <> '' ORDER BY label LIMIT 20")
_add("catalog_columns", _on_masters(lambda m: S.columns_of(m).select("name", "type")))

# Cleaning, garbage and names, for each profile that cleans.
for _p in (P.AGGRESSIVE, P.AGGRESSIVE_ALL, P.ULTRA, P.IMPROVED, P.BALANCED):
    _add(
        f"clean_{_p.name}",
        _on_masters(lambda m, p=_p: L.flagged_records(m, p).select("id", "company_name", "filter_reason", "norm")),
        "WITH " + O.flagged(_p) + " SELECT id, company_name, filter_reason, norm FROM flagged",
    )
_add("normalise_dedup", _on_masters(lambda m: m.select("id", P.DEDUP.normalise(F.col("label")).alias("norm"))), _M + f"SELECT id, {O.normalise('label', P.DEDUP)} AS norm FROM masters")
_add(
    "token_signatures",
    _on_masters(lambda m: _flagged(m, P.BALANCED).where("norm IS NOT NULL").select("id", T.token_signature(F.col("norm"), V.STOPWORDS).alias("sig"), F.array_join(F.slice(T.significant(F.col("norm"), V.STOPWORDS), 1, 2), " ").alias("core"))),
    "WITH " + O.flagged(P.BALANCED) + f" SELECT id, array_to_string(list_sort({_lists()}), ' ') AS sig, array_to_string(list_slice({_lists()}, 1, 2), ' ') AS core FROM flagged WHERE norm IS NOT NULL",
)
_add(
    "compact_signatures",
    _on_masters(lambda m: _flagged(m, P.BALANCED).where("norm IS NOT NULL").select("id", T.compact_signature(F.col("norm")).alias("sig"))),
    "WITH " + O.flagged(P.BALANCED) + f" SELECT id, array_to_string(list_filter({_lists()}, lambda w: w NOT IN ({', '.join(repr(w) for w in sorted(V.GENERIC_SIGNATURE))})), '') AS sig FROM flagged WHERE norm IS NOT NULL",
)
_add(
    "title_and_initials",
    _on_masters(lambda m: m.where("label IS NOT NULL").select("id", T.title_case(F.col("label")).alias("title"), T.initials(F.col("label")).alias("initials"))),
    _M + O.TITLE_AND_INITIALS,
)
for _p in (P.AGGRESSIVE, P.ULTRA, P.BALANCED):
    _add(f"clean_hostile_{_p.name}", lambda spark, d, p=_p: L.flagged_records(spark.createDataFrame([(i, x, "Company") for i, x in enumerate(O.HOSTILE)], "id long, label string, type string"), p).select("id", "company_name", "filter_reason", "norm"), O.hostile(_p))

# Blocks and pairs.
_P3 = "SELECT 'prefix3' AS strategy, substr(norm, 1, 3) AS key, id, norm FROM flagged WHERE length(norm) >= 3"
_SIG = f"SELECT 'signature', array_to_string(list_sort({_lists()}), ' '), id, norm FROM flagged WHERE len({_lists()}) > 1"
_BLOCKS = "WITH " + O.flagged(P.AGGRESSIVE_ALL) + f", keys AS ({_P3} UNION ALL {_SIG}), sizes AS (SELECT strategy, key, count(*) AS size FROM keys GROUP BY ALL) "


def _names(m: DataFrame, p: P.Profile) -> DataFrame:
    return blocking.names_of(_flagged(m, p).where("filter_reason IS NULL"))


_add("block_sizes", _on_masters(lambda m: blocking.block_sizes(blocking.block_members(_names(m, P.AGGRESSIVE_ALL), P.AGGRESSIVE_ALL))), _BLOCKS + "SELECT strategy, key, CAST(size AS BIGINT) AS size FROM sizes")
_add(
    "candidate_pairs",
    _on_masters(lambda m: blocking.candidate_pairs(blocking.usable_members(_names(m, P.AGGRESSIVE_ALL), P.AGGRESSIVE_ALL), P.AGGRESSIVE_ALL, prune=False).select("a", "b")),
    _BLOCKS + ", ok AS (SELECT DISTINCT strategy, key, norm FROM keys JOIN sizes USING (strategy, key) WHERE size BETWEEN 2 AND 500) SELECT DISTINCT x.norm AS a, y.norm AS b FROM ok x JOIN ok y ON x.strategy = y.strategy AND x.key = y.key AND x.norm < y.norm",
)
for _p in (P.ULTRA, P.IMPROVED, P.BALANCED):
    _add(f"candidate_pairs_{_p.name}", _on_masters(lambda m, p=_p: blocking.candidate_pairs(blocking.usable_members(_names(m, p), p), p, prune=False).select("a", "b", "ab", "ba")), O.candidate_pairs(_p))
_add(
    "similarity_metrics",
    _on_masters(lambda m: blocking.candidate_pairs(blocking.usable_members(_names(m, P.BALANCED), P.BALANCED), P.BALANCED, prune=False).withColumn("m", metric_columns(F.col("a"), F.col("b"), P.BALANCED.weights)).select("a", "b", *[F.round(f"m.{c}", 6).alias(c) for c in ("tsr", "tse", "rat", "par", "score")])),
)

# Components of orders and the parts on their lines, over every row of lineitem.
_add(
    "connected_components",
    lambda spark, d: connected_components(spark.read.parquet(f"{d.rstrip('/')}/lineitem.parquet").select(F.col("l_orderkey").alias("id_a"), (F.col("l_partkey") + 1_000_000).alias("id_b"))),
    O.COMPONENTS,
)

# Whole profiles.
_add("result_exact", _on_result(lambda r: r), _RESULT + "SELECT * FROM result")
for _p in (P.AGGRESSIVE, P.AGGRESSIVE_ALL, P.ULTRA, P.IMPROVED, P.BALANCED):
    _add(f"result_{_p.name}", _on_masters(lambda m, p=_p: L.build_result(m, p)))
_add("result_patched", _on_result(L.signature_patch))
_add("dedup_marked", _on_masters(L.validated_dedup))
_add("dedup_final_result", _on_masters(lambda m: L.final_result(L.validated_dedup(m))))
_add("dedup_results", _on_masters(lambda m: L.dedup_results(L.validated_dedup(m))))
_add("dedup_report", _on_masters(lambda m: A.report_groups(L.dedup_results(L.validated_dedup(m)))))
_add("dedup_search", _on_masters(lambda m: A.ordered_search(L.dedup_results(L.validated_dedup(m)), "gear")))
_add("dedup_status_counts", _on_masters(lambda m: A.status_counts(L.validated_dedup(m))))
_add("run_audit", _on_masters(lambda m: sinks.run_audit(L.validated_dedup(m), "dry_run").drop("run_id", "executed_at")))
_add("reset_run", _on_masters(sinks.reset_run), _M + "SELECT id, label, type, NULL::VARCHAR AS duplicate_status, NULL::BIGINT AS duplicate_of, NULL::DECIMAL(5,3) AS duplicate_score, NULL::VARCHAR AS ai_decision, 'old' AS record_type FROM masters")

# What builds on marks, over marks that SQL can state too.
_K = f"WITH marked AS ({S.marked_sql()}) "
_R = _K.rstrip() + ", " + O.RESULTS + " "


def _on_marked(f: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, d: f(S.marked_masters(spark, d))


_add("marked_status_counts", _on_marked(A.status_counts), _K + "SELECT duplicate_status, count(*) AS n FROM marked GROUP BY duplicate_status")
_add("marked_final_result", _on_marked(lambda m: sinks.conform(L.final_result(m), sinks.FINAL_SCHEMA)), _K + O.FINAL_RESULT)
_add("marked_results", _on_marked(L.dedup_results), _R + "SELECT * FROM results")
_add("marked_report", _on_marked(lambda m: A.report_groups(L.dedup_results(m))), _R.rstrip() + ", " + O.REPORT)
_add(
    "marked_search",
    _on_marked(lambda m: A.ordered_search(L.dedup_results(m), "gear")),
    _R + "SELECT *, CASE member_role WHEN 'primary' THEN 1 WHEN 'duplicate' THEN 2 ELSE 3 END AS role_order FROM results WHERE primary_label ILIKE '%gear%' OR member_label ILIKE '%gear%'",
)
_add(
    "marked_run_audit",
    _on_marked(lambda m: sinks.run_audit(m, "apply", "fixed marks").drop("run_id", "executed_at")),
    _K + "SELECT 'apply' AS mode, count(*) AS total_company_rows, count(DISTINCT CASE WHEN duplicate_status = 'duplicate' THEN duplicate_of END) AS duplicate_groups, count(*) FILTER (duplicate_status = 'duplicate') AS duplicate_rows, count(*) FILTER (duplicate_status = 'probable') AS probable_rows, 'fixed marks' AS notes FROM marked",
)
_add("marked_reset", _on_marked(sinks.reset_run), _K + "SELECT id, label, type, NULL::VARCHAR AS duplicate_status, NULL::BIGINT AS duplicate_of, NULL::DECIMAL(5,3) AS duplicate_score, NULL::VARCHAR AS ai_decision, record_type FROM marked WHERE record_type <> 'new'")
_add("dedup_report_lines", _on_marked(lambda m: A.report_lines(L.dedup_results(m))))

# Analytics.
_SIZES = "sizes AS (SELECT group_id, count(*) AS members, max(CASE WHEN is_primary = 1 THEN company_name END) AS primary_name FROM result WHERE is_valid = 1 GROUP BY group_id) "
_add("type_distribution", _on_masters(lambda m: A.status_counts(m, "type")), _M + "SELECT type, count(*) AS n FROM masters GROUP BY type")
_add("type_summary", _on_result(A.type_summary), _RESULT + "SELECT source_type, count(*) AS total, CAST(sum(is_valid) AS BIGINT) AS valid, CAST(sum(1 - is_valid) AS BIGINT) AS invalid, CAST(sum(is_primary) AS BIGINT) AS primaries FROM result GROUP BY source_type")
_add("garbage_breakdown", _on_result(A.garbage_breakdown), _RESULT + "SELECT filter_reason, count(*) AS n FROM result WHERE is_valid = 0 GROUP BY filter_reason")
_SUMMARY = "count(*) AS total, CAST(sum(is_valid) AS BIGINT) AS valid, CAST(sum(1 - is_valid) AS BIGINT) AS invalid, CAST(sum(is_valid * is_primary) AS BIGINT) AS primaries, count(DISTINCT CASE WHEN is_valid = 1 THEN group_id END) AS groups, round(100.0::DOUBLE * (sum(is_valid) - sum(is_valid * is_primary)) / sum(is_valid), 4) AS dedup_percent"
_add("summary", _on_result(A.summary), _RESULT + f"SELECT {_SUMMARY} FROM result")
_add("compare_profiles", lambda spark, d: A.compare({"exact": L.exact_result(S.derived_masters(spark, d)), "aggressive_all": L.build_result(S.derived_masters(spark, d), P.AGGRESSIVE_ALL)}))
_add("row_match", lambda spark, d: A.row_match(S.derived_masters(spark, d), L.exact_result(S.derived_masters(spark, d))), _RESULT + "SELECT (SELECT count(*) FROM masters) AS source_rows, (SELECT count(*) FROM result) AS result_rows, (SELECT count(*) FROM masters) = (SELECT count(*) FROM result) AS matches")
_add("bad_primaries", _on_result(A.bad_primaries), _RESULT + "SELECT group_id, CAST(sum(is_primary) AS BIGINT) AS primaries FROM result WHERE is_valid = 1 GROUP BY group_id HAVING sum(is_primary) <> 1")
_add("keyword_rows", _on_result(lambda r: A.keyword_rows(r, "gear").select("id", "company_name", "group_id")), _RESULT + "SELECT id, company_name, group_id FROM result WHERE company_name ILIKE '%gear%'")
_add("keyword_by_type", _on_result(lambda r: A.keyword_by_type(r, "gear")), _RESULT + "SELECT source_type, count(*) AS n, count(DISTINCT group_id) AS groups FROM result WHERE company_name ILIKE '%gear%' GROUP BY source_type")
_add(
    "keyword_hits",
    lambda spark, d: A.keyword_hits(S.derived_masters(spark, d), L.exact_result(S.derived_masters(spark, d)), _KEYWORDS),
    _RESULT + " UNION ALL ".join(f"SELECT '{k}' AS keyword, (SELECT count(*) FROM masters WHERE label ILIKE '%{k}%') AS source_hits, (SELECT count(*) FROM result WHERE company_name ILIKE '%{k}%') AS result_hits" for k in _KEYWORDS),
)
_add("top_groups", _on_result(A.top_groups), _RESULT + f", {_SIZES} SELECT * FROM sizes ORDER BY members DESC, group_id LIMIT 10")
_add("large_groups", _on_result(A.large_groups), _RESULT + f", {_SIZES} SELECT * FROM sizes WHERE members >= 5")
_add("singleton_groups", _on_result(A.singleton_groups), _RESULT + f", {_SIZES} SELECT count(*) AS singletons FROM sizes WHERE members = 1")
_add(
    "keyword_top_groups",
    _on_result(lambda r: A.keyword_top_groups(r, _KEYWORDS)),
    _RESULT + f", hits AS (SELECT keyword, group_id, count(*) AS hits FROM result, (SELECT unnest([{', '.join(repr(k) for k in _KEYWORDS)}]) AS keyword) WHERE is_valid = 1 AND contains(lower(company_name), keyword) GROUP BY ALL) SELECT keyword, group_id, hits, CAST(row_number() OVER w AS INT) AS place FROM hits WINDOW w AS (PARTITION BY keyword ORDER BY hits DESC, group_id) QUALIFY row_number() OVER w <= 3",
)
_add("group_members", _on_result(lambda r: A.group_members(r, [19, 38, 57, 15, 16])), _RESULT + "SELECT group_id, master_id, company_name, is_primary FROM result WHERE group_id IN (19, 38, 57, 15, 16)")
_add(
    "prefix_neighbours",
    _on_result(A.prefix_neighbours),
    _RESULT + ", one AS (SELECT group_id, substr(lower(company_name), 1, 10) AS prefix FROM result WHERE is_primary = 1 AND is_valid = 1) SELECT a.prefix AS prefix, count(*) AS pairs FROM one a JOIN one b ON a.prefix = b.prefix AND a.group_id < b.group_id WHERE length(a.prefix) = 10 GROUP BY a.prefix",
)
_add("totals", _on_result(A.totals), _RESULT + "SELECT count(DISTINCT group_id) AS groups, CAST(sum(is_primary) AS BIGINT) AS primaries FROM result WHERE is_valid = 1")
_add("deduplicated_view", _on_result(A.deduplicated), _RESULT + "SELECT * FROM result WHERE is_primary = 1 AND is_valid = 1")
_add(
    "regression_status",
    _on_result(lambda r: A.regression_status(r, {15: 15, 16: 30, 17: 1})),
    _RESULT + "SELECT e.g AS group_id, e.most AS most, count(r.id) AS members, CASE WHEN count(r.id) <= e.most THEN 'FIXED' ELSE 'STILL BIG (' || count(r.id) || ')' END AS status FROM (VALUES (15, 15), (16, 30), (17, 1)) AS e(g, most) LEFT JOIN result r ON r.group_id = e.g AND r.is_valid = 1 GROUP BY e.g, e.most",
)
_add(
    "label_quality",
    _on_masters(A.label_quality),
    _M
    + r"""SELECT CAST(count(*) FILTER (t IN ('-', '.', ',', '--', '---', '..', '...')) AS BIGINT) AS dash_or_dot,
      count(*) FILTER (regexp_matches(lower(t), '^(test|unknown|n/?a|none|null|na|tbd|temp|sample|dummy|xxx|zzz|abc|asdf|qwerty|-)$')) AS placeholder,
      count(*) FILTER (length(t) <= 2) AS short, count(*) FILTER (regexp_matches(t, '^[0-9]+$')) AS numeric, count(*) FILTER (regexp_matches(t, '^[^a-zA-Z0-9]+$')) AS special,
      count(*) FILTER (t LIKE '.%' OR t LIKE ',%' OR t LIKE '%,') AS edge_dots, count(*) FILTER (label LIKE '%  %') AS double_space, count(*) FILTER (label IS NULL OR t = '') AS blank,
      count(*) FILTER (t LIKE '%·%') AS bullet, count(*) FILTER (regexp_matches(lower(label), '(freelanc|self.employ|unemploy|retired|student|homemaker|housewife|looking for)')) AS non_company
      FROM (SELECT label, trim(label) AS t FROM masters WHERE type = 'Company')""",
)
_add(
    "residue",
    _on_result(A.residue),
    _RESULT + "SELECT count(*) FILTER (regexp_matches(company_name, 'Full-time|Part-time|Contract|Internship|Seasonal')) AS artifacts, count(*) FILTER (regexp_matches(company_name, ', [A-Z][a-z]+$') OR regexp_matches(company_name, ', (India|Mumbai|Delhi|Bangalore|Chennai|Pune)')) AS places, count(*) FILTER (contains(company_name, '(')) AS parentheses, count(*) FILTER (contains(original_name, '·')) AS bullets FROM result WHERE is_valid = 1",
)
_add(
    "prefix_neighbour_pairs",
    _on_result(A.prefix_neighbour_pairs),
    _RESULT + ", one AS (SELECT group_id, company_name, substr(lower(company_name), 1, 10) AS prefix FROM result WHERE is_primary = 1 AND is_valid = 1) SELECT a.prefix AS prefix, a.group_id AS group_a, a.company_name AS name_a, b.group_id AS group_b, b.company_name AS name_b FROM one a JOIN one b ON a.prefix = b.prefix AND a.group_id < b.group_id WHERE length(a.prefix) = 10 ORDER BY a.prefix, a.group_id, b.group_id LIMIT 30",
)
_add(
    "bad_primaries_planted",
    _on_result(lambda r: A.bad_primaries(r.withColumn("is_primary", F.when(F.col("id") % 37 == 5, 1 - F.col("is_primary")).otherwise(F.col("is_primary"))))),
    _RESULT + "SELECT group_id, CAST(sum(p) AS BIGINT) AS primaries FROM (SELECT *, CASE WHEN id % 37 = 5 THEN 1 - is_primary ELSE is_primary END AS p FROM result) WHERE is_valid = 1 GROUP BY group_id HAVING sum(p) <> 1",
)
_KINDS = (
    "SELECT 'artifact' AS kind, company_name AS label FROM result WHERE is_valid = 1 AND regexp_matches(company_name, 'Full-time|Part-time|Contract|Internship|Seasonal') "
    "UNION ALL SELECT 'place', company_name FROM result WHERE is_valid = 1 AND (regexp_matches(company_name, ', [A-Z][a-z]+$') OR regexp_matches(company_name, ', (India|Mumbai|Delhi|Bangalore|Chennai|Pune)')) "
    "UNION ALL SELECT 'parentheses', company_name FROM result WHERE is_valid = 1 AND contains(company_name, '(') UNION ALL SELECT 'bullet', original_name FROM result WHERE is_valid = 1 AND contains(original_name, '·')"
)
_add("residual_labels", _on_result(A.residual_labels), _RESULT + f", kinds AS ({_KINDS}), counted AS (SELECT kind, label, count(*) AS n FROM kinds GROUP BY ALL) SELECT kind, label, n FROM counted QUALIFY row_number() OVER (PARTITION BY kind ORDER BY n DESC, label) <= 20")
_add(
    "regression_tiers",
    _on_result(lambda r: A.regression_tiers(r, [15, 16, 17], [15, 18, 99999999])),
    _RESULT + f", {_SIZES}, e(tier, g) AS (VALUES ('generic', 15), ('generic', 16), ('generic', 17), ('mixed', 15), ('mixed', 18), ('mixed', 99999999)) SELECT tier, CAST(g AS BIGINT) AS group_id, coalesce(members, 0) AS members, CASE WHEN tier = 'generic' THEN CASE WHEN coalesce(members, 0) <= 15 THEN 'FIXED' ELSE 'STILL BIG (' || members || ')' END WHEN coalesce(members, 0) <= 30 THEN 'OK' ELSE 'STILL BIG' END AS status, substr(primary_name, 1, 60) AS primary_name FROM e LEFT JOIN sizes ON group_id = g",
)
_add(
    "keyword_groups",
    _on_result(lambda r: A.keyword_groups(r, _KEYWORDS)),
    _RESULT + f", k AS (SELECT unnest([{', '.join(repr(k) for k in _KEYWORDS)}]) AS keyword), hits AS (SELECT keyword, group_id, count(*) AS n FROM result, k WHERE is_valid = 1 AND (contains(lower(company_name), keyword) OR contains(lower(original_name), keyword)) GROUP BY ALL) SELECT keyword, count(group_id) AS groups, coalesce(max(n), 0) AS largest FROM k LEFT JOIN hits USING (keyword) GROUP BY keyword",
)
