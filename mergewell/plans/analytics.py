"""Audit and quality queries over result tables and labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

VALID = "is_valid = 1"


def _n(test: str | Column) -> Column:
    return F.sum((F.expr(test) if isinstance(test, str) else test).cast("long"))


def status_counts(marked: DataFrame, by: str = "duplicate_status") -> DataFrame:
    return marked.groupBy(by).agg(F.count("*").alias("n"))


def type_summary(result: DataFrame) -> DataFrame:
    return result.groupBy("source_type").agg(F.count("*").alias("total"), _n(VALID).alias("valid"), _n("is_valid = 0").alias("invalid"), _n("is_primary = 1").alias("primaries"))


def garbage_breakdown(result: DataFrame) -> DataFrame:
    return result.where("is_valid = 0").groupBy("filter_reason").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "filter_reason")


def summary(result: DataFrame) -> DataFrame:
    """One row; the share of duplicates is null without valid rows."""
    valid, primary = _n(VALID), _n(f"{VALID} AND is_primary = 1")
    groups = F.count_distinct(F.expr(f"CASE WHEN {VALID} THEN group_id END"))
    share = F.when(valid > 0, F.round(100.0 * (valid - primary) / valid, 4))
    return result.agg(F.count("*").alias("total"), valid.alias("valid"), _n("is_valid = 0").alias("invalid"), primary.alias("primaries"), groups.alias("groups"), share.alias("dedup_percent"))


def compare(results: dict[str, DataFrame]) -> DataFrame:
    """The summary of each result, under its name."""
    out = None
    for name, r in results.items():
        row = summary(r).withColumn("profile", F.lit(name))
        out = row if out is None else out.unionByName(row)
    return out


def row_match(source: DataFrame, result: DataFrame) -> DataFrame:
    a, b = source.agg(F.count("*").alias("source_rows")), result.agg(F.count("*").alias("result_rows"))
    return a.crossJoin(b).withColumn("matches", F.col("source_rows") == F.col("result_rows"))  # one row each


def bad_primaries(result: DataFrame) -> DataFrame:
    """Valid groups with other than one primary, none included."""
    return result.where(VALID).groupBy("group_id").agg(F.sum("is_primary").cast("long").alias("primaries")).where("primaries <> 1")


def keyword_rows(result: DataFrame, keyword: str, column: str = "company_name") -> DataFrame:
    return result.where(F.col(column).ilike(f"%{keyword}%"))


def keyword_by_type(result: DataFrame, keyword: str) -> DataFrame:
    hits = keyword_rows(result, keyword)
    return hits.groupBy("source_type").agg(F.count("*").alias("n"), F.count_distinct("group_id").alias("groups"))


def keyword_hits(source: DataFrame, result: DataFrame, keywords: list[str]) -> DataFrame:
    """Hits of each keyword among source labels and result names, in one pass over each."""
    a = source.agg(*[_n(F.col("label").ilike(f"%{k}%")).alias(f"s{i}") for i, k in enumerate(keywords)])
    b = result.agg(*[_n(F.col("company_name").ilike(f"%{k}%")).alias(f"r{i}") for i, k in enumerate(keywords)])
    rows = F.array(*[F.struct(F.lit(k).alias("keyword"), F.coalesce(f"s{i}", F.lit(0)).alias("source_hits"), F.coalesce(f"r{i}", F.lit(0)).alias("result_hits")) for i, k in enumerate(keywords)])
    return a.crossJoin(b).select(F.explode(rows).alias("x")).select("x.*")


def group_sizes(result: DataFrame) -> DataFrame:
    name = F.max(F.when(F.col("is_primary") == 1, F.col("company_name")))
    return result.where(VALID).groupBy("group_id").agg(F.count("*").alias("members"), name.alias("primary_name"))


def top_groups(result: DataFrame, n: int = 10) -> DataFrame:
    return group_sizes(result).orderBy(F.desc("members"), "group_id").limit(n)


def large_groups(result: DataFrame, least: int = 5) -> DataFrame:
    return group_sizes(result).where(F.col("members") >= least)


def singleton_groups(result: DataFrame) -> DataFrame:
    return group_sizes(result).agg(_n("members = 1").alias("singletons"))


def keyword_top_groups(result: DataFrame, keywords: list[str], k: int = 3) -> DataFrame:
    """The ``k`` largest groups of each keyword, by one window for all keywords."""
    tagged = result.where(VALID).withColumn("keyword", F.explode(F.filter(F.array(*[F.lit(w) for w in keywords]), lambda w: F.lower("company_name").contains(F.lower(w)))))
    sized = tagged.groupBy("keyword", "group_id").agg(F.count("*").alias("hits"))
    w = Window.partitionBy("keyword").orderBy(F.desc("hits"), "group_id")
    return sized.withColumn("place", F.row_number().over(w)).where(F.col("place") <= k)


def group_members(result: DataFrame, groups: list[int]) -> DataFrame:
    return result.where(F.col("group_id").isin(groups)).select("group_id", "master_id", "company_name", "is_primary").orderBy("group_id", F.desc("is_primary"), "master_id")


def prefix_neighbours(result: DataFrame, width: int = 10) -> DataFrame:
    """How many pairs of primaries of different groups begin alike, by prefix; counted without making the pairs."""
    one = result.where("is_primary = 1 AND is_valid = 1").select("group_id", F.substring(F.lower("company_name"), 1, width).alias("prefix")).where(F.char_length("prefix") == width)
    m = one.groupBy("prefix", "group_id").agg(F.count("*").alias("m")).groupBy("prefix").agg(F.sum("m").alias("all"), F.sum(F.col("m") * F.col("m")).alias("same"))
    pairs = ((F.col("all") * F.col("all") - F.col("same")) / 2).cast("long")
    return m.select("prefix", pairs.alias("pairs")).where("pairs > 0")


def totals(result: DataFrame) -> DataFrame:
    """Valid groups and primaries; they agree if every group has one primary."""
    return result.where(VALID).agg(F.count_distinct("group_id").alias("groups"), _n("is_primary = 1").alias("primaries"))


def deduplicated(result: DataFrame) -> DataFrame:
    return result.where("is_primary = 1 AND is_valid = 1")


def regression_status(result: DataFrame, expected: dict[int, int]) -> DataFrame:
    """Size of named groups against the most that each may have."""
    spec = result.sparkSession.createDataFrame(sorted(expected.items()), "group_id long, most long")
    sized = result.where(VALID).groupBy("group_id").agg(F.count("*").alias("members"))
    out = spec.join(F.broadcast(spec.select("group_id")), "group_id").join(sized, "group_id", "left")
    n = F.coalesce("members", F.lit(0))
    return out.select("group_id", "most", n.alias("members"), F.when(n <= F.col("most"), "FIXED").otherwise(F.concat(F.lit("STILL BIG ("), n.cast("string"), F.lit(")"))).alias("status"))


def label_quality(masters: DataFrame) -> DataFrame:
    """Counts of dirty labels of companies in one pass."""
    t = F.trim("label")
    tests = {
        "dash_or_dot": t.isin("-", ".", ",", "--", "---", "..", "..."),
        "placeholder": F.lower(t).rlike("^(test|unknown|n/?a|none|null|na|tbd|temp|sample|dummy|xxx|zzz|abc|asdf|qwerty|-)$"),
        "short": F.char_length(t) <= 2,
        "numeric": t.rlike("^[0-9]+$"),
        "special": t.rlike("^[^a-zA-Z0-9]+$"),
        "edge_dots": t.like(".%") | t.like(",%") | t.like("%,"),
        "double_space": F.col("label").like("%  %"),
        "blank": F.col("label").isNull() | (t == ""),
        "bullet": t.like("%·%"),
        "non_company": F.lower("label").rlike("(freelanc|self.employ|unemploy|retired|student|homemaker|housewife|looking for)"),
    }
    return masters.where("type = 'Company'").agg(*[F.coalesce(_n(F.coalesce(c, F.lit(False))), F.lit(0)).alias(k) for k, c in tests.items()])


def residue(result: DataFrame) -> DataFrame:
    """Traces that cleaning should have removed, among valid names."""
    name = F.col("company_name")
    artifact = name.rlike("Full-time|Part-time|Contract|Internship|Seasonal")
    place = name.rlike(", [A-Z][a-z]+$") | name.rlike(", (India|Mumbai|Delhi|Bangalore|Chennai|Pune)")
    return result.where(VALID).agg(_n(artifact).alias("artifacts"), _n(place).alias("places"), _n(name.contains("(")).alias("parentheses"), _n(F.col("original_name").contains("·")).alias("bullets"))


def residual_labels(result: DataFrame, most: int = 20) -> DataFrame:
    """The ``most`` frequent labels with each trace that cleaning should have removed: ``kind, label, n``."""
    name, original = F.col("company_name"), F.col("original_name")
    tests = {
        "artifact": (name, name.rlike("Full-time|Part-time|Contract|Internship|Seasonal")),
        "place": (name, name.rlike(", [A-Z][a-z]+$") | name.rlike(", (India|Mumbai|Delhi|Bangalore|Chennai|Pune)")),
        "parentheses": (name, name.contains("(")),
        "bullet": (original, original.contains("·")),
    }
    found = F.filter(F.array(*[F.when(t, F.struct(F.lit(k).alias("kind"), c.alias("label"))) for k, (c, t) in tests.items()]), lambda x: x.isNotNull())
    counted = result.where(VALID).select(F.explode(found).alias("x")).groupBy("x.kind", "x.label").agg(F.count("*").alias("n"))
    place = F.row_number().over(Window.partitionBy("kind").orderBy(F.desc("n"), "label"))
    return counted.withColumn("place", place).where(F.col("place") <= most).drop("place")


def report_groups(results: DataFrame, first: int = 5, then: int = 10) -> DataFrame:
    """Groups for the report, numbered: the best validated ones, the best plain ones, then others until there are ``first + then``.

    The best have the highest least score, then most members.
    """
    members = results.where("member_role = 'duplicate'")
    g = members.groupBy("primary_id", "primary_label").agg(F.min("duplicate_score").alias("least"), F.count("*").alias("size"), F.bool_or(F.col("ai_decision").isNotNull()).alias("validated"))
    best = [F.desc("least"), F.desc("size"), F.col("primary_id")]
    few = g.where("validated").orderBy(*best).limit(first + then).unionAll(g.where("NOT validated").orderBy(*best).limit(first + then))
    few = few.withColumn("place", F.row_number().over(Window.partitionBy("validated").orderBy(*best)))  # over these rows alone
    tier = F.when(F.col("validated") & (F.col("place") <= first), 0).when(~F.col("validated") & (F.col("place") <= then), 1).otherwise(2)
    number = F.row_number().over(Window.orderBy(tier, *best))
    return few.withColumn("number", number).where(F.col("number") <= first + then).drop("place")


def report_lines(results: DataFrame) -> DataFrame:
    """The report as text, ``number, rank, line``, to be read in the order of the first two and the line."""
    groups = F.broadcast(report_groups(results).select("number", "primary_id", "validated"))  # 15 rows
    mine = results.where("member_role = 'duplicate'").join(groups, "primary_id")
    title = F.concat(F.lit("Group "), F.col("number").cast("string"), F.when(F.col("validated"), " (AI-validated):").otherwise(":"))
    primary = F.format_string('  Primary: ID=%d, Label="%s"', "primary_id", "primary_label")
    judged = F.when(F.col("ai_decision").isNotNull(), F.concat(F.lit(", AI="), F.col("ai_decision"))).otherwise("")
    member = F.concat(F.format_string('  Duplicate: ID=%d, Label="%s", Score=%.3f', "member_id", "member_label", F.col("duplicate_score").cast("double")), judged)
    heads = mine.select("number", F.explode(F.array(F.struct(F.lit(0).alias("rank"), title.alias("line")), F.struct(F.lit(1).alias("rank"), primary.alias("line")))).alias("x")).distinct()
    return heads.select("number", "x.rank", "x.line").unionAll(mine.select("number", F.lit(2).alias("rank"), member.alias("line")))


def prefix_neighbour_pairs(result: DataFrame, width: int = 10, most: int = 30) -> DataFrame:
    """The first ``most`` pairs of primaries that begin alike but stand in different groups, by prefix and group ids."""
    one = result.where("is_primary = 1 AND is_valid = 1").select(F.substring(F.lower("company_name"), 1, width).alias("prefix"), "group_id", "company_name").where(F.char_length("prefix") == width)
    # A pair among the first ones has both its rows among the first of their prefix.
    one = one.withColumn("place", F.row_number().over(Window.partitionBy("prefix").orderBy("group_id"))).where(F.col("place") <= most + 1)
    side = lambda x: one.select("prefix", F.col("group_id").alias(f"group_{x}"), F.col("company_name").alias(f"name_{x}"))
    return side("a").join(side("b"), "prefix").where("group_a < group_b").orderBy("prefix", "group_a", "group_b").limit(most)


def regression_tiers(result: DataFrame, generic: list[int], mixed: list[int]) -> DataFrame:
    """Named groups against the most members that their tier may have, 15 or 30, with the primary's name."""
    spec = result.sparkSession.createDataFrame([("generic", g) for g in generic] + [("mixed", g) for g in mixed], "tier string, group_id long")
    out = spec.join(group_sizes(result.join(F.broadcast(spec.select("group_id").distinct()), "group_id", "left_semi")), "group_id", "left")
    n = F.coalesce("members", F.lit(0))
    status = F.when(F.col("tier") == "generic", F.when(n <= 15, "FIXED").otherwise(F.concat(F.lit("STILL BIG ("), n.cast("string"), F.lit(")")))).otherwise(F.when(n <= 30, "OK").otherwise("STILL BIG"))
    return out.select("tier", "group_id", n.alias("members"), status.alias("status"), F.substring("primary_name", 1, 60).alias("primary_name"))


def keyword_groups(result: DataFrame, keywords: list[str]) -> DataFrame:
    """For each keyword, in either name of valid rows: distinct groups, and the members of the largest; in one pass."""
    hit = lambda w: F.lower("company_name").contains(F.lower(w)) | F.lower("original_name").contains(F.lower(w))
    words = F.array(*[F.lit(w) for w in keywords])
    sized = result.where(VALID).withColumn("keyword", F.explode(F.filter(words, hit))).groupBy("keyword", "group_id").agg(F.count("*").alias("n"))
    found = sized.groupBy("keyword").agg(F.count("*").alias("groups"), F.max("n").alias("largest"))
    every = result.sparkSession.createDataFrame([(w,) for w in keywords], "keyword string")
    return every.join(found, "keyword", "left").select("keyword", F.coalesce("groups", F.lit(0)).alias("groups"), F.coalesce("largest", F.lit(0)).alias("largest"))


def ordered_search(results: DataFrame, keyword: str) -> DataFrame:
    """Rows of ``dedup_results`` whose labels hold the keyword: by primary, then role from the last to the first."""
    role = F.when(F.col("member_role") == "primary", 1).when(F.col("member_role") == "duplicate", 2).otherwise(3)
    hits = results.where(F.col("primary_label").ilike(f"%{keyword}%") | F.col("member_label").ilike(f"%{keyword}%"))
    return hits.withColumn("role_order", role).orderBy("primary_id", F.desc("role_order"), "member_id")
