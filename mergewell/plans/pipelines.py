"""From records to grouped results: one plan for all profiles, and the three that build on results.

``id`` of a result row is its record's id.  A tie in an election goes to the longer, then the older record.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import quality
from ..functions import text as T
from ..functions import vocabulary as V
from ..functions.similarity import score_column, scored_pair
from ..operators import blocking
from ..operators.components import connected_components
from ..storage import materialize
from . import profiles as P
from .profiles import Profile


def flagged_records(masters: DataFrame, profile: Profile) -> DataFrame:
    """``id, original_name, source_type, company_name, filter_reason, norm``; nothing is dropped."""
    rows = masters.where("type = 'Company'") if profile.companies_only else masters
    out = rows.select(F.col("id").cast("long").alias("id"), F.col("label").alias("original_name"), F.coalesce("type", F.lit("Unknown")).alias("source_type"))
    out = out.withColumn("company_name", profile.clean(F.col("original_name")))
    out = out.withColumn("filter_reason", profile.garbage(F.col("company_name")))
    return out.withColumn("norm", F.when(F.col("filter_reason").isNull(), profile.normalise(F.col("company_name"))))


def merge_edges(members: DataFrame, profile: Profile) -> DataFrame:
    """Accepted pairs of names as edges of their least record ids, with the score."""
    pairs = blocking.candidate_pairs(members, profile)
    scored = pairs.withColumn("s", scored_pair(profile.weights, profile.threshold, profile.rule)("a", "b", "ab", "ba"))
    return scored.where("s.merge").select(F.col("a_low").alias("id_a"), F.col("b_low").alias("id_b"), "a", "b", F.col("s.score").alias("score"))


def name_groups(names: DataFrame, profile: Profile) -> DataFrame:
    """``norm, node, grp``: every name that stands in a usable block, and its group's least record id."""
    members = materialize(blocking.usable_members(names, profile), "members")
    edges = materialize(merge_edges(members, profile), "merges")
    comp = connected_components(edges.select("id_a", "id_b"))
    usable = members.select("norm", "n", F.col("low").alias("node"), "high").distinct()
    grouped = usable.join(comp, usable.node == comp.id, "left").select("norm", "n", "node", "high", F.coalesce("component", "node").alias("grp"))
    return _split_oversized(grouped, profile) if profile.split_over else grouped


def _split_oversized(grouped: DataFrame, profile: Profile) -> DataFrame:
    """Groups of over ``split_over`` records again, by pairs at ``split_score`` alone."""
    grouped = materialize(grouped, "groups")
    big = grouped.groupBy("grp").agg(F.sum("n").alias("size")).where(F.col("size") > profile.split_over).select("grp")
    inside = grouped.join(big, "grp").select(F.lit("group").alias("strategy"), F.col("grp").cast("string").alias("key"), "norm", F.col("node").alias("low"), "high")
    pairs = blocking.candidate_pairs(inside, profile)
    scored = pairs.withColumn("s", scored_pair(profile.weights, profile.split_score, profile.rule)("a", "b", "ab", "ba")).where("s.merge")
    comp = connected_components(materialize(scored.select(F.col("a_low").alias("id_a"), F.col("b_low").alias("id_b")), "tight"))
    again = inside.select("norm").distinct().withColumn("_big", F.lit(True))
    out = grouped.join(again, "norm", "left").join(comp, grouped.node == comp.id, "left")
    return out.select("norm", "n", "node", "high", F.when(F.col("_big"), F.coalesce("component", "node")).otherwise(F.col("grp")).alias("grp"))


def elect(records: DataFrame, score: Column, group: str, name: str) -> DataFrame:
    """Adds ``primary_id``: the best record of each group, found by an aggregate that combines map-side."""
    best = records.groupBy(group).agg(F.max(F.struct(score.alias("s"), F.char_length(name).alias("l"), (-F.col("id")).alias("i"))).alias("best"))
    return records.join(best.select(group, (-F.col("best.i")).alias("primary_id")), group)


def build_result(masters: DataFrame, profile: Profile) -> DataFrame:
    """A profile's result: a row per record, garbage flagged, one primary for each group."""
    records = materialize(flagged_records(masters, profile), "records")
    valid = records.where("filter_reason IS NULL")
    groups = name_groups(blocking.names_of(valid), profile).select("norm", "grp")
    return finish_result(records, valid.join(groups, "norm", "left").withColumn("grp", F.coalesce("grp", "id")), profile)


def finish_result(records: DataFrame, grouped: DataFrame, profile: Profile) -> DataFrame:
    score = quality.primary_score(F.col("company_name"), F.col("source_type") if profile.typed_primary else None)
    chosen = elect(grouped, score, "grp", "company_name")
    good = chosen.select("id", "company_name", "original_name", "source_type", F.col("primary_id").alias("group_id"), (F.col("id") == F.col("primary_id")).cast("int").alias("is_primary"), F.lit(1).alias("is_valid"), "filter_reason")
    bad = records.where("filter_reason IS NOT NULL").select("id", "company_name", "original_name", "source_type", F.col("id").alias("group_id"), F.lit(0).alias("is_primary"), F.lit(0).alias("is_valid"), "filter_reason")
    out = good.unionByName(bad).withColumn("master_id", F.col("id"))
    columns = ["id", "company_name", "original_name", "master_id", "source_type", "group_id", "is_primary", "is_valid", "filter_reason"]
    return out.select(*[c for c in columns if profile.typed_primary or c != "source_type"])


def exact_result(masters: DataFrame, profile: Profile = P.IMPROVED) -> DataFrame:
    """Result with equal normalised names as groups, whatever their block's size."""
    records = materialize(flagged_records(masters, profile), "records")
    valid = records.where("filter_reason IS NULL")
    names = valid.where("norm <> ''").groupBy("norm").agg(F.min("id").alias("grp"))
    return finish_result(records, valid.join(names, "norm", "left").withColumn("grp", F.coalesce("grp", "id")), profile)


# --- the validated profile ---


def _round2(c: Column) -> Column:
    return F.bround(c, 2)


def local_verdict(label_a: Column, label_b: Column, norm_a: Column, norm_b: Column, score: Column) -> Column:
    """Struct ``same_company, confidence, reasoning`` from rules on two names; first rule wins."""
    stop = F.array(*[F.lit(w) for w in V.STOPWORDS])
    a, b = F.array_except(T.words(norm_a), stop), F.array_except(T.words(norm_b), stop)
    shared, some = F.size(F.array_intersect(a, b)), (F.size(a) > 0) & (F.size(b) > 0)
    overlap = shared / F.greatest(F.size(a), F.size(b), F.lit(1))
    least = shared / F.greatest(F.least(F.size(a), F.size(b)), F.lit(1))
    within = some & ((shared == F.size(a)) | (shared == F.size(b)))
    raw_a, raw_b = T.strip(label_a), T.strip(label_b)
    low_a, low_b = F.lower(raw_a), F.lower(raw_b)
    a_shorter = F.char_length(raw_a) < F.char_length(raw_b)
    low_short = F.when(F.char_length(low_a) <= F.char_length(low_b), low_a).otherwise(low_b)
    low_long = F.when(F.char_length(low_a) <= F.char_length(low_b), low_b).otherwise(low_a)
    short = F.when(a_shorter, raw_a).otherwise(raw_b)
    other = F.when(short == raw_b, T.initials(label_a)).otherwise(T.initials(label_b))
    letters = F.upper(F.replace(F.replace(short, F.lit("."), F.lit("")), F.lit(" "), F.lit("")))
    percent = lambda c: F.format_string("%.0f%%", c * 100)
    points = F.format_string("%.3f", score)

    def verdict(same: bool, confidence: Column, reason: Column) -> Column:
        return F.struct(F.lit(same).alias("same_company"), confidence.cast("double").alias("confidence"), reason.alias("reasoning"))

    rules = [
        (norm_a == norm_b, verdict(True, F.lit(0.99), F.lit("Normalised names identical."))),
        (within & (overlap >= 0.6) & (score >= 0.78), verdict(True, _round2(0.80 + 0.15 * overlap), F.concat(F.lit("Token containment ("), percent(overlap), F.lit("), score "), points, F.lit(".")))),
        ((F.char_length(low_short) >= 4) & F.contains(low_long, low_short), verdict(True, _round2(0.82 + 0.10 * score), F.concat(F.lit("Substring match, score "), points, F.lit(".")))),
        (some & F.char_length(letters).between(2, 5) & (letters == other) & (score >= 0.75), verdict(True, F.lit(0.80), F.lit("Initials match."))),
        (some & (score >= 0.82) & (least >= 0.5), verdict(True, _round2(0.95 * score), F.concat(F.lit("High score ("), points, F.lit("), "), percent(least), F.lit(" token overlap.")))),
        (some & (score >= 0.78) & (least >= 0.3), verdict(True, _round2(0.80 * score), F.concat(F.lit("Moderate score ("), points, F.lit("), "), percent(least), F.lit(" overlap.")))),
    ]
    out = verdict(False, _round2(1 - score), F.concat(F.lit("Score "), points, F.lit(" below threshold.")))
    for test, answer in reversed(rules):
        out = F.when(test, answer).otherwise(out)
    return out


def judged_by_rules(pairs: DataFrame) -> DataFrame:
    """The judge that needs no service: adds ``verdict`` to pairs ``label_a, label_b, a, b, score``."""
    return pairs.withColumn("verdict", local_verdict(F.col("label_a"), F.col("label_b"), F.col("a"), F.col("b"), F.col("score")))


#: Adds ``verdict`` to a table of pairs; a null verdict leaves a pair open.
Judge = Callable[[DataFrame], DataFrame]


def validated_dedup(masters: DataFrame, judge: Judge = judged_by_rules) -> DataFrame:
    """``masters`` with ``duplicate_status, duplicate_of, duplicate_score, ai_decision, record_type``.

    Pairs at 0.92 merge; pairs from 0.75 merge if the judge accepts them.  Every such pair is judged, so
    a probable mark does not depend on an order.  Members too unlike their primary are let go.  Where even
    the best label is poor, a title-cased record is minted above the highest id, and the old best becomes
    its duplicate with score 1.
    """
    profile = P.DEDUP
    rows = masters.where("type = 'Company'").select(F.col("id").cast("long").alias("id"), "label")
    rows = rows.where(F.char_length(T.strip(F.col("label"))) >= 2).withColumn("norm", profile.normalise(F.col("label")))
    rows = materialize(rows, "labels")
    members = materialize(blocking.usable_members(blocking.names_of(rows), profile), "members")
    edges = materialize(merge_edges(members, profile), "scored")
    auto = edges.where(F.col("score") >= P.AUTO_DUPLICATE)
    labels = rows.groupBy("norm", "label").agg(F.min("id").alias("rid"))
    open_pairs = edges.where(F.col("score") < P.AUTO_DUPLICATE).select("id_a", "id_b", "a", "b", "score")
    judged = open_pairs.join(labels.select(F.col("norm").alias("a"), F.col("label").alias("label_a"), F.col("rid").alias("rid_a")), "a")
    judged = judged.join(labels.select(F.col("norm").alias("b"), F.col("label").alias("label_b"), F.col("rid").alias("rid_b")), "b")
    judged = materialize(judge(judged), "judged")
    accepted = judged.where(F.col("verdict.same_company") & (F.col("verdict.confidence") >= P.ACCEPT_CONFIDENCE))
    comp = materialize(connected_components(auto.select("id_a", "id_b").unionAll(accepted.select("id_a", "id_b"))), "comp")
    usable = members.select("norm", F.col("low").alias("node")).distinct()
    named = usable.join(comp, usable.node == comp.id, "left").select("norm", F.coalesce("component", "node").alias("grp"))
    grouped = materialize(rows.join(named, "norm"), "grouped")
    many = grouped.groupBy("grp").count().where("count > 1").select("grp")
    grouped = grouped.join(many, "grp").withColumn("quality", quality.primary_score(F.col("label"), strict=True))
    chosen = elect(grouped, F.col("quality"), "grp", "label")
    best = chosen.where("id = primary_id").select("grp", F.col("norm").alias("best_norm"), F.col("quality").alias("best_quality"), T.strip(F.col("label")).alias("best_label"))
    chosen = chosen.join(best, "grp")
    minted = (F.col("best_quality") < P.LEAST_PRIMARY_SCORE) & ~F.col("best_label").isin("", "-")
    same = F.col("norm") == F.col("best_norm")
    chosen = chosen.withColumn("minted", minted).withColumn("score", F.when(same, F.lit(1.0)).otherwise(score_column(F.col("norm"), F.col("best_norm"), profile.weights)))
    members_kept = materialize(chosen.where((F.col("id") == F.col("primary_id")) | (F.col("score") >= P.LEAST_COHERENCE)), "kept")
    pairs_left = members_kept.groupBy("grp").agg(F.count("*").alias("size"), F.first("minted").alias("was_minted")).where("size > 1 OR was_minted")
    members_kept = members_kept.join(pairs_left.select("grp"), "grp", "left_semi")
    # Minted records are numbered above the highest id, in order of the record they replace.
    top = masters.agg(F.max("id")).first()[0] or 0
    new = members_kept.where("minted AND id = primary_id").select("grp", T.title_case(F.col("best_label")).alias("label"), "primary_id")
    existing = masters.groupBy("label").agg(F.min("id").alias("existing"))
    new = materialize(new.join(existing, "label", "left").withColumn("new_id", F.coalesce("existing", F.lit(top) + F.lit(1) + F.col("primary_id"))), "minted")
    owner = members_kept.join(new.select("grp", "new_id"), "grp", "left").withColumn("owner", F.coalesce("new_id", "primary_id"))
    verdicts = judged.select(F.col("rid_a").alias("x"), F.col("rid_b").alias("y"), F.to_json("verdict").alias("ai"))
    verdicts = verdicts.select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y"), "ai").dropDuplicates(["x", "y"])
    owner = owner.join(verdicts, (F.least("id", "primary_id") == F.col("x")) & (F.greatest("id", "primary_id") == F.col("y")), "left")
    status = owner.select(
        "id",
        F.when(F.col("id") == F.col("owner"), "primary").otherwise("duplicate").alias("status"),
        F.when(F.col("id") != F.col("owner"), F.col("owner")).alias("of"),
        F.when(F.col("id") != F.col("owner"), F.col("score")).cast("decimal(5,3)").alias("dscore"),
        F.when(F.col("id") != F.col("owner"), F.col("ai")).alias("ai"),
        "minted",
    )
    unsure = judged.where(F.col("verdict.same_company") & (F.col("verdict.confidence") < P.ACCEPT_CONFIDENCE))
    where = grouped.select("id", "grp")
    apart = unsure.select("rid_a", "rid_b", F.to_json("verdict").alias("pai")).join(where.select(F.col("id").alias("rid_a"), F.col("grp").alias("ga")), "rid_a", "left").join(where.select(F.col("id").alias("rid_b"), F.col("grp").alias("gb")), "rid_b", "left")
    apart = apart.where("ga IS NULL OR gb IS NULL OR ga <> gb")
    probable = apart.select(F.col("rid_a").alias("id"), "pai").unionAll(apart.select(F.col("rid_b").alias("id"), "pai")).groupBy("id").agg(F.min("pai").alias("pai"))
    out = masters.select(F.col("id").cast("long").alias("id"), "label", "type").join(status, "id", "left").join(probable, "id", "left")
    is_probable = F.col("pai").isNotNull() & ~F.coalesce("minted", F.lit(False))
    out = out.select(
        "id",
        "label",
        "type",
        F.when(is_probable, "probable").otherwise(F.col("status")).alias("duplicate_status"),
        F.col("of").alias("duplicate_of"),
        F.col("dscore").alias("duplicate_score"),
        F.when(is_probable, F.col("pai")).otherwise(F.col("ai")).alias("ai_decision"),
        F.lit("old").alias("record_type"),
    )
    fresh = new.where("existing IS NULL").select(F.col("new_id").alias("id"), "label", F.lit("Company").alias("type"), F.lit("primary").alias("duplicate_status"), F.lit(None).cast("long").alias("duplicate_of"), F.lit(None).cast("decimal(5,3)").alias("duplicate_score"), F.lit(None).cast("string").alias("ai_decision"), F.lit("new").alias("record_type"))
    return out.unionByName(fresh)


def final_result(marked: DataFrame) -> DataFrame:
    """``id, company_name, master_id, group_id, is_primary`` of companies; what has no mark stands alone."""
    rows = marked.where("type = 'Company'")
    group = F.when(F.col("duplicate_status") == "duplicate", F.coalesce("duplicate_of", "id")).otherwise(F.col("id"))
    primary = F.when((F.col("duplicate_status") == "duplicate") & F.col("duplicate_of").isNotNull(), 0).otherwise(1)
    return rows.select("id", F.col("label").alias("company_name"), F.col("id").alias("master_id"), group.alias("group_id"), primary.alias("is_primary"))


def dedup_results(marked: DataFrame) -> DataFrame:
    """Primaries, and duplicates beside their primary's label; a duplicate of a missing record is left out."""
    members = marked.where("duplicate_status = 'duplicate'").alias("d").join(marked.select("id", "label").alias("p"), F.col("d.duplicate_of") == F.col("p.id"))
    dup = members.select(F.col("p.id").alias("primary_id"), F.col("p.label").alias("primary_label"), F.col("d.id").alias("member_id"), F.col("d.label").alias("member_label"), F.lit("duplicate").alias("member_role"), "d.duplicate_score", "d.ai_decision", "d.record_type")
    own = marked.where("duplicate_status IN ('primary', 'probable')").select(F.col("id").alias("primary_id"), F.col("label").alias("primary_label"), F.col("id").alias("member_id"), F.col("label").alias("member_label"), F.col("duplicate_status").alias("member_role"), "duplicate_score", "ai_decision", "record_type")
    return own.unionByName(dup)


def signature_patch(result: DataFrame) -> DataFrame:
    """Groups joined where names differ only in spacing: equal compact signatures of 8 letters or more.

    A bucket of 2 to 25 rows joins its groups if it holds a joined and a split form.  Group ids become the
    least of the joined ones, and primaries are elected anew among valid rows.
    """
    norm = T.normalise(F.col("company_name"), V.SUFFIXES_MINIMAL, acronyms=True)
    words = T.distinctive(norm)
    rows = result.where("is_valid = 1").select("group_id", F.array_join(words, "").alias("sig"), F.size(words).alias("n")).where("char_length(sig) >= 8")
    bucket = rows.groupBy("sig").agg(F.count("*").alias("rows"), F.count_distinct("group_id").alias("groups"), F.bool_or(F.col("n") >= 2).alias("split"), F.bool_or(F.col("n") == 1).alias("joined"), F.min("group_id").alias("least"))
    bucket = bucket.where("rows BETWEEN 2 AND 25 AND split AND joined AND groups >= 2").select("sig", "least")
    edges = rows.join(bucket, "sig").select(F.col("group_id").alias("id_a"), F.col("least").alias("id_b"))
    comp = connected_components(materialize(edges, "patches")).select(F.col("id").alias("group_id"), F.col("component").alias("new_group"))
    moved = result.join(comp, "group_id", "left").withColumn("group_id", F.coalesce("new_group", "group_id")).drop("new_group", "is_primary")
    valid = elect(moved.where("is_valid = 1"), quality.election_score(F.col("company_name"), F.col("source_type")), "group_id", "company_name")
    valid = valid.withColumn("is_primary", (F.col("id") == F.col("primary_id")).cast("int")).drop("primary_id")
    return valid.unionByName(moved.where("is_valid <> 1").withColumn("is_primary", F.lit(0))).select(*result.columns)
