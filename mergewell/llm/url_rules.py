"""URL filter by association rules, with DataFrame functions only.

Listed rules (host and path prefix) judge the urls they fit.  Their verdicts are the labels from
which FP-growth mines token combinations: a transaction is a judged url's token set, with its verdict
as one more item.  The confidence of a combination is taken as if both verdicts were equally common, so
it is above one half only where the combination shifts the base rate.  Combinations of at most
``LONGEST`` tokens that imply a verdict with enough support and confidence, and that no shorter rule
covers, judge the remaining urls through an inverted index: each rule is posted under its rarest token
and checked whole.  The surer verdict holds; a url that no combination fits, or both verdicts equally,
is allowed.

Scale: urls are reduced to distinct token sets before any join; a url meets its set's verdict in a join
that is broadcast if the verdicts are few, and salted otherwise, so a host with a third of all rows is
spread.  A transaction of more than ``WHOLE`` frequent tokens is given to FP-growth in parts of
``2 * LONGEST`` tokens, so that every combination of ``LONGEST`` stands whole in one of them and no host
with many labels makes it enumerate all their subsets; what it finds are candidates, whose counts
are then taken from the whole sets.  The item counts that FP-growth sends to the driver, and the list of frequent tokens, are
bounded by tokens per url over the support.  No text is read.

Defined results: a null url, or one without ``://``, has empty host and path, no rule fits it and
the method allows it, as no combination fits an empty token set; where the listed rules give one verdict
only, there is nothing to tell apart and the method allows every url; repeated rows each give a row; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import drop_materialized, materialize, salted_join

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
VERDICT = "verdict="
#: A combination needs this many urls, whatever the relative support.
LEAST_URLS = 20
#: Tokens in the longest combination.
LONGEST = 3
#: A transaction of so many tokens is mined as it is.
WHOLE = 10
#: Rows up to which rules, or verdicts of token sets, are broadcast.
BROADCAST_ROWS = 100_000


class Rule(NamedTuple):
    host: str
    path: str
    verdict: str


RULES = (
    Rule("com", "/en/", "block"),
    Rule("example.com", "/en/7", "allow"),
    Rule("net", "/de/", "allow"),
    Rule("example.net", "/de/8", "block"),
    Rule("org", "/es/", "block"),
)


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(url, r"://([^/?#]*)", 1), _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"://[^/?#]*([^?#]*)", 1), F.lit(""))


def longest_rule(host: Column, path: Column, rules: tuple[Rule, ...]) -> Column:
    """The fitting rule with the longest host and path, as a struct ``(rule, verdict)``, or null."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for r in sorted(rules, key=lambda r: (len(r.host) + len(r.path), r)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        out = F.when(fits, F.struct(F.lit(r.host + r.path).alias("rule"), F.lit(r.verdict).alias("verdict"))).otherwise(out)
    return out


def tokens_of(url: Column, host: Column, path: Column) -> Column:
    """Host labels, the last two of them, path segments with digits as 0, the shape of the last one, and query keys."""
    named = lambda kind, xs: F.transform(xs, lambda x: F.concat(F.lit(kind + ":"), x))
    labels = F.filter(F.split(host, r"\."), lambda x: x != "")
    site = F.when(F.size(labels) >= 2, F.array(F.concat_ws(".", F.slice(labels, -2, 2)))).otherwise(F.array().cast("array<string>"))
    segments = F.transform(F.filter(F.split(path, "/"), lambda x: x != ""), lambda x: F.regexp_replace(x, "[0-9]+", "0"))
    tail = F.transform(F.slice(F.reverse(segments), 1, 1), lambda x: F.regexp_replace(x, r"^[^.]{16,}", "long"))
    query = F.split(F.regexp_extract(F.coalesce(url, F.lit("")), r"\?([^#]*)", 1), "&")
    keys = F.filter(F.transform(query, lambda x: F.substring_index(x, "=", 1)), lambda x: x != "")
    return F.array_sort(F.array_distinct(F.concat(named("host", labels), named("site", site), named("path", segments), named("tail", tail), named("query", keys))))


def _parts(tokens: Column) -> Column:
    """Arrays of at most ``2 * LONGEST`` tokens; any ``LONGEST`` of the tokens stand together in one."""
    last = F.floor((F.size(tokens) - 1) / 2).cast("int")
    block = lambda i: F.slice(tokens, 2 * i + 1, F.lit(2))
    later = lambda i: F.when(i < last, F.sequence(i + 1, last)).otherwise(F.array().cast("array<int>"))
    rows = lambda i: F.flatten(F.transform(later(i), lambda j: F.transform(later(j), lambda k: F.concat(block(i), block(j), block(k)))))
    return F.flatten(F.transform(F.sequence(F.lit(0), last), rows))


def _posted(sets: DataFrame, rules: DataFrame) -> DataFrame:
    """Rows of ``sets`` beside every row of ``rules`` whose ``items`` they hold; rules stand under ``anchor``."""
    few = rules.count() <= BROADCAST_ROWS
    rows = sets.withColumn("anchor", F.explode("tokens"))
    met = rows.join(F.broadcast(rules), "anchor") if few else salted_join(rows, rules, ["anchor"], ["tokens"])
    return met.where(F.size(F.array_except("items", "tokens")) == 0)


def mine_rules(sets: DataFrame, min_support: float, min_confidence: float) -> DataFrame:
    """``(rule_id, items, anchor, implies, confidence)`` from judged token sets ``(tokens, verdict, n)``, ``n`` urls each."""
    spark = sets.sparkSession
    empty = spark.createDataFrame([], "rule_id long, items array<string>, anchor string, implies string, confidence double")
    judged = {r["verdict"]: r["n"] for r in sets.groupBy("verdict").agg(F.sum("n").alias("n")).collect()}  # two rows
    if len(judged) < 2:
        return empty
    total = sum(judged.values())
    least = max(min_support * total, min(LEAST_URLS, total))
    # At most a url's tokens over the support, so a short list at any size.
    counts = sets.select("n", F.explode("tokens").alias("token")).groupBy("token").agg(F.sum("n").alias("df"))
    frequent = materialize(counts.where(F.col("df") >= least), "urltokens")
    known = F.array_sort(F.array_intersect("tokens", "known"))
    rows = sets.join(F.broadcast(frequent.agg(F.coalesce(F.collect_list("token"), F.array().cast("array<string>")).alias("known"))), how="cross")  # one row
    # Copies of a set are dealt in chunks, so that a set with a third of all urls is many tasks' work.
    rows = rows.select(known.alias("tokens"), "verdict", "n").withColumn("chunk", F.explode(F.sequence(F.lit(0), F.floor((F.col("n") - 1) / 1024))))
    rows = rows.repartition("tokens", "verdict", "chunk").withColumn("copy", F.explode(F.sequence(F.lit(1), F.least(F.lit(1024), F.col("n") - F.col("chunk") * 1024))))
    parts = F.when(F.size("tokens") <= WHOLE, F.array("tokens")).otherwise(_parts(F.col("tokens")))
    baskets = rows.select(F.explode(parts).alias("part"), "verdict").select(F.concat("part", F.array(F.concat(F.lit(VERDICT), "verdict"))).alias("items"))
    baskets = materialize(baskets, "urlbaskets")
    n = baskets.count()
    found = FPGrowth(itemsCol="items", minSupport=min(1.0, max(0.0, least - 0.5) / n)).fit(baskets).freqItemsets
    of = F.filter("items", lambda x: ~x.startswith(VERDICT))
    itemsets = found.where(F.size(of).between(1, LONGEST) & (F.size(of) < F.size("items"))).select(F.array_sort(of).alias("items")).distinct()
    itemsets = materialize(itemsets.withColumn("rule_id", F.xxhash64("items")), "urlitems")
    rarest = itemsets.select("rule_id", F.explode("items").alias("token")).join(F.broadcast(frequent), "token").groupBy("rule_id").agg(F.min(F.struct("df", "token")).alias("r"))
    posted = materialize(itemsets.join(rarest, "rule_id").select("rule_id", "items", F.col("r.token").alias("anchor")), "urlanchors")
    held = _posted(sets, posted).groupBy("rule_id", "items", "anchor").agg(*[F.sum(F.when(F.col("verdict") == v, F.col("n")).otherwise(0)).alias(v) for v in ("block", "allow")])
    sides = F.explode(F.array(*[F.struct(F.lit(v).alias("implies"), F.col(v).alias("mine"), F.col(o).alias("other"), F.lit(float(judged[v])).alias("all_mine"), F.lit(float(judged[o])).alias("all_other")) for v, o in (("block", "allow"), ("allow", "block"))]))
    rules = held.select("rule_id", "items", "anchor", sides.alias("s")).select("rule_id", "items", "anchor", "s.*").where(F.col("mine") >= least)
    mine, other = F.col("mine") / F.col("all_mine"), F.col("other") / F.col("all_other")
    rules = rules.withColumn("confidence", mine / (mine + other)).where(F.col("confidence") >= min_confidence - 1e-9)
    rules = materialize(rules.select(F.xxhash64("items", "implies").alias("rule_id"), "items", "anchor", "implies", "confidence"), "urlrules")
    drop_materialized(baskets, itemsets, posted, frequent)
    # A rule with a subset that is as sure adds nothing; the subset is posted under one of its items.
    wide = rules.select(F.col("rule_id").alias("wide_id"), F.col("items").alias("wide"), F.col("confidence").alias("sure"), "implies", F.explode("items").alias("anchor"))
    covered = wide.join(rules, ["anchor", "implies"]).where((F.size("items") < F.size("wide")) & (F.size(F.array_except("items", "wide")) == 0) & (F.col("confidence") >= F.col("sure")))
    return rules.join(covered.select(F.col("wide_id").alias("rule_id")).distinct(), "rule_id", "left_anti").select("rule_id", "items", "anchor", "implies", "confidence")


def judge_urls(pages: DataFrame, rules: tuple[Rule, ...] = RULES, min_support: float = 0.002, min_confidence: float = 0.8, learn_from: Column | None = None) -> DataFrame:
    """``page_id, host, path, rule, verdict, n_mined, mined_verdict``, a row per row of ``pages``.

    ``learn_from`` may keep judged urls out of the mining, to measure what it says of them: ``mined_verdict`` is
    the method's for every url, null where no combination fits.
    """
    url = F.col("url")
    parsed = pages.select(F.col("page_id").cast("long").alias("page_id"), url, host_of(url).alias("host"), path_of(url).alias("path"))
    parsed = parsed.withColumn("fit", longest_rule(F.col("host"), F.col("path"), rules)).withColumn("tokens", tokens_of(url, F.col("host"), F.col("path")))
    learns = F.col("fit").isNotNull() & (F.lit(True) if learn_from is None else learn_from)
    sets = parsed.groupBy("tokens", F.when(learns, F.col("fit.verdict")).alias("verdict")).agg(F.count("*").alias("n"))
    sets = materialize(sets, "urlsets")
    mined = materialize(mine_rules(sets.where("verdict is not null"), min_support, min_confidence), "urlmined")
    sure = lambda verdict: F.coalesce(F.max(F.when(F.col("implies") == verdict, F.col("confidence"))), F.lit(0.0))
    hit = _posted(sets.select("tokens").distinct(), mined).groupBy("tokens").agg((sure("block") > sure("allow")).alias("blocks"), F.count("*").alias("n_rules"))
    hit = materialize(hit, "urlhits")
    out = parsed.join(F.broadcast(hit), "tokens", "left") if hit.count() <= BROADCAST_ROWS else salted_join(parsed, hit, ["tokens"], ["page_id"], "left")
    method = F.when(F.col("blocks"), F.lit("block")).when(~F.col("blocks"), F.lit("allow"))
    drop_materialized(sets, mined)
    return out.select(
        "page_id",
        "host",
        "path",
        F.col("fit.rule").alias("rule"),
        F.coalesce("fit.verdict", method, F.lit("allow")).alias("verdict"),
        F.coalesce("n_rules", F.lit(0)).cast("long").alias("n_mined"),
        method.alias("mined_verdict"),
    )
