"""Route lineage over a feed's history, and rolling metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from feedloom.operators.graph import components

WINDOW_DAYS, PER_DAYS = 365, 30
SUMS = ("publications", "available", "pairs", "M", "T", "E", "eM", "eT", "U", "regressions", "compared", "unclassified", "raw", "renumbering", "renumbering_reported")


def route_lineage(occurrences: DataFrame, mappings: DataFrame, least: float = 0.8) -> DataFrame:
    """org_id, feed_id, uid, route_id, canonical_route_id.

    occurrences: org_id, feed_id, pair_id, side, uid, route_id; mappings: org_id, feed_id, old_uid, new_uid, old, new
    (arrays of routes), relation, confidence. Routes are one across a pair if their id stayed or one high-confidence
    one-to-one mapping says so. The name comes from the first occurrence.
    """
    if not 0 <= least <= 1:
        raise ValueError("least must be between 0 and 1")
    keys = ["org_id", "feed_id"]
    node = lambda uid, route: F.struct(F.col(uid).alias("uid"), (F.col(route) if isinstance(route, str) else route).alias("route"))
    side = lambda p: occurrences.where(F.col("side") == p).select(*keys, "pair_id", "route_id", F.col("uid").alias(p))
    same = side("old").join(side("new"), [*keys, "pair_id", "route_id"]).select(*keys, node("old", "route_id").alias("a"), node("new", "route_id").alias("b"))
    linked = mappings.where((F.col("relation") == "same") & (F.col("confidence") >= least) & (F.size("old") == 1) & (F.size("new") == 1)).select(*keys, node("old_uid", F.element_at("old", 1)).alias("a"), node("new_uid", F.element_at("new", 1)).alias("b"))
    roots = components(same.unionByName(linked), keys)
    every = occurrences.select(*keys, "uid", "route_id").distinct().withColumn("node", node("uid", "route_id"))
    seed = F.coalesce("root", "node")
    told = F.concat(F.concat_ws("/", *keys), F.lit("|"), seed["uid"].cast("string"), F.lit("|"), seed["route"].cast("string"))
    named = F.concat(F.lit("route-"), F.substring(F.sha2(told, 256), 1, 16))
    return every.join(roots, [*keys, "node"], "left").select(*keys, "uid", "route_id", named.alias("canonical_route_id"))


def regressions(published: DataFrame) -> DataFrame:
    """published with regression against the one before: a lower score, or a severe rule that was not there.

    published: org_id, feed_id, pos, uid, score, severe (ids of CRITICAL and HIGH rules that occur), rules (ids that occur).
    """
    w = W.partitionBy("org_id", "feed_id").orderBy("pos")
    score, rules = F.lag("score").over(w), F.lag("rules").over(w)
    lower = F.coalesce(F.col("score") < score, F.lit(False))
    return published.withColumn("regression", lower | F.coalesce(F.size(F.array_except("severe", rules)) > 0, F.lit(False)))


def metrics(listed: DataFrame, pairs: DataFrame, today: str) -> DataFrame:
    """Counts, ratios and frequencies of the last 365 days for each feed, and for all (feed null).

    listed: feed, published_at (date), present; pairs: feed, published_at, code, comparable, regression, unclassified,
    raw, renumbered (null: not counted). The window is open at its start. A ratio of nothing is null.
    """
    inside = (F.col("published_at") > F.date_sub(F.lit(today).cast("date"), WINDOW_DAYS)) & (F.col("published_at") <= F.lit(today).cast("date"))
    one = lambda c: F.when(c, 1).otherwise(0)
    a = listed.where(inside).select("feed", F.lit(1).alias("publications"), one(F.coalesce("present", F.lit(True))).alias("available"))
    code = F.col("code")
    b = pairs.where(inside).select(
        "feed", F.lit(1).alias("pairs"), *[one(code == c).alias(c) for c in ("M", "T", "E")], one(code == "~M").alias("eM"), one(code == "~T").alias("eT"), one(code.startswith("U")).alias("U"), one(F.col("comparable") & F.col("regression")).alias("regressions"),
        one(F.col("comparable")).alias("compared"), F.coalesce("unclassified", F.lit(0)).alias("unclassified"), F.coalesce("raw", F.lit(0)).alias("raw"), one(F.coalesce("renumbered", F.lit(False))).alias("renumbering"), one(F.col("renumbered").isNotNull()).alias("renumbering_reported"),
    )
    feeds = listed.select("feed").unionByName(pairs.select("feed")).distinct()
    both = a.unionByName(b, allowMissingColumns=True).unionByName(feeds, allowMissingColumns=True)
    sums = both.groupingSets([["feed"], []], "feed").agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in SUMS])
    ratio = lambda n, d, digits=4: F.when(d > 0, F.round(n / d, digits))
    c = {x: F.col(x) for x in SUMS}
    known = c["M"] + c["T"] + c["E"] + c["eM"] + c["eT"]
    per = WINDOW_DAYS / PER_DAYS
    return sums.select(
        "feed", *SUMS, ratio(known, c["pairs"]).alias("coverage"), ratio(c["M"] + c["T"] + c["E"], c["pairs"]).alias("exact_coverage"), F.round(c["publications"] / per, 2).alias("publication_frequency"), F.round((c["M"] + c["eM"]) / per, 2).alias("meaningful_update_frequency"),
        ratio(c["E"], known).alias("equivalent_republication_ratio"), ratio(c["T"] + c["eT"], known).alias("technical_only_change_ratio"), ratio(c["U"], c["pairs"]).alias("unknown_classification_ratio"), ratio(c["unclassified"], c["raw"], 6).alias("unclassified_diff_ratio"),
        ratio(c["available"], c["publications"]).alias("source_availability_rate"), ratio(c["renumbering"], c["renumbering_reported"]).alias("id_churn_ratio"),
    )


def compact_rules(rules: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rule_id, severity, class most often seen; ties to the first) and rules with severity and class only where they differ.

    rules: uid, rule_id, count, severity, class.
    """
    counts = rules.groupBy("rule_id", "severity", "class").agg(F.count("*").alias("n"))
    usual = counts.withColumn("place", F.row_number().over(W.partitionBy("rule_id").orderBy(F.desc("n"), "severity", "class"))).where("place = 1").select("rule_id", F.col("severity").alias("s"), F.col("class").alias("c"))
    same = (F.col("severity") == F.col("s")) & (F.col("class") == F.col("c"))
    kept = rules.join(usual, "rule_id").select("uid", "rule_id", "count", F.when(~same, F.col("severity")).alias("severity"), F.when(~same, F.col("class")).alias("class"))
    return usual.select("rule_id", F.col("s").alias("severity"), F.col("c").alias("class")), kept


def determinism(published: DataFrame, limit: int = 20) -> DataFrame:
    """Neighbours with one signature but different summaries, the first `limit`: the validator was not deterministic."""
    w = W.partitionBy("org_id", "feed_id").orderBy("pos")
    rows = published.withColumn("ps", F.lag("signature").over(w)).withColumn("pd", F.lag("summary_digest").over(w))
    return rows.where("signature = ps and summary_digest <> pd").orderBy("org_id", "feed_id", "pos").limit(limit).drop("ps", "pd")


def configuration_differences(a: DataFrame, b: DataFrame) -> DataFrame:
    """What two configurations make of the same pairs: rows of either that the other lacks, with their side."""
    return a.exceptAll(b).withColumn("side", F.lit("a")).unionByName(b.exceptAll(a).withColumn("side", F.lit("b")))
