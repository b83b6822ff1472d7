"""Publications of a feed in order, the pairs they form, and what is left to do for them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from feedloom.functions import scalar as s

FEED = ["org_id", "feed_id"]
PAGE_BACK, RECENT_DAYS = 3, 60


def ordered(generations: DataFrame) -> DataFrame:
    """generations with pos (oldest 1) within the feed: by from_date, missing publication instants first, uid.

    Those without a date are last, by uid, and not orderable.
    """
    date, at = s.iso_date(F.col("from_date")), s.instant(F.col("published_at"))
    w = W.partitionBy(*FEED).orderBy(date.isNull(), date, at.isNotNull(), at, "uid")
    return generations.withColumn("orderable", date.isNotNull()).withColumn("pos", F.row_number().over(w))


def rid_order_matches(positioned: DataFrame) -> DataFrame:
    """Per feed, whether the source's positions (newest first) agree with our order."""
    rank = s.rid_rank(F.col("rid"))
    both = positioned.where(F.col("orderable") & rank.isNotNull()).withColumn("a", F.row_number().over(W.partitionBy(*FEED).orderBy(F.desc("pos")))).withColumn("b", F.row_number().over(W.partitionBy(*FEED).orderBy(rank, F.desc("pos"))))
    return both.groupBy(*FEED).agg(F.bool_and(F.col("a") == F.col("b")).alias("matches"))


def feed_index(generations: DataFrame, analyses: DataFrame, digests: DataFrame, source_changed: DataFrame) -> DataFrame:
    """One row per analysed publication and key, in order, with source_status and equivalent_to_previous.

    analyses: uid, key, status; digests: uid, key, digest; source_changed: uid. Equivalent is what has the digest of the
    publication before it under the same key; unordered ones are passed over, a missing digest is never equivalent.
    """
    base = ordered(generations).join(source_changed.select("uid", F.lit(True).alias("replaced")), "uid", "left")
    status = F.when(~F.coalesce("present", F.lit(True)), "SOURCE_UNAVAILABLE").when(F.col("replaced"), "SOURCE_CHANGED").when(~F.col("orderable"), "ORDERING_UNKNOWN").otherwise("AVAILABLE")
    each = base.withColumn("source_status", status).join(analyses, "uid", "left").join(digests, ["uid", "key"], "left")
    keys = each.where("key is not null").select(*FEED, "key").distinct()
    chain = base.withColumn("source_status", status).where("source_status <> 'ORDERING_UNKNOWN'").select(*FEED, "uid", "pos").join(keys, FEED).join(digests, ["uid", "key"], "left")
    before = chain.withColumn("before", F.lag("digest").over(W.partitionBy(*FEED, "key").orderBy("pos"))).select("uid", "key", (F.col("digest") == F.col("before")).alias("same"))
    return each.join(before, ["uid", "key"], "left").withColumn("equivalent_to_previous", F.coalesce("same", F.lit(False))).drop("same", "replaced")


def consecutive_pairs(index: DataFrame) -> DataFrame:
    """Neighbouring COMPLETE publications of each key, with the uids skipped between them.

    index: org_id, feed_id, key, uid, pos, source_status, status (null: not analysed).
    """
    rows = index.where("source_status <> 'ORDERING_UNKNOWN'")
    done = F.coalesce(F.col("status") == "COMPLETE", F.lit(False))
    w = W.partitionBy(*FEED, "key").orderBy("pos")
    runs = rows.withColumn("run", F.sum(F.when(done, 1).otherwise(0)).over(w))
    skipped = runs.where(~done).groupBy(*FEED, "key", "run").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "uid"))), lambda x: x["uid"]).alias("skipped_uids"))
    complete = runs.where(done).withColumn("old_uid", F.lag("uid").over(w)).where("old_uid is not null").withColumn("before", F.col("run") - 1)
    out = complete.join(skipped.withColumnRenamed("run", "before"), [*FEED, "key", "before"], "left")
    return out.select(*FEED, "key", "old_uid", F.col("uid").alias("new_uid"), F.coalesce("skipped_uids", F.array().cast("array<string>")).alias("skipped_uids"))


def report_pairs(index: DataFrame) -> DataFrame:
    """Neighbours among analysed publications; a FATAL one breaks the chain and equivalent ones get no pair."""
    rows = index.where("source_status <> 'ORDERING_UNKNOWN' and status is not null")
    w = W.partitionBy(*FEED, "key").orderBy("pos")
    chain = rows.withColumn("chain", F.sum(F.when(F.col("status") == "FATAL", 1).otherwise(0)).over(w)).where("status <> 'FATAL'")
    return chain.withColumn("old_uid", F.lag("uid").over(W.partitionBy(*FEED, "key", "chain").orderBy("pos"))).where("old_uid is not null and not equivalent_to_previous").select(*FEED, "key", "old_uid", F.col("uid").alias("new_uid"), "pos")


def page_groups(index: DataFrame) -> DataFrame:
    """Groups of publications as they are shown: an equivalent one joins the group before it, unless either is FATAL.

    Rows: feed, key, grp, first_uid, last_uid, fatal, uids, rids of the first and last.
    """
    rows = index.where("source_status <> 'ORDERING_UNKNOWN' and status is not null").withColumn("fatal", F.col("status") == "FATAL")
    w = W.partitionBy(*FEED, "key").orderBy("pos")
    starts = ~(F.col("equivalent_to_previous") & ~F.col("fatal") & F.coalesce(~F.lag("fatal").over(w), F.lit(False)))
    grouped = rows.withColumn("grp", F.sum(F.when(starts, 1).otherwise(0)).over(w))
    return grouped.groupBy(*FEED, "key", "grp").agg(F.min_by("uid", "pos").alias("first_uid"), F.max_by("uid", "pos").alias("last_uid"), F.bool_or("fatal").alias("fatal"), F.collect_set("uid").alias("uids"), F.min_by("rid", "pos").alias("first_rid"), F.max_by("rid", "pos").alias("last_rid"))


def page_window(groups: DataFrame) -> DataFrame:
    """groups from three before the current one to the newest, without FATAL ones.

    Current is the last whose position says so, else the last that isn't ahead, else the last.
    """
    current = F.max(F.when((F.col("first_rid") == "current") | (F.col("last_rid") == "current"), F.col("grp")))
    not_next = F.max(F.when(~F.coalesce(F.col("last_rid").startswith("next_"), F.lit(False)), F.col("grp")))
    at = groups.groupBy(*FEED, "key").agg(F.coalesce(current, not_next, F.max("grp")).alias("current"))
    return groups.join(at, [*FEED, "key"]).where((F.col("grp") >= F.col("current") - PAGE_BACK) & ~F.col("fatal"))


def page_pairs(window: DataFrame) -> DataFrame:
    """Pairs of shown groups that are not neighbours."""
    a = window.select(*FEED, "key", F.col("grp").alias("ga"), F.col("last_uid").alias("old_uid"))
    b = window.select(*FEED, "key", F.col("grp").alias("gb"), F.col("first_uid").alias("new_uid"))
    return a.join(b, [*FEED, "key"]).where("gb - ga > 1").select(*FEED, "key", "old_uid", "new_uid")


def wanted_pairs(index: DataFrame, today: str) -> DataFrame:
    """Pairs to report with their depth: shown or recent neighbours, newest first, then the other shown pairs at depth 2."""
    window = page_window(page_groups(index))
    shown = window.select(*FEED, "key", F.explode("uids").alias("uid"))
    flag = lambda c, name: shown.select(*FEED, "key", F.col("uid").alias(c), F.lit(True).alias(name))
    recent = index.where(F.to_date(F.try_to_timestamp("published_at")) >= F.date_sub(F.lit(today).cast("date"), RECENT_DAYS)).select(*FEED, "key", F.col("uid").alias("new_uid"), F.lit(True).alias("recent"))
    near = report_pairs(index).join(flag("old_uid", "so"), [*FEED, "key", "old_uid"], "left").join(flag("new_uid", "sn"), [*FEED, "key", "new_uid"], "left").join(recent, [*FEED, "key", "new_uid"], "left").where("(so and sn) or recent")
    depth = F.row_number().over(W.partitionBy(*FEED, "key").orderBy(F.desc("pos"))) - 1
    return near.select(*FEED, "key", "old_uid", "new_uid", depth.alias("depth")).unionByName(page_pairs(window).withColumn("depth", F.lit(2)))


def pending_reports(wanted: DataFrame, done: DataFrame, failed: DataFrame, build: str) -> DataFrame:
    """wanted without stored reports and lasting failures; an engine error is tried again by another build."""
    pair = [*FEED, "old_uid", "new_uid"]
    lasting = failed.where(~((F.col("code") == "ENGINE_ERROR") & ~F.col("engine_build").eqNullSafe(F.lit(build))))
    return wanted.join(done.select(*pair), pair, "left_anti").join(lasting.select(*pair), pair, "left_anti").orderBy("depth", *FEED)


def pending(generations: DataFrame, stored: DataFrame, limit: int | None = None) -> DataFrame:
    """Publications without a record, the newest of every feed before the second newest of any.

    stored: uid of those with a record for the key.
    """
    rows = ordered(generations.where("coalesce(present, true)")).where("orderable")
    depth = F.row_number().over(W.partitionBy(*FEED).orderBy(F.desc("pos"))) - 1
    out = rows.withColumn("depth", depth).join(stored.select("uid"), "uid", "left_anti").orderBy("depth", *FEED)
    return out.limit(limit) if limit is not None else out


def replaced(generations: DataFrame, recorded: DataFrame, seen: DataFrame) -> DataFrame:
    """uids of listed, analysed publications whose dates differ from the recorded ones or whose bytes were seen to."""
    dates = ("published_at", "from_date", "to_date")
    both = generations.where("coalesce(present, true) and from_date is not null").join(recorded.select("uid", *[F.col(c).alias(f"r_{c}") for c in dates]), "uid").join(seen.select("uid", F.lit(True).alias("seen")), "uid", "left")
    differs = F.greatest(*[~F.col(c).eqNullSafe(F.col(f"r_{c}")) for c in dates])
    return both.where(F.coalesce("seen", F.lit(False)) | differs).select("uid")


def merged_catalog(previous: DataFrame, fetched: DataFrame, keys: list[str]) -> DataFrame:
    """The catalogue after a sync: rows once listed stay, with present telling whether they still are."""
    rest = [c for c in fetched.columns if c not in keys]
    old = previous.select(*keys, F.struct(*rest).alias("old"))
    new = fetched.select(*keys, F.struct(*rest).alias("new"))
    return old.join(new, keys, "full_outer").select(*keys, *[F.when(F.col("new").isNotNull(), F.col(f"new.{c}")).otherwise(F.col(f"old.{c}")).alias(c) for c in rest], F.col("new").isNotNull().alias("present"))


def signature_candidates(chain: DataFrame) -> DataFrame:
    """Publications whose summary equals a neighbour's and that have no signature of the analysed archive, newest first.

    chain: org_id, feed_id, uid, pos, digest (null when fatal), signed, present.
    """
    w = W.partitionBy(*FEED).orderBy("pos")
    hit = chain.withColumn("near", F.coalesce(F.lag("digest").over(w) == F.col("digest"), F.lit(False)) | F.coalesce(F.lead("digest").over(w) == F.col("digest"), F.lit(False)))
    return hit.where("digest is not null and near and not signed and present").orderBy(*FEED, F.desc("pos")).select(*FEED, "uid")


def key_for(available: DataFrame, requested: str) -> DataFrame:
    """uid, key: the requested analysis, else the newest of its profile that is no newer than it."""
    release, _, profile = requested.partition("__")
    limit = F.array(*[F.lit(int(x)) for x in release.removeprefix("v").split(".")])
    v = s.version(s.key_release(F.col("key")))
    fits = available.where((F.col("key") == requested) | ((s.key_profile(F.col("key")) == profile) & (v <= limit)))
    return fits.groupBy("uid").agg(F.max_by("key", F.struct((F.col("key") == requested).alias("exact"), v.alias("v"))).alias("key"))


def newest_reports(reports: DataFrame, engine: str, wanted: DataFrame) -> DataFrame:
    """The newest engine version of each pair up to `engine`; of older ones only pairs that are still wanted."""
    limit = F.array(*[F.lit(int(x)) for x in engine.split(".")])
    v = s.version(F.col("engine_version"))
    marked = reports.withColumn("v", v).where(F.col("v") <= limit).join(wanted.select("old_uid", "new_uid", F.lit(True).alias("wanted")), ["old_uid", "new_uid"], "left")
    kept = marked.where((F.col("v") == limit) | F.col("wanted"))
    return kept.withColumn("n", F.row_number().over(W.partitionBy("old_uid", "new_uid").orderBy(F.desc("v")))).where("n = 1").drop("n", "v", "wanted")


def comparator_states(published: DataFrame) -> DataFrame:
    """uid, state of each publication against the one before: can their validations be compared?

    published: org_id, feed_id, pos, uid, status, source_changed, method, zip_sha256.
    """
    w = W.partitionBy(*FEED).orderBy("pos")
    p = {c: F.lag(c).over(w) for c in ("uid", "status", "source_changed", "method", "zip_sha256")}
    rows = published.select("*", *[v.alias(f"p_{k}") for k, v in p.items()]).where("p_uid is not null")
    both = lambda value: (F.col("status") == value) | (F.col("p_status") == value)
    state = (
        F.when(both("FATAL"), "INVALID_INPUT")
        .when(both("PARTIAL") | F.coalesce("source_changed", F.lit(False)) | F.coalesce("p_source_changed", F.lit(False)), "UNVERIFIED_INPUT")
        .when(~F.col("method").eqNullSafe(F.col("p_method")), "INCOMPATIBLE_METHOD")
        .when(F.col("zip_sha256") == F.col("p_zip_sha256"), "SAME_FEED")
        .otherwise("COMPARABLE")
    )
    return rows.select(*FEED, "uid", state.alias("state"))


def backlog(unanalysed: DataFrame, reports: DataFrame) -> DataFrame:
    return unanalysed.agg(F.count("*").alias("unanalysed")).crossJoin(reports.agg(F.count("*").alias("reports_pending")))
