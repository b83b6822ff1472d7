"""Catalogue listings, validator results, holidays and stage logs as tables, with what was refused beside them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.functions import scalar as s

FEEDS = "organization_id string, organization_name string, feed_id string, feed_name string, feed_license string, feed_is_discontinued boolean, feed_discontinued_date string"
PUBLICATIONS = "organization_id string, feed_id string, gtfs_file_uid string, rid string, gtfs_url string, from_date string, to_date string, published_at string, memo string"
NOTICE = "array<struct<rule_id: string, severity: string, rule_class: string>>"
SEVERITIES = ("CRITICAL", "HIGH", "MEDIUM", "LOW", "INFO")


def feeds(listing: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(feeds, refused rows with a reason) of a feed listing: ids must be path-safe and unique."""
    ok = s.is_path_id(F.col("organization_id")) & s.is_path_id(F.col("feed_id"))
    judged = listing.withColumn("reason", F.when(~ok, "invalid_id"))
    good = judged.where("reason is null").groupBy("organization_id", "feed_id").agg(*[F.first(c, ignorenulls=True).alias(c) for c in listing.columns if c not in ("organization_id", "feed_id")])
    return good.withColumn("license", s.normalized_license(F.col("feed_license"))), judged.where("reason is not null")


def publications(listing: DataFrame, host: str) -> tuple[DataFrame, DataFrame]:
    """(publications, refused rows with a reason): uid, position and download address must be valid, a uid listed once."""
    times = listing.groupBy("organization_id", "feed_id", "gtfs_file_uid").agg(F.count("*").alias("times"))
    judged = listing.join(times, ["organization_id", "feed_id", "gtfs_file_uid"], "left").withColumn(
        "reason",
        F.when(~s.is_uid(F.col("gtfs_file_uid")), "invalid_uid")
        .when(F.col("rid").isNotNull() & s.rid_rank(F.col("rid")).isNull(), "invalid_rid")
        .when(~s.is_download_url(F.col("gtfs_url"), host), "invalid_url")
        .when(F.col("times") > 1, "duplicate_uid"),
    )
    return judged.where("reason is null").drop("reason", "times"), judged.where("reason is not null").drop("times")


def complete(found: DataFrame, reported: DataFrame) -> DataFrame:
    """Whether each feed's returned and refused earlier and later publications are as many as the source reports.

    found: org_id, feed_id, rid (refused ones too); reported: org_id, feed_id, prev, next.
    """
    got = found.groupBy("org_id", "feed_id").agg(F.count_if(F.col("rid").startswith("prev_")).alias("got_prev"), F.count_if(F.col("rid").startswith("next_")).alias("got_next"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    return reported.join(got, ["org_id", "feed_id"], "left").select("org_id", "feed_id", ((zero("got_prev") == zero("prev")) & (zero("got_next") == zero("next"))).alias("complete"))


def load_catalog(spark: SparkSession, path: str) -> DataFrame:
    """A tree of JSON documents, one publication list per feed."""
    return spark.read.schema(f"org_id string, feed_id string, generations array<struct<{PUBLICATIONS.replace(' string', ': string')}>>").option("multiLine", True).json(path)


def stored_analyses(records: DataFrame) -> DataFrame:
    """uid to {analysis key: status}; rows whose uid or key is no such thing are left out."""
    ok = s.is_uid(F.col("uid")) & F.col("analysis_key").rlike(r"^[A-Za-z0-9.]+__[A-Za-z0-9_-]+\z")
    entries = F.array_sort(F.collect_set(F.struct("analysis_key", "status")))
    return records.where(ok).groupBy("org_id", "feed_id", "uid").agg(F.map_from_entries(entries).alias("analyses"))


def generation_records(reports: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(records, refused) of validator reports: uid, status, publishable, coverage_complete, notices.

    A report of status ok without a boolean verdict or with a notice without rule is refused; a fatal one keeps its code.
    """
    fatal = F.col("status") == "fatal"
    reason = F.when(~fatal & F.col("publishable").isNull(), "no_verdict").when(~fatal & F.exists(F.coalesce("notices", F.array().cast(NOTICE)), lambda n: n["rule_id"].isNull()), "notice_without_rule")
    judged = reports.withColumn("reason", reason)
    status = F.when(fatal, "FATAL").when(F.col("coverage_complete"), "COMPLETE").otherwise("PARTIAL")
    good = judged.where("reason is null").withColumn("validation_status", status).withColumn("fatal_code", F.when(fatal, s.upper_snake(F.coalesce("code", F.lit("")))))
    return good.drop("reason"), judged.where("reason is not null")


def notice_counts(records: DataFrame) -> DataFrame:
    """Notices by publication and severity, with zero for severities that have none."""
    spark = records.sparkSession
    exploded = records.select("uid", F.explode("notices").alias("n")).groupBy("uid", F.col("n.severity").alias("severity")).agg(F.count("*").alias("count"))
    every = records.select("uid").distinct().crossJoin(F.broadcast(spark.createDataFrame([(x,) for x in SEVERITIES], "severity string")))
    return every.join(exploded, ["uid", "severity"], "left").select("uid", "severity", F.coalesce("count", F.lit(0)).alias("count"))


def rule_counts(records: DataFrame) -> DataFrame:
    """uid to {rule: (count, severity, class)}."""
    rules = records.select("uid", F.explode("notices").alias("n")).groupBy("uid", F.col("n.rule_id").alias("rule_id")).agg(F.count("*").alias("count"), F.min("n.severity").alias("severity"), F.min("n.rule_class").alias("class"))
    return rules.groupBy("uid").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("rule_id", F.struct("count", "severity", "class"))))).alias("rules"))


def holidays(dates: DataFrame, first_year: int, last_year: int) -> DataFrame:
    """Holiday dates; one outside the years of the table is an error, not an ordinary day."""
    year = F.year("date")
    checked = F.when(year.between(first_year, last_year), F.col("date")).otherwise(F.raise_error(F.concat(F.lit("holiday outside the table: "), F.col("date").cast("string"))).cast("date"))
    return dates.select(checked.alias("date")).distinct()


def stage_minutes(spark: SparkSession, path: str) -> DataFrame:
    """Start, end and minutes of each stage of a log of `<stage> start|end <time>` lines."""
    part = F.split(F.trim("value"), r"\s+")
    lines = spark.read.text(path).where((F.size(part) == 3) & F.element_at(part, 2).isin("start", "end")).select(part[0].alias("stage"), part[1].alias("what"), part[2].alias("at"), F.monotonically_increasing_id().alias("n"))
    out = lines.groupBy("stage").agg(*[F.max_by(F.when(F.col("what") == w, F.col("at")), F.when(F.col("what") == w, F.col("n"))).alias(name) for w, name in (("start", "started"), ("end", "finished"))])
    seconds = F.unix_timestamp(F.try_to_timestamp("finished")) - F.unix_timestamp(F.try_to_timestamp("started"))
    return out.withColumn("minutes", s.round1(seconds / 60))
