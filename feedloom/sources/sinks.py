"""Canonical JSON, writes that happen only when something changed, and Atom feeds."""

from __future__ import annotations

import gzip
import io
import json
from xml.sax.saxutils import escape

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

PER_FEED, OVERALL, LINES = 20, 50, 10


def canonical_json(document: object) -> str:
    """Sorted keys, two spaces, no escapes, a newline at the end; NaN is refused."""
    return json.dumps(document, sort_keys=True, indent=2, ensure_ascii=False, allow_nan=False) + "\n"


def canonical_gzip(document: object) -> bytes:
    """The same bytes for the same document: no time stamp and no name."""
    out = io.BytesIO()
    with gzip.GzipFile("", "wb", 9, out, 0) as file:
        file.write(canonical_json(document).encode())
    return out.getvalue()


def _digest(columns: list[str]) -> F.Column:
    return F.sha2(F.to_json(F.struct(*[F.col(c) for c in sorted(columns)]), {"ignoreNullFields": "false"}), 256)


def changed_rows(spark: SparkSession, new: DataFrame, path: str, keys: list[str]) -> DataFrame:
    """The rows of new that the table at path doesn't hold in the same form; all if there is none."""
    rest = [c for c in new.columns if c not in keys]
    hashed = new.withColumn("_digest", _digest(rest))
    try:
        old = spark.read.schema(new.schema).parquet(path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return new
    seen = old.withColumn("_digest", _digest(rest)).select(*keys, "_digest")
    return hashed.join(seen, [*keys, "_digest"], "left_anti").select(*new.columns)


def write_changed_partitions(spark: SparkSession, new: DataFrame, path: str, keys: list[str], partitions: list[str]) -> int:
    """Overwrites only the partitions in which a row changed or is gone; returns how many rows did.

    new holds whole partitions; those of which it has no row are not touched.
    """
    changed = changed_rows(spark, new, path, keys).select(*partitions)
    try:
        old = spark.read.schema(new.schema).parquet(path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
    else:
        where = [*keys, *[c for c in partitions if c not in keys]]
        gone = old.join(new.select(*where), where, "left_anti").join(new.select(*partitions).distinct(), partitions, "left_semi")
        changed = changed.unionByName(gone.select(*partitions))
    n = changed.count()
    if n:
        touched = new.join(changed.distinct(), partitions, "left_semi")
        touched.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partitions).parquet(path)
    return n


def newest_entries(reports: DataFrame) -> DataFrame:
    """Major reports for Atom: the 20 newest of each feed, and in_overall for the 50 newest of all.

    reports: org_id, feed_id, uid, updated, class. Ties go to the larger uid.
    """
    major = reports.where("class = 'major'")
    own = F.row_number().over(W.partitionBy("org_id", "feed_id").orderBy(F.desc("updated"), F.desc("uid")))
    kept = major.withColumn("place", own).where(F.col("place") <= PER_FEED)
    overall = kept.orderBy(F.desc("updated"), F.desc("uid"), "org_id", "feed_id").limit(OVERALL).select("org_id", "feed_id", "uid").withColumn("in_overall", F.lit(True))
    return kept.join(overall, ["org_id", "feed_id", "uid"], "left").withColumn("in_overall", F.coalesce("in_overall", F.lit(False)))


def entry_text(lines: DataFrame) -> DataFrame:
    """uid and text of an entry: its non-technical lines, major ones first, ten at most."""
    rank = F.when(F.col("class") == "major", 0).otherwise(1)
    place = F.row_number().over(W.partitionBy("uid").orderBy(rank, "line"))
    kept = lines.where("class <> 'technical'").withColumn("n", place).where(F.col("n") <= LINES)
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("n", "text"))), lambda x: x["text"])
    return kept.groupBy("uid").agg(F.concat_ws("\n", ordered).alias("text"))


def atom(title: str, link: str, entries: list[dict]) -> str:
    """The XML of a feed of at most a few dozen entries (id, title, updated, text)."""
    tag = lambda name, value: f"<{name}>{escape(str(value))}</{name}>"
    body = "".join(f"<entry>{tag('id', e['id'])}{tag('title', e['title'])}{tag('updated', e['updated'])}{tag('content', e.get('text') or '')}</entry>" for e in entries)
    updated = max((e["updated"] for e in entries), default="1970-01-01T00:00:00Z")
    return f'<?xml version="1.0" encoding="utf-8"?><feed xmlns="http://www.w3.org/2005/Atom">{tag("id", link)}{tag("title", title)}{tag("updated", updated)}{body}</feed>\n'


def storage_history(history: DataFrame, entry: DataFrame) -> DataFrame:
    """History with one entry a day, the newly given one instead of an older one of its day."""
    both = history.withColumn("_new", F.lit(0)).unionByName(entry.withColumn("_new", F.lit(1)))
    return both.withColumn("_n", F.row_number().over(W.partitionBy("date").orderBy(F.desc("_new")))).where("_n = 1").drop("_n", "_new")


def storage_growth(history: DataFrame, today: str, days: int = 30) -> DataFrame:
    """Megabytes a day from the first to the last entry of the last days; no row with fewer than two entries."""
    span = history.where(F.col("date") >= F.date_sub(F.lit(today).cast("date"), days))
    unit = {"repo_kb": 1024, "data_bytes": 1, "reports_bytes": 1}
    ends = span.agg(F.count("*").alias("n"), F.min("date").alias("from"), F.max("date").alias("to"), *[f(c, "date").alias(f"{c}_{k}") for c in unit for k, f in (("a", F.min_by), ("b", F.max_by))])
    between = F.greatest(F.datediff("to", "from"), F.lit(1))
    rate = lambda c: F.round((F.col(f"{c}_b") - F.col(f"{c}_a")) * unit[c] / between / 2**20, 2)
    return ends.where("n >= 2").select("from", "to", rate("repo_kb").alias("repo_mb_per_day"), rate("data_bytes").alias("data_mb_per_day"), rate("reports_bytes").alias("reports_mb_per_day"))
