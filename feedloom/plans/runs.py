"""Runs: reports of pending pairs within a time budget, run records, and stored differences kept in step with what is wanted."""

from __future__ import annotations

import time
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from feedloom.operators.graph import cut
from feedloom.operators.publications import FEED
from feedloom.plans import report
from feedloom.plans.config import Config
from feedloom.sources.sinks import changed_rows

PAIR = ["pair_id", *FEED, "old_uid", "new_uid"]
RESULT = "action string, code string, detail string, run_id string, batch string"
DETAIL = 2000


def reporter(files: DataFrame, rows: DataFrame, holidays: DataFrame, config: Config | None = None) -> Callable[[DataFrame], dict[str, DataFrame]]:
    """What run_reports() builds with: the whole comparison of the pairs it is given."""

    def build(pairs: DataFrame) -> dict[str, DataFrame]:
        found = report.build(pairs.select("pair_id", "old_uid", "new_uid"), files, rows, holidays, config)
        return {name: getattr(found, name) for name in report.TABLES}

    return build


def run_reports(pending: DataFrame, build: Callable[[DataFrame], dict[str, DataFrame]], out: str, run_id: str, budget: float | None = None, size: int = 200, clock: Callable[[], float] = time.monotonic) -> dict[str, int]:
    """Builds and writes the reports of pending pairs, the lowest depth first; returns how many were reported, failed, deferred.

    pending: pair_id, org_id, feed_id, old_uid, new_uid, depth. build gives tables keyed by pair_id; a table of a batch of
    about `size` pairs is one job and lies in out/<table>/run_id=/batch=. out/results gets a row a pair once its tables are
    whole, so tables without such rows are of a run that broke off. If a batch fails, its pairs are built one by one and
    only those that fail again are marked. No batch, nor pair of a failed batch, starts after `budget` seconds; what is left is deferred.
    """
    end = None if budget is None else clock() + budget
    late = lambda: end is not None and clock() >= end
    pending = cut(pending.select(*PAIR, "depth"))
    # a row a depth: at most as many as a feed has publications
    depths = [(r["depth"], r["count"]) for r in pending.groupBy("depth").count().orderBy("depth").collect()]
    counts = {"pending": sum(n for _, n in depths), "reported": 0, "failed": 0, "deferred": 0}

    def write(pairs: DataFrame, batch: str) -> None:
        for name, table in build(pairs.select(*PAIR)).items():
            table.write.mode("overwrite").parquet(f"{out}/{name}/run_id={run_id}/batch={batch}")

    def record(pairs: DataFrame, batch: str, action: str, code: str | None = None, detail: str | None = None) -> None:
        told = zip(("action", "code", "detail", "run_id", "batch"), (action, code, detail, run_id, batch), strict=True)
        pairs.select(*PAIR, *[F.lit(v).cast("string").alias(k) for k, v in told]).coalesce(1).write.mode("append").parquet(f"{out}/results")

    for depth, n in depths:
        parts = -(-n // size)
        for part in range(parts):
            same = F.col("depth").eqNullSafe(F.lit(depth))
            pairs, batch = pending.where(same & (F.pmod(F.xxhash64("pair_id"), F.lit(parts)) == part)), f"{depth}-{part}"
            in_batch = pairs.count()
            if late():
                counts["deferred"] += in_batch
                continue
            if not in_batch:
                continue
            try:
                write(pairs, batch)
            except Exception:  # noqa: BLE001 - whatever one pair does must not end the run; each is tried by itself
                for row in pairs.select("pair_id").collect():
                    if late():
                        counts["deferred"] += 1
                        continue
                    one, own = pairs.where(F.col("pair_id") == row.pair_id), f"{batch}-{counts['reported'] + counts['failed']}"
                    try:
                        write(one, own)
                    except Exception as error:  # noqa: BLE001
                        record(one, own, "failed", "ENGINE_ERROR", str(error)[:DETAIL])
                        counts["failed"] += 1
                    else:
                        record(one, own, "reported")
                        counts["reported"] += 1
            else:
                record(pairs, batch, "reported")
                counts["reported"] += in_batch
    return counts


def append_run(spark: SparkSession, path: str, run_id: str, started: datetime, finished: datetime, trigger: str, counts: dict[str, int], changed: int, warnings: list[str] | None = None) -> bool:
    """Adds a record of a run below the year it started in, if the run changed or failed at something; says whether it did."""
    if not (changed or warnings or counts.get("failed")):
        return False
    schema = "run_id string, started_at timestamp, finished_at timestamp, trigger string, counts map<string,long>, warnings array<string>, year int"
    spark.createDataFrame([(run_id, started, finished, trigger, counts, warnings or [], started.year)], schema).write.mode("append").partitionBy("year").json(path)
    return True


def sync_differences(spark: SparkSession, wanted: DataFrame, feeds: DataFrame, path: str) -> tuple[int, int]:
    """Stores the wanted differences of some feeds and deletes the others of theirs; returns how many were written and deleted.

    wanted: org_id, feed_id, key, old_uid, new_uid and anything else; feeds: org_id, feed_id of those in question, which
    wanted's must be among. Only feeds with a change are written again; other feeds are not touched.
    """
    keys = [*FEED, "key", "old_uid", "new_uid"]
    wanted, feeds = cut(wanted), feeds.select(*FEED).distinct()
    changed = cut(changed_rows(spark, wanted, path, keys).select(*keys))
    try:
        stored = spark.read.schema(wanted.schema).parquet(path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        stored = wanted.limit(0).select(*wanted.columns, F.struct(F.lit("").alias("file_path")).alias("_metadata"))
    inside = stored.select(*keys, F.regexp_replace("_metadata.file_path", "/[^/]*$", "").alias("folder")).join(feeds, FEED, "left_semi")
    stale = cut(inside.join(wanted, keys, "left_anti"))
    emptied = stale.join(wanted.select(*FEED).distinct(), FEED, "left_anti").select("folder").distinct()
    written, deleted = changed.count(), stale.count()
    folders = [r.folder for r in emptied.collect()]  # at most one a feed
    if written or deleted:
        touched = cut(changed.select(*FEED).unionByName(stale.select(*FEED)).distinct())
        wanted.join(touched, FEED, "left_semi").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*FEED).parquet(path)
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for folder in folders:
        place = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(folder))
        place.getFileSystem(conf).delete(place, True)
    return written, deleted
