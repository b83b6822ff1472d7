"""Commands: rawdiff and report for two archives, and one registered query."""

from __future__ import annotations

import argparse
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.operators import rawdiff
from feedloom.plans import report
from feedloom.plans.config import Config
from feedloom.session import session
from feedloom.sources import gtfs_zip, sinks


def _tables(spark: SparkSession, old: str, new: str, config: Config) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(pairs, files, rows) of two archives; the uid of an archive is its digest and side."""
    both = gtfs_zip.scan(spark, old, config).withColumn("uid", F.lit("old")).unionByName(gtfs_zip.scan(spark, new, config).withColumn("uid", F.lit("new"))).persist()
    pairs = spark.createDataFrame([("pair", "old", "new")], "pair_id string, old_uid string, new_uid string")
    return pairs, both.where("kind = 'file'"), both.where("kind = 'row'").select("uid", "file", "row_no", "cells")


def run(arguments: list[str] | None = None, spark: SparkSession | None = None) -> None:
    parser = argparse.ArgumentParser(prog="feedloom", description=__doc__)
    commands = parser.add_subparsers(dest="command", required=True)
    for name in ("rawdiff", "report"):
        p = commands.add_parser(name)
        p.add_argument("--old", required=True)
        p.add_argument("--new", required=True)
        p.add_argument("-o", "--out", required=True)
        if name == "report":
            p.add_argument("--holidays", help="a text file of ISO dates")
    p = commands.add_parser("query")
    p.add_argument("name")
    p.add_argument("--tables", required=True)
    p.add_argument("-o", "--out", required=True)
    a = parser.parse_args(arguments)
    spark = spark or session()
    config = Config()
    if a.command == "query":
        from feedloom.plans import queries

        queries.queries()[a.name](spark, a.tables).write.mode("overwrite").parquet(a.out)
        return
    pairs, files, rows = _tables(spark, a.old, a.new, config)
    if a.command == "rawdiff":
        changes, _ = rawdiff.raw_diff(pairs, files, rows, config)
        document = {"changes": [r.asDict(True) for r in changes.drop("pair_id").orderBy("id").collect()]}
        Path(a.out).write_bytes(sinks.canonical_gzip(document))
        return
    days = spark.read.text(a.holidays) if a.holidays else spark.createDataFrame([], "value string")
    found = report.build(pairs, files, rows, days.select(F.to_date("value").alias("date")), config)
    for name in report.TABLES:
        getattr(found, name).write.mode("overwrite").parquet(f"{a.out}/{name}")


if __name__ == "__main__":
    run()
