from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import functions as F

from feedloom.plans import runs
from feedloom.sources import gtfs_zip, layout
from tests.feeds import NEW, OLD, archive

U = "0b9a2c1e-1111-4aaa-8bbb-00000000000"
PENDING = "pair_id string, org_id string, feed_id string, old_uid string, new_uid string, depth int"


def test_paths(spark):
    df = spark.createDataFrame([("o", "f", U + "1", U + "2", "v1.2.3__v4", "1.0.0"), ("..", "f", U + "1", U + "2", "v1.2.3__v9", "1.0"), (None, "f", None, "x/y", None, None)], "o string, f string, a string, b string, k string, e string")
    c = F.col
    out = df.select(
        layout.feed_path(c("o"), c("f")).alias("feed"), layout.generation_path(c("o"), c("f"), c("a"), c("k")).alias("generation"), layout.content_path(c("o"), c("f"), c("a")).alias("content"), layout.source_changed_path(c("o"), c("f"), c("a")).alias("changed"),
        layout.diff_path(c("o"), c("f"), c("k"), c("a"), c("b")).alias("diff"), layout.report_path(c("o"), c("f"), c("e"), c("a"), c("b")).alias("report"), layout.report_path(c("o"), c("f"), c("e"), c("a"), c("b"), True).alias("error"),
    ).collect()
    g = f"feeds/o/f/generations/{U}1"
    pair = f"{U}1__{U}2"
    assert list(out[0]) == ["feeds/o/f/feed.json", f"{g}/v1.2.3__v4.json", f"{g}/content.json", f"{g}/source-changed.json", f"feeds/o/f/diffs/v1.2.3__v4/{pair}.json", f"feeds/o/f/changes/1.0.0/{pair}.report.json.gz", f"feeds/o/f/changes/1.0.0/{pair}.error.json"]
    assert all(v is None for r in out[1:] for v in r)


def test_reports_one_failing(spark, tmp_path):
    rows = [(p, "o", "f", "a", "b", d) for p, d in (("p1", 0), ("p2", 0), ("bad", 0), ("p3", 1))]
    pending = spark.createDataFrame(rows, PENDING)

    def build(pairs):
        if pairs.where("pair_id = 'bad'").count():
            raise ValueError("broken archive")
        return {"summary": pairs.select("pair_id")}

    counts = runs.run_reports(pending, build, str(tmp_path), "r1")
    assert counts == {"pending": 4, "reported": 3, "failed": 1, "deferred": 0}
    done = {r.pair_id: (r.action, r.code, r.detail) for r in spark.read.parquet(f"{tmp_path}/results").collect()}
    assert done == {"p1": ("reported", None, None), "p2": ("reported", None, None), "p3": ("reported", None, None), "bad": ("failed", "ENGINE_ERROR", "broken archive")}
    assert sorted(r.pair_id for r in spark.read.parquet(f"{tmp_path}/summary").collect()) == ["p1", "p2", "p3"]


def test_time_budget(spark, tmp_path):
    pending = spark.createDataFrame([("p1", "o", "f", "a", "b", 0), ("p2", "o", "f", "b", "c", 1), ("p3", "o", "f", "c", "d", 2)], PENDING)
    ticks = iter([0, 1, 99, 99, 99])
    counts = runs.run_reports(pending, lambda p: {"summary": p.select("pair_id")}, str(tmp_path), "r1", budget=10, clock=lambda: next(ticks))
    assert counts == {"pending": 3, "reported": 1, "failed": 0, "deferred": 2}
    assert runs.run_reports(pending.limit(0), lambda p: {}, str(tmp_path), "r2") == {"pending": 0, "reported": 0, "failed": 0, "deferred": 0}


def test_run_records(spark, tmp_path):
    at, path = datetime(2027, 2, 1, tzinfo=UTC), str(tmp_path / "runs")
    assert not runs.append_run(spark, path, "r0", at, at, "manual", {"failed": 0}, 0)
    assert runs.append_run(spark, path, "r1", at, at, "manual", {"failed": 0}, 3) and runs.append_run(spark, path, "r2", at, at, "manual", {"failed": 1}, 0)
    assert sorted((r.run_id, r.year) for r in spark.read.json(path).collect()) == [("r1", 2027), ("r2", 2027)]


def test_differences_in_step(spark, tmp_path):
    path, schema = str(tmp_path / "diffs"), "org_id string, feed_id string, key string, old_uid string, new_uid string, n int"
    table = lambda *rows: spark.createDataFrame([("o", f, "k", a, b, n) for f, a, b, n in rows], schema)
    feeds = lambda *f: spark.createDataFrame([("o", x) for x in f], "org_id string, feed_id string")
    stored = lambda: sorted((r.feed_id, r.old_uid, r.new_uid, r.n) for r in spark.read.schema(schema).parquet(path).collect())
    first = (("f", "a", "b", 1), ("f", "b", "c", 2), ("g h", "a", "b", 3), ("z", "a", "b", 4))
    assert runs.sync_differences(spark, table(*first), feeds("f", "g h", "z"), path) == (4, 0)
    assert runs.sync_differences(spark, table(*first), feeds("f", "g h", "z"), path) == (0, 0)
    assert runs.sync_differences(spark, table(("f", "a", "c", 5)), feeds("f", "g h"), path) == (1, 3)
    assert stored() == [("f", "a", "c", 5), ("z", "a", "b", 4)]


def test_whole_reports(spark, tmp_path):
    for name, files in (("old", OLD), ("new", NEW)):
        (tmp_path / f"{name}.zip").write_bytes(archive(files))
    uid = F.regexp_extract("path", "([^/]+)[.]zip$", 1)
    scanned = gtfs_zip.scan(spark, f"{tmp_path}/*.zip").withColumn("uid", uid).cache()
    build = runs.reporter(gtfs_zip.files(scanned).withColumn("uid", uid), scanned.where("kind = 'row'").select("uid", "file", "row_no", "cells"), spark.createDataFrame([], "date date"))
    counts = runs.run_reports(spark.createDataFrame([("p", "o", "f", "old", "new", 0)], PENDING), build, f"{tmp_path}/out", "r1")
    assert counts == {"pending": 1, "reported": 1, "failed": 0, "deferred": 0}, spark.read.parquet(f"{tmp_path}/out/results").collect()
    assert spark.read.parquet(f"{tmp_path}/out/impacts").first()["class"] == "major" and spark.read.parquet(f"{tmp_path}/out/renumbered").first().stops == 1
