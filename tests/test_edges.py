from __future__ import annotations

import gzip
import json

from pyspark.sql import functions as F

from feedloom import cli
from feedloom.operators import content, events, history, publications
from feedloom.sources import catalog, gtfs_zip
from feedloom.streaming import incremental
from tests.feeds import NEW, OLD, archive


def test_stream_ingest(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.zip").write_bytes(archive(OLD))
    go = lambda: incremental.ingest(incremental.arrivals(spark, str(tmp_path / "in")), str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    go()
    first = spark.read.parquet(str(tmp_path / "out/rows")).count()
    (tmp_path / "in" / "b.zip").write_bytes(archive(NEW))
    go()
    go()
    rows = spark.read.parquet(str(tmp_path / "out/rows"))
    assert rows.count() > first and rows.select("path").distinct().count() == 2


def test_rawdiff_command(spark, tmp_path):
    (tmp_path / "old.zip").write_bytes(archive(OLD))
    (tmp_path / "new.zip").write_bytes(archive(NEW))
    cli.run(["rawdiff", "--old", str(tmp_path / "old.zip"), "--new", str(tmp_path / "new.zip"), "-o", str(tmp_path / "d.gz")], spark)
    changes = json.loads(gzip.decompress((tmp_path / "d.gz").read_bytes()))["changes"]
    assert [c["id"] for c in changes] == [f"c{i:07d}" for i in range(1, len(changes) + 1)]
    assert {(c["file"], c["kind"]) for c in changes} >= {("stops.txt", "row_added"), ("stops.txt", "field_changed"), ("fare_attributes.txt", "field_changed")}


def test_catalog_checks(spark):
    uid = "0b9a2c1e-1111-4aaa-8bbb-000000000001"
    rows = [("o", "f", uid, "current", "https://api.example/x.zip"), ("o", "f", "bad", "current", "https://api.example/x.zip"), ("o", "f", uid[:-1] + "2", "prev_x", "https://api.example/x"), ("o", "f", uid[:-1] + "3", "next_1", "http://api.example/x"), ("o", "f", uid[:-1] + "4", None, "https://api.example.evil/x")]
    good, bad = catalog.publications(spark.createDataFrame(rows, "organization_id string, feed_id string, gtfs_file_uid string, rid string, gtfs_url string"), "api.example")
    assert [r.gtfs_file_uid for r in good.collect()] == [uid]
    assert sorted(r.reason for r in bad.collect()) == ["invalid_rid", "invalid_uid", "invalid_url", "invalid_url"]


def test_generation_records(spark):
    notice = "array<struct<rule_id: string, severity: string, rule_class: string>>"
    rows = [("a", "ok", True, True, None, [("R1", "HIGH", "c"), ("R1", "HIGH", "c")]), ("b", "fatal", None, None, "ZipUnreadable", None), ("c", "ok", None, True, None, []), ("d", "ok", True, False, None, [(None, "LOW", "c")])]
    good, bad = catalog.generation_records(spark.createDataFrame(rows, f"uid string, status string, publishable boolean, coverage_complete boolean, code string, notices {notice}"))
    assert {(r.uid, r.validation_status, r.fatal_code) for r in good.collect()} == {("a", "COMPLETE", None), ("b", "FATAL", "ZIP_UNREADABLE")}
    assert {(r.uid, r.reason) for r in bad.collect()} == {("c", "no_verdict"), ("d", "notice_without_rule")}
    assert {(r.severity, r["count"]) for r in catalog.notice_counts(good.where("uid = 'a'")).collect() if r["count"]} == {("HIGH", 2)}


def test_signature_is_free_of_order(spark):
    rows = [("x", {"a": "1", "b": "2"}), ("x", {"b": "3", "a": "1"}), ("y", {"a": "1", "b": "3"}), ("y", {"b": "2", "a": "1"}), ("z", {"a": "1", "b": "2"}), ("z", {"a": "1", "b": "2"})]
    got = {r.k: r.signature for r in content.table_signatures(spark.createDataFrame(rows, "k string, cells map<string,string>"), ["k"]).collect()}
    assert got["x"] == got["y"] != got["z"]


def test_limb_sum_is_exact(spark):
    digests = [f"{(1 << 256) - 1 - i:064x}" for i in range(5)]
    rows = spark.createDataFrame([(d,) for d in digests], "d string")
    sums = rows.select(*[x.alias(f"l{i}") for i, x in enumerate(content.limbs(F.col("d")))]).agg(*[F.sum(f"l{i}").alias(f"l{i}") for i in range(8)])
    assert sums.select(content.folded([F.col(f"l{i}") for i in range(8)]).alias("x")).first().x == f"{sum(int(d, 16) for d in digests) % (1 << 256):064x}"


def test_lineage(spark):
    occ = [("p1", "old", "u1", "A"), ("p1", "new", "u2", "B"), ("p2", "old", "u2", "B"), ("p2", "new", "u3", "B"), ("p2", "new", "u3", "C")]
    occurrences = spark.createDataFrame([("o", "f", *r) for r in occ], "org_id string, feed_id string, pair_id string, side string, uid string, route_id string")
    mapping = lambda c: spark.createDataFrame([("o", "f", "u1", "u2", ["A"], ["B"], "same", c)], "org_id string, feed_id string, old_uid string, new_uid string, old array<string>, new array<string>, relation string, confidence double")
    names = lambda c: {(r.uid, r.route_id): r.canonical_route_id for r in history.route_lineage(occurrences, mapping(c)).collect()}
    sure, unsure = names(0.9), names(0.5)
    assert sure["u1", "A"] == sure["u2", "B"] == sure["u3", "B"] != sure["u3", "C"] and unsure["u1", "A"] != unsure["u2", "B"]


def test_pair_codes(spark):
    pairs = spark.createDataFrame([("a", "FATAL", "COMPLETE", True), ("b", "COMPLETE", "COMPLETE", True), ("c", "COMPLETE", "PARTIAL", False), ("d", "COMPLETE", "COMPLETE", False), ("e", "COMPLETE", "COMPLETE", False), ("f", "COMPLETE", "COMPLETE", False)], "pair_id string, old_status string, new_status string, equivalent boolean")
    classes = spark.createDataFrame([("c", "MEANINGFUL_SERVICE_CHANGE"), ("a", "MEANINGFUL_SERVICE_CHANGE")], "pair_id string, class string")
    errors = spark.createDataFrame([("d", "SOURCE_UNAVAILABLE")], "pair_id string, code string")
    estimates = spark.createDataFrame([("e", "~T"), ("d", "~M")], "pair_id string, estimate string")
    assert {r.pair_id: r.code for r in events.pair_codes(pairs, classes, errors, estimates).collect()} == {"a": "U/FATAL", "b": "E", "c": "M", "d": "U/SOURCE_UNAVAILABLE", "e": "~T", "f": "U/NOT_REPORTED"}


def test_analysis_key_fallback(spark):
    keys = spark.createDataFrame([("a", "v1.2.0__jp"), ("a", "v1.10.0__jp"), ("a", "v2.0.0__jp"), ("a", "v1.11.0__eu"), ("b", "v1.11.0__jp"), ("b", "v1.2.0__jp")], "uid string, key string")
    assert {r.uid: r.key for r in publications.key_for(keys, "v1.11.0__jp").collect()} == {"a": "v1.10.0__jp", "b": "v1.11.0__jp"}


def test_empty_scan(spark, tmp_path):
    (tmp_path / "x.zip").write_bytes(b"not a zip")
    scanned = gtfs_zip.scan(spark, str(tmp_path / "*.zip"))
    assert gtfs_zip.rows(scanned).count() == 0 and [r.code for r in gtfs_zip.notes(scanned).collect()] == ["not_a_zip"]
