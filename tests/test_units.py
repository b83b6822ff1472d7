from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from feedloom.functions import kernels
from feedloom.functions import scalar as s
from feedloom.operators import graph, places, publications, rawdiff
from feedloom.plans.config import Config
from feedloom.sources import gtfs_zip, sinks
from tests.feeds import archive


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def test_scalars(spark):
    lit = F.lit
    assert [one(spark, s.minutes(lit(v))) for v in ("07:30:00", "25:01:59", "7:60:00", "7:30", "")] == [450, 1501, None, None, None]
    assert [one(spark, s.hour_band(lit(v))) for v in (0, 450, 1501, 6000)] == ["00-01", "07-08", "25-26", "100-101"]
    assert [str(one(spark, s.ymd(lit(v)))) for v in ("20260228", "20260230", "2026022")] == ["2026-02-28", "None", "None"]
    assert [one(spark, s.rid_rank(lit(v))) for v in ("next_2", "current", "prev_1", "prev_0", "x")] == [-2, 0, 1, None, None]
    assert [one(spark, s.same_value(lit(a), lit(b))) for a, b in (("140.50", "140.5"), ("7:30:00", "07:30:00"), ("a", "b"), ("nan", "nan"))] == [True, True, False, False]
    assert one(spark, s.upper_snake(lit("ZipUnreadable"))) == "ZIP_UNREADABLE" and one(spark, s.upper_snake(lit("a b"))) == "UNKNOWN_FATAL"
    assert one(spark, s.is_path_id(lit("a/b"))) is False and one(spark, s.is_path_id(lit("a-b"))) is True
    assert one(spark, s.day_type_id(F.array(lit("hol"), lit("mon")))) == "mon,hol"
    assert one(spark, s.normalized_license(lit(" CC  BY 4.0 "))) == "CC-BY-4.0" and one(spark, s.normalized_license(lit("x"))) is None
    assert str(one(spark, s.delta1(lit("1.25").cast("decimal(10,2)"), lit("2.35").cast("decimal(10,2)")))) == "1.1"
    assert abs(one(spark, s.distance_m(lit(33.0), lit(131.0), lit(33.01), lit(131.0))) - 1111.95) < 0.1
    assert one(spark, s.direction_key(lit(""), F.array(lit("A"), lit("B")))) == one(spark, F.substring(F.sha2(lit("A>B"), 256), 1, 8))
    areas = [(20.0, 46.0, 122.0, 154.0)]
    assert [one(spark, s.coordinate_area(lit(a), lit(b), areas)) for a, b in (("35", "139"), ("139", "35"), ("0", "0"), ("x", "1"))] == [None, "swapped", "outside", None]


def test_pattern_edits():
    cases = {
        ("ABC", "ABCD"): [("extended", ["D"])], ("ABCD", "ABC"): [("shortened", ["D"])], ("ABD", "ABCD"): [("inserted", ["C"])], ("ABCD", "ABD"): [("removed", ["C"])],
        ("AD", "ABCD"): [("detour_added", ["B", "C"])], ("ABCD", "ACBD"): [("reordered", ["C"])], ("ABC", "AXC"): [("removed", ["B"]), ("inserted", ["X"])], ("ABC", "ABC"): [],
    }
    for (a, b), want in cases.items():
        got = kernels.edits_of(list(a), list(b))
        assert got == want or (a, b) == ("ABCD", "ACBD") and [k for k, _ in got] == ["reordered"], (a, b, got)


def test_merged_rows():
    patterns = [tuple("ABCA"), tuple("ABDA"), tuple("XAB")]
    rows, at = kernels.merged_rows(patterns)
    for pattern, stands in zip(patterns, at, strict=True):
        assert tuple(rows[i] for i in stands) == pattern and stands == sorted(stands)
    assert kernels.merged_rows([]) == ([], []) and len(rows) == 6


def test_names():
    normal = kernels.name_normaliser(("のりば", "（上り）"), ("[0-9]+(番|番のりば)$",))
    assert normal("駅前 １番のりば") == "駅前" and normal("のりば") == "のりば" and normal("駅前（上り）") == "駅前"


def test_geometry():
    line = np.array([(33 + i * 0.001, 131.0) for i in range(20)])
    assert kernels.simplified(line, 5).sum() == 2 and abs(kernels.line_length(line) - 2112.7) < 1
    assert kernels.divergence(line, line, 20, 50, 500)["max_m"] == 0
    detour = line.copy()
    detour[8:12, 1] += 0.00321
    d = kernels.divergence(line, detour, 20, 50, 500)
    assert 290 <= d["max_m"] <= 310 and d["new_spans"] and not d["capped"]
    assert kernels.divergence(line, line[:, ::-1], 20, 50, 500)["capped"]


def test_reader_rules():
    rows = list(gtfs_zip.archive_rows("x", archive({"a/stops.txt": "﻿stop_id, stop_name\nS1\nS2,x,y\n,\n", "a/b.TXT": "名前\n".encode("cp932"), "a/dup.txt": "a,a\n", "../up.txt": "a\n", "a/raw.txt": b"a\n\x81"}), Config()))
    files = {r["file"]: r for r in rows if r["kind"] == "file"}
    assert files["stops.txt"]["header"] == ["stop_id", "stop_name"] and files["stops.txt"]["row_count"] == 2 and files["stops.txt"]["ragged_rows"] == 1
    assert files["b.TXT"]["encoding"] == "cp932" and files["dup.txt"]["status"] == "duplicate_header" and files["raw.txt"]["status"] == "undecodable"
    assert [r["cells"] for r in rows if r["kind"] == "row" and r["file"] == "stops.txt"] == [{"stop_id": "S1", "stop_name": ""}, {"stop_id": "S2", "stop_name": "x"}]
    assert [(r["code"], r["file"]) for r in rows if r["kind"] == "note"] == [("unsafe_member_ignored", "../up.txt")]
    assert [r["code"] for r in gtfs_zip.archive_rows("x", b"no", Config())] == ["not_a_zip"]
    few = list(gtfs_zip.archive_rows("x", archive({"a.txt": "a\n1\n2\n3\n"}), Config(max_rows_per_file=2)))
    assert few[0]["status"] == "too_large" and few[0]["row_count"] == 3 and len(few) == 1


def test_greedy_and_components(spark):
    c = spark.createDataFrame([("g", "a", "x", 1), ("g", "a", "y", 2), ("g", "b", "x", 2), ("g", "b", "y", 3), ("h", "a", "x", 9)], "g string, l string, r string, cost int")
    assert {(x.g, x.l, x.r) for x in graph.greedy(c, ["g"], ["l"], ["r"], ["cost", "l", "r"]).collect()} == {("g", "a", "x"), ("g", "b", "y"), ("h", "a", "x")}
    e = spark.createDataFrame([(i, i + 1) for i in range(1, 30)] + [(50, 51)], "a int, b int")
    assert {(x.node, x.root) for x in graph.components(e).collect()} == {(i, 1) for i in range(1, 31)} | {(50, 50), (51, 50)}


def test_raw_diff_modes(spark):
    rows = [("o", "stops.txt", {"stop_id": "1", "n": "a", "gone": "x"}), ("o", "stops.txt", {"stop_id": "2", "n": "b", "gone": ""}), ("n", "stops.txt", {"stop_id": "1", "n": "A", "new": "y"}), ("n", "stops.txt", {"stop_id": "3", "n": "c", "new": ""}), ("o", "x.txt", {"k": "1"}), ("o", "x.txt", {"k": "1"}), ("n", "x.txt", {"k": "1"})]
    files = [("o", "stops.txt", "h1", "ok", "u", ["stop_id", "n", "gone"], 2, 0), ("n", "stops.txt", "h2", "ok", "u", ["stop_id", "n", "new"], 2, 0), ("o", "x.txt", "h3", "ok", "u", ["k"], 2, 0), ("n", "x.txt", "h4", "ok", "u", ["k"], 1, 0), ("n", "only.txt", "h5", "ok", "u", ["k"], 7, 0), ("o", "bad.txt", "h6", "undecodable", None, [], 0, 0), ("n", "bad.txt", "h7", "ok", "u", ["k"], 0, 0)]
    changes, chosen = rawdiff.raw_diff(
        spark.createDataFrame([("p", "o", "n")], "pair_id string, old_uid string, new_uid string"),
        spark.createDataFrame(files, "uid string, file string, file_sha256 string, status string, encoding string, header array<string>, row_count long, ragged_rows long"),
        spark.createDataFrame(rows, "uid string, file string, cells map<string,string>"),
    )
    got = [(r.id, r.file, r.kind, r.column) for r in changes.orderBy("id").collect()]
    want = [("bad.txt", "file_changed_opaque", None), ("only.txt", "file_added", None), ("stops.txt", "column_added", "new"), ("stops.txt", "column_removed", "gone"), ("stops.txt", "row_added", None), ("stops.txt", "row_removed", None), ("stops.txt", "field_changed", "n"), ("x.txt", "row_removed", None)]
    assert got == [(f"c{i:07d}", *w) for i, w in enumerate(want, 1)]
    assert {r.file: (r["mode"], r.fallback_reason) for r in chosen.collect()} == {"bad.txt": ("opaque", None), "only.txt": ("presence", None), "stops.txt": ("keyed", None), "x.txt": ("multiset", "no_primary_key")}


def test_grouped_and_moved_places(spark):
    stops = spark.createDataFrame([("o", "1", "Mill", 33.0, 131.0, "0", ""), ("o", "2", "Mill", 33.001, 131.0, "0", ""), ("o", "9", "Hub", None, None, "1", ""), ("o", "9a", "Hub A", 34.0, 132.0, "0", "9"), ("n", "7", "Mill", 33.0005, 131.0, "0", "")], "uid string, stop_id string, name string, lat double, lon double, kind string, parent string")
    built = places.build_places(stops)
    assert {(r.uid, r.place_id, tuple(r.members)) for r in built.collect()} == {("o", "1", ("1", "2")), ("o", "9", ("9", "9a")), ("n", "7", ("7",))}
    pairs = spark.createDataFrame([("p", "o", "n")], "pair_id string, old_uid string, new_uid string")
    got = {(r.old_id, r.new_id, r.method, r.status) for r in places.match_places(pairs, built).collect()}
    assert got == {("1", "7", "same_name", "moved"), ("9", None, None, "removed")}


def test_publication_order(spark):
    rows = [("u3", "2026-01-02", "2026-01-01T00:00:00+00:00"), ("u2", "2026-01-02", None), ("u1", "2026-01-02", "2026-01-01T00:00:00+09:00"), ("u0", None, None), ("u4", "2026-01-01", "2026-01-01T00:00:00")]
    g = spark.createDataFrame([("o", "f", *r) for r in rows], "org_id string, feed_id string, uid string, from_date string, published_at string")
    assert [r.uid for r in publications.ordered(g).orderBy("pos").collect()] == ["u4", "u2", "u1", "u3", "u0"]


def test_sinks(spark, tmp_path):
    assert sinks.canonical_gzip({"b": 1, "a": "é"}) == sinks.canonical_gzip({"a": "é", "b": 1})
    df = spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], "k int, v string, part string")
    path = str(tmp_path / "t")
    assert sinks.write_changed_partitions(spark, df, path, ["k"], ["part"]) == 2
    assert sinks.write_changed_partitions(spark, df, path, ["k"], ["part"]) == 0
    assert sinks.write_changed_partitions(spark, df.withColumn("v", F.when(F.col("k") == 1, "z").otherwise(F.col("v"))), path, ["k"], ["part"]) == 1
    more = df.unionByName(spark.createDataFrame([(3, "c", "y")], df.schema))
    assert sinks.write_changed_partitions(spark, more, path, ["k"], ["part"]) == 2
    assert sinks.write_changed_partitions(spark, df.where("part = 'y'"), path, ["k"], ["part"]) == 1
    assert sorted(r.k for r in spark.read.parquet(path).collect()) == [1, 2]
    assert "<title>t &amp; u</title>" in sinks.atom("t & u", "l", [])
