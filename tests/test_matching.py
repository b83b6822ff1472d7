"""Lines, trips and geometry of pairs, against small cases worked out by hand."""

from __future__ import annotations

from pyspark.sql import functions as F

from feedloom.operators import lines, places, trips
from feedloom.plans.config import Matching

EDGES = "pair_id string, o string, n string, overlap double, inside double, alike double"


def told(spark, edges, **cfg):
    table = spark.createDataFrame([("p", *e) for e in edges], EDGES)
    return {("+".join(r.old), "+".join(r.new), r.relation, r.method, r.confidence) for r in lines.interpreted(table, Matching(**cfg)).collect()}


def test_shapes_of_groups(spark):
    found = told(spark, [("a", "x", 0.9, 0.1, 0.1), ("b", "y", 0.8, 0.0, 0.0), ("b", "z", 0.7, 0.0, 0.0), ("c", "w", 0.9, 0.0, 0.0), ("d", "w", 0.6, 0.0, 0.0)])
    assert found == {("a", "x", "renamed", "served_places", 0.9), ("b", "y+z", "split", "served_places", 0.7), ("c+d", "w", "merged", "served_places", 0.6)}


def test_names_divide_a_group(spark):
    edges = [("a1", "a2", 0.7, 1.0, 0.9), ("a1", "b2", 0.9, 0.2, 0.1), ("b1", "b2", 0.8, 1.0, 0.9)]
    assert told(spark, edges) == {("a1", "a2", "renamed", "served_places_and_name", 0.7), ("b1", "b2", "renamed", "served_places_and_name", 0.8)}
    assert told(spark, edges, line_name_pair_min_similarity=None) == {("a1+b1", "a2+b2", "restructured", "served_places", 0.7)}
    # one name alone doesn't name every line, and the group is small enough to be read whole
    assert told(spark, [*edges[:2], ("b1", "b2", 0.8, 0.1, 0.1)]) == {("a1+b1", "a2+b2", "restructured", "served_places", 0.7)}


def test_what_names_leave_is_read_again(spark):
    edges = [("a1", "a2", 0.9, 1.0, 1.0), ("b1", "b2", 0.9, 1.0, 1.0), ("a1", "b2", 0.8, 0.0, 0.0), ("b1", "c2", 0.8, 0.0, 0.0), ("c1", "c2", 0.7, 0.0, 0.0), ("c1", "d2", 0.7, 0.0, 0.0), ("d1", "d2", 0.7, 0.0, 0.0)]
    found = told(spark, edges)
    assert found == {("a1", "a2", "renamed", "served_places_and_name", 0.9), ("b1", "b2", "renamed", "served_places_and_name", 0.9), ("c1+d1", "c2+d2", "restructured", "served_places", 0.7)}
    assert told(spark, [(f"o{i}", "n", 0.9, 0.0, 0.0) for i in range(7)]) == set()


RUNS = "pair_id string, group_key string, line string, direction string, day_type string, side string, trip_id string, places array<string>, times array<int>"


def runs(spark, rows):
    table = spark.createDataFrame([("p", line, line, "0", "all", side, trip, list(where), at) for side, line, trip, where, at in rows], RUNS)
    return table.withColumn("departure", F.get(F.filter("times", lambda t: t.isNotNull()), F.lit(0)))


def test_trips_pair_by_cost(spark):
    every = runs(spark, [
        ("old", "L", "a", "ABCD", [10, 20, 30, 40]), ("old", "L", "b", "ABCD", [60, 70, 80, 90]), ("old", "L", "c", "XY", [60, 70]), ("old", "L", "e", "ABCD", [300, None, 320, 330]),
        ("new", "L", "a", "ABCD", [13, 23, 33, 43]), ("new", "L", "z", "ABCD", [11, 21, 31, 41]), ("new", "L", "b", "ABD", [60, 70, 90]), ("new", "L", "e2", "ABCD", [300, None, 320, 330]), ("new", "L", "f", "ABCD", [900, 910, 920, 930]),
    ])
    found = {(r.old_trip, r.new_trip, r.kind) for r in trips.match_trips(every).collect()}
    assert found == {("e", "e2", "exact"), ("a", "z", "retimed"), ("b", "b", "rerouted"), (None, "a", "added"), ("c", None, "removed"), (None, "f", "added")}


def test_equal_trips_keep_their_id(spark):
    every = runs(spark, [("old", "L", t, "AB", [10, 20]) for t in ("p", "q", "r")] + [("new", "L", t, "AB", [10, 20]) for t in ("q", "s")])
    assert {(r.old_trip, r.new_trip, r.kind) for r in trips.match_trips(every).collect()} == {("q", "q", "exact"), ("p", "s", "exact"), ("r", None, "removed")}


def test_moves_share_an_end(spark):
    every = runs(spark, [("old", "L", "a", "ABC", [10, 20, 30]), ("old", "L", "b", "ABC", [100, 110, 120]), ("new", "M", "c", "AB", [12, 22]), ("new", "M", "d", "XBCY", [90, 110, 120, 130])])
    matched = trips.match_trips(every)
    assert [(r.old_trip, r.new_trip, r.kind) for r in trips.match_moved_trips(every, matched).collect()] == [("a", "c", "retimed_rerouted")]


def test_shift_edits(spark):
    rows = [("p", "L", "0", "inserted", ["X"], 3), ("p", "L", "0", "removed", ["X"], 2), ("p", "L", "0", "detour_added", ["B", "A"], 4), ("p", "L", "0", "detour_removed", ["A", "B"], 4), ("p", "L", "0", "reordered", ["Q"], 1), ("p", "M", "0", "removed", ["X"], 9)]
    got = trips.shift_edits(spark.createDataFrame(rows, "pair_id string, group_key string, direction string, kind string, places array<string>, trips long")).collect()
    assert {(r.group_key, r.kind, *r.places, r.trips) for r in got} == {("L", "inserted", "X", 1), ("L", "shifted", "X", 2), ("L", "shifted", "B", "A", 4), ("L", "reordered", "Q", 1), ("M", "removed", "X", 9)}


def test_date_changes_pair_nearest_first(spark):
    item = lambda line, at, n: (line, ["A"], [at], n)
    rows = [("p", "r", [item("L", 100, -1), item("L", 120, 1), item("L", 130, 1), item("L", 300, -2), item("M", 100, 1)])]
    table = spark.createDataFrame(rows, "pair_id string, residual string, trips array<struct<group_key: string, places: array<string>, times: array<int>, n: long>>")
    found = trips.changed_runs(table, 45)
    assert sorted((r.group_key, r.kind, r.old_time or 0, r.new_time or 0) for r in found.collect()) == [("L", "added", 0, 130), ("L", "changed", 100, 120), ("L", "removed", 300, 0), ("L", "removed", 300, 0), ("M", "added", 0, 100)]
    listed = trips.date_change_list(found, 100, 1).collect()
    assert sorted((r.kind, r.place, r.trips, r.groups) for r in listed) == [("added", 1, 2, 1), ("changed", 1, 1, 1), ("removed", 1, 2, 1)]


def test_geometry_block(spark):
    point = lambda x: (35.0 + x * 0.01, 139.0)
    known = spark.createDataFrame([("s", [point(0), point(1), point(2)]), ("t", [point(0), point(5)])], "shape_id string, points array<struct<lat: double, lon: double>>")
    used = spark.createDataFrame([("L", "s"), ("L", "s"), ("L", "t"), ("M", "none")], "line string, shape_id string")
    patterns = spark.createDataFrame([("L", ["a", "b"]), ("M", ["a", "c", "b"])], "line string, places array<string>")
    at = spark.createDataFrame([("a", *point(0)), ("b", *point(2))], "place_id string, lat double, lon double")
    old = places.line_geometry(used, known, patterns, at, ["line"], 10.0)
    assert {(r.line, r.source, r.length_m, len(r.points)) for r in old.collect()} == {("L", "shape", 2224, 2), ("M", "stops", 2224, 2)}
    new = old.where("line = 'L'")
    block = {r.line: r for r in places.geometry_block(old, new, ["line"], 20.0, 50.0, 500.0).collect()}
    assert block["L"].identical and block["L"].change.max_m == 0 and not block["M"].identical and block["M"].new_points is None
