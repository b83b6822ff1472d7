"""Queries on tables that are larger, or fuller of equal rows, than the smallest ones."""

from __future__ import annotations

import itertools
import random

import pytest
from pyspark.sql import functions as F

from feedloom.functions import kernels
from feedloom.operators import lines, rawdiff, trips
from feedloom.plans import more_queries, queries
from feedloom.plans.config import Matching

PAIRS = "pair_id string, old_uid string, new_uid string"


def test_raw_diff_plans_no_task_for_a_publication(spark, monkeypatch):
    """rows meet pairs and their files without being dealt by publication or file."""
    pairs = spark.createDataFrame([("p", "a", "b")], PAIRS)
    cells = F.create_map(F.lit("stop_id"), F.col("id").cast("string"), F.lit("stop_name"), F.concat(F.lit("n"), F.col("id") % 7))
    side = lambda uid, kept: spark.range(1_000_000).where(f"id < 100 and {kept}").select(F.lit(uid).alias("uid"), F.lit("stops.txt").alias("file"), cells.alias("cells"))
    rows = side("a", "id % 2 = 0").unionByName(side("b", "id % 3 = 0"))
    files = spark.createDataFrame([(u, "stops.txt", u, "ok", "utf-8", ["stop_id", "stop_name"], n, 0) for u, n in (("a", 50), ("b", 34))], "uid string, file string, file_sha256 string, status string, encoding string, header array<string>, row_count long, ragged_rows long")
    plans, cut = [], rawdiff.cut

    def seen(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return cut(df)

    monkeypatch.setattr(rawdiff, "cut", seen)
    changes, _ = rawdiff.raw_diff(pairs, files, rows)
    assert {r["kind"]: r["count"] for r in changes.groupBy("kind").count().collect()} == {"row_added": 17, "row_removed": 33}
    assert "old_row" in plans[-2] and "SortMergeJoin" not in plans[-2]


def test_multiset_tells_every_row(spark, tmp_path):
    """F8: rows of a large file without a key are told with their copies, not summed up in one change."""
    spark.range(0, 1_200_000, 1, 2).select(F.col("id").alias("o_orderkey"), F.when(F.col("id") % 4 == 0, "O").otherwise("F").alias("o_orderstatus"), F.lit("1-HIGH").alias("o_orderpriority")).write.parquet(f"{tmp_path}/orders.parquet")
    spark.range(3).select(F.col("id").alias("p_partkey"), F.lit("n").alias("p_name"), F.lit("b").alias("p_brand"), F.lit(1).alias("p_size")).write.parquet(f"{tmp_path}/part.parquet")
    found = queries.FOUND["raw_diff_multiset"](spark, str(tmp_path)).collect()
    # old: even orders, 300,000 O and 300,000 F; new: each third, 100,000 O and 300,000 F
    assert [(r["kind"], r["status"], r["priority"], r["n"]) for r in found] == [("row_removed", "O", "1-HIGH", 200_000)]


def test_equal_trips_meet_by_what_is_equal(spark, monkeypatch):
    """only trips with equal places and times meet; those around them in time don't."""
    run = lambda side, trip, at: ("p", "l", "l", "0", "all", side, trip, ["a", "b"], [at, at + 5], at)
    every = spark.createDataFrame([run("old", "o1", 10), run("old", "o2", 11), run("new", "n1", 11), run("new", "n2", 12)], "pair_id string, group_key string, line string, direction string, day_type string, side string, trip_id string, places array<string>, times array<int>, departure int")
    monkeypatch.setattr(more_queries, "_coarse", lambda *_: every)
    monkeypatch.setattr(trips, "_near", None)
    assert [(r["old_trip"], r["new_trip"]) for r in more_queries.FOUND["equal_trips"](spark, "").collect()] == [("o2", "n1")]


def test_lines_overlap_in_slices_and_blocks(spark, monkeypatch):
    """pairs of lines don't leave the task that counts them unless they may overlap enough; slices and blocks lose none."""
    rng = random.Random(5)
    old = {f"o{i}": rng.sample(range(80), rng.randint(1, 30)) for i in range(30)}
    new = {f"n{i}": rng.sample(range(80), rng.randint(1, 30)) for i in range(25)}
    became = {str(p): str(p - p % 2) for p in range(70)}
    told = {k: {became[str(p)] for p in v if str(p) in became} for k, v in old.items()}
    want = set()
    for (o, a), (n, b) in itertools.product(told.items(), ((k, {str(p) for p in v}) for k, v in new.items())):
        if a & b and len(a & b) / min(len(a), len(b)) >= 0.4:
            want.add((o, n, round(len(a & b) / min(len(a), len(b)), 3)))
    table = lambda x: spark.createDataFrame([("p", k, [str(p) for p in v]) for k, v in x.items()], "pair_id string, line string, places array<string>")
    places = spark.createDataFrame([("p", a, b) for a, b in became.items()], "pair_id string, old_id string, new_id string")
    kernel = lines.proposed_pairs
    monkeypatch.setattr(lines, "SLICE_LEAST", 100)
    for block in (1 << 23, 20):
        monkeypatch.setattr(lines, "BLOCK", block)
        monkeypatch.setattr(lines, "proposed_pairs", lambda least: kernel(least, 50))
        rows = lines.overlap_edges(table(old), table(new), places, 0.4).collect()
        assert len(rows) == len(want) and {(r["o"], r["n"], r["overlap"]) for r in rows} == want


TRIP = "pair_id string, group_key string, line string, direction string, day_type string, side string, trip_id string, places array<string>, times array<int>, departure int"


def _told(spark, runs):
    """runs: side, id, line, places, times."""
    return spark.createDataFrame([("p", l, l, "0", "all", side, trip, places, times, times[0]) for side, trip, l, places, times in runs], TRIP)


def _met(monkeypatch):
    met, near = [], trips._near

    def counted(*given):
        out = near(*given)
        met.append(out.count())
        return out

    monkeypatch.setattr(trips, "_near", counted)
    return met


def _copies(line_of_new):
    runs = [("old", f"o{i:03}", "l", ["a", "b"], [100, 110]) for i in range(300)]
    return runs + [("new", f"n{i:03}", line_of_new, ["a", "b"], [102, 112]) for i in range(200)]


def test_equal_trips_meet_others_once(spark, monkeypatch):
    """300 equal trips and 200 equal ones near them meet once, not 60,000 times, and pair in order."""
    met = _met(monkeypatch)
    found = {r["old_trip"]: r["new_trip"] for r in trips.match_trips(_told(spark, _copies("l"))).collect()}
    assert met == [1] and found == {f"o{i:03}": f"n{i:03}" if i < 200 else None for i in range(300)}


def test_equal_trips_move_lines_together(spark, monkeypatch):
    """so do those that other lines leave over."""
    every = _told(spark, _copies("m"))
    matched = trips.match_trips(every)
    met = _met(monkeypatch)
    found = {r["old_trip"]: r["new_trip"] for r in trips.match_moved_trips(every, matched).collect()}
    assert met == [1] and found == {f"o{i:03}": f"n{i:03}" for i in range(200)}


def test_edits_of_equal_trips(spark, monkeypatch):
    """edits count every member of a class of equal trips."""
    met = _met(monkeypatch)
    every = _told(spark, [(side, trip, l, places if side == "old" else [*places, "c"], times if side == "old" else [*times, 120]) for side, trip, l, places, times in _copies("l")])
    edits = trips.shift_edits(trips.trip_edits(trips.match_trips(every), every)).collect()
    assert met == [1] and [(tuple(r["places"]), r["trips"]) for r in edits] == [(("c",), 200)]


@pytest.mark.parametrize("meetings", [20_000_000, 5])
def test_classes_pair_like_trips(spark, monkeypatch, meetings):
    """classes, ties and steps of cost give what one-to-one assignment of all pairs of trips in order gives."""
    rng, cfg = random.Random(3), Matching()
    runs = []
    for side, n in (("old", 60), ("new", 50)):
        for i in range(n):
            places = rng.choice([["a", "b"], ["a", "b", "c"], ["a", "c"], ["b", "a"]])
            at = rng.randrange(0, 60, 4)
            runs.append((side, f"{side}{rng.randrange(10**6)}", "l", places, [at + 5 * j for j in range(len(places))]))
    every = _told(spark, runs)
    old, new = (trips._sided(every, trips.COMBO, s) for s in ("old", "new"))
    equal = trips._equal_runs(old, new, trips.COMBO)
    free = [trips._without(x, equal, trips.COMBO, s) for x, s in ((old, "old"), (new, "new"))]
    near = trips._near(*free, trips.COMBO, cfg.trip_max_shift_min)
    scored = near.withColumn("share", kernels.sequence_similarity("old_places", "new_places")).where(F.col("share") >= cfg.pattern_min_similarity)
    cost = F.round(F.col("shift") / cfg.trip_max_shift_min + (1 - F.col("share")), 6)
    pairs = [r for r in scored.select(cost.alias("cost"), "old_dep", "new_dep", "old_trip", "new_trip").collect() if r["cost"] <= cfg.trip_max_cost]
    want, a, b = set(), set(), set()
    for r in sorted(pairs):
        if r["old_trip"] not in a and r["new_trip"] not in b:
            want.add((r["old_trip"], r["new_trip"]))
            a.add(r["old_trip"])
            b.add(r["new_trip"])
    monkeypatch.setattr(trips, "MEETINGS", meetings)
    met = _met(monkeypatch)
    got = trips.match_trips(every).where("kind <> 'exact' and old_trip is not null and new_trip is not null").collect()
    assert want and {(r["old_trip"], r["new_trip"]) for r in got} == want and len(got) == len(want)
    assert (len(met) > 1) == (meetings == 5)


def _pairs_cut(monkeypatch):
    kept, cut = [], trips.cut

    def seen(df):
        if {"old_trip", "new_trip", "shift"} <= set(df.columns):
            kept.append(dict(df.dtypes))
        return cut(df)

    monkeypatch.setattr(trips, "cut", seen)
    return kept


def test_moved_pairs_carry_no_lists(spark, monkeypatch):
    """pairs of classes have numbers of their places and times, whose size doesn't grow with the calls of a trip."""
    every = _told(spark, _copies("m"))
    matched = trips.match_trips(every)
    kept = _pairs_cut(monkeypatch)
    assert trips.match_moved_trips(every, matched).count() == 200
    assert len(kept) == 1 and not [x for x in kept[0].values() if x.startswith(("array", "map"))]


def test_edits_pairs_carry_no_lists(spark, monkeypatch):
    """nor do the pairs whose edits are counted; a call made several times counts as often for the delay."""
    old, new = (["a"] * 3 + ["b"], [10, 10, 10, 50]), (["a", "b"], [10, 90])
    every = _told(spark, [("old", "o", "l", *old), ("new", "n", "l", *new)])
    kept = _pairs_cut(monkeypatch)
    matched = trips.match_trips(every)
    assert [(r["old_trip"], r["new_trip"], r["kind"]) for r in matched.collect()] == [("o", "n", "retimed_rerouted")]
    assert trips.trip_edits(matched, every).count() and len(kept) == 1
    assert not [x for x in kept[0].values() if x.startswith(("array", "map"))]


def test_equal_trips_meet_in_one_exchange(spark):
    """lists of places and times are dealt out once to find equal trips, however the trips pair."""
    runs = [("old", "a", "l", ["p", "q"], [1, 2]), ("old", "b", "l", ["p", "q"], [1, 2]), ("new", "b", "l", ["p", "q"], [1, 2]), ("new", "c", "l", ["p", "q"], [1, 2]), ("new", "d", "l", ["p", "q"], [1, 2])]
    found = trips.equal_trips(_told(spark, [*runs, ("old", "e", "l", ["p"], [None]), ("new", "f", "l", ["p"], [None])]))
    assert {(r["old_trip"], r["new_trip"], r["kind"]) for r in found.collect()} == {("b", "b", "exact"), ("a", "c", "exact"), ("e", "f", "exact")}
    plan = found._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
    assert plan.count("Exchange hashpartitioning") == 1


def test_only_rerouted_trips_bring_places(spark, monkeypatch):
    """pairs of equal places stay out of the joins that count edits."""
    runs = [("old", "o", "l", ["a", "b"], [10, 50]), ("new", "n", "l", ["a", "b", "c"], [10, 50, 60]), ("old", "x", "l", ["a", "b"], [300, 310]), ("new", "x", "l", ["a", "b"], [300, 310])]
    every, kept, cut = _told(spark, runs), [], trips.cut
    matched = cut(trips.match_trips(every))
    monkeypatch.setattr(trips, "cut", lambda df: kept.append(df.count()) or cut(df))
    assert [(r["places"], r["trips"]) for r in trips.trip_edits(matched, every).collect()] == [(["c"], 1)]
    assert matched.count() == 2 and kept == [1]
