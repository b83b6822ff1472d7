"""Trips of groups in which so many meet that no table of their pairs is made."""

from __future__ import annotations

import random
from collections import Counter
from decimal import ROUND_HALF_UP, Decimal
from statistics import median

import numpy as np
import pytest
from pyspark.sql import functions as F

from feedloom.functions import assignment, kernels
from feedloom.operators import trips
from feedloom.plans.config import Matching

TRIP = "pair_id string, group_key string, line string, direction string, day_type string, side string, trip_id string, places array<string>, times array<int>, departure int"
CFG = Matching()


def _crowd(seed, line_of_new="l", n=260):
    rng, runs, ids = random.Random(seed), [], iter(random.Random(seed).sample(range(10**6), 2 * n))
    for side in ("old", "new"):
        for _ in range(n):
            places = [rng.choice("abcd") for _ in range(rng.choice((1, 2, 2, 3, 3, 4, 7)))]
            times = [rng.randrange(0, 50, 3) if rng.random() > 0.1 else None for _ in places]
            runs += [("p", *[line_of_new if side == "new" else "l"] * 2, "0", "all", side, f"{side[0]}{next(ids)}", places, times, next((t for t in times if t is not None), None))]
    return runs


def _wanted(old, new, score, within, most, ends):
    """One-to-one assignment of all pairs in order, in plain Python; trips are (id, places, times, departure)."""
    found = []
    for o in old:
        for n in new:
            first = {}
            for p, t in zip(n[1], n[2], strict=True):
                if t is not None:
                    first.setdefault(p, t)
            delays = [abs(t - first[p]) for p, t in zip(o[1], o[2], strict=True) if t is not None and p in first]
            if not delays or median(delays) > within or (ends and o[1][0] != n[1][0] and o[1][-1] != n[1][-1]):
                continue
            share = score[0](o[1], n[1])
            cost = Decimal(repr(median(delays) / within + (1 - share))).quantize(Decimal("0.000001"), ROUND_HALF_UP)
            if share >= score[1] and (most is None or float(cost) <= most):
                rerouted = o[1] != n[1]
                retimed = any(delays) if rerouted else o[2] != n[2]
                found.append((cost, o[3] or 0, n[3] or 0, o[0], n[0], "_".join(x for x, y in (("retimed", retimed), ("rerouted", rerouted)) if y) or "exact"))
    want, a, b = {}, set(), set()
    for _, _, _, o, n, kind in sorted(found):
        if o not in a and n not in b:
            want[o] = (n, kind)
            a.add(o)
            b.add(n)
    return want


def _sides(runs, gone):
    return [[(r[6], r[7], r[8], r[9]) for r in runs if r[5] == side and r[6] not in gone] for side in ("old", "new")]


@pytest.mark.parametrize("step", [assignment.STEP, 500])
def test_crowds_pair_without_a_table_of_pairs(spark, monkeypatch, step):
    """where trips that all differ meet often, no table of their pairs is made, and they pair as in order."""
    runs = _crowd(1)
    every = spark.createDataFrame(runs, TRIP)
    monkeypatch.setattr(trips, "_near", None)
    rows = trips.match_trips(every).collect()
    got = {r["old_trip"]: (r["new_trip"], r["kind"]) for r in rows if r["old_trip"] and r["new_trip"]}
    equal = {x for r in trips.equal_trips(every).collect() for x in (r["old_trip"], r["new_trip"])}
    want = _wanted(*_sides(runs, equal), (kernels.similarity, CFG.pattern_min_similarity), CFG.trip_max_shift_min, CFG.trip_max_cost, False)
    assert len(want) > 100 and {o: x for o, x in got.items() if o not in equal} == want
    assert len(rows) == len(runs) - len(got)
    # the task itself, in steps and slices of any size, with times looked up either way
    monkeypatch.setattr(assignment, "STEP", step)
    monkeypatch.setattr(assignment, "CELLS", step)
    monkeypatch.setattr(assignment, "DENSE", 0)
    left = [trips._classes(trips._sided(every.where(~F.col("trip_id").isin(*equal)), trips.COMBO, side), trips.COMBO, side) for side in ("old", "new")]
    both = [x.select(*trips.COMBO, F.lit(s).alias("side"), "members", *[F.col(f"{s}_{c}").alias(c) for c in ("places", "times", "dep")], F.size(f"{s}_places").alias("calls")) for s, x in zip(("old", "new"), left, strict=True)]
    task = assignment.assigned(trips.COMBO, False, CFG.pattern_min_similarity, CFG.trip_max_shift_min, CFG.trip_max_cost, False)
    assert {r["old_trip"]: (r["new_trip"], r["kind"]) for r in task(both[0].unionByName(both[1]).toArrow()).to_pylist()} == want


def test_halves_round_up():
    """costs are rounded as Spark's round does it."""
    assert assignment.millionths(np.array([0.0078125, 0.0234375, 1.0, 0.1234564999])).tolist() == [7813, 23438, 1000000, 123456]


def test_crowds_move_lines_without_a_table_of_pairs(spark, monkeypatch):
    """nor is one made of trips that other lines leave over."""
    runs = _crowd(2, "m", 420)
    every = spark.createDataFrame(runs, TRIP)
    matched = trips.cut(trips.match_trips(every))
    monkeypatch.setattr(trips, "_near", None)
    got = {r["old_trip"]: (r["new_trip"], r["kind"]) for r in trips.match_moved_trips(every, matched).collect()}
    want = _wanted(*_sides(runs, set()), (kernels.containment, CFG.cross_line_min_containment), CFG.cross_line_max_shift_min, None, True)
    assert len(want) > 100 and got == want


def test_place_counts_only_rule_out(spark):
    """pairs that the counts of places rule out have no share that would do."""
    rng = random.Random(4)
    rows = [("p", side, [f"{side}{i}"], [rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(1, 8))]) for side in ("old", "new") for i in range(60)]
    table = spark.createDataFrame([(*r, [0] * len(r[3]), 0, len(r[3])) for r in rows], "k string, side string, members array<string>, places array<string>, times array<int>, dep int, calls int").toArrow()
    old, new = (assignment.Trips(table.filter(np.array(table["side"].to_pylist()) == side), side == "new") for side in ("old", "new"))
    for shorter, score in ((True, kernels.containment), (False, kernels.similarity)):
        group = assignment.Group(old, new, shorter, 0.1, 10, None, False)
        o, n = (x.ravel() for x in np.meshgrid(np.arange(60), np.arange(60)))
        shares = [score(rows[i][3], rows[60 + j][3]) for i, j in zip(o, n, strict=True)]
        assert (group.best(o, n) >= np.array(shares)).all() and (group.best(o, n) < 0.5).any()
        assert group.shares(group.old_pattern[o], group.new_pattern[n]).tolist() == shares


def test_crowds_are_edited_without_a_table_of_pairs(spark, monkeypatch):
    """nor is one made to count the edits of paired trips, and each pair counts."""
    runs = _crowd(3)
    every = spark.createDataFrame(runs, TRIP)
    monkeypatch.setattr(trips, "_near", None)
    matched = trips.cut(trips.match_trips(every))
    edits = {(r["kind"], tuple(r["places"])): r["trips"] for r in trips.trip_edits(matched, every).collect()}
    places, want = {r[6]: r[7] for r in runs}, Counter()
    for r in matched.where("kind like '%rerouted'").collect():
        want.update((kind, tuple(p)) for kind, p in kernels.edits_of(places[r["old_trip"]], places[r["new_trip"]]))
    assert len(want) > 10 and edits == want
