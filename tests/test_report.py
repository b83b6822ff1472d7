from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from feedloom.operators import accounting
from feedloom.plans import report
from feedloom.sources import gtfs_zip
from tests.feeds import NEW, OLD, archive


@pytest.fixture(scope="module")
def found(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("zips")
    for name, files in (("old", OLD), ("new", NEW)):
        (folder / f"{name}.zip").write_bytes(archive(files))
    scanned = gtfs_zip.scan(spark, f"{folder}/*.zip").withColumn("uid", F.regexp_extract("path", "([^/]+)[.]zip$", 1)).cache()
    pairs = spark.createDataFrame([("p", "old", "new")], "pair_id string, old_uid string, new_uid string")
    holidays = spark.createDataFrame([("2027-02-11",), ("2027-02-23",)], "d string").select(F.to_date("d").alias("date"))
    return report.build(pairs, gtfs_zip.files(scanned).withColumn("uid", F.regexp_extract("path", "([^/]+)[.]zip$", 1)), scanned.where("kind = 'row'").select("uid", "file", "row_no", "cells"), holidays)


WORK, SUN = "mon,tue,wed,thu,fri,sat,hol", "sun"


def test_places(found):
    told = {(r.old_id, r.new_id, r.status) for r in found.places.collect()}
    assert told == {("h1", "h1", "unchanged"), ("h2", "m2", "unchanged"), ("h3", "h3", "renamed"), ("h4", "h4", "unchanged"), ("h5", None, "removed"), (None, "h6", "added")}


def test_lines(found):
    assert {(*r.old, "->", *r.new, r.relation) for r in found.lines.collect()} == {("Red", "->", "Red", "same"), ("Blue", "->", "Blue", "same"), ("->", "Green", "added")}


def test_trips(found):
    told = {(r.day_type, r.group_key, r.old_trip, r.new_trip, r.kind) for r in found.trips.collect()}
    assert told == {
        (WORK, "Red", "a1", "a1", "exact"), (WORK, "Red", "a2", "a2", "retimed"), (WORK, "Red", None, "a4", "added"), (SUN, "Red", "a3", "a3", "exact"),
        (WORK, "Blue", "b1", "b1", "rerouted"), (WORK, "Blue", "b2", None, "removed"), (WORK, "Green", None, "g1", "added"),
    }
    assert [(r.old_trip, r.new_trip, r.kind) for r in found.moves.collect()] == [("b2", "g1", "retimed_rerouted")]
    assert {(r.kind, *r.places, r.trips) for r in found.edits.collect()} == {("inserted", "h6", 1), ("removed", "old:h5", 1)}
    assert found.residuals.count() == 0


def test_timetables(found):
    red = {r.side: r for r in found.timetables.where("group_key = 'Red' and day_type <> 'sun'").collect()}
    assert red["new"].places == ["h1", "m2", "h3", "h4"] and [(t.trip_id, t.times[0]) for t in red["new"].trips] == [("a1", 420), ("a2", 487), ("a4", 1080)]
    columns = {r.place: (r.old_trip, r.new_trip) for r in found.columns.where("group_key = 'Red' and day_type <> 'sun'").collect()}
    assert columns == {1: ("a1", "a1"), 2: ("a2", "a2"), 3: (None, "a4")}


def test_ids(found):
    (r,) = found.renumbered.collect()
    assert (r.stops, r.lines, r.trips) == (1, 1, 0)
    assert [(r.old, r.new) for r in found.mappings["stops"].collect()] == [(["h2"], ["m2"])]
    assert [(r.line, r.old, r.new) for r in found.mappings["routes"].collect()] == [("Red", ["red1"], ["red9"])]


def test_events_and_impact(found):
    types = sorted(r.type for r in found.events.collect())
    want = "FARE_CHANGED FIRST_LAST_CHANGED FIRST_LAST_CHANGED ROUTE_ADDED SERVICE_INCREASED SERVICE_INCREASED SERVICE_REDUCED STOP_ADDED STOP_INSERTED STOP_REMOVED STOP_RENAMED STOP_SKIPPED TRIPS_MOVED TRIPS_RETIMED"
    assert types == want.split()
    assert found.impacts.first()["class"] == "major" and found.classes.first()["class"] == "MEANINGFUL_SERVICE_CHANGE"


def test_accounting_is_complete(found):
    assert accounting.inconsistencies(found.classified, found.changes).count() == 0
    assert found.classified.count() == found.changes.count() and accounting.fare_summary(found.classified).first().prices_changed == 1


def test_comparison(found):
    assert {(r.day_type, r["mode"]) for r in found.comparison.collect()} == {(WORK, "same_days"), (SUN, "same_days")}
