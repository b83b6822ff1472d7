"""The whole comparison of many pairs in one plan of tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.operators import accounting, calendar, events, lines, places, rawdiff, trips
from feedloom.operators.graph import cut
from feedloom.plans.config import Config

#: Tables that a run writes for each pair.
TABLES = ("changes", "comparison", "places", "lines", "trips", "moves", "edits", "residuals", "classified", "events", "reasons", "classes", "impacts", "timetables", "columns", "renumbered")


@dataclass
class PairReport:
    """Tables of one comparison, each keyed by pair_id."""

    changes: DataFrame
    files: DataFrame
    comparison: DataFrame
    places: DataFrame
    lines: DataFrame
    trips: DataFrame
    moves: DataFrame
    edits: DataFrame
    residuals: DataFrame
    classified: DataFrame
    events: DataFrame
    reasons: DataFrame
    classes: DataFrame
    impacts: DataFrame
    day_trips: DataFrame
    timetables: DataFrame
    columns: DataFrame
    mappings: dict[str, DataFrame]
    renumbered: DataFrame


def _both(matches: DataFrame, side: str) -> DataFrame:
    return matches.select("pair_id", "group_key", F.lit(side).alias("side"), F.explode(side).alias("line"))


def build(pairs: DataFrame, files: DataFrame, rows: DataFrame, holidays: DataFrame, config: Config | None = None) -> PairReport:
    """Compares all pairs (pair_id, old_uid, new_uid). What belongs to one publication is worked out once for all its pairs."""
    config = config or Config()
    cfg = config.matching
    changes, paired = rawdiff.raw_diff(pairs, files, rows, config)
    changes = cut(changes)
    days = cut(calendar.build_calendar(rows, holidays, config))
    comparison = cut(calendar.choose_comparison(pairs, days, config))
    all_places = cut(places.build_places(places.stops_of(rows), cfg))
    stop_places = cut(places.place_of_stop(all_places))
    matches = cut(places.match_places(pairs, all_places, cfg))
    place_map = matches.where("old_id is not null and new_id is not null").select("pair_id", "old_id", "new_id")
    all_lines = cut(lines.build_lines(rows, stop_places, cfg))
    groups = cut(lines.with_group_keys(lines.match_lines(pairs, all_lines, place_map, cfg)))
    members = _both(groups, "old").unionByName(_both(groups, "new"))
    of_pair = cut(trips.pair_trips(pairs, trips.publication_trips(rows, stop_places, all_lines), place_map, members))
    day_trips = trips.on_typical_days(of_pair, comparison)
    day_trips = cut(trips.aligned(day_trips) if cfg.direction_align else day_trips)
    matched = cut(trips.match_trips(day_trips, cfg))
    moves = cut(trips.match_moved_trips(day_trips, matched, cfg))
    edits = trips.trip_edits(matched, day_trips)
    edits = cut(trips.shift_edits(edits) if config.report.pattern_shifts else edits)
    residuals = cut(trips.date_residuals(pairs, days, comparison, of_pair))

    seen = cut(_evidence_days(pairs, days, of_pair))
    classified = cut(accounting.classify(changes, _evidence(pairs, matches, groups, all_lines, matched, moves, day_trips, seen)))
    counts = day_trips.groupBy("pair_id", "group_key", "day_type").agg(F.count_if(F.col("side") == "old").alias("before"), F.count_if(F.col("side") == "new").alias("after"))
    ends = trips.first_last(day_trips, cfg.first_last_min_shift)
    line_of = lambda p: day_trips.where(F.col("side") == p).select("pair_id", "day_type", F.col("trip_id").alias(f"{p}_trip"), F.col("group_key").alias(f"{p}_line")).dropDuplicates(["pair_id", "day_type", f"{p}_trip"])
    moved = moves.join(line_of("old"), ["pair_id", "day_type", "old_trip"]).join(line_of("new"), ["pair_id", "day_type", "new_trip"]).groupBy("pair_id", "old_line", "new_line", "day_type").count()
    found = events.place_events(matches).unionByName(events.line_events(groups)).unionByName(events.edit_events(edits)).unionByName(events.service_events(counts)).unionByName(events.timing_events(matched, ends, moved)).unionByName(events.topic_events(classified))
    summary = _summary(matches, groups, ends, moves, residuals, counts)
    exceptions = accounting.exception_details(classified, _shared_service_dates(pairs, days), of_pair.select("pair_id", "service_id").distinct())
    why = cut(events.reasons(classified, exceptions, summary))
    classes = cut(events.pair_classes(pairs, why))
    served = day_trips.select("pair_id", F.explode("places").alias("place")).select("pair_id", F.regexp_replace("place", "^old:", "").alias("place"))
    totals = day_trips.groupBy("pair_id", F.col("group_key").alias("line"), "direction").agg(F.greatest(F.count_if(F.col("side") == "old"), F.count_if(F.col("side") == "new")).alias("trips"))
    classed = cut(events.event_classes(found, served, totals, accounting.fare_summary(classified), why))
    return PairReport(changes, paired, comparison, matches, groups, matched, moves, edits, residuals, classified, classed, why, classes, events.pair_impacts(classed, classes), day_trips, *_tables(pairs, matches, groups, all_lines, matched, day_trips))


def _tables(pairs: DataFrame, matches: DataFrame, groups: DataFrame, all_lines: DataFrame, matched: DataFrame, day_trips: DataFrame) -> tuple:
    """Timetables with the order of their columns, ids that changed, and how many of each kind."""
    of_side = lambda p: pairs.select("pair_id", F.col(f"{p}_uid").alias("uid")).join(all_lines, "uid").select("pair_id", F.lit(p).alias("side"), "line", "route_ids")
    routes = events.group_routes(groups, of_side("old").unionByName(of_side("new")))
    return trips.timetables(day_trips), trips.timetable_order(matched, day_trips), events.mappings(matches, routes, matched), events.renumbering(matches, routes, matched)


def _evidence_days(pairs: DataFrame, days: DataFrame, of_pair: DataFrame) -> DataFrame:
    """Trips that ran on a date both sides cover."""
    dates = _shared_service_dates(pairs, days).select("pair_id", "side", "service_id").distinct()
    return of_pair.join(dates, ["pair_id", "side", "service_id"]).select("pair_id", F.col("trip_id").alias("id")).distinct()


def _shared_service_dates(pairs: DataFrame, days: DataFrame) -> DataFrame:
    side = lambda p: pairs.select("pair_id", F.col(f"{p}_uid").alias("uid")).join(days, "uid").select("pair_id", F.lit(p).alias("side"), "date", "services")
    both = side("old").unionByName(side("new"))
    shared = both.groupBy("pair_id", "date").agg(F.count_distinct("side").alias("n")).where("n = 2").select("pair_id", "date")
    return both.join(shared, ["pair_id", "date"]).select("pair_id", "side", F.explode("services").alias("service_id"), "date")


def _evidence(pairs: DataFrame, matches: DataFrame, groups: DataFrame, all_lines: DataFrame, matched: DataFrame, moves: DataFrame, day_trips: DataFrame, seen: DataFrame) -> dict[str, DataFrame]:
    """Ids of the source rows that the report explains."""
    none = F.array().cast("array<string>")
    members = F.explode(F.array_distinct(F.concat(F.coalesce("old_members", none), F.coalesce("new_members", none))))
    side_lines = lambda p: pairs.select("pair_id", F.col(f"{p}_uid").alias("uid")).join(all_lines, "uid").select("pair_id", F.lit(p).alias("side"), "line", "route_ids", "family_routes")
    sided = side_lines("old").unionByName(side_lines("new")).join(_both(groups, "old").unionByName(_both(groups, "new")), ["pair_id", "side", "line"])
    own = matched.groupBy("pair_id", "group_key").agg(F.bool_or(F.col("kind") != "exact").alias("differs"))
    status = groups.join(own, ["pair_id", "group_key"], "left").select("pair_id", "group_key", ((F.col("relation") != "same") | F.coalesce("differs", F.lit(False))).alias("changed"))
    routes = sided.join(status, ["pair_id", "group_key"])
    ids = lambda df, c: df.select("pair_id", F.col(c).alias("id"))
    both_ids = lambda df: ids(df.where("old_trip is not null"), "old_trip").unionByName(ids(df.where("new_trip is not null"), "new_trip"))
    exact = matched.where("kind = 'exact' and old_trip = new_trip")
    moved_ids = both_ids(moves)
    stop_place = lambda side, key: matches.where(f"{side}_members is not null").select("pair_id", F.explode(f"{side}_members").alias("id"), F.coalesce("new_id", F.concat(F.lit("old:"), "old_id")).alias("value"))
    return {
        "changed_stops": matches.where("status <> 'unchanged'").select("pair_id", members.alias("id")),
        "grouped_stops": matches.where("greatest(coalesce(size(old_members), 0), coalesce(size(new_members), 0)) > 1").select("pair_id", members.alias("id")),
        "changed_routes": routes.where("changed").select("pair_id", F.explode("route_ids").alias("id")),
        "family_routes": routes.select("pair_id", F.explode("family_routes").alias("id")),
        "route_line": routes.select("pair_id", F.explode("route_ids").alias("id"), F.col("group_key").alias("value")),
        "changed_trips": both_ids(matched.where("kind <> 'exact' or old_trip <> new_trip")).unionByName(moved_ids),
        "same_trips": ids(exact, "old_trip"),
        "compared_trips": ids(day_trips, "trip_id"),
        "date_trips": seen,
        "old_stop_place": stop_place("old", "old_id"),
        "new_stop_place": stop_place("new", "new_id"),
    }


def _summary(matches: DataFrame, groups: DataFrame, ends: DataFrame, moves: DataFrame, residuals: DataFrame, counts: DataFrame) -> DataFrame:
    """pair_id, reason of what the report's summary would count."""
    name = lambda df, reason: df.select("pair_id", reason.alias("reason")).distinct()
    days = counts.groupBy("pair_id", "day_type").agg(F.sum("before").alias("b"), F.sum("after").alias("a")).where("a <> b")
    return (
        name(matches.where("status <> 'unchanged'"), F.concat(F.lit("places."), F.regexp_replace("status", "renamed_moved", "renamed")))
        .unionByName(name(groups.where("relation <> 'same'"), F.concat(F.lit("lines."), "relation")))
        .unionByName(name(ends.where("changed"), F.lit("first_last_changed")))
        .unionByName(name(moves, F.lit("trip_moves")))
        .unionByName(name(residuals, F.lit("date_changes")))
        .unionByName(name(days, F.lit("trips_by_day_type")))
    )
