"""Events of a pair with the raw changes behind them, their impact, and what class of change the pair is."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from feedloom.operators.accounting import entity
from feedloom.plans.config import CORE_COLUMNS, MAJOR_EVENTS, MAJOR_IF_PATTERN_SHARE, MAJOR_IF_SERVED, PATTERN_MAJOR_SHARE, SERVICE_MAJOR_SHARE, SERVICE_MAJOR_TRIPS, TECHNICAL_COLUMNS, TECHNICAL_EXCEPTION_KINDS, TECHNICAL_TOPICS

#: Events of places, lines and pattern edits by what became of them.
PLACE_EVENTS = {"added": ["STOP_ADDED"], "removed": ["STOP_REMOVED"], "renamed": ["STOP_RENAMED"], "moved": ["STOP_MOVED"], "renamed_moved": ["STOP_RENAMED", "STOP_MOVED"]}
LINE_EVENTS = {"added": "ROUTE_ADDED", "discontinued": "ROUTE_DISCONTINUED", "renamed": "ROUTE_RENAMED", "merged": "ROUTE_MERGED", "split": "ROUTE_SPLIT", "restructured": "ROUTE_RESTRUCTURED"}
EDIT_EVENTS = {
    "extended": "PATTERN_EXTENDED", "shortened": "PATTERN_SHORTENED", "inserted": "STOP_INSERTED", "removed": "STOP_SKIPPED",
    "detour_added": "DETOUR_ADDED", "detour_removed": "DETOUR_REMOVED", "reordered": "STOPS_REORDERED", "shifted": "DETOUR_SHIFTED",
}
EVENT = ["pair_id", "type", "place", "line", "to_line", "direction", "day_type", "places", "before", "after", "count", "topic"]
TYPES = {"places": "array<string>", "before": "bigint", "after": "bigint", "count": "bigint"}


def _map(values: dict) -> F.Column:
    return F.create_map(*[x if isinstance(x, F.Column) else F.lit(x) for k, v in values.items() for x in (k, F.array(*[F.lit(i) for i in v]) if isinstance(v, list) else v)])


def events_of(df: DataFrame, **columns) -> DataFrame:
    """df's pair_id and the given columns of an event, null for the others."""
    return df.select(*[(columns[c] if c in columns else F.col(c) if c == "pair_id" else F.lit(None)).cast(TYPES.get(c, "string")).alias(c) for c in EVENT])


def place_events(matches: DataFrame) -> DataFrame:
    each = matches.withColumn("t", F.explode(F.try_element_at(_map(PLACE_EVENTS), F.col("status"))))
    return events_of(each, type=F.col("t"), place=F.coalesce("new_id", "old_id"))


def line_events(groups: DataFrame) -> DataFrame:
    each = groups.withColumn("t", F.try_element_at(_map(LINE_EVENTS), F.col("relation"))).where("t is not null")
    return events_of(each, type=F.col("t"), line=F.col("group_key"))


def edit_events(edits: DataFrame) -> DataFrame:
    return events_of(edits, type=F.element_at(_map(EDIT_EVENTS), F.col("kind")), line=F.col("group_key"), direction=F.col("direction"), places=F.col("places"), count=F.col("trips"))


def service_events(counts: DataFrame) -> DataFrame:
    """counts: pair_id, group_key, day_type, before, after trips of a line on a day type."""
    each = counts.where("before <> after")
    return events_of(each, type=F.when(F.col("after") > F.col("before"), "SERVICE_INCREASED").otherwise("SERVICE_REDUCED"), line=F.col("group_key"), day_type=F.col("day_type"), before=F.col("before"), after=F.col("after"))


def timing_events(matched: DataFrame, ends: DataFrame, moves: DataFrame) -> DataFrame:
    """Retimed trips by line and day type, changed first and last departures, and trips that moved to another line.

    moves: pair_id, old_line, new_line, day_type, count.
    """
    retimed = matched.where("kind in ('retimed', 'retimed_rerouted')").groupBy("pair_id", "group_key", "day_type").agg(F.count("*").alias("n"))
    a = events_of(retimed, type=F.lit("TRIPS_RETIMED"), line=F.col("group_key"), day_type=F.col("day_type"), count=F.col("n"))
    b = events_of(ends.where("changed"), type=F.lit("FIRST_LAST_CHANGED"), line=F.col("group_key"), direction=F.col("direction"), day_type=F.col("day_type"))
    c = events_of(moves, type=F.lit("TRIPS_MOVED"), line=F.col("old_line"), to_line=F.col("new_line"), day_type=F.col("day_type"), count=F.col("count"))
    return a.unionByName(b).unionByName(c)


def topic_events(classified: DataFrame) -> DataFrame:
    topics = classified.where("topic is not null").select("pair_id", "topic").distinct()
    return events_of(topics, type=F.when(F.col("topic") == "fares", "FARE_CHANGED").otherwise("OTHER_CHANGED"), topic=F.col("topic"))


def evidence_index(changes: DataFrame) -> DataFrame:
    """pair_id, file, entity, id of every raw change whose row is about something."""
    return changes.withColumn("entity", entity()).where("entity is not null").select("pair_id", "file", "entity", "id")


def id_ranges(ids: DataFrame, keys: list[str]) -> DataFrame:
    """keys, ranges: change ids as c0000012 or, for consecutive ones, c0000012-c0000340, in order."""
    n = F.substr("id", F.lit(2)).cast("long")
    run = ids.select(*keys, n.alias("n")).distinct().withColumn("run", F.col("n") - F.row_number().over(W.partitionBy(*keys).orderBy("n")))
    ends = run.groupBy(*keys, "run").agg(F.min("n").alias("a"), F.max("n").alias("b"))
    name = lambda c: F.format_string("c%07d", c)
    each = F.transform(F.array_sort(F.collect_list(F.struct("a", "b"))), lambda x: F.when(x["a"] == x["b"], name(x["a"])).otherwise(F.concat_ws("-", name(x["a"]), name(x["b"]))))
    return ends.groupBy(*keys).agg(each.alias("ranges"))


def group_routes(groups: DataFrame, lines: DataFrame) -> DataFrame:
    """groups with old_routes and new_routes, the route ids of their lines. lines: pair_id, side, line, route_ids."""
    out = groups
    for side in ("old", "new"):
        each = groups.select("pair_id", "group_key", F.explode(side).alias("line")).join(lines.where(F.col("side") == side), ["pair_id", "line"])
        routes = each.select("pair_id", "group_key", F.explode("route_ids").alias("r")).groupBy("pair_id", "group_key").agg(F.array_sort(F.collect_set("r")).alias(f"{side}_routes"))
        out = out.join(routes, ["pair_id", "group_key"], "left").withColumn(f"{side}_routes", F.coalesce(f"{side}_routes", F.array().cast("array<string>")))
    return out


def mappings(matches: DataFrame, groups: DataFrame, matched: DataFrame) -> dict[str, DataFrame]:
    """Ids that changed while what they name stayed: stops, routes and trips, old to new. groups: as of group_routes()."""
    stops = matches.where("old_members is not null and new_members is not null and old_members <> new_members").select("pair_id", F.col("old_members").alias("old"), F.col("new_members").alias("new"))
    routes = groups.where("size(old_routes) > 0 and size(new_routes) > 0 and old_routes <> new_routes").select("pair_id", F.col("group_key").alias("line"), F.col("old_routes").alias("old"), F.col("new_routes").alias("new"), "relation", "confidence")
    trips = matched.where("old_trip <> new_trip").select("pair_id", F.col("old_trip").alias("old"), F.col("new_trip").alias("new")).distinct()
    return {"stops": stops, "routes": routes, "trips": trips}


def renumbered_routes(groups: DataFrame) -> DataFrame:
    """groups of group_routes() with `renumbered`, the route ids that only one side has."""
    differ = F.array_sort(F.array_union(F.array_except("old_routes", "new_routes"), F.array_except("new_routes", "old_routes")))
    return groups.withColumn("renumbered", differ)


def renumbering(matches: DataFrame, groups: DataFrame, matched: DataFrame) -> DataFrame:
    """pair_id, stops, lines, trips: unchanged places, lines of one name and equal trips whose ids are others now."""
    other = lambda a, b: (F.size(F.array_except(a, b)) > 0) | (F.size(F.array_except(b, a)) > 0)
    stops = matches.where((F.col("status") == "unchanged") & other("old_members", "new_members")).select("pair_id", F.lit("stops").alias("what"))
    lines = groups.where((F.col("relation") == "same") & other("old_routes", "new_routes")).select("pair_id", F.lit("lines").alias("what"))
    trips = matched.where("kind = 'exact' and old_trip <> new_trip").select("pair_id", "old_trip").distinct().select("pair_id", F.lit("trips").alias("what"))
    return stops.unionByName(lines).unionByName(trips).groupBy("pair_id").agg(*[F.count_if(F.col("what") == c).alias(c) for c in ("stops", "lines", "trips")])


def reasons(classified: DataFrame, exceptions: DataFrame, summary: DataFrame) -> DataFrame:
    """pair_id, reason, passenger_facing of everything that changed. What the rules don't name counts as passenger-facing.

    summary: pair_id, reason of changed lines, places, trips and days; exceptions: pair_id, kind.
    """
    technical = F.create_map(*[x for f, cs in TECHNICAL_COLUMNS.items() for x in (F.lit(f), F.array(*[F.lit(c) for c in cs]).cast("array<string>"))])
    core = F.create_map(*[x for f, cs in CORE_COLUMNS.items() for x in (F.lit(f), F.array(*[F.lit(c) for c in cs]))])
    cells = classified.where(F.col("file").isin(*CORE_COLUMNS) & F.col("column").isNotNull() & F.col("kind").isin("field_changed", "column_added", "column_removed")).where(~F.array_contains(F.element_at(core, F.col("file")), F.col("column"))).select("pair_id", "file", "column").distinct()
    by_column = cells.select("pair_id", F.concat_ws(":", "file", "column").alias("reason"), (~F.array_contains(F.element_at(technical, F.col("file")), F.col("column"))).alias("passenger_facing"))
    topics = classified.where("topic is not null and topic not in ('attributes', 'calendar_exceptions')").select("pair_id", F.col("topic").alias("reason"), (~F.col("topic").isin(*TECHNICAL_TOPICS)).alias("passenger_facing")).distinct()
    by_kind = exceptions.select("pair_id", F.concat_ws(".", F.lit("calendar_exceptions"), "kind").alias("reason"), (~F.col("kind").isin(*TECHNICAL_EXCEPTION_KINDS)).alias("passenger_facing")).distinct()
    open_ = classified.where("bucket = 'unclassified'").select("pair_id", F.lit("unclassified").alias("reason"), F.lit(True).alias("passenger_facing")).distinct()
    return summary.select("pair_id", "reason", F.lit(True).alias("passenger_facing")).unionByName(topics).unionByName(by_column).unionByName(by_kind).unionByName(open_)


def pair_classes(pairs: DataFrame, why: DataFrame) -> DataFrame:
    """pair_id, class, passenger_facing and technical reasons."""
    each = why.groupBy("pair_id").agg(*[F.array_sort(F.collect_set(F.when(c, F.col("reason")))).alias(n) for n, c in (("passenger_facing", F.col("passenger_facing")), ("technical", ~F.col("passenger_facing")))])
    some = F.coalesce("passenger_facing", F.array().cast("array<string>"))
    out = pairs.select("pair_id").join(each, "pair_id", "left")
    return out.select("pair_id", F.when(F.size(some) > 0, "MEANINGFUL_SERVICE_CHANGE").otherwise("TECHNICAL_OR_METADATA_ONLY").alias("class"), some.alias("passenger_facing"), F.coalesce("technical", F.array().cast("array<string>")).alias("technical"))


def pair_codes(pairs: DataFrame, classes: DataFrame, errors: DataFrame, estimates: DataFrame) -> DataFrame:
    """pair_id, code: U/FATAL, E, M or T from a report, U/ and a failure's code, an estimate, or U/NOT_REPORTED, in that order.

    pairs: pair_id, old_status, new_status, equivalent.
    """
    all_ = pairs.join(classes.select("pair_id", "class"), "pair_id", "left").join(errors.select("pair_id", F.col("code").alias("error")), "pair_id", "left").join(estimates, "pair_id", "left")
    code = (
        F.when((F.col("old_status") == "FATAL") | (F.col("new_status") == "FATAL"), "U/FATAL")
        .when(F.col("equivalent"), "E")
        .when(F.col("class") == "MEANINGFUL_SERVICE_CHANGE", "M")
        .when(F.col("class") == "TECHNICAL_OR_METADATA_ONLY", "T")
        .when(F.col("error").isNotNull(), F.concat(F.lit("U/"), "error"))
        .otherwise(F.coalesce("estimate", F.lit("U/NOT_REPORTED")))
    )
    return all_.select("pair_id", code.alias("code"))


def event_classes(events: DataFrame, served: DataFrame, direction_trips: DataFrame, fares: DataFrame, why: DataFrame) -> DataFrame:
    """events with class major, minor or technical.

    served: pair_id, place of places that a line serves; direction_trips: pair_id, line, direction, trips (of the larger
    side); fares: fare_summary(); why: reasons().
    """
    facing = why.where("passenger_facing").groupBy("pair_id").agg(F.bool_or(F.col("reason").startswith("calendar_exceptions.")).alias("by_kind"), F.bool_or(F.col("reason").contains(":")).alias("by_column"))
    rows = events.join(served.select("pair_id", "place", F.lit(True).alias("served")).distinct(), ["pair_id", "place"], "left").join(direction_trips, ["pair_id", "line", "direction"], "left").join(fares.drop("changed"), "pair_id", "left").join(facing, "pair_id", "left")
    t, change = F.col("type"), F.abs(F.col("after") - F.col("before"))
    yes = lambda c: F.coalesce(c, F.lit(False))
    big = (change >= SERVICE_MAJOR_TRIPS) & ((F.col("before") == 0) | (change >= SERVICE_MAJOR_SHARE * F.col("before")))
    share = F.col("count").isNull() | yes((F.col("trips") > 0) & (F.col("count") >= PATTERN_MAJOR_SHARE * F.col("trips")))
    price = yes((F.col("prices_changed") > 0) | (F.col("classes_added") != F.col("classes_removed")))
    topic = F.col("topic")
    other = F.when(topic.isin(*TECHNICAL_TOPICS), "technical").when(topic == "calendar_exceptions", F.when(yes(F.col("by_kind")), "minor").otherwise("technical")).when(topic == "attributes", F.when(yes(F.col("by_column")), "minor").otherwise("technical")).otherwise("minor")
    cls = (
        F.when(t.isin(*MAJOR_EVENTS), "major")
        .when(t.isin(*MAJOR_IF_SERVED), F.when(yes(F.col("served")), "major").otherwise("technical"))
        .when(t.isin("SERVICE_INCREASED", "SERVICE_REDUCED"), F.when(yes(big), "major").otherwise("minor"))
        .when(t.isin(*MAJOR_IF_PATTERN_SHARE), F.when(share, "major").otherwise("minor"))
        .when(t == "FARE_CHANGED", F.when(price, "major").otherwise("minor"))
        .when(t == "OTHER_CHANGED", other)
        .otherwise("minor")
    )
    return rows.withColumn("class", cls).select(*events.columns, "class")


def _rank() -> F.Column:
    return F.when(F.col("class") == "major", 2).when(F.col("class") == "minor", 1).otherwise(0)


def _named(rank: F.Column) -> F.Column:
    return F.element_at(F.array(F.lit("technical"), F.lit("minor"), F.lit("major")), rank + 1)


def line_impacts(classed: DataFrame) -> DataFrame:
    """pair_id, line, class: the highest of its events."""
    return classed.where("line is not null").groupBy("pair_id", "line").agg(_named(F.max(_rank())).alias("class"))


def pair_impacts(classed: DataFrame, classes: DataFrame) -> DataFrame:
    """pair_id, class: the highest of its events, minor at least where the pair is meaningful."""
    floor = classes.select("pair_id", F.when(F.col("class") == "MEANINGFUL_SERVICE_CHANGE", 1).alias("floor"))
    top = classed.groupBy("pair_id").agg(F.max(_rank()).alias("top"))
    return floor.join(top, "pair_id", "left").select("pair_id", _named(F.greatest("floor", "top")).alias("class"))


def impact_types(classed: DataFrame) -> DataFrame:
    return classed.groupBy("pair_id", "type", "class").count()


def impact_trips(events: DataFrame) -> DataFrame:
    """Trips added, removed and retimed and lines increased and reduced by pair and day type."""
    d = F.col("after") - F.col("before")
    service = F.col("type").isin("SERVICE_INCREASED", "SERVICE_REDUCED")
    rows = events.where(service | (F.col("type") == "TRIPS_RETIMED"))
    total = lambda c: F.coalesce(F.sum(c), F.lit(0))
    return rows.groupBy("pair_id", "day_type").agg(total(F.when(service & (d > 0), d)).alias("added"), total(F.when(service & (d < 0), -d)).alias("removed"), total(F.when(~service, F.col("count"))).alias("retimed"), F.count_if(service & (d > 0)).alias("increased"), F.count_if(service & (d < 0)).alias("reduced"))
