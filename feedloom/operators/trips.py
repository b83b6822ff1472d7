"""Trips of a day, their matching, pattern edits and timetables.

A combo is (pair_id, group_key, direction, day_type). Trips pair in joins and rounds over tables, where Python sees each pair
of patterns once, and of trips only the ids of classes that tie; groups in which many trips meet pair in a task each.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedloom.functions import scalar as s
from feedloom.functions.assignment import assigned
from feedloom.functions.kernels import BRINGS, TAKES, merged_patterns, pattern_edits, sequence_containment, sequence_similarity
from feedloom.operators.graph import cut, greedy, greedy_classes
from feedloom.plans.config import Matching
from feedloom.sources.gtfs_zip import table

LATE = 10**6


def calls(rows: DataFrame, place_of_stop: DataFrame) -> DataFrame:
    """uid, trip_id, seq, place_id, time, dwell of every call with a whole sequence number at a stop of a place."""
    raw = table(rows, "stop_times.txt", "trip_id", "stop_id", "stop_sequence", "arrival_time", "departure_time").withColumn("seq", F.trim("stop_sequence").try_cast("int")).where("seq is not null")
    dep, arr = s.minutes(F.col("departure_time")), s.minutes(F.col("arrival_time"))
    return raw.join(place_of_stop, ["uid", "stop_id"]).select("uid", "trip_id", "seq", "place_id", F.coalesce(dep, arr).alias("time"), F.when(dep >= arr, dep - arr).alias("dwell"))


def assembled(call: DataFrame, keys: list[str]) -> DataFrame:
    """keys, places, times, dwell: calls in order of sequence, place and time, a missing time first."""
    ordered = F.array_sort(F.collect_list(F.struct("seq", "place_id", "time")))
    out = call.repartition(*keys).groupBy(*keys).agg(ordered.alias("c"), F.sum("dwell").cast("int").alias("dwell"))
    return out.select(*keys, F.transform("c", lambda c: c["place_id"]).alias("places"), F.transform("c", lambda c: c["time"]).alias("times"), "dwell")


def publication_trips(rows: DataFrame, place_of_stop: DataFrame, lines: DataFrame) -> DataFrame:
    """uid, trip_id, service_id, line, direction_id, places, times, dwell of every trip with a call, worked out once a publication."""
    trips = table(rows, "trips.txt", "trip_id", "route_id", "service_id", "direction_id").where("trip_id <> ''").groupBy("uid", "trip_id").agg(F.max_by(F.struct("route_id", "service_id", "direction_id"), "row_no").alias("t"))
    routes = lines.select("uid", "line", F.explode("route_ids").alias("route_id"))
    named = trips.select("uid", "trip_id", "t.*").join(routes, ["uid", "route_id"])
    return assembled(calls(rows, place_of_stop), ["uid", "trip_id"]).join(named, ["uid", "trip_id"])


def pair_trips(pairs: DataFrame, trips: DataFrame, place_map: DataFrame, groups: DataFrame) -> DataFrame:
    """Trips of both sides of every pair, told in the new side's places and report lines.

    An old place that became nothing is `old:` and its id. groups: pair_id, side, line, group_key.
    """
    new = pairs.select("pair_id", F.col("new_uid").alias("uid")).join(trips, "uid").withColumn("side", F.lit("new"))
    old = pairs.select("pair_id", F.col("old_uid").alias("uid")).join(trips, "uid")
    at = old.select("pair_id", "trip_id", F.posexplode("places").alias("i", "old_id")).join(place_map.select("pair_id", "old_id", "new_id"), ["pair_id", "old_id"], "left")
    told = at.groupBy("pair_id", "trip_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", F.coalesce("new_id", F.concat(F.lit("old:"), "old_id")).alias("p")))), lambda x: x["p"]).alias("places"))
    old = old.drop("places").join(told, ["pair_id", "trip_id"]).withColumn("side", F.lit("old"))
    both = new.unionByName(old).join(groups, ["pair_id", "side", "line"])
    return both.select("pair_id", "side", "trip_id", "service_id", "group_key", "line", s.direction_key(F.col("direction_id"), F.col("places")).alias("direction"), "places", "times", "dwell", s.first_departure(F.col("times")).alias("departure"))


def aligned(trips: DataFrame) -> DataFrame:
    """trips with old directions that the new side doesn't use taken from the new trips with the same ends.

    Only where a side lacks direction_id. First the one direction of trips with both ends, else the first place, else the
    last; a probe that finds several ends the search.
    """
    given = lambda c: c.isin("0", "1")
    first, last = F.element_at("places", 1), F.element_at("places", -1)
    new = trips.where("side = 'new'").select("pair_id", "group_key", "direction", first.alias("a"), last.alias("b"))
    used = new.groupBy("pair_id", "group_key").agg(F.collect_set("direction").alias("used"), F.bool_and(given(F.col("direction"))).alias("all_given"))
    probe = lambda *c: new.groupBy("pair_id", "group_key", *c).agg(F.count_distinct("direction").alias("n"), F.min("direction").alias("d"))
    old = trips.where("side = 'old'").withColumn("a", first).withColumn("b", last).join(used, ["pair_id", "group_key"], "left")
    for i, on in enumerate((("a", "b"), ("a",), ("b",))):
        old = old.join(probe(*on).withColumnRenamed("n", f"n{i}").withColumnRenamed("d", f"d{i}"), ["pair_id", "group_key", *on], "left")
    hit = F.when(F.col("n0").isNotNull(), F.when(F.col("n0") == 1, F.col("d0"))).when(F.col("n1").isNotNull(), F.when(F.col("n1") == 1, F.col("d1"))).when(F.col("n2") == 1, F.col("d2"))
    keep = F.col("used").isNull() | F.array_contains("used", F.col("direction")) | (given(F.col("direction")) & F.col("all_given"))
    out = old.withColumn("direction", F.when(keep, F.col("direction")).otherwise(F.coalesce(hit, "direction")))
    return trips.where("side = 'new'").unionByName(out.select(*trips.columns))


def on_typical_days(trips: DataFrame, comparison: DataFrame) -> DataFrame:
    """trips with a row for each compared day type on whose typical day they run."""
    each = comparison.select("pair_id", "day_type", F.explode(F.array(F.struct(F.lit("old").alias("side"), F.col("old_services").alias("v")), F.struct(F.lit("new").alias("side"), F.col("new_services").alias("v")))).alias("x"))
    runs = each.select("pair_id", "day_type", "x.side", F.explode("x.v").alias("service_id"))
    return trips.join(runs, ["pair_id", "side", "service_id"])


COMBO = ["pair_id", "group_key", "direction", "day_type"]


def _place_in_line() -> F.Column:
    """What puts the trips of a line in order."""
    return F.struct("line", "direction", F.coalesce("departure", F.lit(LATE)).alias("d"), "trip_id")


def _sided(day_trips: DataFrame, keys: list[str], side: str) -> DataFrame:
    run = {"trip": F.col("trip_id"), "places": F.col("places"), "times": F.col("times"), "dep": F.coalesce("departure", F.lit(0)), "nth": _place_in_line()}
    return day_trips.where(F.col("side") == side).select(*keys, *[c.alias(f"{side}_{n}") for n, c in run.items()])


def _without(rows: DataFrame, taken: DataFrame, keys: list[str], side: str) -> DataFrame:
    return rows.join(taken.select(*keys, f"{side}_trip"), [*keys, f"{side}_trip"], "left_anti")


def _visits(places: str, times: str) -> F.Column:
    """(place, time) of the timed calls."""
    return F.filter(F.transform(F.arrays_zip(places, times), lambda x: F.struct(x[places].alias("p"), x[times].alias("t"))), lambda x: x["t"].isNotNull())


def _first_visits(places: str, times: str) -> F.Column:
    visits = _visits(places, times)
    names = F.array_distinct(F.transform(visits, lambda x: x["p"]))
    return F.map_from_arrays(names, F.transform(names, lambda n: F.element_at(F.filter(visits, lambda x: x["p"] == n), 1)["t"]))


def _visiting(trips: DataFrame, side: str) -> DataFrame:
    """trips with {side}_visits: an old trip's timed calls, each once with its number, or a new trip's first visits by place."""
    if f"{side}_visits" in trips.columns:
        return trips
    if side == "new":
        return trips.withColumn("new_visits", _first_visits("new_places", "new_times"))
    every = _visits("old_places", "old_times")
    number = lambda x: F.size(F.filter(every, lambda y: y == x))
    return trips.withColumn("old_visits", F.transform(F.array_distinct(every), lambda x: F.struct(x["p"].alias("p"), x["t"].alias("t"), number(x).alias("n"))))


def _delays() -> F.Column:
    """Minutes between each timed call of the old trip and the new trip's first visit of its place."""
    each = F.transform("old_visits", lambda x: F.array_repeat(F.abs(x["t"] - F.try_element_at("new_visits", x["p"])), x["n"]))
    return F.filter(F.flatten(each), lambda d: d.isNotNull())


def _kind() -> F.Column:
    """What became of a trip, by its pattern, its times and whether a call it keeps has another time."""
    rerouted = F.col("old_pattern") != F.col("new_pattern")
    retimed = F.when(rerouted, F.col("late")).otherwise(F.col("old_run") != F.col("new_run"))
    words = F.concat_ws("_", F.when(retimed, "retimed"), F.when(rerouted, "rerouted"))
    return F.when(words == "", "exact").otherwise(words)


def _near(old: DataFrame, new: DataFrame, keys: list[str], within: float) -> DataFrame:
    """Pairs of trips whose median delay is at most `within` minutes, with delays and shift (that median).

    At least one shared place is then called at that closely, so trips meet by place and by spans of `within` minutes: a
    trip costs the trips around it, not all of its line.
    """
    old, new = _visiting(old, "old"), _visiting(new, "new")
    span = lambda c: F.floor(F.col(c) / within)
    a = old.select(*keys, "old_trip", F.explode("old_visits").alias("v")).select(*keys, "old_trip", F.col("v.p").alias("p"), F.col("v.t").alias("a")).withColumn("span", span("a"))
    b = new.select(*keys, "new_trip", F.explode("new_visits").alias("p", "b")).withColumn("span", F.explode(F.array(span("b") - 1, span("b"), span("b") + 1)))
    met = a.join(b, [*keys, "p", "span"]).where(F.abs(F.col("a") - F.col("b")) <= within).select(*keys, "old_trip", "new_trip").distinct()
    both = met.join(old, [*keys, "old_trip"]).join(new, [*keys, "new_trip"]).withColumn("delays", _delays())
    ordered, n = F.array_sort("delays"), F.size("delays")
    middle = (F.get(ordered, F.floor((n - 1) / 2).cast("int")) + F.get(ordered, F.floor(n / 2).cast("int"))) / 2.0
    return both.withColumn("shift", middle).where(F.col("shift") <= within)


def _classes(trips: DataFrame, keys: list[str], side: str) -> DataFrame:
    """keys, id, members (sorted) of the trips of a side that have equal places and times, with those and the departure."""
    run = [f"{side}_{c}" for c in ("places", "times", "dep")]
    return cut(trips.groupBy(*keys, *run).agg(F.array_sort(F.collect_set(f"{side}_trip")).alias("members")).withColumn("id", F.monotonically_increasing_id()))


def _numbered(classes: dict[str, DataFrame], what: str, name: str) -> tuple[DataFrame, dict[str, DataFrame]]:
    """(what, name: each list of the classes of both sides and its number; the classes with that number)."""
    lists = [x.select(F.col(f"{side}_{what}").alias(what)) for side, x in classes.items()]
    known = cut(lists[0].unionByName(lists[1]).distinct().withColumn(name, F.monotonically_increasing_id()))
    return known, {side: x.join(known.select(F.col(what).alias(f"{side}_{what}"), F.col(name).alias(f"{side}_{name}")), f"{side}_{what}") for side, x in classes.items()}


def _slim(classes: DataFrame, side: str) -> DataFrame:
    """classes with what pairs need of them instead of their lists."""
    ends = {f"{side}_first": F.element_at(f"{side}_places", 1), f"{side}_last": F.element_at(f"{side}_places", -1)}
    return cut(_visiting(classes, side).withColumns(ends).drop(f"{side}_places", f"{side}_times"))


def _met(classes: dict[str, DataFrame], keys: list[str], within: float) -> DataFrame:
    """keys, meetings, calls: how many times the classes of a group meet at a place within `within` minutes or a little more."""
    span = F.floor(F.col("t") / within).alias("span")
    visits = {side: x.select(*keys, F.explode(F.arrays_zip(F.col(f"{side}_places").alias("p"), F.col(f"{side}_times").alias("t"))).alias("v")).select(*keys, "v.p", "v.t").where("t is not null") for side, x in classes.items()}
    a, b = (x.groupBy(*keys, "p", span).agg(F.count("*").alias(n)) for n, x in zip("ab", (visits["old"], visits["new"]), strict=True))
    b = b.withColumn("span", F.explode(F.array(F.col("span") - 1, F.col("span"), F.col("span") + 1)))
    calls = [x.groupBy(*keys).agg(F.sum(F.size(f"{side}_places") + F.size("members")).alias(side)) for side, x in classes.items()]
    met = a.join(b, [*keys, "p", "span"]).groupBy(*keys).agg(F.sum(F.col("a").cast("double") * F.col("b")).alias("meetings"))
    return met.join(calls[0], keys).join(calls[1], keys).select(*keys, "meetings", (F.col("old") + F.col("new")).alias("calls"))


def _meetings(old: DataFrame, new: DataFrame, keys: list[str], within: float) -> int:
    """How many times classes meet at a place within `within` minutes or a little more."""
    span = lambda c: F.floor(F.col(c) / within)
    a = old.select(*keys, F.explode("old_visits").alias("v")).groupBy(*keys, F.col("v.p").alias("p"), span("v.t").alias("span")).agg(F.count("*").alias("a"))
    b = new.select(*keys, F.explode("new_visits").alias("p", "t")).withColumn("span", F.explode(F.array(span("t") - 1, span("t"), span("t") + 1))).groupBy(*keys, "p", "span").agg(F.count("*").alias("b"))
    return a.join(b, [*keys, "p", "span"]).agg(F.sum(F.col("a").cast("double") * F.col("b"))).first()[0] or 0


#: Meetings of classes that one step may compare.
MEETINGS = 20_000_000
#: Meetings up to which tables of their pairs are small; and calls and members of a group that one task may hold.
FEW, HELD = 100_000, 2_000_000
#: What the share of a comparison is relative to: the shorter pattern or the longer one.
SHORTER = {sequence_containment: True, sequence_similarity: False}


def _alone(classes: dict[str, DataFrame], groups: DataFrame, keys: list[str], measure, least: float, within: int, most: float | None, ends: bool) -> DataFrame:
    """keys, old_trip, new_trip, kind that one-to-one assignment takes in groups of which each fits a task."""
    sides = (x.join(groups, keys, "left_semi").select(*keys, F.lit(side).alias("side"), "members", *[F.col(f"{side}_{c}").alias(c) for c in ("places", "times", "dep")], F.size(f"{side}_places").alias("calls")) for side, x in classes.items())
    both = next(sides).unionByName(next(sides))
    schema = T.StructType([*(both.schema[k] for k in keys), *(T.StructField(c, T.StringType()) for c in ("old_trip", "new_trip", "kind"))])
    return both.groupBy(*keys).applyInArrow(assigned(keys, SHORTER[measure], least, within, most, ends), schema)


def _assigned(old: DataFrame, new: DataFrame, keys: list[str], measure, least: float, within: int, most: float | None, ends: bool = False) -> DataFrame:
    """The pairs that one-to-one assignment takes by cost; `measure` compares each pair of patterns once.

    Trips with equal places and times are one class, and classes meet, not trips; pairs carry the numbers of their lists. Where
    many meet, groups that fit a task are assigned in one each. In larger groups, pairs of small
    cost are found and assigned first, among trips that are closer to each other; what stays free then meets in wider spans.
    No pair costs less than its shift alone, so none that comes earlier is missed. ends: pairs share their first or last place.
    """
    classes = {"old": _classes(old, keys, "old"), "new": _classes(new, keys, "new")}
    met, parts, done = cut(_met(classes, keys, within)), [], 0.0
    if (met.agg(F.sum("meetings")).first()[0] or 0) > min(FEW, MEETINGS):
        fits = (F.col("meetings") <= MEETINGS) & (F.col("calls") <= HELD)
        parts.append(_alone(classes, met.where(fits), keys, measure, least, within, most, ends))
        if met.where(~fits).isEmpty():
            return cut(parts[0])
        classes = {side: x.join(met.where(~fits), keys, "left_semi") for side, x in classes.items()}
    patterns, classes = _numbered(classes, "places", "pattern")
    olds, news = (_slim(x, side) for side, x in _numbered(classes, "times", "run")[1].items())
    end = lambda at: F.col(f"old_{at}") == F.col(f"new_{at}")
    while done < within:
        span = float(within)
        while span >= max(2.0, 4 * done) and _meetings(olds, news, keys, span) > MEETINGS:
            span /= 2
        near = _near(olds.withColumnRenamed("id", "old_trip").drop("members"), news.withColumnRenamed("id", "new_trip").drop("members"), keys, span)
        near = near.where(end("first") | end("last")) if ends else near
        near = cut(near.select(*keys, "old_trip", "new_trip", "old_pattern", "new_pattern", "old_run", "new_run", "old_dep", "new_dep", "shift", F.exists("delays", lambda d: d > 0).alias("late")))
        named = lambda side: patterns.select(F.col("places").alias(f"{side}_places"), F.col("pattern").alias(f"{side}_pattern"))
        compared = near.select("old_pattern", "new_pattern").distinct().join(named("old"), "old_pattern").join(named("new"), "new_pattern")
        shares = compared.select("old_pattern", "new_pattern", measure("old_places", "new_places").alias("share")).where(F.col("share") >= least)
        cost = F.round(F.col("shift") / within + (1 - F.col("share")), 6)
        costed = near.join(shares, ["old_pattern", "new_pattern"]).withColumn("cost", cost)
        costed = costed if most is None else costed.where(F.col("cost") <= most)
        costed = costed if span == within else costed.where(F.col("cost") < span / within - 1e-6)
        edges = costed.select(*keys, F.col("old_trip").alias("old"), F.col("new_trip").alias("new"), "cost", "old_dep", "new_dep", _kind().alias("kind"))
        won = cut(greedy_classes(edges, olds, news, keys, ["cost", "old_dep", "new_dep"]))
        member = lambda c, at: F.get(f"{c}_members", (F.col(at) + F.col("i")).cast("int")).alias(f"{c}_trip")
        whole = won.join(olds.select(*keys, F.col("id").alias("old"), F.col("members").alias("old_members")), "old").join(news.select(F.col("id").alias("new"), F.col("members").alias("new_members")), "new")
        each = whole.withColumn("i", F.explode(F.sequence(F.lit(0).cast("long"), F.col("m") - 1)))
        parts.append(cut(each.select(*keys, member("old", "uo"), member("new", "un"), "kind")))
        done = span
        if done < within:
            olds, news = (cut(_free(x, won, c)) for x, c in ((olds, "old"), (news, "new")))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _free(classes: DataFrame, won: DataFrame, side: str) -> DataFrame:
    """classes without the members that were taken."""
    used = won.groupBy(F.col(side).alias("id")).agg(F.sum("m").cast("int").alias("used"))
    left = classes.join(used, "id", "left").withColumn("used", F.coalesce("used", F.lit(0))).where(F.size("members") > F.col("used"))
    return left.withColumn("members", F.slice("members", F.col("used") + 1, F.size("members"))).select(*classes.columns)


def _with_partners(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Trips of both sides (side, trip, places, times, dep, nth) with `partner`, the one of the other side that equals it.

    Equal are places and times. Trips that kept their id pair first, then the others in order, place by place. One exchange
    by keys, places and times brings together all that this needs; what holds a null there has no partner.
    """
    sides = (x.select(*keys, F.lit(p).alias("side"), *[F.col(f"{p}_{c}").alias(c) for c in ("trip", "places", "times", "dep", "nth")]) for x, p in ((old, "old"), (new, "new")))
    run = ["hash", *keys, "places", "times"]  # a number comes first, so that rows sort by it before their lists
    both = next(sides).unionByName(next(sides)).withColumn("hash", F.xxhash64(*run[1:])).repartition("hash").withColumn("whole", F.expr(" and ".join(f"`{c}` is not null" for c in [*run, "trip"])))
    kept = W.partitionBy(*run, "trip")
    both = both.withColumn("kept", F.when(F.min("side").over(kept) != F.max("side").over(kept), F.col("trip")))
    both = both.withColumn("n", F.when(F.col("kept").isNull(), F.row_number().over(W.partitionBy(*run, "kept", "side").orderBy("nth"))))
    of = lambda side: F.max(F.when(F.col("side") == side, F.col("trip"))).over(W.partitionBy(*run, "kept", "n"))
    partner = F.when(F.col("whole"), F.when(F.col("side") == "old", of("new")).otherwise(of("old")))
    return both.select(*keys, "side", "trip", "places", "times", "dep", "nth", partner.alias("partner"))


def _pairs_of(paired: DataFrame, keys: list[str]) -> DataFrame:
    return paired.where("side = 'old' and partner is not null").select(*keys, F.col("trip").alias("old_trip"), F.col("partner").alias("new_trip"), F.lit("exact").alias("kind"))


def _left_over(paired: DataFrame, keys: list[str], side: str) -> DataFrame:
    return paired.where((F.col("side") == side) & F.col("partner").isNull()).select(*keys, *[F.col(c).alias(f"{side}_{c}") for c in ("trip", "places", "times", "dep", "nth")])


def _equal_runs(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Trips with equal places and times: those that kept their id first, then the others in order, place by place."""
    return _pairs_of(_with_partners(old, new, keys), keys)


def equal_trips(day_trips: DataFrame) -> DataFrame:
    """pair_id, group_key, direction, day_type, old_trip, new_trip, kind of the trips that run on as they were."""
    return _equal_runs(*(_sided(day_trips, COMBO, p) for p in ("old", "new")), COMBO)


def match_trips(day_trips: DataFrame, cfg: Matching | None = None) -> DataFrame:
    """pair_id, group_key, direction, day_type, old_trip, new_trip, kind of every trip on a typical day.

    Equal trips pair first; the others pair by the cost of their shift and of the places they don't share, least first.
    """
    cfg = cfg or Matching()
    old, new = (_sided(day_trips, COMBO, p) for p in ("old", "new"))
    paired = cut(_with_partners(old, new, COMBO))
    equal = _pairs_of(paired, COMBO)
    left_old, left_new = (_left_over(paired, COMBO, p) for p in ("old", "new"))
    costed = _assigned(left_old, left_new, COMBO, sequence_similarity, cfg.pattern_min_similarity, cfg.trip_max_shift_min, cfg.trip_max_cost)
    none, names = F.lit(None).cast("string"), [*COMBO, "old_trip", "new_trip", "kind"]
    gone = _without(left_old, costed, COMBO, "old").select(*COMBO, "old_trip", none.alias("new_trip"), F.lit("removed").alias("kind"))
    come = _without(left_new, costed, COMBO, "new").select(*COMBO, none.alias("old_trip"), "new_trip", F.lit("added").alias("kind"))
    return equal.unionByName(costed).unionByName(gone).unionByName(come).select(*names)


def match_moved_trips(day_trips: DataFrame, matched: DataFrame, cfg: Matching | None = None) -> DataFrame:
    """pair_id, day_type, old_trip, new_trip, kind of trips left over in their lines that run on in another.

    One end is shared, the shorter trip's places stand in the longer one's and both run at about the same time.
    """
    cfg, keys = cfg or Matching(), ["pair_id", "day_type"]
    left = matched.where("kind in ('removed', 'added')").select(*keys, F.when(F.col("kind") == "removed", "old").otherwise("new").alias("side"), F.coalesce("old_trip", "new_trip").alias("trip_id"))
    rest = cut(day_trips.join(left, [*keys, "side", "trip_id"]))
    return _assigned(_sided(rest, keys, "old"), _sided(rest, keys, "new"), keys, sequence_containment, cfg.cross_line_min_containment, cfg.cross_line_max_shift_min, None, ends=True)


def timetable_order(matched: DataFrame, day_trips: DataFrame) -> DataFrame:
    """matched with `place`, the order of a timetable that shows both sides: by the earlier departure of either."""
    at = lambda p: _sided(day_trips.withColumn("departure", F.coalesce("departure", F.lit(LATE))), COMBO, p).select(*COMBO, f"{p}_trip", f"{p}_dep", f"{p}_nth")
    both = matched.join(at("old"), [*COMBO, "old_trip"], "left").join(at("new"), [*COMBO, "new_trip"], "left")
    order = W.partitionBy(*COMBO).orderBy(F.coalesce(F.least("old_dep", "new_dep"), F.lit(LATE)), F.asc_nulls_first("old_nth"), F.asc_nulls_first("new_nth"))
    return both.withColumn("place", F.row_number().over(order)).select(*matched.columns, "place")


def timetables(day_trips: DataFrame) -> DataFrame:
    """One timetable for each side of a combo: rows of places, and each trip's times by row.

    Patterns go into the rows one after the other, the most frequent first, then the longest. Only patterns reach Python.
    """
    keys = [*COMBO, "side"]
    counts = day_trips.groupBy(*keys, "places").agg(F.count("*").alias("n"))
    ranked = counts.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("n"), (-F.size("places")).alias("size"), "places"))).alias("x"))
    patterns = ranked.select(*keys, F.transform("x", lambda x: x["places"]).alias("patterns"))
    merged = patterns.withColumn("m", merged_patterns("patterns")).select(*keys, F.col("m.places").alias("rows"), F.explode(F.arrays_zip("patterns", "m.stands")).alias("z"))
    merged = merged.select(*keys, "rows", F.col("z.patterns").alias("places"), F.col("z.stands").alias("stands"))
    shown = F.transform("times", lambda t: F.when(t.between(0, 2880), t))
    times = F.transform(F.sequence(F.lit(0), F.size("rows") - 1), lambda r: F.when(F.array_contains("stands", r), F.element_at(shown, F.array_position("stands", r).cast("int"))))
    each = day_trips.join(merged, [*keys, "places"]).select(*keys, "rows", _place_in_line().alias("nth"), "trip_id", times.alias("times"))
    inner = F.transform(F.array_sort(F.collect_list(F.struct("nth", "trip_id", "times"))), lambda x: F.struct(x["trip_id"].alias("trip_id"), x["times"].alias("times")))
    return each.groupBy(*keys, F.col("rows").alias("places")).agg(inner.alias("trips"))


def dominant_patterns(trips: DataFrame, keys: list[str]) -> DataFrame:
    """keys, places: the sequence most trips run; ties go to the longest, then to the one that is last read backwards."""
    counts = trips.groupBy(*keys, "places").count()
    return counts.groupBy(*keys).agg(F.max_by("places", F.struct("count", F.size("places"), F.reverse("places"))).alias("places"))


def trip_edits(matched: DataFrame, day_trips: DataFrame) -> DataFrame:
    """pair_id, group_key, direction, kind, places, trips: the edits that paired trips show, and how many show each.

    Each pair of patterns is compared once. Trips of equal places show none, so they are left out by their kind and only
    the trips of the others bring their places.
    """
    rerouted = cut(matched.where("old_trip is not null and new_trip is not null and kind not in ('exact', 'retimed')"))

    def side(p: str) -> DataFrame:
        keys = ["pair_id", "day_type", f"{p}_trip"]
        named = day_trips.where(F.col("side") == p).select("pair_id", "day_type", F.col("trip_id").alias(f"{p}_trip"), F.col("places").alias(f"{p}_places"))
        return named.join(rerouted.select(*keys).distinct(), keys, "left_semi").dropDuplicates(keys)

    both = rerouted.join(side("old"), ["pair_id", "day_type", "old_trip"]).join(side("new"), ["pair_id", "day_type", "new_trip"]).where("old_places <> new_places")
    counts = both.groupBy("pair_id", "group_key", "direction", "old_places", "new_places").agg(F.count("*").alias("n"))
    each = counts.select("pair_id", "group_key", "direction", "n", F.explode(pattern_edits("old_places", "new_places")).alias("e"))
    return each.groupBy("pair_id", "group_key", "direction", F.col("e.kind").alias("kind"), F.col("e.places").alias("places")).agg(F.sum("n").alias("trips"))


def shift_edits(edits: DataFrame) -> DataFrame:
    """edits with places that some trips of a line direction gained and as many others lost as one shifted edit.

    Gains and losses of one set of places, in opposite kinds, cancel: each side gives up as many trips as the other has, in
    order of kind and places, and the places of the gains name the shift.
    """
    keys = ["pair_id", "group_key", "direction"]
    opposite = F.create_map(*[F.lit(x) for take, bring in zip(TAKES, BRINGS, strict=True) for x in (bring, take)])
    gain = F.col("kind").isin(*BRINGS)
    facing = edits.withColumn("gain", gain).withColumn("base", F.when(gain | F.col("kind").isin(*TAKES), F.coalesce(F.try_element_at(opposite, F.col("kind")), F.col("kind"))))
    facing = facing.withColumn("same", F.array_sort(F.array_distinct("places")))
    group = [*keys, "base", "same"]
    other = F.sum(F.when(F.col("base").isNotNull(), F.col("trips"))).over(W.partitionBy(*group)) - F.sum("trips").over(W.partitionBy(*group, "gain"))
    before = F.coalesce(F.sum("trips").over(W.partitionBy(*group, "gain").orderBy("kind", "places").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    gone = F.when(F.col("base").isNull(), 0).otherwise(F.least(F.col("trips"), F.greatest(F.lit(0), F.coalesce(other, F.lit(0)) - before)))
    told = facing.withColumn("gone", gone)
    left = told.where("trips > gone").select(*keys, "kind", "places", (F.col("trips") - F.col("gone")).alias("trips"))
    moved = told.where("gain and gone > 0").groupBy(*keys, "places").agg(F.sum("gone").alias("trips"))
    return left.unionByName(moved.select(*keys, F.lit("shifted").alias("kind"), "places", "trips"))


def hour_bands(day_trips: DataFrame) -> DataFrame:
    """Trips of each combo by hour of departure and side."""
    return day_trips.where("departure is not null").groupBy("pair_id", "group_key", "direction", "day_type", s.hour_band(F.col("departure")).alias("band")).agg(F.count_if(F.col("side") == "old").alias("before"), F.count_if(F.col("side") == "new").alias("after"))


def first_last(day_trips: DataFrame, least: int) -> DataFrame:
    """First and last departures of each combo, and whether either moved by at least `least` minutes."""
    side = lambda f, p: f(F.when(F.col("side") == p, F.col("departure")))
    out = day_trips.groupBy("pair_id", "group_key", "direction", "day_type").agg(*[side(f, p).alias(f"{p}_{n}") for n, f in (("first", F.min), ("last", F.max)) for p in ("old", "new")])
    moved_ = F.coalesce(F.abs(F.col("old_first") - F.col("new_first")) >= least, F.lit(False)) | F.coalesce(F.abs(F.col("old_last") - F.col("new_last")) >= least, F.lit(False))
    return out.withColumn("changed", moved_)


def dwell_medians(day_trips: DataFrame) -> DataFrame:
    return day_trips.groupBy("pair_id", "group_key", "direction", "day_type").agg(*[F.median(F.when(F.col("side") == p, F.col("dwell"))).alias(f"{p}_dwell") for p in ("old", "new")])


def travel_times(day_trips: DataFrame) -> DataFrame:
    """Median minutes from first to last timed call of each combo and side."""
    timed = F.filter("times", lambda t: t.isNotNull())
    span = F.when(F.size(timed) > 1, F.element_at(timed, -1) - F.element_at(timed, 1))
    return day_trips.withColumn("span", span).groupBy("pair_id", "group_key", "direction", "day_type").agg(*[F.median(F.when(F.col("side") == p, F.col("span"))).alias(f"{p}_minutes") for p in ("old", "new")])


def trip_counts(day_trips: DataFrame) -> DataFrame:
    """Trips of each pair and day type before and after."""
    return day_trips.groupBy("pair_id", "day_type").agg(F.count_if(F.col("side") == "old").alias("before"), F.count_if(F.col("side") == "new").alias("after"))


def date_residuals(pairs: DataFrame, calendar: DataFrame, comparison: DataFrame, trips: DataFrame) -> DataFrame:
    """pair_id, residual, dates, before, after and the trips (group_key, places, times, n) by which dates that both sides cover
    change other than the typical day they follow.

    A date follows the typical day with the most services of those whose services it runs on both sides, else that of its
    day type. Each pair of service sets is worked out once.
    """
    side = lambda p: pairs.select("pair_id", F.col(f"{p}_uid").alias("uid")).join(calendar, "uid").select("pair_id", "date", F.col("services").alias(f"{p}_services"), F.col("category").alias(f"{p}_category"))
    shared = side("old").join(side("new"), ["pair_id", "date"])
    sets = shared.select("pair_id", "old_services", "new_services").distinct()
    typical = comparison.where("old_date is not null and new_date is not null").select("pair_id", "day_type", F.col("old_services").alias("to"), F.col("new_services").alias("tn"))
    wanted = sets.select("pair_id", "old_services", "new_services").unionByName(typical.select("pair_id", F.col("to").alias("old_services"), F.col("tn").alias("new_services"))).distinct()
    ids = wanted.withColumn("set_id", F.struct(F.col("old_services").alias("o"), F.col("new_services").alias("n")))
    each = ids.select("pair_id", "set_id", F.explode(F.concat(F.transform("old_services", lambda x: F.struct(F.lit("old").alias("side"), x.alias("service_id"))), F.transform("new_services", lambda x: F.struct(F.lit("new").alias("side"), x.alias("service_id"))))).alias("x")).select("pair_id", "set_id", "x.*")
    change = each.join(trips.select("pair_id", "side", "service_id", "group_key", "places", "times"), ["pair_id", "side", "service_id"]).groupBy("pair_id", "set_id", "group_key", "places", "times").agg(
        F.sum(F.when(F.col("side") == "new", 1).otherwise(-1)).alias("n"), F.count_if(F.col("side") == "old").alias("o"), F.count_if(F.col("side") == "new").alias("w")
    )
    sizes = change.groupBy("pair_id", "set_id").agg(F.sum("o").alias("before"), F.sum("w").alias("after"))
    fits = sets.join(typical, "pair_id").where((F.size(F.array_except("to", "old_services")) == 0) & (F.size(F.array_except("tn", "new_services")) == 0))
    best = fits.groupBy("pair_id", "old_services", "new_services").agg(F.max_by(F.struct("to", "tn"), F.struct(F.size("to") + F.size("tn"), "to", "tn")).alias("fit"))
    own = comparison.select("pair_id", F.explode(F.split("day_type", ",")).alias("new_category"), F.col("day_type"), F.struct(F.col("old_services").alias("to"), F.col("new_services").alias("tn")).alias("own"), (F.col("old_date").isNotNull() & F.col("new_date").isNotNull()).alias("has"))
    dated = shared.join(best, ["pair_id", "old_services", "new_services"], "left").join(own, ["pair_id", "new_category"], "left").withColumn("base", F.coalesce("fit", F.when(F.col("has"), F.col("own"))))
    sid = lambda a, b: F.struct(F.col(a).alias("o"), F.col(b).alias("n"))
    dated = dated.withColumn("set_id", sid("old_services", "new_services")).withColumn("base_id", sid("base.to", "base.tn")).withColumn("base_id", F.when(F.col("base").isNotNull(), F.col("base_id")))
    combos = dated.select("pair_id", "set_id", "base_id").distinct()
    item = ["group_key", "places", "times"]
    rest = combos.join(change, ["pair_id", "set_id"]).select("pair_id", "set_id", "base_id", *item, "n").unionByName(
        combos.join(change.withColumnRenamed("set_id", "base_id"), ["pair_id", "base_id"]).select("pair_id", "set_id", "base_id", *item, (-F.col("n")).alias("n"))
    )
    rest = rest.groupBy("pair_id", "set_id", "base_id", *item).agg(F.sum("n").alias("n")).where("n <> 0")
    residual = rest.groupBy("pair_id", "set_id", "base_id").agg(F.array_sort(F.collect_list(F.struct(*item, "n"))).alias("trips")).withColumn("residual", F.sha2(F.to_json("trips"), 256))
    hit = dated.join(residual, (dated["pair_id"] == residual["pair_id"]) & (dated["set_id"] == residual["set_id"]) & dated["base_id"].eqNullSafe(residual["base_id"])).drop(residual["pair_id"], residual["set_id"], residual["base_id"]).join(sizes, ["pair_id", "set_id"], "left")
    return hit.groupBy("pair_id", "residual").agg(F.array_sort(F.collect_list("date")).alias("dates"), F.array_sort(F.collect_set("day_type")).alias("day_types"), F.min_by("before", "date").alias("before"), F.min_by("after", "date").alias("after"), F.min_by("trips", "date").alias("trips"))


def changed_runs(residuals: DataFrame, within: int) -> DataFrame:
    """pair_id, residual, group_key, kind (changed, added, removed), old_time, new_time of each trip by which dates differ.

    residuals: pair_id, residual, trips (group_key, places, times, n). Trips that came and went in one line, with departures
    at most `within` minutes apart, pair nearest first as changed; the others are added or removed.
    """
    each = residuals.select("pair_id", "residual", F.posexplode("trips").alias("i", "x")).select("pair_id", "residual", "x.group_key", s.first_departure(F.col("x.times")).alias("dep"), F.col("x.n").alias("n"), "i")
    single = each.withColumn("k", F.explode(F.sequence(F.lit(1), F.abs("n").cast("int")))).withColumn("id", F.struct("i", "k"))
    keys = ["pair_id", "residual", "group_key"]
    gone = single.where("n < 0").select(*keys, F.col("id").alias("old_id"), F.col("dep").alias("old_time"))
    came = single.where("n > 0").select(*keys, F.col("id").alias("new_id"), F.col("dep").alias("new_time"))
    slot = lambda c: F.floor(F.col(c) / within)
    spread = came.withColumn("slot", F.explode(F.array(slot("new_time") - 1, slot("new_time"), slot("new_time") + 1)))
    near = gone.withColumn("slot", slot("old_time")).join(spread, [*keys, "slot"]).withColumn("apart", F.abs(F.col("old_time") - F.col("new_time"))).where(F.col("apart") <= within).drop("slot")
    paired = cut(greedy(near, keys, ["old_id"], ["new_id"], ["apart", "old_time", "new_time", "old_id", "new_id"]))
    none = F.lit(None).cast("int")
    left = lambda x, c: x.join(paired.select(*keys, c), [*keys, c], "left_anti")
    out = paired.select(*keys, F.lit("changed").alias("kind"), F.col("old_time").cast("int").alias("old_time"), F.col("new_time").cast("int").alias("new_time"))
    out = out.unionByName(left(gone, "old_id").select(*keys, F.lit("removed").alias("kind"), F.col("old_time").cast("int").alias("old_time"), none.alias("new_time")))
    return out.unionByName(left(came, "new_id").select(*keys, F.lit("added").alias("kind"), none.alias("old_time"), F.col("new_time").cast("int").alias("new_time")))


def date_change_list(runs: DataFrame, groups_most: int, trips_most: int) -> DataFrame:
    """The first trips of each kind of the first date changes of a pair, by line and time, with the full counts.

    runs: as of changed_runs(). `groups` counts all changes of the pair and `trips` all trips of the kind.
    """
    kind = ["pair_id", "residual", "kind"]
    at = F.coalesce("new_time", "old_time")
    listed = runs.withColumn("trips", F.count("*").over(W.partitionBy(*kind))).withColumn("place", F.row_number().over(W.partitionBy(*kind).orderBy("group_key", at, "old_time")))
    groups = runs.select("pair_id", "residual").distinct()
    ranked = groups.withColumn("nth", F.row_number().over(W.partitionBy("pair_id").orderBy("residual"))).withColumn("groups", F.count("*").over(W.partitionBy("pair_id")))
    return listed.where(F.col("place") <= trips_most).join(ranked.where(F.col("nth") <= groups_most), ["pair_id", "residual"]).drop("nth")
