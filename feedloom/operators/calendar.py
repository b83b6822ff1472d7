"""Service days, day types, periods and the days on which two publications are compared."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from feedloom.functions import scalar as s
from feedloom.operators.graph import cut
from feedloom.plans.config import CATEGORIES, WEEKDAYS, Config
from feedloom.sources.gtfs_zip import table

def nothing() -> F.Column:
    return F.array().cast("array<string>")



def active_dates(rows: DataFrame) -> DataFrame:
    """uid, service_id, date of every day a service runs: weekday flags, then exceptions in the order of their file.

    The last exception of a service and date counts. Where a publication has trips, services without any don't.
    """
    cal = table(rows, "calendar.txt", "service_id", "start_date", "end_date", *WEEKDAYS).where("service_id <> ''")
    cal = cal.withColumn("a", s.ymd(F.col("start_date"))).withColumn("b", s.ymd(F.col("end_date"))).where("a <= b")
    flags = F.array(*[F.trim(c) == "1" for c in WEEKDAYS])
    base = cal.withColumn("flags", flags).select("uid", "service_id", "flags", F.explode(F.sequence("a", "b")).alias("date")).where(F.element_at("flags", F.weekday("date") + 1)).select("uid", "service_id", "date").distinct()
    exc = table(rows, "calendar_dates.txt", "service_id", "date", "exception_type").withColumn("date", s.ymd(F.col("date"))).withColumn("t", F.trim("exception_type")).where("service_id <> '' and date is not null and t in ('1', '2')")
    last = exc.groupBy("uid", "service_id", "date").agg(F.max_by("t", "row_no").alias("t"))
    days = base.join(last.where("t = '2'"), ["uid", "service_id", "date"], "left_anti").unionByName(last.where("t = '1'").drop("t")).distinct()
    trips = table(rows, "trips.txt", "service_id")
    used = trips.where("service_id <> ''").select("uid", "service_id").distinct()
    any_trip = trips.select("uid").distinct()
    return days.join(used, ["uid", "service_id"], "left_semi").unionByName(days.join(any_trip, "uid", "left_anti"))


def windows(rows: DataFrame, active: DataFrame, validity: DataFrame | None, first_year: int, last_year: int) -> DataFrame:
    """uid, start, end, clipped: the dates of feed_info, else of the catalogue, else of the services, within the holiday table."""
    info = table(rows, "feed_info.txt", "feed_start_date", "feed_end_date").where("row_no = 0").select("uid", s.ymd(F.col("feed_start_date")).alias("fa"), s.ymd(F.col("feed_end_date")).alias("fb"))
    own = active.groupBy("uid").agg(F.min("date").alias("sa"), F.max("date").alias("sb"))
    uids = rows.select("uid").distinct()
    if validity is None:
        validity = uids.limit(0).select("uid", F.lit(None).cast("date").alias("va"), F.lit(None).cast("date").alias("vb"))
    each = uids.join(info, "uid", "left").join(validity, "uid", "left").join(own, "uid", "left")
    pick = F.when(F.col("fa") <= F.col("fb"), F.struct(F.col("fa").alias("a"), F.col("fb").alias("b"))).when(F.col("va") <= F.col("vb"), F.struct(F.col("va").alias("a"), F.col("vb").alias("b"))).when(F.col("sa").isNotNull(), F.struct(F.col("sa").alias("a"), F.col("sb").alias("b")))
    low, high = F.make_date(F.lit(first_year), F.lit(1), F.lit(1)), F.make_date(F.lit(last_year), F.lit(12), F.lit(31))
    w = each.select("uid", pick.alias("w")).where("w is not null")
    return w.select("uid", F.greatest("w.a", low).alias("start"), F.least("w.b", high).alias("end"), ((F.col("w.a") < low) | (F.col("w.b") > high)).alias("clipped")).where("start <= end")


def service_days(active: DataFrame, window: DataFrame, holidays: DataFrame) -> DataFrame:
    """uid, date, category, services (sorted, maybe none) of every date of each window."""
    spine = window.select("uid", F.explode(F.sequence("start", "end")).alias("date"))
    hol = holidays.select("date", F.lit(True).alias("hol"))
    by_date = active.groupBy("uid", "date").agg(F.array_sort(F.collect_set("service_id")).alias("services"))
    return spine.join(by_date, ["uid", "date"], "left").join(hol, "date", "left").select("uid", "date", s.category(F.col("date"), F.col("hol")).alias("category"), F.coalesce("services", nothing()).alias("services"))


def service_content(rows: DataFrame) -> DataFrame:
    """uid, service_id, content: its sorted trips as route, first and last stop with their times and number of calls."""
    trips = table(rows, "trips.txt", "trip_id", "service_id", "route_id").groupBy("uid", "trip_id").agg(F.max_by(F.struct("service_id", "route_id"), "row_no").alias("t"))
    calls = table(rows, "stop_times.txt", "trip_id", "stop_sequence", "stop_id", "arrival_time", "departure_time").withColumn("seq", F.trim("stop_sequence").try_cast("int")).where("seq is not null")
    time = F.when(F.col("departure_time") != "", F.col("departure_time")).otherwise(F.col("arrival_time"))
    at = F.struct("stop_id", time.alias("time"))
    ends = calls.groupBy("uid", "trip_id").agg(F.min_by(at, F.struct("seq", "row_no")).alias("first"), F.max_by(at, F.struct("seq", -F.col("row_no"))).alias("last"), F.count("*").alias("n"))
    item = F.to_json(F.struct("t.route_id", F.struct("first.stop_id", "first.time").alias("first"), F.struct("last.stop_id", "last.time").alias("last"), "n"))
    return trips.join(ends, ["uid", "trip_id"]).groupBy("uid", F.col("t.service_id").alias("service_id")).agg(F.array_sort(F.collect_list(item)).alias("content"))


def date_content(days: DataFrame, content: DataFrame) -> DataFrame:
    """days with the hash of what runs, whatever its services are called, and whether anything does.

    Each set of services is worked out once.
    """
    sets = days.select("uid", "services").distinct()
    each = sets.select("uid", "services", F.explode_outer("services").alias("service_id")).join(content, ["uid", "service_id"], "left")
    own = F.when(F.col("service_id").isNull(), nothing()).otherwise(F.coalesce("content", F.array(F.to_json(F.struct(F.col("service_id").alias("service"))))))
    hashed = each.groupBy("uid", "services").agg(F.sha2(F.to_json(F.array_sort(F.flatten(F.collect_list(own)))), 256).alias("content"))
    return days.join(hashed, ["uid", "services"]).withColumn("runs", F.size("services") > 0)


def isolated(days: DataFrame) -> DataFrame:
    """days with exception: what runs differs from both neighbouring dates of its category."""
    w = W.partitionBy("uid", "category").orderBy("date")
    before, after = F.lag("content").over(w), F.lead("content").over(w)
    return days.withColumn("exception", before.isNotNull() & after.isNotNull() & (before != F.col("content")) & (after != F.col("content")))


def agreements(days: DataFrame) -> DataFrame:
    """uid, a, b, total, same: each usable date against the nearest one, within a week, of every other category."""
    usable = days.where("not exception").select("uid", "date", "category", "content", "runs")
    other = usable.select("uid", F.col("date").alias("d2"), F.col("category").alias("c2"), F.col("content").alias("t2"), F.col("runs").alias("r2"))
    near = usable.withColumn("d2", F.explode(F.sequence(F.date_sub("date", 7), F.date_add("date", 7)))).join(other, ["uid", "d2"]).where("category <> c2")
    best = near.groupBy("uid", "date", "category", "content", "runs", "c2").agg(F.min_by(F.struct("t2", "r2"), F.struct(F.abs(F.datediff("d2", "date")), "d2")).alias("n"))
    informative = best.where(F.col("runs") | F.col("n.r2"))
    order = F.array(*[F.lit(c) for c in CATEGORIES])
    first = F.array_position(order, F.col("category")) < F.array_position(order, F.col("c2"))
    a, b = F.when(first, F.col("category")).otherwise(F.col("c2")), F.when(first, F.col("c2")).otherwise(F.col("category"))
    return informative.groupBy("uid", a.alias("a"), b.alias("b")).agg(F.count("*").alias("total"), F.count_if(F.col("content") == F.col("n.t2")).alias("same"))


def _category_roots(part: pd.DataFrame) -> pd.DataFrame:
    """The smallest member of each group of joined categories; a publication has eight at most."""
    root = {n: n for n in range(1, len(CATEGORIES) + 1)}
    for a, b in zip(part["a"], part["b"], strict=True):
        low, high = sorted((root[a], root[b]))
        root = {n: low if r == high else r for n, r in root.items()}
    return pd.DataFrame({"uid": part["uid"].iloc[0], "node": list(root), "root": list(root.values())})


def day_groups(days: DataFrame, least: float) -> DataFrame:
    """uid, category, day_type: categories that run the same trips in the same weeks are one type; idle ones are, too."""
    marked = cut(isolated(days))
    order = F.array(*[F.lit(c) for c in CATEGORIES])
    number = lambda c: F.array_position(order, F.col(c))
    joined = agreements(marked).where(F.col("same") / F.col("total") >= least).select("uid", number("a").alias("a"), number("b").alias("b"))
    usable = marked.where("not exception").groupBy("uid", "category").agg(F.bool_or("runs").alias("runs"))
    idle = usable.where("not runs").select("uid", number("category").alias("b"))
    first = idle.groupBy("uid").agg(F.min("b").alias("a"))
    edges = joined.unionByName(idle.join(first, "uid").where("a <> b").select("uid", "a", "b"))
    roots = edges.groupBy("uid").applyInPandas(_category_roots, "uid string, node int, root int")
    every = marked.select("uid", "category").distinct().withColumn("node", number("category"))
    rooted = every.join(roots, ["uid", "node"], "left").join(usable.select("uid", "category", F.lit(True).alias("usable")), ["uid", "category"], "left")
    key = F.when(F.col("usable"), F.coalesce("root", "node")).otherwise(F.col("node"))
    members = rooted.withColumn("root", key).groupBy("uid", "root").agg(F.collect_set("category").alias("m"))
    return rooted.withColumn("root", key).join(members, ["uid", "root"]).select("uid", "category", s.day_type_id(F.col("m")).alias("day_type"))


def special_days(typed: DataFrame, least: int) -> DataFrame:
    """typed (uid, date, day_type, services) with special: a set rarer than `least` in a type that has a regular one."""
    counts = typed.groupBy("uid", "day_type", "services").count()
    most = counts.groupBy("uid", "day_type").agg(F.max("count").alias("most"))
    rare = counts.join(most, ["uid", "day_type"]).where((F.col("most") >= least) & (F.col("count") < least)).select("uid", "day_type", "services", F.lit(True).alias("special"))
    return typed.join(rare, ["uid", "day_type", "services"], "left").withColumn("special", F.coalesce("special", F.lit(False)))


def periods(typed: DataFrame) -> DataFrame:
    """uid, day_type, start, end, days, services: runs of dates of one type with the same services, special days left out."""
    w = W.partitionBy("uid", "day_type").orderBy("date")
    changed = F.when(F.lag("services").over(w).eqNullSafe(F.col("services")), 0).otherwise(1)
    runs = typed.where("not special").withColumn("c", changed).withColumn("run", F.sum("c").over(w))
    return runs.groupBy("uid", "day_type", "run").agg(F.min("date").alias("start"), F.max("date").alias("end"), F.count("*").alias("days"), F.first("services").alias("services")).drop("run")


def irregular_services(active: DataFrame, typed: DataFrame, runs: DataFrame, least: int) -> DataFrame:
    """uid, service_id, dates, mode of services in no period of `least` days: adds to, replaces or mixes with regular ones."""
    regular = runs.where(F.col("days") >= least).select("uid", F.explode("services").alias("service_id")).distinct()
    dates = active.join(typed.select("uid", "date"), ["uid", "date"], "left_semi")
    beside = dates.join(regular, ["uid", "service_id"], "left_semi").select("uid", "date").distinct().withColumn("beside", F.lit(True))
    own = dates.join(regular, ["uid", "service_id"], "left_anti").join(beside, ["uid", "date"], "left")
    n, k = F.count("*"), F.count_if("beside")
    return own.groupBy("uid", "service_id").agg(F.array_sort(F.collect_list("date")).alias("dates"), F.when(n == k, "adds").when(k == 0, "replaces").otherwise("mixed").alias("mode"))


def build_calendar(rows: DataFrame, holidays: DataFrame, config: Config | None = None, years: tuple[int, int] = (2000, 2100), validity: DataFrame | None = None) -> DataFrame:
    """uid, date, category, day_type, services, content, runs, special for every date of every publication."""
    config = config or Config()
    active = cut(active_dates(rows))
    days = cut(date_content(service_days(active, windows(rows, active, validity, *years), holidays), service_content(rows)))
    typed = days.join(day_groups(days, config.matching.day_group_min_agreement), ["uid", "category"])
    return special_days(typed, config.special_max_days)


def common_day_types(pairs: DataFrame, calendar: DataFrame) -> DataFrame:
    """pair_id, day_type, categories: the common refinement of both sides' day types."""
    groups = calendar.select("uid", "category", "day_type").distinct()
    side = lambda p: pairs.select("pair_id", F.col(f"{p}_uid").alias("uid")).join(groups, "uid").select("pair_id", "category", F.col("day_type").alias(p))
    both = side("old").join(side("new"), ["pair_id", "category"], "full_outer").groupBy("pair_id", "old", "new").agg(F.collect_set("category").alias("categories"))
    return both.select("pair_id", s.day_type_id(F.col("categories")).alias("day_type"), "categories")


def typical_days(days: DataFrame, keys: list[str], latest: F.Column | None = None) -> DataFrame:
    """keys, date, services: the most frequent set of services, ties to the one seen first, at its first (or last) date."""
    sets = days.groupBy(*keys, "services").agg(F.count("*").alias("n"), F.min("date").alias("a"), F.max("date").alias("b"))
    best = sets.groupBy(*keys).agg(F.max_by(F.struct("services", "a", "b"), F.struct("n", -F.unix_date("a"))).alias("s"))
    at = F.col("s.a") if latest is None else F.when(latest, F.col("s.b")).otherwise(F.col("s.a"))
    return best.select(*keys, at.alias("date"), F.col("s.services").alias("services"))


def choose_comparison(pairs: DataFrame, calendar: DataFrame, config: Config | None = None) -> DataFrame:
    """pair_id, day_type, mode, and old and new typical date and services of each common day type.

    With enough dates in common they are taken from those (same_days), else from each side's own (successive_periods),
    the old one's last and the new one's first. Where pairs have `after`, only dates from it on count if a side has any.
    """
    config = config or Config()
    types = cut(common_day_types(pairs, calendar))
    after = F.col("after") if "after" in pairs.columns else F.lit(None).cast("date")
    base = pairs.select("pair_id", "old_uid", "new_uid", after.alias("after"))
    side = lambda p: base.select("pair_id", "after", F.col(f"{p}_uid").alias("uid")).join(calendar, "uid").select("pair_id", "after", F.lit(p).alias("side"), "date", "category", "services", "special")
    both = side("old").unionByName(side("new"))
    shared = both.where("after is null or date >= after").groupBy("pair_id", "date").agg(F.count_distinct("side").alias("n")).where("n = 2").select("pair_id", "date", F.lit(True).alias("shared"))
    modes = base.select("pair_id").join(shared.groupBy("pair_id").count(), "pair_id", "left").select("pair_id", F.when(F.col("count") >= config.min_overlap_days, "same_days").otherwise("successive_periods").alias("mode"))
    ahead = both.groupBy("pair_id", "side").agg(F.bool_or(F.coalesce(F.col("date") >= F.col("after"), F.lit(False))).alias("ahead"))
    days = both.join(modes, "pair_id").join(ahead, ["pair_id", "side"]).join(shared, ["pair_id", "date"], "left")
    taken = F.when(F.col("mode") == "same_days", F.coalesce("shared", F.lit(False))).otherwise(~F.col("ahead") | (F.col("date") >= F.col("after")))
    typed = days.where(taken & ~F.col("special")).join(types.select("pair_id", "day_type", F.explode("categories").alias("category")), ["pair_id", "category"])
    latest = (F.col("mode") == "successive_periods") & (F.col("side") == "old")
    best = typical_days(typed, ["pair_id", "day_type", "mode", "side"], latest)
    pick = lambda p, c: F.first(F.when(F.col("side") == p, F.col(c)), ignorenulls=True).alias(f"{p}_{c}")
    chosen = best.groupBy("pair_id", "day_type").agg(*[pick(p, c) for p in ("old", "new") for c in ("date", "services")])
    empty = lambda c: F.coalesce(c, nothing()).alias(c)
    return types.select("pair_id", "day_type").join(modes, "pair_id").join(chosen, ["pair_id", "day_type"], "left").select("pair_id", "day_type", "mode", "old_date", "new_date", empty("old_services"), empty("new_services"))


def spans(dates: DataFrame, keys: list[str]) -> DataFrame:
    """keys, start, end of runs of consecutive dates."""
    w = W.partitionBy(*keys).orderBy("date")
    run = F.date_sub("date", F.row_number().over(w))
    return dates.select(*keys, "date").distinct().withColumn("run", run).groupBy(*keys, "run").agg(F.min("date").alias("start"), F.max("date").alias("end")).drop("run")


def active_days(days: DataFrame) -> DataFrame:
    """uid, category, active: dates of each category on which something runs; categories without any are left out."""
    return days.where(F.size("services") > 0).groupBy("uid", "category").agg(F.count("*").alias("active"))


def irregular_list(irregular: DataFrame, trips: DataFrame, most: int, spans: int) -> DataFrame:
    """The first `most` irregular services of each publication with their first `spans` spans of dates and full counts.

    irregular: uid, service_id, dates, mode; trips: uid, trip_id, service_id.
    """
    each = irregular.select("uid", "service_id", F.explode("dates").alias("date"))
    run = each.withColumn("run", F.datediff("date", F.lit("1970-01-01").cast("date")) - F.row_number().over(W.partitionBy("uid", "service_id").orderBy("date")))
    ends = run.groupBy("uid", "service_id", "run").agg(F.min("date").alias("start"), F.max("date").alias("end"))
    listed = ends.groupBy("uid", "service_id").agg(F.slice(F.array_sort(F.collect_list(F.struct("start", "end"))), 1, spans).alias("spans"))
    counts = trips.groupBy("uid", "service_id").agg(F.count("*").alias("trips"))
    out = irregular.join(listed, ["uid", "service_id"]).join(counts, ["uid", "service_id"], "left")
    place = F.row_number().over(W.partitionBy("uid").orderBy("service_id"))
    kept = out.withColumn("place", place).where(F.col("place") <= most)
    return kept.select("uid", "service_id", "spans", F.size("dates").alias("date_count"), F.coalesce("trips", F.lit(0)).alias("trips"), "mode")
