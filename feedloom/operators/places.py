"""Places made of stops, and their matching between two publications."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.functions import scalar as s
from feedloom.functions.kernels import line_divergence, name_ratio, normalised_name, simplified_line
from feedloom.operators.graph import components, cut, greedy
from feedloom.plans.config import Matching
from feedloom.sources.gtfs_zip import table

#: Degrees of a grid cell, some 1.1 km; radii must stay below it.
CELL = 0.01


def stops_of(rows: DataFrame) -> DataFrame:
    """Places' view of stops.txt: uid, stop_id, name, lat, lon, kind, parent. The last row of an id counts."""
    raw = table(rows, "stops.txt", "stop_id", "stop_name", "stop_lat", "stop_lon", "location_type", "parent_station").where("stop_id <> ''")
    last = raw.groupBy("uid", "stop_id").agg(F.max_by(F.struct("stop_name", "stop_lat", "stop_lon", "location_type", "parent_station"), "row_no").alias("r"))
    kind = F.trim("r.location_type")
    return last.select("uid", "stop_id", F.col("r.stop_name").alias("name"), s.finite(F.col("r.stop_lat")).alias("lat"), s.finite(F.col("r.stop_lon")).alias("lon"), F.when(kind == "", "0").otherwise(kind).alias("kind"), F.trim("r.parent_station").alias("parent"))


def parents(stops: DataFrame) -> DataFrame:
    """Stations with their platforms and stops on their own: uid, place_id, name, lat, lon, members, lone.

    A platform whose parent is unknown is a stop on its own. A station without position has its platforms' mean.
    """
    known = stops.select("uid", F.col("stop_id").alias("parent"), F.lit(True).alias("known"))
    with_parent = stops.where("kind not in ('2', '3', '4')").join(known, ["uid", "parent"], "left")
    child = (F.col("kind") == "0") & F.coalesce("known", F.lit(False))
    located = F.col("lat").isNotNull() & F.col("lon").isNotNull()
    inside = with_parent.where(child).groupBy("uid", F.col("parent").alias("stop_id")).agg(F.collect_list("stop_id").alias("children"), F.avg(F.when(located, F.col("lat"))).alias("clat"), F.avg(F.when(located, F.col("lon"))).alias("clon"))
    heads = with_parent.where((F.col("kind") == "1") | ((F.col("kind") == "0") & ~child)).join(inside, ["uid", "stop_id"], "left")
    missing = ~located & F.col("children").isNotNull()
    at = lambda own, mean: F.when(missing & F.col(mean).isNotNull(), F.col(mean)).otherwise(F.col(own))
    members = F.array_sort(F.concat(F.array("stop_id"), F.coalesce("children", F.array().cast("array<string>"))))
    return heads.select("uid", F.col("stop_id").alias("place_id"), "name", at("lat", "clat").alias("lat"), at("lon", "clon").alias("lon"), members.alias("members"), ((F.col("kind") == "0") & F.col("children").isNull()).alias("lone"))


def near_pairs(left: DataFrame, right: DataFrame, on: list[str], radius: float) -> DataFrame:
    """Rows l_* and r_* of the same `on` within the radius, with distance; a row meets the nine cells around its own.

    left and right: on, id, lat, lon. Rows without position meet nothing.
    """
    if radius >= 1000:
        raise ValueError("the radius must stay below a cell")
    cells = lambda lat, lon: (F.floor(F.col(lat) / CELL), F.floor(F.col(lon) / CELL))
    around = F.explode(F.flatten(F.transform(F.array(*[F.lit(i) for i in (-1, 0, 1)]), lambda i: F.transform(F.array(*[F.lit(j) for j in (-1, 0, 1)]), lambda j: F.struct((F.col("ci") + i).alias("i"), (F.col("cj") + j).alias("j"))))))
    ci, cj = cells("lat", "lon")
    placed = lambda df, p: df.where("lat is not null and lon is not null").select(*on, F.col("id").alias(f"{p}_id"), F.col("lat").alias(f"{p}_lat"), F.col("lon").alias(f"{p}_lon"), ci.alias("ci"), cj.alias("cj"))
    a = placed(left, "l").withColumn("c", around).withColumn("ci", F.col("c.i")).withColumn("cj", F.col("c.j")).drop("c")
    d = s.distance_m(F.col("l_lat"), F.col("l_lon"), F.col("r_lat"), F.col("r_lon"))
    return a.join(placed(right, "r"), [*on, "ci", "cj"]).withColumn("distance", d).where(F.col("distance") <= radius).drop("ci", "cj")


def build_places(stops: DataFrame, cfg: Matching | None = None) -> DataFrame:
    """uid, place_id, name, norm, lat, lon, members, points of every place.

    Stops on their own with one normalised name, each within the radius of another, are one place: named as the smallest
    id, at their mean, with the members' positions as points.
    """
    cfg = cfg or Matching()
    base = cut(parents(stops).withColumn("norm", normalised_name(F.col("name"), cfg.stop_name_suffixes, cfg.stop_name_strip_patterns)))
    lone = base.where("lone and norm <> '' and lat is not null and lon is not null").select("uid", "norm", F.col("place_id").alias("id"), "lat", "lon")
    edges = near_pairs(lone, lone, ["uid", "norm"], cfg.stop_group_radius_m).where("l_id < r_id").select("uid", F.col("l_id").alias("a"), F.col("r_id").alias("b"))
    roots = components(edges, ["uid"]).select("uid", F.col("node").alias("place_id"), "root")
    both = base.join(roots, ["uid", "place_id"], "left").withColumn("key", F.coalesce("root", "place_id"))
    first = lambda c: F.min_by(c, "place_id")
    point = F.struct("place_id", "lat", "lon")
    grouped = both.groupBy("uid", "key", F.col("root").isNotNull().alias("grouped")).agg(
        first("name").alias("name"), first("norm").alias("norm"), F.avg("lat").alias("lat"), F.avg("lon").alias("lon"), F.array_sort(F.flatten(F.collect_list("members"))).alias("members"), F.array_sort(F.collect_list(point)).alias("p")
    )
    points = F.when(F.col("grouped"), F.transform("p", lambda x: F.struct(x["lat"].alias("lat"), x["lon"].alias("lon")))).otherwise(F.array().cast("array<struct<lat: double, lon: double>>"))
    return grouped.select("uid", F.col("key").alias("place_id"), "name", "norm", "lat", "lon", "members", points.alias("points"))


def place_of_stop(places: DataFrame) -> DataFrame:
    return places.select("uid", F.explode("members").alias("stop_id"), "place_id")


def match_places(pairs: DataFrame, places: DataFrame, cfg: Matching | None = None) -> DataFrame:
    """pair_id, old_id, new_id, method, confidence, distance_m, status of every place of every pair.

    Three passes, each one-to-one: the same id, if name or position agree; the same name nearby, nearest first; a similar
    name close by, best first.
    """
    cfg = cfg or Matching()
    old = cut(pairs.select("pair_id", F.col("old_uid").alias("uid")).join(places, "uid").drop("uid"))
    new = cut(pairs.select("pair_id", F.col("new_uid").alias("uid")).join(places, "uid").drop("uid"))
    o = old.select("pair_id", F.col("place_id").alias("old_id"), F.col("norm").alias("on"), F.col("lat").alias("olat"), F.col("lon").alias("olon"))
    n = new.select("pair_id", F.col("place_id").alias("new_id"), F.col("norm").alias("nn"), F.col("lat").alias("nlat"), F.col("lon").alias("nlon"))
    d = s.distance_m(F.col("olat"), F.col("olon"), F.col("nlat"), F.col("nlon"))
    same = o.join(n, (o["pair_id"] == n["pair_id"]) & (o["old_id"] == n["new_id"])).drop(n["pair_id"]).withColumn("d", d)
    near, named = F.coalesce(F.col("d") <= cfg.stop_same_id_max_m, F.lit(False)), F.col("on") == F.col("nn")
    conf = F.when(named & (near | F.col("d").isNull()), 1.0).when(named | near, 0.9)
    columns = ["pair_id", "old_id", "new_id", "method", "confidence"]
    found = cut(same.withColumn("method", F.lit("same_id")).withColumn("confidence", conf).where(F.col("confidence") >= cfg.accept_confidence).select(*columns))
    rest = lambda side, taken: side.join(taken.select("pair_id", side.columns[1]), ["pair_id", side.columns[1]], "left_anti")
    ids = lambda side, k, name: side.select("pair_id", F.col(k).alias("id"), F.col(name).alias("name"), *[F.col(c).alias(c[1:]) for c in side.columns if c[1:] in ("lat", "lon")])

    ro, rn = rest(o, found), rest(n, found)
    by_name = near_pairs(ids(ro.where("`on` <> ''"), "old_id", "on").withColumnRenamed("name", "norm"), ids(rn, "new_id", "nn").withColumnRenamed("name", "norm"), ["pair_id", "norm"], cfg.stop_name_radius_m)
    second = by_name.select("pair_id", F.col("l_id").alias("old_id"), F.col("r_id").alias("new_id"), F.lit("same_name").alias("method"), F.round(1 - 0.1 * F.col("distance") / cfg.stop_name_radius_m, 3).alias("confidence"), F.col("distance").alias("sort"))
    taken = greedy(second.where(F.col("confidence") >= cfg.accept_confidence), ["pair_id"], ["old_id"], ["new_id"], ["sort", "old_id", "new_id"]).select(*columns)
    found = cut(found.unionByName(taken))

    ro, rn = rest(o, found), rest(n, found)
    close = near_pairs(ids(ro, "old_id", "on"), ids(rn, "new_id", "nn"), ["pair_id"], cfg.stop_near_radius_m)
    close = close.join(ro.select("pair_id", F.col("old_id").alias("l_id"), "on"), ["pair_id", "l_id"]).join(rn.select("pair_id", F.col("new_id").alias("r_id"), "nn"), ["pair_id", "r_id"]).withColumn("sim", name_ratio("on", "nn"))
    score = F.round(F.col("sim") * (1 - 0.5 * F.col("distance") / cfg.stop_near_radius_m), 3)
    third = close.where(F.col("sim") >= cfg.stop_name_min_similarity).select("pair_id", F.col("l_id").alias("old_id"), F.col("r_id").alias("new_id"), F.lit("near_similar_name").alias("method"), score.alias("confidence"), (-score).alias("sort"))
    taken = greedy(third.where(F.col("confidence") >= cfg.accept_confidence), ["pair_id"], ["old_id"], ["new_id"], ["sort", "old_id", "new_id"]).select(*columns)
    return statuses(found.unionByName(taken), old, new, cfg)


def statuses(found: DataFrame, old: DataFrame, new: DataFrame, cfg: Matching) -> DataFrame:
    """Every place of both sides with what became of it."""
    side = lambda df, p: df.select("pair_id", F.col("place_id").alias(f"{p}_id"), F.struct("name", "norm", "lat", "lon", "members", "points").alias(p))
    full = side(old, "old").join(found, ["pair_id", "old_id"], "left").join(side(new, "new"), ["pair_id", "new_id"], "full_outer")
    at = lambda p: F.when(F.size(f"{p}.points") > 0, F.col(f"{p}.points")).otherwise(F.array(F.struct(F.col(f"{p}.lat").alias("lat"), F.col(f"{p}.lon").alias("lon"))))
    moved = s.moved_m(at("old"), at("new"))
    far, renamed = F.coalesce(moved >= cfg.stop_moved_min_m, F.lit(False)), F.col("old.norm") != F.col("new.norm")
    status = F.when(F.col("new").isNull(), "removed").when(F.col("old").isNull(), "added").when(renamed & far, "renamed_moved").when(renamed, "renamed").when(far, "moved").otherwise("unchanged")
    both = F.col("old").isNotNull() & F.col("new").isNotNull()
    return full.select("pair_id", "old_id", "new_id", "method", "confidence", F.when(both, F.bround(moved)).cast("int").alias("distance_m"), status.alias("status"), F.col("old.members").alias("old_members"), F.col("new.members").alias("new_members"))


def shapes(rows: DataFrame) -> DataFrame:
    """uid, shape_id, points (lat, lon in the order of their sequence) of every shape with two usable points at least.

    Points without a finite place or a whole sequence number don't count.
    """
    raw = table(rows, "shapes.txt", "shape_id", "shape_pt_sequence", "shape_pt_lat", "shape_pt_lon").where("shape_id <> ''")
    number = raw.select("uid", "shape_id", F.trim("shape_pt_sequence").try_cast("int").alias("seq"), s.finite(F.col("shape_pt_lat")).alias("lat"), s.finite(F.col("shape_pt_lon")).alias("lon"), "row_no")
    usable = number.where("seq is not null and lat is not null and lon is not null")
    ordered = F.array_sort(F.collect_list(F.struct("seq", "row_no", "lat", "lon")))
    points = F.transform(ordered, lambda p: F.struct(p["lat"].alias("lat"), p["lon"].alias("lon")))
    return usable.groupBy("uid", "shape_id").agg(points.alias("points")).where(F.size("points") > 1)


def dominant_shapes(trips: DataFrame, known: DataFrame, keys: list[str]) -> DataFrame:
    """keys, shape_id, points: of the known shapes the one that most trips follow, the smaller id first.

    trips: keys, shape_id; known: shape_id, points and those keys that tell shapes apart.
    """
    on = [c for c in known.columns if c in keys] + ["shape_id"]
    used = trips.where("shape_id <> ''").groupBy(*keys, "shape_id").agg(F.count("*").alias("n")).join(known, on)
    best = F.min_by(F.struct("shape_id", "points"), F.struct((-F.col("n")).alias("n"), "shape_id")).alias("b")
    return used.groupBy(*keys).agg(best).select(*keys, "b.shape_id", "b.points")


def line_geometry(trips: DataFrame, known: DataFrame, patterns: DataFrame, at: DataFrame, keys: list[str], tolerance: float) -> DataFrame:
    """keys, source, length_m, points: the dominant shape, simplified, or else the places of the dominant pattern.

    patterns: keys, places; at: place_id, lat, lon. Lines of fewer than two points have no geometry.
    """
    shaped = dominant_shapes(trips, known, keys).select(*keys, F.lit("shape").alias("source"), "points")
    stops = patterns.join(shaped.select(*keys), keys, "left_anti").select(*keys, F.posexplode("places").alias("i", "place_id")).join(at, "place_id")
    by_stops = stops.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "lat", "lon"))), lambda p: F.struct(p["lat"].alias("lat"), p["lon"].alias("lon"))).alias("points"))
    both = shaped.unionByName(by_stops.select(*keys, F.lit("stops").alias("source"), "points")).where(F.size("points") > 1)
    thin = both.withColumn("points", simplified_line(F.col("points"), tolerance))
    steps = F.zip_with(F.slice("points", 1, F.size("points") - 1), F.slice("points", 2, F.size("points") - 1), lambda a, b: s.distance_m(a["lat"], a["lon"], b["lat"], b["lon"]))
    return thin.withColumn("length_m", F.round(F.aggregate(steps, F.lit(0.0), lambda n, x: n + x)).cast("long"))


def geometry_block(old: DataFrame, new: DataFrame, keys: list[str], sample: float, diverge: float, cap: float) -> DataFrame:
    """keys, identical, both sides' geometry and how far they run from each other (null if one side has none)."""
    side = lambda df, p: df.select(*keys, *[F.col(c).alias(f"{p}_{c}") for c in ("source", "length_m", "points")])
    both = side(old, "old").join(side(new, "new"), keys, "full_outer")
    same = s.polyline(F.col("old_points")) == s.polyline(F.col("new_points"))
    return both.withColumn("identical", F.coalesce(same, F.lit(False))).withColumn("change", line_divergence(F.col("old_points"), F.col("new_points"), sample, diverge, cap))
