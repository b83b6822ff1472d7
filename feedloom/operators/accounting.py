"""Every raw change in one bucket: explained by the report, outside the compared days, or unclassified."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.functions import scalar as s
from feedloom.plans.config import CORE_COLUMNS, OTHER_TOPICS

#: What evidence tables may hold: pair_id and id (and place or line), of which any may be missing.
EVIDENCE = ("changed_stops", "changed_routes", "changed_trips", "same_trips", "date_trips", "compared_trips", "family_routes", "grouped_stops")
ENTITY = {"stops.txt": "stop_id", "routes.txt": "route_id", "trips.txt": "trip_id", "stop_times.txt": "trip_id", "frequencies.txt": "trip_id", "calendar.txt": "service_id", "calendar_dates.txt": "service_id"}
WHOLE_FILE = ("file_added", "file_removed", "column_added", "column_removed", "file_changed_opaque", "rows_bulk")


def entity() -> F.Column:
    """The id of what a change's row is about: its key, else the value in the row."""
    column = F.lit(None).cast("string")
    for name, c in ENTITY.items():
        column = F.when(F.col("file") == name, c).otherwise(column)
    row = F.coalesce("new_row", "old_row")
    return F.when(F.size(F.coalesce("key", F.array().cast("array<string>"))) > 0, F.element_at("key", 1)).otherwise(F.try_element_at(row, column))


def flagged(changes: DataFrame, evidence: dict[str, DataFrame]) -> DataFrame:
    """changes with a boolean for each kind of evidence and the places and lines of changed values."""
    out = changes.withColumn("entity", entity())
    for name in EVIDENCE:
        if name in evidence:
            ids = evidence[name].select("pair_id", F.col("id").alias("entity"), F.lit(True).alias(name)).distinct()
            out = out.join(ids, ["pair_id", "entity"], "left").withColumn(name, F.coalesce(name, F.lit(False)))
        else:
            out = out.withColumn(name, F.lit(False))
    for name, value, key in (("old_place", "old_value", "old_stop_place"), ("new_place", "new_value", "new_stop_place"), ("old_line", "old_value", "route_line"), ("new_line", "new_value", "route_line")):
        if key in evidence:
            known = evidence[key].select("pair_id", F.col("id").alias(value), F.col("value").alias(name)).dropDuplicates(["pair_id", value])
            out = out.join(known, ["pair_id", value], "left")
        else:
            out = out.withColumn(name, F.lit(None).cast("string"))
    return out


def classify(changes: DataFrame, evidence: dict[str, DataFrame]) -> DataFrame:
    """changes with bucket and topic. The order of the tests is part of the result; formatting comes first."""
    rows = flagged(changes, evidence)
    file, kind, column = F.col("file"), F.col("kind"), F.coalesce("column", F.lit(""))
    core = F.lit(False)
    for name, columns in CORE_COLUMNS.items():
        core = core | ((file == name) & column.isin(*columns))
    cell = kind == "field_changed"
    attribute = cell & ~core
    is_ = lambda name: file == name
    answer = lambda bucket, topic=None: F.struct(F.lit(bucket).alias("bucket"), F.lit(topic).cast("string").alias("topic"))
    explained, attributes, unclassified = answer("explained"), answer("explained", "attributes"), answer("unclassified")
    blank = (F.trim(F.coalesce("old_value", F.lit(""))) == "") | (F.trim(F.coalesce("new_value", F.lit(""))) == "")
    stops = F.when(F.col("changed_stops"), explained).when(F.col("grouped_stops") | attribute | (cell & column.isin("stop_lat", "stop_lon")), attributes).otherwise(unclassified)
    routes = F.when(F.col("changed_routes"), explained).when((cell & column.isin("route_short_name", "route_long_name") & F.col("family_routes")) | attribute, attributes).otherwise(unclassified)
    trips = (
        F.when(is_("stop_times.txt") & cell & (column == "stop_id") & (F.col("old_place") == F.col("new_place")), explained)
        .when(~F.col("compared_trips") & ~F.col("date_trips"), answer("outside"))
        .when(attribute, attributes)
        .when(F.col("changed_trips") | ~F.col("compared_trips"), explained)
        .when(is_("trips.txt") & cell & (column == "route_id") & F.col("same_trips") & (F.col("old_line") == F.col("new_line")), explained)
        .when(is_("stop_times.txt") & F.col("same_trips"), explained)
        .when(is_("trips.txt") & cell & (column == "direction_id") & F.col("same_trips") & blank, attributes)
        .otherwise(unclassified)
    )
    in_row_file = F.when(kind.isin("column_added", "column_removed"), F.when(core, unclassified).otherwise(attributes)).when(kind.isin(*WHOLE_FILE), unclassified).when(is_("stops.txt"), stops).when(is_("routes.txt"), routes).otherwise(trips)
    topics = F.create_map(*[F.lit(x) for pair in OTHER_TOPICS.items() for x in pair])
    topic = F.try_element_at(topics, file)
    out = (
        F.when(cell & s.same_value(F.col("old_value"), F.col("new_value")), answer("explained", "formatting"))
        .when(is_("calendar.txt"), explained)
        .when(topic.isNotNull(), F.struct(F.lit("explained").alias("bucket"), topic.alias("topic")))
        .when(is_("frequencies.txt"), unclassified)
        .when(file.isin(*CORE_COLUMNS), in_row_file)
        .otherwise(answer("explained", "other_files"))
    )
    return rows.withColumn("_a", out).select(*changes.columns, "entity", F.col("_a.bucket").alias("bucket"), F.col("_a.topic").alias("topic"))


def file_table(classified: DataFrame) -> DataFrame:
    """Rows by pair, file and bucket, each row in the worst of its cells' buckets; file null is the total.

    Changes of whole files and columns are counted as structure. A row without a key is a row of its own.
    """
    rank = F.when(F.col("bucket") == "unclassified", 2).when(F.col("bucket") == "outside", 1).otherwise(0)
    structure = F.col("kind").isin(*WHOLE_FILE)
    row = F.coalesce(F.to_json("key"), F.col("id"))
    rows = classified.where(~structure).groupBy("pair_id", "file", row.alias("row")).agg(F.max(rank).alias("rank"), F.lit(0).alias("structure"))
    items = classified.where(structure).select("pair_id", "file", F.lit(None).cast("string").alias("row"), F.lit(None).cast("int").alias("rank"), F.lit(1).alias("structure"))
    both = rows.unionByName(items)
    sums = [F.count("rank").alias("rows"), *[F.count_if(F.col("rank") == i).alias(n) for i, n in enumerate(("explained", "outside", "unclassified"))], F.sum("structure").alias("structure")]
    return both.groupingSets([["pair_id", "file"], ["pair_id"]], "pair_id", "file").agg(*sums)


def topic_counts(classified: DataFrame) -> DataFrame:
    return classified.where("topic is not null").groupBy("pair_id", "topic", "kind").count()


def fare_summary(classified: DataFrame) -> DataFrame:
    """pair_id, changed, prices_changed, classes_added, classes_removed of the fares topic."""
    f = classified.where("topic = 'fares'")
    attributes = F.col("file") == "fare_attributes.txt"
    return f.groupBy("pair_id").agg(
        F.count("*").alias("changed"),
        F.count_distinct(F.when(attributes & (F.col("column") == "price"), F.col("key"))).alias("prices_changed"),
        F.count_if(attributes & (F.col("kind") == "row_added")).alias("classes_added"),
        F.count_if(attributes & (F.col("kind") == "row_removed")).alias("classes_removed"),
    )


def attribute_details(classified: DataFrame, limit: int) -> DataFrame:
    """Attribute changes by file, kind, column and values, the most frequent first, with how many groups are left out."""
    from pyspark.sql import Window as W

    grouped = classified.where("topic = 'attributes'").groupBy("pair_id", "file", "kind", "column", "old_value", "new_value").agg(F.count("*").alias("n"))
    w = W.partitionBy("pair_id").orderBy(F.desc("n"), "file", "kind", "column", "old_value", "new_value")
    total = grouped.groupBy("pair_id").agg(F.count("*").alias("groups"))
    kept = grouped.withColumn("place", F.row_number().over(w)).where(F.col("place") <= limit)
    return kept.join(total, "pair_id").withColumn("left_out", F.greatest(F.col("groups") - limit, F.lit(0))).drop("groups")


def shape_details(classified: DataFrame) -> DataFrame:
    """Changed points of each shape by kind."""
    return classified.where("file = 'shapes.txt' and key is not null").groupBy("pair_id", F.element_at("key", 1).alias("shape_id")).pivot("kind", ["row_added", "row_removed", "field_changed"]).count().na.fill(0, ["row_added", "row_removed", "field_changed"])


def exception_details(classified: DataFrame, service_dates: DataFrame, used: DataFrame) -> DataFrame:
    """Changed calendar exceptions by effect: a date of the service gained, lost, unchanged, not shared or of an unused one.

    service_dates: pair_id, side, service_id, date on dates both sides cover; used: pair_id, service_id.
    """
    row = F.coalesce("new_row", "old_row")
    sid, day = F.coalesce(F.try_element_at("key", F.lit(1)), F.try_element_at(row, F.lit("service_id"))), F.coalesce(F.try_element_at("key", F.lit(2)), F.try_element_at(row, F.lit("date")))
    exc = classified.where("file = 'calendar_dates.txt'").select("pair_id", sid.alias("service_id"), s.ymd(day).alias("date")).distinct()
    side = lambda p: service_dates.where(F.col("side") == p).select("pair_id", "service_id", "date", F.lit(True).alias(p))
    shared = service_dates.select("pair_id", "date").distinct().withColumn("shared", F.lit(True))
    out = exc.join(side("old"), ["pair_id", "service_id", "date"], "left").join(side("new"), ["pair_id", "service_id", "date"], "left").join(shared, ["pair_id", "date"], "left").join(used.withColumn("used", F.lit(True)), ["pair_id", "service_id"], "left")
    kind = F.when(F.col("used").isNull(), "calendar_unused_service").when(F.col("shared").isNull(), "calendar_outside_shared").when(F.col("old").eqNullSafe(F.col("new")), "calendar_no_effect").otherwise("service_dates_changed")
    return out.withColumn("kind", kind).groupBy("pair_id", "service_id", "kind").agg(F.array_sort(F.collect_set(F.when(F.col("new").isNotNull() & F.col("old").isNull(), F.col("date")))).alias("gained"), F.array_sort(F.collect_set(F.when(F.col("old").isNotNull() & F.col("new").isNull(), F.col("date")))).alias("lost"), F.count("*").alias("n"))


def inconsistencies(classified: DataFrame, changes: DataFrame) -> DataFrame:
    """What must not be: changes in no or two buckets, ids that are not 1 to n, unknown buckets. Empty if all is well."""
    n = F.count("*")
    doubled = classified.groupBy("pair_id", "id").agg(n.alias("n")).where("n > 1").select("pair_id", "id", F.lit("two_buckets").alias("problem"))
    lost = changes.join(classified, ["pair_id", "id"], "left_anti").select("pair_id", "id", F.lit("no_bucket").alias("problem"))
    odd = classified.where("bucket not in ('explained', 'outside', 'unclassified') or bucket is null").select("pair_id", "id", F.lit("unknown_bucket").alias("problem"))
    gaps = changes.groupBy("pair_id").agg(n.alias("n"), F.max(F.substr("id", F.lit(2)).cast("long")).alias("top")).where("n <> top").select("pair_id", F.lit(None).cast("string").alias("id"), F.lit("ids_with_gaps").alias("problem"))
    return doubled.unionByName(lost).unionByName(odd).unionByName(gaps)
