"""The operators over the driver's tables, each with SQL that gives the same rows where SQL can say it.

The tables are no schedules, so each query derives what its operator reads: customers are feeds and their orders
publications, event types lines, users services and so on.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.functions import kernels
from feedloom.functions import scalar as s
from feedloom.operators import calendar, content, graph, history, lines, places, publications, rawdiff, trips
from feedloom.operators import events as ev
from feedloom.sources import sinks

Query = Callable[[SparkSession, str], DataFrame]
FOUND: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        FOUND[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


# ---- raw differences

_ORDERS = """
old as (select o_orderkey as k, o_orderstatus as status, o_totalprice::decimal(18,2)::varchar as price from orders),
new as (select case when o_orderkey % 11 = 0 then o_orderkey + 10000000 else o_orderkey end as k,
  case when o_orderkey % 5 = 0 then 'X' else o_orderstatus end as status, o_totalprice::decimal(18,2)::varchar as price
  from orders where o_orderkey % 7 <> 0),
changes as (
  select 'row_removed' as kind, k, '' as "column", null::varchar as old_value, null::varchar as new_value from old where k not in (select k from new)
  union all select 'row_added', k, '', null, null from new where k not in (select k from old)
  union all select 'field_changed', k, 'status', o.status, n.status from old o join new n using (k) where o.status <> n.status
  union all select 'field_changed', k, 'price', o.price, n.price from old o join new n using (k) where o.price <> n.price)"""


def _snapshots(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    price = F.col("o_totalprice").cast("decimal(18,2)").cast("string").alias("price")
    base = t(spark, sf, "orders").select("o_orderkey", F.col("o_orderstatus").alias("status"), price)
    moved = F.when(F.col("o_orderkey") % 11 == 0, F.col("o_orderkey") + 10_000_000).otherwise(F.col("o_orderkey"))
    new = base.where("o_orderkey % 7 <> 0").select(moved.alias("k"), F.when(F.col("o_orderkey") % 5 == 0, "X").otherwise(F.col("status")).alias("status"), "price")
    return base.withColumnRenamed("o_orderkey", "k"), new


@query(f"with {_ORDERS} select *, 'c' || lpad(row_number() over (order by kind, k, \"column\")::varchar, 7, '0') as id from changes")
def raw_change_ids(spark: SparkSession, sf: str) -> DataFrame:
    """Numbered differences of two snapshots."""
    return rawdiff.positional_ids(rawdiff.snapshot_diff(*_snapshots(spark, sf), ["k"]), ["kind", "k", "column"])


@query(f"with {_ORDERS} select * from changes")
def raw_diff_keyed(spark: SparkSession, sf: str) -> DataFrame:
    """Rows and cells by primary key."""
    return rawdiff.snapshot_diff(*_snapshots(spark, sf), ["k"])


@query("""
with l as (select l_orderkey, l_linenumber, min(l_returnflag) as l_returnflag, min(l_partkey) as l_partkey, min(l_quantity) as l_quantity from lineitem group by 1, 2),
old as (select l_orderkey, l_linenumber, l_returnflag as flag, l_quantity::decimal(12,2)::varchar as qty from l),
new as (select l_orderkey, l_linenumber, case when l_partkey % 13 = 0 then 'Z' else l_returnflag end as flag, l_quantity::decimal(12,2)::varchar as qty from l where (l_orderkey + l_linenumber) % 17 <> 0)
select 'row_removed' as kind, l_orderkey, l_linenumber, '' as "column", null::varchar as old_value, null::varchar as new_value from old o where not exists (select 1 from new n where n.l_orderkey = o.l_orderkey and n.l_linenumber = o.l_linenumber)
union all select 'field_changed', l_orderkey, l_linenumber, 'flag', o.flag, n.flag from old o join new n using (l_orderkey, l_linenumber) where o.flag <> n.flag""")
def raw_diff_composite(spark: SparkSession, sf: str) -> DataFrame:
    """D2, D3 with a key of two columns."""
    li = t(spark, sf, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(*[F.min(c).alias(c) for c in ("l_returnflag", "l_partkey", "l_quantity")])
    base = [F.col("l_orderkey"), F.col("l_linenumber")]
    qty = F.col("l_quantity").cast("decimal(12,2)").cast("string").alias("qty")
    old = li.select(*base, F.col("l_returnflag").alias("flag"), qty)
    new = li.where("(l_orderkey + l_linenumber) % 17 <> 0").select(*base, F.when(F.col("l_partkey") % 13 == 0, "Z").otherwise(F.col("l_returnflag")).alias("flag"), qty)
    return rawdiff.snapshot_diff(old, new, ["l_orderkey", "l_linenumber"])


def _gtfs_rows(df: DataFrame, uid: str, file: str, **cells: F.Column) -> DataFrame:
    pairs = [x for name, c in cells.items() for x in (F.lit(name), c.cast("string"))]
    return df.select(F.lit(uid).alias("uid"), F.lit(file).alias("file"), F.create_map(*pairs).alias("cells"))


def _order_files(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(pairs, files, rows): orders as a file without a key, parts as a keyed one."""
    o, p = t(spark, sf, "orders"), t(spark, sf, "part")
    status = {"status": F.col("o_orderstatus"), "priority": F.col("o_orderpriority")}
    stop = lambda df, name: {"stop_id": F.col("p_partkey"), "stop_name": name, "brand": F.col("p_brand")}
    rows = (
        _gtfs_rows(o.where("o_orderkey % 2 = 0"), "old", "extra.txt", **status)
        .unionByName(_gtfs_rows(o.where("o_orderkey % 3 = 0"), "new", "extra.txt", **status))
        .unionByName(_gtfs_rows(p, "old", "stops.txt", **stop(p, F.col("p_name"))))
        .unionByName(_gtfs_rows(p.where("p_partkey % 9 <> 0"), "new", "stops.txt", **stop(p, F.when(F.col("p_size") > 40, F.concat("p_name", F.lit(" B"))).otherwise(F.col("p_name")))))
    )
    counts = rows.groupBy("uid", "file").agg(F.count("*").alias("row_count"), F.array_sort(F.map_keys(F.first("cells"))).alias("header"))
    files = counts.select("uid", "file", F.sha2(F.concat_ws(":", "uid", "file"), 256).alias("file_sha256"), F.lit("ok").alias("status"), F.lit("utf-8").alias("encoding"), "header", "row_count", F.lit(0).cast("long").alias("ragged_rows"))
    pairs = spark.createDataFrame([("p", "old", "new")], "pair_id string, old_uid string, new_uid string")
    return pairs, files, rows


_MULTISET = """
a as (select o_orderstatus as status, o_orderpriority as priority from orders where o_orderkey % 2 = 0),
b as (select o_orderstatus as status, o_orderpriority as priority from orders where o_orderkey % 3 = 0)"""


@query(f"""with {_MULTISET}
select 'row_removed' as kind, status, priority, count(*)::bigint as n from (select * from a except all select * from b) group by status, priority
union all select 'row_added', status, priority, count(*)::bigint from (select * from b except all select * from a) group by status, priority""")
def raw_diff_multiset(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of a file without a key, with how often."""
    pairs, files, rows = _order_files(spark, sf)
    changes, _ = rawdiff.row_changes(pairs, files.where("file = 'extra.txt'"), rows.where("file = 'extra.txt'"))
    row = F.coalesce("new_row", "old_row")
    return changes.select("kind", row["status"].alias("status"), row["priority"].alias("priority"), "copies").groupBy("kind", "status", "priority").agg(F.sum("copies").alias("n"))


@query(f"""with {_MULTISET},
x as (select (select count(*) from (select * from b except all select * from a)) as added, (select count(*) from (select * from a except all select * from b)) as removed)
select 'extra.txt' as file, 'rows_bulk' as kind, 'c0000001' as id, added::bigint as added, removed::bigint as removed from x where added + removed > 100
union all select 'stops.txt', 'row_removed', 'c' || lpad((1 + row_number() over (order by p_partkey::varchar))::varchar, 7, '0'), null, null from part where p_partkey % 9 = 0
union all select 'stops.txt', 'field_changed', 'c' || lpad((1 + (select count(*) from part where p_partkey % 9 = 0) + row_number() over (order by p_partkey::varchar))::varchar, 7, '0'), null, null from part where p_partkey % 9 <> 0 and p_size > 40""")
def raw_diff_files(spark: SparkSession, sf: str) -> DataFrame:
    """Files with and without keys in one diff; the large unkeyed one summed up."""
    from feedloom.plans.config import Config

    changes, _ = rawdiff.raw_diff(*_order_files(spark, sf), Config(bulk_threshold=100))
    return changes.select("file", "kind", "id", F.col("counts.added").alias("added"), F.col("counts.removed").alias("removed"))


@query("""
with changed as (select p_partkey as k, 'removed' as what from part where p_partkey % 9 = 0 union all select p_partkey, 'renamed' from part where p_partkey % 9 <> 0 and p_size > 40),
r as (select case when what = 'removed' then 'unclassified' when k % 2 = 0 then 'explained' else 'unclassified' end as bucket from changed)
select coalesce(file, '') as file, count(*)::bigint as "rows", count(*) filter (bucket = 'explained')::bigint as explained, count(*) filter (bucket = 'unclassified')::bigint as unclassified
from (select 'stops.txt' as file, bucket from r) group by grouping sets ((file), ())""")
def file_table(spark: SparkSession, sf: str) -> DataFrame:
    """Raw changes in buckets by evidence, and rows by file with a total."""
    from feedloom.operators import accounting

    pairs, files, rows = _order_files(spark, sf)
    changes, _ = rawdiff.raw_diff(pairs, files.where("file = 'stops.txt'"), rows.where("file = 'stops.txt'"))
    known = t(spark, sf, "part").where("p_partkey % 2 = 0 and p_partkey % 9 <> 0").select(F.lit("p").alias("pair_id"), F.col("p_partkey").cast("string").alias("id"))
    return accounting.file_table(accounting.classify(changes, {"changed_stops": known})).where("pair_id is not null").select(F.coalesce("file", F.lit("")).alias("file"), "rows", "explained", "unclassified")


# ---- calendar

_DAYS = "with d as (select distinct user_id % 8 as service, ts::date as date from events)"


@query(f"""{_DAYS}, r as (select service, date, date - row_number() over (partition by service order by date)::int as run from d)
select service, min(date) as start, max(date) as "end" from r group by service, run""")
def date_spans(spark: SparkSession, sf: str) -> DataFrame:
    """P25: runs of consecutive dates."""
    days = t(spark, sf, "events").select((F.col("user_id") % 8).alias("service"), F.to_date("ts").alias("date"))
    return calendar.spans(days, ["service"])


def _service_dates(spark: SparkSession, sf: str, extra: str = "true") -> DataFrame:
    """Sets of services by date: all users modulo 4; service 3 ends on the 12th of a month."""
    e = t(spark, sf, "events").select((F.col("user_id") % 4).cast("string").alias("service"), F.to_date("ts").alias("date"))
    kept = e.where("not (service = '3' and dayofmonth(date) > 12)").where(extra)
    typed = kept.groupBy("date").agg(F.array_sort(F.collect_set("service")).alias("services"))
    return typed.select(F.lit("u").alias("uid"), "date", F.lit("all").alias("day_type"), "services")


_SETS = """
e as (select distinct (user_id % 4)::varchar as service, ts::date as date from events where not (user_id % 4 = 3 and day(ts) > 12)),
s as (select date, string_agg(service, ',' order by service) as services from e group by date)"""


@query(f"""with {_SETS}, c as (select services, count(*) as n, min(date) as a from s group by services)
select a as date, services from c order by n desc, a limit 1""")
def typical_day(spark: SparkSession, sf: str) -> DataFrame:
    """The most frequent set of services, ties to the earliest, at its first date."""
    return calendar.typical_days(_service_dates(spark, sf), ["uid"]).select("date", F.concat_ws(",", "services").alias("services"))


_FEWER = _SETS.replace("day(ts) > 12)", "day(ts) > 12) and not (user_id % 4 = 1 and day(ts) between 20 and 22)")


@query(f"""with {_FEWER}, c as (select *, count(*) over (partition by services) as n from s), m as (select max(n) as most from c)
select date, services from c, m where most >= 8 and n < 8""")
def special_days(spark: SparkSession, sf: str) -> DataFrame:
    """Dates with a rare set of services where a regular one exists."""
    days = calendar.special_days(_service_dates(spark, sf, "not (service = '1' and dayofmonth(date) between 20 and 22)"), 8)
    return days.where("special").select("date", F.concat_ws(",", "services").alias("services"))


@query(f"""with {_FEWER}, c as (select *, count(*) over (partition by services) as n from s), m as (select max(n) as most from c),
k as (select date, services from c, m where not (most >= 8 and n < 8)),
r as (select *, case when services = lag(services) over (order by date) then 0 else 1 end as new from k),
g as (select *, sum(new) over (order by date) as run from r)
select min(date) as start, max(date) as "end", count(*)::bigint as days, min(services) as services from g group by run""")
def service_periods(spark: SparkSession, sf: str) -> DataFrame:
    """Runs of dates with one set of services, special days left out."""
    days = calendar.special_days(_service_dates(spark, sf, "not (service = '1' and dayofmonth(date) between 20 and 22)"), 8)
    return calendar.periods(days).select("start", "end", "days", F.concat_ws(",", "services").alias("services"))


_CATEGORY = "case dayofweek(date) when 0 then 'sun' when 1 then 'mon' when 2 then 'tue' when 3 then 'wed' when 4 then 'thu' when 5 then 'fri' else 'sat' end"


@query(f"""with {_FEWER}, c as (select *, {_CATEGORY} as category from s),
w as (select *, lag(services) over (partition by category order by date) as p, lead(services) over (partition by category order by date) as q from c)
select date, category from w where p is not null and q is not null and p <> services and q <> services""")
def isolated_dates(spark: SparkSession, sf: str) -> DataFrame:
    """Dates that differ from both neighbours of their weekday."""
    days = _service_dates(spark, sf, "not (service = '1' and dayofmonth(date) between 20 and 22)")
    marked = days.withColumn("category", s.category(F.col("date"), F.lit(False))).withColumn("content", F.concat_ws(",", "services")).withColumn("runs", F.lit(True))
    return calendar.isolated(marked).where("exception").select("date", "category")


@query(f"""with {_SETS}, c as (select *, {_CATEGORY} as category from s),
near as (select a.date, a.category as c1, b.category as c2, a.services = b.services as same,
  row_number() over (partition by a.date, b.category order by abs(datediff('day', a.date, b.date)), b.date) as n
  from c a join c b on b.date between a.date - 7 and a.date + 7 and a.category <> b.category),
o as (select *, list_position(['mon','tue','wed','thu','fri','sat','sun'], c1) as i, list_position(['mon','tue','wed','thu','fri','sat','sun'], c2) as j from near where n = 1)
select case when i < j then c1 else c2 end as a, case when i < j then c2 else c1 end as b, count(*)::bigint as total, (count(*) filter (same))::bigint as same from o group by 1, 2""")
def day_agreement(spark: SparkSession, sf: str) -> DataFrame:
    """Each date against the nearest date of every other weekday within a week."""
    days = _service_dates(spark, sf).withColumn("category", s.category(F.col("date"), F.lit(False))).withColumn("content", F.concat_ws(",", "services")).withColumn("runs", F.lit(True)).withColumn("exception", F.lit(False))
    return calendar.agreements(days).select("a", "b", "total", "same")


@query("""
with x as (select ts::date as date, event_type, user_id % 2 as side from events), base as (select event_type, sum(case when side = 1 then 1 else -1 end) as b from x where date = date '2024-01-01' group by 1),
d as (select date, event_type, sum(case when side = 1 then 1 else -1 end) as n from x group by 1, 2),
dates as (select distinct date from x), types as (select distinct event_type from x)
select dates.date, types.event_type, (coalesce(n, 0) - coalesce(b, 0))::bigint as n from dates cross join types left join d on d.date = dates.date and d.event_type = types.event_type left join base on base.event_type = types.event_type where coalesce(n, 0) <> coalesce(b, 0)""")
def date_residual(spark: SparkSession, sf: str) -> DataFrame:
    """What a date changes beyond the first one, as signed counts."""
    e = t(spark, sf, "events").select(F.to_date("ts").alias("date"), "event_type", F.when(F.col("user_id") % 2 == 1, 1).otherwise(-1).alias("n"))
    change = e.groupBy("date", "event_type").agg(F.sum("n").alias("n"))
    dates = change.select("date").distinct()
    base = change.where("date = '2024-01-01'").select("event_type", (-F.col("n")).alias("n"))
    return change.unionByName(dates.crossJoin(base).select("date", "event_type", "n")).groupBy("date", "event_type").agg(F.sum("n").alias("n")).where("n <> 0")


@query("""
with a as (select distinct dayofweek(ts) as c, event_type as g from events), o as (select c, min(g) as g from a where c % 3 <> 0 group by c), n as (select distinct c, case when c in (0, 6) then 'w' else 'd' end as g from a)
select coalesce(o.g, '-') as old, coalesce(n.g, '-') as new, string_agg(coalesce(o.c, n.c)::varchar, ',' order by coalesce(o.c, n.c)) as categories from o full join n on o.c = n.c group by o.g, n.g""")
def common_refinement(spark: SparkSession, sf: str) -> DataFrame:
    """Categories that share a group on both sides."""
    e = t(spark, sf, "events").select((F.dayofweek("ts") - 1).alias("c"), F.col("event_type").alias("g")).distinct()
    o = e.where("c % 3 <> 0").groupBy("c").agg(F.min("g").alias("o"))
    n = e.select("c", F.when(F.col("c").isin(0, 6), "w").otherwise("d").alias("n")).distinct()
    both = o.join(n, "c", "full_outer").groupBy("o", "n").agg(F.array_sort(F.collect_set("c")).alias("m"))
    return both.select(F.coalesce("o", F.lit("-")).alias("old"), F.coalesce("n", F.lit("-")).alias("new"), F.concat_ws(",", F.col("m").cast("array<string>")).alias("categories"))


# ---- trips

def _event_trips(spark: SparkSession, sf: str) -> DataFrame:
    """A trip is a user's day, its calls the events, a line the user modulo 5, a side the user modulo 2."""
    e = t(spark, sf, "events")
    call = e.select("user_id", F.to_date("ts").alias("date"), F.struct("ts", "event_id").alias("seq"), F.col("event_type").alias("place_id"), (F.hour("ts") * 60 + F.minute("ts")).alias("time"), (F.col("event_id") % 7).cast("int").alias("dwell"))
    out = trips.assembled(call, ["user_id", "date"])
    return out.select(
        F.lit("p").alias("pair_id"), (F.col("user_id") % 5).cast("string").alias("group_key"), (F.col("user_id") % 5).cast("string").alias("line"), F.lit("0").alias("direction"), F.lit("all").alias("day_type"),
        F.when(F.col("user_id") % 2 == 1, "new").otherwise("old").alias("side"), F.concat_ws("-", F.col("user_id").cast("string"), F.col("date").cast("string")).alias("trip_id"), "places", "times", s.first_departure(F.col("times")).alias("departure"), "dwell", "date", "user_id",
    )


@query("""
with t as (select event_type as line, user_id % 2 as side, hour(ts) as h from events)
select line, lpad(h::varchar, 2, '0') || '-' || lpad((h + 1)::varchar, 2, '0') as band, (count(*) filter (side = 0))::bigint as before, (count(*) filter (side = 1))::bigint as after from t group by 1, 2""")
def hour_bands(spark: SparkSession, sf: str) -> DataFrame:
    """Departures by hour and side."""
    e = t(spark, sf, "events").select(F.lit("p").alias("pair_id"), F.col("event_type").alias("group_key"), F.lit("0").alias("direction"), F.lit("all").alias("day_type"), F.when(F.col("user_id") % 2 == 0, "old").otherwise("new").alias("side"), (F.hour("ts") * 60 + F.minute("ts")).alias("departure"))
    return trips.hour_bands(e).select(F.col("group_key").alias("line"), "band", "before", "after")


_TRIPS = """
c as (select user_id, ts::date as date, event_type, ts, event_id, hour(ts) * 60 + minute(ts) as m from events),
trips as (select user_id, date, user_id % 5 as line, user_id % 2 as side, string_agg(event_type, '>' order by ts, event_id) as pattern, string_agg(event_type, '>' order by ts desc, event_id desc) as backwards, count(*) as calls, min(m) as dep, max(m) as arr, sum(event_id % 7) as dwell from c group by 1, 2)"""


@query(f"""with {_TRIPS}, n as (select line, pattern, backwards, calls, count(*) as n from trips group by all),
r as (select *, row_number() over (partition by line order by n desc, calls desc, backwards desc) as k from n) select line::varchar as line, pattern from r where k = 1""")
def dominant_pattern(spark: SparkSession, sf: str) -> DataFrame:
    """Calls in order, and the pattern most trips of a line run."""
    return trips.dominant_patterns(_event_trips(spark, sf), ["line"]).select("line", F.concat_ws(">", "places").alias("pattern"))


@query(f"""with {_TRIPS}, x as (select line::varchar as line, min(dep) filter (side = 0) as old_first, min(dep) filter (side = 1) as new_first, max(dep) filter (side = 0) as old_last, max(dep) filter (side = 1) as new_last from trips group by line)
select line, old_first::int as old_first, new_first::int as new_first, old_last::int as old_last, new_last::int as new_last, (coalesce(abs(old_first - new_first) >= 10, false) or coalesce(abs(old_last - new_last) >= 10, false)) as changed from x""")
def first_last(spark: SparkSession, sf: str) -> DataFrame:
    """First and last departures of a line on both sides."""
    return trips.first_last(_event_trips(spark, sf), 10).select(F.col("group_key").alias("line"), "old_first", "new_first", "old_last", "new_last", "changed")


@query(f"""with {_TRIPS} select line::varchar as line, median(dwell) filter (side = 0) as old_dwell, median(dwell) filter (side = 1) as new_dwell from trips group by line""")
def dwell_median(spark: SparkSession, sf: str) -> DataFrame:
    """Medians by side."""
    return trips.dwell_medians(_event_trips(spark, sf)).select(F.col("group_key").alias("line"), "old_dwell", "new_dwell")


@query(f"""with {_TRIPS} select line::varchar as line, median(arr - dep) filter (side = 0 and calls > 1) as old_minutes, median(arr - dep) filter (side = 1 and calls > 1) as new_minutes from trips group by line""")
def travel_times(spark: SparkSession, sf: str) -> DataFrame:
    """Median minutes from first to last call."""
    return trips.travel_times(_event_trips(spark, sf)).select(F.col("group_key").alias("line"), "old_minutes", "new_minutes")


@query()
def trip_match(spark: SparkSession, sf: str) -> DataFrame:
    """Trips of one line and day, old users against new ones."""
    day = F.col("date").cast("string")
    return trips.match_trips(_event_trips(spark, sf).withColumn("day_type", day).drop("date", "user_id"))


@query()
def moved_trips(spark: SparkSession, sf: str) -> DataFrame:
    """What a line leaves over against the other lines of the day."""
    every = graph.cut(_event_trips(spark, sf).withColumn("day_type", F.col("date").cast("string")).drop("date", "user_id"))
    return trips.match_moved_trips(every, graph.cut(trips.match_trips(every)))


@query()
def pattern_edits(spark: SparkSession, sf: str) -> DataFrame:
    """How paired trips' patterns differ."""
    every = graph.cut(_event_trips(spark, sf).withColumn("day_type", F.col("date").cast("string")).drop("date", "user_id"))
    return trips.shift_edits(trips.trip_edits(trips.match_trips(every), every))


# ---- places, lines, graphs

def _vectors(spark: SparkSession, sf: str) -> DataFrame:
    x = lambda i: F.col("embedding")[i].cast("decimal(18,6)").cast("double") * 0.05
    return t(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), (x(0) + 35).alias("lat"), (x(1) + 135).alias("lon"))


_VECTORS = """
v as (select vec_id, embedding[1]::decimal(18,6)::double * 0.05 + 35 as lat, embedding[2]::decimal(18,6)::double * 0.05 + 135 as lon from embeddings),
d as (select a.vec_id as a, b.vec_id as b, 2 * 6371008.8 * asin(least(1.0, sqrt(pow(sin((radians(b.lat) - radians(a.lat)) / 2), 2) + cos(radians(a.lat)) * cos(radians(b.lat)) * pow(sin(radians(b.lon - a.lon) / 2), 2)))) as m
  from v a join v b on a.vec_id < b.vec_id and abs(a.lat - b.lat) < 0.009)"""


@query(f"with {_VECTORS} select a, b, round(m)::bigint as metres from d where m <= 500")
def place_radius_join(spark: SparkSession, sf: str) -> DataFrame:
    """Pairs within a radius by grid cells."""
    v = _vectors(spark, sf)
    return places.near_pairs(v, v, [], 500).where("l_id < r_id").select(F.col("l_id").alias("a"), F.col("r_id").alias("b"), F.round("distance").cast("long").alias("metres"))


@query(f"""with recursive {_VECTORS}, e as (select a, b from d where m <= 40 union select b, a from d where m <= 40),
reach as (select a as node, a as seen from e union select r.node, e.b from reach r join e on e.a = r.seen)
select node, min(seen) as root from reach group by node""")
def line_components(spark: SparkSession, sf: str) -> DataFrame:
    """M2, M7: connected components of places within 40 m."""
    v = _vectors(spark, sf)
    return graph.components(places.near_pairs(v, v, [], 40).where("l_id < r_id").select(F.col("l_id").alias("a"), F.col("r_id").alias("b")))


@query()
def place_match_greedy(spark: SparkSession, sf: str) -> DataFrame:
    """M3, G-1:1: one-to-one pairs of even and odd vectors, nearest first."""
    v = _vectors(spark, sf)
    near = places.near_pairs(v.where("id % 2 = 0"), v.where("id % 2 = 1"), [], 500).select(F.lit("p").alias("pair_id"), F.col("l_id").alias("old_id"), F.col("r_id").alias("new_id"), "distance")
    return graph.greedy(near, ["pair_id"], ["old_id"], ["new_id"], ["distance", "old_id", "new_id"])


_LINES = """
o as (select distinct l_suppkey as k, l_partkey as p from lineitem),
n as (select distinct l_suppkey // 2 as k, l_partkey as p from lineitem)"""


@query(f"""with {_LINES}, so as (select k, count(*) as s from o group by k), sn as (select k, count(*) as s from n group by k)
select o.k::varchar as o, n.k::varchar as n, round(count(*) / least(min(so.s), min(sn.s))::double, 3) as overlap from o join n using (p) join so on so.k = o.k join sn on sn.k = n.k group by o.k, n.k having count(*) / least(min(so.s), min(sn.s))::double >= 0.2""")
def line_overlap(spark: SparkSession, sf: str) -> DataFrame:
    """Lines that share enough places, by what they share."""
    li = t(spark, sf, "lineitem")
    side = lambda line: li.select(line.cast("string").alias("line"), F.col("l_partkey").cast("string").alias("p")).groupBy("line").agg(F.collect_set("p").alias("places")).withColumn("pair_id", F.lit("p"))
    same = li.select(F.lit("p").alias("pair_id"), F.col("l_partkey").cast("string").alias("old_id")).distinct().withColumn("new_id", F.col("old_id"))
    return lines.overlap_edges(side(F.col("l_suppkey")), side(F.floor(F.col("l_suppkey") / 2)), same, 0.2).select("o", "n", "overlap")


@query("""
with o as (select distinct c_name as line, regexp_replace(c_name, '^Customer#0*', '') as name from customer where c_custkey % 2 = 0 or c_custkey % 5 = 0), n as (select distinct replace(c_name, '#', '#0') as line, regexp_replace(c_name, '^Customer#0*', '') as name from customer where c_custkey % 3 = 0)
select o.line as o, n.line as n from o join n on (case when length(o.name) >= 2 then o.name else o.line end) = (case when length(n.name) >= 2 then n.name else n.line end)""")
def line_names(spark: SparkSession, sf: str) -> DataFrame:
    """Lines with one name after the configured parts are stripped."""
    c = t(spark, sf, "customer")
    old = c.where("c_custkey % 2 = 0 or c_custkey % 5 = 0").select(F.lit("p").alias("pair_id"), F.col("c_name").alias("line")).distinct()
    new = c.where("c_custkey % 3 = 0").select(F.lit("p").alias("pair_id"), F.regexp_replace("c_name", "#", "#0").alias("line")).distinct()
    return lines.named_matches(old, new, ("^Customer#0*",)).select("o", "n")


@query()
def name_normalise(spark: SparkSession, sf: str) -> DataFrame:
    """P10: names without endings, to a fixed point."""
    p = t(spark, sf, "part").select("p_partkey", "p_name")
    return p.withColumn("norm", kernels.normalised_name(F.col("p_name"), ("ed", "s", "er"), ("[0-9]+$",)))


@query()
def geometry_divergence(spark: SparkSession, sf: str) -> DataFrame:
    """Polylines of 16 coordinate pairs against the next vector's."""
    v = t(spark, sf, "embeddings").select("vec_id", "embedding")
    line = F.transform(F.sequence(F.lit(0), F.lit(15)), lambda i: F.struct((35 + F.col("embedding")[2 * i].cast("double") * 0.01).alias("lat"), (135 + F.col("embedding")[2 * i + 1].cast("double") * 0.01).alias("lon")))
    a = v.select("vec_id", kernels.simplified_line(line, 10.0).alias("old"))
    b = v.select((F.col("vec_id") - 1).alias("vec_id"), line.alias("new"))
    return a.join(b, "vec_id").select("vec_id", kernels.line_divergence(F.col("old"), F.col("new"), 200.0, 50.0, 500.0).alias("d")).select("vec_id", "d.max_m", "d.diverged_old_m", "d.diverged_new_m", "d.capped")


# ---- publications

def _generations(spark: SparkSession, sf: str) -> DataFrame:
    """Orders are publications of their customer; two in nine give no instant; status P failed."""
    o = t(spark, sf, "orders")
    at = F.concat(F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit("T00:00:00Z"))
    return o.select(F.lit("org").alias("org_id"), F.col("o_custkey").alias("feed_id"), F.col("o_orderkey").alias("uid"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("from_date"), F.when(F.col("o_orderkey") % 9 < 7, at).alias("published_at"), (F.col("o_orderkey") % 10 != 3).alias("present"), "o_orderstatus", F.col("o_totalprice").alias("price"))


_GENS = """
g as (select o_custkey as feed_id, o_orderkey as uid, o_orderdate::date as d, case when o_orderkey % 9 < 7 then o_orderdate::date end as p, o_orderkey % 10 <> 3 as present, o_orderstatus, o_totalprice,
  row_number() over (partition by o_custkey order by o_orderdate::date, (o_orderkey % 9 < 7), o_orderkey) as pos from orders)"""


@query(f"with {_GENS} select feed_id, uid, pos::int as pos from g")
def publication_order(spark: SparkSession, sf: str) -> DataFrame:
    """Publications in order, those without an instant first on their day."""
    return publications.ordered(_generations(spark, sf)).select("feed_id", "uid", "pos")


def _index(spark: SparkSession, sf: str) -> DataFrame:
    g = publications.ordered(_generations(spark, sf))
    status = F.when(F.col("uid") % 8 == 5, None).when(F.col("o_orderstatus") == "P", "FATAL").when(F.col("uid") % 5 == 0, "PARTIAL").otherwise("COMPLETE")
    return g.select("org_id", "feed_id", F.lit("k").alias("key"), "uid", "pos", F.lit("AVAILABLE").alias("source_status"), status.alias("status"), (F.col("uid") % 6 == 0).alias("equivalent_to_previous"), F.when(F.col("uid") % 4 == 1, "current").otherwise("prev_1").alias("rid"), "published_at")


_INDEX = f"""{_GENS},
i as (select feed_id, uid, pos, case when uid % 8 = 5 then null when o_orderstatus = 'P' then 'FATAL' when uid % 5 = 0 then 'PARTIAL' else 'COMPLETE' end as status, uid % 6 = 0 as eq, case when uid % 4 = 1 then 'current' else 'prev_1' end as rid from g)"""


@query(f"""with {_INDEX}, c as (select *, lag(uid) over (partition by feed_id order by pos) as old_uid, lag(pos) over (partition by feed_id order by pos) as old_pos from i where status = 'COMPLETE')
select c.feed_id, old_uid, c.uid as new_uid, coalesce((select string_agg(x.uid::varchar, ',' order by x.pos) from i x where x.feed_id = c.feed_id and x.pos > c.old_pos and x.pos < c.pos), '') as skipped from c where old_uid is not null""")
def consecutive_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """Neighbouring complete publications and what lies between them."""
    return publications.consecutive_pairs(_index(spark, sf)).select("feed_id", "old_uid", "new_uid", F.concat_ws(",", F.col("skipped_uids").cast("array<string>")).alias("skipped"))


@query(f"""with {_INDEX}, a as (select *, sum(case when status = 'FATAL' then 1 else 0 end) over (partition by feed_id order by pos) as chain from i where status is not null),
l as (select *, lag(uid) over (partition by feed_id, chain order by pos) as old_uid from a where status <> 'FATAL') select feed_id, old_uid, uid as new_uid from l where old_uid is not null and not eq""")
def report_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """Analysed neighbours; a failed one breaks the chain."""
    return publications.report_pairs(_index(spark, sf)).select("feed_id", "old_uid", "new_uid")


@query(f"""with {_INDEX}, a as (select *, status = 'FATAL' as fatal, coalesce(lag(status) over (partition by feed_id order by pos) = 'FATAL', true) as pf from i where status is not null),
s as (select *, sum(case when eq and not fatal and not pf then 0 else 1 end) over (partition by feed_id order by pos) as grp from a)
select feed_id, grp::bigint as grp, arg_min(uid, pos) as first_uid, arg_max(uid, pos) as last_uid, bool_or(fatal) as fatal, count(*)::int as n from s group by feed_id, grp""")
def page_groups(spark: SparkSession, sf: str) -> DataFrame:
    """Publications with the equivalent ones that follow them."""
    return publications.page_groups(_index(spark, sf)).select("feed_id", "grp", "first_uid", "last_uid", "fatal", F.size("uids").alias("n"))


@query(f"""with {_INDEX}, a as (select *, status = 'FATAL' as fatal, coalesce(lag(status) over (partition by feed_id order by pos) = 'FATAL', true) as pf from i where status is not null),
s as (select *, sum(case when eq and not fatal and not pf then 0 else 1 end) over (partition by feed_id order by pos) as grp from a),
pg as (select feed_id, grp, arg_min(uid, pos) as first_uid, arg_max(uid, pos) as last_uid, bool_or(fatal) as fatal, arg_min(rid, pos) as fr, arg_max(rid, pos) as lr from s group by feed_id, grp),
c as (select feed_id, coalesce(max(grp) filter (fr = 'current' or lr = 'current'), max(grp)) as cur from pg group by feed_id),
w as (select pg.* from pg join c using (feed_id) where grp >= cur - 3 and not fatal)
select a.feed_id, a.last_uid as old_uid, b.first_uid as new_uid from w a join w b on a.feed_id = b.feed_id and b.grp - a.grp > 1""")
def page_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """Pairs of shown groups that are not neighbours."""
    return publications.page_pairs(publications.page_window(publications.page_groups(_index(spark, sf)))).select("feed_id", "old_uid", "new_uid")


@query(f"""with {_GENS}, p as (select feed_id, uid, row_number() over (partition by feed_id order by pos desc) - 1 as depth from g where present)
select feed_id, uid, depth::int as depth from p where uid % 4 <> 2 order by depth, feed_id limit 500""")
def pending_round_robin(spark: SparkSession, sf: str) -> DataFrame:
    """What has no record, newest of every feed first."""
    g = _generations(spark, sf)
    return publications.pending(g, g.where("uid % 4 = 2").select("uid"), 500).select("feed_id", "uid", "depth")


@query(f"""with {_GENS}, x as (select *, o_orderstatus || (uid % 2)::varchar as digest from g), l as (select *, lag(digest) over (partition by feed_id order by pos) as before from x) select feed_id, uid, coalesce(digest = before, false) as equivalent from l""")
def equivalent_runs(spark: SparkSession, sf: str) -> DataFrame:
    """Publications with the digest of the one before."""
    g = _generations(spark, sf).withColumn("present", F.lit(True))
    analyses = g.select("uid", F.lit("k").alias("key"), F.lit("COMPLETE").alias("status"))
    digests = g.select("uid", F.lit("k").alias("key"), F.concat("o_orderstatus", (F.col("uid") % 2).cast("string")).alias("digest"))
    return publications.feed_index(g, analyses, digests, g.limit(0)).select("feed_id", "uid", F.col("equivalent_to_previous").alias("equivalent"))


@query(f"""with {_GENS}, x as (select feed_id, uid, case when o_orderstatus = 'P' then 'FATAL' when uid % 5 = 0 then 'PARTIAL' else 'COMPLETE' end as st, uid % 7 = 0 as sc, uid % 3 as m, uid // 8 as z, pos from g),
l as (select *, lag(uid) over w as pu, lag(st) over w as ps, lag(sc) over w as pc, lag(m) over w as pm, lag(z) over w as pz from x window w as (partition by feed_id order by pos))
select feed_id, uid, case when st = 'FATAL' or ps = 'FATAL' then 'INVALID_INPUT' when st = 'PARTIAL' or ps = 'PARTIAL' or sc or pc then 'UNVERIFIED_INPUT' when m <> pm then 'INCOMPATIBLE_METHOD' when z = pz then 'SAME_FEED' else 'COMPARABLE' end as state from l where pu is not null""")
def comparator_states(spark: SparkSession, sf: str) -> DataFrame:
    """Whether neighbours' validations can be compared."""
    g = publications.ordered(_generations(spark, sf))
    status = F.when(F.col("o_orderstatus") == "P", "FATAL").when(F.col("uid") % 5 == 0, "PARTIAL").otherwise("COMPLETE")
    rows = g.select("org_id", "feed_id", "pos", "uid", status.alias("status"), (F.col("uid") % 7 == 0).alias("source_changed"), (F.col("uid") % 3).alias("method"), F.floor(F.col("uid") / 8).alias("zip_sha256"))
    return publications.comparator_states(rows).select("feed_id", "uid", "state")


@query("""
with n as (select c_custkey as k, c_acctbal::decimal(12,2)::varchar as v from customer where c_custkey % 4 <> 0), o as (select c_custkey as k, 'old' as v from customer where c_custkey % 3 <> 0)
select coalesce(n.k, o.k) as k, case when n.k is not null then n.v else o.v end as v, n.k is not null as present from n full join o on n.k = o.k""")
def catalog_merge(spark: SparkSession, sf: str) -> DataFrame:
    """Rows once listed stay, with whether they still are."""
    c = t(spark, sf, "customer").select(F.col("c_custkey").alias("k"), F.col("c_acctbal").cast("decimal(12,2)").cast("string").alias("v"))
    return publications.merged_catalog(c.where("k % 3 <> 0").withColumn("v", F.lit("old")), c.where("k % 4 <> 0"), ["k"])


# ---- validation, metrics, content

@query("""
with b as (select l_suppkey % 20 as k, case when l_partkey % 5 < 2 then l_returnflag || l_linestatus else l_linestatus end as r, count(*) as n from lineitem where l_orderkey % 2 = 0 group by 1, 2),
a as (select l_suppkey % 20 as k, case when l_partkey % 7 < 2 then l_returnflag || l_linestatus else l_returnflag end as r, count(*) as n from lineitem where l_orderkey % 2 = 1 group by 1, 2),
x as (select coalesce(b.k, a.k) as k, coalesce(b.r, a.r) as rule_id, coalesce(b.n, 0) as before, coalesce(a.n, 0) as after from b full join a on b.k = a.k and b.r = a.r)
select k, rule_id, before::bigint as before, after::bigint as after, case when before > 0 and after = 0 then 'fixed' when before = 0 and after > 0 then 'new' when after > before then 'increased' when after < before then 'decreased' else 'same' end as bucket from x""")
def rule_buckets(spark: SparkSession, sf: str) -> DataFrame:
    """Rules fixed, new, increased, decreased or the same, of the even orders against the odd ones."""
    li = t(spark, sf, "lineitem")
    both = F.concat("l_returnflag", "l_linestatus")
    side = lambda odd, rule: li.where(F.col("l_orderkey") % 2 == odd).groupBy((F.col("l_suppkey") % 20).alias("k"), rule.alias("rule_id")).agg(F.count("*").alias("count"))
    before = side(0, F.when(F.col("l_partkey") % 5 < 2, both).otherwise(F.col("l_linestatus")))
    return content.rule_buckets(before, side(1, F.when(F.col("l_partkey") % 7 < 2, both).otherwise(F.col("l_returnflag"))), ["k"])


@query("""
with p as (select o_custkey % 50 as k, o_orderstatus as name, o_orderkey % 2 as side, sum(o_totalprice::decimal(18,2)) as v from orders group by 1, 2, 3)
select coalesce(b.k, a.k) as k, coalesce(b.name, a.name) as name, round(b.v, 1)::double as before, round(a.v, 1)::double as after, (round(a.v, 1) - round(b.v, 1))::double as delta from (select * from p where side = 0) b full join (select * from p where side = 1) a on a.k = b.k and a.name = b.name""")
def validation_diff(spark: SparkSession, sf: str) -> DataFrame:
    """Exact deltas of figures with one decimal."""
    o = t(spark, sf, "orders")
    side = lambda i: o.where(F.col("o_orderkey") % 2 == i).groupBy((F.col("o_custkey") % 50).alias("k"), F.col("o_orderstatus").alias("name")).agg(F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("value"))
    out = content.measure_deltas(side(0), side(1), ["k"])
    return out.select("k", "name", *[F.col(c).cast("double").alias(c) for c in ("before", "after", "delta")])


@query("""
with l as (select c_nationkey::varchar as feed, o_orderdate::date as d, o_orderkey % 10 <> 3 as present, o_orderkey as k, o_orderstatus as st from orders join customer on o_custkey = c_custkey),
p as (select feed, present, case when k % 7 = 0 then 'E' when k % 11 = 0 then '~T' when st = 'P' then 'U/FATAL' when st = 'F' then 'M' else 'T' end as code from l where d > date '1996-06-30' - 365 and d <= date '1996-06-30'),
x as (select feed, count(*) as n, count(*) filter (present) as av, count(*) filter (code = 'M') as m, count(*) filter (code = 'T') as t, count(*) filter (code = 'E') as e, count(*) filter (code = '~T') as et, count(*) filter (code = 'U/FATAL') as u from p group by grouping sets ((feed), ())),
f as (select distinct c_nationkey::varchar as feed from orders join customer on o_custkey = c_custkey union all select null)
select coalesce(f.feed, 'all') as feed, coalesce(n, 0)::bigint as publications, case when n > 0 then round((m + t + e + et) / n::double, 4) end as coverage, case when n > 0 then round(av / n::double, 4) end as source_availability_rate,
case when m + t + e + et > 0 then round((t + et) / (m + t + e + et)::double, 4) end as technical_only_change_ratio, round(coalesce(n, 0) / (365.0 / 30)::double, 2)::double as publication_frequency from f left join x on x.feed is not distinct from f.feed""")
def metrics_rollup(spark: SparkSession, sf: str) -> DataFrame:
    """Rolling metrics for each feed and for all; a ratio of nothing is null."""
    o = t(spark, sf, "orders").join(t(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey")).select(F.col("c_nationkey").cast("string").alias("feed"), F.to_date("o_orderdate").alias("published_at"), (F.col("o_orderkey") % 10 != 3).alias("present"), F.col("o_orderkey").alias("k"), F.col("o_orderstatus").alias("st"))
    code = F.when(F.col("k") % 7 == 0, "E").when(F.col("k") % 11 == 0, "~T").when(F.col("st") == "P", "U/FATAL").when(F.col("st") == "F", "M").otherwise("T")
    pairs = o.select("feed", "published_at", code.alias("code"), F.lit(False).alias("comparable"), F.lit(False).alias("regression"), F.lit(0).alias("unclassified"), F.lit(0).alias("raw"), F.lit(None).cast("boolean").alias("renumbered"))
    out = history.metrics(o, pairs, "1996-06-30")
    return out.select(F.coalesce("feed", F.lit("all")).alias("feed"), "publications", "coverage", "source_availability_rate", "technical_only_change_ratio", "publication_frequency")


@query("""
with f as (select p_brand, sha256(string_agg(sha256(p_partkey::varchar || '|' || p_name), '' order by sha256(p_partkey::varchar || '|' || p_name))) as hash from part group by p_brand)
select p_brand as k, sha256('part|rows|' || hash) as signature from f""")
def content_signature(spark: SparkSession, sf: str) -> DataFrame:
    """Signatures of files from sorted hashes of their rows."""
    h = F.sha2(F.concat_ws("|", F.col("p_partkey").cast("string"), "p_name"), 256)
    f = t(spark, sf, "part").groupBy(F.col("p_brand").alias("k")).agg(F.sha2(F.concat_ws("", F.array_sort(F.collect_list(h))), 256).alias("hash"))
    return content.content_signatures(f.select("k", F.lit("part").alias("file"), F.lit("rows").alias("method"), "hash"), ["k"])


@query()
def multiset_signature(spark: SparkSession, sf: str) -> DataFrame:
    """Order-free signatures by limb sums."""
    li = t(spark, sf, "lineitem")
    rows = li.select(F.col("l_shipdate").cast("date").cast("string").alias("day"), F.create_map(F.lit("part"), F.col("l_partkey").cast("string"), F.lit("line"), F.col("l_linenumber").cast("string")).alias("cells"))
    return content.table_signatures(rows, ["day"])


@query("""
with r as (select l_suppkey as uid, l_returnflag as rule_id, l_linestatus as severity, case when l_quantity < 25 then 'a' else 'b' end as cls from lineitem),
u as (select uid, rule_id, count(*) as n, min(severity) as severity, min(cls) as cls from r group by 1, 2), c as (select rule_id, severity, cls, count(*) as k from u group by all),
m as (select *, row_number() over (partition by rule_id order by k desc, severity, cls) as p from c)
select uid, rule_id, n::bigint as "count", case when u.severity = m.severity and u.cls = m.cls then null else u.severity end as severity, case when u.severity = m.severity and u.cls = m.cls then null else u.cls end as class from u join m using (rule_id) where p = 1""")
def compact_rules(spark: SparkSession, sf: str) -> DataFrame:
    """Severity and class only where a publication differs from the usual."""
    li = t(spark, sf, "lineitem").select(F.col("l_suppkey").alias("uid"), F.col("l_returnflag").alias("rule_id"), F.col("l_linestatus").alias("severity"), F.when(F.col("l_quantity") < 25, "a").otherwise("b").alias("class"))
    return history.compact_rules(li.groupBy("uid", "rule_id").agg(F.count("*").alias("count"), F.min("severity").alias("severity"), F.min("class").alias("class")))[1]


@query("""
with n as (select o_custkey as k, o_orderkey as v from orders where o_orderkey % 3 <> 0), r as (select k, v - row_number() over (partition by k order by v) as run, v from n), e as (select k, min(v) as a, max(v) as b from r group by k, run)
select k, string_agg(case when a = b then 'c' || lpad(a::varchar, 7, '0') else 'c' || lpad(a::varchar, 7, '0') || '-c' || lpad(b::varchar, 7, '0') end, ',' order by a) as ranges from e group by k""")
def id_ranges(spark: SparkSession, sf: str) -> DataFrame:
    """Consecutive change ids as ranges."""
    ids = t(spark, sf, "orders").where("o_orderkey % 3 <> 0").select(F.col("o_custkey").alias("k"), F.concat(F.lit("c"), F.lpad(F.col("o_orderkey").cast("string"), 7, "0")).alias("id"))
    return ev.id_ranges(ids, ["k"]).select("k", F.concat_ws(",", "ranges").alias("ranges"))


@query("""
with m as (select o_custkey as feed_id, o_orderkey as uid, o_orderdate as updated from orders where o_orderstatus = 'F'), r as (select *, row_number() over (partition by feed_id order by updated desc, uid desc) as n from m),
k as (select * from r where n <= 20), o as (select uid, row_number() over (order by updated desc, uid desc, feed_id) <= 50 as ov from k)
select feed_id, uid, n::int as place, ov as in_overall from k join o using (uid)""")
def newest_entries(spark: SparkSession, sf: str) -> DataFrame:
    """K6, T5: the newest 20 of each feed and 50 of all."""
    o = t(spark, sf, "orders").select(F.lit("org").alias("org_id"), F.col("o_custkey").alias("feed_id"), F.col("o_orderkey").alias("uid"), F.col("o_orderdate").alias("updated"), F.when(F.col("o_orderstatus") == "F", "major").otherwise("minor").alias("class"))
    return sinks.newest_entries(o).select("feed_id", "uid", "place", "in_overall")


@query("""
with p as (select o_custkey as f, o_orderkey as uid from orders),
r as (select *, sum(case when uid % 3 = 0 then 1 else 0 end) over (partition by f order by uid) as run from p),
c as (select f, uid, min(uid) over (partition by f, run) as root from r)
select f as feed, uid, 'route-' || substr(sha256('o/' || f::varchar || '|' || lpad(root::varchar, 12, '0') || '|R'), 1, 16) as canonical_route_id from c""")
def route_lineage(spark: SparkSession, sf: str) -> DataFrame:
    """One route carried through a history, with a break where neither id nor mapping links it."""
    from pyspark.sql import Window as W

    o = t(spark, sf, "orders").select(F.col("o_custkey").alias("feed_id"), F.col("o_orderkey").alias("n"))
    w = W.partitionBy("feed_id").orderBy("n")
    uid = lambda c: F.lpad(F.col(c).cast("string"), 12, "0")
    p = o.withColumn("before", F.lag("n").over(w)).where("before is not null and n % 3 <> 0").select(F.lit("o").alias("org_id"), "feed_id", F.concat_ws("-", uid("before"), uid("n")).alias("pair_id"), uid("before").alias("old_uid"), uid("n").alias("new_uid"))
    each = o.select(F.lit("o").alias("org_id"), "feed_id", uid("n").alias("uid"))
    side = lambda c, name: p.select("org_id", "feed_id", "pair_id", F.lit(name).alias("side"), F.col(c).alias("uid"), F.lit("R").alias("route_id"))
    lone = each.select("org_id", "feed_id", F.concat(F.lit("x"), "uid").alias("pair_id"), F.lit("old").alias("side"), "uid", F.lit("R").alias("route_id"))
    none = spark.createDataFrame([], "org_id string, feed_id long, old_uid string, new_uid string, old array<string>, new array<string>, relation string, confidence double")
    out = history.route_lineage(side("old_uid", "old").unionByName(side("new_uid", "new")).unionByName(lone), none)
    return out.select(F.col("feed_id").alias("feed"), F.col("uid").cast("long").alias("uid"), "canonical_route_id")


@query("""
with x as (select o_orderkey as k, (o_orderkey % 31)::varchar || ':' || lpad((o_orderkey % 75)::varchar, 2, '0') || ':00' as c, (o_orderkey % 13)::varchar as a, case when o_orderkey % 2 = 0 then (o_orderkey % 13)::varchar || '.0' else 'x' end as b from orders)
select k, case when (k % 75) < 60 then ((k % 31) * 60 + k % 75)::int end as minutes, case when (k % 75) < 60 then lpad(((k % 31) + 0)::varchar, 2, '0') || '-' || lpad(((k % 31) + 1)::varchar, 2, '0') end as band, k % 2 = 0 as same from x""")
def times_and_values(spark: SparkSession, sf: str) -> DataFrame:
    """Times beyond midnight, hour bands and cells that write one value in two ways."""
    k = F.col("o_orderkey")
    x = t(spark, sf, "orders").select(k.alias("k"), F.concat((k % 31).cast("string"), F.lit(":"), F.lpad((k % 75).cast("string"), 2, "0"), F.lit(":00")).alias("c"), (k % 13).cast("string").alias("a"), F.when(k % 2 == 0, F.concat((k % 13).cast("string"), F.lit(".0"))).otherwise("x").alias("b"))
    m = s.minutes(F.col("c"))
    return x.select("k", m.alias("minutes"), F.when(m.isNotNull(), s.hour_band(m)).alias("band"), s.same_value(F.col("a"), F.col("b")).alias("same"))


def queries() -> dict[str, Query]:
    from feedloom.plans import more_queries

    return FOUND | more_queries.FOUND


def oracle_sql() -> dict[str, str]:
    from feedloom.plans import more_queries

    return SQL | more_queries.SQL
