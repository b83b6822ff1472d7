"""Column expressions of the schedule model. All run inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from feedloom.plans.config import CATEGORIES, EARTH_M, LICENSES

UID = r"^[0-9a-f]{8}-[0-9a-f]{4}-4[0-9a-f]{3}-[89ab][0-9a-f]{3}-[0-9a-f]{12}$"


def is_path_id(c: Column) -> Column:
    return F.coalesce(c.rlike(r"^[A-Za-z0-9][A-Za-z0-9._-]{0,127}\z"), F.lit(False))


def is_uid(c: Column) -> Column:
    return F.coalesce(c.rlike(UID[:-1] + r"\z"), F.lit(False))


def rid_rank(c: Column) -> Column:
    """Newness of a relative position: next_2 is -2, current 0, prev_1 1; null for anything else."""
    n = F.regexp_extract(c, r"^(?:prev|next)_([1-9][0-9]*)\z", 1).try_cast("int")
    return F.when(c == "current", 0).when(c.startswith("prev_"), n).when(c.startswith("next_"), -n)


def is_download_url(c: Column, host: str) -> Column:
    """An https address of just this host, without user or port."""
    return F.coalesce(c.rlike(rf"^https://{host.replace('.', '[.]')}(?:[/?#].*)?\z"), F.lit(False))


def normalized_license(c: Column) -> Column:
    known = F.create_map(*[F.lit(x) for pair in LICENSES.items() for x in pair])
    return F.try_element_at(known, F.regexp_replace(F.trim(c), r"\s+", " "))


def ymd(c: Column) -> Column:
    """The date of exactly eight digits, else null."""
    t = F.trim(c)
    return F.when(t.rlike(r"^[0-9]{8}\z"), F.try_to_date(t, "yyyyMMdd"))


def iso_date(c: Column) -> Column:
    return F.when(c.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}\z"), F.try_to_date(c, "yyyy-MM-dd"))


def ymd_to_iso(c: Column) -> Column:
    return F.date_format(ymd(c.cast("string")), "yyyy-MM-dd")


def instant(c: Column) -> Column:
    """A timestamp that names its offset; others are null."""
    return F.when(c.rlike(r"(?:Z|[+-][0-9]{2}:?[0-9]{2})\z"), F.try_to_timestamp(c))


def round1(c: Column) -> Column:
    """One decimal, halves away from zero, exact."""
    return F.round(c.cast("decimal(20,10)"), 1).cast("decimal(18,1)")


def delta1(before: Column, after: Column) -> Column:
    return round1(after) - round1(before)


def minutes(c: Column) -> Column:
    """H:MM:SS as minutes after midnight; hours may exceed 24, seconds are dropped, bad times are null."""
    t = F.trim(c)
    h, m = (F.regexp_extract(t, r"^([0-9]+):([0-9]+):[0-9]+\z", i).try_cast("int") for i in (1, 2))
    return F.when(m < 60, h * 60 + m)


def hour_band(m: Column) -> Column:
    """07-08 for 420 to 479; hours may exceed 24."""
    h = F.floor(m / 60)
    two = lambda x: F.when(x < 100, F.lpad(x.cast("string"), 2, "0")).otherwise(x.cast("string"))
    return F.concat_ws("-", two(h), two(h + 1))


def shown_time(m: Column) -> Column:
    return F.when(m.between(0, 2880), m)


def direction_key(direction: Column, places: Column) -> Column:
    """direction_id where it is 0 or 1, else eight digits of the hash of the end places."""
    ends = F.concat(F.coalesce(F.try_element_at(places, F.lit(1)), F.lit("")), F.lit(">"), F.coalesce(F.try_element_at(places, F.lit(-1)), F.lit("")))
    d = F.trim(F.coalesce(direction, F.lit("")))
    return F.when(d.isin("0", "1"), d).otherwise(F.substring(F.sha2(ends, 256), 1, 8))


def finite(c: Column) -> Column:
    """A finite number, else null."""
    x = F.trim(c.cast("string")).try_cast("double")
    return F.when(x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")), x)


def distance_m(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle metres; null if a coordinate is missing."""
    a, b = F.radians(lat1), F.radians(lat2)
    h = F.pow(F.sin((b - a) / 2), 2) + F.cos(a) * F.cos(b) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    return 2 * EARTH_M * F.asin(F.least(F.lit(1.0), F.sqrt(h)))


def moved_m(old: Column, new: Column) -> Column:
    """The least distance between two arrays of (lat, lon) points."""
    return F.array_min(F.flatten(F.transform(old, lambda p: F.transform(new, lambda q: distance_m(p["lat"], p["lon"], q["lat"], q["lon"])))))


def same_value(a: Column, b: Column) -> Column:
    """Whether two cells write one finite number, or one H:M:S time, in two ways."""
    x, y = finite(a), finite(b)
    clock = r"^\s*[0-9]+:[0-9]+:[0-9]+\s*\z"
    parts = lambda c: F.transform(F.split(F.trim(c), ":"), lambda v: v.try_cast("bigint"))
    return F.coalesce(x == y, F.lit(False)) | F.coalesce(a.rlike(clock) & b.rlike(clock) & (parts(a) == parts(b)), F.lit(False))


def coordinate_area(lat: Column, lon: Column, areas: list[tuple[float, float, float, float]]) -> Column:
    """Null inside any (lat0, lat1, lon0, lon1) or if not numeric, swapped if inside the other way round, else outside."""
    y, x = F.trim(lat).try_cast("double"), F.trim(lon).try_cast("double")
    inside = lambda a, b: F.greatest(*[F.lit(False), *[a.between(s, n) & b.between(w, e) for s, n, w, e in areas]])
    return F.when(y.isNull() | x.isNull(), None).when(inside(y, x), None).when(inside(x, y), "swapped").otherwise("outside")


def category(date: Column, holiday: Column) -> Column:
    """hol on a holiday, else the weekday."""
    return F.when(F.coalesce(holiday, F.lit(False)), "hol").otherwise(F.element_at(F.array(*[F.lit(c) for c in CATEGORIES[:7]]), F.weekday(date) + 1))


def overlap(a: Column, b: Column) -> Column:
    """Shared members over the smaller set; 0 if either is empty."""
    n = F.least(F.size(a), F.size(b))
    return F.when(n > 0, F.size(F.array_intersect(a, b)) / n).otherwise(0.0)


def day_type_id(categories: Column) -> Column:
    """Categories joined in calendar order."""
    return F.concat_ws(",", F.filter(F.array(*[F.lit(c) for c in CATEGORIES]), lambda c: F.array_contains(categories, c)))


def day_type_order(day_type: Column) -> Column:
    order = F.array(*[F.lit(c) for c in CATEGORIES])
    return F.transform(F.split(day_type, ","), lambda c: F.array_position(order, c))


def first_departure(times: Column) -> Column:
    return F.try_element_at(F.filter(times, lambda t: t.isNotNull()), F.lit(1))


def time_map(places: Column, times: Column) -> Column:
    """Place to the time of its first call that has one, as entries."""
    calls = F.filter(F.arrays_zip(places.alias("p"), times.alias("t")), lambda c: c["t"].isNotNull())
    return F.filter(F.transform(calls, lambda c, i: F.struct(c["p"].alias("p"), c["t"].alias("t"), i.alias("i"))), lambda c: ~F.exists(F.slice(calls, 1, c["i"]), lambda d: d["p"] == c["p"]))


def shifts(places: Column, times: Column, other: Column) -> Column:
    """Absolute minutes between each call and the other trip's time map, where it has the place."""
    calls = F.filter(F.arrays_zip(places.alias("p"), times.alias("t")), lambda c: c["t"].isNotNull())
    hits = F.transform(calls, lambda c: F.abs(c["t"] - F.try_element_at(F.filter(other, lambda o: o["p"] == c["p"]), F.lit(1))["t"]))
    return F.filter(hits, lambda x: x.isNotNull())


def version(c: Column) -> Column:
    """Three numbers of a release name such as v1.2.3, else null; arrays compare as versions do."""
    v = F.regexp_replace(c, "^v", "")
    return F.when(v.rlike(r"^[0-9]+[.][0-9]+[.][0-9]+\z"), F.transform(F.split(v, "[.]"), lambda x: x.cast("int")))


def analysis_key(release: Column, profile: Column) -> Column:
    return F.concat_ws("__", release, profile)


def key_release(key: Column) -> Column:
    return F.substring_index(key, "__", 1)


def key_profile(key: Column) -> Column:
    return F.when(F.instr(key, "__") > 0, F.substr(key, F.instr(key, F.lit("__")) + 2))


def fingerprint(*columns: Column) -> Column:
    """Sixteen digits that change when an option does; names are sorted."""
    return F.substring(F.sha2(F.to_json(F.struct(*columns)), 256), 1, 16)


def upper_snake(c: Column) -> Column:
    """PascalCase codes as UPPER_SNAKE; anything that is then no such code is UNKNOWN_FATAL."""
    ok = r"^[A-Z][A-Z0-9_]*\z"
    snake = F.upper(F.regexp_replace(c, "(?<=[a-z0-9])(?=[A-Z])", "_"))
    return F.when(c.rlike(ok), c).when(snake.rlike(ok), snake).otherwise("UNKNOWN_FATAL")


def percent(n: Column, rows: Column) -> Column:
    """Whole percent, halves to even; 0 without rows."""
    return F.when(rows > 0, F.bround(100 * n / rows)).otherwise(0).cast("int")


def polyline(points: Column) -> Column:
    """Points as whole 1e-5 degrees."""
    return F.transform(points, lambda p: F.array(F.bround(p["lat"] * 1e5).cast("long"), F.bround(p["lon"] * 1e5).cast("long")))
