"""Signatures of what files hold, whatever the order of rows and columns, and validation differences."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.functions import scalar as s
from feedloom.plans.config import ESTIMATE_TECHNICAL_FILES

LIMBS = 8
#: Columns in which 0 says that nothing is known.
NO_INFORMATION = ("wheelchair_boarding", "wheelchair_accessible", "bikes_allowed")


def limbs(digest: F.Column) -> list[F.Column]:
    """A SHA-256 as eight 32-bit numbers, the highest first."""
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("decimal(38,0)") for i in range(LIMBS)]


def folded(sums: list[F.Column]) -> F.Column:
    """The sum of digests modulo 2**256 as hex, from the sums of their limbs."""
    carry, out = F.lit(0).cast("decimal(38,0)"), []
    base = F.lit(1 << 32).cast("decimal(38,0)")
    for total in reversed(sums):
        value = total + carry
        out.append(F.lpad(F.lower(F.hex((value % base).cast("long"))), 8, "0"))
        carry = ((value - value % base) / base).cast("decimal(38,0)")  # the quotient itself would be rounded
    return F.concat(*reversed(out))


def table_signatures(rows: DataFrame, keys: list[str]) -> DataFrame:
    """keys, rows, signature of tables (keys, cells): free of order, but not of how often a row occurs.

    Limbs are summed with partial aggregation, so no task sees more of a table than its own rows.
    """
    entries = F.array_sort(F.map_entries("cells"))
    digest = F.sha2(F.to_json(F.transform(entries, lambda e: e["value"])), 256)
    each = rows.select(*keys, F.to_json(F.transform(entries, lambda e: e["key"])).alias("header"), *[x.alias(f"l{i}") for i, x in enumerate(limbs(digest))])
    summed = each.groupBy(*keys).agg(F.min("header").alias("header"), F.count("*").alias("rows"), *[F.sum(f"l{i}").alias(f"l{i}") for i in range(LIMBS)])
    return summed.select(*keys, "rows", F.sha2(F.concat_ws("|", "header", F.col("rows").cast("string"), folded([F.col(f"l{i}") for i in range(LIMBS)])), 256).alias("signature"))


def content_signatures(files: DataFrame, keys: list[str]) -> DataFrame:
    """keys, signature over the files' names, methods and hashes. files: keys, file, method, hash."""
    part = F.concat_ws("|", "file", "method", "hash")
    return files.groupBy(*keys).agg(F.sha2(F.concat_ws("\n", F.array_sort(F.collect_list(part))), 256).alias("signature"))


def field_fill(rows: DataFrame, file: str, columns: tuple[str, ...]) -> DataFrame:
    """uid, rows and the rows with a value in each column."""
    value = lambda c: F.trim(F.coalesce(F.try_element_at("cells", F.lit(c)), F.lit("")))
    filled = lambda c: (value(c) != "") & ((value(c) != "0") if c in NO_INFORMATION else F.lit(True))
    return rows.where(F.col("file") == file).groupBy("uid").agg(F.count("*").alias("rows"), *[F.count_if(filled(c)).alias(c) for c in columns])


def coordinate_counts(stops: DataFrame, areas: list[tuple[float, float, float, float]]) -> DataFrame:
    """uid with stops outside every area and with latitude and longitude swapped. stops: uid, stop_lat, stop_lon."""
    where = s.coordinate_area(F.col("stop_lat"), F.col("stop_lon"), areas)
    return stops.groupBy("uid").agg(F.count_if(where == "outside").alias("outside"), F.count_if(where == "swapped").alias("swapped"))


def content_digests(records: DataFrame, contents: DataFrame) -> DataFrame:
    """uid, key, digest of summary and signature; null (never equivalent) where the signature is of another archive.

    records: uid, key, status, sha256, summary (struct or string); contents: uid, zip_sha256, signature.
    """
    text = F.to_json("summary") if dict(records.dtypes)["summary"].startswith("struct") else F.col("summary")
    joined = records.where("status <> 'FATAL'").withColumn("_t", text).join(contents, "uid", "left")
    digest = F.when(F.col("zip_sha256") == F.col("sha256"), F.sha2(F.concat_ws(":", F.sha2("_t", 256), "signature"), 256))
    return joined.select("uid", "key", digest.alias("digest"))


def rule_buckets(before: DataFrame, after: DataFrame, keys: list[str]) -> DataFrame:
    """keys, rule_id, before, after, bucket: fixed, new, increased, decreased or same."""
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    both = before.select(*keys, "rule_id", F.col("count").alias("b")).join(after.select(*keys, "rule_id", F.col("count").alias("a")), [*keys, "rule_id"], "full_outer").select(*keys, "rule_id", zero("b").alias("before"), zero("a").alias("after"))
    b, a = F.col("before"), F.col("after")
    return both.withColumn("bucket", F.when((b > 0) & (a == 0), "fixed").when((b == 0) & (a > 0), "new").when(a > b, "increased").when(a < b, "decreased").otherwise("same"))


def measure_deltas(before: DataFrame, after: DataFrame, keys: list[str]) -> DataFrame:
    """keys, name, before, after, delta of named figures with one exact decimal."""
    both = before.select(*keys, "name", F.col("value").alias("before")).join(after.select(*keys, "name", F.col("value").alias("after")), [*keys, "name"], "full_outer")
    return both.select(*keys, "name", s.round1(F.col("before")).alias("before"), s.round1(F.col("after")).alias("after"), s.delta1(F.col("before"), F.col("after")).alias("delta"))


def file_deltas(before: DataFrame, after: DataFrame, keys: list[str]) -> DataFrame:
    """keys, file, before, after, delta of row counts; a missing file is null and counts 0."""
    both = before.select(*keys, "file", F.col("rows").alias("before")).join(after.select(*keys, "file", F.col("rows").alias("after")), [*keys, "file"], "full_outer")
    return both.withColumn("delta", F.coalesce("after", F.lit(0)) - F.coalesce("before", F.lit(0)))


def pair_estimates(pairs: DataFrame, hashes: DataFrame) -> DataFrame:
    """pair_id, estimate: ~T if only files without service differ, else ~M. hashes: uid, file, hash; both sides needed."""
    side = lambda p: pairs.select("pair_id", F.col(f"{p}_uid").alias("uid")).join(hashes, "uid").select("pair_id", "file", F.col("hash").alias(p))
    known = side("old").select("pair_id").distinct().join(side("new").select("pair_id").distinct(), "pair_id")
    changed = side("old").join(side("new"), ["pair_id", "file"], "full_outer").where(~F.col("old").eqNullSafe(F.col("new"))).groupBy("pair_id").agg(F.bool_and(F.col("file").isin(*ESTIMATE_TECHNICAL_FILES)).alias("technical"))
    return known.join(changed, "pair_id", "left").select("pair_id", F.when(F.coalesce("technical", F.lit(True)), "~T").otherwise("~M").alias("estimate"))
