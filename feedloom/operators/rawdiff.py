"""Every difference between the two publications of a pair, in a fixed order with positional ids.

All pairs go through one plan; pair_id is part of every key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from feedloom.operators.graph import cut
from feedloom.plans.config import FIXED_KEYS, KINDS, NEVER_BULK, OPTIONAL_KEYS, Config

MAP = "map<string,string>"
CHANGE = {"pair_id": "string", "file": "string", "kind": "string", "key": "array<string>", "sort_key": "array<string>", "column": "string", "old_value": "string", "new_value": "string", "old_row": MAP, "new_row": MAP, "rows": "bigint", "counts": "struct<added: bigint, removed: bigint, changed_rows: bigint, changed_cells: bigint>", "copies": "bigint"}


def _shaped(df: DataFrame, **given: F.Column) -> DataFrame:
    """df's pair_id and file with the given columns, null for the others. `copies` says how often a change stands."""
    base = {"pair_id": F.col("pair_id"), "file": F.col("file"), "copies": F.lit(1)} | given
    return df.select(*[base.get(c, F.lit(None)).cast(t).alias(c) for c, t in CHANGE.items()])


def sides(pairs: DataFrame, table: DataFrame) -> DataFrame:
    """table (keyed by uid) for both sides of every pair: pair_id, side (old or new) and the rest.

    The table stands on the left: of a sort-merge join's right side, all rows of one key are held on the heap.
    """
    each = pairs.select("pair_id", F.explode(F.array(F.struct(F.lit("old").alias("side"), F.col("old_uid").alias("uid")), F.struct(F.lit("new").alias("side"), F.col("new_uid").alias("uid")))).alias("s")).select("pair_id", "s.side", "s.uid")
    return table.join(each, "uid").select("pair_id", "side", *[c for c in table.columns if c != "uid"])


def paired_files(pairs: DataFrame, files: DataFrame) -> DataFrame:
    """One row per pair and file name with both sides' file columns as old and new structs."""
    both = sides(pairs, files)
    cols = [c for c in both.columns if c not in ("pair_id", "side", "file")]
    return both.groupBy("pair_id", "file").agg(*[F.first(F.when(F.col("side") == side, F.struct(*cols)), ignorenulls=True).alias(side) for side in ("old", "new")])


def key_choice(paired: DataFrame, rows: DataFrame) -> DataFrame:
    """paired with mode (presence, opaque, keyed, multiset), key columns and the reason of a fallback.

    rows: pair_id, side, file, cells. A key with duplicates on either side falls back to the multiset.
    """
    fixed = F.create_map(*[F.lit(x) if not isinstance(x, tuple) else F.array(*[F.lit(c) for c in x]) for name, key in FIXED_KEYS.items() if key for x in (name, key)])
    optional = F.create_map(*[F.lit(x) if not isinstance(x, tuple) else F.array(*[F.lit(c) for c in x]) for name, key in OPTIONAL_KEYS.items() for x in (name, key)])
    single = [k for k, v in FIXED_KEYS.items() if v is None]
    both = F.array_intersect("old.header", "new.header")
    full = F.try_element_at(fixed, F.col("file"))
    some = F.filter(F.try_element_at(optional, F.col("file")), lambda c: F.array_contains(both, c))
    ok = F.col("old").isNotNull() & F.col("new").isNotNull() & (F.col("old.status") == "ok") & (F.col("new.status") == "ok")
    one_row = F.col("file").isin(single)
    lone = one_row & (F.col("old.row_count") <= 1) & (F.col("new.row_count") <= 1)
    wanted = F.when(lone, F.array().cast("array<string>")).when(full.isNotNull() & (F.size(F.array_except(full, both)) == 0), full).when(some.isNotNull() & (F.size(some) > 0), some)
    reason = F.when(one_row & ~lone, "multiple_rows_in_single_row_file").when(full.isNotNull() | some.isNotNull(), F.when(wanted.isNull(), "key_column_missing")).when(~one_row, "no_primary_key")
    first = paired.withColumn("wanted", F.when(ok, wanted)).withColumn("reason", F.when(ok, reason))
    keyed_rows = rows.join(first.where("size(wanted) > 0").select("pair_id", "file", "wanted"), ["pair_id", "file"])
    values = F.transform("wanted", lambda c: F.coalesce(F.try_element_at("cells", c), F.lit("")))
    doubled = keyed_rows.groupBy("pair_id", "file", "side", values.alias("k")).count().where("count > 1").select("pair_id", "file").distinct().withColumn("doubled", F.lit(True))
    out = first.join(doubled, ["pair_id", "file"], "left")
    key = F.when(F.col("doubled").isNull(), F.col("wanted"))
    mode = F.when(F.col("old").isNull() | F.col("new").isNull(), "presence").when(~ok, "opaque").when(key.isNull(), "multiset").otherwise("keyed")
    return out.withColumn("key", key).withColumn("mode", mode).withColumn("fallback_reason", F.when(F.col("doubled"), "duplicate_key").otherwise(F.col("reason"))).drop("wanted", "reason", "doubled")


def keyed_changes(chosen: DataFrame, rows: DataFrame) -> DataFrame:
    """Rows added and removed, and cells changed in columns that both sides have."""
    meta = chosen.where("mode = 'keyed'").select("pair_id", "file", F.col("key").alias("key_columns"), F.array_intersect("old.header", "new.header").alias("common"))
    keyed = rows.join(meta, ["pair_id", "file"]).withColumn("key", F.transform("key_columns", lambda c: F.coalesce(F.try_element_at("cells", c), F.lit(""))))
    each = keyed.groupBy("pair_id", "file", "key", "common").agg(*[F.first(F.when(F.col("side") == x, F.col("cells")), ignorenulls=True).alias(x) for x in ("old", "new")])
    added = _shaped(each.where("old is null"), kind=F.lit("row_added"), key=F.col("key"), sort_key=F.col("key"), new_row=F.col("new"))
    removed = _shaped(each.where("new is null"), kind=F.lit("row_removed"), key=F.col("key"), sort_key=F.col("key"), old_row=F.col("old"))
    cells = F.filter(F.transform("common", lambda c: F.struct(c.alias("column"), F.element_at("old", c).alias("o"), F.element_at("new", c).alias("n"))), lambda x: ~x["o"].eqNullSafe(x["n"]))
    changed = each.where("old is not null and new is not null").select("pair_id", "file", "key", F.explode(cells).alias("c"))
    return added.unionByName(removed).unionByName(_shaped(changed, kind=F.lit("field_changed"), key=F.col("key"), sort_key=F.col("key"), column=F.col("c.column"), old_value=F.col("c.o"), new_value=F.col("c.n")))


def multiset_changes(chosen: DataFrame, rows: DataFrame) -> DataFrame:
    """Rows that one side holds more often than the other, over the columns of either; a missing column is empty."""
    meta = chosen.where("mode = 'multiset'").select("pair_id", "file", F.array_sort(F.array_union("old.header", "new.header")).alias("columns"))
    values = rows.join(meta, ["pair_id", "file"]).withColumn("values", F.transform("columns", lambda c: F.coalesce(F.try_element_at("cells", c), F.lit(""))))
    surplus = values.groupBy("pair_id", "file", "columns", "values").agg(F.sum(F.when(F.col("side") == "new", 1).otherwise(-1)).alias("n")).where("n <> 0")
    row = F.map_from_arrays("columns", "values")
    return _shaped(surplus, copies=F.abs("n"), kind=F.when(F.col("n") > 0, "row_added").otherwise("row_removed"), sort_key=F.col("values"), new_row=F.when(F.col("n") > 0, row), old_row=F.when(F.col("n") < 0, row))


def file_changes(chosen: DataFrame) -> DataFrame:
    """Files and columns that only one side has, and changed files that can't be read."""
    lone = chosen.where("mode = 'presence'")
    presence = _shaped(lone, kind=F.when(F.col("old").isNull(), "file_added").otherwise("file_removed"), rows=F.coalesce("old.row_count", "new.row_count"))
    opaque = _shaped(chosen.where("mode = 'opaque' and not (old.file_sha256 <=> new.file_sha256)"), kind=F.lit("file_changed_opaque"), old_value=F.col("old.file_sha256"), new_value=F.col("new.file_sha256"))
    read = chosen.where("mode in ('keyed', 'multiset')")
    only = lambda a, b: read.select("pair_id", "file", F.explode(F.array_except(f"{a}.header", f"{b}.header")).alias("c"))
    columns = _shaped(only("new", "old"), kind=F.lit("column_added"), column=F.col("c")).unionByName(_shaped(only("old", "new"), kind=F.lit("column_removed"), column=F.col("c")))
    return presence.unionByName(opaque).unionByName(columns)


def bulk(row_changes: DataFrame, threshold: int) -> DataFrame:
    """Row changes with those of files beyond the threshold summed up in one change a file."""
    changed = F.col("kind") == "field_changed"
    sizes = row_changes.groupBy("pair_id", "file").agg(
        *[F.coalesce(F.sum(F.when(F.col("kind") == k, F.col("copies"))), F.lit(0)).alias(n) for k, n in (("row_added", "added"), ("row_removed", "removed"))], F.count_distinct(F.when(changed, F.col("key"))).alias("changed_rows"), F.count_if(changed).alias("changed_cells")
    )
    large = sizes.where(~F.col("file").isin(*NEVER_BULK) & (F.col("added") + F.col("removed") + F.col("changed_rows") > threshold))
    summed = _shaped(large, kind=F.lit("rows_bulk"), counts=F.struct("added", "removed", "changed_rows", "changed_cells"))
    return row_changes.join(large.select("pair_id", "file"), ["pair_id", "file"], "left_anti").unionByName(summed)


def numbered(changes: DataFrame) -> DataFrame:
    """Changes with ids c0000001, c0000002, ... of each pair in order of file, kind, key and column, each copy its own row.

    Rows go to ranges of that order, cut by sampled splitters, so a file of any size is numbered by many tasks. A range
    numbers its rows from what the ranges before it hold of the same pair; copies are counted, and made at the end.
    """
    rank = F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind"))
    key = {"_r": rank, "_k": F.coalesce("sort_key", F.array().cast("array<string>")), "_c": F.coalesce("column", F.lit("")), "_o": F.coalesce("old_value", F.lit(""))}
    order = ["pair_id", "file", *key]
    ranged = cut(changes.select("*", *[c.alias(n) for n, c in key.items()]).repartitionByRange(*order).withColumn("_p", F.spark_partition_id()))
    sizes = ranged.groupBy("pair_id", "_p").agg(F.sum("copies").alias("_n"))
    up_to = lambda *by: W.partitionBy(*by).rowsBetween(W.unboundedPreceding, -1)
    before = sizes.select("pair_id", "_p", F.coalesce(F.sum("_n").over(up_to("pair_id").orderBy("_p")), F.lit(0)).alias("_before"))
    inside = F.coalesce(F.sum("copies").over(up_to("pair_id", "_p").orderBy(*order[1:], F.to_json("old_row"), F.to_json("new_row"))), F.lit(0))
    placed = ranged.withColumn("_inside", inside).join(before, ["pair_id", "_p"])
    each = placed.withColumn("_i", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    number = F.format_string("c%07d", F.col("_before") + F.col("_inside") + F.col("_i"))
    return each.withColumn("id", number).drop("_p", "_before", "_inside", "_i", "sort_key", "copies", *key)


def row_changes(pairs: DataFrame, files: DataFrame, rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(every row change with its copies, files of every pair); see raw_diff().

    Pairs and their files are written before rows meet them, so Spark knows their size and need not deal all rows of a
    publication or file to one task.
    """
    pairs = cut(pairs)
    each = sides(pairs, rows.select("uid", "file", "cells"))
    paired = cut(paired_files(pairs, files.select("uid", "file", "file_sha256", "status", "encoding", "header", "row_count", "ragged_rows")))
    chosen = cut(key_choice(paired, each))
    return keyed_changes(chosen, each).unionByName(multiset_changes(chosen, each)), chosen


def raw_diff(pairs: DataFrame, files: DataFrame, rows: DataFrame, config: Config | None = None) -> tuple[DataFrame, DataFrame]:
    """(changes, files of every pair with mode, key, reason and both sides' columns).

    pairs: pair_id, old_uid, new_uid; files: uid, file, file_sha256, status, encoding, header, row_count, ragged_rows; rows:
    uid, file, row_no, cells.
    """
    config = config or Config()
    changes, chosen = row_changes(pairs, files, rows)
    return numbered(file_changes(chosen).unionByName(bulk(cut(changes), config.bulk_threshold))), chosen


def file_counts(changes: DataFrame) -> DataFrame:
    """Changes of each pair and file by kind."""
    return changes.groupBy("pair_id", "file").pivot("kind", list(KINDS)).count().na.fill(0, list(KINDS))


def snapshot_diff(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Keyed differences of two snapshots of one table of strings: kind, key columns, column, old_value, new_value.

    Keys are unique on either side. Columns of only one side are ignored.
    """
    columns = [c for c in old.columns if c in new.columns and c not in keys]
    pack = lambda df, name: df.select(*keys, F.struct(*[F.col(c).cast("string").alias(c) for c in columns]).alias(name))
    both = pack(old, "_o").join(pack(new, "_n"), keys, "full_outer")
    cells = F.array(*[F.struct(F.lit("field_changed").alias("kind"), F.lit(c).alias("column"), F.col(f"_o.{c}").alias("old_value"), F.col(f"_n.{c}").alias("new_value")) for c in columns])
    row = lambda kind: F.array(F.struct(F.lit(kind).alias("kind"), F.lit("").alias("column"), F.lit(None).cast("string").alias("old_value"), F.lit(None).cast("string").alias("new_value")))
    found = F.when(F.col("_o").isNull(), row("row_added")).when(F.col("_n").isNull(), row("row_removed")).otherwise(F.filter(cells, lambda x: ~x["old_value"].eqNullSafe(x["new_value"])))
    return both.select(*keys, F.explode(found).alias("c")).select("c.kind", *keys, "c.column", "c.old_value", "c.new_value")


def positional_ids(df: DataFrame, order: list[str], name: str = "id") -> DataFrame:
    """df with ids c0000001, ... in the given total order, without a window over all rows.

    Rows go to ranges; a row's number is what the ranges before hold, of which the plan sees one row each, plus its place
    in its own range.
    """
    ranged = cut(df.repartitionByRange(*order).withColumn("_p", F.spark_partition_id()))
    sizes = ranged.groupBy("_p").count()
    before = sizes.withColumn("_b", F.coalesce(F.sum("count").over(W.orderBy("_p").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))).select("_p", "_b")
    n = F.col("_b") + F.row_number().over(W.partitionBy("_p").orderBy(*order))
    return ranged.join(F.broadcast(before), "_p").withColumn(name, F.format_string("c%07d", n)).drop("_p", "_b")
