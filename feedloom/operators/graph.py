"""Greedy one-to-one assignment and connected components as rounds over tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def cut(df: DataFrame) -> DataFrame:
    """df with its lineage cut by a table in the folder that the cluster shares; only a local session may do without one."""
    spark: SparkSession = df.sparkSession
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="feedloom-")
        spark.sparkContext.setCheckpointDir(base)
    path = f"{base.rstrip('/')}/feedloom/{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def greedy(candidates: DataFrame, group: list[str], left: list[str], right: list[str], order: list[str]) -> DataFrame:
    """The candidates that one-to-one assignment in the given order takes: each is taken if both its ends are free.

    `order` is total within a group. An edge that comes first for both its ends is taken whatever the others do, so a
    round takes all such edges at once and drops what touches them; a group needs as many rounds as its longest chain of
    edges that wait for each other.
    """
    sort = F.struct(*order)
    ends = ([*group, *left], [*group, *right])
    rest, taken = cut(candidates), None
    while not rest.isEmpty():
        first = rest
        for i, keys in enumerate(ends):
            least = rest.groupBy(*keys).agg(F.min(sort).alias(f"_m{i}"))
            first = first.join(least, keys)
        won = cut(first.where((sort == F.col("_m0")) & (sort == F.col("_m1"))).select(*candidates.columns))
        taken = won if taken is None else taken.unionByName(won)
        for keys in ends:
            rest = rest.join(won.select(*keys).distinct(), keys, "left_anti")
        rest = cut(rest.select(*candidates.columns))
    return taken if taken is not None else candidates.limit(0)


def _settled() -> Callable[[pd.DataFrame], pd.DataFrame]:
    """Assigns the members of classes whose edges are equal in order: each left member in turn takes the least right one."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        left, right, kinds = {}, {}, {}
        for r in rows.itertuples(index=False):
            left[r.old], right[r.new], kinds[r.old, r.new] = (r.uo, r.old_members), (r.un, r.new_members), r.kind
        near, at = {a: [b for x, b in kinds if x == a] for a in left}, {b: x[0] for b, x in right.items()}
        found = []
        for _, a, i in sorted((m, a, i) for a, (used, members) in left.items() for i, m in enumerate(members) if i >= used):
            open_ = [(right[b][1][at[b]], b) for b in near[a] if at[b] < len(right[b][1])]
            if open_:
                b = min(open_)[1]
                found.append((a, b, kinds[a, b], i, at[b], 1))
                at[b] += 1
        return pd.DataFrame(found, columns=["old", "new", "kind", "uo", "un", "m"])

    return run


def greedy_classes(edges: DataFrame, old: DataFrame, new: DataFrame, group: list[str], order: list[str]) -> DataFrame:
    """One-to-one assignment of the members of classes: old, new, kind, uo, un, m (so many members from these places on).

    edges: group, old, new (ids of classes), kind and order; old and new: id and its sorted members. Edges between members
    come in `order`, then by the left member, then by the right one, so two classes whose edge comes first for both give each
    other members in step, all at once. Classes that several edges of one order join wait until each of those comes first
    for its ends, and are settled member by member. Members of a class are always taken in order, so a count tells who is free.
    """
    size = lambda df, c, n: df.select(F.col("id").alias(c), F.size("members").cast("long").alias(n))
    zero = F.lit(0).cast("long")
    rest = cut(edges.join(size(old, "old", "no"), "old").join(size(new, "new", "nn"), "new").withColumn("uo", zero).withColumn("un", zero))
    names, key, taken = rest.columns, F.struct(*order), None
    while not rest.isEmpty():
        first = rest
        for end in ("old", "new"):
            first = first.join(rest.groupBy(end).agg(F.min(key).alias(f"_m{end}")), end)
        first = first.withColumn("_first", (key == F.col("_mold")) & (key == F.col("_mnew")))
        ready = first.groupBy(*group, *order).agg(F.bool_and("_first").alias("_ready"), F.count("*").alias("_e")).where("_ready").drop("_ready")
        ready = cut(first.where("_first").join(ready, [*group, *order]).select(*names, "_e"))
        won = ready.where("_e = 1").select("old", "new", "kind", "uo", "un", F.least(F.col("no") - F.col("uo"), F.col("nn") - F.col("un")).alias("m"))
        ties = ready.where("_e > 1")
        if not ties.isEmpty():
            members = lambda df, c: df.select(F.col("id").alias(c), F.col("members").alias(f"{c}_members"))
            ties = ties.join(members(old, "old"), "old").join(members(new, "new"), "new")
            won = won.unionByName(ties.groupBy(*group, *order).applyInPandas(_settled(), "old long, new long, kind string, uo long, un long, m long"))
        won = cut(won)
        taken = won if taken is None else taken.unionByName(won)
        for end, used in (("old", "uo"), ("new", "un")):
            more = won.groupBy(end).agg(F.sum("m").alias("_more"))
            rest = rest.join(more, end, "left").withColumn(used, F.col(used) + F.coalesce("_more", zero)).drop("_more")
        rest = cut(rest.where("uo < no and un < nn").select(*names))
    return taken if taken is not None else rest.select("old", "new", "kind", "uo", "un", F.col("no").alias("m"))


def components(edges: DataFrame, group: list[str] | None = None) -> DataFrame:
    """(group, node, root) for every node of the edges (group, a, b); root is the smallest node of its component.

    Labels spread to neighbours and then jump to their label's label, so paths shrink by half a round.
    """
    group = group or []
    both = cut(edges.select(*group, "a", "b").unionByName(edges.select(*group, F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = cut(both.groupBy(*group, F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("node")).alias("root")))
    while True:
        spread = both.join(labels.withColumnRenamed("node", "b"), [*group, "b"]).groupBy(*group, F.col("a").alias("node")).agg(F.min("root").alias("near"))
        new = labels.join(spread, [*group, "node"]).select(*group, "node", "root", F.least("root", "near").alias("low"))
        jump = new.select(*group, F.col("node").alias("low"), F.col("low").alias("further"))
        new = cut(new.join(jump, [*group, "low"], "left").select(*group, "node", "root", F.least("low", F.coalesce("further", "low")).alias("new")))
        moved = new.where("new <> root").limit(1).count()
        labels = new.select(*group, "node", F.col("new").alias("root"))
        if not moved:
            return labels
