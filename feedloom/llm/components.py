"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.llm.common import files_for, written


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node with an edge; root is the smallest node of its component.

    `edges` has columns u and v of type long. Loops and repeated edges do no harm. Every round writes its edges to the
    shared folder, so a lost executor costs one round at most; what the driver sees is a count and a checksum.
    """
    edges = written(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    before = None
    while True:
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before or not state[0]:
            break
        before = state
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        smallest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(smallest, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
        edges = written(small.where("u <> v").distinct(), "edges", files_for(state[0]))  # a round makes no edges
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest member of every node's component, for n nodes of one task."""
    label = np.arange(n)
    while len(a):
        low, high = np.minimum(label[a], label[b]), np.maximum(label[a], label[b])
        open_ = low < high
        if not open_.any():
            break
        a, b = a[open_], b[open_]
        np.minimum.at(label, high[open_], low[open_])
        while True:
            jumped = label[label]
            if (jumped == label).all():
                break
            label = jumped
    return label
