"""Exact top-k by inner product with multi-resolution segment statistics.

A vector's coordinates are cut into 1, 2, 4, ... segments; each keeps its mean and deviation. With lengths L these bound
the distance of two vectors from below by sum L((m - m')^2 + (s - s')^2), hence, with the norms, their inner product from
above. A block of queries meets a block of candidates: the bounds are taken coarse to fine, each level only for the
pairs that the level before left, and the exact product only for those that the last one leaves.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

LEVELS = (1, 2, 4, 8, 16)
QUERIES, CANDIDATES = 1024, 4096
SCALE = 256


def whole_vectors(table: DataFrame, vector: str = "embedding") -> DataFrame:
    """vec_id and floor(256 * component) of the rows whose vector, components and id are neither null nor non-finite."""
    x = F.col(vector).cast("array<double>")
    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return table.select(F.col("vec_id").cast("long").alias("vec_id"), F.when(x.isNotNull() & ~bad, F.transform(x, lambda c: F.floor(c * SCALE))).alias("v")).where("vec_id is not null and v is not null")


def statistics(x: np.ndarray, levels: tuple[int, ...] = LEVELS) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each level: segment means and deviations, both times the root of the segments' lengths, and the lengths."""
    out, size = [], x.shape[1]
    for n in sorted({min(n, size) for n in levels if size}):
        cuts = np.linspace(0, size, n + 1).astype(int)
        length = np.diff(cuts).astype(np.float64)
        mean = np.add.reduceat(x, cuts[:-1], axis=1) / length
        spread = np.sqrt(np.maximum(np.add.reduceat(x * x, cuts[:-1], axis=1) / length - mean * mean, 0))
        out.append((mean * np.sqrt(length), spread * np.sqrt(length), length))
    return out


def search(queries: np.ndarray, ids: np.ndarray, candidates: np.ndarray, names: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(query, candidate id, score) of the k best of each query in a block, and how many exact products it took.

    Ties at the k-th place go to the smaller id; a query does not meet a row of its own id. Only pairs whose bound is
    below the k-th best score so far are left out, so no pair that ties with it is.
    """
    order = np.argsort(names, kind="stable")
    candidates, names = candidates[order], names[order]
    qs, cs = statistics(queries), statistics(candidates)
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    exact = 0
    longest = float(np.sqrt((candidates**2).sum(axis=1).max())) if len(candidates) else 0.0
    for i in range(len(queries)):
        own = names != ids[i]
        left = np.flatnonzero(own)
        if not len(left):
            continue
        slack = 1e-9 * (1 + float(np.linalg.norm(queries[i])) * longest)
        bounds = None
        floor = -np.inf
        for (qm, qd, _), (cm, cd, _) in zip(qs, cs, strict=True):
            bounds = cm[left] @ qm[i] + cd[left] @ qd[i] + slack
            if floor == -np.inf and len(left) > k:  # the exact scores of the most promising give the first threshold
                top = left[np.argpartition(-bounds, k - 1)[: 4 * k]]
                floor = np.partition(candidates[top] @ queries[i], -k)[-k] if len(top) >= k else -np.inf
                exact += len(top)
            left = left[bounds >= floor]
        scores = candidates[left] @ queries[i]
        exact += len(left)
        best = np.lexsort((names[left], -scores))[:k]
        found.append((np.full(len(best), ids[i]), names[left[best]], scores[best].astype(np.int64)))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), exact
    return *(np.concatenate(x) for x in zip(*found, strict=True)), exact


def top_k(table: DataFrame, k: int = 5, every: int = 50, vector: str = "embedding") -> DataFrame:
    """The k rows of highest integer inner product for each row whose vec_id is divisible by `every`.

    Returns query_id, rank (from 1), vec_id, score. Ties go to the smaller id; a query does not meet rows of its own id; a
    query with fewer candidates gets all. Vectors that are null or hold null or non-finite components and rows without
    id take no part. Vectors of different lengths meet as if zeros followed the shorter one. Rows that repeat an id are
    candidates each for other queries, and the query of that id is the first of them by its vector. Other columns are not read.

    Queries and candidates are packed into blocks (of 1024 and 4096 rows by a hash of the row, so no key makes one block
    large); each candidate block goes once to every query block. Partial results are k rows per query and block.
    """
    spark = table.sparkSession
    rows = whole_vectors(table, vector)
    # two counts size the blocks; they are all that the driver sees
    n, asked = rows.agg(F.count("*"), F.count_if(F.pmod("vec_id", F.lit(every)) == 0)).first()
    blocks, groups = max(1, -(-n // CANDIDATES)), max(1, -(-asked // QUERIES))
    pack = F.collect_list(F.struct("vec_id", "v")).alias("rows")
    part = lambda m: F.pmod(F.xxhash64("vec_id", "v"), F.lit(m)).cast("int")
    queries = rows.where(F.pmod("vec_id", F.lit(every)) == 0).groupBy("vec_id").agg(F.min("v").alias("v")).groupBy(part(groups).alias("g")).agg(pack)
    candidates = rows.groupBy(part(blocks).alias("b")).agg(pack).withColumn("g", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    pairs = candidates.withColumnRenamed("rows", "c").join(queries.withColumnRenamed("rows", "q"), "g").select("b", "g", "q", "c").repartition(blocks * groups, "b", "g")

    def matrix(cell: pa.Scalar) -> tuple[np.ndarray, np.ndarray]:
        values = cell.values
        lists = values.field("v")
        sizes = np.diff(lists.offsets.to_numpy())
        x = np.zeros((len(sizes), int(sizes.max(initial=0))), np.float64)
        x[np.arange(x.shape[1]) < sizes[:, None]] = lists.flatten().to_numpy(zero_copy_only=False)
        return x, values.field("vec_id").to_numpy(zero_copy_only=False)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                (q, ids), (c, names) = matrix(batch.column(2)[i]), matrix(batch.column(3)[i])
                width = max(q.shape[1], c.shape[1])
                q, c = (np.pad(x, ((0, 0), (0, width - x.shape[1]))) for x in (q, c))
                a, b, score, _ = search(q, ids, c, names, k)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(score, pa.int64())], ["query_id", "vec_id", "score"])

    del spark
    partial = pairs.mapInArrow(run, "query_id long, vec_id long, score long")
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return partial.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
