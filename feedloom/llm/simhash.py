"""SimHash near-duplicates by tiled exact comparison.

Distinct fingerprints are dealt into tiles by their population count. Two fingerprints within the radius have population
counts within it, so only such tile pairs meet; within a pair, rows are sorted into small tiles by the population counts
of their four quarters, whose differences sum to no more than the distance, and small tiles further apart are skipped
too. What is left is compared whole with exclusive-or and bit counts, so no link is lost. A task returns a spanning
forest of what it found, not all pairs. Comparisons still grow with the square of the number of distinct fingerprints.

A fingerprint has 64 bits or a multiple. One bit differs between two texts with probability angle / pi, where the angle is
that between their shingle counts; so a wide fingerprint measures similarity, and the radius stands for a threshold.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.llm.common import at_space, chunks, files_for, keyed, mixed, pieces, ranges, released, text_bytes, text_of, written
from feedloom.llm.components import components, forest
from feedloom.llm.words import words_of
from feedloom.llm.xxh import xxh64

TILE = 16_384
#: Elements of a block of comparisons; its temporary arrays stay in a core's cache.
BLOCK = 1 << 16
#: Bits of a fingerprint that measures similarity.
WIDE = 256
#: Bytes of text handled at once.
SHINGLE_CHUNK = 1 << 19
#: Places in which the rows of one fingerprint or group meet what is known of it.
SPREAD = 64
SALTS = np.random.Generator(np.random.PCG64(20240806)).integers(1, 1 << 63, 64, dtype=np.uint64)


def radius_for(similar: float, bits: int = WIDE, spread: float = 2.0) -> int:
    """Bits in which two texts differ at most whose sets of shingles have this Jaccard similarity, but for one in fifty.

    Sets with similarity s have the cosine 2s / (1 + s) at equal sizes; the number of differing bits is binomial.
    """
    chance = math.acos(2 * similar / (1 + similar)) / math.pi
    return math.floor(bits * chance + spread * math.sqrt(bits * chance * (1 - chance)))


def _counts(data: np.ndarray, offs: np.ndarray, shingle: int, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(shingles that set each bit, shingles, words) of every row; a row of fewer words is one shingle, without words none."""
    words = words_of(data, offs)
    counts = words.counts
    number = np.where(counts > 0, np.maximum(counts - shingle + 1, 1), 0)
    first = ranges(words.rows[:-1], number)
    out = np.zeros((len(counts), bits), np.int32)
    if len(first):
        last = np.minimum(first + shingle - 1, np.repeat(words.rows[1:], number) - 1)
        begin = words.begin[first]
        hashes = xxh64(words.data, begin, words.begin[last] + words.size[last] - begin)
        some = np.flatnonzero(number)
        at = (np.cumsum(number) - number)[some]
        for i in range(bits // 64):
            lane = hashes if i == 0 else mixed(hashes ^ SALTS[i])
            set_ = np.unpackbits(lane.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            out[some, 64 * i : 64 * i + 64] = np.add.reduceat(set_, at, axis=0, dtype=np.int32)
    return out, number, counts


def _counts_of_long(data: np.ndarray, shingle: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """_counts of one text of any length, piece by piece; a piece begins with the last words of the one before it."""
    total, number, before = np.zeros((1, bits), np.int64), 0, np.zeros(0, np.uint8)
    cuts = pieces(data, np.array([0, len(data)]), at_space, SHINGLE_CHUNK)
    for a, b in zip(cuts, cuts[1:], strict=False):
        part = np.concatenate([before, data[a:b]])
        edges = np.array([0, len(part)])
        words = words_of(part, edges)
        if len(words.begin) >= shingle:
            some, n, _ = _counts(part, edges, shingle, bits)
            total, number = total + some, number + int(n[0])
            words.begin, words.size = words.begin[len(words.begin) - shingle + 1 :], words.size[len(words.begin) - shingle + 1 :]
            before = words.data[words.begin[0] :] if shingle > 1 else before
        else:
            before = words.data
    if not number:
        total, n, _ = _counts(before, np.array([0, len(before)]), shingle, bits)
        number = int(n[0])
    return total, np.array([number])


def fingerprints_of(data: np.ndarray, offs: np.ndarray, shingle: int = 3, bits: int = 64) -> np.ndarray:
    """The fingerprint of every row, bits / 64 numbers; zero without words."""
    if len(offs) == 2 and len(data) > 2 * SHINGLE_CHUNK:
        sums, number = _counts_of_long(data, shingle, bits)
    else:
        sums, number, _ = _counts(data, offs, shingle, bits)
    return np.packbits(2 * sums > number[:, None], axis=1, bitorder="little").view("<u8").reshape(len(number), bits // 64)


def fingerprints(docs: DataFrame, shingle: int = 3, text: str = "text", bits: int = 64) -> DataFrame:
    """doc_id, dk and fp (the fingerprint: an array of signed longs, or one signed long if it has 64 bits) of every row."""
    width = bits // 64

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = chunks(*text_bytes(batch.column(2)), SHINGLE_CHUNK)
            made = [fingerprints_of(data, offs, shingle, bits) for _, _, data, offs in parts]
            flat = pa.array((np.concatenate(made) if made else np.zeros(0, np.uint64)).ravel().view(np.int64))
            if width > 1:
                flat = pa.ListArray.from_arrays(pa.array(np.arange(batch.num_rows + 1) * width, pa.int32()), flat)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), flat], ["doc_id", "dk", "fp"])

    return keyed(docs, text=text).mapInArrow(released(run), f"doc_id long, dk long, fp {'array<bigint>' if width > 1 else 'long'}")


def _quarters(x: np.ndarray) -> np.ndarray:
    """Population counts of the four quarters of each row of x."""
    if x.shape[1] == 1:
        return np.bitwise_count(x.view(np.uint16).reshape(-1, 4)).astype(np.int64)
    counts = np.bitwise_count(x).astype(np.int64)
    return np.stack([part.sum(axis=1) for part in np.array_split(counts, 4, axis=1)], axis=1)


def _hits(home: np.ndarray, other: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of home and of other, transposed tables of words, that differ in at most `radius` bits."""
    if len(home) == 1:
        return np.nonzero(np.bitwise_count(home[0][:, None] ^ other[0][None, :]) <= radius)
    near = np.bitwise_count(home[0][:, None] ^ other[0][None, :]) + np.bitwise_count(home[1][:, None] ^ other[1][None, :])
    x, y = np.nonzero(near <= radius)
    if len(home) > 2 and len(x):
        whole = near[x, y].astype(np.int64)
        for i in range(2, len(home)):
            whole += np.bitwise_count(home[i][x] ^ other[i][y])
        x, y = x[whole <= radius], y[whole <= radius]
    return x, y


def compare(left: np.ndarray, right: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """(place, place of the smallest member of its group) of all rows that links between or, if both are one array, within
    the tables connect to others; places count through left and then right."""
    same = right is left
    count = len(left) if same else len(left) + len(right)
    orders = [np.lexsort(_quarters(x).T[::-1]) for x in ((left,) if same else (left, right))]
    sorted_ = [x[o] for x, o in zip((left, right), orders, strict=False)]
    tiles = []
    for x in sorted_:
        q = _quarters(x)
        cut = np.flatnonzero(np.r_[True, (q[1:] != q[:-1]).any(axis=1)]) if len(q) else np.zeros(0, np.int64)
        tiles.append((q[cut], cut, np.diff(np.append(cut, len(q)))))
    (lq, lcut, lsize), (rq, rcut, rsize) = tiles[0], tiles[-1]
    a, b = (np.ascontiguousarray(x.T) for x in (sorted_[0], sorted_[-1]))
    a_at, b_at = orders[0], orders[-1] + (0 if same else len(left))
    label = np.arange(count)
    found_a, found_b, held = [], [], 0

    def settle() -> None:
        nonlocal label, held
        x, y = (np.concatenate(z) for z in (found_a, found_b))
        old = label
        label = forest(count, np.concatenate([x, np.arange(count)]), np.concatenate([y, old]))
        found_a.clear()
        found_b.clear()
        held = 0

    # wide fingerprints have hardly any two rows of equal quarters, so small tiles would be single rows
    groups = len(lq) if a.shape[0] == 1 else -(-a.shape[1] // 64)
    for i in range(groups):
        if a.shape[0] == 1:
            near = np.flatnonzero(np.abs(rq - lq[i]).sum(axis=1) <= radius)
            near = near[near >= i] if same else near
            cols = ranges(rcut[near], rsize[near])
            rows = np.arange(lcut[i], lcut[i] + lsize[i])
        else:
            rows = np.arange(64 * i, min(64 * i + 64, a.shape[1]))
            cols = np.arange(64 * i if same else 0, b.shape[1])
        block = max(1, BLOCK // max(len(rows), 1))
        for at in range(0, len(cols), block):
            some = cols[at : at + block]
            wide = max(1, BLOCK // max(len(some), 1))
            for top in range(0, len(rows), wide):
                x, y = _hits(a[:, rows[top : top + wide]], b[:, some], radius)
                u, v = a_at[rows[top + x]], b_at[some[y]]
                keep = label[u] != label[v]
                if keep.any():
                    found_a.append(u[keep])
                    found_b.append(v[keep])
                    held += int(keep.sum())
                if held > 200_000:
                    settle()
    if held:
        settle()
    root = forest(count, np.arange(count), label)
    linked = np.flatnonzero(root != np.arange(count))
    return linked, root[linked]


def links(nodes: DataFrame, radius: int = 3) -> DataFrame:
    """Edges u, v of nodes (columns node and fp) that join all distinct fingerprints that links connect."""
    wide = dict(nodes.dtypes)["fp"] != "bigint"
    bits, reach = F.bit_count("fp").cast("int"), radius
    if wide:  # one count alone has few rows, so counts share tiles by bands as wide as the radius
        bits = F.floor(F.aggregate("fp", F.lit(0), lambda n, x: n + F.bit_count(x)) / (radius + 1)).cast("int")
        reach = 1
    # at most one row for each population count
    sizes = {r["p"]: -(-r["count"] // TILE) for r in nodes.groupBy(bits.alias("p")).count().collect()}
    if not sizes:
        return nodes.select(F.col("node").alias("u"), F.col("node").alias("v"))
    spark = nodes.sparkSession
    base, total = {}, 0
    for p in sorted(sizes):
        base[p], total = total, total + sizes[p]
    known = spark.createDataFrame([(p, base[p], sizes[p]) for p in sizes], "p int, base long, tiles long")
    tile = (F.col("base") + F.pmod(F.xxhash64("node"), "tiles")).alias("tile")
    tiled = nodes.select("node", "fp", bits.alias("p")).join(F.broadcast(known), "p").select("node", "fp", "p", tile)
    packed = tiled.groupBy("tile", "p").agg(F.collect_list(F.struct("node", "fp")).alias("rows"))
    each = known.select(F.col("p").alias("q"), F.col("base").alias("b"), F.col("tiles").alias("t"))
    others = F.explode(F.sequence("b", F.col("b") + F.col("t") - 1)).alias("other")
    partner = known.join(F.broadcast(each), F.col("q").between(F.col("p"), F.col("p") + reach)).select("p", others)
    pairs = packed.select("tile", "p").join(partner, "p").where("other >= tile").select("tile", "other")
    both = pairs.join(packed.select("tile", F.col("rows").alias("x")), "tile")
    both = both.join(packed.select(F.col("tile").alias("other"), F.col("rows").alias("y")), "other")
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), min(total * 4, 20_000))

    def table(rows: pa.Scalar) -> tuple[np.ndarray, np.ndarray]:
        names, fps = rows.values.flatten()
        fps = fps.flatten() if wide else fps
        return names.to_numpy(), np.ascontiguousarray(fps.to_numpy()).view(np.uint64).reshape(len(names), -1)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                same = batch.column(0)[i].as_py() == batch.column(1)[i].as_py()
                names, x = table(batch.column(2)[i])
                y = x
                if not same:
                    more, y = table(batch.column(3)[i])
                    names = np.concatenate([names, more])
                u, v = compare(x, y, radius)
                yield pa.RecordBatch.from_arrays([pa.array(names[u]), pa.array(names[v])], ["u", "v"])

    return both.select("tile", "other", "x", "y").repartition(parts, "tile", "other").mapInArrow(released(run), "u long, v long")


def near_duplicates(docs: DataFrame, radius: int = 3, shingle: int = 3, text: str = "text", bits: int = 64) -> DataFrame:
    """doc_id, dk, fp and component_id (the smallest doc_id that links reach) for every row.

    Null and empty texts and texts of white space have fingerprint zero and are linked like any other. Null ids don't
    count for component_id unless the component has no other, when it is null. Repeated rows link by distance 0. Texts are
    whole, of any length: a long one goes through piece by piece. Other columns are not read, so their names may clash; an
    empty table gives no rows. `node` names a distinct fingerprint: itself, or for wide ones the least dk that has it.
    """
    rows = written(fingerprints(docs, shingle, text, bits), "fingerprints")
    node = F.first("fp") if bits == 64 else F.min("dk")
    distinct = written(rows.groupBy("fp").agg(F.min("doc_id").alias("first"), node.alias("node")), "distinct-fingerprints", files_for(rows.count()))
    roots = components(links(distinct.select("node", "fp"), radius)).withColumnRenamed("node", "linked")
    rooted = distinct.join(roots, F.col("node") == F.col("linked"), "left").select("fp", "first", F.coalesce("root", "node").alias("root"))
    smallest = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named = rooted.join(smallest, "root").select("fp", "root", "component_id")
    # the rows of a frequent text meet its name in SPREAD places, not in one
    part = F.pmod("dk", F.lit(SPREAD)).cast("short").alias("part")
    spread = rows.select("doc_id", "dk", "fp", part)
    placed = spread.select("fp", "part").distinct().join(named, "fp")
    return spread.join(placed, ["fp", "part"]).select("doc_id", "dk", "fp", "component_id", "root")


def hex_of(fp: str = "fp") -> F.Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def keep_one(docs: DataFrame, similar: float = 0.8, shingle: int = 5, text: str = "text", bits: int = WIDE) -> DataFrame:
    """docs with one row of each group of near-duplicates: that of the smallest id (null last), then of the smallest hash.

    Texts are linked whose wide fingerprints over `shingle` words differ in at most radius_for(similar) bits. The others of
    docs' columns may have any names. Of rows that repeat id and text one stays.
    """
    found = near_duplicates(docs, radius_for(similar, bits), shingle, text, bits)
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "dk")
    gone = found.groupBy("root").agg(F.min(order).alias("m")).select("root", F.col("m.dk").alias("stays"))
    # the rows of a large group meet the one that stays in SPREAD places
    part = F.pmod("dk", F.lit(SPREAD)).cast("short").alias("part")
    rows = found.select("doc_id", "dk", "root", part)
    placed = rows.select("root", "part").distinct().join(gone, "root")
    a, b = (f"{x}_{uuid.uuid4().hex}" for x in "ab")
    drop = rows.join(placed, ["root", "part"]).where("dk <> stays").select(F.col("doc_id").alias(a), F.col("dk").alias(b)).distinct()
    key = F.xxhash64(F.col("doc_id").cast("long"), text_of(text))
    left = docs.join(drop, F.col("doc_id").cast("long").eqNullSafe(F.col(a)) & (key == F.col(b)), "left_anti")
    again = found.groupBy(F.col("dk").alias(a)).count().where("count > 1").select(a)  # rows that repeat id and text
    once = left.join(again, key == F.col(a), "left_semi").withColumn(b, key).dropDuplicates([b]).drop(b)
    return left.join(again, key == F.col(a), "left_anti").unionByName(once)
