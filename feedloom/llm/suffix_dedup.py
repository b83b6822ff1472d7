"""Exact removal of repeated byte strings with a partitioned, sparse suffix array.

A byte is removed if some string of `width` bytes (100) that covers it also starts earlier in the corpus: in a document
with a smaller id, or before in the same one. Strings are judged on the input.

Sorting every suffix would move many times the input, so the array is sparse. Each window of `width` bytes has one
anchor, the leftmost of its grams of 37 bytes with the smallest hash; equal windows have equal anchors at the same place,
so only suffixes that start at anchors (some 3 in 100 bytes) are sorted, each standing for the run of windows it anchors.

1. Map: anchors go to range partitions by their suffix's leading bytes, split by sampled splitters (ties in the leading
   bytes by the gram's hash, so frequent beginnings spread). Of the runs with equal whole context that a batch holds,
   only the first goes on, so a passage that a third of all documents share reaches its partition once a batch.
2. Buckets: of all anchors with one gram and equal whole context every run but the first is a repetition. Runs whose
   gram occurs with other contexts too are decided in step 4.
3. Those contexts are cut from the texts and sent to their bucket.
4. Buckets sort the windows of such contexts by multikey quicksort, eight bytes a key, and compare neighbours. Splitters
   never part equal grams, so equal windows can't lie on two sides of a boundary between buckets; slices of one bucket
   end between grams for the same reason.
5. Texts meet their runs, and the covered bytes go.

Texts cross the network once: steps 3 and 5 read the same exchange. Grams and whole contexts are compared by 64-bit hashes
each (both have to agree), the windows of step 4 by their bytes.
"""

from __future__ import annotations

import struct
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.llm.common import CHUNK, Rolling, chunks, keyed, mixed, ranges, released, text_bytes

WIDTH, GRAM, SPAN = 100, 37, 64
#: Bytes of text for each partition.
PART = 12 << 20
#: Documents whose anchors are sampled for splitters. It sets only how even the buckets are.
SAMPLED = 2000
#: Windows sorted at once.
SLICE = 150_000
NONE = np.iinfo(np.int64).min
DECIDED, ANCHORS, CONTEXTS = range(3)
RUNS = (("doc", "<i8"), ("dk", "<i8"), ("lo", "<u4"), ("n", "u1"))
RECORDS = (("g", "<u8"), ("x", "<u8"), *RUNS)
CANDIDATES = (("g", "<u8"), *RUNS)
ROWS = "at int, kind int, bucket int, blob binary"
SCHEMA = pa.schema([("at", pa.int32()), ("kind", pa.int32()), ("bucket", pa.int32()), ("blob", pa.binary())])


def pack(fields: tuple, columns: dict[str, np.ndarray], rows: np.ndarray | slice = slice(None), extra: bytes = b"") -> bytes:
    """The columns one after the other, ids and places as differences, compressed."""
    out, n = [], 0
    for name, kind in fields:
        x = columns[name][rows].astype(kind)
        n = len(x)
        out.append((np.diff(x, prepend=x.dtype.type(0)) if name in ("doc", "lo") else x).tobytes())
    return struct.pack("<I", n) + zstandard.compress(b"".join(out) + extra, 1)


def unpack(fields: tuple, blob: bytes) -> tuple[dict[str, np.ndarray], bytes]:
    n, data, at, out = struct.unpack("<I", blob[:4])[0], zstandard.decompress(blob[4:]), 0, {}
    for name, kind in fields:
        x = np.frombuffer(data, kind, n, at)
        at += x.nbytes
        out[name] = np.cumsum(x, dtype=x.dtype) if name in ("doc", "lo") else x
    return out, data[at:]


def joined(fields: tuple, parts: list[dict[str, np.ndarray]]) -> dict[str, np.ndarray]:
    return {name: np.concatenate([p[name] for p in parts]) if parts else np.zeros(0, kind) for name, kind in fields}


def anchors_of(data: np.ndarray, offs: np.ndarray) -> dict[str, np.ndarray]:
    """anchors, of rows of any length: a long one goes piece by piece, each with the bytes that its last windows need."""
    if len(offs) != 2 or len(data) <= 2 * CHUNK:
        return anchors(data, offs)
    made = []
    for at in range(0, len(data), CHUNK):
        part = data[at : at + CHUNK + WIDTH - 1]
        made.append(anchors(part, np.array([0, len(part)])))
        made[-1]["lo"] = made[-1]["lo"] + at
    return {k: np.concatenate([m[k] for m in made]) for k in made[0]}


def anchors(data: np.ndarray, offs: np.ndarray) -> dict[str, np.ndarray]:
    """The anchors of all windows in the rows: gram g, whole context x, row, first window's place in it, windows, key.

    The key orders anchors by five leading bytes of their suffix and then by the gram's hash.
    """
    count = len(data) - WIDTH + 1
    if count <= 0:
        return {k: np.zeros(0, t) for k, t in (("g", "u8"), ("x", "u8"), ("row", "i8"), ("lo", "i8"), ("n", "i8"), ("key", "u8"))}
    hashes = Rolling(data)
    grams = hashes.windows(GRAM)
    low, place, step = grams, np.arange(len(grams), dtype=np.int32), 1
    while step < SPAN:  # the smallest and its leftmost place in runs of 2, 4, ... 64
        right = low[step:] < low[:-step]
        low, place = np.where(right, low[step:], low[:-step]), np.where(right, place[step:], place[:-step])
        step *= 2
    sizes = np.diff(offs)
    windows = np.maximum(sizes - WIDTH + 1, 0)
    at = ranges(offs[:-1], windows)
    p = place[at]
    new = np.ones(len(at), bool)
    new[1:] = p[1:] != p[:-1]
    firsts = np.cumsum(windows) - windows
    new[firsts[windows > 0]] = True
    begin = np.flatnonzero(new)
    lo, n, p = at[begin], np.diff(np.append(begin, len(at))), p[begin].astype(np.int64)
    row = np.searchsorted(offs, lo, "right") - 1
    g = grams[p]
    key = np.zeros(len(p), np.uint64)
    for i in range(5):
        key = key << np.uint64(8) | data[p + i]
    return {"g": g, "x": hashes.span(lo, lo + n - 1 + WIDTH), "row": row, "lo": lo - offs[row], "n": n, "key": key << np.uint64(24) | g >> np.uint64(40)}


def order_of(columns: dict[str, np.ndarray], *first: str) -> np.ndarray:
    return np.lexsort((columns["lo"], columns["dk"], columns["doc"], *(columns[k] for k in reversed(first))))


def changes(columns: dict[str, np.ndarray], *names: str) -> np.ndarray:
    """Which rows differ from the one before in any of the columns."""
    n = len(columns[names[0]])
    out = np.ones(n, bool)
    if n:
        out[1:] = np.logical_or.reduce([columns[k][1:] != columns[k][:-1] for k in names])
    return out


def multikey_order(words: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, run of equal rows of each sorted row) by group and then word after word; ties keep their order.

    Multikey quicksort with whole words as keys: rows that a word tells apart are done, the others go on to the next.
    """
    n = len(group)
    order = np.argsort(group, kind="stable")
    split = np.ones(n, bool)
    split[1:] = group[order][1:] != group[order][:-1]
    for word in range(words.shape[1]):
        run = np.cumsum(split)
        sizes = np.bincount(run)
        open_ = np.flatnonzero(sizes[run] > 1)
        if not len(open_):
            break
        values = words[order[open_], word]
        inner = np.lexsort((values, run[open_]))
        order[open_] = order[open_][inner]
        values = values[inner]
        split[open_[1:]] |= (values[1:] != values[:-1]) & (run[open_][1:] == run[open_][:-1])
    return order, np.cumsum(split)


def repeated_windows(texts: np.ndarray, offs: np.ndarray, c: dict[str, np.ndarray], limit: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(context, window in it) of all windows that have an equal one before them among contexts in corpus order.

    At most about `limit` (SLICE) windows are held as bytes at once, however many one gram has.
    """
    limit = limit or SLICE
    context = np.repeat(np.arange(len(c["n"])), c["n"])
    inside = ranges(np.zeros(len(c["n"]), np.int64), c["n"])
    if not len(context):
        return context, inside
    if len(context) <= limit:
        again = _again(texts, offs[context] + inside, c["g"][context])
        return context[again], inside[again]
    # equal windows agree in some of their bytes, so classes by these can be sorted one after the other
    eight = np.ndarray((len(texts) - 7,), "<u8", texts.tobytes(), strides=(1,))
    kind = np.zeros(len(context), np.uint64)
    for skip in (0, 31, 62, WIDTH - 8):
        kind = mixed(kind ^ eight[offs[context] + inside + skip])
    kind = kind % np.uint64(-(-len(context) // limit) * 2)
    found = []
    for k in np.unique(kind):
        some = np.flatnonzero(kind == k)
        found.append(some[_again(texts, offs[context[some]] + inside[some], c["g"][context[some]])])
    again = np.sort(np.concatenate(found))
    return context[again], inside[again]


def _again(texts: np.ndarray, at: np.ndarray, group: np.ndarray) -> np.ndarray:
    """Which of the windows that begin at these places have an equal one of their group before them, in order."""
    words = -(-WIDTH // 8)
    rows = np.zeros((len(at), words * 8), np.uint8)
    rows[:, :WIDTH] = np.lib.stride_tricks.sliding_window_view(texts, WIDTH)[at]
    order, run = multikey_order(rows.view(">u8"), group)
    return np.sort(order[1:][run[1:] == run[:-1]])


def runs_of(context: np.ndarray, inside: np.ndarray, c: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """Neighbouring windows as runs of a first one and a number."""
    new = np.ones(len(context), bool)
    if len(context):
        new[1:] = (context[1:] != context[:-1]) | (inside[1:] != inside[:-1] + 1)
    begin = np.flatnonzero(new)
    at = context[begin]
    return {"doc": c["doc"][at], "dk": c["dk"][at], "lo": c["lo"][at] + inside[begin], "n": np.diff(np.append(begin, len(context)))}


def spans_of(lo: np.ndarray, n: np.ndarray) -> np.ndarray:
    """[begin, end) of the maximal runs of bytes that the windows cover."""
    if not len(lo):
        return np.zeros((0, 2), np.int64)
    order = np.argsort(lo, kind="stable")
    begin, end = lo[order].astype(np.int64), np.maximum.accumulate((lo.astype(np.int64) + n - 1 + WIDTH)[order])
    new = np.ones(len(begin), bool)
    new[1:] = begin[1:] > end[:-1]
    first = np.flatnonzero(new)
    return np.stack([begin[first], end[np.append(first[1:], len(begin)) - 1]], axis=1)


def emitted(groups: dict[int, list], kind: int, fields: tuple, columns: dict[str, np.ndarray], to: np.ndarray, bucket: int = 0) -> None:
    """Adds one packed row for each place that rows go to."""
    order = np.argsort(to, kind="stable")
    cuts = np.append(np.flatnonzero(np.diff(to[order], prepend=-1)), len(order))
    for a, b in zip(cuts, cuts[1:], strict=False):
        groups.append((int(to[order[a]]), kind, bucket, pack(fields, columns, order[a:b])))


def batch_of(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows, strict=True) if rows else [[]] * 4, SCHEMA, strict=True)], schema=SCHEMA)


def dedup(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, n_bytes, kept binary (the bytes that stay) and spans array<struct<begin, end>> removed, for every row.

    `keep` names further columns of docs to return; all others are not read, so their names may clash. Null texts are
    empty and have no spans, as all texts shorter than 100 bytes. Null ids come first in corpus order; rows that share an
    id but not the text are documents of their own, ordered by a hash of id and text; rows that repeat id and text are one
    document, each given its result. The empty table gives no rows. Kept bytes may end inside a character.
    """
    spark = docs.sparkSession
    rows = keyed(docs, *[F.col(k).alias(f"k{i}") for i, k in enumerate(keep)], text=text)
    n, size = rows.agg(F.count("*"), F.sum(F.octet_length("text").cast("long"))).first()
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-(size or 0) // PART), 1)
    buckets = parts

    def sampled(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, data, offs in chunks(*text_bytes(batch.column(0))):
                found = anchors_of(data, offs)
                yield pa.RecordBatch.from_arrays([pa.array(found["key"][mixed(found["g"] + np.uint64(1)) % np.uint64(16) == 0].astype(np.int64) ^ NONE)], ["key"])

    sample = rows.select("text").sample(min(1.0, SAMPLED / max(n, 1)), 42) if n > SAMPLED else rows.select("text")
    keys = np.sort(np.array([r[0] for r in sample.mapInArrow(released(sampled), "key long").limit(200_000).collect()], np.int64)) ^ NONE
    splitters = keys.astype(np.uint64)[np.linspace(0, len(keys) - 1, buckets + 1).astype(int)[1:-1]] if len(keys) else np.zeros(0, np.uint64)

    def find(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).fill_null(int(NONE)).to_numpy(zero_copy_only=False)
            dk = batch.column(1).to_numpy(zero_copy_only=False)
            whole = []
            for at, _, data, offs in chunks(*text_bytes(batch.column(2))):
                c = anchors_of(data, offs)
                row = c.pop("row") + at
                whole.append(c | {"doc": ids[row], "dk": dk[row]})
            c = {k: np.concatenate([w[k] for w in whole]) for k in whole[0]} if whole else None
            if c is None or not len(c["g"]):
                continue
            to = np.searchsorted(splitters, c.pop("key"), "right")
            order = order_of(c, "g", "x")
            c, to = {k: v[order] for k, v in c.items()}, to[order]
            once = changes(c, "g", "x", "doc", "dk", "lo")  # a row given twice is one document
            c, to = {k: v[once] for k, v in c.items()}, to[once]
            first = changes(c, "g", "x")
            out: list[tuple] = []
            again = np.flatnonzero(~first)
            emitted(out, DECIDED, RUNS, {k: c[k][again] for k, _ in RUNS}, c["dk"][again] % buckets)
            stay = np.flatnonzero(first)
            stay = stay[np.lexsort((c["lo"][stay], c["dk"][stay], c["doc"][stay]))]
            emitted(out, ANCHORS, RECORDS, {k: c[k][stay] for k, _ in RECORDS}, to[stay])
            yield batch_of(out)

    def group(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts_, bucket = [], 0
        for batch in batches:
            out: list[tuple] = []
            for at, kind, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(3), strict=True):
                if kind == ANCHORS:
                    bucket = at
                    parts_.append(unpack(RECORDS, blob.as_py())[0])
                else:
                    c = unpack(RUNS, blob.as_py())[0]
                    emitted(out, DECIDED, RUNS, c, c["dk"] % parts)
            if out:
                yield batch_of(out)
        c = joined(RECORDS, parts_)
        parts_.clear()
        order = order_of(c, "g", "x")
        c = {k: v[order] for k, v in c.items()}
        once = changes(c, "g", "x", "doc", "dk", "lo")
        c = {k: v[once] for k, v in c.items()}
        first, gram = changes(c, "g", "x"), np.cumsum(changes(c, "g")) - 1
        several = np.bincount(gram, first)[gram] > 1 if len(gram) else first
        for kind, fields, which in ((DECIDED, RUNS, ~first), (CONTEXTS, CANDIDATES, first & several)):
            some = {k: c[k][which] for k, _ in fields}
            order = np.lexsort((some["lo"], some["dk"], some["doc"]))
            some, out = {k: v[order] for k, v in some.items()}, []
            emitted(out, kind, fields, some, some["dk"] % parts, bucket)
            yield batch_of(out)

    texts = rows.withColumn("part", F.pmod("dk", F.lit(parts)).cast("int"))

    def documents(left: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        data, offs = text_bytes(left["text"])
        ids = left["doc_id"].fill_null(int(NONE)).to_numpy()
        return data, offs, ids, left["dk"].to_numpy()

    def rows_of(ids: np.ndarray, dk: np.ndarray, doc: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(order of the documents' rows by key, first and last of each wanted document in it)."""
        pairs = np.rec.fromarrays([np.concatenate([ids, doc]), np.concatenate([dk, key])])
        number = np.unique(pairs, return_inverse=True)[1].reshape(-1)
        order = np.argsort(number[: len(ids)], kind="stable")
        held = number[: len(ids)][order]
        return order, np.searchsorted(held, number[len(ids) :]), np.searchsorted(held, number[len(ids) :], "right")

    def cut(left: pa.Table, right: pa.Table) -> pa.Table:
        data, offs, ids, dk = documents(left)
        out: list[tuple] = []
        for at, kind, bucket, blob in zip(*(right[k].to_pylist() for k in ("at", "kind", "bucket", "blob")), strict=True):
            if kind == DECIDED:
                out.append((at % buckets, DECIDED, 0, blob))
                continue
            c = unpack(CANDIDATES, blob)[0]
            order, begin, _ = rows_of(ids, dk, c["doc"], c["dk"])
            sizes = c["n"].astype(np.int64) - 1 + WIDTH
            bytes_ = data[ranges(offs[order[begin]] + c["lo"], sizes)].tobytes()
            out.append((bucket, CONTEXTS, bucket, pack(CANDIDATES, c, extra=bytes_)))
        return pa.Table.from_batches([batch_of(out)])

    def sort(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, bodies = [], []
        for batch in batches:
            out: list[tuple] = []
            for kind, blob in zip(batch.column(1).to_pylist(), batch.column(3), strict=True):
                if kind == DECIDED:
                    c = unpack(RUNS, blob.as_py())[0]
                    emitted(out, DECIDED, RUNS, c, c["dk"] % parts)
                else:
                    c, extra = unpack(CANDIDATES, blob.as_py())
                    held.append(c)
                    bodies.append(np.frombuffer(extra, np.uint8))
            if out:
                yield batch_of(out)
        c = joined(CANDIDATES, held)
        body = np.concatenate(bodies) if bodies else np.zeros(0, np.uint8)
        bodies.clear()
        sizes = c["n"].astype(np.int64) - 1 + WIDTH
        offs = np.cumsum(sizes) - sizes
        order = order_of(c, "g")
        c, offs, sizes = {k: v[order] for k, v in c.items()}, offs[order], sizes[order]
        begins = np.append(np.flatnonzero(changes(c, "g")), len(order))
        done = np.append(0, np.cumsum(c["n"], dtype=np.int64))
        i = 0
        while i < len(begins) - 1:
            j = max(i + 1, int(np.searchsorted(done[begins], done[begins[i]] + SLICE, "right")) - 1)
            rows_ = slice(begins[i], begins[j])
            some = {k: v[rows_] for k, v in c.items()}
            local = body[ranges(offs[rows_], sizes[rows_])]
            context, inside = repeated_windows(local, np.cumsum(sizes[rows_]) - sizes[rows_], some)
            found, out = runs_of(context, inside, some), []
            emitted(out, DECIDED, RUNS, found, found["dk"] % parts)
            yield batch_of(out)
            i = j

    kept_columns = [f"k{i}" for i in range(len(keep))]
    kinds = {f"k{i}": docs.schema[k].dataType.simpleString() for i, k in enumerate(keep)}

    def remove(left: pa.Table, right: pa.Table) -> pa.Table:
        data, offs, ids, dk = documents(left)
        raw = data.tobytes()
        c = joined(RUNS, [unpack(RUNS, blob)[0] for blob in right["blob"].to_pylist()])
        order, begin, end = rows_of(ids, dk, c["doc"], c["dk"])
        copies = end - begin
        row = order[ranges(begin, copies)]
        lo, n_ = np.repeat(c["lo"], copies), np.repeat(c["n"], copies)
        by = np.argsort(row, kind="stable")
        lo, n_ = lo[by], n_[by]
        cuts = np.searchsorted(row[by], np.arange(len(ids) + 1))
        kept, begins, ends, sizes = [], [], [], [0]
        for i in range(len(ids)):
            whole = raw[offs[i] : offs[i + 1]]
            spans = spans_of(lo[cuts[i] : cuts[i + 1]], n_[cuts[i] : cuts[i + 1]]).tolist()
            if spans:
                whole = b"".join(whole[a:b] for a, b in zip([0, *(e for _, e in spans)], [*(b for b, _ in spans), len(whole)], strict=True))
            kept.append(whole)
            begins += [a for a, _ in spans]
            ends += [b for _, b in spans]
            sizes.append(len(begins))
        pairs = pa.StructArray.from_arrays([pa.array(begins, pa.int64()), pa.array(ends, pa.int64())], ["begin", "end"])
        spans_ = pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), pairs)
        return pa.table([left["doc_id"], pa.array(np.diff(offs), pa.int64()), pa.array(kept, pa.binary()), spans_, *(left[k] for k in kept_columns)], ["doc_id", "n_bytes", "kept", "spans", *kept_columns])

    found = rows.select("doc_id", "dk", "text").mapInArrow(released(find), ROWS).repartitionById(buckets, "at").mapInArrow(released(group), ROWS)
    decided = texts.groupBy("part").cogroup(found.withColumn("part", F.col("at")).groupBy("part")).applyInArrow(cut, ROWS).repartitionById(buckets, "at").mapInArrow(released(sort), ROWS)
    types = "doc_id long, n_bytes long, kept binary, spans array<struct<begin: long, end: long>>" + "".join(f", {k} {t}" for k, t in kinds.items())
    out = texts.groupBy("part").cogroup(decided.withColumn("part", F.col("at")).groupBy("part")).applyInArrow(remove, types)
    return out.select("doc_id", "n_bytes", "kept", "spans", *[F.col(f"k{i}").alias(k) for i, k in enumerate(keep)])
