"""What the operators share: the shared folder, document keys and views of Arrow text as numpy bytes.

Keys. Operators identify a document by `doc_id` together with a 64-bit hash of its text, so rows that repeat an id with
another text stay apart and rows that repeat id and text are one document, given once per row with equal values. A null
text counts as empty and a null id is an id of its own that sorts before all others.
"""

from __future__ import annotations

import ctypes
import functools
import re
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that the numpy kernels handle at once; their temporary arrays take some 60 times this.
CHUNK = 1 << 20


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir; only a local session may do without one."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="feedloom-")
        spark.sparkContext.setCheckpointDir(base)
    return base.rstrip("/") if "://" in base else "file://" + base.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    """A path for one table or file set of this run, below the shared folder."""
    return f"{shared_dir(spark)}/feedloom/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex[:12]}"


#: Rows of a small table that are worth a file.
FILE_ROWS = 4_096
#: In a local folder, no checksum files: for each file that is made there, Hadoop has the JVM start processes (chmod), and
#: until such a process has begun, all memory of the executor's JVM is its memory, too.
PLAIN_FILES = {"fs.file.impl": "org.apache.hadoop.fs.RawLocalFileSystem", "fs.file.impl.disable.cache": "true"}


def written(df: DataFrame, name: str, files: int | None = None) -> DataFrame:
    """Cuts lineage: the rows as a Parquet table in the shared folder, which a lost executor does not take with it.

    files: as many files at most; whoever gives it knows that the table is small.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    (df if files is None else df.coalesce(files)).write.options(compression="zstd", **PLAIN_FILES).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def give_back() -> None:
    """Hands the memory that this process has freed back to the system, where its C library can."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def released(run: Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """run, a task on Arrow batches, giving back what it freed: a worker waits for its next task beside the others of its executor."""

    @functools.wraps(run)
    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            give_back()

    return task


def files_for(rows: int) -> int:
    return 1 + rows // FILE_ROWS


def text_of(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def keyed(docs: DataFrame, *more: Column | str, text: str = "text") -> DataFrame:
    """doc_id, dk (hash of id and text), text and what `more` names, and no other column."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.col("doc_id").cast("long"), text_of(text)).alias("dk"), text_of(text).alias("text"), *more)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all rows, offsets of rows and of the end) of a string column; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    large = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    n = len(column)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offs = np.frombuffer(offsets, np.int64 if large else np.int32)[column.offset : column.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offs[0] : offs[-1]], offs - offs[0]


def chunks(data: np.ndarray, offs: np.ndarray, limit: int = CHUNK) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of runs of whole rows with at most `limit` bytes, or one longer row."""
    n, at = len(offs) - 1, 0
    while at < n:
        end = max(at + 1, int(np.searchsorted(offs, offs[at] + limit, "right")) - 1)
        yield at, end, data[offs[at] : offs[end]], offs[at : end + 1] - offs[at]
        at = end


def pieces(data: np.ndarray, offs: np.ndarray, may_cut: Callable[[np.ndarray, np.ndarray], np.ndarray], limit: int = CHUNK) -> np.ndarray:
    """offs with further cuts, so that rows longer than `limit` become pieces of about that size.

    A row may be cut between two bytes for which may_cut(bytes before, bytes after) holds; the last such place up to the
    limit is taken, or else the first one after it.
    """
    cuts = [offs]
    for row in np.flatnonzero(np.diff(offs) > limit):
        at, end = int(offs[row]), int(offs[row + 1])
        while end - at > limit:
            low, high, found = at, at + limit, np.zeros(0, np.int64)
            while not len(found) and low < end - 1:
                found = low + 1 + np.flatnonzero(may_cut(data[low : high - 1], data[low + 1 : high]))
                low, high = high - 1, min(high + limit, end)
            if not len(found):
                break
            at = int(found[-1] if found[0] <= at + limit and found[-1] <= at + limit else found[0])
            cuts.append(np.array([at]))
    return np.sort(np.concatenate(cuts)) if len(cuts) > 1 else offs


def at_space(before: np.ndarray, after: np.ndarray) -> np.ndarray:
    """Whether a space or control character of ASCII white space follows a byte that is none."""
    white = lambda x: (x == 32) | ((x >= 9) & (x <= 13))
    return white(after) & ~white(before)


class Rolling:
    """Polynomial hashes modulo 2**64 of any substring of an array of bytes, from prefix sums.

    Some strings over two letters, a thousand bytes long and more, collide by their structure, whatever the base. So the
    hashes only propose which strings are equal, and whoever uses them compares the bytes, or hashes short strings only.
    """

    BASE = np.uint64(0x9E3779B97F4A7C15)
    INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
    TABLE = np.random.Generator(np.random.PCG64(20240229)).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    _powers = _inverses = np.ones(1, np.uint64)

    @classmethod
    def powers(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Powers of the base and its inverse; those of a chunk are kept, those of a longer text are not."""
        if len(cls._powers) >= n:
            return cls._powers, cls._inverses
        size = max(n, CHUNK + 1)
        made = tuple(np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(size - 1, b, np.uint64), dtype=np.uint64)]) for b in (cls.BASE, cls.INVERSE))
        if size == CHUNK + 1:
            cls._powers, cls._inverses = made
        return made

    def __init__(self, data: np.ndarray):
        n = len(data)
        powers, self.inverses = self.powers(n + 1)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(self.TABLE[data] * powers[:n], out=self.sums[1:])

    def span(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Mixed hashes of the bytes from start up to end."""
        return mixed((self.sums[end] - self.sums[start]) * self.inverses[start] + (end - start).astype(np.uint64))

    def windows(self, width: int) -> np.ndarray:
        """Mixed hashes of every run of `width` bytes."""
        n = len(self.sums) - width
        return mixed((self.sums[width:] - self.sums[:-width]) * self.inverses[: max(n, 0)]) if n > 0 else np.zeros(0, np.uint64)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits (xor-shift and multiply) that spreads low and high bits."""
    x = x ^ (x >> np.uint64(31))
    x *= np.uint64(0x7FB5D329728EA185)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x81DADEF4BC2DD44D)
    x ^= x >> np.uint64(33)
    return x


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The indexes start, start+1, ... of each run, one after the other."""
    lengths = lengths.astype(np.int64)
    ends = np.cumsum(lengths)
    return np.arange(int(ends[-1]) if len(ends) else 0, dtype=np.int64) + np.repeat(starts.astype(np.int64) - (ends - lengths), lengths)


def grouped(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(where each distinct key comes first, every key's place among them), as np.unique gives them; its stable sort is slower."""
    order = np.argsort(keys)
    ordered = keys[order]
    new = np.ones(len(keys), bool)
    new[1:] = ordered[1:] != ordered[:-1]
    inverse = np.empty(len(keys), np.int64)
    inverse[order] = np.cumsum(new) - 1
    return (np.minimum.reduceat(order, np.flatnonzero(new)) if len(keys) else order), inverse


def _equal_bytes(data: np.ndarray, a: np.ndarray, b: np.ndarray, sizes: np.ndarray) -> bool:
    """Whether all pieces of these sizes that begin at a have the bytes of those that begin at b; eight bytes at a time."""
    padded = np.append(data, np.zeros(8, np.uint8))
    eight = np.ndarray(len(data) + 1, "<u8", padded, strides=(1,)).copy()
    while len(a):
        differ = eight[a] ^ eight[b]
        differ <<= (8 * np.maximum(8 - sizes, 0)).astype(np.uint64)  # of a piece's last bytes, what follows goes
        if differ.any():
            return False
        more = np.flatnonzero(sizes > 8)
        a, b, sizes = a[more] + 8, b[more] + 8, sizes[more] - 8
    return True


def distinct(data: np.ndarray, begin: np.ndarray, without: int = 0) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """(bytes of each distinct piece, where it first begins, every piece's place among them).

    Pieces lie one after the other, up to the end of data, and have a byte at least; their last `without` bytes are not
    given. Equal hashes only propose that pieces are equal; the bytes decide.
    """
    raw, end = data.tobytes(), np.append(begin[1:], len(data))
    where, inverse = grouped(Rolling(data).span(begin, end))
    sizes, first = end - begin, begin[where]
    equal = bool((sizes == sizes[where][inverse]).all())
    if equal and len(begin):
        equal = _equal_bytes(data, begin, first[inverse], sizes)
    if not equal:
        known: dict[bytes, int] = {}
        inverse = np.array([known.setdefault(raw[a:b], len(known)) for a, b in zip(begin.tolist(), end.tolist(), strict=True)], np.int64)
        where = np.unique(inverse, return_index=True)[1]
        first = begin[where]
    return [raw[a:b] for a, b in zip(first.tolist(), (end[where] - without).tolist(), strict=True)], first, inverse
