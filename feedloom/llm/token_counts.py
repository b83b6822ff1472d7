"""Token counts through a cache of digests.

A count is stored under two digests: of the content, normalised as the tokenizer itself normalises it before it splits
(for byte-level BPE: not at all), and of the tokenizer's file. Texts whose digests are stored are never encoded; of the
others each distinct one is encoded once and appended to the cache.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from feedloom.llm.common import chunks, distinct, keyed, new_path, pieces, text_bytes
from feedloom.llm.pretokens import Pool, may_cut, per_row, starts

CACHE = "content binary, n_tokens long, tokenizer string"
#: Parts that the rows of one content are dealt into when they meet its count.
SPREAD = 64
VERSION = "1"
#: Strings handed to the library at once; it keeps far more than the ids of each.
AT_ONCE = 1000


class Counter:
    """Counts tokens as the library of a tokenizer file gives them: tokenizers for .json, sentencepiece for .model.

    Special strings inside a text are handled as the library does by default; none is added. Where a .json splits text by
    the public byte-level pattern and encodes each match by itself, each distinct match goes through the library once.
    """

    def __init__(self, path: str):
        self.pieces = None
        if path.endswith(".model"):
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_file=path)
            self.counts = lambda texts: [len(x) for x in model.encode(texts, num_threads=1)]
            return
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks are parallel already; each thread would keep memory of its own
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        self.counts = lambda texts: [len(x.ids) for at in range(0, len(texts), AT_ONCE) for x in tokenizer.encode_batch_fast(texts[at : at + AT_ONCE], add_special_tokens=False)]
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        pre, model = spec.get("pre_tokenizer") or {}, spec.get("model") or {}
        if spec.get("normalizer") is None and pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space") and model.get("type") == "BPE" and not model.get("dropout"):
            self.pieces = Pool(200_000)
            self.special = [x["content"].encode() for x in spec.get("added_tokens", [])]

    def rows(self, data: np.ndarray, offs: np.ndarray) -> np.ndarray:
        """The count of every row."""
        raw = data.tobytes()
        whole = np.zeros(len(offs) - 1, bool)
        if self.pieces is None:
            whole[:] = True
        else:
            for mark in self.special:
                at = raw.find(mark)
                while at >= 0:
                    whole[np.searchsorted(offs, at, "right") - 1] = True
                    at = raw.find(mark, at + 1)
        out = np.zeros(len(whole), np.int64)
        if not whole.all() and len(data):
            cuts = pieces(data, offs, may_cut)
            made = [self._pieces(part, edges) for _, _, part, edges in chunks(data, cuts)]
            sums = np.concatenate([[0], np.cumsum(np.concatenate(made))])
            out = np.diff(sums[np.searchsorted(cuts, offs, "right") - 1])
        if whole.any():
            rows = np.flatnonzero(whole)
            out[rows] = self.counts([raw[offs[i] : offs[i + 1]].decode() for i in rows])
        return out

    def _pieces(self, data: np.ndarray, offs: np.ndarray) -> np.ndarray:
        begin = starts(data, offs)
        if not len(begin):
            return np.zeros(len(offs) - 1, np.int64)
        found, _, inverse = distinct(data, begin)
        places = self.pieces.lookup(found, lambda new: [[n] for n in self.counts([x.decode() for x in new])])
        sums = np.concatenate([[0], np.cumsum(self.pieces.gather(places)[inverse], dtype=np.int64)])
        return np.diff(sums[per_row(begin, offs)])


@lru_cache(1)
def counter_of(path: str) -> Counter:
    """One for all tasks of a worker."""
    return Counter(path)


@lru_cache(4)
def tokenizer_digest(path: str) -> str:
    """Of the tokenizer's file and of how texts are handed to it."""
    with open(path, "rb") as file:
        return hashlib.sha256(VERSION.encode() + file.read()).hexdigest()


def stored(spark: SparkSession, cache: str) -> DataFrame:
    """The cache at a path, a folder for each tokenizer version; empty if nothing has been written there."""
    try:
        return spark.read.schema(CACHE).parquet(cache)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in str(error):
            return spark.createDataFrame([], CACHE)
        raise


def token_counts(docs: DataFrame, path: str, cache: str | None = None, limit: int = 512, text: str = "text") -> DataFrame:
    """doc_id, n_bytes (UTF-8), n_tokens and over_limit (n_tokens > limit) for every row.

    Null texts count as empty, which has 0 tokens; texts are encoded whole. Rows that repeat a text share one encoding.
    Repeated ids stay repeated and null ids stay null. Other columns are not read, so their names may clash with those
    made here. `cache` is a path below a shared folder (a new one if None); two runs that append the same digest at once do
    no harm, as counts are read by digest with duplicates dropped.
    """
    spark = docs.sparkSession
    cache = cache or new_path(spark, "token-cache")
    version = tokenizer_digest(path)
    content, part = F.unhex(F.sha2("text", 256)).alias("content"), F.pmod("dk", F.lit(SPREAD)).cast("short").alias("part")
    rows = keyed(docs, text=text).select("doc_id", "dk", "text", content, part, F.octet_length("text").cast("long").alias("n_bytes"))
    one = F.max("n_tokens").alias("n_tokens")
    known = stored(spark, cache).where(F.col("tokenizer") == version).groupBy("content").agg(one)
    missing = rows.groupBy("content").agg(F.min("dk").alias("dk")).join(known, "content", "left_anti").hint("shuffle_hash")
    # dk stands for an id with a text, so a document given twice would be encoded twice here, not more
    todo = rows.select("dk", "text").join(missing, "dk").select("content", "text")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = counter_of(path)
        for batch in batches:
            made = [counter.rows(data, offs) for _, _, data, offs in chunks(*text_bytes(batch.column(1)))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.concatenate(made) if made else np.zeros(0, np.int64))], ["content", "n_tokens"])

    made = todo.mapInArrow(run, "content binary, n_tokens long").select("content", "n_tokens", F.lit(version).alias("tokenizer"))
    made.write.mode("append").partitionBy("tokenizer").parquet(cache)
    counts = stored(spark, cache).where(F.col("tokenizer") == version).groupBy("content").agg(one)
    # the rows of a frequent text meet its count in SPREAD places, not in one
    placed = rows.select("content", "part").distinct().join(counts, "content")
    out = rows.select("doc_id", "n_bytes", "content", "part").join(placed, ["content", "part"])
    return out.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
