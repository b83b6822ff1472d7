"""A document classifier that learns from the labelled table: the shape of the text and words that tell classes apart."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.llm.common import at_space, chunks, distinct, keyed, pieces, released, text_bytes, text_of, written
from feedloom.llm.pretokens import per_row
from feedloom.llm.words import words_of

#: The most labelled rows that a fit reads, the first by a hash of their id, and the words that a head uses at most.
SAMPLE, MARKERS = 8_000, 256
#: How far the presence of a word must be from chance, in standard deviations, for a head to use it.
TELLING = 5.0
#: Bytes of text whose features are worked out at once.
FEATURE_CHUNK = 1 << 19
#: Shape features: bytes of these kinds by share of the text, then word length, words per line, distinct lines, length.
KINDS = (b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b"!?", b"#$%&*@^~=+", b"|<>{}[]\\", b".,;:")
SHAPES = 2 * len(KINDS) + 4
TABLES = [np.isin(np.arange(256), np.frombuffer(kind, np.uint8)) for kind in KINDS]


def features_of(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, list[bytes]]:
    """(shape of every row, row and place of each of its distinct words, words of every row, all distinct words)."""
    n = len(offs) - 1
    if n == 1 and len(data) > 2 * FEATURE_CHUNK:
        return features_of_long(data)
    size = np.maximum(np.diff(offs), 1).astype(np.float64)
    shape = np.zeros((n, SHAPES))
    for i, table in enumerate(TABLES):
        hits = np.append(0, np.cumsum(table[data], dtype=np.int32))
        share = np.diff(hits[offs]) / size
        shape[:, 2 * i], shape[:, 2 * i + 1] = share, np.log(share + 1e-3)
    words = words_of(data, offs)
    count = np.maximum(words.counts, 1)
    row = np.repeat(np.arange(n), words.counts)
    found, _, place = distinct(words.data, words.begin)
    line = np.append(offs[:-1], np.flatnonzero(data == 10) + 1)
    line = np.unique(line[line < len(data)])
    at = per_row(line, offs)
    lines = np.diff(at)
    owner = np.repeat(np.arange(n), lines)
    texts, _, number = distinct(data, line) if len(line) else ([], None, np.zeros(0, np.int64))
    different = np.bincount(np.unique(owner * max(len(texts), 1) + number) // max(len(texts), 1), minlength=n)
    letters = np.bincount(row, words.size, n)
    per_line = np.maximum(lines, 1)
    shape[:, -4:] = np.stack([letters / count, np.log(count / per_line), different / per_line, np.log(count)], axis=1)
    keys = np.unique(row * max(len(found), 1) + place)
    return shape, keys // max(len(found), 1), keys % max(len(found), 1), words.counts, [w[:-1] for w in found]


def features_of_long(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, list[bytes]]:
    """features_of one text of any length, piece by piece."""
    hits = sum(np.bincount(data[at : at + FEATURE_CHUNK], minlength=256) for at in range(0, len(data), FEATURE_CHUNK))
    share = np.array([hits[table].sum() for table in TABLES]) / len(data)
    known: dict[bytes, int] = {}
    count = letters = 0
    cuts = pieces(data, np.array([0, len(data)]), at_space, FEATURE_CHUNK)
    for _, _, part, edges in chunks(data, cuts, FEATURE_CHUNK):
        words = words_of(part, edges)
        count += len(words.begin)
        letters += int(words.size.sum())
        for word in distinct(words.data, words.begin)[0]:
            known.setdefault(word[:-1], len(known))
    raw, line = data.tobytes(), np.append(0, np.flatnonzero(data == 10) + 1)
    line = line[line < len(data)].tolist()
    different = len({raw[a:b] for a, b in zip(line, [*line[1:], len(data)], strict=True)})
    shape = np.zeros((1, SHAPES))
    shape[0, : 2 * len(KINDS) : 2], shape[0, 1 : 2 * len(KINDS) : 2] = share, np.log(share + 1e-3)
    some = max(count, 1)
    shape[0, -4:] = letters / some, np.log(some / len(line)), different / len(line), np.log(some)
    return shape, np.zeros(len(known), np.int64), np.arange(len(known)), np.array([count]), list(known)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


class Head:
    """The probability of one 0/1 label: logistic regression on shapes and on the presence of marker words."""

    def __init__(self, shape: np.ndarray, present: np.ndarray, label: np.ndarray, markers: list[bytes]):
        known = np.isfinite(label)
        n, k = int(known.sum()), float(label[known].sum())
        self.rate = (k + 1) / (n + 2)
        self.centre, self.scale = np.zeros(SHAPES), np.ones(SHAPES)
        self.markers, self.weights = markers, np.zeros(SHAPES + 1 + len(markers))
        self.weights[0] = np.log(self.rate / (1 - self.rate))
        self.learnt = 0 < k < n
        if not self.learnt:
            return
        y, x = label[known], shape[known]
        self.centre, self.scale = x.mean(axis=0), x.std(axis=0) + 1e-9
        z = self.design(x, present[known])
        w = np.zeros(z.shape[1])
        w[0] = np.log(k / (n - k))
        for _ in range(30):  # Newton steps with a ridge
            q = sigmoid(z @ w)
            gradient = z.T @ (y - q) - 1.0 * np.append(0, w[1:])
            curve = (z * (q * (1 - q) + 1e-6)[:, None]).T @ z + np.eye(len(w))
            step = np.linalg.solve(curve, gradient)
            w += step * min(1.0, 5 / max(np.abs(step).max(), 1e-9))
            if np.abs(step).max() < 1e-6:
                break
        self.weights = w

    def design(self, shape: np.ndarray, present: np.ndarray) -> np.ndarray:
        scaled = np.clip((shape - self.centre) / self.scale, -8, 8)
        return np.concatenate([np.ones((len(shape), 1)), scaled, present], axis=1)

    def score(self, shape: np.ndarray, row: np.ndarray, place: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """Probabilities of rows; `weight` has that of every distinct word, 0 where it is no marker."""
        base = np.concatenate([np.ones((len(shape), 1)), np.clip((shape - self.centre) / self.scale, -8, 8)], axis=1)
        return sigmoid(base @ self.weights[: SHAPES + 1] + np.bincount(row, weight[place], len(shape)))


def _chosen(docs: DataFrame, labels: DataFrame, names: tuple[str, ...], sample: int) -> DataFrame:
    """(n, doc_id, dk, y) of at most `sample` labelled documents, the first by a hash of id and text."""
    means = [F.round(F.avg(c)).cast("double").alias(f"y{i}") for i, c in enumerate(names)]
    given = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(*means)
    order = F.struct(F.xxhash64("doc_id"), "doc_id", "dk")
    known = docs.groupBy("doc_id", "dk").agg(F.lit(1)).select("doc_id", "dk").join(given, "doc_id")
    return known.select("doc_id", "dk", F.array(*[f"y{i}" for i in range(len(names))]).alias("y")).orderBy(order).limit(sample)


def fit(docs: DataFrame, labels: DataFrame, names: tuple[str, ...], text: str = "text", sample: int = SAMPLE) -> dict[str, Head]:
    """A head for each label column, from at most `sample` labelled documents.

    A label given several times for an id counts by its mean, rounded; null ids and labels do not count. The driver gets the
    shapes of the sampled rows and which of the at most MARKERS words of each head stand in them, never their texts: which
    words tell classes apart is found by grouping.
    """
    rows = keyed(docs, text=text)
    chosen = written(_chosen(rows.select("doc_id", "dk"), labels, names, sample), "labelled")
    sampled = rows.join(F.broadcast(chosen), ["doc_id", "dk"]).dropDuplicates(["doc_id", "dk"]).select("dk", "y", "text")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, end, data, offs in chunks(*text_bytes(batch.column(2)), FEATURE_CHUNK):
                shape, row, place, _, found = features_of(data, offs)
                cuts = pa.array(np.searchsorted(row, np.arange(end - at + 1)), pa.int32())
                words = pa.ListArray.from_arrays(cuts, pa.array(found, pa.binary()).take(pa.array(place)))
                shapes = pa.array(list(shape), pa.list_(pa.float64()))
                columns = [*(batch.column(i).slice(at, end - at) for i in (0, 1)), shapes, words]
                yield pa.RecordBatch.from_arrays(columns, ["dk", "y", "shape", "words"])

    features = written(sampled.mapInArrow(released(run), "dk long, y array<double>, shape array<double>, words array<binary>"), "labelled-features", 16)
    got = features.select("dk", "y", "shape").toArrow()  # at most `sample` rows
    n, k = got.num_rows, len(names)
    if not n:
        return {name: Head(np.zeros((0, SHAPES)), np.zeros((0, 0)), np.zeros(0), []) for name in names}
    keys = got["dk"].to_numpy()
    shape = got["shape"].combine_chunks().flatten().to_numpy().reshape(n, SHAPES)
    y = got["y"].combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(float).reshape(n, k)
    each = features.select("dk", "y", F.explode("words").alias("word"))
    out = {}
    for i, name in enumerate(names):
        label = y[:, i]
        known = np.isfinite(label)
        p = float(label[known].mean()) if known.any() else 0.0
        if not 0 < p < 1:
            out[name] = Head(shape, np.zeros((n, 0)), label, [])
            continue
        value = F.get("y", F.lit(i))
        seen = each.where(value.isNotNull()).groupBy("word").agg(F.count("*").alias("n"), F.sum(value).alias("hits"))
        far = F.abs((F.col("hits") - F.col("n") * p) / F.sqrt(F.col("n") * (p * (1 - p)) + 1))
        best = seen.select("word", far.alias("far")).where(F.col("far") > TELLING).orderBy(F.desc("far"), "word").limit(MARKERS)
        markers = sorted(bytes(r["word"]) for r in best.collect())  # at most MARKERS rows
        present = np.zeros((n, len(markers)))
        if markers:
            table = docs.sparkSession.createDataFrame([(bytearray(m), j) for j, m in enumerate(markers)], "word binary, j int")
            cells = each.join(F.broadcast(table), "word").select("dk", "j").toArrow()  # at most `sample` x MARKERS rows
            order = np.argsort(keys)
            at = order[np.searchsorted(keys, cells["dk"].to_numpy(), sorter=order)]
            present[at, cells["j"].to_numpy()] = 1
        out[name] = Head(shape, present, label, markers)
    return out


def probabilities(docs: DataFrame, heads: dict[str, Head], keep: list[F.Column], text: str = "text") -> DataFrame:
    """(the columns `keep`, p_<name> of each head, tokens: the number of words) of every row; one pass without a shuffle.

    Texts go into Python and don't come back. `keep` must be aliased to names other than p_... and tokens.
    """
    shared = docs.sparkSession.sparkContext.broadcast(heads)
    rows = docs.select(*keep, text_of(text).alias("text"))
    names = [*(f"p_{x}" for x in heads), "tokens"]
    kinds = [*("double" for _ in heads), "long"]
    kept = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema[:-1]]
    schema = ", ".join([*kept, *(f"{x} {k}" for x, k in zip(names, kinds, strict=True))])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heads_ = shared.value
        tables = [dict(zip(h.markers, h.weights[SHAPES + 1 :].tolist(), strict=True)) for h in heads_.values()]
        for batch in batches:
            p, tokens = [np.zeros(batch.num_rows) for _ in heads_], np.zeros(batch.num_rows, np.int64)
            for a, b, data, offs in chunks(*text_bytes(batch.column(batch.num_columns - 1)), FEATURE_CHUNK):
                shape, row, place, tokens[a:b], found = features_of(data, offs)
                for out, head, table in zip(p, heads_.values(), tables, strict=True):
                    weight = np.fromiter((table.get(w, 0.0) for w in found), np.float64, len(found))
                    out[a:b] = head.score(shape, row, place, weight if len(found) else np.zeros(1))
            made = [*(pa.array(x) for x in (*p, tokens))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *made], [*batch.schema.names[:-1], *names])

    return rows.mapInArrow(released(run), schema)
