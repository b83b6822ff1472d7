"""Class-based n-gram scoring: exchange clustering, class transitions and word emissions.

Every training word gets a class by exchange, in two steps. Units (the most frequent words, one for each ending of all
other words, and the end of a text) are clustered first: a unit moves between classes as long as the mutual information
of neighbouring classes grows. These are the classes that histories have. Then every further word, however rare, is
exchanged by itself, in one distributed round: from the class of its ending it goes to the class at which the counts of
the history classes before it have the largest log likelihood, if that gains more than naming a class costs. The classes
of words are what is predicted.

A text's probability is the product of P(class | history class), from counts over all words' classes, interpolated with
the classes' frequencies, and P(word | class): counts with an absolute discount whose mass goes to the unseen word of a
class, so that the known words of a class and its unseen word sum to one. An unseen word has the class of its ending.

All counts cover the whole corpus; words are told apart by their bytes. The driver sees the HELD most frequent words, the
table of unit pairs and tables of classes, whose sizes the parameters bound; all other words stay in tables that grow with
the corpus and meet the texts' words in joins.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.llm.common import CHUNK, at_space, chunks, distinct, keyed, mixed, pieces, released, text_bytes, written
from feedloom.llm.words import words_of

#: Words that are units of their own, endings, classes, sweeps of the exchange of units.
WORDS, ENDINGS, CLASSES, SWEEPS = 768, 512, 64, 4
#: Words whose counts and classes every task holds, and the bytes that such a word has at most.
HELD, HELD_BYTES = 65_536, 64
FOLDS, OUT = 7, 2
#: Weight of class frequencies in the transitions.
BETA = 5.0
#: Counts up to this are looked up when words are exchanged, not worked out.
SMALL = 8
#: A history class and how often a word follows it.
RECORD = np.dtype([("cell", "u1"), ("n", "<u4")])
UNITS = WORDS + ENDINGS + 1
END = UNITS - 1


def held_out_of(ids: list[int | None]) -> np.ndarray:
    return np.array([zlib.crc32(b"" if i is None else str(i).encode()) % FOLDS == OUT for i in ids], bool)


class Tokens:
    """The words of many rows: `found` has the distinct ones, `place` the one of each token, `bounds` each row's tokens."""

    def __init__(self, data: np.ndarray, offs: np.ndarray):
        words = words_of(data, offs)
        self.bounds = words.rows
        self.found, first, self.place = distinct(words.data, words.begin, 1)
        size = np.fromiter(map(len, self.found), np.int64, len(self.found))
        code = np.zeros(len(first), np.uint64)
        for back in (1, 2, 3):
            byte = words.data[np.maximum(first + size - back, 0)] if len(first) else np.zeros(0, np.uint8)
            code = code * np.uint64(257) + np.where(size >= back, byte.astype(np.uint64) + np.uint64(1), np.uint64(0))
        self.endings = (mixed(code) % np.uint64(ENDINGS)).astype(np.int64)

    def units(self, index: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray]:
        """(place of each distinct word in the index of held ones or -1, its unit)."""
        held = np.fromiter((index.get(w, -1) for w in self.found), np.int64, len(self.found))
        return held, np.where((held >= 0) & (held < WORDS), held, WORDS + self.endings)


def parts_of(data: np.ndarray, offs: np.ndarray, limit: int = CHUNK) -> Iterator[tuple[Tokens, np.ndarray, np.ndarray]]:
    """(tokens of a run of pieces, row of each piece, whether it begins its row). Only rows beyond `limit` bytes are cut."""
    cuts = pieces(data, offs, at_space, limit)
    if cuts is offs:
        rows, first = np.arange(len(offs) - 1), np.ones(len(offs) - 1, bool)
    else:
        sizes = np.searchsorted(cuts, offs[1:], "left") - np.searchsorted(cuts, offs[:-1], "right") + 1
        sizes = np.where(np.diff(offs) > 0, sizes, 0)
        empty = np.flatnonzero(sizes == 0)  # an empty row is one piece of its own
        rows = np.sort(np.concatenate([np.repeat(np.arange(len(sizes)), sizes), empty]))
        first = np.r_[True, rows[1:] != rows[:-1]]
    for a, b, part, edges in chunks(data, cuts, limit):
        yield Tokens(part, edges), rows[a:b], first[a:b]


def exchange(pairs: np.ndarray, classes: int = CLASSES, sweeps: int = SWEEPS) -> np.ndarray:
    """The class of every unit, from the counts of neighbouring units; the last unit keeps a class of its own.

    Units start in classes by rank of frequency. One after the other, a unit goes to the class at which the sum of
    N log N over class pairs, less that over left and right classes, is largest; ties go to the smaller class.
    """
    n = len(pairs)
    f = lambda x: x * np.log(np.maximum(x, 1e-300))
    weight = pairs.sum(axis=0) + pairs.sum(axis=1)
    own = classes - 1
    cls = np.empty(n, np.int64)
    order = np.argsort(-weight[:-1], kind="stable")
    cls[order] = np.arange(n - 1) % own
    cls[-1] = own
    member = np.zeros((n, classes))
    member[np.arange(n), cls] = 1
    pairs = pairs.astype(np.float64)
    table = member.T @ pairs @ member
    right, left = pairs @ member, pairs.T @ member  # of each unit by the class after and before it
    for _ in range(sweeps):
        moved = 0
        for w in order:
            if not weight[w]:
                continue
            a, r, l, s = cls[w], right[w].copy(), left[w].copy(), pairs[w, w]
            r[a] -= s
            l[a] -= s  # without the unit itself
            table[a, :] -= r
            table[:, a] -= l
            table[a, a] -= s
            rows, cols, diagonal = table.sum(axis=1), table.sum(axis=0), np.diag(table)
            base = f(table)
            # put into b: row b gains r, column b gains l, and the cell (b, b) gains both and s
            gain = (f(table + r[None, :]) - base).sum(axis=1) + (f(table + l[:, None]) - base).sum(axis=0)
            gain += f(diagonal + r + l + s) - f(diagonal + r) - f(diagonal + l) + f(diagonal)
            gain -= f(rows + r.sum() + s + l) - f(rows) + f(cols + l.sum() + s + r) - f(cols)
            # row sums of other classes gain l, column sums gain r, whichever b it is
            others_l, others_r = f(rows + l) - f(rows), f(cols + r) - f(cols)
            gain -= others_l.sum() - others_l + others_r.sum() - others_r
            gain[own] = -np.inf
            b = int(np.argmax(gain > gain.max() - 1e-9))
            table[b, :] += r
            table[:, b] += l
            table[b, b] += s
            if b != a:
                moved += 1
                cls[w] = b
                right[:, a] -= pairs[:, w]
                right[:, b] += pairs[:, w]
                left[:, a] -= pairs[w]
                left[:, b] += pairs[w]
        if not moved:
            break
    return cls


def xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1e-300))


class Assignment:
    """Exchanges words one by one against a table of (history class, class) counts, many at once.

    Each word is judged against the table as it stands, itself taken out of its own class.
    """

    def __init__(self, table: np.ndarray):
        self.table = table.astype(float)
        self.classes = table.shape[1]
        self.base, self.total = xlogx(self.table), self.table.sum(axis=0)
        n = np.arange(SMALL + 1, dtype=float)[:, None, None]
        self.gains = xlogx(self.table + n) - self.base  # by count, history class and class

    def __call__(self, group: np.ndarray, cell: np.ndarray, n: np.ndarray, own: np.ndarray) -> np.ndarray:
        """The class of each group; its history counts are (group, cell, n), sorted by group, and its class so far `own`."""
        begin = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
        gain = np.empty((len(cell), self.classes))
        small = n <= SMALL
        gain[small] = self.gains[n[small], cell[small]]
        large = np.flatnonzero(~small)
        gain[large] = xlogx(self.table[cell[large]] + n[large, None]) - self.base[cell[large]]
        at = own[group]
        here = self.table[cell, at]
        gain[np.arange(len(cell)), at] = self.base[cell, at] - xlogx(np.maximum(here - n, 0))
        score = np.add.reduceat(gain, begin, axis=0)
        size = np.add.reduceat(n, begin).astype(float)
        cost = xlogx(self.total + size[:, None]) - xlogx(self.total)
        rows = np.arange(len(own))
        mine = self.total[own]
        cost[rows, own] = xlogx(mine) - xlogx(np.maximum(mine - size, 0))
        score -= cost
        score[:, self.classes - 1] = -np.inf  # the end is no word's class
        best = np.argmax(score, axis=1)
        return np.where(score[rows, best] - score[rows, own] > np.log(self.classes), best, own)


def exchanged(batches: Iterable[pa.RecordBatch], assignment: Assignment) -> Iterator[pa.RecordBatch]:
    """w, c, cls, cells and ns of every word, from rows of w, own (the class of its ending) and cells (RECORDs).

    Rows come sorted by word, so a word's rows follow each other; the counts of the last one wait for the next batch.
    """
    waiting: tuple[pa.Array, np.ndarray, np.ndarray] | None = None

    def settle(words: pa.Array, own: np.ndarray, sums: np.ndarray) -> pa.RecordBatch:
        group, cell = np.nonzero(sums)
        n = sums[group, cell]
        chosen = assignment(group, cell, n, own)
        ends = pa.array(np.searchsorted(group, np.arange(len(words) + 1)), pa.int32())
        cells = pa.ListArray.from_arrays(ends, pa.array(cell.astype(np.int16)))
        counts = pa.ListArray.from_arrays(ends, pa.array(n))
        return pa.RecordBatch.from_arrays([words, pa.array(sums.sum(axis=1)), pa.array(chosen.astype(np.int16)), cells, counts], ["w", "c", "cls", "cells", "ns"])

    for batch in batches:
        if not batch.num_rows:
            continue
        words = batch.column(0).cast(pa.binary())
        change = np.r_[True, ~pc.equal(words[1:], words[:-1]).to_numpy(zero_copy_only=False)]
        begin = np.flatnonzero(change)
        raw, offs = text_bytes(batch.column(2))
        record = raw.view(RECORD)
        at = np.repeat(np.cumsum(change) - 1, np.diff(offs) // RECORD.itemsize) * CLASSES + record["cell"]
        sums = np.bincount(at, record["n"], len(begin) * CLASSES).astype(np.int64).reshape(-1, CLASSES)
        words, own = words.take(pa.array(begin)), batch.column(1).to_numpy()[begin].astype(np.int64)
        if waiting is not None and waiting[0][0] == words[0]:
            sums[0] += waiting[2][0]
        elif waiting is not None:
            words, own, sums = pa.concat_arrays([waiting[0], words]), np.concatenate([waiting[1], own]), np.concatenate([waiting[2], sums])
        if len(words) > 1:
            yield settle(words[:-1], own[:-1], sums[:-1])
        waiting = pa.array([words[-1].as_py()], pa.binary()), own[-1:].copy(), sums[-1:].copy()
    if waiting is not None:
        yield settle(*waiting)


class Model:
    """Log10 probabilities of classes after history classes, and of words in classes."""

    def __init__(self, table: np.ndarray, types: np.ndarray, discount: float):
        count = table.sum(axis=0)
        share = (count + 1) / (count.sum() + len(count))
        self.transition = np.log10((table + BETA * share) / (table.sum(axis=1, keepdims=True) + BETA))
        self.discount = discount
        self.size = np.log10(np.maximum(count, 1e-300))
        self.unseen = np.where(types > 0, np.log10(np.maximum(discount * types, 1e-300)) - self.size, 0.0)

    def known(self, counts: np.ndarray, cls: np.ndarray) -> np.ndarray:
        return np.log10(np.maximum(counts - self.discount, 1e-300)) - self.size[cls]


def scores(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score (log10) of every row.

    Texts are read whole, long ones piece by piece; null and empty ones have one token, the end. Documents with crc32 of
    the id as text mod 7 = 2 are held out from learning; a null id counts as the empty text. Repeated rows count and are
    scored each. Without any training document every word is the unseen one. Other columns are not read, so their names may
    clash; an empty table gives no rows.
    """
    spark = docs.sparkSession
    rows = keyed(docs, text=text)
    training = F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(FOLDS)) != OUT
    train = rows.where(training).select("text")

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums: dict[bytes, int] = {}
            for tokens, _, _ in parts_of(*text_bytes(batch.column(0))):
                n = np.bincount(tokens.place, minlength=len(tokens.found)).tolist()
                for word, c in zip(tokens.found, n, strict=True):
                    sums[word] = sums.get(word, 0) + c
            yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.binary()), pa.array(list(sums.values()), pa.int64())], ["w", "c"])

    table = written(train.mapInArrow(released(count), "w binary, c long").groupBy("w").agg(F.sum("c").alias("c")), "word-counts")
    train_docs = train.count()
    total, types, n1, n2 = table.agg(F.sum("c"), F.count("*"), F.count_if(F.col("c") == 1), F.count_if(F.col("c") == 2)).first()
    total, types = (total or 0) + train_docs, types + (train_docs > 0)
    discount = min(0.95, max(0.05, n1 / (n1 + 2 * n2))) if n1 else 0.5
    short = table.where(F.octet_length("w") <= HELD_BYTES)
    top = short.orderBy(F.desc("c"), "w").limit(HELD).toArrow()  # at most HELD short words
    held, held_counts = top["w"].to_pylist(), top["c"].to_numpy()
    index = spark.sparkContext.broadcast({w: i for i, w in enumerate(held)})

    def sequence(tokens: Tokens, rows_: np.ndarray, first: np.ndarray, last: np.ndarray, units: np.ndarray, before: int) -> tuple[np.ndarray, np.ndarray, int]:
        """(unit, history unit) of all tokens with ends put in after each row's last piece, and the last unit."""
        each = units[tokens.place]
        each = np.insert(each, tokens.bounds[1:][last], END)
        history = np.append(before, each[:-1])
        begin = tokens.bounds[:-1] + np.cumsum(last) - last
        some = first & (begin < len(each))
        history[begin[some]] = END
        return each, history, int(each[-1]) if len(each) else before

    def walk(batch_text: pa.Array) -> Iterator[tuple]:
        before, pending = END, None
        for item in (*parts_of(*text_bytes(batch_text)), None):
            if pending is not None:
                tokens, rows_, first = pending
                after = item[2][0] if item is not None and len(item[2]) else True
                last = np.append(first[1:], after)
                held_at, units = tokens.units(index.value)
                each, history, before = sequence(tokens, rows_, first, last, units, before)
                yield tokens, rows_, last, held_at, units, each, history
            pending = item

    def pairs_of(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = np.zeros(UNITS * UNITS, np.int64)
        for batch in batches:
            for *_, each, history in walk(batch.column(0)):
                cells += np.bincount(history * UNITS + each, minlength=UNITS * UNITS)
        some = np.flatnonzero(cells)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(cells[some])], ["cell", "c"])

    found = train.mapInArrow(released(pairs_of), "cell long, c long").groupBy("cell").agg(F.sum("c").alias("c")).toArrow()  # at most UNITS x UNITS rows
    pairs = np.zeros(UNITS * UNITS)
    pairs[found["cell"].to_numpy()] = found["c"].to_numpy()
    del found
    pairs = pairs.reshape(UNITS, UNITS)
    cls = exchange(pairs)
    member = np.zeros((UNITS, CLASSES))
    member[np.arange(UNITS), cls] = 1
    shared = spark.sparkContext.broadcast((cls, member.T @ pairs @ member))

    def contexts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes_ = shared.value[0]
        for batch in batches:
            sums: dict[bytes, int] = {}
            keys, kinds, owns = [], [], []
            for tokens, _, last, _, units, each, history in walk(batch.column(0)):
                mine = each < END
                rare = np.flatnonzero(units >= WORDS)
                number = np.full(len(units), -1, np.int64)
                number[rare] = [sums.setdefault(tokens.found[i], len(sums)) for i in rare.tolist()]
                owns.append((number[rare], classes_[units[rare]]))
                word = number[tokens.place]
                past = classes_[history[mine]][word >= 0]
                pair, n = np.unique(word[word >= 0] * CLASSES + past, return_counts=True)
                keys.append(pair)
                kinds.append(n)
            pair, inverse = np.unique(np.concatenate(keys) if keys else np.zeros(0, np.int64), return_inverse=True)
            n = np.bincount(inverse, np.concatenate(kinds) if kinds else None, len(pair)).astype("<u4")
            own = np.zeros(len(sums), np.int8)
            for at, c in owns:
                own[at] = c
            ends = np.searchsorted(pair, np.arange(len(sums) + 1) * CLASSES)
            record = np.zeros(len(pair), RECORD)
            record["cell"], record["n"] = pair % CLASSES, n
            packed = pa.Array.from_buffers(pa.binary(), len(sums), [None, pa.py_buffer((ends * RECORD.itemsize).astype(np.int32)), pa.py_buffer(record.tobytes())])
            yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.binary()), pa.array(own), packed], ["w", "own", "cells"])

    def assign(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from exchanged(batches, Assignment(shared.value[1]))

    gathered = train.mapInArrow(released(contexts), "w binary, own byte, cells binary")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    gathered = gathered.repartition(parts, "w").sortWithinPartitions("w")
    model_words = written(gathered.mapInArrow(released(assign), "w binary, c long, cls short, cells array<short>, ns array<long>"), "word-classes")
    cells = model_words.select("cls", F.explode(F.arrays_zip("cells", "ns")).alias("x")).groupBy("cls", F.col("x.cells").alias("past")).agg(F.sum("x.ns").alias("n")).toArrow()  # at most CLASSES x CLASSES rows
    seeds = cls[: min(WORDS, len(held))]
    transitions = np.zeros((CLASSES, CLASSES))
    transitions[cells["past"].to_numpy(), cells["cls"].to_numpy()] = cells["n"].to_numpy()
    own_units = [*range(len(seeds)), END]
    for unit in own_units:
        transitions[:, cls[unit]] += member.T @ pairs[:, unit]
    class_types = np.bincount(seeds, minlength=CLASSES).astype(float)
    for r in model_words.groupBy("cls").count().collect():  # at most CLASSES rows
        class_types[r["cls"]] += r["count"]
    model = Model(transitions, class_types, discount)
    held_classes = np.zeros(len(held), np.int64)
    held_classes[: len(seeds)] = seeds
    names = spark.createDataFrame(pa.table({"w": pa.array(held, pa.binary()), "i": pa.array(np.arange(len(held)), pa.int32())})) if held else None
    if names is not None:
        got = model_words.select("w", "cls").join(F.broadcast(names), "w").select("i", "cls").toArrow()  # at most HELD rows
        held_classes[got["i"].to_numpy()] = got["cls"].to_numpy()
    known = spark.sparkContext.broadcast((held_counts, held_classes, model))
    denominator = float(np.log10(total + types + 1))

    def local(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, classes, m = known.value
        hist = shared.value[0]
        for batch in batches:
            k = batch.num_rows
            n_tokens, n_known, base, model_score = (np.zeros(k) for _ in range(4))
            out: list[tuple] = []
            for tokens, rows_, last, held_at, units, each, history in walk(batch.column(2)):
                past = hist[history]
                sizes = np.diff(tokens.bounds) + last
                row = np.repeat(rows_, sizes)
                n_tokens += np.bincount(row, minlength=k)
                end = each == END
                if train_docs:
                    n_known += np.bincount(row[end], minlength=k)
                base += np.bincount(row[end], np.full(int(end.sum()), np.log10(train_docs + 1)), k)
                model_score += np.bincount(row[end], m.transition[past[end], hist[END]], k)
                word_row, word_past, place = row[~end], past[~end], held_at[tokens.place]
                near = place >= 0
                c, to = counts[place[near]], classes[place[near]]
                n_known += np.bincount(word_row[near], minlength=k)
                base += np.bincount(word_row[near], np.log10(c + 1), k)
                model_score += np.bincount(word_row[near], m.transition[word_past[near], to] + m.known(c, to), k)
                far = np.flatnonzero(~near)
                key = (word_row[far] * len(tokens.found) + tokens.place[far]) * CLASSES + word_past[far]
                key, times = np.unique(key, return_counts=True)
                word = key // CLASSES % max(len(tokens.found), 1)
                out.append((key // CLASSES // max(len(tokens.found), 1), pa.array(tokens.found, pa.binary()).take(pa.array(word)), key % CLASSES, times, hist[units[word]]))
            dk = batch.column(1).to_numpy(zero_copy_only=False)
            at = np.concatenate([x[0] for x in out]) if out else np.zeros(0, np.int64)
            some = len(at)
            gather = lambda i, kind: np.concatenate([x[i] for x in out]).astype(kind) if out else np.zeros(0, kind)
            words = pa.concat_arrays([x[1] for x in out]) if out else pa.array([], pa.binary())
            nothing = lambda n, kind: pa.nulls(n, kind)
            past, fallback = gather(2, np.int64), gather(4, np.int64)
            unseen = m.transition[past, fallback] + m.unseen[fallback]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.concat_arrays([batch.column(0), nothing(some, pa.int64())]),
                    pa.array(np.concatenate([dk, dk[at]])),
                    pa.concat_arrays([pa.array(held_out_of(batch.column(0).to_pylist())), nothing(some, pa.bool_())]),
                    pa.array(np.concatenate([n_tokens.astype(np.int64), gather(3, np.int64)])),
                    pa.concat_arrays([pa.array(n_known.astype(np.int64)), nothing(some, pa.int64())]),
                    pa.concat_arrays([pa.array(base - n_tokens * denominator), nothing(some, pa.float64())]),
                    pa.array(np.concatenate([model_score, unseen])),
                    pa.concat_arrays([nothing(k, pa.binary()), words]),
                    pa.concat_arrays([nothing(k, pa.int16()), pa.array(past.astype(np.int16))]),
                ],
                ["doc_id", "dk", "held_out", "n", "known", "base", "score", "w", "past"],
            )

    kinds = "doc_id long, dk long, held_out boolean, n long, known long, base double, score double, w binary, past short"
    found_parts = written(rows.mapInArrow(released(local), kinds), "scores")
    texts, rare = found_parts.where("w is null"), found_parts.where("w is not null")
    c = F.col("c")
    joined = rare.select("dk", "n", "w", "past", F.col("score").alias("unseen")).join(model_words.select("w", "c", "cls"), "w", "left")
    numbers = lambda x: F.expr(f"array({','.join(f'{float(v)!r}D' for v in x.ravel())})")
    flat, inside = numbers(model.transition), numbers(model.size)
    of_known = F.get(flat, F.col("past") * CLASSES + F.col("cls")) + F.log10(c - discount) - F.get(inside, F.col("cls").cast("int"))
    sums = joined.groupBy("dk").agg(
        F.sum(F.when(c.isNotNull(), F.col("n")).otherwise(0)).alias("more"),
        F.sum(F.col("n") * F.log10(F.coalesce(c, F.lit(0)) + 1.0)).alias("base_more"),
        F.sum(F.col("n") * F.when(c.isNotNull(), of_known).otherwise(F.col("unseen"))).alias("score_more"),
    )
    copies = texts.groupBy("dk").agg(F.count("*").alias("copies"))  # rows given several times sent their words as often
    sums = sums.join(copies, "dk").select("dk", *[(F.col(x) / F.col("copies")).alias(x) for x in ("more", "base_more", "score_more")])
    more = lambda x: F.coalesce(F.col(x), F.lit(0.0))
    return texts.join(sums, "dk", "left").select(
        "doc_id",
        "held_out",
        F.col("n").alias("n_tokens"),
        (F.col("known") + more("more").cast("long")).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("base") + more("base_more")).alias("base_score"),
        (F.col("score") + more("score_more")).alias("score"),
    )
