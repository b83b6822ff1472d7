"""Byte-level BPE by prefix dynamic programming.

For every prefix of a byte string there is exactly one token that can end its encoding; storing it per prefix makes
appending exact and cheap, and an edit only needs the prefixes after it, up to where the old table is met again. A token
may end a prefix if the pair of it and the token stored for what stands before it is one that merging by rank leaves as
it is. Reading the stored tokens from the end gives the encoding that merging by rank gives.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.llm.common import CHUNK, chunks, distinct, pieces, ranges, released, text_bytes, text_of
from feedloom.llm.pretokens import Pool, may_cut, per_row, starts


class Vocabulary:
    """Ranks of a .tiktoken file: each token's bytes, its id and the pair that merging makes it from."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.longest = max(map(len, ranks), default=1)
        self.tokens = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            self.tokens[rank] = token
        sizes = np.array([len(t) for t in self.tokens], np.int64)
        self.sizes, self.begins = sizes, np.cumsum(sizes) - sizes
        self.flat = np.frombuffer(b"".join(self.tokens), np.uint8)
        self.pairs: dict[int, bool] = {}
        self._halves: dict[int, tuple[int, int] | None] = {}
        self.trie: dict[int, tuple[dict, int]] = {}
        for token, rank in ranks.items():
            node = self.trie
            for byte in token[:-1]:
                node = node.setdefault(byte, ({}, -1))[0]
            node[token[-1]] = (node.get(token[-1], ({}, -1))[0], rank)

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        with open(path, "rb") as file:
            return cls({base64.b64decode(a): int(b) for a, b in (line.split() for line in file if line.strip())})

    def halves(self, token: int) -> tuple[int, int] | None:
        """The two tokens whose merge makes this one; None for a single byte."""
        if token not in self._halves:
            parts = [self.ranks[bytes([b])] for b in self.tokens[token]]
            while len(parts) > 2:
                merged = [self.ranks.get(self.tokens[a] + self.tokens[b], 1 << 60) for a, b in zip(parts, parts[1:], strict=False)]
                i = merged.index(min(merged))
                if merged[i] >= token:
                    break
                parts[i : i + 2] = [merged[i]]
            self._halves[token] = (parts[0], parts[1]) if len(parts) == 2 else None
        return self._halves[token]

    def stays(self, left: int, right: int) -> bool:
        """Whether merging the bytes of both by rank ends in just these two tokens.

        It undoes the later of the two merges again and again: the pair is broken up if, at a time when both edges stand
        next to each other, a merge across them comes before the merge that hides one of them.
        """
        key = left << 32 | right
        if (known := self.pairs.get(key)) is not None:
            return known
        limit, a, b, out = 1 << 60, left, right, True
        while True:
            across = self.ranks.get(self.tokens[a] + self.tokens[b])
            if across is not None and across < limit:
                out = False
                break
            if a > b:
                limit, parts = a, self.halves(a)
                if parts is not None:
                    a = parts[1]
                    continue
                limit, parts = b + 1, self.halves(b)
                if parts is None:
                    break
                b = parts[0]
            else:
                limit, parts = b + 1, self.halves(b)
                if parts is not None:
                    b = parts[0]
                    continue
                limit, parts = a, self.halves(a)
                if parts is None:
                    break
                a = parts[1]
        if len(self.pairs) > 1_000_000:
            self.pairs.clear()
        self.pairs[key] = out
        return out


class Prefixes:
    """The last token of every prefix of one byte string."""

    def __init__(self, vocabulary: Vocabulary, data: bytes = b""):
        self.v, self.data, self.last = vocabulary, b"", []
        self.append(data)

    def append(self, more: bytes) -> None:
        """Only the new prefixes are worked out."""
        at = len(self.data)
        self.data += more
        self.last += [-1] * len(more)
        self._fill(at)

    def _fill(self, at: int) -> None:
        """Works out the prefixes longer than `at`; tokens are walked from each place they can begin, so the longest
        that ends a prefix is tried first."""
        data, last, trie, pairs, stays = self.data, self.last, self.v.trie, self.v.pairs, self.v.stays
        for begin in range(max(0, at + 1 - self.v.longest), len(data)):
            left = last[begin - 1] << 32 if begin else -1
            node, end = trie, begin
            for byte in data[begin : begin + self.v.longest]:
                if (hit := node.get(byte)) is None:
                    break
                node, token = hit
                if token >= 0 and last[end] < 0:
                    if left < 0 or (ok := pairs.get(left | token)) or ok is None and stays(left >> 32, token):
                        last[end] = token
                end += 1
            if last[begin] < 0:
                raise ValueError(f"no token for byte {data[begin]}")

    def edit(self, begin: int, end: int, new: bytes) -> int:
        """Puts `new` in place of the bytes from begin to end; returns how many prefixes were worked out again.

        A prefix depends on the `longest` prefixes before it, so once so many in a row past the edit agree with the old
        table the rest of it holds.
        """
        old, shift = self.last, len(new) - (end - begin)
        self.data = self.data[:begin] + new + self.data[end:]
        self.last, agree, step = old[:begin], 0, max(16, self.v.longest)
        whole, done = self.data, begin
        while done < len(whole):
            stop = min(len(whole), done + step)
            self.data = whole[:stop]
            self.last += [-1] * (stop - done)
            self._fill(done)
            for at in range(done, stop):
                agree = agree + 1 if at >= begin + len(new) and old[at - shift] == self.last[at] else 0
            done = stop
            if agree >= self.v.longest:
                self.last += old[done - shift :]
                break
        self.data = whole
        return done - begin

    def ids(self) -> list[int]:
        out, at = [], len(self.data)
        while at:
            out.append(token := self.last[at - 1])
            at -= len(self.v.tokens[token])
        return out[::-1]


class Trie:
    """The trie of a vocabulary as arrays: (node, byte) hashed to the next node, and the token that ends at each node."""

    def __init__(self, v: Vocabulary):
        edges, tokens, todo = [], [-1], [(0, v.trie)]
        for number, node in todo:
            for byte, (below, token) in node.items():
                edges.append((number << 8 | byte, len(tokens)))
                todo.append((len(tokens), below))
                tokens.append(token)
        self.token = np.array(tokens, np.int64)
        keys, to = np.array(edges, np.int64).reshape(-1, 2).T
        self.bits = max(4, int(4 * len(edges)).bit_length())
        self.keys, self.to = np.full(1 << self.bits, -1, np.int64), np.full(1 << self.bits, -1, np.int64)
        left, slot = np.arange(len(keys)), self._slot(keys)
        while len(left):
            free = self.keys[slot[left]] < 0
            put = left[free][np.unique(slot[left][free], return_index=True)[1]]
            self.keys[slot[put]], self.to[slot[put]] = keys[put], to[put]
            left = np.setdiff1d(left, put)
            slot[left] = (slot[left] + 1) & ((1 << self.bits) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def step(self, nodes: np.ndarray, data: np.ndarray) -> np.ndarray:
        keys = nodes << 8 | data
        slot, out = self._slot(keys), np.full(len(keys), -1, np.int64)
        left = np.arange(len(keys))
        while len(left):
            there = self.keys[slot[left]]
            hit = there == keys[left]
            out[left[hit]] = self.to[slot[left[hit]]]
            left = left[~hit & (there >= 0)]
            slot[left] = (slot[left] + 1) & ((1 << self.bits) - 1)
        return out


class Pairs:
    """Which pairs of tokens stay, for whole arrays; each pair is worked out once."""

    def __init__(self, v: Vocabulary, most: int = 1_000_000):
        self.v, self.most = v, most
        self.keys, self.stay = np.zeros(0, np.int64), np.zeros(0, bool)

    def __call__(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left << 32 | right
        for _ in range(2):
            at = np.minimum(np.searchsorted(self.keys, keys), max(len(self.keys) - 1, 0))
            known = self.keys[at] == keys if len(self.keys) else np.zeros(len(keys), bool)
            if known.all():
                break
            new = np.unique(keys[~known])
            stay = np.array([self.v.stays(k >> 32, k & 0xFFFFFFFF) for k in new.tolist()], bool)
            if len(self.keys) > self.most:
                self.keys, self.stay, new = np.zeros(0, np.int64), np.zeros(0, bool), np.unique(keys)
                stay = np.array([self.v.stays(k >> 32, k & 0xFFFFFFFF) for k in new.tolist()], bool)
            where = np.searchsorted(self.keys, new)
            self.keys, self.stay = np.insert(self.keys, where, new), np.insert(self.stay, where, stay)
        return self.stay[at]


#: Strings up to this many bytes share prefix tables of one width.
SHORT = 28


class Tables:
    """Prefix tables of many strings at once, a column for every length of prefix."""

    def __init__(self, v: Vocabulary):
        self.v, self.trie, self.pairs = v, Trie(v), Pairs(v)

    def encode(self, pieces: list[bytes]) -> list[np.ndarray | list[int]]:
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        out: list = [None] * len(pieces)
        for i in np.flatnonzero(sizes > SHORT):
            out[i] = Prefixes(self.v, pieces[i]).ids()
        for low, high in ((0, 6), (6, 10), (10, 16), (16, SHORT)):
            rows = np.flatnonzero((sizes > low) & (sizes <= high))
            if len(rows):
                for i, ids in zip(rows.tolist(), self._encode([pieces[i] for i in rows], sizes[rows], high), strict=True):
                    out[i] = ids
        return [x if x is not None else [] for x in out]

    def _encode(self, pieces: list[bytes], sizes: np.ndarray, width: int) -> list[np.ndarray]:
        n = len(pieces)
        data = np.zeros((n, width), np.int64)
        data[np.arange(width) < sizes[:, None]] = np.frombuffer(b"".join(pieces), np.uint8)
        found = np.full((width, width, n), -1, np.int32)  # by begin and last byte
        for begin in range(width):
            rows = np.flatnonzero(sizes > begin)
            nodes = np.zeros(len(rows), np.int64)
            for end in range(begin, width):
                inside = sizes[rows] > end
                rows, nodes = rows[inside], nodes[inside]
                if not len(rows):
                    break
                nodes = self.trie.step(nodes, data[rows, end])
                rows, nodes = rows[nodes >= 0], nodes[nodes >= 0]
                found[begin, end, rows] = self.trie.token[nodes]
        last = np.full((width, n), -1, np.int64)
        for end in range(width):
            for begin in range(end + 1):
                rows = np.flatnonzero((found[begin, end] >= 0) & (last[end] < 0))
                if len(rows) and begin:
                    rows = rows[self.pairs(last[begin - 1, rows], found[begin, end, rows].astype(np.int64))]
                last[end, rows] = found[begin, end, rows]
        # from the end: token after token
        at, steps = sizes.copy(), []
        while (open_ := np.flatnonzero(at > 0)).size:
            token = np.full(n, -1, np.int64)
            token[open_] = last[at[open_] - 1, open_]
            if (token[open_] < 0).any():
                raise ValueError("a byte has no token")
            at[open_] -= self.v.sizes[token[open_]]
            steps.append(token)
        ids = np.array(steps[::-1]).T
        flat = ids[ids >= 0]
        cuts = np.cumsum((ids >= 0).sum(axis=1))[:-1]
        return np.split(flat, cuts)


@lru_cache(4)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary.load(path)


@lru_cache(2)
def tables(path: str) -> Tables:
    """One for all tasks of a worker."""
    return Tables(vocabulary(path))


class Encoder:
    """Encodes many texts at once; each distinct match of the pattern goes through the prefix table once per worker."""

    def __init__(self, v: Vocabulary, made: Tables | None = None):
        self.v, self.pool, self.tables = v, Pool(), made or Tables(v)

    def encode(self, data: np.ndarray, offs: np.ndarray, limit: int = CHUNK) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all rows, where each row's ids begin, and the end). Rows beyond `limit` bytes go piece by piece."""
        cuts = pieces(data, offs, may_cut, limit)
        ids, bounds, done = [], [np.zeros(1, np.int64)], 0
        for _, _, part, edges in chunks(data, cuts, limit):
            made, ends = self._encode(part, edges)
            ids.append(made)
            bounds.append(ends[1:] + done)
            done += len(made)
        at = np.concatenate(bounds)
        return np.concatenate(ids) if ids else np.zeros(0, np.uint32), at if cuts is offs else at[np.searchsorted(cuts, offs)]

    def _encode(self, data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        begin = starts(data, offs)
        if not len(begin):
            return np.zeros(0, np.uint32), np.zeros(len(offs), np.int64)
        found, _, inverse = distinct(data, begin)
        places = self.pool.lookup(found, self.tables.encode)[inverse]
        sizes = np.concatenate([[0], np.cumsum(self.pool.size[places])])
        return self.pool.gather(places), sizes[per_row(begin, offs)]

    def decode(self, ids: np.ndarray) -> np.ndarray:
        return self.v.flat[ranges(self.v.begins[ids], self.v.sizes[ids])]

    def decode_offsets(self, ids: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        return np.concatenate([[0], np.cumsum(self.v.sizes[ids])])[bounds]


def encode(docs: DataFrame, path: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",), digests: bool = False) -> DataFrame:
    """Encodes every text by the ranks at `path` and decodes the ids again.

    Returns the columns of `keep` with n_tokens and, either `token_ids array<int>` and `decoded binary`, or with `digests`
    ids_sha256 and decoded_sha256 (of the ids as little-endian 32-bit integers and of the decoded bytes). Each match of
    the pattern is encoded by itself and there are no special tokens. Null and empty texts give no ids. Texts of any length
    are encoded whole; a long one is cut where a match begins in any case and goes through piece by piece. Rows stay as they are, repeated ones too; other columns are dropped,
    so their names may clash with the new ones. The work is one pass without a shuffle; the path must be one that every
    executor has, as an installed package's files are.
    """
    kinds = "ids_sha256 string, decoded_sha256 string" if digests else "token_ids array<int>, decoded binary"
    rows = docs.select(*[F.col(c).alias(f"k{i}") for i, c in enumerate(keep)], text_of(text).alias("t"))
    types = ", ".join(f"k{i} {docs.schema[c].dataType.simpleString()}" for i, c in enumerate(keep))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(vocabulary(path), tables(path))
        for batch in batches:
            for at, end, data, offs in chunks(*text_bytes(batch.column(len(keep)))):
                ids, bounds = encoder.encode(data, offs)
                back = encoder.decode(ids)
                cuts = encoder.decode_offsets(ids, bounds)
                pairs = [(ids[bounds[i] : bounds[i + 1]].astype("<u4"), back[cuts[i] : cuts[i + 1]].tobytes()) for i in range(end - at)]
                if digests:
                    made = [pa.array([hashlib.sha256(x.tobytes()).hexdigest() for x, _ in pairs], pa.string()), pa.array([hashlib.sha256(y).hexdigest() for _, y in pairs], pa.string())]
                else:
                    made = [pa.array([x.astype(np.int32) for x, _ in pairs], pa.list_(pa.int32())), pa.array([y for _, y in pairs], pa.binary())]
                yield pa.RecordBatch.from_arrays([*(pc.take(batch.column(i), pa.array(range(at, end))) for i in range(len(keep))), pa.array(np.diff(bounds), pa.int64()), *made], [*(f"k{i}" for i in range(len(keep))), "n_tokens", *(x.split()[0] for x in kinds.split(", "))])

    out = rows.mapInArrow(released(run), f"{types}, n_tokens long, {kinds}")
    return out.select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(keep)], *out.columns[len(keep) :])
