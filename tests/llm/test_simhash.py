from __future__ import annotations

import random
from collections import defaultdict

import numpy as np
import xxhash
from pyspark.sql import functions as F
from tests.llm.helpers import corpus, documents, words

from feedloom.llm import simhash
from feedloom.llm.common import mixed
from feedloom.llm.components import components, forest
from feedloom.llm.xxh import xxh64


def fingerprint(text):
    w = words(text)
    shingles = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [" ".join(w)] if w else []
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in shingles]
    return sum(1 << i for i in range(64) if h and 2 * sum(x >> i & 1 for x in h) > len(h))


def wide_fingerprint(text, shingle, bits=simhash.WIDE):
    w = words(text)
    shingles = [" ".join(w[i : i + shingle]) for i in range(len(w) - shingle + 1)] if len(w) >= shingle else [" ".join(w)] if w else []
    h = np.array([xxhash.xxh64_intdigest(x.encode(), 42) for x in shingles], np.uint64)
    lanes = [h, *(mixed(h ^ simhash.SALTS[i]) for i in range(1, bits // 64))]
    out = 0
    for i, lane in enumerate(lanes):
        for b in range(64):
            if len(h) and 2 * int((lane >> np.uint64(b) & np.uint64(1)).sum()) > len(h):
                out |= 1 << (64 * i + b)
    return out


def test_wide_fingerprints_measure_similarity(spark):
    r = random.Random(9)
    word = lambda: "".join(r.choices("abcdefghij", k=6))
    rows, want = [], {}
    for i in range(40):
        base = [word() for _ in range(300)]
        rows.append((10 * i, " ".join(base)))
        for k, changed in enumerate((2, 3, 40), 1):  # similarity about 0.94, 0.91 and 0.28
            other = list(base)
            for at in r.sample(range(300), changed):
                other[at] = word()
            rows.append((10 * i + k, " ".join(other)))
            if changed == 40:
                want[10 * i + k] = 10 * i + k
            else:
                want[10 * i + k] = 10 * i
        want[10 * i] = 10 * i
    docs = documents(spark, rows)
    got = simhash.near_duplicates(docs, simhash.radius_for(0.8), 5, bits=256).collect()
    assert {x.doc_id: x.component_id for x in got} == want
    fps = {x.doc_id: sum((v & (1 << 64) - 1) << 64 * i for i, v in enumerate(x.fp)) for x in got}
    assert all(fps[i] == wide_fingerprint(t, 5) for i, t in rows[:12])


def test_wide_tiles_lose_no_link():
    rng = np.random.default_rng(5)
    x = rng.integers(0, 1 << 63, (700, 4), dtype=np.uint64)
    near = x[:300].copy()
    for row in near:
        for bit in rng.choice(256, rng.integers(1, 60), replace=False):
            row[bit // 64] ^= np.uint64(1) << np.uint64(bit % 64)
    x = np.concatenate([x, near])
    dist = np.bitwise_count(x[:, None] ^ x[None, :]).astype(int).sum(axis=2)
    a, b = np.nonzero(dist <= 40)
    want = forest(len(x), a, b)
    assert (forest(len(x), *simhash.compare(x, x, 40)) == want).all()
    u, v = simhash.compare(x[:500], x[500:], 40)
    a, b = np.nonzero(dist[:500, 500:] <= 40)
    assert (forest(len(x), u, v) == forest(len(x), a, b + 500)).all()


def test_long_texts_piece_by_piece(monkeypatch):
    r = random.Random(3)
    for text in (" ".join(r.choices(["ab", "Cde", "f\n", "é"], k=900)), "x" * 3000, "one " + "y" * 4000 + " two", " " * 3000, ""):
        raw = np.frombuffer(text.encode(), np.uint8)
        offs = np.array([0, len(raw)])
        for shingle, bits in ((3, 64), (5, 256)):
            want = simhash.fingerprints_of(raw, offs, shingle, bits)
            with monkeypatch.context() as m:
                m.setattr(simhash, "SHINGLE_CHUNK", 500)
                assert (simhash.fingerprints_of(raw, offs, shingle, bits) == want).all()


def test_xxh64():
    rng = np.random.default_rng(1)
    parts = [rng.bytes(int(n)) for n in rng.integers(0, 200, 400)]
    size = np.array([len(p) for p in parts])
    got = xxh64(np.frombuffer(b"".join(parts), np.uint8), np.cumsum(size) - size, size)
    assert got.tolist() == [xxhash.xxh64_intdigest(p, 42) for p in parts]


def test_against_brute_force(spark):
    rows = corpus(2) + [(200 + i, " ".join([f"w{k}" for k in range(300)] + [f"e{i}"])) for i in range(8)]
    got = simhash.near_duplicates(documents(spark, rows)).collect()
    assert len(got) == len(rows)
    fps = {(i, t): fingerprint(t) for i, t in rows}
    names = list(fps)
    x = np.array([fps[n] for n in names], np.uint64)
    a, b = np.nonzero(np.bitwise_count(x[:, None] ^ x[None, :]) <= 3)
    root = forest(len(x), a, b)
    least = defaultdict(list)
    for n, r in zip(names, root, strict=True):
        if n[0] is not None:
            least[r].append(n[0])
    want = sorted((str(n[0]), f"{fps[n]:016x}", str(min(least[r])) if least[r] else "None") for n, r in zip(names, root, strict=True) for _ in range(rows.count(n)))
    shown = simhash.near_duplicates(documents(spark, rows)).select("doc_id", simhash.hex_of().alias("h"), "component_id").collect()
    assert sorted((str(r.doc_id), r.h, str(r.component_id)) for r in shown) == want


def test_keep_one(spark):
    rows = [(5, "a b c d e"), (3, "a b c d e"), (3, "a b c d e"), (9, "completely other words here now")]
    kept = simhash.keep_one(documents(spark, rows)).collect()
    assert sorted(r.doc_id for r in kept) == [3, 9] and kept[0].dk == "x"
    docs = documents(spark, rows)
    for name in ("root", "stays", "node", "h", "m", "a", "b", "p", "tile"):
        docs = docs.withColumn(name, F.lit(name))
    assert simhash.keep_one(docs).columns == docs.columns and simhash.keep_one(docs).count() == 2
    assert simhash.keep_one(documents(spark, rows).limit(0)).count() == 0


def test_tiles_lose_no_link():
    rng = np.random.default_rng(3)
    x = np.unique(rng.integers(0, 1 << 63, 800, dtype=np.uint64))
    flips = x[:200] ^ (np.uint64(1) << rng.integers(0, 64, 200, dtype=np.uint64)) ^ (np.uint64(1) << rng.integers(0, 64, 200, dtype=np.uint64))
    x = np.unique(np.concatenate([x, flips]))
    a, b = np.nonzero(np.bitwise_count(x[:, None] ^ x[None, :]) <= 3)
    whole = x[:, None]
    u, v = simhash.compare(whole, whole, 3)
    assert (forest(len(x), a, b) == forest(len(x), u, v)).all()


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {i: 0 for i in range(41)} | {100 + i: 100 for i in range(30)}
