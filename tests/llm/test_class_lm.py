from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from tests.llm.helpers import corpus, documents, words

from feedloom.llm import class_lm, common


def test_base_and_model(spark):
    rows = corpus(8, 200)
    got = class_lm.scores(documents(spark, rows)).collect()
    assert len(got) == len(rows)
    held = lambda i: zlib.crc32(b"" if i is None else str(i).encode()) % 7 == 2
    c = Counter(t for i, x in rows if not held(i) for t in [*words(x), "\0"])
    n, v = sum(c.values()), len(c)
    base = lambda x: sum(math.log10((c[t] + 1) / (n + v + 1)) for t in [*words(x), "\0"])
    want = sorted((str(i), held(i), len(words(x)) + 1, sum(c[t] > 0 for t in [*words(x), "\0"]), n, round(base(x), 6)) for i, x in rows)
    assert sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == want
    assert all(math.isfinite(r.score) and r.score < 0 for r in got)
    assert sum(r.score for r in got if r.held_out) > sum(r.base_score for r in got if r.held_out)
    same = {r.score for r in got if r.doc_id == 903}
    assert len(same) == 1


def test_without_training_rows(spark):
    none = [i for i in range(200) if zlib.crc32(str(i).encode()) % 7 == 2][:3]
    got = class_lm.scores(documents(spark, [(i, "a b") for i in none])).collect()
    assert [(r.n_known, r.train_tokens) for r in got] == [(0, 0)] * 3 and all(math.isfinite(r.score) for r in got)
    assert class_lm.scores(documents(spark, [(1, "x")]).limit(0)).count() == 0


def test_exchange_finds_classes():
    rng = np.random.default_rng(9)
    kind = rng.integers(0, 3, 41)
    pairs = np.zeros((41, 41))
    state = 0
    for _ in range(60_000):
        state_kind = (kind[state] + 1) % 3
        new = rng.choice(np.flatnonzero(kind[:40] == state_kind))
        pairs[state, new] += 1
        state = new
    cls = class_lm.exchange(pairs, classes=4, sweeps=6)[:40]
    assert len({(k, c) for k, c in zip(kind[:40], cls, strict=True)}) == 3


def test_model_is_a_distribution():
    rng = np.random.default_rng(10)
    counts, cls = rng.integers(1, 50, 300), rng.integers(0, 10, 300)
    table = rng.dirichlet(np.ones(10), 10) * 5
    table = table / table.sum(axis=0) * np.bincount(cls, counts, 10)
    m = class_lm.Model(table, np.bincount(cls, minlength=10), 0.5)
    assert np.allclose((10**m.transition).sum(axis=1), 1)
    assert np.allclose(np.bincount(cls, 10 ** m.known(counts, cls), 10) + 10**m.unseen, 1)


def brute_scores(rows):
    """The model of the docstring, word by word in plain Python; the exchange of units is the operator's own."""
    held = lambda i: zlib.crc32(b"" if i is None else str(i).encode()) % 7 == 2
    train = [[w.encode() for w in words(x)] for i, x in rows if not held(i)]
    c = Counter(w for t in train for w in t)
    order = sorted(c, key=lambda w: (-c[w], w))
    frequent = {w: i for i, w in enumerate(order[: class_lm.WORDS])}
    code = {}

    def unit(w):
        if w in frequent:
            return frequent[w]
        if w not in code:
            tail = w[-3:][::-1]
            value = 0
            for k in range(3):
                value = value * 257 + (tail[k] + 1 if k < len(tail) else 0)
            code[w] = class_lm.WORDS + int(class_lm.mixed(np.array([value], np.uint64))[0] % np.uint64(class_lm.ENDINGS))
        return code[w]

    pairs = np.zeros((class_lm.UNITS, class_lm.UNITS))
    for t in train:
        u = [class_lm.END, *(unit(w) for w in t), class_lm.END]
        for a, b in zip(u, u[1:], strict=False):
            pairs[a, b] += 1
    cls = class_lm.exchange(pairs)
    member = np.eye(class_lm.CLASSES)[cls]
    table = member.T @ pairs @ member
    past = {}
    for t in train:
        before = class_lm.END
        for w in t:
            past.setdefault(w, Counter())[cls[before]] += 1
            before = unit(w)
    f = lambda x: x * math.log(x) if x > 0 else 0.0
    of = {}
    for w in c:
        own = cls[unit(w)]
        of[w] = own
        if w in frequent:
            continue
        gains = []
        for b in range(class_lm.CLASSES - 1):
            sign = -1 if b == own else 1
            gain = sum(sign * (f(max(table[h, b] + sign * n, 0)) - f(table[h, b])) for h, n in past[w].items())
            total = table[:, b].sum()
            gains.append(gain - sign * (f(max(total + sign * c[w], 0)) - f(total)))
        best = int(np.argmax(gains))
        if gains[best] - gains[own] > math.log(class_lm.CLASSES):
            of[w] = best
    counts, types = np.zeros((class_lm.CLASSES, class_lm.CLASSES)), np.zeros(class_lm.CLASSES)
    for w, h in past.items():
        types[of[w]] += 1
        for k, n in h.items():
            counts[k, of[w]] += n
    counts[:, cls[class_lm.END]] += member.T @ pairs[:, class_lm.END]
    n1, n2 = sum(x == 1 for x in c.values()), sum(x == 2 for x in c.values())
    d = min(0.95, max(0.05, n1 / (n1 + 2 * n2)))
    size = counts.sum(axis=0)
    share = (size + 1) / (size.sum() + class_lm.CLASSES)
    move = lambda h, k: math.log10((counts[h, k] + class_lm.BETA * share[k]) / (counts[h].sum() + class_lm.BETA))
    out = []
    for _, x in rows:
        before, score = class_lm.END, 0.0
        for w in (t.encode() for t in words(x)):
            k = of.get(w, cls[unit(w)])
            score += move(cls[before], k)
            if w in c:
                score += math.log10(c[w] - d) - math.log10(size[k])
            elif types[k]:
                score += math.log10(d * types[k]) - math.log10(size[k])
            before = unit(w)
        out.append(score + move(cls[before], cls[class_lm.END]))
    return out, of, cls, unit


def test_score_against_brute_force(spark, monkeypatch):
    r = random.Random(5)
    kinds = [["".join(r.choices("abcdefghijklmn", k=5)) for _ in range(500)] for _ in range(3)]
    rows = [(i, " ".join(kinds[k % 3][int(500 * r.random() ** 2)] for k in range(r.randint(0, 120)))) for i in range(300)]
    rows += [(400, None), (401, rows[5][1]), (401, rows[5][1]), (None, "never seen words"), (402, "x" * 70 + " a")]
    want, of, cls, unit = brute_scores(rows)
    assert any(of[w] != cls[unit(w)] for w in of)  # some words left the class of their ending
    docs = documents(spark, rows)
    monkeypatch.setattr(class_lm, "HELD", class_lm.WORDS + 40)
    for _ in range(2):  # with words that meet their counts in a join, and with all of them held
        got = class_lm.scores(docs).collect()
        assert sorted((str(r.doc_id), round(r.score, 6)) for r in got) == sorted((str(i), round(s, 6)) for (i, _), s in zip(rows, want, strict=True))
        monkeypatch.setattr(class_lm, "HELD", 65_536)


def test_words_are_exchanged_by_the_batch():
    """op3: a word's counts add up over rows and batches, and words are judged a batch at a time, not row by row."""
    r, calls = np.random.default_rng(4), []

    def keep(group, cell, n, own):
        calls.append(len(own))
        return own

    rows = [(w, w[0] % 7, [(int(c), int(r.integers(1, 9))) for c in sorted(set(r.integers(0, 63, 3)))]) for w in sorted(b"%c%d" % (97 + k % 3, k // 40) for k in range(120))]
    rows += [(b"z", 3, [(5, 2**32 - 1)])] * 30
    packed = [(w, own, np.array(cells, class_lm.RECORD).tobytes()) for w, own, cells in rows]
    schema = pa.schema([("w", pa.binary()), ("own", pa.int8()), ("cells", pa.binary())])
    batches = [pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*packed[i : i + 7]), schema)], schema=schema) for i in range(0, len(packed), 7)]
    found = [row for b in class_lm.exchanged(iter([batches[0].slice(0, 0), *batches]), keep) for row in b.to_pylist()]
    want = {}
    for w, own, cells in rows:
        counts = want.setdefault(w, (own, Counter()))[1]
        for cell, n in cells:
            counts[cell] += n
    assert [x["w"] for x in found] == sorted(want) and len(calls) <= len(batches) + 1
    for x in found:
        own, counts = want[x["w"]]
        assert (x["cls"], x["c"], dict(zip(x["cells"], x["ns"], strict=True))) == (own, sum(counts.values()), dict(counts))


def test_pieces_of_rows():
    texts = ["a b c " * 50, "", "x" * 90, " ", "one two", "", "q w e r " * 30]
    raw = np.frombuffer("".join(texts).encode(), np.uint8)
    offs = np.cumsum([0, *map(len, texts)])
    for limit in (16, 64, 1000):
        seen = {}
        for tokens, rows, first in class_lm.parts_of(raw, offs, limit):
            for i, (r, f) in enumerate(zip(rows.tolist(), first.tolist(), strict=True)):
                assert f == (r not in seen)
                seen.setdefault(r, []).extend(tokens.found[p].decode() for p in tokens.place[tokens.bounds[i] : tokens.bounds[i + 1]])
        assert seen == {i: words(t) for i, t in enumerate(texts)}


def test_words_are_told_apart_without_an_index_of_bytes(monkeypatch):
    """op3: words are found and compared eight bytes at a time, not by a number for every byte; equal hashes alone don't count."""
    monkeypatch.setattr(common, "ranges", None)
    texts = ["The cat", "", "cat\tthe  CAT\n", " verylongword verylongworD verylongwörd ", "x", "y x"]
    data = [t.encode() for t in texts]
    tokens = class_lm.Tokens(np.frombuffer(b"".join(data), np.uint8), np.cumsum([0, *map(len, data)]))
    got = [[tokens.found[i] for i in tokens.place[a:b]] for a, b in zip(tokens.bounds, tokens.bounds[1:], strict=False)]
    assert got == [re.findall(rb"[^\x20\x09-\x0d]+", t.lower()) for t in data] and len(set(tokens.found)) == len(tokens.found)
    monkeypatch.setattr(common.Rolling, "span", lambda self, start, end: np.zeros(len(start), np.uint64))
    found, _, inverse = common.distinct(np.frombuffer(b"abcdefghi1abcdefghi2abcdefghi1", np.uint8), np.array([0, 10, 20]))
    assert found == [b"abcdefghi1", b"abcdefghi2"] and inverse.tolist() == [0, 1, 0]
