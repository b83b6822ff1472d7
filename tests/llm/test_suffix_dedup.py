from __future__ import annotations

import numpy as np
from tests.llm.helpers import corpus, documents

from feedloom.llm import suffix_dedup


def brute(rows):
    seen, out = set(), {}
    for i, text in sorted(set(rows), key=lambda r: (r[0] is not None, r[0] or 0)):
        data = (text or "").encode()
        gone = bytearray(len(data))
        for a in range(len(data) - 99):
            w = data[a : a + 100]
            if w in seen:
                gone[a : a + 100] = b"\1" * 100
            seen.add(w)
        out[i] = (len(data), sum(gone), sum(x and (not k or not gone[k - 1]) for k, x in enumerate(gone)), bytes(x for x, g in zip(data, gone, strict=True) if not g))
    return out


def test_against_brute_force(spark):
    rows = corpus() + [(110, "abc" * 90), (111, "z" + "abc" * 60 + "q" * 120)]
    got = suffix_dedup.dedup(documents(spark, rows), keep=("dk", "part")).collect()
    want = brute(rows)
    assert len(got) == len(rows) and want[906][1] > 0
    for r in got:
        assert (r.n_bytes, sum(s.end - s.begin for s in r.spans), len(r.spans), bytes(r.kept)) == want[r.doc_id], r.doc_id
        assert (r.dk, r.part) == ("x", 2)


def test_empty_table(spark):
    assert suffix_dedup.dedup(documents(spark, corpus()).limit(0)).count() == 0


def test_multikey_order():
    rng = np.random.default_rng(2)
    words = rng.integers(0, 3, (500, 5)).astype(np.uint64)
    group = rng.integers(0, 4, 500)
    order, run = suffix_dedup.multikey_order(words, group)
    rows = [(group[i], *words[i], i) for i in range(500)]
    assert [rows[i] for i in order] == sorted(rows)
    assert all((rows[a][:-1] == rows[b][:-1]) == (run[k] == run[k + 1]) for k, (a, b) in enumerate(zip(order, order[1:], strict=False)))


def test_slices_and_pieces_change_nothing(monkeypatch):
    rng = np.random.default_rng(7)
    body = rng.choice(np.frombuffer(b"ab", np.uint8), 3000)
    body[1000:1400] = body[:400]
    n = np.full(40, 60)
    offs = np.concatenate([rng.integers(0, 2800, 20), rng.integers(1000, 1200, 20)])
    c = {"n": n, "g": np.repeat([1, 2], 20)}
    want = suffix_dedup.repeated_windows(body, offs, c)
    for limit in (50, 300):
        got = suffix_dedup.repeated_windows(body, offs, c, limit)
        assert all((a == b).all() for a, b in zip(got, want, strict=True))
    text = rng.choice(np.frombuffer(b"abcdefgh", np.uint8), 9000)
    whole = suffix_dedup.anchors(text, np.array([0, 9000]))
    monkeypatch.setattr(suffix_dedup, "CHUNK", 2000)
    cut = suffix_dedup.anchors_of(text, np.array([0, 9000]))
    windows = lambda a: sorted((int(g), int(lo) + k) for g, lo, m in zip(a["g"], a["lo"], a["n"], strict=True) for k in range(m))
    assert windows(whole) == windows(cut) and len(cut["g"]) > len(whole["g"])
