from __future__ import annotations

import random

import numpy as np
from pyspark.sql import functions as F
from tests.llm.helpers import documents, words

from feedloom.llm import evidence, mixing, quality


def labelled(spark, n=1500):
    r = random.Random(11)
    say = lambda k: " ".join("".join(r.choices("abcdefgh", k=r.randint(2, 6))) for _ in range(k))
    rows, labels = [], []
    for i in range(n):
        kind = r.choice(["plain"] * 6 + ["poor", "poor", "toxic", "toxic"])
        t = say(r.randint(30, 80))
        t = t.upper().replace(" ", "!! ") if kind == "poor" else t.replace(" ", " vilewort ", 3) if kind == "toxic" else t
        rows.append((i, t))
        if i % 2:
            labels.append((i, int(kind != "poor"), int(kind == "toxic")))
        rows[-1] = (i, t, kind)
    labels += [(None, 1, 1), (1, None, None)]
    kinds = {i: k for i, _, k in rows}
    return documents(spark, [(i, t) for i, t, _ in rows] + [(n, None), (n + 1, "")]), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), kinds


def test_quality(spark):
    docs, labels, kinds = labelled(spark)
    got = quality.quality(docs, labels).collect()
    assert len(got) == len(kinds) + 2
    rest = [r for r in got if r.doc_id in kinds and r.doc_id % 2 == 0]
    assert np.mean([r.keep == (kinds[r.doc_id] == "plain") for r in rest]) > 0.95
    assert all(r.keep for r in rest if kinds[r.doc_id] == "plain")
    assert len({(r.source or "", r.path_rate) for r in got}) <= 8
    kept = quality.filtered(docs, labels)
    assert kept.columns == docs.columns and kept.count() == sum(r.keep for r in got)
    assert quality.quality(docs.limit(0), labels).count() == 0
    assert all(r.keep for r in quality.quality(docs, labels.limit(0)).collect())


def test_small_sites_are_shrunk(spark):
    rows = [("big", "en", 0.9)] * 500 + [("small", "en", 0.1)] * 2 + [("other", "en", 0.2)] * 300
    prior, rate = quality.priors(spark.createDataFrame(rows, "source string, lang string, p double"))
    p = {r.source: r.path_rate for r in prior.collect()}
    assert 0.1 < p["small"] < rate and abs(p["big"] - 0.9) < 0.02


def shares(rows):
    totals = np.array([sum(r.rate * r.n_tokens * getattr(r, f"p_{d}") for r in rows) for d in mixing.DOMAINS])
    return totals / totals.sum()


def test_mixing_meets_targets(spark):
    docs, labels, kinds = labelled(spark)
    targets = {"plain": 0.9, "poor": 0.05, "toxic": 0.05}
    got = mixing.mix(docs, labels, targets).collect()
    assert len(got) == len(kinds) + 2 and all(r.rate >= 0 for r in got)
    assert np.abs(shares(got) - [0.9, 0.05, 0.05]).max() < 1e-4
    default = mixing.mix(docs, labels).collect()
    assert np.abs(shares(default) - [mixing.TARGETS[d] for d in mixing.DOMAINS]).max() < 1e-4
    kept = mixing.sampled(docs, labels)
    assert kept.columns == docs.columns and kept.count() == sum(r.copies for r in default)
    assert mixing.mix(docs.limit(0), labels).count() == 0


def test_rates_against_projected_gradient_in_numpy(spark):
    """The least change of rates that meets the totals, found by many plain projected steps on the multipliers."""
    rng = np.random.default_rng(12)
    q, t, n = rng.beta(0.4, 0.2, 300), rng.beta(0.1, 0.5, 300), rng.integers(10, 100, 300)
    table = spark.createDataFrame([(float(a), float(b), int(c)) for a, b, c in zip(q, t, n, strict=True)], "p_quality double, p_toxic double, tokens long")
    for most in (np.inf, 1.5):
        x, totals = mixing.solve(table, {"plain": 0.8, "poor": 0.1, "toxic": 0.1}, most)
        p = np.stack([q * (1 - t), 1 - q, q * t], axis=1)
        target = np.array([0.8, 0.1, 0.1]) * (n @ p)[0] / 0.8 / n.sum()
        y, step = np.zeros(3), 1 / np.linalg.eigvalsh((p * n[:, None]).T @ p / n.sum())[-1]
        for _ in range(5_000):
            y = y + step * ((n * np.clip(1 - p @ y, 0, most)) @ p / n.sum() - target)
        assert np.abs(np.clip(1 - p @ x, 0, most) - np.clip(1 - p @ y, 0, most)).max() < 1e-3
        assert most < 2 or np.abs(totals - target).max() < 1e-4


def brute_probability(head, names, texts):
    """What the documented features give for each text, one by one."""
    out = []
    for text in texts:
        raw = (text or "").encode()
        n = max(len(raw), 1)
        share = np.array([sum(c in kind for c in raw) / n for kind in evidence.KINDS])
        tokens = words(text)
        lines = raw.splitlines(keepends=True) if raw else []
        count, some = max(len(tokens), 1), max(len(lines), 1)
        rest = [sum(len(w.encode()) for w in tokens) / count, np.log(count / some), len(set(lines)) / some, np.log(count)]
        shape = np.append(np.stack([share, np.log(share + 1e-3)], axis=1).ravel(), rest)
        z = np.clip((shape - head.centre) / head.scale, -8, 8)
        has = [float(m.decode() in tokens) for m in head.markers]
        out.append(1 / (1 + np.exp(-np.clip(np.r_[1, z, has] @ head.weights, -40, 40))))
    return out


def test_quality_against_brute_force(spark):
    docs, labels, _ = labelled(spark, 300)
    docs = docs.unionByName(docs.where("doc_id < 5"))
    rows = docs.collect()
    heads = evidence.fit(docs, labels, ("quality", "toxic"))
    p, toxic = (brute_probability(heads[n], n, [r.text for r in rows]) for n in ("quality", "toxic"))
    site, path = {}, {}
    for r, x in zip(rows, p, strict=True):
        for table, key in ((site, r.source or ""), (path, (r.source or "", r.lang or ""))):
            table.setdefault(key, []).append(x)
    rate = (sum(p) + 1) / (len(p) + 2)

    def strength(groups):
        n = np.array([len(v) for v, _ in groups])
        k, at = np.array([sum(v) for v, _ in groups]), np.array([r for _, r in groups])
        mean = (n * at * (1 - at)).sum() / n.sum()
        between = ((n * (k / n - at) ** 2).sum() - mean * len(n)) / n.sum()
        return min(quality.MOST, max(quality.LEAST, mean / between - 1)) if between > 0 else quality.MOST

    m = strength([(v, rate) for v in site.values()])
    host = {s: (sum(v) + m * rate) / (len(v) + m) for s, v in site.items()}
    m = strength([(v, host[k[0]]) for k, v in path.items()])
    prior = {k: (sum(v) + m * host[k[0]]) / (len(v) + m) for k, v in path.items()}
    logit = lambda x: np.log(min(max(x, 1e-6), 1 - 1e-6) / (1 - min(max(x, 1e-6), 1 - 1e-6)))
    want = {}
    for r, x, t in zip(rows, p, toxic, strict=True):
        post = 1 / (1 + np.exp(-(logit(x) - logit(rate) + logit(prior[r.source or "", r.lang or ""]))))
        want.setdefault(r.doc_id, []).append((x, post, t, post >= 0.5 and t < 0.5))
    got = quality.quality(docs, labels).collect()
    assert len(got) == len(rows)
    for r in got:
        assert any(np.allclose((r.p_document, r.p_quality, r.p_toxic), w[:3], atol=1e-9) and r.keep == w[3] for w in want[r.doc_id])


def test_long_texts_have_the_features_of_short_ones(monkeypatch):
    rng = random.Random(4)
    text = "".join(rng.choice(["a b", "Cd\n", " ", "x1!", "\n\n", "wörd ", "\r", "#"]) for _ in range(3000)).encode()
    data, offs = np.frombuffer(text, np.uint8), np.array([0, len(text)])
    shape, _, place, count, found = evidence.features_of(data, offs)
    monkeypatch.setattr(evidence, "FEATURE_CHUNK", 700)
    again = evidence.features_of(data, offs)
    assert np.allclose(shape, again[0]) and count == again[3] and {found[i] for i in place} == set(again[4])


def test_clashing_names_repeats_and_nulls(spark):
    docs, labels, _ = labelled(spark, 200)
    for name in ("_source", "_lang", "_p_quality", "_tokens", "_rate", "id", "h", "tokens", "rate", "copies", "keep", "posterior", "p_toxic", "dk", "node"):
        docs = docs.withColumn(name, F.lit(name))
    docs = docs.unionByName(docs.where("doc_id < 3"))
    kept, mixed = quality.filtered(docs, labels), mixing.sampled(docs, labels)
    assert kept.columns == docs.columns and mixed.columns == docs.columns
    want = {(r.doc_id, r.keep) for r in quality.quality(docs, labels).collect()}
    assert kept.count() == sum(k for r in docs.collect() for i, k in want if i == r.doc_id)
    assert all(r["keep"] == "keep" and r["rate"] == "rate" for r in mixed.collect())
    for f in (quality.filtered, mixing.sampled):
        assert f(docs.limit(0), labels).count() == 0
