from __future__ import annotations

import logging

import numpy as np
from pyspark.sql import functions as F
from tests.llm.test_quality_and_mixing import labelled

from feedloom.llm import mixing

WANT = [mixing.TARGETS[d] for d in mixing.DOMAINS]


def shares(rows):
    totals = np.array([sum(r.rate * r.tokens * getattr(r, f"p_{d}") for r in rows) for d in mixing.DOMAINS])
    return totals / totals.sum()


def test_registered_default_meets_its_targets(spark, caplog):
    docs, labels, _ = labelled(spark)
    with caplog.at_level(logging.INFO, "feedloom.llm.mixing"):
        got = mixing.rated(docs, labels).collect()
    assert np.abs(shares(got) - WANT).max() < 0.01 and "meets its targets" in caplog.text


def test_scarce_domains_are_raised_or_the_miss_is_told(spark, caplog):
    docs, labels, kinds = labelled(spark)
    few = [i for k, n in (("plain", 600), ("poor", 4), ("toxic", 8)) for i in [i for i in kinds if kinds[i] == k][:n]]
    left = docs.where(F.col("doc_id").isin(few))
    got = mixing.rated(left, labels, learn=docs).collect()
    assert np.abs(shares(got) - WANT).max() < 0.01 and max(r.rate for r in got) > 1
    with caplog.at_level(logging.WARNING, "feedloom.llm.mixing"):
        mixing.rated(left, labels, most=1.0, learn=docs)
    assert "misses its targets" in caplog.text
