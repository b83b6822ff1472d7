"""The pipeline's stages, each against what plain Python makes of its input."""

from __future__ import annotations

import hashlib
import os

import public_tokenizers as P
import pytest
from tests.llm.test_byte_bpe import library  # noqa: F401
from tests.llm.test_simhash import wide_fingerprint
from tests.llm.test_suffix_dedup import brute

import corpus_pipeline
from feedloom.llm import simhash
from feedloom.llm.common import written

DATA = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no tables")
def test_stages(spark, library):  # noqa: F811
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    columns, tables = docs.columns, [docs]
    for name, stage in corpus_pipeline.STAGES:
        tables.append(written(stage(spark, tables[-1], DATA), f"test-{name}"))
    start, good, single, cut, mixed, encoded = ([r.asDict() for r in t.collect()] for t in tables)
    assert all(t.columns == columns for t in tables[:-1])
    ids = lambda rows: {r["doc_id"] for r in rows}
    assert ids(good) <= ids(start) and ids(mixed) <= ids(cut) == ids(single) and ids(encoded) == ids(mixed)
    labels = {r.doc_id: r for r in spark.read.parquet(f"{DATA}/labels.parquet").collect()}
    assert {r["doc_id"] for r in start if r["doc_id"] in labels and labels[r["doc_id"]].quality and not labels[r["doc_id"]].toxic} <= ids(good)
    fps, radius = {r["doc_id"]: wide_fingerprint(r["text"], 5) for r in good}, simhash.radius_for(0.8)
    for i, f in fps.items():  # one of each group stays: the smallest, and each that went is linked to another
        if i not in ids(single):
            assert any((f ^ g).bit_count() <= radius for j, g in fps.items() if j != i)
    kept = sorted(ids(single))
    assert all((fps[a] ^ fps[b]).bit_count() > radius for k, a in enumerate(kept) for b in kept[k + 1 :])
    want = brute([(r["doc_id"], r["text"]) for r in single])
    assert {r["doc_id"]: r["text"] for r in cut} == {i: w[3].decode("utf-8", "replace") for i, w in want.items()}
    text = {r["doc_id"]: r["text"] for r in mixed}
    for r in encoded:
        assert r["token_ids"] == library.encode_ordinary(text[r["doc_id"]]) and r["decoded_sha256"] == hashlib.sha256(text[r["doc_id"]].encode()).hexdigest()
    assert P.PATTERN


def test_stage_list():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "repeated_passages", "mixing", "encoding"]
