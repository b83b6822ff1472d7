from __future__ import annotations

import public_tokenizers as P
import pytest
from tests.llm.helpers import corpus, documents
from tests.llm.test_byte_bpe import strange

from feedloom.llm import token_counts
from feedloom.llm.common import new_path


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"])
def test_as_the_library(spark, name):
    path = P.path(name)
    if name.endswith(".model"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        count = lambda t: len(model.encode(t, num_threads=1))
    else:
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        count = lambda t: len(tokenizer.encode(t, add_special_tokens=False).ids)
    rows = list(enumerate(strange(2, 400), 1000)) + corpus(4)
    want = sorted((str(i), len((t or "").encode()), count(t or ""), count(t or "") > 512) for i, t in rows)
    got = token_counts.token_counts(documents(spark, rows), path).collect()
    assert sorted((str(r.doc_id), r.n_bytes, r.n_tokens, r.over_limit) for r in got) == want


def test_cache_is_read_and_grown(spark):
    cache, path = new_path(spark, "cache"), P.path("byte_bpe_50k.json")
    first = documents(spark, [(1, "one two"), (2, "one two"), (3, None)])
    token_counts.token_counts(first, path, cache).collect()
    assert spark.read.parquet(cache).count() == 2
    token_counts.token_counts(documents(spark, [(1, "one two"), (4, "three")]), path, cache).collect()
    assert spark.read.parquet(cache).count() == 3
    token_counts.token_counts(first, P.path("word_bpe_49k.json"), cache).collect()
    assert spark.read.parquet(cache).count() == 5
    assert token_counts.token_counts(first.limit(0), path, cache).count() == 0
