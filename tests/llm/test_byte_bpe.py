from __future__ import annotations

import base64
import hashlib
import random

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from tests.llm.helpers import corpus, documents

from feedloom.llm import byte_bpe, token_counts

PATH = P.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    with open(PATH, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def vocabulary():
    return byte_bpe.Vocabulary.load(PATH)


def strange(seed, n):
    r = random.Random(seed)
    parts = [*"abc'stredlvm  \n\t.,!é日本ñ１2٣½ 　́🙂A", "'s", "'ll", "'re", " '", "\r\n", "  ", "the ", "<|endoftext|>"]
    return ["".join(r.choices(parts, k=r.randint(0, 40))) for _ in range(n)]


def test_as_the_library(spark, library):
    rows = list(enumerate(strange(1, 1500))) + corpus(3) + [(9000, "a" * 3000 + "日" * 500)]
    got = {}
    for r in byte_bpe.encode(documents(spark, rows), PATH, keep=("doc_id", "dk", "text"), digests=True).collect():
        got.setdefault((r.doc_id, r.text), []).append(r)
    assert sum(map(len, got.values())) == len(rows)
    for i, text in rows:
        ids = library.encode_ordinary(text or "")
        for r in got[i, text]:
            assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()), text


def test_ids_and_bytes(spark, library):
    got = {r.doc_id: r for r in byte_bpe.encode(documents(spark, [(1, "Hello there"), (2, None)]), PATH).collect()}
    assert got[1].token_ids == library.encode_ordinary("Hello there") and bytes(got[1].decoded) == b"Hello there"
    assert got[2].token_ids == [] and bytes(got[2].decoded) == b""
    assert byte_bpe.encode(documents(spark, [(1, "x")]).limit(0), PATH).count() == 0


def test_append_and_edit(vocabulary, library):
    r = random.Random(4)
    for _ in range(60):
        data = bytes(r.choices(b"abcdefghij tionerstha", k=r.randint(1, 120)))
        cut = r.randint(0, len(data))
        table = byte_bpe.Prefixes(vocabulary, data[:cut])
        table.append(data[cut:])
        assert table.ids() == byte_bpe.Prefixes(vocabulary, data).ids()
        a = r.randint(0, len(data))
        b = min(len(data), a + r.randint(0, 5))
        new = bytes(r.choices(b"xyzthe", k=r.randint(0, 4)))
        table.edit(a, b, new)
        whole = data[:a] + new + data[b:]
        assert table.data == whole and table.last == byte_bpe.Prefixes(vocabulary, whole).last
    table = byte_bpe.Prefixes(vocabulary, b"the quick brown fox jumps over " * 200)
    assert table.edit(10, 12, b"zz") < len(table.data) / 2


def thue_morse(n, flip):
    return "".join("ab"[(bin(i).count("1") + flip) % 2] for i in range(n))


def test_words_whose_hashes_collide(library):  # noqa: F811
    """Polynomial hashes modulo a power of two can't tell these words apart, whatever the base."""
    from feedloom.llm.common import distinct

    texts = [thue_morse(2048, 0), thue_morse(2048, 1)]
    raw = np.frombuffer("".join(texts).encode(), np.uint8)
    offs = np.array([0, 2048, 4096])
    encoder = byte_bpe.Encoder(byte_bpe.vocabulary(P.path("byte_bpe_multi_50k.tiktoken")))
    ids, bounds = encoder.encode(raw, offs)
    assert [ids[bounds[i] : bounds[i + 1]].tolist() for i in range(2)] == [library.encode_ordinary(t) for t in texts]
    assert len(distinct(raw, offs[:-1])[0]) == 2
    counter = token_counts.Counter(P.path("byte_bpe_50k.json"))
    alone = [int(counter.rows(raw[2048 * i : 2048 * i + 2048], np.array([0, 2048]))[0]) for i in range(2)]
    assert token_counts.Counter(P.path("byte_bpe_50k.json")).rows(raw, offs).tolist() == alone


def test_pieces_of_long_texts_and_small_pools(library):  # noqa: F811
    r = random.Random(8)
    parts = ["don't ", "x" * 40, "  \n\n", " 12,5", "é€ ", "'s", "\t", "\u00a0a", "  b", "中文"]
    texts = ["".join(r.choices(parts, k=300)), "", "z" * 5000, "a b", "".join(r.choices(parts, k=500))]
    raw = "".join(texts).encode()
    offs = np.cumsum([0, *(len(t.encode()) for t in texts)])
    encoder = byte_bpe.Encoder(byte_bpe.vocabulary(P.path("byte_bpe_multi_50k.tiktoken")))
    encoder.pool.most, encoder.pool.most_bytes = 5, 50
    for limit in (64, 300, 1 << 20):
        ids, bounds = encoder.encode(np.frombuffer(raw, np.uint8), offs, limit)
        assert [ids[bounds[i] : bounds[i + 1]].tolist() for i in range(5)] == [library.encode_ordinary(t) for t in texts]
