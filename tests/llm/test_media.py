from __future__ import annotations

import hashlib
import io
import tarfile
import zlib

from pyarrow import fs
from tests.llm.helpers import corpus, documents

from feedloom.llm import media
from feedloom.llm.common import new_path


def test_round_trip(spark):
    rows = corpus(5)
    folder = new_path(spark, "media")
    got = media.media_columns(documents(spark, rows), folder).collect()
    assert len(got) == len(rows)
    by_id = {}
    for i, t in rows:
        by_id.setdefault(i, []).append(t or "")
    store, path = fs.FileSystem.from_uri(folder)
    for r in got:
        payloads = [media.padded(t.encode()) for t in by_id[r.doc_id]]
        assert r.payload_sha256 in {hashlib.sha256(p).hexdigest() for p in payloads}
        p = next(p for p in payloads if hashlib.sha256(p).hexdigest() == r.payload_sha256)
        assert (r.payload_bytes, r.tail_crc32, r.width, r.height, r.bits) == (len(p), zlib.crc32(p[-64:]), 64, len(p) // 64, 8)
        with store.open_input_file(f"{path}/{r.shard}") as file:
            stored = file.read_at(r.length, r.offset)
        assert hashlib.sha256(stored).hexdigest() == r.media_sha256 == r.digest and len(stored) == r.media_bytes and media.png_payload(stored) == p
    same = {(r.payload_sha256, r.digest, r.shard, r.offset) for r in got}
    assert len(same) == len({r.payload_sha256 for r in got})
    shard = next(x.path for x in store.get_file_info(fs.FileSelector(path)) if x.path.endswith(".tar"))
    with store.open_input_file(shard) as file, tarfile.open(fileobj=io.BytesIO(file.read())) as tar:
        assert all(m.name.endswith(".png") for m in tar.getmembers())


def test_edges(spark):
    assert media.padded(b"") == bytes(64) and len(media.padded(b"x" * 64)) == 64 and len(media.padded(b"x" * 65)) == 128
    assert media.media_columns(documents(spark, [(1, "x")]).limit(0)).count() == 0
