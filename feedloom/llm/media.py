"""Media columns: content-addressed payloads in tar shards.

A text's UTF-8 bytes, filled with zero bytes to a positive multiple of 64, are the samples of an 8-bit grey image 64
samples wide. Each map task writes the distinct images it meets into one tar shard in the shared folder, named by their
SHA-256; rows carry digest, shard, offset and length. A content stored by several tasks keeps one address, the smallest.
Range reads of the first bytes of an image fill the metadata columns; reading whole images back gives the features.
"""

from __future__ import annotations

import hashlib
import struct
import tarfile
import uuid
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.llm.common import keyed, new_path, text_bytes, written

WIDTH = 64
LEVEL = 5
#: PNG's signature.
SIGNATURE = b"\x89PNG\r\n\x1a\n"
#: Signature and the header chunk.
HEADER = 33


def _chunk(kind: bytes, data: bytes) -> bytes:
    return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))


def png(payload: bytes) -> bytes:
    """The lossless grey image of a payload whose length is a positive multiple of the width."""
    rows = np.zeros((len(payload) // WIDTH, WIDTH + 1), np.uint8)
    rows[:, 1:] = np.frombuffer(payload, np.uint8).reshape(-1, WIDTH)
    head = struct.pack(">IIBBBBB", WIDTH, len(rows), 8, 0, 0, 0, 0)
    return SIGNATURE + _chunk(b"IHDR", head) + _chunk(b"IDAT", zlib.compress(rows.tobytes(), LEVEL)) + _chunk(b"IEND", b"")


def png_header(data: bytes) -> tuple[int, int, int]:
    """(width, height, bits) from an image's first bytes."""
    if data[:8] != SIGNATURE or data[12:16] != b"IHDR":
        raise ValueError("not a PNG header")
    return struct.unpack(">IIB", data[16:25])


def png_payload(data: bytes) -> bytes:
    """The samples of an image as png() makes it."""
    width, height, _ = png_header(data)
    at, body = HEADER, []
    while (kind := data[at + 4 : at + 8]) != b"IEND":
        size = struct.unpack(">I", data[at : at + 4])[0]
        if kind == b"IDAT":
            body.append(data[at + 8 : at + 8 + size])
        at += 12 + size
    rows = np.frombuffer(zlib.decompress(b"".join(body)), np.uint8).reshape(height, width + 1)
    if rows[:, 0].any():
        raise ValueError("filtered rows")
    return rows[:, 1:].tobytes()


def feature(payload: bytes) -> str:
    """64 bits as hex: the columns of the image that are brighter than the whole."""
    means = np.frombuffer(payload, np.uint8).reshape(-1, WIDTH).mean(axis=0)
    return np.packbits(means > means.mean()).tobytes().hex()


def padded(text: bytes) -> bytes:
    return text + bytes(-len(text) % WIDTH if text else WIDTH)


class Shard:
    """A tar file written beside its place and moved there when it is whole, so a task that runs again does no harm."""

    def __init__(self, folder: str, name: str):
        self.store, path = fs.FileSystem.from_uri(folder)
        self.store.create_dir(path)
        self.path, self.part = f"{path}/{name}", f"{path}/.{name}.{uuid.uuid4().hex}"
        self.out, self.at = self.store.open_output_stream(self.part), 0

    def add(self, name: str, data: bytes) -> int:
        """Returns the offset of the data."""
        info = tarfile.TarInfo(name)
        info.size = len(data)
        head = info.tobuf(tarfile.USTAR_FORMAT)
        self.out.write(head + data + bytes(-len(data) % 512))
        offset, self.at = self.at + len(head), self.at + len(head) + len(data) + -len(data) % 512
        return offset

    def close(self) -> None:
        self.out.write(bytes(1024))
        self.out.close()
        self.store.move(self.part, self.path)


MANIFEST = "doc_id long, n_bytes long, digest string, shard string, offset long, length long"
META = "digest string, width int, height int, bits int"
FEATURES = "digest string, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"


def store(docs: DataFrame, folder: str, text: str = "text") -> DataFrame:
    """Writes every text's image into shards below `folder` (a URI that all executors reach).

    One row per row of docs: doc_id, n_bytes (without the fill), digest (of the image), shard, offset, length. Equal texts
    have equal digests and one address. Null texts are empty, whose payload is 64 zero bytes. Nothing is shuffled but the
    rows of this manifest.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, shard, seen = f"shard-{TaskContext.get().partitionId():06d}.tar", None, {}
        for batch in batches:
            data, offs = text_bytes(batch.column(1))
            raw, rows = data.tobytes(), []
            for a, b in zip(offs.tolist(), offs[1:].tolist(), strict=False):
                payload = padded(raw[a:b])
                key = hashlib.sha256(payload).digest()
                if key not in seen:
                    image = png(payload)
                    shard = shard or Shard(folder, name)
                    digest = hashlib.sha256(image).hexdigest()
                    seen[key] = (digest, name, shard.add(f"{digest}.png", image), len(image))
                rows.append((b - a, *seen[key]))
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 5
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(x, t) for x, t in zip(columns, (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64()), strict=True))], ["doc_id", "n_bytes", "digest", "shard", "offset", "length"])
        if shard:
            shard.close()

    manifest = written(keyed(docs, text=text).select("doc_id", "text").mapInArrow(run, MANIFEST), "media-manifest")
    address = manifest.groupBy("digest").agg(F.min(F.struct("shard", "offset", "length")).alias("at")).select("digest", "at.shard", "at.offset", "at.length")
    return manifest.select("doc_id", "n_bytes", "digest").join(address, "digest").select("doc_id", "n_bytes", "digest", "shard", "offset", "length")


def addresses(media: DataFrame) -> DataFrame:
    """Each stored content once, ordered within its shard."""
    return media.groupBy("digest").agg(F.min(F.struct("shard", "offset", "length")).alias("at")).select("digest", "at.shard", "at.offset", "at.length")


def _reads(folder: str, batches: Iterable[pa.RecordBatch], most: int | None) -> Iterator[list[tuple[str, bytes]]]:
    """(digest, stored bytes or their first `most`) of each row; one shard is open at a time."""
    files, path = fs.FileSystem.from_uri(folder)
    name, file = None, None
    for batch in batches:
        rows = sorted(zip(*(batch.column(i).to_pylist() for i in (1, 2, 3, 0)), strict=True))
        out = []
        for shard, offset, length, digest in rows:
            if shard != name:
                name, file = shard, files.open_input_file(f"{path}/{shard}")
            file.seek(offset)
            out.append((digest, file.read(length if most is None else min(most, length))))
        yield out


def metadata(media: DataFrame, folder: str) -> DataFrame:
    """digest, width, height and bits of each content, from range reads of its header only."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for got in _reads(folder, batches, HEADER):
            yield pa.RecordBatch.from_pylist([dict(zip(("digest", "width", "height", "bits"), (digest, *png_header(data)), strict=True)) for digest, data in got], pa.schema([("digest", pa.string()), ("width", pa.int32()), ("height", pa.int32()), ("bits", pa.int32())]))

    return addresses(media).mapInArrow(run, META)


def features(media: DataFrame, folder: str) -> DataFrame:
    """What the stored bytes of each content give when they are read back and decoded."""
    kinds = pa.schema([("digest", pa.string()), ("payload_bytes", pa.int64()), ("payload_sha256", pa.string()), ("tail_crc32", pa.int64()), ("media_bytes", pa.int64()), ("media_sha256", pa.string()), ("feature", pa.string())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for got in _reads(folder, batches, None):
            rows = []
            for digest, data in got:
                payload = png_payload(data)
                rows.append((digest, len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-WIDTH:]), len(data), hashlib.sha256(data).hexdigest(), feature(payload)))
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows, strict=True) if rows else [[]] * 7, kinds, strict=True)], schema=kinds)

    return addresses(media).mapInArrow(run, FEATURES)


def media_columns(docs: DataFrame, folder: str | None = None, text: str = "text") -> DataFrame:
    """doc_id, n_bytes, payload and media columns, digest, shard, offset, length, width, height and bits of every row.

    Rows that repeat an id or a text stay repeated with equal values; null ids stay null; an empty table gives no rows and
    no shard; other columns of docs are not read, so their names may clash. A payload of any length is stored whole.
    """
    folder = folder or new_path(docs.sparkSession, "media")
    media = written(store(docs, folder, text), "media")
    known = metadata(media, folder).join(features(media, folder), "digest")
    return media.join(known, "digest").select("doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "digest", "shard", "offset", "length", "width", "height", "bits")
