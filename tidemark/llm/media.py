"""Media columns: content-addressed payloads in tar shards, found by digest, offset and length.

A text's bytes, filled up with 255 to a positive multiple of 576, are the samples of an 8-bit grey PNG image 576
wide. Each task writes its images to tar shards on the shared folder, one member for each digest it meets, and
each row carries the digest, shard, offset and length. Where several shards hold a digest, all rows refer to that in
the first of them (by partition): every image has one address. Metadata columns come from a range read of the header
alone; payload columns from a range read of the member.

A digest that very many rows share is no hot key: rows find what is known of their image by the member that their own
task wrote, of which each task has one, and only these members meet by digest.

Defined results: a null text is empty and, like an empty one, 576 bytes of 255; equal texts have equal values and
one address; very long texts are one image each; ids may be null or repeated, each row gets a row; other columns are
ignored, whatever their names; no rows give no shards.
"""

from __future__ import annotations

import hashlib
import struct
import tarfile
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.files import attempt_name, open_input, open_output, shared_dir, written

WIDTH = 576
SHARD_BYTES = 256 << 20
#: Bytes of an image file up to the end of its header chunk.
HEADER_BYTES = 33
_MAGIC = b"\x89PNG\r\n\x1a\n"


def padded(text: bytes) -> bytes:
    return text + b"\xff" * (-len(text) % WIDTH if text else WIDTH)


def _chunk(kind: bytes, body: bytes) -> bytes:
    return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))


def to_png(payload: bytes) -> bytes:
    """A grey image, 576 samples a row, of a payload of a positive multiple of 576 bytes."""
    rows = np.zeros((len(payload) // WIDTH, WIDTH + 1), np.uint8)
    rows[:, 1:] = np.frombuffer(payload, np.uint8).reshape(-1, WIDTH)
    head = struct.pack(">IIBBBBB", WIDTH, len(rows), 8, 0, 0, 0, 0)
    return _MAGIC + _chunk(b"IHDR", head) + _chunk(b"IDAT", zlib.compress(rows.tobytes(), 6)) + _chunk(b"IEND", b"")


def png_header(start: bytes) -> tuple[int, int, int]:
    """Width, height and bits of a sample, from the first 33 bytes."""
    if start[:8] != _MAGIC or start[12:16] != b"IHDR":
        raise ValueError("not an image")
    width, height, bits = struct.unpack(">IIB", start[16:25])
    return width, height, bits


def from_png(data: bytes) -> bytes:
    """The samples of an image that ``to_png`` made; checks every chunk's sum."""
    width, height, _ = png_header(data)
    at, body = 8, []
    while at < len(data):
        (n,) = struct.unpack(">I", data[at : at + 4])
        chunk = data[at + 4 : at + 8 + n]
        if struct.unpack(">I", data[at + 8 + n : at + 12 + n])[0] != zlib.crc32(chunk):
            raise ValueError("an image is damaged")
        if chunk[:4] == b"IDAT":
            body.append(chunk[4:])
        at += 12 + n
    rows = np.frombuffer(zlib.decompress(b"".join(body)), np.uint8).reshape(height, width + 1)
    if rows[:, 0].any():
        raise ValueError("a row has a filter that is not used here")
    return rows[:, 1:].tobytes()


class _Shards:
    """Tar files of at most about SHARD_BYTES; an image is stored once in each. A file's number is of its partition and its turn."""

    def __init__(self, folder: str, part: int):
        self.folder, self.out, self.known, self.number = folder, None, {}, (part << 20) - 1

    def put(self, data: bytes) -> tuple[bytes, int, str, int, int]:
        digest = hashlib.sha256(data).digest()
        if digest not in self.known:
            if self.out is None or self.at > SHARD_BYTES:
                self.close()
                self.known.clear()
                self.name, self.at = f"{self.folder}/{attempt_name('media')}.tar", 0
                self.number += 1
                self.out = open_output(self.name)
            info = tarfile.TarInfo(f"{digest.hex()[:2]}/{digest.hex()}.png")
            info.size = len(data)
            head = info.tobuf(tarfile.GNU_FORMAT)
            fill = b"\0" * (-len(data) % 512)
            self.out.write(head + data + fill)
            self.known[digest] = (self.number, self.name, self.at + len(head), len(data))
            self.at += len(head) + len(data) + len(fill)
        return digest, *self.known[digest]

    def close(self):
        if self.out is not None:
            self.out.write(b"\0" * 1024)
            self.out.close()
        self.out = None


def _store(folder: str):
    def run(batches):
        shards = _Shards(folder, TaskContext.get().partitionId())
        for batch in batches:
            rows = []
            for text in batch.column(1):
                raw = text.as_py()
                raw = raw.encode("utf-8", "surrogatepass") if isinstance(raw, str) else raw or b""
                rows.append((len(raw), *shards.put(to_png(padded(raw)))))
            kinds = (pa.int64(), pa.binary(), pa.int64(), pa.string(), pa.int64(), pa.int64())
            cols = [pa.array(x, k) for x, k in zip(zip(*rows) if rows else [()] * 6, kinds)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *cols], names=["id", "n_bytes", "digest", "member", "shard", "offset", "length"])
        shards.close()

    return run


def store_media(docs: DataFrame, folder: str, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """Write the shards; two tables in ``folder``.

    Rows: (id, n_bytes, member, at), a row for each row of ``docs`` with the number of the file and the offset that its task
    wrote. Members: (member, at, first, digest, shard, offset, length), each with the one address that its digest has; first
    says that it is the one.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    schema = f"id {rows.schema['id'].dataType.simpleString()}, n_bytes long, digest binary, member long, shard string, offset long, length long"
    raw = written(rows.mapInArrow(_store(f"{folder}/shards"), schema), f"{folder}/rows")
    own = raw.groupBy("member", "offset").agg(F.first("digest").alias("digest"), F.first("shard").alias("shard"), F.first("length").alias("length"))
    place = own.groupBy("digest").agg(F.min(F.struct("member", "offset", "shard", "length")).alias("p"))
    first = (F.col("member") == F.col("p.member")) & (F.col("offset") == F.col("p.offset"))
    members = own.join(place, "digest").select("member", F.col("offset").alias("at"), first.alias("first"), "digest", "p.shard", "p.offset", "p.length")
    return raw.select("id", "n_bytes", "member", F.col("offset").alias("at")), written(members, f"{folder}/members")


def _headers(batches):
    for batch in batches:
        rows, path, source = [], None, None
        for shard, offset in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            if shard != path:
                if source is not None:
                    source.close()
                path, source = shard, open_input(shard)
            rows.append("png:%dx%d:%d" % png_header(source.read_at(HEADER_BYTES, offset)))
        if source is not None:
            source.close()
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.string())], names=["digest", "feature"])


def _payloads(batches):
    for batch in batches:
        rows, path, source = [], None, None
        for digest, shard, offset, length in zip(*(batch.column(c).to_pylist() for c in range(4))):
            if shard != path:
                if source is not None:
                    source.close()
                path, source = shard, open_input(shard)
            data = source.read_at(length, offset)
            if hashlib.sha256(data).digest() != digest:
                raise ValueError(f"{shard} at {offset} is not what its digest says")
            payload = from_png(data)
            rows.append((len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]), len(data), digest.hex(), "png:%dx%d:%d:mean=%d" % (*png_header(data[:HEADER_BYTES]), int(np.frombuffer(payload, np.uint8).sum(dtype=np.int64)) * 1000 // len(payload))))
        if source is not None:
            source.close()
        kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string())
        cols = [pa.array(x, k) for x, k in zip(zip(*rows) if rows else [()] * 6, kinds)]
        yield pa.RecordBatch.from_arrays([batch.column(0), *cols], names=["digest", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"])


def _objects(stored: DataFrame) -> DataFrame:
    """Each address once, in the order of the shards, so that reads run forward."""
    return stored.where("first").select("digest", "shard", "offset", "length").repartitionByRange("shard", "offset").sortWithinPartitions("shard", "offset")


def media_headers(stored: DataFrame) -> DataFrame:
    """(digest, feature) from a 33-byte range read of each stored image."""
    return _objects(stored).mapInArrow(_headers, "digest binary, feature string")


def media_facts(stored: DataFrame) -> DataFrame:
    """(digest, payload_bytes, payload_sha256, tail_crc32, media_bytes, media_sha256, feature) of each stored image, read back."""
    return _objects(stored).mapInArrow(_payloads, "digest binary, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string")


def media_columns(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Store, read back, and one row for each row of ``docs`` with its address, header metadata and payload facts."""
    folder = shared_dir(docs.sparkSession, "media")
    rows, members = store_media(docs, folder, id_col, text_col)
    known = media_facts(members).join(media_headers(members).withColumnRenamed("feature", "header"), "digest")
    known = members.join(known, "digest").drop("digest")
    return rows.join(known, ["member", "at"]).select(F.col("id").alias(id_col), "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "header", F.regexp_extract("shard", "[^/]+$", 0).alias("shard"), "offset", "length")
