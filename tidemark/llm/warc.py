"""WARC archives of pages: segmented, chunk-framed records, and their reassembly.

Writing: of the pages with equal payloads that with the smallest id becomes a response record, the others revisit
it. A response's HTTP message has chunked transfer framing; where it is longer than ``segment_bytes`` it is cut into
a first record and continuation records. Reading: records are parsed from the archives; continuation records
are grouped by origin identifier, ordered by segment number, checked against the total length, and the framing is
decoded. Only segmented records are shuffled. Archives count if a committed manifest names them, so retried
tasks leave nothing that is read.

Defined results: a null payload is empty; an empty payload is a payload like others; rows that repeat an id and
payload are all responses or all revisits; a null id is never referred to (it is a response if no row with an id has
its payload); very long payloads go over as many segments as they fill; an empty table gives no records; columns other than id,
url and payload are ignored, whatever their names. A record that cannot be read or put together is a row with an error and no payload, and so
is the rest of an archive whose bytes are damaged; other records and archives are read as ever.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.files import attempt_name, open_input, open_output, shared_dir, written

READ_BYTES = 1 << 18
ARCHIVE_BYTES = 256 << 20
MANIFEST = "path string, records long, bytes long"
RECORD = "record_id string, origin_id string, segment int, total long, page_id string, kind string, refers_to string, digest string, block binary, error string"
PAGE = "page_id string, record_type string, refers_to string, declared string, payload binary, error string"


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def chunked(payload: bytes, size: int) -> bytes:
    """HTTP/1.1 chunked framing of a payload."""
    parts = [b"%x\r\n%b\r\n" % (len(c), c) for i in range(0, len(payload), size) if (c := payload[i : i + size])]
    return b"".join(parts) + b"0\r\n\r\n"


def unchunked(framed: bytes) -> bytes:
    """The payload inside chunked framing. Chunk extensions are skipped; broken framing is an error."""
    out, at = [], 0
    while True:
        end = framed.index(b"\r\n", at)
        n = int(framed[at:end].split(b";")[0], 16)
        at = end + 2
        if not n:
            return b"".join(out)
        if framed[at + n : at + n + 2] != b"\r\n":
            raise ValueError("a chunk does not end where its length says")
        out.append(framed[at : at + n])
        at += n + 2


def _record(kind: str, record_id: str, headers: dict, block: bytes) -> bytes:
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <{record_id}>", "WARC-Date: 1970-01-01T00:00:00Z"]
    lines += [f"{k}: {v}" for k, v in headers.items() if v is not None] + [f"Content-Length: {len(block)}"]
    raw = "\r\n".join(lines).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n"
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(raw) + packer.flush()


def _page_records(page_id, url, payload: bytes, refers, unique: str, segment_bytes: int, chunk_bytes: int):
    record_id = f"urn:record:{unique}"
    uri = " ".join((url or "").split()) or None
    headers = {"WARC-Target-URI": uri, "WARC-Payload-Digest": f"sha1:{base32_sha1(payload)}", "X-Page-Id": page_id}
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
    if refers is not None:
        profile = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
        yield _record("revisit", record_id, headers | {"WARC-Profile": profile, "X-Refers-To-Page-Id": refers}, head)
        return
    block = head + chunked(payload, chunk_bytes)
    pieces = [block[i : i + segment_bytes] for i in range(0, len(block), segment_bytes)]
    if len(pieces) == 1:
        yield _record("response", record_id, headers, block)
        return
    yield _record("response", record_id, headers | {"WARC-Segment-Number": 1}, pieces[0])
    for k, piece in enumerate(pieces[1:], 2):
        total = {"WARC-Segment-Total-Length": len(block)} if k == len(pieces) else {}
        yield _record("continuation", f"{record_id}:{k}", {"WARC-Segment-Origin-ID": f"<{record_id}>", "WARC-Segment-Number": k} | total, piece)


def _write(folder: str, segment_bytes: int, chunk_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, name, records, size = None, "", 0, 0

        def closed():
            out.close()
            return pa.RecordBatch.from_pylist([{"path": f"{folder}/{name}", "records": records, "bytes": size}], pa.schema([("path", pa.string()), ("records", pa.int64()), ("bytes", pa.int64())]))

        for batch in batches:
            for r in range(batch.num_rows):
                if out is None:
                    name, records, size = attempt_name("archive") + ".warc.gz", 0, 0
                    out = open_output(f"{folder}/{name}")
                page_id, url, payload, refers = (batch.column(c)[r].as_py() for c in range(4))
                for raw in _page_records(page_id, url, payload or b"", refers, f"{name.split('.')[0]}:{records}", segment_bytes, chunk_bytes):
                    out.write(raw)
                    size += len(raw)
                    records += 1
                if size >= ARCHIVE_BYTES:
                    yield closed()
                    out = None
        if out is not None:
            yield closed()

    return run


def write_archives(pages: DataFrame, folder: str, segment_bytes: int = 32 << 10, chunk_bytes: int = 4 << 10, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> DataFrame:
    """Write ``pages`` as gzipped WARC files into ``folder``; the manifest (path, records, bytes), itself a table there."""
    pages = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"), F.coalesce(F.col(payload_col).cast("binary"), F.lit(b"")).alias("payload"))
    digests = pages.select("page_id", F.sha1("payload").alias("digest"))
    first = digests.groupBy("digest").agg(F.min("page_id").alias("refers_to"), F.count("*").alias("n")).where("n > 1").drop("n")
    copies = digests.join(first, "digest").where("not page_id <=> refers_to").select(F.col("page_id").alias("copy"), "digest", "refers_to").distinct()
    marked = pages.withColumn("sha1", F.sha1("payload")).join(copies, F.col("page_id").eqNullSafe(F.col("copy")) & (F.col("sha1") == F.col("digest")), "left")
    rows = marked.select(F.col("page_id").cast("string"), "url", "payload", F.col("refers_to").cast("string"))
    return written(rows.mapInArrow(_write(f"{folder}/archives", segment_bytes, chunk_bytes), MANIFEST), f"{folder}/manifest")


class _Unpacked:
    """The bytes of a file of gzip members, a bounded buffer at a time."""

    def __init__(self, source):
        self.source, self.inflate, self.rest, self.data, self.at = source, None, b"", b"", 0

    def _more(self) -> bool:
        raw = self.rest or self.source.read(READ_BYTES)
        if not raw:
            return False
        if self.inflate is None:
            self.inflate = zlib.decompressobj(31)
        got = self.inflate.decompress(raw, 4 * READ_BYTES)
        self.rest = self.inflate.unconsumed_tail
        if self.inflate.eof:
            self.rest, self.inflate = self.inflate.unused_data, None
        self.data, self.at = self.data[self.at :] + got, 0
        return True

    def until(self, mark: bytes) -> bytes | None:
        while (end := self.data.find(mark, self.at)) < 0:
            if not self._more():
                if self.data[self.at :].strip():
                    raise ValueError("an archive ends inside a record")
                return None
        out = self.data[self.at : end]
        self.at = end + len(mark)
        return out

    def take(self, n: int) -> bytes:
        parts, have = [], 0
        while have < n:
            piece = self.data[self.at : self.at + n - have]
            self.at += len(piece)
            have += len(piece)
            parts.append(piece)
            if have < n and not self._more():
                raise ValueError("an archive ends inside a record")
        return b"".join(parts)


def records_of(source) -> Iterator[tuple[dict, bytes]]:
    """The headers (names in lower case) and the block of each record of a gzipped WARC stream."""
    stream = _Unpacked(source)
    while (head := stream.until(b"\r\n\r\n")) is not None:
        lines = head.decode("utf-8", "surrogatepass").strip().split("\r\n")
        headers = {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
        block = stream.take(int(headers["content-length"]))
        if stream.take(4) != b"\r\n\r\n":
            raise ValueError("a record does not end where its length says")
        yield headers, block


def _batch(rows: list[tuple], schema: list[tuple[str, pa.DataType]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x, k) for x, (_, k) in zip(zip(*rows), schema)], names=[n for n, _ in schema])


_RECORD = [("record_id", pa.string()), ("origin_id", pa.string()), ("segment", pa.int32()), ("total", pa.int64()), ("page_id", pa.string()), ("kind", pa.string()), ("refers_to", pa.string()), ("digest", pa.string()), ("block", pa.binary()), ("error", pa.string())]
_PAGE = [("page_id", pa.string()), ("record_type", pa.string()), ("refers_to", pa.string()), ("declared", pa.string()), ("payload", pa.binary()), ("error", pa.string())]


def _sliced(rows: Iterator[tuple], schema, of: int) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[of] or b"") + 200
        if size > 2 << 20:
            yield _batch(held, schema)
            held, size = [], 0
    if held:
        yield _batch(held, schema)


def _fields(h: dict, block: bytes) -> tuple:
    own = h["warc-record-id"].strip("<>")
    number, total = h.get("warc-segment-number"), h.get("warc-segment-total-length")
    return own, h.get("warc-segment-origin-id", own).strip("<>"), number and int(number), total and int(total), h.get("x-page-id"), h["warc-type"], h.get("x-refers-to-page-id"), h.get("warc-payload-digest"), block, None


def _read(batches):
    def rows():
        for batch in batches:
            for path in batch.column(0).to_pylist():
                with open_input(path) as source:
                    try:
                        for h, block in records_of(source):
                            try:
                                yield _fields(h, block)
                            except (KeyError, ValueError) as e:
                                yield h.get("warc-record-id"), None, None, None, h.get("x-page-id"), h.get("warc-type"), None, None, None, f"{path}: a header is missing or wrong: {e}"
                    except (KeyError, ValueError, zlib.error) as e:
                        yield None, None, None, None, None, None, None, None, None, f"{path}: {e}"

    yield from _sliced(rows(), _RECORD, 8)


def _payload(kind: str, digest: str | None, total: int | None, parts: list[dict]) -> tuple[str, bytes | None]:
    """The declared digest and the payload of a record from its parts, by segment number; what is not as it should be is an error."""
    if [p["segment"] for p in parts] not in ([None], list(range(1, len(parts) + 1))):
        raise ValueError("segments are missing or repeated")
    block = b"".join(p["block"] for p in parts)
    if len(parts) > 1 and len(block) != total:
        raise ValueError(f"segments have {len(block)} bytes and should have {total}")
    head, _, body = block.partition(b"\r\n\r\n")
    payload = None if kind == "revisit" else unchunked(body) if b"transfer-encoding: chunked" in head.lower() else body
    declared = (digest or "").removeprefix("sha1:")
    if payload is not None and base32_sha1(payload) != declared:
        raise ValueError("a payload is not what its digest says")
    return declared, payload


def _decode(batches):
    """From the parts of one record to its payload."""

    def rows():
        for batch in batches:
            for r in range(batch.num_rows):
                page_id, kind, refers, digest, total, error = (batch.column(c)[r].as_py() for c in range(6))
                declared, payload = None, None
                if error is None:
                    try:
                        declared, payload = _payload(kind, digest, total, batch.column(6)[r].as_py())
                    except ValueError as e:
                        error = f"page {page_id}: {e}"
                yield page_id, kind, refers, declared, payload, error

    yield from _sliced(rows(), _PAGE, 4)


def read_archives(manifest: DataFrame) -> DataFrame:
    """(page_id string, record_type, refers_to, declared, payload, error) of the archives that ``manifest`` names; a revisit's payload is null."""
    n = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    records = manifest.select("path").repartition(n).mapInArrow(_read, RECORD)
    part = F.struct("segment", "block")
    single = records.where("segment is null").select("page_id", "kind", "refers_to", "digest", "total", "error", F.array(part).alias("parts"))
    grouped = records.where("segment is not null").groupBy("origin_id").agg(
        *[F.max(c).alias(c) for c in ("page_id", "refers_to", "digest", "total", "error")], F.min(F.when(F.col("segment") == 1, F.col("kind"))).alias("kind"), F.array_sort(F.collect_list(part)).alias("parts")
    )
    return single.union(grouped.select(*single.columns)).mapInArrow(_decode, PAGE)


def archive_round_trip(pages: DataFrame, segment_bytes: int = 32 << 10, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> DataFrame:
    """Write archives and read them back: (page_id, payload_bytes, payload_digest, record_type, refers_to)."""
    folder = shared_dir(pages.sparkSession, "warc")
    kind = pages.schema[id_col].dataType
    manifest = write_archives(pages, folder, segment_bytes, id_col=id_col, url_col=url_col, payload_col=payload_col)
    # these archives are our own: an error here would lose a page
    size = F.when(F.col("error").isNotNull(), F.raise_error("error").cast("long")).otherwise(F.length("payload").cast("long"))
    facts = read_archives(manifest).select(F.col("page_id").cast(kind).alias("page_id"), size.alias("payload_bytes"), F.col("declared").alias("payload_digest"), "record_type", F.col("refers_to").cast(kind).alias("refers_to"))
    facts = written(facts, f"{folder}/facts")
    origin = facts.where("record_type = 'response'").select(F.col("page_id").alias("refers_to"), F.col("payload_digest").alias("digest"), F.col("payload_bytes").alias("n")).distinct()
    visits = facts.where("record_type = 'revisit'").join(origin, "refers_to").where("payload_digest = digest")
    visits = visits.select("page_id", F.col("n").alias("payload_bytes"), F.col("digest").alias("payload_digest"), "record_type", "refers_to")
    return facts.where("record_type = 'response'").union(visits)
