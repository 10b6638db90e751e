"""WARC records in ZIP packages: a writer, and a reader that needs no extraction.

A package holds stored (uncompressed) members: ``archive/data.warc.gz``, in which
each record is a gzip member of its own, and ``indexes/index.cdxj``, one JSON line
for each record with its offset and length inside the archive member.  The reader
finds the end-of-central-directory record (ZIP64 too), parses the central
directory, locates the members' data from their local headers, reads the index and
range-reads single records.

Edge cases: a null payload is an empty one; a null URL is written as
``urn:missing``; packages, members and central directories beyond 4 GiB or 65535
entries use ZIP64; a null page id is dropped to the end of its group, so it is the
response only when all ids are null; repeated rows are separate records, so each row that
has the smallest id of its payload is a response; other columns are not read, whatever their names; an
empty table gives no package.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import json
import struct
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sondeframe.llm.common import work_path, written
from sondeframe.llm.files import new_file, read_at

_EOCD, _EOCD64, _LOC64 = b"PK\x05\x06", b"PK\x06\x06", b"PK\x06\x07"
_CENTRAL, _LOCAL = b"PK\x01\x02", b"PK\x03\x04"
_MAX32, _MAX16 = 0xFFFFFFFF, 0xFFFF
ARCHIVE, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
#: Groups of the rows that share one payload, and the most payloads that are split so: those of more than 1 / LARGE_ROWS of the repeated rows.
SALTS = 64
LARGE_ROWS = 10_000


class ZipWriter:
    """Streams stored members, with sizes in ZIP64 data descriptors, to a sink that need not seek."""

    def __init__(self, out) -> None:
        self.out, self.at, self.entries = out, 0, []

    def _write(self, data: bytes) -> None:
        self.out.write(data)
        self.at += len(data)

    def begin(self, name: str) -> None:
        self.name, self.header, self.crc, self.size = name.encode(), self.at, 0, 0
        extra = struct.pack("<HHQQ", 1, 16, 0, 0)
        self._write(struct.pack("<4s5H3L2H", _LOCAL, 45, 8, 0, 0, 33, 0, _MAX32, _MAX32, len(self.name), len(extra)) + self.name + extra)

    def write(self, data: bytes) -> None:
        self.crc, self.size = zlib.crc32(data, self.crc), self.size + len(data)
        self._write(data)

    def end(self) -> None:
        self._write(struct.pack("<4sLQQ", b"PK\x07\x08", self.crc, self.size, self.size))
        self.entries.append((self.name, self.header, self.crc, self.size))

    def close(self) -> None:
        first = self.at
        for name, header, crc, size in self.entries:
            big = [x for x in (size, size, header) if x >= _MAX32]
            extra = struct.pack(f"<HH{len(big)}Q", 1, 8 * len(big), *big) if big else b""
            self._write(
                struct.pack("<4s6H3L5H2L", _CENTRAL, 45, 45, 8, 0, 0, 33, crc, min(size, _MAX32), min(size, _MAX32), len(name), len(extra), 0, 0, 0, 0, min(header, _MAX32))
                + name + extra
            )
        size, n = self.at - first, len(self.entries)
        if n >= _MAX16 or first >= _MAX32 or size >= _MAX32:
            at = self.at
            self._write(struct.pack("<4sQ2H2L4Q", _EOCD64, 44, 45, 45, 0, 0, n, n, size, first))
            self._write(struct.pack("<4sLQL", _LOC64, 0, at, 1))
        self._write(struct.pack("<4s4H2LH", _EOCD, 0, 0, min(n, _MAX16), min(n, _MAX16), min(size, _MAX32), min(first, _MAX32), 0))


def directory(f, size: int) -> dict[str, tuple[int, int, int]]:
    """name -> (local header offset, stored size, method) from the central directory of a random-access file."""
    tail_at = max(0, size - 22 - _MAX16 - 20)
    f.seek(tail_at)
    tail = f.read(size - tail_at)
    end = tail.rfind(_EOCD)
    if end < 0:
        raise ValueError("no end of central directory")
    n, cd_size, cd_at = struct.unpack_from("<H2L", tail, end + 10)
    if end >= 20 and tail[end - 20 : end - 16] == _LOC64 and (n == _MAX16 or cd_size == _MAX32 or cd_at == _MAX32):
        f.seek(struct.unpack_from("<Q", tail, end - 12)[0])
        record = f.read(56)
        if record[:4] != _EOCD64:
            raise ValueError("broken ZIP64 end of central directory")
        n, cd_size, cd_at = struct.unpack_from("<3Q", record, 32)
    f.seek(cd_at)
    data, at, out = f.read(cd_size), 0, {}
    for _ in range(n):
        if data[at : at + 4] != _CENTRAL:
            raise ValueError("broken central directory")
        method, = struct.unpack_from("<H", data, at + 10)
        packed, full, name_n, extra_n, comment_n = struct.unpack_from("<2L3H", data, at + 20)
        header, = struct.unpack_from("<L", data, at + 42)
        name = data[at + 46 : at + 46 + name_n].decode()
        extra, e = data[at + 46 + name_n : at + 46 + name_n + extra_n], 0
        while e + 4 <= len(extra):
            kind, length = struct.unpack_from("<HH", extra, e)
            if kind == 1:
                wide = iter(struct.unpack_from(f"<{length // 8}Q", extra, e + 4))
                full = next(wide) if full == _MAX32 else full
                packed = next(wide) if packed == _MAX32 else packed
                header = next(wide) if header == _MAX32 else header
            e += 4 + length
        out[name] = (header, packed, method)
        at += 46 + name_n + extra_n + comment_n
    return out


def member_at(f, entry: tuple[int, int, int]) -> int:
    """Where a stored member's data begin."""
    header, _, method = entry
    if method != 0:
        raise ValueError("the member is compressed and can't be range-read")
    f.seek(header)
    local = f.read(30)
    if local[:4] != _LOCAL:
        raise ValueError("broken local header")
    name_n, extra_n = struct.unpack_from("<2H", local, 26)
    return header + 30 + name_n + extra_n


def warc_record(kind: str, page_id: int | None, url: str, digest: str, n: int, refers: int | None, payload: bytes) -> bytes:
    """One WARC/1.1 record; a revisit has no payload block."""
    lines = [
        "WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>", f"WARC-Target-URI: {url}",
        "WARC-Date: 1970-01-01T00:00:00Z", f"WARC-Payload-Digest: sha1:{digest}", f"X-Payload-Length: {n}",
    ]
    if kind == "revisit":
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <urn:page:{refers}>"]
        payload = b""
    lines += ["Content-Type: text/html", f"Content-Length: {len(payload)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + payload + b"\r\n\r\n"


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
    return fields, rest[: int(fields["Content-Length"])]


def _base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload, usedforsecurity=False).digest()).decode()


def plan_records(pages: DataFrame, least_bytes: int, id_col: str, url_col: str, body_col: str) -> DataFrame:
    """Rows with ``record_type`` and ``refers_to``; equal payloads meet by SHA-1 and length only.

    A first pass writes the digests; only payloads that occur twice or more give a
    row, the smallest id, from partial minima.  Each row then meets its payload's
    decision under a salt of its own id, so a payload that a third of all pages share
    is spread over ``SALTS`` groups (its decision is copied to each).
    """
    body = F.encode(F.coalesce(F.col(body_col).cast("string"), F.lit("")), "UTF-8")
    rows = pages.select(
        F.col(id_col).cast("long").alias("page_id"), F.regexp_replace(F.coalesce(F.col(url_col), F.lit("urn:missing")), r"[\r\n]+", "%0A").alias("url"),
        body.alias("payload"), F.octet_length(body).cast("long").alias("payload_bytes"), F.sha1(body).alias("_sha1"),
    )
    salt = F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)).alias("_salt")
    firsts = rows.where(F.col("payload_bytes") >= least_bytes).groupBy("_sha1", "payload_bytes").agg(F.min("page_id").alias("first"), F.count("*").alias("_n"))
    firsts = written(firsts.where("_n > 1 and first is not null"), "firsts")
    # Small groups need no salt; large ones, of which there are at most LARGE_ROWS, get all of them.
    least = max(SALTS, (firsts.agg(F.sum("_n")).first()[0] or 0) // LARGE_ROWS)
    salts = F.when(F.col("_n") > least, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    spread = firsts.select("_sha1", "payload_bytes", "first", F.explode(salts).alias("_salt"))
    large = F.broadcast(firsts.where(F.col("_n") > least).select("_sha1", "payload_bytes", F.lit(1).alias("_large")))
    rows = rows.join(large, ["_sha1", "payload_bytes"], "left").withColumn("_salt", F.when(F.col("_large") == 1, salt).otherwise(0))
    out = rows.join(spread, ["_sha1", "payload_bytes", "_salt"], "left")
    revisit = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return out.select(
        "page_id", "url", "payload_bytes", F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("first")).alias("refers_to"), F.when(revisit, F.lit(b"")).otherwise(F.col("payload")).alias("payload"),
        F.when(revisit, F.col("_sha1")).alias("sha1"),
    )


def write_packages(
    pages: DataFrame, folder: str, least_bytes: int = 0, id_col: str = "page_id", url_col: str = "url", body_col: str = "html",
    records_per_package: int = 50_000,
) -> DataFrame:
    """Write packages from the executors; the committed manifest ``(uri, records, bytes)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made: list[tuple[str, int, int]] = []
        z = out = None
        index: list[bytes] = []

        def finish() -> None:
            z.end()
            z.begin(INDEX)
            for line in index:
                z.write(line)
            z.end()
            z.close()
            out.close()
            made.append((uri, len(index), z.at))

        for batch in batches:
            for page_id, url, n, kind, refers, payload, sha1 in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if z is None:
                    uri, out = new_file(folder, ".wacz")
                    z, index = ZipWriter(out), []
                    z.begin(ARCHIVE)
                digest = base64.b32encode(bytes.fromhex(sha1)).decode() if sha1 else _base32_sha1(payload)
                packed = gzip.compress(warc_record(kind, page_id, url, digest, n, refers, payload), 1, mtime=0)
                index.append(json.dumps({"page_id": page_id, "offset": z.size, "length": len(packed)}).encode() + b"\n")
                z.write(packed)
                if len(index) == records_per_package:
                    finish()
                    z = None
        if z is not None:
            finish()
        columns = list(zip(*made, strict=True)) or [()] * 3
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.int64()), strict=True)], ["uri", "records", "bytes"])

    planned = plan_records(pages, least_bytes, id_col, url_col, body_col)
    return written(planned.mapInArrow(run, "uri string, records long, bytes long"), "warc-manifest")


def read_packages(manifest: DataFrame, block: int = 4 << 20) -> DataFrame:
    """Records of the packages: ``(page_id, payload_bytes, payload_digest, record_type, refers_to)``.

    Index and records are range-read; neighbouring records are fetched together in
    ranges of about ``block`` bytes.  A response's digest is computed anew from its
    payload and must equal the one in its header.
    """
    fields = [("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())]

    def packed(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True)) or [()] * len(fields)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, fields, strict=True)], [n for n, _ in fields])

    def record(data: bytes) -> tuple:
        head, payload = parse_record(gzip.decompress(data))
        page = head["WARC-Record-ID"][10:-1]
        digest, n = head["WARC-Payload-Digest"][5:], int(head["X-Payload-Length"])
        refers = head.get("WARC-Refers-To")
        if head["WARC-Type"] == "response":
            digest, n, said = _base32_sha1(payload), len(payload), digest
            if digest != said:
                raise ValueError(f"payload of page {page} is damaged")
        return int(page) if page else None, n, digest, head["WARC-Type"], int(refers[10:-1]) if refers else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri in batch.column(0).to_pylist():
                with read_at(uri) as f:
                    names = directory(f, f.size())
                    base = member_at(f, names[ARCHIVE])
                    f.seek(member_at(f, names[INDEX]))
                    index = io.BytesIO(f.read(names[INDEX][1]))
                    group: list[tuple[int, int]] = []

                    def fetch(group: list[tuple[int, int]], base: int = base, f=f) -> pa.RecordBatch:
                        first = group[0][0]
                        f.seek(base + first)
                        data = f.read(group[-1][0] + group[-1][1] - first)
                        return packed([record(data[o - first : o - first + n]) for o, n in group])

                    for line in map(json.loads, index):
                        group.append((line["offset"], line["length"]))
                        if group[-1][0] + group[-1][1] - group[0][0] >= block:
                            yield fetch(group)
                            group = []
                    if group:
                        yield fetch(group)

    schema = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
    # A package is one row, so a number of partitions is given: it would else be one small partition.
    return manifest.select("uri").repartition(max(1, manifest.count()), "uri").mapInArrow(run, schema)


def archive_round_trip(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Write ``pages`` as packages in the shared folder and read every record back."""
    return read_packages(write_packages(pages, work_path(pages.sparkSession, "warc"), least_bytes))
