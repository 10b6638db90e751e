"""Token-id files: frequency-ranked ids in byte-aligned variable-length codes.

Ids are renumbered by corpus frequency (ties to the smaller id), so that common ids
take one byte.  A file is a sequence of blocks; a block holds whole or continued
documents, at most ``BLOCK_IDS`` ids:

    b"IDB1", then unsigned 32-bit little-endian: rows, ids, data bytes
    rows x (document id, signed 64-bit; ids of it in this block, unsigned 32-bit;
        flags, unsigned 32-bit: 1 the document starts here, 2 its id is null)
    control bytes, ceil(ids / 4): two bits an id, first id lowest, byte count - 1
    data bytes: each rank's low 1 to 4 bytes, little-endian

Control bytes stand apart from data, so numpy decodes a block with table lookups on
whole arrays.  ``ranks`` beside the files lists the ids by rank.

Edge cases: a null text has no ids but its end id; documents are written in
ascending id order, null ids first; repeated rows are all written; a text of any
length continues over blocks.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sondeframe.llm.common import by_bytes, work_path, written
from sondeframe.llm.files import new_file, open_fs, read_at
from sondeframe.llm.tokens import encoder

BLOCK_IDS = 1 << 18
_MAGIC = b"IDB1"
_HEAD = struct.Struct("<4sIII")
_ROW = np.dtype([("doc_id", "<i8"), ("ids", "<u4"), ("flags", "<u4")])
_LENGTHS = (np.arange(256)[:, None] >> np.array([0, 2, 4, 6]) & 3) + 1  # control byte -> four byte counts


def encode_block(rows: list[tuple[int, int, int]], ranks: np.ndarray) -> bytes:
    ranks = ranks.astype("<u4", copy=False)
    size = 1 + (ranks > 0xFF).astype(np.uint8) + (ranks > 0xFFFF) + (ranks > 0xFFFFFF)
    codes = np.zeros(-(-len(ranks) // 4) * 4, np.uint8)
    codes[: len(ranks)] = size - 1
    codes = codes.reshape(-1, 4)
    control = codes[:, 0] | codes[:, 1] << 2 | codes[:, 2] << 4 | codes[:, 3] << 6
    taken = np.arange(4, dtype=np.uint8)[None, :] < size[:, None]
    data = ranks.view(np.uint8).reshape(-1, 4)[taken]
    return _HEAD.pack(_MAGIC, len(rows), len(ranks), len(data)) + np.array(rows, _ROW).tobytes() + control.tobytes() + data.tobytes()


def decode_data(control: np.ndarray, data: np.ndarray, n: int) -> np.ndarray:
    """Ranks of a block."""
    size = _LENGTHS[control].ravel()[:n]
    ends = np.cumsum(size)
    at = ends - size
    padded = np.concatenate((data, np.zeros(4, np.uint8)))
    out = padded[at].astype(np.uint32)
    for k in (1, 2, 3):
        more = size > k
        if not more.any():
            break
        out[more] |= padded[at[more] + k].astype(np.uint32) << np.uint32(8 * k)
    return out


def read_blocks(uri: str) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, ranks) block by block."""
    with read_at(uri) as f:
        while head := f.read(_HEAD.size):
            magic, rows, n, size = _HEAD.unpack(head)
            if magic != _MAGIC:
                raise ValueError(f"{uri} is not a token-id file")
            table = np.frombuffer(f.read(_ROW.itemsize * rows), _ROW)
            control = np.frombuffer(f.read(-(-n // 4)), np.uint8)
            yield table, decode_data(control, np.frombuffer(f.read(size), np.uint8), n)


def _tokenised(docs: DataFrame, tokenizer: str, kind: str, end_id: int, dtype: np.dtype, id_col: str, text_col: str) -> DataFrame:
    end = np.array([end_id], np.uint32).tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer, kind)
        for batch in by_bytes(batches, 1):
            held = [np.frombuffer(ids + end, np.uint32).astype(dtype).tobytes() for ids in encode.encode(batch.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(held, pa.binary())], ["doc_id", "ids"])

    source = docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string"))
    return source.mapInArrow(run, "doc_id long, ids binary")


def _counts(tokens: DataFrame, vocab: int, dtype: np.dtype) -> DataFrame:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(vocab, np.int64)
        for batch in batches:
            for ids in batch.column(0):
                total += np.bincount(np.frombuffer(ids.as_buffer(), dtype), minlength=vocab)
        there = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(there), pa.array(total[there])], ["id", "n"])

    return tokens.select("ids").mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))


def write_id_files(
    docs: DataFrame, tokenizer: str, kind: str, end_id: int, vocab: int, folder: str,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """Write ``docs`` in ascending id order; the committed manifest ``(file_no, uri, docs, ids)``."""
    dtype = np.dtype("<u2" if vocab <= 1 << 16 else "<u4")
    tokens = written(_tokenised(docs, tokenizer, kind, end_id, dtype, id_col, text_col), "ids")
    ranked = _counts(tokens, vocab, dtype).orderBy(F.desc("n"), "id").collect()  # at most `vocab` rows
    by_rank = np.array([r["id"] for r in ranked], "<u4")
    system, path = open_fs(folder)
    system.create_dir(path, recursive=True)
    with system.open_output_stream(f"{path}/ranks") as f:
        f.write(by_rank.tobytes())
    rank_of = np.zeros(vocab, np.uint32)
    rank_of[by_rank] = np.arange(len(by_rank))
    shared = docs.sparkSession.sparkContext.broadcast(rank_of)  # 4 bytes an id of the vocabulary

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        uri, out = new_file(folder, ".ids")
        n_docs = n_ids = held = 0
        rows: list[tuple[int, int, int]] = []
        parts: list[np.ndarray] = []
        with out:
            for batch in batches:
                for doc_id, ids in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                    ids = shared.value[np.frombuffer(ids.as_buffer(), dtype)]
                    at = 0
                    while at < len(ids):
                        part = ids[at : at + BLOCK_IDS - held]
                        rows.append((doc_id or 0, len(part), (at == 0) + 2 * (doc_id is None)))
                        parts.append(part)
                        at, held = at + len(part), held + len(part)
                        if held == BLOCK_IDS:
                            out.write(encode_block(rows, np.concatenate(parts)))
                            rows, parts, held = [], [], 0
                    n_docs, n_ids = n_docs + 1, n_ids + len(ids)
            if rows:
                out.write(encode_block(rows, np.concatenate(parts)))
        if n_docs:
            values = [pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([uri])]
            values += [pa.array([x], pa.int64()) for x in (n_docs, n_ids)]
            yield pa.RecordBatch.from_arrays(values, ["file_no", "uri", "docs", "ids"])

    ordered = tokens.repartitionByRange("doc_id").sortWithinPartitions("doc_id")
    return written(ordered.mapInArrow(write, "file_no int, uri string, docs long, ids long"), "id-manifest")


def read_id_files(manifest: DataFrame, folder: str) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` decoded from the files; start counts the ids of all documents before."""
    # One row for each file: what precedes each file is a running sum over the manifest alone.
    before = F.coalesce(F.sum("ids").over(W.orderBy("file_no").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    files = manifest.select("uri", before.alias("start"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with read_at(f"{folder}/ranks") as f:
            by_rank = np.frombuffer(f.read(), "<u4")
        for batch in batches:
            for uri, at in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                out: list[list] = []
                for rows, ranks in read_blocks(uri):
                    ids = by_rank[ranks]
                    ends = np.cumsum(rows["ids"])
                    for row, end in zip(rows.tolist(), ends.tolist(), strict=True):
                        doc_id, n, flags = row
                        part = ids[end - n : end].tobytes()
                        if flags & 1:
                            if len(out) >= 20_000:
                                yield _rows(out)
                                out = []
                            out.append([None if flags & 2 else doc_id, at, n, zlib.crc32(part)])
                        else:
                            out[-1][2] += n
                            out[-1][3] = zlib.crc32(part, out[-1][3])
                        at += n
                yield _rows(out)

    # A file is one row, so a number of partitions is given: it would else be one small partition.
    return files.repartition(max(1, manifest.count()), "uri").mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def _rows(out: list[list]) -> pa.RecordBatch:
    names = ["doc_id", "start", "n_tokens", "ids_crc32"]
    columns = list(zip(*out, strict=True)) or [()] * 4
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)


def round_trip(docs: DataFrame, tokenizer: str, kind: str, end_id: int, vocab: int) -> DataFrame:
    folder = work_path(docs.sparkSession, "id-files")
    return read_id_files(write_id_files(docs, tokenizer, kind, end_id, vocab, folder), folder)
