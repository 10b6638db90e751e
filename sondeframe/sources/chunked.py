"""Arrays in chunks (the Zarr v2 layout, uncompressed or zlib) as a Spark data source.

``spark.read.format("chunked").option("path", store).option("array", "label")`` gives one
row for each element: its index on every dimension (named by ``_ARRAY_DIMENSIONS`` or d0, d1, ...) and ``value``, NULL for
the fill value.  Each chunk is a partition, read by one task; filters on
index columns reach the reader and leave out chunks that they can't meet (Spark still applies them to the rows), which
needs ``spark.sql.python.filterPushdown.enabled``; ``read_array`` sees to that.  ``write_array`` stores rows as
chunks: each chunk is made by one task and written under its own name, so a task that runs twice writes the same bytes.

Only ``json``, ``zlib`` and ``struct``-like numpy buffers are used; files are opened through
``pyarrow.fs``, so a store may lie on a local disk, HDFS or an object store.
"""

from __future__ import annotations

import itertools
import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual

_SPARK = {"i1": "tinyint", "i2": "smallint", "i4": "int", "i8": "bigint", "u1": "smallint", "u2": "int", "u4": "bigint", "f4": "float", "f8": "double"}
_ARROW = {"tinyint": pa.int8(), "smallint": pa.int16(), "int": pa.int32(), "bigint": pa.int64(), "float": pa.float32(), "double": pa.float64()}


def _open(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path if ":" in path.split("/")[0] else f"file://{path}")


def _read(path: str) -> bytes | None:
    system, where = _open(path)
    if system.get_file_info(where).type != fs.FileType.File:
        return None
    with system.open_input_stream(where) as f:
        return f.read()


def _write(path: str, data: bytes) -> None:
    system, where = _open(path)
    system.create_dir(where.rsplit("/", 1)[0], recursive=True)
    with system.open_output_stream(where) as f:
        f.write(data)


class Meta:
    """Shape, chunks and type of one array of a store."""

    def __init__(self, store: str, array: str) -> None:
        found = _read(f"{store}/{array}/.zarray")
        if found is None:
            raise ValueError(f"no array {array} in {store}")
        m = json.loads(found)
        if m.get("zarr_format") != 2 or m.get("order") != "C" or m.get("filters"):
            raise ValueError("only unfiltered version 2 arrays in C order are read")
        self.compressor = (m.get("compressor") or {}).get("id")
        if self.compressor not in (None, "zlib"):
            raise ValueError(f"compressor {self.compressor} is not read")
        self.shape, self.chunks, self.dtype = tuple(m["shape"]), tuple(m["chunks"]), np.dtype(m["dtype"])
        fill = m.get("fill_value")
        self.fill = float("nan") if fill == "NaN" else fill
        attrs = json.loads(_read(f"{store}/{array}/.zattrs") or b"{}")
        self.dims = attrs.get("_ARRAY_DIMENSIONS") or [f"d{i}" for i in range(len(self.shape))]
        self.separator = m.get("dimension_separator", ".")

    def spark_type(self) -> str:
        kind = self.dtype.str[1:]
        if kind not in _SPARK:
            raise ValueError(f"type {self.dtype} is not read")
        return _SPARK[kind]

    def key(self, at: tuple[int, ...]) -> str:
        return self.separator.join(map(str, at))


class Chunk(InputPartition):
    def __init__(self, at: tuple[int, ...]) -> None:
        super().__init__(at)
        self.at = at


class ChunkedReader(DataSourceReader):
    def __init__(self, store: str, array: str) -> None:
        self.store, self.array, self.meta = store, array, Meta(store, array)
        self.bounds = {d: [0, n - 1] for d, n in zip(self.meta.dims, self.meta.shape, strict=True)}

    def pushFilters(self, filters) -> Iterator:
        """Index filters narrow the chunks; all filters go back, as a chunk holds other elements too."""
        for f in filters:
            name = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
            if name in self.bounds:
                low, high = self.bounds[name]
                if isinstance(f, EqualTo):
                    low, high = max(low, f.value), min(high, f.value)
                elif isinstance(f, In) and f.value:
                    low, high = max(low, min(f.value)), min(high, max(f.value))
                elif isinstance(f, GreaterThan):
                    low = max(low, f.value + 1)
                elif isinstance(f, GreaterThanOrEqual):
                    low = max(low, f.value)
                elif isinstance(f, LessThan):
                    high = min(high, f.value - 1)
                elif isinstance(f, LessThanOrEqual):
                    high = min(high, f.value)
                self.bounds[name] = [low, high]
            yield f

    def partitions(self) -> list[Chunk]:
        """One for each chunk that meets the bounds; a single empty one if none does."""
        spans = [range(low // c, high // c + 1) if low <= high else range(0) for (low, high), c in zip((self.bounds[d] for d in self.meta.dims), self.meta.chunks, strict=True)]
        return [Chunk(at) for at in itertools.product(*spans)] or [Chunk(())]

    def read(self, partition: Chunk) -> Iterator[pa.RecordBatch]:
        m, at = self.meta, partition.at
        kind = _ARROW[m.spark_type()]
        names = [*m.dims, "value"]
        if len(at) != len(m.shape):
            return
        raw = _read(f"{self.store}/{self.array}/{m.key(at)}")
        start = [a * c for a, c in zip(at, m.chunks, strict=True)]
        if raw is None:  # a chunk that isn't stored holds the fill value only
            data = None
        else:
            raw = zlib.decompress(raw) if m.compressor else raw
            data = np.frombuffer(raw, m.dtype).reshape(m.chunks)
        size = [min(c, n - s) for c, n, s in zip(m.chunks, m.shape, start, strict=True)]
        # Slab by slab along the first dimension, so that a large chunk isn't held as rows at once.
        inner = [np.arange(s, s + k, dtype=np.int64) for s, k in zip(start[1:], size[1:], strict=True)]
        grids = [g.ravel() for g in np.meshgrid(*inner, indexing="ij")] if inner else []
        n = int(np.prod(size[1:])) if inner else 1
        for i in range(size[0]):
            if data is None:
                values = pa.nulls(n, kind)
            else:
                own = data[(i, *(slice(0, k) for k in size[1:]))].ravel()
                own = own.astype(m.dtype.newbyteorder("="))
                none = np.isnan(own) if own.dtype.kind == "f" else np.zeros(len(own), bool)
                if m.fill is not None:
                    none |= own == m.fill
                values = pa.array(own, mask=none).cast(kind)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(n, start[0] + i)), *map(pa.array, grids), values], names)


class ChunkedSource(DataSource):
    """Options: ``path`` of the store and ``array``."""

    @classmethod
    def name(cls) -> str:
        return "chunked"

    def schema(self) -> str:
        m = Meta(self.options["path"], self.options["array"])
        return ", ".join([*(f"`{d}` bigint" for d in m.dims), f"value {m.spark_type()}"])

    def reader(self, schema) -> ChunkedReader:
        return ChunkedReader(self.options["path"].rstrip("/"), self.options["array"])


def read_array(spark: SparkSession, store: str, array: str) -> DataFrame:
    """The elements of an array; registers the source with the session and turns on filters for Python sources."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(ChunkedSource)
    return spark.read.format("chunked").option("path", store).option("array", array).load()


def create_array(store: str, array: str, dims: list[str], shape: list[int], chunks: list[int], dtype: str, fill) -> None:
    """Write an array's description; chunks follow by ``write_array``."""
    meta = {"zarr_format": 2, "shape": shape, "chunks": chunks, "dtype": np.dtype(dtype).str, "compressor": {"id": "zlib", "level": 1}, "fill_value": fill, "order": "C", "filters": None}
    _write(f"{store}/.zgroup", b'{"zarr_format": 2}')
    _write(f"{store}/{array}/.zarray", json.dumps(meta).encode())
    _write(f"{store}/{array}/.zattrs", json.dumps({"_ARRAY_DIMENSIONS": dims}).encode())


def write_array(rows: DataFrame, store: str, array: str) -> int:
    """Store ``rows(dims..., value)`` into an array made by ``create_array``; how many chunks were written.

    Elements meet by chunk in one shuffle and each chunk is one group, bounded by the
    chunk's own size.  A missing element takes the fill value, of a repeated one the largest value counts; an index outside the shape is an error.
    """
    meta = Meta(store, array)
    dims = meta.dims
    for d, n in zip(dims, meta.shape, strict=True):
        rows = rows.withColumn(d, F.when(F.col(d).between(0, n - 1), F.col(d)).otherwise(F.raise_error(F.concat(F.lit(f"{d} outside 0..{n - 1}: "), F.coalesce(F.col(d).cast("string"), F.lit("null"))))))
    one = rows.groupBy(*dims).agg(F.max("value").alias("value"))
    at = F.array(*[F.floor(F.col(d) / c) for d, c in zip(dims, meta.chunks, strict=True)])

    def store_chunk(table: pa.Table) -> pa.Table:
        key = tuple(table.column("chunk")[0].as_py())
        fill = meta.fill if meta.fill is not None else 0
        data = np.full(meta.chunks, fill, meta.dtype)
        where = tuple(table.column(d).to_numpy() - k * c for d, k, c in zip(dims, key, meta.chunks, strict=True))
        value = table.column("value").combine_chunks()
        there = value.is_valid().to_numpy(zero_copy_only=False)
        data[tuple(w[there] for w in where)] = value.drop_null().to_numpy().astype(meta.dtype)
        _write(f"{store}/{array}/{meta.key(key)}", zlib.compress(data.tobytes(), 1) if meta.compressor else data.tobytes())
        return pa.table({"chunk": [meta.key(key)], "n": pa.array([int(there.sum())], pa.int64())})

    done = one.select(at.alias("chunk"), *dims, "value").groupBy("chunk").applyInArrow(store_chunk, "chunk string, n long")
    return done.count()
