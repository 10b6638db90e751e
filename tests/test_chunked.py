"""Chunked arrays: round trips, skipped chunks, a labelled tile store."""

import json
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from sondeframe.operators import dataset, patches
from sondeframe.sources import chunked


@pytest.fixture
def store(tmp_path):
    return str(tmp_path / "tiles.zarr")


@pytest.mark.parametrize(("shape", "chunks"), [((7,), (3,)), ((5, 6), (2, 4)), ((3, 4, 5), (1, 4, 2))])
def test_round_trip(spark, store, shape, chunks):
    rng = np.random.default_rng(1)
    data = rng.normal(size=shape).astype("f4")
    data.ravel()[::5] = np.nan
    dims = [f"a{i}" for i in range(len(shape))]
    rows = [(*map(int, at), None if np.isnan(v) else float(v)) for at, v in np.ndenumerate(data)]
    df = spark.createDataFrame(rows, ", ".join(f"{d} long" for d in dims) + ", value double")
    chunked.create_array(store, "x", dims, list(shape), list(chunks), "<f4", "NaN")
    n = chunked.write_array(df.where("value is not null"), store, "x")
    assert n <= int(np.prod([-(-s // c) for s, c in zip(shape, chunks, strict=True)]))
    back = chunked.read_array(spark, store, "x")
    assert back.columns == [*dims, "value"] and back.rdd.getNumPartitions() == int(np.prod([-(-s // c) for s, c in zip(shape, chunks, strict=True)]))
    got = {tuple(r)[:-1]: r.value for r in back.collect()}
    assert len(got) == data.size
    for at, v in np.ndenumerate(data):
        assert (got[at] is None) if np.isnan(v) else got[at] == v


def test_reads_what_others_write(spark, store):
    """Plain files in the public layout: big-endian, no compressor, a missing chunk, another separator."""
    chunked._write(f"{store}/v/.zarray", json.dumps({"zarr_format": 2, "shape": [4, 3], "chunks": [2, 2], "dtype": ">i2", "compressor": None, "fill_value": -1, "order": "C", "filters": None, "dimension_separator": "/"}).encode())
    chunked._write(f"{store}/v/0/0", np.array([[1, 2], [3, -1]], ">i2").tobytes())
    chunked._write(f"{store}/v/1/1", np.array([[7, 99], [8, 99]], ">i2").tobytes())
    got = {(r.d0, r.d1): r.value for r in chunked.read_array(spark, store, "v").collect()}
    assert len(got) == 12 and {k: v for k, v in got.items() if v is not None} == {(0, 0): 1, (0, 1): 2, (1, 0): 3, (2, 2): 7, (3, 2): 8}
    for bad in ({"order": "F"}, {"compressor": {"id": "blosc"}}, {"filters": [1]}, {"dtype": "<U5"}):
        meta = {"zarr_format": 2, "shape": [1], "chunks": [1], "dtype": "<i2", "compressor": None, "fill_value": 0, "order": "C", "filters": None} | bad
        chunked._write(f"{store}/bad/.zarray", json.dumps(meta).encode())
        with pytest.raises(ValueError):
            chunked.Meta(store, "bad").spark_type()
    with pytest.raises(ValueError, match="no array"):
        chunked.Meta(store, "none")


def test_pushed_bounds_skip_chunks(spark, store):
    from pyspark.sql.datasource import EqualTo, GreaterThan, In, LessThan

    chunked.create_array(store, "x", ["t", "y"], [100, 40], [10, 10], "<i4", -1)
    chunked.write_array(spark.range(4000).select((F.col("id") / 40).cast("long").alias("t"), (F.col("id") % 40).alias("y"), F.col("id").alias("value")), store, "x")
    for filters, want in (([EqualTo(("t",), 57)], 4), ([GreaterThan(("t",), 79), LessThan(("y",), 10)], 2), ([In(("t",), (3, 12))], 8), ([EqualTo(("value",), 5)], 40), ([EqualTo(("t",), 500)], 1)):
        reader = chunked.ChunkedReader(store, "x")
        assert list(reader.pushFilters(filters)) == filters and len(reader.partitions()) == want
    df = chunked.read_array(spark, store, "x").where("t >= 20 and t < 40 and y = 3")
    assert df.rdd.getNumPartitions() == 2 and sorted(r.value for r in df.collect()) == [t * 40 + 3 for t in range(20, 40)]
    assert chunked.read_array(spark, store, "x").where("t > 1000").count() == 0


def test_writing_is_repeatable_and_checked(spark, store):
    chunked.create_array(store, "x", ["i"], [4], [2], "u1", 255)
    df = spark.createDataFrame([(0, 3), (0, 2), (3, 1)], "i long, value int")
    for _ in range(2):
        assert chunked.write_array(df, store, "x") == 2
    assert [r.value for r in chunked.read_array(spark, store, "x").orderBy("i").collect()] == [3, None, None, 1]
    assert zlib.decompress(chunked._read(f"{store}/x/0")) == bytes([3, 255])
    with pytest.raises(Exception, match="outside"):
        chunked.write_array(spark.createDataFrame([(4, 1)], "i long, value int"), store, "x")


def test_labelled_tile_store_follows_the_image_order(spark, store):
    """Samples in the order of an image store get label patches at the same places; the index follows that order."""
    order = spark.createDataFrame([("s", 0, "b"), ("s", 1, "a"), ("s", 2, "c")], "store string, position long, sample_id string")
    index = spark.createDataFrame([("a", 30.2, 30.3), ("b", 30.6, 30.4), ("c", 30.4, 30.7), ("d", 30.1, 30.1)], "sample_id string, lon double, lat double")
    placed = dataset.in_store_order(index, order)
    assert [(r.position, r.sample_id) for r in placed.collect()] == [(0, "b"), (1, "a"), (2, "c")]
    with pytest.raises(ValueError, match="x"):
        dataset.in_store_order(index, order.unionByName(spark.createDataFrame([("s", 3, "x")], order.schema)))
    labels = spark.createDataFrame([(y, x, (y * 3 + x) % 4) for y in range(40) for x in range(40)], "lat_i int, lon_i int, cls int")
    made = patches.label_patches(placed.select(F.col("position").alias("id"), "lon", "lat"), labels, [], (30.0, 0.05, 40), (30.0, 0.05, 40), size=8, res=900.0)
    chunked.create_array(store, "label", ["sample", "y", "x"], [3, 8, 8], [1, 8, 8], "u1", 255)
    assert chunked.write_array(patches.patch_pixels(made, 8).withColumnsRenamed({"id": "sample", "cls": "value"}), store, "label") == 3
    back = {(r["sample"], r.y, r.x): r.value for r in chunked.read_array(spark, store, "label").collect()}
    for r in made.collect():
        assert [back[r.id, y, x] for y in range(8) for x in range(8)] == list(r.patch)
