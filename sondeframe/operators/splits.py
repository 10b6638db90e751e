"""Spatial block and temporal splits."""

from __future__ import annotations

import random

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sondeframe import config as C
from sondeframe.functions import geo
from sondeframe.operators.joins import sized


def assign_cells(roi: list[tuple[int, int]], ood: list[tuple[int, int]] = (), seed: int = C.SEED, ratio=C.SPLIT_RATIO) -> dict[tuple[int, int], str]:
    """Seeded partition of a short cell list; the shuffle's order is part of the result, so it runs on the driver."""
    keys = sorted(f"{x}_{y}" for x, y in roi)
    random.Random(seed).shuffle(keys)
    n_train, n_val = round(ratio[0] * len(keys)), round(ratio[1] * len(keys))
    out = {k: "train" if i < n_train else "val" if i < n_train + n_val else "test" for i, k in enumerate(keys)}
    out |= {f"{x}_{y}": "ood" for x, y in ood}
    return {tuple(map(int, k.split("_"))): v for k, v in out.items()}


def box_cells(box, size: int = 1) -> list[tuple[int, int]]:
    from math import ceil, floor

    w, s, e, n = box
    return [(x, y) for x in range(ceil(w), floor(e), size) for y in range(ceil(s), floor(n), size)]


def cells_frame(spark: SparkSession, cells: dict[tuple[int, int], str]) -> DataFrame:
    return spark.createDataFrame([(x, y, s) for (x, y), s in cells.items()], "cell_lon int, cell_lat int, split string")


def split_points(points: DataFrame, cells: DataFrame, buffer_km: float = C.BUFFER_KM) -> DataFrame:
    """``split`` of ``(id, lon, lat)``: the cell's, ``none`` without a cell, ``buffer`` near a different one.

    ``cells`` is a table of whole degrees, broadcast when its counted rows allow; each point looks
    up its cell and the eight around it.
    """
    x, y = geo.cell(F.col("lon"), F.col("lat"))
    ring = F.array(*[F.struct(F.lit(a).alias("dx"), F.lit(b).alias("dy")) for a in (-1, 0, 1) for b in (-1, 0, 1)])
    p = points.select("id", "lon", "lat", x.alias("x"), y.alias("y"), F.explode(ring).alias("o"))
    p = p.select("id", "lon", "lat", "o", (F.col("x") + F.col("o.dx")).alias("cell_lon"), (F.col("y") + F.col("o.dy")).alias("cell_lat"))
    p = p.join(sized(cells, 64_800), ["cell_lon", "cell_lat"], "left")
    p = p.withColumn("km", geo.to_cell_km(F.col("lon"), F.col("lat"), F.col("cell_lon"), F.col("cell_lat")))
    own = F.max(F.when((F.col("o.dx") == 0) & (F.col("o.dy") == 0), F.col("split")))
    near = F.collect_set(F.when(F.col("km") < buffer_km, F.col("split")))  # at most nine
    g = p.groupBy("id").agg(own.alias("base"), near.alias("near"))
    other = F.exists("near", lambda s: s != F.col("base"))
    return g.select("id", F.when(F.col("base").isNull(), "none").when((F.lit(buffer_km) > 0) & other, "buffer").otherwise(F.col("base")).alias("split"))


def temporal_split(year: Column) -> Column:
    between = lambda span: year.between(*span)
    return F.when(between(C.TRAIN_YEARS), "train").when(between(C.TEST_YEARS), "test").when(between(C.OOD_TIME_YEARS), "ood_time").otherwise("none")


def split_documents(cells: dict, seed: int = C.SEED) -> tuple[dict, dict]:
    """The spatial and the temporal split as plain documents, with all that is needed to make them again."""
    counts: dict[str, int] = {}
    for v in cells.values():
        counts[v] = counts.get(v, 0) + 1
    spatial = {
        "version": "v1", "kind": "spatial_block_cv", "seed": seed, "cell_size_deg": C.CELL_DEG, "ratio": dict(zip(("train", "val", "test"), C.SPLIT_RATIO, strict=True)),
        "roi_bbox": list(C.ROI), "ood_bbox": list(C.OOD), "buffer_km": C.BUFFER_KM, "counts": counts, "cells": {f"{x}_{y}": s for (x, y), s in sorted(cells.items())},
    }
    spans = {"train": C.TRAIN_YEARS, "test": C.TEST_YEARS, "ood_time": C.OOD_TIME_YEARS}
    years = {str(y): s for s, (a, b) in spans.items() for y in range(a, b + 1)}
    temporal = {"version": "v1_temporal", "kind": "temporal_holdout", "rule": "by_calendar_year", **{f"{k}_years": list(range(a, b + 1)) for k, (a, b) in spans.items()}, "assignment": years}
    return spatial, temporal
