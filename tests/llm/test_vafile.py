import os
import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from sondeframe.llm import oracle, vafile
from sondeframe.llm.vafile import Cells, hard_negatives

SCHEMA = "vec_id long, label int, vector array<long>, rank string"


def brute(rows, asked, positives=5, negatives=3):
    by = {}
    for i, label, v in rows:
        if i is not None and label is not None and v is not None and None not in v:
            by[i] = min(by.get(i, (label, v)), (label, v))
    out = []
    for a, (la, va) in by.items():
        if not asked(a):
            continue
        score = {i: sum(x * y for x, y in zip(va, v, strict=True)) for i, (_, v) in by.items() if i != a}
        order = sorted(score, key=lambda i: (-score[i], i))
        for p in [i for i in order if by[i][0] == la][:positives]:
            fits = [i for i in order if by[i][0] != la and 50 * score[p] <= 100 * score[i] <= 95 * score[p]][:negatives]
            out += [(a, p, n + 1, i, score[p], score[i]) for n, i in enumerate(fits)]
    return sorted(out)


def made(rng, n, dims, spread, labels):
    rows = [(i, rng.randrange(labels), [rng.randint(-spread, spread) for _ in range(dims)]) for i in range(n)]
    hot = [rng.randint(-spread, spread) for _ in range(dims)]
    rows += [(n + i, rng.randrange(2), hot) for i in range(n // 2)]  # a third of all rows are copies of one vector
    rows += [(5000, 0, [0] * dims), (5010, 7, hot), (5020, 1, [-x for x in hot])]  # no direction; alone with its label; opposite
    rng.shuffle(rows)
    return rows


def got(spark, rows, parts=5, **more):
    df = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA).repartition(parts)
    return sorted(map(tuple, hard_negatives(df, F.col("vec_id") % 10 == 0, **more).collect()))


@pytest.mark.parametrize(("spread", "labels", "bits"), [(100, 4, 6), (100, 4, 2), (2, 3, 4), (1000, 2, 8)])
def test_matches_brute_force(spark, monkeypatch, spread, labels, bits):
    for name, value in (("BLOCK_ROWS", 16), ("ANCHOR_ROWS", 4), ("LANE_BLOCKS", 2), ("THIN_ROWS", 8), ("FIT_ROWS", 30)):
        monkeypatch.setattr(vafile, name, value)
    rows = made(random.Random(spread + bits), 150, 12, spread, labels)
    want = brute(rows, lambda a: a % 10 == 0)
    assert got(spark, rows, bits=bits) == want and len(want) > 30


def test_bounds_hold_for_every_row_and_are_met_by_whole_cells():
    rng = np.random.default_rng(1)
    x, q = rng.integers(-300, 300, (500, 9)), rng.integers(-300, 300, (20, 9)).astype(float)
    for bits in (1, 3, 6, 8):
        cells = Cells(x[:40], x.min(0), x.max(0), bits)
        low, high = cells.bounds(cells.codes(x), q)
        exact = q @ x.T
        assert (low <= exact).all() and (exact <= high).all()
    low, high = Cells(x[:, :1] // 100, x[:, 0].min(keepdims=True) // 100, x[:, 0].max(keepdims=True) // 100, 8).bounds(np.zeros((1, 1), np.uint8), q[:1, :1])
    assert low.shape == (1, 1) and low <= high


def test_few_rows_are_scored_exactly(spark, monkeypatch):
    """Of some 3,000 rows of clustered vectors only a small part stays open for an anchor."""
    rng = np.random.default_rng(4)
    centres = rng.normal(0, 40, (8, 24))
    rows = [(i, int(rng.integers(8)), [int(v) for v in centres[int(rng.integers(8))] + rng.normal(0, 20, 24)], "x") for i in range(3000)]
    seen = []
    scored = vafile._scored
    monkeypatch.setattr(vafile, "_scored", lambda pairs, *a: seen.append(pairs.select("anchor_id", "id").distinct().count()) or scored(pairs, *a))
    df = spark.createDataFrame(rows, SCHEMA)
    out = hard_negatives(df, F.col("vec_id") % 100 == 0).collect()
    assert len({r.anchor_id for r in out}) > 20 and len(seen) == 2
    assert seen[0] < 30 * 3000 * 0.02 and seen[1] < 30 * 3000 * 0.1  # 30 anchors


def test_odd_rows(spark):
    rows = [(0, 1, [3, 4]), (0, 1, [3, 4]), (1, 1, [3, 3]), (2, 2, [2, 3]), (2, 2, [2, 4]), (3, None, [3, 3]), (4, 2, None), (5, 2, [None, 2]), (None, 2, [2, 2]), (7, 2, [3, 2]), (8, 2, [3, 2])]
    assert got(spark, rows) == brute(rows, lambda a: a % 10 == 0) != []
    assert got(spark, [*rows, (9, 2, [5]), (11, 2, [])]) == got(spark, rows)
    assert got(spark, []) == [] and got(spark, [(0, 1, None)]) == [] and got(spark, [(0, 1, [])]) == [] and got(spark, [(0, 1, [1])]) == []
    with pytest.raises(ValueError, match="exact"):
        got(spark, [(0, 1, [1 << 40])])
    with pytest.raises(ValueError, match="bits"):
        got(spark, rows, bits=9)


def test_same_as_sql(spark, sf):
    from sondeframe.llm.queries import op11_hard_negatives

    path = f"{sf}/embeddings.parquet"
    c = duckdb.connect()
    c.execute(f"create view embeddings as select * from '{path}{'/*.parquet' if os.path.isdir(path) else ''}'")
    columns = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    want = c.execute(f"select {', '.join(f'\"{x}\"' for x in columns)} from ({oracle.OP11})").fetchall()
    assert sorted(map(tuple, op11_hard_negatives(spark, sf).select(*columns).collect())) == sorted(want) != []
