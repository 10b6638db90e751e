import numpy as np
from pyspark.sql import functions as F

from sondeframe.llm import ann


def _missed(spark, x, queries, top=20):
    """How many of the truly nearest rows the search leaves out, and how many there are."""
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = {}
    for r in ann.nearest(df, queries, top=top).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r.vec_id)
    missed = 0
    for q, found in got.items():
        s = x @ x[q]
        s[q] = -np.inf
        missed += len(set(np.argsort(-s, kind="stable")[:top].tolist()) - set(found))
    return missed, top * len(got)


def test_rows_that_codes_hold_for_equal_are_all_scored(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(3000, 16))
    x[1000:1900] = rng.normal(size=16) * 4 + rng.normal(size=(900, 16)) * 1e-3  # one spot, finer than any code
    missed, of = _missed(spark, x, (F.col("vec_id") % 20 == 0) & F.col("vec_id").between(1000, 1899))
    assert of == 45 * 20 and missed == 0


def test_queries_unlike_the_other_rows_find_their_cells(spark):
    rng = np.random.default_rng(6)
    centres = rng.normal(size=(40, 16)) * 3
    x = centres[rng.integers(0, 40, 12_000)] + rng.normal(size=(12_000, 16)) * 0.1
    x[::400] = rng.normal(size=(30, 16))  # between the clusters; few, so that a sample of all rows says little about them
    missed, of = _missed(spark, x, F.col("vec_id") % 400 == 0)
    assert of == 600 and missed == 0
