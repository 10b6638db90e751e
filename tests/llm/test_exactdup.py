import hashlib
import os
import random
import re

import duckdb
import pytest

from sondeframe.llm import exactdup, oracle
from sondeframe.llm.exactdup import drop_exact_duplicates, exact_duplicates


def norm(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def brute(rows):
    """(id, text) -> rows (id, keep_id, size, kept, digest); of rows without an id one stays if none has an id."""
    groups = {}
    for i, t in rows:
        groups.setdefault(norm(t), []).append(i)
    out = []
    for i, t in rows:
        ids = groups[norm(t)]
        out.append((i, min((x for x in ids if x is not None), default=None), len(ids), hashlib.sha256(norm(t).encode()).hexdigest()))
    return out


def test_matches_brute_force_over_many_runs(spark):
    rng = random.Random(3)
    texts = ["hot  text", "", None, " ", "\n\t", "a b", "a b", "é ü", "A b", "x" * 50_000]
    rows = [(i, rng.choice(texts) if rng.random() < 0.7 else f"own {i}") for i in range(1500)] + [(10_000 + i, "hot\ttext") for i in range(1500)]
    rng.shuffle(rows)
    for parts in (1, 3, 40, 300):  # 1, 1, 2 and 3 rounds
        df = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
        got = exact_duplicates(df).collect()
        assert sorted((r.id, r.keep_id, r.group_size, r.text_sha256) for r in got) == sorted(brute(rows))
        assert all(r.kept == (r.id == r.keep_id) for r in got)


def test_pieces_of_a_run_meet(spark, monkeypatch):
    """With a fold of two rows, equal texts of one task leave it in several pieces."""
    import pyarrow as pa

    monkeypatch.setattr(exactdup, "FOLD_ROWS", 2)
    batch = pa.record_batch({"run": [0] * 5, "digest": list("abcab"), "n_bytes": [1] * 5, "mark": [1] * 5, "id": [5, 4, 3, None, 1], "row": [0, 1, 2, 3, 4]},
                            schema=pa.schema([("run", pa.int64()), ("digest", pa.string()), ("n_bytes", pa.int64()), ("mark", pa.int64()), ("id", pa.int64()), ("row", pa.int64())]))
    out = pa.Table.from_batches(list(exactdup._fold(iter([batch.slice(i, 1) for i in range(5)])))).to_pylist()
    assert sum(r["size"] for r in out) == 5 and len(out) > 3
    merged = exactdup.merge_round(spark.createDataFrame([(r["run"], r["digest"], r["n_bytes"], r["mark"], tuple(r["first"].values()), r["size"]) for r in out], exactdup._ENTRY), 0)
    assert {(r.digest, r.first.id, r.size) for r in merged.collect()} == {("a", 5, 2), ("b", 1, 2), ("c", 3, 1)}


def test_equal_digests_of_other_texts_stay_apart(spark):
    rows = [(0, "a" * 64, 3, 7, (False, 1, 0), 2), (1, "a" * 64, 4, 7, (False, 2, 1), 2), (1, "a" * 64, 3, 7, (False, 0, 2), 1)]
    got = exactdup.tree_merge(spark.createDataFrame(rows, exactdup._ENTRY), 2).collect()
    assert {(r.n_bytes, r.first.id, r.size) for r in got} == {(3, 0, 3), (4, 2, 2)}


def test_one_of_repeated_rows_stays(spark, odd_docs):
    got = exact_duplicates(odd_docs).collect()
    by = {}
    for r in got:
        by.setdefault(r.keep_id, []).append(r.kept)
    assert len(got) == 10 and all(k.count(True) == 1 for k in by.values()) and sorted(map(len, by.values())) == [1, 1, 1, 2, 2, 3]
    assert [r.keep_id for r in got if r.id is None] == [None]
    nulls = spark.createDataFrame([(None, "t"), (None, "t"), (None, None)], "doc_id long, text string")
    assert sorted((r.group_size, r.kept) for r in exact_duplicates(nulls).collect()) == [(1, True), (2, False), (2, True)]
    kept = drop_exact_duplicates(odd_docs)
    assert kept.columns == odd_docs.columns and sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 2, 4, 6, 7]


def test_empty_table(spark):
    assert exact_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_same_as_sql(spark, sf):
    from sondeframe.llm.queries import op13_exact_dedup

    path = f"{sf}/documents.parquet"
    c = duckdb.connect()
    c.execute(f"create view documents as select * from '{path}{'/*.parquet' if os.path.isdir(path) else ''}'")
    want = c.execute(f"select doc_id, keep_id, group_size, kept, text_sha256 from ({oracle.OP13})").fetchall()
    got = op13_exact_dedup(spark, sf).select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()
    assert sorted(map(tuple, got)) == sorted(want)


@pytest.mark.parametrize("digit", [0, 1])
def test_a_round_keeps_the_other_digits(spark, digit):
    rows = [(run, f"{d:x}{e:x}" + "0" * 62, 1, 1, (False, run, 0), 1) for run in (0, 5, 17, 250) for d in (0, 9) for e in (3, 15)]
    got = exactdup.merge_round(spark.createDataFrame(rows, exactdup._ENTRY), digit).collect()
    for r in got:
        assert r.run // 16**digit % 16 == int(r.digest[digit], 16)
    assert sum(r.size for r in got) == len(rows)
