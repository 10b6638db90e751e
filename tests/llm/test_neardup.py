import random
import re

import numpy as np
import pytest

from sondeframe.llm.components import connected_components
from sondeframe.llm.neardup import near_duplicates
from sondeframe.llm.superminhash import signatures, similarity


def shingles(text, k):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return frozenset(tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1))) if words else frozenset()


def brute(docs, k, num, den):
    sets = {i: shingles(t, k) for i, t in docs}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            if sets[a] and sets[b] and den * len(sets[a] & sets[b]) >= num * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    return {i: (len(sets[i]), find(i)) for i in ids}


def edited(words, rate, rng):
    return " ".join(f"e{rng.random()}" if rng.random() < rate else w for w in words)


def test_hot_group_matches_brute_force(spark):
    rng = random.Random(5)
    base = [f"b{i}" for i in range(120)]
    docs = [(i, edited(base, rng.choice([0, 0.01, 0.03, 0.06, 0.1]), rng)) for i in range(90)]
    docs += [(100 + i, " ".join(rng.choice("abcdefgh") * 3 for _ in range(60))) for i in range(20)]
    docs += [(200 + i, " ".join([*base[:40], *(f"u{i}_{j}" for j in range(40))])) for i in range(30)]
    rng.shuffle(docs)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    for k, num in ((3, 85), (5, 80)):
        got = {r.id: (r.n_shingles, r.component_id) for r in near_duplicates(df, k, num, 100, 32, 4).collect()}
        assert got == brute(docs, k, num, 100)


def test_odd_rows(spark, odd_docs):
    got = near_duplicates(odd_docs, 3, 85, 100, 25, 5).collect()
    assert len(got) == 10
    by = {}
    for r in got:
        by.setdefault(r.id, []).append((r.n_shingles, r.component_id, r.kept))
    assert by[2] == [(0, 2, True)] and by[3] == [(0, 3, True)] and by[6] == [(0, 6, True)]
    assert by[5] == [(by[4][0][0], 4, False)] * 2 and by[8] == [(1, 7, False)] and by[None][0][1:] == (None, True)


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert near_duplicates(df).count() == 0


def test_signature_is_unbiased():
    rng = np.random.default_rng(3)
    errors = []
    for _ in range(100):
        u = rng.integers(0, 2**63, 300).astype(np.uint64)
        s = signatures(np.concatenate([u[:200], u[100:]]), np.array([0, 200, 400]), 64)
        errors.append(similarity(s[0], s[1]) - 1 / 3)
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < (1 / 3 * 2 / 3 / 64) ** 0.5 * 1.15


@pytest.mark.parametrize("n", [1, 40])
def test_components_of_a_chain(spark, n):
    df = spark.createDataFrame([(i, i + 1) for i in range(n)] + [(100, 101)], "u long, v long")
    got = {r.node: r.component for r in connected_components(df).collect()}
    assert got == {**{i: 0 for i in range(n + 1)}, 100: 100, 101: 100}


def test_rows_that_share_an_id_link_in_any_order(spark):
    """Document 2 holds a near copy of 1, another text and a copy of 3; the order of rows plays no part."""
    base, other, third = ([f"{c}{i}" for i in range(100)] for c in "abc")
    rows = [(1, " ".join(base)), (2, " ".join([*base[:50], "x", *base[51:]])), (2, " ".join(other)), (2, " ".join(third)), (3, " ".join(third)), (4, " ".join([*other[:30], "y", *other[31:]])), (5, "far from all of these words")]
    for order in (rows, rows[::-1], rows[3:] + rows[:3], sorted(rows, key=lambda r: r[1])):
        for parts in (1, 4):
            got = near_duplicates(spark.createDataFrame(order, "doc_id long, text string").repartition(parts), 3, 85, 100, 25, 5).collect()
            assert sorted((r.id, r.component_id, r.kept) for r in got) == [(1, 1, True), *[(2, 1, False)] * 3, (3, 1, False), (4, 1, False), (5, 5, True)]


def test_a_star_is_checked_in_parts(spark):
    """A node of many partners meets them under several keys, and its text is not sent with each of them."""
    from sondeframe.llm import neardup

    base = [f"b{i}" for i in range(60)]
    texts = spark.createDataFrame([(i, " ".join([*base, f"e{i}"])) for i in range(200)], "node long, text string")
    pairs = spark.range(1, 200).selectExpr("0L as a", "id as b", "id % 13 as salt")
    plan = neardup._verified(pairs, texts, 3, 85, 100)
    assert sorted(tuple(r) for r in plan.collect()) == [(0, i) for i in range(1, 200)]
    assert "hashpartitioning(a" in (text := plan._jdf.queryExecution().executedPlan().toString()) and "salt" in text.split("hashpartitioning(a")[-1][:60]
