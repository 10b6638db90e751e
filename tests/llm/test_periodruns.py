import hashlib
import random
import re
import zlib
from array import array
from fractions import Fraction

import pytest

from sondeframe.llm import periodruns
from sondeframe.llm.periodruns import lz_factors, periodic_runs, runs_of


def brute(w, least, times):
    """Every period by itself: maximal stretches of w[i] == w[i - p]; a stretch counts by its smallest period."""
    out = {}
    for p in range(1, len(w) // times + 1):
        i = p
        while i < len(w):
            j = i
            while j < len(w) and w[j] == w[j - p]:
                j += 1
            if j > i and j - i + p >= max(least, times * p):
                out.setdefault((i - p, j), p)
            i = max(j, i + 1)
    return sorted((a, b - a, p) for (a, b), p in out.items())


def collapsed(words, runs):
    gone = {i for s, n, p in runs for i in range(s + p, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


@pytest.mark.parametrize("seed", range(6))
def test_runs_match_brute_force(seed):
    rng = random.Random(seed)
    for _ in range(150):
        w = [rng.randrange(rng.choice([1, 2, 3, 4])) for _ in range(rng.randrange(80))]
        for _ in range(rng.randrange(4)):
            a = rng.randrange(len(w) + 1)
            w[a:a] = w[a : a + rng.randrange(1, 12)] * rng.randrange(1, 6)
        w = array("i", w + w[: rng.randrange(len(w) + 1)] + w if rng.random() < 0.3 else w)
        for least, times in ((4, 2), (3, 3), (6, 3), (8, 2), (12, 4)):
            assert runs_of(w, least, times) == brute(w, least, times)


def test_factors_are_longest_earlier_occurrences():
    rng = random.Random(9)
    for _ in range(60):
        w = array("i", [rng.randrange(3) for _ in range(40)])
        at = 0
        for start, length, source in lz_factors(w):
            assert start == at
            earlier = max((next((k for k in range(len(w) - at) if w[j + k] != w[at + k]), len(w) - at) for j in range(at)), default=0)
            assert (source < 0 and earlier == 0 and length == 1) or (length == earlier and w[source : source + length] == w[start : start + length] and source < start)
            at += length
        assert at == len(w)


def texts(rng):
    base = [f"w{i}" for i in range(40)]
    for i in range(60):
        words = [rng.choice(base) if rng.random() < 0.5 else f"u{rng.random()}" for _ in range(rng.randrange(120))]
        for _ in range(rng.randrange(3)):
            a = rng.randrange(len(words) + 1)
            words[a:a] = words[a : a + rng.randrange(1, 15)] * rng.randrange(1, 7)
        if i % 4 == 0:  # a run again inside a longer repeat: copied from the first
            words = words + ["x", *["r1", "r2", "r3"] * 9, "y", "z", *words[:30]] * 2
        yield rng.choice([" ", "\n", " \t"]).join(words)


@pytest.mark.parametrize("slice_", [1 << 20, 64])
def test_texts_match_brute_force(spark, monkeypatch, slice_):
    monkeypatch.setattr(periodruns, "SLICE", slice_)
    rows = list(enumerate(texts(random.Random(11))))
    for least, times in ((24, 3), (6, 2)):
        got = {i: (n, runs, c) for i, (n, runs, c) in enumerate(periodruns._of_batch([t.encode() for _, t in rows], least, times))}
        for i, t in rows:
            words = words_of(t)
            want = brute([{w: k for k, w in enumerate(dict.fromkeys(words))}[w] for w in words], least, times)
            assert got[i] == (len(words), want, collapsed(words, want).encode())


def test_query_matches_brute_force(spark, sf):
    from sondeframe.llm.queries import op12_periodic_runs

    got = {r.doc_id: r for r in op12_periodic_runs(spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(docs)
    with_runs = 0
    for r in docs:
        words, h = words_of(r.text), zlib.crc32(str(r.doc_id).encode())
        g, n = h // 10, len(words)
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
        ids = {w: k for k, w in enumerate(dict.fromkeys(words))}
        runs = brute_fast([ids[w] for w in words])
        top = min(runs, key=lambda x: (-Fraction(x[1], x[2]), x[0], x[2]), default=(None, None, None))
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        milli = 1000 * top[1] // top[2] if runs else None
        want = (r.doc_id, len(runs), *top, milli, sha("".join(f"{s},{m},{q}\n" for s, m, q in runs)), sha(collapsed(words, runs)))
        assert tuple(got[r.doc_id][c] for c in ("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")) == want
        with_runs += bool(runs)
    assert with_runs >= 5


def brute_fast(w, least=24, times=3):
    """As ``brute``, with the comparison of each period done by numpy."""
    import numpy as np

    x, out = np.array(w, np.int64), {}
    for p in range(1, len(w) // times + 1):
        same = np.concatenate(([0], (x[p:] == x[:-p]).astype(np.int8), [0]))
        for a, b in zip(np.flatnonzero(np.diff(same) == 1).tolist(), np.flatnonzero(np.diff(same) == -1).tolist(), strict=True):
            if b - a + p >= max(least, times * p):
                out.setdefault((a, b + p), p)
    return sorted((a, b - a, p) for (a, b), p in out.items())


def test_odd_rows(spark, odd_docs):
    got = {}
    for r in periodic_runs(odd_docs).collect():
        got.setdefault(r.id, []).append((r.n_words, [tuple(x) for x in r.runs], r.collapsed))
    assert sum(map(len, got.values())) == 10 and len(got[5]) == 2
    assert got[2] == [(0, [], "")] and got[3] == [(0, [], "")] and got[6] == [(0, [], "")] and got[8] == [(2, [], "one two")]
    assert got[4][0][0] == 30_000 and got[None][0][2] == "a text without an id at all"
    df = spark.createDataFrame([(1, "a " * 400_000, "r")], "doc_id long, text string, runs string")
    (r,) = periodic_runs(df).collect()
    assert [tuple(x) for x in r.runs] == [(0, 400_000, 1)] and r.collapsed == "a"
    giant = spark.createDataFrame([(1, "x" * 3_000_000 + " y"), (2, "é ü " * 30)], "doc_id long, text string")
    got = {r.id: r for r in periodic_runs(giant).collect()}
    assert got[1].n_words == 2 and got[1].runs == [] and got[2].collapsed == "é ü"
    with pytest.raises(ValueError):
        periodic_runs(df, times=1)


def test_empty_table(spark):
    assert periodic_runs(spark.createDataFrame([], "doc_id long, text string")).count() == 0
