import os
import re
import zlib
from array import array

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sondeframe.llm import tokencounts
from sondeframe.llm.idfile import decode_data, encode_block, round_trip
from sondeframe.llm.packing import _band_end, best_fit, pack, sweep_plan
from sondeframe.llm.quality import keep_quality, quality
from sondeframe.llm.queries import op1_token_counts
from sondeframe.llm.spviterbi import Encoder, StreamingViterbi, encoded
from sondeframe.llm.tokens import UnitEncoder, public_path
from sondeframe.llm import toxicity as toxicity_module
from sondeframe.llm.toxicity import _shift, features, fit, sample, toxicity
from sondeframe.llm.toxicity import scales as toxicity_scales

TEXT = st.text(st.sampled_from(list("abZ .,'st\n\t19éÀß|#<$|>½ \u0301\x1c\u2003ü中")) | st.characters(codec="utf-8"), max_size=60)
_made = {}


def made(key, f):
    if key not in _made:
        _made[key] = f()
    return _made[key]


@pytest.mark.parametrize("name, kind", [("byte_bpe_50k.json", "byte"), ("word_bpe_49k.json", "word")])
@settings(max_examples=150, deadline=None)
@given(texts=st.lists(TEXT, max_size=6))
def test_units_give_the_library_ids(name, kind, texts):
    e = made(name, lambda: UnitEncoder(public_path(name), kind, max_units=500))
    want = [array("I", x.ids).tobytes() for x in e.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert list(e.encode(texts)) == want


def best_score(v, text):
    """Brute force: the best total over all segmentations."""
    best = [0.0] + [float("-inf")] * len(text)
    for end in range(1, len(text) + 1):
        for start in range(end):
            found = v.prefixes.get(text[start:end])
            if found:
                best[end] = max(best[end], best[start] + found[1])
        if v.prefixes.get(text[end - 1]) is None:
            best[end] = max(best[end], best[end - 1] + v.unknown_score)
    return best[-1]


@settings(max_examples=150, deadline=None)
@given(text=TEXT, size=st.integers(1, 9))
def test_viterbi_is_best_and_streams(text, size):
    e = made("sp", lambda: Encoder(public_path("piece_bpe_32k.model")))
    ids = next(e.encode([text]))
    normal = e.v.processor.normalize(text)
    total, run = 0.0, 0
    for i in array("I", ids):
        if i in e.v.byte_ids.values():
            run += 1
        else:
            total += e.v.scores[i]
    unknown = sum(c for c in (1 for ch in normal if e.v.prefixes.get(ch) is None))
    if unknown == 0:
        assert total == best_score(e.v, normal)
    assert e.decode(ids) == e.v.processor.decode(list(array("I", ids)))
    s, out = StreamingViterbi(e.v), []
    for at in range(0, len(normal), size):
        out += s.feed(normal[at : at + size])
    assert out + s.finish() == list(array("I", ids))


def brute_path(v, text):
    """Best total and ids over all segmentations, unknown characters too; the earliest start wins a tie."""
    best, back = [0.0] + [float("-inf")] * len(text), [None] * (len(text) + 1)
    for end in range(1, len(text) + 1):
        for start in range(end):
            found = v.prefixes.get(text[start:end]) or ((None, v.unknown_score) if end == start + 1 else None)
            if found and best[start] + found[1] > best[end]:
                best[end], back[end] = best[start] + found[1], (start, found[0])
    ids, end = [], len(text)
    while end:
        start, piece = back[end]
        ids = ([piece] if piece is not None else [v.byte_ids[b] for b in text[start:end].encode()]) + ids
        end = start
    return ids


@settings(max_examples=120, deadline=None)
@given(texts=st.lists(TEXT | st.text("ab-=", max_size=200), max_size=5), chunk=st.integers(1, 40))
def test_viterbi_matches_brute_force_in_any_chunks(texts, chunk):
    e = made("sp", lambda: Encoder(public_path("piece_bpe_32k.model")))
    small = Encoder.__new__(Encoder)
    small.v, small.chunk = e.v, chunk
    want = [brute_path(e.v, e.v.processor.normalize(t)) for t in texts]
    assert [list(array("I", x)) for x in e.encode(texts)] == want
    assert [list(array("I", x)) for x in small.encode(texts)] == want


def test_sentencepiece_odd_rows(spark, odd_docs):
    got = encoded(odd_docs, public_path("piece_bpe_32k.model"), with_ids=False).collect()
    assert len(got) == 10 and all(r.round_trip for r in got) and {r.n_tokens for r in got if r.doc_id in (2, 3)} == {0}


def brute_sweep(docs, slots):
    """Largest first, slots before documents; a document takes the slot put on the stack last."""
    stack, pairs = [], {}
    for value, kind, i in sorted([(-v, 0, i) for i, v in enumerate(slots)] + [(-v, 1, i) for i, v in enumerate(docs)]):
        if kind == 0:
            stack.append(i)
        elif stack:
            pairs[i] = stack.pop()
            assert slots[pairs[i]] >= -value
    return pairs


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 12), max_size=30), st.lists(st.integers(1, 12), max_size=30))
def test_sweep_plan_counts_what_a_stack_matches(docs, slots):
    pairs = brute_sweep(docs, slots)
    plan = sweep_plan({v: docs.count(v) for v in docs}, {v: slots.count(v) for v in slots}, 12)
    for value, before, after, placed in plan:
        assert placed == sum(docs[i] == value for i in pairs) and after - before == slots.count(value)
        assert before == sum(v > value for v in slots) - sum(docs[i] > value for i in pairs)


def brute_rounds(lengths, capacity, ratio):
    """Sequences opened by the same rounds in plain Python."""
    rest, gaps, n = sorted((v for v in lengths if v < capacity), reverse=True), [], sum(v == capacity for v in lengths)
    while rest:
        low = _band_end(rest[0], capacity, ratio)
        band, rest = [v for v in rest if v > low], [v for v in rest if v <= low]
        while band:
            most, least = max(band), min(band)
            if not any(g >= least for g in gaps):
                need = -(-len(band) // (capacity // most))
                gaps, n = gaps + [capacity] * need, n + need
            slots = [i for i, g in enumerate(gaps) if g >= least for _ in range(max(1, g // most))]
            pairs = brute_sweep(band, [gaps[i] for i in slots])
            for d, k in pairs.items():
                gaps[slots[k]] -= band[d]
            band = [v for i, v in enumerate(band) if i not in pairs]
    return n


def best_fit_decreasing(lengths, capacity):
    gaps = []
    for v in sorted(lengths, reverse=True):
        fits = [i for i, g in enumerate(gaps) if g >= v]
        if fits:
            gaps[min(fits, key=gaps.__getitem__)] -= v
        else:
            gaps.append(capacity - v)
    return len(gaps)


def test_best_fit_matches_plain_rounds(spark):
    rng = np.random.default_rng(4)
    lengths = [*rng.integers(1, 65, 250).tolist(), *[64] * 5, *[17] * 60, *[1, 1, 2]]  # ties, and one length that many share
    items = spark.createDataFrame([(i, v, "x") for i, v in enumerate(lengths)], "_row long, length long, gap string")
    got = best_fit(items, 64).collect()
    assert len(got) == len(lengths) and got[0].gap == "x" and sorted(r.length for r in got) == sorted(lengths)
    by = {}
    for r in got:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for held in by.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= 64
    assert len(by) == brute_rounds(lengths, 64, 0.75) <= 1.02 * best_fit_decreasing(lengths, 64) + 1


def test_pieces_match_the_library(spark, odd_docs):
    """Starts, lengths and checksums of every piece, from the tokenizer's own ids."""
    tk = UnitEncoder(public_path("byte_bpe_50k.json"), "byte").tokenizer
    want = []
    for r in odd_docs.collect():
        ids = [*tk.encode(r.text or "", add_special_tokens=False).ids, 0]
        cuts = [0, *range((len(ids) - 1) % 512 + 1, len(ids) + 1, 512)]
        want += [(r.doc_id, i, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())) for i, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False))]
    got = [(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in pack(odd_docs, public_path("byte_bpe_50k.json"), capacity=512).collect()]
    assert sorted(map(str, got)) == sorted(map(str, want))


def test_pack_odd_rows(spark, odd_docs):
    tk = UnitEncoder(public_path("byte_bpe_50k.json"), "byte")
    got = pack(odd_docs, public_path("byte_bpe_50k.json"), capacity=2048).collect()
    want = sum(len(x) // 4 + 1 for x in tk.encode([r.text for r in odd_docs.select("text").collect()]))
    assert sum(r.length for r in got) == want and max(r.length for r in got) == 2048
    by = {}
    for r in got:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for items in by.values():
        at = 0
        for offset, length in sorted(items):
            assert offset == at
            at += length
        assert at <= 2048
    assert [r.ids_crc32 for r in got if r.doc_id == 2] == [zlib.crc32(b"\0\0\0\0")]


def test_pack_empty(spark, odd_docs):
    assert pack(odd_docs.where("false"), public_path("byte_bpe_50k.json")).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1) | st.integers(0, 300), min_size=1, max_size=50))
def test_variable_length_codes(values):
    ranks = np.array(values, np.uint32)
    data = encode_block([(1, len(ranks), 1)], ranks)
    at = 16 + 16
    control = np.frombuffer(data[at : at + -(-len(ranks) // 4)], np.uint8)
    assert (decode_data(control, np.frombuffer(data[at + len(control) :], np.uint8), len(ranks)) == ranks).all()


def test_id_files_odd_rows(spark, odd_docs):
    path = public_path("word_bpe_49k.json")
    got = sorted(round_trip(odd_docs, path, "word", 1, 49_408).collect(), key=lambda r: r.start)
    docs = sorted(((r.doc_id is not None, r.doc_id or 0, r.text) for r in odd_docs.select("doc_id", "text").collect()), key=lambda r: r[:2])
    end, at = array("I", [1]).tobytes(), 0
    assert len(got) == 10
    for r, (there, i, ids) in zip(got, [(a, b, x) for (a, b, _), x in zip(docs, UnitEncoder(path, "word").encode([d[2] for d in docs]), strict=True)], strict=True):
        assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32) == (i if there else None, at, len(ids) // 4 + 1, zlib.crc32(ids + end))
        at += r.n_tokens
    assert round_trip(odd_docs.where("false"), path, "word", 1, 49_408).count() == 0


def test_token_counts_are_delta_maintained(spark, odd_docs, tmp_path):
    versions = {"byte@1": (public_path("byte_bpe_50k.json"), "byte")}
    counted = tokencounts.count_tokens(odd_docs, versions).cache()
    rollup = f"file://{tmp_path}/rollup"
    for _ in range(2):
        tokencounts.commit(tokencounts.inserts(counted), rollup, "b1")
    gone = counted.where("doc_id = 4")
    tokencounts.commit(tokencounts.deletes(gone), rollup, "b2")
    revised = counted.where("doc_id = 1")
    tokencounts.commit(tokencounts.revisions(revised, revised.selectExpr("source", "'de' lang", "tokenizer", "n_tokens + 5 as n_tokens")), rollup, "b3")
    got = {(r.source, r.lang): (r.n_docs, r.n_tokens) for r in tokencounts.totals(spark, rollup).collect()}
    n = {}
    for r in counted.collect():
        n.setdefault(r.doc_id, r.n_tokens)
    assert got["a", "en"] == (2, 2 * n[5]) and got["a", "de"] == (1, n[1] + 5) and got[None, "en"] == (1, 0)
    tokencounts.compact(spark, rollup, f"file://{tmp_path}/folded")
    assert sorted(map(str, tokencounts.totals(spark, f"file://{tmp_path}/folded").collect())) == sorted(map(str, tokencounts.totals(spark, rollup).collect()))
    assert tokencounts.totals(spark, f"file://{tmp_path}/none").count() == 0


def brute_quality(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    seen, covered = {}, set()
    for w in windows:
        seen[w] = seen.get(w, 0) + 1
    for i, w in enumerate(windows):
        if seen[w] > 1:
            covered |= set(range(i, i + 5))
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered)


def test_quality_matches_brute_force(spark, sf, odd_docs):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    extra = spark.createDataFrame([(10**6, "a b c d e f a b c d e f g\na b c d e f g"), (10**6 + 1, "x " * 40), (10**6 + 2, "é|ü<>\n\n#\n#\r\n")], "doc_id long, text string")
    docs = docs.select("doc_id", "text").unionByName(extra).unionByName(odd_docs.select("doc_id", "text"))
    text = sorted((str(r.doc_id), brute_quality(r.text)) for r in docs.collect())
    got = quality(docs).collect()
    assert sorted((str(r.doc_id), (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)) for r in got) == text
    for r in got:
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words) and not (r.base_failed and r.kept)


def test_toxicity_learns(spark, odd_docs):
    rng = np.random.default_rng(2)
    word = lambda: "".join(rng.choice(list("abcdefghij"), 5))
    rows = [(i, " ".join([word() for _ in range(30)] + (["zzvileword"] if i % 4 == 0 else [])), int(i % 4 == 0)) for i in range(600)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows] + [(None, 1), (3, None)], "doc_id long, toxic int")
    got = toxicity(docs, labels).collect()
    truth = {r[0]: r[2] for r in rows}
    held = [r for r in got if r.held_out]
    assert len(got) == 600 and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    assert np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.97
    odd = toxicity(odd_docs, labels.where("false")).collect()
    assert len(odd) == 10 and all(r.score < 1e-6 for r in odd)


def test_toxicity_recall_by_language(spark):
    """On held-out labels of the real table: most toxic rows of every language, and hardly any clean one."""
    folder = "/root/testdata/sf0.1"
    if not os.path.isdir(folder):
        pytest.skip("no test data")
    labels = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "toxic")
    docs = spark.read.parquet(f"{folder}/documents.parquet").join(labels, "doc_id", "left_semi").select("doc_id", "lang", "text")
    got = {r.doc_id: r.predicted for r in toxicity(docs, labels).where("held_out").collect()}
    rows = [(r.lang, r.toxic, got[r.doc_id]) for r in docs.drop("text").join(labels, "doc_id").collect() if r.doc_id in got]
    recall = lambda lang=None: np.mean([p for g, t, p in rows if t == 1 and lang in (None, g)])
    by = {g: recall(g) for g in {r[0] for r in rows}}
    assert len(rows) > 800 and recall() >= 0.8 and min(by.values()) >= 0.6, by
    assert np.mean([p for _, t, p in rows if t == 0]) <= 0.01


def test_toxicity_cut_keeps_its_bound():
    rng = np.random.default_rng(5)
    clean, bad = rng.normal(-4, 1, 2000), rng.normal(-1, 1, 300)
    cut = _shift(np.concatenate((clean, bad)), np.repeat([0.0, 1.0], [2000, 300]))
    assert 5 <= (clean >= cut).sum() <= 10 and (bad >= cut).mean() > 0.5
    assert _shift(clean, np.zeros(2000)) == 0.0


def test_folded_batches_are_not_counted_again(spark, tmp_path):
    counted = spark.createDataFrame([("a", "en", "v", 5), ("a", "en", "v", 7), (None, "de", "v", 2)], "source string, lang string, tokenizer string, n_tokens long")
    first, second, third = (f"file://{tmp_path}/{x}" for x in "abc")
    shown = lambda rollup: {(r.source, r.lang): (r.n_docs, r.n_tokens) for r in tokencounts.totals(spark, rollup).collect()}
    tokencounts.commit(tokencounts.inserts(counted), first, "b1")
    tokencounts.compact(spark, first, second)
    tokencounts.commit(tokencounts.inserts(counted), second, "b1")
    want = {("a", "en"): (2, 12), (None, "de"): (1, 2)}
    assert shown(second) == want
    for _ in range(2):
        tokencounts.commit(tokencounts.deletes(counted.where("n_tokens = 7")), second, "b2")
    tokencounts.compact(spark, second, third)
    assert not tokencounts.commit(tokencounts.inserts(counted), third, "b1")
    assert not tokencounts.commit(tokencounts.deletes(counted.where("n_tokens = 7")), third, "b2")
    with pytest.raises(ValueError, match="other sums"):  # a folded id keeps its digest
        tokencounts.commit(tokencounts.inserts(counted), third, "b2")
    assert shown(third) == {("a", "en"): (1, 5), (None, "de"): (1, 2)}
    with pytest.raises(ValueError):
        tokencounts.commit(tokencounts.inserts(counted), third, "base")


def test_op1_totals_are_the_plain_sums(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    versions = {f"{n}@1": (public_path(f"{n}.json"), kind) for n, kind in (("byte_bpe_50k", "byte"), ("word_bpe_49k", "word"))}
    want = {}
    for r in tokencounts.count_tokens(docs, versions).collect():
        n = want.setdefault((r.source, r.lang, r.tokenizer), [0, 0])
        n[0], n[1] = n[0] + 1, n[1] + r.n_tokens
    got = {(r.source, r.lang, r.tokenizer): [r.n_docs, r.n_tokens] for r in op1_token_counts(spark, sf).collect()}
    assert got == want


def test_commits_are_published_whole(spark, tmp_path):
    rows = spark.createDataFrame([("a", "en", "v", 5, "clash"), (None, None, "v", 2, "clash")], "source string, lang string, tokenizer string, n_tokens long, d_docs string")
    rollup = f"file://{tmp_path}/r"
    tokencounts.inserts(rows).write.parquet(f"{rollup}/data/dead-attempt")  # never published
    assert tokencounts.commit(tokencounts.inserts(rows), rollup, "x/1 y") and not tokencounts.commit(tokencounts.inserts(rows), rollup, "x/1 y")
    assert sorted((r.n_docs, r.n_tokens) for r in tokencounts.totals(spark, rollup).collect()) == [(1, 2), (1, 5)]
    with pytest.raises(ValueError):
        tokencounts.commit(tokencounts.deletes(rows), rollup, "x/1 y")
    assert tokencounts.commit(tokencounts.inserts(rows.where("false")), rollup, "empty")
    tokencounts.compact(spark, rollup, f"{rollup}2")
    assert not tokencounts.commit(tokencounts.inserts(rows), f"{rollup}2", "x/1 y")


def test_toxicity_sample_is_bounded(spark):
    """One id that thousands of rows hold teaches one text."""
    docs = spark.range(4000).selectExpr("1L as doc_id", "concat('text ', id) as text", "'x' as _score").unionByName(
        spark.createDataFrame([(i, f"other {i}", "y") for i in range(2, 30)], "doc_id long, text string, _score string"))
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 30)], "doc_id long, toxic int")
    got = sample(docs, labels, "doc_id", "text", 6).collect()
    assert len(got) <= 6 and {r.toxic for r in got} == {0, 1}
    assert len([r for r in sample(docs, labels.where("doc_id in (1, 2, 3)"), "doc_id", "text", 6).collect() if r.text.startswith("text ")]) <= 1
    assert toxicity(docs.where("doc_id > 1"), labels).count() == 28 and toxicity(docs.where("false"), labels).count() == 0


def test_toxicity_scores_match_a_plain_recount(spark):
    """Ratios and scores recomputed with dictionaries from the n-grams of the texts."""
    rng = np.random.default_rng(6)
    words = ["".join(rng.choice(list("abcdefgh"), 4)) for _ in range(40)]
    rows = [(i, " ".join(rng.choice(words, 12)) + (" vilest word" if i % 3 == 0 else ""), int(i % 3 == 0)) for i in range(300)]
    docs, labels = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string"), spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int")
    b, table = fit(docs, labels)
    train = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 5]
    sets = dict(zip([r[0] for r in rows], [set(np.concatenate(f).tolist()) for f in features(pa.array([r[1] for r in rows]))], strict=True))
    n1 = sum(r[2] for r in train)
    n0 = len(train) - n1
    kept = 0
    for f in set().union(*sets.values()):
        p, q = (sum(f in sets[r[0]] for r in train if r[2] == c) for c in (1, 0))
        ratio = np.log((p + 0.3) / n1) - np.log(q / n0 + 0.3 / n1)
        z = ratio / np.sqrt(1 / (p + 0.5) + 1 / (q + 0.5))
        scale = toxicity_scales(np.array([float(p)]), np.array([float(q)]), n1, n0)[0]
        assert abs(scale - ratio * z**2 / (z**2 + 9)) < 1e-12
        assert (table[f] != 0) == (p + q > 0 and abs(scale) > 1e-12)  # every feature of the training texts keeps its part
        kept += table[f] != 0
    assert kept > 0.95 * len(set().union(*(sets[r[0]] for r in train)))
    for r in toxicity(docs, labels).collect():
        assert abs(r.score - 1 / (1 + np.exp(-(b + sum(table[f] for f in sets[r.doc_id]))))) < 1e-5


def test_quality_keeps_columns_of_any_name(spark):
    good = "the cat sat on the mat and the dog ran off to a house by the sea"
    docs = spark.createDataFrame([(1, good, 5, "a", "b"), (2, "one two", 6, "a", "b"), (None, good, 7, None, None), (3, None, 8, "", "")], "doc_id long, text string, _q int, _w string, held string")
    got = keep_quality(docs)
    assert got.columns == docs.columns and sorted(r["_q"] for r in got.collect()) == [5, 7]
    assert keep_quality(docs.where("false")).count() == 0 and quality(docs.where("false")).count() == 0


def test_toxicity_features_of_long_texts_do_not_depend_on_slices(monkeypatch):
    """Slices cut inside words, runs of white space and code points of several bytes give the same features."""
    rng = np.random.default_rng(8)
    text = "".join(rng.choice(["a", "B", "é", "ж", "中", " ", "  \n", "\t", "x y"], 3000))
    whole = [np.sort(x) for x in next(features(pa.array([text])))]
    for size in (7, 64, 1001):
        monkeypatch.setattr(toxicity_module, "SLICE", size)
        (sliced,) = features(pa.array([text]))
        assert all((a == b).all() for a, b in zip(whole, sliced, strict=True))
    monkeypatch.undo()
    assert len(next(features(pa.array(["жжжж"])))[0]) == 1 and len(next(features(pa.array(["жжж"])))[0]) == 0  # code points, not bytes


def test_toxicity_memory_stays_bounded_for_a_long_text():
    """A text of 40 MB is hashed within a tenth of what whole arrays of it would take."""
    import tracemalloc

    text = pa.array([" ".join(f"w{i % 5000}" for i in range(6_500_000))])
    tracemalloc.start()
    (found,) = features(text)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 100e6 and all(len(x) for x in found)


def test_token_counts_lose_no_change_silently(spark, tmp_path):
    """Nulls count in the digest, a compacted folder is closed, a folded id with other sums raises."""
    schema = "source string, lang string, tokenizer string, n_tokens long"
    one, other = (tokencounts.inserts(spark.createDataFrame([r], schema)) for r in ((None, "en", "v", 4), ("en", None, "v", 4)))
    old, new, third = (f"file://{tmp_path}/{x}" for x in ("old", "new", "third"))
    assert tokencounts.commit(one, old, "b")
    with pytest.raises(ValueError, match="other sums"):
        tokencounts.commit(other, old, "b")
    tokencounts.compact(spark, old, new)
    tokencounts.compact(spark, old, new)  # done again after a lost acknowledgement
    with pytest.raises(ValueError, match="went on in"):
        tokencounts.commit(other, old, "c")
    with pytest.raises(ValueError, match="went on in"):
        tokencounts.compact(spark, old, third)
    assert not tokencounts.commit(one, new, "b") and tokencounts.commit(other, new, "c")
    with pytest.raises(ValueError, match="other sums"):
        tokencounts.commit(other, new, "b")
    tokencounts.compact(spark, new, third)
    with pytest.raises(ValueError, match="other sums"):
        tokencounts.commit(other, third, "b")
    assert not tokencounts.commit(other, third, "c")
    shown = [(r.source, r.lang, r.n_docs, r.n_tokens) for r in tokencounts.totals(spark, third).collect()]
    assert sorted(shown, key=str) == sorted([(None, "en", 1, 4), ("en", None, 1, 4)], key=str)
    assert tokencounts.totals(spark, old).count() == 1  # what it held stays readable
    for name in (tokencounts.BASE, tokencounts.CLOSED):
        with pytest.raises(ValueError):
            tokencounts.commit(one, third, name)


def test_token_counts_take_any_column_names(spark):
    docs = spark.createDataFrame([("a", "x", 1.5, "hello there"), ("b", "y", None, None)], "_text string, _text_ string, n_tokens double, text string")
    got = tokencounts.count_tokens(docs, {"byte@1": (public_path("byte_bpe_50k.json"), "byte")})
    assert got.columns == ["_text", "_text_", "tokenizer", "n_tokens"] and sorted((r["_text"], r["_text_"], r.n_tokens > 0) for r in got.collect()) == [("a", "x", True), ("b", "y", False)]
