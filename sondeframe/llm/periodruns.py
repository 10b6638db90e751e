"""Maximal periodic runs of words, by the method of Kolpakov and Kucherov, and texts with their repeats dropped.

A run is a stretch of words of smallest period q and of length at least ``least`` and
``times * q`` that no neighbouring word extends.  For each text
  1. words that lie in a repeated stretch of ``least - least // times`` words (any run
     is covered by such stretches) are found by hashes of a whole batch at once.  A
     connected piece of them, a span, holds each of its runs whole; other words
     are in no run;
  2. each span's words, told apart by their bytes, go into a suffix automaton, which
     gives its LZ factors: each the longest earlier occurrence, which may overlap;
  3. Main's algorithm finds the runs that touch a factor's border, from longest common
     extensions to both sides of the border (Z arrays over a window of some factor
     lengths, as a run can't reach further);
  4. runs strictly inside a factor are copied from the factor's earlier occurrence.

Texts are independent rows: nothing is shuffled.  A text is read in slices of about
``SLICE`` bytes; held are the text, eight bytes a word and its gram hashes, and for a
span some fifty bytes a word, so a very long text needs about its own size several
times over.  A text without a repeated stretch costs a few array passes.

Edge cases: null and empty texts have no words; null ids pass through; a giant word is
one word; repeated rows are judged alike; an empty table gives no rows; other columns
are not read.
"""

from __future__ import annotations

import re
from array import array
from bisect import bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sondeframe.llm.common import by_bytes

SLICE = 1 << 20
U64 = np.uint64
_GAP = re.compile(rb"[\x20\x09-\x0D]")
_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def _automaton(w: array) -> tuple[array, array, dict[int, dict[int, int]], array]:
    """Suffix automaton of ``w``: first symbol and target of each state, further ones, and where its words first end."""
    size, link, ends, sym, to = array("i", [0]), array("i", [-1]), array("i", [-1]), array("i", [-1]), array("i", [-1])
    more: dict[int, dict[int, int]] = {}
    last = 0
    for i, c in enumerate(w):
        cur = len(size)
        size.append(i + 1), link.append(0), ends.append(i), sym.append(-1), to.append(-1)
        p, q = last, -1
        while p >= 0:
            if sym[p] == c:
                q = to[p]
                break
            if sym[p] < 0:
                sym[p], to[p] = c, cur
            else:
                others = more.setdefault(p, {})
                if c in others:
                    q = others[c]
                    break
                others[c] = cur
            p = link[p]
        if q >= 0:
            if size[p] + 1 == size[q]:
                link[cur] = q
            else:
                twin = len(size)
                size.append(size[p] + 1), link.append(link[q]), ends.append(ends[q]), sym.append(sym[q]), to.append(to[q])
                if q in more:
                    more[twin] = dict(more[q])
                while p >= 0:
                    if sym[p] == c:
                        if to[p] != q:
                            break
                        to[p] = twin
                    else:
                        if more[p][c] != q:
                            break
                        more[p][c] = twin
                    p = link[p]
                link[q] = link[cur] = twin
        last = cur
    return sym, to, more, ends


def lz_factors(w: array) -> list[tuple[int, int, int]]:
    """(start, length, start of the first occurrence, or -1 for a new word) of each factor."""
    sym, to, more, ends = _automaton(w)
    out, i, n = [], 0, len(w)
    while i < n:
        p, at = 0, i
        while at < n:
            c = w[at]
            q = to[p] if sym[p] == c else more[p][c]
            if ends[q] >= at:
                break
            p, at = q, at + 1
        if at == i:
            out.append((i, 1, -1))
            i += 1
        else:
            out.append((i, at - i, ends[p] - (at - i) + 1))
            i = at
    return out


def _z(x: array) -> array:
    """For each place, how many symbols from it on equal the beginning."""
    n = len(x)
    z = array("i", bytes(4 * n))
    if n:
        z[0] = n
    left = right = 0
    for i in range(1, n):
        k = 0
        if i < right:
            k = z[i - left]
            if k >= right - i:
                k = right - i
            else:
                z[i] = k
                continue
        while i + k < n and x[k] == x[i + k]:
            k += 1
        z[i] = k
        if i + k > right:
            left, right = i, i + k
    return z


_END = array("i", [-1])


def _at_border(w: array, border: int, before: int, after: int, least: int, times: int, found: dict[tuple[int, int], int]) -> None:
    """Runs that touch the border of two factors of lengths ``before`` and ``after``: (start, end) -> period."""
    most = (before + after) // (times - 1)  # no longer period fits
    wide = min(border, before + most + 1)
    if wide + after < least:
        return
    n = len(w)
    t, v = w[border - wide : border], w[border : border + after]
    ahead, back = _z(v + _END + t), _z(t[::-1] + _END + v[::-1])

    def add(start: int, end: int, p: int) -> None:
        whole = (end == n or w[end] != w[end - p]) and (start == 0 or w[start - 1] != w[start - 1 + p])
        if whole and p < found.get((start, end), n + 1):
            found[start, end] = p

    for p in range(1, min(wide, most) + 1):  # the period's first copy lies left of the border
        left = back[p] if p < wide else 0
        right = ahead[after + 1 + wide - p]
        if right >= p and p < after:
            right = p + ahead[p]
        if left + right + p >= max(least, times * p):
            add(border - p - left, border + right, p)
    for p in range(1, min(after, most) + 1):  # it starts less than a period left of the border
        left = back[wide + 1 + after - p]
        right = ahead[p] if p < after else 0
        if left < p and left + right + p >= max(least, times * p):
            add(border - left, border + p + right, p)


def runs_of(w: array, least: int, times: int) -> list[tuple[int, int, int]]:
    """(start, length, smallest period) of all runs of ``w`` by start, then period; ``times`` is 2 at least."""
    if len(w) < least:
        return []
    factors = lz_factors(w)
    found: dict[tuple[int, int], int] = {}
    for (_, before, _), (border, after, _) in zip(factors, factors[1:], strict=False):
        _at_border(w, border, before, after, least, times, found)
    _at_border(w, len(w), factors[-1][1], 0, least, times, found)
    by_start: dict[int, list[tuple[int, int]]] = {}
    for (start, end), p in found.items():
        by_start.setdefault(start, []).append((end, p))
    starts = sorted(by_start)
    for at, length, source in factors:
        shift, upto = at - source, source + length
        if source < 0 or length < least + 2:
            continue
        i = bisect_right(starts, source)
        while i < len(starts) and starts[i] + least < upto:
            start = starts[i]
            for end, p in by_start[start]:
                if end < upto and (start + shift, end + shift) not in found:
                    found[start + shift, end + shift] = p
                    if start + shift not in by_start:
                        insort(starts, start + shift)
                    by_start.setdefault(start + shift, []).append((end + shift, p))
            i += 1
    return sorted((start, end - start, p) for (start, end), p in found.items())


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def _grams(h: np.ndarray, width: int) -> np.ndarray:
    """A hash of each ``width`` neighbouring hashes, by doubling."""
    part, size, out, made = _mixed(h), 1, None, 0
    while True:
        if width & size:
            out = part if out is None else _mixed(out[: len(part) - made] * U64(0x9E3779B97F4A7C15) + part[made : made + len(out)][: len(out)])
            made += size
        if size * 2 > width:
            return out[: len(h) - width + 1]
        part = _mixed(part[: len(part) - size] * U64(0x9E3779B97F4A7C15) + part[size:])
        size *= 2


def spans(hashes: np.ndarray, offsets: np.ndarray, width: int) -> list[list[tuple[int, int]]]:
    """For each row, the pieces of words (from, to) covered by stretches of ``width`` words that occur twice in it."""
    rows, n = len(offsets) - 1, len(hashes)
    out: list[list[tuple[int, int]]] = [[] for _ in range(rows)]
    if n < width:
        return out
    row = np.repeat(np.arange(rows), np.diff(offsets))
    start = np.flatnonzero(row[: n - width + 1] == row[width - 1 :])
    key = _mixed(_grams(hashes, width)[start] + row[start].astype(U64) * U64(0xD6E8FEB86659FD93))
    order = np.argsort(key, kind="stable")
    same = key[order[1:]] == key[order[:-1]]
    twice = np.zeros(len(start), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    step = np.zeros(n + 1, np.int64)
    np.add.at(step, start[twice], 1)
    np.add.at(step, start[twice] + width, -1)
    covered = np.cumsum(step)[:n] > 0
    first = np.zeros(n + 1, bool)
    first[offsets[:-1]] = True
    first = first[:n]
    begins = np.flatnonzero(covered & (first | ~np.concatenate(([False], covered[:-1]))))
    ends = np.flatnonzero(covered & (np.concatenate((first[1:], [True])) | ~np.concatenate((covered[1:], [False])))) + 1
    for a, b in zip(begins.tolist(), ends.tolist(), strict=True):
        r = int(row[a])
        out[r].append((a - int(offsets[r]), b - int(offsets[r])))
    return out


class _Text:
    """A text's words, split again from slices that end at white space whenever they are wanted."""

    def __init__(self, text: bytes) -> None:
        self.text, self.cuts, hashes = text, [0], []
        while self.cuts[-1] < len(text):
            end = self.cuts[-1] + SLICE
            gap = _GAP.search(text, end) if end < len(text) else None
            self.cuts.append(gap.start() if gap else len(text))
            words = text[self.cuts[-2] : self.cuts[-1]].split()  # bytes split at just [\x20\x09-\x0D]
            hashes.append(np.fromiter(map(hash, words), np.int64, len(words)))
        self.counts = np.concatenate(([0], np.cumsum([len(x) for x in hashes]))).astype(np.int64)
        self.hashes = np.concatenate(hashes) if hashes else np.zeros(0, np.int64)

    def slices(self) -> Iterator[tuple[int, list[bytes]]]:
        for at, a, b in zip(self.counts.tolist(), self.cuts, self.cuts[1:], strict=False):
            yield at, self.text[a:b].split()

    def words(self, a: int, b: int) -> Iterator[bytes]:
        for k in range(int(np.searchsorted(self.counts, a, side="right")) - 1, len(self.cuts) - 1):
            at = int(self.counts[k])
            if at >= b:
                break
            yield from self.text[self.cuts[k] : self.cuts[k + 1]].split()[max(0, a - at) : b - at]

    def without(self, gone: list[tuple[int, int]]) -> bytes:
        """The words outside the sorted stretches ``gone``, joined by one space."""
        out, g = [], 0
        for at, words in self.slices():
            kept, here, upto = [], at, at + len(words)
            while here < upto:
                while g < len(gone) and gone[g][1] <= here:
                    g += 1
                a, b = gone[g] if g < len(gone) else (upto, upto)
                if here < a:
                    kept += words[here - at : min(a, upto) - at]
                here = max(here, min(b, upto)) if a < upto else upto
            if kept:
                out.append(b" ".join(kept))
        return b" ".join(out)


def _after_first(runs: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """Stretches of words that lie in a run after its first period, sorted and joined."""
    out: list[tuple[int, int]] = []
    for a, b in sorted((s + p, s + n) for s, n, p in runs):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _of_batch(texts: list[bytes], least: int, times: int) -> Iterator[tuple[int, list[tuple[int, int, int]], bytes]]:
    held = [_Text(t) for t in texts]
    offsets = np.concatenate(([0], np.cumsum([len(t.hashes) for t in held]))).astype(np.int64)
    hashes = np.concatenate([t.hashes for t in held]).view(U64) if held else np.zeros(0, U64)
    for text, found in zip(held, spans(hashes, offsets, least - least // times), strict=True):
        runs = []
        for a, b in found:
            ids: dict[bytes, int] = {}
            w = array("i", [ids.setdefault(x, len(ids)) for x in text.words(a, b)])
            runs += [(a + s, n, p) for s, n, p in runs_of(w, least, times)]
        yield len(text.hashes), runs, text.without(_after_first(runs))


def periodic_runs(docs: DataFrame, least: int = 24, times: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, n_words, runs, collapsed``: one row for each input row.

    ``runs`` holds (start, length, period) of every run, by start, then period, counted in
    words from 0; ``collapsed`` is the text's words, joined by one space, without those
    that any run contains after its first period.
    """
    if times < 2 or least < times:
        raise ValueError("times must be 2 at least, and least no less than times")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, 1, 2 << 20):
            got = list(_of_batch([t or b"" for t in batch.column(1).cast(pa.binary()).to_pylist()], least, times))
            runs = [[{"start": s, "length": n, "period": p} for s, n, p in r] for _, r, _ in got]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([n for n, _, _ in got], pa.int64()), pa.array(runs, _RUNS), pa.array([c for _, _, c in got], pa.binary()).cast(pa.string())],
                ["id", "n_words", "runs", "collapsed"],
            )

    source = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    return source.mapInArrow(run, "id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string")
