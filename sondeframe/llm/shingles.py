"""Vectorised word-shingle hashing over Arrow string batches.

Words are maximal runs of bytes outside ``[\\x20\\x09-\\x0D]`` after A-Z are
lower-cased (ASCII only; other code points keep their bytes).  All hashes are
64-bit and depend only on the bytes, never on the batch, so the same words hash
alike on every executor.

Edge cases: a null text counts as empty; a document with fewer than ``k`` words
has the whole word sequence as its one shingle; without words it has none.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

U64 = np.uint64
_SEED_RNG = np.random.default_rng(20240607)
_BYTE_VALUE = _SEED_RNG.integers(1, 2**63, 256, dtype=np.int64).astype(U64)
_BASE = U64(0x9E3779B97F4A7C13)  # odd, 3 mod 4
_BASE_INV = U64(pow(int(_BASE), -1, 2**64))
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
#: Text is hashed in pieces of about this many bytes, so that the scratch
#: arrays stay small whatever the Arrow batch holds.
CHUNK_BYTES = 1 << 19
_powers: dict[str, np.ndarray] = {}  # at most 16 bytes for each of 2 * CHUNK_BYTES


def mix64(x: np.ndarray) -> np.ndarray:
    """splitmix64 finaliser, elementwise."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and its inverse; those beyond the kept bound (a giant word) are made anew."""
    if len(_powers.get("p", ())) >= n:
        return _powers["p"][:n], _powers["i"][:n]
    made = {}
    for name, base in (("p", _BASE), ("i", _BASE_INV)):
        steps = np.full(n, base, dtype=U64)
        steps[0] = 1
        made[name] = np.multiply.accumulate(steps)
    if n <= 2 * CHUNK_BYTES:
        _powers.update(made)
    return made["p"], made["i"]


def text_chunks(texts: pa.Array, limit: int = CHUNK_BYTES):
    """(first row, byte array, row offsets) pieces of a string array.

    One text longer than ``limit`` makes a piece of its own.
    """
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null("")
    wide = texts.type in (pa.large_string(), pa.large_utf8())
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64 if wide else np.int32)[
        texts.offset : texts.offset + len(texts) + 1
    ].astype(np.int64)
    data = texts.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    row = 0
    while row < len(texts):
        end = int(np.searchsorted(offsets, offsets[row] + limit, side="right")) - 1
        end = min(len(texts), max(end, row + 1))
        yield row, data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
        row = end


def _long_word_hashes(data: np.ndarray) -> np.ndarray:
    """Word hashes of one long text, taken in slices that end at white space (or after a giant word)."""
    parts, at = [], 0
    while at < len(data):
        end = min(len(data), at + CHUNK_BYTES)
        if end < len(data):
            gaps = np.flatnonzero(_SPACE[data[at:end]])[-1:]
            while not len(gaps) and end < len(data):  # a giant word: up to the first white space after it
                step = data[end : end + CHUNK_BYTES]
                gaps = np.flatnonzero(_SPACE[step])[:1] + (end - at)
                end += len(step)
            end = at + int(gaps[0]) + 1 if len(gaps) else len(data)
        parts.append(word_hashes(data[at:end], np.array([0, end - at]))[0])
        at = end
    return np.concatenate(parts)


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word of a piece, and the word offsets of its rows."""
    n = len(data)
    rows = len(offsets) - 1
    if rows == 1 and n > CHUNK_BYTES and _SPACE[data[: n - 1]].any():
        found = _long_word_hashes(data)
        return found, np.array([0, len(found)])
    if n == 0:
        return np.zeros(0, U64), np.zeros(rows + 1, np.int64)
    low = _LOWER[data]
    word = ~_SPACE[low]
    first = np.zeros(n + 1, dtype=bool)
    first[0] = True
    first[offsets[:-1]] = True  # an offset may equal n: empty rows at the end
    first = first[:n]
    before = np.empty(n, dtype=bool)
    before[0] = False
    before[1:] = word[:-1]
    starts = np.flatnonzero(word & (first | ~before))
    last = np.zeros(n, dtype=bool)
    last[-1] = True
    last[:-1] = first[1:]
    after = np.zeros(n, dtype=bool)
    after[:-1] = word[1:]
    ends = np.flatnonzero(word & (last | ~after)) + 1
    power, inverse = _power(n + 1)
    sums = np.zeros(n + 1, dtype=U64)
    np.cumsum(_BYTE_VALUE[low] * power[:n], out=sums[1:])
    hashes = (sums[ends] - sums[starts]) * inverse[starts]
    hashes = mix64(hashes + (ends - starts).astype(U64) * U64(0xD6E8FEB86659FD93))
    return hashes, np.searchsorted(starts, offsets).astype(np.int64)


def shingle_hashes(words: np.ndarray, offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes (repeats kept) in row order, and the row offsets."""
    counts = np.diff(offsets)
    made = np.where(counts >= k, counts - k + 1, np.minimum(counts, 1))
    out_offsets = np.concatenate(([0], np.cumsum(made)))
    row_of = np.repeat(np.arange(len(counts)), made)
    at = np.arange(out_offsets[-1]) - out_offsets[row_of] + offsets[row_of]
    size = np.minimum(counts, k)[row_of]
    total = np.zeros(len(at), dtype=U64)
    for j in range(k):
        there = j < size
        part = np.zeros(len(at), dtype=U64)
        part[there] = words[at[there] + j]
        total = mix64(total * U64(0x2545F4914F6CDD1D) + part + there.astype(U64))
    return total, out_offsets


def distinct_sets(texts: pa.Array, k: int):
    """For each piece: first row, concatenated sorted distinct shingle hashes, row offsets."""
    for row, data, offsets in text_chunks(texts):
        words, word_offsets = word_hashes(data, offsets)
        if len(words) > CHUNK_BYTES and len(offsets) == 2:  # one long text: shingles in runs that overlap by k - 1 words
            cuts = range(0, len(words) - k + 1, CHUNK_BYTES)
            runs = [words[c : c + CHUNK_BYTES + k - 1] for c in cuts]
            one = np.unique(np.concatenate([np.unique(shingle_hashes(r, np.array([0, len(r)]), k)[0]) for r in runs]))
            yield row, one, np.array([0, len(one)])
            continue
        hashes, at = shingle_hashes(words, word_offsets, k)
        if len(hashes) == 0:
            yield row, hashes, at
            continue
        # One sort a row; a row is at most one text, so this is cache friendly.
        sets = [np.unique(hashes[at[i] : at[i + 1]]) for i in range(len(at) - 1)]
        yield row, np.concatenate(sets), np.concatenate(([0], np.cumsum([len(s) for s in sets])))
