"""SuperMinHash signatures (Ertl 2017), vectorised over the documents of a batch.

Element x has a random permutation pi_x of the m slots and uniform values
r_x(0..m-1).  Slot pi_x(j) may take the value j + r_x(j); the signature holds the
minimum per slot.  The slots an element touches are drawn without replacement, so
ranks are correlated and the estimate has a lower variance than plain MinHash.

Rounds run over j.  After round j every slot below j + 1 is final, so a document
whose largest slot is below j + 1 stops early: documents with many elements need
one round or two, and only short ones go further.  Values are held as integers,
``j << 32 | 32 random bits``.
"""

from __future__ import annotations

import numpy as np

from sondeframe.llm.shingles import U64, mix64

EMPTY = U64(0xFFFFFFFFFFFFFFFF)


def signatures(elements: np.ndarray, offsets: np.ndarray, m: int) -> np.ndarray:
    """(rows, m) uint64 signatures of distinct element hashes; rows without elements stay EMPTY."""
    rows = len(offsets) - 1
    best = np.full(rows * m, EMPTY, dtype=U64)
    counts = np.diff(offsets)
    row = np.repeat(np.arange(rows), counts)
    live, perm = elements, None
    for j in range(m):
        draw = mix64(live + U64((0x9E3779B97F4A7C15 * (j + 1)) % 2**64))
        k = j + (((draw >> U64(32)) * U64(m - j)) >> U64(32)).astype(np.int64)
        if perm is None:
            slot = k
        else:
            at = np.arange(len(live))
            slot = perm[at, k].astype(np.int64)
            perm[at, k] = perm[:, j]
            perm[:, j] = slot
        value = (draw & U64(0xFFFFFFFF)) | U64(j << 32)
        np.minimum.at(best, row * m + slot, value)
        top = best.reshape(rows, m).max(axis=1)
        again = (counts > 0) & (top >= U64((j + 1) << 32))
        stay = again[row]
        if not stay.any():
            break
        if perm is None:
            live, row, k = live[stay], row[stay], k[stay]
            perm = np.tile(np.arange(m, dtype=np.uint8 if m <= 256 else np.uint16), (len(live), 1))
            at = np.arange(len(live))
            perm[at, k] = 0
            perm[:, 0] = k
        elif not stay.all():
            live, row, perm = live[stay], row[stay], perm[stay]
    return best.reshape(rows, m)


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Estimated Jaccard similarity of two signatures."""
    return float((a == b).mean())


def band_hashes(sig: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """(documents, bands) int64: one hash for each run of ``rows`` slots, told apart by band."""
    out = np.empty((len(sig), bands), dtype=np.int64)
    for b in range(bands):
        h = np.full(len(sig), U64(b + 1), dtype=U64)
        for r in range(rows):
            h = mix64(h * U64(0x2545F4914F6CDD1D) + sig[:, b * rows + r])
        out[:, b] = h.view(np.int64)
    return out
