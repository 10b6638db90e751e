"""SentencePiece encoding and decoding by a streaming Viterbi.

The best segmentation maximises the sum of the vocabulary's piece scores; a code
point that no piece covers costs the smallest score less 10 and becomes byte pieces
(or the unknown id).  Among equal scores the path whose last piece starts earliest
wins.

Text arrives in chunks.  Only the open window is kept: a boundary is final once
``longest`` characters (the maximum piece length) follow it, and where all surviving
backpointer paths meet in one boundary, the ids before it are committed and
forgotten.  ``Encoder`` runs the search in numpy over all texts of a run at once:

1. pieces are looked up level by level, the n-grams that continue no piece drop out;
2. a boundary that no piece found here spans is one where every path meets: it is
   committed whatever the scores, so stretches between such boundaries are lanes,
   and all lanes take their i-th boundary together;
3. a lane beyond ``LANE`` characters goes through ``StreamingViterbi``, which follows
   the backpointers of its window to the boundary where they meet.

A text beyond ``CHUNK`` characters goes in slices, with the part after its last
committed boundary carried over, so memory doesn't grow with the text.

Edge cases: null and empty texts have no ids and decode to the empty string; texts
decode to themselves except for what the model's own normaliser changes and U+2581,
which is the white-space mark; rows with null ids and repeated rows are encoded
like any other; other columns are not read, whatever their names; an empty table gives no rows.
"""

from __future__ import annotations

import itertools
import re
import zlib
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sondeframe.llm.common import by_bytes

MARK = "▁"
UNKNOWN_PENALTY = 10.0
#: Characters of a lane, and of the runs that are searched at once.
LANE = 64
CHUNK = 1 << 16
_BETWEEN = 0xFFFFFFFF  # no code point
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_SLICE_END = re.compile("[A-Za-z] (?=[A-Za-z])")
_NONE = float("-inf")


class Vocabulary:
    """Pieces and scores of a model file, as plain tables."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        self.processor = sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self.pieces = [sp.id_to_piece(i) for i in range(sp.get_piece_size())]
        self.scores = [sp.get_score(i) for i in range(len(self.pieces))]
        self.unknown = sp.unk_id()
        self.byte_ids = {int(self.pieces[i][3:-1], 16): i for i in range(len(self.pieces)) if sp.is_byte(i)}
        normal = [i for i in range(len(self.pieces)) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
        #: every prefix of a piece -> (id, score) or None
        self.prefixes: dict[str, tuple[int, float] | None] = {}
        for i in normal:
            p = self.pieces[i]
            for n in range(1, len(p)):
                self.prefixes.setdefault(p[:n], None)
            self.prefixes[p] = (i, self.scores[i])
        self.longest = max(len(self.pieces[i]) for i in normal)
        self.unknown_score = min(self.scores[i] for i in normal) - UNKNOWN_PENALTY
        self._build()
        self.text_of = [MARK.join(self.pieces[i].split(MARK)).replace(MARK, " ") if not sp.is_control(i) else "" for i in range(len(self.pieces))]
        self.byte_of = {i: b for b, i in self.byte_ids.items() if b >= 0x80}
        self.text_of = [chr(int(p[3:-1], 16)) if sp.is_byte(i) else t for i, (p, t) in enumerate(zip(self.pieces, self.text_of, strict=True))]
        self.high = np.zeros(len(self.pieces), bool)
        self.high[list(self.byte_of)] = True

    def _build(self) -> None:
        """A hash table of all prefixes: key, piece id (-1 where it is no piece) and score, probed in line."""
        keys = np.array([self.key(p) for p in self.prefixes], np.uint64)
        if len(np.unique(keys)) != len(keys):
            raise ValueError("two prefixes share a key")
        self.bits = max(10, int(len(keys) * 4 - 1).bit_length())
        self.keys = np.zeros((1 << self.bits) + 64, np.uint64)
        self.table_id = np.full(len(self.keys), -1, np.int32)
        self.table_score = np.zeros(len(self.keys))
        self.depth = 1
        for key, found in zip(keys.tolist(), self.prefixes.values(), strict=True):
            at = home = (key * int(_MULTIPLIER) & 0xFFFFFFFFFFFFFFFF) >> (64 - self.bits)
            while self.keys[at]:
                at += 1
            self.keys[at], self.depth = key, max(self.depth, at - home + 1)
            if found is not None:
                self.table_id[at], self.table_score[at] = found

    @staticmethod
    def key(text: str) -> int:
        """A polynomial of the code points, never 0."""
        h = 0
        for c in text:
            h = (h * 0x100000001B3 + ord(c) + 1) & 0xFFFFFFFFFFFFFFFF
        return h or 1

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Slots of the keys in the table, or -1."""
        at = ((keys * _MULTIPLIER) >> np.uint64(64 - self.bits)).astype(np.int64)
        out = np.where(self.keys[at] == keys, at, -1)
        open_ = np.flatnonzero((out < 0) & (self.keys[at] != 0))
        for step in range(1, self.depth):
            there = self.keys[at[open_] + step]
            out[open_[there == keys[open_]]] = at[open_[there == keys[open_]]] + step
            open_ = open_[(there != keys[open_]) & (there != 0)]
        return out

    def unknown_ids(self, char: str) -> list[int]:
        return [self.byte_ids[b] for b in char.encode()] if len(self.byte_ids) == 256 else [self.unknown]


class StreamingViterbi:
    """Feed chunks, get committed ids; ``finish`` commits the rest."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.v = vocabulary
        self.text = ""  # from the first open boundary on, up to the input's end
        self.at = 0  # boundaries 0..at of the window are final
        self.score = [0.0]
        self.back: list[tuple[int, int]] = [(-1, -1)]  # (start, id or -1 for unknown)

    def _relax(self, upto: int) -> None:
        """Extend from every boundary before ``upto``; boundary i + 1 is then final once i is done."""
        text, score, back = self.text, self.score, self.back
        get, low, longest, n = self.v.prefixes.get, self.v.unknown_score, self.v.longest, len(self.text)
        more = n + 1 - len(score)
        score += [_NONE] * more
        back += [(-1, -1)] * more
        for start in range(self.at, upto):
            base, alone = score[start], False
            for end in range(start + 1, min(start + longest, n) + 1):
                found = get(text[start:end], False)
                if found is False:
                    break
                if found is not None:
                    if end == start + 1:
                        alone = True
                    value = base + found[1]
                    if value > score[end]:
                        score[end], back[end] = value, (start, found[0])
            if not alone and base + low > score[start + 1]:
                score[start + 1], back[start + 1] = base + low, (start, -1)
        self.at = max(self.at, upto)

    def _path(self, end: int) -> list[int]:
        ids: list[int] = []
        while end > 0:
            start, piece = self.back[end]
            if piece < 0:
                ids += reversed(self.v.unknown_ids(self.text[start:end]))
            else:
                ids.append(piece)
            end = start
        ids.reverse()
        return ids

    def _converged(self) -> int:
        """The last boundary that the best paths of all alive boundaries share."""
        alive = {i for i in range(self.at, len(self.score)) if self.score[i] > _NONE}
        while len(alive) > 1:
            last = max(alive)
            alive.remove(last)
            alive.add(self.back[last][0])
        return alive.pop()

    def feed(self, chunk: str) -> list[int]:
        self.text += chunk
        out: list[int] = []
        step = 4 * self.v.longest
        while len(self.text) - self.at > self.v.longest:  # a boundary is final when every piece up to it is seen
            self._relax(min(self.at + step, len(self.text) - self.v.longest))
            cut = self._converged()
            if cut > 0:
                out += self._path(cut)
                self.text = self.text[cut:]
                self.at -= cut
                self.score = [s - self.score[cut] for s in self.score[cut:]]
                self.back = [(-1, -1), *((a - cut, p) for a, p in self.back[cut + 1 :])]
        return out

    def finish(self) -> list[int]:
        self._relax(len(self.text))
        out = self._path(len(self.text))
        self.text, self.at, self.score, self.back = "", 0, [0.0], [(-1, -1)]
        return out


class Encoder:
    """Encodes many texts at once; holds no state but the vocabulary."""

    def __init__(self, path: str, chunk: int = CHUNK) -> None:
        self.v, self.chunk = Vocabulary(path), chunk

    def _pieces(self, cps: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """For each length n from 1: starts, ids (-1: unknown character) and scores of the pieces in ``cps``, where ``_BETWEEN`` stands between texts."""
        v, out = self.v, []
        alive = np.flatnonzero(cps != _BETWEEN)
        keys = np.zeros(len(alive), np.uint64)
        for n in range(1, v.longest + 1):
            inside = alive + n <= len(cps)
            alive, keys = alive[inside], keys[inside]
            cp = cps[alive + (n - 1)].astype(np.uint64)
            text = cp != _BETWEEN
            keys = keys * np.uint64(0x100000001B3) + cp + np.uint64(1)
            slot = np.where(text, v.find(np.maximum(keys, np.uint64(1))), -1)
            ids = np.where(slot >= 0, v.table_id[slot], -1)
            there = ids >= 0
            if n == 1:
                out.append((alive, ids, np.where(there, v.table_score[slot], v.unknown_score)))
            else:
                out.append((alive[there], ids[there], v.table_score[slot[there]]))
            on = slot >= 0
            alive, keys = alive[on], keys[on]
            if not len(alive):
                break
        return out

    def _solve(self, cps: np.ndarray, last: bool) -> tuple[np.ndarray, np.ndarray, int]:
        """``(ids, ends, cut)``: ids committed, the boundary that each ends at, and the last committed boundary.

        Unless ``last``, boundaries within a piece's length of the end are not final.
        """
        n, v = len(cps), self.v
        found = self._pieces(cps)
        reach = np.arange(1, n + 1)
        for length, (start, _, _) in enumerate(found, 1):
            reach[start] = start + length
        met = np.flatnonzero(np.maximum.accumulate(reach) == np.arange(1, n + 1)) + 1  # no piece spans these
        if not last:
            met = met[met <= n - v.longest]
        if not len(met):
            return np.zeros(0, np.uint32), np.zeros(0, np.int64), 0
        cut = int(met[-1])
        lane_start = np.concatenate(([0], met[:-1]))
        width = met - lane_start
        first = np.repeat(lane_start, width)  # of each character before the cut
        short = np.repeat(width <= LANE, width)
        best, back, piece = np.full(cut + 1, _NONE), np.full(cut + 1, -1, np.int64), np.full(cut + 1, -1, np.int32)
        best[lane_start] = 0.0
        groups = []
        for length, (start, ids, score) in enumerate(found, 1):
            use = start < cut
            use[use] = short[start[use]]
            start, ids, score = start[use], ids[use], score[use]
            place = (start + length - first[start]).astype(np.uint16)
            order = np.argsort(place, kind="stable")
            groups.append((length, start[order], ids[order], score[order], np.searchsorted(place[order], np.arange(LANE + 2))))
        # A lane's end is the next one's start, so its best is kept apart.
        value = best.copy()
        value[lane_start] = _NONE
        for i in range(1, min(LANE, int(width.max())) + 1):
            for length, start, ids, score, at in reversed(groups):  # the earliest start first
                a, b = at[i], at[i + 1]
                if length > i or a == b:
                    continue
                s = start[a:b]
                base = value[s] if length < i else 0.0  # a lane's start costs nothing
                total = base + score[a:b]
                better = total > value[s + length]
                s, total = s[better], total[better]
                value[s + length], back[s + length], piece[s + length] = total, s, ids[a:b][better]
        counts = np.zeros(cut + 1, np.int64)
        here, floor = met[width <= LANE], lane_start[width <= LANE]
        while len(here):
            counts[here] = 1
            here = back[here]
            on = here > floor
            here, floor = here[on], floor[on]
        own: dict[int, list[int]] = {}
        for end in np.flatnonzero((counts > 0) & (piece < 0)).tolist():
            own[end] = v.unknown_ids(chr(cps[end - 1])) if cps[end - 1] != _BETWEEN else []
        for a, b in zip(lane_start[width > LANE].tolist(), met[width > LANE].tolist(), strict=True):
            stream = StreamingViterbi(v)
            own[b] = stream.feed("".join(map(chr, cps[a:b].tolist()))) + stream.finish()
        for end, ids in own.items():
            counts[end] = len(ids)
        ends = np.repeat(np.arange(cut + 1), counts)
        ids = piece[ends].astype(np.uint32)
        if own:
            stops = np.cumsum(counts)
            for end, some in own.items():
                ids[stops[end] - counts[end] : stops[end]] = some
        return ids, ends, cut

    def _long(self, text: str) -> bytes:
        """A text in slices of about ``chunk`` characters; what follows the last committed boundary is carried over."""
        out, at, held = [], 0, np.zeros(0, np.uint32)
        while at < len(text):
            found = _SLICE_END.search(text, at + self.chunk)
            upto = found.end() if found else len(text)
            # The space before the next slice is the mark that the normaliser puts before it.
            part = text[at:upto] if upto == len(text) else text[at : upto - 1]
            cps = np.concatenate((held, np.frombuffer(self.v.processor.normalize(part).encode("utf-32-le"), np.uint32)))
            ids, _, cut = self._solve(cps, upto == len(text))
            out.append(ids.tobytes())
            held, at = cps[cut:], upto
        return b"".join(out)

    def _run(self, texts: list[str]) -> Iterator[bytes]:
        normal = [np.frombuffer(self.v.processor.normalize(t).encode("utf-32-le"), np.uint32) for t in texts]
        gap = np.array([_BETWEEN], np.uint32)
        cps = np.concatenate([x for t in normal for x in (t, gap)])
        ids, ends, _ = self._solve(cps, True)
        at = 0
        stops = np.searchsorted(ends, np.cumsum([len(t) + 1 for t in normal]), side="right").tolist()
        for stop in stops:
            yield ids[at:stop].tobytes()
            at = stop

    def encode(self, texts: Iterable[str | None]) -> Iterator[bytes]:
        """Unsigned 32-bit ids of each text."""
        run: list[str] = []
        size = 0
        for text in texts:
            if text and len(text) > 2 * self.chunk:
                if run:
                    yield from self._run(run)
                run, size = [], 0
                yield self._long(text)
                continue
            run.append(text or "")
            size += len(run[-1])
            if size > self.chunk:
                yield from self._run(run)
                run, size = [], 0
        if run:
            yield from self._run(run)

    def decode(self, ids: bytes) -> str:
        # An ASCII byte piece is a character of its own; only runs of other bytes are put together.
        numbers = np.frombuffer(ids, np.uint32)
        text_of, high = self.v.text_of, self.v.high
        if high[numbers].any():
            byte = self.v.byte_of
            runs = itertools.groupby(numbers.tolist(), byte.__contains__)
            text = "".join(bytes(map(byte.__getitem__, run)).decode("utf-8", "replace") if raw else "".join(map(text_of.__getitem__, run)) for raw, run in runs)
        else:
            text = "".join(map(text_of.__getitem__, numbers.tolist()))
        return text[1:] if text.startswith(" ") else text  # the mark put before every text


_encoders: dict[str, Encoder] = {}


def encoded(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = True) -> DataFrame:
    """``(doc_id, n_tokens, ids_crc32, n_chars_decoded, round_trip, ids)`` for each row; ``ids`` as bytes when asked for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if model not in _encoders:
            _encoders[model] = Encoder(model)
        e = _encoders[model]
        for part in by_bytes(batches, 1, 1 << 20):
            texts = part.column(1).to_pylist()
            ids = list(e.encode(texts))
            decoded = [e.decode(x) for x in ids]
            columns = [
                part.column(0), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array([zlib.crc32(x) for x in ids], pa.int64()),
                pa.array([len(x) for x in decoded], pa.int64()), pa.array([a == (b or "") for a, b in zip(decoded, texts, strict=True)]),
            ]
            names = ["doc_id", "n_tokens", "ids_crc32", "n_chars_decoded", "round_trip"]
            yield pa.RecordBatch.from_arrays(columns + ([pa.array(ids, pa.binary())] if with_ids else []), names + (["ids"] if with_ids else []))

    source = docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string"))
    schema = "doc_id long, n_tokens long, ids_crc32 long, n_chars_decoded long, round_trip boolean"
    return source.mapInArrow(run, schema + (", ids binary" if with_ids else ""))
