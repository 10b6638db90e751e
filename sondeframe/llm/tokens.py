"""Whole-text token ids from the ``tokenizers`` library, each distinct unit encoded once.

A unit is a stretch of text at whose ends the tokenizer's own pre-tokenizer always
cuts, so a text's ids are its units' ids in order:

* ``byte``: byte-level BPE.  Texts of ASCII and Latin-1 letters are cut just as the
  byte-level pattern cuts them; others into one optional white-space character with
  what follows up to white space, or a run of white space.
* ``word``: lower-casing pre-tokenizers that drop white space and cut words, single
  digits and the rest; texts beyond Latin-1 are cut at white space only.
* ``none``: any other tokenizer; a text is one unit.

Simple texts (the first kind) are cut many at a time: a run of them is one array of
Latin-1 bytes, whose classes give the cuts; Arrow's dictionary tells equal units, so
Python sees a run's distinct units only, and ids are gathered as arrays.

Texts holding a special token's opening or an ASCII separator (on which engines
disagree about white space) are one unit too.  A very long text goes in slices cut
before a single space between two ASCII letters, where every kind cuts.

The table of known units keeps two bounded generations, so words in use stay and
memory does not grow: a process with one encoder peaked at 342 MB, tokenizer and a run's
arrays included, on 104 million characters that filled it.
"""

from __future__ import annotations

import itertools
import json
import os
import re
from array import array
from collections.abc import Iterable

import numpy as np
import pyarrow as pa

_WS = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
_ODD = re.compile("[\\x1c-\\x1f]|<\\|")
_SIMPLE = re.compile("[\\t-\\r -~\xa1\xbf\xc0-\xd6\xd8-\xf6\xf8-\xff]*")
_LOW, _UP = "a-z\xdf-\xf6\xf8-\xff", "A-Z\xc0-\xd6\xd8-\xde"
_L, _N, _O, _S, _END = range(1, 6)
#: Class of a Latin-1 character in simple texts: letter, digit, other, white space, end of a text; 0 for the rest.
_CLASS = np.zeros(256, np.uint8)
for _c in range(256):
    if _SIMPLE.fullmatch(chr(_c)):
        _CLASS[_c] = _S if chr(_c).isspace() else _N if _c < 128 and chr(_c).isdigit() else _L if re.match(f"[{_LOW}{_UP}]", chr(_c)) else _O
#: Stands after each simple text of a run; no text that is cut holds it.
_STOP = "\x1c"
_CLASS[ord(_STOP)] = _END
_LOWER = bytes(ord(chr(_c).lower()) if len(chr(_c).lower()) == 1 and ord(chr(_c).lower()) < 256 else _c for _c in range(256))
#: kind -> cuts of texts that aren't simple
_CUTS = {
    "byte": re.compile(f"[{_WS}]?[^{_WS}]+|[{_WS}]+(?![^{_WS}])|[{_WS}]+").findall,
    "word": str.split,
    "none": lambda t: [t],
}
#: Units in each of the two generations.
MAX_UNITS = 400_000
#: Texts are cut into units in runs of about this many characters.
RUN_CHARS = 1 << 20
#: New units that go through the library in one text.
IN_ONE = 1024
_SLICE_END = re.compile("[A-Za-z](?= [A-Za-z])")


def unit_starts(data: np.ndarray, kind: str) -> np.ndarray:
    """Where the units of simple texts start, a stop after each text; stops and, for ``word``, white space are units of their own.

    ``byte`` cuts by ``'(?:s|t|re|ve|m|ll|d)| ?L+| ?N+| ?O+|\\s+(?!\\S)|\\s+`` and ``word``, on lower-case texts, by
    ``'(?:s|t|re|ve|m|ll|d)|L+|N|O+``.
    """
    c = _CLASS[data]
    cut = np.ones(len(c), bool)
    np.not_equal(c[1:], c[:-1], out=cut[1:])
    cut |= c == _END
    if kind == "word":
        cut |= c == _N
    else:
        # The last of a run of white space before a word: apart from the run, with the word if it is a space.
        last = (c[:-1] == _S) & (c[1:] < _S)
        cut[:-1] |= last
        cut[1:] &= ~(last & (data[:-1] == 32))
    # An ending counts where its apostrophe starts a unit; a letter after it starts the next one.
    at = np.flatnonzero((data == 39) & cut)
    x, y = data[at + 1], data[np.minimum(at + 2, len(data) - 1)]
    one = (x == ord("s")) | (x == ord("t")) | (x == ord("m")) | (x == ord("d"))
    two = ((x == ord("r")) | (x == ord("v"))) & (y == ord("e")) | (x == ord("l")) & (y == ord("l"))
    cut[at[one | two] + 1] = False
    cut[at[one] + 2] = True
    cut[at[two] + 3] = True
    return np.flatnonzero(cut)


class UnitEncoder:
    def __init__(self, path: str, kind: str, max_units: int = MAX_UNITS) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.kind, self.any = kind, _CUTS[kind]
        self.max_units, self.sliced = max_units, kind != "none"
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        # New units of simple texts go through the library many in one text; as they are cut (and lower-cased) already
        # and spelt in the byte-level alphabet here, a split at spaces takes the place of the tokenizer's own steps.
        self.split = self._splitting(kind)
        spell = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        self.spelt = {i: spell(chr(i))[0][0] for i in range(256)} | {10: " "}
        self.sizes = np.zeros(self.tokenizer.get_vocab_size(), np.int64)  # bytes that each id stands for
        for piece, i in self.tokenizer.get_vocab().items():
            self.sizes[i] = len(piece.removesuffix("</w>") if kind == "word" else piece)

    def _splitting(self, kind: str):
        """The same model behind a plain split at spaces; None for a tokenizer whose parts this module doesn't know."""
        from tokenizers import Tokenizer, pre_tokenizers

        parts = json.loads(self.tokenizer.to_str())
        norm, pre = parts["normalizer"] or {}, parts["pre_tokenizer"] or {}
        last = (pre.get("pretokenizers") or [pre])[-1]
        if last.get("type") != "ByteLevel" or last["add_prefix_space"]:
            return None
        if kind == "byte" and (norm or not last["use_regex"] or last is not pre):
            return None
        if kind == "word" and (last["use_regex"] or any(x["type"] not in ("NFC", "Replace", "Lowercase") for x in norm.get("normalizers", [norm]) if x)):
            return None
        if kind not in ("byte", "word"):
            return None
        out = Tokenizer(self.tokenizer.model)
        out.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        return out

    def _in_one(self, units: list[str]) -> bool:
        """Encode cut units as one text; False when the ids don't fall apart at the units' ends."""
        text = "\n".join(units)
        text = text.replace(" ", self.spelt[32]).replace("\n", " ") if text.isascii() else text.translate(self.spelt)
        ids = np.array(self.split.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)
        upto = np.cumsum(np.fromiter(map(len, text.split(" ")), np.int64, len(units)))
        ends = np.cumsum(self.sizes[ids])
        cuts = np.searchsorted(ends, upto) + 1
        if not len(ids) or cuts[-1] != len(ids) or (ends[cuts - 1] != upto).any():
            return False
        at, data = 0, ids.tobytes()
        for unit, end in zip(units, (4 * cuts).tolist(), strict=True):
            self.young[unit] = data[at:end]
            at = end
        return True

    def _learn(self, units: Iterable[str], simple: bool = False) -> None:
        """Take distinct units that aren't in the young table into it."""
        new = []
        for unit in units:
            ids = self.old.get(unit)
            if ids is None:
                new.append(unit)
            else:
                self.young[unit] = ids
        if simple and self.split is not None:
            rest, part = [], []
            for u in new:
                (part if not u[0].isspace() or u[0] == " " and u[1:2].strip() else rest).append(u)
            for at in range(0, len(part), IN_ONE):
                if not self._in_one(part[at : at + IN_ONE]):
                    rest += part[at : at + IN_ONE]
            new = rest
        for e, unit in zip(self.tokenizer.encode_batch_fast(new, add_special_tokens=False), new, strict=True):
            self.young[unit] = array("I", e.ids).tobytes()

    def _gathered(self, data: bytes) -> list[bytes]:
        """Ids of simple texts, given as Latin-1 with a stop after each."""
        if self.kind == "word":
            data = data.translate(_LOWER)
        chars = np.frombuffer(data, np.uint8)
        starts = unit_starts(chars, self.kind)
        ends = np.append(starts, len(chars)).astype(np.int32)
        cut = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(ends), pa.py_buffer(data)]).dictionary_encode()
        at = np.frombuffer(cut.dictionary.buffers()[1], np.int32)[: len(cut.dictionary) + 1].tolist()
        joined = cut.dictionary.buffers()[2].to_pybytes()[: at[-1]].decode("latin-1")
        units = [joined[i:j] for i, j in itertools.pairwise(at)]
        self.young[_STOP] = b""
        known = list(map(self.young.get, units))
        missing = [i for i, ids in enumerate(known) if ids is None]
        self._learn([units[i] for i in missing], True)
        for i in missing:
            known[i] = self.young[units[i]]
        ids = np.frombuffer(b"".join(known), np.uint32)
        n = np.fromiter(map(len, known), np.int64, len(known)) // 4
        which = cut.indices.to_numpy()
        first, count = (np.cumsum(n) - n)[which], n[which]
        upto = np.cumsum(count)
        out = ids[np.repeat(first - (upto - count), count) + np.arange(upto[-1])].tobytes()
        stops = 4 * upto[chars[starts] == ord(_STOP)]
        return [out[i:j] for i, j in itertools.pairwise([0, *stops.tolist()])]

    def _simple(self, texts: list[str]) -> bytes | None:
        """Texts as Latin-1, a stop after each; None unless all are simple."""
        if self.kind == "none":
            return None
        text = _STOP.join([*texts, ""])
        try:
            data = text.encode("latin-1")
        except UnicodeEncodeError:
            return None
        n = np.bincount(_CLASS[np.frombuffer(data, np.uint8)], minlength=_END + 1)
        return None if n[0] or n[_END] != len(texts) or "<|" in text else data

    def _run(self, texts: list[str]) -> list[bytes]:
        if not texts:
            return []
        data = self._simple(texts)
        if data is None:
            plain = [self.kind != "none" and _SIMPLE.fullmatch(t) is not None and "<|" not in t for t in texts]
            some = [t for t, p in zip(texts, plain, strict=True) if p]
            met = iter(self._gathered(self._simple(some)) if some else ())
            rest = iter(self._units([t for t, p in zip(texts, plain, strict=True) if not p]))
            out = [next(met if p else rest) for p in plain]
        else:
            out = self._gathered(data)
        if len(self.young) > self.max_units:
            self.old, self.young = self.young, {}
        return out

    def _units(self, texts: list[str]) -> list[bytes]:
        """Ids of texts that aren't simple."""
        odd = {i for i, t in enumerate(texts) if _ODD.search(t)}
        cut = [() if i in odd else self.any(t) for i, t in enumerate(texts)]
        self._learn(set(itertools.chain.from_iterable(cut)).difference(self.young))
        get = self.young.__getitem__
        out = [b"".join(map(get, u)) for u in cut]
        for i in odd:
            out[i] = array("I", self.tokenizer.encode(texts[i], add_special_tokens=False).ids).tobytes()
        return out

    def _long(self, text: str) -> bytes:
        """Ids of a very long text, slice by slice."""
        parts, at = [], 0
        while at < len(text):
            end = _SLICE_END.search(text, at + RUN_CHARS) if self.sliced else None
            upto = end.end() if end else len(text)
            parts += self._run([text[at:upto]])
            at = upto
        return b"".join(parts)

    def encode(self, texts: list[str | None]):
        """Ids of each text as native (little-endian) unsigned 32-bit integers; a null text has none."""
        run: list[str] = []
        size = 0
        for text in texts:
            if text and len(text) > 2 * RUN_CHARS:
                yield from self._run(run)
                run, size = [], 0
                yield self._long(text)
                continue
            run.append(text or "")
            size += len(run[-1])
            if size >= RUN_CHARS:
                yield from self._run(run)
                run, size = [], 0
        yield from self._run(run)


_encoders: dict[tuple, UnitEncoder] = {}


def encoder(path: str, kind: str) -> UnitEncoder:
    """One encoder for each file in a Python worker."""
    if (path, kind) not in _encoders:
        _encoders[path, kind] = UnitEncoder(path, kind)
    return _encoders[path, kind]


def public_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)
