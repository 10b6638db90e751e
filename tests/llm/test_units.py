import random
import re
import time
from array import array

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sondeframe.llm.tokens import UnitEncoder, public_path, unit_starts

LOW, UP, ENDINGS = "a-z\xdf-\xf6\xf8-\xff", "A-Z\xc0-\xd6\xd8-\xde", "'(?:s|t|re|ve|m|ll|d)"
CUTS = {
    "byte": f"{ENDINGS}| ?[{LOW}{UP}]+| ?[0-9]+| ?[^\\s0-9{LOW}{UP}]+|\\s+(?!\\S)|\\s+",
    "word": f"{ENDINGS}|[{LOW}]+|[0-9]|[^\\s0-9{LOW}]+|\\s+",
}


class _Counting:
    def __init__(self, tokenizer):
        self.tokenizer, self.texts = tokenizer, 0

    def encode_batch_fast(self, texts, **kw):
        self.texts += len(texts)
        return self.tokenizer.encode_batch_fast(texts, **kw)

    def encode(self, text, **kw):
        return self.tokenizer.encode(text, **kw)


@pytest.mark.parametrize(("name", "kind"), [("byte_bpe_50k", "byte"), ("word_bpe_49k", "word")])
def test_rare_words_go_through_the_library_together(name, kind):
    rng = random.Random(3)
    letters = "abcdefghijklmnopqrstuvwxyzABCDEÉéñöüßÿ"
    word = lambda: "".join(rng.choice(letters) for _ in range(rng.randint(1, 12)))
    marks = ["'s", "'", "''s", "!?", "12", "4a", "a<b", "< |", "x_y", "``", "\xa1\xbf", "don't", "  ", "\n\n ", "\t7", " \r\n"]
    texts = ["".join(rng.choice((" ", " ", " ", "")) + (word() if rng.random() < 0.8 else rng.choice(marks)) for _ in range(400)) for _ in range(60)]
    encode = UnitEncoder(public_path(f"{name}.json"), kind)
    whole = [array("I", encode.tokenizer.encode(t, add_special_tokens=False).ids).tobytes() for t in texts]
    encode.tokenizer = _Counting(encode.tokenizer)
    assert list(encode.encode(texts)) == whole
    assert len(encode.young) > 5_000 and encode.tokenizer.texts < 0.05 * len(encode.young)


@pytest.mark.parametrize("kind", ["byte", "word"])
@settings(max_examples=400, deadline=None)
@given(texts=st.lists(st.text(st.sampled_from(list("''  \n\tstrevmldabS1.<|éß¿")), max_size=25), min_size=1, max_size=4))
def test_cuts_of_many_texts_are_those_of_the_patterns(kind, texts):
    texts = [t.lower() if kind == "word" else t for t in texts]
    data = "".join(t + "\x1c" for t in texts).encode("latin-1")
    starts = [*unit_starts(np.frombuffer(data, np.uint8), kind).tolist(), len(data)]
    got = [data[i:j].decode("latin-1") for i, j in zip(starts, starts[1:], strict=False)]
    assert got == [u for t in texts for u in [*re.findall(CUTS[kind], t), "\x1c"]]


@pytest.mark.parametrize(("name", "kind"), [("byte_bpe_50k", "byte"), ("word_bpe_49k", "word")])
def test_known_units_cost_less_than_cutting_by_pattern(name, kind):
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdefghijklmnopqrst") for _ in range(rng.randint(2, 8))) for _ in range(3_000)]
    texts = [" ".join(rng.choices(words, k=1_000)) for _ in range(300)]
    encode = UnitEncoder(public_path(f"{name}.json"), kind)
    cut = re.compile(CUTS[kind]).findall

    def seconds(f):
        at = time.process_time()
        f()
        return time.process_time() - at

    list(encode.encode(texts))
    assert min(seconds(lambda: list(encode.encode(texts))) for _ in range(3)) < 0.8 * min(seconds(lambda: [cut(t) for t in texts]) for _ in range(3))
