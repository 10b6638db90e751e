import numpy as np
import pyarrow as pa

from sondeframe.llm import toxicity


def test_rows_of_long_texts_take_bounded_memory():
    rng = np.random.default_rng(4)
    letters = np.frombuffer(b"abcdefghijklmnopqrstuvwxyz     ", np.uint8)
    texts = [letters[rng.integers(0, len(letters), n)].tobytes().decode() for n in (300_000, 40, 5_000, 200_000, 0)]
    size = len(toxicity.GRAMS) << toxicity.BITS
    rows = toxicity._Rows(pa.array([t]) for t in texts)
    assert max(x.nbytes for x in rows.index) <= size // 8
    found = [np.concatenate(next(toxicity.features(pa.array([t])))) for t in texts]
    there = np.stack([np.bincount(x, minlength=size) for x in found])
    assert there.max() == 1 and there[0].sum() > toxicity.DENSE
    values, of_row = rng.normal(size=size), rng.normal(size=len(texts))
    np.testing.assert_allclose(rows.sums(np.arange(len(texts)), values), there @ values, atol=1e-8)
    np.testing.assert_allclose(rows.gathered(of_row, size), of_row @ there, atol=1e-12)
