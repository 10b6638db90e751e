"""Hash sampling: a function of (seed, id), never of row order."""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from sondeframe import config as C


def unit_hash(sample_id: Column, seed: int = C.SEED) -> Column:
    """Portable mode: the first 13 hex digits of SHA-256 of ``seed:id``, over 2^52."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), sample_id.cast("string")), 256)
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / float(2**52)


def unit_hash_exact(seed: int = C.SEED):
    """Exact mode: BLAKE2b-64 of ``seed:id``, over 2^64, as a pandas UDF (Spark has no such builtin)."""

    @F.pandas_udf("double")
    def run(ids: pd.Series) -> pd.Series:
        return ids.map(lambda x: int.from_bytes(hashlib.blake2b(f"{seed}:{x}".encode(), digest_size=8).digest(), "big") / 2**64)

    return run


def keep(sample_id: Column, p: Column, seed: int = C.SEED) -> Column:
    return F.when(p >= 1, True).when(p <= 0, False).otherwise(unit_hash(sample_id, seed) < p)


def keep_by_class(sample_id: Column, cls: Column, probs: dict[int, float] = C.KEEP_PROB, seed: int = C.SEED) -> Column:
    """Class-stratified decision; a class without a probability, or no class, is dropped."""
    p = F.lit(0.0)
    for k, v in probs.items():
        p = F.when(cls == k, v).otherwise(p)
    return keep(sample_id, p, seed)
