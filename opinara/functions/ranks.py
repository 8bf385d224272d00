"""A pseudo-random rank per key, equal on every engine and under any partitioning."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

RANK_BITS = 60
RANK_SPAN = 1 << RANK_BITS


def hash_rank(key: str | Column, seed: int | str) -> Column:
    """First 60 bits of ``md5(seed:key)`` as a BIGINT: uniform whatever the keys look like."""
    key = F.col(key) if isinstance(key, str) else key
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), key.cast("string")))
    return F.conv(F.substring(digest, 1, RANK_BITS // 4), 16, 10).cast("bigint")


def below_fraction(rank: Column, fraction: float) -> Column:
    return rank < F.lit(int(fraction * RANK_SPAN)).cast("bigint")
