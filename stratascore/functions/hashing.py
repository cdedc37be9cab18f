"""Repeatable randomness: every draw is a hash of the row key, so no result depends on partitioning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HASH_BITS = 32
HASH_RANGE = float(1 << HASH_BITS)


def hash_u32(key: Column | str, *salt: object) -> Column:
    """First 32 bits of ``md5(key:salt:...)`` as a bigint; same value in any SQL engine with md5."""
    key = F.col(key) if isinstance(key, str) else key
    parts = [key.cast("string")]
    for s in salt:
        parts += [F.lit(":"), s.cast("string") if isinstance(s, Column) else F.lit(str(s))]
    return F.conv(F.substring(F.md5(F.concat(*parts).cast("binary")), 1, 8), 16, 10).cast("bigint")


def uniform(key: Column | str, *salt: object) -> Column:
    """A number in [0, 1) from the same hash."""
    return hash_u32(key, *salt) / F.lit(HASH_RANGE)
