"""Seeded pseudo-random values that do not depend on partitioning.

The text ``seed:id`` is hashed with md5, so a row draws the same value on any cluster, after any
retry, and in any engine that has md5.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_TWO_32 = 4294967296.0


def hash_key(seed: int | str, *parts: Column | str) -> Column:
    """Hex md5 of ``seed:part:part...``."""
    texts = [(F.col(p) if isinstance(p, str) else p).cast("string") for p in parts]
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *texts))


def hash_int(key: Column) -> Column:
    """First 8 hex digits of a hash key as a bigint in [0, 2^32)."""
    return F.conv(F.substring(key, 1, 8), 16, 10).cast("bigint")


def hash_unit(key: Column) -> Column:
    """First 8 hex digits of a hash key as a double in [0, 1)."""
    return hash_int(key) / F.lit(_TWO_32)
