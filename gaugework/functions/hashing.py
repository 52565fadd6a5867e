"""Repeatable pseudo-random order: the md5 of a unique key and a seed.

The order is the same under any partitioning and in any engine, so splits and permutations can be checked in SQL.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def hash_key(key: str | list[str], seed: int = 42) -> Column:
    """32 hex digits; rows are put in random order by sorting on them."""
    keys = [key] if isinstance(key, str) else key
    return F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in keys], F.lit(str(seed))))


def _leading_bits(digest: Column) -> Column:
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")


def hash_bucket(digest: Column, buckets: int) -> Column:
    """Bucket 0..buckets-1, increasing with the digest; equally filled whatever the data."""
    return F.floor(_leading_bits(digest) * F.lit(buckets) / F.lit(4294967296.0)).cast("int")


def hash_uniform(digest: Column) -> Column:
    """Uniform number in [0, 1)."""
    return _leading_bits(digest) / F.lit(4294967296.0)


def hash_integer(digest: Column) -> Column:
    """Integer of 60 bits."""
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")
