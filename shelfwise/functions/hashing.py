"""Repeatable pseudo-random draws: pure functions of a key and a salt."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def salted_md5(key: Column, salt: str) -> Column:
    return F.md5(F.concat(F.lit(f"{salt}|"), key.cast("string")))


def hash_int(key: Column, salt: str = "") -> Column:
    """32-bit unsigned draw as bigint."""
    digest = F.md5(key.cast("string")) if salt == "" else salted_md5(key, salt)
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")


def hash_pick(key: Column, n: int, salt: str = "") -> Column:
    """Draw from 0..n-1."""
    return F.pmod(hash_int(key, salt), F.lit(n).cast("bigint"))


def hash_unit(key: Column, salt: str = "") -> Column:
    """Draw from [0, 1) on a grid of 1e-6, so that both engines agree exactly."""
    return hash_pick(key, 1_000_000, salt) / F.lit(1_000_000.0)


def catalogue_key(product_id: Column) -> Column:
    """Whole number that orders products: the id itself, or a hash of one that is no number."""
    return F.coalesce(product_id.try_cast("bigint"), F.pmod(F.xxhash64(product_id), F.lit(1 << 62)))
