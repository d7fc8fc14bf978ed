"""Deterministic pseudo-random numbers that any SQL engine can repeat."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def digest(key: Column, stream: Column) -> Column:
    """MD5 of ``stream:key`` in hexadecimal: a random order of the keys, another one in every stream."""
    text = F.concat_ws(":", stream.cast("bigint").cast("string"), key.cast("bigint").cast("string"))
    return F.md5(text.cast("binary"))


def draw(key: Column, stream: Column, n: int) -> Column:
    """Uniform number in ``[0, n)`` from the first 60 bits of an MD5 digest.

    Draws with replacement need real collisions; a congruential sequence has too few.
    """
    return F.conv(F.substring(digest(key, stream), 1, 15), 16, 10).cast("bigint") % F.lit(n)
