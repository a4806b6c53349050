"""Seeded, engine-independent randomness from md5."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def seeded_md5(key: Column, seed: int | str) -> Column:
    return F.md5(F.concat(key.cast("string"), F.lit(f"|{seed}")).cast("binary"))


def hex_uniform(digest: Column) -> Column:
    """First 32 bits of a hex digest as a number in [0, 1)."""
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") / F.lit(4294967296.0)
