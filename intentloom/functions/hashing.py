"""Seeded draws: every random choice is a function of (seed, row id), so reruns agree."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SEED = 42


def row_hash(*cols: str | Column, seed: int | str = SEED) -> Column:
    """Hex digest of ``seed|col|col...``; sorting by it is a seeded shuffle of the rows."""
    parts = [(F.col(c) if isinstance(c, str) else c).cast("string") for c in cols]
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *parts))


def hash_int(digest: Column) -> Column:
    """First 60 bits of a hex digest as a non-negative long."""
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def hash_unit(digest: Column) -> Column:
    """Uniform double in [0, 1) from a hex digest (52 bits, exact in a double)."""
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(2**52))
