"""Seeded picks: uniform over a short list, yet the same on every rerun."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from gradeline.functions.dates import as_column


def pick(options: Sequence[str], index: Column) -> Column:
    """The option at a 0-based index."""
    return F.element_at(F.array(*[F.lit(o) for o in options]), index.cast("int") + 1)


def hashed_index(columns: Sequence[Column | str], seed: str, size: int) -> Column:
    """0-based index from Spark's own 64-bit hash of the columns and a seed."""
    hashed = F.xxhash64(*[as_column(c) for c in columns], F.lit(seed))
    return F.pmod(hashed, F.lit(size)).cast("int")


def digest_index(columns: Sequence[Column | str], size: int) -> Column:
    """0-based index from an MD5 digest, which other SQL engines reproduce."""
    text = F.concat_ws("|", *[as_column(c).cast("string") for c in columns])
    head = F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("long")
    return F.pmod(head, F.lit(size)).cast("int")
