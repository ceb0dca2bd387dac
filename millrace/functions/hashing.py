"""Portable md5-based hashing for splits, samples, ids and feature hashing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HASH_SPAN = 1 << 32


def hash32(*cols, seed=None) -> Column:
    """Unsigned 32-bit hash of the columns as text; stable under repartitioning."""
    parts = [(F.col(c) if isinstance(c, str) else c).cast("string") for c in cols]
    if seed is not None:
        parts.append(F.lit(str(seed)))
    text = parts[0] if len(parts) == 1 else F.concat_ws("|", *parts)
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")


def hash_below(fraction: float, *cols, seed=None) -> Column:
    """True for a key-determined share ``fraction`` of the rows."""
    return hash32(*cols, seed=seed) < int(fraction * HASH_SPAN)
