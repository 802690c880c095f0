"""Numeric column helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def grid_round(c: Column | str, bits: int = 20) -> Column:
    """Round to the nearest multiple of ``2**-bits`` (about 1e-6 for 20 bits).

    Scaling by a power of two is exact in binary floating point, and values
    built from decimal constants never sit exactly on a binary midpoint, so
    two engines whose raw sums differ in the last bits still agree.
    """
    c = F.col(c) if isinstance(c, str) else c
    scale = float(2 ** bits)
    return F.round(c * F.lit(scale), 0) / F.lit(scale)
