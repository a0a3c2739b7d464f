"""Rounding helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_half_away(c: Column, digits: int = 2) -> Column:
    """``round(x * 10^d) / 10^d`` on the binary value.

    Spark's own ``round(double, d)`` goes through the shortest decimal, which turns
    1.005 into 1.01; the published statistics use the binary rule, giving 1.0.
    """
    scale = float(10**digits)
    return F.round(c * F.lit(scale), 0) / F.lit(scale)


def one_decimal(x: Column) -> Column:
    """Text with one decimal, rounding the binary value (half to even only on a true tie).

    Java rounds the shortest decimal, so 24811.85, stored slightly below, would become 24811.9.
    Twenty times x is an odd integer plus its exact rounding error where the decision is close.
    """
    scaled = x * 16.0 + x * 4.0
    error = x * 4.0 - (scaled - x * 16.0)
    tie = F.pmod(scaled, F.lit(2.0)) == 1.0
    even_below = F.pmod((scaled - 1.0) / 2.0, F.lit(2.0)) == 0.0
    down = (error < 0) | ((error == 0) & even_below)
    value = F.when(tie & down, (scaled - 1.0) / 20.0).when(tie, (scaled + 1.0) / 20.0).otherwise(x)
    return F.format_string("%.1f", value)
