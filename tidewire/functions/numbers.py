"""Fixed-point text of doubles."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_SPLIT = 134217729.0  # 2**27 + 1, halves a double's 53-bit mantissa


def to_fixed(x: Column, digits: int) -> Column:
    """`x` with `digits` decimals, rounded from its exact binary value, exact ties away from zero.

    format_string rounds the shortest decimal text instead (1.005 -> 1.01). Here the fraction is
    scaled by 10**digits without error as `scaled + residue`, so 1.005, which lies below the tie,
    gives 1.00.
    """
    scale = 10**digits
    size = F.abs(x)
    whole = F.floor(size).cast("double")
    fraction = size - whole
    high = fraction * _SPLIT - (fraction * _SPLIT - fraction)
    low = fraction - high
    scaled = fraction * float(scale)
    residue = (high * float(scale) - scaled) + low * float(scale)
    base = F.floor(scaled).cast("double")
    steps = base + F.when((scaled - base - 0.5) + residue >= 0, 1.0).otherwise(0.0)
    carry = steps >= scale
    units = (whole + F.when(carry, 1.0).otherwise(0.0)).cast("decimal(38,0)").cast("string")
    decimals = F.when(carry, 0.0).otherwise(steps).cast("bigint").cast("string")
    sign = F.when(x < 0, "-").otherwise("")
    return F.concat(sign, units, F.lit("."), F.lpad(decimals, digits, "0"))
