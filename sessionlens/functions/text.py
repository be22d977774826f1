"""Text rendering of numbers and timestamps inside Spark expressions."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

# 2**27 + 1 cuts a double into two halves whose products are exact.
_HALF_SPLITTER = 134217729.0
_EXACT_LIMIT = float(2**52)


def fixed_point(value: Column, digits: int) -> Column:
    """`value` with `digits` decimals, rounded the way C and Python round.

    The JVM formatter rounds the shortest decimal text of a double, C and
    Python round its exact binary value (0.00015 -> 0.0001). A tie is therefore
    decided by the exact error of the scaling product.
    """
    scale = float(10**digits)
    size = F.abs(value.cast("double"))
    scaled = size * F.lit(scale)
    whole = F.floor(scaled)
    fraction = scaled - whole
    split = size * F.lit(_HALF_SPLITTER)
    high = split - (split - size)
    residue = (high * F.lit(scale) - scaled) + (size - high) * F.lit(scale)
    half = fraction == 0.5
    up = (
        (fraction > 0.5)
        | (half & (residue > 0))
        | (half & (residue == 0) & (whole % 2 == 1))
    )
    units = (whole + F.when(up, 1).otherwise(0)).cast("decimal(18,0)")
    digits_text = (units * F.lit(Decimal(1).scaleb(-digits))).cast("string")
    sign = F.when(value < 0, F.lit("-")).otherwise(F.lit(""))
    return F.when(scaled < F.lit(_EXACT_LIMIT), F.concat(sign, digits_text)).otherwise(
        F.format_string(f"%.{digits}f", value.cast("double"))
    )


def shortest_number(value: Column) -> Column:
    """Plain decimal text of a double, at most six decimals, never an exponent.

    Zero prints as `0`, every other value keeps at least one decimal (`1234.0`).
    """
    plain = F.rtrim(F.round(value, 6).cast("decimal(38,6)").cast("string"), F.lit("0"))
    return F.when(value == 0, F.lit("0")).otherwise(
        F.when(F.endswith(plain, F.lit(".")), F.concat(plain, F.lit("0"))).otherwise(plain)
    )


def timestamp_text(value: Column) -> Column:
    """`yyyy-MM-dd HH:mm:ss[.ffffff]`; the fraction is absent when it is zero."""
    length = F.when(F.unix_micros(value) % 1_000_000 == 0, F.lit(19)).otherwise(F.lit(26))
    return F.substring(F.date_format(value, "yyyy-MM-dd HH:mm:ss.SSSSSS"), F.lit(1), length)


def text_or_none(value: Column) -> Column:
    """NULL prints as `None` in a replay line."""
    return F.coalesce(value.cast("string"), F.lit("None"))
