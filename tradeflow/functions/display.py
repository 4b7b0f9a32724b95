"""Text columns for reports, built from Spark functions only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def one_decimal(value: Column) -> Column:
    """Text with one decimal, rounding the exact binary value, ties to even.

    ``format_string('%.1f')`` rounds the shortest decimal text half up instead, so it prints
    0.25 as 0.3. Here 20·|x| is held as a sum plus its rounding error, which makes the tie exact.
    """
    # From 2**53 on a double is a whole number.
    whole_number = F.abs(value) >= float(2**53)
    size = F.when(whole_number, 0.0).otherwise(F.abs(value))
    wide, narrow = size * 16, size * 4
    twenty = wide + narrow
    part = twenty - wide
    error = (wide - (twenty - part)) + (narrow - part)
    tenths = F.floor(twenty / 2)
    rest = twenty - tenths * 2
    up = (rest > 1) | ((rest == 1) & ((error > 0) | ((error == 0) & (tenths % 2 == 1))))
    digits = tenths.cast("bigint") + up.cast("bigint")
    sign = F.when(value < 0, F.lit("-")).otherwise(F.lit(""))
    whole = F.floor(digits / 10).cast("string")
    small = F.concat(sign, whole, F.lit("."), (digits % 10).cast("string"))
    long = F.concat(value.try_cast("bigint").cast("string"), F.lit(".0"))
    wide_text = F.concat(value.try_cast("decimal(38,0)").cast("string"), F.lit(".0"))
    return F.when(whole_number, F.coalesce(long, wide_text, F.format_string("%.1f", value))).otherwise(small)


def signed_percent(ratio: Column) -> Column:
    """'+12.5%' / '-40.0%'."""
    text = one_decimal(ratio * 100)
    return F.concat(F.when(ratio >= 0, F.lit("+")).otherwise(F.lit("")), text, F.lit("%"))


def minute(instant: Column) -> Column:
    return F.date_format(instant, "yyyy-MM-dd HH:mm")
