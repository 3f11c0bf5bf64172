"""Column expressions. All stay inside whole-stage code generation; none is a UDF."""

from __future__ import annotations

from datetime import datetime
from functools import reduce
from operator import add, or_

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_column(value) -> Column:
    return F.col(value) if isinstance(value, str) else value


def strip(value) -> Column:
    """Remove leading and trailing whitespace of every kind (``trim`` removes spaces only)."""
    return F.regexp_replace(as_column(value), r"^\s+|\s+$", "")


def starts_with_any(value, prefixes) -> Column:
    return reduce(or_, [F.startswith(as_column(value), F.lit(p)) for p in prefixes])


def round_half_even(value, digits: int) -> Column:
    """Round the scaled double to the nearest integer, ties to even, and scale back."""
    scale = F.lit(10.0 ** digits)
    return F.rint(as_column(value) * scale) / scale


def timestamp(value: datetime) -> Column:
    """A zone-free timestamp literal."""
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def whole_days(earlier, later) -> Column:
    """Elapsed whole days between two timestamps (not the number of midnights between them)."""
    elapsed = as_column(later) - as_column(earlier)
    return F.extract(F.lit("DAY"), elapsed).cast("bigint")


def count_reached(value, moments) -> Column:
    """How many of ``moments`` lie at or before ``value``."""
    column = as_column(value)
    return reduce(add, [(column >= timestamp(m)).cast("int") for m in moments], F.lit(0))


def at_least_one(value) -> Column:
    """``max(value, 1)`` that keeps NULL as NULL (``greatest`` alone would turn it into 1)."""
    column = as_column(value)
    return F.when(column.isNotNull(), F.greatest(column, F.lit(1).cast("double")))


def ratio_or_zero(numerator, denominator) -> Column:
    return F.coalesce(F.try_divide(as_column(numerator), as_column(denominator)), F.lit(0.0))


def day_text(value) -> Column:
    return F.date_format(as_column(value), "yyyy-MM-dd")


def money_text(value, symbol: str = "£") -> Column:
    """Whole currency units with thousands separators, e.g. ``£14,528``; ties go to even."""
    return F.concat(F.lit(symbol), F.format_number(F.rint(as_column(value)), 0))


def positive_hash(*parts) -> Column:
    """A reproducible 60-bit hash of the text of ``parts``; the same in any SQL engine with md5."""
    text = F.concat_ws("|", *[as_column(p).cast("string") for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")
