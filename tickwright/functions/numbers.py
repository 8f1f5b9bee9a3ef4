"""Numeric clean-up, rounding and formatting."""

from pyspark.sql import Column
from pyspark.sql import functions as F


# Numbers as plain text has them; a cast alone also takes suffixes such as "1d" and hex text.
PLAIN_NUMBER = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"


def plain_number(text: Column) -> Column:
    """Text as a double, NULL if it is no plain number."""
    return F.when(text.cast("string").rlike(PLAIN_NUMBER), text.try_cast("double"))


def number_or_zero(value: Column) -> Column:
    """The value as a double; text that is no number, NULL and NaN become 0.0."""
    named = F.lower(F.trim(value.cast("string"))).isin("inf", "+inf", "-inf", "infinity", "-infinity")
    parsed = F.when(named, value.try_cast("double")).otherwise(plain_number(value))
    return F.coalesce(F.nanvl(parsed, F.lit(0.0)), F.lit(0.0))


def is_finite(value: Column) -> Column:
    """True for ordinary numbers, false for NULL, NaN and both infinities."""
    return F.coalesce(F.abs(value) < F.lit(float("inf")), F.lit(False))


def absolute_error(predicted: Column, actual: Column) -> Column:
    return F.abs(predicted - actual)


# Unit names in rising order, a factor of 1024 apart.
BYTE_UNITS = ["B", "KB", "MB", "GB", "TB"]


def human_bytes(n_bytes: Column) -> Column:
    """Bytes in the largest unit that keeps the figure under 1024, one decimal.

    NULL and zero give "0 B". Halves round to even (``bround``), because Java's
    own ``%.1f`` rounds them up.
    """
    size = n_bytes.cast("double")
    text = None
    for power, unit in enumerate(BYTE_UNITS):
        scaled = size / F.lit(float(1024**power))
        shown = F.format_string(f"%.1f {unit}", F.bround(scaled, 1))
        fits = scaled < 1024
        if unit == BYTE_UNITS[-1]:
            text = text.otherwise(shown)
        else:
            text = F.when(fits, shown) if text is None else text.when(fits, shown)
    return F.when(size.isNull() | (size == 0), F.lit("0 B")).otherwise(text)
