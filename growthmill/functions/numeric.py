"""Arithmetic that never raises on a zero denominator."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Text that counts as a number. A JVM cast alone would also take "12d" and "3f".
NUMBER_PATTERN = r"(?i)^\s*[+-]?((\d+\.?\d*|\.\d+)(e[+-]?\d+)?|inf|infinity)\s*$"


def safe_divide(numerator: Column, denominator: Column) -> Column:
    """Quotient as double; null when the denominator is zero or either side is null."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def safe_divide_or(numerator: Column, denominator: Column, fill: float = 0.0) -> Column:
    """Quotient as double with ``fill`` for zero denominators and missing values."""
    quotient = safe_divide(numerator, denominator)
    return F.coalesce(F.nanvl(quotient, F.lit(fill)), F.lit(fill))


def lenient_number(text: Column) -> Column:
    """Text to double; anything that is not a number, and null, becomes zero."""
    value = F.when(text.rlike(NUMBER_PATTERN), text.try_cast("double"))
    return F.coalesce(value, F.lit(0.0))


def from_micros(amount: Column) -> Column:
    return amount.cast("double") / F.lit(1_000_000.0)
