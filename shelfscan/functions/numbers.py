"""Number helpers. All run inside code generation, without Python workers."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Decimals kept of each amount in a sum.
SUM_SCALE = 10
#: A fraction is summed in two parts of this many units, so that no sum of a task fills 64 bits.
PART_UNITS = 100_000
#: Doubles below this lie closer together than units of the last decimal.
SMALL = 1 << 18


def exact_sum(amount: Column, when: Column | None = None) -> Column:
    """SUM of a DOUBLE column as a decimal that does not depend on task order or retries.

    Amounts count with ``SUM_SCALE`` decimals and up to 27 digits before them; what is smaller
    is lost. NaN and infinite amounts have no decimal and are an error, not a zero. ``when``
    restricts the sum to some rows.

    Amounts below ``SMALL`` are split without error into a whole number and units of the last
    decimal, and these are added as 64-bit integers; only larger ones are made decimals line by line.
    """
    value = amount.cast("double") if when is None else F.when(when, amount.cast("double"))
    size = F.abs(value)
    small = F.when(size < SMALL, value)
    whole = F.floor(small)
    units = F.floor((small - whole) * F.lit(float(10 ** SUM_SCALE)) + F.lit(0.5))
    large = F.when(size >= SMALL, F.when(
        size < float("inf"), value.cast(f"decimal(37,{SUM_SCALE})")).otherwise(
        F.raise_error(F.lit("an amount is NaN or infinite"))))

    upper = F.sum(F.floor(units / F.lit(float(PART_UNITS)))).cast("decimal(19,0)")
    lower = F.sum(units % PART_UNITS).cast("decimal(19,0)")
    fractions = (upper * F.lit(Decimal(PART_UNITS)) + lower).cast("decimal(27,0)") * F.lit(
        Decimal(1).scaleb(-SUM_SCALE))
    smalls = F.sum(whole).cast("decimal(29,10)") + fractions.cast("decimal(30,10)")
    larges = F.sum(large).cast("decimal(37,10)")
    both = F.coalesce(smalls, F.lit(0).cast("decimal(31,10)")) + F.coalesce(
        larges, F.lit(0).cast("decimal(37,10)"))
    return F.when(smalls.isNotNull() | larges.isNotNull(), both.cast(f"decimal(38,{SUM_SCALE})"))


def total(amount: Column) -> Column:
    """Order-independent SUM of a DOUBLE column, as DOUBLE."""
    return exact_sum(amount).cast("double")


def ratio(numerator: Column, denominator: Column) -> Column:
    """Division that yields NULL for a zero denominator."""
    return numerator.cast("double") / F.nullif(denominator.cast("double"), F.lit(0.0))


def whole_number(text: Column, strict: bool = True) -> Column:
    """Text to INT, rounding text such as ``12.6``. ``strict=False`` gives NULL for bad text."""
    if strict:
        return F.round(text.cast("decimal(38,18)"), 0).cast("int")
    return F.round(text.try_cast("decimal(38,18)"), 0).try_cast("int")


def real_number(text: Column, strict: bool = True) -> Column:
    """Text to DOUBLE."""
    return text.cast("double") if strict else text.try_cast("double")
