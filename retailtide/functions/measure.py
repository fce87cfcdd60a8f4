"""Money, shares and age bands."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Both ends of the middle age band belong to it.
BAND_LOW = 20
BAND_HIGH = 30


def money(amount: Column) -> Column:
    """Exact money: sums of doubles depend on the order of the rows.

    An amount that is no number, or over 26 digits, is null and counts in no sum.
    """
    return amount.try_cast("decimal(28,2)")


def one_decimal_percent(part: Column, total: Column) -> Column:
    """Share in percent, one decimal, halves up; 0 when the total is 0."""
    per_mille = F.try_divide(part.cast("double") * F.lit(1000.0), total.cast("double"))
    return F.coalesce(F.floor(per_mille + F.lit(0.5)) / F.lit(10.0), F.lit(0.0))


def age_band(age: Column) -> Column:
    """Key of the age band; unknown users carry age 0 and so are young."""
    return (
        F.when(age < BAND_LOW, "under_20")
        .when(age <= BAND_HIGH, "from_20_to_30")
        .when(age > BAND_HIGH, "over_30")
    )
