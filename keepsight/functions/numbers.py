"""Division, rounding and a normal tail."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(numerator: Column, denominator: Column) -> Column:
    """a / b as double; NULL instead of an error when b is zero."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def steady_mean(value: Column) -> Column:
    """Mean of all values but NULL and NaN; that of amounts does not depend on the rows' order.

    Doubles summed in another order differ in the last digits, which moves a tie when the
    mean is rounded. So values that six decimal digits hold are summed as decimals, exactly; all
    others (longer fractions, very large values, infinity) are summed as doubles beside them.
    """
    return mean_of_parts(mean_parts(value))


def mean_parts(value: Column) -> dict[str, Column]:
    """The sums that `steady_mean` is made of; parts of several groups are added."""
    number = value.cast("double")
    number = F.when(~F.isnan(number), number)
    exact = number.try_cast("decimal(22,6)")
    held = F.coalesce(exact.cast("double") == number, F.lit(False))
    return {
        "exact": F.sum(F.when(held, exact)),
        "other": F.sum(F.when(~held, number)),
        "values": F.count(number),
    }


def mean_of_parts(parts: dict[str, Column]) -> Column:
    """Mean from the (added) `mean_parts`; NULL without values."""
    exact, other = (F.coalesce(parts[p].cast("double"), F.lit(0.0)) for p in ("exact", "other"))
    return ratio(exact + other, parts["values"])


def half_up(value: Column, digits: int) -> Column:
    """Rounding of the SQL reports: ties go away from zero."""
    return F.round(value, digits)


def half_even(value: Column, digits: int) -> Column:
    """Rounding of the event and frame reports: ties go to the even digit."""
    return F.bround(value, digits)


def capped_share(value: Column, full: float) -> Column:
    """value / full, at most 1."""
    return F.least(value.cast("double") / F.lit(float(full)), F.lit(1.0))


def normal_upper_tail(z: Column) -> Column:
    """P(Z > z) for a standard normal Z, absolute error below 1e-7.

    Spark has no erf; this is formula 7.1.26 of Abramowitz and Stegun, *Handbook of
    Mathematical Functions*, whose coefficients are the fixed values below.
    """
    p = 0.3275911
    coefficients = (0.254829592, -0.284496736, 1.421413741, -1.453152027, 1.061405429)
    x = F.abs(z) / F.sqrt(F.lit(2.0))
    t = F.lit(1.0) / (F.lit(1.0) + F.lit(p) * x)
    series = F.lit(0.0)
    for a in reversed(coefficients):
        series = (series + F.lit(a)) * t
    tail = series * F.exp(-x * x) / F.lit(2.0)
    return F.when(z >= 0, tail).otherwise(F.lit(1.0) - tail)
