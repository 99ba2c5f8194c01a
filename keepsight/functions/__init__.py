"""Column expressions shared by the operators. All of them stay inside the JVM."""

from keepsight.functions.numbers import (
    capped_share,
    half_even,
    half_up,
    mean_of_parts,
    mean_parts,
    normal_upper_tail,
    ratio,
    steady_mean,
)
from keepsight.functions.text import email_domain, jaccard, strip_whitespace, trigrams
from keepsight.functions.times import (
    as_wall_clock,
    days_between,
    iso_week,
    iso_week_key,
    month_of,
    months_before,
    parse_wall_clock,
)

__all__ = [
    "as_wall_clock", "capped_share", "days_between", "email_domain", "half_even", "half_up",
    "iso_week", "iso_week_key", "jaccard", "mean_of_parts", "mean_parts", "month_of",
    "months_before", "normal_upper_tail", "parse_wall_clock", "ratio", "steady_mean", "strip_whitespace", "trigrams",
]
