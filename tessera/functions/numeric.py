"""Numeric column expressions: exact rounding, grade bands, progressive tax."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Exact decimal type used for averages: 18 fractional digits keep any rational
# tie (x.xx5) exact and separate non-ties from ties for groups of up to 1e12 rows.
EXACT = "decimal(38,18)"

# Letter-grade lower bounds (score >= bound), highest first.
LETTER_BANDS: tuple[tuple[str, float], ...] = (("A", 90), ("B", 80), ("C", 70), ("D", 60))
LETTER_FLOOR = "F"

# Academic status lower bounds on the average, highest first.
STATUS_BANDS: tuple[tuple[str, float], ...] = (
    ("First Class", 80), ("Second Upper Class", 70), ("Second Lower Class", 60), ("Pass", 50))
STATUS_FLOOR = "Fail"

# Progressive tax on base salary, (threshold, rate) from the top
# band down; income above each threshold is taxed at its rate.
TAX_BANDS: tuple[tuple[float, float], ...] = (
    (1_000_000, 0.35), (250_000, 0.30), (100_000, 0.25), (30_000, 0.20))


def exact_sum(col: Column) -> Column:
    return F.sum(col.cast(EXACT))


def half_even_mean(total: Column, n: Column, scale: int = 2) -> Column:
    """Mean of an exact (decimal) total over a count, rounded half-to-even on
    the exact rational, returned as double. Null when ``n`` is 0."""
    return F.bround(total.cast(EXACT) / F.nullif(n, F.lit(0)).cast("decimal(20,0)"), scale).cast("double")


def banded(score: Column, bands: Sequence[tuple[str, float]], floor_label: str) -> Column:
    expr = None
    for label, bound in bands:
        cond = score >= F.lit(bound)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(floor_label))


def letter_grade(score: Column, bands=LETTER_BANDS, floor_label=LETTER_FLOOR) -> Column:
    return banded(score, bands, floor_label)


def academic_status(avg: Column, bands=STATUS_BANDS, floor_label=STATUS_FLOOR) -> Column:
    return banded(avg, bands, floor_label)


def progressive_tax(base: Column, bands=TAX_BANDS) -> Column:
    """Tax summed band by band from the top, in the same floating-point order as
    the sequential definition, so double results agree bit for bit."""
    tax = None
    remaining = base
    for threshold, rate in bands:
        part = F.when(remaining > F.lit(threshold), (remaining - F.lit(threshold)) * F.lit(rate)) \
            .otherwise(F.lit(0.0))
        tax = part if tax is None else tax + part
        remaining = F.least(remaining, F.lit(float(threshold)))
    return tax
