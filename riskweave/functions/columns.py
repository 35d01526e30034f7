"""Column functions: recodes, conversions, rounding, bands and text labels."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F


def recode(col: Column | str, mapping: Mapping) -> Column:
    """Value of ``mapping`` for each key; NULL for keys it does not hold."""
    col = F.col(col) if isinstance(col, str) else col
    return reduce(lambda case, kv: case.when(col == F.lit(kv[0]), F.lit(kv[1])), mapping.items(), F)


def convert(col: Column | str, divisor: float) -> Column:
    """Linear unit conversion by a constant divisor, as a double."""
    col = F.col(col) if isinstance(col, str) else col
    return col.cast("double") / F.lit(float(divisor))


def ratio_per_square(num: Column | str, den: Column | str, den_unit: float = 100.0) -> Column:
    """``num / (den / den_unit)^2``; NULL where ``den`` is zero."""
    num = F.col(num) if isinstance(num, str) else num
    scaled = convert(den, den_unit)
    return F.try_divide(num.cast("double"), scaled * scaled)


def as_flag(col: Column | str) -> Column:
    """Truth of a numeric value: anything but zero, NULL stays NULL."""
    col = F.col(col) if isinstance(col, str) else col
    return col != 0


def flag_share(flags: Sequence[str]) -> Column:
    """Share of the given 0/1 columns that are set; a missing flag counts as 0."""
    return reduce(add, [F.coalesce(F.col(c).cast("int"), F.lit(0)) for c in flags]) / F.lit(float(len(flags)))


def parse_yes_no(col: Column | str) -> Column:
    """1 for ``y``/``yes``/``1``, 0 for ``n``/``no``/``0``, NULL for anything else."""
    token = F.lower(F.trim(F.col(col) if isinstance(col, str) else col))
    return F.when(token.isin("y", "yes", "1"), 1).when(token.isin("n", "no", "0"), 0)


def menu_offset(col: Column | str, offset: int = 1) -> Column:
    """Code of a zero-based menu choice."""
    return (F.col(col) if isinstance(col, str) else col) + F.lit(offset)


def round_half_even(col: Column | str, digits: int) -> Column:
    """Scale, round ties to even, scale back: the rounding of array libraries.

    ``bround`` rounds the decimal text of the number instead and differs near ties.
    """
    col = F.col(col) if isinstance(col, str) else col
    scale = F.lit(10.0**digits)
    return F.rint(col * scale) / scale


def round_half_away(col: Column, digits: int) -> Column:
    return F.round(col, digits)


def percent(prob: Column | str, digits: int = 1) -> Column:
    """Probability as a percentage, ties to even."""
    prob = F.col(prob) if isinstance(prob, str) else prob
    return round_half_even(prob * F.lit(100.0), digits)


def band_right_closed(col: Column | str, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Label of the interval ``(edges[i], edges[i+1]]``; NULL outside all of them."""
    col = F.col(col) if isinstance(col, str) else col
    spans = zip(edges[:-1], edges[1:], labels, strict=True)
    return reduce(lambda case, s: case.when((col > F.lit(s[0])) & (col <= F.lit(s[1])), s[2]), spans, F)


def band_left_closed(col: Column | str, cuts: Sequence[float], labels: Sequence[str]) -> Column:
    """Label by strict upper cuts; the last label takes everything from the last cut on."""
    col = F.col(col) if isinstance(col, str) else col
    cases = reduce(lambda case, s: case.when(col < F.lit(s[0]), s[1]), zip(cuts, labels), F)
    return F.when(col.isNotNull(), cases.otherwise(labels[-1]))


def abs_above(col: Column | str, limit: float) -> Column:
    """Whether the magnitude exceeds ``limit``."""
    return F.abs(F.col(col) if isinstance(col, str) else col) > F.lit(float(limit))
