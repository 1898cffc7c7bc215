"""Averages and roundings that give the same double on every run and every cluster.

The functions take a column name or SQL text and build one SQL expression: a rounding has
some thirty operators, and assembling them one by one from the client is slower than running
them.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def steady_avg(x: str) -> Column:
    """Mean that does not depend on the order in which tasks deliver rows.

    A plain ``avg`` of doubles changes in the last digits with the order of summation, so a
    retried task could move a mean across a threshold. Here values are summed exactly in units
    of 1e-9, whatever the size of the group. Values below 10,000 are 64-bit units, summed in two
    limbs: the low 20 bits and the rest, each with room for about 10^12 rows, so the hash
    aggregate keeps primitive buffers. Larger ones, up to 1e20, are summed as decimals of 38
    digits. Feed values have at most six decimals, so their mean is exact; finer values are
    rounded to nine decimals, which moves a mean by less than 1e-9. A group that holds values
    beyond 1e20, infinite ones or NaN has the plain mean; that depends on the values, never on
    how many there are.
    """
    parts = steady_parts(x)
    return _mean({name: f"coalesce({part}, 0)" if name in _LIMBS else part for name, part in parts.items()})


# Sums of limbs, which are zero where no value fits them.
_LIMBS = ("low", "rest", "large")


def steady_parts(x: str) -> dict[str, str]:
    """The aggregates that ``steady_avg`` is made of, as SQL by name.

    They can be stored per part of a group, under their names with a prefix, and give the same
    mean when ``steady_avg_of_parts`` adds them up.
    """
    x = f"cast({x} AS double)"
    units = f"CASE WHEN abs({x}) < 1e4D THEN floor({x} * 1e9D + 0.5D) END"
    large = f"CASE WHEN abs({x}) >= 1e4D AND abs({x}) < 1e20D THEN cast({x} AS decimal(38, 9)) END"
    return {
        "low": f"cast(sum({units} & 1048575) AS decimal(38, 0))",
        "rest": f"cast(sum(shiftright({units}, 20)) AS decimal(38, 0))",
        "large": f"sum({large})",
        "exact": f"count({units}) + count({large})",
        "n": f"count({x})",
        "plain": f"sum({x})",
    }


def steady_avg_of_parts(prefix: str) -> Column:
    """The mean over the parts of a group, whose columns are named ``prefix`` and part."""
    added = {name: f"sum({prefix}{name})" for name in steady_parts("0")}
    return _mean({n: f"coalesce({sql}, 0)" if n in _LIMBS else sql for n, sql in added.items()})


def _mean(part: dict[str, str]) -> Column:
    total = (
        f"cast(cast({part['rest']} * 1048576 + {part['low']} AS decimal(38, 0))"
        f" + cast({part['large']} * 1000000000 AS decimal(38, 0)) AS double) / 1e9D"
    )
    mean = f"CASE WHEN {part['exact']} = {part['n']} THEN try_divide({total}, {part['n']}) END"
    return F.expr(f"coalesce({mean}, try_divide({part['plain']}, {part['n']}))")


def _rounded(x: str, digits: int) -> str:
    scale = f"{10**digits}D"
    product = f"({x} * {scale})"
    # 2^27 + 1 splits a double into halves whose products with the scale are exact
    high = f"({x} * 134217729D - ({x} * 134217729D - {x}))"
    error = f"(({high} * {scale} - {product}) + ({x} - {high}) * {scale})"
    nearest = f"rint({product})"
    step = (
        f"CASE WHEN {product} - {nearest} = 0.5D AND {error} > 0D THEN 1D"
        f" WHEN {product} - {nearest} = -0.5D AND {error} < 0D THEN -1D ELSE 0D END"
    )
    return f"(({nearest} + {step}) / {scale})"


def round_exact(x: str, digits: int) -> Column:
    """Round to at most six decimals by the exact binary value, ties to even.

    Spark's ``round`` works on the shortest decimal text (0.345 becomes 0.35 although the
    double lies below the tie). Feeds are written with correctly rounded decimals, so this
    takes the product with 10^digits together with its rounding error and decides ties by
    the error. It costs a handful of double operations and no decimal objects.
    """
    return F.expr(_rounded(x, digits))


def fixed_text(x: str, digits: int) -> Column:
    """Text with exactly ``digits`` decimals; null stays null."""
    fixed = f"try_cast({_rounded(x, digits)} AS decimal(38, {digits}))"
    return F.expr(f"coalesce(cast({fixed} AS string), cast({x} AS string))")
