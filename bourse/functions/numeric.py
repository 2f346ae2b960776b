"""Arithmetic that stays defined under ANSI mode."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def safe_div(num: Column, den: Column) -> Column:
    """``num / den`` that is NULL (not an error) when ``den`` is 0 or NULL."""
    return F.try_divide(num, den)


def round_half(x: Column, digits: int) -> Column:
    """Round a double half-up at ``digits`` decimals through DECIMAL.

    Plain ``round(double)`` and engines other than Spark disagree on exact
    binary halves and on the last bits of long sums; rounding a decimal
    image of the value is stable. Values that do not fit become NULL.
    """
    return F.round(x.try_cast("decimal(38,10)"), digits).cast("double")
