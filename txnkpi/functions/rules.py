"""Row rules of the cleaning step, written so that they reach the scan."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column
from pyspark.sql import functions as F

# Raw columns every input must have, and the reader's column for unreadable rows.
REQUIRED = ("Time", "Amount", "Class")
CORRUPT = "_corrupt"

INT_MIN, INT_MAX = -(2**31), 2**31 - 1


def _usable(name: str) -> Column:
    """Value present and a number; text that is no number counts as missing."""
    value = F.col(name).try_cast("double")
    return F.col(name).isNotNull() & value.isNotNull() & ~F.isnan(value)


def is_present() -> Column:
    """True when time, amount and class are there: neither NULL nor NaN nor unreadable."""
    return reduce(and_, map(_usable, REQUIRED))


def is_finite_time() -> Column:
    """An infinite time has no hour of day."""
    return F.abs(F.col("Time").try_cast("double")) < float("inf")


def is_class() -> Column:
    """A whole number of 32 bits. Nothing is rounded: 0.9 is no class at all."""
    value = F.col("Class").try_cast("double")
    return value.between(INT_MIN, INT_MAX) & (value == F.rint(value))


def has_criticals() -> Column:
    """True when time, amount and class can all be used.

    Left out are missing values and those that the clean types cannot hold, infinite times
    and classes that are no whole number of 32 bits; ``fault`` tells them apart. With ANSI
    casts one such row would otherwise end the whole job.
    """
    return is_present() & is_finite_time() & is_class()


def is_positive() -> Column:
    """Strictly positive amount: zero fails as well."""
    return F.col("Amount").try_cast("double") > 0


# Why a row is left out, in the order in which the rules apply.
MISSING, ENDLESS_TIME, ODD_CLASS, NONPOSITIVE = (
    "missing",
    "endless_time",
    "odd_class",
    "nonpositive",
)


def fault() -> Column:
    """Name of the first rule a row breaks, NULL for a row to keep."""
    return (
        F.when(~is_present(), MISSING)
        .when(~is_finite_time(), ENDLESS_TIME)
        .when(~is_class(), ODD_CLASS)
        .when(~is_positive(), NONPOSITIVE)
    )
