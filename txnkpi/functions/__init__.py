"""Column expressions: derived fields, validity rules and exact money sums."""

from txnkpi.functions.derive import (
    AMOUNT_BUCKETS,
    TOP_BUCKET,
    amount_category,
    trans_hour,
)
from txnkpi.functions.money import gathered, money_sums, money_total, with_bands
from txnkpi.functions.rules import (
    CORRUPT,
    ENDLESS_TIME,
    MISSING,
    NONPOSITIVE,
    ODD_CLASS,
    REQUIRED,
    fault,
    has_criticals,
    is_positive,
)

__all__ = [
    "AMOUNT_BUCKETS",
    "CORRUPT",
    "ENDLESS_TIME",
    "MISSING",
    "NONPOSITIVE",
    "ODD_CLASS",
    "REQUIRED",
    "TOP_BUCKET",
    "amount_category",
    "fault",
    "has_criticals",
    "is_positive",
    "gathered",
    "money_sums",
    "money_total",
    "with_bands",
    "trans_hour",
]
