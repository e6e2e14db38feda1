"""Raw transactions to clean transactions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnkpi.functions import (
    CORRUPT,
    ENDLESS_TIME,
    MISSING,
    NONPOSITIVE,
    ODD_CLASS,
    amount_category,
    fault,
    has_criticals,
    is_positive,
    trans_hour,
)

FAULT = "_fault"
COPIES = "_copies"
CORRUPT_COPIES = "_corrupt_copies"
FILE, TEXT = REJECT = ("_file", "_text")


def drop_missing(raw: DataFrame) -> DataFrame:
    """Keep rows whose time, amount and class can be used."""
    return raw.filter(has_criticals())


def drop_copies(raw: DataFrame) -> DataFrame:
    """Keep one of each group of rows equal in every column, pass-through ones included.

    This is the one wide shuffle. It is a two-step hash aggregate: copies are collapsed
    inside each map task first, so a group holding a third of all rows sends one row per
    task and never piles up in a single reducer. Run large inputs inside ``sizing.sized``,
    which makes the number of reducers follow the input.
    """
    return raw.dropDuplicates()


def keep_positive(raw: DataFrame) -> DataFrame:
    """Keep rows with an amount above zero."""
    return raw.filter(is_positive())


def name_and_type(raw: DataFrame) -> DataFrame:
    """Clean names and types for the three known columns, in place."""
    named = raw.withColumnsRenamed(
        {"Time": "trans_time", "Amount": "amount", "Class": "is_fraud"}
    )
    return named.withColumns(
        {
            "trans_time": F.col("trans_time").cast("double"),
            "amount": F.col("amount").cast("double"),
            "is_fraud": F.col("is_fraud").cast("double").cast("int"),
        }
    )


def derive(named: DataFrame) -> DataFrame:
    """Add hour of day and amount bucket."""
    return named.withColumns(
        {
            "trans_hour": trans_hour(F.col("trans_time")),
            "amount_category": amount_category(F.col("amount")),
        }
    )


def clean(raw: DataFrame) -> DataFrame:
    """All cleaning steps in order.

    Both filters sit below the de-duplication in the optimized plan, and the renames and
    derived columns above it, so a row is parsed, tested, shuffled once and written.
    """
    return (
        raw.drop(CORRUPT)
        .transform(drop_missing)
        .transform(drop_copies)
        .transform(keep_positive)
        .transform(name_and_type)
        .transform(derive)
    )


def quoted(name: str) -> str:
    """A column name safe to resolve even with dots or backticks in it."""
    return "`" + name.replace("`", "``") + "`"


def count_copies(raw: DataFrame, rejects: bool = False) -> DataFrame:
    """One row per distinct row to keep with the number of its copies, and one per fault.

    Same shuffle as ``drop_copies``, but every raw row stays accounted for. Rows that break
    a rule are only counted: they are blanked, so that each task sends one for all of them
    that break the same rule. Counting after the shuffle keeps the counts right when map
    tasks run twice because an executor was lost; counters filled on the map side would
    count rows again.

    With ``rejects`` a row that breaks a rule keeps its text and the file it came from
    instead of being blanked altogether.
    """
    names = [name for name in raw.columns if name != CORRUPT]
    corrupt = F.col(CORRUPT).isNotNull() if CORRUPT in raw.columns else F.lit(False)
    broken = fault()
    marked = raw.select(
        *[F.when(broken.isNull(), raw[quoted(name)]).alias(name) for name in names],
        broken.alias(FAULT),
        corrupt.alias(CORRUPT_COPIES),
        *(_rejected(raw, names, broken) if rejects else []),
    )
    return marked.groupBy(*map(quoted, names), FAULT, *(REJECT if rejects else [])).agg(
        F.count(F.lit(1)).alias(COPIES),
        F.count_if(CORRUPT_COPIES).alias(CORRUPT_COPIES),
    )


def _rejected(raw: DataFrame, names: list[str], broken: Column) -> list[Column]:
    """File and text of a row that breaks a rule; its text as read if that was kept."""
    text = F.to_csv(F.struct(*[raw[quoted(name)].alias(name) for name in names]))
    if CORRUPT in raw.columns:
        text = F.coalesce(raw[CORRUPT], text)
    values = {FILE: F.input_file_name(), TEXT: text}
    return [F.when(broken.isNotNull(), values[name]).alias(name) for name in REJECT]


def rejects_counted(counted: DataFrame) -> DataFrame:
    """Rows that were refused out of ``count_copies`` rows with their rejects.

    (reason, file, text, rows): ``rows`` is how often the same text occurs in the file.
    """
    refused = counted.filter(F.col(FAULT).isNotNull())
    return refused.select(
        F.col(FAULT).alias("reason"), F.col(FILE).alias("file"), F.col(TEXT).alias("text"),
        F.col(COPIES).alias("rows"),
    )


def report_columns() -> list[Column]:
    """Row counts over ``count_copies`` rows.

    raw = missing + endless times + odd classes + not positive + duplicate + clean. All but
    the last two count every row that breaks the rule, copies included; a corrupt row, one
    with an unreadable value somewhere, is counted beside them.
    """
    kept, copies = F.col(FAULT).isNull(), F.col(COPIES)

    def total(column: Column) -> Column:
        return F.coalesce(F.sum(column), F.lit(0)).cast("bigint")

    def broken(name: str) -> Column:
        return total(F.when(F.col(FAULT) == name, copies))

    return [
        total(copies).alias("raw_rows"),
        total(F.col(CORRUPT_COPIES)).alias("corrupt_rows"),
        broken(MISSING).alias("missing_rows"),
        broken(ENDLESS_TIME).alias("endless_time_rows"),
        broken(ODD_CLASS).alias("odd_class_rows"),
        broken(NONPOSITIVE).alias("nonpositive_rows"),
        total(F.when(kept, copies - 1)).alias("duplicate_rows"),
        F.count_if(kept).alias("clean_rows"),
    ]


def clean_counted(counted: DataFrame) -> DataFrame:
    """Clean rows out of ``count_copies`` rows: equal to ``clean`` of the raw rows."""
    return (
        counted.filter(F.col(FAULT).isNull())
        .drop(FAULT, COPIES, CORRUPT_COPIES, *REJECT)
        .transform(name_and_type)
        .transform(derive)
    )


def ingest_report(raw: DataFrame) -> DataFrame:
    """One row of counts: raw rows, rows lost at each step, clean rows."""
    return count_copies(raw).agg(*report_columns())
