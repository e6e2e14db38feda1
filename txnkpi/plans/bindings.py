"""The given tables seen as raw transactions (Time, Amount, Class, pass-through)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txnkpi.operators.cleaning import clean

Binding = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _seconds_since(moment: str) -> Column:
    micros = F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'{moment}', ts)")
    return micros.cast("double") / 1_000_000


def _raw(df: DataFrame, time: Column, amount: Column, fraud: Column, *more) -> DataFrame:
    return df.select(
        time.alias("Time"), amount.alias("Amount"), fraud.alias("Class"), *more
    )


def _flag(condition: Column) -> Column:
    return F.when(condition, 1).otherwise(0)


def _error() -> Column:
    return _flag(F.col("event_type") == "error")


def events(spark: SparkSession, folder: str) -> DataFrame:
    """All hours of the day; errors count as fraud."""
    df = _table(spark, folder, "events")
    return _raw(df, _seconds_since("2024-01-01 00:00:00"), F.col("value"), _error())


def events_mid_month(spark: SparkSession, folder: str) -> DataFrame:
    """Events timed from the middle of the month: half of the times are negative."""
    df = _table(spark, folder, "events")
    return _raw(df, _seconds_since("2024-01-15 12:30:00"), F.col("value"), _error())


def events_wide(spark: SparkSession, folder: str) -> DataFrame:
    """Events with two pass-through columns."""
    df = _table(spark, folder, "events")
    time = _seconds_since("2024-01-01 00:00:00")
    return _raw(df, time, F.col("value"), _error(), "user_id", "event_type")


def events_dated(spark: SparkSession, folder: str) -> DataFrame:
    """Events with a date and a category, as the declared transactions table has them."""
    df = _table(spark, folder, "events")
    date = F.to_date("ts").alias("trans_date")
    category = F.col("event_type").alias("category")
    time = _seconds_since("2024-01-01 00:00:00")
    return _raw(df, time, F.col("value"), _error(), date, category)


def events_gaps(spark: SparkSession, folder: str) -> DataFrame:
    """Events that lack amounts below 10 and the class of views."""
    df = _table(spark, folder, "events")
    amount = F.when(F.col("value") >= 10, F.col("value"))
    klass = F.when(F.col("event_type") == "error", 1).when(F.col("event_type") != "view", 0)
    return _raw(df, _seconds_since("2024-01-01 00:00:00"), amount, klass)


def events_coarse(spark: SparkSession, folder: str) -> DataFrame:
    """Events cut to hours and whole amounts, so that many rows are copies."""
    df = _table(spark, folder, "events")
    time = F.hour("ts").cast("double") * 3600
    return _raw(df, time, F.floor("value").cast("double"), _error())


def events_coarse_typed(spark: SparkSession, folder: str) -> DataFrame:
    """The same with the kind of event, in which many rows differ that agree otherwise."""
    df = _table(spark, folder, "events")
    time = F.hour("ts").cast("double") * 3600
    return _raw(df, time, F.floor("value").cast("double"), _error(), "event_type")


def events_fine(spark: SparkSession, folder: str) -> DataFrame:
    """Amounts far below a cent."""
    df = events(spark, folder)
    return df.withColumn("Amount", F.col("Amount") / 1e7)


def events_huge(spark: SparkSession, folder: str) -> DataFrame:
    """Amounts on both sides of 10^9 and of 10^12, with digits after the point."""
    df = _table(spark, folder, "events")
    scale = F.when(F.col("user_id") % 3 == 0, 1e7).when(F.col("user_id") % 3 == 1, 1e10)
    amount = F.col("value") * scale.otherwise(1.0) + 0.0004
    return _raw(df, _seconds_since("2024-01-01 00:00:00"), amount, _error())


def events_vast(spark: SparkSession, folder: str) -> DataFrame:
    """Amounts on both sides of 2^60 and amounts below 10^-6, in whole units of 2^-30."""
    df = _table(spark, folder, "events")
    scale = F.when(F.col("user_id") % 3 == 0, 2.0**54).when(F.col("user_id") % 3 == 1, 2.0**-20)
    amount = F.floor(F.col("value") * 1024) / 1024 * scale.otherwise(1.0)
    return _raw(df, _seconds_since("2024-01-01 00:00:00"), amount, _error())


def events_sold(spark: SparkSession, folder: str) -> DataFrame:
    """Events with all columns of the declared transactions table."""
    df = _table(spark, folder, "events")
    user = F.col("user_id")
    more = [
        F.to_date("ts").alias("trans_date"),
        F.col("event_type").alias("category"),
        F.concat(F.lit("m"), (user % 50).cast("string")).alias("merchant"),
        F.when(user % 11 != 0, (user % 7).cast("string")).alias("state"),
    ]
    return _raw(df, _seconds_since("2024-01-01 00:00:00"), F.col("value"), _error(), *more)


def events_coarse_even(spark: SparkSession, folder: str) -> DataFrame:
    """Every second row of the coarse events with their kind."""
    df = _table(spark, folder, "events").filter(F.col("event_id") % 2 == 0)
    time = F.hour("ts").cast("double") * 3600
    return _raw(df, time, F.floor("value").cast("double"), _error(), "event_type")


def events_messy(spark: SparkSession, folder: str) -> DataFrame:
    """Every fault: missing and odd classes, endless times, low amounts, copies."""
    df = _table(spark, folder, "events")
    user = F.col("user_id")
    time = F.when(user % 13 == 0, float("inf")).otherwise(F.hour("ts").cast("double") * 3600)
    klass = (
        F.when(user % 7 == 0, None)
        .when(user % 5 == 0, 0.9)
        .when(user % 11 == 0, 1.9)
        .when(user % 3 == 0, 2.0)
        .otherwise(_error().cast("double"))
    )
    return _raw(df, time, F.floor(F.col("value") / 10) - 2.0, klass, "event_type")


def events_unreadable(spark: SparkSession, folder: str) -> DataFrame:
    """Amounts as text, some of which are no numbers."""
    df = events(spark, folder)
    text = F.when(F.col("Time") % 7 < 1, "oops").otherwise(F.col("Amount").cast("string"))
    return df.withColumn("Amount", text)


def customer(spark: SparkSession, folder: str) -> DataFrame:
    """Account balances: negative amounts and all four buckets."""
    df = _table(spark, folder, "customer")
    fraud = _flag(F.col("c_mktsegment") == "MACHINERY")
    return _raw(df, F.col("c_custkey").cast("double") * 977, F.col("c_acctbal"), fraud)


def customer_unclean(spark: SparkSession, folder: str) -> DataFrame:
    """Account balances with missing times and amounts, and with an unknown class."""
    df = customer(spark, folder)
    key = F.col("Time") / 977
    return df.withColumns(
        {
            "Time": F.when(key % 9 != 0, F.col("Time")),
            "Amount": F.when(key % 10 != 0, F.col("Amount")),
            "Class": F.when(key % 8 == 0, 7).otherwise(F.col("Class")),
        }
    )


def customer_honest(spark: SparkSession, folder: str) -> DataFrame:
    """Account balances without any fraud."""
    return customer(spark, folder).withColumn("Class", F.lit(0))


def lineitem(spark: SparkSession, folder: str) -> DataFrame:
    """The largest table; returned items count as fraud."""
    df = _table(spark, folder, "lineitem")
    time = F.col("l_orderkey").cast("double") * 977
    return _raw(df, time, F.col("l_extendedprice"), _flag(F.col("l_returnflag") == "R"))


def lineitem_early(spark: SparkSession, folder: str) -> DataFrame:
    """Line items timed by line number: only the first hours of the day occur."""
    df = _table(spark, folder, "lineitem")
    time = F.col("l_linenumber").cast("double") * 3600
    return _raw(df, time, F.col("l_extendedprice"), _flag(F.col("l_returnflag") == "R"))


def orders_status(spark: SparkSession, folder: str) -> DataFrame:
    """Orders with a third class beside normal and fraud."""
    df = _table(spark, folder, "orders")
    status = F.col("o_orderstatus")
    klass = F.when(status == "F", 1).when(status == "P", 2).otherwise(0)
    return _raw(df, F.col("o_orderkey").cast("double") * 977, F.col("o_totalprice"), klass)


def cleaned(binding: Binding, spark: SparkSession, folder: str) -> DataFrame:
    """Clean transactions of a binding."""
    return binding(spark, folder).transform(clean)
