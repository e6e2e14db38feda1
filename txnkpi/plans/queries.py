"""Named queries over the given tables, one or more per operator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnkpi.operators import cleaning, kpis, profile, quality
from txnkpi.operators.conforming import conform
from txnkpi.operators.publishing import refresh, upsert
from txnkpi.plans import bindings as b
from txnkpi.plans import by_day, daily, history, incremental, run_figures
from txnkpi.plans.registry import DECLARED_ONLY, REGISTRY
from txnkpi.sources import evolving, paths, published, tables
from txnkpi.sources.raw_csv import read_raw

Query = Callable[[SparkSession, str], DataFrame]


def _raw_query(binding: b.Binding, step: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, folder: step(binding(spark, folder))


def _clean_query(binding: b.Binding, step: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, folder: step(b.cleaned(binding, spark, folder))


def _derived(*columns: str) -> Callable[[DataFrame], DataFrame]:
    """Derived columns of all rows, cleaned or not."""
    return lambda raw: cleaning.derive(cleaning.name_and_type(raw)).select(*columns)


WIDE_SCHEMA = "Time double, Amount double, Class double, user_id bigint, event_type string"


def _csv_ingest(schema: str | None) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        path = paths.scratch(spark, "raw")
        b.events_wide(spark, folder).write.csv(path, header=True)
        return cleaning.clean(read_raw(spark, path, schema))

    return query


def _csv_report(binding: b.Binding) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        path = paths.scratch(spark, "raw")
        binding(spark, folder).write.csv(path, header=True)
        return cleaning.ingest_report(read_raw(spark, path))

    return query


MESSY_SCHEMA = "Time double, Amount double, Class double, event_type string"


def _daily_ingest(spark: SparkSession, folder: str) -> tuple[str, dict[str, int]]:
    """The ingest stage over CSV files; returns the output folder and the counts."""
    path, output = paths.scratch(spark, "raw"), paths.scratch(spark, "output")
    b.events_messy(spark, folder).write.csv(path, header=True)
    return output, daily.ingest(spark, path, output, MESSY_SCHEMA)


def _daily_rows(spark: SparkSession, folder: str) -> DataFrame:
    output, _ = _daily_ingest(spark, folder)
    return tables.read(spark, tables.clean_path(output))


def _daily_counts(spark: SparkSession, folder: str) -> DataFrame:
    _, counts = _daily_ingest(spark, folder)
    schema = ", ".join(f"{name} bigint" for name in counts)
    return spark.createDataFrame([tuple(counts.values())], schema)


def _clean_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    output = paths.scratch(spark, "output")
    daily.write_clean(b.events_wide(spark, folder), output)
    return tables.read(spark, tables.clean_path(output))


def _transformed(spark: SparkSession, folder: str, binding: b.Binding) -> str:
    """Run ingest and transform on a binding; returns the output folder."""
    output = paths.scratch(spark, "output")
    daily.write_clean(binding(spark, folder), output)
    daily.transform(spark, output)
    return output


def _kpi_roundtrip(name: str) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        output = _transformed(spark, folder, b.lineitem)
        return tables.read(spark, tables.kpi_path(output, name))

    return query


def _gate_kpis(spark: SparkSession, folder: str) -> DataFrame:
    return daily.check_kpis(spark, _transformed(spark, folder, b.events))


def _gate_kpis_missing(spark: SparkSession, folder: str) -> DataFrame:
    """One KPI was never written, of another only a dead write's leftovers are there."""
    output = paths.scratch(spark, "output")
    transactions = b.cleaned(b.events, spark, folder)
    for name, kpi in REGISTRY.items():
        if name == "kpi_global":
            leftovers = paths.join(tables.kpi_path(output, name), "_temporary", "0")
            tables.write(kpi.build(transactions), leftovers)
        elif name != "kpi_by_hour":
            tables.write(kpi.build(transactions), tables.kpi_path(output, name))
    return daily.check_kpis(spark, output)


Meeting = Callable[[DataFrame, DataFrame], DataFrame]


def _published(name: str, old: b.Binding, new: b.Binding, meet: Meeting) -> Query:
    """Publish a KPI of one binding, let that of another meet it, read the outcome."""
    kpi = REGISTRY[name]

    def query(spark: SparkSession, folder: str) -> DataFrame:
        root = paths.scratch(spark, "published")

        def batch(binding: b.Binding) -> DataFrame:
            """The KPI as a written table, since publishing looks at it more than once."""
            path = paths.scratch(spark, name)
            tables.write(kpi.build(b.cleaned(binding, spark, folder)), path)
            return conform(tables.read_compact(spark, path), kpi.schema)

        def current() -> DataFrame:
            return published.read_published(spark, root, name, kpi.schema)

        published.write_version(batch(old), root, name)
        published.write_version(meet(current(), batch(new)), root, name)
        return current()

    return query


def _upsert(name: str, old: b.Binding, new: b.Binding) -> Query:
    key = REGISTRY[name].key
    return _published(name, old, new, lambda target, batch: upsert(target, batch, key))


def _refresh(name: str, old: b.Binding, new: b.Binding) -> Query:
    return _published(name, old, new, refresh)


def _publish_summary(spark: SparkSession, folder: str) -> DataFrame:
    root = paths.scratch(spark, "published")
    for binding in (b.customer, b.events):
        daily.publish(spark, _transformed(spark, folder, binding), root)
    return daily.summary_frame(spark, root)


def _publish_snapshot(spark: SparkSession, folder: str) -> DataFrame:
    """Two runs publish one after the other, a third one starts from the first and is refused."""
    root = paths.scratch(spark, "published")
    daily.publish(spark, _transformed(spark, folder, b.customer), root)
    base = published.snapshot(spark, root)
    daily.publish(spark, _transformed(spark, folder, b.events), root)
    try:
        daily.publish(spark, _transformed(spark, folder, b.lineitem), root, base=base)
    except published.PublishConflict:
        return daily.summary_frame(spark, root).withColumn("version", F.lit(published.snapshot(spark, root).version))
    raise RuntimeError("a run from an old publication was not refused")


def _upsert_bucketed(spark: SparkSession, folder: str) -> DataFrame:
    """Balances by customer, of which some are replaced and some are added."""
    root = paths.scratch(spark, "published")
    rows = b.cleaned(b.customer, spark, folder).select("trans_time", "amount", "is_fraud")
    number = F.col("trans_time") / 977
    old = published.write_buckets(rows.filter(number % 3 != 0), root, "balances", "trans_time", 16)
    published.commit(spark, root, published.snapshot(spark, root), {"balances": old})
    path = paths.scratch(spark, "batch")
    tables.write(rows.filter(number % 5 == 0).withColumn("amount", F.col("amount") + 1), path)
    schema = rows.schema
    batch = tables.read(spark, path, schema)
    new = published.upsert_buckets(spark, root, "balances", old, batch, schema)
    published.commit(spark, root, published.snapshot(spark, root), {"balances": new})
    return published.read_published(spark, root, "balances", schema)


RERUN_FROM = "2024-01-11"


def _days_written(spark: SparkSession, folder: str) -> str:
    """All days with wrong amounts, then those from a date on once more with the right ones."""
    path = paths.scratch(spark, "transactions")
    sold = b.cleaned(b.events_sold, spark, folder).drop("trans_time", "trans_hour", "amount_category")
    by_day.write_days(sold.withColumn("amount", F.col("amount") * 2), path)
    by_day.write_days(sold.filter(F.col("trans_date") >= RERUN_FROM), path)
    return path


def _transactions_by_day(spark: SparkSession, folder: str) -> DataFrame:
    return by_day.read_days(spark, _days_written(spark, folder))


def _kpi_one_day(spark: SparkSession, folder: str) -> DataFrame:
    day = F.col("trans_date") == F.lit("2024-01-15").cast("date")
    return kpis.kpi_daily(by_day.read_days(spark, _days_written(spark, folder)).filter(day))


def _dedup_history(spark: SparkSession, folder: str) -> DataFrame:
    """Two days are kept, one of them run twice; the third day's rows that are new."""
    path = paths.scratch(spark, "history")
    even, rows = b.events_coarse_even(spark, folder), b.events_coarse_typed(spark, folder)
    for day, raw in (("1", even.filter("Time < 40000")), ("2", rows), ("2", even)):
        history.remember(history.fresh_rows(raw, path, day, 4), path, day, 4)
    return history.fresh_rows(rows, path, "3", 4)


def _incremental(spark: SparkSession, folder: str) -> str:
    """Three days, one of which came in half and runs again."""
    root = paths.scratch(spark, "by_day")
    transactions = b.cleaned(b.events, spark, folder)
    number = F.floor(F.col("trans_time") / 86400) % 3
    days = {str(n): transactions.filter(number == n) for n in range(3)}
    for day, rows in days.items():
        incremental.add_day(rows.filter("trans_hour < 12") if day == "1" else rows, root, day)
    incremental.add_day(days["1"], root, "1")
    return root


def _suite_incremental(spark: SparkSession, folder: str) -> DataFrame:
    return kpis.suite_of_cells(incremental.cells(spark, _incremental(spark, folder)))


def _top_incremental(spark: SparkSession, folder: str) -> DataFrame:
    return incremental.kpi_tables(spark, _incremental(spark, folder))["kpi_top_fraud_amounts"]


def _ingest_rejects(spark: SparkSession, folder: str) -> DataFrame:
    """Refused rows by reason, beside what the same pass counted and kept."""
    path, output = paths.scratch(spark, "raw"), paths.scratch(spark, "output")
    b.events_messy(spark, folder).write.csv(path, header=True)
    counts = daily.ingest(spark, path, output, MESSY_SCHEMA, rejects=True)
    clean, rejects = daily.read_ingested(spark, output)
    kept = clean.agg(F.lit("clean").alias("reason"), F.count("*").alias("rows"), F.count("*").alias("texts"))
    copies = F.lit(counts["duplicate_rows"]).cast("bigint")
    kept = kept.unionByName(kept.select(F.lit("duplicate").alias("reason"), copies.alias("rows"), F.lit(0).cast("bigint").alias("texts")))
    refused = rejects.groupBy("reason").agg(F.sum("rows").alias("rows"), F.count_distinct("text").alias("texts"))
    return refused.unionByName(kept).withColumn("raw_rows", F.lit(counts["raw_rows"]).cast("bigint"))


PLANTED = "2024-01-20"


def _gate_history(spark: SparkSession, folder: str) -> DataFrame:
    """Days are runs; the one judged has lost four rows of five."""
    root = paths.scratch(spark, "figures")
    rows = b.cleaned(b.events_dated, spark, folder)
    rows = rows.withColumn("run", F.col("trans_date").cast("string")).filter(F.col("run") <= PLANTED)
    rows = rows.filter((F.col("run") < PLANTED) | (F.floor("trans_time") % 5 == 0))
    figures = rows.groupBy("run").agg(
        F.count("*").alias("clean_rows"),
        F.count_distinct("category").alias("categories"),
        F.count_distinct("trans_hour").alias("hours"),
    )
    path = paths.scratch(spark, "measured")
    tables.write(figures.unpivot("run", ["clean_rows", "categories", "hours"], "check", "measured"), path)
    measured = tables.read(spark, path)
    late = F.col("run") == "2024-01-19"
    run_figures.remember(measured.filter(~late), root, "all before")
    run_figures.remember(measured.filter(late).withColumn("measured", F.lit(7)), root, "2024-01-19")
    run_figures.remember(measured.filter(late), root, "2024-01-19")
    past = run_figures.past(spark, root, PLANTED).filter(F.col("run") < PLANTED)
    return quality.gate_history(past, measured.filter(F.col("run") == PLANTED))


def _read_evolved(spark: SparkSession, folder: str) -> DataFrame:
    """Events of three times, each with a wider schema; the first one is published twice."""
    root = paths.scratch(spark, "evolving")
    events = spark.read.parquet(f"{folder}/events.parquet")
    day = F.dayofmonth("ts")
    narrow = ["event_id", F.col("user_id").cast("int").alias("user_id"), F.col("value").cast("float").alias("value")]
    evolving.add_part(events.filter(day <= 12).select(*narrow), root, "events", "early")
    evolving.add_part(events.filter((day > 10) & (day <= 20)).select("event_id", "user_id", "value"), root, "events", "middle")
    evolving.add_part(events.filter(day > 20).select("event_id", "event_type", "user_id", "value"), root, "events", "late")
    evolving.add_part(events.filter(day <= 10).select(*narrow), root, "events", "early")
    return evolving.read_evolved(spark, root, "events")


def _ingest_profile(spark: SparkSession, folder: str) -> DataFrame:
    """Sketched figures of an ingest's own pass, held against the rows it wrote."""
    path, output = paths.scratch(spark, "raw"), paths.scratch(spark, "output")
    b.events_wide(spark, folder).write.csv(path, header=True)
    daily.ingest(spark, path, output, WIDE_SCHEMA, profiled=True)
    clean = tables.read(spark, tables.clean_path(output))
    sketched = profile.report(profile.merge(daily.read_profile(spark, output)))
    frames = []
    for row in sketched.collect():  # one per column
        value = F.col(row["column"])
        near = F.abs(F.lit(row["distinct"]) / F.count_distinct(value) - 1) <= profile.DISTINCT_ERROR
        ranks = F.lit(True)
        if row["median"] is not None:
            under, to = (F.count_if(x) / F.count(value) for x in (value < row["median"], value <= row["median"]))
            ranks = (under <= 0.5 + profile.RANK_ERROR) & (to >= 0.5 - profile.RANK_ERROR)
        frames.append(
            clean.agg(
                F.lit(row["column"]).alias("column"),
                F.lit(row["rows"]).cast("bigint").alias("rows"),
                F.lit(row["least"]).cast("double").alias("least"),
                F.lit(row["highest"]).cast("double").alias("highest"),
                near.alias("distinct_within"),
                ranks.alias("median_within"),
            )
        )
    first, *rest = frames
    for frame in rest:
        first = first.unionByName(frame)
    return first


def _exact_profile(spark: SparkSession, folder: str) -> DataFrame:
    return profile.exact_profile(b.events_wide(spark, folder))


def _conform(name: str) -> Query:
    kpi = REGISTRY[name]
    return _clean_query(b.events, lambda df: conform(kpi.build(df), kpi.schema, strict=True))


def _conform_declared(name: str, build: Callable[[DataFrame], DataFrame]) -> Query:
    schema = DECLARED_ONLY[name]
    return _clean_query(b.events_dated, lambda df: conform(build(df), schema, strict=True))


def queries() -> dict[str, Query]:
    """All queries by name."""
    found: dict[str, Query] = {
        "csv_ingest": _csv_ingest(WIDE_SCHEMA),
        "csv_ingest_inferred": _csv_ingest(None),
        "csv_ingest_report": _csv_report(b.events_gaps),
        "csv_ingest_report_unreadable": _csv_report(b.events_unreadable),
        "daily_ingest": _daily_rows,
        "daily_ingest_counts": _daily_counts,
        "clean_roundtrip": _clean_roundtrip,
        "clean_null_drop": _raw_query(b.events_gaps, cleaning.drop_missing),
        "clean_dedup": _raw_query(b.events_coarse, cleaning.drop_copies),
        "clean_dedup_wide": _raw_query(b.events_coarse_typed, cleaning.drop_copies),
        "clean_positive": _raw_query(b.customer, cleaning.keep_positive),
        "derive_trans_hour": _raw_query(b.events, _derived("trans_time", "trans_hour")),
        "derive_trans_hour_negative": _raw_query(
            b.events_mid_month, _derived("trans_time", "trans_hour")
        ),
        "derive_amount_category": _raw_query(
            b.customer, _derived("amount", "amount_category")
        ),
        "clean_transactions": _raw_query(b.events_wide, cleaning.clean),
        "clean_transactions_coarse": _raw_query(b.events_coarse, cleaning.clean),
        "clean_transactions_gaps": _raw_query(b.events_gaps, cleaning.clean),
        "clean_transactions_coarse_typed": _raw_query(
            b.events_coarse_typed, cleaning.clean
        ),
        "clean_transactions_messy": _raw_query(b.events_messy, cleaning.clean),
        "ingest_report": _raw_query(b.events_coarse, cleaning.ingest_report),
        "ingest_report_messy": _raw_query(b.events_messy, cleaning.ingest_report),
        "gate_ingest": _raw_query(
            b.events_messy,
            lambda raw: quality.gate_ingest(cleaning.ingest_report(raw)),
        ),
        "gate_source": _raw_query(b.events, quality.gate_source),
        "gate_clean": _clean_query(b.events, quality.gate_clean),
        "gate_clean_unclean": _raw_query(
            b.customer_unclean,
            lambda raw: quality.gate_clean(cleaning.derive(cleaning.name_and_type(raw))),
        ),
        "gate_kpis": _gate_kpis,
        "gate_kpis_missing": _gate_kpis_missing,
        "upsert_by_hour": _upsert("kpi_by_hour", b.events, b.lineitem_early),
        "upsert_by_amount_category": _upsert(
            "kpi_by_amount_category", b.customer, b.events
        ),
        "upsert_fraud_vs_normal": _upsert(
            "kpi_fraud_vs_normal", b.orders_status, b.lineitem
        ),
        "refresh_global": _refresh("kpi_global", b.customer, b.events),
        "refresh_top_fraud": _refresh("kpi_top_fraud_amounts", b.customer, b.events),
        "refresh_empty_keeps_old": _refresh(
            "kpi_top_fraud_amounts", b.events, b.customer_honest
        ),
        "publish_summary": _publish_summary,
        "publish_snapshot": _publish_snapshot,
        "upsert_bucketed": _upsert_bucketed,
        "transactions_by_day": _transactions_by_day,
        "kpi_daily_of_one_day": _kpi_one_day,
        "clean_dedup_history": _dedup_history,
        "kpi_suite_incremental": _suite_incremental,
        "kpi_top_fraud_incremental": _top_incremental,
        "ingest_rejects": _ingest_rejects,
        "ingest_profile": _ingest_profile,
        "profile_exact": _exact_profile,
        "gate_history": _gate_history,
        "read_evolved": _read_evolved,
        "kpi_daily": _clean_query(b.events_dated, kpis.kpi_daily),
        "kpi_by_category": _clean_query(b.events_dated, kpis.kpi_by_category),
    }
    for name in REGISTRY:
        roundtrip = "kpi_roundtrip" if name == "kpi_by_hour" else f"{name}_roundtrip"
        found[roundtrip] = _kpi_roundtrip(name)
    for suffix, binding in EXACT_BINDINGS.items():
        for name in ("kpi_global", "kpi_by_hour", "kpi_fraud_vs_normal"):
            found[name + suffix] = _clean_query(binding, REGISTRY[name].build)
        found["kpi_suite" + suffix] = _clean_query(binding, kpis.kpi_suite)
    for suffix, binding in KPI_BINDINGS.items():
        for name, kpi in REGISTRY.items():
            found[name + suffix] = _clean_query(binding, kpi.build)
        found["kpi_suite" + suffix] = _clean_query(binding, kpis.kpi_suite)
    for name in REGISTRY:
        found[f"conform_{name}"] = _conform(name)
    for build in (kpis.kpi_daily, kpis.kpi_by_category):
        found[f"conform_{build.__name__}"] = _conform_declared(build.__name__, build)
    return found


KPI_BINDINGS: dict[str, b.Binding] = {
    "": b.events,
    "_customer": b.customer,
    "_lineitem": b.lineitem,
}


# Where money sums need every digit.
EXACT_BINDINGS: dict[str, b.Binding] = {
    "_fine": b.events_fine,
    "_huge": b.events_huge,
    "_vast": b.events_vast,
}


def flagship(spark: SparkSession, folder: str) -> DataFrame:
    """All aggregate KPIs of the largest table, from raw rows, in one scan."""
    return kpis.kpi_suite(b.cleaned(b.lineitem, spark, folder))
