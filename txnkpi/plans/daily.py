"""The daily run: ingest, transform, publish, with a gate after each stage."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from txnkpi.operators import cleaning, profile, publishing, quality
from txnkpi.operators.conforming import conform
from txnkpi.operators.kpis import kpi_cells
from txnkpi.operators.sizing import sized, sized_for
from txnkpi.plans import run_figures
from txnkpi.plans.registry import REGISTRY, Kpi
from txnkpi.sources import paths, published, tables
from txnkpi.sources.raw_csv import infer_raw_schema, read_raw


@dataclass
class RunReport:
    """Sizes, row counts, failed checks and published versions of one run."""

    source_bytes: int = 0
    clean_files: int = 0
    counts: dict[str, int] = field(default_factory=dict)
    failed_checks: dict[str, list[str]] = field(default_factory=dict)
    published: list[tuple[str, str, int, int | None]] = field(default_factory=list)


def ingest(
    spark: SparkSession,
    raw_path: str,
    output: str,
    schema: StructType | str | None = None,
    rejects: bool = False,
    profiled: bool = False,
) -> dict[str, int]:
    """CSV to clean Parquet in one pass over the input; returns the row counts.

    The counts ride on the write, observed behind the shuffle where a task's figures
    count once even if it runs twice. With ``rejects`` refused rows are kept as well, see
    ``write_clean_and_rejects``. With ``profiled`` sketches of every column of the clean rows
    ride on the same write and are kept beside them; read them with ``read_profile``.
    """
    need_source(spark, raw_path)
    raw = read_raw(spark, raw_path, schema)
    with sized(raw):
        return (write_clean_and_rejects if rejects else write_clean)(raw, output, profiled)


def need_source(spark: SparkSession, raw_path: str) -> None:
    """An error when there is no raw input."""
    if not paths.exists(spark, raw_path):
        raise FileNotFoundError(f"no raw transactions at {raw_path}")


def write_clean(raw: DataFrame, output: str, profiled: bool = False) -> dict[str, int]:
    """Clean raw rows, write them and return the row counts."""
    seen, sketches = Observation(), Observation()
    counted = cleaning.count_copies(raw).observe(seen, *cleaning.report_columns())
    clean = cleaning.clean_counted(counted)
    schema = clean.schema
    if profiled:
        clean = clean.observe(sketches, *profile.measures(schema))
    tables.write(clean, tables.clean_path(output))
    if profiled:
        _write_profile(raw.sparkSession, schema, sketches, output)
    return dict(seen.get)


def _write_profile(spark: SparkSession, schema: StructType, seen: Observation, output: str) -> None:
    rows = profile.profile_of(spark, schema, seen.get).coalesce(1)
    tables.write(rows, tables.profile_path(output))


def read_profile(spark: SparkSession, output: str) -> DataFrame:
    """The kept profile of the clean rows; ``profile.merge`` and ``profile.report`` take it."""
    return tables.read(spark, tables.profile_path(output))


def write_clean_and_rejects(raw: DataFrame, output: str, profiled: bool = False) -> dict[str, int]:
    """Like ``write_clean``, with every refused row beside the clean ones.

    Both come out of one pass and one write: a table with a part of clean rows and a part of
    rejected ones (reason, file, text, rows). Read them with ``read_ingested``.
    """
    seen, sketches = Observation(), Observation()
    counted = cleaning.count_copies(raw, rejects=True).observe(seen, *cleaning.report_columns())
    kept = F.col(cleaning.FAULT).isNull()
    clean = cleaning.clean_counted(counted).columns
    rows = counted.withColumns(
        {
            "reason": F.col(cleaning.FAULT),
            "file": F.col(cleaning.FILE),
            "text": F.col(cleaning.TEXT),
            "rows": F.when(~kept, F.col(cleaning.COPIES)),
            tables.KIND: F.when(kept, "clean").otherwise("rejected"),
        }
    )
    taken = {*REJECT_COLUMNS, tables.KIND} & set(clean)
    if taken:
        raise ValueError(f"raw columns {sorted(taken)} clash with those of rejected rows")
    rows = rows.transform(cleaning.name_and_type).transform(cleaning.derive)
    schema = rows.select(*map(cleaning.quoted, clean)).schema
    rows = rows.select(*map(cleaning.quoted, clean), *REJECT_COLUMNS, tables.KIND)
    if profiled:
        rows = rows.observe(sketches, *profile.measures(schema, F.col(tables.KIND) == "clean"))
    rows.write.mode("overwrite").partitionBy(tables.KIND).parquet(tables.ingested_path(output))
    if profiled:
        _write_profile(raw.sparkSession, schema, sketches, output)
    return dict(seen.get)


REJECT_COLUMNS = ("reason", "file", "text", "rows")


def read_ingested(spark: SparkSession, output: str) -> tuple[DataFrame, DataFrame]:
    """Clean rows, and rejected ones (reason, file, text, rows), of the last such ingest."""
    rows = tables.read(spark, tables.ingested_path(output))
    kind = F.col(tables.KIND)
    return (
        rows.filter(kind == "clean").drop(*REJECT_COLUMNS, tables.KIND),
        rows.filter(kind == "rejected").select(*REJECT_COLUMNS),
    )


def transform(spark: SparkSession, output: str) -> None:
    """Clean Parquet to the KPI tables in two scans that run side by side.

    One scan makes the cells, written as a table since four KPIs and the gate read them;
    one filtered scan finds the top fraud amounts.
    """
    transactions = tables.read(spark, tables.clean_path(output))
    with sized_for(spark, paths.scanned_bytes(transactions), wide=False):
        scans = {tables.cells_path(output): kpi_cells(transactions)}
        for kpi in REGISTRY.values():
            if not kpi.from_cells:
                scans[tables.kpi_path(output, kpi.name)] = kpi.build(transactions)
        tables.write_all(scans)
    cells = tables.read_compact(spark, tables.cells_path(output))
    tables.write_all(
        {
            tables.kpi_path(output, kpi.name): kpi.build(cells, cells=True)
            for kpi in REGISTRY.values()
            if kpi.from_cells
        }
    )


def check_source(raw: DataFrame) -> DataFrame:
    """Gate over the raw input that looks for a first row: the counts come with ``ingest``."""
    return quality.gate_source(raw, count=False)


def check_ingest(spark: SparkSession, counts: dict[str, int]) -> DataFrame:
    """Gate over the counts of ``ingest``."""
    schema = ", ".join(f"{name} bigint" for name in counts)
    return quality.gate_ingest(spark.createDataFrame([tuple(counts.values())], schema))


def clean_files(spark: SparkSession, output: str) -> int:
    """Number of Parquet files of the clean transactions."""
    return paths.count(spark, paths.join(tables.clean_path(output), "*.parquet"))


def check_clean(spark: SparkSession, output: str) -> DataFrame:
    """Gate over the written cells: no further scan of the transactions."""
    return quality.gate_cells(tables.read_compact(spark, tables.cells_path(output)))


def check_kpis(spark: SparkSession, output: str) -> DataFrame:
    """Gate over the written KPI tables."""
    found = {
        kpi.name: tables.read_if_there(spark, tables.kpi_path(output, kpi.name), kpi.schema)
        for kpi in REGISTRY.values()
    }
    return quality.gate_kpis(spark, found)


def publish(
    spark: SparkSession,
    output: str,
    root: str,
    on_empty: str = publishing.KEEP,
    base: published.Snapshot | None = None,
) -> list[tuple[str, str, int, int | None]]:
    """Publish every KPI: (table, mode, rows, version or None), in registry order.

    All batches are checked in one job before any is written, and written side by side. Then
    one file puts all of them in force at once: readers see the tables of the run before or of
    this one, and a run that fails half-way changes nothing. If another run has published
    since ``base`` (by default the newest publication as this one starts), this one ends with
    ``PublishConflict``. An empty batch leaves its table as it is unless ``on_empty="clear"``.
    """
    base = base or published.snapshot(spark, root)
    batches = batches_of(spark, output)
    rows = publishing.checked_batches({n: (df, REGISTRY[n].key) for n, df in batches.items()})

    def staged(kpi: Kpi) -> published.Table:
        batch = batches[kpi.name]
        if kpi.key:
            target = published.read_table(spark, root, base.tables.get(kpi.name), kpi.schema)
            batch = publishing.upsert(target, batch, kpi.key)
        return published.stage(batch, root, kpi.name)

    changing = [k for k in REGISTRY.values() if publishing.replaces(rows[k.name], k.key, on_empty)]
    with ThreadPoolExecutor(len(batches)) as pool:
        changed = dict(zip([k.name for k in changing], pool.map(staged, changing), strict=True))
    version = published.commit(spark, root, base, changed) if changed else None
    return [
        (kpi.name, kpi.mode, rows[kpi.name], version if kpi.name in changed else None)
        for kpi in REGISTRY.values()
    ]


def batches_of(spark: SparkSession, output: str) -> dict[str, DataFrame]:
    """The written KPI tables by name, in their declared schemas."""
    return {
        kpi.name: conform(
            tables.read_compact(spark, tables.kpi_path(output, kpi.name), kpi.schema),
            kpi.schema,
        )
        for kpi in REGISTRY.values()
    }


def summary_frame(spark: SparkSession, root: str) -> DataFrame:
    """One row per table of the newest publication: (table, mode, rows in it)."""
    now = published.snapshot(spark, root)
    frames = [
        published.read_table(spark, root, now.tables.get(kpi.name), kpi.schema)
        .agg(F.count(F.lit(1)).alias("rows"))
        .select(F.lit(kpi.name).alias("table"), F.lit(kpi.mode).alias("mode"), "rows")
        for kpi in REGISTRY.values()
    ]
    first, *rest = frames
    for frame in rest:
        first = first.unionByName(frame)
    return first


def run_pipeline(
    spark: SparkSession,
    raw_path: str,
    output: str,
    root: str,
    schema: StructType | str | None = None,
    strict: bool = False,
    on_empty: str = publishing.KEEP,
    history: str | None = None,
    run: str | None = None,
) -> RunReport:
    """The whole daily run. ``strict`` stops at the first gate with a failed check.

    Without it checks are reported only. A source that is absent or lacks a required
    column ends the run either way. With a folder of past figures and a name for this run, its
    counts must lie where those of past runs did, and are kept there once all is published.
    """
    if (history is None) != (run is None):
        raise ValueError("a history needs the name of the run, and the other way round")
    report = RunReport()

    def gate(name: str, frame: DataFrame) -> None:
        report.failed_checks[name] = quality.enforce(frame, name, strict)

    need_source(spark, raw_path)
    schema = schema or infer_raw_schema(spark, raw_path)
    raw = read_raw(spark, raw_path, schema)
    report.source_bytes = paths.scanned_bytes(raw)
    gate("source", check_source(raw))
    report.counts = ingest(spark, raw_path, output, schema)
    gate("ingest", check_ingest(spark, report.counts))
    if history:
        figures = run_figures.of_counts(spark, report.counts)
        gate("history", quality.gate_history(run_figures.past(spark, history, run), figures))
    report.clean_files = clean_files(spark, output)
    transform(spark, output)
    gate("clean", check_clean(spark, output))
    gate("kpis", check_kpis(spark, output))
    report.published = publish(spark, output, root, on_empty)
    if history:
        run_figures.remember(run_figures.of_run(figures, run), history, run)
    return report
