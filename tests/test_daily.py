"""The daily run from CSV to published tables, its gates, sizing and command line."""

from __future__ import annotations

import json

import pytest
from conftest import DATA, EDGE_ROWS

from txnkpi import __main__ as cli
from txnkpi.operators import quality
from txnkpi.operators import sizing as scale
from txnkpi.plans import bindings, daily
from txnkpi.plans.registry import REGISTRY
from txnkpi.sources import paths, published, tables
from txnkpi.sources.raw_csv import infer_raw_schema, read_raw


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_run_from_csv(spark, edge_csv, tmp_path):
    output, root = str(tmp_path / "out"), str(tmp_path / "published")
    report = daily.run_pipeline(spark, edge_csv, output, root)
    assert report.source_bytes == len(EDGE_ROWS)
    written = list((tmp_path / "out" / "transactions_clean").glob("*.parquet"))
    assert report.clean_files == len(written) > 0
    assert report.counts == {
        "raw_rows": 19,
        "corrupt_rows": 1,
        "missing_rows": 5,
        "endless_time_rows": 0,
        "odd_class_rows": 0,
        "nonpositive_rows": 2,
        "duplicate_rows": 2,
        "clean_rows": 10,
    }
    assert report.failed_checks == {
        "source": [],
        "ingest": [],
        "clean": ["no_hours_out_of_range"],
        "kpis": [],
    }
    assert [(name, n) for name, _, n, _ in report.published] == [
        ("kpi_global", 1),
        ("kpi_by_hour", 5),
        ("kpi_by_amount_category", 4),
        ("kpi_fraud_vs_normal", 2),
        ("kpi_top_fraud_amounts", 4),
    ]
    name = "kpi_fraud_vs_normal"
    assert rows(published.read_published(spark, root, name, REGISTRY[name].schema)) == [
        (0, 6, 1222.64, 203.77, 2.68, 999.99),
        (1, 4, 6012.68, 1503.17, 2.68, 5000.0),
    ]


def test_written_kpis_equal_direct_ones(spark, tmp_path):
    output = str(tmp_path)
    daily.write_clean(bindings.lineitem(spark, f"{DATA}/sf0.01"), output)
    daily.transform(spark, output)
    transactions = bindings.cleaned(bindings.lineitem, spark, f"{DATA}/sf0.01")
    for kpi in REGISTRY.values():
        written = tables.read(spark, tables.kpi_path(output, kpi.name))
        assert written.schema == kpi.schema
        assert rows(written) == rows(kpi.build(transactions))


def test_second_run_replaces_stage_tables(spark, edge_csv, tmp_path):
    output, root = str(tmp_path / "out"), str(tmp_path / "published")
    first = daily.run_pipeline(spark, edge_csv, output, root)
    second = daily.run_pipeline(spark, edge_csv, output, root)
    assert first.counts == second.counts
    assert {v for *_, v in second.published} == {2}


def test_strict_run_stops_at_the_failed_gate(spark, edge_csv, tmp_path):
    root = str(tmp_path / "published")
    with pytest.raises(quality.GateError, match="clean: no_hours_out_of_range"):
        daily.run_pipeline(spark, edge_csv, str(tmp_path / "out"), root, strict=True)
    assert published.current_version(spark, root, "kpi_global") is None


def test_header_without_rows(spark, tmp_path):
    raw = tmp_path / "raw.csv"
    raw.write_text("Time,Amount,Class\n")
    root = str(tmp_path / "published")
    report = daily.run_pipeline(spark, str(raw), str(tmp_path / "out"), root)
    assert report.counts["raw_rows"] == 0
    assert report.failed_checks["source"] == ["has_rows"]
    assert [v for *_, v in report.published] == [1, None, None, None, None]


def test_absent_source(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        daily.ingest(spark, str(tmp_path / "none.csv"), str(tmp_path / "out"))


def test_missing_column(spark, tmp_path):
    raw = tmp_path / "raw.csv"
    raw.write_text("Time,Amount\n1,2\n")
    with pytest.raises(Exception, match="UNRESOLVED_COLUMN"):
        daily.ingest(spark, str(raw), str(tmp_path / "out"))


def test_gate_kpis_names_absent_tables(spark, edge_csv, tmp_path):
    output = str(tmp_path)
    daily.ingest(spark, edge_csv, output)
    daily.transform(spark, output)
    found = {
        name: tables.read_if_there(spark, tables.kpi_path(output, name)) for name in REGISTRY
    }
    found["kpi_global"] = None
    report = quality.gate_kpis(spark, found)
    assert report.count() == 5
    assert quality.failed(report) == ["kpi_global"]
    empty = {name: None for name in REGISTRY}
    assert len(quality.failed(quality.gate_kpis(spark, empty))) == 5


def test_half_written_kpi_is_reported(spark, edge_csv, tmp_path):
    output = str(tmp_path)
    daily.ingest(spark, edge_csv, output)
    daily.transform(spark, output)
    folder = tmp_path / "kpis" / "kpi_global"
    for path in folder.iterdir():
        path.unlink()
    (folder / "_temporary").mkdir()
    assert quality.failed(daily.check_kpis(spark, output)) == ["kpi_global"]


def test_source_gate_starts_one_task(spark, tmp_path):
    for i in range(40):
        (tmp_path / f"{i}.csv").write_text(EDGE_ROWS)
    schema = "Time double, V1 double, Amount double, Class double"
    raw = read_raw(spark, str(tmp_path), schema)
    context = spark.sparkContext
    context.setJobGroup("source-gate", "")
    gate = daily.check_source(raw)
    context.setLocalProperty("spark.jobGroup.id", None)
    tracker = context.statusTracker()
    jobs = [tracker.getJobInfo(j) for j in tracker.getJobIdsForGroup("source-gate")]
    tasks = [tracker.getStageInfo(s).numTasks for job in jobs for s in job.stageIds]
    assert tasks == [1]
    assert {r["check"]: r["measured"] for r in gate.collect()}["has_rows"] is None
    assert quality.failed(gate) == []


def test_each_gate_is_looked_at_once(spark, edge_csv, tmp_path, monkeypatch):
    seen = []
    failed = quality.failed
    monkeypatch.setattr(quality, "failed", lambda report: seen.append(1) or failed(report))
    rows = EDGE_ROWS.replace("-7200", "7200")
    (tmp_path / "raw.csv").write_text(rows)
    raw, output = str(tmp_path / "raw.csv"), str(tmp_path / "out")
    daily.run_pipeline(spark, raw, output, str(tmp_path / "published"), strict=True)
    assert len(seen) == 4


def test_strict_stages_end_with_an_error(spark, edge_csv, tmp_path):
    output, target = str(tmp_path / "out"), str(tmp_path / "published")
    common = ["--output", output, "--target", target]
    odd = tmp_path / "odd.csv"
    odd.write_text("Time,Amount,Class\n0,5,0.9\n0,5,1\n")

    def stage(name, *more):
        cli.run_stage(spark, cli.arguments([name, *common, *more]))

    stage("ingest", "--raw", str(odd))
    with pytest.raises(quality.GateError, match="ingest: no_odd_classes"):
        stage("ingest", "--raw", str(odd), "--strict")
    stage("ingest", "--raw", edge_csv, "--strict")
    stage("transform")
    with pytest.raises(quality.GateError, match="clean: no_hours_out_of_range"):
        stage("transform", "--strict")
    (tmp_path / "out" / "kpis" / "kpi_by_hour" / "_SUCCESS").unlink()
    with pytest.raises(quality.GateError, match="kpis: kpi_by_hour"):
        stage("publish", "--strict")
    assert published.current_version(spark, target, "kpi_global") is None


def test_run_passes_on_what_to_do_when_empty(spark, edge_csv, tmp_path):
    output, target = str(tmp_path / "out"), str(tmp_path / "published")
    quiet = tmp_path / "quiet.csv"
    quiet.write_text("Time,Amount,Class\n0,5,0\n")
    common = ["run", "--output", output, "--target", target, "--raw"]
    for raw, more, version in (
        (edge_csv, [], 1),
        (str(quiet), [], 1),
        (str(quiet), ["--on-empty", "clear"], 3),  # the third publication
    ):
        cli.run_stage(spark, cli.arguments([*common, raw, *more]))
        assert published.current_version(spark, target, "kpi_top_fraud_amounts") == version


def test_compressed_text_counts_for_more(spark, tmp_path):
    rows = spark.range(20_000).selectExpr("id as Time", "id + 0.5 as Amount", "0 as Class")
    sizes = {}
    for kind in ("none", "gzip"):
        path = str(tmp_path / kind)
        rows.coalesce(2).write.csv(path, header=True, compression=kind)
        scan = spark.read.csv(path, header=True)
        sizes[kind] = paths.scanned_bytes(scan), paths.text_bytes(scan)
    assert sizes["none"][0] == sizes["none"][1]
    assert sizes["gzip"][0] < sizes["none"][0] <= sizes["gzip"][1]


def test_directory_and_glob_sources(spark, tmp_path):
    for name in ("a.csv", "b.csv"):
        (tmp_path / name).write_text(EDGE_ROWS)
    for i, raw in enumerate((str(tmp_path), str(tmp_path / "*.csv"))):
        counts = daily.ingest(spark, raw, str(tmp_path.parent / f"{tmp_path.name}-out{i}"))
        assert (counts["raw_rows"], counts["clean_rows"]) == (38, 10)
        scan = spark.read.csv(raw, header=True)
        assert paths.scanned_bytes(scan) == 2 * len(EDGE_ROWS)
    assert paths.count(spark, str(tmp_path / "*.csv")) == 2


def test_command_line_stages(spark, edge_csv, tmp_path, capsys):
    schema = tmp_path / "schema.json"
    cli.run_stage(spark, cli.arguments(["schema", "--raw", edge_csv]))
    schema.write_text(capsys.readouterr().out)
    assert json.loads(schema.read_text()) == infer_raw_schema(spark, edge_csv).jsonValue()
    output, target = str(tmp_path / "out"), str(tmp_path / "published")
    common = ["--output", output, "--target", target]
    cli.run_stage(
        spark,
        cli.arguments(["ingest", "--raw", edge_csv, "--schema", str(schema), *common]),
    )
    cli.run_stage(spark, cli.arguments(["transform", *common]))
    cli.run_stage(spark, cli.arguments(["publish", *common]))
    printed = capsys.readouterr().out
    assert "'clean_rows': 10" in printed
    assert "kpi_by_hour upsert 5 1" in printed
    cli.run_stage(spark, cli.arguments(["run", "--raw", edge_csv, *common]))
    assert published.current_version(spark, target, "kpi_by_hour") == 2


def test_command_line_needs_paths(monkeypatch):
    for name in ("RAW_DATA_PATH", "OUTPUT_PATH", "PUBLISH_PATH"):
        monkeypatch.delenv(name, raising=False)
    with pytest.raises(SystemExit):
        cli.arguments(["ingest"])
    monkeypatch.setenv("RAW_DATA_PATH", "/in.csv")
    monkeypatch.setenv("OUTPUT_PATH", "/out")
    assert cli.arguments(["ingest"]).raw == "/in.csv"


def test_settings_follow_the_input_size():
    split = 128 * scale.MiB
    small = scale.settings_for(10**6, 200, split)
    assert small == {scale.SHUFFLE: "200", scale.SPLIT: str(split)}
    big = scale.settings_for(100 * 1024**4, 200, split)
    assert big == {scale.SHUFFLE: "32768", scale.SPLIT: str(512 * scale.MiB)}
    middle = scale.settings_for(1024**4, 200, split)
    assert middle[scale.SHUFFLE] == "4096"
    assert scale.settings_for(1024**4, 200, split, wide=False)[scale.SHUFFLE] == "200"


def test_settings_are_restored(spark):
    before = {k: spark.conf.get(k) for k in (scale.SHUFFLE, scale.SPLIT)}
    with scale.sized_for(spark, 1024**4):
        assert spark.conf.get(scale.SHUFFLE) == "4096"
    assert {k: spark.conf.get(k) for k in before} == before
    for text, size in (("128MB", 2**27), ("1g", 2**30), ("77b", 77), ("5", 5)):
        assert scale._bytes(text) == size


def test_scratch_lies_in_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir", None)
    shared = shared or spark.sparkContext.getCheckpointDir()
    assert paths.scratch(spark, "x").startswith(shared)
    assert paths.scratch(spark, "x") != paths.scratch(spark, "x")
