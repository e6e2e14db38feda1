"""The named queries in plain SQL, written independently of the Spark plans.

Money is summed exactly, as 128-bit integers in units of 2^-60. Rounding goes through the
printed number, as a binary round would turn 1.005 into 1.0. Truncation is spelled out, as
a cast to integer rounds.
"""

from __future__ import annotations

EVENT_SECONDS = "cast(epoch_us(ts) - epoch_us(timestamp '{}') as double) / 1000000"
START = EVENT_SECONDS.format("2024-01-01 00:00:00")
MIDDLE = EVENT_SECONDS.format("2024-01-15 12:30:00")
ERROR = "case when event_type = 'error' then 1 else 0 end"


def _binding(time: str, amount: str, fraud: str, table: str, more: str = "") -> str:
    return (
        f'select {time} as "Time", {amount} as "Amount", {fraud} as "Class"{more} '
        f"from {table}"
    )


RETURNED = "case when l_returnflag = 'R' then 1 else 0 end"
MACHINERY = "case when c_mktsegment = 'MACHINERY' then 1 else 0 end"

RAW = {
    "events": _binding(START, "value", ERROR, "events"),
    "events_mid_month": _binding(MIDDLE, "value", ERROR, "events"),
    "events_wide": _binding(START, "value", ERROR, "events", ", user_id, event_type"),
    "events_dated": _binding(
        START,
        "value",
        ERROR,
        "events",
        ", cast(ts as date) as trans_date, event_type as category",
    ),
    "events_gaps": _binding(
        START,
        "case when value >= 10 then value end",
        "case when event_type = 'error' then 1 when event_type <> 'view' then 0 end",
        "events",
    ),
    "events_coarse": _binding(
        "cast(hour(ts) as double) * 3600",
        "cast(floor(value) as double)",
        ERROR,
        "events",
    ),
    "events_coarse_typed": _binding(
        "cast(hour(ts) as double) * 3600",
        "cast(floor(value) as double)",
        ERROR,
        "events",
        ", event_type",
    ),
    "events_fine": _binding(START, "value / 1e7", ERROR, "events"),
    "events_vast": _binding(
        START,
        "floor(value * 1024) / 1024 * case user_id % 3 when 0 then 18014398509481984.0::double "
        "when 1 then 1 / 1048576.0::double else 1.0::double end",
        ERROR,
        "events",
    ),
    "events_huge": _binding(
        START,
        "value * case user_id % 3 when 0 then 1e7 when 1 then 1e10 else 1.0::double end "
        "+ 0.0004::double",
        ERROR,
        "events",
    ),
    "events_sold": _binding(
        START,
        "value",
        ERROR,
        "events",
        ", cast(ts as date) as trans_date, event_type as category, "
        "'m' || cast(user_id % 50 as varchar) as merchant, "
        "case when user_id % 11 <> 0 then cast(user_id % 7 as varchar) end as state",
    ),
    "events_messy": _binding(
        "case when user_id % 13 = 0 then 'infinity'::double "
        "else cast(hour(ts) as double) * 3600 end",
        "cast(floor(value / 10) - 2 as double)",
        "case when user_id % 7 = 0 then null when user_id % 5 = 0 then 0.9::double "
        "when user_id % 11 = 0 then 1.9::double when user_id % 3 = 0 then 2.0::double "
        f"else cast({ERROR} as double) end",
        "events",
        ", event_type",
    ),
    "events_unreadable": _binding(
        START,
        f"case when fmod({START}, 7) < 1 then null else value end",
        ERROR,
        "events",
    ),
    "customer_unclean": _binding(
        "case when c_custkey % 9 <> 0 then cast(c_custkey as double) * 977 end",
        "case when c_custkey % 10 <> 0 then c_acctbal end",
        f"case when c_custkey % 8 = 0 then 7 else {MACHINERY} end",
        "customer",
    ),
    "customer": _binding(
        "cast(c_custkey as double) * 977", "c_acctbal", MACHINERY, "customer"
    ),
    "customer_honest": _binding(
        "cast(c_custkey as double) * 977", "c_acctbal", "0", "customer"
    ),
    "lineitem": _binding(
        "cast(l_orderkey as double) * 977", "l_extendedprice", RETURNED, "lineitem"
    ),
    "lineitem_early": _binding(
        "cast(l_linenumber as double) * 3600",
        "l_extendedprice",
        RETURNED,
        "lineitem",
    ),
    "orders_status": _binding(
        "cast(o_orderkey as double) * 977",
        "o_totalprice",
        "case when o_orderstatus = 'F' then 1 when o_orderstatus = 'P' then 2 else 0 end",
        "orders",
    ),
}

PRESENT = (
    '"Time" is not null and not isnan("Time") and "Amount" is not null '
    'and not isnan("Amount") and "Class" is not null'
)
FINITE = 'not isinf("Time")'
WHOLE = '"Class" = trunc("Class") and abs("Class") < 2147483648'
USABLE = f"{PRESENT} and {FINITE} and {WHOLE}"
HOUR = "cast(trunc({} / 3600 % 24) as integer)"
BUCKET = (
    "case when {0} < 10 then 'micro' when {0} < 100 then 'small' "
    "when {0} < 1000 then 'medium' else 'large' end"
)


def _clean(raw: str, pass_through: str = "") -> str:
    return (
        'select "Time" as trans_time, "Amount" as amount, '
        f'cast("Class" as integer) as is_fraud{pass_through}, '
        f"{HOUR.format(chr(34) + 'Time' + chr(34))} as trans_hour, "
        f"{BUCKET.format(chr(34) + 'Amount' + chr(34))} as amount_category "
        f'from (select distinct * from ({raw}) where {USABLE}) where "Amount" > 0'
    )


PASS_THROUGH = {
    "events_wide": ", user_id, event_type",
    "events_dated": ", trans_date, category",
    "events_coarse_typed": ", event_type",
    "events_messy": ", event_type",
    "events_sold": ", trans_date, category, merchant, state",
}
CLEAN = {name: _clean(raw, PASS_THROUGH.get(name, "")) for name, raw in RAW.items()}


def _round(value: str, places: int) -> str:
    printed = f"cast(cast({value} as varchar) as decimal(38,12))"
    return f"cast(round({printed}, {places}) as double)"


UNIT = "1152921504606846976"
SUM = (
    f"(sum(cast(trunc(amount) as hugeint)) * {UNIT}::hugeint + "
    f"sum(cast(round_even((amount - trunc(amount)) * {UNIT}::double, 0) as hugeint)))"
)
TOTAL = f"(cast(cast({SUM} as varchar) as double) / {UNIT}::double)"
# For amounts in whole units of 2^-30, up to 2^96 of them.
VAST_UNIT = "1073741824::double"
VAST_SUM = f"sum(cast(amount * {VAST_UNIT} as hugeint))"
VAST_TOTAL = f"(cast(cast({VAST_SUM} as varchar) as double) / {VAST_UNIT})"
FIGURES = {
    "nb_transactions": "count(trans_time)",
    "total_amount": _round(TOTAL, 2),
    "avg_amount": _round(f"{TOTAL} / count(amount)", 2),
    "min_amount": _round("min(amount)", 2),
    "max_amount": _round("max(amount)", 2),
    "nb_fraud": "cast(sum(is_fraud) as bigint)",
    "fraud_rate_pct": _round("avg(is_fraud) * 100", 4),
    "fraud_rate": "avg(is_fraud)",
}

VOLUME = ("nb_transactions", "total_amount", "avg_amount", "nb_fraud", "fraud_rate_pct")
KPI_FIGURES = {
    "kpi_global": (None, ("max_amount", *VOLUME)),
    "kpi_by_hour": ("trans_hour", VOLUME),
    "kpi_by_amount_category": ("amount_category", VOLUME),
    "kpi_fraud_vs_normal": (
        "is_fraud",
        ("nb_transactions", "total_amount", "avg_amount", "min_amount", "max_amount"),
    ),
}


def _kpi(name: str, clean: str) -> str:
    if name == "kpi_top_fraud_amounts":
        return (
            "select trans_time, amount, amount_category, trans_hour "
            f"from ({clean}) where is_fraud = 1 "
            "order by amount desc, trans_time, amount_category, trans_hour limit 20"
        )
    key, figures = KPI_FIGURES[name]
    columns = ", ".join(f"{FIGURES[f]} as {f}" for f in figures)
    if key is None:
        return f"select {columns} from ({clean})"
    return f"select {key}, {columns} from ({clean}) group by {key}"


def _suite(clean: str) -> str:
    names = [f for f in FIGURES if f != "fraud_rate"]
    columns = ", ".join(f"{FIGURES[f]} as {f}" for f in names)
    # Keys are copied, so that the class can be both grouped and summed.
    return (
        "select case when grouping(h) = 0 then 'kpi_by_hour' "
        "when grouping(c) = 0 then 'kpi_by_amount_category' "
        "when grouping(f) = 0 then 'kpi_fraud_vs_normal' else 'kpi_global' end as kpi, "
        f"h as trans_hour, c as amount_category, f as is_fraud, {columns} "
        "from (select trans_time, amount, is_fraud, trans_hour as h, "
        f"amount_category as c, is_fraud as f from ({clean})) "
        "group by grouping sets ((), (h), (c), (f))"
    )


def _narrow(kpi: str, counts: tuple[str, ...] = ("nb_transactions", "nb_fraud")) -> str:
    """A KPI with its counts as 32-bit integers."""
    narrowed = ", ".join(f"cast({c} as integer) as {c}" for c in counts)
    return f"select * replace ({narrowed}) from ({kpi})"


def _conform(name: str, clean: str) -> str:
    kpi = _kpi(name, clean)
    if name == "kpi_top_fraud_amounts":
        return kpi
    if name == "kpi_fraud_vs_normal":
        return _narrow(kpi, ("nb_transactions",))
    return _narrow(kpi)


def _upsert(name: str, old: str, new: str) -> str:
    key = KPI_FIGURES[name][0]
    old_sql, new_sql = _kpi(name, CLEAN[old]), _kpi(name, CLEAN[new])
    return (
        f"with old_rows as ({old_sql}), new_rows as ({new_sql}) "
        "select * from new_rows union all by name "
        f"select * from old_rows where {key} not in (select {key} from new_rows)"
    )


def _report(raw: str, corrupt: str = "false") -> str:
    kept = f'(select * from ({raw}) where {USABLE} and "Amount" > 0)'
    distinct = f"(select distinct * from {kept})"

    def rows(where: str) -> str:
        return f"(select count(*) from ({raw}) where {where})"

    return (
        f"select {rows('true')} as raw_rows, {rows(corrupt)} as corrupt_rows, "
        f"{rows(f'not ({PRESENT})')} as missing_rows, "
        f"{rows(f'{PRESENT} and not ({FINITE})')} as endless_time_rows, "
        f"{rows(f'{PRESENT} and {FINITE} and not ({WHOLE})')} as odd_class_rows, "
        f"{rows(USABLE + ' and not ' + chr(34) + 'Amount' + chr(34) + ' > 0')} "
        "as nonpositive_rows, "
        f"(select count(*) from {kept}) - (select count(*) from {distinct}) "
        "as duplicate_rows, "
        f"(select count(*) from {distinct}) as clean_rows"
    )


def _checks(rows: list[tuple[str, str, str]]) -> str:
    return " union all ".join(
        f'select \'{name}\' as "check", {passed} as passed, '
        f"cast({measured} as bigint) as measured"
        for name, passed, measured in rows
    )


def _gate_source(raw: str) -> str:
    count = f"(select count(*) from ({raw}))"
    columns = [(f"has_{name}", "true", "1") for name in ("time", "amount", "class")]
    return _checks([*columns, ("has_rows", f"{count} > 0", count)])


def _gate_clean(transactions: str) -> str:
    rules = {
        "no_missing_criticals": "trans_time is null or isnan(trans_time) "
        "or amount is null or isnan(amount) or is_fraud is null",
        "no_nonpositive_amounts": "amount <= 0",
        "no_hours_out_of_range": "not coalesce(trans_hour between 0 and 23, false)",
        "no_unknown_buckets": "amount_category not in "
        "('micro', 'small', 'medium', 'large')",
        "no_unknown_classes": "not coalesce(is_fraud in (0, 1), false)",
    }
    count = f"(select count(*) from ({transactions}))"
    checks = [("has_rows", f"{count} > 0", count)]
    for name, bad in rules.items():
        number = f"(select count(*) from ({transactions}) where {bad})"
        checks.append((name, f"{number} = 0", number))
    return _checks(checks)


def _gate_ingest(raw: str) -> str:
    report = _report(raw)
    checks = [
        ("has_clean_rows", "clean_rows", ">"),
        ("no_odd_classes", "odd_class_rows", "="),
        ("no_endless_times", "endless_time_rows", "="),
    ]
    value = "(select {} from (" + report + "))"
    return _checks(
        [(name, f"{value.format(c)} {sign} 0", value.format(c)) for name, c, sign in checks]
    )


def _gate_kpis(clean: str, missing: tuple[str, ...] = ()) -> str:
    names = [*KPI_FIGURES, "kpi_top_fraud_amounts"]
    return _checks(
        [
            (n, "false", "null")
            if n in missing
            else (n, "true", f"(select count(*) from ({_kpi(n, clean)}))")
            for n in names
        ]
    )


def _summary(old: str, new: str) -> str:
    """Rows in each published table after publishing ``old``, then ``new``."""
    parts = []
    for name in [*KPI_FIGURES, "kpi_top_fraud_amounts"]:
        if KPI_FIGURES.get(name, (None,))[0]:
            mode, rows = "upsert", _upsert(name, old, new)
        else:
            mode, rows = "refresh", _kpi(name, CLEAN[new])
        parts.append(
            f"select '{name}' as \"table\", '{mode}' as mode, count(*) as rows "
            f"from ({rows})"
        )
    return " union all ".join(parts)


def _rejects(raw: str) -> str:
    """Refused rows by reason, clean rows and copies of clean rows."""
    usable = f'{USABLE} and "Amount" > 0'
    reason = (
        f"case when not ({PRESENT}) then 'missing' when not ({FINITE}) then 'endless_time' "
        f"when not ({WHOLE}) then 'odd_class' else 'nonpositive' end"
    )
    kept = f"(select count(*) from ({raw}) where {usable})"
    distinct = f"(select count(*) from (select distinct * from ({raw}) where {usable}))"
    return (
        f"select *, (select count(*) from ({raw})) as raw_rows from ("
        f"select {reason} as reason, count(*) as rows, count(distinct (r)) as texts "
        f"from ({raw}) as r where not ({usable}) is not false group by all "
        f"union all select 'clean', {distinct}, {distinct} "
        f"union all select 'duplicate', {kept} - {distinct}, 0)"
    )


def _gate_history(dated: str) -> str:
    """Days before the 20th as runs, against a fifth of that day's rows."""
    names = ("clean_rows", "categories", "hours")
    figures = (
        "select cast(trans_date as varchar) as run, count(*) as clean_rows, "
        "count(distinct category) as categories, count(distinct trans_hour) as hours "
        f"from ({dated}) where trans_date < date '2024-01-20' "
        "or (trans_date = date '2024-01-20' and cast(floor(trans_time) as bigint) % 5 = 0) group by run"
    )
    long = " union all ".join(
        f"select run, '{n}' as \"check\", {n} as measured from figures" for n in names
    )
    return (
        f"with figures as ({figures}), long as ({long}), past as ("
        "select \"check\", count(*) as runs, median(measured) as middle, "
        "greatest(mad(measured) * 1.4826::double * 5, abs(median(measured)) * 0.1::double) as half "
        "from long where run < '2024-01-20' group by \"check\") "
        "select \"check\", measured between middle - half and middle + half as passed, measured, "
        "runs, middle - half as low, middle + half as high "
        "from long join past using (\"check\") where run = '2024-01-20'"
    )


def _profile(rows: str, columns: dict[str, bool], exact: bool) -> str:
    """Figures of every column; numeric ones have an order."""
    parts = []
    for name, numeric in columns.items():
        c = f'"{name}"'
        ends = [f"cast({f}({c}) as double)" if numeric else "null::double" for f in ("min", "max")]
        figures = f"{ends[0]} as least, {ends[1]} as highest, "
        if exact:
            figures += f'count(distinct {c}) as "distinct"'
            for cut, label in ((0.25, "q25"), (0.5, "median"), (0.75, "q75")):
                value = f"cast(quantile_disc({c}, {cut}) as double)" if numeric else "null::double"
                figures += f", {value} as {label}"
        else:
            figures += "true as distinct_within, true as median_within"
        parts.append(f"select '{name}' as \"column\", count({c}) as rows, {figures} from ({rows})")
    return " union all ".join(parts)


NUMBERS = {"trans_time": True, "amount": True, "is_fraud": True, "user_id": True}


def oracle_sql() -> dict[str, str]:
    """SQL by query name."""
    named = "cast(\"Time\" as double) as trans_time"
    wide, customer = CLEAN["events_wide"], RAW["customer"]
    unclean = (
        'select "Time" as trans_time, "Amount" as amount, "Class" as is_fraud, '
        + HOUR.format('"Time"')
        + " as trans_hour, "
        + BUCKET.format('"Amount"')
        + f" as amount_category from ({RAW['customer_unclean']})"
    )
    hours = f"select {named}, {HOUR.format(chr(34) + 'Time' + chr(34))} as trans_hour from "
    daily = ("nb_transactions", "total_amount", "nb_fraud", "fraud_rate")
    by_date = ", ".join(f"{FIGURES[f]} as {f}" for f in daily)
    by_category = ", ".join(f"{FIGURES[f]} as {f}" for f in daily[:3])
    dated = CLEAN["events_dated"]
    found = {
        "csv_ingest": wide,
        "csv_ingest_inferred": "select * replace (cast(user_id as integer) as user_id) "
        f"from ({wide})",
        "csv_ingest_report": _report(RAW["events_gaps"]),
        "clean_roundtrip": wide,
        "csv_ingest_report_unreadable": _report(
            RAW["events_unreadable"], '"Amount" is null'
        ),
        "daily_ingest": CLEAN["events_messy"],
        "daily_ingest_counts": _report(RAW["events_messy"]),
        "clean_null_drop": f"select * from ({RAW['events_gaps']}) where {USABLE}",
        "clean_dedup": f"select distinct * from ({RAW['events_coarse']})",
        "clean_dedup_wide": f"select distinct * from ({RAW['events_coarse_typed']})",
        "clean_positive": f'select * from ({customer}) where "Amount" > 0',
        "derive_trans_hour": f"{hours} ({RAW['events']})",
        "derive_trans_hour_negative": f"{hours} ({RAW['events_mid_month']})",
        "derive_amount_category": f'select "Amount" as amount, '
        f"{BUCKET.format(chr(34) + 'Amount' + chr(34))} as amount_category "
        f"from ({customer})",
        "clean_transactions": wide,
        "clean_transactions_coarse": CLEAN["events_coarse"],
        "clean_transactions_gaps": CLEAN["events_gaps"],
        "clean_transactions_coarse_typed": CLEAN["events_coarse_typed"],
        "clean_transactions_messy": CLEAN["events_messy"],
        "ingest_report": _report(RAW["events_coarse"]),
        "ingest_report_messy": _report(RAW["events_messy"]),
        "gate_ingest": _gate_ingest(RAW["events_messy"]),
        "gate_source": _gate_source(RAW["events"]),
        "gate_clean": _gate_clean(CLEAN["events"]),
        "gate_clean_unclean": _gate_clean(unclean),
        "gate_kpis": _gate_kpis(CLEAN["events"]),
        "gate_kpis_missing": _gate_kpis(CLEAN["events"], ("kpi_global", "kpi_by_hour")),
        "upsert_by_hour": _upsert("kpi_by_hour", "events", "lineitem_early"),
        "upsert_by_amount_category": _upsert(
            "kpi_by_amount_category", "customer", "events"
        ),
        "upsert_fraud_vs_normal": _upsert(
            "kpi_fraud_vs_normal", "orders_status", "lineitem"
        ),
        "refresh_global": _kpi("kpi_global", CLEAN["events"]),
        "refresh_top_fraud": _kpi("kpi_top_fraud_amounts", CLEAN["events"]),
        "refresh_empty_keeps_old": _kpi("kpi_top_fraud_amounts", CLEAN["events"]),
        "publish_summary": _summary("customer", "events"),
        "publish_snapshot": f"select *, 2 as version from ({_summary('customer', 'events')})",
        "upsert_bucketed": "select trans_time, is_fraud, "
        "case when n % 5 = 0 then amount + 1 else amount end as amount from ("
        f"select *, cast(trans_time / 977 as bigint) as n from ({CLEAN['customer']})) "
        "where n % 3 <> 0 or n % 5 = 0",
        "transactions_by_day": "select trans_date, category, is_fraud, merchant, state, "
        "case when trans_date >= date '2024-01-11' then amount else amount * 2 end as amount "
        f"from ({CLEAN['events_sold']})",
        "kpi_daily_of_one_day": f"select trans_date, {by_date} from ({dated}) "
        "where trans_date = date '2024-01-15' group by trans_date",
        "clean_dedup_history": f"select * from ({RAW['events_coarse_typed']}) "
        f"except select * from ({RAW['events_coarse_typed']} where event_id % 2 = 0)",
        "kpi_suite_incremental": _suite(CLEAN["events"]),
        "kpi_top_fraud_incremental": _kpi("kpi_top_fraud_amounts", CLEAN["events"]),
        "ingest_rejects": _rejects(RAW["events_messy"]),
        "ingest_profile": _profile(
            wide, {**NUMBERS, "event_type": False, "trans_hour": True, "amount_category": False}, False
        ),
        "profile_exact": _profile(
            RAW["events_wide"],
            {"Time": True, "Amount": True, "Class": True, "user_id": True, "event_type": False},
            True,
        ),
        "gate_history": _gate_history(dated),
        "read_evolved": "select event_id, user_id, case when day(ts) <= 10 "
        "then cast(cast(value as float) as double) else value end as value, "
        "case when day(ts) > 20 then event_type end as event_type from events",
        "kpi_daily": f"select trans_date, {by_date} from ({dated}) group by trans_date",
        "kpi_by_category": f"select category, {by_category} from ({dated}) "
        "group by category",
    }
    for name in [*KPI_FIGURES, "kpi_top_fraud_amounts"]:
        roundtrip = "kpi_roundtrip" if name == "kpi_by_hour" else f"{name}_roundtrip"
        found[roundtrip] = _kpi(name, CLEAN["lineitem"])
    for suffix in ("fine", "huge", "vast"):
        clean = CLEAN[f"events_{suffix}"]
        total = VAST_TOTAL if suffix == "vast" else TOTAL
        for name in ("kpi_global", "kpi_by_hour", "kpi_fraud_vs_normal"):
            found[f"{name}_{suffix}"] = _kpi(name, clean).replace(TOTAL, total)
        found[f"kpi_suite_{suffix}"] = _suite(clean).replace(TOTAL, total)
    for binding in ("events", "customer", "lineitem"):
        suffix = "" if binding == "events" else f"_{binding}"
        for name in [*KPI_FIGURES, "kpi_top_fraud_amounts"]:
            found[name + suffix] = _kpi(name, CLEAN[binding])
        found["kpi_suite" + suffix] = _suite(CLEAN[binding])
    for name in [*KPI_FIGURES, "kpi_top_fraud_amounts"]:
        found[f"conform_{name}"] = _conform(name, CLEAN["events"])
    for name in ("kpi_daily", "kpi_by_category"):
        found[f"conform_{name}"] = _narrow(found[name])
    return found
