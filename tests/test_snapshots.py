"""Snapshot tables, the look-back state, retained history and partial sums per file."""

import datetime as dt
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from adlens.operators import daily, reports, summary
from adlens.plans import jobs
from adlens.schema import TRAFFIC_RAW
from adlens.session import scratch_path
from adlens.sources import history, lookback, readers, snapshots
from adlens.sources.adapter import ad_tables
from adlens.sources.snapshots import ConflictError, SnapshotTable
from adlens.streaming import deltas
from adlens.streaming.refresh import refresh_flags, start_daily_refresh
from tests.conftest import SF001
from tests.fixtures import CONVERSION_COLUMNS, CONVERSION_ROWS, TRAFFIC_ROWS, tables


def rows_of(df, columns=None):
    return sorted(map(tuple, df.select(*(columns or df.columns)).collect()), key=str)


def failing(df):
    """The same rows, but the tasks that write them die half-way."""
    return df.withColumn("id", F.when(F.col("id") == 90, F.raise_error(F.lit("disk full"))).otherwise(F.col("id")).cast("long"))


@pytest.fixture()
def numbers(spark):
    return spark.range(100).withColumn("day", (F.col("id") % 4).cast("int"))


def test_versions_replace_touch_and_append(spark, numbers):
    table = SnapshotTable(spark, scratch_path(spark, "snapshot"))
    assert table.current() is None
    table.commit(numbers, ["day"])
    table.commit(numbers.filter("day = 1").limit(5), ["day"], "touched")
    assert table.read().groupBy("day").count().orderBy("day").collect() == [(0, 25), (1, 5), (2, 25), (3, 25)]
    table.commit(numbers.filter("day = 1"), ["day"], "append")
    assert table.read().filter("day = 1").count() == 30
    table.commit(numbers.filter("day = 2"), ["day"], "all")
    assert table.read().select("day").distinct().collect() == [(2,)] and table.read().dtypes == numbers.dtypes
    table.commit(numbers.limit(0), ["day"], "all")
    assert table.read().count() == 0 and table.read().dtypes == numbers.dtypes


def test_a_failing_write_leaves_every_table_as_it_was(spark, numbers):
    for replace in ("all", "touched", "append"):
        table = SnapshotTable(spark, scratch_path(spark, "failing"))
        table.commit(numbers, ["day"])
        before, listed = rows_of(table.read()), table.files.children(table.path)
        with pytest.raises(Exception, match="disk full"):
            table.commit(failing(numbers), ["day"], replace)
        assert rows_of(table.read()) == before and table.files.children(table.path) == listed
    for columns, whole in ((["day"], True), (["day"], False), (None, True)):  # plain files
        path = scratch_path(spark, "failing-plain")
        readers.write_table(numbers, path, "parquet", columns)
        with pytest.raises(Exception, match="disk full"):
            readers.write_table(failing(numbers), path, "parquet", columns, replace_all=whole)
        assert rows_of(spark.read.parquet(path), ["id", "day"]) == rows_of(numbers, ["id", "day"])
        readers.write_table(numbers.filter("id < 8 and day < 2"), path, "parquet", columns, replace_all=whole)
        assert spark.read.parquet(path).count() == (4 if whole else 54)


def test_a_daily_job_that_fails_while_it_writes_leaves_the_old_table(spark, monkeypatch):
    traffic, conversion = tables(spark)
    path = scratch_path(spark, "failing-job")
    before = rows_of(jobs.daily_job(spark, traffic, conversion, path)["table"])
    broken = traffic.withColumn("cost", F.when(F.col("event_date") == "2025-03-10", F.raise_error(F.lit("disk full"))).otherwise(F.col("cost")).cast("decimal(18,4)"))
    for since in (None, "2025-03-10"):
        with pytest.raises(Exception, match="disk full"):
            jobs.daily_job(spark, broken, conversion, path, since=since)
        assert rows_of(readers.read_parquet(spark, path)) == before


def test_a_pointer_that_breaks_off_does_not_count(spark, numbers):
    table = SnapshotTable(spark, scratch_path(spark, "broken-pointer"))
    table.commit(numbers.limit(10))
    assert table.files.create(f"{table.path}/_versions/{2:012d}", '{"number": 2, "par')
    assert table.current().number == 1 and table.read().count() == 10
    assert table.commit(numbers.limit(20)).number == 3 and table.read().count() == 20
    assert not table.files.create(f"{table.path}/_versions/{3:012d}", "x")  # a number is given once


def test_writers_from_one_version_conflict_or_start_over(spark, numbers):
    table = SnapshotTable(spark, scratch_path(spark, "conflict"))
    base = table.commit(numbers.limit(10))
    other = SnapshotTable(spark, table.path)
    other.commit(numbers.limit(3), replace="append")
    with pytest.raises(ConflictError):
        table.commit(numbers.limit(5), base=base, must_follow=True)
    assert table.read().count() == 13
    table.commit(numbers.limit(5), replace="append", base=base)
    assert table.read().count() == 18


def test_old_versions_go_with_their_folders(spark, numbers):
    table = SnapshotTable(spark, scratch_path(spark, "expire"))
    for k in range(12):
        table.commit(numbers.limit(k + 1), side={"note": numbers.limit(1)})
    names = table.files.children(table.path)
    assert len([n for n in names if n.startswith("commit=")]) == snapshots.KEEP_VERSIONS
    assert len(table.files.children(f"{table.path}/_side")) == snapshots.KEEP_VERSIONS
    assert table.read().count() == 12 and table.side("note").count() == 1


# ------------------------------------------------------------------ look-back state

def test_refreshes_with_the_state_equal_a_full_run_and_read_few_partitions(spark, monkeypatch):
    monkeypatch.setattr(lookback, "STEP_DAYS", 4)
    traffic, conversion = ad_tables(spark, SF001)
    path, first = scratch_path(spark, "state"), dt.date(2024, 1, 10)
    upto = lambda df, day: df.filter(F.col("event_date") < F.lit(day))
    jobs.daily_job(spark, upto(traffic, first), upto(conversion, first), path)
    table, used = SnapshotTable(spark, path), 0
    perf = daily.daily_performance(traffic, conversion).columns
    # Day after day, once a late delivery from before the state's date, once a gap.
    for since, until in ((10, 11), (11, 12), (12, 13), (13, 16), (8, 17), (16, 18), (18, 25), (24, 31)):
        since, until = dt.date(2024, 1, since), dt.date(2024, 1, until)
        note = table.current().notes.get(lookback.STATE)
        earlier, _, _ = lookback.rows_before(table, table.current(), lambda: table.read().select(perf), since, 7)
        plan = earlier._jdf.queryExecution().executedPlan().toString()
        assert f"< {since}" in plan  # partitions of the table, from the state's date on where it serves
        if note and dt.date.fromisoformat(note["before"]) <= since:
            used += 1
            assert f">= {note['before']}" in plan and "PartitionFilters: [isnotnull(date" in plan
        jobs.daily_job(spark, upto(traffic, until), upto(conversion, until), path, since=since)
        full = daily.anomalies(daily.performance_trends(daily.daily_performance(upto(traffic, until), upto(conversion, until))))
        assert rows_of(table.read(), full.columns) == rows_of(full)
        assert (since - dt.date.fromisoformat(table.current().notes[lookback.STATE]["before"])).days <= lookback.STEP_DAYS
    assert used == 6
    assert table.side(lookback.STATE).groupBy(*daily.SERIES_KEYS).count().agg(F.max("count")).first()[0] <= 7


def test_flags_refresh_keeps_its_state(spark):
    traffic, conversion = ad_tables(spark, SF001)
    perf = daily.daily_performance(traffic, conversion)
    root = scratch_path(spark, "flags-state")
    readers.write_table(perf, f"{root}/daily", "parquet", ["date"])
    full = daily.anomalies(daily.performance_trends(perf))
    for day in (1, 20, 21, 5, 25):
        refresh_flags(spark, f"{root}/daily", f"{root}/flags", dt.date(2024, 1, day))
        assert rows_of(readers.read_parquet(spark, f"{root}/flags"), full.columns) == rows_of(full)


# ------------------------------------------------------------------ history

def test_history_stays_few_files_and_retries_stay_exact(spark, monkeypatch):
    monkeypatch.setattr(history, "COMPACT_AFTER", 4)
    traffic, conversion = tables(spark)
    one = summary.account_summary(reports.ad_group_report(traffic, conversion, "today", "2025-03-10")).checkpoint()
    path, base = scratch_path(spark, "history-store"), dt.datetime(2025, 1, 1)
    for k in range(40):
        stamp = base + dt.timedelta(days=k)
        if k % 7 == 0:  # a wrong run, then its retry
            history.history_append(one.withColumn("total_clicks", F.lit(-1).cast("long")), path, "a", stamp)
        history.history_append(one.withColumn("total_clicks", F.lit(k).cast("long")), path, "a", stamp)
    history.history_append(one, path, "b", base)
    table = SnapshotTable(spark, path)
    assert len(table.current().folders()) <= 4 and table.read().count() <= history.HISTORY_KEEP + 2 * 4
    assert len(table.files.data_files(path)) <= 4 * (4 + snapshots.KEEP_VERSIONS)
    got = {r.timestamp: r.total_clicks for r in history.history_read(spark, path).filter("account_id = 'a'").collect()}
    assert got == {base + dt.timedelta(days=k): k for k in range(10, 40)}
    assert history.history_read(spark, path).filter("account_id = 'b'").count() == 1


def test_history_of_plain_files_is_still_read_and_appended_to(spark):
    traffic, conversion = tables(spark)
    one = summary.account_summary(reports.ad_group_report(traffic, conversion, "today", "2025-03-10"))
    path = scratch_path(spark, "history-plain")
    entries = history.as_history(one, "a", dt.datetime(2025, 1, 1)).withColumn("written_at", F.localtimestamp())
    entries.write.parquet(path)
    history.history_append(one, path, "a", dt.datetime(2025, 1, 2))
    assert history.history_read(spark, path).count() == 2


# ------------------------------------------------------------------ partial sums per file

def _filed(spark, seed):
    """The adapter's rows as if delivered in files: late rows of a date come in later files."""
    traffic, conversion = ad_tables(spark, SF001)
    file = lambda df: df.withColumn(deltas.FILE, F.concat(F.lit("f"), F.pmod(F.xxhash64("campaign_id", "event_date", "time_window_start"), F.lit(seed))))
    return file(traffic), file(conversion)


def test_partial_sums_of_files_equal_a_full_recompute_and_replays_add_nothing(spark, monkeypatch):
    monkeypatch.setattr(deltas, "COMPACT_AFTER", 3)
    traffic, conversion = _filed(spark, 6)
    store = SnapshotTable(spark, scratch_path(spark, "deltas"))
    full = daily.daily_performance(traffic, conversion)
    for some in (["f0", "f1"], ["f1", "f2"], ["f3"], ["f3"], ["f0", "f4"], ["f5"], ["f0", "f1", "f2", "f3", "f4", "f5"]):
        version = deltas.add_files(store, traffic.filter(F.col(deltas.FILE).isin(some)), conversion.filter(F.col(deltas.FILE).isin(some)))
    assert sorted(r.file for r in deltas.counted_files(store, version).collect()) == [f"f{k}" for k in range(6)]
    got = daily.performance_of_partials(deltas.partial_sums(store, version))
    assert got.schema == full.schema and rows_of(got) == rows_of(full)
    assert max(len(c) for c in version.parts.values()) <= 3
    dates = full.select(F.col("date").alias("event_date")).filter("event_date >= '2024-01-20'")
    some = deltas.performance(store, version, dates, dt.date(2024, 1, 20))
    assert rows_of(some) == rows_of(full.filter("date >= '2024-01-20'"))


def test_sums_that_no_part_has_a_value_of_stay_null_or_zero_as_in_one_pass(spark):
    traffic, conversion = tables(spark)  # null and negative impressions, conversions without traffic, and so on
    parts = [daily.daily_partials(traffic.filter(f"coalesce(impressions, 0) % 2 = {k}"), conversion.filter(f"units % 2 = {k} or ({k} = 0 and units is null or units % 2 = -{k})")) for k in (0, 1)]
    split = parts[0].unionByName(parts[1])
    assert rows_of(daily.performance_of_partials(split)) == rows_of(daily.daily_performance(traffic, conversion))


def test_refresh_stream_with_partial_sums(spark):
    root = scratch_path(spark, "stream-deltas")
    t_dir, c_dir, out, flags_dir = f"{root}/traffic", f"{root}/conversion", f"{root}/daily", f"{root}/flags"
    spark.createDataFrame(TRAFFIC_ROWS, TRAFFIC_RAW).write.parquet(f"{t_dir}/batch=1")
    spark.createDataFrame(CONVERSION_ROWS, CONVERSION_COLUMNS).write.parquet(f"{c_dir}/batch=1")
    late = [("e9", "c1", "g1", "k1", "2025-03-08T05:00:00-07:00", 1, D("7.00"), 1)]

    def run(check):
        start_daily_refresh(spark, t_dir, c_dir, out, f"{root}/{check}", flags_path=flags_dir, deltas_path=f"{root}/deltas").awaitTermination(120)

    def expect(conversions):
        traffic, conversion = tables(spark, TRAFFIC_ROWS, conversions)
        perf = daily.daily_performance(traffic, conversion)
        full = daily.anomalies(daily.performance_trends(perf))
        assert rows_of(readers.read_parquet(spark, out), perf.columns) == rows_of(perf)
        assert rows_of(readers.read_parquet(spark, flags_dir), full.columns) == rows_of(full)

    run("_check")
    expect(CONVERSION_ROWS)
    spark.createDataFrame(late, CONVERSION_COLUMNS).write.parquet(f"{c_dir}/batch=2")
    run("_check")
    expect(CONVERSION_ROWS + late)
    run("_lost")  # the stream's checkpoint is lost: every file comes again
    expect(CONVERSION_ROWS + late)


# ------------------------------------------------------------------ malformed values, positions

def test_a_job_counts_malformed_values_in_its_own_scan(spark):
    from adlens.plans import cli
    root = scratch_path(spark, "malformed")
    lines = ["campaign_id,ad_group_id,time_window_start,impressions,clicks,cost,year,month,day",
             "c1,g1,2025-03-10T05:00:00-07:00,10,2,0.5,2025,03,10", "c1,g1,2025-03-10T06:00:00-07:00,1.5,x,oops,2025,03,10",
             "c1,g2,2025-03-11T06:00:00-07:00,7,,1.0,2025,03,11", "c1,g2,2025-03-01T06:00:00-07:00,bad,1,1.0,2025,03,01"]
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(f"{root}/traffic")
    spark.createDataFrame(CONVERSION_ROWS, CONVERSION_COLUMNS).write.option("header", True).csv(f"{root}/conv")
    base = ["daily", "--traffic", f"{root}/traffic", "--conversion", f"{root}/conv", "--quarantine", f"{root}/bad"]
    out = cli.run(spark, [*base, "--output", f"{root}/daily"])
    bad = {(r.feed, r.column): r.rejected for r in out["rejected"].collect() if r.rejected}
    assert bad == {("traffic", "impressions"): 2, ("traffic", "clicks"): 1, ("traffic", "cost"): 1}
    kept = {tuple(r.columns): r.row for r in spark.read.parquet(f"{root}/bad/traffic").collect()}
    assert set(kept) == {("impressions", "clicks", "cost"), ("impressions",)} and '"cost":"oops"' in kept["impressions", "clicks", "cost"]
    assert not snapshots.SnapshotTable(spark, root).files.exists(f"{root}/bad/conversion")
    # Arrivals that the run doesn't need are neither read nor counted.
    out = cli.run(spark, [*base, "--output", f"{root}/daily2", "--since", "2025-03-10"])
    assert {(r.column): r.rejected for r in out["rejected"].collect() if r.rejected and r.feed == "traffic"} == {"impressions": 1, "clicks": 1, "cost": 1}
    report = cli.run(spark, ["report", "--traffic", f"{root}/traffic", "--conversion", f"{root}/conv", "--results", f"{root}/report",
                             "--window", "today", "--as-of", "2025-03-10"])
    assert spark.read.parquet(f"{root}/report/rejected").filter("rejected > 0").count() == 3 and report["report"].count() == 1


def test_counting_reads_the_files_once(spark):
    from pyspark.sql import Observation
    path = scratch_path(spark, "one-scan")
    spark.createDataFrame(TRAFFIC_ROWS, TRAFFIC_RAW).write.option("header", True).csv(path)
    rejects = {"traffic": Observation("one-scan")}
    raw = readers.read_source(spark, path, "csv", TRAFFIC_RAW, rejects["traffic"])
    plan = daily.daily_traffic(readers.prepare_traffic(raw))
    assert plan._jdf.queryExecution().executedPlan().toString().count("FileScan csv") == 1
    plan.collect()
    counts = readers.rejected_counts(spark, rejects)
    assert counts.agg(F.sum("rejected")).first()[0] == 0 and counts.count() == len(TRAFFIC_RAW)


def test_positions_of_a_sorted_report(spark):
    rows = spark.range(1000).select("id", F.pmod(F.xxhash64("id"), F.lit(50)).alias("spend"))
    got = reports.with_positions(rows.repartition(7).orderBy(F.desc("spend"), "id")).collect()
    want = sorted(rows.collect(), key=lambda r: (-r.spend, r.id))
    assert [r.id for r in sorted(got, key=lambda r: r.position)] == [r.id for r in want]
    assert sorted(r.position for r in got) == list(range(1, 1001))


# ------------------------------------------------------------------ arrivals

def _arrived(spark):
    """Event dates of March; one row of each arrives the next day, one 20 days late."""
    rows = []
    for d in range(1, 29):
        event = dt.date(2025, 3, d)
        for late in (1, 20):
            a = event + dt.timedelta(days=late)
            rows.append(("c1", "g1", "k1", "shoes", "EXACT", f"{event}T05:00:00-07:00", 10, d, D("1.00"), f"{a:%Y}", f"{a:%m}", f"{a:%d}"))
    return spark.createDataFrame(rows, ", ".join([f"{f.name} {f.dataType.simpleString()}" for f in TRAFFIC_RAW] + ["year string", "month string", "day string"]))


def test_a_past_window_reads_only_arrivals_that_hold_its_dates(spark):
    from adlens.sources.arrivals import ArrivalMap
    root = scratch_path(spark, "arrivals")
    _arrived(spark).write.partitionBy("year", "month", "day").parquet(f"{root}/traffic")
    raw = lambda held=None: readers.read_source(spark, f"{root}/traffic", "parquet", TRAFFIC_RAW, arrivals=held)
    days = ArrivalMap(spark, f"{root}/map")
    first = last = dt.date(2025, 3, 10)
    assert raw(days.holds(first, last)).count() == 56  # nothing entered: everything is read
    for until in (dt.date(2025, 3, 15), dt.date(2025, 3, 15), dt.date(2025, 4, 5)):
        days.update(raw(), until)
    assert days.entered().select("arrival").distinct().count() == 34 and days.entered().count() == days.entered().distinct().count()
    some = raw(days.holds(first, last))
    got = {(r.year, r.month, r.day) for r in some.select("year", "month", "day").collect()}
    # Entered days that hold the date (the next one, and 20 days late), and all days that aren't closed.
    assert {(int(m), int(d)) for _, m, d in got} == {(3, 11), (3, 30)} | {(4, d) for d in range(5, 18)}
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [coalesce((concat(cast(year" in plan
    date = F.col("event_date") == F.lit(first)
    assert rows_of(readers.prepare_traffic(some).filter(date)) == rows_of(readers.prepare_traffic(raw()).filter(date))


def test_command_line_arrival_map(spark):
    from adlens.plans import cli
    root = scratch_path(spark, "arrivals-cli")
    _arrived(spark).write.partitionBy("year", "month", "day").option("header", True).csv(f"{root}/traffic")
    spark.createDataFrame(CONVERSION_ROWS, CONVERSION_COLUMNS).withColumns({"year": F.lit("2025"), "month": F.lit("03"), "day": F.lit("12")}).write.partitionBy(
        "year", "month", "day").option("header", True).csv(f"{root}/conv")
    feeds = ["--traffic", f"{root}/traffic", "--conversion", f"{root}/conv", "--arrival-map", f"{root}/map"]
    cli.run(spark, ["arrivals", *feeds, "--closed-before", "2025-04-25"])
    base = ["campaigns", "--window", "today", "--as-of", "2025-03-10"]
    with_map = rows_of(cli.run(spark, [*base, *feeds, "--results", f"{root}/a"])["campaigns"])
    assert with_map == rows_of(cli.run(spark, [*base, *feeds[:4], "--results", f"{root}/b"])["campaigns"]) and len(with_map) == 1
