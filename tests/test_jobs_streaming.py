import datetime as dt
from decimal import Decimal as D

from pyspark.sql import functions as F

from adlens.operators import daily
from adlens.plans import jobs
from adlens.schema import TRAFFIC_RAW
from adlens.session import scratch_path
from adlens.sources import history, readers
from adlens.streaming.refresh import start_daily_refresh
from tests.fixtures import CONVERSION_COLUMNS, CONVERSION_ROWS, TRAFFIC_ROWS, tables


def test_daily_job_writes_by_date_and_digests(spark):
    traffic, conversion = tables(spark)
    out = scratch_path(spark, "daily-job")
    res = jobs.daily_job(spark, traffic, conversion, out)
    assert res["table"].count() == 6
    assert sorted(r.date.day for r in res["table"].select("date").distinct().collect()) == [8, 10, 11, 12]
    d = res["digest"].first()
    assert d.anomaly_count == 3
    assert d.message.startswith("🚨 Alert: 3 campaigns have performance anomalies!\n\nCampaign c1 on 2025-03-10:")


def test_report_job_returns_every_result(spark):
    traffic, conversion = tables(spark)
    hist = scratch_path(spark, "report-history")
    res = jobs.report_job(spark, traffic, conversion, "today", "2025-03-10", history_path=hist)
    assert res["report"].count() == 3
    s = res["summary"].first()
    assert s.total_spend == D("37.24") and s.total_campaigns == 2
    assert res["alerts"].count() >= 1
    assert res["bid_adjustments"].count() >= 1
    assert history.history_read(spark, hist).count() == 1


def test_refresh_stream_recomputes_only_touched_dates(spark):
    root = scratch_path(spark, "stream")
    t_dir, c_dir, out, chk = f"{root}/traffic", f"{root}/conversion", f"{root}/daily", f"{root}/_chk"
    flags_dir = f"{root}/flags"
    spark.createDataFrame(TRAFFIC_ROWS, TRAFFIC_RAW).write.parquet(f"{t_dir}/batch=1")
    spark.createDataFrame(CONVERSION_ROWS, CONVERSION_COLUMNS).write.parquet(f"{c_dir}/batch=1")
    q = start_daily_refresh(spark, t_dir, c_dir, out, chk, flags_path=flags_dir)
    q.awaitTermination(120)
    traffic, conversion = tables(spark)
    expect = daily.daily_performance(traffic, conversion)
    got = readers.read_parquet(spark, out, expect.schema)
    assert sorted(map(tuple, got.select(*expect.columns).collect())) == sorted(map(tuple, expect.collect()))
    # A late conversion for 03-08 lands: only that date is recomputed and replaced.
    late = [("e9", "c1", "g1", "k1", "2025-03-08T05:00:00-07:00", 1, D("7.00"), 1)]
    spark.createDataFrame(late, CONVERSION_COLUMNS).write.parquet(f"{c_dir}/batch=2")
    q = start_daily_refresh(spark, t_dir, c_dir, out, chk, flags_path=flags_dir)
    q.awaitTermination(120)
    got = readers.read_parquet(spark, out, expect.schema)
    first = got.filter(F.col("date") == dt.date(2025, 3, 8)).first()
    assert (first.conversions_1d, first.sales_1d) == (1, D("7.0000"))
    assert got.count() == 6
    # The flags from 03-08 on were refreshed too, and equal a full recompute.
    traffic, conversion = tables(spark, TRAFFIC_ROWS, CONVERSION_ROWS + late)
    full = daily.anomalies(daily.performance_trends(daily.daily_performance(traffic, conversion)))
    flags = readers.read_parquet(spark, flags_dir, full.schema)
    assert sorted(map(tuple, flags.select(*full.columns).collect())) == sorted(map(tuple, full.collect()))


def test_refresh_prunes_old_arrivals(spark):
    """Raw folders partitioned by arrival day: only arrivals since the touched date are read."""
    root = scratch_path(spark, "stream-arrivals")
    t_dir, c_dir, out, chk = f"{root}/traffic", f"{root}/conversion", f"{root}/daily", f"{root}/_chk"
    t = spark.createDataFrame(TRAFFIC_ROWS, TRAFFIC_RAW).withColumns(
        {"year": F.lit("2025"), "month": F.lit("03"), "day": F.lit("12")})
    t.write.partitionBy("year", "month", "day").parquet(t_dir)
    c = spark.createDataFrame(CONVERSION_ROWS, CONVERSION_COLUMNS).withColumns(
        {"year": F.lit("2025"), "month": F.lit("03"), "day": F.lit("12")})
    c.write.partitionBy("year", "month", "day").parquet(c_dir)
    start_daily_refresh(spark, t_dir, c_dir, out, chk).awaitTermination(120)
    traffic, conversion = tables(spark)
    expect = daily.daily_performance(traffic, conversion)
    got = readers.read_parquet(spark, out, expect.schema)
    assert sorted(map(tuple, got.select(*expect.columns).collect())) == sorted(map(tuple, expect.collect()))


def test_command_line_jobs(spark):
    from adlens.plans import cli
    root = scratch_path(spark, "cli")
    spark.createDataFrame(TRAFFIC_ROWS, TRAFFIC_RAW).write.option("header", True).csv(f"{root}/traffic")
    spark.createDataFrame(CONVERSION_ROWS, CONVERSION_COLUMNS).write.option("header", True).csv(f"{root}/conv")
    cli.run(spark, ["daily", "--traffic", f"{root}/traffic", "--conversion", f"{root}/conv",
                    "--output", f"{root}/daily"])
    assert spark.read.parquet(f"{root}/daily").count() == 6
    assert spark.read.json(f"{root}/daily_anomaly_digest").first().anomaly_count == 3
    cli.run(spark, ["report", "--traffic", f"{root}/traffic", "--conversion", f"{root}/conv",
                    "--results", f"{root}/report", "--window", "today", "--as-of", "2025-03-10",
                    "--history", f"{root}/history"])
    assert spark.read.parquet(f"{root}/report/report").count() == 3
    assert spark.read.parquet(f"{root}/report/summary").first().total_campaigns == 2
    assert spark.read.parquet(f"{root}/history").count() == 1


def test_flags_refresh_equals_full_recompute(spark):
    """Bounded look-back refresh of C4/C5 from a cut date equals the full computation."""
    from adlens.sources.adapter import ad_tables
    from adlens.streaming.refresh import refresh_flags
    from tests.conftest import SF001
    traffic, conversion = ad_tables(spark, SF001)
    perf = daily.daily_performance(traffic, conversion)
    root = scratch_path(spark, "flags")
    readers.write_table(perf, f"{root}/daily", "parquet", ["date"])
    full = daily.anomalies(daily.performance_trends(perf))
    cut = dt.date(2024, 1, 20)
    stale = full.filter(F.col("date") < cut)
    readers.write_table(stale, f"{root}/flags", "parquet", ["date"])        # what was there before
    refresh_flags(spark, f"{root}/daily", f"{root}/flags", cut)
    got = readers.read_parquet(spark, f"{root}/flags", full.schema)
    cols = full.columns
    assert sorted(map(tuple, got.select(*cols).collect())) == sorted(map(tuple, full.collect()))


def test_incremental_daily_job_equals_full_run(spark):
    from adlens.sources.adapter import ad_tables
    from tests.conftest import SF001
    traffic, conversion = ad_tables(spark, SF001)
    full_path, inc_path = scratch_path(spark, "daily-full"), scratch_path(spark, "daily-inc")
    full = jobs.daily_job(spark, traffic, conversion, full_path)["table"]
    cut = dt.date(2024, 1, 20)
    # an earlier run that only saw the days before the cut, then an incremental run from the cut
    jobs.daily_job(spark, traffic.filter(F.col("event_date") < cut),
                   conversion.filter(F.col("event_date") < cut), inc_path)
    inc = jobs.daily_job(spark, traffic, conversion, inc_path, since=cut)["table"]
    cols = full.columns
    assert sorted(map(tuple, inc.select(*cols).collect())) == sorted(map(tuple, full.collect()))
    # a first run with ``since`` and no table yet: only the dates from the cut are written
    fresh = jobs.daily_job(spark, traffic, conversion, scratch_path(spark, "daily-fresh"), since=cut)["table"]
    assert fresh.count() == full.filter(F.col("date") >= cut).count()


def test_command_line_incremental_daily(spark):
    from adlens.plans import cli
    root = scratch_path(spark, "cli-since")
    spark.createDataFrame(TRAFFIC_ROWS, TRAFFIC_RAW).write.parquet(f"{root}/traffic")
    spark.createDataFrame(CONVERSION_ROWS, CONVERSION_COLUMNS).write.parquet(f"{root}/conv")
    base = ["daily", "--traffic", f"{root}/traffic", "--conversion", f"{root}/conv",
            "--output", f"{root}/daily", "--format", "parquet"]
    full = cli.run(spark, base)["table"]
    before = sorted(map(tuple, full.collect()))
    again = cli.run(spark, base + ["--since", "2025-03-10"])["table"]
    assert sorted(map(tuple, again.select(*full.columns).collect())) == before


def test_report_job_with_rules_document_and_retry(spark):
    from adlens.sources import config
    traffic, conversion = tables(spark)
    root = scratch_path(spark, "report-rules")
    config.write_rules(spark, [{"condition": "ctr >= 5.0", "action": "increase_bid", "percentage": 5,
                                "description": "high CTR"}], f"{root}/rules")
    run_at = dt.datetime(2025, 3, 10, 6, 0)
    for _ in range(2):                       # a retried run with the same scheduled time
        res = jobs.report_job(spark, traffic, conversion, "today", "2025-03-10",
                              history_path=f"{root}/history", rules_path=f"{root}/rules",
                              run_timestamp=run_at)
    adj = sorted((r.campaign_id, r.ad_group_id, r.reason) for r in res["bid_adjustments"].collect())
    assert adj == [("c1", "g1", "Rule triggered: ctr >= 5.0"), ("c2", "g3", "Rule triggered: ctr >= 5.0")]
    assert history.history_read(spark, f"{root}/history").count() == 1


def test_refresh_of_many_dates_keeps_all_of_them(spark):
    """More touched dates than any list should hold: flags equal a full recompute."""
    days = [dt.date(2015, 1, 1) + dt.timedelta(days=k) for k in range(900)]
    rows = [("c1", f"g{k % 3}", "k1", "shoes", "EXACT", f"{d}T05:00:00-07:00", 100 + k % 7, 5 + k % 3, D("1.00")) for k, d in enumerate(days)]
    root = scratch_path(spark, "many-dates")
    spark.createDataFrame(rows, TRAFFIC_RAW).coalesce(2).write.parquet(f"{root}/traffic/batch=1")
    spark.createDataFrame([("e1", "c1", "g0", "k1", "2015-01-01T05:00:00-07:00", 1, D("5.00"), 1)], CONVERSION_COLUMNS).write.parquet(f"{root}/conversion/batch=1")
    start_daily_refresh(spark, f"{root}/traffic", f"{root}/conversion", f"{root}/daily", f"{root}/_chk",
                        flags_path=f"{root}/flags").awaitTermination(300)
    flags = spark.read.parquet(f"{root}/flags")
    assert flags.select("date").distinct().count() == 900 and flags.agg(F.min("date")).first()[0] == days[0]


def test_command_line_reports(spark):
    from adlens.plans import cli
    root = scratch_path(spark, "cli-reports")
    spark.createDataFrame(TRAFFIC_ROWS, TRAFFIC_RAW).createOrReplaceTempView("cli_traffic")
    spark.createDataFrame(CONVERSION_ROWS, CONVERSION_COLUMNS).createOrReplaceTempView("cli_conversion")
    base = ["--traffic", "cli_traffic", "--conversion", "cli_conversion", "--format", "table", "--as-of", "2025-03-10", "--results", root]
    assert cli.run(spark, ["campaigns", *base])["campaigns"].count() == 2
    assert cli.run(spark, ["account", *base])["account"].count() == 1
    assert cli.run(spark, ["keywords", *base, "--limit", "1"])["keywords"].count() == 1
    assert cli.run(spark, ["recommendations", *base, "--campaign", "c1"])["recommendations"].count() >= 1
    for _ in range(2):
        cli.run(spark, ["report", *base, "--history", f"{root}/hist", "--account", "shop", "--run-timestamp", "2025-03-10 06:00:00"])
    out = cli.run(spark, ["history", "--history", f"{root}/hist", "--results", f"{root}/read"])["history"].collect()
    assert [(r.account_id, r.timestamp) for r in out] == [("shop", dt.datetime(2025, 3, 10, 6, 0))]
    assert spark.read.parquet(f"{root}/campaigns").count() == 2
