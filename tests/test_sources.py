import datetime as dt
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from adlens.operators import daily, summary
from adlens.schema import TRAFFIC_RAW
from adlens.session import scratch_path
from adlens.sources import history, readers
from tests.fixtures import TRAFFIC_ROWS, tables


def test_csv_scan_with_declared_schema(spark):
    path = scratch_path(spark, "traffic-csv")
    spark.createDataFrame(TRAFFIC_ROWS, TRAFFIC_RAW).write.option("header", True).csv(path)
    raw = readers.read_source(spark, path, "csv", TRAFFIC_RAW)
    assert raw.schema == TRAFFIC_RAW
    t = readers.prepare_traffic(raw)
    assert t.count() == len(TRAFFIC_ROWS)
    assert t.filter(F.col("impressions").isNull()).count() == 1
    with pytest.raises(ValueError):
        readers.read_source(spark, path, "orc")
    with pytest.raises(ValueError):
        readers.read_source(spark, path, "csv")      # CSV needs a schema


def test_partitioned_sink_replaces_only_written_dates(spark):
    traffic, conversion = tables(spark)
    perf = daily.daily_performance(traffic, conversion)
    path = scratch_path(spark, "perf")
    readers.write_table(perf, path, "parquet", ["date"])
    # A late re-run for one date only must leave the other dates in place.
    one_day = perf.filter(F.col("date") == dt.date(2025, 3, 10)).withColumn("cpc", F.lit(-1.0))
    readers.write_table(one_day, path, "parquet", ["date"])
    back = readers.read_parquet(spark, path, perf.schema)
    assert back.count() == perf.count()
    assert {r.date.day for r in back.filter(F.col("cpc") == -1.0).collect()} == {10}


def test_adhoc_sql_binds_parameters(spark):
    traffic, conversion = tables(spark)
    readers.register_views(traffic, conversion)
    q = "SELECT campaign_id, SUM(cost) AS cost FROM traffic WHERE campaign_id = :cid GROUP BY campaign_id"
    rows = readers.run_sql(spark, q, cid="c2").collect()
    assert [(r.campaign_id, r.cost) for r in rows] == [("c2", D("6.0000"))]
    assert readers.run_sql(spark, q, cid="c2' OR '1'='1").count() == 0   # a value, never SQL text


def test_history_keeps_newest_entries(spark):
    traffic, conversion = tables(spark)
    from adlens.operators import reports
    rep = reports.ad_group_report(traffic, conversion, "today", "2025-03-10")
    summ = summary.account_summary(rep)
    path = scratch_path(spark, "history")
    assert history.history_read(spark, path).count() == 0                  # nothing yet
    base = dt.datetime(2025, 1, 1)
    for i in range(35):
        history.history_append(summ, path, "acct", base + dt.timedelta(days=i))
    history.history_append(summ, path, "other", base)
    history.history_append(summ, path, "other", base)          # a retried run: counted once
    kept = history.history_read(spark, path)
    assert kept.filter(F.col("account_id") == "acct").count() == 30
    oldest = kept.filter(F.col("account_id") == "acct").agg(F.min("timestamp")).first()[0]
    assert oldest == base + dt.timedelta(days=5)
    assert kept.filter(F.col("account_id") == "other").count() == 1
    assert history.history_read(spark, path, keep=3).count() == 4


def test_named_tables_and_arrival_pruning(spark):
    traffic, conversion = tables(spark)
    readers.register_views(traffic, conversion)
    assert readers.table(spark, readers.TRAFFIC_VIEW).count() == traffic.count()
    assert readers.table(spark, readers.CONVERSION_VIEW).count() == conversion.count()
    arrivals = spark.createDataFrame([("2025", "03", "08"), ("2025", "03", "09"), ("2025", "04", "07"),
                                      (None, None, None)], "year string, month string, day string")
    kept = arrivals.filter(readers.arrival_lower_bound(dt.date(2025, 3, 10))).collect()
    # a day to spare (arrival days are UTC), no upper bound (late rows), and rows without arrival values are kept
    assert [(r.month, r.day) for r in kept] == [("03", "09"), ("04", "07"), (None, None)]
    numeric = spark.createDataFrame([(2025, 3, 8), (2025, 3, 11)], "year int, month int, day int")
    assert [r.day for r in numeric.filter(readers.arrival_lower_bound("2025-03-10")).collect()] == [11]


def test_wide_conversion_csv_is_read_by_header_name(spark):
    from adlens.schema import CONVERSION_RAW
    path = scratch_path(spark, "wide-conversion")
    # Our own rows, laid out like a wide delivery: other columns first, in another order.
    header = ("advertiser_id,marketplace_id,idempotency_id,time_window_start,ad_group_id,placement,"
              "attributed_sales_7d,ad_id,campaign_id,keyword_id,attributed_conversions_1d,"
              "attributed_units_ordered_1d,attributed_sales_1d,attributed_conversions_7d,"
              "attributed_units_ordered_7d,year,month,day,hour")
    lines = [header,
             "A1,M1,i1,2025-03-10T05:00:00-07:00,g1,Top,12.5,ad1,c1,k1,1,2,10.25,2,3,2025,03,10,13",
             "A1,M1,i2,2025-03-10T23:00:00-07:00,g1,Top,0,ad1,c1,k1,-1,-1,-4.00,-1,-1,2025,04,07,18",
             "A1,M1,i3,2025-03-11T01:00:00-07:00,g2,Top,oops,ad2,c1,k2,1,1,5.00,1,1,2025,03,11,09"]
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(path)
    raw = readers.read_csv(spark, path, CONVERSION_RAW)
    assert raw.schema == CONVERSION_RAW
    conv = {r.idempotency_id: r for r in readers.prepare_conversion(raw).collect()}
    assert (conv["i1"].campaign_id, conv["i1"].conversions, conv["i1"].sales, conv["i1"].units) == \
        ("c1", 1, D("10.2500"), 2)
    assert conv["i2"].event_date == dt.date(2025, 3, 10) and conv["i2"].sales == D("-4.0000")
    wide = {r.idempotency_id: r for r in readers.prepare_conversion(raw, "7d").collect()}
    assert wide["i1"].sales == D("12.5000") and wide["i3"].sales is None     # bad text -> null
    assert wide["i1"].conversions == 2
    assert raw.filter("attributed_conversions_14d is not null").count() == 0   # absent column -> null


def _csv(spark, path, lines):
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(path)


def test_counts_with_a_fraction_of_zeros_and_rejected_values(spark):
    path = scratch_path(spark, "counts")
    _csv(spark, path, ["campaign_id,ad_group_id,time_window_start,impressions,clicks,cost",
                       "c1,g1,2025-03-10T05:00:00-07:00,1.0,2,0.5", "c1,g1,2025-03-10T06:00:00-07:00,1.5,x,oops"])
    rows = readers.read_csv(spark, path, TRAFFIC_RAW).orderBy("time_window_start").collect()
    assert [(r.impressions, r.clicks) for r in rows] == [(1, 2), (None, None)]
    assert daily.daily_traffic(readers.prepare_traffic(readers.read_csv(spark, path, TRAFFIC_RAW))).count() == 1
    bad = {r.column: r.rejected for r in readers.rejected_values(spark, path, TRAFFIC_RAW).collect()}
    assert (bad["impressions"], bad["clicks"], bad["cost"], bad["campaign_id"]) == (1, 1, 1, 0)


def test_files_with_differing_headers_fail(spark):
    path = scratch_path(spark, "headers")
    _csv(spark, f"{path}/a", ["campaign_id,impressions,clicks", "c1,10,1"])
    _csv(spark, f"{path}/b", ["campaign_id,clicks,impressions", "c1,1,10"])
    with pytest.raises(Exception, match="header"):
        readers.read_csv(spark, f"{path}/*", TRAFFIC_RAW).collect()


def test_rows_east_of_utc_survive_the_arrival_bound(spark):
    raw = spark.createDataFrame([("c", "2025-03-10T01:00:00+09:00", "2025", "03", "09")],
                                "campaign_id string, time_window_start string, year string, month string, day string")
    assert readers.arrivals_since(raw, dt.date(2025, 3, 10)).count() == 1


def test_last_written_entry_wins(spark):
    traffic, conversion = tables(spark)
    from adlens.operators import reports
    summ = summary.account_summary(reports.ad_group_report(traffic, conversion, "today", "2025-03-10"))
    path = scratch_path(spark, "history-retry")
    for clicks in (5, 6, 7):
        history.history_append(summ.withColumn("total_clicks", F.lit(clicks).cast("long")), path, "a", dt.datetime(2025, 1, 1))
    assert [r.total_clicks for r in history.history_read(spark, path).collect()] == [7]


def test_full_overwrite_leaves_no_stale_dates(spark):
    traffic, conversion = tables(spark)
    perf = daily.daily_performance(traffic, conversion)
    path = scratch_path(spark, "full")
    readers.write_table(perf, path, "parquet", ["date"])
    readers.write_table(perf.filter(F.col("date") == dt.date(2025, 3, 10)), path, "parquet", ["date"], replace_all=True)
    assert {r.date.day for r in readers.read_parquet(spark, path, perf.schema).select("date").collect()} == {10}


def test_scratch_needs_a_shared_folder_off_local_mode():
    from adlens.session import checkpoint_root

    class Conf(dict):
        def get(self, key, default=None):
            return {"spark.master": "spark://host:7077"}.get(key, default)

    class Context:
        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        checkpoint_root(Session())
