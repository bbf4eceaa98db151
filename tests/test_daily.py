import datetime as dt
from decimal import Decimal as D

from pyspark.sql import functions as F

from adlens.operators import daily
from adlens.sources.adapter import ad_tables
from tests.conftest import SF01
from tests.fixtures import by_key, tables

D10 = dt.date(2025, 3, 10)


def test_daily_traffic_drops_corrections(spark):
    traffic, _ = tables(spark)
    rows = by_key(daily.daily_traffic(traffic).collect(), "campaign_id", "ad_group_id", "date")
    g1 = rows[("c1", "g1", D10)]
    assert (g1.total_impressions, g1.total_clicks, g1.total_cost) == (200, 10, D("20.0000"))
    assert (g1.cpc, g1.ctr) == (2.0, 5.0)
    g2 = rows[("c1", "g2", D10)]          # null-impression row dropped with its clicks and cost
    assert (g2.total_impressions, g2.total_clicks, g2.total_cost, g2.cpc, g2.ctr) == (50, 0, D("1.2500"), 0.0, 0.0)
    assert ("c2", "g3", D10) in rows      # 23:00 at -07:00 stays on its local date


def test_daily_performance_left_join_semantics(spark):
    traffic, conversion = tables(spark)
    rows = by_key(daily.daily_performance(traffic, conversion).collect(), "campaign_id", "ad_group_id", "date")
    assert len(rows) == 6                 # conversions without traffic (c9) vanish (D7)
    assert not any(k[0] == "c9" for k in rows)
    g1 = rows[("c1", "g1", D10)]
    assert (g1.conversions_1d, g1.sales_1d, g1.units_ordered_1d) == (2, D("35.0000"), 2)
    assert (g1.acos, g1.roas, g1.conversion_rate) == (57.14, 1.75, 20.0)
    first = rows[("c1", "g1", dt.date(2025, 3, 8))]   # no conversions: filled with 0, ratios 0
    assert (first.conversions_1d, first.sales_1d, first.acos, first.roas, first.conversion_rate) == \
        (0, D("0.0000"), 0.0, 0.0, 0.0)
    g3 = rows[("c2", "g3", D10)]
    assert (g3.acos, g3.roas, g3.conversion_rate, g3.cpc, g3.ctr) == (20.0, 5.0, 25.0, 1.5, 10.0)


def test_trends_and_anomalies(spark):
    traffic, conversion = tables(spark)
    flags = daily.anomalies(daily.performance_trends(daily.daily_performance(traffic, conversion)))
    s = {r.date.day: r for r in flags.filter(F.col("ad_group_id") == "g1").collect()}
    assert sorted(s) == [8, 10, 11, 12]
    assert (s[8].impressions_change, s[8].cost_change, s[8].sales_change) == (0.0, 0.0, 0.0)
    assert (s[10].impressions_change, s[10].cost_change, s[10].sales_change) == (100.0, 471.43, 0.0)
    assert (s[11].impressions_change, s[11].cost_change, s[11].sales_change) == (-100.0, -100.0, -100.0)
    assert s[12].impressions_change == 1000.0     # previous 0 divides by 1 (D23)
    assert s[12].cost_change == 0.0               # previous 0 gives 0
    assert s[10].avg_ctr_7d == 3.5                # (2 + 5) / 2: rows, not days (D3)
    assert abs(s[11].avg_ctr_7d - 7 / 3) < 1e-12
    assert [s[d].acos_anomaly for d in (8, 10, 11, 12)] == [0, 1, 1, 0]
    assert [s[d].ctr_anomaly for d in (8, 10, 11, 12)] == [0, 0, 0, 1]
    assert [s[d].has_anomaly for d in (8, 10, 11, 12)] == [0, 1, 1, 1]


def test_trailing_frame_is_eight_rows(spark):
    rows = [("c", "g", dt.date(2024, 1, d), float(d)) for d in range(1, 13)]
    df = spark.createDataFrame(rows, "campaign_id string, ad_group_id string, date date, ctr double")
    got = {r.date.day: r.a for r in df.select("date", daily.trailing_avg("ctr", 7).alias("a")).collect()}
    assert got[12] == sum(range(5, 13)) / 8
    assert got[3] == 2.0
    nulls = spark.createDataFrame([("c", "g", dt.date(2024, 1, 1), None)],
                                  "campaign_id string, ad_group_id string, date date, ctr double")
    assert nulls.select(daily.trailing_avg("ctr", 7).alias("a")).first().a is None


def test_sf001_goldens(spark):
    """FIXTURES.md section 7 figures at sf0.01 (Spark and DuckDB agreed on them)."""
    traffic, conversion = ad_tables(spark, SF01)
    assert traffic.count() == 8019 and conversion.count() == 1981
    assert traffic.filter(F.col("keyword_text").isNull()).count() == 789
    perf = daily.daily_performance(traffic, conversion)
    t = perf.agg(F.count(F.lit(1)).alias("rows"), F.sum("total_impressions").alias("imp"),
                 F.sum("total_clicks").alias("clk"), F.sum("total_cost").alias("cost"),
                 F.sum("conversions_1d").alias("conv"), F.sum("sales_1d").alias("sales"),
                 F.sum("units_ordered_1d").alias("units")).first()
    assert (t.rows, t.imp, t.clk, t.cost, t.conv, t.sales, t.units) == \
        (3281, 6005, 2006, D("50975.5000"), 1185, D("56072.7800"), 1868)
    keys = ["campaign_id", "ad_group_id", "date"]
    c1, c2 = daily.daily_traffic(traffic), daily.daily_conversions(conversion)
    assert c1.join(c2, keys, "left_anti").count() == 2107      # rows without a conversion group
    assert c2.join(c1, keys, "left_anti").count() == 430       # conversion groups the join loses
    f = daily.anomalies(daily.performance_trends(perf)).agg(
        F.sum("ctr_anomaly"), F.sum("acos_anomaly"), F.sum("conversion_anomaly"), F.sum("has_anomaly")).first()
    assert tuple(f) == (928, 627, 924, 1557)
