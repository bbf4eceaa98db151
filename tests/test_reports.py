from decimal import Decimal as D

from pyspark.sql import functions as F

from adlens.operators import reports
from adlens.sources.adapter import ad_tables
from tests.conftest import SF01
from tests.fixtures import by_key, tables

AS_OF = "2025-03-10"


def test_ad_group_report_keeps_sql_null_semantics(spark):
    traffic, conversion = tables(spark)
    rows = by_key(reports.ad_group_report(traffic, conversion, "today", AS_OF).collect(),
                  "campaign_id", "ad_group_id")
    assert set(rows) == {("c1", "g1"), ("c1", "g2"), ("c2", "g3")}
    g1 = rows[("c1", "g1")]   # reports keep the correction row (D6)
    assert (g1.total_impression, g1.total_click, g1.spend, g1.total_order, g1.sales) == \
        (195, 10, D("20.00"), 2, D("35.00"))
    g2 = rows[("c1", "g2")]   # no conversions: acos 0, roas/conversion null (D8)
    assert g2.total_impression == 50 and g2.total_click == 1 and g2.spend == D("11.24")
    assert (g2.total_order, g2.sales, g2.acos, g2.roas, g2.conversion) == (None, None, 0.0, None, None)


def test_campaign_and_account_reports(spark):
    traffic, conversion = tables(spark)
    camps = reports.campaign_report(traffic, conversion, "today", AS_OF).collect()
    assert [r.campaign_id for r in camps] == ["c1", "c2"]      # larger spend first
    one = reports.campaign_report(traffic, conversion, "today", AS_OF, campaign_id="c2").collect()
    assert [(r.campaign_id, r.sales) for r in one] == [("c2", D("30.00"))]
    acc = reports.account_report(traffic, conversion, "today", AS_OF).collect()
    assert len(acc) == 1
    assert acc[0].total_order == 4 and acc[0].sales == D("70.00")   # c9 counts here (D7)
    empty = reports.account_report(traffic, conversion, "today", "2030-01-01").collect()
    assert len(empty) == 1 and empty[0].spend is None and empty[0].acos == 0.0


def test_last7days_spans_eight_dates(spark):
    traffic, conversion = tables(spark)
    r = reports.account_report(traffic, conversion, "last7days", "2025-03-15").first()
    assert r.total_impression == 100 + 195 + 0 + 10 + 50 + 40
    r = reports.account_report(traffic, conversion, "last7days", "2025-03-16").first()
    assert r.total_impression == 195 + 10 + 50 + 40           # 03-08 is out


def _brute_force_as_written(traffic, conversion):
    """The reference's join, pairs and all (fine on a handful of rows)."""
    t, c = traffic.alias("t"), conversion.alias("c")
    cond = ((F.col("t.campaign_id") == F.col("c.campaign_id")) & (F.col("t.ad_group_id") == F.col("c.ad_group_id"))
            & (F.col("t.time_window_start") == F.col("c.time_window_start")))
    j = t.join(c, cond, "left").filter(F.col("t.keyword_text").isNotNull())
    return {(r[0], r[1]): r for r in j.groupBy("t.campaign_id", "t.keyword_id").agg(
        F.sum("t.impressions").alias("impressions"), F.sum("t.cost").alias("cost"),
        F.sum("c.conversions").alias("conversions"), F.sum("c.sales").alias("sales")).collect()}


def test_keyword_as_written_equals_pairwise_join(spark):
    traffic, conversion = tables(spark)
    got = reports.keyword_report(traffic, conversion, "last7days", "2025-03-15", limit=None,
                                 mode="as_written").collect()
    expect = _brute_force_as_written(traffic, conversion)
    assert len(got) == len(expect) == 3
    for r in got:
        e = expect[(r.campaign_id, r.keyword_id)]
        assert (r.impressions, r.cost, r.conversions, r.sales) == \
            (e.impressions, e.cost, e.conversions, e.sales)
    shoes = [r for r in got if r.keyword_id == "k1"][0]
    assert shoes.impressions == 100 + 200 * 2 - 5 + 10     # the 05:00 row meets two conversions
    assert shoes.conversions == 2 + 1 - 1


def test_keyword_filters_and_attribution(spark):
    traffic, conversion = tables(spark)
    rows = reports.keyword_report(traffic, conversion, "last7days", "2025-03-15", limit=None).collect()
    assert {r.keyword_id for r in rows} == {"k1", "k2", "k4"}      # null keyword text dropped
    k1 = [r for r in rows if r.keyword_id == "k1"][0]
    assert (k1.conversions, k1.sales) == (2, D("35.0000"))
    k2 = [r for r in rows if r.keyword_id == "k2"][0]
    assert (k2.conversions, k2.sales, k2.roas) == (None, None, 0.0)
    # '%' and '_' in the search term stay wildcards, matching is case-sensitive.
    pct = reports.keyword_report(traffic, conversion, "last7days", "2025-03-15", keyword="50%_", limit=None)
    assert [r.keyword_text for r in pct.collect()] == ["50%_off"]
    assert reports.keyword_report(traffic, conversion, "last7days", "2025-03-15",
                                  keyword="SHOES", limit=None).count() == 0
    top = reports.keyword_report(traffic, conversion, "last7days", "2025-03-15", limit=2).collect()
    assert [r.keyword_id for r in top] == ["k1", "k4"]


def test_sf001_report_goldens(spark):
    traffic, conversion = ad_tables(spark, SF01)
    rep = reports.ad_group_report(traffic, conversion, "last7days", "2024-01-15", bounded=True)
    t = rep.agg(F.count(F.lit(1)), F.sum("total_impression"), F.sum("total_click"), F.sum("total_order"),
                F.sum("total_units"), F.count_if(F.col("roas").isNull())).first()
    assert tuple(t) == (150, 1050, 484, 421, 654, 4)
    # The raw join before keyword filters: rows, cost, sales, conversions (fan-out included).
    everything = traffic.withColumn("keyword_text", F.lit("all"))
    whole = reports._keyword_as_written(everything, conversion).agg(
        F.sum("cost"), F.sum("sales"), F.sum("conversions")).first()
    assert tuple(whole) == (D("50975.5000"), D("6779.2500"), 119)


def test_net_negative_sales(spark):
    from tests.fixtures import CONVERSION_ROWS, TRAFFIC_ROWS
    refunds = CONVERSION_ROWS + [("e7", "c2", "g3", "k4", "2025-03-10T22:00:00-07:00", -2, D("-45.50"), -2)]
    traffic, conversion = tables(spark, TRAFFIC_ROWS, refunds)
    g3 = [r for r in reports.ad_group_report(traffic, conversion, "today", AS_OF).collect()
          if r.ad_group_id == "g3"][0]
    assert (g3.total_order, g3.sales, g3.total_units) == (-1, D("-15.50"), -1)
    assert g3.acos == 0.0                        # sales not positive
    assert g3.roas == -2.58                      # -15.50 / 6.00, rounded half-up away from zero
    assert g3.conversion == -25.0


def test_keyword_report_corner_arguments(spark):
    rows = [("c1", "g1", "k1", "sho\\es", "EXACT", "2025-03-10T05:00:00-07:00", 10, 1, D("2.00")),
            ("c1", "g1", "k1", "shoes new", "BROAD", "2025-03-10T06:00:00-07:00", 10, 1, D("3.00")),
            ("c1", "g1", "k2", "100%", "BROAD", "2025-03-10T06:00:00-07:00", 10, 1, D("1.00"))]
    traffic, conversion = tables(spark, rows, [("e1", "c1", "g1", "k1", "2025-03-10T05:00:00-07:00", 1, D("50.00"), 1)])
    get = lambda **k: reports.keyword_report(traffic, conversion, "today", "2025-03-10", **k).collect()
    # Two variants of one keyword id: one row with the newest text, and the sale once.
    assert [(r.keyword_id, r.keyword_text, r.cost, r.sales) for r in get()] == [
        ("k1", "shoes new", D("5.0000"), D("50.0000")), ("k2", "100%", D("1.0000"), None)]
    assert [r.keyword_text for r in get(keyword="sho\\es")] == ["sho\\es"]
    assert len(get(keyword="%")) == 2 and get(limit=0) == [] and len(get(limit=None)) == 2
    assert len(get(campaign_id="")) == 2 and len(get(keyword="")) == 2
