from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from adlens.operators import alerts, daily, reports, rules, summary
from adlens.sources import config
from adlens.session import scratch_path
from adlens.sources.adapter import ad_tables
from tests.conftest import SF01

REPORT_SCHEMA = ("campaign_id string, ad_group_id string, total_impression bigint, total_click bigint, "
                 "spend decimal(38,2), total_order bigint, sales decimal(38,2), total_units bigint, "
                 "acos double, roas double, conversion double, ctr double")


def report(spark, rows):
    return spark.createDataFrame(rows, REPORT_SCHEMA)


ROWS = [
    # spend > 100 and roas < 1: both row alerts fire
    ("c1", "g1", 1000, 50, D("150.00"), 1, D("90.00"), 1, 166.67, 0.6, 2.0, 5.0),
    # spend without sales: null roas counts as 0 for alerts and rules
    ("c2", "g2", 100, 4, D("60.00"), None, None, None, 0.0, None, None, 4.0),
    # matches two rules: roas >= 4 and conversion > 10 with roas >= 3
    ("c3", "g3", 400, 20, D("10.00"), 5, D("80.00"), 5, 12.5, 8.0, 25.0, 5.0),
]


def test_summary_counts_and_distributions(spark):
    s = summary.account_summary(report(spark, ROWS)).first()
    assert (s.total_campaigns, s.total_ad_groups, s.total_impressions, s.total_clicks) == (3, 3, 1500, 74)
    assert (s.total_spend, s.total_sales, s.total_orders, s.total_units) == (D("220.00"), D("170.00"), 6, 6)
    assert s.overall_roas == round(170 / 220, 2)
    assert s.overall_acos == 129.41                    # 220 / 170 * 100
    assert s.overall_conversion == round(6 / 74 * 100, 2)
    assert tuple(s.roas_distribution) == (1, 0, 1)     # null roas in no bucket
    assert tuple(s.acos_distribution) == (1, 0, 2)     # 166.67 | - | 0.0, 12.5
    assert s.report_rows == 3


def test_empty_summary_is_zero_and_raises_no_alert(spark):
    s = summary.account_summary(report(spark, []))
    row = s.first()
    assert row.report_rows == 0 and row.total_spend == D("0.00") and row.overall_roas == 0.0
    assert alerts.account_alerts(s).count() == 0


def test_account_and_row_alerts_text(spark):
    rep = report(spark, ROWS)
    acc = {(r.level, r.type): r.message for r in alerts.account_alerts(summary.account_summary(rep)).collect()}
    assert acc == {("CRITICAL", "ROAS"): "Overall ROAS is critically low at 0.77 (threshold: 1.0)",
                   ("CRITICAL", "ACOS"): "Overall ACOS is critically high at 129.41% (threshold: 50.0%)"}
    rows = sorted((r.level, r.campaign_id, r.ad_group_id, r.message) for r in alerts.row_alerts(rep).collect())
    assert rows == [
        ("CRITICAL", "c1", "g1", "Campaign c1 has very poor performance: ROAS 0.6, ACOS 166.67%"),
        ("CRITICAL", "c2", "g2", "Campaign c2 has very poor performance: ROAS 0, ACOS 0.0%"),
        ("WARNING", "c1", "g1", "Campaign c1 has high spend ($150.0) with low ROAS (0.6)"),
    ]


def test_alert_digest_reassembles_to_reference_text(spark):
    rep = report(spark, ROWS)
    al = alerts.all_alerts(summary.account_summary(rep), rep)
    counts = {r.level: r.alert_count for r in alerts.alert_counts(al).collect()}
    assert counts == {"CRITICAL": 4, "WARNING": 1}
    frags = alerts.alert_digest(al).collect()           # already in order (small test input)
    text = {lvl: "".join(f.fragment for f in frags if f.level == lvl) for lvl in counts}
    assert text["WARNING"] == (
        "⚠️ WARNING ALERTS ⚠️\n\n"
        "- Campaign c1 has high spend ($150.0) with low ROAS (0.6)\n"
        "\nPlease review and take appropriate action.")
    assert text["CRITICAL"].startswith("🚨 CRITICAL ALERTS 🚨\n\n- Overall ROAS is critically low at 0.77 "
                                       "(threshold: 1.0)\n- Overall ACOS is critically high")
    assert text["CRITICAL"].endswith("\nImmediate action recommended!")


def test_anomaly_digest_text(spark):
    rows = [("c1", "g1", "2025-03-10", 1, 1, 0, 1), ("c2", "g2", "2025-03-09", 0, 0, 1, 1),
            ("c3", "g3", "2025-03-09", 0, 0, 0, 0)]
    flags = spark.createDataFrame(rows, "campaign_id string, ad_group_id string, date string, ctr_anomaly int, "
                                        "acos_anomaly int, conversion_anomaly int, has_anomaly int") \
        .withColumn("date", F.to_date("date"))
    d = alerts.anomaly_digest(flags).collect()
    assert len(d) == 1 and d[0].anomaly_count == 2
    assert d[0].message == ("🚨 Alert: 2 campaigns have performance anomalies!\n\n"
                            "Campaign c2 on 2025-03-09:\n- Conversion rate anomaly detected\n\n"
                            "Campaign c1 on 2025-03-10:\n- CTR anomaly detected\n- ACOS anomaly detected\n\n")
    assert alerts.anomaly_digest(flags.filter("has_anomaly = 0")).count() == 0


def test_rule_compilation_whitelist(spark):
    for bad in ["__import__('os')", "roas; drop", "spend > 1", "(roas", "(roas < 1) < 2", "roas < < 1", "1e", ""]:
        with pytest.raises(rules.InvalidRule):
            rules.to_sql(bad)
    rep = report(spark, ROWS)
    ok, rejected = rules.compile_rules(
        [{"condition": "roas < 1.0", "action": "a", "percentage": 1},
         {"condition": "roas + 1", "action": "b", "percentage": 2},        # not boolean
         {"condition": "roas >", "action": "c", "percentage": 3},          # parse error
         {"condition": "exec(1)", "action": "d", "percentage": 4}], rep)
    assert [r.action for r in ok] == ["a"]
    assert len(rejected) == 3


def test_conditions_mean_what_they_mean_in_python(spark):
    values = [{"acos": 30.0, "roas": 1.5, "conversion": 4.0, "ctr": 0.0}, {"acos": 0.5, "roas": 4.0, "conversion": 0.0, "ctr": 2.0}]
    frame = rules._metric_frame(spark.createDataFrame([tuple(v.values()) for v in values], "acos double, roas double, conversion double, ctr double"))
    for c in ["roas > -1", "acos > 2 * 0.25", "0.5 < roas < 2", "acos < 1e3", "not (roas < 1 or acos > 2)", "not roas < 2 and ctr > 1",
              "(acos + 1) / (roas - 4.5) < -3 or roas == 4", "1 < roas <= 4 != ctr", "-roas<(-1)", "acos - 2 * (roas + conversion) > 19",
              "(roas < 2) or ((ctr)) >= 2", "10 / ctr > 1"]:
        got = [r[0] or False for r in frame.select(F.expr(rules.to_sql(c))).collect()]
        want = []
        for v in values:
            try:
                want.append(eval(c, {}, v))
            except ZeroDivisionError:      # such a rule fails on that row and is skipped there
                want.append(False)
        assert got == want, c


def test_many_rules_and_fractional_percentages(spark):
    rep = report(spark, ROWS)
    many = [{"condition": f"roas > {k}e6", "action": "a", "percentage": 1} for k in range(1, 1101)]
    many += [{"condition": "roas >= 4.0", "action": "up", "percentage": 12.5}]
    assert [(r.action, r.percentage) for r in rules.bid_adjustments(rep, many).collect()] == [("up", 12.5)]
    path = scratch_path(spark, "rules-many")
    config.write_rules(spark, many, path)
    assert len(config.read_rules(spark, path)) == 1101 and config.read_rules(spark, path)[-1]["percentage"] == 12.5
    bad = rules.rejected_rules(spark, [{"condition": "x > 1", "action": "a", "percentage": 1}, many[0]]).collect()
    assert [(r.condition, r.action) for r in bad] == [("x > 1", "a")]


def test_bid_adjustments_and_recommendations(spark):
    rep = report(spark, ROWS)
    adj = sorted((r.campaign_id, r.action, r.percentage, r.reason) for r in rules.bid_adjustments(rep).collect())
    assert adj == [
        ("c1", "decrease_bid", 15, "Rule triggered: acos > 40.0"),
        ("c1", "decrease_bid", 20, "Rule triggered: roas < 1.0"),
        ("c2", "decrease_bid", 20, "Rule triggered: roas < 1.0"),         # null roas -> 0
        ("c3", "increase_bid", 10, "Rule triggered: roas >= 4.0"),
        ("c3", "increase_bid", 15, "Rule triggered: conversion > 10.0 and roas >= 3.0"),
    ]
    recs = rules.bid_recommendations(rep.drop("ad_group_id")).filter(F.col("campaign_id") == "c2").collect()
    assert len(recs) == 1
    assert tuple(recs[0].current_metrics) == (0.0, 0.0, 0.0, 4.0)
    assert recs[0].description == "ROAS below 1 is losing money, decrease bids by 20%"
    assert rules.bid_adjustments(rep, []).count() == 0


def test_rules_document_roundtrip(spark):
    path = scratch_path(spark, "rules-test")
    assert config.read_rules(spark, path) == rules.DEFAULT_RULES          # missing -> defaults
    custom = [{"condition": "ctr < 1.0", "action": "pause", "percentage": 100, "description": None}]
    config.write_rules(spark, custom, path)
    assert config.read_rules(spark, path) == custom
    other = scratch_path(spark, "rules-empty")
    spark.createDataFrame([('{"other": 1}',)], "value string").write.text(other)
    assert config.read_rules(spark, other) == []                          # no default_rules -> none
    broken = scratch_path(spark, "rules-broken")
    spark.createDataFrame([('{"default_rules": [',)], "value string").write.text(broken)
    with pytest.raises(ValueError):
        config.read_rules(spark, broken)                                  # the report fails
    assert config.read_rules(spark, broken, on_error="none") == []                        # the report's job
    assert config.read_rules(spark, broken, on_error="defaults") == rules.DEFAULT_RULES   # the tool


def test_sf001_alert_and_rule_goldens(spark):
    t, c = ad_tables(spark, SF01)
    rep = reports.ad_group_report(t, c, "last7days", "2024-01-15", bounded=True)
    s = summary.account_summary(rep).first()
    assert tuple(s.roas_distribution) == (77, 38, 31)
    assert tuple(s.acos_distribution) == (77, 33, 40)
    levels = {r.level: r.alert_count for r in alerts.alert_counts(alerts.row_alerts(rep)).collect()}
    assert levels == {"WARNING": 43, "CRITICAL": 44}
    fired = {r.reason: r["count"] for r in rules.bid_adjustments(rep).groupBy("reason").count().collect()}
    assert [fired["Rule triggered: " + r["condition"]] for r in rules.DEFAULT_RULES] == [59, 31, 69, 52]
    assert daily.ANOMALY_THRESHOLDS == {"ctr": 50.0, "acos": 30.0, "conversion_rate": 40.0}
