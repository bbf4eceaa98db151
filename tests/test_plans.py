"""Plan properties that keep the queries scalable (see README, design for scale)."""

import contextlib
import io
import re

import pytest

from adlens.plans.registry import QUERIES
from tests.conftest import SF001

FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
             "FlatMapGroupsInPandas", "MapInPandas")
# These write or run jobs while being built.
WRITES = {"parquet_roundtrip", "csv_roundtrip", "rules_from_json", "ingested_performance", "rules_document", "recommendations_document",
          "daily_job", "daily_job_replaced", "report_job_report", "report_job_alert_digest", "report_job_adjustments", "history_table",
          "daily_job_stepwise", "partial_sums_performance", "history_compacted", "rejected_values", "report_past_arrivals", "campaign_positions", "report_job_summary",
          "history_default_stamp"}


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


@pytest.fixture(scope="module")
def plans(spark):
    return {name: plan(q(spark, SF001)) for name, q in QUERIES.items() if name not in WRITES}


def exchanges(text):
    return re.findall(r"Arguments: (hashpartitioning|rangepartitioning|SinglePartition)", text)


def test_no_pair_explosion_and_no_python_in_any_plan(plans):
    for name, text in plans.items():
        for op in FORBIDDEN:
            assert op not in text, f"{name} uses {op}"


def test_report_windows_reach_the_scan(plans):
    for name in ("report_today", "report_last7days", "campaign_report", "account_report",
                 "keyword_report_attributed", "keyword_report_as_written", "bid_adjustments"):
        pushed = re.findall(r"PushedFilters: \[(.*?)\]", plans[name])
        assert pushed and all("GreaterThanOrEqual(ts," in p for p in pushed), name


def test_scans_read_only_needed_columns(plans):
    for name, text in plans.items():
        for schema in re.findall(r"ReadSchema: struct<(.*?)>", text):
            assert len(schema.split(",")) <= 5, name          # events has 6 columns


def test_one_shuffle_per_report_and_shared_window_exchange(plans):
    for name in ("daily_traffic", "daily_performance", "report_today", "report_last7days",
                 "row_alerts", "bid_adjustments"):
        assert exchanges(plans[name]) == ["hashpartitioning"], name
    for name in ("performance_trends", "anomalies"):
        assert exchanges(plans[name]) == ["hashpartitioning"] * 2, name
        assert len(re.findall(r"^\(\d+\) Window$", plans[name], re.M)) == 1, name


def test_top_k_reports_use_take_ordered(plans):
    for name in ("keyword_report_attributed", "keyword_report_as_written", "keyword_search",
                 "history_latest10"):
        assert "TakeOrderedAndProject" in plans[name], name


def test_raw_report_windows_reach_text_and_arrivals(spark):
    """On raw folders by arrival day, a report skips old arrivals and pushes the window down as text."""
    from adlens.operators import reports
    from adlens.schema import CONVERSION_RAW, TRAFFIC_RAW
    from adlens.session import scratch_path
    from adlens.sources import readers
    from tests.fixtures import CONVERSION_COLUMNS, CONVERSION_ROWS, TRAFFIC_ROWS

    frames = []
    for rows, written, schema, prepare in ((TRAFFIC_ROWS, TRAFFIC_RAW, TRAFFIC_RAW, readers.prepare_traffic),
                                           (CONVERSION_ROWS, CONVERSION_COLUMNS, CONVERSION_RAW, readers.prepare_conversion)):
        path = scratch_path(spark, "raw")
        df = spark.createDataFrame(rows, written).selectExpr("*", "'2025' as year", "'03' as month", "'12' as day")
        df.write.partitionBy("year", "month", "day").parquet(path)
        frames.append(prepare(readers.arrivals_since(readers.read_source(spark, path, "parquet"), "2025-03-03")))
    text = plan(reports.ad_group_report(*frames, "last7days", "2025-03-10"))
    pushed = re.findall(r"PushedFilters: \[(.*?)\]", text)
    assert len(pushed) == 2 and all("GreaterThanOrEqual(time_window_start,2025-03-03)" in p for p in pushed)
    assert len(re.findall(r"PartitionFilters: \[.*?year.*?\]", text)) == 2
