"""The registered queries: name -> (spark, sf_dir) -> DataFrame.

Every query reads the driver's tables through the ``events`` adapter, over
the whole table (report windows filter by date, as the reports do).
``AS_OF`` replaces ``current_date`` so results are reproducible.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from adlens.functions import dates
from adlens.functions.dates import window_bounds
from adlens.functions.text import to_number
from adlens.operators import alerts, daily, reports, rules, summary
from adlens.plans import jobs
from adlens.schema import CONVERSION_RAW, TRAFFIC_RAW
from adlens.session import scratch_path
from adlens.sources import config, history, readers
from adlens.sources.snapshots import SnapshotTable
from adlens.sources.adapter import ad_tables, read_events
from adlens.sources.arrivals import ArrivalMap
from adlens.streaming import deltas, refresh

AS_OF = "2024-01-15"

Query = Callable[[SparkSession, str], DataFrame]


def q_daily_traffic(spark, sf_dir):
    traffic, _ = ad_tables(spark, sf_dir)
    return daily.daily_traffic(traffic)


def q_daily_conversions(spark, sf_dir):
    _, conversion = ad_tables(spark, sf_dir)
    return daily.daily_conversions(conversion)


def q_daily_performance(spark, sf_dir):
    return daily.daily_performance(*ad_tables(spark, sf_dir))


def q_performance_trends(spark, sf_dir):
    return daily.performance_trends(q_daily_performance(spark, sf_dir))


def q_anomalies(spark, sf_dir):
    return daily.anomalies(q_performance_trends(spark, sf_dir))


REFRESH_FROM = "2024-01-20"


def q_anomalies_since(spark, sf_dir):
    """C4 + C5 for dates from REFRESH_FROM only, earlier dates feeding just the look-back."""
    return daily.flags_since(q_daily_performance(spark, sf_dir), REFRESH_FROM)


QUERIES: dict[str, Query] = {
    "daily_traffic": q_daily_traffic,
    "daily_conversions": q_daily_conversions,
    "daily_performance": q_daily_performance,
    "performance_trends": q_performance_trends,
    "anomalies": q_anomalies,
    "anomalies_since": q_anomalies_since,
}


# --- window reports (C7-C10) ---------------------------------------------------

ONE_CAMPAIGN = "7"
KEYWORD_TERM = "kw 1"


def _window_tables(spark, sf_dir, window):
    """Adapter tables with the window's dates pushed to the scan as a ts range."""
    return ad_tables(spark, sf_dir, date_range=window_bounds(window, AS_OF))


def _ad_group_report(window):
    def q(spark, sf_dir):
        t, c = _window_tables(spark, sf_dir, window)
        return reports.ad_group_report(t, c, window, AS_OF)
    return q


def q_report_last7days_unbounded(spark, sf_dir):
    """``last7days`` exactly as the reference writes it: no upper bound."""
    first, _ = window_bounds("last7days", AS_OF)
    t, c = ad_tables(spark, sf_dir, date_range=(first, None))
    return reports.ad_group_report(t, c, "last7days", AS_OF, bounded=False)


def q_campaign_report(spark, sf_dir):
    t, c = _window_tables(spark, sf_dir, "last7days")
    return reports.campaign_report(t, c, "last7days", AS_OF)


def q_campaign_report_one(spark, sf_dir):
    t, c = _window_tables(spark, sf_dir, "yesterday")
    return reports.campaign_report(t, c, "yesterday", AS_OF, campaign_id=ONE_CAMPAIGN)


def q_account_report(spark, sf_dir):
    t, c = _window_tables(spark, sf_dir, "last7days")
    return reports.account_report(t, c, "last7days", AS_OF)


def _keyword_report(mode, campaign_id=None, keyword=None):
    def q(spark, sf_dir):
        t, c = _window_tables(spark, sf_dir, "last7days")
        return reports.keyword_report(t, c, "last7days", AS_OF, campaign_id=campaign_id,
                                      keyword=keyword, limit=10, mode=mode)
    return q


QUERIES.update({
    "report_today": _ad_group_report("today"),
    "report_yesterday": _ad_group_report("yesterday"),
    "report_last7days": _ad_group_report("last7days"),
    "report_last7days_unbounded": q_report_last7days_unbounded,
    "campaign_report": q_campaign_report,
    "campaign_report_one": q_campaign_report_one,
    "account_report": q_account_report,
    "keyword_report_attributed": _keyword_report("attributed"),
    "keyword_report_as_written": _keyword_report("as_written"),
    "keyword_search": _keyword_report("attributed", ONE_CAMPAIGN, KEYWORD_TERM),
})


# --- summary, alerts, rules, history (C11-C17) -----------------------------------

def _report_last7(spark, sf_dir):
    t, c = _window_tables(spark, sf_dir, "last7days")
    return reports.ad_group_report(t, c, "last7days", AS_OF)


def q_account_summary(spark, sf_dir):
    return summary.account_summary(_report_last7(spark, sf_dir)).select(*summary.SUMMARY_COLUMNS)


def q_roas_distribution(spark, sf_dir):
    return summary.account_summary(_report_last7(spark, sf_dir)).select("roas_distribution.*")


def q_acos_distribution(spark, sf_dir):
    return summary.account_summary(_report_last7(spark, sf_dir)).select("acos_distribution.*")


def q_account_alerts(spark, sf_dir):
    return alerts.account_alerts(summary.account_summary(_report_last7(spark, sf_dir)))


def q_row_alerts(spark, sf_dir):
    return alerts.row_alerts(_report_last7(spark, sf_dir))


def _all_alerts(spark, sf_dir):
    report = _report_last7(spark, sf_dir)
    return alerts.all_alerts(summary.account_summary(report), report)


def q_alert_counts(spark, sf_dir):
    return alerts.alert_counts(_all_alerts(spark, sf_dir))


def q_alert_digest(spark, sf_dir):
    return alerts.alert_digest(_all_alerts(spark, sf_dir))


def q_anomaly_digest(spark, sf_dir):
    return alerts.anomaly_digest(q_anomalies(spark, sf_dir))


def q_bid_adjustments(spark, sf_dir):
    return rules.bid_adjustments(_report_last7(spark, sf_dir))


def q_bid_recommendations(spark, sf_dir):
    t, c = _window_tables(spark, sf_dir, "last7days")
    recs = jobs.recommendations(t, c, window="last7days", as_of=AS_OF)
    return recs.select("campaign_id", "current_metrics.*", "action", "percentage",
                       "description", "reason")


def q_rules_from_json(spark, sf_dir):
    path = scratch_path(spark, "rules")
    config.write_rules(spark, rules.DEFAULT_RULES, path)
    return rules.bid_adjustments(_report_last7(spark, sf_dir), config.read_rules(spark, path))


def _history(keep):
    def q(spark, sf_dir):
        t, c = ad_tables(spark, sf_dir)
        per_day = reports.window_report(t, c, ["campaign_id", "ad_group_id", "event_date"], window=None)
        daily_summaries = summary.account_summary(per_day, by=["event_date"])
        entries = history.as_history(daily_summaries, "all", "event_date")
        return history.latest(entries, keep).select(
            "account_id", "timestamp", *summary.SUMMARY_COLUMNS,
            "roas_distribution.*", "acos_distribution.*")
    return q


def q_text_to_number(spark, sf_dir):
    events = read_events(spark, sf_dir)
    k_text = F.get_json_object("props", "$.k")
    return events.select("event_id", k_text.alias("k_text"), to_number(k_text).alias("k_number"))


# Ad-hoc SQL over the registered views; values bound as parameters.
# A campaign x day rollup of both views (conversion-only days included).
ADHOC_BODY = """activity AS (
  SELECT campaign_id, event_date, impressions, clicks, cost,
         CAST(NULL AS BIGINT) AS conversions, CAST(NULL AS DECIMAL(18,4)) AS sales
  FROM traffic WHERE event_date BETWEEN :first_day AND :last_day
  UNION ALL
  SELECT campaign_id, event_date, NULL, NULL, NULL, conversions, sales
  FROM conversion WHERE event_date BETWEEN :first_day AND :last_day)
SELECT campaign_id, event_date,
       CAST(SUM(impressions) AS BIGINT) AS impressions, CAST(SUM(clicks) AS BIGINT) AS clicks,
       CAST(SUM(cost) AS DECIMAL(38,4)) AS cost, CAST(SUM(conversions) AS BIGINT) AS conversions,
       CAST(SUM(sales) AS DECIMAL(38,4)) AS sales
FROM activity
GROUP BY campaign_id, event_date"""
ADHOC_DAYS = {"first_day": _dt.date(2024, 1, 8), "last_day": _dt.date(2024, 1, 15)}


def q_adhoc_sql(spark, sf_dir):
    readers.register_views(*ad_tables(spark, sf_dir))
    return readers.run_sql(spark, "WITH " + ADHOC_BODY, **ADHOC_DAYS)


def q_parquet_roundtrip(spark, sf_dir):
    df = daily.daily_performance(*ad_tables(spark, sf_dir))
    path = scratch_path(spark, "daily_performance")
    readers.write_table(df, path, "parquet", ["date"])
    return readers.read_source(spark, path, "parquet", schema=df.schema)


def q_csv_roundtrip(spark, sf_dir):
    traffic, _ = ad_tables(spark, sf_dir)
    df = daily.daily_traffic(traffic)
    path = scratch_path(spark, "daily_traffic_csv")
    readers.write_table(df, path, "csv")
    return readers.read_source(spark, path, "csv", schema=df.schema)


QUERIES.update({
    "account_summary": q_account_summary,
    "roas_distribution": q_roas_distribution,
    "acos_distribution": q_acos_distribution,
    "account_alerts": q_account_alerts,
    "row_alerts": q_row_alerts,
    "alert_counts": q_alert_counts,
    "alert_digest": q_alert_digest,
    "anomaly_digest": q_anomaly_digest,
    "bid_adjustments": q_bid_adjustments,
    "bid_recommendations": q_bid_recommendations,
    "rules_from_json": q_rules_from_json,
    "history_last30": _history(history.HISTORY_KEEP),
    "history_latest10": _history(10),
    "text_to_number": q_text_to_number,
    "adhoc_sql": q_adhoc_sql,
    "parquet_roundtrip": q_parquet_roundtrip,
    "csv_roundtrip": q_csv_roundtrip,
})


# --- the ingestion path: ISO text, CSV and parquet folders by arrival day (S1, S2, DT1, DT2) ------

INGEST_FROM = "2024-01-10"
# Offsets of the rendered window starts, west and east of UTC, by campaign.
OFFSETS = ("-07:00", "+00:00", "+09:00", "+05:30")


def _iso_text(df):
    """The window start as ISO text whose local date is the row's ``event_date``."""
    offset = F.array(*[F.lit(o) for o in OFFSETS])[(F.col("campaign_id").cast("int") % len(OFFSETS))]
    return F.concat(F.date_format("time_window_start", "yyyy-MM-dd'T'HH:mm:ss"), offset)


def _arrival_parts(df):
    """Arrival partitions: the UTC day of the window start, so east of UTC a day before the local date."""
    utc = F.to_utc_timestamp(dates.iso_to_timestamp("time_window_start"), F.current_timezone()).cast("timestamp_ntz")
    return df.withColumns({"year": F.date_format(utc, "yyyy"), "month": F.date_format(utc, "MM"), "day": F.date_format(utc, "dd")})


def _raw_folders(spark, sf_dir):
    """The adapter's rows as deliveries: traffic CSV with counts written as 1.0, conversions as parquet."""
    traffic, conversion = ad_tables(spark, sf_dir)
    t = traffic.withColumn("time_window_start", _iso_text(traffic)).drop("event_date")
    t = t.withColumns({"impressions": F.concat(F.col("impressions").cast("string"), F.lit(".0")),
                       "clicks": F.concat(F.col("clicks").cast("string"), F.lit(".0"))})
    c = conversion.withColumn("time_window_start", _iso_text(conversion)).drop("event_date").withColumnsRenamed({
        "conversions": "attributed_conversions_1d", "sales": "attributed_sales_1d", "units": "attributed_units_ordered_1d"})
    paths = scratch_path(spark, "raw-traffic"), scratch_path(spark, "raw-conversion")
    parts = ["year", "month", "day"]
    _arrival_parts(t).write.partitionBy(*parts).option("header", True).csv(paths[0])
    _arrival_parts(c).write.partitionBy(*parts).parquet(paths[1])
    return paths


def q_ingested_performance(spark, sf_dir):
    """C3 from INGEST_FROM on, read from raw folders with arrivals pruned."""
    t_path, c_path = _raw_folders(spark, sf_dir)
    traffic = readers.arrivals_since(readers.read_source(spark, t_path, "csv", TRAFFIC_RAW), INGEST_FROM)
    conversion = readers.arrivals_since(readers.read_source(spark, c_path, "parquet", CONVERSION_RAW), INGEST_FROM)
    since = F.col("event_date") >= F.lit(INGEST_FROM).cast("date")
    return daily.daily_performance(readers.prepare_traffic(traffic).filter(since), readers.prepare_conversion(conversion).filter(since))


def q_ingested_timestamps(spark, sf_dir):
    """DT1, DT2: instant and local date of every window start."""
    traffic, _ = ad_tables(spark, sf_dir)
    text = traffic.select("campaign_id", _iso_text(traffic).alias("time_window_start"))
    return (dates.with_event_date(text).groupBy("campaign_id", "event_date")
            .agg(F.count("*").alias("n"), F.sum(F.unix_seconds("event_ts")).alias("sum_epoch")))


def q_touched_performance(spark, sf_dir):
    """The refresh's selection: C3 of the dates that refunds touch."""
    traffic, conversion = ad_tables(spark, sf_dir)
    touched = conversion.filter("conversions < 0 and campaign_id = '3'").select("event_date")
    return refresh.touched_performance(traffic, conversion, touched)


# --- rules documents (S10, B2, C15, C16) -------------------------------------------

RULES_DOCUMENT = [
    {"condition": "roas > -1 and acos > 2 * 10.5", "action": "decrease_bid", "percentage": 12.5, "description": "arithmetic"},
    {"condition": "0.5 < roas < 2", "action": "increase_bid", "percentage": 7, "description": "chained"},
    {"condition": "not (acos < 1e1 or conversion / 2 >= ctr - 1)", "action": "increase_bid", "percentage": 0.25},
    {"condition": "spend > 3", "action": "decrease_bid", "percentage": 5, "description": "unknown name: rejected"},
]


def _rules_document(spark):
    path = scratch_path(spark, "rules")
    config.write_rules(spark, RULES_DOCUMENT, path)
    return path


def q_rules_document(spark, sf_dir):
    return rules.bid_adjustments(_report_last7(spark, sf_dir), config.read_rules(spark, _rules_document(spark)))


def q_recommendations_document(spark, sf_dir):
    t, c = _window_tables(spark, sf_dir, "last7days")
    recs = jobs.recommendations(t, c, window="last7days", as_of=AS_OF, rules_path=_rules_document(spark))
    return recs.select("campaign_id", "current_metrics.*", "action", "percentage", "description", "reason")


RULE_COUNT = 1200


def many_rules() -> list[dict]:
    """A rules document of RULE_COUNT rules: ranges, and comparisons joined by ``and``."""
    out = []
    for k in range(RULE_COUNT):
        m, v = rules.METRICS[k % 4], k // 4 % 100
        condition = (f"{v} <= {m} < {v + 5}", f"{m} > {v} and roas < {k % 7}", f"ctr == {v % 9} and {m} >= {v}")[k % 3]
        out.append({"condition": condition, "action": ("increase_bid", "decrease_bid", "pause")[k % 3], "percentage": k % 50})
    return out


def q_rules_many(spark, sf_dir):
    """C15 with many rules, looked up by their thresholds."""
    path = scratch_path(spark, "rules-many")
    config.write_rules(spark, many_rules(), path)
    return rules.bid_adjustments(_report_last7(spark, sf_dir), config.read_rules(spark, path))


# --- jobs and history (C17-C19), severity (T3), unknown window (F4), order (O2) ------------------

def q_daily_job(spark, sf_dir):
    """A full run up to a day, then an incremental one from there; the table as it then stands."""
    traffic, conversion = ad_tables(spark, sf_dir)
    path, first = scratch_path(spark, "daily"), F.lit(REFRESH_FROM).cast("date")
    jobs.daily_job(spark, traffic.filter(F.col("event_date") < first), conversion.filter(F.col("event_date") < first), path)
    return jobs.daily_job(spark, traffic, conversion, path, since=REFRESH_FROM)["table"]


def q_daily_job_replaced(spark, sf_dir):
    """A full run over a table that holds more dates leaves none of them; the digest of it."""
    traffic, conversion = ad_tables(spark, sf_dir)
    path, first = scratch_path(spark, "daily"), F.lit(REFRESH_FROM).cast("date")
    jobs.daily_job(spark, traffic, conversion, path)
    since = F.col("event_date") >= first
    return jobs.daily_job(spark, traffic.filter(since), conversion.filter(since), path)["table"].groupBy("date").agg(
        F.count("*").alias("n"), F.sum("has_anomaly").alias("anomalies"))


def _report_job(name):
    def q(spark, sf_dir):
        t, c = _window_tables(spark, sf_dir, "last7days")
        return jobs.report_job(spark, t, c, "last7days", AS_OF, history_path=scratch_path(spark, "history"),
                               rules_path=_rules_document(spark), run_timestamp=AS_OF)[name]
    return q


def q_history_table(spark, sf_dir):
    """C17: two accounts' summaries appended, one of them twice (a retry after a wrong run), the newest 10 read back."""
    t, c = ad_tables(spark, sf_dir)
    per_day = reports.window_report(t, c, ["campaign_id", "ad_group_id", "event_date"], window=None)
    summaries = summary.account_summary(per_day, by=["event_date"])
    path = scratch_path(spark, "history")
    history.history_append(summaries.withColumn("total_clicks", F.lit(-1).cast("long")), path, "all", "event_date")
    history.history_append(summaries, path, "all", "event_date")
    history.history_append(summaries, path, "other", "event_date")
    return history.history_read(spark, path, 10).select(
        "account_id", "timestamp", *summary.SUMMARY_COLUMNS, "roas_distribution.*", "acos_distribution.*")


def q_notifications(spark, sf_dir):
    return alerts.notifications(_all_alerts(spark, sf_dir))


def q_report_unknown_window(spark, sf_dir):
    t, c = _window_tables(spark, sf_dir, "today")
    return reports.ad_group_report(t, c, "fortnight", AS_OF)


def _with_day_windows(df):
    return df.withColumn("time_window_start", F.col("event_date").cast("timestamp_ntz"))


def q_keyword_fan_out(spark, sf_dir):
    """J5 with windows of a day: many rows on both sides of the raw join."""
    t, c = _window_tables(spark, sf_dir, "last7days")
    return reports.keyword_report(_with_day_windows(t), _with_day_windows(c), "last7days", AS_OF, mode="as_written", bounded=True)


def q_keyword_positions(spark, sf_dir):
    """O2 with each row's position in the returned order (at most ``limit`` rows)."""
    top = q_keyword_fan_out(spark, sf_dir)
    order = F.row_number().over(Window.orderBy(F.monotonically_increasing_id()))
    return top.select("campaign_id", "keyword_id", "cost", order.alias("position"))


QUERIES.update({
    "ingested_performance": q_ingested_performance,
    "ingested_timestamps": q_ingested_timestamps,
    "touched_performance": q_touched_performance,
    "rules_document": q_rules_document,
    "rules_many": q_rules_many,
    "recommendations_document": q_recommendations_document,
    "daily_job": q_daily_job,
    "daily_job_replaced": q_daily_job_replaced,
    "report_job_report": _report_job("report"),
    "report_job_alert_digest": _report_job("alert_digest"),
    "report_job_adjustments": _report_job("bid_adjustments"),
    "history_table": q_history_table,
    "notifications": q_notifications,
    "report_unknown_window": q_report_unknown_window,
    "keyword_fan_out": q_keyword_fan_out,
    "keyword_positions": q_keyword_positions,
})


# --- versions, look-back state, partial sums, retention, malformed values, order and stamp ----------

def q_daily_job_stepwise(spark, sf_dir):
    """C18 in steps with late dates: each run looks back into the state kept beside the table; the table as it then stands."""
    traffic, conversion = ad_tables(spark, sf_dir)
    path, out = scratch_path(spark, "daily-steps"), None
    for since, until in ((None, "2024-01-15"), ("2024-01-14", "2024-01-20"), ("2024-01-18", "2024-01-26"), ("2024-01-24", "2025-01-01")):
        upto = F.col("event_date") < F.lit(until).cast("date")
        out = jobs.daily_job(spark, traffic.filter(upto), conversion.filter(upto), path, since=since)
    return out["table"]


def _in_files(df):
    """Rows named by the file a delivery would bring them in: late rows of a date come with another file."""
    return df.withColumn(deltas.FILE, F.concat(F.lit("delivery-"), F.pmod(F.xxhash64("ad_group_id", "time_window_start"), F.lit(3))))


def q_partial_sums_performance(spark, sf_dir):
    """C3 from partial sums per file: three deliveries, one of them twice."""
    traffic, conversion = map(_in_files, ad_tables(spark, sf_dir))
    store, version = SnapshotTable(spark, scratch_path(spark, "partial-sums")), None
    for some in (["delivery-0", "delivery-1"], ["delivery-1", "delivery-2"]):
        arrived = F.col(deltas.FILE).isin(some)
        version = deltas.add_files(store, traffic.filter(arrived), conversion.filter(arrived))
    return daily.performance_of_partials(deltas.partial_sums(store, version))


def q_history_compacted(spark, sf_dir):
    """Appends that are compacted to what is retained on the way; the newest 10 read back."""
    t, c = ad_tables(spark, sf_dir)
    per_day = reports.window_report(t, c, ["campaign_id", "ad_group_id", "event_date"], window=None)
    summaries = summary.account_summary(per_day, by=["event_date"])
    path = scratch_path(spark, "history-compacted")
    for k in range(4):
        history.history_append(summaries.filter(F.dayofmonth("event_date") % 4 == k), path, "all", "event_date", compact_after=2)
    return history.history_read(spark, path, 10).select(
        "account_id", "timestamp", *summary.SUMMARY_COLUMNS, "roas_distribution.*", "acos_distribution.*")


def q_rejected_values(spark, sf_dir):
    """S1 in a job: malformed values of the traffic files, counted per column by the daily job's own scan."""
    traffic, conversion = ad_tables(spark, sf_dir)
    k = F.col("keyword_id").cast("int")
    t = traffic.withColumn("time_window_start", _iso_text(traffic)).drop("event_date").withColumns({
        "clicks": F.when(k % 10 == 3, "n/a").otherwise(F.col("clicks").cast("string")),
        "cost": F.when(k % 7 == 2, "1,5").otherwise(F.col("cost").cast("string"))})
    path = scratch_path(spark, "malformed-traffic")
    t.write.option("header", True).csv(path)
    rejects = {"traffic": Observation("rejected-traffic")}
    raw = readers.read_source(spark, path, "csv", TRAFFIC_RAW, rejects["traffic"])
    return jobs.daily_job(spark, readers.prepare_traffic(raw), conversion, scratch_path(spark, "daily"), rejects=rejects)["rejected"]


def q_report_past_arrivals(spark, sf_dir):
    """C7 of a past day from raw folders, of which only the arrivals that hold its dates are read."""
    paths, frames = _raw_folders(spark, sf_dir), []
    first, last = window_bounds("yesterday", AS_OF)
    for path, fmt, schema in zip(paths, ("csv", "parquet"), (TRAFFIC_RAW, CONVERSION_RAW)):
        days = ArrivalMap(spark, scratch_path(spark, "arrival-map"))
        for until in ("2024-01-12", "2024-01-28"):  # as days are closed; the last ones are open still
            days.update(readers.read_source(spark, path, fmt, schema), _dt.date.fromisoformat(until))
        frames.append(readers.read_source(spark, path, fmt, schema, first_date=first, arrivals=days.holds(first, last)))
    return reports.ad_group_report(readers.prepare_traffic(frames[0]), readers.prepare_conversion(frames[1]), "yesterday", AS_OF)


def q_campaign_positions(spark, sf_dir):
    """O1 with each campaign's position in the returned order."""
    return reports.with_positions(q_campaign_report(spark, sf_dir)).select("campaign_id", "spend", "position")


def q_report_job_summary(spark, sf_dir):
    return _report_job("summary")(spark, sf_dir).select(*summary.SUMMARY_COLUMNS, "roas_distribution.*", "acos_distribution.*")


def q_history_default_stamp(spark, sf_dir):
    """DT7: an entry appended without a run time is stamped with the session's time of the run."""
    path = scratch_path(spark, "history")
    start = _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
    history.history_append(summary.account_summary(_report_last7(spark, sf_dir)), path)
    end = _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
    here = lambda t: F.lit(int((t - _dt.datetime(1970, 1, 1)).total_seconds()))
    local = F.unix_seconds(F.to_utc_timestamp(F.col("timestamp").cast("string"), F.current_timezone()))
    return history.history_read(spark, path).select("account_id", "total_campaigns", "total_spend", local.between(here(start), here(end) + 1).alias("at_run_time"))


QUERIES.update({
    "daily_job_stepwise": q_daily_job_stepwise,
    "partial_sums_performance": q_partial_sums_performance,
    "history_compacted": q_history_compacted,
    "rejected_values": q_rejected_values,
    "report_past_arrivals": q_report_past_arrivals,
    "campaign_positions": q_campaign_positions,
    "report_job_summary": q_report_job_summary,
    "history_default_stamp": q_history_default_stamp,
})
