"""Threshold alerts and notification digests.

Alerts are generated as arrays of ``when(condition, struct)`` that are
filtered and exploded: one narrow pass over the rows, no join, no UDF.
Digests never gather an unbounded set of alerts into one task: the alert
digest is a sorted frame of text fragments (one per alert line) whose
concatenation in order is the message, and the anomaly digest holds at
most ``limit`` blocks by design.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adlens.functions.dates import date_text
from adlens.functions.metrics import num_text, zero_if_null
from adlens.functions.text import text, value_text, with_severity
from adlens.operators.daily import anomalous
from adlens.operators.summary import THRESHOLDS

R, A, S = THRESHOLDS["ROAS"], THRESHOLDS["ACOS"], THRESHOLDS["Daily_Spend"]

# Spend limits of the per-row alerts.
ROW_WARNING_SPEND = 100
ROW_CRITICAL_SPEND = 50

# Digest texts.
DIGEST_HEADER = {"CRITICAL": "🚨 CRITICAL ALERTS 🚨\n\n", "WARNING": "⚠️ WARNING ALERTS ⚠️\n\n"}
DIGEST_FOOTER = {"CRITICAL": "\nImmediate action recommended!",
                 "WARNING": "\nPlease review and take appropriate action."}
ANOMALY_HEADER = ("🚨 Alert: ", " campaigns have performance anomalies!\n\n")
ANOMALY_LINES = {"ctr_anomaly": "- CTR anomaly detected\n",
                 "acos_anomaly": "- ACOS anomaly detected\n",
                 "conversion_anomaly": "- Conversion rate anomaly detected\n"}

ALERT_TYPES = ["ROAS", "ACOS", "SPEND", "CAMPAIGN"]


def _alert(level: str, kind: str, message: Column, campaign_id=None, ad_group_id=None) -> Column:
    return F.struct(
        F.lit(level).alias("level"), F.lit(kind).alias("type"),
        (campaign_id if campaign_id is not None else F.lit(None).cast("string")).alias("campaign_id"),
        (ad_group_id if ad_group_id is not None else F.lit(None).cast("string")).alias("ad_group_id"),
        message.alias("message"))


def _explode_alerts(df: DataFrame, candidates: list[Column]) -> DataFrame:
    fired = F.filter(F.array(*candidates), lambda a: a.isNotNull())
    return df.select(F.explode(fired).alias("a")).select("a.*")


def account_alerts(summary: DataFrame) -> DataFrame:
    """One ROAS, one ACOS and one spend alert at most, critical before warning.

    Suppressed when the summary covers no report rows (D18).
    """
    roas, acos = F.col("overall_roas"), F.col("overall_acos")
    spend = F.col("total_spend").cast("double")
    # A ratio whose denominator was not positive is the integer 0 in the reference text.
    # Fixed values, here and in ``row_alerts``: the alert sentences, which must read as the reports' users know them.
    roas_t = F.when(F.col("total_spend") > 0, num_text(roas)).otherwise(F.lit("0"))
    acos_t = F.when(F.col("total_sales") > 0, num_text(acos)).otherwise(F.lit("0"))
    spend_t = num_text(spend)
    roas_alert = (
        F.when(roas < R["critical_low"], _alert("CRITICAL", "ROAS", text(
            "Overall ROAS is critically low at ", roas_t, f" (threshold: {R['critical_low']})")))
        .when(roas < R["warning_low"], _alert("WARNING", "ROAS", text(
            "Overall ROAS is below target at ", roas_t, f" (threshold: {R['warning_low']})"))))
    acos_alert = (
        F.when(acos > A["critical_high"], _alert("CRITICAL", "ACOS", text(
            "Overall ACOS is critically high at ", acos_t, f"% (threshold: {A['critical_high']}%)")))
        .when(acos > A["warning_high"], _alert("WARNING", "ACOS", text(
            "Overall ACOS is above target at ", acos_t, f"% (threshold: {A['warning_high']}%)"))))
    spend_alert = (
        F.when(spend > S["critical_high"], _alert("CRITICAL", "SPEND", text(
            "Daily spend is critically high at $", spend_t, f" (threshold: ${S['critical_high']})")))
        .when(spend > S["warning_high"], _alert("WARNING", "SPEND", text(
            "Daily spend is high at $", spend_t, f" (threshold: ${S['warning_high']})"))))
    return _explode_alerts(summary.filter(F.col("report_rows") > 0),
                           [roas_alert, acos_alert, spend_alert])


def row_alerts(report: DataFrame) -> DataFrame:
    """Per ad-group alerts; both may fire for one row.  Missing values count as 0."""
    spend, roas = zero_if_null("spend"), zero_if_null("roas")
    cid, gid = F.col("campaign_id"), F.col("ad_group_id")
    warning = F.when(
        (spend > ROW_WARNING_SPEND) & (roas < R["warning_low"]),
        _alert("WARNING", "CAMPAIGN", text(
            "Campaign ", cid, " has high spend ($", value_text("spend"),
            ") with low ROAS (", value_text("roas"), ")"), cid, gid))
    critical = F.when(
        (spend > ROW_CRITICAL_SPEND) & (roas < R["critical_low"]),
        _alert("CRITICAL", "CAMPAIGN", text(
            "Campaign ", cid, " has very poor performance: ROAS ", value_text("roas"),
            ", ACOS ", value_text("acos"), "%"), cid, gid))
    return _explode_alerts(report, [warning, critical])


def all_alerts(summary: DataFrame, report: DataFrame) -> DataFrame:
    """Account alerts followed by row alerts."""
    return account_alerts(summary).unionByName(row_alerts(report))


def alert_counts(alerts: DataFrame) -> DataFrame:
    """Number of alerts per level."""
    return alerts.groupBy("level").agg(F.count(F.lit(1)).alias("alert_count"))


def alert_digest(alerts: DataFrame) -> DataFrame:
    """C14: the per-level notification text as ordered fragments.

    Columns ``level, part, source, type_rank, campaign_id, ad_group_id,
    fragment``; concatenating ``fragment`` in that order gives, per level,
    header + one ``- message`` line per alert + footer.  Sorting is a
    distributed range sort, so no single task holds all alerts.
    """
    type_rank = F.array_position(F.array(*[F.lit(t) for t in ALERT_TYPES]), F.col("type"))
    body = alerts.select(
        "level", F.lit(1).alias("part"),
        F.when(F.col("type") == "CAMPAIGN", 1).otherwise(0).alias("source"),
        type_rank.alias("type_rank"), "campaign_id", "ad_group_id",
        F.concat(F.lit("- "), F.col("message"), F.lit("\n")).alias("fragment"))
    header = F.create_map(*[x for k, v in DIGEST_HEADER.items() for x in (F.lit(k), F.lit(v))])
    footer = F.create_map(*[x for k, v in DIGEST_FOOTER.items() for x in (F.lit(k), F.lit(v))])
    level = F.col("level")
    edges = (body.select("level").distinct()
             .select("level", F.explode(F.array(
                 F.struct(F.lit(0).alias("part"), header[level].alias("fragment")),
                 F.struct(F.lit(2).alias("part"), footer[level].alias("fragment")))).alias("e"))
             .select("level", "e.part", F.lit(0).alias("source"),
                     F.lit(0).cast("bigint").alias("type_rank"),
                     F.lit(None).cast("string").alias("campaign_id"),
                     F.lit(None).cast("string").alias("ad_group_id"), "e.fragment"))
    return (edges.unionByName(body)
            .orderBy("level", "part", "source", "type_rank",
                     F.asc_nulls_first("campaign_id"), F.asc_nulls_first("ad_group_id")))


def notifications(alerts: DataFrame, subject: str = "Advertising alert") -> DataFrame:
    """T3 applied to every alert: subject and message with the banner of the alert's level."""
    new_subject, new_message = with_severity(F.lit(subject), "message", "level")
    return alerts.select("level", "type", "campaign_id", "ad_group_id", new_subject.alias("subject"), new_message.alias("message"))


def anomaly_digest(flags: DataFrame, limit: int = 10) -> DataFrame:
    """Count of flagged rows and one text block for each of the first ``limit``.

    One row (``anomaly_count``, ``message``) when anything is flagged, none
    otherwise.  The count is a distributed count; only the ``limit`` blocks
    (a top-k by date, campaign, ad group) are gathered into the message.
    """
    flagged = anomalous(flags)
    block = F.concat(
        F.lit("Campaign "), F.col("campaign_id"), F.lit(" on "),
        date_text("date"), F.lit(":\n"),
        *[F.when(F.col(c) == 1, F.lit(t)).otherwise(F.lit("")) for c, t in ANOMALY_LINES.items()],
        F.lit("\n"))
    first = (flagged.orderBy("date", "campaign_id", "ad_group_id").limit(limit)
             .select(F.struct("date", "campaign_id", "ad_group_id", block.alias("text")).alias("_block")))
    rows = flagged.select(F.lit(1).alias("_one")).unionByName(first, allowMissingColumns=True)
    agg = rows.agg(F.count("_one").alias("anomaly_count"),
                   F.array_sort(F.collect_list("_block")).alias("_blocks"))
    message = F.concat(F.lit(ANOMALY_HEADER[0]), F.col("anomaly_count").cast("string"),
                       F.lit(ANOMALY_HEADER[1]),
                       F.array_join(F.transform("_blocks", lambda b: b["text"]), ""))
    return agg.filter(F.col("anomaly_count") > 0).select("anomaly_count", message.alias("message"))
