"""End-to-end jobs.

Both jobs survive executor loss without caches: the daily job reads back the
table it has just written before the digest runs, and the report job cuts
the lineage of the report rows with a reliable ``checkpoint()`` in the
shared ``spark.checkpoint.dir`` before summary, alerts and rules reuse them.
Each piece of work therefore runs once, the sink's rows included
(``write_table`` makes no sampling pass; the reference ran its ETL lineage
three times, D17).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from adlens.operators import alerts, daily, reports, rules, summary
from adlens.session import checkpoint_root
from adlens.sources import config, history, lookback, readers, snapshots


def daily_job(spark: SparkSession, traffic: DataFrame, conversion: DataFrame, output_path: str,
              days: int = 7, digest_limit: int = 10, fmt: str = "parquet",
              since=None, rejects: dict[str, Observation] | None = None) -> dict[str, DataFrame]:
    """C1 -> C2 -> C3 -> C4 -> C5, written by date (S7), then the anomaly digest.

    A full run replaces the whole table, as the reference does.  With ``since``
    (a date), only dates from ``since`` on are recomputed and replaced from the raw rows (pass raw frames pruned to
    the arrivals that can hold them); the trends of those dates look back
    into the table already written, through the state kept beside it
    (``lookback``), so the result equals a full run.  Returns the written table
    (read back) and the digest.

    Parquet output is a snapshot table: it changes at once when all is written, and a
    run that fails leaves it as it was.  Where plain files already lie at
    ``output_path``, they are replaced as plain files (``readers.write_table``).

    ``rejects``: what counts the malformed values of the feeds' files while this job
    reads them (``readers.read_csv``); the counts come back as ``rejected``.
    """
    sink = snapshots.snapshot_sink(spark, output_path) if fmt == "parquet" else None
    version = sink.current() if sink else None
    side, notes = {lookback.STATE: None}, {lookback.STATE: None}
    if since is None:
        flags = daily.anomalies(daily.performance_trends(daily.daily_performance(traffic, conversion), days))
    else:
        if fmt != "parquet":
            raise ValueError("an incremental run reads its own output back: use the parquet sink")
        first = F.lit(since).cast("date")
        recent = daily.daily_performance(traffic.filter(F.col("event_date") >= first),
                                         conversion.filter(F.col("event_date") >= first))
        if sink is None:
            # Only partitions before ``since`` are read; only those from ``since`` on are replaced.
            earlier = readers.read_parquet(spark, output_path).filter(F.col("date") < first).select(*recent.columns)
        elif version is None:
            earlier = recent.filter(F.lit(False))          # first run: no history yet
        else:
            earlier, side, notes = lookback.rows_before(sink, version, lambda: sink.read(version).select(*recent.columns), lookback.as_date(since), days)
        flags = daily.flags_for_recent(earlier, recent, days)
    if sink is None:
        readers.write_table(flags, output_path, fmt, ["date"], replace_all=since is None)
    else:
        sink.commit(flags, ["date"], "all" if since is None else "touched", version, must_follow=since is not None, side=side, notes=notes)
    written = readers.read_source(spark, output_path, fmt, schema=flags.schema)
    out = {"table": written, "digest": alerts.anomaly_digest(written, digest_limit)}
    return {**out, "rejected": readers.rejected_counts(spark, rejects)} if rejects else out


def report_job(spark: SparkSession, traffic: DataFrame, conversion: DataFrame,
               window: str = "today", as_of=None, history_path: str | None = None,
               rules_path: str | None = None, account_id: str = history.DEFAULT_ACCOUNT,
               run_timestamp=None, on_rules_error: str = "none", bounded: bool = False,
               rejects: dict[str, Observation] | None = None) -> dict[str, DataFrame]:
    """Report (C7) -> summary (C11) -> history (C17) -> alerts (C12-C14) -> bid adjustments.

    The rules are read before anything is written, so a run that fails on them
    leaves no history entry; ``on_rules_error`` says what a bad document means
    (``config.read_rules``).  ``rejects`` as in ``daily_job``.  Returns the named results; the caller decides
    which to write or send.
    """
    rule_list = config.read_rules(spark, rules_path, on_rules_error)
    checkpoint_root(spark)
    report = reports.ad_group_report(traffic, conversion, window, as_of, bounded).checkpoint(eager=True)
    summ = summary.account_summary(report).checkpoint(eager=True)
    if history_path:
        history.history_append(summ, history_path, account_id, run_timestamp)
    all_alerts = alerts.all_alerts(summ, report)
    adjustments = rules.bid_adjustments(report, rule_list)
    return {
        "report": report,
        "summary": summ,
        "alerts": all_alerts,
        "alert_digest": alerts.alert_digest(all_alerts),
        "bid_adjustments": adjustments,
        "rejected_rules": rules.rejected_rules(spark, rule_list),
        **({"rejected": readers.rejected_counts(spark, rejects)} if rejects else {}),
        "run": summ.select(F.lit(window).alias("time_window"), F.localtimestamp().alias("timestamp")),
    }


def recommendations(traffic: DataFrame, conversion: DataFrame, campaign_id=None,
                    window: str = "last7days", as_of=None, rule_list: list[dict] | None = None,
                    rules_path: str | None = None) -> DataFrame:
    """C16 with the tool's signature: campaign report (C8) for the window, then the rules.

    Rules come from ``rule_list``, else from the document at ``rules_path``, of
    which any failure gives the default rules.
    """
    if rule_list is None and rules_path is not None:
        rule_list = config.read_rules(traffic.sparkSession, rules_path, on_error="defaults")
    campaigns = reports.campaign_report(traffic, conversion, window, as_of, campaign_id, ordered=False)
    return rules.bid_recommendations(campaigns, rule_list)
