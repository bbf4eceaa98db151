"""Daily ad-group metrics, trends and anomaly flags.

All window functions of C4 and C5 share one partitioning and order
(campaign, ad group by date), so Catalyst plans one exchange and one sort
for all of them.  A window partition holds one row per date of one ad
group, so its size is bounded by the date span, not by the data volume.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adlens.functions import metrics as M
from adlens.operators.combine import merge_totals, partial_totals, totals

DAILY_KEYS = ["campaign_id", "ad_group_id", "date"]
SERIES_KEYS = ["campaign_id", "ad_group_id"]

# Anomaly thresholds in percentage points.
ANOMALY_THRESHOLDS = {"ctr": 50.0, "acos": 30.0, "conversion_rate": 40.0}


def _dated(df: DataFrame) -> DataFrame:
    return df.withColumnRenamed("event_date", "date")


def daily_traffic(traffic: DataFrame) -> DataFrame:
    """Corrections dropped (F5), sums per ad group and date, CPC and CTR."""
    kept = _dated(traffic).filter(F.col("impressions") >= 0)
    agg = kept.groupBy(*DAILY_KEYS).agg(
        M.count_sum("impressions").alias("total_impressions"),
        M.count_sum("clicks").alias("total_clicks"),
        M.money_sum("cost").alias("total_cost"))
    return agg.withColumns({
        "cpc": M.cpc("total_cost", "total_clicks"),
        "ctr": M.ctr("total_clicks", "total_impressions"),
    })


def daily_conversions(conversion: DataFrame) -> DataFrame:
    """Conversion sums per ad group and date."""
    return _dated(conversion).groupBy(*DAILY_KEYS).agg(
        M.count_sum("conversions").alias("conversions_1d"),
        M.money_sum("sales").alias("sales_1d"),
        M.count_sum("units").alias("units_ordered_1d"))


def daily_performance(traffic: DataFrame, conversion: DataFrame) -> DataFrame:
    """C1 left-joined with C2 on ad group and date, nulls -> 0, then ACOS/ROAS/conversion rate.

    Computed as one union-aggregate (see ``combine.totals``) rather than
    two aggregates and a join; the result is the same.
    """
    kept = _dated(traffic).filter(F.col("impressions") >= 0)
    return performance_of(totals(kept, _dated(conversion), DAILY_KEYS))


def daily_partials(traffic: DataFrame, conversion: DataFrame) -> DataFrame:
    """The sums of C3 over a part of the rows, to be added to those of other parts (``performance_of_partials``)."""
    return partial_totals(_dated(traffic).filter(F.col("impressions") >= 0), _dated(conversion), DAILY_KEYS)


def performance_of_partials(partials: DataFrame) -> DataFrame:
    """C3 from partial sums; equal to ``daily_performance`` over all the rows behind them."""
    return performance_of(merge_totals(partials, DAILY_KEYS).filter("has_traffic").drop("has_traffic"))


def performance_of(t: DataFrame) -> DataFrame:
    """C3's columns from the totals per ad group and date."""
    zero = F.lit(0)
    out = t.select(
        *DAILY_KEYS, "total_impressions", "total_clicks", "total_cost",
        M.cpc("total_cost", "total_clicks").alias("cpc"),
        M.ctr("total_clicks", "total_impressions").alias("ctr"),
        F.coalesce("total_orders", zero.cast("bigint")).alias("conversions_1d"),
        F.coalesce("total_sales", zero.cast("decimal(38,4)")).alias("sales_1d"),
        F.coalesce("total_units", zero.cast("bigint")).alias("units_ordered_1d"))
    return out.withColumns({
        "acos": M.acos("total_cost", "sales_1d"),
        "roas": M.roas("sales_1d", "total_cost"),
        "conversion_rate": M.conversion_rate("conversions_1d", "total_clicks"),
    })


def _series() -> Window:
    return Window.partitionBy(*SERIES_KEYS).orderBy("date")


def trailing_avg(metric: str, rows: int) -> Column:
    """Mean of the current and ``rows`` preceding rows.

    The metrics are already rounded to cents, so they are summed exactly as
    whole cents in a BIGINT and divided once: the mean does not depend on
    summation order, and a sliding frame re-adds longs, not decimals.
    """
    frame = _series().rowsBetween(-rows, 0)
    cents = F.round(F.col(metric) * F.lit(100.0)).cast("bigint")
    # An all-null frame has count 0: null, as ``avg`` would give, never a division error.
    return F.try_divide(F.sum(cents).over(frame).cast("double") / F.lit(100.0),
                        F.count(metric).over(frame))


def performance_trends(daily: DataFrame, days: int = 7) -> DataFrame:
    """C4: trailing means of four ratios and day-over-day changes.

    The frame is ``days`` preceding *rows* plus the current one (8 rows for
    the default), and rows are dates with data: gaps are not filled (D3).
    """
    prev = _series()
    with_prev = daily.withColumns({
        "avg_ctr_7d": trailing_avg("ctr", days),
        "avg_conversion_rate_7d": trailing_avg("conversion_rate", days),
        "avg_acos_7d": trailing_avg("acos", days),
        "avg_roas_7d": trailing_avg("roas", days),
        "_prev_impressions": F.lag("total_impressions", 1).over(prev),
        "_prev_cost": F.lag("total_cost", 1).over(prev),
        "_prev_sales": F.lag("sales_1d", 1).over(prev),
    })
    return with_prev.withColumns({
        "impressions_change": M.change_pct("total_impressions", "_prev_impressions",
                                           zero_base_as_one=True),
        "cost_change": M.change_pct("total_cost", "_prev_cost"),
        "sales_change": M.change_pct("sales_1d", "_prev_sales"),
    }).drop("_prev_impressions", "_prev_cost", "_prev_sales")


def anomalies(trends: DataFrame, thresholds: dict[str, float] | None = None) -> DataFrame:
    """0/1 flags for day-over-day jumps above a threshold, and ``has_anomaly``."""
    th = dict(ANOMALY_THRESHOLDS, **(thresholds or {}))
    w = _series()

    def jump(metric: str) -> Column:
        moved = F.abs(F.col(metric) - F.lag(metric, 1).over(w)) > F.lit(th[metric])
        return F.when(moved, F.lit(1)).otherwise(F.lit(0))

    flagged = trends.withColumns({
        "ctr_anomaly": jump("ctr"),
        "acos_anomaly": jump("acos"),
        "conversion_anomaly": jump("conversion_rate"),
    })
    any_flag = ((F.col("ctr_anomaly") == 1) | (F.col("acos_anomaly") == 1)
                | (F.col("conversion_anomaly") == 1))
    return flagged.withColumn("has_anomaly", F.when(any_flag, F.lit(1)).otherwise(F.lit(0)))


def lookback_rows(rows: DataFrame, days: int = 7) -> DataFrame:
    """Each series' ``days`` newest rows."""
    newest_first = Window.partitionBy(*SERIES_KEYS).orderBy(F.desc("date"))
    return rows.withColumn("_rank", F.row_number().over(newest_first)).filter(F.col("_rank") <= days).drop("_rank")


def flags_for_recent(earlier: DataFrame, recent: DataFrame, days: int = 7) -> DataFrame:
    """C4 + C5 for the daily rows of ``recent`` only, exactly as over the whole history.

    A row's trailing mean looks back ``days`` rows of its series and its
    lags one row, so of ``earlier`` (the daily rows before ``recent``) only
    each series' ``days`` most recent rows matter: a per-series top-k
    (``row_number() <= days``, run as a partial top-k before the exchange).
    """
    lookback = lookback_rows(earlier, days).withColumn("_recent", F.lit(False))
    rows = lookback.unionByName(recent.withColumn("_recent", F.lit(True)))
    flags = anomalies(performance_trends(rows, days))
    return flags.filter(F.col("_recent")).drop("_recent")


def flags_since(perf: DataFrame, first, days: int = 7) -> DataFrame:
    """C4 + C5 for the dates from ``first`` on, out of one pass over the daily rows.

    As ``flags_for_recent``, for rows that are computed rather than read: the
    look-back rows are picked by a window over the same series, so the raw
    tables are read once and the series are exchanged once.
    """
    recent = F.col("date") >= F.lit(first).cast("date")
    series = Window.partitionBy(*SERIES_KEYS)
    rows = (perf.withColumns({"_recent": recent, "_n": F.count_if(recent).over(series),
                              "_rank": F.row_number().over(series.orderBy(F.desc("date")))})
            .filter(F.col("_rank") <= F.col("_n") + days).drop("_n", "_rank"))
    flags = anomalies(performance_trends(rows, days))
    return flags.filter(F.col("_recent")).drop("_recent")


def anomalous(flags: DataFrame) -> DataFrame:
    """F10 + P2: the flagged rows, narrowed for alerting."""
    return (flags.filter(F.col("has_anomaly") == 1)
            .select("campaign_id", "ad_group_id", "date",
                    "ctr_anomaly", "acos_anomaly", "conversion_anomaly"))
