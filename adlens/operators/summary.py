"""Account summary over report rows.

One aggregation pass, one output row (per ``by`` group).  The overall
ratios are ratios of sums of the *already rounded* per-row spend and sales
(D13); those sums are exact DECIMAL sums, so the result does not depend on
how rows are spread over partitions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adlens.functions.metrics import MONEY_2DP, round_half_up

# The alert and distribution thresholds that are read.
THRESHOLDS = {
    "ROAS": {"critical_low": 1.0, "warning_low": 2.0, "good": 4.0},
    "ACOS": {"critical_high": 50.0, "warning_high": 35.0, "good": 20.0},
    "Daily_Spend": {"warning_high": 500.0, "critical_high": 1000.0},
}

SUMMARY_COLUMNS = ["total_campaigns", "total_ad_groups", "total_impressions", "total_clicks",
                   "total_spend", "total_orders", "total_sales", "total_units", "overall_acos",
                   "overall_roas", "overall_conversion", "overall_ctr"]


def _ratio_of_sums(num: Column, den: Column, percent: bool) -> Column:
    # Divide, then scale: the order the reference uses for the overall ratios.
    q = num.cast("double") / den.cast("double")
    if percent:
        q = q * F.lit(100.0)
    return F.when(den > 0, round_half_up(q)).otherwise(F.lit(0.0))


def account_summary(report: DataFrame, by: list[str] | None = None) -> DataFrame:
    """C11 over C7 rows: counts, totals, overall ratios and two distributions.

    Null ratios fall in no distribution bucket (A9, A10).  Empty input gives
    one row of zeros with ``report_rows = 0`` (D18).
    """
    by = list(by or [])
    roas, acos = F.col("roas"), F.col("acos")
    r, a = THRESHOLDS["ROAS"], THRESHOLDS["ACOS"]
    agg = [
        F.count_distinct("campaign_id").alias("total_campaigns"),
        F.count_distinct("ad_group_id").alias("total_ad_groups"),
        F.sum("total_impression").alias("_impressions"),
        F.sum("total_click").alias("_clicks"),
        F.sum("spend").alias("_spend"),
        F.sum("total_order").alias("_orders"),
        F.sum("sales").alias("_sales"),
        F.sum("total_units").alias("_units"),
        F.count(F.lit(1)).alias("report_rows"),
        F.count_if(roas < r["warning_low"]).alias("_roas_low"),
        F.count_if((roas >= r["warning_low"]) & (roas < r["good"])).alias("_roas_avg"),
        F.count_if(roas >= r["good"]).alias("_roas_high"),
        F.count_if(acos > a["warning_high"]).alias("_acos_high"),
        F.count_if((acos <= a["warning_high"]) & (acos > a["good"])).alias("_acos_target"),
        F.count_if(acos <= a["good"]).alias("_acos_low"),
    ]
    grouped = report.groupBy(*by).agg(*agg) if by else report.agg(*agg)
    zero_i = F.lit(0).cast("bigint")
    zero_m = F.lit(0).cast(MONEY_2DP)
    spend = F.coalesce(F.col("_spend").cast(MONEY_2DP), zero_m)
    sales = F.coalesce(F.col("_sales").cast(MONEY_2DP), zero_m)
    impressions = F.coalesce(F.col("_impressions").cast("bigint"), zero_i)
    clicks = F.coalesce(F.col("_clicks").cast("bigint"), zero_i)
    orders = F.coalesce(F.col("_orders").cast("bigint"), zero_i)
    return grouped.select(
        *by,
        "total_campaigns", "total_ad_groups",
        impressions.alias("total_impressions"),
        clicks.alias("total_clicks"),
        spend.alias("total_spend"),
        orders.alias("total_orders"),
        sales.alias("total_sales"),
        F.coalesce(F.col("_units").cast("bigint"), zero_i).alias("total_units"),
        _ratio_of_sums(spend, sales, True).alias("overall_acos"),
        _ratio_of_sums(sales, spend, False).alias("overall_roas"),
        _ratio_of_sums(orders, clicks, True).alias("overall_conversion"),
        _ratio_of_sums(clicks, impressions, True).alias("overall_ctr"),
        F.struct(F.col("_roas_low").alias("low_performing"),
                 F.col("_roas_avg").alias("average_performing"),
                 F.col("_roas_high").alias("high_performing")).alias("roas_distribution"),
        F.struct(F.col("_acos_high").alias("high_acos"),
                 F.col("_acos_target").alias("target_acos"),
                 F.col("_acos_low").alias("low_acos")).alias("acos_distribution"),
        "report_rows",
    )
