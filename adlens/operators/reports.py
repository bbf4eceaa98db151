"""Window reports at ad-group, campaign, account and keyword grain.

C7-C9 are one builder with a different list of keys.  The report window
and the optional campaign filter are applied to both sides before they are
aggregated; for an equality on a join key this is the same as filtering
after the left join, and it lets the predicate reach the scans.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adlens.functions import metrics as M
from adlens.functions.dates import text_window_filter, window_filter
from adlens.operators.combine import totals
from adlens.session import checkpoint_root

AD_GROUP_KEYS = ["campaign_id", "ad_group_id"]
CAMPAIGN_KEYS = ["campaign_id"]
KEYWORD_KEYS = ["campaign_id", "keyword_id", "keyword_text", "match_type"]
RAW_JOIN_KEYS = ["campaign_id", "ad_group_id", "time_window_start"]


def _scope(df: DataFrame, window: str | None, as_of, campaign_id, bounded: bool) -> DataFrame:
    """Rows of the report window (all rows for ``window=None``) and the campaign, if any (null or empty: all).

    On raw rows, whose window start is ISO text, the window also goes in as a
    range on that text, which the scan can use to skip files and row groups.
    """
    if window is not None:
        df = df.filter(window_filter(window, as_of, bounded=bounded))
        if isinstance(df.schema["time_window_start"].dataType, T.StringType):
            df = df.filter(text_window_filter(window, as_of, bounded=bounded))
    if campaign_id not in (None, ""):
        df = df.filter(F.col("campaign_id") == F.lit(str(campaign_id)))
    return df


def window_report(traffic: DataFrame, conversion: DataFrame, keys: list[str],
                  window: str = "today", as_of=None, campaign_id=None,
                  bounded: bool = False) -> DataFrame:
    """Traffic sums left-joined with conversion sums over a report window, plus ratios.

    Conversion-side values stay null for groups without conversions, and
    then so do ``roas`` and ``conversion`` while ``acos`` is 0 (D8).
    """
    t = _scope(traffic, window, as_of, campaign_id, bounded)
    c = _scope(conversion, window, as_of, campaign_id, bounded)
    return totals(t, c, keys).select(
        *keys,
        F.col("total_impressions").alias("total_impression"),
        F.col("total_clicks").alias("total_click"),
        M.money_2dp("total_cost").alias("spend"),
        F.col("total_orders").alias("total_order"),
        M.money_2dp("total_sales").alias("sales"),
        "total_units",
        M.acos("total_cost", "total_sales").alias("acos"),
        M.roas("total_sales", "total_cost").alias("roas"),
        M.conversion_rate("total_orders", "total_clicks").alias("conversion"),
        M.ctr("total_clicks", "total_impressions").alias("ctr"),
    )


def ad_group_report(traffic, conversion, window="today", as_of=None, bounded=False) -> DataFrame:
    """One row per campaign and ad group with traffic in the window."""
    return window_report(traffic, conversion, AD_GROUP_KEYS, window, as_of, bounded=bounded)


def campaign_report(traffic, conversion, window="today", as_of=None, campaign_id=None,
                    bounded=False, ordered: bool = True) -> DataFrame:
    """One row per campaign, largest (rounded) spend first (O1)."""
    out = window_report(traffic, conversion, CAMPAIGN_KEYS, window, as_of, campaign_id, bounded)
    return out.orderBy(F.desc_nulls_last("spend"), "campaign_id") if ordered else out


def account_report(traffic, conversion, window="today", as_of=None, bounded=False) -> DataFrame:
    """Exactly one row; conversions count even without traffic."""
    return window_report(traffic, conversion, [], window, as_of, bounded=bounded)


def _keyword_traffic(traffic, window, as_of, campaign_id, keyword, bounded) -> DataFrame:
    t = _scope(traffic, window, as_of, campaign_id, bounded).filter(F.col("keyword_text").isNotNull())
    if keyword:
        # Case-sensitive substring; % and _ in the keyword stay wildcards (F7).  No
        # escape character there, so ours is one the keyword doesn't have.
        escape = next(c for c in map(chr, range(1, 0x110000)) if c not in keyword)
        t = t.filter(F.like(F.col("keyword_text"), F.lit(f"%{keyword}%"), F.lit(escape)))
    return t


def _keyword_attributed(t: DataFrame, c: DataFrame) -> DataFrame:
    """Each side summed by campaign and keyword id, then conversions attributed by that id, once.

    A keyword id seen with several texts or match types is one row, with the
    newest pair, so a sale never counts twice.
    """
    newest = F.max(F.struct("time_window_start", "keyword_text", "match_type"))
    tk = t.groupBy("campaign_id", "keyword_id").agg(
        newest["keyword_text"].alias("keyword_text"), newest["match_type"].alias("match_type"),
        M.count_sum("impressions").alias("impressions"),
        M.count_sum("clicks").alias("clicks"),
        M.money_sum("cost").alias("cost"))
    ck = (c.filter(F.col("campaign_id").isNotNull() & F.col("keyword_id").isNotNull())
          .groupBy("campaign_id", "keyword_id").agg(
              M.count_sum("conversions").alias("conversions"),
              M.money_sum("sales").alias("sales")))
    return tk.join(ck, ["campaign_id", "keyword_id"], "left")


def _keyword_as_written(t: DataFrame, c: DataFrame) -> DataFrame:
    """The reference's raw many-to-many join, without materialising any pair.

    Joining traffic rows to every conversion row of the same campaign, ad
    group and hour multiplies each traffic measure by the number of
    matching conversion rows (or 1 when there is none), and adds to each
    traffic row the conversion sums of its hour.  So conversions are
    reduced to (rows, sums) per hour first, traffic to (rows, sums) per
    hour and keyword, and the join becomes many-to-one: the output and the
    shuffle stay linear in the input however hot an hour is.
    """
    per_hour = c.groupBy(*RAW_JOIN_KEYS).agg(
        F.count(F.lit(1)).alias("_matches"),
        F.sum("conversions").alias("_conversions"),
        M.money_sum("sales").alias("_sales"))
    per_kw_hour = t.groupBy(*RAW_JOIN_KEYS, *[k for k in KEYWORD_KEYS if k != "campaign_id"]).agg(
        F.count(F.lit(1)).alias("_rows"),
        F.sum("impressions").alias("_impressions"),
        F.sum("clicks").alias("_clicks"),
        M.money_sum("cost").alias("_cost"))
    fan = F.coalesce(F.col("_matches"), F.lit(1))
    joined = per_kw_hour.join(per_hour, RAW_JOIN_KEYS, "left")
    return joined.groupBy(*KEYWORD_KEYS).agg(
        F.sum(F.col("_impressions") * fan).cast("bigint").alias("impressions"),
        F.sum(F.col("_clicks") * fan).cast("bigint").alias("clicks"),
        M.money_sum(F.col("_cost") * fan).alias("cost"),
        F.sum(F.col("_conversions") * F.col("_rows")).cast("bigint").alias("conversions"),
        M.money_sum(F.col("_sales") * F.col("_rows")).alias("sales"))


def keyword_report(traffic: DataFrame, conversion: DataFrame, window: str = "today", as_of=None,
                   campaign_id=None, keyword: str | None = None, limit: int | None = 10,
                   mode: str = "attributed", bounded: bool = False) -> DataFrame:
    """Keyword performance, top ``limit`` by cost (O2).

    ``mode="attributed"`` (default) sums each side by campaign and keyword id
    and joins on them.  ``mode="as_written"`` reproduces the
    reference's join of raw rows on campaign, ad group and hour, fan-out
    included (D9).
    """
    t = _keyword_traffic(traffic, window, as_of, campaign_id, keyword, bounded)
    c = _scope(conversion, window, as_of, campaign_id, bounded)
    if mode == "attributed":
        sums = _keyword_attributed(t, c)
    elif mode == "as_written":
        sums = _keyword_as_written(t, c)
    else:
        raise ValueError(f"unknown keyword report mode: {mode}")
    out = sums.select(
        *KEYWORD_KEYS, "impressions", "clicks", "cost", "conversions", "sales",
        M.acos("cost", "sales").alias("acos"),
        M.roas("sales", "cost").alias("roas"),
        M.conversion_rate("conversions", "clicks").alias("conversion_rate"),
        M.ctr("clicks", "impressions").alias("ctr"))
    ordered = out.orderBy(F.desc_nulls_last("cost"), *[F.asc_nulls_last(k) for k in KEYWORD_KEYS])
    return ordered if limit is None else ordered.limit(limit)



def with_positions(ordered: DataFrame, name: str = "position") -> DataFrame:
    """The rows of a sorted report with their place in it, from 1.

    Places are counted per partition and shifted by the sizes of the partitions
    before (one row each), so the report is never brought into one task.
    """
    checkpoint_root(ordered.sparkSession)
    rows = ordered.withColumn("_at", F.monotonically_increasing_id()).checkpoint(eager=True)  # partition number << 33, plus the place in it
    part = F.shiftright("_at", 33)
    sizes = rows.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    before = sizes.withColumn("_before", F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    placed = rows.withColumn("_part", part).join(F.broadcast(before.drop("_n")), "_part")
    return placed.withColumn(name, F.col("_before") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)) + 1).drop("_part", "_at", "_before")
