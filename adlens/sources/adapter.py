"""Canonical traffic and conversion frames derived from the driver's ``events`` table.

The test tables hold no advertising data, so an adapter plays the two lake
tables (FIXTURES.md section 6): ``error`` events are impression
corrections, ``purchase`` events with ``k < 10`` are refunds.  Everything is
a projection of one scan; nothing is materialised.

When a report only needs some dates, ``date_range`` adds a predicate on the
raw ``ts`` column next to the exact ``event_date`` filter, so that parquet
row groups outside the range are skipped (it shows up as ``PushedFilters``).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adlens.schema import EVENTS, MONEY

# Fixed values of the adapter (FIXTURES.md section 6).
CAMPAIGN_MODULUS = 19
MATCH_TYPES = ("EXACT", "PHRASE", "BROAD")  # k % 3 = 0, 1, 2
REFUND_BELOW_K = 10
COST_PER_CLICK_VALUE = 0.5


def read_events(spark: SparkSession, sf_dir: str, date_range=None) -> DataFrame:
    events = spark.read.schema(EVENTS).parquet(f"{sf_dir}/events.parquet")
    if date_range is not None:
        events = events.filter(ts_range(events, *date_range))
    return events


def ts_range(events: DataFrame, first, last=None):
    """``first <= date(ts) <= last`` written on ``ts`` itself, so it pushes down.

    ``last=None`` leaves the range open above.
    """
    ts_type = events.schema["ts"].dataType.simpleString()
    lo = _dt.datetime.combine(_as_date(first), _dt.time())
    cond = F.col("ts") >= F.lit(lo.isoformat(sep=" ")).cast(ts_type)
    if last is not None:
        hi = _dt.datetime.combine(_as_date(last) + _dt.timedelta(days=1), _dt.time())
        cond = cond & (F.col("ts") < F.lit(hi.isoformat(sep=" ")).cast(ts_type))
    return cond


def _as_date(d) -> _dt.date:
    return d if isinstance(d, _dt.date) else _dt.date.fromisoformat(str(d))


def _hour_start(ts):
    """Start of the hour of a TIMESTAMP_NTZ, independent of the session time zone.

    (``date_trunc`` would first convert to the session zone, so a zone with a
    half-hour offset would move every hourly window.)
    """
    return F.make_timestamp_ntz(F.year(ts), F.month(ts), F.dayofmonth(ts), F.hour(ts),
                                F.lit(0), F.lit(0))


def _base(events: DataFrame) -> DataFrame:
    return events.select(
        "event_id",
        (F.col("user_id") % CAMPAIGN_MODULUS).cast("string").alias("campaign_id"),
        F.col("user_id").cast("string").alias("ad_group_id"),
        F.col("ts").cast("date").alias("event_date"),
        _hour_start(F.col("ts")).alias("time_window_start"),
        "event_type",
        "value",
        F.get_json_object("props", "$.k").try_cast("bigint").alias("k"),
    )


def traffic_from_events(events: DataFrame) -> DataFrame:
    """Hourly traffic rows: every non-purchase event is one impression."""
    k = F.col("k")
    is_click = F.col("event_type") == "click"
    return (_base(events)
            .filter(F.col("event_type") != "purchase")
            .select(
                "campaign_id", "ad_group_id",
                k.cast("string").alias("keyword_id"),
                F.when(k % 10 != 0, F.concat(F.lit("kw "), k.cast("string"))).alias("keyword_text"),
                F.when(k % 3 == 0, F.lit(MATCH_TYPES[0]))
                 .when(k % 3 == 1, F.lit(MATCH_TYPES[1]))
                 .otherwise(F.lit(MATCH_TYPES[2])).alias("match_type"),
                "time_window_start", "event_date",
                F.when(F.col("event_type") == "error", F.lit(-1)).otherwise(F.lit(1))
                 .cast("bigint").alias("impressions"),
                F.when(is_click, F.lit(1)).otherwise(F.lit(0)).cast("bigint").alias("clicks"),
                F.when(is_click, F.col("value") * COST_PER_CLICK_VALUE).otherwise(F.lit(0))
                 .cast(MONEY).alias("cost"),
            ))


def conversion_from_events(events: DataFrame) -> DataFrame:
    """Hourly conversion rows: purchases; ``k < 10`` are refunds."""
    k = F.col("k")
    refund = k < REFUND_BELOW_K
    return (_base(events)
            .filter(F.col("event_type") == "purchase")
            .select(
                F.col("event_id").cast("string").alias("idempotency_id"),
                "campaign_id", "ad_group_id",
                k.cast("string").alias("keyword_id"),
                "time_window_start", "event_date",
                F.when(refund, F.lit(-1)).otherwise(F.lit(1)).cast("bigint").alias("conversions"),
                F.when(refund, -F.col("value")).otherwise(F.col("value")).cast(MONEY).alias("sales"),
                F.when(refund, F.lit(-1)).otherwise(F.lit(1) + k % 2).cast("bigint").alias("units"),
            ))


def ad_tables(spark: SparkSession, sf_dir: str, date_range=None) -> tuple[DataFrame, DataFrame]:
    """(traffic, conversion) over the events of ``sf_dir``."""
    events = read_events(spark, sf_dir, date_range)
    return traffic_from_events(events), conversion_from_events(events)


# DuckDB text of the same adapter, used by the oracle SQL of every query.
ORACLE_ADAPTER_SQL = """
ev as (
  select event_id, cast(user_id % 19 as varchar) as campaign_id, cast(user_id as varchar) as ad_group_id,
         cast(ts as date) as event_date, date_trunc('hour', ts) as time_window_start, event_type, value,
         try_cast(json_extract_string(props, '$.k') as bigint) as k
  from events),
traffic as (
  select campaign_id, ad_group_id, cast(k as varchar) as keyword_id,
         case when k % 10 <> 0 then concat('kw ', cast(k as varchar)) end as keyword_text,
         case when k % 3 = 0 then 'EXACT' when k % 3 = 1 then 'PHRASE' else 'BROAD' end as match_type,
         time_window_start, event_date,
         cast(case when event_type = 'error' then -1 else 1 end as bigint) as impressions,
         cast(case when event_type = 'click' then 1 else 0 end as bigint) as clicks,
         cast(case when event_type = 'click' then value * 0.5 else 0 end as decimal(18,4)) as cost
  from ev where event_type <> 'purchase'),
conversion as (
  select cast(event_id as varchar) as idempotency_id, campaign_id, ad_group_id, cast(k as varchar) as keyword_id,
         time_window_start, event_date,
         cast(case when k < 10 then -1 else 1 end as bigint) as conversions,
         cast(case when k < 10 then -value else value end as decimal(18,4)) as sales,
         cast(case when k < 10 then -1 else 1 + k % 2 end as bigint) as units
  from ev where event_type = 'purchase')
"""
