"""Declared schemas.  Nothing is inferred at run time.

Raw schemas describe the files the reports are fed from; the *canonical*
frames are what every operator consumes:

traffic     campaign_id, ad_group_id, keyword_id, keyword_text, match_type,
            time_window_start, event_date, impressions, clicks, cost
conversion  idempotency_id, campaign_id, ad_group_id, keyword_id,
            time_window_start, event_date, conversions, sales, units

``time_window_start`` is the hourly window the row belongs to (the join key
of the raw keyword report) and ``event_date`` its marketplace-local date.
"""

from __future__ import annotations

from pyspark.sql import types as T

ID = T.StringType()
COUNT = T.LongType()
MONEY = T.DecimalType(18, 4)
# Sums of money: wide enough for account totals at any scale.
MONEY_SUM = T.DecimalType(38, 4)
MONEY_2DP = T.DecimalType(38, 2)

# The driver's ``events`` table, read by the test adapter (FIXTURES.md section 6).
EVENTS = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("props", T.StringType()),
])

# Raw hourly traffic rows, as delivered (CSV or lake table).
TRAFFIC_RAW = T.StructType([
    T.StructField("campaign_id", ID),
    T.StructField("ad_group_id", ID),
    T.StructField("keyword_id", ID),
    T.StructField("keyword_text", T.StringType()),
    T.StructField("match_type", T.StringType()),
    T.StructField("time_window_start", T.StringType()),
    T.StructField("impressions", COUNT),
    T.StructField("clicks", COUNT),
    T.StructField("cost", MONEY),
])

# Raw hourly conversion rows: the columns the operators read out of the
# wide delivery (the other attribution windows are selected by name).
CONVERSION_RAW = T.StructType([
    T.StructField("idempotency_id", ID),
    T.StructField("campaign_id", ID),
    T.StructField("ad_group_id", ID),
    T.StructField("ad_id", ID),
    T.StructField("keyword_id", ID),
    T.StructField("time_window_start", T.StringType()),
    T.StructField("attributed_conversions_1d", COUNT),
    T.StructField("attributed_sales_1d", MONEY),
    T.StructField("attributed_units_ordered_1d", COUNT),
    T.StructField("attributed_conversions_7d", COUNT),
    T.StructField("attributed_sales_7d", MONEY),
    T.StructField("attributed_units_ordered_7d", COUNT),
    T.StructField("attributed_conversions_14d", COUNT),
    T.StructField("attributed_sales_14d", MONEY),
    T.StructField("attributed_units_ordered_14d", COUNT),
    T.StructField("attributed_conversions_30d", COUNT),
    T.StructField("attributed_sales_30d", MONEY),
    T.StructField("attributed_units_ordered_30d", COUNT),
    T.StructField("placement", T.StringType()),
    T.StructField("year", T.StringType()),
    T.StructField("month", T.StringType()),
    T.StructField("day", T.StringType()),
    T.StructField("hour", T.StringType()),
])

ATTRIBUTION_WINDOWS = ("1d", "7d", "14d", "30d")

# Bidding rules document: {"default_rules": [{condition, action, percentage, description}]}
RULE = T.StructType([
    T.StructField("condition", T.StringType()),
    T.StructField("action", T.StringType()),
    T.StructField("percentage", T.DoubleType()),
    T.StructField("description", T.StringType()),
])
RULES_DOCUMENT = T.StructType([T.StructField("default_rules", T.ArrayType(RULE))])
