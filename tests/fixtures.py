"""Hand-made rows covering the edge cases of FIXTURES.md section 5."""

from decimal import Decimal as D

from pyspark.sql import types as T

from adlens.schema import CONVERSION_RAW, TRAFFIC_RAW
from adlens.sources.readers import prepare_conversion, prepare_traffic

CONVERSION_COLUMNS = T.StructType([CONVERSION_RAW[c] for c in (
    "idempotency_id", "campaign_id", "ad_group_id", "keyword_id", "time_window_start",
    "attributed_conversions_1d", "attributed_sales_1d", "attributed_units_ordered_1d")])

# campaign, ad group, keyword id, keyword text, match, window start, impressions, clicks, cost
TRAFFIC_ROWS = [
    ("c1", "g1", "k1", "shoes", "EXACT", "2025-03-08T05:00:00-07:00", 100, 2, D("3.50")),
    # 03-09 has no data: a gap in the series
    ("c1", "g1", "k1", "shoes", "EXACT", "2025-03-10T05:00:00-07:00", 200, 10, D("20.00")),
    ("c1", "g1", "k1", "shoes", "EXACT", "2025-03-10T06:00:00-07:00", -5, 0, D("0")),  # correction
    ("c1", "g1", "k2", "50%_off", "PHRASE", "2025-03-11T05:00:00-07:00", 0, 0, D("0")),  # zero impressions
    ("c1", "g1", "k1", "shoes", "EXACT", "2025-03-12T05:00:00-07:00", 10, 6, D("0")),
    ("c1", "g2", "k3", None, "BROAD", "2025-03-10T05:00:00-07:00", None, 1, D("9.99")),  # null impressions
    ("c1", "g2", "k3", None, "BROAD", "2025-03-10T07:00:00-07:00", 50, 0, D("1.25")),  # cost, no clicks
    ("c2", "g3", "k4", "boots", "EXACT", "2025-03-10T23:00:00-07:00", 40, 4, D("6.00")),  # near midnight
]

# id, campaign, ad group, keyword id, window start, conversions, sales, units
CONVERSION_ROWS = [
    ("e1", "c1", "g1", "k1", "2025-03-10T05:00:00-07:00", 2, D("40.00"), 2),
    ("e2", "c1", "g1", "k1", "2025-03-10T05:00:00-07:00", 1, D("10.00"), 1),  # same hour: fan-out
    ("e3", "c1", "g1", "k1", "2025-03-10T06:00:00-07:00", -1, D("-15.00"), -1),  # refund
    ("e4", "c9", "g9", "k9", "2025-03-10T05:00:00-07:00", 1, D("5.00"), 1),  # no traffic
    ("e5", "c2", "g3", "k4", "2025-03-10T23:00:00-07:00", 1, D("30.00"), 1),
]


def tables(spark, traffic_rows=TRAFFIC_ROWS, conversion_rows=CONVERSION_ROWS):
    traffic = prepare_traffic(spark.createDataFrame(traffic_rows, TRAFFIC_RAW))
    conversion = prepare_conversion(spark.createDataFrame(conversion_rows, CONVERSION_COLUMNS))
    return traffic, conversion


def by_key(rows, *keys):
    return {tuple(r[k] for k in keys): r for r in rows}
