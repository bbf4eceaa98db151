"""Traffic + conversion totals at any grain, in one shuffle.

The reference aggregates each side and then left-joins the two aggregates
(J1-J4).  Here both sides are projected to one shape, unioned and
aggregated once: a single partial-aggregate -> exchange -> final-aggregate
instead of two of them plus a sort-merge join.  The left-join result is
kept exactly:

* only groups that have traffic rows survive (``bool_or`` of a traffic
  marker), so conversions without traffic vanish as in the join (D7);
* a group without conversion rows has null conversion sums (D8);
* conversion rows with a null key are dropped, since a null key never
  matches in an equi-join (traffic rows with a null key are kept).

With no keys the result is the one-row cross join of two global
aggregates (J4): every conversion counts and no traffic is needed.

A key that holds a third of all rows is harmless: partial aggregation
collapses it to one row per map task before the exchange.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlens.functions.metrics import count_sum, money_sum

TRAFFIC_MEASURES = ("impressions", "clicks", "cost")
CONVERSION_MEASURES = ("conversions", "sales", "units")


def totals(traffic: DataFrame, conversion: DataFrame, keys: list[str]) -> DataFrame:
    """keys + total_impressions, total_clicks, total_cost, total_orders, total_sales, total_units."""
    keys = list(keys)
    rows = _rows(traffic, conversion, keys)
    if not keys:
        return rows.agg(*_measures())
    return (rows.groupBy(*keys)
            .agg(*_measures(), F.bool_or("_has_traffic").alias("_has_traffic"))
            .filter(F.col("_has_traffic"))
            .drop("_has_traffic"))


def partial_totals(traffic: DataFrame, conversion: DataFrame, keys: list[str]) -> DataFrame:
    """``totals`` of a part of the rows, to be added to those of other parts: groups without traffic in this part stay, marked."""
    return _rows(traffic, conversion, keys).groupBy(*keys).agg(*_measures(), F.coalesce(F.bool_or("_has_traffic"), F.lit(False)).alias("has_traffic"))


def merge_totals(partials: DataFrame, keys: list[str]) -> DataFrame:
    """One row per group, marked still: sums of sums; a measure that no part has a value of stays null."""
    money = [c for c, t in partials.dtypes if t.startswith("decimal")]
    measures = [F.sum(c).cast("decimal(38,4)" if c in money else "bigint").alias(c) for c in TOTALS]
    return partials.groupBy(*keys).agg(*measures, F.bool_or("has_traffic").alias("has_traffic"))


TOTALS = ("total_impressions", "total_clicks", "total_cost", "total_orders", "total_sales", "total_units")


def _rows(traffic: DataFrame, conversion: DataFrame, keys: list[str]) -> DataFrame:
    t = traffic.select(*keys, *TRAFFIC_MEASURES, F.lit(True).alias("_has_traffic"))
    c = conversion
    if keys:
        c = c.filter(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys]))
    return t.unionByName(c.select(*keys, *CONVERSION_MEASURES), allowMissingColumns=True)


def _measures() -> list:
    return [
        count_sum("impressions").alias("total_impressions"),
        count_sum("clicks").alias("total_clicks"),
        money_sum("cost").alias("total_cost"),
        count_sum("conversions").alias("total_orders"),
        money_sum("sales").alias("total_sales"),
        count_sum("units").alias("total_units"),
    ]
