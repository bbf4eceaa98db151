"""Keep the daily table current as hourly files land (an addition; SURVEY 7.6).

The reference reads its hourly delivery tables as batch tables; rows arrive
up to ~30 days after their event time (SURVEY 1.3).  A stateful streaming
aggregation would have to hold 30 days of state, so instead a Structured
Streaming query watches both raw folders and, per micro-batch, recomputes
the daily performance (C3) of only the dates that the new files touch,
from the full tables, and overwrites just those date partitions.  The
result is exactly the batch result; no state is kept besides the file
source's checkpoint.  Of the touched dates only the earliest reaches the driver.
With a store of partial sums per file (``deltas``) the raw rows of earlier
deliveries aren't read again.
When the raw folders are partitioned by arrival day (``year/month/day``),
arrivals before the earliest touched date are pruned from the recompute.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from adlens.functions.dates import local_date
from adlens.operators import daily
from adlens.schema import CONVERSION_RAW, TRAFFIC_RAW
from adlens.session import checkpoint_root
from adlens.sources import lookback, readers, snapshots
from adlens.streaming import deltas


def touched_performance(traffic: DataFrame, conversion: DataFrame, dates: DataFrame) -> DataFrame:
    """C3 for the dates in ``dates`` (a frame with ``event_date``), however many they are."""
    some = dates.select("event_date").distinct()
    return daily.daily_performance(traffic.join(some, "event_date", "left_semi"),
                                   conversion.join(some, "event_date", "left_semi"))


def refresh_dates(traffic: DataFrame, conversion: DataFrame, dates: DataFrame, output_path: str,
                  fmt: str = "parquet") -> None:
    """Recompute C3 for ``dates`` and replace those partitions of ``output_path``."""
    readers.write_table(touched_performance(traffic, conversion, dates), output_path, fmt, ["date"])


def refresh_flags(spark: SparkSession, daily_path: str, flags_path: str, first_date,
                  days: int = 7) -> None:
    """Recompute trends and anomaly flags (C4, C5) for dates >= ``first_date`` only.

    Earlier dates of the daily table feed only each series' look-back rows, which
    are kept beside the flags (``lookback``), so what is read doesn't grow with the
    history; the result equals a full recompute and only the partitions from
    ``first_date`` on are replaced.
    """
    table = readers.read_parquet(spark, daily_path)
    first = F.lit(first_date).cast("date")
    recent = table.filter(F.col("date") >= first)
    sink = snapshots.snapshot_sink(spark, flags_path)
    if sink is None:
        flags = daily.flags_for_recent(table.filter(F.col("date") < first), recent, days)
        readers.write_table(flags, flags_path, "parquet", ["date"])
        return
    version = sink.current()
    earlier, side, notes = lookback.rows_before(sink, version, lambda: table, lookback.as_date(first_date), days)
    sink.commit(daily.flags_for_recent(earlier, recent, days), ["date"], "touched", version, must_follow=True, side=side, notes=notes)


def _arrivals(spark: SparkSession, path: str, schema) -> DataFrame:
    # Parquet files are matched to the schema by column name; only the window start is read.
    only = T.StructType([schema["time_window_start"]])
    return (spark.readStream.schema(only).parquet(path)
            .select(local_date("time_window_start").alias("event_date")))


def _rows(spark: SparkSession, path: str, schema, prepare, feed: str) -> DataFrame:
    """Canonical rows of one feed, as a struct of the feed's name, with their file."""
    rows = prepare(spark.readStream.schema(schema).parquet(path), F.col("_metadata.file_path").alias(deltas.FILE))
    return rows.select(F.lit(feed).alias("_feed"), F.struct(*[c for c in rows.columns if c != deltas.FILE]).alias(feed), deltas.FILE)


def start_daily_refresh(spark: SparkSession, traffic_path: str, conversion_path: str, output_path: str,
                        checkpoint_path: str, attribution: str = "1d",
                        available_now: bool = True,
                        traffic_table: Callable[[], DataFrame] | None = None,
                        conversion_table: Callable[[], DataFrame] | None = None,
                        flags_path: str | None = None, deltas_path: str | None = None) -> StreamingQuery:
    """Start the refresh stream over the raw traffic and conversion parquet folders.

    ``available_now`` processes what has landed and stops (scheduled use);
    otherwise the query keeps running.  ``checkpoint_path`` must be on the
    shared file system so a restarted driver resumes where it stopped.  With
    ``flags_path``, the trends and anomaly flags are refreshed as well, from
    the earliest touched date on (``refresh_flags``).  With ``deltas_path``, partial
    sums per file are kept there (``deltas``), and a batch reads its own files and
    the sums of the dates it touches instead of all rows of those dates.
    """
    def full_traffic(first_date=None) -> DataFrame:
        if traffic_table:
            return traffic_table()
        raw = readers.read_source(spark, traffic_path, "parquet", TRAFFIC_RAW)
        return readers.prepare_traffic(readers.arrivals_since(raw, first_date))

    def full_conversion(first_date=None) -> DataFrame:
        if conversion_table:
            return conversion_table()
        raw = readers.read_source(spark, conversion_path, "parquet", CONVERSION_RAW)
        return readers.prepare_conversion(readers.arrivals_since(raw, first_date), attribution)

    def process(batch: DataFrame, batch_id: int) -> None:
        touched = batch.filter(F.col("event_date").isNotNull()).select("event_date").distinct()
        touched = touched.checkpoint(eager=True)      # a row per date; the batch is read once
        first = touched.agg(F.min("event_date").alias("first")).first()["first"]
        if first is None:
            return
        from_first = F.col("event_date") >= F.lit(first)
        refresh_dates(full_traffic(first).filter(from_first), full_conversion(first).filter(from_first),
                      touched, output_path)
        if flags_path:
            refresh_flags(spark, output_path, flags_path, first)

    def process_deltas(batch: DataFrame, batch_id: int) -> None:
        traffic = batch.filter("_feed = 't'").select("t.*", deltas.FILE)
        conversion = batch.filter("_feed = 'c'").select("c.*", deltas.FILE)
        store = snapshots.SnapshotTable(spark, deltas_path)
        # Dates of counted files, too: their partitions may not have been written before a crash.
        both = traffic.select("event_date").unionByName(conversion.select("event_date"))
        touched = both.filter("event_date is not null").distinct().checkpoint(eager=True)
        version = deltas.add_files(store, traffic, conversion)
        first = touched.agg(F.min("event_date").alias("first")).first()["first"]
        if first is None:
            return
        readers.write_table(deltas.performance(store, version, touched, first), output_path, "parquet", ["date"])
        if flags_path:
            refresh_flags(spark, output_path, flags_path, first)

    checkpoint_root(spark)
    if deltas_path:
        arrivals = (_rows(spark, traffic_path, TRAFFIC_RAW, readers.prepare_traffic, "t")
                    .unionByName(_rows(spark, conversion_path, CONVERSION_RAW, lambda raw, *more: readers.prepare_conversion(raw, attribution, *more), "c"),
                                 allowMissingColumns=True))
        process = process_deltas
    else:
        arrivals = (_arrivals(spark, traffic_path, TRAFFIC_RAW)
                    .unionByName(_arrivals(spark, conversion_path, CONVERSION_RAW)))
    writer = (arrivals.writeStream.foreachBatch(process)
              .option("checkpointLocation", checkpoint_path))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
