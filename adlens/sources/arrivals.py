"""Which event dates each arrival day holds, so that a report on the past reads neither earlier nor later arrivals.

Rows arrive up to weeks after their event time, so a window of event dates has no
safe upper arrival day (``readers.arrival_lower_bound`` has a lower one only).  The map
keeps the event dates that each arrival day of a feed holds, a few dozen rows a
day, in a snapshot table; a stray late row costs the reports of its own date only.  Days are entered in order, once they are closed (no more files come
for them); days that aren't entered yet are always read, and so are rows without
an arrival day.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adlens.functions.dates import local_date
from adlens.sources import readers
from adlens.sources.snapshots import SnapshotTable


class ArrivalMap:
    def __init__(self, spark: SparkSession, path: str):
        self.table = SnapshotTable(spark, path)

    def entered(self) -> DataFrame | None:
        """arrival (text) and event_date of every day entered so far."""
        return self.table.read() if self.table.current() else None

    def update(self, raw: DataFrame, closed_before: dt.date) -> None:
        """Enter the arrival days before ``closed_before`` that come after the last one entered; only their partitions are read."""
        version = self.table.current()
        day = readers.arrival_day()
        rows = raw.filter(day < F.lit(str(closed_before)))
        if version:
            rows = rows.filter(day > F.lit(version.notes["until"]))
        held = rows.select(day.alias("arrival"), local_date("time_window_start").alias("event_date")).filter("event_date is not null").distinct()
        # The last day that counts as entered is the one before ``closed_before``, whether it has rows or not.
        until = str(closed_before - dt.timedelta(days=1))
        if version is None or until > version.notes["until"]:
            self.table.commit(held.coalesce(1), replace="append", base=version, must_follow=True, notes={"until": until})

    def holds(self, first: dt.date | None, last: dt.date | None) -> Column:
        """Partition predicate: arrivals that can hold event dates from ``first`` to ``last`` (None: no bound)."""
        version = self.table.current()
        if version is None:
            return F.lit(True)
        held = self.table.read(version)
        if first is not None:
            held = held.filter(F.col("event_date") >= F.lit(first))
        if last is not None:
            held = held.filter(F.col("event_date") <= F.lit(last))
        days = sorted(r.arrival for r in held.select("arrival").distinct().collect())  # a row per arrival day
        day = readers.arrival_day()
        return F.coalesce(day.isin(days) | (day > F.lit(version.notes["until"])), F.lit(True))
