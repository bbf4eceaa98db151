"""Partial sums of the daily table per delivered file, so that late data are added instead of read again.

The store is a snapshot table of two kinds of rows:

    kind=sums   per commit, ad group and date: the sums of C3 over the files of that commit
    kind=files  the files that have been counted

One commit holds both, so a file's sums and the note that it is counted appear
together: a batch that is replayed, after a crash or because a stream's own
checkpoint is lost, finds its files counted and adds nothing.  Two writers can't count
one file, as a commit must follow the version whose files it has looked at.

A refresh reads the sums of the dates that new files touch, never the raw rows of
earlier deliveries.  Where a date has gathered ``COMPACT_AFTER`` commits, its sums are
added up into one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlens.operators import daily
from adlens.operators.combine import merge_totals
from adlens.sources.snapshots import SnapshotTable, Version

FILE = "_file"
COMPACT_AFTER = 16
_PARTS = ["kind", "date"]


def counted_files(store: SnapshotTable, version: Version | None) -> DataFrame | None:
    """The files whose rows a version holds; None before the first commit."""
    return store.read(version).filter("kind = 'files'").select("file") if version else None


def partial_sums(store: SnapshotTable, version: Version, first_date=None) -> DataFrame:
    """The partial sums of a version, of dates from ``first_date`` on."""
    sums = store.read(version).filter("kind = 'sums'").drop("kind", "file")
    return sums if first_date is None else sums.filter(F.col("date") >= F.lit(first_date).cast("date"))


def add_files(store: SnapshotTable, traffic: DataFrame, conversion: DataFrame) -> Version | None:
    """Count the rows of files that aren't counted yet (canonical rows, ``FILE`` naming their file); the version that holds them.

    Files are taken as whole: a file's rows must all be in the frames.  Rows
    without an event date take no part.
    """
    version = store.current()
    files = traffic.select(FILE).unionByName(conversion.select(FILE)).distinct().withColumnRenamed(FILE, "file")
    known = counted_files(store, version)
    fresh = (files if known is None else files.join(known, "file", "left_anti")).checkpoint(eager=True)  # a row per new file
    if not fresh.limit(1).count():
        return version
    new = lambda rows: rows.filter("event_date is not null").join(fresh, F.col(FILE) == F.col("file"), "left_semi")
    sums = daily.daily_partials(new(traffic), new(conversion)).withColumn("kind", F.lit("sums"))
    rows = sums.unionByName(fresh.withColumn("kind", F.lit("files")), allowMissingColumns=True)
    return _compact(store, store.commit(rows, _PARTS, "append", version, must_follow=True))


def _compact(store: SnapshotTable, version: Version) -> Version:
    """One commit instead of many for the dates, and the list of files, that have gathered too many."""
    crowded = [part for part, commits in version.parts.items() if len(commits) >= COMPACT_AFTER]
    if not crowded:
        return version
    rows = store.read(Version(version.number, {p: version.parts[p] for p in crowded}, version.written, version.schema))
    sums = merge_totals(rows.filter("kind = 'sums'"), daily.DAILY_KEYS).withColumn("kind", F.lit("sums"))
    files = rows.filter("kind = 'files'").select("kind", "file")
    return store.commit(sums.unionByName(files, allowMissingColumns=True), _PARTS, "touched", version, must_follow=True)


def performance(store: SnapshotTable, version: Version, dates: DataFrame, first_date) -> DataFrame:
    """C3 of the dates in ``dates`` (``event_date``; none before ``first_date``), from partial sums alone."""
    some = dates.select(F.col("event_date").alias("date")).distinct()
    return daily.performance_of_partials(partial_sums(store, version, first_date).join(some, "date", "left_semi"))
