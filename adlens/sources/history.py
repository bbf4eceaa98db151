"""Performance history: append summaries, read back the newest ones.

The history is a snapshot table on the shared file system (one row per
summary), instead of one JSON document rewritten on every run: an append adds a
folder, racing appends both count, and retention is a window over the table,
on reading and, every few appends, in the store itself.
Keeping the newest ``keep`` entries per account is ``row_number <= keep``,
which Spark runs as a per-partition top-k before the exchange
(``WindowGroupLimit``), so the kept set is bounded whatever the history size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from adlens.operators.summary import SUMMARY_COLUMNS
from adlens.sources import snapshots

HISTORY_KEEP = 30
DEFAULT_ACCOUNT = "default"

_COUNT, _MONEY, _RATIO = T.LongType(), T.DecimalType(38, 2), T.DoubleType()
_TYPES = {"total_spend": _MONEY, "total_sales": _MONEY, "overall_acos": _RATIO,
          "overall_roas": _RATIO, "overall_conversion": _RATIO, "overall_ctr": _RATIO}
HISTORY_SCHEMA = T.StructType(
    [T.StructField("account_id", T.StringType()), T.StructField("timestamp", T.TimestampNTZType())]
    + [T.StructField(c, _TYPES.get(c, _COUNT)) for c in SUMMARY_COLUMNS]
    + [T.StructField("roas_distribution", T.StructType([
          T.StructField(n, _COUNT) for n in ("low_performing", "average_performing", "high_performing")])),
       T.StructField("acos_distribution", T.StructType([
          T.StructField(n, _COUNT) for n in ("high_acos", "target_acos", "low_acos")]))])


def as_history(summary: DataFrame, account_id=DEFAULT_ACCOUNT, timestamp=None) -> DataFrame:
    """Summary rows shaped as history entries, stamped with ``timestamp`` (default: now, DT7)."""
    acc = F.col(account_id) if account_id in summary.columns else F.lit(account_id)
    if timestamp is None:
        ts = F.localtimestamp()
    elif isinstance(timestamp, str) and timestamp in summary.columns:
        ts = F.col(timestamp).cast("timestamp_ntz")
    else:
        ts = F.lit(timestamp).cast("timestamp_ntz")
    return summary.select(*[
        (acc if f.name == "account_id" else ts if f.name == "timestamp" else F.col(f.name))
        .cast(f.dataType).alias(f.name) for f in HISTORY_SCHEMA.fields])


# Which of two entries with one timestamp was written last; kept in the table, not returned.
WRITTEN_AT = T.StructField("written_at", T.TimestampNTZType())


COMPACT_AFTER = 16  # appends that lie beside each other before they become one folder


def history_append(summary: DataFrame, path: str, account_id=DEFAULT_ACCOUNT, timestamp=None,
                   keep: int = HISTORY_KEEP, compact_after: int | None = None) -> None:
    """Append stamped summaries to the history table, which keeps the newest ``keep`` per account.

    Pass the run's scheduled time as ``timestamp`` to make a retried run
    harmless: one entry per account and timestamp counts, the one written last.

    The history is a snapshot table.  An append adds a folder; every ``compact_after`` (``COMPACT_AFTER``)
    of them are rewritten as one that holds only what is retained, in the commit of the append
    that comes then.  So the files stay few, however many runs there were.  A table of
    plain files is appended to as it is.
    """
    entries = as_history(summary, account_id, timestamp).withColumn(WRITTEN_AT.name, F.localtimestamp())
    sink = snapshots.snapshot_sink(summary.sparkSession, path)
    if sink is None:
        entries.write.mode("append").parquet(path)
        return
    while True:
        version = sink.current()
        if version is None or len(version.folders()) < (compact_after or COMPACT_AFTER):
            sink.commit(entries, replace="append")
            return
        both = sink.read(version).unionByName(entries)
        try:
            sink.commit(latest(last_written(both, drop=False), keep).coalesce(1), replace="all", base=version, must_follow=True)
            return
        except snapshots.ConflictError:
            continue  # another append came first: retain from what is there now


def latest(history: DataFrame, keep: int = HISTORY_KEEP) -> DataFrame:
    """The newest ``keep`` entries of each account, given one entry per account and timestamp."""
    w = Window.partitionBy("account_id").orderBy(F.desc("timestamp"))
    return history.withColumn("_rank", F.row_number().over(w)).filter(F.col("_rank") <= keep).drop("_rank")


def last_written(history: DataFrame, drop: bool = True) -> DataFrame:
    """One entry per account and timestamp: of a run and its retries, the last."""
    w = Window.partitionBy("account_id", "timestamp").orderBy(F.desc_nulls_last(WRITTEN_AT.name))
    one = history.withColumn("_rank", F.row_number().over(w)).filter(F.col("_rank") == 1).drop("_rank")
    return one.drop(WRITTEN_AT.name) if drop else one


def history_read(spark: SparkSession, path: str, keep: int = HISTORY_KEEP) -> DataFrame:
    """The retained history; an empty history when none was written yet."""
    if snapshots.is_snapshot_table(spark, path):
        return latest(last_written(snapshots.SnapshotTable(spark, path).read()), keep)
    try:
        history = spark.read.schema(T.StructType([*HISTORY_SCHEMA.fields, WRITTEN_AT])).parquet(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e) and "Path does not exist" not in str(e):
            raise
        return spark.createDataFrame([], HISTORY_SCHEMA)
    return latest(last_written(history), keep)
