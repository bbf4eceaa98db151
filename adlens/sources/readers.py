"""Scans, named tables, ad-hoc SQL and the partitioned sink.

Schemas are always declared.  Raw rows are turned into the canonical
frames by ``prepare_traffic`` / ``prepare_conversion``.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adlens.functions.dates import local_date
from adlens.schema import ATTRIBUTION_WINDOWS, MONEY
from adlens.sources.files import Files
from adlens.sources.snapshots import SnapshotTable, is_snapshot_table

TRAFFIC_VIEW = "traffic"
CONVERSION_VIEW = "conversion"


ARRIVAL_COLUMNS = ("year", "month", "day")


def _csv_text(spark: SparkSession, path: str) -> DataFrame:
    """Every column of the files as text; a file whose header differs in names or order is an error."""
    names = spark.read.option("header", True).option("inferSchema", False).csv(path).columns
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    return spark.read.schema(schema).option("header", True).option("enforceSchema", False).csv(path)


def _typed(text: DataFrame, f: T.StructField) -> Column:
    """One declared column of the text frame; what can't be converted is null.

    Whole numbers may be written with a fraction of zeros (``1.0``); a fraction
    that is not zero is no count.
    """
    if f.name not in text.columns:
        return F.lit(None).cast(f.dataType)
    src = F.col(f"`{f.name}`")
    if isinstance(f.dataType, (T.LongType, T.IntegerType)):
        number = src.try_cast("decimal(38,10)")
        return F.when(number == F.floor(number), number.try_cast(f.dataType))
    return src.try_cast(f.dataType)


def _rejected(text: DataFrame, f: T.StructField) -> Column:
    """The file has a value for a declared column, but none of its type."""
    return F.col(f"`{f.name}`").isNotNull() & _typed(text, f).isNull()


def read_csv(spark: SparkSession, path: str, schema: T.StructType, rejects: Observation | None = None,
             first_date=None, arrivals: Column | None = None) -> DataFrame:
    """CSV with a header row, typed by a declared schema.

    Columns are found by header name (deliveries carry many more columns, in
    their own order; all files of one path must agree on it), and nothing is
    inferred: each declared column is read as text and converted with
    ``try_cast``, so one malformed value becomes null instead of failing the job.
    A declared column the file does not have is null, as with a parquet scan.
    Arrival partition columns are kept, so a caller can prune by them.

    ``rejects`` counts the malformed values per column while the job that reads the
    frame runs, in its own scan (``rejected_counts``).  A filter above the counting is not
    pushed below it, so arrivals before ``first_date``, and those that ``arrivals`` rules out
    (``arrivals.ArrivalMap``), are pruned here, before it.
    """
    text = arrivals_since(_csv_text(spark, path), first_date)
    text = text if arrivals is None else text.filter(arrivals)
    arrival = [c for c in ARRIVAL_COLUMNS if c in text.columns and c not in schema.fieldNames()]
    if rejects is not None:
        present = [f for f in schema.fields if f.name in text.columns]
        text = text.observe(rejects, F.count("*").alias(_ROWS), *[F.count_if(_rejected(text, f)).alias(f.name) for f in present])
    return text.select(*[_typed(text, f).alias(f.name) for f in schema.fields], *arrival)


_ROWS = "_rows"


def rejected_counts(spark: SparkSession, rejects: dict[str, Observation]) -> DataFrame:
    """feed, column, rejected: the counts of the scans that a finished job made; feeds by name."""
    rows = [(feed, column, n) for feed, observed in rejects.items() for column, n in observed.get.items() if column != _ROWS]
    return spark.createDataFrame(rows, "feed string, column string, rejected long")


def rejected_rows(spark: SparkSession, path: str, schema: T.StructType, first_date=None) -> DataFrame:
    """The rows of the CSV files with a malformed value: their file, the columns at fault and the row as it is written there."""
    text = arrivals_since(_csv_text(spark, path), first_date)
    present = [f for f in schema.fields if f.name in text.columns]
    at_fault = F.filter(F.array(*[F.when(_rejected(text, f), F.lit(f.name)) for f in present]), lambda c: c.isNotNull())
    return (text.select(F.col("_metadata.file_path").alias("file"), at_fault.alias("columns"), F.to_json(F.struct(*[F.col(f"`{c}`") for c in text.columns])).alias("row"))
            .filter(F.size("columns") > 0))


def rejected_values(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """One row per declared column: how many values of the CSV files are no value of its type (a scan of its own)."""
    text = _csv_text(spark, path)
    present = [f for f in schema.fields if f.name in text.columns]
    counts = text.agg(*[F.count_if(_rejected(text, f)).alias(f.name) for f in present])
    return counts.select(F.explode(F.array(*[
        F.struct(F.lit(f.name).alias("column"), F.col(f"`{f.name}`").alias("rejected")) for f in present])).alias("r")).select("r.*")


def read_parquet(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Parquet scan (S2); of a snapshot table its current version."""
    if is_snapshot_table(spark, path):
        rows = SnapshotTable(spark, path).read()
        return rows if schema is None else rows.select(*[F.col(c) for c in schema.names])
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def read_source(spark: SparkSession, path: str, fmt: str = "csv",
                schema: T.StructType | None = None, rejects: Observation | None = None, first_date=None,
                arrivals: Column | None = None) -> DataFrame:
    """Either format by name; any other format is an error.

    ``rejects`` counts malformed CSV values (``read_csv``; parquet has none); arrivals that
    can't hold rows of ``first_date`` or later, or that ``arrivals`` rules out, are left out.
    """
    if fmt == "csv":
        if schema is None:
            raise ValueError("CSV sources need a declared schema")
        return read_csv(spark, path, schema, rejects, first_date, arrivals)
    if fmt == "parquet":
        rows = arrivals_since(read_parquet(spark, path, schema), first_date)
        return rows if arrivals is None else rows.filter(arrivals)
    raise ValueError(f"Unsupported format: {fmt}")


def prepare_traffic(raw: DataFrame, *more: Column) -> DataFrame:
    """Raw traffic rows -> canonical traffic frame (and ``more`` columns)."""
    return raw.select(
        F.col("campaign_id").cast("string"), F.col("ad_group_id").cast("string"),
        F.col("keyword_id").cast("string"), "keyword_text", "match_type",
        "time_window_start", local_date("time_window_start").alias("event_date"),
        F.col("impressions").cast("bigint"), F.col("clicks").cast("bigint"),
        F.col("cost").cast(MONEY), *more)


def prepare_conversion(raw: DataFrame, attribution: str = "1d", *more: Column) -> DataFrame:
    """Raw conversion rows -> canonical conversion frame (and ``more`` columns).

    ``attribution`` picks which attributed measures feed the reports; the
    reference always reads the ``1d`` ones.
    """
    if attribution not in ATTRIBUTION_WINDOWS:
        raise ValueError(f"attribution must be one of {ATTRIBUTION_WINDOWS}")
    return raw.select(
        F.col("idempotency_id").cast("string"),
        F.col("campaign_id").cast("string"), F.col("ad_group_id").cast("string"),
        F.col("keyword_id").cast("string"),
        "time_window_start", local_date("time_window_start").alias("event_date"),
        F.col(f"attributed_conversions_{attribution}").cast("bigint").alias("conversions"),
        F.col(f"attributed_sales_{attribution}").cast(MONEY).alias("sales"),
        F.col(f"attributed_units_ordered_{attribution}").cast("bigint").alias("units"), *more)


def arrival_lower_bound(first_date) -> Column:
    """Partition predicate on the arrival columns ``year/month/day``.

    Rows arrive after their event time, so earlier arrivals can be pruned.
    Arrival days are UTC and event dates local, up to 14 hours ahead, so the
    bound is one day before the first report date; there is no safe upper bound (late data of
    up to 30 days, SURVEY 1.3).  Rows without arrival values are kept.
    Month and day may be typed as numbers by partition discovery, so they
    are padded back to two digits before comparing.
    """
    first = first_date if isinstance(first_date, dt.date) else dt.date.fromisoformat(str(first_date))
    return F.coalesce(arrival_day() >= F.lit(str(first - dt.timedelta(days=1))), F.lit(True))


def arrival_day() -> Column:
    """The arrival columns as the text of a date."""
    def two(c: str) -> Column:
        return F.lpad(F.col(c).cast("string"), 2, "0")

    return F.concat(F.col("year").cast("string"), F.lit("-"), two("month"), F.lit("-"), two("day"))


def arrivals_since(raw: DataFrame, first_date) -> DataFrame:
    """``raw`` without arrival partitions that can't hold rows of ``first_date`` or later, where it has such partitions."""
    if first_date is None or not set(ARRIVAL_COLUMNS) <= set(raw.columns):
        return raw
    return raw.filter(arrival_lower_bound(first_date))


def table(spark: SparkSession, name: str) -> DataFrame:
    """Named table or view scan from the catalog."""
    return spark.table(name)


def register_views(traffic: DataFrame, conversion: DataFrame) -> None:
    """Expose the two canonical frames as the views ad-hoc SQL reads."""
    traffic.createOrReplaceTempView(TRAFFIC_VIEW)
    conversion.createOrReplaceTempView(CONVERSION_VIEW)


def run_sql(spark: SparkSession, query: str, **params) -> DataFrame:
    """Ad-hoc SQL over the registered views.

    Values are passed as named parameters (``:name`` markers), never pasted
    into the text (D22).  Errors raise instead of returning an error record.
    """
    return spark.sql(query, args=params or None)


def write_table(df: DataFrame, path: str, fmt: str = "parquet",
                partition_cols: list[str] | None = None,
                max_records_per_file: int = 5_000_000, replace_all: bool = False) -> None:
    """Overwrite a table (S7): with ``replace_all`` all of it, else only the partitions present in ``df``.

    Rows are rebalanced by the partition columns: each partition's rows come
    together, and AQE splits a hot one by its measured size and merges small
    ones, without a sampling pass over the rows before.

    What was there goes only once the new rows are committed, so a run that fails
    while it writes leaves the old table.  Between the commit and the removal a
    reader of plain files can meet both; a snapshot table (``snapshots``), to which
    this writes if one is at ``path``, changes from version to version at once.
    """
    spark = df.sparkSession
    if fmt == "parquet" and is_snapshot_table(spark, path):
        SnapshotTable(spark, path).commit(df, partition_cols, "all" if replace_all or not partition_cols else "touched",
                                          max_records_per_file=max_records_per_file)
        return
    files = Files(spark, path)
    whole = replace_all or not partition_cols
    before = files.data_files(path.rstrip("/")) if whole else []
    writer_df = df.hint("rebalance", *[F.col(c) for c in partition_cols]) if partition_cols else df
    writer = (writer_df.write.mode("overwrite" if partition_cols else "append").format(fmt)
              .option("partitionOverwriteMode", "dynamic")
              .option("maxRecordsPerFile", max_records_per_file))
    if fmt == "csv":
        writer = writer.option("header", True)
    if partition_cols:
        writer = writer.partitionBy(*partition_cols)
    writer.save(path)
    for file in before:  # those of replaced partitions are gone already
        files.delete(file)
