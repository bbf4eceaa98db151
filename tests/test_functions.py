import datetime as dt

from pyspark.sql import functions as F

from adlens.functions import metrics as M
from adlens.functions.dates import local_date, window_bounds, window_filter, with_event_date
from adlens.functions.text import to_number, with_severity


def one(spark, *cols):
    return spark.range(1).select(*cols).first()


def test_safe_ratio_guards_zero_and_null(spark):
    r = one(spark,
            M.safe_ratio(F.lit(5), F.lit(0)).alias("zero_den"),
            M.safe_ratio(F.lit(5), F.lit(None).cast("int")).alias("null_den"),
            M.safe_ratio(F.lit(None).cast("int"), F.lit(4)).alias("null_num"),
            M.safe_ratio(F.lit(1), F.lit(3), 100.0).alias("third"),
            M.cpc(F.lit(3.5), F.lit(0)).alias("cpc_no_clicks"))
    assert r.zero_den == 0.0 and r.null_den == 0.0
    assert r.null_num is None
    assert r.third == 33.33
    assert r.cpc_no_clicks == 0.0


def test_round_half_up_on_decimal_value(spark):
    # 19.025 and 1.005 are stored below the tie as doubles; the decimal value rounds up.
    r = one(spark, M.round_half_up(F.lit(19.025)).alias("a"), M.round_half_up(F.lit(1.005)).alias("b"),
            M.round_half_up(F.lit(-2.675)).alias("c"), M.round_half_up(F.lit(2.674999)).alias("d"))
    assert (r.a, r.b, r.c, r.d) == (19.03, 1.01, -2.68, 2.67)


def test_change_pct_rules(spark):
    r = one(spark,
            M.change_pct(F.lit(10), F.lit(0), zero_base_as_one=True).alias("imp_zero_base"),
            M.change_pct(F.lit(10), F.lit(None).cast("int"), zero_base_as_one=True).alias("imp_first"),
            M.change_pct(F.lit(10), F.lit(0)).alias("cost_zero_base"),
            M.change_pct(F.lit(0), F.lit(20)).alias("down"))
    assert r.imp_zero_base == 1000.0
    assert r.imp_first == 0.0
    assert r.cost_zero_base == 0.0
    assert r.down == -100.0


def test_num_text_prints_like_python_floats(spark):
    values = [12.5, 100.0, 0.07, 0.0, 12345678.9, -3.1, 1043.03]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = [r.t for r in df.select(M.num_text("x").alias("t")).collect()]
    assert got == [str(v) for v in values]


def test_local_date_uses_offset_of_text(spark):
    df = spark.createDataFrame([("2025-03-10T23:00:00-07:00",), ("bad",)], "time_window_start string")
    rows = with_event_date(df).collect()
    assert rows[0].event_date == dt.date(2025, 3, 10)   # UTC would say 03-11
    assert rows[0].event_ts == dt.datetime(2025, 3, 11, 6, 0)  # session zone UTC
    assert rows[1].event_date is None and rows[1].event_ts is None
    assert one(spark, local_date(F.lit("2025-03-10T00:00:00-07:00")).alias("d")).d == dt.date(2025, 3, 10)


def test_window_filter_semantics(spark):
    days = [dt.date(2024, 1, d) for d in range(1, 31)]
    df = spark.createDataFrame([(d,) for d in days], "event_date date")

    def dates(window, bounded=False):
        return sorted(r.event_date.day for r in
                      df.filter(window_filter(window, "2024-01-15", bounded=bounded)).collect())

    assert dates("today") == [15]
    assert dates("yesterday") == [14]
    assert dates("last7days") == list(range(8, 31))           # no upper bound (D16)
    assert dates("last7days", bounded=True) == list(range(8, 16))  # 8 dates, up to as_of
    assert dates("last_month") == [15]                        # unknown -> today (F4)
    assert window_bounds("last7days", "2024-01-15") == (dt.date(2024, 1, 8), dt.date(2024, 1, 15))


def test_to_number_and_severity(spark):
    df = spark.createDataFrame([("12.5", "s", "m", "CRITICAL"), ("n/a", "s", "m", "Warning"),
                                (None, "s", "m", "normal")], "t string, subject string, message string, imp string")
    subj, msg = with_severity("subject", "message", "imp")
    rows = df.select(to_number("t").alias("n"), subj.alias("s"), msg.alias("m")).collect()
    assert [r.n for r in rows] == [12.5, None, None]
    assert [r.s for r in rows] == ["CRITICAL: s", "WARNING: s", "s"]
    assert rows[0].m == "🚨 CRITICAL ALERT 🚨\n\nm"
    assert rows[1].m == "⚠️ WARNING ⚠️\n\nm"
    assert rows[2].m == "m"


def test_size_shuffles_scales_with_input(spark):
    from adlens.session import size_shuffles
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.files.maxPartitionBytes")}
    try:
        assert size_shuffles(spark, 10 << 20) == 200                    # small input: the floor
        assert size_shuffles(spark, 100 << 40) == 100_000               # 100 TB: the ceiling
        assert size_shuffles(spark, 1 << 40) == 8192                    # 1 TB / 128 MB
        assert spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum") == "8192"
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.initialPartitionNum")
