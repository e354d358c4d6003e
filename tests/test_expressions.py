import datetime as dt

from pyspark.sql import functions as F

from helpers import T0, action, actions_df
from visitflow.functions import expressions as X
from visitflow.sources.tables import actions_in_range


def test_range_is_inclusive_and_open_ended(spark):
    rows = [action(i, f"s{i}", at=T0 + dt.timedelta(days=i)) for i in range(5)]  # 2024-01-01 .. 01-05
    df = actions_df(spark, rows)
    assert actions_in_range(df, "2024-01-02", "2024-01-04").count() == 3
    assert actions_in_range(df, "2024-01-04", None).count() == 2
    assert actions_in_range(df, None, "2024-01-01").count() == 1
    assert actions_in_range(df, "", "").count() == 5


def test_formatting_helpers(spark):
    ts = dt.datetime(2024, 3, 5, 7, 8, 9, 123000)
    df = spark.createDataFrame([(ts,)], "ts TIMESTAMP_NTZ")
    r = df.select(X.format_date("ts").alias("d"), X.format_time("ts").alias("t"), X.day_hour_key("ts").alias("k"),
                  X.compact_day("ts").alias("c"), X.timestamp_to_millis("ts").alias("ms"),
                  X.millis_to_timestamp(X.timestamp_to_millis("ts")).alias("back"),
                  X.is_before(F.col("ts"), F.lit(ts).cast("timestamp_ntz")).alias("lt"),
                  X.is_after(F.col("ts"), F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")).alias("gt"),
                  X.pad2(F.lit("7")).alias("p1"), X.pad2(F.lit("12")).alias("p2"),
                  X.trim_commas(F.lit(",1,2,")).alias("tc")).first()
    assert (r.d, r.t, r.k, r.c) == ("2024-03-05", "2024-03-05 07:08:09", "2024-03-05_07", "20240305")
    assert r.ms == 1709622489123 and r.back == ts
    assert r.lt is False and r.gt is True
    assert (r.p1, r.p2, r.tc) == ("07", "12", "1,2")
