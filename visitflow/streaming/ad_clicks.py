"""Real-time ad clicks (S5, S6, T1, T2, T3, A19) on Structured Streaming.

Messages are text lines ``<epoch millis> <province> <city> <user id> <ad id>``.

* ``parse_ad_messages`` (T1) is a per-row built-in expression, identical for a
  batch or a streaming DataFrame; malformed lines are kept apart, not dropped
  silently (``ad_message_rejects``).
* ``daily_counts`` (A19) and ``windowed_counts`` (T2, per 5-second event-time
  window) are aggregates of any set of clicks.
* ``count_to_sink`` keeps either of them running (T2, T3): each micro-batch is
  counted by itself and the sink (S6, ``visitflow.streaming.sink``) adds the
  batches up and folds them. No streaming state is held, so nothing grows with
  the days and no click is too late to count.
* ``running_daily_counts`` is T3 kept as Spark's streaming state instead, for
  sinks that need totals. The day is a 1-day event-time window, so with a
  watermark Spark drops the state of closed days, and later clicks with it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from visitflow.config import new_subdir
from visitflow.functions.expressions import (compact_day, instant_to_ntz, millis_to_timestamp,
                                             ntz_to_instant, timestamp_to_millis)
from visitflow.streaming.sink import DELTA, UpsertSink

DAY_KEYS = ("day", "user_id", "ad_id")
WINDOW_KEYS = ("window_start", "user_id", "ad_id")


# ------------------------------------------------------------------ parsing
def _parts(value: Column) -> Column:
    return F.split(value, " ", -1)


def with_parsed_fields(messages: DataFrame, value_col: str = "value") -> DataFrame:
    """Adds typed fields and ``is_valid`` (exactly 5 fields, numeric ts/ids)."""
    p = _parts(F.col(value_col))
    ms = p[0].try_cast("bigint")
    user = p[3].try_cast("bigint")
    ad = p[4].try_cast("bigint")
    ok = (F.size(p) == 5) & ms.isNotNull() & user.isNotNull() & ad.isNotNull()
    return messages.select(
        F.col(value_col),
        F.when(ok, millis_to_timestamp(ms)).alias("event_time"),
        F.when(ok, p[1]).alias("province"),
        F.when(ok, p[2]).alias("city"),
        F.when(ok, user).alias("user_id"),
        F.when(ok, ad).alias("ad_id"),
        F.coalesce(ok, F.lit(False)).alias("is_valid"))


def parse_ad_messages(messages: DataFrame, value_col: str = "value") -> DataFrame:
    """Valid messages as (event_time, day, day_key 'yyyyMMdd', province,
    city, user_id, ad_id)."""
    parsed = with_parsed_fields(messages, value_col).where("is_valid")
    return parsed.select("event_time", F.to_date("event_time").alias("day"),
                         compact_day("event_time").alias("day_key"),
                         "province", "city", "user_id", "ad_id")


def ad_message_rejects(messages: DataFrame, value_col: str = "value") -> DataFrame:
    """Malformed messages counted (one row: reject_count)."""
    return with_parsed_fields(messages, value_col).agg(
        F.count_if(~F.col("is_valid")).alias("reject_count"))


def messages_from_clicks(events: DataFrame) -> DataFrame:
    """Ad-click messages from the test ``events`` table (click rows): ad id is
    the integer in props; every 50th event id carries a non-numeric ad id."""
    k = F.regexp_extract("props", r"[0-9]+", 0)
    ad = F.when(F.col("event_id") % 50 == 0, F.lit("x")).otherwise(k)
    return (events.where(F.col("event_type") == "click")
            .select(F.concat_ws(" ", timestamp_to_millis(F.col("ts")).cast("string"),
                                F.concat(F.lit("province"), (F.col("user_id") % 5).cast("string")),
                                F.concat(F.lit("city"), (F.col("event_id") % 25).cast("string")),
                                F.col("user_id").cast("string"), ad).alias("value")))


# ------------------------------------------------------------------ aggregates
def daily_counts(clicks: DataFrame) -> DataFrame:
    """A19 (batch): clicks per (day, user_id, ad_id)."""
    return clicks.groupBy(*DAY_KEYS).agg(F.count(F.lit(1)).alias("click_count"))


def _event_ts(clicks: DataFrame, watermark: str | None) -> DataFrame:
    # Watermarks need TIMESTAMP (an instant). The instant is taken with the
    # event's wall clock as UTC, so windows align with the wall-clock day and
    # the result does not depend on the session time zone.
    out = clicks.withColumn("_ts", ntz_to_instant("event_time"))
    return out.withWatermark("_ts", watermark) if watermark else out


def running_daily_counts(clicks: DataFrame, watermark: str | None = None) -> DataFrame:
    """Running clicks per (day, user_id, ad_id). Every click counts, however
    late. A ``watermark`` is the caller's choice to bound the state: a day's is
    dropped once the watermark passes its end, and later clicks are lost."""
    agg = (_event_ts(clicks, watermark)
           .groupBy(F.window("_ts", "1 day").alias("w"), "day", "user_id", "ad_id")
           .agg(F.count(F.lit(1)).alias("click_count")))
    return agg.select(*DAY_KEYS, "click_count")


def windowed_counts(clicks: DataFrame, size: str = "5 seconds", watermark: str | None = None) -> DataFrame:
    """Clicks per event-time window of ``size`` and (user_id, ad_id); every
    click counts unless the caller sets a ``watermark``."""
    agg = (_event_ts(clicks, watermark)
           .groupBy(F.window("_ts", size).alias("w"), "user_id", "ad_id")
           .agg(F.count(F.lit(1)).alias("click_count")))
    return agg.select(instant_to_ntz("w.start").alias("window_start"),
                      instant_to_ntz("w.end").alias("window_end"),
                      "user_id", "ad_id", "click_count")


# ------------------------------------------------------------------ sources
def kafka_messages(spark: SparkSession, servers: str, topics: str, **options) -> DataFrame:
    """Message text from Kafka (needs the Kafka connector on the class
    path; it is not bundled here). Returns one ``value`` STRING column."""
    try:
        raw = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
               .option("subscribe", topics).options(**options).load())
    except Exception as exc:
        if "kafka" in str(exc).lower() and "find" in str(exc).lower():
            raise RuntimeError("the Kafka source needs the spark-sql-kafka connector on the class path "
                               "(spark.jars.packages); file_messages() reads staged message files instead") from exc
        raise
    return raw.select(F.col("value").cast("string").alias("value"))


def file_messages(spark: SparkSession, path: str, files_per_trigger: int = 1) -> DataFrame:
    """S5 for tests and replays: message text files as a stream."""
    return (spark.readStream.schema("value STRING").option("maxFilesPerTrigger", files_per_trigger)
            .text(path))


_NO_DATA_BATCHES = "spark.sql.streaming.noDataMicroBatches.enabled"


def _start(writer, spark: SparkSession, available_now: bool, processing_time: str) -> StreamingQuery:
    """``available_now`` drains the input and stops (tests, backfills), otherwise
    a ``processing_time`` trigger.

    A drain-and-stop run skips the trailing no-data batch (it would only move
    the watermark of a query that is about to stop); continuous runs keep
    no-data batches so the state of closed windows is dropped on time. The
    setting is read when the query starts, so it is restored right after.
    """
    if not available_now:
        return writer.trigger(processingTime=processing_time).start()
    previous = spark.conf.get(_NO_DATA_BATCHES, "true")
    spark.conf.set(_NO_DATA_BATCHES, "false")
    try:
        return writer.trigger(availableNow=True).start()
    finally:
        spark.conf.set(_NO_DATA_BATCHES, previous)


def run_to_sink(stream: DataFrame, sink: UpsertSink, checkpoint: str, output_mode: str = "update",
                available_now: bool = True, processing_time: str = "5 seconds") -> StreamingQuery:
    """Start an aggregated ``stream`` (running totals) into ``sink``."""
    w = (stream.writeStream.outputMode(output_mode).option("checkpointLocation", checkpoint)
         .foreachBatch(sink.write_batch))
    return _start(w, stream.sparkSession, available_now, processing_time)


def count_to_sink(clicks: DataFrame, counts: Callable[[DataFrame], DataFrame], sink: UpsertSink, checkpoint: str,
                  fold_every: int | None = None, available_now: bool = True, processing_time: str = "5 seconds") -> StreamingQuery:
    """Start a stream of clicks into a ``delta`` sink: ``counts`` (such as
    ``daily_counts``) of every micro-batch by itself. ``fold_every`` folds the
    sink after so many batches."""
    if sink.kind != DELTA:
        raise ValueError("counts of single batches need a sink of kind 'delta'")

    def write(batch: DataFrame, batch_id: int) -> None:
        sink.write_batch(counts(batch), batch_id)
        if fold_every and (batch_id + 1) % fold_every == 0:
            sink.fold(batch.sparkSession)

    w = clicks.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write)
    return _start(w, clicks.sparkSession, available_now, processing_time)


def stage_messages(messages: DataFrame, records_per_file: int = 1_000_000) -> str:
    """Write message lines as text files under the shared folder (a replayable
    input for the file source): one or more per partition, none with more than
    ``records_per_file`` lines."""
    path = new_subdir(messages.sparkSession, "ad_messages")
    messages.write.mode("overwrite").option("maxRecordsPerFile", records_per_file).text(path)
    return path


def stream_counts(spark: SparkSession, messages_path: str, kind: str = "daily", watermark: str | None = None,
                  files_per_trigger: int = 1, fold_every: int | None = None) -> DataFrame:
    """Run T2 or T3 over staged messages to completion through the sink and
    return the sink's table: each batch counted by itself, or with a
    ``watermark`` as streaming state."""
    clicks = parse_ad_messages(file_messages(spark, messages_path, files_per_trigger))
    daily = kind == "daily"
    # Flat layout: a replay pushes many days through few batches, where day
    # folders would mean days x tasks small files per batch. The live job
    # (plans.jobs.ad_click_counts) partitions its sink by day.
    path, keys, checkpoint = new_subdir(spark, f"ad_sink_{kind}"), DAY_KEYS if daily else WINDOW_KEYS, new_subdir(spark, f"ad_ckpt_{kind}")
    if watermark:
        sink = UpsertSink(path, keys)
        agg = running_daily_counts(clicks, watermark) if daily else windowed_counts(clicks, "5 seconds", watermark)
        q = run_to_sink(agg, sink, checkpoint)
    else:
        sink = UpsertSink(path, keys, kind=DELTA)
        q = count_to_sink(clicks, daily_counts if daily else windowed_counts, sink, checkpoint, fold_every)
    q.awaitTermination()
    return sink.read(spark)
