"""A session holding a third of the log must not become one task."""

import datetime as dt

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from helpers import T0, action, actions_df
from visitflow.operators import ordering as O
from visitflow.operators import sessions as S
from visitflow.operators.ranges import sorted_ranges


def _max_partition_share(df, used_col: str) -> float:
    # counting a window output column keeps the window (and its shuffle) in the plan
    counts = [r.n for r in df.groupBy(F.spark_partition_id().alias("_part"))
              .agg(F.count(F.lit(1)).alias("n"), F.max(used_col).alias("m")).collect()]
    return max(counts) / sum(counts)


def _rows(kind):
    for e in range(6000):
        if e % 3:
            yield action(e, f"s{e % 400}", seconds=e)
        elif kind == "session":  # over 30 days
            yield action(e, "hot", at=T0 + dt.timedelta(minutes=7 * e))
        elif kind == "hour":
            yield action(e, "hot", seconds=e % 3600)
        else:
            yield action(e, None, seconds=e)


@pytest.mark.parametrize("kind", ["session", "hour", "no session"])
def test_hot_session_is_spread_over_partitions(spark, kind):
    """A third of all rows in one session, session-hour or without a session."""
    df = actions_df(spark, list(_rows(kind)))
    saved = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "48")
    try:
        naive = df.withColumn("p", F.lag("page_id").over(
            Window.partitionBy("session_id").orderBy("action_time", "event_id")))
        naive_share = _max_partition_share(naive, "p")
        ranges = [r["count"] for r in sorted_ranges(df, ["session_id", *O.ORDER]).groupBy("part").count().collect()]
        share = max(ranges) / sum(ranges)  # of the tasks that read the rows in order
    finally:
        for k, v in saved.items():
            spark.conf.set(k, v)
    assert naive_share > 0.33
    assert share < 0.05


def test_hot_user_is_split_by_its_bytes(spark):
    """A third of all sessions on one user, no broadcast: Spark splits the
    partition that its bytes make too large (the thresholds are scaled to the
    test's 30 MB; `config.cluster_settings` has those of a cluster)."""
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "24",
                "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
                "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "128k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5"}
    saved = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        user = F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 4000)
        log = spark.range(150_000).select(
            F.sha2(F.col("id").cast("string"), 256).alias("session_id"), user.cast("bigint").alias("user_id"), F.lit(T0).cast("timestamp_ntz").alias("action_time"),
            F.sha2((F.col("id") + 1).cast("string"), 256).alias("search_keyword"), F.col("id").alias("click_category_id"))
        users = spark.range(4000).select(F.col("id").alias("user_id"), F.lit(30).alias("age"), F.lit("p").alias("professional"),
                                         F.lit("c").alias("city"), F.lit("m").alias("sex"))
        profile = S.session_profile(S.aggregate_sessions(log), users)
        counts = [r.n for r in profile.groupBy(F.spark_partition_id().alias("p")).agg(
            F.count(F.lit(1)).alias("n"), F.max("age"), F.max("keywords")).collect()]
        assert sum(counts) == 150_000 and max(counts) < 0.1 * sum(counts)
    finally:
        for k, v in saved.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)
