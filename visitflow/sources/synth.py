"""Synthetic visit-log generator (S12), as a Spark job.

Every output row is a pure function of one input id and a seed, so the job
parallelises over any id column (``spark.range(n)`` for a fixed size, or the
ids of an existing table) and any retry reproduces the same row. The mixing
is integer arithmetic that SQL engines share, so the same rows can be
re-derived in plain SQL.

Shape (as the original mock data): ten actions per session, ten sessions
per user stripe; one of four action types per row; keyword from the first
four of the keyword list; ids 0-99; pages 0-9; order and pay rows carry 0-6
comma ids (possibly the empty string); times are unpadded 'H:m:s' text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Keyword list and action types of the original mock data.
KEYWORDS = ("火锅", "蛋糕", "重庆辣子鸡", "重新小面", "海底捞", "道鱼火锅", "国贸大厦", "日本料理", "温泉", "太古商城")
ACTION_TYPES = ("SEARCH", "CLICK", "ORDER", "PAY")
MIX_MULTIPLIER = 48271
MIX_MODULUS = 2147483647
MIX_STRIDE = 7919


def mix(id_col: Column, seed: int, j: int) -> Column:
    """Deterministic pseudo-random non-negative integer for (id, seed, j)."""
    return F.pmod((id_col + F.lit(seed * 31 + j * MIX_STRIDE)) * F.lit(MIX_MULTIPLIER), F.lit(MIX_MODULUS))


def _id_list(id_col: Column, seed: int, base: int) -> Column:
    n = mix(id_col, seed, base) % 7
    ids = F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1)).cast("int")),
                      lambda j: (mix(id_col, seed, base + 1) + j * F.lit(MIX_STRIDE)) % 100)
    return F.when(n == 0, F.lit("")).otherwise(F.array_join(ids.cast("array<string>"), ","))


def synthetic_visits(ids: DataFrame, id_col: str = "id", seed: int = 666,
                     day: str = "2024-01-01") -> DataFrame:
    """One visit-log row per input id: the text layout of the original mock
    table plus ``event_id`` (the input id) and ``city_id``."""
    i = F.col(id_col).cast("bigint")
    session = F.floor(i / 10).cast("bigint")
    kind = F.element_at(F.array(*[F.lit(a) for a in ACTION_TYPES]), (mix(i, seed, 3) % 4 + 1).cast("int"))
    keyword = F.element_at(F.array(*[F.lit(k) for k in KEYWORDS]), (mix(i, seed, 4) % 4 + 1).cast("int"))
    time_text = F.concat_ws(":", (mix(i, seed, 8) % 24).cast("string"),
                            (mix(i, seed, 9) % 60).cast("string"), (mix(i, seed, 10) % 60).cast("string"))
    return ids.select(
        i.alias("event_id"),
        F.lit(day).alias("date"),
        (mix(session, seed, 1) % 100).alias("user_id"),
        F.concat(F.lit("s"), session.cast("string")).alias("session_id"),
        (mix(i, seed, 2) % 10).alias("page_id"),
        F.concat(F.lit(day + " "), time_text).alias("action_time"),
        kind.alias("action_type"),
        F.when(kind == "SEARCH", keyword).alias("search_keyword"),
        F.when(kind == "CLICK", mix(i, seed, 5) % 100).alias("click_category_id"),
        F.when(kind == "CLICK", mix(i, seed, 6) % 100).alias("click_product_id"),
        F.when(kind == "ORDER", _id_list(i, seed, 20)).alias("order_category_ids"),
        F.when(kind == "PAY", _id_list(i, seed, 30)).alias("pay_category_ids"),
        (mix(i, seed, 11) % 25).alias("city_id"),
    )


def synthetic_users(ids: DataFrame, id_col: str = "id", seed: int = 666) -> DataFrame:
    """One user row per input id; user ids 0-99 and may repeat (as the mock)."""
    i = F.col(id_col).cast("bigint")
    return ids.select(
        (mix(i, seed, 40) % 100).alias("user_id"),
        F.concat(F.lit("user"), i.cast("string")).alias("username"),
        F.concat(F.lit("name"), i.cast("string")).alias("name"),
        (mix(i, seed, 41) % 100).cast("int").alias("age"),
        F.concat(F.lit("professional"), (mix(i, seed, 42) % 100).cast("string")).alias("professional"),
        F.concat(F.lit("city"), (mix(i, seed, 43) % 100).cast("string")).alias("city"),
        F.when(mix(i, seed, 44) % 2 == 0, "man").otherwise("woman").alias("sex"),
    )
