"""Session operators.

A session is the set of visit-log rows that share a ``session_id``; rows
without one are in no session, here and in every operator on sessions, and
``log_gaps`` counts them. A session none of whose rows has a time has no start:
it counts as a session but is in no hour, day or length bucket. Everything here is a DataFrame -> DataFrame function:

* ``aggregate_sessions`` is one hash aggregation keyed by session_id. Every
  aggregate is partial-able (min/max/count/collect_set), so a hot session is
  pre-aggregated on the map side and ships one row per map task.
* ``session_profile`` joins the user dimension after reducing it to one row
  per user with a partial-able ``min(struct(...))`` (no window, no sort).
* statistics are a single global aggregate (``count_if`` per bucket).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from visitflow.functions import predicates as P
from visitflow.functions.expressions import day_hour_key, is_present, ratio_half_up, seconds_between
from visitflow.operators.joins import kept_rows

# Session-length buckets, upper bounds inclusive, lower exclusive.
VISIT_LENGTH_BUCKETS = (
    ("1s_3s", 0, 3), ("4s_6s", 3, 6), ("7s_9s", 6, 9), ("10s_30s", 9, 30),
    ("30s_60s", 30, 60), ("1m_3m", 60, 180), ("3m_10m", 180, 600),
    ("10m_30m", 600, 1800), ("30m", 1800, None),
)
STEP_LENGTH_BUCKETS = (
    ("1_3", 0, 3), ("4_6", 3, 6), ("7_9", 6, 9), ("10_30", 9, 30),
    ("30_60", 30, 60), ("60", 60, None),
)


def aggregate_sessions(actions: DataFrame) -> DataFrame:
    """A1-A3: one row per session.

    Columns: session_id, user_id, start_time, end_time, visit_length (s),
    step_length (#actions), keywords ARRAY<STRING> (distinct, sorted, blanks
    dropped), category_ids ARRAY<BIGINT> (distinct clicked categories, sorted).
    """
    kw = F.when(is_present("search_keyword"), F.col("search_keyword"))
    return (
        actions.where(F.col("session_id").isNotNull()).groupBy("session_id")
        .agg(
            F.min("user_id").alias("user_id"),
            F.min("action_time").alias("start_time"),
            F.max("action_time").alias("end_time"),
            F.count(F.lit(1)).alias("step_length"),
            F.collect_set(kw).alias("_kw"),
            F.collect_set("click_category_id").alias("_cat"),
        )
        .select(
            "session_id", "user_id", "start_time", "end_time",
            seconds_between("start_time", "end_time").alias("visit_length"),
            "step_length",
            F.array_sort("_kw").alias("keywords"),
            F.array_sort("_cat").alias("category_ids"),
        )
    )


def log_gaps(actions: DataFrame) -> DataFrame:
    """One row: the log's actions, those without a session and without a time."""
    return actions.agg(F.count(F.lit(1)).alias("actions"), F.count_if(F.col("session_id").isNull()).alias("without_session"),
                       F.count_if(F.col("action_time").isNull()).alias("without_time"))


def list_text(arr) -> Column:
    """Array -> comma text; an empty or NULL array gives NULL."""
    c = F.col(arr) if isinstance(arr, str) else arr
    return F.when(F.size(c) > 0, F.array_join(c.cast("array<string>"), ","))


def sessions_as_text(sessions: DataFrame) -> DataFrame:
    """Replace the list columns by comma text (search_keywords, click_category_ids)."""
    cols = [c for c in sessions.columns if c not in ("keywords", "category_ids")]
    return sessions.select(*cols, list_text("keywords").alias("search_keywords"),
                           list_text("category_ids").alias("click_category_ids"))


def dedup_users(users: DataFrame, key: str = "user_id") -> DataFrame:
    """One row per user: the smallest row in full column order (deterministic).

    ``min(struct(...))`` is an ordinary partial aggregate, so a user id that
    repeats millions of times is reduced on the map side.
    """
    rest = [c for c in users.columns if c != key]
    if not rest:
        return users.select(key).distinct()
    return (users.groupBy(key)
            .agg(F.min(F.struct(*rest)).alias("_first"))
            .select(key, *[F.col(f"_first.{c}").alias(c) for c in rest]))


def session_profile(sessions: DataFrame, users: DataFrame) -> DataFrame:
    """Sessions inner-joined with the (deduplicated) user dimension.

    No broadcast is forced: AQE measures the deduplicated dimension when its
    stage has run, and broadcasts it below the session's threshold.
    """
    return sessions.join(dedup_users(users.select("user_id", "age", "professional", "city", "sex")), "user_id")


@dataclass(frozen=True)
class SessionFilter:
    """F4 parameters; ``None`` or ``""`` disables a condition."""
    start_date: str | None = None
    end_date: str | None = None
    start_age: int | None = None
    end_age: int | None = None
    professionals: str | list | None = None
    cities: str | list | None = None
    sex: str | None = None
    keywords: str | list | None = None
    category_ids: str | list | None = None

    @classmethod
    def from_params(cls, params) -> "SessionFilter":
        return cls(params.start_date, params.end_date, params.start_age, params.end_age,
                   params.professionals, params.cities, params.sex, params.keywords,
                   params.category_ids)


def session_condition(f: SessionFilter) -> Column:
    """conjunction of F1-F3 over a profiled session row."""
    start_day = F.to_date("start_time")
    return (P.between(start_day, f.start_date and F.lit(f.start_date).cast("date"),
                      f.end_date and F.lit(f.end_date).cast("date"))
            & P.between("age", f.start_age, f.end_age)
            & P.in_values("professional", f.professionals)
            & P.in_values("city", f.cities)
            & P.equals("sex", f.sex)
            & P.any_in_list("keywords", f.keywords, "string")
            & P.any_in_list("category_ids", f.category_ids, "bigint"))


def filter_sessions(profile: DataFrame, f: SessionFilter) -> DataFrame:
    return profile.where(session_condition(f))


def _bucket_flag(col: str, lo, hi) -> Column:
    c = F.col(col)
    cond = c > F.lit(lo)
    if hi is not None:
        cond = cond & (c <= F.lit(hi))
    return cond


def session_stats(sessions: DataFrame) -> DataFrame:
    """One row: session_count, visit_len_<bucket>, step_len_<bucket>."""
    aggs = [F.count(F.lit(1)).alias("session_count")]
    aggs += [F.count_if(_bucket_flag("visit_length", lo, hi)).alias(f"visit_len_{name}")
             for name, lo, hi in VISIT_LENGTH_BUCKETS]
    aggs += [F.count_if(_bucket_flag("step_length", lo, hi)).alias(f"step_len_{name}")
             for name, lo, hi in STEP_LENGTH_BUCKETS]
    return sessions.agg(*aggs)


def stat_ratios(stats: DataFrame, digits: int = 2) -> DataFrame:
    """Every bucket divided by session_count, HALF_UP to ``digits``."""
    buckets = [c for c in stats.columns if c != "session_count"]
    return stats.select("session_count", *[
        ratio_half_up(c, "session_count", digits).alias(f"{c}_ratio") for c in buckets])


def sessions_per_hour(sessions: DataFrame) -> DataFrame:
    """Session count per day and hour of the session start (X3 key);
    sessions without a start are in no hour."""
    return (sessions.where(F.col("start_time").isNotNull())
            .groupBy(F.to_date("start_time").alias("visit_day"),
                     F.hour("start_time").alias("hour"),
                     day_hour_key("start_time").alias("day_hour"))
            .agg(F.count(F.lit(1)).alias("session_count")))


def session_detail(actions: DataFrame, sessions: DataFrame) -> DataFrame:
    """Visit-log rows of the given sessions (semi join on session_id, pruned
    at the log's scan)."""
    return kept_rows(actions, sessions)


def kept_touches(actions: DataFrame, kept: DataFrame) -> DataFrame:
    """The category columns of the log rows of the ``kept`` sessions."""
    cols = ["session_id", "event_id", "click_category_id", "order_category_ids", "pay_category_ids"]
    return kept_rows(actions.select(*cols), kept)


def bucket_rows(stats: DataFrame, prefix: str) -> DataFrame:
    """Long form of the ``prefix``-ed bucket columns of ``session_stats``:
    one row (bucket, session_count) per bucket, empty buckets included."""
    cols = [c for c in stats.columns if c.startswith(prefix)]
    return (stats.select(*cols)
            .unpivot([], cols, "bucket", "session_count")
            .select(F.expr(f"substring(bucket, {len(prefix) + 1})").alias("bucket"),
                    F.col("session_count").cast("bigint")))
