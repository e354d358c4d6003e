"""Category operators.

The three kinds of category touch (click, order, pay) are unpivoted in one
pass: every visit-log row becomes 0..n (category_id, kind) rows through a
single ``explode`` over a built array, so the log is scanned once, not three
times. Counting is then one hash aggregation with map-side partial counts,
which is also what protects against a hot category (a third of all clicks
still ships one partial row per map task).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from visitflow.config import cut_lineage
from visitflow.operators.joins import broadcast_bounded

CLICK, ORDER, PAY = "click", "order", "pay"


def _ids(col: str) -> Column:
    """Comma id text -> ARRAY<BIGINT> with blank entries removed; entries that
    are not numbers become NULL and are dropped after the explode. Built-in,
    codegen'd expressions only (no lambda functions on the hot path)."""
    empty = F.array().cast("array<bigint>")
    return F.coalesce(F.array_remove(F.split(F.col(col), ","), "").try_cast("array<bigint>"), empty)


def _tag(ids: Column, kind: str) -> Column:
    return F.arrays_zip(ids.alias("category_id"), F.array_repeat(F.lit(kind), F.size(ids)).alias("kind"))


def category_touches(actions: DataFrame, extra_cols: tuple[str, ...] = ()) -> DataFrame:
    """Unpivot: one row per (category_id, kind) touch; kind in click/order/pay.

    Order and pay lists are split with blanks and non-numbers dropped (F6,
    X11); every id in a list counts once per row. One ``explode`` over the
    concatenated, kind-tagged arrays: the log is read once.
    """
    empty = F.array().cast("array<bigint>")
    click = F.when(F.col("click_category_id").isNotNull(),
                   F.array(F.col("click_category_id").cast("bigint"))).otherwise(empty)
    touches = F.concat(_tag(click, CLICK), _tag(_ids("order_category_ids"), ORDER),
                       _tag(_ids("pay_category_ids"), PAY))
    typed = touches.cast("array<struct<category_id:bigint,kind:string>>")
    return (actions.select(*extra_cols, F.explode(typed).alias("_t"))
            .select(*extra_cols, "_t.category_id", "_t.kind")
            .where(F.col("category_id").isNotNull()))


def touched_categories(actions: DataFrame) -> DataFrame:
    """Distinct category ids clicked, ordered or paid."""
    return category_touches(actions).select("category_id").distinct()


def _count_listed(actions: DataFrame, ids_col: str, name: str) -> DataFrame:
    """Ids of one list column counted; only that list is read and exploded."""
    ids = actions.where(F.col(ids_col).isNotNull()).select(F.explode(_ids(ids_col)).alias("category_id"))
    return ids.where("category_id is not null").groupBy("category_id").agg(F.count(F.lit(1)).alias(name))


def category_clicks(actions: DataFrame) -> DataFrame:
    """Clicks per category."""
    return (actions.where(F.col("click_category_id").isNotNull())
            .groupBy(F.col("click_category_id").alias("category_id"))
            .agg(F.count(F.lit(1)).alias("click_count")))


def category_clicks_salted(actions: DataFrame, salts: int = 10) -> DataFrame:
    """A10: two-phase count with an explicit salt (result equals A9).

    The salt is a hash of the row id (deterministic, so a retried task
    produces the same partial sums).
    """
    salted = (actions.where(F.col("click_category_id").isNotNull())
              .select(F.col("click_category_id").alias("category_id"),
                      F.pmod(F.xxhash64("event_id"), F.lit(salts)).alias("salt")))
    partial = salted.groupBy("category_id", "salt").agg(F.count(F.lit(1)).alias("n"))
    return partial.groupBy("category_id").agg(F.sum("n").cast("bigint").alias("click_count"))


def category_orders(actions: DataFrame) -> DataFrame:
    """Orders per category (ids from the order lists)."""
    return _count_listed(actions, "order_category_ids", "order_count")


def category_pays(actions: DataFrame) -> DataFrame:
    """Payments per category (ids from the pay lists)."""
    return _count_listed(actions, "pay_category_ids", "pay_count")


def category_counts(actions: DataFrame) -> DataFrame:
    """Every touched category with click, order and pay counts (0 if none).

    One conditional aggregate over the unpivoted touches: the same rows as
    three left outer joins, with one shuffle instead of four.
    """
    return (category_touches(actions).groupBy("category_id")
            .agg(F.count_if(F.col("kind") == CLICK).alias("click_count"),
                 F.count_if(F.col("kind") == ORDER).alias("order_count"),
                 F.count_if(F.col("kind") == PAY).alias("pay_count")))


def rank_order() -> list:
    return [F.desc("click_count"), F.desc("order_count"), F.desc("pay_count"), F.desc("category_id")]


def rank_categories(counts: DataFrame) -> DataFrame:
    """O1: click desc, then order desc, then pay desc, then category_id desc."""
    return counts.orderBy(*rank_order())


def top_categories(counts: DataFrame, n: int = 10) -> DataFrame:
    """O2: the first ``n`` of O1 with their rank.

    ``orderBy(...).limit(n)`` runs as TakeOrderedAndProject (each partition
    keeps its own top n before the final merge); the at most n rows are then
    numbered by exploding their sorted list - no unpartitioned window.
    """
    top = counts.orderBy(*rank_order()).limit(n)
    key = F.struct((-F.col("click_count")).alias("a"), (-F.col("order_count")).alias("b"),
                   (-F.col("pay_count")).alias("c"), (-F.col("category_id")).alias("d"),
                   F.struct(*counts.columns).alias("row"))
    ranked = top.agg(F.array_sort(F.collect_list(key)).alias("_top"))
    return (ranked.select(F.posexplode("_top").alias("_pos", "_e"))
            .select(*[F.col(f"_e.row.{c}").alias(c) for c in counts.columns],
                    (F.col("_pos") + 1).cast("int").alias("rank")))


def session_category_clicks(actions: DataFrame) -> DataFrame:
    """Clicks per (category, session); clicks without a session are in none."""
    return (actions.where(F.col("click_category_id").isNotNull() & F.col("session_id").isNotNull())
            .groupBy(F.col("click_category_id").alias("category_id"), "session_id")
            .agg(F.count(F.lit(1)).alias("click_count")))


def top_sessions_per_category(clicks: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` most-clicking sessions of every category.

    Ties broken by session_id descending. ``row_number() <= n`` with a literal
    n gets a map-side WindowGroupLimit, so a hot category ships at most n rows
    per map task into the final window.
    """
    w = Window.partitionBy("category_id").orderBy(F.desc("click_count"), F.desc("session_id"))
    return (clicks.withColumn("rank", F.row_number().over(w))
            .where(F.col("rank") <= n))


def top_sessions_for_top_categories(actions: DataFrame, top_n: int = 10,
                                    sessions_n: int = 10) -> DataFrame:
    """J4 + R1: top sessions of the top-N categories only.

    The log is read and aggregated once, to counts per session and category;
    these are stored (a job at build time), and both the ranking of the
    categories and that of their sessions are taken from the stored table.
    """
    counts = cut_lineage(session_category_counts(actions), "session-categories")
    return top_sessions_from_counts(counts, top_categories(category_counts_from_sessions(counts), top_n), sessions_n)


def session_category_counts(actions: DataFrame) -> DataFrame:
    """(session_id, category_id, click_count, order_count, pay_count): touches
    per session and category, one partial-able aggregate. Category totals and
    per-session clicks can both be derived from it, so a job that needs both
    aggregates the log once."""
    return (category_touches(actions, ("session_id",)).groupBy("session_id", "category_id")
            .agg(F.count_if(F.col("kind") == CLICK).alias("click_count"),
                 F.count_if(F.col("kind") == ORDER).alias("order_count"),
                 F.count_if(F.col("kind") == PAY).alias("pay_count")))


def category_counts_from_sessions(counts: DataFrame) -> DataFrame:
    """J3 from ``session_category_counts``: totals per category."""
    return counts.groupBy("category_id").agg(
        F.sum("click_count").cast("bigint").alias("click_count"),
        F.sum("order_count").cast("bigint").alias("order_count"),
        F.sum("pay_count").cast("bigint").alias("pay_count"))


def top_sessions_from_counts(counts: DataFrame, top: DataFrame, n: int = 10) -> DataFrame:
    """J4 + R1 from ``session_category_counts`` and a top-category list
    (bounded by its limit, broadcast). Clicks without a session count for the
    categories, but make no session."""
    clicks = (counts.where((F.col("click_count") > 0) & F.col("session_id").isNotNull())
              .select("category_id", "session_id", "click_count")
              .join(broadcast_bounded(top.select("category_id", F.col("rank").alias("category_rank"))),
                    "category_id"))
    w = Window.partitionBy("category_id").orderBy(F.desc("click_count"), F.desc("session_id"))
    return clicks.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)
