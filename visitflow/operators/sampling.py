"""Stratified, reproducible session sample.

Definition (exact): with N the sample size, n_days the number of days and
hour_cnt / day_cnt the sessions starting in an hour / day,

    quota(day, hour) = greatest(1, (hour_cnt * (N div n_days)) div day_cnt)

and a session is sampled when its rank inside its (day, hour) - ordered by
md5(seed || '_' || session_id), then session_id - is at most the quota. A
session without a start time is in no hour: it is not sampled and makes no day.

Plan: one pass over the sessions
--------------------------------
One hour may hold a third of all sessions, so whole hours are never ranked. No
quota exceeds N, so every task keeps, per (day, hour), its sessions' count and
its N smallest sessions in the order above: a bottom-k sketch, which merges by
taking the N smallest of several. The sketches are stored (their size follows
tasks, hours and N, not the sessions of an hour), the counts add up to the
quotas, and each hour's ranks are taken over its merged sketches.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, IntegerType, LongType, StringType, StructField, StructType

from visitflow.config import cut_lineage
from visitflow.operators.joins import kept_rows

KEYS = ("visit_day", "hour")
HELD_ROWS = 1 << 18  # kept sessions a task holds before it passes its sketches on


def _order_hash(seed) -> Column:
    return F.md5(F.concat(F.lit(str(seed)), F.lit("_"), F.col("session_id")))


def _quotas(counts: DataFrame, n: int, n_days: int | None = None) -> DataFrame:
    """(visit_day, hour, hour_cnt) with day_cnt, n_days and quota. This table
    has at most 24 rows a day, so its windows are small."""
    per_day = Window.partitionBy("visit_day")
    with_days = counts.withColumn("day_cnt", F.sum("hour_cnt").over(per_day))
    if n_days is not None:
        with_days = with_days.withColumn("n_days", F.lit(int(n_days)).cast("bigint"))
    else:
        first = F.when(F.row_number().over(per_day.orderBy("hour")) == 1, 1).otherwise(0)
        with_days = with_days.withColumn("_first_of_day", first).withColumn(
            "n_days", F.sum("_first_of_day").over(Window.partitionBy())).drop("_first_of_day")
    quota = F.floor((F.col("hour_cnt") * F.floor(F.lit(n) / F.col("n_days"))) / F.col("day_cnt"))
    return with_days.withColumn("quota", F.greatest(F.lit(1).cast("bigint"), quota.cast("bigint")))


def hour_quotas(sessions: DataFrame, n: int, n_days: int | None = None) -> DataFrame:
    """A14 + quotas: (visit_day, hour, hour_cnt, day_cnt, n_days, quota).

    Input must carry visit_day and hour; rows without a day count nowhere.
    ``n_days`` may be given (a count taken by the caller).
    """
    counts = sessions.where(F.col("visit_day").isNotNull()).groupBy(*KEYS).agg(F.count(F.lit(1)).alias("hour_cnt"))
    return _quotas(counts, n, n_days)


def _bottom(k: int, held_rows: int = HELD_ROWS) -> Callable:
    """Per task, (day, hour): the ``k`` first rows by (order, id), and one row
    with ``n``, the number of all its rows."""
    import numpy as np
    import pyarrow as pa

    def smallest(table: pa.Table) -> pa.Table:
        table = table.take(pa.compute.sort_indices(table, [(c, "ascending") for c in ("visit_day", "hour", "order", "id")]))
        keys = [table[c].combine_chunks().cast(pa.int32()).to_numpy() for c in KEYS]
        at = np.arange(len(table))
        first = (at == 0) | np.any([np.diff(key, prepend=key[:1]) != 0 for key in keys], axis=0)
        rank = at - np.maximum.accumulate(np.where(first, at, 0))
        return table.filter(pa.array(rank < k))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[tuple, int] = {}
        held, rows, schema = [], 0, None
        limit = held_rows
        for batch in batches:
            schema = batch.schema
            part = pa.Table.from_batches([batch])
            for r in part.group_by(list(KEYS)).aggregate([([], "count_all")]).to_pylist():
                key = tuple(r[c] for c in KEYS)
                counts[key] = counts.get(key, 0) + r["count_all"]
            held, rows = [*held, part], rows + len(part)
            if rows > limit:
                kept = smallest(pa.concat_tables(held))
                held, rows = [kept], len(kept)
                if rows > held_rows:
                    yield from kept.to_batches()
                    held, rows = [], 0
                limit = max(held_rows, 2 * rows)
        if rows:
            yield from smallest(pa.concat_tables(held)).to_batches()
        if counts:
            table = pa.Table.from_pylist([dict(zip(KEYS, key), n=n) for key, n in counts.items()], schema)
            yield from table.to_batches()

    return run


def stratified_sample(sessions: DataFrame, n: int = 100, seed: int = 42, n_days: int | None = None) -> DataFrame:
    """The sampled sessions with visit_day, hour, their hour's quota and
    their rank in the hour (``sample_rank``). The sessions are read once, when
    this is called; only the sketches are stored."""
    fields = [f for f in sessions.schema if f.name not in KEYS]
    own = {f.name: f"c{i}" for i, f in enumerate(fields)}  # by position: no name of the input can clash
    rows = sessions.where(F.col("start_time").isNotNull() & F.col("session_id").isNotNull()).select(
        F.to_date("start_time").alias("visit_day"), F.hour("start_time").alias("hour"), _order_hash(seed).alias("order"),
        F.col("session_id").cast("string").alias("id"), F.lit(None).cast("bigint").alias("n"), *[F.col(c).alias(x) for c, x in own.items()])
    schema = StructType([StructField("visit_day", DateType()), StructField("hour", IntegerType()), StructField("order", StringType()),
                         StructField("id", StringType()), StructField("n", LongType()), *[StructField(own[f.name], f.dataType) for f in fields]])
    sketch = cut_lineage(rows.mapInArrow(_bottom(n), schema), "sketches")
    counts = sketch.where("n IS NOT NULL").groupBy(*KEYS).agg(F.sum("n").alias("hour_cnt"))
    quotas = _quotas(counts, n, n_days).select(*KEYS, "quota")
    w = Window.partitionBy(*KEYS).orderBy("order", "id")
    ranked = sketch.where("n IS NULL").withColumn("sample_rank", F.row_number().over(w)).where(F.col("sample_rank") <= max(n, 1))
    return ranked.join(quotas, list(KEYS)).where(F.col("sample_rank") <= F.col("quota")).select(
        *KEYS, *[F.col(x).alias(c) for c, x in own.items()], "quota", "sample_rank")


def sample_detail(actions: DataFrame, sample: DataFrame) -> DataFrame:
    """Visit-log rows of the sampled sessions."""
    return kept_rows(actions, sample)
