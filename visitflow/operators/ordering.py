"""Previous row inside a session (P1, P2, X2), balanced by rows.

A plain ``lag(x) over (partition by session_id order by time)`` puts a whole
session into one task; one bot session holding a third of the log would then
be a single task. Here the whole log is put in one order, (session_id,
action_time, event_id), and Spark's range partitioner cuts it into ranges of
about equal rows, so a session, a session-hour or a single second of one
session may span any number of tasks.

One pass over the sorted ranges gives each row the row before it and leaves
each range's last row beside the others in a stored table. Only a range's
first row looks elsewhere: at the last row of the ranges before it, however
many of them are empty, in a table of one row per range. The plan has the same
size for any number of ranges and nothing but that table depends on them.

Rows without a session id are in no session: they have no previous row. Rows
without a time come first in their session, by event id. Rows that repeat
(session_id, action_time, event_id) follow each other in any order.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, IntegerType, StructField, StructType

from visitflow.config import cut_lineage
from visitflow.operators.ranges import carried, sorted_ranges

ORDER = ("action_time", "event_id")


def _shifted(columns: list[str], names: list[str]) -> Callable:
    """Rows of a range with ``columns`` of the row before (NULL on the range's
    first row); the last row comes once more, marked as the range's edge."""
    import pyarrow as pa

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None

        def out(batch: pa.RecordBatch, before: list, first: bool, edge: bool) -> pa.RecordBatch:
            n = batch.num_rows
            flags = [pa.array([first] + [False] * (n - 1)), pa.array([edge] * n)]
            return pa.RecordBatch.from_arrays([*batch.columns, *before, *flags], names)

        for batch in batches:
            if not batch.num_rows:
                continue
            before = []
            for name in columns:
                col = batch.column(name)
                head = pa.nulls(1, col.type) if last is None else last.column(name)
                before.append(pa.concat_arrays([head, col.slice(0, len(col) - 1)]))
            yield out(batch, before, last is None, False)
            last = batch.slice(batch.num_rows - 1)
        if last is not None:
            yield out(last, [pa.nulls(1, last.column(name).type) for name in columns], False, True)

    return run


def with_previous(actions: DataFrame, values: Sequence[str], keep: Sequence[str] = (),
                  ranges: int | None = None, ids: bool = True) -> DataFrame:
    """Every row with ``has_prev`` and ``prev_<v>``, the value of the session's
    previous row (NULL on its first). Output: session_id, event_id,
    action_time, the ``keep`` and ``values`` columns, has_prev, prev_<v>;
    without ``ids`` the first three are left out, and not stored either, unless
    they are among the others.

    ``ranges`` (default: the session's shuffle partitions) is the number of
    ranges; the result does not depend on it. The sorted ranges are stored
    when this is called."""
    values = list(values)
    base = list(dict.fromkeys(["session_id", "event_id", "action_time", *keep, *values]))
    wanted = base if ids else [c for c in base if c in keep or c in values]
    # inside, columns go by position, so no name of the log's can clash
    own = {name: f"c{i}" for i, name in enumerate(base)}
    rows = actions.select(*[F.col(name).alias(c) for name, c in own.items()])
    shifted = list(dict.fromkeys([own["session_id"], *[own[v] for v in values]]))
    field = {f.name: f for f in rows.schema}
    stored = [c for name, c in own.items() if name in wanted or name == "session_id"]
    rows = sorted_ranges(rows, [own[c] for c in ("session_id", *ORDER)], ranges).select(*stored, "part")
    schema = StructType([*[field[c] for c in stored], StructField("part", IntegerType()),
                         *[StructField(f"{c}_before", field[c].dataType) for c in shifted],
                         StructField("first", BooleanType()), StructField("edge", BooleanType())])
    read = cut_lineage(rows.mapInArrow(_shifted(shifted, schema.names), schema), "ranges")
    last = F.struct(*[F.col(c).alias(f"{c}_before") for c in shifted])
    carry = carried(read.where("edge").select("part", *shifted), {"carry": last}).withColumnRenamed("part", "carry_part")
    joined = read.where("not edge").join(carry, F.col("first") & (F.col("part") == F.col("carry_part")), "left")
    before = {c: F.when(F.col("first"), F.col(f"carry.{c}_before")).otherwise(F.col(f"{c}_before")) for c in shifted}
    session = own["session_id"]
    has_prev = F.coalesce(F.col(session) == before[session], F.lit(False))
    return joined.select(*[F.col(own[name]).alias(name) for name in wanted], has_prev.alias("has_prev"),
                         *[F.when(has_prev, before[own[v]]).alias(f"prev_{v}") for v in values])


def consecutive_pairs(actions: DataFrame, value: str, ranges: int | None = None) -> DataFrame:
    """(prev_<value>, <value>) for every pair of consecutive rows of a session."""
    return with_previous(actions, [value], ranges=ranges, ids=False).where("has_prev").select(f"prev_{value}", value)
