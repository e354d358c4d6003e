"""Page single-step conversion.

Consecutive page pairs come from ``visitflow.operators.ordering`` (previous
row inside a session, in ranges of about equal rows). The flow is a small
parameter, so every number the funnel needs - the start page's views and each
step's pair count - is a conditional count: one global aggregate over one pass
of the ordered rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitflow.functions.expressions import ratio_half_up
from visitflow.operators.ordering import with_previous

# Fixed value: the default target page flow.
DEFAULT_FLOW = (1, 2, 3, 4, 5, 6, 7, 8, 9)


def parse_flow(flow) -> list[int]:
    """'1,2,3' or a sequence -> list of page ids."""
    if isinstance(flow, str):
        return [int(x) for x in flow.split(",") if x.strip() != ""]
    return [int(x) for x in flow]


def page_transitions(actions: DataFrame, ranges: int | None = None) -> DataFrame:
    """Every action with the page of the action before it in the session.

    Columns: session_id, event_id, action_time, page_id, prev_page_id (NULL for
    the first action of a session and for actions without a session).
    """
    return with_previous(actions, ["page_id"], ranges=ranges).drop("has_prev")


def funnel_counts(actions: DataFrame, flow=DEFAULT_FLOW, ranges: int | None = None) -> DataFrame:
    """One row: ``start_page_pv`` and ``pv_<i>`` (pairs matching step i) for
    every step of the flow, from a single pass. A pair repeated in the flow
    is counted for each of its steps."""
    pages = parse_flow(flow)
    rows = with_previous(actions, ["page_id"], ranges=ranges, ids=False)
    aggs = [F.count_if(F.col("page_id") == F.lit(pages[0])).alias("start_page_pv")]
    for i in range(1, len(pages)):
        aggs.append(F.count_if(F.col("has_prev") & (F.col("prev_page_id") == F.lit(pages[i - 1]))
                               & (F.col("page_id") == F.lit(pages[i]))).alias(f"pv_{i}"))
    return rows.agg(*aggs)


def _step_rows(counts: DataFrame, flow) -> DataFrame:
    """(step, split, split_pv, prev_pv), one row per flow step, straight from
    the single aggregate row: step 1's denominator is the start page's views,
    step i's is step i-1's count. No window needed."""
    pages = parse_flow(flow)
    k = len(pages) - 1
    if k == 0:
        return counts.select(F.lit(1).alias("step"), F.lit("").alias("split"),
                             F.lit(0).cast("bigint").alias("split_pv"),
                             F.lit(0).cast("bigint").alias("prev_pv")).where(F.lit(False))
    items = ", ".join(f"{i}, '{pages[i - 1]}_{pages[i]}', pv_{i}, {'start_page_pv' if i == 1 else f'pv_{i - 1}'}"
                      for i in range(1, k + 1))
    return counts.selectExpr(f"stack({k}, {items}) AS (step, split, split_pv, prev_pv)")


def page_flow_matches(actions: DataFrame, flow=DEFAULT_FLOW, ranges: int | None = None) -> DataFrame:
    """The flow steps whose page pair occurs, with the pair count."""
    steps = _step_rows(funnel_counts(actions, flow, ranges), flow)
    return (steps.where(F.col("split_pv") > 0)
            .select("step", "split", F.col("split_pv").cast("bigint").alias("pair_count")))


def page_split_pv(actions: DataFrame, flow=DEFAULT_FLOW, ranges: int | None = None) -> DataFrame:
    """Every flow step with its matched pair count (0 when never seen)."""
    steps = _step_rows(funnel_counts(actions, flow, ranges), flow)
    return steps.select("step", "split", F.col("split_pv").cast("bigint").alias("split_pv"))


def start_page_pv(actions: DataFrame, flow=DEFAULT_FLOW) -> DataFrame:
    """Number of views of the flow's first page (one row)."""
    first = parse_flow(flow)[0]
    return actions.agg(F.count_if(F.col("page_id") == F.lit(first)).alias("start_page_pv"))


def page_convert_rate(actions: DataFrame, flow=DEFAULT_FLOW, digits: int = 2, ranges: int | None = None) -> DataFrame:
    """Step 1 = pv(1) / start pv; step i = pv(i) / pv(i-1), HALF_UP.

    Columns: step, split, split_pv, prev_pv, rate (NULL when prev_pv is 0).
    All counts come from one aggregate row.
    """
    steps = _step_rows(funnel_counts(actions, flow, ranges), flow)
    return steps.select("step", "split", F.col("split_pv").cast("bigint").alias("split_pv"),
                        F.col("prev_pv").cast("bigint").alias("prev_pv"),
                        ratio_half_up("split_pv", "prev_pv", digits).alias("rate"))


def rate_report(rates: DataFrame, task_id: int) -> DataFrame:
    """One row (task_id, report) with 'split=rate|split=rate' in step order;
    a NULL rate is written as an empty value. Input is one row per flow step."""
    item = F.concat(F.col("split"), F.lit("="), F.coalesce(F.col("rate").cast("string"), F.lit("")))
    ordered = F.array_sort(F.collect_list(F.struct(F.col("step"), item.alias("text"))))
    return rates.agg(F.array_join(F.transform(ordered, lambda s: s["text"]), "|").alias("report")) \
        .select(F.lit(task_id).cast("bigint").alias("task_id"), "report")
