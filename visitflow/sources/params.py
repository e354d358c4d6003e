"""Task parameters.

A task row carries a JSON document whose keys map to arrays; the first
element of each array is the parameter. Parsing is a DataFrame expression
(``from_json`` + ``try_element_at``); the single selected row is then
collected once into a small typed object on the driver - the only driver
collect in the library, bounded to one row.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitflow.schemas import TASK_PARAM_FIELDS

_JSON_SCHEMA = "STRUCT<" + ", ".join(f"{k}: ARRAY<STRING>" for k in TASK_PARAM_FIELDS) + ">"


def task_param_columns(tasks: DataFrame, task_id: int) -> DataFrame:
    """One row per matching task with one STRING column per parameter key
    (first array element; NULL when the key or the element is missing)."""
    parsed = (tasks.where(F.col("task_id") == F.lit(task_id))
              .select("task_id", F.from_json("task_param", _JSON_SCHEMA).alias("p")))
    return parsed.select("task_id", *[F.try_element_at(F.col(f"p.{k}"), F.lit(1)).alias(k)
                                      for k in TASK_PARAM_FIELDS])


@dataclass(frozen=True)
class TaskParams:
    task_id: int
    start_date: str | None = None
    end_date: str | None = None
    start_age: int | None = None
    end_age: int | None = None
    professionals: str | None = None
    cities: str | None = None
    sex: str | None = None
    keywords: str | None = None
    category_ids: str | None = None
    target_page_flow: str | None = None


def _int(v):
    """None without a value; a value that is no number raises ValueError, since
    dropping the condition would widen the result."""
    return int(v) if v not in (None, "") else None


def load_task_params(tasks: DataFrame, task_id: int) -> TaskParams | None:
    """The task's parameters, or None when no such task exists; an id with two
    different rows raises ValueError."""
    rows = task_param_columns(tasks, task_id).distinct().limit(2).collect()
    if not rows:
        return None
    if len(rows) > 1:
        raise ValueError(f"task {task_id} has more than one row of parameters")
    r = rows[0].asDict()
    return TaskParams(task_id=task_id, start_date=r["startDate"], end_date=r["endDate"],
                      start_age=_int(r["startAge"]), end_age=_int(r["endAge"]),
                      professionals=r["professionals"], cities=r["cities"], sex=r["sex"],
                      keywords=r["keywords"], category_ids=r["categoryIds"],
                      target_page_flow=r["targetPageFlow"])
