"""Small hand-made inputs for unit tests."""

from __future__ import annotations

import datetime as dt

from visitflow.schemas import VISIT_ACTION

T0 = dt.datetime(2024, 1, 1, 0, 0, 0)


def action(event_id, session_id="s1", user_id=1, seconds=0, page_id=1, keyword=None, click=None,
           product=None, orders=None, pays=None, city_id=0, at=None):
    ts = at if at is not None else T0 + dt.timedelta(seconds=seconds)
    return (ts.date(), user_id, session_id, page_id, ts, event_id, keyword, click, product,
            orders, pays, city_id, None, None)


def actions_df(spark, rows):
    return spark.createDataFrame(rows, VISIT_ACTION)


def users_df(spark, rows):
    return spark.createDataFrame(rows, "user_id BIGINT, age INT, professional STRING, city STRING, sex STRING")
