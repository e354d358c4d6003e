import datetime as dt
import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from helpers import T0, action, actions_df
from visitflow.operators import funnel as FN
from visitflow.operators import ordering as O
from visitflow.operators import sampling as Y
from visitflow.operators import sessions as S


def _plain_prev(df, col):
    w = Window.partitionBy("session_id").orderBy("action_time", "event_id")
    return {r.event_id: r.p for r in df.select("event_id", F.lag(col).over(w).alias("p")).collect()}


def test_previous_equals_plain_lag_for_any_ranges(spark):
    rnd = random.Random(7)
    rows = []
    for e in range(400):
        sid = f"s{rnd.randrange(5)}"
        rows.append(action(e, sid, seconds=rnd.randrange(0, 3 * 86400), page_id=rnd.randrange(10)))
    rows.append(action(1000, "s0", seconds=5, page_id=3))  # same second as others: tie on time
    df = actions_df(spark, rows)
    for opts in (dict(ranges=n) for n in (1, 2, 7, 40, 500)):
        got = {r.event_id: r.prev_page_id for r in O.with_previous(df, ["page_id"], **opts).collect()}
        assert got == _plain_prev(df, "page_id"), opts
        pairs = sorted((r.prev_page_id, r.page_id) for r in O.consecutive_pairs(df, "page_id", **opts).collect())
        w = Window.partitionBy("session_id").orderBy("action_time", "event_id")
        plain = sorted((r.p, r.page_id) for r in df.select(F.lag("page_id").over(w).alias("p"), "page_id")
                       .where(F.col("p").isNotNull()).collect())
        assert pairs == plain


def test_funnel_missing_step_and_rates(spark):
    # pages 1,2 then 2,3 never followed by 4: split 3_4 has pv 0 -> rate 0.0, next rate NULL
    rows = [action(1, "a", seconds=1, page_id=1), action(2, "a", seconds=2, page_id=2),
            action(3, "a", seconds=3, page_id=3), action(4, "b", seconds=1, page_id=1),
            action(5, "b", seconds=2, page_id=2)]
    for method in (1, 2, 5):
        rates = {r.split: (r.split_pv, r.prev_pv, r.rate)
                 for r in FN.page_convert_rate(actions_df(spark, rows), "1,2,3,4,5", ranges=method).collect()}
        assert rates["1_2"] == (2, 2, 1.0), method
        assert rates["2_3"] == (1, 2, 0.5), method
        assert rates["3_4"] == (0, 1, 0.0), method
        assert rates["4_5"] == (0, 0, None), method


def test_funnel_repeated_pair_matches_per_repetition(spark):
    rows = [action(1, "a", seconds=1, page_id=1), action(2, "a", seconds=2, page_id=2)]
    for ranges in (1, 2):
        m = FN.page_flow_matches(actions_df(spark, rows), "1,2,1,2", ranges=ranges).collect()
        assert sorted((r.step, r.split, r.pair_count) for r in m) == [(1, "1_2", 1), (3, "1_2", 1)]


def test_rate_report_text(spark):
    rows = [action(1, "a", seconds=1, page_id=1), action(2, "a", seconds=2, page_id=2)]
    rates = FN.page_convert_rate(actions_df(spark, rows), "1,2,3")
    r = FN.rate_report(rates, 7).collect()[0]
    assert r.task_id == 7 and r.report == "1_2=1.0|2_3=0.0"


def _plain_sample(sessions, n, seed):
    s = sessions.withColumn("visit_day", F.to_date("start_time")).withColumn("hour", F.hour("start_time"))
    q = Y.hour_quotas(s, n).select("visit_day", "hour", "quota")
    w = Window.partitionBy("visit_day", "hour").orderBy(
        F.md5(F.concat(F.lit(str(seed)), F.lit("_"), "session_id")), "session_id")
    r = s.join(q, ["visit_day", "hour"]).withColumn("rn", F.row_number().over(w))
    return sorted(x.session_id for x in r.where(F.col("rn") <= F.col("quota")).collect())


def test_sample_equals_plain_ranking(spark):
    rnd = random.Random(3)
    rows = []
    for i in range(600):
        # one hot hour holding most sessions, plus a scatter over three days
        when = T0 + dt.timedelta(hours=5, seconds=rnd.randrange(3600)) if i % 3 else \
            T0 + dt.timedelta(seconds=rnd.randrange(3 * 86400))
        rows.append(action(i, f"s{i}", at=when))
    sessions = S.aggregate_sessions(actions_df(spark, rows)).drop("keywords", "category_ids")
    for n in (3, 30, 300, 3000):
        got = sorted(r.session_id for r in Y.stratified_sample(sessions, n, 42).collect())
        assert got == _plain_sample(sessions, n, 42)


def test_sample_quota_and_subset(spark):
    rows = [action(i, f"s{i}", seconds=(i * 997) % 86400 * 3) for i in range(300)]
    sessions = S.aggregate_sessions(actions_df(spark, rows)).drop("keywords", "category_ids")
    smp = Y.stratified_sample(sessions, 50, 1)
    per = smp.groupBy("visit_day", "hour").agg(F.count(F.lit(1)).alias("n"), F.max("quota").alias("q"))
    s = sessions.withColumn("visit_day", F.to_date("start_time")).withColumn("hour", F.hour("start_time"))
    hc = s.groupBy("visit_day", "hour").agg(F.count(F.lit(1)).alias("c"))
    for r in per.join(hc, ["visit_day", "hour"]).collect():
        assert r.n == min(r.q, r.c)
    assert smp.join(sessions, "session_id", "left_anti").count() == 0


def test_previous_equals_plain_lag_with_hot_second(spark):
    rnd = random.Random(11)
    rows = []
    for e in range(500):
        if e % 2:  # half the log: one session, all inside the same second
            rows.append(action(e, "hot", at=T0 + dt.timedelta(microseconds=rnd.randrange(10)), page_id=e % 10))
        else:
            rows.append(action(e, f"s{e % 7}", seconds=rnd.randrange(86400), page_id=rnd.randrange(10)))
    df = actions_df(spark, rows)
    got = {r.event_id: r.prev_page_id for r in O.with_previous(df, ["page_id"], ranges=16).collect()}
    assert got == _plain_prev(df, "page_id")
    pairs = sorted(tuple(r) for r in O.consecutive_pairs(df, "page_id", ranges=16).collect())
    w = Window.partitionBy("session_id").orderBy("action_time", "event_id")
    plain = sorted((r.p, r.page_id) for r in df.select(F.lag("page_id").over(w).alias("p"), "page_id",
                                                         F.row_number().over(w).alias("rn"))
                   .where("rn > 1").collect())
    assert pairs == plain
    rates_r = FN.page_convert_rate(df, "1,2,3", ranges=33).collect()
    rates_b = FN.page_convert_rate(df, "1,2,3").collect()
    assert sorted(map(tuple, rates_r)) == sorted(map(tuple, rates_b))


def test_null_times_and_null_sessions(spark):
    """No session: no previous row. No time: first in the session, by event id.
    Repeated rows follow each other. The same for any number of ranges."""
    rnd = random.Random(3)
    rows = []
    for e in range(300):
        a = list(action(e, rnd.choice(["hot", "hot", "s1", "s2", None]), seconds=rnd.randrange(50), page_id=rnd.randrange(5)))
        if rnd.random() < 0.25:
            a[4] = None
        rows += [tuple(a)] * (2 if e % 37 == 0 else 1)
    by: dict = {}
    for r in rows:
        by.setdefault(r[2], []).append((r[4] is not None, r[4] or 0, r[5], r[3]))
    want = []
    for sid, acts in by.items():
        acts.sort()
        want += [(sid, a[2], a[3], None if k == 0 or sid is None else acts[k - 1][3]) for k, a in enumerate(acts)]
    for ranges in (1, 3, 16, 64, 900):
        got = [(r.session_id, r.event_id, r.page_id, r.prev_page_id)
               for r in O.with_previous(actions_df(spark, rows), ["page_id"], ranges=ranges).collect()]
        assert sorted(got, key=str) == sorted(want, key=str), ranges


def test_funnel_with_null_pages(spark):
    rows = [action(1, "a", seconds=1, page_id=1), action(2, "a", seconds=2, page_id=None),
            action(3, "a", seconds=3, page_id=2), action(4, "b", seconds=1, page_id=1),
            action(5, "b", seconds=4000, page_id=2), action(6, "b", seconds=8000, page_id=None)]
    for method in (1, 2, 6):
        counts = FN.funnel_counts(actions_df(spark, rows), "1,2", ranges=method).first()
        # a: 1 -> NULL -> 2 has no 1_2 pair; b: 1 -> 2 across hour buckets is one pair
        assert (counts.start_page_pv, counts.pv_1) == (2, 1), method
        prev = {r.event_id: r.prev_page_id for r in
                FN.page_transitions(actions_df(spark, rows), ranges=method).collect()}
        assert prev == {1: None, 2: 1, 3: None, 4: None, 5: 1, 6: 2}, method


def test_sample_is_the_same_for_any_sketches(spark, monkeypatch):
    rows = [(f"s{i}", dt.datetime(2024, 1, 1 + i % 2, i % 3)) for i in range(3000)]
    sessions = spark.createDataFrame(rows, "session_id STRING, start_time TIMESTAMP_NTZ")
    want = _plain_sample(sessions, 60, 5)
    keep = Y._bottom
    for held, parts in ((1 << 18, 1), (10, 7), (500, 3)):  # many flushes, or one
        monkeypatch.setattr(Y, "_bottom", lambda k, held=held: keep(k, held))
        got = Y.stratified_sample(sessions.repartition(parts), 60, 5)
        assert sorted(r.session_id for r in got.collect()) == want and len(want) == 60


def test_sample_without_start_times(spark):
    """A session without a time is in no stratum and makes no day."""
    rows = [(f"s{i}", dt.datetime(2024, 1, 1, 5)) for i in range(40)]
    for extra in ([], [("x", None)], [(None, dt.datetime(2024, 1, 2)), ("y", None)]):
        sessions = spark.createDataFrame(rows + extra, "session_id STRING, start_time TIMESTAMP_NTZ")
        got = Y.stratified_sample(sessions, 10, 5).collect()
        assert len(got) == 10 and {r.quota for r in got} == {10} and "x" not in {r.session_id for r in got}
    none = spark.createDataFrame([("x", None)], "session_id STRING, start_time TIMESTAMP_NTZ")
    assert Y.stratified_sample(none, 10).collect() == []


def test_sample_keeps_columns_named_like_its_own(spark):
    rows = [(f"s{i}", dt.datetime(2024, 1, 1, 5), i, "o", -1) for i in range(20)]
    sessions = spark.createDataFrame(rows, "session_id STRING, start_time TIMESTAMP_NTZ, id BIGINT, order STRING, n BIGINT")
    got = Y.stratified_sample(sessions, 5, 5).collect()
    assert len(got) == 5 and all((f"s{r.id}", r.order, r.n) == (r.session_id, "o", -1) for r in got)
