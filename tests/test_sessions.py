import datetime as dt

from pyspark.sql import functions as F

from helpers import T0, action, actions_df, users_df
from visitflow.functions import expressions as X
from visitflow.operators import sessions as S


def test_parse_unpadded_and_bad_time(spark):
    df = spark.createDataFrame([("2018-05-01 3:5:7",), ("x",), ("2018-05-01 13:45:07",)], "t STRING")
    got = [r.ts for r in df.select(X.parse_time("t").alias("ts")).collect()]
    assert got == [dt.datetime(2018, 5, 1, 3, 5, 7), None, dt.datetime(2018, 5, 1, 13, 45, 7)]


def test_session_min_max_ignore_null_time(spark):
    rows = [action(1, seconds=10), action(2, seconds=20)]
    rows.append((T0.date(), 1, "s1", 1, None, 3, None, None, None, None, None, 0, None, None))
    s = S.aggregate_sessions(actions_df(spark, rows)).collect()[0]
    assert s.start_time == T0 + dt.timedelta(seconds=10)
    assert s.end_time == T0 + dt.timedelta(seconds=20)
    assert s.visit_length == 10 and s.step_length == 3


def test_one_action_session_in_no_length_bucket(spark):
    s = S.aggregate_sessions(actions_df(spark, [action(1)]))
    row = s.collect()[0]
    assert row.visit_length == 0 and row.step_length == 1
    stats = S.session_stats(s).collect()[0].asDict()
    assert stats["session_count"] == 1
    assert sum(v for k, v in stats.items() if k.startswith("visit_len_")) == 0
    assert stats["step_len_1_3"] == 1


def test_bucket_edges_one_bucket_each(spark):
    lengths = [0, 1, 3, 4, 6, 7, 9, 10, 30, 31, 60, 61, 180, 181, 600, 601, 1800, 1801]
    rows = []
    for i, n in enumerate(lengths):
        rows += [action(2 * i, f"s{i}", seconds=0), action(2 * i + 1, f"s{i}", seconds=n)]
    stats = S.session_stats(S.aggregate_sessions(actions_df(spark, rows))).collect()[0].asDict()
    expect = {"1s_3s": 2, "4s_6s": 2, "7s_9s": 2, "10s_30s": 2, "30s_60s": 2, "1m_3m": 2,
              "3m_10m": 2, "10m_30m": 2, "30m": 1}
    assert {k[len("visit_len_"):]: v for k, v in stats.items() if k.startswith("visit_len_")} == expect
    assert stats["session_count"] == len(lengths)  # length 0 counted only here


def test_step_buckets(spark):
    rows = [action(i, "big", seconds=i) for i in range(61)] + [action(100 + i, "mid", seconds=i) for i in range(30)]
    stats = S.session_stats(S.aggregate_sessions(actions_df(spark, rows))).collect()[0]
    assert stats.step_len_60 == 1 and stats.step_len_10_30 == 1


def test_distinct_keywords_and_categories(spark):
    rows = [action(1, keyword="a"), action(2, keyword="a"), action(3, keyword="ab"), action(4, keyword=" "),
            action(5, click=2), action(6, click=50), action(7, click=50),
            action(8, "t", click=7), action(9, "t", click=44)]
    out = {r.session_id: r for r in S.sessions_as_text(S.aggregate_sessions(actions_df(spark, rows))).collect()}
    assert out["s1"].search_keywords == "a,ab"
    assert out["s1"].click_category_ids == "2,50"
    assert out["t"].click_category_ids == "7,44"
    assert out["t"].search_keywords is None


def test_duplicate_users_first_by_full_row_order(spark):
    users = users_df(spark, [(1, 30, "b", "c", "man"), (1, 25, "z", "c", "woman"), (2, 40, "a", "x", "man")])
    d = {r.user_id: r for r in S.dedup_users(users).collect()}
    assert len(d) == 2 and d[1].age == 25 and d[1].professional == "z"


def test_filter_absent_parameters_keep_all_and_null_data_fails(spark):
    rows = [action(1, "a", user_id=1), action(2, "b", user_id=2)]
    users = users_df(spark, [(1, None, "p", "c", "man"), (2, 30, "p", "c", "woman")])
    prof = S.session_profile(S.aggregate_sessions(actions_df(spark, rows)), users)
    assert S.filter_sessions(prof, S.SessionFilter()).count() == 2
    assert S.filter_sessions(prof, S.SessionFilter(sex="", professionals="", start_age=None)).count() == 2
    kept = S.filter_sessions(prof, S.SessionFilter(start_age=20, end_age=50)).collect()
    assert [r.session_id for r in kept] == ["b"]


def test_filter_keywords_and_categories_any_match(spark):
    rows = [action(1, "a", keyword="x"), action(2, "a", click=5), action(3, "b", keyword="y")]
    users = users_df(spark, [(1, 30, "p", "c", "man")])
    prof = S.session_profile(S.aggregate_sessions(actions_df(spark, rows)), users)
    assert {r.session_id for r in S.filter_sessions(prof, S.SessionFilter(keywords="y,z")).collect()} == {"b"}
    assert {r.session_id for r in S.filter_sessions(prof, S.SessionFilter(category_ids="5")).collect()} == {"a"}


def test_half_up_ratios(spark):
    df = spark.createDataFrame([(1, 8), (57, 200), (1, 0), (2, 3)], "n BIGINT, d BIGINT")
    got = [r.r for r in df.select(X.ratio_half_up("n", "d").alias("r")).collect()]
    assert got == [0.13, 0.29, None, 0.67]


def test_stats_sum_property(spark):
    rows = [action(i, f"s{i % 7}", seconds=(i * 37) % 4000) for i in range(70)]
    s = S.aggregate_sessions(actions_df(spark, rows))
    stats = S.session_stats(s).collect()[0].asDict()
    zero = s.where(F.col("visit_length") == 0).count()
    assert sum(v for k, v in stats.items() if k.startswith("visit_len_")) + zero == stats["session_count"]
