import json

from pyspark.sql import functions as F

from visitflow.config import new_subdir
from visitflow.operators import records as R
from visitflow.sources import params as PR
from visitflow.sources import quality as Q
from visitflow.sources import synth as G
from visitflow.streaming import ad_clicks as AD


def test_malformed_ad_messages_rejected_and_counted(spark):
    msgs = spark.createDataFrame([("1525132800000 p c 17 42",), ("1525132800000 p c 17",),
                                  ("1525132800000 p c u 42",), ("1525132800000 p c 17 42 9",)], "value STRING")
    good = AD.parse_ad_messages(msgs).collect()
    assert len(good) == 1 and good[0].user_id == 17 and good[0].ad_id == 42
    assert str(good[0].day) == "2018-05-01" and good[0].day_key == "20180501"
    from visitflow.functions.expressions import compact_day_to_date
    back = msgs.sparkSession.createDataFrame([("20180501",), ("2018x501",)], "k STRING") \
        .select(compact_day_to_date("k").alias("d")).collect()
    assert [str(r.d) for r in back] == ["2018-05-01", "None"]
    assert AD.ad_message_rejects(msgs).collect()[0].reject_count == 3


def test_kafka_reader_explains_missing_connector(spark):
    import pytest
    with pytest.raises(RuntimeError, match="connector"):
        AD.kafka_messages(spark, "localhost:1", "ads")


def test_upsert_sink_replay_is_idempotent(spark):
    sink = AD.UpsertSink(new_subdir(spark, "t_upsert"), ["k"])
    b0 = spark.createDataFrame([(1, 5), (2, 1)], "k BIGINT, n BIGINT")
    b1 = spark.createDataFrame([(1, 7)], "k BIGINT, n BIGINT")
    sink.write_batch(b0, 0)
    sink.write_batch(b1, 1)
    before = sorted(tuple(r) for r in sink.read(spark).collect())
    sink.write_batch(b0, 0)  # replay of batch 0
    after = sorted(tuple(r) for r in sink.read(spark).collect())
    assert before == after == [(1, 7), (2, 1)]


def _counts(sink, spark):
    return sorted(tuple(r) for r in sink.read(spark).select("k", "n").collect())


def test_fold_keeps_counts_of_running_and_new_queries(spark):
    """Totals of a query that goes on, of a new one and counts of single
    batches, each before and after folds; folded batches replayed change nothing."""
    path = new_subdir(spark, "t_fold")
    total, delta = AD.UpsertSink(path, ["k"]), AD.UpsertSink(path, ["k"], kind=AD.DELTA)
    df = lambda *rows: spark.createDataFrame(list(rows), "k BIGINT, n BIGINT")
    total.write_batch(df((1, 5), (2, 9)), 0, "a")
    total.write_batch(df((1, 6)), 1, "a")
    delta.write_batch(df((3, 1)), 0, "d")
    assert total.fold(spark) and _counts(total, spark) == [(1, 6), (2, 9), (3, 1)]
    assert total.fold(spark) is None  # nothing new
    total.write_batch(df((1, 7)), 2, "a")  # a goes on
    total.write_batch(df((1, 100)), 0, "b")  # b counts from zero
    delta.write_batch(df((3, 2), (1, 1)), 1, "d")
    want = [(1, 108), (2, 9), (3, 3)]
    assert _counts(total, spark) == want
    for _ in range(3):
        total.fold(spark)
        total.write_batch(df((1, 5), (2, 9)), 0, "a")  # replay of a folded batch
        delta.write_batch(df((3, 1)), 0, "d")
        assert _counts(total, spark) == want
    total.write_batch(df((2, 10)), 3, "a")
    moved = total.compact(spark, new_subdir(spark, "t_fold_moved"))
    moved = AD.UpsertSink(moved, ["k"])
    assert _counts(moved, spark) == [(1, 108), (2, 10), (3, 3)]
    moved.write_batch(df((2, 11)), 4, "a")
    moved.write_batch(df((1, 7)), 0, "new")
    assert _counts(moved, spark) == [(1, 115), (2, 11), (3, 3)]


def test_reads_of_a_folded_sink_do_not_grow_with_its_batches(spark):
    sink = AD.UpsertSink(new_subdir(spark, "t_fold_cost"), ["k"], kind=AD.DELTA)
    files = []
    for batch in range(12):
        sink.write_batch(spark.createDataFrame([(batch % 3, 1)], "k BIGINT, n BIGINT").coalesce(1), batch, "q")
        if batch % 3 == 2:
            sink.fold(spark)
            files.append(len(sink.read(spark).inputFiles()) + len(spark.read.parquet(f"{sink.path}/log").inputFiles()))
    assert _counts(sink, spark) == [(0, 4), (1, 4), (2, 4)]
    assert max(files) <= 30 and files[-1] <= files[1]


def test_sixty_days_out_of_order_hold_no_state(spark):
    """Clicks of 60 days, newest days first: nothing is kept between batches and
    no click is lost; folding while the stream runs."""
    day = 86_400_000
    lines = [f"{1704067200000 + d * day + i} p c {i % 4} {d % 2}" for d in reversed(range(60)) for i in range(5)]
    path = new_subdir(spark, "t_sixty")
    for k in range(6):
        part = lines[k * 50:(k + 1) * 50]
        spark.createDataFrame([(x,) for x in part], "value STRING").coalesce(1).write.mode("append").text(path)
    clicks = AD.parse_ad_messages(AD.file_messages(spark, path, 1))
    sink = AD.UpsertSink(new_subdir(spark, "t_sixty_sink"), AD.DAY_KEYS, ("day",), kind=AD.DELTA)
    q = AD.count_to_sink(clicks, AD.daily_counts, sink, new_subdir(spark, "t_sixty_ckpt"), fold_every=2)
    q.awaitTermination()
    assert q.lastProgress["batchId"] == 5 and q.lastProgress["stateOperators"] == []
    got = sink.read(spark)
    assert got.agg(F.sum("click_count")).first()[0] == 300 and got.select("day").distinct().count() == 60


def test_counts_of_batches_need_a_delta_sink(spark):
    import pytest
    path = AD.stage_messages(spark.createDataFrame([("1 p c 1 1",)], "value STRING"))
    with pytest.raises(ValueError):
        AD.count_to_sink(AD.parse_ad_messages(AD.file_messages(spark, path)), AD.daily_counts, AD.UpsertSink("/tmp/none", AD.DAY_KEYS), "/tmp/none")


def test_stream_equals_batch(spark):
    lines = [f"{1704067200000 + i * 1500} p c {i % 3} {i % 2}" for i in range(60)] + ["bad"]
    msgs = spark.createDataFrame([(x,) for x in lines], "value STRING")
    path = AD.stage_messages(msgs, 3)
    streamed = sorted(tuple(r) for r in AD.stream_counts(spark, path, "daily", "40 days").collect())
    batch = sorted(tuple(r) for r in AD.daily_counts(AD.parse_ad_messages(msgs)).collect())
    assert streamed == batch
    w_stream = AD.stream_counts(spark, path, "window", "40 days")
    w_batch = AD.windowed_counts(AD.parse_ad_messages(msgs), "5 seconds", None)
    assert sorted(tuple(r) for r in w_stream.select(*w_batch.columns).collect()) == \
        sorted(tuple(r) for r in w_batch.collect())


def test_csv_classifier_edges(spark):
    lines = spark.createDataFrame([("a b c",), ("a  c",), ("a b",), (None,)], "value STRING")
    got = [r.reject_reason for r in Q.classify_lines(lines, 3, sep=" ").collect()]
    assert got == [None, "empty_field", "field_count", "field_count"]


def test_csv_quality_split(spark):
    lines = spark.createDataFrame([("a,b,c",), ("a,b",), ("a,b,c,d",), ("a,,c",), ("x,y,z",), ("a, ,c",),
                                   ("a,b,",)], "value STRING")
    cls = Q.classify_lines(lines, 3)
    assert sorted(tuple(r) for r in Q.reject_counts(cls).collect()) == [("empty_field", 3), ("field_count", 2)]
    rows = Q.valid_rows(cls, ["f1", "f2", "f3"])
    out = Q.write_split_csv(rows, new_subdir(spark, "t_csv"), 2)
    back = spark.read.option("header", True).csv(out)
    assert sorted(tuple(r) for r in back.collect()) == [("a", "b", "c"), ("x", "y", "z")]
    # reading raw lines drops each file's header
    raw = Q.read_lines(spark, out)
    assert sorted(r.value for r in raw.collect()) == ["a,b,c", "x,y,z"]


def test_csv_quarantine_keeps_every_line(spark):
    """Valid and rejected lines of one pass, with their files; NULL lines, no rejects, no lines."""
    folder = new_subdir(spark, "t_quarantine")
    for k, lines in enumerate((["a,b", "c", "d,"], ["e,f", ",", "g,h,i"])):
        Q.write_lines_with_header(spark.createDataFrame([(x,) for x in lines], "value STRING").coalesce(1), f"{folder}/{k}", "x,y")
    lines = Q.read_lines(spark, f"{folder}/*", with_file=True)
    path = Q.split(Q.classify_lines(lines, 2), new_subdir(spark, "t_split"))
    bad = Q.quarantined(spark, path)
    assert sorted((r.line, r.reject_reason) for r in bad.collect()) == [(",", "empty_field"), ("c", "field_count"), ("d,", "empty_field"), ("g,h,i", "field_count")]
    assert bad.select("file").distinct().count() == 2 and bad.where("file is null").count() == 0
    assert "PartitionFilters: [isnotnull(verdict" in bad._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, Q.accepted(spark, path, ["x", "y"]).collect())) == [("a", "b"), ("e", "f")]
    hand_made = spark.createDataFrame([(None,), ("a,b",)], "value STRING")
    path = Q.split(Q.classify_lines(hand_made, 2), new_subdir(spark, "t_split"))
    assert [tuple(r) for r in Q.quarantined(spark, path).collect()] == [(None, None, "field_count")]
    path = Q.split(Q.classify_lines(hand_made.where("value is not null"), 2), new_subdir(spark, "t_split"))
    assert Q.quarantined(spark, path).count() == 0 and Q.accepted(spark, path, ["x", "y"]).count() == 1


def test_csv_job_with_a_quarantine(spark):
    from visitflow.plans import jobs
    folder = new_subdir(spark, "t_csv_job")
    Q.write_lines_with_header(spark.createDataFrame([("a,b",), ("c",), ("e,",)], "value STRING"), folder, "x,y")
    out, kept = new_subdir(spark, "t_csv_out"), new_subdir(spark, "t_csv_kept")
    counts = jobs.split_valid_csv(spark, folder, out, 2, ["x", "y"], quarantine=kept)
    assert sorted(map(tuple, counts.collect())) == [("empty_field", 1), ("field_count", 1)]
    assert [tuple(r) for r in spark.read.option("header", True).csv(out).collect()] == [("a", "b")]


def test_kv_values_with_separators_come_back_unchanged(spark):
    words = ["x|user_id=9=1", "%7C", "a=b|c%", "", "100%25"]
    df = spark.createDataFrame([(i, w, 7) for i, w in enumerate(words)], "id INT, word STRING, user_id BIGINT")
    back = R.parse_kv(R.export_kv(df, "id", ("word", "user_id")), "record", {"word": "string", "user_id": "bigint"}, ("id",))
    assert sorted(tuple(r) for r in back.collect()) == [(i, w, 7) for i, w in enumerate(words)]


def test_kv_text(spark):
    df = spark.createDataFrame([("a=1|b=|c=3",), ("a=1||b=2",), ("a=5|a=6|ba=7",)], "t STRING")
    got = R.parse_kv(df, "t", {"a": "bigint", "b": "string", "c": "bigint"}).collect()
    assert tuple(got[0]) == (1, "", 3)
    assert tuple(got[1]) == (1, "2", None)
    assert tuple(got[2]) == (5, None, None)  # first of a repeated key; ba is another key
    exp = R.export_kv(spark.createDataFrame([(1, "x", None)], "id BIGINT, u STRING, v BIGINT"), "id", ["u", "v"])
    assert exp.collect()[0].record == "u=x|v="


def test_task_params(spark):
    doc = {"startDate": ["2024-01-01"], "endDate": ["2024-01-30"], "startAge": ["20"], "endAge": ["50"],
           "targetPageFlow": ["1,2,3"], "sex": []}
    tasks = spark.createDataFrame([(1, json.dumps(doc)), (2, "{}")], "task_id BIGINT, task_param STRING")
    p = PR.load_task_params(tasks, 1)
    assert p.start_date == "2024-01-01" and p.end_age == 50 and p.target_page_flow == "1,2,3"
    assert p.sex is None and p.professionals is None
    assert PR.load_task_params(tasks, 3) is None


def test_synthetic_generator_deterministic(spark):
    ids = spark.range(500)
    a = G.synthetic_visits(ids, "id", 666)
    b = G.synthetic_visits(ids.repartition(7), "id", 666)
    assert sorted(tuple(r) for r in a.collect()) == sorted(tuple(r) for r in b.collect())
    stats = a.agg(F.max("page_id").alias("p"), F.max("user_id").alias("u"),
                  F.countDistinct("action_type").alias("k")).collect()[0]
    assert stats.p <= 9 and stats.u <= 99 and stats.k == 4
    assert G.synthetic_users(ids).count() == 500


def test_jobs_end_to_end(spark):
    from visitflow.plans import jobs
    from visitflow.sources.adapter import SuppliedTables
    t = SuppliedTables(spark, "/root/testdata/sf0.001")
    params = PR.TaskParams(task_id=5, start_date="2024-01-05", end_date="2024-01-20", start_age=20, end_age=60,
                           target_page_flow="1,2,3")
    out = new_subdir(spark, "t_jobs")
    res = jobs.session_analysis(t.actions(), t.users(), params, out_dir=out)
    assert spark.read.parquet(f"{out}/session_stats").count() == 1
    assert res["top_categories"].count() <= 10
    conv = jobs.page_conversion(t.actions(), params)
    assert conv["page_rate_report"].collect()[0].task_id == 5
    assert conv["page_convert_rate"].count() == 2
    area = jobs.area_top_products(t.actions(), t.cities(), params)
    assert area["area_top_products"].groupBy("area").count().where("count > 3").count() == 0


def test_stream_windows_independent_of_session_zone(spark):
    lines = [f"{1704067200000 + i * 3_600_000} p c 1 2" for i in range(30)]  # hourly clicks over 30 hours
    msgs = spark.createDataFrame([(x,) for x in lines], "value STRING")
    path = AD.stage_messages(msgs, 2)
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        daily = sorted(tuple(r) for r in AD.stream_counts(spark, path, "daily", "40 days").collect())
        win = AD.stream_counts(spark, path, "window", "40 days").orderBy("window_start").first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert [(str(d), n) for d, _, _, n in daily] == [("2024-01-01", 24), ("2024-01-02", 6)]
    assert str(win.window_start) == "2024-01-01 00:00:00"


def test_ad_click_job_and_compaction(spark):
    from visitflow.plans import jobs
    lines = [f"{1704067200000 + i * 60_000} p c {i % 2} 7" for i in range(20)]
    path = AD.stage_messages(spark.createDataFrame([(x,) for x in lines], "value STRING"), 2)
    sink_path = new_subdir(spark, "t_job_sink")
    q = jobs.ad_click_counts(AD.file_messages(spark, path), sink_path, new_subdir(spark, "t_job_ckpt"),
                             watermark="1 day", available_now=True)
    q.awaitTermination()
    sink = AD.UpsertSink(sink_path, AD.DAY_KEYS, ("day",))
    got = sorted((r.user_id, r.click_count) for r in sink.read(spark).collect())
    assert got == [(0, 10), (1, 10)]
    one_day = sink.read(spark, F.col("day") == F.lit("2024-01-01").cast("date"))
    assert one_day.count() == 2
    assert "PartitionFilters: [isnotnull(day" in one_day._jdf.queryExecution().executedPlan().toString()
    out = sink.compact(spark, new_subdir(spark, "t_compacted"))
    moved = AD.UpsertSink(out, AD.DAY_KEYS, ("day",))
    assert sorted((r.user_id, r.click_count) for r in moved.read(spark).collect()) == got


def test_csv_job_and_mock_tables(spark):
    from visitflow.plans import jobs
    src = Q.write_lines_with_header(
        spark.createDataFrame([("1,a",), ("2,",), ("3,c,x",), ("4,d",)], "value STRING"),
        new_subdir(spark, "t_csv_in"), "id,name", 2)
    out = new_subdir(spark, "t_csv_out")
    rejects = jobs.split_valid_csv(spark, src, out, 2, ["id", "name"], n_files=3)
    assert sorted(tuple(r) for r in rejects.collect()) == [("empty_field", 1), ("field_count", 1)]
    assert sorted(tuple(r) for r in spark.read.option("header", True).csv(out).collect()) == [("1", "a"), ("4", "d")]
    frames = jobs.mock_tables(spark, 1000, 100)
    assert spark.sql("SELECT count(*) AS n FROM user_visit_action").collect()[0].n == 1000
    assert frames["user_info"].count() == 100


def test_text_log_normalised(spark):
    from visitflow.operators import sessions as S
    from visitflow.sources.tables import normalize_text_log
    raw = G.synthetic_visits(spark.range(2000), "id", 666, day="2024-03-05")
    log = normalize_text_log(raw)
    assert log.schema.simpleString().startswith("struct<visit_date:date,user_id:bigint,session_id:string")
    assert log.where("action_time IS NULL").count() == 0
    assert log.select(F.min("visit_date")).first()[0].isoformat() == "2024-03-05"
    s = S.aggregate_sessions(log)
    assert s.count() == 200 and s.agg(F.sum("step_length")).first()[0] == 2000


def test_session_job_equals_direct_operators(spark):
    from visitflow.operators import categories as C
    from visitflow.operators import sessions as S
    from visitflow.plans import jobs
    from visitflow.sources.adapter import SuppliedTables
    t = SuppliedTables(spark, "/root/testdata/sf0.01")
    params = PR.TaskParams(task_id=1, start_age=20, end_age=50, professionals="BUILDING,HOUSEHOLD")
    res = jobs.session_analysis(t.actions(), t.users(), params)
    kept = S.filter_sessions(S.session_profile(S.aggregate_sessions(t.actions()), t.users()),
                             S.SessionFilter.from_params(params))
    kept_actions = S.session_detail(t.actions(), kept)
    want_top = sorted(tuple(r) for r in C.top_categories(C.category_counts(kept_actions), 10).collect())
    assert sorted(tuple(r) for r in res["top_categories"].collect()) == want_top
    want_sessions = C.top_sessions_for_top_categories(kept_actions, 10, 10)
    cols = want_sessions.columns
    assert sorted(tuple(r) for r in res["top_category_sessions"].select(*cols).collect()) == \
        sorted(tuple(r) for r in want_sessions.collect())
    assert res["session_stats"].first().session_count == kept.count()
    detail = res["session_sample_detail"].select("session_id").distinct()
    assert detail.join(res["session_sample"], "session_id", "left_anti").count() == 0


def test_ad_click_job_with_processing_time_trigger(spark):
    from visitflow.plans import jobs
    lines = [f"{1704067200000 + i * 60_000} p c {i % 3} 9" for i in range(30)]
    path = AD.stage_messages(spark.createDataFrame([(x,) for x in lines], "value STRING"), 2)
    sink_path = new_subdir(spark, "t_live_sink")
    q = jobs.ad_click_counts(AD.file_messages(spark, path), sink_path, new_subdir(spark, "t_live_ckpt"),
                             watermark="1 day", available_now=False)
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    got = sorted((r.user_id, r.click_count) for r in AD.UpsertSink(sink_path, AD.DAY_KEYS, ("day",))
                 .read(spark).collect())
    assert got == [(0, 10), (1, 10), (2, 10)]


def test_windowed_counts_in_append_mode_emit_closed_windows(spark):
    import datetime as dt
    lines = [f"{1704067200000 + i * 3000} p c {i % 2} 4" for i in range(40)]  # every 3 s for 2 minutes
    msgs = spark.createDataFrame([(x,) for x in lines], "value STRING")
    path = AD.stage_messages(msgs, 2)
    stream = AD.windowed_counts(AD.parse_ad_messages(AD.file_messages(spark, path)), "5 seconds", "10 seconds")
    sink = AD.UpsertSink(new_subdir(spark, "t_append"), AD.WINDOW_KEYS)
    AD.run_to_sink(stream, sink, new_subdir(spark, "t_append_ckpt"), output_mode="append").awaitTermination()
    got = sorted(tuple(r) for r in sink.read(spark).select("window_start", "user_id", "click_count").collect())
    batch = AD.windowed_counts(AD.parse_ad_messages(msgs), "5 seconds", None)
    # the watermark ends 10 s behind the newest event seen before the last batch, so the windows closed
    # by then are emitted exactly once with their final counts, and nothing newer is emitted
    assert got and max(w for w, _, _ in got) < dt.datetime(2024, 1, 1, 0, 1, 55)  # newest window withheld
    want = {(r.window_start, r.user_id): r.click_count for r in batch.collect()}
    assert all(want[(w, u)] == n for w, u, n in got)


def test_command_line_jobs(spark):
    from visitflow.__main__ import main
    base = new_subdir(spark, "t_cli")
    assert main(["mock-tables", "--actions-rows", "3000", "--users-rows", "100", "--out", base]) == 0
    task = '{"startAge": ["10"], "endAge": ["90"], "targetPageFlow": ["1,2,3"]}'
    assert main(["session-analysis", "--actions", f"{base}/actions", "--users", f"{base}/users",
                 "--task-json", task, "--out", f"{base}/e1"]) == 0
    assert spark.read.parquet(f"{base}/e1/session_stats").first().session_count > 0
    assert main(["page-conversion", "--actions", f"{base}/actions", "--task-json", task,
                 "--out", f"{base}/e2"]) == 0
    assert spark.read.parquet(f"{base}/e2/page_convert_rate").count() == 2


def test_late_clicks_and_a_new_checkpoint_lose_nothing(spark, tmp_path):
    """A click ten days late counts; a query with a fresh checkpoint adds to
    what the sink holds; a replayed batch changes nothing."""
    from visitflow.streaming import ad_clicks as AD

    def messages(folder, rows):
        for k, (day, user, ad) in enumerate(rows):
            ms = (19723 + day) * 86400000 + k
            spark.createDataFrame([(f"{ms} p c {user} {ad}",)], "value string").coalesce(1).write.mode("append").text(str(tmp_path / folder))

    messages("first", [(20, 1, 1), (21, 1, 1), (10, 7, 7)])
    messages("second", [(20, 1, 1), (22, 2, 2)])
    sink = AD.UpsertSink(str(tmp_path / "sink"), AD.DAY_KEYS)
    for folder, checkpoint in (("first", "c1"), ("second", "c2"), ("first", "c1")):
        clicks = AD.parse_ad_messages(AD.file_messages(spark, str(tmp_path / folder)))
        AD.run_to_sink(AD.running_daily_counts(clicks), sink, str(tmp_path / checkpoint)).awaitTermination()
    got = {(r.day.day, r.user_id, r.ad_id): r.click_count for r in sink.read(spark).collect()}
    assert got == {(21, 1, 1): 2, (22, 1, 1): 1, (11, 7, 7): 1, (23, 2, 2): 1}


def test_task_parameters_are_strict(spark):
    import pytest
    from visitflow.sources.params import load_task_params
    from visitflow.schemas import TASK
    tasks = spark.createDataFrame([(1, '{"startAge": ["x"]}'), (2, '{"startAge": ["1"]}'), (2, '{"startAge": ["2"]}')], TASK)
    for task in (1, 2):
        with pytest.raises(ValueError):
            load_task_params(tasks, task)
