"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame.

Each query reads the supplied test tables through the adapter, runs one of
the library operators over the whole tables, and returns a DataFrame whose
column names equal those of its SQL twin in ``visitflow.plans.oracle``.
Query parameters that the original jobs take from a task row are fixed here
and documented next to each query.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from visitflow.config import cut_lineage, new_subdir
from visitflow.functions import expressions as X
from visitflow.operators import area as A
from visitflow.operators import categories as C
from visitflow.operators import funnel as FN
from visitflow.operators import ordering as O
from visitflow.operators import records as R
from visitflow.operators import sampling as Y
from visitflow.operators import sessions as S
from visitflow.plans import jobs
from visitflow.sources import quality as Q
from visitflow.sources import sinks as SK
from visitflow.sources import synth as G
from visitflow.sources.adapter import SuppliedTables
from visitflow.sources.params import load_task_params
from visitflow.streaming import ad_clicks as AD

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}

# Action kinds that touch a category (lets the scan skip searches and page views).
TOUCH_KINDS = ("click", "order", "pay")


def query(name: str):
    def register(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        return fn
    return register


def _t(spark: SparkSession, sf_dir: str) -> SuppliedTables:
    return SuppliedTables(spark, sf_dir)


def _sessions(t: SuppliedTables) -> DataFrame:
    return S.aggregate_sessions(t.actions())


def _profile(t: SuppliedTables) -> DataFrame:
    return S.session_profile(_sessions(t), t.users())


@query("session_agg")
def q_session_agg(spark, sf_dir):
    """A1-A3: one row per session with its lists as text."""
    return S.sessions_as_text(_sessions(_t(spark, sf_dir)))


@query("session_profile")
def q_session_profile(spark, sf_dir):
    """Sessions with the user's age, profession, city and sex."""
    return S.sessions_as_text(_profile(_t(spark, sf_dir)))


@query("category_counts")
def q_category_counts(spark, sf_dir):
    """Click, order and pay counts of every touched category."""
    return C.category_counts(_t(spark, sf_dir).actions(kinds=TOUCH_KINDS))


@query("categories_top10")
def q_categories_top10(spark, sf_dir):
    """O2: the ten top categories with their rank (the smoke-entry query)."""
    return C.top_categories(C.category_counts(_t(spark, sf_dir).actions(kinds=TOUCH_KINDS)), 10)


# ---------------------------------------------------------------- sessions
# Fixed query parameters (documented; the SQL twins use the same values).
AGE_FILTER = dict(start_age=12, end_age=60)
COMPOSITE_FILTER = dict(start_date="2024-01-03", end_date="2024-01-27", start_age=20, end_age=50,
                        professionals="AUTOMOBILE,BUILDING,HOUSEHOLD", cities=None, sex=None,
                        keywords=None, category_ids=None)


def _stats_sessions(t: SuppliedTables) -> DataFrame:
    return S.filter_sessions(_profile(t), S.SessionFilter(**AGE_FILTER))


@query("visits_in_range")
def q_visits_in_range(spark, sf_dir):
    """Visit-log rows dated 2024-01-10 .. 2024-01-20 (inclusive)."""
    return _t(spark, sf_dir).actions("2024-01-10", "2024-01-20")


@query("session_keywords")
def q_session_keywords(spark, sf_dir):
    """A2: distinct search keywords per session."""
    return S.sessions_as_text(_sessions(_t(spark, sf_dir))).select("session_id", "search_keywords")


@query("session_categories")
def q_session_categories(spark, sf_dir):
    """A3: distinct clicked categories per session."""
    return S.sessions_as_text(_sessions(_t(spark, sf_dir))).select("session_id", "click_category_ids")


def _filtered(spark, sf_dir, **kw):
    return S.sessions_as_text(S.filter_sessions(_profile(_t(spark, sf_dir)), S.SessionFilter(**kw)))


@query("filter_age")
def q_filter_age(spark, sf_dir):
    """sessions of users aged 20..50."""
    return _filtered(spark, sf_dir, start_age=20, end_age=50)


@query("filter_profession")
def q_filter_profession(spark, sf_dir):
    """F2 (scalar): professions BUILDING or MACHINERY."""
    return _filtered(spark, sf_dir, professionals="BUILDING,MACHINERY")


@query("filter_sex")
def q_filter_sex(spark, sf_dir):
    """sex = woman."""
    return _filtered(spark, sf_dir, sex="woman")


@query("filter_keywords")
def q_filter_keywords(spark, sf_dir):
    """F2 (list): sessions that searched kw1 or kw3."""
    return _filtered(spark, sf_dir, keywords="kw1,kw3")


@query("filter_categories")
def q_filter_categories(spark, sf_dir):
    """F2 (list): sessions that clicked category 2, 50 or 77."""
    return _filtered(spark, sf_dir, category_ids="2,50,77")


@query("filtered_sessions")
def q_filtered_sessions(spark, sf_dir):
    """composite filter (COMPOSITE_FILTER)."""
    return _filtered(spark, sf_dir, **COMPOSITE_FILTER)


@query("session_stats")
def q_session_stats(spark, sf_dir):
    """Bucket counts of sessions of users aged 12..60."""
    return S.session_stats(_stats_sessions(_t(spark, sf_dir)))


@query("visit_length_buckets")
def q_visit_length_buckets(spark, sf_dir):
    """A4 in long form: (bucket, session_count)."""
    return S.bucket_rows(S.session_stats(_stats_sessions(_t(spark, sf_dir))), "visit_len_")


@query("step_length_buckets")
def q_step_length_buckets(spark, sf_dir):
    """A5 in long form: (bucket, session_count)."""
    return S.bucket_rows(S.session_stats(_stats_sessions(_t(spark, sf_dir))), "step_len_")


@query("session_stat_ratios")
def q_session_stat_ratios(spark, sf_dir):
    """Bucket / session_count, HALF_UP to 2 digits."""
    return S.stat_ratios(S.session_stats(_stats_sessions(_t(spark, sf_dir))))


@query("sessions_per_hour")
def q_sessions_per_hour(spark, sf_dir):
    """Sessions per start day and hour."""
    return S.sessions_per_hour(_sessions(_t(spark, sf_dir)))


@query("session_detail")
def q_session_detail(spark, sf_dir):
    """Visit-log rows of the sessions passing COMPOSITE_FILTER."""
    t = _t(spark, sf_dir)
    kept = S.filter_sessions(_profile(t), S.SessionFilter(**COMPOSITE_FILTER))
    return S.session_detail(t.actions(), kept)


# ---------------------------------------------------------------- funnel
FLOW = "1,2,3,4,5,6,7,8,9"


@query("page_transitions")
def q_page_transitions(spark, sf_dir):
    """Each action with the previous page of its session."""
    return FN.page_transitions(_t(spark, sf_dir).actions())


def _incomplete(spark, sf_dir):
    """The log with every ninth session id and every fourth time missing."""
    a = _t(spark, sf_dir).actions()
    return a.withColumn("session_id", F.when(F.col("event_id") % 9 != 0, F.col("session_id"))).withColumn(
        "action_time", F.when(F.col("event_id") % 4 != 0, F.col("action_time")))


@query("page_transitions_incomplete")
def q_page_transitions_incomplete(spark, sf_dir):
    """P2 where session ids and times are missing."""
    return FN.page_transitions(_incomplete(spark, sf_dir))


@query("page_split_pv_incomplete")
def q_page_split_pv_incomplete(spark, sf_dir):
    """A17 where session ids and times are missing."""
    return FN.page_split_pv(_incomplete(spark, sf_dir), FLOW)


@query("session_stats_incomplete")
def q_session_stats_incomplete(spark, sf_dir):
    """A4-A6 where session ids and times are missing."""
    return S.session_stats(S.aggregate_sessions(_incomplete(spark, sf_dir)))


@query("session_sample_incomplete")
def q_session_sample_incomplete(spark, sf_dir):
    """Y1, N = 100, where session ids and times are missing."""
    return Y.stratified_sample(S.aggregate_sessions(_incomplete(spark, sf_dir)).drop("keywords", "category_ids"), 100, 42)


@query("sessions_per_hour_incomplete")
def q_sessions_per_hour_incomplete(spark, sf_dir):
    """A13 where session ids and times are missing."""
    return S.sessions_per_hour(S.aggregate_sessions(_incomplete(spark, sf_dir)))


@query("category_top_sessions_incomplete")
def q_category_top_sessions_incomplete(spark, sf_dir):
    """A15 and R1 where session ids are missing."""
    return C.top_sessions_per_category(C.session_category_clicks(_incomplete(spark, sf_dir)), 10)


@query("top_sessions_for_top_categories_incomplete")
def q_top_sessions_for_top_categories_incomplete(spark, sf_dir):
    """J4 where session ids are missing: the categories count every click."""
    return C.top_sessions_for_top_categories(_incomplete(spark, sf_dir), 10, 10)


@query("log_gaps")
def q_log_gaps(spark, sf_dir):
    """Actions without a session or a time."""
    return S.log_gaps(_incomplete(spark, sf_dir))


@query("page_flow_matches")
def q_page_flow_matches(spark, sf_dir):
    """Page pairs matching a step of flow 1..9, with counts."""
    return FN.page_flow_matches(_t(spark, sf_dir).actions(), FLOW)


@query("page_split_pv")
def q_page_split_pv(spark, sf_dir):
    """Every step of flow 1..9 with its pair count."""
    return FN.page_split_pv(_t(spark, sf_dir).actions(), FLOW)


@query("start_page_pv")
def q_start_page_pv(spark, sf_dir):
    """Views of page 1."""
    return FN.start_page_pv(_t(spark, sf_dir).actions(), FLOW)


@query("page_convert_rate")
def q_page_convert_rate(spark, sf_dir):
    """Step conversion rates of flow 1..9."""
    return FN.page_convert_rate(_t(spark, sf_dir).actions(), FLOW)


@query("page_rate_report")
def q_page_rate_report(spark, sf_dir):
    """The rates as 'split=rate|...' text for task 1, written to and read
    back from a table in the shared folder."""
    rates = FN.page_convert_rate(_t(spark, sf_dir).actions(), FLOW)
    return SK.write_and_read(FN.rate_report(rates, 1), "page_rate_report")


# ---------------------------------------------------------------- categories
@query("touched_categories")
def q_touched_categories(spark, sf_dir):
    """Categories clicked, ordered or paid."""
    return C.touched_categories(_t(spark, sf_dir).actions(kinds=TOUCH_KINDS))


@query("category_clicks")
def q_category_clicks(spark, sf_dir):
    """Clicks per category."""
    return C.category_clicks(_t(spark, sf_dir).actions(kinds=("click",)))


@query("category_clicks_salted")
def q_category_clicks_salted(spark, sf_dir):
    """A10: salted two-phase click count (equals A9)."""
    return C.category_clicks_salted(_t(spark, sf_dir).actions(kinds=("click",)), 10)


@query("category_orders")
def q_category_orders(spark, sf_dir):
    """Orders per category."""
    return C.category_orders(_t(spark, sf_dir).actions(kinds=("order",)))


@query("category_pays")
def q_category_pays(spark, sf_dir):
    """Payments per category."""
    return C.category_pays(_t(spark, sf_dir).actions(kinds=("pay",)))


@query("categories_ranked")
def q_categories_ranked(spark, sf_dir):
    """O1: all categories in rank order."""
    return C.rank_categories(C.category_counts(_t(spark, sf_dir).actions(kinds=TOUCH_KINDS)))


@query("session_category_clicks")
def q_session_category_clicks(spark, sf_dir):
    """Clicks per (category, session)."""
    return C.session_category_clicks(_t(spark, sf_dir).actions(kinds=("click",)))


@query("category_top_sessions")
def q_category_top_sessions(spark, sf_dir):
    """Top-10 sessions of every clicked category."""
    return C.top_sessions_per_category(C.session_category_clicks(_t(spark, sf_dir).actions(kinds=("click",))), 10)


@query("top_sessions_for_top_categories")
def q_top_sessions_for_top_categories(spark, sf_dir):
    """J4 + R1: top-10 sessions of each of the top-10 categories."""
    return C.top_sessions_for_top_categories(_t(spark, sf_dir).actions(kinds=TOUCH_KINDS), 10, 10)


# ---------------------------------------------------------------- area
# Fixed query parameter: tiers for the test regions (MIDDLE EAST falls to D).
TEST_TIERS = {"A级": ("AMERICA", "EUROPE"), "B级": ("ASIA",), "C级": ("AFRICA",)}


def _clicks_city(t: SuppliedTables) -> DataFrame:
    return A.clicks_with_city(A.product_clicks(t.actions(kinds=("click",))), t.cities())


def _area_clicks(t: SuppliedTables) -> DataFrame:
    return A.with_area_level(A.area_product_clicks(_clicks_city(t)), TEST_TIERS)


@query("product_clicks")
def q_product_clicks(spark, sf_dir):
    """clicks with a product id."""
    return A.product_clicks(_t(spark, sf_dir).actions(kinds=("click",)))


@query("product_clicks_by_city")
def q_product_clicks_by_city(spark, sf_dir):
    """Clicks joined to the city dimension."""
    return _clicks_city(_t(spark, sf_dir))


@query("city_labels")
def q_city_labels(spark, sf_dir):
    """X12 / U1: 'id:name' label of every click's city, through the SQL function."""
    A.register_sql_functions(spark)
    _clicks_city(_t(spark, sf_dir)).createOrReplaceTempView("vf_clicks_city")
    return spark.sql("SELECT event_id, concat_long_string(city_id, city_name, ':') AS city_label "
                     "FROM vf_clicks_city")


@query("area_product_clicks")
def q_area_product_clicks(spark, sf_dir):
    """A16 + U2: clicks per (area, product) with the distinct city list."""
    return A.area_product_clicks(_clicks_city(_t(spark, sf_dir)))


@query("area_level")
def q_area_level(spark, sf_dir):
    """F8: A16 rows with the tier of their area (TEST_TIERS)."""
    return _area_clicks(_t(spark, sf_dir))


@query("area_top_products")
def q_area_top_products(spark, sf_dir):
    """R2: top-3 products per area."""
    return A.top_products_per_area(_area_clicks(_t(spark, sf_dir)), 3)


# ---------------------------------------------------------------- sampling
@query("session_sample")
def q_session_sample(spark, sf_dir):
    """Stratified sample, N = 100, seed 42."""
    return Y.stratified_sample(_sessions(_t(spark, sf_dir)).drop("keywords", "category_ids"), 100, 42)


@query("session_sample_2000")
def q_session_sample_2000(spark, sf_dir):
    """Stratified sample, N = 2000, seed 42 (quotas above 1)."""
    return Y.stratified_sample(_sessions(_t(spark, sf_dir)).drop("keywords", "category_ids"), 2000, 42)


@query("sessions_per_day")
def q_sessions_per_day(spark, sf_dir):
    """Hour counts with their day total, quota inputs of the sample."""
    s = _sessions(_t(spark, sf_dir)).select(F.to_date("start_time").alias("visit_day"),
                                            F.hour("start_time").alias("hour"))
    return Y.hour_quotas(s, 100)


@query("session_sample_detail")
def q_session_sample_detail(spark, sf_dir):
    """Visit-log rows of the N = 100 sample."""
    t = _t(spark, sf_dir)
    sample = Y.stratified_sample(_sessions(t).drop("keywords", "category_ids"), 100, 42)
    return Y.sample_detail(t.actions(), sample)


# ---------------------------------------------------------------- session analysis, end to end
# All seven conditions on (S4 parameters of the task).
TASK = dict(startDate=["2024-01-03"], endDate=["2024-01-27"], startAge=["18"], endAge=["70"], sex=["man"],
            professionals=["AUTOMOBILE,BUILDING,HOUSEHOLD,MACHINERY"],
            cities=[",".join(f"NATION_{i}" for i in range(20))],
            keywords=["kw1,kw2,kw3"], categoryIds=[",".join(map(str, range(0, 100, 2)))])


def _task_output(spark, sf_dir, name: str) -> DataFrame:
    """One result of the session-analysis job for TASK, from its written table."""
    t = _t(spark, sf_dir)
    out = new_subdir(spark, "session-analysis")
    tasks = spark.createDataFrame([(1, json.dumps(TASK))], "task_id bigint, task_param string")
    jobs.session_analysis(t.actions(), t.users(), load_task_params(tasks, 1), out_dir=out, outputs=(name,))
    return spark.read.parquet(f"{out}/{name}")


@query("task_session_stats")
def q_task_session_stats(spark, sf_dir):
    """F4 with all conditions, A4-A6, S9: bucket counts of the task's sessions."""
    return _task_output(spark, sf_dir, "session_stats")


@query("task_session_sample")
def q_task_session_sample(spark, sf_dir):
    """The sample of the task's sessions."""
    return _task_output(spark, sf_dir, "session_sample")


@query("task_top_categories")
def q_task_top_categories(spark, sf_dir):
    """Top categories over the actions of the task's sessions."""
    return _task_output(spark, sf_dir, "top_categories")


@query("task_top_category_sessions")
def q_task_top_category_sessions(spark, sf_dir):
    """The top sessions of those categories."""
    return _task_output(spark, sf_dir, "top_category_sessions")


# ---------------------------------------------------------------- scalar functions
@query("normalized_action_times")
def q_normalized_action_times(spark, sf_dir):
    """Unpadded 'yyyy-MM-dd H:m:s' text of every event time, parsed
    back, and re-padded to two digits per component."""
    ev = _t(spark, sf_dir).raw("events").select("event_id", "ts")
    raw = F.date_format("ts", "yyyy-MM-dd H:m:s")
    hms = F.split(F.split(F.col("raw_time"), " ")[1], ":")
    return (ev.select("event_id", raw.alias("raw_time"))
            .select("event_id", "raw_time", X.parse_time("raw_time").alias("action_time"),
                    F.concat(F.split(F.col("raw_time"), " ")[0], F.lit(" "), X.pad2(hms[0]), F.lit(":"),
                             X.pad2(hms[1]), F.lit(":"), X.pad2(hms[2])).alias("padded_time")))


@query("event_gap_seconds")
def q_event_gap_seconds(spark, sf_dir):
    """Seconds since the previous action of the same session."""
    prev = O.with_previous(_t(spark, sf_dir).actions(), ["action_time"])
    return prev.select("session_id", "event_id", "action_time", "prev_action_time",
                       X.seconds_between("prev_action_time", "action_time").alias("gap_seconds"),
                       X.is_after("action_time", "prev_action_time").alias("is_later"))


@query("normalized_id_lists")
def q_normalized_id_lists(spark, sf_dir):
    """Order / pay id lists split, blanks dropped, cast to ids."""
    a = _t(spark, sf_dir).actions(kinds=("order", "pay"))
    raw = F.coalesce("order_category_ids", "pay_category_ids")
    ids = X.id_list(F.col("raw_ids"))
    return (a.where(F.col("order_category_ids").isNotNull() | F.col("pay_category_ids").isNotNull())
            .select("event_id",
                    F.when(F.col("order_category_ids").isNotNull(), "order").otherwise("pay").alias("kind"),
                    raw.alias("raw_ids"))
            .select("event_id", "kind", "raw_ids",
                    F.array_join(ids.cast("array<string>"), ",").alias("ids"),
                    F.size(ids).alias("id_count")))


KV_FIELDS = ("user_id", "visit_length", "step_length", "search_keywords", "click_category_ids")
KV_TYPES = {"user_id": "bigint", "visit_length": "bigint", "step_length": "bigint",
            "search_keywords": "string", "click_category_ids": "string"}


def _kv_export(t: SuppliedTables) -> DataFrame:
    return R.export_kv(S.sessions_as_text(_sessions(t)), "session_id", KV_FIELDS)


@query("kv_records_export")
def q_kv_records_export(spark, sf_dir):
    """Session aggregates as 'k=v|k=v' text."""
    return _kv_export(_t(spark, sf_dir))


@query("kv_records_parsed")
def q_kv_records_parsed(spark, sf_dir):
    """The exported text loaded back into typed columns."""
    return R.parse_kv(_kv_export(_t(spark, sf_dir)), "record", KV_TYPES, keep=("session_id",))


@query("kv_records_escaped")
def q_kv_records_escaped(spark, sf_dir):
    """Values that hold separators and escape signs, written and loaded back."""
    ev = _t(spark, sf_dir).raw("events").select("event_id", F.concat(
        "event_type", F.lit("|user_id=9=%7C%"), F.col("user_id").cast("string")).alias("word"), "user_id", "props")
    return R.parse_kv(R.export_kv(ev, "event_id", ("word", "user_id", "props")), "record",
                      {"word": "string", "user_id": "bigint", "props": "string"}, keep=("event_id",))


# ---------------------------------------------------------------- text quality, generator
LINEITEM_FIELDS = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
                   "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate")


def _lineitem_lines(t: SuppliedTables) -> DataFrame:
    """Comma lines of lineitem; rows with l_orderkey % 20 = 0 lose their return
    flag (empty field), rows with l_orderkey % 20 = 10 their last field."""
    li = t.raw("lineitem")
    cols = [F.col(c).cast("string") for c in LINEITEM_FIELDS]
    flag_idx = LINEITEM_FIELDS.index("l_returnflag")
    blanked = list(cols)
    blanked[flag_idx] = F.lit("")
    key = F.col("l_orderkey") % 20
    line = (F.when(key == 0, F.concat_ws(",", *blanked))
            .when(key == 10, F.concat_ws(",", *cols[:-1]))
            .otherwise(F.concat_ws(",", *cols)))
    return li.select(line.alias("value"))


_STAGED: dict[tuple, str] = {}


def _staged(spark: SparkSession, sf_dir: str, name: str, make) -> str:
    """Input files derived from the test tables, written once per application
    and folder (they stand for files the original jobs read, a CSV export or a
    message topic), so repeated runs of a query read the same input."""
    key = (spark.conf.get("spark.app.id", ""), sf_dir, name)
    if key not in _STAGED:
        _STAGED[key] = make()
    return _STAGED[key]


def _lineitem_csv(spark: SparkSession, sf_dir: str) -> str:
    return _staged(spark, sf_dir, "lineitem_csv", lambda: Q.write_lines_with_header(
        _lineitem_lines(_t(spark, sf_dir)), new_subdir(spark, "lineitem_csv"), ",".join(LINEITEM_FIELDS), 200_000))


@query("csv_valid_rows")
def q_csv_valid_rows(spark, sf_dir):
    """CSV lines (headers skipped) validated; valid rows written as CSV
    files with a header each, read back."""
    lines = Q.read_lines(spark, _lineitem_csv(spark, sf_dir))
    rows = Q.valid_rows(Q.classify_lines(lines, len(LINEITEM_FIELDS)), LINEITEM_FIELDS)
    path = Q.write_split_csv(rows, new_subdir(spark, "csv_valid_rows"))
    return spark.read.option("header", True).schema(
        ", ".join(f"{c} STRING" for c in LINEITEM_FIELDS)).csv(path)


@query("csv_reject_counts")
def q_csv_reject_counts(spark, sf_dir):
    """Rejected lines counted by reason."""
    lines = Q.read_lines(spark, _lineitem_csv(spark, sf_dir))
    return Q.reject_counts(Q.classify_lines(lines, len(LINEITEM_FIELDS)))


def _split_lines(spark, sf_dir) -> str:
    lines = Q.read_lines(spark, _lineitem_csv(spark, sf_dir), with_file=True)
    return Q.split(Q.classify_lines(lines, len(LINEITEM_FIELDS)), new_subdir(spark, "csv_split"))


@query("csv_quarantine")
def q_csv_quarantine(spark, sf_dir):
    """Every rejected line with its reason, read back from the quarantine
    that one pass wrote beside the valid lines."""
    rejected = Q.quarantined(spark, _split_lines(spark, sf_dir))
    return rejected.select("line", "reject_reason", F.col("file").isNotNull().alias("has_file"))


@query("csv_accepted_rows")
def q_csv_accepted_rows(spark, sf_dir):
    """The valid rows of the same pass."""
    return Q.accepted(spark, _split_lines(spark, sf_dir), LINEITEM_FIELDS)


@query("synthetic_visit_counts")
def q_synthetic_visit_counts(spark, sf_dir):
    """One synthetic visit row per event id (seed 666), counted per
    action type and page."""
    ids = _t(spark, sf_dir).raw("events").select(F.col("event_id").alias("id"))
    v = G.synthetic_visits(ids, "id", 666)
    return (v.groupBy("action_type", "page_id")
            .agg(F.count(F.lit(1)).alias("n_actions"),
                 F.countDistinct("session_id").alias("n_sessions"),
                 F.countDistinct("user_id").alias("n_users"),
                 F.count("search_keyword").alias("n_searches")))


# ---------------------------------------------------------------- ad clicks (batch + streaming)


def _messages(t: SuppliedTables) -> DataFrame:
    return AD.messages_from_clicks(t.raw("events"))


def _ad_topic(spark: SparkSession, sf_dir: str) -> tuple[str, int]:
    """The click messages as text files, the stream's input, and how many files
    are half of them: two micro-batches, so that state is carried over."""
    def stage() -> str:
        messages = _messages(_t(spark, sf_dir))
        return AD.stage_messages(messages, max(1, -(-messages.count() // 2)))

    path = _staged(spark, sf_dir, "ad_topic", stage)
    return path, -(-len(spark.read.text(path).inputFiles()) // 2)


@query("ad_messages_parsed")
def q_ad_messages_parsed(spark, sf_dir):
    """Click messages parsed into typed fields."""
    return AD.parse_ad_messages(_messages(_t(spark, sf_dir)))


@query("ad_message_rejects")
def q_ad_message_rejects(spark, sf_dir):
    """Malformed messages counted."""
    return AD.ad_message_rejects(_messages(_t(spark, sf_dir)))


@query("ad_clicks_daily")
def q_ad_clicks_daily(spark, sf_dir):
    """Clicks per (day, user, ad), batch."""
    return AD.daily_counts(AD.parse_ad_messages(_messages(_t(spark, sf_dir))))


@query("ad_stream_running_counts")
def q_ad_stream_running_counts(spark, sf_dir):
    """The same counts kept running over 2 staged micro-batches, added up
    by the sink."""
    path, half = _ad_topic(spark, sf_dir)
    return AD.stream_counts(spark, path, "daily", files_per_trigger=half)


@query("ad_stream_5s_windows")
def q_ad_stream_5s_windows(spark, sf_dir):
    """Clicks per 5-second event-time window, streamed."""
    path, half = _ad_topic(spark, sf_dir)
    return AD.stream_counts(spark, path, "window", files_per_trigger=half)


@query("ad_upsert_sink")
def q_ad_upsert_sink(spark, sf_dir):
    """Stream into the upsert sink, then replay micro-batch 0 with its
    original rows; the table must be unchanged by the replay."""
    clicks = AD.parse_ad_messages(AD.file_messages(spark, *_ad_topic(spark, sf_dir)))
    sink = AD.UpsertSink(new_subdir(spark, "ad_upsert"), AD.DAY_KEYS)
    run = AD.run_to_sink(AD.running_daily_counts(clicks), sink, new_subdir(spark, "ad_upsert_ckpt"))
    run.awaitTermination()
    replay = spark.read.parquet(f"{sink.path}/log/kind=total/query_id={run.id}/batch_id=0")
    sink.write_batch(cut_lineage(replay), 0, str(run.id))
    return sink.read(spark)


@query("ad_sink_folded")
def q_ad_sink_folded(spark, sf_dir):
    """One query counts the clicks of even event ids, the sink is folded,
    the query goes on with the odd ones from its checkpoint, a new query counts
    these once more, the sink is folded again and a folded batch is replayed."""
    events = _t(spark, sf_dir).raw("events")
    topic, late = new_subdir(spark, "ad_fold_topic"), new_subdir(spark, "ad_fold_late")
    sink = AD.UpsertSink(new_subdir(spark, "ad_fold"), AD.DAY_KEYS)

    def run(folder: str, checkpoint: str):
        clicks = AD.parse_ad_messages(AD.file_messages(spark, folder, 1000))
        q = AD.run_to_sink(AD.running_daily_counts(clicks), sink, checkpoint)
        q.awaitTermination()
        return str(q.id)

    first = new_subdir(spark, "ad_fold_ckpt")
    AD.messages_from_clicks(events.where("event_id % 2 = 0")).write.text(topic)
    query_id = run(topic, first)
    replay = cut_lineage(spark.read.parquet(f"{sink.path}/log/kind=total/query_id={query_id}/batch_id=0"))
    sink.fold(spark)
    for folder in (topic, late):
        AD.messages_from_clicks(events.where("event_id % 2 <> 0")).write.mode("append").text(folder)
    run(topic, first)
    run(late, new_subdir(spark, "ad_fold_ckpt"))
    sink.fold(spark)
    sink.write_batch(replay, 0, query_id)
    return sink.read(spark)


@query("ad_stream_late_clicks")
def q_ad_stream_late_clicks(spark, sf_dir):
    """T3 where the newest days come first: every batch is late, all count; the
    sink is folded after every second batch."""
    path = new_subdir(spark, "ad_late")
    _messages(_t(spark, sf_dir)).repartitionByRange(5, F.desc("value")).write.text(path)
    return AD.stream_counts(spark, path, "daily", files_per_trigger=1, fold_every=2)
