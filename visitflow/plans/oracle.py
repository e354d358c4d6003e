"""Independent SQL twins of the registered queries, for DuckDB.

Each string runs on DuckDB with the raw test tables registered as views. The
adapter CTEs restate ``visitflow.sources.adapter`` in SQL; every query then
computes its result from those CTEs with plain SQL (no shared code with the
Spark side), which is what makes the comparison a check.
"""

from __future__ import annotations

ADAPTER_CTES = """
e AS (
  SELECT *, CAST(regexp_extract(props, '[0-9]+', 0) AS BIGINT) AS k FROM events),
uva AS (
  SELECT CAST(ts AS DATE) AS visit_date, user_id,
         concat(CAST(user_id AS VARCHAR), '_', CAST(CAST(ts AS DATE) AS VARCHAR)) AS session_id,
         k % 10 AS page_id, ts AS action_time, event_id,
         CASE WHEN event_type = 'view' THEN concat('kw', CAST(k % 4 AS VARCHAR)) END AS search_keyword,
         CASE WHEN event_type = 'click' THEN k END AS click_category_id,
         CASE WHEN event_type = 'click' THEN (k * 7 + 3) % 100 END AS click_product_id,
         CASE WHEN event_type = 'purchase' THEN CASE WHEN k % 7 = 0 THEN ''
              ELSE concat(CAST(k AS VARCHAR), ',', CAST((k + 1) % 100 AS VARCHAR)) END END AS order_category_ids,
         CASE WHEN event_type = 'signup' THEN CASE WHEN k % 7 = 0 THEN ''
              ELSE concat(CAST(k AS VARCHAR), ',', CAST((k + 2) % 100 AS VARCHAR)) END END AS pay_category_ids,
         event_id % 25 AS city_id,
         CASE WHEN event_type = 'purchase' THEN CASE WHEN k % 7 = 0 THEN ''
              ELSE concat(CAST((k * 7 + 3) % 100 AS VARCHAR), ',', CAST(((k * 7 + 3) % 100 + 1) % 100 AS VARCHAR)) END END AS order_product_ids,
         CASE WHEN event_type = 'signup' THEN CASE WHEN k % 7 = 0 THEN ''
              ELSE concat(CAST((k * 7 + 3) % 100 AS VARCHAR), ',', CAST(((k * 7 + 3) % 100 + 2) % 100 AS VARCHAR)) END END AS pay_product_ids
  FROM e),
ui AS (
  SELECT c_custkey AS user_id, CAST(18 + c_custkey % 60 AS INTEGER) AS age, c_mktsegment AS professional,
         n_name AS city, CASE WHEN c_custkey % 2 = 0 THEN 'man' ELSE 'woman' END AS sex
  FROM customer JOIN nation ON c_nationkey = n_nationkey),
cty AS (
  SELECT CAST(n_nationkey AS BIGINT) AS city_id, n_name AS city_name, r_name AS area
  FROM nation JOIN region ON n_regionkey = r_regionkey),
ses AS (
  SELECT session_id, min(user_id) AS user_id, min(action_time) AS start_time, max(action_time) AS end_time,
         CAST((epoch_us(max(action_time)) - epoch_us(min(action_time))) // 1000000 AS BIGINT) AS visit_length,
         CAST(count(*) AS BIGINT) AS step_length,
         string_agg(DISTINCT search_keyword, ',' ORDER BY search_keyword)
           FILTER (WHERE trim(search_keyword) <> '') AS search_keywords,
         array_to_string(list_sort(list(DISTINCT click_category_id)
           FILTER (WHERE click_category_id IS NOT NULL)), ',') AS click_category_ids
  FROM uva GROUP BY session_id),
prof AS (
  SELECT ses.*, ui.age, ui.professional, ui.city, ui.sex FROM ses JOIN ui USING (user_id)),
touch AS (
  SELECT click_category_id AS category_id, 'click' AS kind, session_id, event_id FROM uva
  WHERE click_category_id IS NOT NULL
  UNION ALL
  SELECT TRY_CAST(trim(x) AS BIGINT), 'order', session_id, event_id
  FROM (SELECT session_id, event_id, unnest(string_split(order_category_ids, ',')) AS x FROM uva
        WHERE order_category_ids IS NOT NULL) WHERE trim(x) <> ''
  UNION ALL
  SELECT TRY_CAST(trim(x) AS BIGINT), 'pay', session_id, event_id
  FROM (SELECT session_id, event_id, unnest(string_split(pay_category_ids, ',')) AS x FROM uva
        WHERE pay_category_ids IS NOT NULL) WHERE trim(x) <> ''),
catc AS (
  SELECT category_id,
         CAST(count(*) FILTER (WHERE kind = 'click') AS BIGINT) AS click_count,
         CAST(count(*) FILTER (WHERE kind = 'order') AS BIGINT) AS order_count,
         CAST(count(*) FILTER (WHERE kind = 'pay') AS BIGINT) AS pay_count
  FROM touch GROUP BY category_id)
"""


def with_adapter(body: str) -> str:
    """Prefix ``body`` (which may start with ', extra AS (...)') with the CTEs."""
    body = body.strip()
    if body.startswith(","):
        return "WITH " + ADAPTER_CTES.strip() + body
    return "WITH " + ADAPTER_CTES.strip() + "\n" + body


SESSION_COLS = ("session_id, user_id, start_time, end_time, visit_length, step_length, "
                "search_keywords, click_category_ids")

ORACLE: dict[str, str] = {}


def oracle(name: str, body: str) -> None:
    ORACLE[name] = with_adapter(body)


oracle("session_agg", f"SELECT {SESSION_COLS} FROM ses")
oracle("session_profile", f"SELECT {SESSION_COLS}, age, professional, city, sex FROM prof")
oracle("category_counts", "SELECT category_id, click_count, order_count, pay_count FROM catc")
oracle("categories_top10", """
SELECT category_id, click_count, order_count, pay_count,
       CAST(row_number() OVER (ORDER BY click_count DESC, order_count DESC, pay_count DESC,
                               category_id DESC) AS INTEGER) AS rank
FROM catc ORDER BY click_count DESC, order_count DESC, pay_count DESC, category_id DESC LIMIT 10""")

# ---------------------------------------------------------------- sessions
UVA_COLS = ("visit_date, user_id, session_id, page_id, action_time, event_id, search_keyword, "
            "click_category_id, click_product_id, order_category_ids, pay_category_ids, city_id, "
            "order_product_ids, pay_product_ids")
PROF_COLS = SESSION_COLS + ", age, professional, city, sex"

oracle("visits_in_range", f"SELECT {UVA_COLS} FROM uva "
       "WHERE visit_date BETWEEN DATE '2024-01-10' AND DATE '2024-01-20'")
oracle("session_keywords", "SELECT session_id, search_keywords FROM ses")
oracle("session_categories", "SELECT session_id, click_category_ids FROM ses")
oracle("filter_age", f"SELECT {PROF_COLS} FROM prof WHERE age BETWEEN 20 AND 50")
oracle("filter_profession", f"SELECT {PROF_COLS} FROM prof WHERE professional IN ('BUILDING', 'MACHINERY')")
oracle("filter_sex", f"SELECT {PROF_COLS} FROM prof WHERE sex = 'woman'")
oracle("filter_keywords", f"""SELECT {PROF_COLS} FROM prof WHERE session_id IN (
  SELECT session_id FROM uva WHERE search_keyword IN ('kw1', 'kw3'))""")
oracle("filter_categories", f"""SELECT {PROF_COLS} FROM prof WHERE session_id IN (
  SELECT session_id FROM uva WHERE click_category_id IN (2, 50, 77))""")
COMPOSITE_WHERE = ("CAST(start_time AS DATE) BETWEEN DATE '2024-01-03' AND DATE '2024-01-27' "
                   "AND age BETWEEN 20 AND 50 AND professional IN ('AUTOMOBILE', 'BUILDING', 'HOUSEHOLD')")
oracle("filtered_sessions", f"SELECT {PROF_COLS} FROM prof WHERE {COMPOSITE_WHERE}")

VISIT_BUCKETS = [("1s_3s", 0, 3), ("4s_6s", 3, 6), ("7s_9s", 6, 9), ("10s_30s", 9, 30),
                 ("30s_60s", 30, 60), ("1m_3m", 60, 180), ("3m_10m", 180, 600),
                 ("10m_30m", 600, 1800), ("30m", 1800, None)]
STEP_BUCKETS = [("1_3", 0, 3), ("4_6", 3, 6), ("7_9", 6, 9), ("10_30", 9, 30),
                ("30_60", 30, 60), ("60", 60, None)]


def _cond(col, lo, hi):
    return f"{col} > {lo}" + (f" AND {col} <= {hi}" if hi is not None else "")


_stat_cols = ["CAST(count(*) AS BIGINT) AS session_count"]
_stat_cols += [f"CAST(count(*) FILTER (WHERE {_cond('visit_length', lo, hi)}) AS BIGINT) AS visit_len_{n}"
               for n, lo, hi in VISIT_BUCKETS]
_stat_cols += [f"CAST(count(*) FILTER (WHERE {_cond('step_length', lo, hi)}) AS BIGINT) AS step_len_{n}"
               for n, lo, hi in STEP_BUCKETS]
STATS_SQL = f"SELECT {', '.join(_stat_cols)} FROM prof WHERE age BETWEEN 12 AND 60"
oracle("session_stats", STATS_SQL)
oracle("visit_length_buckets", f", st AS ({STATS_SQL})\n" + " UNION ALL ".join(
    f"SELECT '{n}' AS bucket, visit_len_{n} AS session_count FROM st" for n, _, _ in VISIT_BUCKETS))
oracle("step_length_buckets", f", st AS ({STATS_SQL})\n" + " UNION ALL ".join(
    f"SELECT '{n}' AS bucket, step_len_{n} AS session_count FROM st" for n, _, _ in STEP_BUCKETS))


def _half_up(n, d):
    return f"CASE WHEN {d} > 0 THEN CAST((200 * {n} + {d}) // (2 * {d}) AS DOUBLE) / 100 END"


_ratio_cols = [f"{_half_up(f'visit_len_{n}', 'session_count')} AS visit_len_{n}_ratio" for n, _, _ in VISIT_BUCKETS]
_ratio_cols += [f"{_half_up(f'step_len_{n}', 'session_count')} AS step_len_{n}_ratio" for n, _, _ in STEP_BUCKETS]
oracle("session_stat_ratios", f", st AS ({STATS_SQL})\nSELECT session_count, {', '.join(_ratio_cols)} FROM st")
oracle("sessions_per_hour", """
SELECT CAST(start_time AS DATE) AS visit_day, CAST(hour(start_time) AS INTEGER) AS hour,
       strftime(start_time, '%Y-%m-%d_%H') AS day_hour, CAST(count(*) AS BIGINT) AS session_count
FROM ses GROUP BY 1, 2, 3""")
oracle("session_detail", f"""SELECT {UVA_COLS} FROM uva WHERE session_id IN (
  SELECT session_id FROM prof WHERE {COMPOSITE_WHERE})""")

# ---------------------------------------------------------------- funnel
FLOW_VALUES = "(1, 1, 2), (2, 2, 3), (3, 3, 4), (4, 4, 5), (5, 5, 6), (6, 6, 7), (7, 7, 8), (8, 8, 9)"
FUNNEL_CTES = f"""
, ordered AS (
  SELECT session_id, event_id, action_time, page_id,
         lag(page_id) OVER (PARTITION BY session_id ORDER BY action_time, event_id) AS prev_page_id,
         row_number() OVER (PARTITION BY session_id ORDER BY action_time, event_id) AS rn
  FROM uva),
flow AS (SELECT step, from_page, to_page, concat(from_page, '_', to_page) AS split
         FROM (VALUES {FLOW_VALUES}) t(step, from_page, to_page)),
matched AS (
  SELECT f.step, f.split, CAST(count(*) AS BIGINT) AS pair_count
  FROM ordered o JOIN flow f ON o.prev_page_id = f.from_page AND o.page_id = f.to_page
  WHERE o.rn > 1 GROUP BY f.step, f.split),
spv AS (
  SELECT f.step, f.split, CAST(coalesce(m.pair_count, 0) AS BIGINT) AS split_pv
  FROM flow f LEFT JOIN matched m USING (step)),
startpv AS (SELECT CAST(count(*) FILTER (WHERE page_id = 1) AS BIGINT) AS start_page_pv FROM uva),
rates AS (
  SELECT step, split, split_pv,
         CAST(coalesce(lag(split_pv) OVER (ORDER BY step), (SELECT start_page_pv FROM startpv)) AS BIGINT) AS prev_pv
  FROM spv)
"""
oracle("page_transitions", FUNNEL_CTES + "SELECT session_id, event_id, action_time, page_id, prev_page_id FROM ordered")
oracle("page_flow_matches", FUNNEL_CTES + "SELECT step, split, pair_count FROM matched")
oracle("page_split_pv", FUNNEL_CTES + "SELECT step, split, split_pv FROM spv")
oracle("start_page_pv", FUNNEL_CTES + "SELECT start_page_pv FROM startpv")
oracle("page_convert_rate", FUNNEL_CTES +
       f"SELECT step, split, split_pv, prev_pv, {_half_up('split_pv', 'prev_pv')} AS rate FROM rates")
oracle("page_rate_report", FUNNEL_CTES + f"""
SELECT CAST(1 AS BIGINT) AS task_id,
       string_agg(split || '=' || coalesce(CAST(rate AS VARCHAR), ''), '|' ORDER BY step) AS report
FROM (SELECT step, split, {_half_up('split_pv', 'prev_pv')} AS rate FROM rates)""")

INCOMPLETE = """
, inc AS (SELECT CASE WHEN event_id % 9 <> 0 THEN session_id END AS session_id, event_id,
                 CASE WHEN event_id % 4 <> 0 THEN action_time END AS action_time, page_id FROM uva),
inc_prev AS (SELECT *, CASE WHEN session_id IS NOT NULL THEN lag(page_id) OVER (
               PARTITION BY session_id ORDER BY action_time NULLS FIRST, event_id) END AS prev_page_id FROM inc)
"""
oracle("page_transitions_incomplete", INCOMPLETE +
       "SELECT session_id, event_id, action_time, page_id, prev_page_id FROM inc_prev")
oracle("page_split_pv_incomplete", INCOMPLETE + """
SELECT CAST(s AS INTEGER) AS step, CAST(s AS VARCHAR) || '_' || CAST(s + 1 AS VARCHAR) AS split,
       CAST(count(p.event_id) AS BIGINT) AS split_pv
FROM range(1, 9) t(s) LEFT JOIN inc_prev p ON p.prev_page_id = s AND p.page_id = s + 1 GROUP BY s""")

# ---------------------------------------------------------------- categories
oracle("touched_categories", "SELECT DISTINCT category_id FROM touch")
oracle("category_clicks", "SELECT category_id, CAST(count(*) AS BIGINT) AS click_count FROM touch "
       "WHERE kind = 'click' GROUP BY category_id")
oracle("category_clicks_salted", "SELECT category_id, CAST(count(*) AS BIGINT) AS click_count FROM touch "
       "WHERE kind = 'click' GROUP BY category_id")
oracle("category_orders", "SELECT category_id, CAST(count(*) AS BIGINT) AS order_count FROM touch "
       "WHERE kind = 'order' GROUP BY category_id")
oracle("category_pays", "SELECT category_id, CAST(count(*) AS BIGINT) AS pay_count FROM touch "
       "WHERE kind = 'pay' GROUP BY category_id")
oracle("categories_ranked", "SELECT category_id, click_count, order_count, pay_count FROM catc "
       "ORDER BY click_count DESC, order_count DESC, pay_count DESC, category_id DESC")
SCC = ("scc AS (SELECT category_id, session_id, CAST(count(*) AS BIGINT) AS click_count FROM touch "
       "WHERE kind = 'click' GROUP BY category_id, session_id)")
oracle("session_category_clicks", f", {SCC}\nSELECT category_id, session_id, click_count FROM scc")
oracle("category_top_sessions", f""", {SCC}
SELECT * FROM (
  SELECT category_id, session_id, click_count,
         CAST(row_number() OVER (PARTITION BY category_id ORDER BY click_count DESC, session_id DESC)
              AS INTEGER) AS rank
  FROM scc) WHERE rank <= 10""")
oracle("top_sessions_for_top_categories", f""", {SCC},
topc AS (
  SELECT category_id, CAST(row_number() OVER (ORDER BY click_count DESC, order_count DESC, pay_count DESC,
                                              category_id DESC) AS INTEGER) AS category_rank
  FROM catc ORDER BY category_rank LIMIT 10)
SELECT * FROM (
  SELECT scc.category_id, session_id, click_count, category_rank,
         CAST(row_number() OVER (PARTITION BY scc.category_id ORDER BY click_count DESC, session_id DESC)
              AS INTEGER) AS rank
  FROM scc JOIN topc USING (category_id)) WHERE rank <= 10""")

# ---------------------------------------------------------------- area
AREA_CTES = """
, pc AS (SELECT event_id, city_id, click_product_id AS product_id FROM uva
         WHERE click_product_id IS NOT NULL AND upper(trim(CAST(click_product_id AS VARCHAR))) <> 'NULL'),
pcc AS (SELECT pc.city_id, pc.event_id, pc.product_id, cty.city_name, cty.area FROM pc JOIN cty USING (city_id)),
apc AS (SELECT area, product_id, CAST(count(*) AS BIGINT) AS click_count,
               string_agg(DISTINCT concat(CAST(city_id AS VARCHAR), ':', city_name), ','
                          ORDER BY concat(CAST(city_id AS VARCHAR), ':', city_name)) AS city_infos
        FROM pcc GROUP BY area, product_id),
apl AS (SELECT *, CASE WHEN area IN ('AMERICA', 'EUROPE') THEN 'A级' WHEN area IN ('ASIA') THEN 'B级'
                       WHEN area IN ('AFRICA') THEN 'C级' ELSE 'D级' END AS area_level FROM apc)
"""
oracle("product_clicks", AREA_CTES + "SELECT event_id, city_id, product_id FROM pc")
oracle("product_clicks_by_city", AREA_CTES + "SELECT city_id, event_id, product_id, city_name, area FROM pcc")
oracle("city_labels", AREA_CTES + "SELECT event_id, concat(CAST(city_id AS VARCHAR), ':', city_name) AS city_label FROM pcc")
oracle("area_product_clicks", AREA_CTES + "SELECT area, product_id, click_count, city_infos FROM apc")
oracle("area_level", AREA_CTES + "SELECT area, product_id, click_count, city_infos, area_level FROM apl")
oracle("area_top_products", AREA_CTES + """
SELECT * FROM (
  SELECT area, product_id, click_count, city_infos, area_level,
         CAST(row_number() OVER (PARTITION BY area ORDER BY click_count DESC, product_id ASC) AS INTEGER) AS rank
  FROM apl) WHERE rank <= 3""")


# ---------------------------------------------------------------- sampling
def _sample_ctes(n: int, seed: int = 42, of: str = "ses") -> str:
    return f"""
, sh AS (SELECT session_id, user_id, start_time, end_time, visit_length, step_length,
                CAST(start_time AS DATE) AS visit_day, CAST(hour(start_time) AS INTEGER) AS hour FROM {of}),
hc AS (SELECT visit_day, hour, CAST(count(*) AS BIGINT) AS hour_cnt FROM sh GROUP BY visit_day, hour),
dc AS (SELECT visit_day, CAST(sum(hour_cnt) AS BIGINT) AS day_cnt FROM hc GROUP BY visit_day),
nd AS (SELECT CAST(count(*) AS BIGINT) AS n_days FROM dc),
q AS (SELECT hc.visit_day, hc.hour, hour_cnt, day_cnt, (SELECT n_days FROM nd) AS n_days,
             CAST(greatest(1, (hour_cnt * ({n} // (SELECT n_days FROM nd))) // day_cnt) AS BIGINT) AS quota
      FROM hc JOIN dc USING (visit_day)),
ranked AS (
  SELECT sh.*, CAST(row_number() OVER (PARTITION BY visit_day, hour
                                       ORDER BY md5('{seed}_' || session_id), session_id) AS INTEGER) AS sample_rank
  FROM sh),
smp AS (
  SELECT r.session_id, r.user_id, r.start_time, r.end_time, r.visit_length, r.step_length,
         r.visit_day, r.hour, q.quota, r.sample_rank
  FROM ranked r JOIN q USING (visit_day, hour) WHERE r.sample_rank <= q.quota)
"""


oracle("session_sample", _sample_ctes(100) + "SELECT * FROM smp")
oracle("session_sample_2000", _sample_ctes(2000) + "SELECT * FROM smp")
oracle("sessions_per_day", _sample_ctes(100) + "SELECT visit_day, hour, hour_cnt, day_cnt, n_days, quota FROM q")
oracle("session_sample_detail", _sample_ctes(100) +
       f"SELECT {UVA_COLS} FROM uva WHERE session_id IN (SELECT session_id FROM smp)")

# ---------------------------------------------------------------- missing session ids and times
INC_SESSIONS = """
, iuva AS (SELECT * REPLACE (CASE WHEN event_id % 9 <> 0 THEN session_id END AS session_id,
                             CASE WHEN event_id % 4 <> 0 THEN action_time END AS action_time) FROM uva),
ises AS (
  SELECT session_id, min(user_id) AS user_id, min(action_time) AS start_time, max(action_time) AS end_time,
         CAST((epoch_us(max(action_time)) - epoch_us(min(action_time))) // 1000000 AS BIGINT) AS visit_length,
         CAST(count(*) AS BIGINT) AS step_length
  FROM iuva WHERE session_id IS NOT NULL GROUP BY session_id),
itimed AS (SELECT * FROM ises WHERE start_time IS NOT NULL),
iscc AS (SELECT click_category_id AS category_id, session_id, CAST(count(*) AS BIGINT) AS click_count FROM iuva
         WHERE click_category_id IS NOT NULL AND session_id IS NOT NULL GROUP BY ALL)
"""
oracle("session_stats_incomplete", INC_SESSIONS + f"SELECT {', '.join(_stat_cols)} FROM ises")
oracle("session_sample_incomplete", INC_SESSIONS + _sample_ctes(100, of="itimed") + "SELECT * FROM smp")
oracle("sessions_per_hour_incomplete", INC_SESSIONS + """
SELECT CAST(start_time AS DATE) AS visit_day, CAST(hour(start_time) AS INTEGER) AS hour,
       strftime(start_time, '%Y-%m-%d_%H') AS day_hour, CAST(count(*) AS BIGINT) AS session_count
FROM itimed GROUP BY ALL""")
oracle("category_top_sessions_incomplete", INC_SESSIONS + """
SELECT category_id, session_id, click_count,
       CAST(row_number() OVER (PARTITION BY category_id ORDER BY click_count DESC, session_id DESC) AS INTEGER) AS rank
FROM iscc QUALIFY rank <= 10""")
oracle("top_sessions_for_top_categories_incomplete", INC_SESSIONS + """,
itop AS (
  SELECT category_id, CAST(row_number() OVER (ORDER BY click_count DESC, order_count DESC, pay_count DESC,
                                              category_id DESC) AS INTEGER) AS category_rank
  FROM catc ORDER BY category_rank LIMIT 10)
SELECT category_id, session_id, click_count, category_rank,
       CAST(row_number() OVER (PARTITION BY category_id ORDER BY click_count DESC, session_id DESC) AS INTEGER) AS rank
FROM iscc JOIN itop USING (category_id) QUALIFY rank <= 10""")
oracle("log_gaps", INC_SESSIONS + """
SELECT count(*) AS actions, count(*) - count(session_id) AS without_session, count(*) - count(action_time) AS without_time FROM iuva""")

# ---------------------------------------------------------------- session analysis, end to end
TASK_CTES = """
, tuva AS (SELECT * FROM uva WHERE visit_date BETWEEN DATE '2024-01-03' AND DATE '2024-01-27'),
kept AS (
  SELECT * FROM prof WHERE CAST(start_time AS DATE) BETWEEN DATE '2024-01-03' AND DATE '2024-01-27'
    AND age BETWEEN 18 AND 70 AND sex = 'man' AND professional IN ('AUTOMOBILE', 'BUILDING', 'HOUSEHOLD', 'MACHINERY')
    AND city IN (SELECT concat('NATION_', i) FROM range(20) n(i))
    AND session_id IN (SELECT session_id FROM tuva WHERE search_keyword IN ('kw1', 'kw2', 'kw3'))
    AND session_id IN (SELECT session_id FROM tuva WHERE click_category_id % 2 = 0)),
ktouch AS (SELECT * FROM touch WHERE session_id IN (SELECT session_id FROM kept)),
ktop AS (
  SELECT category_id, count(*) FILTER (WHERE kind = 'click') AS click_count,
         count(*) FILTER (WHERE kind = 'order') AS order_count, count(*) FILTER (WHERE kind = 'pay') AS pay_count,
         CAST(row_number() OVER (ORDER BY count(*) FILTER (WHERE kind = 'click') DESC, count(*) FILTER (WHERE kind = 'order') DESC,
                                 count(*) FILTER (WHERE kind = 'pay') DESC, category_id DESC) AS INTEGER) AS rank
  FROM ktouch GROUP BY category_id QUALIFY rank <= 10)
"""
oracle("task_session_stats", TASK_CTES + f"SELECT {', '.join(_stat_cols)} FROM kept")
oracle("task_session_sample", TASK_CTES + _sample_ctes(100, of="kept") +
       "SELECT smp.*, age, professional, city, sex FROM smp JOIN kept USING (session_id)")
oracle("task_top_categories", TASK_CTES + "SELECT category_id, click_count, order_count, pay_count, rank FROM ktop")
oracle("task_top_category_sessions", TASK_CTES + """
SELECT category_id, session_id, count(*) AS click_count, ktop.rank AS category_rank,
       CAST(row_number() OVER (PARTITION BY category_id ORDER BY count(*) DESC, session_id DESC) AS INTEGER) AS rank
FROM ktouch JOIN ktop USING (category_id) WHERE kind = 'click' GROUP BY category_id, session_id, ktop.rank
QUALIFY row_number() OVER (PARTITION BY category_id ORDER BY count(*) DESC, session_id DESC) <= 10""")

# ---------------------------------------------------------------- scalar functions
oracle("normalized_action_times", """
SELECT event_id, strftime(ts, '%Y-%m-%d %-H:%-M:%-S') AS raw_time, date_trunc('second', ts) AS action_time,
       strftime(ts, '%Y-%m-%d %H:%M:%S') AS padded_time FROM events""")
oracle("event_gap_seconds", """
, g AS (SELECT session_id, event_id, action_time,
               lag(action_time) OVER (PARTITION BY session_id ORDER BY action_time, event_id) AS prev_action_time
        FROM uva)
SELECT session_id, event_id, action_time, prev_action_time,
       CAST((epoch_us(action_time) - epoch_us(prev_action_time)) // 1000000 AS BIGINT) AS gap_seconds,
       action_time > prev_action_time AS is_later
FROM g""")
oracle("normalized_id_lists", """
, l AS (SELECT event_id, CASE WHEN order_category_ids IS NOT NULL THEN 'order' ELSE 'pay' END AS kind,
               coalesce(order_category_ids, pay_category_ids) AS raw_ids FROM uva
        WHERE order_category_ids IS NOT NULL OR pay_category_ids IS NOT NULL),
p AS (SELECT event_id, kind, raw_ids,
             list_filter(list_transform(list_filter(string_split(regexp_replace(raw_ids, '^,|,$', '', 'g'), ','),
                                                    lambda x: trim(x) <> ''), lambda x: TRY_CAST(trim(x) AS BIGINT)),
                         lambda x: x IS NOT NULL) AS id_arr FROM l)
SELECT event_id, kind, raw_ids, array_to_string(id_arr, ',') AS ids, CAST(len(id_arr) AS INTEGER) AS id_count FROM p""")
oracle("kv_records_export", """
SELECT session_id, concat_ws('|', 'user_id=' || CAST(user_id AS VARCHAR), 'visit_length=' || CAST(visit_length AS VARCHAR),
       'step_length=' || CAST(step_length AS VARCHAR), 'search_keywords=' || coalesce(search_keywords, ''),
       'click_category_ids=' || coalesce(click_category_ids, '')) AS record FROM ses""")
oracle("kv_records_parsed", """
SELECT session_id, user_id, visit_length, step_length, coalesce(search_keywords, '') AS search_keywords,
       coalesce(click_category_ids, '') AS click_category_ids FROM ses""")

oracle("kv_records_escaped", """
SELECT event_id, concat(event_type, '|user_id=9=%7C%', CAST(user_id AS VARCHAR)) AS word, user_id, props FROM events""")

# ---------------------------------------------------------------- text quality, generator
LINES_CTE = """
, li AS (SELECT l_orderkey % 20 AS k, CAST(l_orderkey AS VARCHAR) AS l_orderkey, CAST(l_partkey AS VARCHAR) AS l_partkey,
                CAST(l_suppkey AS VARCHAR) AS l_suppkey, CAST(l_linenumber AS VARCHAR) AS l_linenumber,
                CAST(l_quantity AS VARCHAR) AS l_quantity, CAST(l_extendedprice AS VARCHAR) AS l_extendedprice,
                CAST(l_discount AS VARCHAR) AS l_discount, CAST(l_tax AS VARCHAR) AS l_tax, l_returnflag,
                l_linestatus, CAST(l_shipdate AS VARCHAR) AS l_shipdate FROM lineitem),
lines AS (
  SELECT CASE WHEN k = 0 THEN concat_ws(',', l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity,
                                        l_extendedprice, l_discount, l_tax, '', l_linestatus, l_shipdate)
              WHEN k = 10 THEN concat_ws(',', l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity,
                                         l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus)
              ELSE concat_ws(',', l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice,
                             l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) END AS line
  FROM li),
cls AS (
  SELECT line, string_split(line, ',') AS f,
         CASE WHEN len(string_split(line, ',')) <> 11 THEN 'field_count'
              WHEN len(list_filter(string_split(line, ','), lambda x: trim(x) = '')) > 0 THEN 'empty_field' END AS reason
  FROM lines)
"""
oracle("csv_valid_rows", LINES_CTE + """
SELECT f[1] AS l_orderkey, f[2] AS l_partkey, f[3] AS l_suppkey, f[4] AS l_linenumber, f[5] AS l_quantity,
       f[6] AS l_extendedprice, f[7] AS l_discount, f[8] AS l_tax, f[9] AS l_returnflag, f[10] AS l_linestatus,
       f[11] AS l_shipdate FROM cls WHERE reason IS NULL""")
oracle("csv_accepted_rows", LINES_CTE + """
SELECT f[1] AS l_orderkey, f[2] AS l_partkey, f[3] AS l_suppkey, f[4] AS l_linenumber, f[5] AS l_quantity,
       f[6] AS l_extendedprice, f[7] AS l_discount, f[8] AS l_tax, f[9] AS l_returnflag, f[10] AS l_linestatus,
       f[11] AS l_shipdate FROM cls WHERE reason IS NULL""")
oracle("csv_quarantine", LINES_CTE + "SELECT line, reason AS reject_reason, true AS has_file FROM cls WHERE reason IS NOT NULL")
oracle("csv_reject_counts", LINES_CTE + """
SELECT reason AS reject_reason, CAST(count(*) AS BIGINT) AS line_count FROM cls WHERE reason IS NOT NULL GROUP BY reason""")


def _mix(x: str, j: int, seed: int = 666) -> str:
    return f"((({x}) + {seed * 31 + j * 7919}) * 48271) % 2147483647"


oracle("synthetic_visit_counts", f"""
, sv AS (SELECT event_id AS id, event_id // 10 AS sess FROM events),
rows AS (SELECT ['SEARCH', 'CLICK', 'ORDER', 'PAY'][CAST({_mix('id', 3)} % 4 + 1 AS INTEGER)] AS action_type,
                {_mix('id', 2)} % 10 AS page_id, 's' || CAST(sess AS VARCHAR) AS session_id,
                {_mix('sess', 1)} % 100 AS user_id FROM sv)
SELECT action_type, page_id, CAST(count(*) AS BIGINT) AS n_actions,
       CAST(count(DISTINCT session_id) AS BIGINT) AS n_sessions, CAST(count(DISTINCT user_id) AS BIGINT) AS n_users,
       CAST(count(*) FILTER (WHERE action_type = 'SEARCH') AS BIGINT) AS n_searches
FROM rows GROUP BY action_type, page_id""")

# ---------------------------------------------------------------- ad clicks
AD_CTES = """
, msg AS (SELECT event_id, epoch_us(ts) // 1000 AS ms, 'province' || CAST(user_id % 5 AS VARCHAR) AS province,
                 'city' || CAST(event_id % 25 AS VARCHAR) AS city, user_id, k AS ad_id
          FROM e WHERE event_type = 'click'),
clk AS (SELECT make_timestamp(ms * 1000) AS event_time, CAST(make_timestamp(ms * 1000) AS DATE) AS day,
               province, city, user_id, ad_id FROM msg WHERE event_id % 50 <> 0),
daily AS (SELECT day, user_id, ad_id, CAST(count(*) AS BIGINT) AS click_count FROM clk GROUP BY day, user_id, ad_id)
"""
oracle("ad_messages_parsed", AD_CTES +
       "SELECT event_time, day, strftime(event_time, '%Y%m%d') AS day_key, province, city, user_id, ad_id FROM clk")
oracle("ad_message_rejects", AD_CTES +
       "SELECT CAST(count(*) FILTER (WHERE event_id % 50 = 0) AS BIGINT) AS reject_count FROM msg")
oracle("ad_clicks_daily", AD_CTES + "SELECT day, user_id, ad_id, click_count FROM daily")
oracle("ad_stream_running_counts", AD_CTES + "SELECT day, user_id, ad_id, click_count FROM daily")
oracle("ad_upsert_sink", AD_CTES + "SELECT day, user_id, ad_id, click_count FROM daily")
oracle("ad_stream_late_clicks", AD_CTES + "SELECT day, user_id, ad_id, click_count FROM daily")
oracle("ad_sink_folded", AD_CTES + """
SELECT CAST(make_timestamp(ms * 1000) AS DATE) AS day, user_id, ad_id, CAST(sum(1 + event_id % 2) AS BIGINT) AS click_count
FROM msg WHERE event_id % 50 <> 0 GROUP BY ALL""")
oracle("ad_stream_5s_windows", AD_CTES + """
SELECT make_timestamp((epoch_ms(event_time) // 5000) * 5000 * 1000) AS window_start,
       make_timestamp((epoch_ms(event_time) // 5000) * 5000 * 1000 + 5000000) AS window_end,
       user_id, ad_id, CAST(count(*) AS BIGINT) AS click_count
FROM clk GROUP BY 1, 2, user_id, ad_id""")
