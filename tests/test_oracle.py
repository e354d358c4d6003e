"""Every registered query against its DuckDB twin on the smallest tables
(the driver runs the same comparison at sf0.01; see tests/oracle_compare.py)."""

import pytest

import __spark_entry__ as E
from oracle_compare import compare, duck

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


@pytest.mark.parametrize("name", sorted(E.queries()))
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, name, SF_DIR, con)
    assert r["status"] in ("ok", "rows-only"), r


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() >= 0 and "category_id" in df.columns


ZONE_SENSITIVE = ("visits_in_range", "normalized_action_times", "ad_messages_parsed", "ad_clicks_daily",
                  "ad_stream_5s_windows", "ad_stream_running_counts", "sessions_per_hour", "event_gap_seconds")


@pytest.mark.parametrize("name", ZONE_SENSITIVE)
def test_query_independent_of_session_zone(spark, con, name):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
    try:
        r = compare(spark, name, SF_DIR, con)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert r["status"] == "ok", r


def test_many_ranges_match_oracle(spark, con):
    """The previous row over many small ranges against the same SQL twin."""
    from oracle_compare import _rows
    from visitflow.operators import funnel as FN
    from visitflow.sources.adapter import SuppliedTables
    df = FN.page_transitions(SuppliedTables(spark, SF_DIR).actions(), ranges=97)
    cur = con.execute(E.oracle_sql()["page_transitions"])
    d_cols = [c[0] for c in cur.description]
    assert _rows(df.columns, [tuple(r) for r in df.collect()]) == _rows(d_cols, cur.fetchall())


def test_every_query_has_a_sql_twin():
    own = set(E.queries()) - set(E.LLM_QUERIES)
    assert own == set(E.oracle_sql()) - set(E.LLM_ORACLE) and len(own) == 75


def test_bench_prints_one_json_line():
    import json
    import os
    import subprocess
    import sys
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = dict(os.environ, BENCH_SF_DIR=SF_DIR, BENCH_CPUS="2", BENCH_RUNS="1", BENCH_QUERIES="categories_top10")
    out = subprocess.run([sys.executable, os.path.join(root, "bench.py")], env=env, capture_output=True,
                         text=True, timeout=600)
    lines = [ln for ln in out.stdout.splitlines() if ln.strip()]
    assert len(lines) == 1, out.stdout
    rec = json.loads(lines[0])
    assert {"metric", "value", "unit", "queries", "sf"} <= set(rec) and rec["unit"] == "sec"
    assert rec["queries"]["categories_top10"] is not None and rec["sf"] == "0.001"
