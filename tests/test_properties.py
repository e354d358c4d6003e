"""Property tests (hypothesis) for the scalar building blocks."""

from decimal import ROUND_HALF_UP, Decimal

from hypothesis import given, settings
from hypothesis import strategies as st

from visitflow.functions import expressions as X


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 10 ** 9), st.integers(0, 10 ** 9)), min_size=1, max_size=200))
def test_half_up_matches_decimal(spark, pairs):
    df = spark.createDataFrame(pairs, "n BIGINT, d BIGINT")
    got = [r.r for r in df.select(X.ratio_half_up("n", "d").alias("r")).collect()]
    want = [None if d == 0 else float((Decimal(n) / Decimal(d)).quantize(Decimal("0.01"), ROUND_HALF_UP))
            for n, d in pairs]
    assert got == want


_token = st.one_of(st.integers(0, 999).map(str), st.just(""), st.just(" "), st.just("x"))


@settings(max_examples=10, deadline=None)
@given(st.lists(st.lists(_token, max_size=6).map(",".join), min_size=1, max_size=100))
def test_id_list_matches_python(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t STRING")
    got = [list(r.ids) for r in df.select(X.id_list("t").alias("ids")).collect()]

    def py(t):
        t = t[1:] if t.startswith(",") else t
        t = t[:-1] if t.endswith(",") else t
        out = []
        for part in t.split(","):
            part = part.strip()
            if part and part.lstrip("-").isdigit():
                out.append(int(part))
        return out
    assert got == [py(t) for t in texts]


_session_times = st.lists(st.tuples(st.integers(0, 2), st.integers(0, 23), st.integers(0, 3599)),
                          min_size=1, max_size=150)


@settings(max_examples=8, deadline=None)
@given(_session_times, st.sampled_from([1, 5, 40, 500]))
def test_sample_matches_python_definition(spark, starts, n):
    import datetime as dt
    import hashlib

    from pyspark.sql import types as T

    from visitflow.operators import sampling as Y
    t0 = dt.datetime(2024, 1, 1)
    rows = [(f"s{i}", t0 + dt.timedelta(days=d, hours=h, seconds=s)) for i, (d, h, s) in enumerate(starts)]
    schema = T.StructType([T.StructField("session_id", T.StringType()),
                           T.StructField("start_time", T.TimestampNTZType())])
    got = sorted(r.session_id for r in Y.stratified_sample(spark.createDataFrame(rows, schema), n, 7).collect())

    by_hour: dict = {}
    for sid, ts in rows:
        by_hour.setdefault((ts.date(), ts.hour), []).append(sid)
    day_cnt: dict = {}
    for (day, _), ids in by_hour.items():
        day_cnt[day] = day_cnt.get(day, 0) + len(ids)
    per_day = n // len(day_cnt)
    want = []
    for (day, _), ids in by_hour.items():
        quota = max(1, (len(ids) * per_day) // day_cnt[day])
        ranked = sorted(ids, key=lambda sid: (hashlib.md5(f"7_{sid}".encode()).hexdigest(), sid))
        want += ranked[:quota]
    assert got == sorted(want)


_actions = st.lists(st.tuples(st.integers(0, 4), st.integers(0, 3 * 86400), st.integers(0, 4)),
                    min_size=1, max_size=120)


@settings(max_examples=6, deadline=None)
@given(_actions, st.lists(st.integers(0, 4), min_size=2, max_size=5))
def test_funnel_counts_match_python(spark, rows, flow):
    import datetime as dt

    from visitflow.operators import funnel as FN
    from visitflow.schemas import VISIT_ACTION
    t0 = dt.datetime(2024, 1, 1)
    data = [(None, None, f"s{s}", p, t0 + dt.timedelta(seconds=sec), i, *[None] * 8)
            for i, (s, sec, p) in enumerate(rows)]
    df = spark.createDataFrame(data, VISIT_ACTION)

    by_session: dict = {}
    for _, _, sid, page, ts, eid, *_ in data:
        by_session.setdefault(sid, []).append((ts, eid, page))
    pairs = []
    for acts in by_session.values():
        acts.sort()
        pairs += [(a[2], b[2]) for a, b in zip(acts, acts[1:])]
    want = [sum(1 for p in pairs if p == (flow[i - 1], flow[i])) for i in range(1, len(flow))]
    want_start = sum(1 for r in data if r[3] == flow[0])

    for ranges in (1, 2, 5, 30):
        counts = FN.funnel_counts(df, flow, ranges=ranges).first()
        assert [counts[f"pv_{i}"] for i in range(1, len(flow))] == want, ranges
        assert counts.start_page_pv == want_start, ranges
