"""Phrase mining, whitening and top-k search against plain Python and numpy."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from oracle_compare import compare
from visitflow.llm import phrases, pivot_search, queries, whitening
from visitflow.sources.tables import read_table

from llm_tables import AWKWARD, docs_df, empty_docs

SMALL = "/root/testdata/sf0.001"
NAN, INF = float("nan"), float("inf")
VECTORS = "vec_id bigint, embedding array<float>, label int, row bigint, n bigint, score string"


def vectors_df(spark, rows):
    """Vectors with further columns, some named like the operators' own."""
    return spark.createDataFrame([(i, v, 1, -1, -2, "x") for i, v in rows], VECTORS)


# phrases -----------------------------------------------------------------

LOWER = {chr(c): chr(c + 32) for c in range(65, 91)}


def plain_phrases(rows, min_count, top):
    counts, n = {}, Counter()
    for lang, text in rows:
        own = counts.setdefault(lang or "und", Counter())
        for piece in re.split("[.,;:!?\x0a-\x0d]", "".join(LOWER.get(c, c) for c in text or "")):
            words = re.findall("[^\x20\x09]+", piece)
            n[lang or "und"] += len(words)
            own.update(tuple(words[i:i + k]) for k in (1, 2, 3) for i in range(len(words) - k + 1))
    out = []
    for lang, c in counts.items():
        found = []
        for p, a in c.items():
            if len(p) == 1 or a < min_count:
                continue
            if any(100 * b >= 50 * a for q, b in c.items() if len(q) == 3 and b >= min_count and len(p) == 2 and p in (q[:2], q[1:])):
                continue
            score, k = min((1_000_000 * a * a // (c[p[:k]] * c[p[k:]]), k) for k in range(1, len(p)))
            found.append((score, a, " ".join(p), c[p[:k]], c[p[k:]]))
        found.sort(key=lambda x: (-x[0], -x[1], x[2].encode()))
        out += [(lang, i + 1, p, a, left, right, n[lang], s) for i, (s, a, p, left, right) in enumerate(found[:top])]
    return sorted(out)


def phrase_rows(seed=1):
    rnd = random.Random(seed)
    words = ["the", "The", "cat", "sat", "é", "É", "漢字", "a\x01b", "a", "x" * 300, "no\x1fend"]
    ends = [" ", " ", " ", "  ", "\t", ". ", ",", "\n", " \x0b", "!?", " \r"]
    texts = [None, "", " \t", "...", "cat"] + ["".join(rnd.choice(words) + rnd.choice(ends) for _ in range(rnd.randint(1, 60))) for _ in range(80)]
    return [(rnd.choice(["en", "fr", None, "und"]), t) for t in texts] + [("en", "repeated row, of words")] * 15


@pytest.mark.parametrize("ranges, max_bytes, partitions", [(1, 1 << 20, 1), (7, 64, 3), (60, 1 << 20, 5)])
def test_phrases_match_plain_counts(spark, ranges, max_bytes, partitions):
    """For any cut of the streams and a bit map that is full as well."""
    rows = phrase_rows()
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(partitions)
    for top in (3, 2000):
        got = sorted(map(tuple, phrases.collocations(docs, min_count=4, top=top, ranges=ranges, max_bytes=max_bytes).collect()))
        assert got == plain_phrases(rows, 4, top)
    assert len(got) > 50


def test_phrases_awkward_rows(spark):
    assert phrases.collocations(empty_docs(spark)).count() == 0
    got = phrases.collocations(docs_df(spark), min_count=10)
    assert sorted(map(tuple, got.collect())) == plain_phrases([("en", t) for _, t in AWKWARD], 10, 2000)
    assert phrases.collocations(docs_df(spark, [(1, None), (2, " . ")])).count() == 0


def test_phrase_scores_pass_64_bits(spark):
    """Counts whose products need more than 64 bits, and a tie of two cuts."""
    big = 4_000_000_000
    rows = [("en", "a", None, None, big), ("en", "b", None, None, big + 1), ("en", "c", None, None, big), ("en", "a", "b", None, big - 3),
            ("en", "b", "c", None, big - 3), ("en", "a", "b", "c", 10)]
    got = {r.a: r for r in phrases.candidates(spark.createDataFrame(rows, "lang string, w1 string, w2 string, w3 string, f bigint"), 3).collect() if r.w3}
    assert (got[10].l, got[10].r, got[10].score) == (big, big - 3, 1_000_000 * 100 // (big * (big - 3)))
    pairs = [r for r in phrases.candidates(spark.createDataFrame(rows, "lang string, w1 string, w2 string, w3 string, f bigint"), 2).collect() if not r.w3]
    assert {(r.w1, r.score, r.longer) for r in pairs} == {("a", 1_000_000 * (big - 3) ** 2 // (big * (big + 1)), 10), ("b", 1_000_000 * (big - 3) ** 2 // (big * (big + 1)), 10)}


# whitening ---------------------------------------------------------------

def plain_whitening(vectors):
    x = np.floor(np.array(vectors, float) * 64) + 1_000_000
    centred = x - x.mean(axis=0)
    values, columns = np.linalg.eigh(centred.T @ centred / len(x))
    order = np.argsort(-values)[:32]
    return x, values[order], centred @ columns[:, order] / np.sqrt(values[order]), values.sum()


def test_whitening_matches_numpy(spark):
    rng = np.random.default_rng(3)
    mixed = (rng.normal(size=(400, 40)) @ rng.normal(size=(40, 40)) + 50).astype(np.float32)
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(mixed)]
    bad = [(900, None), (901, []), (902, [None] + [1.0] * 39), (903, [NAN] * 40), (904, [INF] * 40), (905, [1.0, 2.0]), (None, rows[5][1])]
    df = vectors_df(spark, rows + bad).repartition(4)
    model = whitening.fit(df)
    x, values, white, trace = plain_whitening([v for _, v in rows] + [rows[5][1]])
    assert model.n == 401 and np.allclose(model.values, values, rtol=1e-9)
    assert whitening.identity_error(df, model) < 1e-8
    got = whitening.whiten(df, model).collect()
    assert len(got) == 401 * 32 and {r.vec_id for r in got} == {*range(400), None}
    table = {(r.vec_id, r.component): r for r in got}
    n, sums = 401, [int(s) for s in x.sum(axis=0)]
    signs = np.sign([table[0, k + 1].whitened * white[0, k] for k in range(32)])
    for i in range(400):
        assert table[i, 1].deviation == sum((n * int(a) - s) ** 2 for a, s in zip(x[i], sums)) and table[i, 1].n == n
        assert np.allclose([table[i, k + 1].whitened for k in range(32)], signs * white[i], atol=1e-6)
    assert np.allclose([table[None, k + 1].whitened for k in range(32)], signs * white[5], atol=1e-6)
    assert np.allclose([table[0, k + 1].explained for k in range(32)], values / trace, rtol=1e-6)


def test_whitening_is_exact_for_large_values(spark):
    """Entries so large that squares and n times x pass 64 bits."""
    rng = np.random.default_rng(5)
    rows = [(i, [float(c) for c in v]) for i, v in enumerate((rng.normal(size=(50, 3)) * [1e12, 1.0, 1e-2]).astype(np.float32))] + [(99, [1e30, 0.0, 0.0])]
    df = vectors_df(spark, rows)
    model = whitening.fit(df)
    x = [[int(np.floor(np.float64(c) * 64)) + 1_000_000 for c in v] for _, v in rows[:50]]
    sums = [sum(c) for c in zip(*x)]
    n = 50
    exact = [[sum((n * r[i] - sums[i]) * (n * r[j] - sums[j]) for r in x) / n ** 3 for j in range(3)] for i in range(3)]
    assert model.n == n and np.isclose(model.values[0], max(np.linalg.eigvalsh(np.array(exact))), rtol=1e-12)
    deviation = {r.vec_id: r.deviation for r in whitening.whiten(df, model).collect()}
    for (i, _), r in zip(rows, x):
        want = sum((n * a - s) ** 2 for a, s in zip(r, sums))
        assert deviation[i] == (want if want < 1 << 63 else None)
    assert 99 not in deviation and None in deviation.values()


def test_whitening_awkward_tables(spark):
    for rows in ([], [(1, None)], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])]):
        df = vectors_df(spark, rows)
        model = whitening.fit(df)
        assert model is None and whitening.whiten(df, model).count() == 0
    flat = vectors_df(spark, [(i, [float(i), 1.0, 2.0 * i]) for i in range(9)])
    model = whitening.fit(flat)  # one direction only: one component
    assert len(model.values) == 1 and {r.component for r in whitening.whiten(flat, model).collect()} == {1}


def test_whitening_query(spark):
    rows = read_table(spark, SMALL, "embeddings").collect()
    got = queries.op12_embedding_whitening(spark, SMALL).collect()
    x, values, white, trace = plain_whitening([r.embedding for r in rows])
    assert len(got) == 32 * len(rows) and len({r.identity_error for r in got}) == 1 and got[0].identity_error < 1e-4
    by = {(r.vec_id, r.component): r for r in got}
    for r, w in list(zip(rows, white))[::25]:
        assert np.allclose([abs(by[r.vec_id, k + 1].whitened) for k in range(32)], np.abs(w), atol=1e-6)
    assert np.allclose([by[rows[0].vec_id, k + 1].explained for k in range(32)], values / trace, rtol=1e-4)


# top-k search ------------------------------------------------------------

def plain_top(rows, asked, k):
    v = [(n, i, [int(np.floor(np.float64(np.float32(c)) * 256)) for c in x]) for n, (i, x) in enumerate(rows)]
    out = []
    for n, i, q in v:
        if i is None or not asked(i):
            continue
        scored = [(-sum(a * b for a, b in zip(q, x)), j is None, j if j is not None else 0, m) for m, j, x in v if m != n and len(x) == len(q)]
        out += [(i, r + 1, None if none else j, -s) for r, (s, none, j, _) in enumerate(sorted(scored)[:k])]
    return sorted(out, key=str)


@pytest.mark.parametrize("cell, pivots", [(1 << 15, 64), (40, 5), (7, 1)])
def test_top_k_matches_plain_search(spark, cell, pivots):
    rng = np.random.default_rng(4)
    spread = rng.normal(size=(8, 12))
    rows = [(i, [float(c) for c in (spread[i % 8] + rng.normal(size=12) * 0.2).astype(np.float32)]) for i in range(200)]
    rows += [(1000 + i, rows[3][1]) for i in range(30)]  # ties
    rows += [(10, rows[10][1]), (10, rows[11][1]), (None, rows[3][1]), (600, [1.0, 2.0]), (601, [-1.0, 4.0]), (605, [3.0] * 5), (700, [0.0] * 12)]
    bad = [(2000, None), (2005, []), (2010, [None] * 12), (2015, [NAN] * 12), (2020, [INF] * 12)]
    df = vectors_df(spark, rows + bad).repartition(3)
    got = sorted(map(tuple, pivot_search.top_k(df, F.col("vec_id") % 5 == 0, 5, cell=cell, pivots=pivots).collect()), key=str)
    assert got == plain_top(rows, lambda i: i % 5 == 0, 5)


def test_top_k_of_large_values(spark):
    """Scores beyond the whole numbers of doubles, and beyond 64 bits."""
    rng = np.random.default_rng(6)
    rows = [(i, [float(c) for c in (rng.normal(size=3) * 10.0 ** rng.integers(0, 8)).astype(np.float32)]) for i in range(60)]
    got = sorted(map(tuple, pivot_search.top_k(vectors_df(spark, rows), F.col("vec_id") % 2 == 0, 4, cell=16).collect()), key=str)
    want = plain_top(rows, lambda i: i % 2 == 0, 4)
    assert got == sorted([(*r[:3], r[3] if abs(r[3]) < 1 << 63 else None) for r in want], key=str)


def test_top_k_awkward_tables(spark):
    ask = F.col("vec_id") % 50 == 0
    assert pivot_search.top_k(vectors_df(spark, []), ask).count() == 0
    assert pivot_search.top_k(vectors_df(spark, [(50, [1.0])]), ask).count() == 0
    assert sorted(map(tuple, pivot_search.top_k(vectors_df(spark, [(50, [1.0]), (51, [2.0])]), ask).collect())) == [(50, 1, 51, 512 * 256)]


@pytest.mark.parametrize("name", ["op11_phrase_collocation_mining", "op13_exact_top_k_search"])
def test_queries_equal_their_sql(spark, name):
    assert compare(spark, name, SMALL)["status"] == "ok"
