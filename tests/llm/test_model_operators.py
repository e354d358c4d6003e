"""SimHash, toxicity, LM scoring, packing and decontamination against plain Python or held-out rows."""

from __future__ import annotations

import itertools
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from visitflow.config import cut_lineage
from visitflow.llm import brown_lm, components, decontaminate, packing, queries, simhash, toxicity
from visitflow.llm.words import WordHasher, find_words
from visitflow.sources.tables import read_table

from llm_tables import AWKWARD, docs_df, empty_docs

SMALL = "/root/testdata/sf0.001"


def tokens(text):
    return re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())


def test_words_are_the_pattern():
    texts = ["a b", "", " lead", "trail ", "x\x0b\x0cy", "é ß", None, "a", "b", "\x1c\x1d"]
    words = find_words(pa.array(texts))
    got = [[words.raw[s:e].tobytes() for s, e in zip(words.start[a:b], words.end[a:b])] for a, b in zip(words.first[:-1], words.first[1:])]
    assert got == [tokens(t) for t in texts]
    h = WordHasher()(words)
    flat = [w for t in texts for w in tokens(t)]
    assert len(set(h.tolist())) == len(set(flat)) and all((h[i] == h[j]) == (flat[i] == flat[j]) for i in range(len(flat)) for j in range(i))


# SimHash -----------------------------------------------------------------

def plain_simhash(text):
    words = [w.lower() for w in tokens(text)]
    grams = [b" ".join(words[i:i + 4]) for i in range(len(words) - 3)] if len(words) >= 4 else ([b" ".join(words)] if words else [])
    hs = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def plain_groups(fps, distance):
    fps = sorted(set(fps))
    root = {f: f for f in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(fps):
        for b in fps[:i]:
            if (a ^ b).bit_count() <= distance:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {f: find(f) for f in fps}


def test_simhash_groups(spark):
    rows = [(r.doc_id, r.text) for r in read_table(spark, SMALL, "documents").collect()] + AWKWARD
    got = simhash.near_duplicates(docs_df(spark, rows)).collect()
    prints = [(i, plain_simhash(t)) for i, t in rows]
    group = plain_groups([f for _, f in prints], 4)
    first = {}
    for i, f in prints:
        if i is not None:
            first[group[f]] = min(first.get(group[f], i), i)
    want = sorted(((i, f, first.get(group[f])) for i, f in prints), key=str)
    assert sorted(((r.doc_id, r.fp % (1 << 64), r.component_id) for r in got), key=str) == want


@pytest.mark.parametrize("block", [20_000, 40])
def test_links_keep_all_groups(spark, block):
    """Dense and sparse fingerprints; small blocks split every full cell."""
    rnd = random.Random(9)
    fps = {rnd.getrandbits(64) for _ in range(300)}
    for seed in list(fps)[:6]:
        x = seed
        for _ in range(100):
            x ^= sum(1 << rnd.randrange(64) for _ in range(rnd.randint(1, 4)))
            fps.add(x % (1 << 64))
            fps.add((seed ^ (1 << rnd.randrange(64)) ^ (1 << rnd.randrange(64))) % (1 << 64))
    fps |= {0, (1 << 64) - 1, 0b1111, 0b11111}
    df = spark.createDataFrame([(f - (1 << 64) if f >= 1 << 63 else f,) for f in fps], "fp bigint")
    links = [(r.a % (1 << 64), r.b % (1 << 64)) for r in simhash.fingerprint_links(df, 4, block).collect()]
    assert all((a ^ b).bit_count() <= 4 for a, b in links)
    root = {f: f for f in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    assert {f: find(f) for f in fps} == plain_groups(fps, 4)


def test_manhattan_is_a_lower_bound():
    rng = np.random.default_rng(0)
    a, b = rng.integers(0, 1 << 63, 1000, dtype=np.uint64), rng.integers(0, 1 << 63, 1000, dtype=np.uint64)
    assert (np.bitwise_count(simhash.counts(a) ^ simhash.counts(b)) <= np.bitwise_count(a ^ b)).all()


def test_keep_first_keeps_one_row_of_each_group(spark):
    """One id on rows of two texts, rows that repeat a kept row, ids that are
    NULL, and columns named like the operator's own."""
    x, y = (" ".join(f"{c}{k}" for k in range(40)) for c in "xy")
    z = " ".join(f"z{k}" for k in range(40))
    rows = [(2, y), (5, x), (5, y), (7, x), (7, x), (9, z), (9, z), (9, z), (None, z), (None, "only without an id " + x[::-1]), (None, "only without an id " + x[::-1])]
    df = spark.createDataFrame([(i, t, "k", k) for k, (i, t) in enumerate(rows)], "doc_id bigint, text string, key string, _dropped_id int")
    kept = simhash.keep_first(df)
    assert kept.columns == df.columns
    got = sorted(((r.doc_id, r.text) for r in kept.collect()), key=str)
    assert got == sorted([(2, y), (5, x), (9, z), rows[-1]], key=str)


def test_keep_first(spark):
    kept = simhash.keep_first(docs_df(spark))
    assert kept.columns == docs_df(spark).columns
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == [1, 4, 5, 7, 8] and ids.count(None) == 1
    assert simhash.keep_first(empty_docs(spark)).count() == 0


def test_components_chain_and_star(spark):
    links = [(i, i + 1) for i in range(0, 40)] + [(100, j) for j in range(101, 160)] + [(7, 7), (None, 3), (5, 4)]
    got = {r.node: r.component for r in components.connected_components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 160)}}


# toxicity ----------------------------------------------------------------

def test_toxicity_on_held_out_rows(spark):
    d = "/root/testdata/sf0.1"
    docs, labels = read_table(spark, d, "documents"), read_table(spark, d, "labels")
    model = toxicity.fit(docs, labels, sample=800, sample_bytes=4000)
    rows = toxicity.score(docs.join(labels.where(toxicity.remainder("doc_id", 5) == 0), "doc_id"), model, keep=("toxic",)).collect()
    right = sum((r.toxicity >= 0.5) == bool(r.toxic) for r in rows) / len(rows)
    bad = [r.toxicity for r in rows if r.toxic]
    assert right > 0.95 and sum(p >= 0.5 for p in bad) > 0.75 * len(bad) and all(0 <= r.toxicity <= 1 for r in rows)


def test_toxicity_awkward_rows(spark):
    words = ["stupid", "good", "tree", "idiot", "house", "river"]
    rnd = random.Random(0)
    texts = [" ".join(rnd.choices(words[1:3] + words[4:], k=30) + (["idiot stupid"] if i % 2 else [])) for i in range(60)]
    model = toxicity.train(texts, np.arange(60) % 2.0, 0.5)
    rows = toxicity.score(docs_df(spark), model).collect()
    assert len(rows) == len(AWKWARD) and len({r.toxicity for r in rows if r.doc_id in (1, 2, 3)}) == 1
    kept = toxicity.filter_toxic(docs_df(spark, [(1, texts[0]), (2, texts[1])]), model)
    assert [r.doc_id for r in kept.collect()] == [1] and kept.columns == docs_df(spark).columns
    assert toxicity.score(empty_docs(spark), model).count() == 0
    assert toxicity.train([], np.zeros(0), 0.0).p["b"][0] < 0
    labels = spark.createDataFrame([(1, None), (None, 1), (99, 1)], "doc_id bigint, toxic int")
    assert toxicity.fit(docs_df(spark), labels).p["b"][0] < 0


# LM scoring --------------------------------------------------------------

def test_lm_base_scores_and_perplexity(spark):
    d = "/root/testdata/sf0.01"
    docs = read_table(spark, d, "documents")
    rows = queries.op5_lm_scoring(spark, d).collect()
    texts = {r.doc_id: [w.lower() for w in tokens(r.text)] + [b"\n"] for r in docs.collect()}
    c = Counter(w for i, ws in texts.items() if zlib.crc32(str(i).encode()) % 7 != 2 for w in ws)
    n, v = sum(c.values()), len(c)
    assert len(rows) == len(texts)
    for r in rows:
        ws = texts[r.doc_id]
        assert math.isclose(r.base_score, sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ws), rel_tol=1e-9)
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(ws), sum(c[w] > 0 for w in ws), n)
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 7 == 2)
    held = [r for r in rows if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_lm_emissions_sum_to_one(spark):
    rows = [(i, t) for i, t in enumerate(["a b c a", "a b d", "b a", "the cat"])]
    model, counts = brown_lm.fit(docs_df(spark, rows).select("text"))
    assert np.allclose((10 ** model.transition).sum(axis=1), 1)
    # per class: all its words and one unseen word
    hasher, total = WordHasher(), np.zeros(brown_lm.CLASSES)
    words = find_words(pa.array(["a b c d the cat"]))
    cls = model.classes[brown_lm._units_of(model.units, words, hasher(words))]
    seen = {r.word: r.n for r in counts.collect()}
    for w, k in zip(hasher(words).view(np.int64), cls):
        total[k] += (seen[int(w)] + brown_lm.EMISSION_ADD) / 10 ** model.emission_total[k]
    for k in set(cls.tolist()):
        assert math.isclose(total[k] + brown_lm.EMISSION_ADD / 10 ** model.emission_total[k], 1)


def test_lm_frequent_words_have_their_own_class(spark):
    """Every word of OWN_COUNT occurrences is clustered, also past the units."""
    train = read_table(spark, "/root/testdata/sf0.01", "documents").where("text is not null").select("text")
    model, counts = brown_lm.fit(train)
    rows = counts.collect()
    frequent = {r.word: r.ending for r in rows if r.n >= brown_lm.OWN_COUNT}
    units = dict(zip(model.units.hashes.view(np.int64).tolist(), model.units.unit.tolist()))
    assert frequent.keys() <= units.keys() and len(frequent) > 2 * brown_lm.UNIT_WORDS
    by_ending = {}
    for w, e in frequent.items():
        if units[w] >= brown_lm.UNIT_WORDS:
            by_ending.setdefault(e, set()).add(int(model.classes[units[w]]))
    assert sum(len(c) > 1 for c in by_ending.values()) > len(by_ending) / 4
    # each class' emissions and one unseen word sum to one
    total = np.full(brown_lm.CLASSES, brown_lm.EMISSION_ADD)
    for r in rows:
        total[model.classes[units.get(r.word, brown_lm.UNIT_WORDS + r.ending)]] += r.n + brown_lm.EMISSION_ADD
    total[model.classes[model.units.end]] += model.documents + brown_lm.EMISSION_ADD
    assert np.allclose(total, 10 ** model.emission_total)


def test_lm_units_without_a_table_of_frequent_words(spark, monkeypatch):
    """Scores are the same if the highest count alone holds too many words to send."""
    docs = docs_df(spark)
    want = sorted(map(tuple, brown_lm.score(docs, F.lit(False)).collect()), key=str)
    few = brown_lm.most_frequent
    monkeypatch.setattr(brown_lm, "most_frequent", lambda counts: few(counts, most=0))
    got = sorted(map(tuple, brown_lm.score(docs, F.lit(False)).collect()), key=str)
    assert all(a[:5] == b[:5] and np.allclose(a[5:], b[5:]) for a, b in zip(want, got)) and len(want) == len(got)


def test_lm_driver_holds_no_table_of_all_frequent_words(spark, monkeypatch):
    """Past the words that are sent, classes and counts come by joins, and the scores are the same."""
    docs = read_table(spark, "/root/testdata/sf0.01", "documents")
    held_out = F.col("doc_id") % 7 == 2
    want = {r.doc_id: r for r in brown_lm.score(docs, held_out).collect()}
    most = brown_lm.most_frequent
    monkeypatch.setattr(brown_lm, "most_frequent", lambda counts: most(counts, most=1000))
    model, counts = brown_lm.fit(docs.where(~held_out))
    assert len(model.units.hashes) <= brown_lm.UNIT_WORDS + 1000 < counts.where(F.col("n") >= brown_lm.OWN_COUNT).count()
    assert len(model.classes) <= model.units.size + 1000
    for r in brown_lm.score(docs, held_out).collect():
        w = want.pop(r.doc_id)
        assert r[:5] == w[:5] and np.allclose(r[5:], w[5:], rtol=1e-9)
    assert not want


def test_lm_awkward_rows(spark):
    got = brown_lm.score(docs_df(spark), F.col("doc_id") % 2 == 0).collect()
    assert len(got) == len(AWKWARD) and all(math.isfinite(r.score) and r.base_score <= 0 for r in got)
    assert sorted(r.n_tokens for r in got)[:4] == [1, 1, 1, 1] and all(r.held_out for r in got if r.doc_id is None)
    assert brown_lm.score(empty_docs(spark), F.lit(False)).count() == 0
    assert brown_lm.score(docs_df(spark), F.lit(True)).where("n_known > 0 or train_tokens > 0").count() == 0


def test_exchange_finds_the_classes():
    """Two kinds of units that only follow each other end in two classes."""
    n = 20
    b = np.zeros((n + 1, n + 1))
    b[:10, 10:20] = b[10:20, :10] = 5
    of = brown_lm.exchange(b, classes=3)
    assert len(set(of[:10])) == len(set(of[10:20])) == 1 and of[0] != of[10] and of[n] == 0


# packing -----------------------------------------------------------------

def test_tokens_equal_the_reference_tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rnd = random.Random(1)
    pool = ["a", "B", "é", "ß", "漢", "\U0001F600", " ", "  ", "\n", "\t", "'s", "'ll", "12", "٣", ".", "--", " ", "​", "\x1c", "<|endoftext|>", "ǅ", "the", "\r\n"]
    texts = ["".join(rnd.choices(pool, k=rnd.randint(0, 40))) for _ in range(3000)]
    own = packing.encoder(packing.tokenizer_path(), packing.tokenizer_path(packing.SAME_TOKENIZER))
    assert own("@ <|endoftext|> x") == t.encode("@ <|endoftext|> x", add_special_tokens=False).ids and 50256 in own("@ <|endoftext|> x")
    assert [own(x) for x in texts] == [t.encode(x, add_special_tokens=False).ids for x in texts]


def test_tokens_of_very_long_white_space():
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    own = packing.encoder(packing.tokenizer_path(), packing.tokenizer_path(packing.SAME_TOKENIZER))
    n = packing.LONG_SPACE
    for text in (" " * (n - 1) + "a b", "x" + " \n" * n + "y <|endoftext|>", "\n" * 1_200_000, "a" * n + "\t" * 1_200_000 + "b"):
        assert own(text) == t.encode(text, add_special_tokens=False).ids


def check_packing(pieces, packed):
    key = lambda r: str((r.doc_id, r.piece, r.start, r.length, r.ids_crc32))
    assert sorted(map(key, pieces)) == sorted(map(key, packed))
    by = {}
    for r in packed:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= packing.CAPACITY
    return len(by)


def test_packing_places_every_piece(spark):
    pieces = packing.token_pieces(docs_df(spark))
    rows = pieces.collect()
    assert sum(r.length == 1 for r in rows) == 3 and sum(r.doc_id == 7 for r in rows) > 10
    for doc in (4, 7):
        own = sorted((r.start, r.length) for r in rows if r.doc_id == doc)
        assert own[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(own, own[1:])) and {n for _, n in own[1:]} <= {1024}
    check_packing(rows, packing.pack(pieces).collect())
    assert packing.pack(packing.token_pieces(empty_docs(spark))).count() == 0


def test_packing_query_rows(spark):
    """The query's rows by the tokenizer itself, and their packing."""
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    docs = read_table(spark, "/root/testdata/sf0.001", "documents").collect()
    got = queries.op6_best_fit_packing(spark, "/root/testdata/sf0.001").collect()
    want = set()
    for d in docs:
        ids = [*t.encode(d.text or "", add_special_tokens=False).ids, 2]
        head = len(ids) % 1024 if len(ids) > 1024 else 0
        cuts = [0, *range(head, len(ids), 1024)] if head else [*range(0, len(ids), 1024)]
        for k, (a, b) in enumerate(zip(cuts, [*cuts[1:], len(ids)])):
            want.add((d.doc_id, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())))
    assert {(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got} == want and len(got) == len(want)
    check_packing(got, got)


def test_packing_spreads_equal_rows(spark):
    rows = spark.createDataFrame([(None, 0, 0, 300, 5)] * 40_000, packing.PIECES).repartition(4)
    parts = packing._packed(cut_lineage(rows, "t"), 8, 0, 1024).groupBy("part").count().collect()
    assert max(r["count"] for r in parts) < 2 * 40_000 / 8


def test_packing_partitions_exchange(spark):
    rnd = random.Random(8)
    lengths = [rnd.randint(1, 700) for _ in range(4000)]
    pieces = spark.createDataFrame([(i, 0, 0, n, i) for i, n in enumerate(lengths)], packing.PIECES)
    bins = check_packing(pieces.collect(), packing.pack(pieces, partition_pieces=500).collect())
    bound = packing.lower_bound(np.array(lengths))
    assert bound <= bins <= 1.01 * bound + 2


def test_bounds_never_exceed_the_optimum():
    rnd = random.Random(2)
    for _ in range(300):  # cut full bins apart: the optimum is at most their number
        bins, lengths = rnd.randint(1, 8), []
        for _ in range(bins):
            cuts = sorted(rnd.sample(range(1, 1024), rnd.randint(0, 4)))
            lengths += [b - a for a, b in zip([0, *cuts], [*cuts, 1024])]
        assert packing.lower_bound(np.array(lengths)) <= bins
        assert packing.best_fit_decreasing(np.array(lengths))[2] >= bins
    assert packing.lower_bound(np.array([600] * 5)) == 5


# decontamination ---------------------------------------------------------

def test_equal_items_are_one_class_for_any_blocks(spark):
    rnd = random.Random(2)
    items = [(k, " ".join(f"w{rnd.randint(0, 500)}" for _ in range(20))) for k in range(8)]
    same = items[2][1]
    bench = spark.createDataFrame([*items, (20, same.upper() + "!"), (21, same.replace(" ", " - ")), (22, None)], "item_id bigint, text string")
    docs = spark.createDataFrame([(1, same), (2, items[5][1])], "doc_id bigint, text string")
    for block in (2_000_000, 60, 20, 5):
        assert sorted((r.doc_id, r.item_id) for r in decontaminate.overlaps(docs, bench, block_words=block).collect()) == [(1, 2), (2, 5)], block
    classes = {r.item_id: r.class_id for r in decontaminate.item_classes(bench).collect()}
    assert classes == {**{k: k for k in range(8)}, 20: 2, 21: 2}


def test_overlaps_with_replaced_words(spark):
    rnd = random.Random(6)
    items = [(k, " ".join(f"w{rnd.randint(0, 5000)}" for _ in range(rnd.randint(16, 50)))) for k in range(30)]
    docs, want = [], set()
    for i in range(200):
        words = [f"v{rnd.randint(0, 5000)}" for _ in range(rnd.randint(0, 80))]
        if i % 2:
            k, passage = rnd.choice(items)
            passage = passage.upper().split()
            for j in range(5, len(passage), 9):  # every ninth word differs
                passage[j] = "other"
            at = rnd.randint(0, len(words))
            words[at:at] = passage
            want.add((i, k))
        docs.append((i, " ".join(words)))
    bench = spark.createDataFrame([*items, (99, None), (None, items[0][1]), (98, "")], "item_id bigint, text string")
    df = docs_df(spark, docs)
    got = decontaminate.overlaps(df, bench).collect()
    assert {(r.doc_id, r.item_id) for r in got} == want and all(r.n_equal >= 0.8 * r.n_words for r in got)
    blocks = decontaminate.overlaps(df, bench, block_words=100).collect()
    assert sorted(map(tuple, blocks)) == sorted(map(tuple, got))
    kept = decontaminate.drop_contaminated(df, bench, block_words=300)
    assert kept.columns == df.columns and {r.doc_id for r in kept.collect()} == set(range(0, 200, 2))


def overlapping(bench, texts):
    """(text, item) pairs that overlap, without Spark."""
    return {(r, i) for r, i, *_ in decontaminate.overlaps_in(decontaminate.build_seeds(bench), pa.array(texts, pa.string()), WordHasher())}


@pytest.mark.parametrize("size", range(13, 21))
def test_overlaps_with_words_replaced_anywhere(size):
    """Every choice of one, two or three replaced words that leaves 80 %, and
    the most that 80 % allow at random; one more word is not found."""
    rnd = random.Random(size)
    item = [f"w{k}" for k in range(size)]
    allowed = size // 5
    places = [c for n in range(min(allowed, 3) + 1) for c in itertools.combinations(range(size), n)]
    places += [rnd.sample(range(size), allowed) for _ in range(300)]

    def text(replaced):
        return " ".join(["before", *("other" if k in replaced else w for k, w in enumerate(item)), "after"])

    assert overlapping([(1, " ".join(item))], [text(c) for c in places]) == {(k, 1) for k in range(len(places))}
    if size < 16:  # no part of 13 words has 80 %
        spread = [c for c in itertools.combinations(range(size), 3 if size < 15 else 4)
                  if all(5 * sum(s <= k < s + n for k in c) > n for n in range(13, size + 1) for s in range(size - n + 1))]
        assert spread and overlapping([(1, " ".join(item))], [text(c) for c in spread]) == set()


@pytest.mark.parametrize("size", range(2, 13))
def test_short_items_are_found_whole(size):
    """Items below 13 words: every choice of replaced words that leaves 80 %
    is found, one more is not, nor is a part of the item."""
    item = [f"w{k}" for k in range(size)]
    n = size // 5

    def text(replaced):
        return " ".join(["before", *("other" if k in replaced else w for k, w in enumerate(item)), "after"])

    found = [text(c) for m in range(n + 1) for c in itertools.combinations(range(size), m)]
    lost = [text(c) for c in itertools.combinations(range(size), n + 1)] + [" ".join(item[1:]), " ".join(item[:-1])]
    bench = [(1, " ".join(item)), (2, " ".join(f"u{k}" for k in range(30)))]
    assert overlapping(bench, found + lost) == {(k, 1) for k in range(len(found))}


def test_items_of_one_word_are_whole_texts(spark):
    assert overlapping([(1, "one")], ["one", "One!", "", "one two", "two", "one one", None]) == {(0, 1), (1, 1)}
    bench = spark.createDataFrame([(1, "one"), (2, "same text in two rows of one id"), (3, "two rows"), (4, "漢字 \U0001F600 END")], "item_id bigint, text string")
    assert sorted((r.doc_id, r.item_id) for r in decontaminate.overlaps(docs_df(spark), bench).collect()) == [
        (4, 1), (5, 2), (5, 2), (5, 3), (5, 3), (6, 2), (6, 3), (8, 4)]


@pytest.mark.parametrize("size, n", [(13, 2), (15, 3), (20, 4), (25, 5)])
def test_masks_leave_no_stretch_out(size, n):
    """Longer stretches, or fewer replaced words, hold one of these."""
    seeds = [sum(1 << s + k for k, bit in enumerate(m) if bit == "1") for m in decontaminate.MASKS for s in range(size - len(m) + 1)]
    for c in itertools.combinations(range(size), n):
        replaced = sum(1 << k for k in c)
        shorter = any(5 * (replaced >> s & (1 << w) - 1).bit_count() <= w for w in range(13, size) for s in range(size - w + 1))
        assert shorter or any(not seed & replaced for seed in seeds), c


def test_overlaps_on_table(spark):
    """Whole items in a document are found, and no document without one."""
    docs, items = read_table(spark, "/root/testdata/sf0.01", "documents").collect(), read_table(spark, "/root/testdata/sf0.01", "benchmark").collect()
    norm = lambda t: " ".join(re.findall(r"[a-z0-9\u0080-\U0010ffff]+", re.sub("[A-Z]", lambda m: m[0].lower(), t)))
    texts = [(d.doc_id, f" {norm(d.text)} ") for d in docs]
    want = {i for i, t in texts if any(f" {norm(b.text)} " in t for b in items)}
    assert {r.doc_id for r in queries.op9_benchmark_decontamination(spark, "/root/testdata/sf0.01").collect()} == want and want


def test_overlaps_awkward_rows(spark):
    bench = spark.createDataFrame([(1, "one"), (2, "same text in two rows of one id")], "item_id bigint, text string")
    assert sorted((r.doc_id, r.item_id) for r in decontaminate.overlaps(docs_df(spark), bench).collect()) in (
        [(5, 2), (5, 2), (6, 2)], [(4, 1), (5, 2), (5, 2), (6, 2)])
    assert decontaminate.overlaps(docs_df(spark), bench.where("false")).count() == 0
    assert decontaminate.drop_contaminated(empty_docs(spark), bench).count() == 0
