"""Toxicity: a bidirectional gated recurrent network with attention pooling.

Each word enters as two vectors: a word embedding (known words of the training
sample) and a character embedding (4-grams of the word's bytes, hashed into
buckets and max-pooled). Two GRUs read a window of words in both directions,
attention pools their states and a linear layer gives the window's logit. A
document is as toxic as its most toxic window; windows of WINDOW words overlap
by half and cover the whole text.

The network is trained in numpy on the driver, from a bounded sample of
labelled rows (SAMPLE rows of each label at most, texts of at most SAMPLE_BYTES
bytes; both are parameters, the rows are those with the smallest id hash).
Scoring is one map over all rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from visitflow.config import cut_lineage
from visitflow.llm.words import LETTERS, WordHasher, Words, find_words, mix, ragged, row_of_word, slices

SAMPLE = 2500
SAMPLE_BYTES = 6000
VOCABULARY = 20_000  # embeddings of words; further words have the unknown word's
GRAM_BUCKETS = 1 << 15
WORD_DIM, CHAR_DIM, HIDDEN, ATTENTION = 8, 4, 8, 8
WINDOW, STRIDE = 32, 16
EPOCHS, BATCH, RATE = 6, 128, 0.01
LEAST_STEPS = 200  # small samples take more epochs
DOUBT = 1.5
EMBEDDING_RATE = 0.1  # of RATE: one text alone moves its rare words little
F32 = np.float32


@dataclass
class Model:
    """Weights; ``known`` holds the sorted hashes of the known words."""

    known: np.ndarray
    p: dict[str, np.ndarray]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 + 0.5 * np.tanh(0.5 * x)


def _grams(words: Words, pick: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the byte 4-grams of the picked words (with a start mark and
    zeros behind the end), and where each word's begin."""
    start, length = words.start[pick], words.end[pick] - words.start[pick]
    room = length + 4
    at = ragged(np.zeros(len(pick), np.int64), room)
    source = np.repeat(start, room) + at - 1
    inside = (at > 0) & (at <= np.repeat(length, room))
    padded = np.where(inside, words.raw[np.clip(source, 0, max(0, len(words.raw) - 1))], 0).astype(np.uint64)
    padded[at == 0] = 94
    code = padded.copy()
    for j in range(1, 4):
        code[:-j] |= padded[j:] << np.uint64(8 * j)
    ends = np.cumsum(room)
    gram = code[ragged(ends - room, length + 1)]
    return (mix(gram) % np.uint64(GRAM_BUCKETS)).astype(np.int32), np.cumsum(length + 1) - (length + 1)


def _windows(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """(row, first word) of every window: each row has at least one."""
    n = np.diff(words.first)
    count = np.maximum(1, -(-(n - WINDOW) // STRIDE) + 1)
    row = np.repeat(np.arange(len(n)), count)
    return row, words.first[row] + STRIDE * ragged(np.zeros(len(n), np.int64), count)


def _ids(words: Words, index: np.ndarray, row: np.ndarray, start: np.ndarray) -> np.ndarray:
    """(WINDOW, windows): each place's word index, 0 behind the row's end."""
    at = start + np.arange(WINDOW)[:, None]
    inside = at < words.first[row + 1]
    if not len(index):
        return np.zeros(at.shape, np.int64)
    return np.where(inside, index[np.minimum(at, len(index) - 1)] + 1, 0)


def _gru(x: np.ndarray, u: np.ndarray, keep: list | None = None) -> np.ndarray:
    out = np.empty((*x.shape[:2], HIDDEN), F32)
    h = np.zeros((x.shape[1], HIDDEN), F32)
    for t in range(len(x)):
        g = h @ u
        zr = _sigmoid(x[t, :, :2 * HIDDEN] + g[:, :2 * HIDDEN])
        z, r = zr[:, :HIDDEN], zr[:, HIDDEN:]
        n = np.tanh(x[t, :, 2 * HIDDEN:] + r * g[:, 2 * HIDDEN:])
        if keep is not None:
            keep.append((h, z, r, n, g[:, 2 * HIDDEN:]))
        h = n + z * (h - n)
        out[t] = h
    return out


def _gru_back(keep: list, u: np.ndarray, d_out: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    dx = np.empty((*d_out.shape[:2], 3 * HIDDEN), F32)
    du, dh = np.zeros_like(u), np.zeros(d_out.shape[1:], F32)
    for t in range(len(keep) - 1, -1, -1):
        h, z, r, n, gn = keep[t]
        dh = dh + d_out[t]
        dn = dh * (1 - z) * (1 - n * n)
        dz = dh * (h - n) * z * (1 - z)
        dr = dn * gn * r * (1 - r)
        dx[t] = np.concatenate([dz, dr, dn], axis=1)
        dg = np.concatenate([dz, dr, dn * r], axis=1)
        du += h.T @ dg
        dh = dh * z + dg @ u.T
    return dx, du


def _forward(p: dict, ids: np.ndarray, vectors: np.ndarray, keep: dict | None = None) -> np.ndarray:
    """Logits of windows; vectors[i] is the input of word i, row 0 the padding."""
    fore, back = vectors @ p["wf"] + p["bf"], vectors @ p["wb"] + p["bb"]
    kf, kb = ([], []) if keep is not None else (None, None)
    hf = _gru(fore[ids], p["uf"], kf)
    hb = _gru(back[ids[::-1]], p["ub"], kb)[::-1]
    h = np.concatenate([hf, hb], axis=2)
    q = np.tanh(h @ p["wa"] + p["ba"])
    e = q @ p["u"]
    e = np.where(ids > 0, e, F32(-30))
    a = np.exp(e - e.max(axis=0))
    a /= a.sum(axis=0)
    c = np.einsum("tb,tbh->bh", a, h)
    if keep is not None:
        keep |= {"kf": kf, "kb": kb, "h": h, "q": q, "a": a, "c": c}
    return c @ p["v"] + p["b"]


def _word_vectors(p: dict, known: np.ndarray, gram: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Inputs of distinct words behind a row of zeros for padding; the pooled
    character part also by itself."""
    pooled = np.maximum.reduceat(p["chars"][gram], first, axis=0) if len(first) else np.zeros((0, CHAR_DIM), F32)
    inputs = np.concatenate([p["words"][known], pooled], axis=1)
    return np.concatenate([np.zeros((1, WORD_DIM + CHAR_DIM), F32), inputs]), pooled


def _lookup(known: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Row of each word's embedding; 0 is the unknown word."""
    if not len(known):
        return np.zeros(len(hashes), np.int64)
    at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
    return np.where(known[at] == hashes, at + 1, 0)


def score_texts(model: Model, column: pa.Array, hasher: WordHasher, chunk: int = 4096) -> np.ndarray:
    """Probability that each text is toxic: that of its most toxic window."""
    words = find_words(column, lower=True, bytes_of_words=LETTERS)
    distinct, sample, index = np.unique(hasher(words), return_index=True, return_inverse=True)
    vectors, _ = _word_vectors(model.p, _lookup(model.known, distinct), *_grams(words, sample))
    row, start = _windows(words)
    logit = np.empty(len(row), F32)
    for i in range(0, len(row), chunk):
        logit[i:i + chunk] = _forward(model.p, _ids(words, index, row[i:i + chunk], start[i:i + chunk]), vectors)
    out = np.full(len(column), -np.inf, F32)
    np.maximum.at(out, row, logit)
    return np.round(_sigmoid(out.astype(np.float64)), 6)  # matrix products differ in the last bits by batch


def _log_odds(parts: Iterable[tuple[np.ndarray, np.ndarray]], size: int, toxic: np.ndarray) -> np.ndarray:
    """Smoothed log odds of toxic rows among the rows that have each feature,
    from (row, feature) arrays, less DOUBT standard errors (0 within them): a
    feature of few rows says nothing, whatever its rows are. No row is in two
    parts."""
    bad, seen = np.zeros(size), np.zeros(size)
    for rows, features in parts:
        pairs = np.unique(rows.astype(np.int64) * size + features)
        row, feature = pairs // size, pairs % size
        bad += np.bincount(feature, toxic[row], size)
        seen += np.bincount(feature, minlength=size)
    prior = toxic.mean()
    bad, good = bad + 4 * prior, seen - bad + 4 * (1 - prior)
    odds = np.log(bad / good) - np.log(prior / (1 - prior))
    return (np.sign(odds) * np.maximum(0, np.abs(odds) - DOUBT * np.sqrt(1 / bad + 1 / good))).astype(F32)


def train(texts: list[str], toxic: np.ndarray, prior: float, seed: int = 7) -> Model:
    """Train on labelled texts. Each epoch scores all windows, then learns from
    each text's most toxic window and, for clean texts, one more at random.
    ``prior`` is the share of toxic rows outside the sample; the last bias
    moves from the sample's share to it. One label alone gives a constant."""
    toxic = np.asarray(toxic, np.float64)
    rng = np.random.default_rng(seed)
    p = {"words": np.zeros((1, WORD_DIM), F32), "chars": np.zeros((GRAM_BUCKETS, CHAR_DIM), F32)}
    size = WORD_DIM + CHAR_DIM
    for side in "fb":
        p |= {"w" + side: rng.normal(0, size ** -0.5, (size, 3 * HIDDEN)).astype(F32), "b" + side: np.zeros(3 * HIDDEN, F32),
              "u" + side: rng.normal(0, HIDDEN ** -0.5, (HIDDEN, 3 * HIDDEN)).astype(F32)}
    p |= {"wa": rng.normal(0, 0.3, (2 * HIDDEN, ATTENTION)).astype(F32), "ba": np.zeros(ATTENTION, F32),
          "u": rng.normal(0, 0.3, ATTENTION).astype(F32), "v": rng.normal(0, 0.3, 2 * HIDDEN).astype(F32), "b": np.zeros(1, F32)}
    share = toxic.mean() if len(toxic) else 0.0
    if share in (0.0, 1.0):
        p["v"][:] = 0
        p["b"][:] = 4 if share else -4
        return Model(np.zeros(0, np.uint64), p)

    words = find_words(pa.array(texts, pa.large_string()), lower=True, bytes_of_words=LETTERS)
    hashes = WordHasher()(words)
    distinct, sample, index, seen = np.unique(hashes, return_index=True, return_inverse=True, return_counts=True)
    known = np.sort(distinct[np.argsort(-seen, kind="stable")[:VOCABULARY]][np.sort(-seen, kind="stable")[:VOCABULARY] <= -2])
    gram, gram_first = _grams(words, sample)
    gram_count = np.diff(np.r_[gram_first, len(gram)])
    entry = _lookup(known, distinct)
    of_word = row_of_word(words)
    cuts = words.first[np.r_[0:len(texts):100, len(texts)]]
    parts = [slice(a, b) for a, b in zip(cuts[:-1], cuts[1:])]
    p["words"] = rng.normal(0, 0.05, (len(known) + 1, WORD_DIM)).astype(F32)
    p["words"][:, 0] = _log_odds(((of_word[k], entry[index[k]]) for k in parts), len(known) + 1, toxic) / 3
    p["chars"] = rng.normal(0, 0.05, (GRAM_BUCKETS, CHAR_DIM)).astype(F32)
    p["chars"][:, 0] = _log_odds(((np.repeat(of_word[k], gram_count[index[k]]), gram[ragged(gram_first[index[k]], gram_count[index[k]])])
                                  for k in parts), GRAM_BUCKETS, toxic) / 3
    p["words"][0] = 0

    row, start = _windows(words)
    begins = np.searchsorted(row, np.arange(len(texts) + 1))
    moments = {k: [np.zeros_like(v), np.zeros_like(v)] for k, v in p.items()}
    step = epoch = 0
    while step < LEAST_STEPS or epoch < EPOCHS:
        epoch += 1
        vectors, _ = _word_vectors(p, entry, gram, gram_first)
        logit = np.concatenate([_forward(p, _ids(words, index, row[i:i + 4096], start[i:i + 4096]), vectors)
                                for i in range(0, len(row), 4096)])
        top = begins[:-1] + np.array([np.argmax(logit[a:b]) for a, b in zip(begins[:-1], begins[1:])])
        clean = np.flatnonzero(toxic == 0)
        more = begins[clean] + (rng.random(len(clean)) * (begins[clean + 1] - begins[clean])).astype(np.int64)
        chosen = rng.permutation(np.concatenate([top, more]))
        for i in range(0, len(chosen), BATCH):
            part = chosen[i:i + BATCH]
            ids = _ids(words, index, row[part], start[part])
            used, ids = np.unique(np.r_[0, ids.ravel()], return_inverse=True)
            ids, used = ids[1:].reshape(WINDOW, len(part)), used[1:] - 1
            own = gram[ragged(gram_first[used], gram_count[used])]
            first = np.cumsum(gram_count[used]) - gram_count[used]
            inputs, pooled = _word_vectors(p, entry[used], own, first)
            kept: dict = {}
            out = _forward(p, ids, inputs, kept)
            d = ((_sigmoid(out) - toxic[row[part]]) / len(part)).astype(F32)
            h, q, a, c = kept["h"], kept["q"], kept["a"], kept["c"]
            g = {"v": c.T @ d, "b": d.sum(keepdims=True)}
            dc = d[:, None] * p["v"]
            da = np.einsum("bh,tbh->tb", dc, h)
            de = a * (da - (a * da).sum(axis=0)) * (ids > 0)
            dq = de[..., None] * p["u"] * (1 - q * q)
            g |= {"u": np.einsum("tb,tbk->k", de, q), "wa": np.einsum("tbh,tbk->hk", h, dq), "ba": dq.sum(axis=(0, 1))}
            dh = a[..., None] * dc + dq @ p["wa"].T
            dxf, g["uf"] = _gru_back(kept["kf"], p["uf"], dh[..., :HIDDEN])
            dxb, g["ub"] = _gru_back(kept["kb"], p["ub"], dh[::-1, :, HIDDEN:])
            d_in = np.zeros_like(inputs)
            for side, dx, order in (("f", dxf, ids), ("b", dxb, ids[::-1])):
                by_word = np.zeros((len(inputs), 3 * HIDDEN), F32)
                np.add.at(by_word, order.ravel(), dx.reshape(-1, 3 * HIDDEN))
                g |= {"w" + side: inputs.T @ by_word, "b" + side: by_word.sum(axis=0)}
                d_in += by_word @ p["w" + side].T
            d_in = d_in[1:]
            g["words"], g["chars"] = np.zeros_like(p["words"]), np.zeros_like(p["chars"])
            np.add.at(g["words"], entry[used], d_in[:, :WORD_DIM])
            g["words"][0] = 0
            of = np.repeat(np.arange(len(used)), gram_count[used])
            np.add.at(g["chars"], own, d_in[of, WORD_DIM:] * (p["chars"][own] == pooled[of]))
            step += 1
            for k, grad in g.items():  # Adam
                m, s = moments[k]
                m *= 0.9
                m += 0.1 * grad
                s *= 0.999
                s += 0.001 * grad * grad
                rate = RATE * (EMBEDDING_RATE if k in ("words", "chars") else 1)
                p[k] -= (rate * np.sqrt(1 - 0.999 ** step) / (1 - 0.9 ** step) * m / (np.sqrt(s) + 1e-7)).astype(F32)
    if 0 < prior < 1:
        p["b"] = p["b"] + F32(np.log(prior / (1 - prior)) - np.log(share / (1 - share)))
    return Model(known, p)


def remainder(id_col: str | Column, divisor: int) -> Column:
    """crc32 of the id as text, modulo ``divisor``."""
    return F.pmod(F.crc32(F.col(id_col).cast("string") if isinstance(id_col, str) else id_col.cast("string")), F.lit(divisor))


def fit(docs: DataFrame, labels: DataFrame, folds: int = 5, held_out: int = 0, sample: int = SAMPLE,
        sample_bytes: int = SAMPLE_BYTES) -> Model:
    """Train from ``labels`` (doc_id, toxic) and ``docs`` (doc_id, text).

    Rows whose crc32(doc_id) modulo ``folds`` is ``held_out`` teach nothing,
    nor do NULL ids, NULL labels and labels without a document. Of each label
    ``sample`` documents are taken, those of at most ``sample_bytes`` by the
    smallest id hash and, only where these are too few, longer ones, the
    shortest first, while all of them have ``sample * sample_bytes`` bytes
    at most (one is always taken). That is the bound on what reaches the
    driver; every text taken is whole."""
    usable = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).where(
        F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & (remainder("doc_id", folds) != held_out))
    share = usable.agg(F.avg("toxic").alias("p")).first().p
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")).where("text is not null")
    size = F.octet_length("text")
    sizes = texts.select("doc_id", size.alias("bytes")).join(usable, "doc_id").groupBy("doc_id").agg(
        F.min("bytes").alias("bytes"), F.max("toxic").alias("toxic"))
    order = [F.greatest("bytes", F.lit(sample_bytes)), F.xxhash64("doc_id"), F.col("doc_id")]
    picked = cut_lineage(sizes.where("toxic = 1").orderBy(*order).limit(sample).unionAll(
        sizes.where("toxic = 0").orderBy(*order).limit(sample)), "llm-sample")
    so_far = Window.partitionBy("toxic").orderBy(*order)  # 2 * sample rows
    picked = picked.withColumn("before", F.sum("bytes").over(so_far)).withColumn("at", F.row_number().over(so_far)).where(
        (F.col("at") == 1) | (F.col("before") <= sample * sample_bytes)).select("doc_id", "bytes", "toxic")
    # broadcast: 2 * sample rows of three numbers
    rows = texts.withColumn("bytes", size).join(F.broadcast(picked), ["doc_id", "bytes"]).groupBy("doc_id").agg(
        F.min("text").alias("text"), F.max("toxic").alias("toxic")).collect()
    rows.sort(key=lambda r: r.doc_id)
    return train([r.text for r in rows], np.array([r.toxic for r in rows], float), share or 0.0)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per row of ``docs``: id, the columns in ``keep``, and
    ``toxicity`` from 0 to 1. NULL and empty texts have the score of a window
    without words; every text is read whole."""
    src = docs.select(F.col(id_col), *[F.col(c) for c in keep if c != id_col], F.col(text_col).cast("string").alias("_text"))
    out = src.drop("_text").withColumn("toxicity", F.lit(0.0))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher()
        for batch in slices(batches, "_text"):
            p = score_texts(model, batch.column("_text"), hasher)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(p)], [*batch.schema.names[:-1], "toxicity"])

    return src.mapInArrow(run, out.schema)


def filter_toxic(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """``docs`` without the rows whose toxicity is ``threshold`` or more; all
    columns and all other rows stay as they are."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher()
        for batch in slices(batches, text_col):
            yield batch.filter(pa.array(score_texts(model, batch.column(text_col), hasher) < threshold))

    return docs.mapInArrow(run, docs.schema)
