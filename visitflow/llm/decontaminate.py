"""Benchmark decontamination by spaced-seed hashing.

A mask of SPAN words hashes the words at its ones and ignores those at its
zeros, so a replaced word leaves some seed intact. The seeds of the benchmark
are joined with those of every position of the documents; each hit fixes an
alignment, which is verified word by word: its longest stretch of at least 80 %
equal words must have MIN_WORDS words, or the whole item if that is shorter. A
replaced word may stand anywhere, also at the stretch's ends. Every stretch of
MIN_WORDS words or more with 80 % equal words holds a seed of one of the masks,
wherever its other words stand (a test goes through all cases). Items of fewer
words have seeds of their own: an item of which 80 % leaves n words to differ is
cut into n + 1 parts, one of which stays whole.

The benchmark is the stated, small side: it is cut into blocks of at most
BLOCK_WORDS words (by its measured size), and each block is sent to the tasks
and held against all documents.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from visitflow.llm.words import BASE, LETTERS, WordHasher, find_words, mix, ragged, slices

MASKS = ("1101111", "11101000011", "1111011")
MIN_WORDS = 13
PARTS = tuple("1" * k for k in range(1, 6))  # of items below MIN_WORDS
MISMATCH = 4  # equal words for each different one
BLOCK_WORDS = 2_000_000
CHECKED_WORDS = 1 << 22  # words of alignments compared at once
FILTER_BITS = 22


@dataclass
class Seeds:
    """One block of the benchmark: word hashes of all items, and for each mask
    the sorted seed hashes with the word position of each."""

    item: np.ndarray
    first: np.ndarray
    words: np.ndarray
    hashes: list[np.ndarray]
    at: list[np.ndarray]
    near: np.ndarray


def _seed_hashes(hashes: np.ndarray, mask: str) -> np.ndarray:
    n = max(0, len(hashes) - len(mask) + 1)
    out = np.zeros(n, np.uint64)
    for j, bit in enumerate(mask):
        if bit == "1":
            out = out * np.uint64(BASE) + hashes[j:j + n]
    return mix(out)


def _places(first: np.ndarray, n: int, span: int) -> np.ndarray:
    """Word positions from which ``span`` words lie in one text."""
    if not n:
        return np.zeros(0, np.int64)
    at = np.arange(n)
    end = np.repeat(first[1:], np.diff(first))
    return at[at + span <= end]


def _part_places(first: np.ndarray, span: int) -> np.ndarray:
    """Word positions of the parts of ``span`` words of items below MIN_WORDS."""
    out = []
    for begin, size in zip(first[:-1].tolist(), np.diff(first).tolist()):
        if size < MIN_WORDS:
            n = size // (MISMATCH + 1) + 1
            cuts = [k * size // n for k in range(n + 1)]
            out += [begin + a for a, b in zip(cuts, cuts[1:]) if b - a == span]
    return np.array(out, np.int64)


def build_seeds(items: list[tuple[int, str]]) -> Seeds:
    """Seeds of (item_id, text) pairs; items of equal words count once, under
    the smallest id. Items of MIN_WORDS words have the seeds of MASKS,
    shorter ones those of their PARTS."""
    items = sorted(items)
    words = find_words(pa.array([t or "" for _, t in items], pa.large_string()), lower=True, bytes_of_words=LETTERS)
    hashes = WordHasher()(words)
    kept, seen = [], set()
    for i in range(len(items)):
        own = hashes[words.first[i]:words.first[i + 1]].tobytes()
        if own and own not in seen:
            seen.add(own)
            kept.append(i)
    size = np.array([words.first[i + 1] - words.first[i] for i in kept], np.int64)
    first = np.r_[0, np.cumsum(size)].astype(np.int64)
    flat = np.concatenate([hashes[words.first[i]:words.first[i + 1]] for i in kept]) if kept else np.zeros(0, np.uint64)
    near = np.zeros(1 << FILTER_BITS, bool)
    sorted_hashes, at = [], []
    for mask in (*MASKS, *PARTS):
        if mask in PARTS:
            places = _part_places(first, len(mask))
        else:
            places = _places(first, len(flat), len(mask))
            places = places[np.repeat(size, size)[places] >= MIN_WORDS]
        h = _seed_hashes(flat, mask)[places] if len(places) else np.zeros(0, np.uint64)
        order = np.argsort(h, kind="stable")
        sorted_hashes.append(h[order])
        at.append(places[order])
        near[(h >> np.uint64(64 - FILTER_BITS)).astype(np.int64)] = True
    return Seeds(np.array([items[i][0] for i in kept], np.int64), first, flat, sorted_hashes, at, near)


def _longest_stretch(equal: np.ndarray, least: int) -> tuple[int, int]:
    """Bounds of the longest stretch with at least 80 % equal words, the first
    of these; different words at its ends are left off while ``least`` words
    stay."""
    total = np.r_[0, np.cumsum(np.where(equal, 1, -MISMATCH))]
    high = np.maximum.accumulate(total[::-1])[::-1]  # the largest sum from here on
    ends = np.searchsorted(-high, -total, side="right") - 1  # the last place whose sum is not below this one's
    s = int(np.argmax(ends - np.arange(len(ends))))
    e = int(ends[s])
    while e - s > least and not equal[e - 1]:
        e -= 1
    while e - s > least and not equal[s]:
        s += 1
    return s, e


def _alignments(words: np.ndarray, lo: np.ndarray, size: np.ndarray, known: np.ndarray, other: np.ndarray,
                least: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(alignment, which of its words are equal) of those with enough equal
    words for a stretch: ``size`` words from ``lo`` on held against those of
    the benchmark from ``other`` on."""
    ends = np.cumsum(size)
    at = 0
    while at < len(size):
        stop = max(at + 1, int(np.searchsorted(ends, ends[at] - size[at] + CHECKED_WORDS, side="right")))
        part = slice(at, stop)
        equal = words[ragged(lo[part], size[part])] == known[ragged(other[part], size[part])]
        total = np.r_[0, np.cumsum(equal)]
        end = np.cumsum(size[part])
        begin = end - size[part]
        enough = (size[part] >= least[part]) & ((MISMATCH + 1) * (total[end] - total[begin]) >= MISMATCH * least[part])
        for k in np.flatnonzero(enough).tolist():
            yield at + k, equal[begin[k]:end[k]]
        at = stop


def overlaps_in(seeds: Seeds, column: pa.Array, hasher: WordHasher) -> list[tuple[int, int, int, int, int]]:
    """(row, item_id, start_word, n_words, n_equal) of verified overlaps: the
    longest of each row and item, ties by the earlier place. An item of one
    word overlaps only a text of that word alone."""
    words = find_words(column, lower=True, bytes_of_words=LETTERS)
    hashes = hasher(words)
    if not len(hashes) or not len(seeds.words):
        return []
    lines = []
    for mask, known, at in zip((*MASKS, *PARTS), seeds.hashes, seeds.at):
        if not len(known):
            continue
        places = _places(words.first, len(hashes), len(mask))
        if not len(places):
            continue
        h = _seed_hashes(hashes, mask)
        maybe = places[seeds.near[(h[places] >> np.uint64(64 - FILTER_BITS)).astype(np.int64)]]
        lo, hi = np.searchsorted(known, h[maybe]), np.searchsorted(known, h[maybe], side="right")
        n = hi - lo
        if n.sum():
            ends = np.cumsum(n)
            source = at[np.arange(ends[-1]) + np.repeat(lo - (ends - n), n)]
            lines.append(np.stack([np.repeat(maybe, n), source], axis=1))
    if not lines:
        return []
    pairs = np.concatenate(lines)
    row = np.searchsorted(words.first, pairs[:, 0], side="right") - 1
    item = np.searchsorted(seeds.first, pairs[:, 1], side="right") - 1
    begins = pairs[:, 0] - (pairs[:, 1] - seeds.first[item])  # where the item's first word would stand
    row, item, begins = np.unique(np.stack([row, item, begins], axis=1), axis=0).T
    n_item = np.diff(seeds.first)[item]
    lo, hi = np.maximum(begins, words.first[row]), np.minimum(begins + n_item, words.first[row + 1])
    least = np.minimum(MIN_WORDS, n_item)
    least[(n_item == 1) & (np.diff(words.first)[row] > 1)] = MIN_WORDS  # more than there is
    best: dict[tuple[int, int], tuple[int, int, int]] = {}
    for k, equal in _alignments(hashes, lo, hi - lo, seeds.words, seeds.first[item] + lo - begins, least):
        s, e = _longest_stretch(equal, int(least[k]))
        if e - s >= least[k]:
            r, i = int(row[k]), int(item[k])
            found = (e - s, -int(lo[k] + s - words.first[r]), int(equal[s:e].sum()))
            best[r, i] = max(best.get((r, i), found), found)
    return [(r, int(seeds.item[i]), -f[1], f[0], f[2]) for (r, i), f in sorted(best.items())]


def _word_text(text_col: str) -> Column:
    """The text's words (letters, digits and all characters beyond ASCII, A-Z in
    lower case) with one space between."""
    low = F.translate(F.col(text_col).cast("string"), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.trim(F.regexp_replace(low, "[^0-9a-z\\x{80}-\\x{10FFFF}]+", " "))


def item_classes(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(item_id, class_id) of every item with words: class_id, under which
    ``overlaps`` reports it, is the smallest id of the items of equal words."""
    items = benchmark.select(F.col(id_col).cast("bigint").alias("item_id"), _word_text(text_col).alias("words")).where(
        "item_id is not null and words <> ''")
    first = items.groupBy("words").agg(F.min("item_id").alias("class_id"))
    return items.join(first, "words").select("item_id", "class_id").distinct()


def benchmark_blocks(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text",
                     block_words: int = BLOCK_WORDS) -> Iterator[Seeds]:
    """The benchmark's seeds in blocks of about ``block_words`` words, one at a
    time on the driver. NULL ids and texts without words are left out. Items of
    equal words are in one block."""
    items = benchmark.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text")).where(
        "id is not null and text is not null")
    n_bytes = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-n_bytes // (4 * block_words)))  # words take four bytes or more with their space
    for k in range(blocks):
        part = items if blocks == 1 else items.where(F.pmod(F.xxhash64(_word_text("text")), F.lit(blocks)) == k)
        yield build_seeds([(r.id, r.text) for r in part.collect()])


def overlaps(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             block_words: int = BLOCK_WORDS) -> DataFrame:
    """(doc_id, item_id, start_word, n_words, n_equal): one row per row of
    ``docs`` and benchmark item that overlap. Words are runs of letters and
    digits, A-Z in lower case. Items below MIN_WORDS words must be there whole,
    80 % of their words equal (below five words: all); an item of one word must
    be the whole text. Items of equal words are one, under the smallest id
    (``item_classes`` has the others). NULL and empty texts and an empty benchmark
    overlap nothing; a NULL doc_id is reported as NULL; repeated rows are each
    reported."""
    src = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    out = None
    for seeds in benchmark_blocks(benchmark, text_col="text", block_words=block_words):
        def run(batches: Iterable[pa.RecordBatch], seeds: Seeds = seeds) -> Iterator[pa.RecordBatch]:
            hasher = WordHasher()
            for batch in slices(batches):
                found = overlaps_in(seeds, batch.column("text"), hasher)
                if found:
                    table = np.array(found, np.int64)
                    ids = batch.column("doc_id").take(pa.array(table[:, 0]))
                    yield pa.RecordBatch.from_arrays([ids, *(pa.array(table[:, k].copy()) for k in range(1, 5))],
                                                     ["doc_id", "item_id", "start_word", "n_words", "n_equal"])

        part = src.mapInArrow(run, "doc_id bigint, item_id bigint, start_word bigint, n_words bigint, n_equal bigint")
        out = part if out is None else out.unionAll(part)
    return out


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text",
                      block_words: int = BLOCK_WORDS) -> DataFrame:
    """``docs`` without the rows that overlap a benchmark item; all other rows
    and all columns stay as they are. One map for each block of the benchmark."""
    for seeds in benchmark_blocks(benchmark, block_words=block_words):
        def run(batches: Iterable[pa.RecordBatch], seeds: Seeds = seeds) -> Iterator[pa.RecordBatch]:
            hasher = WordHasher()
            for batch in slices(batches, text_col):
                keep = np.ones(batch.num_rows, bool)
                keep[[r for r, *_ in overlaps_in(seeds, batch.column(text_col), hasher)]] = False
                yield batch.filter(pa.array(keep))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
