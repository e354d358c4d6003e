"""SimHash near-duplicates: segment-popcount embedding, grid range join, exact check.

A fingerprint of 64 bits is mapped to its bit counts in 32 segments of two
bits. The Manhattan distance of two count vectors is never above the Hamming
distance of the fingerprints, so pairs within the limit also lie within it in
count space. The grid has 8 groups of 4 segments as its axes; vectors within
distance d differ in at most d groups, so they share the cell of at least one
choice of 8 - d groups. Fingerprints meet per (choice, cell), are compared by
Manhattan distance first and exactly (bits) last.

Copies meet in one fingerprint before any join. Inside a cell links are found
by growing a spanning forest (every fingerprint leaves the unvisited rest when
it is reached), so a dense cell emits fewer links than members and never all
of its pairs; cells with many members are cut into blocks and each pair of
blocks is a task row group of its own.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from visitflow.config import cut_lineage
from visitflow.llm.components import connected_components

SHINGLE_WORDS = 4
MAX_DISTANCE = 4
GROUPS = 8  # of 8 bits: four two-bit segments
CELL_BLOCK = 20_000  # fingerprints of a cell that one block holds
LOW = np.uint64(0x5555555555555555)


def simhash(data: bytes, size: int = SHINGLE_WORDS) -> int:
    """Fingerprint of one UTF-8 text: the majority over XXH64 (seed 42) of its
    word shingles, A-Z in lower case; 0 without words."""
    words = data.lower().split()
    if not words:
        return 0
    text = b" ".join(words)
    if len(words) <= size:
        n, hashes = 1, iter((xxhash.xxh64_intdigest(text, 42),))
    else:
        length = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(length + 1) - 1
        n = len(words) - size + 1
        starts = (ends - length)[:n].tolist()
        digest = xxhash.xxh64_intdigest
        hashes = (digest(text[s:e], 42) for s, e in zip(starts, ends[size - 1:].tolist()))
    ones, left = np.zeros(64, np.int64), n
    while left:
        part = np.fromiter(hashes, np.uint64, min(left, 1 << 14))
        left -= len(part)
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 shingle: int = SHINGLE_WORDS, keep_key: bool = False) -> DataFrame:
    """(doc_id, fp) per row of ``docs``; fp is the signed 64-bit fingerprint.
    NULL and empty texts have 0; a NULL id stays NULL. ``keep_key`` adds
    ``key``, a hash and the length of the text."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = np.fromiter((simhash((t.as_py() or "").encode(), shingle) for t in batch.column("text")), np.uint64, batch.num_rows)
            kept = [c for c in batch.schema.names if c != "text"]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(out.view(np.int64))], [*kept, "fp"])

    src = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    if not keep_key:
        return src.mapInArrow(run, "doc_id bigint, fp bigint")
    key = _text_key(F.col("text"))
    return src.select("doc_id", key["h"].alias("h"), key["n"].alias("n"), "text").mapInArrow(
        run, "doc_id bigint, h bigint, n int, fp bigint").select("doc_id", F.struct("h", "n").alias("key"), "fp")


def counts(fp: np.ndarray) -> np.ndarray:
    """Bit counts of the 32 two-bit segments in unary: each segment's bits
    sorted, so that XOR and popcount of two results give the Manhattan distance."""
    high = fp >> np.uint64(1)
    return ((fp | high) & LOW) | ((fp & high & LOW) << np.uint64(1))


def _cells(distance: int):
    """Rows (cell, fp): one for each choice of GROUPS - distance groups."""
    choices = list(combinations(range(GROUPS), max(0, GROUPS - distance)))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            axes = counts(fp)
            for k, choice in enumerate(choices):
                mask = np.uint64(sum(0xFF << (8 * g) for g in choice))
                cell = (axes & mask) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(k * 0xD6E8FEB86659FD93 % (1 << 64))
                cell ^= cell >> np.uint64(29)
                yield pa.RecordBatch.from_arrays([pa.array(cell.view(np.int64)), pa.array(fp.view(np.int64))], ["cell", "fp"])

    return run


def _grow(fp: np.ndarray, distance: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links of a spanning forest over one cell's fingerprints."""
    rest, axes = fp, counts(fp)
    while len(rest):
        frontier, rest, axes = [rest[0]], rest[1:], axes[1:]
        while frontier and len(rest):
            x = frontier.pop()
            near = np.bitwise_count(axes ^ counts(x)) <= distance  # Manhattan: lower bound
            near[near] = np.bitwise_count(rest[near] ^ x) <= distance
            if near.any():
                found = rest[near]
                yield np.full(len(found), x), found
                frontier.extend(found)
                rest, axes = rest[~near], axes[~near]


def _links(distance: int):
    """Links within runs of equal (cell, lo, hi); rows come sorted by them."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[tuple[np.ndarray, np.ndarray]] = []

        def flush(key: np.ndarray, fp: np.ndarray) -> Iterator[pa.RecordBatch]:
            cuts = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]).any(axis=1), True])
            size = np.diff(cuts)
            left, right = [], []
            small = np.flatnonzero((size >= 2) & (size <= 32))
            for shift in range(1, 32):  # small cells, all at once
                runs = small[size[small] > shift]
                if not len(runs):
                    break
                i = np.concatenate([cuts[runs[size[runs] - shift > j]] + j for j in range(32 - shift)])
                a, b = fp[i], fp[i + shift]
                ok = np.bitwise_count(counts(a) ^ counts(b)) <= distance
                ok[ok] = np.bitwise_count(a[ok] ^ b[ok]) <= distance
                left.append(a[ok])
                right.append(b[ok])
            for k in np.flatnonzero(size > 32):
                for a, b in _grow(np.unique(fp[cuts[k]:cuts[k + 1]]), distance):
                    left.append(a)
                    right.append(b)
            if left:
                a, b = np.concatenate(left), np.concatenate(right)
                if len(a):
                    pairs = np.unique(np.stack([a, b], axis=1), axis=0)
                    yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0].copy().view(np.int64)), pa.array(pairs[:, 1].copy().view(np.int64))], ["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            key = np.stack([batch.column(i).to_numpy(zero_copy_only=False) for i in range(3)], axis=1)
            fp = batch.column(3).to_numpy(zero_copy_only=False).view(np.uint64)
            if kept:
                key, fp = np.concatenate([kept[0][0], key]), np.concatenate([kept[0][1], fp])
            last = np.flatnonzero((key != key[-1]).any(axis=1))
            open_from = int(last[-1]) + 1 if len(last) else 0
            if open_from:
                yield from flush(key[:open_from], fp[:open_from])
            kept = [(key[open_from:], fp[open_from:])]
        if kept:
            yield from flush(*kept[0])

    return run


def fingerprint_links(fps: DataFrame, distance: int = MAX_DISTANCE, block: int = CELL_BLOCK) -> DataFrame:
    """Links (a, b) that connect exactly what the pairs of ``fps.fp`` within
    ``distance`` bits connect. ``fps`` holds distinct, stored fingerprints.
    Above GROUPS - 1 bits the grid has no axis left and one cell holds all."""
    cells = fps.select("fp").mapInArrow(_cells(distance), "cell bigint, fp bigint")
    hot = cut_lineage(cells.groupBy("cell").count().where(F.col("count") > block)
                      .select("cell", F.ceil(F.col("count") / block).cast("int").alias("n")), "llm-cells")
    spread = cells.join(hot, "cell", "left").withColumn("n", F.coalesce("n", F.lit(1))) if hot.head(1) \
        else cells.withColumn("n", F.lit(1))
    own = F.pmod(F.xxhash64("fp"), F.col("n")).cast("int")
    spread = spread.withColumn("own", own).select(
        "cell", "fp", "own", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("other")).select(
        "cell", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), "fp")
    spread = spread.repartition("cell", "lo", "hi").sortWithinPartitions("cell", "lo", "hi", "fp")
    return spread.mapInArrow(_links(distance), "a bigint, b bigint").distinct()


def _labels(prints: DataFrame, distance: int) -> DataFrame:
    """(fp, component_id, component) of each fingerprint of the stored
    ``prints``: the smallest doc_id of its group, and the group's own number."""
    fps = cut_lineage(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "llm-fps")
    groups = connected_components(fingerprint_links(fps, distance))
    groups = fps.join(groups.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "first_id", F.coalesce("component", "fp").alias("component"))
    groups = cut_lineage(groups, "llm-groups")
    smallest = cut_lineage(groups.groupBy("component").agg(F.min("first_id").alias("component_id")), "llm-first")
    return cut_lineage(groups.join(smallest, "component").select("fp", "component_id", "component"), "llm-label")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle: int = SHINGLE_WORDS, distance: int = MAX_DISTANCE) -> DataFrame:
    """(doc_id, fp, component_id) for every row of ``docs``: component_id is
    the smallest doc_id reachable over links of at most ``distance`` differing
    bits, itself included.

    Rows with NULL or empty text share fingerprint 0 and link like any other.
    A NULL id keeps its row and never becomes a component_id while a group has
    another; repeated rows each come back; an empty table gives an empty one.
    """
    prints = cut_lineage(fingerprints(docs, id_col, text_col, shingle), "llm-simhash")
    return prints.join(_labels(prints, distance).drop("component"), "fp").select("doc_id", "fp", "component_id")


def _text_key(text: Column) -> Column:
    return F.struct(F.xxhash64(text).alias("h"), F.coalesce(F.octet_length(text), F.lit(-1)).alias("n"))


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               shingle: int = SHINGLE_WORDS, distance: int = MAX_DISTANCE) -> DataFrame:
    """``docs`` with one row of each near-duplicate group: the row with the
    smallest id (a NULL id is behind all others), then the smallest hash of its
    text; of rows that repeat both, one."""
    key = F.struct(F.col(id_col).cast("bigint").alias("id"), _text_key(F.col(text_col).cast("string")).alias("text"))
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    prints = cut_lineage(fingerprints(rows.select("doc_id", "text"), shingle=shingle, keep_key=True), "llm-simhash")
    label = _labels(prints.select("doc_id", "fp"), distance)
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "key")
    # stored, so that the join below has plain shuffles on both sides and a large group's rows can be split
    groups = cut_lineage(prints.join(label, "fp").groupBy("component").agg(F.min(order).alias("kept")), "llm-kept")
    copies = cut_lineage(prints.groupBy("doc_id", "key").agg(F.count(F.lit(1)).alias("n"), F.first("fp").alias("fp")), "llm-keys")
    found = copies.join(label, "fp").join(groups, "component")
    first = (F.col("kept.doc_id").eqNullSafe(F.col("doc_id"))) & (F.col("kept.key") == F.col("key"))
    name = F.struct(F.col("doc_id").alias("id"), F.col("key").alias("text"))
    found = cut_lineage(found.select(name.alias("key"), first.alias("first"), "n"), "llm-dropped")
    # columns of docs stay apart in one struct, so no name can clash
    whole = docs.select(F.struct("*").alias("row"), key.alias("key"))
    dropped = found.where("not first or n > 1").select("key")
    repeated = found.where("first and n > 1").select("key")
    same = lambda a, b: a["key"].eqNullSafe(b["key"])
    single = whole.join(dropped, same(whole, dropped), "left_anti").select("row.*")
    once = whole.join(repeated, same(whole, repeated), "left_semi").dropDuplicates(["key"]).select("row.*")
    return single.unionAll(once)
