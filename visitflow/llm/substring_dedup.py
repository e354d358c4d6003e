"""Substring dedup by seed and extend.

Seeds are winnowed anchors: of the GRAM-word sequences in each window of
WINDOW words the one with the smallest hash. Equal windows choose the same
anchor at the same place, so documents that share a window meet on its anchor.
At an anchor every choosing window is the seed extended both ways to the
threshold length; it is a repeat if a document with a smaller id has the same
extended words. Adjacent and overlapping repeats merge into maximal ones.

Anchor rows are ordered by (anchor, id) over all partitions by row count, so
an anchor with a third of all rows is spread over many tasks. Inside a
partition rows come by ascending id and each window is compared with those
seen before, never in pairs. Anchors that may go on in a neighbour partition
(its first and last) pass on each window of the first document that has it;
these are compared across partitions afterwards.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from visitflow.config import cut_lineage
from visitflow.llm.words import WordHasher, find_words, gram_hashes, row_of_word, slices, text_buffer

WINDOW = 13
GRAM = 4
HASH_BYTES = 5  # of a window, beside the 8 of its anchor: 104 bits identify it
FOUND = "kind int, anchor bigint, window bigint, doc_id bigint, place bigint, n int, places array<bigint>"


def _anchor_rows(window: int, gram: int):
    """Rows (anchor, doc_id, place, windows): place is the text's CRC-32 in the
    high half and the first choosing window's word index in the low one."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher()
        for batch in slices(batches):
            words = find_words(batch.column("text"))
            n = len(words.start) - window + 1
            if n <= 0:
                continue
            hashes = hasher(words)
            grams, wins = gram_hashes(hashes, gram), gram_hashes(hashes, window)
            best, off = grams[:n].copy(), np.zeros(n, np.int64)
            for j in range(1, window - gram + 1):
                other = grams[j:j + n]
                off[other < best] = j
                np.minimum(best, other, out=best)
            row = row_of_word(words)
            start = np.flatnonzero(row[:n] == row[window - 1:])
            if not len(start):
                continue
            at = start + off[start]
            begins = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
            data = np.ascontiguousarray(wins[start].view(np.uint8).reshape(-1, 8)[:, :HASH_BYTES])
            offsets = (np.r_[begins, len(start)] * HASH_BYTES).astype(np.int32)
            raw, bounds = text_buffer(batch.column("text"))
            tag = np.array([zlib.crc32(raw[a:b]) for a, b in zip(bounds[:-1], bounds[1:])], np.uint64)
            of = row[start[begins]]
            place = (tag[of] << np.uint64(32)) | (start[begins] - words.first[of]).astype(np.uint64)
            yield pa.RecordBatch.from_arrays([
                pa.array(grams[at[begins]].view(np.int64)), batch.column("doc_id").take(pa.array(of)), pa.array(place.view(np.int64)),
                pa.Array.from_buffers(pa.binary(), len(begins), [None, pa.py_buffer(offsets), pa.py_buffer(data)])],
                ["anchor", "doc_id", "place", "windows"])

    return run


def _runs(doc: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Neighbouring windows of one text as (doc, first place, count)."""
    order = np.lexsort((place, doc))
    doc, place = doc[order], place[order]
    keep = np.r_[True, (doc[1:] != doc[:-1]) | (place[1:] != place[:-1])]
    doc, place = doc[keep], place[keep]
    first = np.flatnonzero(np.r_[True, (doc[1:] != doc[:-1]) | (place[1:] != place[:-1] + 1)])
    return doc[first], place[first], np.diff(np.r_[first, len(doc)])


def _repeats(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by (anchor, doc_id): kind 0, runs of windows that a
    smaller id has; kind 1, each window in the first document that has it,
    under the partition's first and last anchor, one row with all its places."""
    names = ["kind", "anchor", "window", "doc_id", "place", "n", "places"]
    places = pa.list_(pa.int64())

    def repeats(doc: np.ndarray, place: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        fixed = [pa.array(np.full(len(doc), v, t)) for v, t in ((0, np.int32), (0, np.int64), (0, np.int64))]
        return pa.RecordBatch.from_arrays([*fixed, pa.array(doc), pa.array(place), pa.array(n.astype(np.int32)), pa.nulls(len(doc), places)], names)

    def firsts(anchor: int, window: np.ndarray, doc: np.ndarray, place: np.ndarray) -> pa.RecordBatch:
        order = np.lexsort((place, window))
        window, doc, place = window[order], doc[order], place[order]
        head = np.flatnonzero(np.r_[True, window[1:] != window[:-1]])
        fixed = [pa.array(np.full(len(head), v, t)) for v, t in ((1, np.int32), (anchor, np.int64))]
        listed = pa.ListArray.from_arrays(pa.array(np.r_[head, len(place)].astype(np.int32)), pa.array(place))
        return pa.RecordBatch.from_arrays([*fixed, pa.array(window[head]), pa.array(doc[head]), *(pa.nulls(len(head), t) for t in (pa.int64(), pa.int32())), listed], names)

    none = np.zeros(0, np.int64)
    opened, seen_anchor, seen = None, None, (none, none, none)  # first documents' windows: window, doc, place
    for batch in batches:
        if not batch.num_rows:
            continue
        anchor, doc, place = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
        column = batch.column(3)
        offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1].astype(np.int64)
        data = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0]:offsets[-1]].reshape(-1, HASH_BYTES)
        count = np.diff(offsets) // HASH_BYTES
        opened = anchor[0] if opened is None else opened
        # anchors of a single id hold no repeat; those at an edge are kept
        group = np.cumsum(np.r_[True, anchor[1:] != anchor[:-1]]) - 1
        begins = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
        ends = np.r_[begins[1:], len(anchor)]
        use = doc[begins] != doc[ends - 1]
        use |= (anchor[begins] == opened) | (anchor[begins] == seen_anchor if seen_anchor is not None else False)
        use[-1] = True
        picked = np.flatnonzero(use[group])
        rep = np.repeat(picked, count[picked])
        first_window = np.cumsum(count) - count
        step = np.arange(len(rep)) - np.repeat(np.cumsum(count[picked]) - count[picked], count[picked])
        wide = np.zeros((len(rep), 8), np.uint8)
        wide[:, :HASH_BYTES] = data[first_window[rep] + step]
        g, w, d, p, new = group[rep], wide.view(np.int64).ravel(), doc[rep], place[rep] + step, np.ones(len(rep), bool)
        if seen_anchor == anchor[0]:
            g, w, d, p = np.r_[np.zeros(len(seen[0]), np.int64), g], np.r_[seen[0], w], np.r_[seen[1], d], np.r_[seen[2], p]
            new = np.r_[np.zeros(len(seen[0]), bool), new]
        elif seen_anchor is not None and seen_anchor == opened and len(seen[0]):
            yield firsts(seen_anchor, *seen)
        order = np.lexsort((p, d, w, g))
        g, w, d, p, new = g[order], w[order], d[order], p[order], new[order]
        head = np.r_[True, (g[1:] != g[:-1]) | (w[1:] != w[:-1])]
        smallest = d[head][np.cumsum(head) - 1]
        hit = new & (d > smallest)
        if hit.any():
            yield repeats(*_runs(d[hit], p[hit]))
        own = d == smallest  # every place of a window in its first document
        last = own & (g == group[-1])
        if opened == anchor[0] != anchor[-1]:  # the first anchor ends in this batch
            edge = own & (g == 0)
            if edge.any():
                yield firsts(opened, w[edge], d[edge], p[edge])
        seen_anchor, seen = anchor[-1], (w[last], d[last], p[last])
    if seen_anchor is not None and len(seen[0]):
        yield firsts(seen_anchor, *seen)


def repeated_windows(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """(doc_id, place, n): runs of n window starts of ``docs`` (doc_id, text)
    whose words also start in a document with a smaller id."""
    anchors = docs.where("doc_id is not null and text is not null").mapInArrow(
        _anchor_rows(window, gram), "anchor bigint, doc_id bigint, place bigint, windows binary")
    ordered = anchors.repartitionByRange("anchor", "doc_id").sortWithinPartitions("anchor", "doc_id")
    found = cut_lineage(ordered.mapInArrow(_repeats, FOUND), "llm-repeats")
    across = Window.partitionBy("anchor", "window")
    late = found.where("kind = 1").select("anchor", "window", "doc_id", "places").withColumn(
        "smallest", F.min("doc_id").over(across)).where("smallest < doc_id").select("doc_id", F.explode("places").alias("place"), F.lit(1).alias("n"))
    return found.where("kind = 0").select("doc_id", "place", "n").unionAll(late)


def dedup_substrings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
                     gram: int = GRAM) -> DataFrame:
    """(doc_id, n_words, n_removed, kept, repeats) per row of ``docs``: the
    words that no repeat covers, joined by one space, and the maximal repeats
    as (start, end) word bounds, end exclusive.

    All windows are judged on the input. NULL and empty texts have no words;
    texts shorter than a window lose none. A NULL id is neither smaller nor
    larger than any: its row loses nothing and takes nothing from others. Rows
    that share an id never take words from each other; an empty table gives an
    empty one."""
    src = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    found = repeated_windows(src, window, gram)
    spans = found.groupBy("doc_id", F.shiftrightunsigned("place", 32).alias("tag")).agg(
        F.collect_list(F.struct(F.col("place").bitwiseAND(0xFFFFFFFF).alias("start"), "n")).alias("runs"))
    tagged = src.withColumn("tag", F.crc32(F.coalesce("text", F.lit(""))))
    joined = tagged.join(spans, ["doc_id", "tag"], "left").select("doc_id", "text", "runs")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        repeat = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            n_words, n_removed, kept, repeats = [], [], [], []
            for text, runs in zip(batch.column(1), batch.column(2).to_pylist()):
                words = (text.as_py() or "").encode().split()
                bounds: list[list[int]] = []
                for start, n in sorted((r["start"], r["n"]) for r in runs or ()):
                    end = start + n - 1 + window
                    if bounds and start <= bounds[-1][1]:
                        bounds[-1][1] = max(bounds[-1][1], end)
                    else:
                        bounds.append([start, end])
                n_words.append(len(words))
                n_removed.append(sum(e - s for s, e in bounds))
                for s, e in reversed(bounds):
                    del words[s:e]
                kept.append(b" ".join(words).decode())
                repeats.append([{"start": s, "end": e} for s, e in bounds])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()),
                                              pa.array(kept, pa.string()), pa.array(repeats, repeat)],
                                             ["doc_id", "n_words", "n_removed", "kept", "repeats"])

    return joined.mapInArrow(run, "doc_id bigint, n_words bigint, n_removed bigint, kept string, repeats array<struct<start: bigint, end: bigint>>")
