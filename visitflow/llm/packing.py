"""Best-fit packing with certified bin counts.

Documents become token sequences of one fixed length. Each partition packs its
pieces by best-fit decreasing and certifies the count with lower bounds from
dual feasible functions; a partition that reaches its bound is done. Those
with a gap keep their full sequences, exchange the documents of all others
(dealt anew by another hash) and pack again, as long as that saves sequences.
Only counts of partitions reach the driver.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitflow.config import cut_lineage

CAPACITY = 1024
END_ID = 2
PARTITION_PIECES = 5_000
TOKENIZER = "byte_bpe_50k.tiktoken"
SAME_TOKENIZER = "byte_bpe_50k.json"  # the same vocabulary for the other library
SPECIAL = "<|endoftext|>"
LONG_SPACE = 100_000
PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def load_tokenizer(path: str):
    """The byte-level BPE of a rank file with the vocabulary's one special token,
    whose id is the first behind the ranks; one per Python worker and path."""
    import base64

    import public_tokenizers
    import tiktoken

    kept = tiktoken.__dict__.setdefault("_loaded_by_path", {})
    if path not in kept:
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        kept[path] = tiktoken.Encoding("byte_bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={SPECIAL: len(ranks)})
    return kept[path]


def load_same_tokenizer(path: str):
    """The same BPE from its JSON file, slower but without a limit on white
    space in a row; one per Python worker and path."""
    import tokenizers

    kept = tokenizers.__dict__.setdefault("_loaded_by_path", {})
    if path not in kept:
        kept[path] = tokenizers.Tokenizer.from_file(path)
    return kept[path]


def encoder(path: str, same_path: str) -> Callable[[str], list[int]]:
    """Token ids of a text. The rank file's library gives up on about a million
    white-space characters in a row; texts with LONG_SPACE of them go to the
    other library, which has the same ids. SPECIAL in a text is one token."""
    ranks = load_tokenizer(path)

    def ids(text: str) -> list[int]:
        if len(text) >= LONG_SPACE and max((m.end() - m.start() for m in re.finditer(r"\s+", text)), default=0) >= LONG_SPACE:
            return load_same_tokenizer(same_path).encode(text, add_special_tokens=False).ids
        return ranks.encode(text, allowed_special="all") if SPECIAL in text else ranks.encode_ordinary(text)

    return ids


def cut(n: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: whole if it fits, else pieces of
    ``capacity``, of which the first may be shorter."""
    if n <= capacity:
        return [(0, n)]
    head = n % capacity
    return ([(0, head)] if head else []) + [(s, capacity) for s in range(head, n, capacity)]


def token_pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None,
                 same_path: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece (PIECES): the text's token ids, then END_ID, cut to
    ``capacity``. NULL and empty texts are END_ID alone; a NULL id stays NULL."""
    path, same_path = path or tokenizer_path(), same_path or tokenizer_path(SAME_TOKENIZER)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path, same_path)
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = np.array([*encode(text.as_py() or ""), END_ID], "<u4")
                for k, (start, length) in enumerate(cut(len(ids), capacity)):
                    rows.append((doc_id, k, start, length, zlib.crc32(ids[start:start + length].tobytes())))
            cols = zip(*rows) if rows else [()] * 5
            types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], ["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, PIECES)


def lower_bound(length: np.ndarray, capacity: int = CAPACITY) -> int:
    """Sequences that these lengths need at least: the largest over dual
    feasible functions. For each threshold e up to half the capacity, lengths
    above capacity - e count as a whole sequence, those below e as nothing and
    the rest as themselves; the rounding functions for k = 1..20 follow."""
    if not len(length):
        return 0
    count = np.bincount(length, minlength=capacity + 1).astype(np.int64)
    size = np.arange(capacity + 1)
    n, total = np.r_[0, np.cumsum(count)], np.r_[0, np.cumsum(count * size)]
    best = -(-int(total[-1]) // capacity)
    for e in range(1, capacity // 2 + 1):
        large = int(n[-1] - n[capacity - e + 1])
        best = max(best, large + -(-int(total[capacity - e + 1] - total[e]) // capacity))
    for k in range(1, 21):  # u_k(x) = x when (k + 1) x is whole, else floor((k + 1) x) / k
        scaled = (k + 1) * size
        whole = scaled % capacity == 0
        # in units of capacity * k
        value = np.where(whole, size * k, scaled // capacity * capacity)
        best = max(best, -(-int((value * count).sum()) // (capacity * k)))
    return best


def best_fit_decreasing(length: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray, int]:
    """(bin, offset, bins): longest first, each into the fullest bin with room.
    Free rooms are kept as one integer's bits, bins with each room in a list."""
    bins, offsets = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms, n = 0, 0
    for i in np.argsort(-length, kind="stable").tolist():
        need = int(length[i])
        fits = rooms >> need
        if fits:
            room = need + (fits & -fits).bit_length() - 1
            b = open_bins[room].pop()
            if not open_bins[room]:
                rooms &= ~(1 << room)
        else:
            room, b, n = capacity, n, n + 1
        bins[i], offsets[i] = b, capacity - room
        if room > need:
            open_bins[room - need].append(b)
            rooms |= 1 << (room - need)
    return bins, offsets, n


def _packed(pieces: DataFrame, parts: int, turn: int, capacity: int) -> DataFrame:
    """Pieces with their bin in the partition, its fill, count and bound."""
    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["doc_id", "piece", "ids_crc32"], kind="stable").reset_index(drop=True)
        length = pdf["length"].to_numpy(np.int64)
        bins, offset, n = best_fit_decreasing(length, capacity)
        fill = np.bincount(bins, length, n).astype(np.int64)
        return pdf.assign(bin=bins, offset=offset, full=fill[bins] == capacity, bins=n, bound=lower_bound(length, capacity))

    # the row's place in the stored table spreads equal rows too
    part = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32", F.monotonically_increasing_id(), F.lit(turn)), F.lit(parts)).cast("int")
    return pieces.withColumn("part", part).groupBy("part").applyInPandas(
        pack, PIECES + ", part int, bin bigint, offset bigint, full boolean, bins bigint, bound bigint")


def pack(pieces: DataFrame, capacity: int = CAPACITY, partition_pieces: int = PARTITION_PIECES) -> DataFrame:
    """``pieces`` (PIECES) with sequence_id and offset; every piece is placed
    once and the pieces of a sequence lie without gaps from 0. Repeated rows
    are packed each; no pieces give no rows. ``partition_pieces`` is the mean
    number of pieces that one task packs."""
    pieces = cut_lineage(pieces, "llm-pieces")
    n = pieces.count()
    rest, done, turn = pieces, [], 0
    parts = max(1, round(n / partition_pieces))
    packed = cut_lineage(_packed(rest, parts, turn, capacity), "llm-packed")
    while True:
        ident = (F.lit(turn << 52) + F.shiftleft(F.col("part").cast("bigint"), 28) + F.col("bin")).alias("sequence_id")
        here = packed.select(*pieces.columns, ident, "offset", ((F.col("bins") > F.col("bound")) & ~F.col("full")).alias("open"))
        left = here.where("open")
        before = left.agg(F.countDistinct("sequence_id").alias("bins"), F.count("*").alias("n")).first()
        parts = max(1, round(before.n / partition_pieces))
        if before.bins < 2:
            break
        turn += 1
        again = cut_lineage(_packed(left.select(*pieces.columns), parts, turn, capacity), "llm-packed")
        after = again.select("part", "bins").distinct().agg(F.sum("bins")).first()[0]
        if after >= before.bins:
            break
        done.append(here.where("not open").drop("open"))
        packed = again
    done.append(here.drop("open"))
    out = done[0]
    for x in done[1:]:
        out = out.unionAll(x)
    return out
