"""Exact top-k search by inner product, with pivot-table elimination.

Inner products become distances by one further coordinate: a candidate v gets
sqrt(M^2 - |v|^2), a query q gets 0, so |q' - v'|^2 = |q|^2 + M^2 - 2 q.v and
the largest inner product is the smallest distance. A cell of candidates keeps
the distances of all its members to many pivots; the triangle inequality makes
max over pivots |d(q, p) - d(v, p)| a lower bound of d(q, v). A query visits a
cell's candidates in the order of that bound and stops when no bound left can
reach its k-th best score, so nothing is missed.

Candidates are dealt to cells of bounded size by a hash of the row, queries
are sent to every cell and streamed past it. The first cell alone gives each
query a score to beat in the others.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from visitflow.config import cut_lineage
from visitflow.llm.vectors import matrices

SCALE = 256
CELL = 1 << 15  # candidates of a cell, about
LEAST = 1 << 12  # cells are smaller where there would be fewer than tasks, down to this
PIVOTS = 64
QUERIES = 256  # queries held against a cell at once
CHUNK = 512  # candidates evaluated first; later chunks double
LIMIT = 2.0 ** 63
EXACT = 2.0 ** 53  # whole numbers below this are exact in float64
NONE = np.iinfo(np.int64).min
_ROWS = "row bigint, vec_id bigint, is_query boolean, dim int, v binary"


def _integers(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each usable vector as little-endian 64-bit integers floor(256 x)."""
    for batch in batches:
        for rows, c in matrices(batch.column("vector")):
            c = np.floor(c * SCALE)
            fits = (np.abs(c) < LIMIT).all(axis=1)
            rows, v = rows[fits], np.ascontiguousarray(c[fits].astype("<i8"))
            width = v.shape[1] * 8
            data = pa.Array.from_buffers(pa.binary(width), len(v), [None, pa.py_buffer(v.tobytes())]).cast(pa.binary()) if len(v) else pa.array([], pa.binary())
            at = pa.array(rows)
            yield pa.RecordBatch.from_arrays([batch.column("row").take(at), batch.column("vec_id").take(at), batch.column("is_query").take(at),
                                              pa.array(np.full(len(rows), v.shape[1], np.int32)), data], ["row", "vec_id", "is_query", "dim", "v"])


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return np.frombuffer(b"".join(column.to_pylist()), "<i8").reshape(-1, dim)


class Cell:
    """Candidates of one cell with their pivot table."""

    def __init__(self, row: np.ndarray, ids: np.ndarray, no_id: np.ndarray, v: np.ndarray, pivots: int):
        order = np.lexsort((row, ids, no_id))  # ties go to the smaller id: the first here
        self.row, self.ids, self.no_id, self.v = row[order], ids[order], no_id[order], v[order]
        real = self.v.astype(float)
        self.real = real
        self.most = float(np.abs(real).max(initial=0))
        self.norms = (real * real).sum(axis=1)
        self.top = float(self.norms.max(initial=0))
        self.spare = np.sqrt(np.maximum(0, self.top - self.norms))
        self.pivots = np.linspace(0, len(real) - 1, min(pivots, len(real))).astype(int)
        p = real[self.pivots]
        inner = real @ p.T + np.outer(self.spare, self.spare[self.pivots])
        self.table = np.sqrt(np.maximum(0, 2 * self.top - 2 * inner)).T.copy()  # pivot x candidate

    def scores(self, q: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Exact inner products of one query with some candidates."""
        if self.most * float(np.abs(q.astype(float)).max(initial=0)) * len(q) < EXACT:
            return (self.real[at] @ q.astype(float)).astype(np.int64)
        return self.v[at].astype(object) @ np.array([int(x) for x in q], object)

    def best(self, q: np.ndarray, own: int, to_pivots: np.ndarray, k: int, floor: int | None) -> list[tuple[int, int]]:
        """At most k (score, place) of one query, best first, its own row left
        out; scores below ``floor`` may be missing."""
        bound = np.zeros(len(self.row))
        for d, column in zip(to_pivots, self.table):
            np.maximum(bound, np.abs(column - d), out=bound)
        size = float((q.astype(float) ** 2).sum()) + self.top
        reach = (size - bound * bound) / 2 + 1e-6 * size  # no score is above; rounding is far below the margin
        order = np.argsort(bound, kind="stable")
        kept: list[tuple[int, int]] = []
        least, at, step = floor, 0, CHUNK
        while at < len(order) and (least is None or reach[order[at]] >= least):
            part = order[at:at + step]
            part = part[self.row[part] != own]
            if least is not None:
                part = part[reach[part] >= least]
            got = self.scores(q, part)
            if least is not None:
                part, got = part[got >= least], got[got >= least]
            kept = sorted([*kept, *zip((int(s) for s in got), part.tolist())], key=lambda x: (-x[0], x[1]))[:k]
            if len(kept) == k:
                least = kept[-1][0] if least is None else max(least, kept[-1][0])
            at, step = at + step, step * 2
        return kept


_OUT = "query_row bigint, query_id bigint, row bigint, vec_id bigint, score bigint, big string"


def _search(k: int, pivots: int) -> Callable:
    """Rows sorted by (cell, dim, kind): a cell's candidates come first, then
    all queries, which are held against it in small blocks."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, cell = None, [], None
        for batch in batches:
            col = lambda name: batch.column(name).to_numpy(zero_copy_only=False)
            cells, dims, kinds = col("cell"), col("dim"), col("kind")
            cut = np.flatnonzero((np.diff(cells) != 0) | (np.diff(dims) != 0) | (np.diff(kinds) != 0)) + 1
            for a, b in zip([0, *cut], [*cut, len(cells)] if len(cells) else []):
                part, mine = batch.slice(a, b - a), (int(cells[a]), int(dims[a]))
                ids = part.column("vec_id")
                no_id = ids.is_null().to_numpy(zero_copy_only=False)
                ids = ids.fill_null(0).to_numpy(zero_copy_only=False)
                row, v = part.column("row").to_numpy(zero_copy_only=False), _matrix(part.column("v"), mine[1])
                if kinds[a] == 0:
                    if key != mine:
                        key, held, cell = mine, [], None
                    held.append((row, ids, no_id, v))
                    continue
                if key != mine:
                    continue  # no candidate of this length here
                if cell is None:
                    cell = Cell(*(np.concatenate(x) for x in zip(*held)), pivots)
                    held = []
                floors = part.column("floor").to_pylist()
                for at in range(0, len(row), QUERIES):
                    out = []
                    q = v[at:at + QUERIES]
                    real = q.astype(float)
                    square = (real * real).sum(axis=1)[:, None] + cell.top - 2 * real @ cell.real[cell.pivots].T
                    to_pivots = np.sqrt(np.maximum(0, square))
                    for i in range(len(q)):
                        n = at + i
                        floor = None if floors[n] is None else int(floors[n])
                        for score, place in cell.best(q[i], row[n], to_pivots[i], k, floor):
                            out.append((row[n], ids[n], cell.row[place], None if cell.no_id[place] else cell.ids[place],
                                        score if abs(score) < 1 << 63 else None, str(score)))
                    columns = list(zip(*out)) or [()] * 6
                    yield pa.RecordBatch.from_arrays([pa.array([None if x is None else int(x) for x in c], pa.int64()) for c in columns[:5]] + [pa.array(columns[5], pa.string())],
                                                     ["query_row", "query_id", "row", "vec_id", "score", "big"])

    return run


def _ranked(found: DataFrame, k: int) -> DataFrame:
    """The k best rows of each query row. Scores beyond 64 bits compare as decimals."""
    w = Window.partitionBy("query_row").orderBy(F.col("big").cast("decimal(38,0)").desc(), F.col("vec_id").asc_nulls_last(), "row")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding",
          cell: int = CELL, pivots: int = PIVOTS) -> DataFrame:
    """(query_id, rank, vec_id, score): for every row where ``is_query`` holds,
    the ``k`` rows with the largest inner product of floor(256 x), ties to the
    smaller vec_id, the query's own row left out.

    Vectors that are NULL or empty or hold NULL, non-finite or (times 256)
    64-bit overflowing entries take no part; a vector meets those of its own
    length. Rows that repeat an id or a vector are rows of their own, each
    repeated query has its own ranks; a row with a NULL id is a candidate
    (last among ties) and no query. A score beyond 64 bits is NULL, its rank
    is right. An empty table gives no rows."""
    rows = vectors.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("bigint").alias("vec_id"),
                          (F.coalesce(is_query, F.lit(False)) & F.col(id_col).isNotNull()).alias("is_query"),
                          F.col(vector_col).cast("array<double>").alias("vector"))
    rows = cut_lineage(rows.mapInArrow(_integers, _ROWS), "llm-vectors")
    n, tasks = rows.count(), int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cells = max(1, -(-n // cell), min(tasks, n // LEAST))
    candidates = rows.select(F.pmod(F.xxhash64("row"), F.lit(cells)).cast("int").alias("cell"), "dim", F.lit(0).alias("kind"),
                             "row", "vec_id", "v", F.lit(None).cast("string").alias("floor"))
    queries = rows.where("is_query").withColumn("floor", F.lit(None).cast("string"))

    def search(asked: DataFrame, first: int, last: int) -> DataFrame:
        asked = asked.withColumn("cell", F.explode(F.sequence(F.lit(first), F.lit(last)))).select(
            "cell", "dim", F.lit(1).alias("kind"), "row", "vec_id", "v", "floor")
        both = candidates.where(F.col("cell").between(first, last)).unionAll(asked)
        return both.repartitionById(last - first + 1, F.col("cell") - first).sortWithinPartitions("cell", "dim", "kind").mapInArrow(_search(k, pivots), _OUT)

    found = search(queries, 0, 0)
    if cells > 1:
        found = cut_lineage(_ranked(found, k), "llm-first-cell")
        floors = found.where(F.col("rank") == k).select(F.col("query_row").alias("row"), F.col("big").alias("floor"))
        rest = search(queries.drop("floor").join(floors, "row", "left"), 1, cells - 1)
        found = found.drop("rank").unionAll(rest)
    return _ranked(found, k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
