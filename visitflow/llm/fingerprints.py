"""Document fingerprints: bottom-k sketches, in DataFrame functions only.

A sketch is the sorted array of the k smallest distinct hashes of a text's
word shingles. Sketches of parts merge into the sketch of the whole, and two
sketches estimate resemblance, containment and the number of distinct
shingles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SHINGLE_WORDS = 5
SIZE = 128
NO_HASHES = "cast(array() as array<bigint>)"


def words(text: Column) -> Column:
    """Runs of anything but the six ASCII white-space characters; NULL has none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), "[\\x20\\x09-\\x0D]+"), lambda w: w != "")


def sketch(text: Column, shingle: int = SHINGLE_WORDS, size: int = SIZE) -> Column:
    """Bottom-k sketch of one text. A text of fewer words than a shingle has
    its whole sequence as the one shingle; without words the sketch is empty."""
    w = words(text)

    def hashes(ws: Column) -> Column:
        n = F.size(ws)
        grams = F.transform(F.sequence(F.lit(0), n - shingle), lambda i: F.xxhash64(*[F.get(ws, i + j) for j in range(shingle)]))
        return F.when(n >= shingle, grams).when(n > 0, F.array(F.xxhash64(F.array_join(ws, " ")))).otherwise(F.expr(NO_HASHES))

    # the words are bound once: every use of a lambda's variable is a lookup
    bound = F.get(F.transform(F.array(w), hashes), 0)
    return F.slice(F.sort_array(F.array_distinct(bound)), 1, size)


def merge(a: Column, b: Column, size: int = SIZE) -> Column:
    """Sketch of the union of two sketched sets."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, size)


def merge_sketches(df: DataFrame, keys: list[str], sketch_col: str, size: int = SIZE) -> DataFrame:
    """One sketch per key from any number of parts (rows). Hashes are made
    distinct with partial aggregates and ranked with a limit per map task, so
    a hot key ships at most ``size`` hashes a task. Keys whose parts are all
    empty or NULL have an empty sketch; NULL keys are one key."""
    hashes = df.select(*keys, F.explode_outer(sketch_col).alias("_hash")).distinct()
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(F.col("_hash").asc_nulls_last()))
    return hashes.withColumn("_rank", rank).where(F.col("_rank") <= size).groupBy(*keys).agg(
        F.sort_array(F.collect_list("_hash")).alias(sketch_col))


def distinct_count(s: Column, size: int = SIZE) -> Column:
    """Number of distinct shingles: exact below ``size``, else estimated from
    the place of the largest kept hash in the range of all."""
    share = (F.get(s, F.lit(size - 1)).cast("double") + F.lit(2.0 ** 63)) / F.lit(2.0 ** 64)
    return F.when(F.size(s) < size, F.size(s).cast("double")).otherwise(F.lit(size - 1) / share)


def resemblance(a: Column, b: Column, size: int = SIZE) -> Column:
    """Estimated Jaccard similarity: of the bottom-k of the union, the share in
    both. Two empty sketches are alike (1), one empty is not (0)."""
    union = merge(a, b, size)
    both = F.size(F.array_intersect(F.array_intersect(union, a), b))
    return F.when(F.size(union) == 0, F.lit(1.0)).otherwise(both / F.size(union))


def containment(a: Column, b: Column, size: int = SIZE) -> Column:
    """Estimated share of a's shingles that b has: resemblance times the size
    of the union over that of a, at most 1. An empty a is contained (1)."""
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), resemblance(a, b, size) * distinct_count(merge(a, b, size), size) / distinct_count(a, size)))


def as_text(s: Column) -> Column:
    """A sketch as text: 16 hexadecimal digits a hash, in order."""
    return F.lower(F.array_join(F.transform(s, lambda h: F.lpad(F.hex(h), 16, "0")), ""))


def _range_bounds(docs: DataFrame, ranges: int) -> list[int]:
    """Sorted, distinct ids at which ranges of about equal rows begin; the
    first is the smallest id. At most ``ranges`` numbers reach the driver."""
    shares = [k / ranges for k in range(1, ranges)]
    row = docs.agg(F.min("doc_id").alias("lo"), *([F.percentile_approx("doc_id", shares, 50 * ranges).alias("cuts")] if shares else [])).first()
    return [] if row.lo is None else sorted({row.lo, *(row.cuts if shares and row.cuts else ())})


def with_next(docs: DataFrame, ranges: int, shingle: int = SHINGLE_WORDS, size: int = SIZE) -> DataFrame:
    """(doc_id, text, sketch, next_text, next_sketch) per row: next by (doc_id,
    text), NULL ids first; the last row's next is the first, a lone row's is
    itself. NULL texts are empty.

    Rows are dealt to ranges of ids, one shuffle of the texts. The row that a
    range begins with is also sent to the range before as its end mark, so no
    range needs another's result. Rows that repeat an id share a range."""
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    bounds = _range_bounds(docs, ranges)
    nulls = docs.where("doc_id is null").limit(1).count() > 0
    if nulls or not bounds:  # NULL ids are the first range
        bounds = [None, *bounds]
    n, step = len(bounds), max(1, round(len(bounds) ** 0.5))
    ids = [b for b in bounds if b is not None]
    chunks = [ids[i:i + step] for i in range(0, len(ids), step)] or [[0]]
    arr = lambda xs: F.array(*[F.lit(x).cast("bigint") for x in xs])
    # which range: first among the chunks' heads, then inside one chunk
    chunk = F.size(F.filter(arr([c[0] for c in chunks]), lambda b: b <= F.col("doc_id")))
    inner = F.get(F.array(*[arr(c) for c in chunks]), F.col("_chunk") - 1)
    place = (F.col("_chunk") - 1) * step + F.size(F.filter(inner, lambda b: b <= F.col("doc_id"))) - 1
    first = 1 if bounds and bounds[0] is None else 0
    part = F.when(F.col("doc_id").isNull(), F.lit(0)).otherwise(place + first)
    placed = docs.withColumn("_chunk", chunk).withColumn("_part", part.cast("int")).drop("_chunk")
    begins = F.when(F.col("doc_id").isNull(), F.lit(True)).otherwise(
        F.col("doc_id") == F.get(arr([0 if b is None else b for b in bounds]), F.col("_part")))
    before = F.when(F.col("_part") == 0, F.lit(n - 1)).otherwise(F.col("_part") - 1)
    sent = F.when(begins, F.array(F.struct(F.col("_part").alias("part"), F.lit(0).alias("mark")),
                                  F.struct(before.cast("int").alias("part"), F.lit(1).alias("mark")))).otherwise(
        F.array(F.struct(F.col("_part").alias("part"), F.lit(0).alias("mark"))))
    dealt = placed.select("doc_id", "text", F.explode(sent).alias("_to")).select("doc_id", "text", "_to.part", "_to.mark")
    dealt = dealt.repartition("part").withColumn("sketch", sketch(F.col("text"), shingle, size))  # once per row, behind the shuffle
    order = Window.partitionBy("part").orderBy("mark", F.col("doc_id").asc_nulls_first(), "text")
    out = dealt.withColumns({"next_text": F.lead("text").over(order), "next_sketch": F.lead("sketch").over(order)})
    return out.where("mark = 0").select("doc_id", "text", "sketch", "next_text", "next_sketch")
