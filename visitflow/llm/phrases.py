"""Phrase collocations from count streams in prefix and suffix order.

Texts are cut into pieces and words, and contiguous phrases of one, two and
three words are counted per language. Counts of at least MIN_COUNT then lie in
one stream in prefix order - a phrase directly before all phrases that begin
with it - and in one in suffix order. Reading a stream once, in step, gives
every phrase the counts of its first (last) word and first (last) two words,
and every pair of words the largest count of its extensions to the right
(left); no table is looked up and nothing is matched by a hash. Streams are
cut into ranges of about equal rows, so the phrases of one word or one
language may span many ranges; what the rows before a range are needed for
(its last word and pair) is carried over by a table of one row per range.

All parts of a phrase that occurs ten times occur ten times themselves, which
keeps the counting small: a first reading counts 64-bit hashes of words and
pairs, in buckets, and leaves a bit map of bounded size of those that reach
the count; a second one counts the phrases themselves, as texts, passing over
phrases with a part that is not in the map. Collisions and a full map only let
more phrases through, never fewer, so the counts are exact at any size.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from visitflow.config import cut_lineage
from visitflow.llm.words import BASE, BYTE, WordHasher, Words, find_words, mix, ragged, row_of_word, slices, text_buffer
from visitflow.operators.ranges import carried, sorted_ranges

MIN_COUNT = 10
WORDS = 3
TOP = 2000
# A longer candidate with this share of a candidate's count takes its place.
COVER = (50, 100)
NO_LANG = "und"
MAP_BYTES = 1 << 25  # bound of the bit map
SLICE = 1 << 20  # bytes of text worked on at once
HELD = 1 << 18  # hashes a task holds before it passes them on
ENDS = np.isin(BYTE, list(b".,;:!?\n\x0b\x0c\r"))
IN_WORD = ~ENDS & (BYTE != 32) & (BYTE != 9)


class Phrases:
    """Words of some texts as numbers, and which neighbours form phrases."""

    def __init__(self, batch: pa.RecordBatch, hasher: WordHasher):
        found = find_words(batch.column("text"), lower=True, bytes_of_words=IN_WORD)
        self.langs = batch.column("lang").dictionary_encode()
        lang = self.langs.indices.to_numpy().astype(np.int64)
        row = row_of_word(found)
        self.lang = lang[row]
        coded = _strings(found.raw, found.start, found.end).dictionary_encode()
        self.code = coded.indices.to_numpy().astype(np.int64)
        self.words = coded.dictionary
        self.size = len(self.words)
        raw, at = text_buffer(self.words)
        self.word_hash = hasher(Words(raw, at[:-1], at[1:], np.zeros(0, np.int64)))
        self.lang_hash = np.array([zlib.crc32(x.as_py().encode()) for x in self.langs.dictionary], np.uint64)
        ends = np.concatenate([[0], np.cumsum(ENDS[found.raw])])
        self.joined = (row[1:] == row[:-1]) & (ends[found.start[1:]] == ends[found.end[:-1]])

    def places(self, n: int) -> np.ndarray:
        """First words of all phrases of ``n`` words."""
        if n == 1:
            return np.arange(len(self.code))
        ok = self.joined
        for k in range(2, n):
            ok = ok[:-1] & self.joined[k - 1:] if len(ok) else ok
        return np.flatnonzero(ok)

    def keys(self, n: int) -> np.ndarray:
        """One number per (lang, word) or (lang, word, word) at each place."""
        at = self.places(n)
        key = self.lang[at]
        for k in range(n):
            key = key * self.size + self.code[at + k]
        return key

    def hashes(self, n: int, keys: np.ndarray) -> np.ndarray:
        """Hash of each key of ``n`` words (one or two)."""
        out = np.full(len(keys), n, np.uint64)
        rest, parts = keys, []
        for _ in range(n):
            parts.append(rest % self.size)
            rest = rest // self.size
        out += self.lang_hash[rest] * np.uint64(31)
        for part in reversed(parts):
            out = mix(out * np.uint64(BASE) + self.word_hash[part])
        return out


def _strings(raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.StringArray:
    """Slices of ``raw`` as strings. (One batch holds less than 2 GB of text.)"""
    length = end - start
    offsets = np.concatenate([[0], np.cumsum(length)]).astype(np.int32)
    return pa.StringArray.from_buffers(len(start), pa.py_buffer(offsets), pa.py_buffer(raw[ragged(start, length)]))


def _batches(batches: Iterable[pa.RecordBatch]) -> Iterator[Phrases]:
    hasher = WordHasher()
    for batch in slices(batches, size=SLICE):
        yield Phrases(batch, hasher)


def _summed(keys: np.ndarray, n: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, ascending, and their occurrences or summed counts."""
    order = np.argsort(keys, kind="stable") if n is not None else None
    keys = np.sort(keys) if order is None else keys[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    counts = np.diff(np.append(first, len(keys))) if n is None else np.add.reduceat(n[order], first) if len(first) else np.zeros(0, np.int64)
    return keys[first], counts


def _hash_counts(buckets: int, most: int) -> Callable:
    """(bucket, hashes, counts): hashes of words and pairs, summed per task as
    far as HELD goes, counts cut at ``most``."""
    shift = np.uint64(64 - buckets.bit_length() + 1)
    kind = np.uint8 if most < 256 else np.int64

    def flush(keys: list, counts: list) -> Iterator[pa.RecordBatch]:
        h, n = _summed(np.concatenate(keys), np.concatenate(counts))
        n = np.minimum(n, most).astype(kind)
        at = np.searchsorted(h >> shift, np.arange(buckets + 1, dtype=np.uint64))
        full = np.flatnonzero(np.diff(at))
        yield pa.RecordBatch.from_arrays([
            pa.array(full.astype(np.int32)), pa.array([h[at[b]:at[b + 1]].tobytes() for b in full], pa.binary()),
            pa.array([n[at[b]:at[b + 1]].tobytes() for b in full], pa.binary())], ["bucket", "hashes", "counts"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts, held = [], [], 0
        for part in _batches(batches):
            for n in (1, 2):
                key, count = _summed(part.keys(n))
                keys.append(part.hashes(n, key))
                counts.append(count)
                held += len(key)
            if held > HELD:
                yield from flush(keys, counts)
                keys, counts, held = [], [], 0
        if held:
            yield from flush(keys, counts)

    return run


def _frequent(most: int) -> Callable:
    """(bucket, n, hashes) from rows sorted by bucket: hashes counted ``most`` times."""
    kind = np.uint8 if most < 256 else np.int64

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, keys, counts = None, [], []

        def done() -> Iterator[pa.RecordBatch]:
            if keys:
                h, n = _summed(np.concatenate(keys), np.concatenate(counts))
                h = h[n >= most]
                yield pa.RecordBatch.from_arrays([pa.array([now], pa.int32()), pa.array([len(h)]), pa.array([h.tobytes()], pa.binary())], ["bucket", "n", "hashes"])

        for batch in batches:
            for bucket, h, n in zip(*(c.to_pylist() for c in batch.columns)):
                if bucket != now:
                    yield from done()
                    now, keys, counts = bucket, [], []
                keys.append(np.frombuffer(h, np.uint64))
                counts.append(np.frombuffer(n, kind).astype(np.int64))
        yield from done()

    return run


def frequent_map(docs: DataFrame, min_count: int, max_bytes: int = MAP_BYTES) -> np.ndarray:
    """Bit map with the bit of every word and pair that occurs ``min_count``
    times (and, by collisions, some others). Each bucket of hashes owns a
    stretch of it, so a bucket's stretch is made in one task; at most
    ``max_bytes`` in all meet on the driver and are sent to the tasks."""
    spark = docs.sparkSession
    buckets = 1 << min(14, (4 * int(spark.conf.get("spark.sql.shuffle.partitions"))).bit_length())
    counted = docs.mapInArrow(_hash_counts(buckets, min_count), "bucket int, hashes binary, counts binary")
    found = cut_lineage(counted.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(
        _frequent(min_count), "bucket int, n bigint, hashes binary"), "llm-frequent")
    total = found.agg(F.sum("n")).collect()[0][0] or 0
    bits = 1 << max(3, min((max_bytes * 8 // buckets).bit_length() - 1, (16 * total // buckets).bit_length()))

    def stretch(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for h in batch.column("hashes").to_pylist():
                piece = np.zeros(bits // 8, np.uint8)
                low = np.frombuffer(h, np.uint64) & np.uint64(bits - 1)
                np.bitwise_or.at(piece, low >> np.uint64(3), np.uint8(1) << (low & np.uint64(7)).astype(np.uint8))
                out.append(piece.tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("bucket"), pa.array(out, pa.binary())], ["bucket", "piece"])

    whole = np.zeros((buckets, bits // 8), np.uint8)
    for r in found.where("n > 0").select("bucket", "hashes").mapInArrow(stretch, "bucket int, piece binary").collect():
        whole[r["bucket"]] = np.frombuffer(r["piece"], np.uint8)
    return whole


def _in_map(whole: np.ndarray, h: np.ndarray) -> np.ndarray:
    buckets, size = whole.shape
    bucket = h >> np.uint64(64 - buckets.bit_length() + 1)
    low = h & np.uint64(size * 8 - 1)
    return (whole[bucket, low >> np.uint64(3)] >> (low & np.uint64(7)).astype(np.uint8)) & 1 > 0


def _phrase_counts(sent) -> Callable:
    """(lang, phrase, f) summed per slice of text, words joined by a space;
    all words of a language also as one row without a phrase."""
    def rows(part: Phrases, n: int, lang: np.ndarray, codes: list[np.ndarray], f: np.ndarray) -> pa.RecordBatch:
        words = [part.words.take(pa.array(c)) for c in codes]
        phrase = words[0] if n == 1 else pc.binary_join_element_wise(*words, " ") if n else pa.nulls(len(f), pa.string())
        return pa.RecordBatch.from_arrays([part.langs.dictionary.take(pa.array(lang)), phrase, pa.array(f)], ["lang", "phrase", "f"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = sent.value
        for part in _batches(batches):
            if not part.size:
                continue
            lang, f = _summed(part.lang)
            yield rows(part, 0, lang, [], f)
            key, f = _summed(part.keys(1))
            ok = _in_map(whole, part.hashes(1, key))
            yield rows(part, 1, key[ok] // part.size, [key[ok] % part.size], f[ok])
            at, keys = part.places(2), part.keys(2)
            key, inverse, f = np.unique(keys, return_inverse=True, return_counts=True)
            ok = _in_map(whole, part.hashes(2, key))
            yield rows(part, 2, key[ok] // part.size ** 2, [key[ok] // part.size % part.size, key[ok] % part.size], f[ok])
            # three words: both pairs are in the map; a pair's number stands for it
            pair = np.full(len(part.code), -1)
            pair[at] = np.where(ok[inverse], inverse, -1)
            third = part.places(3)
            third = third[(pair[third] >= 0) & (pair[third + 1] >= 0)]
            triple, f = _summed(pair[third] * part.size + part.code[third + 2])
            front, last = key[triple // part.size], triple % part.size
            yield rows(part, 3, front // part.size ** 2, [front // part.size % part.size, front % part.size, last], f)

    return run


def phrase_counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", min_count: int = MIN_COUNT,
                  max_bytes: int = MAP_BYTES) -> DataFrame:
    """(lang, w1, w2, w3, f): all phrases of one to three words (w2, w3 NULL
    where shorter) with ``f >= min_count`` occurrences, and per language its
    number of words (w1 NULL). NULL texts have no words; a NULL language is
    NO_LANG."""
    rows = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit(NO_LANG)).alias("lang"), F.col(text_col).cast("string").alias("text"))
    sent = docs.sparkSession.sparkContext.broadcast(frequent_map(rows, min_count, max_bytes))
    counted = rows.mapInArrow(_phrase_counts(sent), "lang string, phrase string, f bigint").groupBy("lang", "phrase").agg(F.sum("f").alias("f"))
    words = F.split("phrase", " ")  # no word holds a space
    return counted.where(F.col("phrase").isNull() | (F.col("f") >= min_count)).select(
        "lang", *[F.get(words, k).alias(f"w{k + 1}") for k in range(WORDS)], "f")


# Streams ------------------------------------------------------------------

_STREAM = "part int, kind int, lang string, a string, b string, c string, f bigint, one bigint, two bigint, more bigint, x bigint, y bigint, z bigint"
_COLUMNS = [c.split()[0] for c in _STREAM.split(", ")]
PHRASE, LEAD, LAST = 0, 1, 2


def _in_step(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One reading of a range in order. ``one`` and ``two`` of a phrase are the
    counts of its first word and first pair (NULL where these lie in a range
    before), ``more`` of a pair the largest count of its extensions, for which
    its row waits. Extensions of a pair of a range before leave a LEAD row with
    the pair's words; the range's last word and pair are its LAST rows."""
    word = pair = lead = None
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            row.update(kind=PHRASE, one=word and word["f"], two=None, more=0)
            if row["c"] is not None:
                row["two"] = pair and pair["f"]
                longer = pair
                if pair is None:
                    longer = lead = lead or {**row, "kind": LEAD, "c": None, "more": 0}
                longer["more"] = max(longer["more"], row["f"])
                out.append(row)
            elif row["b"] is not None:
                if pair:
                    out.append(pair)
                pair = row
            else:
                row["one"], word = None, row
                out.append(row)
        yield pa.RecordBatch.from_pylist(out, _ARROW)
    ends = [{**x, "kind": LAST} for x in (word, pair) if x]
    yield pa.RecordBatch.from_pylist([x for x in (pair, lead) if x] + ends, _ARROW)


_ARROW = pa.schema([(c.split()[0], {"string": pa.string(), "bigint": pa.int64(), "int": pa.int32()}[c.split()[1]]) for c in _STREAM.split(", ")])


def _stream(counts: DataFrame, ranges: int | None) -> DataFrame:
    """``counts`` (lang, a, b, c, f, x, y, z) with one, two and more: a reading
    in the order of a, b, c, whole over the edges of the ranges."""
    read = cut_lineage(sorted_ranges(counts, ["lang", "a", "b", "c"], ranges).mapInArrow(_in_step, _STREAM), "llm-stream")
    edge = F.col("kind") == LAST
    ends = read.where(F.col("kind") > PHRASE).groupBy("part").agg(
        F.max(F.when(edge & F.col("b").isNull(), F.col("f"))).alias("word"), F.max(F.when(edge & F.col("b").isNotNull(), F.col("f"))).alias("pair"))
    before = carried(ends, {"word": F.col("word"), "pair": F.col("pair")})
    lead = read.where(F.col("kind") == LEAD).groupBy("lang", "a", "b").agg(F.max("more").alias("lead"))
    rows = read.where(F.col("kind") == PHRASE).join(before, "part", "left").join(lead, ["lang", "a", "b"], "left")
    return rows.select("lang", "a", "b", "c", "f", "x", "y", "z", F.when(F.col("b").isNotNull(), F.coalesce("one", "word")).alias("one"),
                       F.when(F.col("c").isNotNull(), F.coalesce("two", "pair")).alias("two"),
                       F.when(F.col("c").isNull(), F.greatest("more", F.coalesce("lead", F.lit(0)))).alias("more"))


def candidates(counts: DataFrame, ranges: int | None = None) -> DataFrame:
    """(lang, w1, w2, w3, a, l, r, score, longer) of every phrase of two or
    three words in ``counts``: its lowest-scoring cut (ties to the shorter first part)
    and the largest count of a phrase one word longer (0: none)."""
    none = F.lit(None).cast("bigint")
    prefix = _stream(counts.select("lang", F.col("w1").alias("a"), F.col("w2").alias("b"), F.col("w3").alias("c"), "f",
                                   *[none.alias(n) for n in "xyz"]), ranges)
    last = F.coalesce("c", "b", "a")
    middle = F.when(F.col("c").isNotNull(), F.col("b")).when(F.col("b").isNotNull(), F.col("a"))
    suffix = _stream(prefix.select("lang", last.alias("a"), middle.alias("b"), F.when(F.col("c").isNotNull(), F.col("a")).alias("c"), "f",
                                   F.col("one").alias("x"), F.col("two").alias("y"), F.col("more").alias("z")), ranges)
    wide = "CAST(1000000 AS DECIMAL(7,0)) * (CAST(f AS DECIMAL(15,0)) * CAST(f AS DECIMAL(15,0))) DIV (CAST({} AS DECIMAL(15,0)) * CAST({} AS DECIMAL(15,0)))"
    cut = lambda k, left, right: F.struct(F.expr(wide.format(left, right)).alias("score"), F.lit(k).alias("k"), F.col(left).alias("l"), F.col(right).alias("r"))
    pair = F.col("c").isNull()
    best = F.when(pair, cut(1, "x", "one")).otherwise(F.least(cut(1, "x", "two"), cut(2, "y", "one")))
    return suffix.where(F.col("b").isNotNull()).select(
        "lang", F.coalesce("c", "b").alias("w1"), F.when(pair, F.col("a")).otherwise(F.col("b")).alias("w2"),
        F.when(~pair, F.col("a")).alias("w3"), F.col("f").alias("a"), best.alias("best"),
        F.when(pair, F.greatest("more", "z")).otherwise(F.lit(0)).cast("bigint").alias("longer")).select(
        "lang", "w1", "w2", "w3", "a", "best.l", "best.r", "best.score", "longer")


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", min_count: int = MIN_COUNT,
                 top: int = TOP, ranges: int | None = None, max_bytes: int = MAP_BYTES) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``top`` phrases of each
    language by score, count and text, without those that a longer phrase
    covers (COVER). Every row's text counts, repeated rows each; NULL and
    empty texts and texts of separators alone have no words, an empty table
    gives no rows."""
    counts = cut_lineage(phrase_counts(docs, text_col, lang_col, min_count, max_bytes), "llm-phrases")
    words = counts.where("w1 IS NULL").select("lang", F.col("f").alias("n"))
    share, of = COVER
    kept = candidates(counts.where("w1 IS NOT NULL"), ranges).where(F.lit(of).cast("bigint") * F.col("longer") < F.lit(share).cast("bigint") * F.col("a"))
    kept = kept.withColumn("phrase", F.concat_ws(" ", "w1", "w2", "w3"))
    w = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    best = kept.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= top)
    return best.join(words, "lang").select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")
