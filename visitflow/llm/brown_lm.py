"""LM scoring with a class-based bigram model (Brown clustering by exchange).

Every word belongs to a unit: each of the UNIT_WORDS most frequent words is
one, all others share one of ENDINGS units by their last three bytes. The
exchange algorithm moves units between classes while that raises the
likelihood of the corpus' class bigrams. Then every other word with OWN_COUNT
training occurrences or more, however many words these are, moves from its
ending's class to the class that its own neighbours' classes make likeliest,
and the class bigrams are counted again. Rarer words stay with their ending. A text's probability is the product,
over its words and one end token, of the smoothed class transition and the
smoothed emission of the word by its class.

Word counts come from all training rows by a grouped sum. Count and class of
the KNOWN most frequent words (a bound, not a share) go to the tasks; all other
words of a text meet theirs in a join, so every count is exact and every word
has its class. The driver holds class and unit counts, at most the square of
the number of units, and the KNOWN words: nothing that grows with the text.
Words are found and hashed twice: to be counted, and to write each text as the
numbers of its units with the hashes of its other words; bigrams, contexts and
scores come from these stored numbers. Words are identified by a 64-bit hash.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitflow.config import cut_lineage
from visitflow.llm.words import WordHasher, Words, find_words, mix, row_of_word, slices

UNIT_WORDS = 512
ENDINGS = 512
CLASSES = 64
SWEEPS = 10
OWN_COUNT = 10
KNOWN = 1 << 18
EMISSION_ADD = 0.5
WORDS_AT_ONCE = 1 << 20  # of stored lines that a task works on; one longer line is taken whole
BIGRAM_SHARE = 0.95  # of the bigram estimate; the rest is the class's own share


@dataclass
class Units:
    """Hashes of the words that are sent to the tasks, sorted, with the unit
    and the count of each. Words that have a class of their own without being
    units are numbered behind the end."""

    hashes: np.ndarray
    unit: np.ndarray
    n: np.ndarray

    @property
    def end(self) -> int:
        return UNIT_WORDS + ENDINGS

    @property
    def size(self) -> int:
        return UNIT_WORDS + ENDINGS + 1


@dataclass
class Model:
    units: Units
    classes: np.ndarray  # class of each unit, and of each sent word numbered behind them
    transition: np.ndarray  # log10, by previous and next class
    emission_total: np.ndarray  # per class: its count and the added mass
    documents: int  # training rows, each an end token
    tokens: int
    distinct: int


def _ending(words: Words) -> np.ndarray:
    """Bucket of each word's last three bytes (fewer in a shorter word)."""
    code = np.zeros(len(words.start), np.uint64)
    for j in range(1, 4):
        there = words.end - j >= words.start
        code = (code << np.uint64(8)) | np.where(there, words.raw[np.maximum(words.end - j, 0)] if len(words.raw) else 0, 0).astype(np.uint64)
    return (mix(code) % np.uint64(ENDINGS)).astype(np.int64)


def _find(sorted_hashes: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Place of each hash among the sorted ones, -1 where it is not."""
    if not len(sorted_hashes):
        return np.full(len(hashes), -1)
    at = np.minimum(np.searchsorted(sorted_hashes, hashes), len(sorted_hashes) - 1)
    return np.where(sorted_hashes[at] == hashes, at, -1)


def _units_of(units: Units, words: Words, hashes: np.ndarray) -> np.ndarray:
    at = _find(units.hashes, hashes)
    own = units.unit[at] if len(units.unit) else at
    return np.where(at >= 0, own, UNIT_WORDS + _ending(words))


def _stored(first: np.ndarray, values: np.ndarray) -> pa.Array:
    """Row i of a binary column holds ``values[first[i]:first[i + 1]]``."""
    return pa.Array.from_buffers(pa.binary(), len(first) - 1, [None, pa.py_buffer((first * values.itemsize).astype(np.int32)), pa.py_buffer(values)])


def _numbers(column: pa.Array, kind) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of such a column in a row, and how many each row has."""
    if not len(column):
        return np.zeros(0, kind), np.zeros(0, np.int64)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int32)[column.offset:column.offset + len(column) + 1].astype(np.int64) // np.dtype(kind).itemsize
    return (np.frombuffer(data, kind, count=int(at[-1])) if at[-1] else np.zeros(0, kind))[at[0]:], np.diff(at)


def _stream(lines: pa.Array, end: int, kind=np.int32) -> tuple[np.ndarray, np.ndarray]:
    """All stored lines in a row, an end before the first and behind each, and
    the number of words of each."""
    numbers, n_words = _numbers(lines, kind)
    out = np.full(len(numbers) + len(lines) + 1, end, np.int64)
    out[np.arange(len(numbers)) + np.repeat(np.arange(len(lines)), n_words) + 1] = numbers
    return out, n_words


def _slices(batches: Iterable[pa.RecordBatch], kind=np.int32) -> Iterator[pa.RecordBatch]:
    return slices(batches, "line", WORDS_AT_ONCE * np.dtype(kind).itemsize)


def _unit(numbers: np.ndarray) -> np.ndarray:
    """The number itself; that of the ending where a word is not sent (``_rows``)."""
    return np.where(numbers < 0, ~numbers, numbers)


def _collect(df: DataFrame) -> list[np.ndarray]:
    """The columns on the driver, by Arrow: no row becomes an object there."""
    return [c.to_numpy() for c in df.toArrow().columns]


def word_counts(train: DataFrame) -> DataFrame:
    """(word, ending, n) over the texts of ``train``: exact counts."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher()
        for batch in slices(batches):
            words = find_words(batch.column("text"), lower=True)
            distinct, first, n = np.unique(hasher(words), return_index=True, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(distinct.view(np.int64)), pa.array(_ending(words)[first].astype(np.int16)), pa.array(n)],
                                             ["word", "ending", "n"])

    return train.select("text").mapInArrow(run, "word bigint, ending smallint, n bigint").groupBy("word", "ending").agg(F.sum("n").alias("n"))


def most_frequent(counts: DataFrame, most: int = KNOWN) -> DataFrame:
    """Words from the lowest count on at which no more than ``most`` words
    remain; counts are told apart by eighths of a power of two, so what the
    driver reads to find that count is a few hundred sums."""
    level = F.floor(8 * F.log2("n")).cast("int")
    sums = {r.level: r["count"] for r in counts.groupBy(level.alias("level")).count().collect()}
    cut, words = max(sums, default=0) + 1, 0
    for k in sorted(sums, reverse=True):
        words += sums[k]
        if words > most:
            break
        cut = k
    return counts.where(level >= cut)


def _pair_counts(lines: DataFrame, of: np.ndarray, end: int, size: int, kind=np.int32) -> np.ndarray:
    """How often each of ``size`` numbers follows each in the stored lines, a
    unit u counted as ``of[u]``; at most size squared sums come back."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size ** 2, np.int64)
        for batch in _slices(batches, kind):
            line = of[_unit(_stream(batch.column("line"), end, kind)[0])]
            total += np.bincount(line[:-1] * size + line[1:], minlength=len(total))
        there = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(there), pa.array(total[there])], ["pair", "n"])

    pair, n = _collect(lines.select("line").mapInArrow(run, "pair bigint, n bigint").groupBy("pair").agg(F.sum("n").alias("n")))
    out = np.zeros(size ** 2)
    out[pair] = n
    return out.reshape(size, size)


def _gains(table: np.ndarray, out: np.ndarray, back: np.ndarray, own: float) -> np.ndarray:
    """Likelihood gained by each class when a unit that is in none joins it."""
    base = _xlogx(table)
    gain_out = _xlogx(table + out) - base  # [b, c]: its followers counted for b
    gain_in = _xlogx(table + back[:, None]) - base  # [c, b]
    diag = table.diagonal()
    gain = gain_out.sum(axis=1) - gain_out.diagonal() + gain_in.sum(axis=0) - gain_in.diagonal()
    gain += _xlogx(diag + out + back + own) - _xlogx(diag)
    rows, cols = table.sum(axis=1) + back, table.sum(axis=0) + out  # its pairs count for their other ends whatever its class
    gain -= _xlogx(rows + out.sum() + own) - _xlogx(rows) + _xlogx(cols + back.sum() + own) - _xlogx(cols)
    gain[0] = -np.inf
    return gain


def own_classes(lines: DataFrame, units: Units, of: np.ndarray, classes: np.ndarray, table: np.ndarray) -> DataFrame:
    """(sent, word, class): the class of each word that is no unit and has
    OWN_COUNT occurrences; a sent word is named by its place behind the units,
    any other by its hash. All are in the classes of their endings now; ``of``
    gives every number's unit. A word's pairs with the classes before and
    behind it come as one row of counts from each slice of the lines, and meet
    in the order of the words; each word is taken out of ``table`` and put
    where it fits best."""
    size, k, end = units.size, len(table), units.end
    slots, n_sent, kind = 2 * k + 1, len(of) - size, _kind(2 * k)

    def pairs(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            numbers = _stream(batch.column("line"), end)[0]
            line, others = classes[of[_unit(numbers)]], np.flatnonzero(numbers < 0)
            hashes, one, back = np.unique(_numbers(batch.column("rest"), np.int64)[0], return_index=True, return_inverse=True)
            start = np.r_[classes[of[size:]], line[others[one]]]
            word = np.where(numbers >= size, numbers - size, -1)
            word[others] = n_sent + back
            again = word[1:] == word[:-1]  # the same word twice is one pair
            place = np.flatnonzero(word >= 0)
            behind = place[~again[place]]
            code, n = np.unique(np.r_[word[place] * slots + np.where(again[place - 1], 2 * k, line[place - 1]), word[behind] * slots + k + line[behind + 1]],
                                return_counts=True)
            first = np.flatnonzero(np.diff(code // slots, prepend=-1))
            at, bounds = code[first] // slots, np.r_[first, len(code)]
            name = np.r_[np.arange(n_sent), hashes][at]
            yield pa.RecordBatch.from_arrays([pa.array(at < n_sent), pa.array(name), pa.array(start[at].astype(np.int32)),
                                              _stored(bounds, (code % slots).astype(kind)), _stored(bounds, n.astype(np.int32))],
                                             ["sent", "word", "start", "slots", "n"])

    def choose(key: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
        there = np.flatnonzero(counts[:, :k].sum(axis=1) + counts[:, -1] >= OWN_COUNT)
        found = key[there, 2]
        for i, count in enumerate(counts[there]):
            a, back, out, own = found[i], count[:k], count[k:2 * k], count[-1]
            rest = table.copy()
            rest[a] -= out
            rest[:, a] -= back
            rest[a, a] -= own
            gain = _gains(rest, out, back, own)
            b = int(np.argmax(gain))
            if gain[b] > gain[a] + 1e-9:
                found[i] = b
        return pa.RecordBatch.from_arrays([pa.array(key[there, 0] > 0), pa.array(key[there, 1]), pa.array(found)], ["sent", "word", "class"])

    def best(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None  # the last word's rows may go on in the next batch
        for batch in batches:
            if not batch.num_rows:
                continue
            key = np.stack([batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("sent", "word", "start")], axis=1)
            new = np.r_[True, (key[1:] != key[:-1]).any(axis=1)]
            slot, per_row = _numbers(batch.column("slots"), kind)
            row = np.repeat(np.cumsum(new) - 1, per_row)
            counts = np.bincount(row * slots + slot, _numbers(batch.column("n"), np.int32)[0], new.sum() * slots).reshape(-1, slots)
            key = key[new]
            if last is not None and (last[0] == key[:1]).all():
                counts[0] += last[1][0]
            elif last is not None:
                key, counts = np.r_[last[0], key], np.r_[last[1], counts]
            last = key[-1:], counts[-1:]
            yield choose(key[:-1], counts[:-1])
        if last is not None:
            yield choose(*last)

    around = lines.select("line", "rest").mapInArrow(pairs, "sent boolean, word bigint, start int, slots binary, n binary")
    return around.repartition("sent", "word").sortWithinPartitions("sent", "word").mapInArrow(best, "sent boolean, word bigint, class bigint")


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1))


def exchange(bigrams: np.ndarray, classes: int = CLASSES, sweeps: int = SWEEPS) -> np.ndarray:
    """Class of each unit. The last unit (end) keeps class 0 to itself; the
    most frequent others begin in a class each, the rest in random ones, and
    each moves to the class that gives the class bigrams the largest
    likelihood, until none moves."""
    n = len(bigrams)
    weight = bigrams.sum(axis=0) + bigrams.sum(axis=1)
    order = np.argsort(-weight[:n - 1], kind="stable")
    of = np.zeros(n, np.int64)
    of[order] = 1 + np.random.default_rng(1).integers(0, max(1, classes - 1), n - 1)
    of[order[:classes - 1]] = 1 + np.arange(min(classes, n) - 1)
    member = np.eye(classes)[of]
    table = member.T @ bigrams @ member
    for _ in range(sweeps):
        moved = 0
        for u in order[weight[order] > 0]:
            a, own = of[u], bigrams[u, u]
            out = np.bincount(of, bigrams[u], classes)
            back = np.bincount(of, bigrams[:, u], classes)
            out[a] -= own
            back[a] -= own
            table[a] -= out
            table[:, a] -= back
            table[a, a] -= own
            gain = _gains(table, out, back, own)
            b = int(np.argmax(gain))
            if gain[b] <= gain[a] + 1e-9:
                b = a
            moved += b != a
            of[u] = b
            table[b] += out
            table[:, b] += back
            table[b, b] += own
        if not moved:
            break
    return of


def fit(train: DataFrame, classes: int = CLASSES) -> tuple[Model, DataFrame]:
    """The model and the stored count table, from the texts of ``train``."""
    none = F.lit(None).cast("bigint")
    return _fit(train.select(none.alias("doc_id"), F.lit(False).alias("held_out"), "text"), classes)[:2]


def _fit(src: DataFrame, k: int) -> tuple[Model, DataFrame, DataFrame]:
    """The model, the stored count table and the stored rows of ``_class_lines``."""
    train = src.where("not held_out")
    counts = cut_lineage(word_counts(train), "llm-counts")
    documents = train.count()
    total = counts.agg(F.sum("n").alias("n"), F.count("*").alias("v")).first()
    columns = ["word", "ending", "n"]
    top = _collect(counts.orderBy(F.desc("n"), "word").limit(UNIT_WORDS).select(columns))
    known = _collect(most_frequent(counts).select(columns))
    word, ending, n = (np.r_[a, b].astype(np.int64) for a, b in zip(top, known))
    n_top = len(top[0])
    hashes, first = np.unique(word.view(np.uint64), return_index=True)
    ending, n = ending[first], n[first]
    # units by rank; other sent words behind the end, if they are frequent enough
    own = (first >= n_top) & (n >= OWN_COUNT)
    unit = np.where(first < n_top, first, UNIT_WORDS + ending)
    unit[own] = UNIT_WORDS + ENDINGS + 1 + np.arange(own.sum())
    units = Units(hashes, unit.astype(np.int32), n)
    of = np.r_[np.arange(units.size), UNIT_WORDS + ending[own]]
    # from here on the texts are not read again
    rows = cut_lineage(src.mapInArrow(_rows(units), _ROWS), "llm-lines")
    lines = rows.where("not held_out")
    bigrams = _pair_counts(lines, of, units.end, units.size)
    classes = exchange(bigrams, k)
    member = np.eye(k)[classes]
    found = cut_lineage(own_classes(lines, units, of, classes, member.T @ bigrams @ member), "llm-own")
    at, new = _collect(found.where("sent").select("word", "class"))
    sent = classes[UNIT_WORDS + ending[own]]
    sent[at] = new
    # distinct words of each unit, and from them of each class
    kinds = np.zeros(units.size)
    for r in counts.groupBy("ending").agg(F.count(F.when(F.col("n") < OWN_COUNT, 1)).alias("few")).collect():
        kinds[UNIT_WORDS + r.ending] = r.few
    np.subtract.at(kinds, UNIT_WORDS + top[1][top[2] < OWN_COUNT].astype(np.int64), 1)
    kinds[:n_top] = 1
    kinds[units.end] = 1
    kinds = np.bincount(classes, kinds, k)
    for r in found.groupBy("class").count().collect():
        kinds[r["class"]] += r["count"]
    classes = np.r_[classes, sent].astype(np.int64)
    rows = cut_lineage(_class_lines(rows, counts, found.where("not sent"), classes, k), "llm-classes")
    table = _pair_counts(rows.where("not held_out"), np.arange(k), classes[units.end], k, _kind(k))
    share = (table.sum(axis=0) + 1) / (table.sum() + k)
    sums = table.sum(axis=1, keepdims=True)
    bigram = np.divide(table, sums, out=np.tile(share, (k, 1)), where=sums > 0)
    transition = np.log10(BIGRAM_SHARE * bigram + (1 - BIGRAM_SHARE) * share)
    per_class = table.sum(axis=0) + EMISSION_ADD * (kinds + 1)
    model = Model(units, classes, transition, np.log10(per_class), documents, int(total.n or 0) + documents, total.v + (documents > 0))
    return model, counts, rows


_ROWS = "rid bigint, doc_id bigint, held_out boolean, n_known bigint, base double, emit double, line binary, rest binary"
_CLASS_ROWS = "doc_id bigint, held_out boolean, n_known bigint, base double, emit double, line binary"


def _kind(k: int) -> np.dtype:
    """The smallest type that holds every class."""
    return np.min_scalar_type(k)


def _rows(units: Units):
    """Per text its line of units, the number of its sent words and the sums
    over them, and the hashes of its other words in their order. These stand
    in the line as the bits of their ending's unit inverted, below zero."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, rid = WordHasher(), TaskContext.get().partitionId() << 36
        base_known, emit_known = np.log10(units.n + 1), np.log10(units.n + EMISSION_ADD)
        for batch in slices(batches):
            words = find_words(batch.column("text"), lower=True)
            rows, hashes, row = batch.num_rows, hasher(words), row_of_word(words)
            at = _find(units.hashes, hashes)
            sent, rest = np.flatnonzero(at >= 0), np.flatnonzero(at < 0)
            line = np.empty(len(at), np.int32)
            line[sent] = units.unit[at[sent]]
            line[rest] = ~(UNIT_WORDS + _ending(Words(words.raw, words.start[rest], words.end[rest], words.first)))
            seen = np.bincount(row[sent], minlength=rows)
            base = np.bincount(row[sent], base_known[at[sent]], rows).astype(float)
            emit = np.bincount(row[sent], emit_known[at[sent]], rows).astype(float)
            ids = rid + np.arange(rows)
            rid += rows
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids), batch.column("doc_id"), batch.column("held_out"), pa.array(seen), pa.array(base), pa.array(emit), _stored(words.first, line),
                 _stored(np.r_[0, np.cumsum(np.diff(words.first) - seen)], hashes[rest].view(np.int64))], [c.split()[0] for c in _ROWS.split(", ")])

    return run


def _class_lines(rows: DataFrame, counts: DataFrame, own: DataFrame, classes: np.ndarray, k: int) -> DataFrame:
    """The stored rows with the sums over all their words, and lines of classes.
    Words that are not sent meet their counts, and the classes in ``own``, in a
    join; those with a class of their own are put in place in their lines."""
    kind = _kind(k)

    def others(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            line, n_words = _numbers(batch.column("line"), np.int32)
            place = np.flatnonzero(line < 0)
            row = np.repeat(np.arange(batch.num_rows), n_words)[place]
            yield pa.RecordBatch.from_arrays([pa.array(batch.column("rid").to_numpy()[row]), pa.array(place - (np.cumsum(n_words) - n_words)[row]),
                                              pa.array(_numbers(batch.column("rest"), np.int64)[0])], ["rid", "place", "word"])

    def as_classes(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            line, n_words = _numbers(batch.column("line"), np.int32)
            line = _stored(np.r_[0, np.cumsum(n_words)], classes[_unit(line)].astype(kind))
            yield batch.set_column(batch.schema.get_field_index("line"), "line", line)

    def put(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            line, n_words = _numbers(batch.column("line"), kind)
            first, line = np.r_[0, np.cumsum(n_words)], line.copy()
            code = batch.column("put").flatten().to_numpy()
            line[np.repeat(first[:-1], batch.column("puts").to_numpy()) + code // k] = code % k
            at = batch.schema.get_field_index("line")
            yield batch.set_column(at, "line", _stored(first, line)).select([c.split()[0] for c in _CLASS_ROWS.split(", ")])

    c = F.coalesce("c", F.lit(0))
    known = counts.select("word", F.col("n").alias("c")).join(own.select("word", "class"), "word", "left")
    sums = rows.select("rid", "line", "rest").mapInArrow(others, "rid bigint, place bigint, word bigint").join(known, "word", "left").groupBy("rid").agg(
        F.sum(F.log10(c + 1)).alias("more_base"), F.sum(F.log10(c + EMISSION_ADD)).alias("more_emit"), F.count("c").alias("more_known"),
        F.collect_list(F.col("place") * k + F.col("class")).alias("put"))
    texts = rows.drop("rest").mapInArrow(as_classes, _ROWS.rsplit(", ", 1)[0])
    zero = F.lit(0)
    put_in = F.coalesce("put", F.array().cast("array<bigint>"))
    return texts.join(sums, "rid", "left").select(
        "doc_id", "held_out", (F.col("n_known") + F.coalesce("more_known", zero)).alias("n_known"), (F.col("base") + F.coalesce("more_base", zero)).alias("base"),
        (F.col("emit") + F.coalesce("more_emit", zero)).alias("emit"), "line", put_in.alias("put"), F.size(put_in).alias("puts")).mapInArrow(put, _CLASS_ROWS)


def _score_rows(model: Model, kind):
    """The stored rows with their sums made scores."""
    documents, transition, emission_total = model.documents, model.transition, model.emission_total
    base_total, end = np.log10(model.tokens + model.distinct + 1), model.classes[model.units.end]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches, kind):
            line, n_words = _stream(batch.column("line"), end, kind)
            rows = batch.num_rows
            of_step = np.repeat(np.arange(rows), n_words + 1)
            score = np.bincount(of_step, transition[line[:-1], line[1:]] - emission_total[line[1:]], rows)
            score += batch.column("emit").to_numpy() + np.log10(documents + EMISSION_ADD)
            base = batch.column("base").to_numpy() + np.log10(documents + 1) - (n_words + 1) * base_total
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(n_words + 1),
                                              pa.array(batch.column("n_known").to_numpy() + (documents > 0)), pa.array(base), pa.array(score)],
                                             ["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"])

    return run


def score(docs: DataFrame, held_out, id_col: str = "doc_id", text_col: str = "text", classes: int = CLASSES) -> DataFrame:
    """Per row of ``docs``: doc_id, held_out, n_tokens, n_known, train_tokens,
    base_score (add-one unigrams) and score (the class model), both log10
    probabilities of the whole text.

    ``held_out`` is the column that keeps rows from training; NULL counts as
    true (so does a NULL id under a hash of it). NULL and empty texts are one
    end token. Repeated rows count, and come back, each. Without training rows
    all words are unknown and scores are those of the added counts."""
    src = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.coalesce(held_out, F.lit(True)).alias("held_out"),
                      F.col(text_col).cast("string").alias("text"))
    model, _, rows = _fit(src, classes)
    scored = rows.mapInArrow(_score_rows(model, _kind(classes)),
                             "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, base_score double, score double")
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(model.tokens).cast("bigint").alias("train_tokens"), "base_score", "score")
