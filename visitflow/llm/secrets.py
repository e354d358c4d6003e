"""Secrets: keyword prefilter, anchored patterns near hits, embedded checksums.

One Aho-Corasick automaton finds the keywords of all kinds in a lower-cased
text; a kind's pattern is tried only where one of its keywords begins. Runs of
hexadecimal digits have no keyword, so all strings of four digits are theirs:
the first one found in a run is the run's beginning. Tokens that carry a
checksum of their own count only if it agrees.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterable, Iterator
from itertools import product
from typing import NamedTuple

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class Kind(NamedTuple):
    name: str
    keywords: tuple[str, ...]
    pattern: re.Pattern
    passes: Callable[[re.Match], bool]


BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"


def base62_crc32(text: str) -> str:
    """CRC-32 of a text in six base-62 digits, as issuers append it to tokens."""
    n, out = zlib.crc32(text.encode()), ""
    for _ in range(6):
        n, d = divmod(n, 62)
        out = BASE62[d] + out
    return out


def _checksum(m: re.Match) -> bool:
    body = m[2]
    return len(body) == 36 and base62_crc32(body[:30]) == body[30:]


# The patterns of the published formats. Kinds in the order in
# which spans that begin together are listed.
KINDS = (
    Kind("assign", ("password", "passwd", "secret", "token", "apikey", "api_key"),
         re.compile(r"(?i:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.A),
         lambda m: len(m[2]) >= 6),
    Kind("access", ("akia",), re.compile(r"AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 20),
    Kind("hex", tuple(map("".join, product("0123456789abcdef", repeat=4))), re.compile(r"[0-9a-f]+"), lambda m: len(m[0]) >= 24),
    Kind("token", ("ghp_", "gho_", "ghu_", "ghs_", "ghr_", "npm_"), re.compile(r"(gh[pousr]|npm)_([A-Za-z0-9]+)"), _checksum),
)
BASE_KINDS = ("assign", "access", "hex")
SPANS = "array<struct<kind: string, start: int, end: int>>"


def build_automaton(kinds: tuple[Kind, ...] = KINDS) -> ahocorasick.Automaton:
    out = ahocorasick.Automaton()
    for k, kind in enumerate(kinds):
        for word in kind.keywords:
            out.add_word(word, (k, len(word)))
    out.make_automaton()
    return out


def lower_same_length(text: str) -> str:
    low = text.lower()
    return low if len(low) == len(text) else "".join(c.lower() if c.isascii() else c for c in text)


def find_secrets(text: str, automaton: ahocorasick.Automaton, kinds: tuple[Kind, ...] = KINDS) -> list[tuple[str, int, int]]:
    """(kind, start, end) by start, then kind as listed; code points, end
    exclusive. Per kind matches are leftmost and do not overlap; a match that
    fails its test still takes its place."""
    taken = [0] * len(kinds)
    out = []
    for last, (k, n) in automaton.iter(lower_same_length(text)):
        start = last - n + 1
        if start >= taken[k]:
            m = kinds[k].pattern.match(text, start)
            if m:
                taken[k] = m.end()
                if kinds[k].passes(m):
                    out.append((start, k, m.end()))
    return [(kinds[k].name, start, end) for start, k, end in sorted(out)]


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", kinds: tuple[Kind, ...] = KINDS) -> DataFrame:
    """(doc_id, spans) per row of ``docs``, ids as they are. NULL and empty
    texts have no spans; whole texts are scanned; repeated rows each come back."""
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    names = kinds if kinds is not KINDS else None

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        use = names or KINDS
        automaton = build_automaton(use)
        span = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])
        for batch in batches:
            found = [[dict(zip(("kind", "start", "end"), s)) for s in find_secrets(t.as_py() or "", automaton, use)]
                     for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(span))], ["doc_id", "spans"])

    kind = src.schema["doc_id"].dataType.simpleString()
    return src.mapInArrow(run, f"doc_id {kind}, spans {SPANS}")
