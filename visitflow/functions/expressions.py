"""Scalar column expressions.

All are built-in Spark expressions, so they run inside whole-stage codegen;
no Python worker is involved. ANSI mode is assumed on: parsing and casting use
the ``try_`` forms, which give NULL on bad input instead of failing the job.
"""

from __future__ import annotations

import re as _re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Text patterns of the visit log.
TIME_PATTERN = "yyyy-MM-dd H:m:s"      # unpadded hour, minute and second are accepted
PADDED_TIME_PATTERN = "yyyy-MM-dd HH:mm:ss"
DATE_PATTERN = "yyyy-MM-dd"
DAY_HOUR_PATTERN = "yyyy-MM-dd_HH"
COMPACT_DATE_PATTERN = "yyyyMMdd"


def _epoch() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def parse_time(text) -> Column:
    """X1: 'yyyy-MM-dd H:m:s' text (padded or not) -> TIMESTAMP_NTZ; bad -> NULL."""
    return F.try_to_timestamp(_c(text), F.lit(TIME_PATTERN)).cast("timestamp_ntz")


def seconds_between(start, end) -> Column:
    """Whole seconds from ``start`` to ``end`` (truncated toward zero)."""
    return F.timestamp_diff("SECOND", _c(start), _c(end))


def is_before(a, b) -> Column:
    """A < b."""
    return _c(a) < _c(b)


def is_after(a, b) -> Column:
    """A > b."""
    return _c(a) > _c(b)


def day_hour_key(ts) -> Column:
    """X3: 'yyyy-MM-dd_HH' key of a timestamp."""
    return F.date_format(_c(ts), DAY_HOUR_PATTERN)


def format_date(d) -> Column:
    """Date or timestamp -> 'yyyy-MM-dd'."""
    return F.date_format(_c(d), DATE_PATTERN)


def format_time(ts) -> Column:
    """Timestamp -> 'yyyy-MM-dd HH:mm:ss'."""
    return F.date_format(_c(ts), PADDED_TIME_PATTERN)


def millis_to_timestamp(ms) -> Column:
    """Epoch milliseconds -> TIMESTAMP_NTZ (UTC wall clock, zone independent)."""
    return F.timestamp_add("MILLISECOND", _c(ms), _epoch())


def timestamp_to_millis(ts) -> Column:
    """Inverse of ``millis_to_timestamp``: TIMESTAMP_NTZ -> epoch milliseconds."""
    return F.timestamp_diff("MILLISECOND", _epoch(), _c(ts))


def ntz_to_instant(ts) -> Column:
    """TIMESTAMP_NTZ wall clock -> TIMESTAMP instant with the same UTC wall
    clock, whatever the session time zone (for watermarks and windows)."""
    return F.timestamp_micros(F.timestamp_diff("MICROSECOND", _epoch(), _c(ts)))


def instant_to_ntz(ts) -> Column:
    """Inverse of ``ntz_to_instant``."""
    micros = F.unix_micros(_c(ts))
    return F.timestamp_add("MICROSECOND", micros, _epoch())


def compact_day(ts) -> Column:
    """X4: 'yyyyMMdd' text of a timestamp (the ad-click day key)."""
    return F.date_format(_c(ts), COMPACT_DATE_PATTERN)


def compact_day_to_date(text) -> Column:
    """X4: 'yyyyMMdd' -> DATE; bad -> NULL."""
    return F.try_to_timestamp(_c(text), F.lit(COMPACT_DATE_PATTERN)).cast("date")


def ratio_half_up(numerator, denominator, digits: int = 2) -> Column:
    """Numerator / denominator rounded HALF_UP to ``digits`` decimals.

    Exact integer arithmetic: floor((2 * 10^d * n + d) / (2 * d)) / 10^d for
    non-negative counts. A zero or NULL denominator gives NULL.
    """
    n, d = _c(numerator).cast("bigint"), _c(denominator).cast("bigint")
    scale = 10 ** digits
    top, bottom = n * (2 * scale) + d, d * 2
    # (top - top mod bottom) is an exact multiple of bottom: the division is exact.
    units = ((top - F.pmod(top, bottom)) / bottom).cast("bigint")
    return F.when(d > 0, units.cast("double") / F.lit(float(scale)))


def is_present(col) -> Column:
    """Not NULL and not blank."""
    c = _c(col)
    return c.isNotNull() & (F.trim(c) != "")


def trim_commas(col) -> Column:
    """Drop one leading and one trailing comma."""
    return F.regexp_replace(_c(col), r"^,|,$", "")


def pad2(col) -> Column:
    """Left-pad to two characters with '0'."""
    c = _c(col).cast("string")
    return F.when(F.length(c) < 2, F.lpad(c, 2, "0")).otherwise(c)


def id_list(col) -> Column:
    """X11: comma id text -> ARRAY<BIGINT>, blanks and non-numbers dropped."""
    parts = F.split(trim_commas(_c(col)), ",")
    ids = F.transform(F.filter(parts, lambda x: F.trim(x) != ""),
                      lambda x: F.trim(x).try_cast("bigint"))
    return F.filter(ids, lambda x: x.isNotNull())


def _kv_signs(pair_sep: str, kv_sep: str) -> list[tuple[str, str]]:
    """Each sign that has a meaning in 'k=v|k=v' text, and what is written for
    it in a value: '%' and two hexadecimal digits, the escape sign first."""
    return [(c, f"%{ord(c):02X}") for c in dict.fromkeys("%" + pair_sep + kv_sep)]


def escape_kv(col, pair_sep: str = "|", kv_sep: str = "=") -> Column:
    """A value as it is written into 'k=v|k=v' text."""
    out = _c(col)
    for sign, code in _kv_signs(pair_sep, kv_sep):
        out = F.replace(out, F.lit(sign), F.lit(code))
    return out


def unescape_kv(col, pair_sep: str = "|", kv_sep: str = "=") -> Column:
    """Inverse of ``escape_kv``."""
    out = _c(col)
    for sign, code in reversed(_kv_signs(pair_sep, kv_sep)):
        out = F.replace(out, F.lit(code), F.lit(sign))
    return out


def kv_field(col, name: str, pair_sep: str = "|", kv_sep: str = "=") -> Column:
    """The value of field ``name`` in 'k=v|k=v' text: the first occurrence,
    '' for an empty value, NULL when the field is absent. Duplicate keys and
    empty segments are tolerated (a map would reject duplicates). One regular
    expression per field: the capture includes ``name=``, so an absent field
    (empty capture) differs from an empty value. Escaped signs are restored."""
    c = _c(col)
    head = name + kv_sep
    pat = "(?:^|" + _re.escape(pair_sep) + ")(" + _re.escape(head) + "[^" + _re.escape(pair_sep) + "]*)"
    found = F.regexp_extract(c, pat, 1)
    return F.when(found != "", unescape_kv(F.substring(found, len(head) + 1, 1 << 30), pair_sep, kv_sep))


def map_to_kv_text(pairs: list[tuple[str, Column]], pair_sep: str = "|", kv_sep: str = "=") -> Column:
    """Columns -> 'k=v|k=v' text, NULL values written as empty; separators
    and the escape sign inside a value are escaped, so it loads back unchanged."""
    return F.concat_ws(pair_sep, *[
        F.concat(F.lit(k + kv_sep), F.coalesce(escape_kv(v.cast("string"), pair_sep, kv_sep), F.lit(""))) for k, v in pairs])


def concat_long_string(value, text, sep: str = ":") -> Column:
    """X12 / U1: '<long><sep><text>'."""
    return F.concat(_c(value).cast("string"), F.lit(sep), _c(text))
