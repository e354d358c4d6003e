"""'k=v|k=v' text records.

Exported aggregates used to travel as flattened text. Here typed columns are
the data model; text exists only at the edges: ``export_kv`` writes it,
``parse_kv`` loads such text back into typed columns. Both are per-row
built-in expressions (``concat_ws`` / ``regexp_extract``), no Python.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitflow.functions.expressions import kv_field, map_to_kv_text


def export_kv(df: DataFrame, key: str, fields: Sequence[str], out_col: str = "record") -> DataFrame:
    """(key, 'f1=v1|f2=v2|...'); NULL values are written empty."""
    return df.select(key, map_to_kv_text([(f, F.col(f)) for f in fields]).alias(out_col))


def parse_kv(df: DataFrame, text_col: str, fields: Mapping[str, str], keep: Sequence[str] = ()) -> DataFrame:
    """Typed columns from 'k=v|...' text.

    ``fields`` maps field name -> Spark SQL type. A missing field is NULL, an
    empty value is '' for strings and NULL for other types (``try_cast``); a
    repeated key yields its first value.
    """
    cols = [F.col(k) for k in keep]
    for name, typ in fields.items():
        raw = kv_field(F.col(text_col), name)
        cols.append((raw if typ == "string" else raw.try_cast(typ)).alias(name))
    return df.select(*cols)
