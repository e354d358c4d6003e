"""Row predicates.

Every predicate takes an optional parameter; a parameter that is ``None`` or
``""`` means "no filter" and yields a literal TRUE that Catalyst folds away.
When the parameter is present, NULL data fails the test.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from visitflow.functions.expressions import is_present


def _absent(value) -> bool:
    return value is None or (isinstance(value, str) and value.strip() == "")


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def _as_list(value) -> list:
    if isinstance(value, str):
        return [v.strip() for v in value.split(",") if v.strip() != ""]
    return [v for v in value if not _absent(v)]


def between(col, low=None, high=None) -> Column:
    """low <= col <= high; absent bound = unbounded; NULL data fails."""
    c = _c(col)
    cond = c.isNotNull()
    if not _absent(low):
        cond = cond & (c >= F.lit(low))
    if not _absent(high):
        cond = cond & (c <= F.lit(high))
    if _absent(low) and _absent(high):
        return F.lit(True)
    return F.coalesce(cond, F.lit(False))


def in_values(col, values) -> Column:
    """F2, scalar data: col is one of ``values`` (list or comma text)."""
    if _absent(values):
        return F.lit(True)
    vals = _as_list(values)
    if not vals:
        return F.lit(True)
    return F.coalesce(_c(col).isin(vals), F.lit(False))


def any_in_list(list_col, values, element_type: str = "string") -> Column:
    """F2, list data: some element of the array column is in ``values``."""
    if _absent(values):
        return F.lit(True)
    vals = _as_list(values)
    if not vals:
        return F.lit(True)
    wanted = F.array(*[F.lit(v).cast(element_type) for v in vals])
    return F.coalesce(F.arrays_overlap(_c(list_col), wanted), F.lit(False))


def equals(col, value) -> Column:
    """col == value; absent value = no filter."""
    if _absent(value):
        return F.lit(True)
    return F.coalesce(_c(col) == F.lit(value), F.lit(False))


def has_product(col) -> Column:
    """product id present. Text ids also reject the word NULL in any case."""
    c = _c(col)
    return c.isNotNull() & (F.upper(F.trim(c.cast("string"))) != "NULL")


def present(col) -> Column:
    """not NULL and not blank."""
    return is_present(col)


# Default area tiers and their labels.
DEFAULT_AREA_TIERS: Mapping[str, Iterable[str]] = {
    "A级": ("华北", "华东"),
    "B级": ("华南", "华中"),
    "C级": ("西北", "西南"),
}
DEFAULT_AREA_OTHER = "D级"


def area_level(col, tiers: Mapping[str, Iterable[str]] = DEFAULT_AREA_TIERS,
               other: str = DEFAULT_AREA_OTHER) -> Column:
    """F8: CASE tier by area name, checked in the mapping's order."""
    c = _c(col)
    expr = None
    for label, areas in tiers.items():
        cond = c.isin(list(areas))
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return F.lit(other) if expr is None else expr.otherwise(F.lit(other))
