"""Line dedup by site-relative frequency, in DataFrame functions only.

Rows are grouped by host. A line's frequency is the number of the host's pages
that hold it, divided by all pages of the host; lines above the ratio are
boilerplate and go. A host has fewer than (lines per page / ratio) such lines,
so they come back to the pages as one array per host, from a stored table
whose measured size lets Spark choose a broadcast or a join that it can split
on hot hosts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitflow.config import cut_lineage

RATIO = 0.05
MIN_PAGES = 3


def boilerplate_lines(docs: DataFrame, host_col: str = "source", text_col: str = "text",
                      ratio: float = RATIO, min_pages: int = MIN_PAGES, copies: bool = True) -> DataFrame:
    """(host, line_hash, n_pages, host_pages) of each line on more than
    ``ratio`` of its host's pages, and on ``min_pages`` pages at least (a host
    of one page repeats nothing). A page counts a line once. Without ``copies``
    pages of one host with equal texts are one page. Lines of white
    space alone are no lines here; NULL hosts are one host; NULL texts are
    pages without lines."""
    pages = docs.select(F.col(host_col).alias("host"), F.col(text_col).cast("string").alias("text"))
    pages = pages.withColumn("page", F.xxhash64("text"))
    n_pages = F.count("*") if copies else F.count_distinct("page")
    totals = pages.groupBy("host").agg(n_pages.alias("host_pages"))
    lines = F.array_distinct(F.filter(F.split("text", "\n"), lambda x: F.trim(x) != ""))
    found = (pages.select("host", "page", F.explode(lines).alias("line")).groupBy("host", F.xxhash64("line").alias("line_hash"))
             .agg(n_pages.alias("n_pages")).where(F.col("n_pages") >= min_pages))
    return found.alias("f").join(totals.alias("t"), F.expr("f.host <=> t.host")).where(
        F.col("n_pages") > F.lit(ratio) * F.col("host_pages")).select("f.host", "line_hash", "n_pages", "host_pages")


def _free_names(docs: DataFrame, *names: str) -> list[str]:
    """Column names that ``docs`` does not have."""
    taken = {c.lower() for c in docs.columns}
    out = []
    for name in names:
        while name in taken:
            name += "_"
        out.append(name)
    return out


def drop_boilerplate(docs: DataFrame, host_col: str = "source", text_col: str = "text", ratio: float = RATIO,
                     min_pages: int = MIN_PAGES, counts: tuple[str, str] | None = None, copies: bool = True) -> DataFrame:
    """``docs`` with the boilerplate lines of each host taken out of the text;
    all other lines keep their order, and all rows stay, so a page of
    boilerplate alone has ''. NULL texts stay NULL, repeated rows each come
    back, an empty table gives an empty one. Pages are rows: two rows of one id
    are two pages (the SQL twin, which counts ids, agrees where ids are distinct). ``counts`` names two further
    columns: the text's lines and the lines dropped; ``copies`` is as above."""
    found = boilerplate_lines(docs, host_col, text_col, ratio, min_pages, copies)
    host, known, lines, kept = _free_names(docs, "host", "boilerplate", "lines", "kept")
    per_host = cut_lineage(found.groupBy("host").agg(F.collect_set("line_hash").alias(known)).select(
        F.col("host").alias(host), known), "llm-lines")
    none = F.expr("cast(array() as array<bigint>)")
    joined = docs.join(per_host, docs[host_col].eqNullSafe(per_host[host]), "left").withColumn(
        lines, F.split(F.col(text_col).cast("string"), "\n"))
    drop = F.coalesce(known, none)
    joined = joined.withColumn(kept, F.when(F.size(drop) == 0, F.col(lines)).otherwise(
        F.filter(lines, lambda x: ~F.array_contains(drop, F.xxhash64(x)))))
    text = F.array_join(kept, "\n").alias(text_col)
    out = [text if c == text_col else F.col(c) for c in docs.columns]
    if counts:
        n, left = F.coalesce(F.size(lines), F.lit(0)), F.coalesce(F.size(kept), F.lit(0))
        total = F.when(F.col(lines).isNull(), 0).otherwise(n).cast("bigint")
        out += [total.alias(counts[0]), (total - F.when(F.col(kept).isNull(), 0).otherwise(left)).cast("bigint").alias(counts[1])]
    return joined.select(*out)
