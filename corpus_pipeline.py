"""Corpus pipeline: toxicity, line dedup, near dedup, decontamination, packing.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before
kept. Stages but the last return the columns of ``docs``; the last returns the
packed sequences of what is left. NULLs, repeated rows and empty tables follow
each operator's own rules.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from visitflow.config import cut_lineage
from visitflow.llm import decontaminate, line_dedup, packing, simhash, toxicity
from visitflow.sources.tables import read_table


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows scored below one half; the network learns from the labelled rows of
    the input. Rows with NULL or empty text have a score like any other."""
    model = toxicity.fit(docs, read_table(spark, sf_dir, "labels"), held_out=-1)
    return toxicity.filter_toxic(docs, model)


def drop_site_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, without the boilerplate lines of their source; n_chars follows
    the text. Equal texts of a source are one page here, so copies keep their
    lines for the near dedup to choose among."""
    out = line_dedup.drop_boilerplate(docs, copies=False)
    return out.withColumn("n_chars", F.char_length("text").cast("bigint")) if "n_chars" in docs.columns else out


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each near-duplicate group: the smallest doc_id."""
    return simhash.keep_first(docs)


def drop_benchmark_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that overlap no benchmark item."""
    return decontaminate.drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece with its sequence and offset."""
    return packing.pack(packing.token_pieces(docs))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", reject_toxic),
    ("line_dedup", drop_site_lines),
    ("simhash_near_dedup", drop_near_copies),
    ("benchmark_decontamination", drop_benchmark_copies),
    ("best_fit_packing", pack_sequences),
]

# The first stage is a trained network, so no SQL gives run()'s rows.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = cut_lineage(docs, f"llm-{name}")
    return docs
