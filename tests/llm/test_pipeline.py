"""The pipeline's stages on their contract, and the SQL twin of line dedup."""

from __future__ import annotations

import corpus_pipeline
import __spark_entry__
from oracle_compare import compare
from visitflow.llm import toxicity
from visitflow.sources.tables import read_table

from llm_tables import docs_df, empty_docs

SMALL = "/root/testdata/sf0.01"


def test_stages_keep_columns_and_only_drop_rows(spark):
    docs = read_table(spark, SMALL, "documents")
    ids = None
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SMALL)
        assert out.columns == docs.columns, name
        docs = spark.createDataFrame(out.toPandas(), out.schema)
        now = {r.doc_id for r in docs.select("doc_id").collect()}
        assert ids is None or now <= ids
        ids = now
    labels = {r.doc_id: r.toxic for r in read_table(spark, SMALL, "labels").collect()}
    clean = [i for i, t in labels.items() if t == 0]
    assert sum(labels.get(i) == 1 for i in ids) < 0.2 * sum(labels.values())
    assert len(ids & set(clean)) > 0.8 * len(clean)
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SMALL)
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == ids


def test_stages_take_awkward_tables(spark):
    for docs in (docs_df(spark), empty_docs(spark)):
        for _, stage in corpus_pipeline.STAGES:
            stage(spark, docs, SMALL).collect()


def test_copies_in_one_source_keep_one_text(spark):
    """Four copies among twenty pages of a source lose its menu, not their own lines."""
    own = "\n".join(f"the page that was copied says this in line {k} alone" for k in range(5))
    texts = [f"menu of the site\n{own}"] * 4 + [f"menu of the site\npage {i} " + " ".join(f"x{i}y{k}" for k in range(30)) for i in range(16)]
    docs = spark.createDataFrame([(i, t, "site") for i, t in enumerate(texts)], "doc_id bigint, text string, source string")
    cut = corpus_pipeline.drop_site_lines(spark, docs, SMALL)
    assert [r.text for r in cut.orderBy("doc_id").limit(4).collect()] == [own] * 4
    kept = corpus_pipeline.drop_near_copies(spark, cut, SMALL).collect()
    assert sorted(r.doc_id for r in kept) == [0, *range(4, 20)] and {r.doc_id: r.text for r in kept}[0] == own


def test_all_queries_are_registered():
    names = list(__spark_entry__.queries())
    assert {f"op{n}" for n in range(1, 11)} <= {n.split("_")[0] for n in names} and "pipeline" in names


def test_line_dedup_equals_sql(spark):
    assert compare(spark, "op8_line_dedup", SMALL)["status"] == "ok"


def test_folds_follow_crc32(spark):
    rows = spark.range(50).select("id", toxicity.remainder("id", 5).alias("k")).collect()
    import zlib
    assert all(r.k == zlib.crc32(str(r.id).encode()) % 5 for r in rows)
