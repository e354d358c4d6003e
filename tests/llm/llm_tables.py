"""Small tables with the awkward rows that every operator must take."""

from __future__ import annotations

LONG = " ".join(f"w{i % 977} x{i}" for i in range(30_000))

# (doc_id, text): NULLs, empty and white texts, repeated rows and ids, one very long text
AWKWARD = [(1, None), (2, ""), (3, " \t\n "), (4, "one"), (5, "same text in two rows of one id"), (5, "same text in two rows of one id"),
           (6, "same text in two rows of one id"), (None, "a row without an id"), (None, None), (7, LONG), (8, "é ß 漢字 \U0001F600 end")]


def docs_df(spark, rows=AWKWARD):
    """Documents with further columns, some named like the operators' own."""
    full = [(i, t, "en", None if k % 5 == 4 else f"src{k % 2}", None if t is None else len(t), k, "x") for k, (i, t) in enumerate(rows)]
    return spark.createDataFrame(full, "doc_id bigint, text string, lang string, source string, n_chars bigint, fp bigint, toxicity string")


def empty_docs(spark):
    return docs_df(spark, AWKWARD[:1]).where("false")
