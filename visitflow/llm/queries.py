"""The thirteen operators as registered queries, over whole tables with production
parameters, and the DuckDB SQL of those that SQL can express."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from visitflow.llm import (brown_lm, decontaminate, fingerprints, html_extract, line_dedup, packing, phrases, pivot_search, secrets, simhash,
                           substring_dedup, toxicity, whitening)
from visitflow.sources.tables import read_table


def _spans_text(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every text of ``documents``."""
    found = secrets.scan(read_table(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint")
    base = F.filter("spans", lambda s: s["kind"].isin(*secrets.BASE_KINDS))
    return found.select("doc_id", *[count(k).alias(f"n_{k}") for k in secrets.BASE_KINDS],
                        F.sha2(_spans_text(base), 256).alias("base_sha256"), _spans_text(F.col("spans")).alias("spans"))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of ``documents`` left after removal of repeated passages."""
    found = substring_dedup.dedup_substrings(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"), "repeats")


def op3_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of ``documents``."""
    found = simhash.near_duplicates(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every text of ``documents``, learned from four folds of ``labels``."""
    docs = read_table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, read_table(spark, sf_dir, "labels"), folds=5, held_out=0)
    return toxicity.score(docs, model).select(
        "doc_id", F.coalesce(toxicity.remainder("doc_id", 5) == 0, F.lit(True)).alias("held_out"), F.col("toxicity").alias("score"),
        (F.col("toxicity") >= 0.5).cast("int").alias("predicted"))


def op5_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log probabilities of every text of ``documents``, learned from six of seven folds."""
    return brown_lm.score(read_table(spark, sf_dir, "documents"), toxicity.remainder("doc_id", 7) == 2)


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents`` packed into sequences of 1024 tokens."""
    return packing.pack(packing.token_pieces(read_table(spark, sf_dir, "documents")))


def op7_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sketches of every text of ``documents`` and of its edited text, and
    their likeness to each other and to the next document's."""
    ranges = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = fingerprints.with_next(read_table(spark, sf_dir, "documents"), ranges)
    n, tail = F.char_length("text"), F.floor(F.char_length("text") / 4).cast("int")
    rows = rows.withColumn("edited", F.concat(F.expr("substring(text, 1, char_length(text) - cast(floor(char_length(text) / 4) as int))"),
                                              F.substring("next_text", F.lit(1), tail)))
    rows = rows.withColumn("edited_sketch", fingerprints.sketch(F.col("edited")))
    mine, edited, following = F.col("sketch"), F.col("edited_sketch"), F.col("next_sketch")
    return rows.select("doc_id", n.cast("bigint").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
                       fingerprints.as_text(mine).alias("fingerprint"), fingerprints.as_text(edited).alias("edited_fingerprint"),
                       fingerprints.resemblance(mine, edited).alias("near_edited"), fingerprints.resemblance(mine, following).alias("near_next"),
                       fingerprints.distinct_count(mine).alias("n_shingles"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` without the boilerplate lines of their source."""
    found = line_dedup.drop_boilerplate(read_table(spark, sf_dir, "documents"), counts=("n_lines", "n_dropped"))
    return found.select("doc_id", "source", "n_lines", "n_dropped", "text")


def op9_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overlaps of ``documents`` with ``benchmark``, one row per document and
    class of equal items, with the ids of all items of the class."""
    benchmark = read_table(spark, sf_dir, "benchmark")
    found = decontaminate.overlaps(read_table(spark, sf_dir, "documents"), benchmark)
    members = decontaminate.item_classes(benchmark).groupBy(F.col("class_id").alias("item_id")).agg(F.array_sort(F.collect_list("item_id")).alias("item_ids"))
    return found.join(members, "item_id", "left").select(*found.columns, "item_ids")


def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every row of ``pages``."""
    return html_extract.extract(read_table(spark, sf_dir, "pages")).withColumn("n_chars", F.char_length("text").cast("bigint"))


def op11_phrase_collocation_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each language's first 2,000 collocations of ``documents``."""
    return phrases.collocations(read_table(spark, sf_dir, "documents"))


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector of ``embeddings`` on the first 32 whitened components."""
    vectors = read_table(spark, sf_dir, "embeddings")
    model = whitening.fit(vectors)
    error = None if model is None else whitening.identity_error(vectors, model)
    return whitening.whiten(vectors, model).withColumn("identity_error", F.lit(error).cast("double"))


def op13_exact_top_k_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best inner products of every fiftieth vector of ``embeddings``."""
    return pivot_search.top_k(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


QUERIES = {f.__name__: f for f in (
    op1_secret_scan, op2_substring_dedup, op3_simhash_near_dedup, op4_toxicity, op5_lm_scoring, op6_best_fit_packing,
    op7_document_fingerprints, op8_line_dedup, op9_benchmark_decontamination, op10_html_extraction,
    op11_phrase_collocation_mining, op12_embedding_whitening, op13_exact_top_k_search)}

ORACLE = {
    "op8_line_dedup": f"""
WITH lines AS (
  SELECT d.doc_id, d.source, u.line, u.pos
  FROM documents d, LATERAL (SELECT unnest(string_split(d.text, chr(10))) AS line,
                                    unnest(range(1, len(string_split(d.text, chr(10))) + 1)) AS pos) u),
hosts AS (SELECT source, count(*) AS host_pages FROM documents GROUP BY source),
found AS (
  SELECT l.source, l.line
  FROM lines l JOIN hosts h ON l.source IS NOT DISTINCT FROM h.source
  WHERE trim(l.line) <> ''
  GROUP BY l.source, l.line, h.host_pages
  HAVING count(DISTINCT l.doc_id) >= {line_dedup.MIN_PAGES} AND count(DISTINCT l.doc_id) > {line_dedup.RATIO} * h.host_pages)
SELECT l.doc_id, l.source, count(*) AS n_lines, count(*) FILTER (f.line IS NOT NULL) AS n_dropped,
       coalesce(string_agg(l.line, chr(10) ORDER BY l.pos) FILTER (f.line IS NULL), '') AS text
FROM lines l LEFT JOIN found f ON l.source IS NOT DISTINCT FROM f.source AND l.line = f.line
GROUP BY l.doc_id, l.source""",
    "op11_phrase_collocation_mining": f"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, row_number() OVER () AS piece, regexp_extract_all(u.p, '[^ \\t]+') AS w
  FROM (SELECT lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                               '[.,;:!?\\x0A-\\x0D]')) AS p FROM documents) u),
words AS (SELECT lang, piece, unnest(w) AS w1, unnest(range(len(w))) AS pos FROM pieces),
runs AS (SELECT lang, w1, lead(w1, 1) OVER p AS w2, lead(w1, 2) OVER p AS w3 FROM words WINDOW p AS (PARTITION BY piece ORDER BY pos)),
ones AS (SELECT lang, w1, count(*) AS f FROM runs GROUP BY ALL),
twos AS (SELECT lang, w1, w2, count(*) AS f FROM runs WHERE w2 IS NOT NULL GROUP BY ALL HAVING count(*) >= {phrases.MIN_COUNT}),
threes AS (SELECT lang, w1, w2, w3, count(*) AS f FROM runs WHERE w3 IS NOT NULL GROUP BY ALL HAVING count(*) >= {phrases.MIN_COUNT}),
totals AS (SELECT lang, sum(f)::BIGINT AS n FROM ones GROUP BY lang),
longer AS (
  SELECT lang, w1, w2, max(f) AS f FROM (SELECT lang, w1, w2, f FROM threes UNION ALL SELECT lang, w2, w3, f FROM threes) GROUP BY ALL),
pairs AS (
  SELECT t.lang, t.w1 || ' ' || t.w2 AS phrase, t.f AS a, x.f AS l, y.f AS r
  FROM twos t JOIN ones x ON x.lang = t.lang AND x.w1 = t.w1 JOIN ones y ON y.lang = t.lang AND y.w1 = t.w2
       LEFT JOIN longer g ON g.lang = t.lang AND g.w1 = t.w1 AND g.w2 = t.w2
  WHERE g.f IS NULL OR {phrases.COVER[1]} * g.f < {phrases.COVER[0]} * t.f),
cuts AS (
  SELECT lang, phrase, a, l, r, 1 AS k FROM pairs
  UNION ALL
  SELECT t.lang, t.w1 || ' ' || t.w2 || ' ' || t.w3, t.f, x.f, y.f, 1
  FROM threes t JOIN ones x ON x.lang = t.lang AND x.w1 = t.w1 JOIN twos y ON y.lang = t.lang AND y.w1 = t.w2 AND y.w2 = t.w3
  UNION ALL
  SELECT t.lang, t.w1 || ' ' || t.w2 || ' ' || t.w3, t.f, x.f, y.f, 2
  FROM threes t JOIN twos x ON x.lang = t.lang AND x.w1 = t.w1 AND x.w2 = t.w2 JOIN ones y ON y.lang = t.lang AND y.w1 = t.w3),
scored AS (SELECT *, ((1000000::HUGEINT * a * a) // (l::HUGEINT * r))::BIGINT AS score FROM cuts),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1)
SELECT b.lang, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank, phrase, a, l, r, n, score
FROM best b JOIN totals t ON t.lang = b.lang
QUALIFY rank <= {phrases.TOP}""",
    "op13_exact_top_k_search": """
WITH usable AS (
  SELECT row_number() OVER () AS row, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.row, q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
  FROM usable q JOIN usable c ON c.row <> q.row AND len(c.v) = len(q.v)
  WHERE q.vec_id % 50 = 0)
SELECT query_id, row_number() OVER (PARTITION BY row ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score
FROM scored QUALIFY rank <= 5""",
}
