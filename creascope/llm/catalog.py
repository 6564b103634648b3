"""One query per operator over its whole table, and SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from creascope.llm import (
    decontaminate, exact_dedup, hard_negatives, html_extract, language_id, line_dedup, minhash_dedup, mixing,
    packing, phrases, pii_surrogates, token_counts, toxicity)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return minhash_dedup.near_duplicates(table(spark, folder, "documents"))


def contaminations(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.contaminations(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def surrogates(spark: SparkSession, folder: str) -> DataFrame:
    return pii_surrogates.pseudonymised(table(spark, folder, "documents"))


def source_mix(spark: SparkSession, folder: str) -> DataFrame:
    sampled = mixing.sample_mix(table(spark, folder, "documents"))
    return sampled.select("doc_id", "mix_tokens", F.round("mix_probability", 6).alias("mix_probability"))


def main_texts(spark: SparkSession, folder: str) -> DataFrame:
    return html_extract.main_texts(table(spark, folder, "pages"))


def fuzzy_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Per document how many of its lines, and of their characters, are first occurrences."""
    lines = line_dedup.fuzzy_lines(table(spark, folder, "documents"))
    return lines.groupBy("doc_id").agg(
        F.count("*").alias("n_lines"), F.count_if("kept").alias("n_kept"),
        F.sum(F.when(F.col("kept"), F.col("n_chars")).otherwise(0)).alias("kept_chars"))


def exact_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.exact_duplicates(table(spark, folder, "documents"))


def toxicity_scores(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return toxicity.toxicity(docs, toxicity.fit_model(docs, table(spark, folder, "labels")))


def languages(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return language_id.languages(docs, language_id.fit_model(docs))


def token_totals(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.token_counts(table(spark, folder, "documents"))


def packed_documents(spark: SparkSession, folder: str) -> DataFrame:
    return packing.packed(table(spark, folder, "documents"))


def negatives(spark: SparkSession, folder: str) -> DataFrame:
    """Vectors in steps of 1/256, labels moved on where the id is divisible by 7, an anchor in 100 ids."""
    vectors = table(spark, folder, "embeddings").filter(
        F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))).select(
        "vec_id", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")).alias("label"),
        F.transform("embedding", lambda x: F.floor(x.cast("double") * 256)).alias("q"))
    return hard_negatives.hard_negatives(vectors, F.col("vec_id") % 100 == 0)


def collocations(spark: SparkSession, folder: str) -> DataFrame:
    return phrases.collocations(table(spark, folder, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_near_duplicates": near_duplicates,
    "op2_decontamination": contaminations,
    "op3_pii_surrogates": surrogates,
    "op4_source_mix": source_mix,
    "op5_main_text": main_texts,
    "op6_fuzzy_lines": fuzzy_lines,
    "op7_exact_duplicates": exact_duplicates,
    "op8_toxicity": toxicity_scores,
    "op9_language": languages,
    "op10_token_counts": token_totals,
    "op11_packing": packed_documents,
    "op12_hard_negatives": negatives,
    "op13_phrases": collocations,
}

WORDS = r"list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '')"
SHINGLES = """list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
  ELSE list_transform(generate_series(1, len(w) - 4), lambda i: array_to_string(w[i:i + 4], ' ')) END)"""

ORACLE: dict[str, str] = {
    "op1_near_duplicates": f"""
WITH RECURSIVE worded AS (SELECT doc_id, {WORDS} AS w FROM documents),
sets AS (SELECT doc_id, {SHINGLES} AS s FROM worded),
parts AS (SELECT doc_id, len(s) AS n, unnest(s) AS shingle FROM sets),
shared AS (
  SELECT a.doc_id AS x, b.doc_id AS y, any_value(a.n) AS nx, any_value(b.n) AS ny, count(*) AS common
  FROM parts a JOIN parts b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (SELECT x, y FROM shared WHERE 100 * common >= 85 * (nx + ny - common)),
reach AS (SELECT x, y FROM links UNION SELECT r.x, l.y FROM reach r JOIN links l ON l.x = r.y),
lowest AS (SELECT x, min(y) AS m FROM reach GROUP BY x)
SELECT s.doc_id, len(s.s) AS n_shingles, least(s.doc_id, coalesce(m, s.doc_id)) AS component_id,
  s.doc_id <= coalesce(m, s.doc_id) AS kept
FROM sets s LEFT JOIN lowest ON x = s.doc_id""",
    "op2_decontamination": f"""
WITH worded AS (SELECT doc_id, {WORDS} AS w FROM documents),
parts AS (SELECT doc_id, unnest({SHINGLES}) AS shingle FROM worded),
asked AS (SELECT item_id, {WORDS} AS w FROM benchmark),
wanted AS (SELECT item_id, {SHINGLES} AS s FROM asked),
pieces AS (SELECT item_id, len(s) AS n_item, unnest(s) AS shingle FROM wanted)
SELECT doc_id, item_id, count(*) AS n_shared, n_item
FROM parts JOIN pieces USING (shingle) GROUP BY doc_id, item_id, n_item
HAVING 100 * count(*) >= 80 * n_item""",
    "op4_source_mix": mixing.mix_sql(),
    "op7_exact_duplicates": """
WITH normal AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
  FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
  doc_id = max(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
FROM normal""",
    "op12_hard_negatives": """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, a.label = r.label AS same, r.vec_id, CAST(list_inner_product(a.q, r.q) AS BIGINT) AS score
  FROM v a, v r WHERE a.vec_id % 100 = 0 AND r.vec_id <> a.vec_id),
positive AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
negative AS (
  SELECT anchor_id, positive_id, positive_score, vec_id AS negative_id, score AS negative_score,
    row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS rank
  FROM positive JOIN scored USING (anchor_id)
  WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM negative WHERE rank <= 5""",
    "op13_phrases": f"""
WITH texts AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
worded AS (
  SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM texts),
grams AS (
  SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase
  FROM (SELECT lang, w, k, unnest(generate_series(1, len(w) - k + 1)) AS i
        FROM worded, (SELECT unnest([1, 2, 3, 4, 5]) AS k) WHERE len(w) >= k)),
counts AS (SELECT lang, k, phrase, count(*) AS f FROM grams GROUP BY ALL HAVING count(*) >= 100),
totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM worded GROUP BY lang),
cuts AS (
  SELECT lang, k AS size, phrase, f AS a, string_split(phrase, ' ') AS w, unnest(generate_series(1, k - 1)) AS cut
  FROM counts WHERE k > 1),
parts AS (
  SELECT lang, size, phrase, a, cut, array_to_string(w[1:cut], ' ') AS left_part,
    array_to_string(w[cut + 1:], ' ') AS right_part FROM cuts),
scored AS (
  SELECT p.*, x.f AS l, y.f AS r, n, CAST((1000::HUGEINT * a * n) // (x.f::HUGEINT * y.f) AS BIGINT) AS score
  FROM parts p JOIN counts x ON x.lang = p.lang AND x.phrase = left_part
  JOIN counts y ON y.lang = p.lang AND y.phrase = right_part JOIN totals t ON t.lang = p.lang),
weakest AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
inner_phrases AS (
  SELECT lang, f, array_to_string(w[i:i + m - 1], ' ') AS phrase
  FROM (SELECT lang, f, w, m, unnest(generate_series(1, len(w) - m + 1)) AS i
        FROM (SELECT lang, f, string_split(phrase, ' ') AS w, unnest(generate_series(2, k - 1)) AS m
              FROM counts WHERE k > 2))),
alone AS (
  SELECT w.* FROM weakest w WHERE NOT EXISTS (
    SELECT 1 FROM inner_phrases i WHERE i.lang = w.lang AND i.phrase = w.phrase AND 100 * i.f >= 100 * w.a))
SELECT lang, CAST(rank AS BIGINT) AS rank, phrase, a, l, r, n, score FROM (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM alone)
WHERE rank <= 2000""",
}
