"""The registered queries of the training-data operators, and DuckDB SQL for those that SQL expresses."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, clustering, decontaminate, langid, license_scan, line_dedup, mining, mixing, packing, quality, simhash, substring, token_counts
from .common import table


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=4, max_bits=4)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op6_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"), weights=(5.0, 2.0, 1.0), share=1.0, most=3.0)


def op8_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring.remove_repeats(table(spark, sf_dir, "documents"), window=35)
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.coalesce(langid.fold("doc_id", 3) == 1, F.lit(False))
    return langid.language_id(docs).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.histogram(token_counts.token_lengths(table(spark, sf_dir, "documents")))


def op9_license(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), exact=True)
    return found.drop("row_a", "row_b")


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"), max_edits=3, per_edit=16, least=16, exact=1)
    return found.select("doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def op1_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


#: A public byte-level tokenizer; where its folder lies is a parameter of ``packing.pack``.
TOKENIZER = "/opt/tokenizers/byte_bpe_50k.json"


def op11_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), TOKENIZER, length=2048)


def op12_cluster(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clustering.cluster(table(spark, sf_dir, "embeddings"), k=40, rounds=5, width=64, scale=256, salt="2")


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.col("label").cast("long")
    vectors = table(spark, sf_dir, "embeddings").withColumn("label", F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label))
    return mining.hard_negatives(vectors, F.col("vec_id") % 100 == 0, positives=5, negatives=5, low=80, high=100, whole=100, scale=256)


QUERIES = {
    "op1_ann": op1_ann,
    "op2_line_dedup": op2_line_dedup,
    "op3_token_counts": op3_token_counts,
    "op4_decontaminate": op4_decontaminate,
    "op5_simhash": op5_simhash,
    "op6_mix": op6_mix,
    "op7_quality": op7_quality,
    "op8_substring": op8_substring,
    "op9_license": op9_license,
    "op10_language_id": op10_language_id,
    "op11_pack": op11_pack,
    "op12_cluster": op12_cluster,
    "op13_hard_negatives": op13_hard_negatives,
}

# Letters of two bytes in the tables. DuckDB counts edits in bytes, so its SQL puts a control character in the place of each.
TWO_BYTE_LETTERS = "ÄÇÈÉÊÍÑÓÖÜßäçèéêíñóöü"
ONE_BYTE = [x for x in range(1, 32) if x not in range(9, 14)]

ORACLES = {
    "op2_line_dedup": rf"""
WITH RECURSIVE split AS (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents),
lines AS (
  SELECT doc_id, no, trim(parts[no + 1], ' ' || chr(9) || chr(11) || chr(12) || chr(13)) AS line
  FROM (SELECT doc_id, parts, unnest(range(0, len(parts))) AS no FROM split)),
known AS (
  SELECT line, length(line) AS n, row_number() OVER (ORDER BY line) AS id,
         translate(line, '{TWO_BYTE_LETTERS}', {" || ".join(f"chr({x})" for x in ONE_BYTE[: len(TWO_BYTE_LETTERS)])}) AS plain
  FROM (SELECT DISTINCT line FROM lines WHERE length(line) >= 1)),
compared AS (SELECT * FROM known WHERE n >= 16),
numbers AS (SELECT i FROM range(1, 5) t(i)),
held AS (
  SELECT id, n, i, substr(plain, CAST(n * (i - 1) // 4 + 1 AS BIGINT), CAST(n * i // 4 - n * (i - 1) // 4 AS BIGINT)) AS part FROM compared, numbers),
probes AS (
  SELECT id, n - less AS m, i, (n - less) * (i - 1) // 4 + 1 + shift AS start, (n - less) * i // 4 - (n - less) * (i - 1) // 4 AS size, plain
  FROM compared, numbers, range(0, 4) a(less), range(-3, 4) b(shift)),
candidates AS (
  SELECT DISTINCT p.id AS u, h.id AS v
  FROM probes p JOIN held h ON h.n = p.m AND h.i = p.i AND h.part = substr(p.plain, CAST(p.start AS BIGINT), CAST(p.size AS BIGINT))
  WHERE p.start >= 1 AND p.id <> h.id),
links AS (
  SELECT c.u, c.v FROM candidates c JOIN known a ON a.id = c.u JOIN known b ON b.id = c.v
  WHERE levenshtein(a.plain, b.plain) <= greatest(1, least(3, a.n // 16, b.n // 16))),
both_ways AS (SELECT u, v FROM links UNION SELECT v, u FROM links),
reach AS (SELECT id, id AS other FROM known UNION SELECT r.id, l.v FROM reach r JOIN both_ways l ON r.other = l.u),
groups AS (SELECT id, min(other) AS root FROM reach GROUP BY id),
placed AS (
  SELECT l.doc_id, l.no, row_number() OVER (PARTITION BY g.root ORDER BY l.doc_id, l.no) AS nth
  FROM lines l JOIN known k ON k.line = l.line JOIN groups g ON g.id = k.id),
gone AS (SELECT doc_id, list(no) AS nos FROM placed WHERE nth > 1 GROUP BY doc_id)
SELECT s.doc_id, CAST(coalesce(len(parts), 0) AS BIGINT) AS n_lines, CAST(coalesce(len(nos), 0) AS BIGINT) AS n_removed,
       sha256(array_to_string(list_filter(parts, lambda x, i: NOT list_contains(coalesce(nos, []), i - 1)), chr(10))) AS kept_sha256
FROM split s LEFT JOIN gone g ON s.doc_id = g.doc_id
""",
    "op9_license": license_scan.oracle(),
    "op12_cluster": clustering.oracle(),
    "op13_hard_negatives": mining.oracle(),
    "op6_mix": r"""
WITH sized AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         substr(md5(coalesce(CAST(doc_id AS VARCHAR), 't' || text, '')), 1, 15) AS hash
  FROM documents),
by_source AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS rank FROM sized GROUP BY source),
weighed AS (SELECT *, CASE (rank - 1) % 3 WHEN 0 THEN 5e0 WHEN 1 THEN 2e0 ELSE 1e0 END AS weight, source_size * 3e0 AS lim FROM by_source),
levels AS (
  SELECT *, CAST(sum(source_size) OVER () AS DOUBLE) AS total, sum(weight) OVER () AS weights,
         coalesce(sum(lim) OVER w, 0e0) AS lim_before, coalesce(sum(weight) OVER w, 0e0) AS weight_before
  FROM weighed WINDOW w AS (ORDER BY lim / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
filled AS (SELECT *, (total - lim_before) * weight > lim * (weights - weight_before) AS is_full FROM levels),
plan AS (
  SELECT source, source_size,
         CASE WHEN is_full THEN lim ELSE (total - coalesce(sum(CASE WHEN is_full THEN lim END) OVER (), 0e0)) * weight
              / sum(CASE WHEN NOT is_full THEN weight END) OVER () END AS target
  FROM filled),
due AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0e0 END AS whole FROM plan),
run AS (
  SELECT s.doc_id, s.size, d.source_size, d.target, d.whole, d.target - d.whole * d.source_size AS rest,
         sum(s.size) OVER (PARTITION BY s.source ORDER BY s.hash) AS upto
  FROM sized s JOIN due d ON s.source IS NOT DISTINCT FROM d.source),
taken AS (
  SELECT doc_id, size, source_size, target,
         CAST(whole + CASE WHEN rest > 0 AND source_size > 0 AND upto <= rest THEN 1 ELSE 0 END AS INT) AS copies FROM run)
SELECT doc_id, size, source_size, target, CAST(copies * size AS BIGINT) AS taken, copies FROM taken
""",
}
