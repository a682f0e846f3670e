"""A training corpus from raw documents: five stages, each an operator over all that the stage before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from asofmill.llm import decontaminate, langid, line_dedup, mixing, simhash
from asofmill.llm.common import quoted, stage, table

#: Least probability of the predicted language.
SURE = 0.35
#: Differing bits of a candidate for near-dedup, and the trees that look for them: at any size of the table 0.96 of all pairs of similarity 0.8 share a shard, more of nearer ones.
NEAR_BITS, FOREST = 56, simhash.Forest(trees=10, bits=14)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told: texts without letters (null and empty ones too), and those of no clear language, go.

    Texts are read whole, long ones too. Each row is judged by its text alone, so repeated rows go or stay together, whatever their ids, null ones
    included. Of equal probabilities the first language counts. An empty table stays empty; all columns are kept.
    """
    found = langid.language_id(docs, "__lang", "__sure")
    return found.filter((F.col("__lang") != langid.UNDETERMINED) & (F.col("__sure") >= SURE)).select(*quoted(docs.columns))


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated lines go (exact copies of any length but blank ones; near-copies up to an edit for every 16 characters, three at most), and documents of which nothing is left; n_chars follows the text.

    The first of a group of lines stays: by doc_id, null ids last, then by text and line. Rows alike in id and text are one document
    written twice: both keep what one does. Null texts stay null, texts without a repeated line stay as they are, empty ones included; very long
    lines and texts are compared whole. An empty table stays empty.
    """
    found = line_dedup.dedup_lines(docs, max_edits=3, exact=1, per_edit=16)
    found = found.filter((F.col("n_removed") == 0) | F.col("text").rlike(r"[^\s]"))
    if "n_chars" in docs.columns:
        found = found.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.char_length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return found.select(*quoted(docs.columns))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays: links are of Jaccard similarity 0.8 or more between their different five-word shingles.

    Candidates are fingerprints of 256 bits that differ in ``NEAR_BITS`` at most (pairs of similarity 0.8
    differ in 39 +- 6) and share a shard of ``FOREST``. Texts without words (null and empty ones too) are one group. Of
    each group, repeated rows included, the row with the smallest doc_id stays (null ids last; ties by text), once. Long texts are read whole; an
    empty table stays empty; all columns are kept.
    """
    return simhash.keep_one(docs, shingle=5, max_bits=NEAR_BITS, size=4, repeats=False, forest=FOREST, similarity=0.8)


def decontaminate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of the benchmark, or one like it with other numbers and names, go.

    Items of a word or two, which any text may hold, remove nothing. Null and empty texts stay, whatever their ids; repeated rows go or stay
    together; texts are read whole. With an empty benchmark all stays, and an empty table stays empty.
    """
    return decontaminate.remove_contaminated(docs, table(spark, sf_dir, "benchmark"), exact=True)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the mix takes, and how often (copies).

    A null source is a source of its own, a null or empty text has size 0; texts are measured whole. Rows alike in id
    and text are taken alike. Ties between documents go by the hash of id and text, so reruns agree. An empty table stays empty.
    """
    return mixing.take(docs, weights=(5.0, 2.0, 1.0), share=1.0, most=3.0)


STAGES = [("language_id", language_id), ("line_dedup", line_dedup_stage), ("near_dedup", near_dedup), ("decontaminate", decontaminate_stage), ("mix", mix)]

#: SQL has no recurrent network; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; what each keeps is written to the shared folder before the next one reads it."""
    docs = table(spark, sf_dir, "documents")
    for name, apply in STAGES[:-1]:
        docs = stage(apply(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
