"""From raw documents to packed training sequences, one operator a stage.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes it to the shared folder and hands the reread
table to the next stage. All but the last return the columns of the table they got, extra ones included, whatever their names.

Every stage takes null or empty texts, null ids, repeated rows and an empty table (which gives an empty result with the same columns).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickframe.llm import exact_dedup, langid, mixing, ngram_join, packing
from tickframe.llm.common import stored, table

# Documents whose best language is less than this part of the way from chance (1 / languages) to certainty are rejected, as are those
# without letters; the bar is lower where the network is less sure of a language's own sample (langid.rejection_level).
LANGUAGE_MARGIN = 0.5


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents whose language is identified. Null texts and texts without letters go; equal texts have equal fates; a table without
    a labelled document keeps nothing."""
    return langid.keep_identified(docs, margin=LANGUAGE_MARGIN)


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the smallest id of every normalised text, one row where that id comes twice with it; null counts as empty, null ids come last."""
    return exact_dedup.drop_exact(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the smallest id of every component of near copies (five-word shingles, Jaccard 0.8 or more). Texts without words
    are linked with nothing and stay; of rows that share an id and a component one stays."""
    return ngram_join.drop_near(docs, k=5, num=80, den=100)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Draws the sources to their target weights: a document comes as often as the mix takes it, in queue order.
    Documents without words have size 0 and finish first; a null source is a source of its own, last in order; ties go by a hash of the id."""
    return mixing.mixed_stream(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of power-of-two length. A null or empty text gives its end id alone; repeated rows give pieces of their own."""
    out = packing.pack(docs)
    return out.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "bucket", "ids")


STAGES = [("language_id", language_id), ("exact_dedup", exact_duplicates), ("near_dedup", near_duplicates), ("source_mix", source_mix), ("packing", packed)]

# SQL can't express the trained network of the first stage; tests hold the rows against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
