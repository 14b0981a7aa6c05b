"""A training corpus from ``documents``: rules, toxicity, near-duplicates, passages, packing.

Every stage takes ``(spark, docs, sf_dir)`` and works on all rows that the
stage before it kept; its result is written as Parquet and read again as the
next one's input.  All but the last return the columns of ``documents``.

Defined results: those of the operators.  A row without an id is linked with
nothing and stays; rows of one id are one document to the near-duplicates, so
all of them stay or go, and of repeats of one text under an id one row stays; a
text that loses all its words stays as an empty text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prioritext.llm import near_duplicates, packing, quality, substrings, toxicity
from prioritext.llm.tables import table, written

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _documents(docs: DataFrame) -> DataFrame:
    return docs.select(*COLUMNS)


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that pass every quality rule."""
    return quality.keep_good(_documents(docs))


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the classifier chain, fitted on the labelled ones among them, does not call toxic."""
    docs = _documents(docs)
    return toxicity.keep_clean(docs, toxicity.fitted_model(docs, table(spark, sf_dir, "labels")))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near-duplicates (five words, similarity of 0.8)."""
    docs = _documents(docs)
    groups = near_duplicates.near_duplicate_groups(docs, percent=80)
    kept = groups.filter("kept and doc_id is not null").select(F.col("doc_id").alias("kept_id")).distinct()
    named = docs.filter(F.col("doc_id").isNotNull()).join(kept, F.col("doc_id") == F.col("kept_id"), "left_semi")
    # repeats of an id and its text are one row, the smallest by the other columns; another text is another row
    rest = [c for c in COLUMNS if c not in ("doc_id", "text")]
    once = named.groupBy("doc_id", "text").agg(F.min(F.struct(*rest)).alias("rest")).select("doc_id", "text", "rest.*")
    return once.select(*COLUMNS).union(docs.filter(F.col("doc_id").isNull()))


def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages of 35 words and more that repeat."""
    docs = _documents(docs).withColumn("doc_id", F.col("doc_id").cast("long"))
    return substrings.without_repeats(docs).withColumn(
        "n_chars", F.coalesce(F.length("text").cast("long"), F.lit(0).cast("long"))
    )


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 4096 ids, piece by piece; ``packing.widened(ids, length)`` reads a piece's ids."""
    packed = packing.pack_documents(docs, packing.word_bpe_path(), digest=True, keep_ids=True)
    return packed.select("doc_id", "start", "length", "ids", "ids_crc32", "doc_tokens", "sequence_id", "offset")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_stage),
    ("toxicity", toxicity_stage),
    ("near_duplicates", near_duplicate_stage),
    ("substring_dedup", substring_stage),
    ("packing", packing_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each one's result written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


# Neither the classifier chain nor the packing can be put in SQL; tests hold the near-duplicates and the ids of
# the packing to brute force, the toxicity stage to column names and counts only.
ORACLE_SQL = None
