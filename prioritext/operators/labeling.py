"""Lexicon scoring, train-only quantile thresholds and three-class labels.

Plan shape of :func:`label_documents`:

1. scan -> broadcast dimension join -> lexicon score (the only regex pass)
   -> narrow rows written to the checkpoint folder (map-only);
2. one aggregate job over the written table: exact quantiles of the train
   scores (two doubles to the driver) and the unmatched-key count;
3. one lazy plan: dense ids on the narrow table (range shuffle of narrow
   rows), texts joined back by (split, order) -> band by literal thresholds
   -> fixed column order.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prioritext.constants import HIGH_QUANTILE, LABELLED_COLUMNS, LOW_QUANTILE, VALID_LABELS
from prioritext.functions.text import map_band, urgency_score
from prioritext.operators.common import (
    EngineError,
    checked_broadcast,
    checked_dimension,
    require_columns,
    spread,
)
from prioritext.operators.ids import dense_ids
from prioritext.session import scratch_path


def fit_thresholds(
    df: DataFrame,
    score_col: str = "urgency_score",
    q_low: float = LOW_QUANTILE,
    q_high: float = HIGH_QUANTILE,
    weight_col: str | None = None,
) -> DataFrame:
    """Exact, linearly interpolated quantiles -> 1 row ``(low, high, q_low, q_high)``.

    Scores are pre-aggregated to ``(score, n)`` first (few distinct values),
    then ``percentile`` with a frequency column keeps the result exact and
    equal to pandas / DuckDB ``quantile_cont``.  ``percentile_approx`` would
    not be.  An empty input gives NULL bounds.
    """
    if weight_col is None:
        counted = df.groupBy(F.col(score_col).alias("_s")).agg(F.count(F.lit(1)).alias("_n"))
    else:
        counted = df.select(F.col(score_col).alias("_s"), F.col(weight_col).alias("_n"))
    counted = counted.filter(F.col("_s").isNotNull())
    q = F.percentile(F.col("_s"), F.array(F.lit(q_low), F.lit(q_high)), F.col("_n"))
    return counted.agg(q.alias("_q")).select(
        F.col("_q")[0].alias("low"),
        F.col("_q")[1].alias("high"),
        F.lit(q_low).alias("q_low"),
        F.lit(q_high).alias("q_high"),
    )


def collect_thresholds(thresholds: DataFrame) -> tuple[float, float]:
    """Bring the two cut points to the driver; empty input is an error."""
    row = thresholds.first()
    if row is None or row["low"] is None or row["high"] is None:
        raise EngineError("the list of train scores is empty: the two cut points are undefined")
    return float(row["low"]), float(row["high"])


def score_documents(
    docs: DataFrame,
    categories: DataFrame,
    raising_terms: Sequence[str],
    lowering_terms: Sequence[str],
    key_col: str = "condition_label",
    text_col: str = "text",
    name_col: str = "condition_name",
    prior_col: str = "prior",
    check: bool = True,
) -> DataFrame:
    """Left join to the (checked, broadcast) dimension, then the lexicon score."""
    require_columns(categories, [key_col, name_col], "category dimension")
    require_columns(docs, [key_col, text_col], "documents")
    dim_cols = [key_col, name_col] + ([prior_col] if prior_col in categories.columns else [])
    if check:
        dim = checked_dimension(categories.select(*dim_cols), key_col, "category dimension")
    else:
        dim = F.broadcast(categories.select(*dim_cols))  # checked by the first call
    joined = docs.join(dim, key_col, "left")
    prior = F.col(prior_col) if prior_col in categories.columns else F.lit(None).cast("double")
    return joined.withColumn(
        "urgency_score", urgency_score(F.col(text_col), prior, raising_terms, lowering_terms)
    )


def label_documents(
    docs: DataFrame,
    categories: DataFrame,
    raising_terms: Sequence[str],
    lowering_terms: Sequence[str],
    thresholds: tuple[float, float] | None = None,
    key_col: str = "condition_label",
    text_col: str = "text",
    split_col: str = "split",
    order_col: str = "doc_id",
    train_value: str = "train",
    q_low: float = LOW_QUANTILE,
    q_high: float = HIGH_QUANTILE,
    check_unmatched: bool = True,
) -> tuple[DataFrame, tuple[float, float]]:
    """Score, fit thresholds on the train split only, label, id; fixed columns.

    Returns ``(labelled, (low, high))``.  Unmatched dimension keys raise,
    listing them sorted (null keys never match in Spark and are reported).

    The lexicon regexes run once per text: the scores go to a narrow table
    ``(split, order, key, name, score)`` written as a table in the cluster's
    checkpoint folder (map-only; it also cuts the lineage).  Dense ids are
    given on that narrow table (a range shuffle of narrow rows, not of texts).  Thresholds and
    the unmatched-key audit read that table; the texts are joined back by
    ``(split, order)`` once at the end.  ``order_col`` must be unique per split.
    """
    require_columns(docs, [text_col, key_col, split_col, order_col], "documents")
    spark = docs.sparkSession
    scored = score_documents(spread(docs, key=order_col), categories, raising_terms, lowering_terms, key_col, text_col)
    narrow = scored.select(split_col, order_col, key_col, "condition_name", "urgency_score")
    # a written table in the checkpoint folder, map-only: the regexes run in
    # exactly one pass (an eager RDD checkpoint would recompute them to write,
    # and a range exchange above them would evaluate them again to sample)
    path = scratch_path(spark, f"narrow-scores-{uuid.uuid4().hex}")
    narrow.write.mode("overwrite").parquet(path)
    written = spark.read.parquet(path)
    # the audit and the threshold fit read the written table (not the id plan,
    # whose range shuffle would run again) in one aggregate job; exact
    # percentile keeps a count per distinct score, bounded by the few
    # distinct lexicon scores
    is_train = F.col(split_col) == F.lit(train_value)
    row = written.agg(
        F.count_if(F.col("condition_name").isNull()).alias("_n_bad"),
        F.count_if(F.col("urgency_score").isNull() | F.isnan("urgency_score")).alias("_n_unscored"),
        F.percentile(F.when(is_train, F.col("urgency_score")), F.array(F.lit(q_low), F.lit(q_high))).alias("_q"),
    ).first()
    if check_unmatched and row["_n_bad"] > 0:
        keys = (
            written.filter(F.col("condition_name").isNull())
            .groupBy(F.col(key_col).cast("string").alias("key"))
            .agg(F.count(F.lit(1)).alias("n_rows"))
        )
        full = scratch_path(spark, f"unmatched-keys-{uuid.uuid4().hex}")
        keys.write.parquet(full)
        listed = spark.read.parquet(full)
        shown = [r["key"] for r in listed.orderBy(F.col("key").asc_nulls_first()).limit(50).collect()]
        raise EngineError(
            f"{key_col}: {listed.count()} key(s) in {row['_n_bad']} row(s) have no category, "
            f"such as {shown}; all of them are in {full}"
        )
    if row["_n_unscored"] > 0:
        raise EngineError(f"{row['_n_unscored']} row(s) have no score ({text_col} is null); they cannot be labelled")
    if thresholds is None:
        q = row["_q"]
        if q is None or q[0] is None or q[1] is None:
            raise EngineError("the list of train scores is empty: the two cut points are undefined")
        thresholds = (float(q[0]), float(q[1]))
    narrow = dense_ids(written, split_col, order_col, "id")
    low, high = thresholds
    texts = docs.select(split_col, order_col, key_col, text_col)
    labelled = texts.join(narrow.drop(key_col), [split_col, order_col], "inner").withColumn(
        "label", map_band("urgency_score", float(low), float(high), VALID_LABELS)
    )
    return labelled.select(*LABELLED_COLUMNS), (low, high)


def label_counts(df: DataFrame, *keys: str) -> DataFrame:
    """Row counts per key combination (partial aggregation on the map side)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def unmatched_keys(facts: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Sorted distinct fact keys with no dimension row (null keys included)."""
    dim_keys = checked_broadcast(dim.select(key).distinct())
    return (
        facts.select(key)
        .distinct()
        .join(dim_keys, key, "left_anti")
        .orderBy(F.col(key).asc_nulls_first())
    )
