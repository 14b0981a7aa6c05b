"""Evaluation aggregates: confusion matrix, per-class metrics, macro summary,
quality gate, cross-backend agreement and relative p50 reduction.

The data-sized step is one ``groupBy(true, pred).count()`` (map-side
partial aggregation); everything after it works on at most k*k rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from prioritext.constants import (
    EQUIVALENCE_MIN_PCT,
    GATE_MACRO_F1_MIN,
    GATE_RECALL_URGENT_MIN,
    LABELS_SORTED,
    P50_REDUCTION_MIN_PCT,
    URGENT_LABEL,
)


def _safe_div(num, den) -> F.Column:
    return F.coalesce(num / F.when(den != 0, den), F.lit(0.0))


def confusion(
    df: DataFrame,
    true_col: str = "y_true",
    pred_col: str = "y_pred",
    labels: Sequence[str] = LABELS_SORTED,
) -> DataFrame:
    """Long confusion table ``(y_true, y_pred, n)``: the full label grid, and what lies outside it.

    Cells of the grid with no pair are present with ``n = 0``.  A label outside
    ``labels``, or none, is null here; such rows exist only where pairs do, so
    every pair is counted once.
    """
    spark = df.sparkSession

    def known(c: str) -> F.Column:
        return F.when(F.col(c).isin(list(labels)), F.col(c))

    cells = df.groupBy(known(true_col).alias("y_true"), known(pred_col).alias("y_pred")).agg(F.count(F.lit(1)).alias("n"))
    grid = spark.createDataFrame([(t, p, 0) for t in labels for p in labels], "y_true STRING, y_pred STRING, n BIGINT")
    return cells.unionByName(grid).groupBy("y_true", "y_pred").agg(F.sum("n").cast("bigint").alias("n"))


def confusion_wide(conf: DataFrame, labels: Sequence[str] = LABELS_SORTED) -> DataFrame:
    """Matrix form: one row per true label, one column per predicted label."""
    return conf.groupBy("y_true").pivot("y_pred", list(labels)).agg(F.sum("n")).orderBy("y_true")


def per_class_metrics(conf: DataFrame) -> DataFrame:
    """``(label, precision, recall, f1, support, predicted, tp, total)``; zero denominators give 0.

    Support counts every pair with that true label, whatever was predicted;
    ``total`` is the number of all pairs, the same in every row.
    """
    t, p, n = F.col("y_true"), F.col("y_pred"), F.col("n")
    none = F.lit(0).cast("bigint")
    conf = conf.withColumn("total", F.sum("n").over(Window.partitionBy()))  # over the cells
    sides = conf.select(
        "total",
        F.explode(
            F.array(
                F.struct(t.alias("label"), F.when(t == p, n).otherwise(0).alias("tp"), n.alias("support"), none.alias("predicted")),
                F.struct(p.alias("label"), none.alias("tp"), none.alias("support"), n.alias("predicted")),
            )
        ).alias("s"),
    ).select("total", "s.*")
    per = sides.filter(F.col("label").isNotNull()).groupBy("label").agg(
        *[F.sum(c).cast("bigint").alias(c) for c in ("tp", "support", "predicted")],
        F.max("total").cast("bigint").alias("total"),
    )
    return per.select(
        "label",
        _safe_div(F.col("tp"), F.col("predicted")).alias("precision"),
        _safe_div(F.col("tp"), F.col("support")).alias("recall"),
        _safe_div(2 * F.col("tp"), F.col("support") + F.col("predicted")).alias("f1"),
        "support",
        "predicted",
        "tp",
        "total",
    )


def eval_summary(per_class: DataFrame, urgent_label: str = URGENT_LABEL) -> DataFrame:
    """1 row: macro-F1 (unweighted over every label), accuracy over all pairs, recall of the urgent class, n."""
    return per_class.agg(
        F.avg("f1").alias("macro_f1"),
        _safe_div(F.sum("tp").cast("double"), F.max("total")).alias("accuracy"),
        F.coalesce(F.max(F.when(F.col("label") == urgent_label, F.col("recall"))), F.lit(0.0)).alias(
            "recall_urgente"
        ),
        F.max("total").cast("bigint").alias("n_samples"),
    )


def quality_gate(
    summary: DataFrame,
    macro_f1_min: float = GATE_MACRO_F1_MIN,
    recall_urgente_min: float = GATE_RECALL_URGENT_MIN,
) -> DataFrame:
    """Rows ``(metric, value, required, passed, failure)``; metrics are never altered."""
    checks = F.array(
        F.struct(F.lit("macro_f1").alias("metric"), F.col("macro_f1").alias("value"), F.lit(macro_f1_min).alias("required")),
        F.struct(F.lit("recall_urgente").alias("metric"), F.col("recall_urgente").alias("value"), F.lit(recall_urgente_min).alias("required")),
    )
    rows = summary.select(F.explode(checks).alias("c")).select("c.*")
    passed = F.col("value") >= F.col("required")
    return rows.select(
        "metric",
        "value",
        "required",
        passed.alias("passed"),
        F.when(~passed, F.format_string("%s %.4f < required %.2f", F.col("metric"), F.col("value"), F.col("required"))).alias(
            "failure"
        ),
    )


def gate_passed(gate: DataFrame) -> DataFrame:
    """1 row: overall verdict and the failure list."""
    return gate.agg(
        F.bool_and("passed").alias("gate_passed"),
        F.array_sort(F.collect_list("failure")).alias("gate_failures"),
    )


def equivalence(
    a: DataFrame | None,
    b: DataFrame | None,
    id_col: str = "doc_id",
    label_col: str = "label",
    floor: float = EQUIVALENCE_MIN_PCT,
) -> DataFrame:
    """Agreement of two prediction sets paired by id.

    1 row ``(n, matches, agreement_pct, passed, unpaired)``.  Pairing is a
    full outer equi-join (shuffle on the id, AQE may switch strategies), so
    rows missing on one side are counted as ``unpaired`` and fail the check.  No rows or a missing side is vacuously ``(0, 0, 100, true)``.
    """
    if a is None or b is None:
        spark = (a or b).sparkSession
        return spark.createDataFrame(
            [(0, 0, 100.0, True, 0)], "n BIGINT, matches BIGINT, agreement_pct DOUBLE, passed BOOLEAN, unpaired BIGINT"
        )
    left = a.select(F.col(id_col).alias("_id"), F.col(label_col).alias("_a"))
    right = b.select(F.col(id_col).alias("_id"), F.col(label_col).alias("_b"))
    paired = left.join(right, "_id", "full_outer")
    both = F.col("_a").isNotNull() & F.col("_b").isNotNull()
    agg = paired.agg(
        F.count_if(both).alias("n"),
        F.count_if(both & (F.col("_a") == F.col("_b"))).alias("matches"),
        F.count_if(~both).alias("unpaired"),
    )
    pct = F.coalesce(F.col("matches") * 100.0 / F.when(F.col("n") > 0, F.col("n")), F.lit(100.0))
    return agg.select(
        F.col("n").cast("bigint").alias("n"),
        F.col("matches").cast("bigint").alias("matches"),
        pct.alias("agreement_pct"),
        ((pct >= F.lit(floor)) & (F.col("unpaired") == 0)).alias("passed"),
        F.col("unpaired").cast("bigint").alias("unpaired"),
    )


def relative_reduction(
    stats: DataFrame,
    base: str,
    new: str,
    key_col: str = "backend",
    value_col: str = "p50",
    floor: float = P50_REDUCTION_MIN_PCT,
) -> DataFrame:
    """``(base_value, new_value, reduction_pct, met)``; null when a side is missing or base is 0."""
    b = F.max(F.when(F.col(key_col) == base, F.col(value_col)))
    n = F.max(F.when(F.col(key_col) == new, F.col(value_col)))
    agg = stats.agg(b.alias("base_value"), n.alias("new_value"))
    red = (F.col("base_value") - F.col("new_value")) / F.when(F.col("base_value") != 0, F.col("base_value")) * 100.0
    return agg.select(
        "base_value",
        "new_value",
        red.alias("reduction_pct"),
        F.coalesce(red >= F.lit(floor), F.lit(False)).alias("met"),
    )


def class_order(labels_df: DataFrame, label_col: str = "label") -> DataFrame:
    """Alphabetical class order with its index (the model's class order)."""
    w = Window.orderBy(label_col)  # over the distinct labels only (a handful of rows)
    return labels_df.select(label_col).distinct().withColumn("class_idx", F.row_number().over(w) - 1)
