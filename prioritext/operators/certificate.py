"""How good a fitted classifier is, from one pass over its training texts.

The penalised objective of the multinomial classifier is

    f(W, b) = (1 / sum_i s_i) sum_i s_i * -log p_i[y_i]  +  (reg / 2) * |W|^2

with class weights ``s`` and no penalty on the intercepts ``b``.  At its
minimum the gradient is zero, and since ``f`` is strongly convex in ``W``,
``f(W, b) - min_W f(W, b) <= |df/dW|^2 / (2 reg)``: a bound on what any further
training could gain, whoever fitted the coefficients and however.

``gradient_sums`` is map-only up to one aggregate: each task adds up its rows'
gradients in a ``max_features x k`` matrix and sends the terms it has seen.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prioritext.functions.text import normalize_text, tokens
from prioritext.operators.common import EngineError
from prioritext.operators.model import SCORED_ROWS, TrainedModel, balanced_weights, export_tables, intercept_list, term_table
from prioritext.session import scratch_path, ship_package

# The number that stands for the intercepts in place of a term's.
INTERCEPTS = -1


def gradient_sums(
    docs: DataFrame,
    vocab: DataFrame,
    coef: DataFrame,
    intercept_rows: Sequence[tuple[str, float]],
    text_col: str = "text",
    label_col: str = "label",
    class_weights: dict[str, float] | None = None,
) -> DataFrame:
    """``(idx, sums ARRAY<DOUBLE>, loss, weight, rows)`` by term, and one row ``idx = -1`` for the intercepts.

    ``sums[c]`` is ``sum_i s_i (p_ic - y_ic) x_it`` over the L2-normalised TF-IDF
    features; ``loss``, ``weight`` and ``rows`` are totals in the row of the
    intercepts and zero elsewhere.  Rows whose label is null or no class are
    left out; a class without a weight counts one.  A term that no row holds has
    no row.  No rows: an empty result.
    """
    classes = [c for c, _ in intercept_rows]
    k = len(classes)
    table = term_table(vocab, coef, k)
    bias = np.array([float(b) for _, b in intercept_rows])
    by_class = np.array([float((class_weights or {}).get(c, 1.0)) for c in classes])
    number = F.create_map(*[x for i, c in enumerate(classes) for x in (F.lit(c), F.lit(i))])
    cut = docs.select(
        number[F.col(label_col).cast("string")].alias("_y"), tokens(normalize_text(F.col(text_col))).alias("_tokens")
    ).filter(F.col("_y").isNotNull())
    ship_package(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast(table)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = held.value
        d = len(table.idf)
        total, seen = np.zeros((d, k)), np.zeros(d, dtype=bool)
        bias_sum, loss, weight, rows = np.zeros(k), 0.0, 0.0, 0
        for batch in batches:
            for low in range(0, batch.num_rows, SCORED_ROWS):
                some = batch.slice(low, SCORED_ROWS)
                m = some.num_rows
                y = some.column("_y").to_numpy(zero_copy_only=False)
                of, term, u = table.weighted(some.column("_tokens"))
                norm = np.sqrt(np.bincount(of, weights=u * u, minlength=m))
                x = u / norm[of]
                z = np.stack([np.bincount(of, weights=x * table.weights[term, c], minlength=m) for c in range(k)], axis=1) + bias
                z -= z.max(axis=1, keepdims=True)
                log_p = z - np.log(np.exp(z).sum(axis=1, keepdims=True))
                s = by_class[y]
                residual = np.exp(log_p)
                residual[np.arange(m), y] -= 1.0
                residual *= s[:, None]
                for c in range(k):
                    total[:, c] += np.bincount(term, weights=x * residual[of, c], minlength=d)
                seen[term] = True
                bias_sum += residual.sum(axis=0)
                loss -= float((s * log_p[np.arange(m), y]).sum())
                weight += float(s.sum())
                rows += m
        if not rows:
            return
        at = np.flatnonzero(seen)
        zeros = np.zeros(len(at))
        sums = np.vstack((bias_sum, total[at]))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.concatenate(([INTERCEPTS], at)).astype(np.int32)),
                *(pa.array(np.ascontiguousarray(sums[:, c])) for c in range(k)),
                pa.array(np.concatenate(([loss], zeros))),
                pa.array(np.concatenate(([weight], zeros))),
                pa.array(np.concatenate(([rows], zeros)).astype(np.int64)),
            ],
            names=["idx", *(f"_g{c}" for c in range(k)), "loss", "weight", "rows"],
        )

    schema = "idx int, " + ", ".join(f"_g{c} double" for c in range(k)) + ", loss double, weight double, rows long"
    parts = cut.mapInArrow(run, schema).groupBy("idx").agg(
        *(F.sum(f"_g{c}").alias(f"_g{c}") for c in range(k)),
        *(F.sum(c).alias(c) for c in ("loss", "weight", "rows")),
    )
    return parts.select("idx", F.array(*(F.col(f"_g{c}") for c in range(k))).alias("sums"), "loss", "weight", "rows")


def certificate(
    docs: DataFrame,
    vocab: DataFrame,
    coef: DataFrame,
    intercept_rows: Sequence[tuple[str, float]],
    reg: float,
    text_col: str = "text",
    label_col: str = "label",
    class_weights: dict[str, float] | None = None,
) -> DataFrame:
    """One row ``(n_docs, loss, penalty, objective, gradient_norm, intercept_norm, gap_bound)``.

    ``reg`` is the weight of the penalty; ``gap_bound`` is the most that the
    objective can still fall at these intercepts, whose own gradient is
    ``intercept_norm``.  Raises where no row has a known label.
    """
    if not reg > 0:
        raise EngineError("the bound needs a positive penalty")
    spark = docs.sparkSession
    path = scratch_path(spark, f"gradient-{uuid.uuid4().hex}")
    gradient_sums(docs, vocab, coef, intercept_rows, text_col, label_col, class_weights).write.parquet(path)
    sums = spark.read.parquet(path)  # at most max_features + 1 rows
    whole = sums.filter(F.col("idx") == INTERCEPTS).first()
    if whole is None:
        raise EngineError("no row has a label of the model")
    k, weight = len(intercept_rows), whole["weight"]
    weights = coef.select("idx", "weights").join(vocab.select("idx"), "idx", "left_semi")
    of_terms = weights.join(sums.select("idx", "sums"), "idx", "left")
    slope = [F.coalesce(F.col("sums")[c], F.lit(0.0)) / F.lit(weight) + F.lit(reg) * F.col("weights")[c] for c in range(k)]
    squares = of_terms.agg(
        F.coalesce(F.sum(sum((g * g for g in slope), F.lit(0.0))), F.lit(0.0)).alias("gradient"),
        F.coalesce(F.sum(sum((F.col("weights")[c] ** 2 for c in range(k)), F.lit(0.0))), F.lit(0.0)).alias("coefs"),
    )
    loss = whole["loss"] / weight
    free = sum((g / weight) ** 2 for g in whole["sums"]) ** 0.5
    penalty = F.lit(reg / 2) * F.col("coefs")
    return squares.select(
        F.lit(whole["rows"]).cast("bigint").alias("n_docs"),
        F.lit(loss).alias("loss"),
        penalty.alias("penalty"),
        (F.lit(loss) + penalty).alias("objective"),
        F.sqrt("gradient").alias("gradient_norm"),
        F.lit(free).alias("intercept_norm"),
        (F.col("gradient") / F.lit(2 * reg)).alias("gap_bound"),
    )


def certify(tm: TrainedModel, docs: DataFrame) -> DataFrame:
    """:func:`certificate` of a trained model on the documents it was trained on."""
    if not tm.counts:
        raise EngineError("the model does not know the class counts it was trained with")
    tables = export_tables(tm)
    reg = 1.0 / (tm.config.c * tm.n_docs)
    return certificate(
        docs, tables["vocab"], tables["coef"], intercept_list(tables["intercept"]), reg,
        tm.config.text_col, tm.config.label_col, balanced_weights(tm.counts),
    )
