"""Text classifier: TF-IDF + multinomial logistic regression on Spark ML, and a
second scoring path from portable coefficient tables.

Path 1 (``score_batch``) is a fitted ``PipelineModel``: SQL n-grams ->
``CountVectorizerModel`` (fixed vocabulary) -> ``ElementwiseProduct`` (IDF)
-> ``Normalizer`` (L2) -> ``LogisticRegressionModel``.  It is map-only.

Path 2 works on portable tables: ``score_text`` is map-only, a sparse dot
product per row with the broadcast term table; ``score_tables`` takes weights
made elsewhere and joins them.  Softmax is column expressions.  Both return the same contract
``(id, label, scores, backend)`` and are checked for agreement.
"""

from __future__ import annotations

import datetime as _dt
import math
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct, Normalizer, SQLTransformer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prioritext.constants import (
    DEFAULT_SEED,
    INVERSE_REGULARISATION_C,
    MAX_FEATURES,
    MAX_ITER,
    MIN_DF,
)
from prioritext.functions.text import BIGRAM_PATTERN, TOKEN_PATTERN, normalize_text, tokens, translation
from prioritext.operators import features as fe
from prioritext.operators.common import EngineError, spread
from prioritext.operators.features import TermTable
from prioritext.session import scratch_path, ship_package

# Rows whose words are looked up together.
SCORED_ROWS = 512

# sklearn's documented lbfgs stopping tolerance (public default).
LBFGS_TOL = 1e-4


ABOUT = "classes ARRAY<STRING>, n_docs BIGINT, trained_at STRING"


@dataclass
class TrainConfig:
    c: float = INVERSE_REGULARISATION_C
    max_iter: int = MAX_ITER
    tol: float = LBFGS_TOL
    min_df: int = MIN_DF
    max_features: int = MAX_FEATURES
    seed: int = DEFAULT_SEED
    id_col: str = "doc_id"
    text_col: str = "text"
    label_col: str = "label"
    num_partitions: int | None = None


@dataclass
class TrainedModel:
    pipeline: PipelineModel
    classes: list[str]
    vocab: DataFrame
    n_docs: int
    trained_at: str
    config: TrainConfig = field(default_factory=TrainConfig)
    counts: dict[str, int] | None = None


def _sql_literal(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def grams_sql(text_col: str = "text", out_col: str = "grams") -> str:
    """The n-gram expression as a SQL statement (for a savable ``SQLTransformer``)."""
    src, dst = translation()
    norm = f"translate(lower({text_col}), {_sql_literal(src)}, {_sql_literal(dst)})"
    toks = f"regexp_extract_all({norm}, {_sql_literal(TOKEN_PATTERN)}, 0)"
    bigrams = f"regexp_extract_all(array_join(_t, ' '), {_sql_literal(BIGRAM_PATTERN)}, 1)"
    return f"SELECT *, concat(_t, {bigrams}) AS {out_col} FROM (SELECT *, {toks} AS _t FROM __THIS__)"


def _feature_stages(vocab_terms: list[str], idf: list[float], text_col: str) -> list:
    grams = SQLTransformer(statement=grams_sql(text_col, "grams"))
    cv = CountVectorizerModel.from_vocabulary(vocab_terms, inputCol="grams", outputCol="_tf")
    scale = ElementwiseProduct(scalingVec=Vectors.dense(idf), inputCol="_tf", outputCol="_tfidf")
    norm = Normalizer(p=2.0, inputCol="_tfidf", outputCol="features")
    return [grams, cv, scale, norm]


# Rows per optimiser partition: every L-BFGS iteration is one treeAggregate of
# a k x d gradient per partition, so tiny partitions only add per-task cost;
# but the featurisation and summary passes before the first iteration run
# per partition too, and long texts make them CPU-heavy.  Measured at sf0.1
# (8,000 training texts): 1 partition ~150 s, 8 partitions ~60 s in total;
# at sf0.01 (800 texts) 1 partition beats 8.  Every partition ships its
# gradient in every iteration, so on large inputs their number follows the
# cores, and grows again only where a partition would become too large.
ROWS_PER_TRAIN_PARTITION = 1000
TRAIN_PARTITIONS_PER_CORE = 2
MAX_ROWS_PER_TRAIN_PARTITION = 200_000


def training_partitions(spark, n_rows: int) -> int:
    """Partitions of the optimiser input: enough for the data and the cores, no more."""
    most = TRAIN_PARTITIONS_PER_CORE * spark.sparkContext.defaultParallelism
    small = min(most, math.ceil(n_rows / ROWS_PER_TRAIN_PARTITION))
    return max(1, small, math.ceil(n_rows / MAX_ROWS_PER_TRAIN_PARTITION))


@dataclass
class Prepared:
    """Everything a fit needs whatever its ``C``: features written once, below the checkpoint folder."""

    stages: list
    features: DataFrame
    classes: list[str]
    counts: dict[str, int]
    vocab: DataFrame
    n_docs: int
    config: TrainConfig


def balanced_weights(counts: dict[str, int]) -> dict[str, float]:
    """``n / (k n_c)`` of each class."""
    n, k = sum(counts.values()), len(counts)
    return {c: n / (k * m) for c, m in counts.items()}


def prepare(df: DataFrame, cfg: TrainConfig | None = None) -> Prepared:
    """Fit vocabulary and IDF on ``df`` (text + label, a row a document) and write its features once.

    No text is shuffled: n-grams are counted inside the rows, features are made
    map-only, and only they are spread for the optimiser, once.
    Only bounded values reach the driver: class counts (k rows) and the
    vocabulary (at most ``max_features`` rows).
    """
    cfg = cfg or TrainConfig()
    spark = df.sparkSession
    class_rows = df.groupBy(cfg.label_col).agg(F.count(F.lit(1)).alias("n")).collect()  # k rows
    counts = {str(r[cfg.label_col]): int(r["n"]) for r in class_rows if r[cfg.label_col] is not None}
    if len(counts) < 2:
        raise EngineError("training needs at least two classes")
    classes = sorted(counts)
    n = sum(counts.values())

    stats = fe.term_statistics(df.filter(F.col(cfg.label_col).isNotNull()), cfg.text_col)
    vocab = fe.vocabulary_of(stats, n, cfg.min_df, cfg.max_features).cache()
    vrows = vocab.orderBy("idx").select("term", "idf").collect()  # <= max_features rows
    if not vrows:
        raise EngineError("empty vocabulary: no term reaches min_df")
    stages = _feature_stages([r["term"] for r in vrows], [float(r["idf"]) for r in vrows], cfg.text_col)

    weights = balanced_weights(counts)
    idx_map = F.create_map(*[x for i, c in enumerate(classes) for x in (F.lit(c), F.lit(float(i)))])
    w_map = F.create_map(*[x for c in classes for x in (F.lit(c), F.lit(weights[c]))])
    lab = F.col(cfg.label_col).cast("string")
    prepared = df.select(
        cfg.id_col, cfg.text_col, idx_map[lab].alias("_label_idx"), w_map[lab].alias("_weight")
    ).filter(F.col("_label_idx").isNotNull())
    made = PipelineModel(stages).transform(prepared).select(cfg.id_col, "_label_idx", "_weight", "features")
    path = scratch_path(spark, f"train-features-{uuid.uuid4().hex}")
    parts = cfg.num_partitions or training_partitions(spark, n)
    # spread before they are written: a fit reads them several times
    made.repartition(parts, F.col(cfg.id_col)).sortWithinPartitions(cfg.id_col).write.parquet(path)
    features = spark.read.schema(made.schema).parquet(path).coalesce(parts)
    return Prepared(stages, features, classes, counts, vocab, n, cfg)


def fit(prepared: Prepared, c: float | None = None) -> TrainedModel:
    """The classifier on prepared features, with the inverse regularisation ``c`` (else that of the settings).

    Balanced class weights ``n / (k n_c)``; L2 penalty ``regParam = 1 / (C * n)``
    (sum of balanced weights = n), ``standardization=False`` and an
    unpenalised intercept reproduce the C-parameterised objective.
    """
    cfg = prepared.config if c is None else replace(prepared.config, c=c)
    lr = LogisticRegression(
        featuresCol="features",
        labelCol="_label_idx",
        weightCol="_weight",
        family="multinomial",
        elasticNetParam=0.0,
        regParam=1.0 / (cfg.c * prepared.n_docs),
        standardization=False,
        fitIntercept=True,
        maxIter=cfg.max_iter,
        tol=cfg.tol,
    )
    model = PipelineModel([*prepared.stages, lr.fit(prepared.features)])
    trained_at = _dt.datetime.now(_dt.timezone.utc).replace(microsecond=0).isoformat()
    return TrainedModel(model, prepared.classes, prepared.vocab, prepared.n_docs, trained_at, cfg, prepared.counts)


def train(df: DataFrame, cfg: TrainConfig | None = None) -> TrainedModel:
    """Fit vocabulary, IDF and the classifier on ``df`` (text + label); see :func:`prepare` and :func:`fit`."""
    return fit(prepare(df, cfg))


def regularisation_path(df: DataFrame, cs: Sequence[float], cfg: TrainConfig | None = None) -> list[TrainedModel]:
    """One model per inverse regularisation strength, over features made and written once.

    Spark's public API takes no starting point for a fit, so each begins at zero.
    """
    prepared = prepare(df, cfg)
    return [fit(prepared, c) for c in cs]


def score_batch(
    tm: TrainedModel, df: DataFrame, id_col: str = "doc_id", text_col: str = "text", num_partitions: int | None = None
) -> DataFrame:
    """Path 1: ``(id, label, scores, backend)``; scores keyed by class, sum to 1.

    Map-only on a large input; a coarse input (fewer partitions than cores)
    is spread first, see ``spread``.
    """
    src = df.select(id_col, text_col)
    if not df.isStreaming:
        src = spread(src, num_partitions, key=id_col)
    out = tm.pipeline.transform(src)
    probs = vector_to_array(F.col("probability"))
    classes = F.array(*[F.lit(c) for c in tm.classes])
    return out.select(
        id_col,
        classes[F.col("prediction").cast("int")].alias("label"),
        F.map_from_arrays(classes, probs).alias("scores"),
        F.lit("spark_ml").alias("backend"),
    )


def export_tables(tm: TrainedModel) -> dict[str, DataFrame]:
    """Portable tables: ``vocab(term, idx, idf)``, ``coef(idx, weights[k])``,
    ``intercept(class, class_idx, value)``, ``metadata``.

    The coefficient matrix lives on the driver already (k x at most
    ``max_features`` doubles); the tables are built from it directly.
    """
    spark = tm.vocab.sparkSession
    lr_model = tm.pipeline.stages[-1]
    mat = lr_model.coefficientMatrix.toArray()  # k x d, bounded by max_features
    k, d = mat.shape
    coef_rows = [(j, [float(mat[i, j]) for i in range(k)]) for j in range(d)]
    coef = spark.createDataFrame(coef_rows, "idx INT, weights ARRAY<DOUBLE>")
    inter = [float(x) for x in lr_model.interceptVector.toArray()]
    intercept = spark.createDataFrame(
        [(c, i, inter[i]) for i, c in enumerate(tm.classes)], "class STRING, class_idx INT, value DOUBLE"
    )
    meta = spark.createDataFrame(
        [(tm.trained_at, tm.n_docs, ",".join(tm.classes))], "trained_at STRING, n_docs BIGINT, classes STRING"
    )
    return {"vocab": tm.vocab.select("term", "idx", "idf"), "coef": coef, "intercept": intercept, "metadata": meta}


def save_trained(tm: TrainedModel, path: str) -> str:
    """Pipeline, vocabulary and what is known of the run below ``path``; the last one written is ``about``."""
    spark = tm.vocab.sparkSession
    tm.pipeline.write().overwrite().save(f"{path}/pipeline")
    tm.vocab.write.mode("overwrite").parquet(f"{path}/vocab")
    about = [(tm.classes, tm.n_docs, tm.trained_at)]
    spark.createDataFrame(about, ABOUT).write.mode("overwrite").parquet(f"{path}/about")
    return path


def load_trained(spark: SparkSession, path: str, cfg: TrainConfig | None = None) -> TrainedModel:
    """A model written by :func:`save_trained`, ready for both scoring paths."""
    about = spark.read.schema(ABOUT).parquet(f"{path}/about").first()  # one row
    pipeline = PipelineModel.load(f"{path}/pipeline")
    vocab = spark.read.parquet(f"{path}/vocab")
    return TrainedModel(pipeline, list(about["classes"]), vocab, about["n_docs"], about["trained_at"], cfg or TrainConfig())


def softmax_label(logits: Sequence[F.Column], classes: Sequence[str]) -> tuple[F.Column, F.Column]:
    """(label, scores map) from per-class logit columns; argmax ties -> first class."""
    m = F.greatest(*logits) if len(logits) > 1 else logits[0]
    exps = [F.exp(x - m) for x in logits]
    total = exps[0]
    for e in exps[1:]:
        total = total + e
    probs = [e / total for e in exps]
    best = F.lit(classes[0])
    best_p = probs[0]
    # strictly greater keeps the first class on ties
    for c, p in zip(classes[1:], probs[1:]):
        best = F.when(p > best_p, F.lit(c)).otherwise(best)
        best_p = F.greatest(best_p, p)
    scores = F.map_from_arrays(F.array(*[F.lit(c) for c in classes]), F.array(*probs))
    return best, scores


def score_tables(
    docs: DataFrame,
    weights: DataFrame,
    coef: DataFrame,
    intercept_rows: Sequence[tuple[str, float]],
    id_col: str = "doc_id",
    backend: str = "tables",
) -> DataFrame:
    """Path 2: ``(id, label, scores, backend)`` from weight and coefficient tables.

    ``weights`` is ``(id, idx, weight)``; ``coef`` is ``(idx, weights[k])``,
    size-bounded by the vocabulary and broadcast.  One aggregate per
    document gives the k logits; a left join from ``docs`` keeps documents
    without any known term (their logits are the intercepts).
    """
    classes = [c for c, _ in intercept_rows]
    k = len(classes)
    joined = weights.join(F.broadcast(coef), "idx", "inner")
    sums = joined.groupBy(id_col).agg(
        *[F.sum(F.col("weight") * F.col("weights")[i]).alias(f"_z{i}") for i in range(k)]
    )
    base = docs.select(id_col).join(sums, id_col, "left")
    logits = [F.coalesce(F.col(f"_z{i}"), F.lit(0.0)) + F.lit(float(b)) for i, (_, b) in enumerate(intercept_rows)]
    label, scores = softmax_label(logits, classes)
    return base.select(id_col, label.alias("label"), scores.alias("scores"), F.lit(backend).alias("backend"))


def intercept_list(intercept: DataFrame) -> list[tuple[str, float]]:
    """k rows to the driver, in class order."""
    return [(r["class"], float(r["value"])) for r in intercept.orderBy("class_idx").collect()]


def weights_for(docs: DataFrame, vocab: DataFrame, id_col: str = "doc_id", text_col: str = "text", num_partitions: int | None = None) -> DataFrame:
    """TF-IDF weights of new documents against a fitted vocabulary."""
    return fe.tfidf_for(docs, vocab, id_col, text_col, num_partitions)


def term_table(vocab: DataFrame, coef: DataFrame, n_classes: int) -> TermTable:
    """Vocabulary and coefficients in the order of their numbers; at most ``max_features`` rows reach the driver."""
    rows = vocab.select("term", "idx", "idf").join(coef.select("idx", "weights"), "idx").orderBy("idx")
    return TermTable([(r["term"], float(r["idf"]), r["weights"]) for r in rows.collect()], n_classes)


def score_text(
    docs: DataFrame,
    vocab: DataFrame,
    coef: DataFrame,
    intercept_rows: Sequence[tuple[str, float]],
    id_col: str = "doc_id",
    text_col: str = "text",
    backend: str = "tables",
    scales: Sequence[float] | None = None,
) -> DataFrame:
    """Path 2 from text, map-only: each row's sparse dot product with the coefficient tables.

    Words are cut natively; a task looks a whole batch of them up in the term
    table (vocabulary, idf and coefficients, at most ``max_features`` rows) and
    adds up ``u_t = c_t * idf_t`` per row: the L2-normalised logit is
    ``z_c = sum_t u_t * w_tc / sqrt(sum_t u_t^2) + b_c``.  No row leaves its
    partition, so ids may be null or repeat; a row without a known term has the
    intercepts.  ``scales``: those of an int8 ``coef``, applied once to each sum.
    """
    classes = [c for c, _ in intercept_rows]
    table = term_table(vocab, coef, len(classes))
    scale = np.array(scales or [1.0] * len(classes))
    bias = np.array([float(b) for _, b in intercept_rows])
    cut = docs.select(F.col(id_col).alias("_id"), tokens(normalize_text(F.col(text_col))).alias("_tokens"))
    ship_package(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast(table)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # a slice's words are bounded by its longest text
            for low in range(0, batch.num_rows, SCORED_ROWS):
                some = batch.slice(low, SCORED_ROWS)
                square, sums = held.value.sums(some.column("_tokens"))
                z = np.divide(sums * scale, np.sqrt(square)[:, None], out=np.zeros_like(sums), where=square[:, None] > 0) + bias
                lists = pa.ListArray.from_arrays(np.arange(0, z.size + 1, max(1, z.shape[1]), dtype=np.int32), pa.array(z.ravel()))
                yield pa.RecordBatch.from_arrays([some.column("_id"), lists], names=["_id", "_z"])

    kind = docs.schema[id_col].dataType.simpleString()
    scored = cut.mapInArrow(run, f"_id {kind}, _z array<double>")
    label, scores = softmax_label([F.col("_z")[i] for i in range(len(classes))], classes)
    return scored.select(
        F.col("_id").alias(id_col), label.alias("label"), scores.alias("scores"), F.lit(backend).alias("backend")
    )


def quantize_tables(coef: DataFrame) -> tuple[DataFrame, list[float]]:
    """Int8 coefficient table ``(idx, weights ARRAY<TINYINT>)`` and the scale of each class.

    ``q = round(w / s)`` with ``s = max|w| / 127``: an eighth of the bytes of the
    doubles.  The scales are one aggregate over the (bounded) table.
    """
    k = coef.select(F.size("weights").alias("k")).first()["k"]
    scales = coef.agg(*[(F.max(F.abs(F.col("weights")[i])) / 127.0).alias(f"_s{i}") for i in range(k)]).first()
    s = [float(scales[f"_s{i}"]) or 1.0 for i in range(k)]
    small = [F.round(F.col("weights")[i] / F.lit(s[i])).cast("tinyint") for i in range(k)]
    return coef.select("idx", F.array(*small).alias("weights")), s


def keep_if_better(equiv: DataFrame, base_p50: float | None, new_p50: float | None, min_samples: int = 20, n_samples: int = 0) -> DataFrame:
    """Decision row: keep the compressed candidate only if it is faster and equal enough."""
    faster = base_p50 is not None and new_p50 is not None and new_p50 < base_p50
    enough = n_samples >= min_samples
    reason = F.when(~F.lit(enough), F.lit("too_few_samples")).when(~F.col("passed"), F.lit("not_equivalent")).when(
        ~F.lit(faster), F.lit("not_faster")
    ).otherwise(F.lit("applied"))
    return equiv.select(
        (F.lit(enough) & F.col("passed") & F.lit(faster)).alias("applied"),
        reason.alias("reason"),
        F.lit(base_p50).cast("double").alias("base_p50_s"),
        F.lit(new_p50).cast("double").alias("new_p50_s"),
        "agreement_pct",
    )
