"""Registered model queries: training + evaluation, both scoring paths, their
agreement, exported tables, publish check, int8 tables, and linear scoring
with a fixed coefficient table.

A fitted model is memoised per (application, sf_dir, target) so the queries
of one session share one training run (the model is "loaded once").
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prioritext.constants import DEFAULT_SEED, GATE_MACRO_F1_MIN, LABELS_SORTED
from prioritext.operators import certificate as cert
from prioritext.operators import evaluate as ev
from prioritext.operators import features as fe
from prioritext.operators import model as M
from prioritext.operators import sampling as sp
from prioritext.operators.common import spread
from prioritext.operators.stats import merge_one_row
from prioritext.plans.catalog import labelled, labelled_with_doc_id, r6, register
from prioritext.session import scratch_path
from prioritext.sources import files as fs
from prioritext.sources import tables as tb
from prioritext.sources import versions

_MODELS: dict[tuple, tuple] = {}
_PREPARED: dict[tuple, M.Prepared] = {}

ARTIFACTS = ("model", "vocab", "coef", "intercept", "metadata", "metrics", "confusion")


def split_labelled(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """The labelled corpus re-split 80 / 20 by the exact stratified split."""
    lab = labelled(spark, sf).select("id", "text", "label")
    folded = sp.stratified_split(lab, "label", "id", 0.2, DEFAULT_SEED, "fold").cache()
    return folded.filter(F.col("fold") == "train").drop("fold"), folded.filter(F.col("fold") == "test").drop("fold")


def trained(spark: SparkSession, sf: str) -> tuple[M.TrainedModel, DataFrame, DataFrame, float]:
    key = (spark.sparkContext.applicationId, sf.rstrip("/"), "label")
    if key not in _MODELS:
        train_df, test_df = split_labelled(spark, sf)
        t0 = time.time()
        prepared = M.prepare(train_df, M.TrainConfig(id_col="id", text_col="text", label_col="label"))
        tm = M.fit(prepared)
        _PREPARED[key] = prepared
        _MODELS[key] = (tm, train_df, test_df, time.time() - t0)
    return _MODELS[key]


def evaluation(tm: M.TrainedModel, test_df: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    scored = M.score_batch(tm, test_df, "id", "text")
    pairs = scored.select("id", F.col("label").alias("y_pred")).join(
        test_df.select("id", F.col("label").alias("y_true")), "id", "inner"
    )
    conf = ev.confusion(pairs, "y_true", "y_pred", LABELS_SORTED)
    per = ev.per_class_metrics(conf)
    return conf, per, ev.eval_summary(per)


def metrics_record(tm: M.TrainedModel, summary: DataFrame, gate: DataFrame, iterations: int) -> DataFrame:
    """One-row metrics record (summary + gate verdict), merged without a join."""
    rec = merge_one_row(summary, ev.gate_passed(gate))
    return rec.select(
        r6("macro_f1").alias("macro_f1"),
        r6("accuracy").alias("accuracy"),
        r6("recall_urgente").alias("recall_urgente"),
        "n_samples",
        "gate_passed",
        "gate_failures",
        F.lit(tm.trained_at).alias("trained_at"),
        F.lit(DEFAULT_SEED).cast("bigint").alias("seed"),
        F.lit(iterations).cast("bigint").alias("iterations"),
    )


@register("train_eval")
def q_train_eval(spark: SparkSession, sf: str) -> DataFrame:
    tm, _, test_df, _ = trained(spark, sf)
    _, _, summary = evaluation(tm, test_df)
    gate = ev.quality_gate(summary)
    iters = tm.pipeline.stages[-1].summary.totalIterations
    return metrics_record(tm, summary, gate, iters)


@register("score_batch")
def q_score_batch(spark: SparkSession, sf: str) -> DataFrame:
    """Path 1 over the whole documents table (one row per text)."""
    tm, _, _, _ = trained(spark, sf)
    docs = tb.read_table(spark, sf, "documents").select("doc_id", "text")
    return M.score_batch(tm, docs, "doc_id", "text")


def _tables_scores(
    tm: M.TrainedModel,
    docs: DataFrame,
    coef: DataFrame | None = None,
    backend: str = "tables",
    scales: list[float] | None = None,
) -> DataFrame:
    tabs = M.export_tables(tm)
    c = coef if coef is not None else tabs["coef"]
    return M.score_text(docs, tabs["vocab"], c, M.intercept_list(tabs["intercept"]), "id", "text", backend, scales=scales)


@register("score_tables")
def q_score_tables(spark: SparkSession, sf: str) -> DataFrame:
    """Path 2 over the whole documents table (one row per text)."""
    tm, _, _, _ = trained(spark, sf)
    docs = spread(tb.read_table(spark, sf, "documents").select("doc_id", "text"), key="doc_id")
    tabs = M.export_tables(tm)
    return M.score_text(docs, tabs["vocab"], tabs["coef"], M.intercept_list(tabs["intercept"]), "doc_id", "text", "tables")


@register("backend_equivalence")
def q_backend_equivalence(spark: SparkSession, sf: str) -> DataFrame:
    tm, _, test_df, _ = trained(spark, sf)
    a = M.score_batch(tm, test_df, "id", "text")
    b = _tables_scores(tm, test_df)
    return ev.equivalence(a, b, "id", "label")


def publish(spark: SparkSession, tm: M.TrainedModel, conf: DataFrame, metrics: DataFrame, base: str) -> dict[str, str]:
    tm.pipeline.write().overwrite().save(f"{base}/model")
    tabs = M.export_tables(tm)
    tabs["metrics"] = metrics
    tabs["confusion"] = conf
    return fs.save_tables(tabs, base)


@register("model_tables")
def q_model_tables(spark: SparkSession, sf: str) -> DataFrame:
    """Exported tables written and read back: class order, intercepts, model version."""
    tm, _, _, _ = trained(spark, sf)
    base = scratch_path(spark, f"model-{uuid.uuid4().hex}")
    fs.save_tables(M.export_tables(tm), base)
    back = fs.load_tables(spark, base, ["intercept", "metadata", "coef", "vocab"])
    meta = back["metadata"].first()  # one row
    shape = back["coef"].agg(F.count(F.lit(1)).alias("n"), F.max(F.size("weights")).alias("k")).first()
    return back["intercept"].select(
        "class",
        "class_idx",
        "value",
        F.lit(meta["trained_at"] or "unknown").alias("model_version"),
        F.lit(meta["n_docs"]).cast("bigint").alias("n_docs"),
        F.lit(shape["n"]).cast("bigint").alias("n_coef_rows"),
        F.lit(shape["k"]).cast("int").alias("n_classes"),
    ).orderBy("class_idx")


@register("missing_artifacts")
def q_missing_artifacts(spark: SparkSession, sf: str) -> DataFrame:
    """A published model against a list that asks for one artefact more: that one is missing."""
    tm, _, test_df, _ = trained(spark, sf)
    conf, _, summary = evaluation(tm, test_df)
    gate = ev.quality_gate(summary)
    metrics = metrics_record(tm, summary, gate, tm.pipeline.stages[-1].summary.totalIterations)
    base = scratch_path(spark, f"publish-{uuid.uuid4().hex}")
    publish(spark, tm, conf, metrics, base)
    wanted = (*ARTIFACTS, "calibration")
    expected = spark.createDataFrame([(a,) for a in wanted], "artifact STRING")
    return fs.missing_artifacts(expected, fs.artifact_manifest(spark, base, wanted))


@register("quantized_equivalence")
def q_quantized_equivalence(spark: SparkSession, sf: str) -> DataFrame:
    """Int8 coefficient table scored through the table path and compared
    with the full-precision table path; whole-job p50 timings of both."""
    tm, _, test_df, _ = trained(spark, sf)
    tabs = M.export_tables(tm)
    coef = tabs["coef"].cache()
    q8, scales = M.quantize_tables(coef)
    q8 = q8.cache()
    full = _tables_scores(tm, test_df, coef, "tables").cache()
    small = _tables_scores(tm, test_df, q8, "tables_int8", scales).cache()
    full.count()
    small.count()
    times: dict[str, list[float]] = {"tables": [], "tables_int8": []}
    for _ in range(3):
        for name, c, by in (("tables", coef, None), ("tables_int8", q8, scales)):
            t0 = time.perf_counter()
            _tables_scores(tm, test_df, c, name, by).write.format("noop").mode("overwrite").save()
            times[name].append(time.perf_counter() - t0)
    med = {k: sorted(v)[len(v) // 2] for k, v in times.items()}
    equiv = ev.equivalence(full, small, "id", "label")
    n = test_df.count()
    return M.keep_if_better(equiv, med["tables"], med["tables_int8"], 20, n)


@register("linear_score")
def q_linear_score(spark: SparkSession, sf: str) -> DataFrame:
    """Table-path scoring with a fixed coefficient table (the stand-in lexicon:
    raising terms vote ``urgente``, lowering terms ``normal``) over raw term counts."""
    docs = tb.read_table(spark, sf, "documents").select("doc_id", "text")
    coef = linear_coef(spark)
    dt = fe.doc_term_counts(docs, "doc_id", "text")
    weights = dt.join(F.broadcast(coef.select("term", "idx")), "term", "inner").select(
        "doc_id", "idx", F.col("c").cast("double").alias("weight")
    )
    scored = M.score_tables(docs, weights, coef.select("idx", "weights"), LINEAR_INTERCEPTS, "doc_id", "linear")
    return scored.select(
        "doc_id",
        "label",
        *[r6(F.col("scores")[c]).alias(f"p_{c}") for c, _ in LINEAR_INTERCEPTS],
    )


# ---------------------------------------------------------------- fixed values
# Intercepts (class order) of the fixed linear scorer.
LINEAR_INTERCEPTS: list[tuple[str, float]] = [("atencao", 0.5), ("normal", 0.0), ("urgente", 0.0)]
# ------------------------------------------------------------ end fixed values


def linear_coef(spark: SparkSession) -> DataFrame:
    rows = []
    for i, t in enumerate(tb.STANDIN_RAISING):
        rows.append((t, i, [0.0, 0.0, 1.0]))
    for j, t in enumerate(tb.STANDIN_LOWERING):
        rows.append((t, len(tb.STANDIN_RAISING) + j, [0.0, 1.0, 0.0]))
    return spark.createDataFrame(rows, "term STRING, idx INT, weights ARRAY<DOUBLE>")


# ---------------------------------------------------------------- fixed values
# Coefficients (class order) of the fixed TF-IDF model, and the strength of the second model of the path.
FIXED_RAISING = (0.0, 0.0, 4.0)
FIXED_LOWERING = (0.0, 4.0, 0.0)
PATH_C = 0.01
# A model counts as optimal if the objective can't fall by more than this share of it.
GAP_SHARE = 0.01
INTERCEPT_NORM_MAX = 0.05
# ------------------------------------------------------------ end fixed values


def fixed_model(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """The vocabulary of the train split and fixed coefficients for it."""
    docs = tb.read_table(spark, sf, "documents").filter(tb.split_of("doc_id") == F.lit("train"))
    vocab = fe.vocabulary_of(fe.term_statistics(docs), docs.count()).cache()
    weights = F.when(F.col("term").isin(list(tb.STANDIN_RAISING)), F.array(*map(F.lit, FIXED_RAISING)))
    weights = weights.when(F.col("term").isin(list(tb.STANDIN_LOWERING)), F.array(*map(F.lit, FIXED_LOWERING)))
    return vocab, vocab.select("idx", weights.otherwise(F.array(*[F.lit(0.0)] * 3)).alias("weights"))


@register("score_text_fixed")
def q_score_text_fixed(spark: SparkSession, sf: str) -> DataFrame:
    """Map-only scoring of every document from TF-IDF features, with fixed coefficients."""
    vocab, coef = fixed_model(spark, sf)
    docs = tb.read_table(spark, sf, "documents").select("doc_id", "text")
    scored = M.score_text(docs, vocab, coef, LINEAR_INTERCEPTS)
    return scored.select("doc_id", "label", *[r6(F.col("scores")[c]).alias(f"p_{c}") for c, _ in LINEAR_INTERCEPTS])


@register("loss_gradient")
def q_loss_gradient(spark: SparkSession, sf: str) -> DataFrame:
    """The gradient of the balanced loss over the train split, by term, at the fixed coefficients."""
    vocab, coef = fixed_model(spark, sf)
    lab = labelled_with_doc_id(spark, sf).filter(F.col("split") == "train").select("text", "label")
    counts = {r["label"]: r["n"] for r in lab.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}  # k rows
    sums = cert.gradient_sums(lab, vocab, coef, LINEAR_INTERCEPTS, class_weights=M.balanced_weights(counts))
    named = sums.join(F.broadcast(vocab.select("idx", "term")), "idx", "left")
    # adding zero makes no sign of a rounded zero
    by_class = [(r6(F.col("sums")[i]) + F.lit(0.0)).alias(f"g_{c}") for i, (c, _) in enumerate(LINEAR_INTERCEPTS)]
    return named.select(F.coalesce("term", F.lit("(intercept)")).alias("term"), *by_class)


def certified(tm: M.TrainedModel, train_df: DataFrame) -> DataFrame:
    found = cert.certify(tm, train_df)
    fine = (F.col("gap_bound") <= GAP_SHARE * F.col("objective")) & (F.col("intercept_norm") <= INTERCEPT_NORM_MAX)
    return found.select(F.lit(tm.config.c).alias("c"), "*", fine.alias("optimal"))


@register("train_certificate")
def q_train_certificate(spark: SparkSession, sf: str) -> DataFrame:
    """The trained model judged by one pass over its training texts: it is within one percent of the optimum."""
    tm, train_df, _, _ = trained(spark, sf)
    return certified(tm, train_df).select("n_docs", "optimal")


@register("regularisation_path")
def q_regularisation_path(spark: SparkSession, sf: str) -> DataFrame:
    """Two strengths over the same features: each model's certificate, and what weaker
    regularisation must do: a smaller loss and larger coefficients."""
    tm, train_df, _, _ = trained(spark, sf)
    key = (spark.sparkContext.applicationId, sf.rstrip("/"), "label")
    strong = certified(M.fit(_PREPARED[key], PATH_C), train_df).first()  # one row each
    usual = certified(tm, train_df).first()
    size = [r["penalty"] * 2 * r["c"] * r["n_docs"] for r in (strong, usual)]
    return spark.createDataFrame(
        [
            (strong["c"], strong["n_docs"], strong["optimal"], None, None),
            (usual["c"], usual["n_docs"], usual["optimal"], usual["loss"] < strong["loss"], size[1] > size[0]),
        ],
        "c DOUBLE, n_docs BIGINT, optimal BOOLEAN, loss_falls BOOLEAN, coefficients_grow BOOLEAN",
    )


@register("end_to_end_job")
def q_end_to_end_job(spark: SparkSession, sf: str) -> DataFrame:
    """The whole job (land -> build -> train -> gate -> publish); its run manifest without paths."""
    from prioritext.plans.job import JobConfig, run_job

    base = scratch_path(spark, f"job-{uuid.uuid4().hex}")
    cfg = JobConfig(base, tb.STANDIN_RAISING, tb.STANDIN_LOWERING)
    manifest = run_job(spark, tb.labelled_text_input(spark, sf), tb.category_dimension(spark), cfg)
    return manifest.select("stage", "status", "rows")


@register("job_resume")
def q_job_resume(spark: SparkSession, sf: str) -> DataFrame:
    """The job three times over one folder: a gate that no model passes ends the first
    run before publish, the second one has the usual gate and goes on from the trained
    model, the third finds all done; the manifests of all three."""
    from dataclasses import replace

    from prioritext.plans.job import JobConfig, run_job

    base = scratch_path(spark, f"job-resume-{uuid.uuid4().hex}")
    strict = JobConfig(base, tb.STANDIN_RAISING, tb.STANDIN_LOWERING, macro_f1_min=1.01, resume=True)
    usual = replace(strict, macro_f1_min=GATE_MACRO_F1_MIN)
    out = None
    for run, cfg in enumerate((strict, usual, usual), start=1):
        manifest = run_job(spark, tb.labelled_text_input(spark, sf), tb.category_dimension(spark), cfg)
        rows = manifest.select(F.lit(run).alias("run"), "stage", "status", "rows")
        out = rows if out is None else out.unionByName(rows)
    return out


@register("published_versions")
def q_published_versions(spark: SparkSession, sf: str) -> DataFrame:
    """Counts of the corpus published twice, a third version whose writer died half-way, and a row lost
    from the current one: what readers see and what the check reports."""
    base = scratch_path(spark, f"versions-{uuid.uuid4().hex}")
    docs = tb.read_table(spark, sf, "documents")
    by_lang = docs.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("text")).alias("chars"))
    by_source = docs.groupBy("source").agg(F.count(F.lit(1)).alias("n"))
    versions.publish_version(spark, base, {"by_lang": by_lang})
    versions.publish_version(spark, base, {"by_lang": by_lang, "by_source": by_source, "lengths": docs.select("doc_id", F.length("text").alias("n"))})
    docs.select("doc_id").write.parquet(f"{versions.version_path(base, 3)}/lengths")
    current = versions.current_version(spark, base)
    last = docs.agg(F.max("doc_id")).first()[0]
    docs.filter(F.col("doc_id") != last).select("doc_id", F.length("text").alias("n")).write.mode("overwrite").parquet(
        f"{versions.version_path(base, current)}/lengths"
    )
    problems = versions.verify_version(spark, base)
    listed = versions.read_manifest(spark, base).select("artifact", F.lit(current).alias("version"), "n_rows")
    return listed.join(problems, "artifact", "left").withColumn("problem", F.coalesce("problem", F.lit("none")))
