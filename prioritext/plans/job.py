"""The end-to-end job: land -> build -> train -> evaluate/gate -> publish.

Strictly linear; a failed gate or a missing artefact stops before (or at)
publish.  Each stage reads what the previous one wrote, so a lost executor
only recomputes from the last written table, never from the raw input.
A run that stopped goes on where it was (``JobConfig.resume``), and the
artefacts become visible as one version or not at all.  Scheduling (cron, retries) is left to the user's scheduler.
"""

from __future__ import annotations

from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prioritext.constants import (
    DEFAULT_SEED,
    GATE_MACRO_F1_MIN,
    GATE_RECALL_URGENT_MIN,
    HIGH_QUANTILE,
    LABELLED_COLUMNS,
    LABELS_SORTED,
    LOW_QUANTILE,
    TEST_SIZE,
)
from prioritext.operators import evaluate as ev
from prioritext.operators import labeling as lb
from prioritext.operators import model as M
from prioritext.operators import sampling as sp
from prioritext.operators.contracts import table_fingerprint
from prioritext.operators.stats import merge_one_row
from prioritext.plans.ledger import StageLedger, stage_key
from prioritext.sources import files as fs
from prioritext.sources import versions

ARTIFACTS = ("model", "vocab", "coef", "intercept", "metadata", "metrics", "confusion")

MANIFEST_SCHEMA = "stage STRING, status STRING, rows BIGINT, detail STRING"


@dataclass
class JobConfig:
    out_dir: str
    raw_lexicon_raising: tuple[str, ...]
    raw_lexicon_lowering: tuple[str, ...]
    seed: int = DEFAULT_SEED
    test_size: float = TEST_SIZE
    force_land: bool = False
    macro_f1_min: float = GATE_MACRO_F1_MIN
    recall_urgente_min: float = GATE_RECALL_URGENT_MIN
    train: M.TrainConfig | None = None
    # keep finished stages in a ledger and go on from them; the input is known by this version, else by a fingerprint
    resume: bool = False
    input_version: str | None = None


def _input_key(raw_docs: DataFrame, categories: DataFrame, cfg: JobConfig) -> list:
    """What the input is known by: the version given for it, else a fingerprint (one pass over it)."""
    dimension = tuple(table_fingerprint(categories).first())  # one row
    return [cfg.input_version or tuple(table_fingerprint(raw_docs, sorted(raw_docs.columns)).first()), dimension]


def run_job(spark: SparkSession, raw_docs: DataFrame, categories: DataFrame, cfg: JobConfig) -> DataFrame:
    """Run every stage; return the run manifest ``(stage, status, rows, detail)``.

    ``raw_docs`` needs ``doc_id, text, condition_label, split``.  With
    ``cfg.resume`` finished stages enter a ledger below ``out_dir``; run again,
    the job keeps (status ``kept``) those whose input and settings are the same
    and whose outputs are whole, and goes on from there.  A failed gate is
    never kept: the next run evaluates again.
    """
    out = cfg.out_dir.rstrip("/")
    ledger = StageLedger(spark, f"{out}/ledger", cfg.resume)
    landed_path, processed, folds = f"{out}/landed", f"{out}/processed", f"{out}/folds"
    trained, models = f"{out}/trained", f"{out}/models"
    given = _input_key(raw_docs, categories, cfg) if cfg.resume else []

    def manifest(*more: tuple[str, str, int | None, str]) -> DataFrame:
        return spark.createDataFrame([*ledger.entries, *more], MANIFEST_SCHEMA)

    # land: keep an existing landing unless forced; with a ledger, one of another input or a broken one goes
    def land() -> tuple[int, str]:
        fs.land(raw_docs, landed_path, force=cfg.force_land or cfg.resume)
        return spark.read.parquet(landed_path).count(), landed_path

    land_key = stage_key("land", given)
    ledger.run("land", land_key, land, [landed_path], landed_path)

    # build: score, train-only thresholds, labels, ids; partitioned by split
    def build() -> tuple[int, str]:
        landed = spark.read.parquet(landed_path)
        labelled, (low, high) = lb.label_documents(
            landed, categories, cfg.raw_lexicon_raising, cfg.raw_lexicon_lowering
        )
        labelled.select(*LABELLED_COLUMNS).write.mode("overwrite").partitionBy("split").parquet(processed)
        th = spark.createDataFrame([(low, high)], "low DOUBLE, high DOUBLE").select(
            "low", "high", F.lit(LOW_QUANTILE).alias("q_low"), F.lit(HIGH_QUANTILE).alias("q_high")
        )
        fs.save_thresholds(th, f"{out}/thresholds", seed=cfg.seed)
        return spark.read.parquet(processed).count(), f"low={low} high={high}"

    build_key = stage_key("build", land_key, cfg.raw_lexicon_raising, cfg.raw_lexicon_lowering, cfg.seed)
    ledger.run("build", build_key, build, [processed, f"{out}/thresholds"], processed)

    # train: fresh stratified split of the whole processed table
    tcfg = cfg.train or M.TrainConfig(id_col="id", text_col="text", label_col="label")

    def fold(name: str) -> DataFrame:
        return spark.read.parquet(folds).filter(F.col("fold") == name).drop("fold")

    def train() -> tuple[int, str]:
        table = spark.read.parquet(processed).select("id", "text", "label")
        sp.stratified_split(table, "label", "id", cfg.test_size, cfg.seed, "fold").write.mode("overwrite").parquet(folds)
        tm = M.train(fold("train"), tcfg)
        M.save_trained(tm, trained)
        return tm.n_docs, f"iterations={tm.pipeline.stages[-1].summary.totalIterations}"

    train_key = stage_key("train", build_key, cfg.seed, cfg.test_size, asdict(tcfg))
    ledger.run("train", train_key, train, [folds, *(f"{trained}/{p}" for p in ("pipeline", "vocab", "about"))])

    # evaluate + gate: a verdict below the gate ends the run here
    gate_key = stage_key("evaluate", train_key, cfg.macro_f1_min, cfg.recall_urgente_min)
    judged = [f"{out}/evaluation/{t}" for t in ("confusion", "metrics")]
    if not ledger.kept("evaluate", gate_key, judged):
        tm = M.load_trained(spark, trained, tcfg)
        test_df = fold("test")
        scored = M.score_batch(tm, test_df, "id", "text")
        pairs = scored.select("id", F.col("label").alias("y_pred")).join(
            test_df.select("id", F.col("label").alias("y_true")), "id"
        )
        ev.confusion(pairs, "y_true", "y_pred", LABELS_SORTED).write.mode("overwrite").parquet(judged[0])
        summary = ev.eval_summary(ev.per_class_metrics(spark.read.parquet(judged[0])))
        gate = ev.quality_gate(summary, cfg.macro_f1_min, cfg.recall_urgente_min)
        metrics = merge_one_row(summary, ev.gate_passed(gate)).withColumn("trained_at", F.lit(tm.trained_at))
        metrics.write.mode("overwrite").parquet(judged[1])
        row = spark.read.parquet(judged[1]).first()  # one row
        if not row["gate_passed"]:
            return manifest(
                ("evaluate", "failed", row["n_samples"], "; ".join(row["gate_failures"])),
                ("publish", "skipped", None, "quality gate failed"),
            )
        detail = f"macro_f1={row['macro_f1']:.4f} recall_urgente={row['recall_urgente']:.4f}"
        ledger.run("evaluate", gate_key, lambda: (row["n_samples"], detail), judged)

    # publish: all artefacts as one version, then the check of its manifest
    publish_key = stage_key("publish", gate_key)
    current = versions.current_version(spark, models)
    if current is not None and ledger.kept("publish", publish_key, [f"{versions.version_path(models, current)}/manifest"]):
        return manifest()
    tm = M.load_trained(spark, trained, tcfg)
    tables = M.export_tables(tm) | {n: spark.read.parquet(p) for n, p in zip(("confusion", "metrics"), judged, strict=True)}
    version = versions.publish_version(
        spark, models, tables, {"model": lambda path: tm.pipeline.write().overwrite().save(path)}
    )
    expected = spark.createDataFrame([(a,) for a in ARTIFACTS], "artifact STRING")
    root = versions.version_path(models, version)
    absent = fs.missing_artifacts(expected, fs.artifact_manifest(spark, root, ARTIFACTS))
    wrong = absent.select("artifact").union(versions.verify_version(spark, models, version).select("artifact")).distinct()
    missing = sorted(r["artifact"] for r in wrong.collect())  # at most one row per artefact
    if missing:
        return manifest(("publish", "failed", None, f"missing or changed artefacts: {missing}"))
    ledger.run("publish", publish_key, lambda: (len(ARTIFACTS), root))
    return manifest()
