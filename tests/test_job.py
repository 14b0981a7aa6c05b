"""The ledger of stages, and the job that goes on from it."""

import glob
import os
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from prioritext.operators import model as M
from prioritext.plans import job
from prioritext.plans.ledger import StageLedger, stage_key
from prioritext.sources import tables as tb
from prioritext.sources import versions


class Stage:
    """Writes so many rows and counts how often it ran."""

    def __init__(self, spark, path, n=10):
        self.spark, self.path, self.n, self.runs = spark, path, n, 0

    def __call__(self):
        self.runs += 1
        self.spark.range(self.n).repartition(2).write.mode("overwrite").parquet(self.path)
        return self.n, f"run {self.runs}"


def test_a_stage_is_kept_while_its_key_and_its_output_are_whole(spark, tmp_path):
    out, base = f"{tmp_path}/out", f"{tmp_path}/ledger"
    work = Stage(spark, out)

    def go(key="k"):
        ledger = StageLedger(spark, base)
        ledger.run("s", key, work, [out], out)
        return ledger.entries[0][1]

    assert [go(), go(), go()] == ["ok", "kept", "kept"] and work.runs == 1
    assert go("other") == "ok" and go("other") == "kept"
    os.remove(f"{out}/_SUCCESS")
    assert go("other") == "ok"
    lost = next(p for p in glob.glob(f"{out}/part-*"))
    os.remove(lost)
    assert go("other") == "ok" and go("other") == "kept" and work.runs == 4


def test_a_stage_that_fails_leaves_no_record(spark, tmp_path):
    out, base = f"{tmp_path}/out", f"{tmp_path}/ledger"
    good = Stage(spark, out)
    StageLedger(spark, base).run("s", "old", good, [out], out)

    def broken():
        good()  # all is written, then the driver dies
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        StageLedger(spark, base).run("s", "new", broken, [out], out)
    for key in ("old", "new"):
        assert not StageLedger(spark, base).kept("s", key, [out], out)


def test_without_resume_nothing_is_kept_or_recorded(spark, tmp_path):
    out, base = f"{tmp_path}/out", f"{tmp_path}/ledger"
    work = Stage(spark, out)
    for _ in range(2):
        StageLedger(spark, base, resume=False).run("s", "k", work, [out], out)
    assert work.runs == 2 and not os.path.exists(base)


def test_keys_follow_every_setting():
    keys = [stage_key("a", [1, None]), stage_key("a", [1, "null"]), stage_key("b", [1, None]), stage_key("a", [1]), stage_key("a", ("1",))]
    assert len(set(keys)) == len(keys) and stage_key("a", (1, 2)) == stage_key("a", [1, 2])


def test_job_goes_on_after_a_crash_and_redoes_what_changed(spark, sf001, tmp_path, monkeypatch):
    docs, dimension = tb.labelled_text_input(spark, sf001), tb.category_dimension(spark)
    quick = M.TrainConfig(id_col="id", text_col="text", label_col="label", max_iter=3, max_features=200)
    cfg = job.JobConfig(
        str(tmp_path), tb.STANDIN_RAISING, tb.STANDIN_LOWERING, macro_f1_min=0.0, recall_urgente_min=0.0, train=quick, resume=True
    )

    def statuses(c=cfg, d=docs):
        return [r["status"] for r in job.run_job(spark, d, dimension, c).collect()]

    def crash(*_):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as patch:
        patch.setattr(job.M, "train", crash)
        with pytest.raises(RuntimeError):
            statuses()
    assert versions.current_version(spark, f"{tmp_path}/models") is None
    assert statuses() == ["kept", "kept", "ok", "ok", "ok"]
    first = versions.read_version(spark, f"{tmp_path}/models")
    assert {"vocab", "coef", "intercept", "metadata", "metrics", "confusion"} == set(first)
    # the loaded model is the trained one
    tm = M.load_trained(spark, f"{tmp_path}/trained", quick)
    coef = {r["idx"]: r["weights"] for r in first["coef"].collect()}
    matrix = tm.pipeline.stages[-1].coefficientMatrix.toArray()
    assert coef == {j: [float(x) for x in matrix[:, j]] for j in range(matrix.shape[1])}
    # a stricter gate that isn't met stops before publish and leaves the published version
    failed = replace(cfg, macro_f1_min=1.01)
    assert statuses(failed) == ["kept", "kept", "kept", "failed", "skipped"]
    assert versions.current_version(spark, f"{tmp_path}/models") == 1
    # one text changes: all stages are done anew and a second version is published
    changed = docs.withColumn("text", F.when(F.col("doc_id") == 0, F.lit("novo")).otherwise(F.col("text")))
    assert statuses(d=changed) == ["ok"] * 5
    assert versions.complete_versions(spark, f"{tmp_path}/models") == [1, 2]
