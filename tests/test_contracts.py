"""Data-quality checks and the file sources / sinks."""

import pytest

from prioritext.operators import contracts as ct
from prioritext.operators.common import EngineError
from prioritext.session import scratch_path
from prioritext.sources import files as fs


def test_validate_text_counts_and_first_ids(spark):
    rows = [(i, t) for i, t in enumerate(["ok", "", None, " \t", "x", "", "", "", "y"])]
    df = spark.createDataFrame(rows, "doc_id INT, text STRING")
    r = ct.validate_text(df, "doc_id").first()
    assert (r["n_checked"], r["n_bad"], r["first_bad"]) == (9, 6, "1,2,3,5,6")


def test_validate_labels_and_domain(spark):
    df = spark.createDataFrame([("normal",), ("unknown",), (None,), ("urgente",)], "label STRING")
    bad = {r["label"]: r["n"] for r in ct.invalid_labels(df).collect()}
    assert bad == {"null": 1, "unknown": 1}


def test_admission_limits_no_trim(spark):
    df = spark.createDataFrame([("",), (" ",), ("a" * 20000,), ("a" * 20001,)], "text STRING")
    got = [(r["admitted"], r["reason"]) for r in ct.admission(df).collect()]
    assert got == [(False, "too_short"), (True, None), (True, None), (False, "too_long")]


def test_contract_columns(spark):
    df = spark.createDataFrame([(1, "t", "x")], "doc_id INT, text STRING, extra STRING")
    got = {r["column"]: r["present"] for r in ct.contract_columns(df, ["text", "label"]).collect()}
    assert got == {"text": True, "label": False}
    with pytest.raises(EngineError, match="label"):
        ct.check_contract(df, ["text", "label"])


def test_class_balance_flags(spark):
    df = spark.createDataFrame([("a",)] * 10 + [("b",)] * 1, "label STRING")
    got = {r["label"]: (r["share_ok"], r["rows_ok"]) for r in ct.class_balance(df, min_rows=5).collect()}
    assert got == {"a": (True, True), "b": (False, True)}


def test_csv_round_trip_keeps_quotes_and_newlines(spark):
    df = spark.createDataFrame([(1, 'he said "hi",\nthen left', "en", "s", 3)], fs.DOCUMENTS_SCHEMA)
    path = scratch_path(spark, "test-csv-roundtrip")
    fs.write_csv(df, path)
    back = fs.read_csv(spark, path, fs.DOCUMENTS_SCHEMA, required=["doc_id", "text"])
    assert back.first()["text"] == 'he said "hi",\nthen left'
    with pytest.raises(EngineError, match="missing"):
        fs.read_csv(spark, path, fs.DOCUMENTS_SCHEMA, required=["medical_abstract"])


def test_landing_is_idempotent(spark):
    path = scratch_path(spark, "test-landing")
    a = spark.createDataFrame([(1,)], "x INT")
    b = spark.createDataFrame([(2,), (3,)], "x INT")
    fs.land(a, path, force=True)
    fs.land(b, path, force=False)
    assert spark.read.parquet(path).count() == 1
    fs.land(b, path, force=True)
    assert spark.read.parquet(path).count() == 2


def test_thresholds_record_defaults(spark):
    path = scratch_path(spark, "test-thresholds")
    spark.createDataFrame([(1.0, 2.0)], "low DOUBLE, high DOUBLE").write.mode("overwrite").json(path)
    r = fs.load_thresholds(spark, path).first()
    assert (r["low"], r["high"], r["q_low"], r["q_high"], r["seed"]) == (1.0, 2.0, 0.35, 0.75, None)


def test_csv_columns_are_found_by_header(spark, tmp_path):
    path = str(tmp_path / "shuffled")
    df = spark.createDataFrame([(3, "a", "x", 9)], "n_chars BIGINT, extra STRING, text STRING, doc_id BIGINT")
    fs.write_csv(df, path)
    schema = df.select("doc_id", "text", "n_chars").schema
    assert [tuple(r) for r in fs.read_csv(spark, path, schema).collect()] == [(9, "x", 3)]


def test_scratch_needs_a_shared_folder_off_local(monkeypatch):
    from types import SimpleNamespace

    from prioritext.session import ensure_checkpoint_dir

    fake = SimpleNamespace(
        conf=SimpleNamespace(get=lambda *a: None),
        sparkContext=SimpleNamespace(getCheckpointDir=lambda: None, master="spark://host:7077"),
    )
    with pytest.raises(RuntimeError, match="checkpoint"):
        ensure_checkpoint_dir(fake)
