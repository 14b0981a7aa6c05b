"""Dimension files, model folders without metadata, comparison records, scratch folders."""

import pytest
from pyspark.sql import functions as F

from prioritext.operators import evaluate as ev
from prioritext.operators.common import EngineError
from prioritext.session import ensure_checkpoint_dir, scratch_path, scratch_scope
from prioritext.sources import files as fs


def test_dimension_by_names_with_its_checks(spark, tmp_path):
    rows = [('say "a",\nb', 1, "k1"), ("plain", 2, "k2")]
    df = spark.createDataFrame(rows, "condition_name STRING, extra INT, condition_label STRING")
    fs.write_csv(df, f"{tmp_path}/ok")
    got = fs.read_dimension(spark, f"{tmp_path}/ok")
    assert got.columns == ["condition_label", "condition_name"]
    assert {tuple(r) for r in got.collect()} == {("k1", 'say "a",\nb'), ("k2", "plain")}
    fs.write_csv(df.drop("condition_name"), f"{tmp_path}/short")
    with pytest.raises(EngineError, match="condition_name"):
        fs.read_dimension(spark, f"{tmp_path}/short")
    fs.write_csv(df.union(df), f"{tmp_path}/twice")
    with pytest.raises(EngineError, match="not unique"):
        fs.read_dimension(spark, f"{tmp_path}/twice")
    with pytest.raises(EngineError, match="no such"):
        fs.read_dimension(spark, f"{tmp_path}/none")


def test_class_order_without_metadata(spark, tmp_path):
    order = ev.class_order(spark.createDataFrame([("b",), ("a",), ("b",)], "label STRING"))
    meta = spark.createDataFrame([(None, "z,y")], "trained_at STRING, classes STRING")
    fs.save_tables({"metadata": meta, "classes": order}, f"{tmp_path}/both")
    fs.save_tables({"metadata": meta.withColumn("classes", F.lit(None).cast("string")), "classes": order}, f"{tmp_path}/null")
    fs.save_tables({"metadata": meta.drop("classes")}, f"{tmp_path}/neither")
    assert tuple(fs.read_model_info(spark, f"{tmp_path}/both").first()) == ("unknown", ["z", "y"], "metadata")
    assert tuple(fs.read_model_info(spark, f"{tmp_path}/null").first()) == ("unknown", ["a", "b"], "classes")
    for folder in ("neither", "absent"):
        with pytest.raises(EngineError, match="order is unknown"):
            fs.read_model_info(spark, f"{tmp_path}/{folder}")


@pytest.mark.parametrize(
    ("agrees", "new_p50", "verdict"), [(True, 4.0, "keep"), (True, 9.0, "not_faster"), (False, 4.0, "not_equivalent")]
)
def test_comparison_record_and_verdict(spark, tmp_path, agrees, new_p50, verdict):
    stats = spark.createDataFrame([("base", 3, 10.0), ("new", 3, new_p50)], "backend STRING, n LONG, p50 DOUBLE")
    a = spark.createDataFrame([(1, "x"), (2, "y")], "doc_id LONG, label STRING")
    b = a if agrees else a.withColumn("label", F.lit("x"))
    path = f"{tmp_path}/bench"
    for _ in range(2):  # records are appended
        fs.write_bench_record(stats, ev.equivalence(a, b), ev.relative_reduction(stats, "base", "new"), path, {"sf": "t"})
    rows = spark.read.json(path).collect()
    assert [r["verdict"] for r in rows] == [verdict] * 2
    assert rows[0]["backends"]["new"]["p50"] == new_p50 and rows[0]["equivalence"]["n"] == 2


def test_scratch_scope_leaves_nothing(spark):
    base = ensure_checkpoint_dir(spark)
    kept = scratch_path(spark, "scope-kept")
    spark.range(3).write.mode("overwrite").parquet(kept)
    with pytest.raises(RuntimeError), scratch_scope(spark):
        spark.range(3).write.parquet(scratch_path(spark, "scope-outer"))
        with scratch_scope(spark):
            spark.range(3).write.parquet(scratch_path(spark, "scope-inner"))
        assert not fs.path_exists(spark, f"{base}/scope-inner") and fs.path_exists(spark, f"{base}/scope-outer")
        raise RuntimeError
    assert not fs.path_exists(spark, f"{base}/scope-outer") and fs.path_exists(spark, kept)
    fs.remove_path(spark, kept)
