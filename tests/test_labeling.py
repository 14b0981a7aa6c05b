"""Labelled-corpus build: thresholds on train only, class counts, ids, contracts."""

import pytest
from pyspark.sql import functions as F

from prioritext.operators import labeling as lb
from prioritext.operators.common import EngineError
from prioritext.operators.ids import dense_ids
from prioritext.sources import tables as tb


def test_sf0001_thresholds_and_counts(spark, sf001):
    docs = tb.labelled_text_input(spark, sf001)
    out, (low, high) = lb.label_documents(docs, tb.category_dimension(spark), tb.STANDIN_RAISING, tb.STANDIN_LOWERING)
    assert (low, high) == (pytest.approx(1.7025), pytest.approx(14.15))
    counts = {r["label"]: r["count"] for r in out.groupBy("label").count().collect()}
    assert counts == {"normal": 65, "atencao": 73, "urgente": 62}
    assert out.columns == ["id", "text", "condition_label", "condition_name", "urgency_score", "label", "split"]
    ids = [r["id"] for r in out.filter(F.col("split") == "test").orderBy("id").collect()]
    assert ids[0] == "test-000000" and ids[-1] == f"test-{len(ids) - 1:06d}"
    assert out.select("id").distinct().count() == out.count()


def test_thresholds_use_train_split_only(spark, sf001):
    docs = tb.labelled_text_input(spark, sf001)
    _, th1 = lb.label_documents(docs, tb.category_dimension(spark), tb.STANDIN_RAISING, tb.STANDIN_LOWERING)
    # rewrite every test text: the train-fitted thresholds must not move
    changed = docs.withColumn("text", F.when(F.col("split") == "test", F.lit("the the the the")).otherwise(F.col("text")))
    _, th2 = lb.label_documents(changed, tb.category_dimension(spark), tb.STANDIN_RAISING, tb.STANDIN_LOWERING)
    assert th1 == th2


def test_unknown_category_raises_sorted_list(spark, sf001):
    docs = tb.labelled_text_input(spark, sf001)
    with pytest.raises(EngineError, match=r"\['es'\]"):
        lb.label_documents(docs, tb.category_dimension(spark, without=("es",)), tb.STANDIN_RAISING, tb.STANDIN_LOWERING)


def test_duplicate_dimension_key_raises(spark, sf001):
    docs = tb.labelled_text_input(spark, sf001)
    dim = tb.category_dimension(spark)
    with pytest.raises(EngineError, match="not unique"):
        lb.label_documents(docs, dim.unionByName(dim), tb.STANDIN_RAISING, tb.STANDIN_LOWERING)


def test_dense_ids_widen_past_six_digits_and_ignore_partitioning(spark):
    df = spark.range(0, 1_000_005).select(F.col("id").alias("doc_id"), F.lit("train").alias("split"))
    a = dense_ids(df, "split", "doc_id", "id", num_partitions=3).filter(F.col("doc_id") >= 999_998)
    got = {r["doc_id"]: r["id"] for r in a.collect()}
    assert got == {i: f"train-{i}" if i >= 1_000_000 else f"train-{i:06d}" for i in range(999_998, 1_000_005)}
    b = dense_ids(df.repartition(7), "split", "doc_id", "id", num_partitions=11).filter(F.col("doc_id") >= 999_998)
    assert {r["doc_id"]: r["id"] for r in b.collect()} == got


def test_unmatched_keys_reports_null_keys(spark):
    facts = spark.createDataFrame([("a",), ("b",), (None,), ("b",)], "k STRING")
    dim = spark.createDataFrame([("a",)], "k STRING")
    assert [r["k"] for r in lb.unmatched_keys(facts, dim, "k").collect()] == [None, "b"]


def test_deterministic_rebuild(spark, sf001):
    from prioritext.operators.contracts import table_fingerprint

    docs = tb.labelled_text_input(spark, sf001)
    a, _ = lb.label_documents(docs, tb.category_dimension(spark), tb.STANDIN_RAISING, tb.STANDIN_LOWERING)
    b, _ = lb.label_documents(docs.repartition(5), tb.category_dimension(spark), tb.STANDIN_RAISING, tb.STANDIN_LOWERING)
    assert table_fingerprint(a).first() == table_fingerprint(b).first()


def _wide(spark, n):
    """Rows with carried columns, enough that range sampling is a real sample."""
    return spark.range(0, n, 1, 12).select(
        F.xxhash64("id").alias("doc_id"),
        F.when(F.col("id") % 5 == 0, "test").otherwise("train").alias("split"),
        F.md5(F.col("id").cast("string")).alias("carried"),
        (F.col("id") % 7).alias("condition_label"),
    )


@pytest.mark.parametrize("parts", [1, 7, 50])
def test_dense_ids_are_dense_on_two_million_rows_with_carried_columns(spark, parts):
    n = 2_000_000
    ids = dense_ids(_wide(spark, n), "split", "doc_id", "id", num_partitions=parts)
    number = F.split("id", "-")[1].cast("bigint")
    got = ids.groupBy("split").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("id").alias("d"), F.min(number).alias("lo"), F.max(number).alias("hi")
    )
    assert {r["split"]: (r["n"], r["d"], r["lo"], r["hi"]) for r in got.collect()} == {
        "test": (n // 5, n // 5, 0, n // 5 - 1),
        "train": (n - n // 5, n - n // 5, 0, n - n // 5 - 1),
    }
    digest = ids.agg(F.bit_xor(F.xxhash64("doc_id", "id", "carried")))
    assert digest.first() == digest.first()


def test_dense_index_keeps_a_null_group(spark):
    from prioritext.operators.ids import dense_index

    df = spark.createDataFrame([(None, 2), ("a", 5), (None, 1)], "g STRING, k INT")
    assert {(r["g"], r["k"], r["i"]) for r in dense_index(df, "g", "k", "i").collect()} == {(None, 1, 0), (None, 2, 1), ("a", 5, 0)}


def test_all_unmatched_keys_are_reported(spark):
    docs = spark.range(80).select(F.col("id").alias("doc_id"), F.lit("the").alias("text"), F.concat(F.lit("k"), "id").alias("condition_label"), F.lit("train").alias("split"))
    with pytest.raises(EngineError, match=r"80 key\(s\) in 80 row\(s\)") as e:
        lb.label_documents(docs, tb.category_dimension(spark), tb.STANDIN_RAISING, tb.STANDIN_LOWERING)
    path = str(e.value).rsplit(" ", 1)[1]
    assert spark.read.parquet(path).count() == 80


def test_null_text_cannot_be_labelled(spark):
    docs = spark.createDataFrame([(1, None, "en", "train"), (2, "the", "en", "train")], "doc_id BIGINT, text STRING, condition_label STRING, split STRING")
    with pytest.raises(EngineError, match="1 row"):
        lb.label_documents(docs, tb.category_dimension(spark), tb.STANDIN_RAISING, tb.STANDIN_LOWERING)
