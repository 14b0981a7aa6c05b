"""Seeded sampling: exact sizes, same seed same draw, partition-count invariance."""

import pytest
from pyspark.sql import functions as F

from prioritext.operators import sampling as sp


def _labelled(spark, n=997):
    labels = ["normal"] * 5 + ["atencao"] * 3 + ["urgente"] * 2
    return spark.createDataFrame([(f"d{i:05d}", labels[i % 10]) for i in range(n)], "id STRING, label STRING")


def test_largest_remainder():
    # exact shares 1.5 / 0.9 / 0.6: floors 1, 0, 0; the two largest remainders get +1
    assert sp.largest_remainder_quotas({"a": 5, "b": 3, "c": 2}, 3) == {"a": 1, "b": 1, "c": 1}
    # 3.5 / 1.0 / 0.5: tie of remainders broken by label
    assert sp.largest_remainder_quotas({"a": 7, "b": 2, "c": 1}, 5) == {"a": 4, "b": 1, "c": 0}


def test_stratified_split_exact_and_invariant(spark):
    df = _labelled(spark)
    a = sp.stratified_split(df, "label", "id", 0.2, 42, "fold")
    test = a.filter(F.col("fold") == "test")
    assert test.count() == 200  # ceil(0.2 * 997)
    per = {r["label"]: r["count"] for r in test.groupBy("label").count().collect()}
    assert abs(per["normal"] - 100) <= 1 and abs(per["atencao"] - 60) <= 1 and abs(per["urgente"] - 40) <= 1
    ids1 = sorted(r["id"] for r in test.collect())
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        ids2 = sorted(r["id"] for r in sp.stratified_split(df.repartition(13), "label", "id", 0.2, 42, "fold").filter(F.col("fold") == "test").collect())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert ids1 == ids2
    ids3 = sorted(r["id"] for r in sp.stratified_split(df, "label", "id", 0.2, 7, "fold").filter(F.col("fold") == "test").collect())
    assert ids3 != ids1


def test_stratified_split_errors(spark):
    df = spark.createDataFrame([("a", "x"), ("b", "x"), ("c", "y")], "id STRING, label STRING")
    with pytest.raises(ValueError, match="fewer than 2"):
        sp.stratified_split(df, "label", "id")
    with pytest.raises(ValueError, match="stratify"):
        sp.stratified_split(df.drop("label"), "label", "id")


def test_stratified_split_by_brute_force_and_map_only(spark):
    import hashlib

    df = _labelled(spark)
    out = sp.stratified_split(df, "label", "id", 0.2, 42, "fold")
    drawn = lambda i: int(hashlib.md5(f"42-{i}".encode()).hexdigest()[:15], 16)
    members = {}
    for r in df.collect():
        members.setdefault(r["label"], []).append(r["id"])
    quotas = sp.largest_remainder_quotas({k: len(v) for k, v in members.items()}, 200)
    want = {i for k, v in members.items() for i in sorted(v, key=lambda i: (drawn(i), i))[: quotas[k]]}
    assert {r["id"] for r in out.filter("fold = 'test'").collect()} == want
    # the rows themselves, texts included, aren't shuffled or joined
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan and out.columns == [*df.columns, "fold"]


def test_stratified_split_repeats_nulls_and_tiny_quotas(spark):
    rows = [(i % 40, "a") for i in range(80)] + [(100 + i, "b") for i in range(20)]
    out = sp.stratified_split(spark.createDataFrame(rows, "id INT, label STRING"), "label", "id", 0.2, 1, "fold")
    assert out.count() == 100
    assert out.groupBy("id").agg(F.count_distinct("fold").alias("n")).filter("n > 1").count() == 0
    for bad, what in (([(1, None)], "no label"), ([(None, "a")], "no id")):
        with pytest.raises(ValueError, match=what):
            sp.stratified_split(spark.createDataFrame(rows + bad, "id INT, label STRING"), "label", "id")
    none = sp.stratified_split(spark.createDataFrame(rows, "id INT, label STRING"), "label", "id", 0.0, 1, "fold")
    assert none.filter("fold = 'test'").count() == 0


def test_sample_with_replacement(spark):
    pool = spark.range(5).withColumnRenamed("id", "doc_id")
    a = sp.sample_with_replacement(pool, 12, 42)
    assert a.count() == 12  # n may exceed the pool
    b = sp.sample_with_replacement(pool.repartition(3), 12, 42)
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
    with pytest.raises(ValueError, match="empty pool"):
        sp.sample_with_replacement(pool.limit(0), 3, 42)


def test_balanced_mix(spark):
    df = _labelled(spark, 60)
    mix = sp.balanced_mix(df, 10, 42, "label", "id")
    rows = mix.collect()
    assert len(rows) == 10
    per = {}
    for r in rows:
        per[r["label"]] = per.get(r["label"], 0) + 1
    assert all(v >= 3 for v in per.values())
    again = sorted(map(tuple, sp.balanced_mix(df.repartition(5), 10, 42, "label", "id").collect()))
    assert again == sorted(map(tuple, rows))
    with pytest.raises(ValueError):
        sp.balanced_mix(df, 0, 42, "label", "id")
    only_one = df.filter(F.col("label") == "normal")
    assert sp.balanced_mix(only_one, 5, 42, "label", "id").count() == 5
    tiny = sp.balanced_mix(df, 2, 42, "label", "id").collect()
    assert len(tiny) == 2


def test_sample_without_replacement_distinct(spark):
    df = spark.range(100).withColumnRenamed("id", "doc_id")
    s = sp.sample_without_replacement(df, 10, 42)
    got = [r["doc_id"] for r in s.collect()]
    assert len(set(got)) == 10
    assert sorted(got) == sorted(r["doc_id"] for r in sp.sample_without_replacement(df.repartition(4), 10, 42).collect())


def test_warmup_split(spark):
    df = spark.range(5).withColumnRenamed("id", "slot")
    got = [r["phase"] for r in sp.warmup_split(df, 2).orderBy("slot").collect()]
    assert got == ["warmup", "warmup", "measured", "measured", "measured"]


def test_draws_with_replacement_are_right_when_written_from_a_large_pool(spark, tmp_path):
    pool = spark.range(0, 1_500_000, 1, 12).select(F.col("id").alias("doc_id"), F.md5(F.col("id").cast("string")).alias("carried"))
    path = str(tmp_path / "draws")
    sp.sample_with_replacement(pool, 20_000, keep=["doc_id", "carried"]).write.parquet(path)
    got = spark.read.parquet(path)
    want = spark.range(20_000).select(F.col("id").alias("slot"), (sp.hash60(sp.DEFAULT_SEED, "id") % 1_500_000).alias("doc_id"))
    assert got.count() == 20_000
    assert got.join(want, ["slot", "doc_id"]).count() == 20_000
