"""Multi-line CSV from byte ranges, and ids in file order."""

import random

import pytest
from pyspark.sql import functions as F

from prioritext.operators.common import EngineError
from prioritext.operators.ids import file_order_ids, file_order_index
from prioritext.sources import files as fs
from prioritext.sources import splitcsv


@pytest.fixture
def small_ranges(spark):
    """Ranges of a few bytes, so that records, quotes and line breaks lie across every border."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    old = {n: spark.conf.get(n) for n in names}

    def use(size):
        for n in names:
            spark.conf.set(n, str(size) if n == names[0] else "1")

    yield use
    for n, v in old.items():
        spark.conf.set(n, v)


def _rows(n, seed=1):
    rng = random.Random(seed)
    bits = ["\n", '"', '""', ",", "\r\n", " ", "a", "é漢", "\n\n", "x" * 30, '",\n"', "\\"]
    rows = []
    for i in range(n):
        text = "".join(rng.choice(bits) for _ in range(rng.randrange(0, 9)))
        rows.append((i, text if i % 7 else None, rng.choice(["en", "", None]), f"s{i}", rng.randrange(99)))
    return rows


def test_ranges_equal_the_scan_of_one_task(spark, tmp_path, small_ranges):
    path = str(tmp_path / "csv")
    fs.write_csv(spark.createDataFrame(_rows(60), fs.DOCUMENTS_SCHEMA).coalesce(1), path)
    want = sorted(map(tuple, fs.read_csv(spark, path, fs.DOCUMENTS_SCHEMA).collect()))
    assert len(want) == 60
    for size in (97, 1_000):
        small_ranges(size)
        lines = splitcsv.ranges_of(spark, path)
        n_ranges = lines.select("file", "start").distinct().count()
        assert n_ranges > (20 if size == 97 else 2)
        got = splitcsv.read_csv_ranges(spark, path, fs.DOCUMENTS_SCHEMA, with_place=True).collect()
        assert sorted((tuple(r)[:5] for r in got)) == want
        placed = sorted(got, key=lambda r: (r["_file"], r["_start"], r["_number"]))
        assert [r["doc_id"] for r in placed] == list(range(60))


def test_unquoted_fields_blank_lines_and_a_record_over_many_ranges(spark, tmp_path, small_ranges):
    (tmp_path / "a.csv").write_text('doc_id,text\n1,plain\n\n2,"' + "long line\n" * 200 + '"\n3,"last ""quoted"""', newline="")
    (tmp_path / "b.csv").write_text("doc_id,text\r\n4,windows\r\n", newline="")
    (tmp_path / "c.csv").write_text("doc_id,text\n")
    schema = fs.T.StructType([fs.T.StructField("doc_id", fs.T.LongType()), fs.T.StructField("text", fs.T.StringType())])
    for size in (150, 10_000):
        small_ranges(size)
        got = {r["doc_id"]: r["text"] for r in splitcsv.read_csv_ranges(spark, str(tmp_path), schema).collect()}
        assert got == {1: "plain", 2: "long line\n" * 200, 3: 'last "quoted"', 4: "windows"}
    with pytest.raises(EngineError, match="missing"):
        splitcsv.read_csv_ranges(spark, str(tmp_path), fs.DOCUMENTS_SCHEMA)
    (tmp_path / "d.csv").write_text("text,doc_id\nx,5\n")
    with pytest.raises(EngineError, match="header"):
        splitcsv.read_csv_ranges(spark, str(tmp_path), schema)


def test_file_order_over_many_files(spark, tmp_path):
    n, path = 2_000_000, str(tmp_path / "many")
    spark.range(0, n, 1, 50).select(F.col("id").alias("v")).write.parquet(path)
    scan = spark.read.parquet(path)
    out = file_order_index(scan)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan and "hashpartitioning" not in plan and "SortMergeJoin" not in plan
    row = out.agg(F.count_if(F.col("v") != F.col("row_idx")).alias("bad"), F.count_distinct("row_idx").alias("d")).first()
    assert row["bad"] == 0 and row["d"] == n
    ids = file_order_ids({"train": scan, "test": scan})
    assert {r["id"] for r in ids.filter("v = 1999999").collect()} == {"train-1999999", "test-1999999"}
    # the same numbers from other ranges, and under a filter
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100000")
    try:
        assert file_order_index(scan).filter("v % 1000 = 7 and v <> row_idx").count() == 0
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
