"""Versions of tables and saved models: all or nothing, repeats, digests."""

import pytest

from prioritext.operators.common import EngineError
from prioritext.sources import versions as vs


def table(spark, n, at=0):
    return spark.range(at, at + n).selectExpr("id", "CAST(id AS STRING) AS name", "id / 2 AS half")


def names(df):
    return sorted((r["artifact"], r["problem"]) for r in df.collect())


def test_readers_see_whole_versions_only(spark, tmp_path):
    base = f"{tmp_path}/models"
    assert vs.current_version(spark, base) is None
    with pytest.raises(EngineError, match="no complete version"):
        vs.read_version(spark, base)
    assert vs.publish_version(spark, base, {"a": table(spark, 5), "b": table(spark, 3)}) == 1
    # a writer dies between its two tables: the old version stays, its number isn't taken again
    table(spark, 50).write.parquet(f"{vs.version_path(base, 2)}/a")
    assert vs.current_version(spark, base) == 1
    assert {k: v.count() for k, v in vs.read_version(spark, base).items()} == {"a": 5, "b": 3}
    assert vs.publish_version(spark, base, {"a": table(spark, 7)}) == 3
    assert {k: v.count() for k, v in vs.read_version(spark, base).items()} == {"a": 7}
    assert vs.read_version(spark, base, 1)["b"].count() == 3
    with pytest.raises(EngineError, match="version 2"):
        vs.read_version(spark, base, 2)


def test_a_failing_writer_leaves_the_old_version(spark, tmp_path):
    base = f"{tmp_path}/models"
    vs.publish_version(spark, base, {"a": table(spark, 5)})

    def broken(path):
        raise OSError("disk gone")

    with pytest.raises(OSError):
        vs.publish_version(spark, base, {"a": table(spark, 9)}, {"model": broken})
    assert vs.current_version(spark, base) == 1 and vs.read_version(spark, base)["a"].count() == 5


def test_changed_and_missing_artefacts_are_reported(spark, tmp_path):
    base = f"{tmp_path}/models"

    def save(path):
        table(spark, 4).repartition(2).write.csv(path)

    v = vs.publish_version(spark, base, {c: table(spark, 6) for c in "abc"}, {"model": save, "other": save})
    assert names(vs.verify_version(spark, base)) == []
    root = vs.version_path(base, v)
    # the same rows in other files are the same table; one row more, one value less, a lost folder are not
    table(spark, 6).repartition(3).write.mode("overwrite").parquet(f"{root}/a")
    table(spark, 1, 6).write.mode("append").parquet(f"{root}/b")
    table(spark, 0).write.mode("overwrite").parquet(f"{root}/c")
    table(spark, 1, 9).write.mode("append").csv(f"{root}/model")
    vs._fs(spark, root).delete(vs._path(spark, f"{root}/other"), True)
    assert names(vs.verify_version(spark, base)) == [("b", "changed"), ("c", "changed"), ("model", "changed"), ("other", "missing")]


def test_a_repeated_number_replaces_and_old_versions_go(spark, tmp_path):
    base = f"{tmp_path}/t"
    for n in (1, 2, 2, 3):
        vs.publish_version(spark, base, {"a": table(spark, n)}, version=n)
    assert vs.read_version(spark, base, 2)["a"].count() == 2
    assert vs.drop_versions(spark, base, 5) == []
    assert vs.drop_versions(spark, base, 2) == [1]
    assert vs.complete_versions(spark, base) == [2, 3]


def test_empty_tables_nulls_and_bad_names(spark, tmp_path):
    base = f"{tmp_path}/t"
    odd = spark.createDataFrame([(None, None), ("", [1.0]), (None, [])], "s STRING, w ARRAY<DOUBLE>")
    vs.publish_version(spark, base, {"none": odd.limit(0), "odd": odd})
    rows = {r["artifact"]: r["n_rows"] for r in vs.read_manifest(spark, base).collect()}
    assert rows == {"none": 0, "odd": 3} and names(vs.verify_version(spark, base)) == []
    for bad in ({}, {"manifest": odd}):
        with pytest.raises(EngineError, match="cannot publish"):
            vs.publish_version(spark, base, bad)
