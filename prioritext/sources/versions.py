"""Versioned publication of tables and saved models.

A version is a folder ``<base>/v=<n>`` with one sub-folder per artefact and,
written last, a ``manifest`` of ``(artifact, kind, n_rows, digest)``.  The
manifest is the switch: readers take the greatest version whose manifest is
complete, so they see all of a version or none of it.  A writer that dies
between two artefacts leaves a folder without a manifest, which nobody reads
and which the next writer leaves alone.

One writer at a time; any number of readers.  Digests do not depend on the
order or the partitioning of rows.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prioritext.operators.common import EngineError
from prioritext.operators.contracts import table_fingerprint

MANIFEST = "manifest"
MANIFEST_COLUMNS = "artifact STRING, kind STRING, n_rows BIGINT, digest STRING"


def _path(spark: SparkSession, path: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)


def _fs(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def version_path(base: str, version: int) -> str:
    return f"{base.rstrip('/')}/v={version}"


def _numbers(spark: SparkSession, base: str, below: str) -> list[int]:
    found = _fs(spark, base).globStatus(_path(spark, f"{base.rstrip('/')}/v=*{below}")) or []
    paths = [str(status.getPath().toString()) for status in found]
    return sorted(int(p[: len(p) - len(below)].rsplit("v=", 1)[1]) for p in paths)


def complete_versions(spark: SparkSession, base: str) -> list[int]:
    """Numbers of the versions whose manifest is complete, ascending."""
    return _numbers(spark, base, f"/{MANIFEST}/_SUCCESS")


def current_version(spark: SparkSession, base: str, below: int | None = None) -> int | None:
    """The version readers see (the latest one before ``below``), or None."""
    known = [v for v in complete_versions(spark, base) if below is None or v < below]
    return known[-1] if known else None


def _table_digest(df: DataFrame) -> DataFrame:
    return table_fingerprint(df).select("n_rows", F.concat_ws(":", F.hex("xor_hash"), "sum_hash").alias("digest"))


def _folder_digest(spark: SparkSession, path: str) -> DataFrame:
    """Fingerprint of the files below a folder by relative path and content (a saved model: small files)."""
    # Spark's own readers skip hidden files, so success marks and checksums do not count
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    name = F.substring_index("path", f"/{path.rstrip('/').rsplit('/', 1)[1]}/", -1)
    return _table_digest(files.select(name.alias("file"), F.sha2("content", 256).alias("sha256")))


def _digest(spark: SparkSession, root: str, artifact: str, kind: str) -> DataFrame:
    path = f"{root}/{artifact}"
    found = _table_digest(spark.read.parquet(path)) if kind == "table" else _folder_digest(spark, path)
    return found.select(F.lit(artifact).alias("artifact"), F.lit(kind).alias("kind"), "n_rows", "digest")


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def publish_version(
    spark: SparkSession,
    base: str,
    tables: Mapping[str, DataFrame],
    folders: Mapping[str, Callable[[str], None]] | None = None,
    version: int | None = None,
) -> int:
    """Write every table (and every folder by its own saver, called with a path),
    then the manifest; returns the version's number.

    ``version`` names the number for writers that may repeat themselves (a
    replayed batch); without it the next unused number is taken.  A repeated
    number is withdrawn first: its manifest goes, then its tables are written anew.
    """
    folders = folders or {}
    names = [*tables, *folders]
    if not names or MANIFEST in names or len(set(names)) != len(names):
        raise EngineError(f"cannot publish artefacts named {names}: one at least, no repeats, none called {MANIFEST!r}")
    if version is None:
        version = max(_numbers(spark, base, ""), default=0) + 1
    root = version_path(base, version)
    _fs(spark, base).delete(_path(spark, f"{root}/{MANIFEST}"), True)
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{root}/{name}")
    for name, save in folders.items():
        save(f"{root}/{name}")
    digests = [_digest(spark, root, n, "table") for n in tables] + [_digest(spark, root, n, "folder") for n in folders]
    _union(digests).write.mode("overwrite").parquet(f"{root}/{MANIFEST}")
    return version


def _chosen(spark: SparkSession, base: str, version: int | None) -> int:
    known = complete_versions(spark, base)
    if not known or (version is not None and version not in known):
        raise EngineError(f"{base}: no complete version" + ("" if version is None else f" {version}"))
    return known[-1] if version is None else version


def read_manifest(spark: SparkSession, base: str, version: int | None = None) -> DataFrame:
    return spark.read.schema(MANIFEST_COLUMNS).parquet(f"{version_path(base, _chosen(spark, base, version))}/{MANIFEST}")


def read_version(spark: SparkSession, base: str, version: int | None = None) -> dict[str, DataFrame]:
    """The tables of the current (or a given) complete version, all of the same one."""
    version = _chosen(spark, base, version)
    listed = read_manifest(spark, base, version).filter("kind = 'table'").collect()  # one row per artefact
    return {r["artifact"]: spark.read.parquet(f"{version_path(base, version)}/{r['artifact']}") for r in listed}


def verify_version(spark: SparkSession, base: str, version: int | None = None) -> DataFrame:
    """``(artifact, problem)`` of a version's artefacts that are ``missing`` or
    ``changed`` (other rows or another digest than published); empty when all is well."""
    version = _chosen(spark, base, version)
    root = version_path(base, version)
    manifest = read_manifest(spark, base, version)
    listed = manifest.select("artifact", "kind").collect()  # one row per artefact

    def held(name: str) -> bool:
        files = _fs(spark, base).globStatus(_path(spark, f"{root}/{name}/[!_.]*"))
        return bool(files)

    now = [_digest(spark, root, r["artifact"], r["kind"]) for r in listed if held(r["artifact"])]
    empty = spark.createDataFrame([], MANIFEST_COLUMNS)
    found = _union([empty, *now]).select("artifact", F.col("n_rows").alias("_rows"), F.col("digest").alias("_digest"))
    same = (F.col("n_rows") == F.col("_rows")) & (F.col("digest") == F.col("_digest"))
    problem = F.when(F.col("_digest").isNull(), "missing").when(~same, "changed")
    return manifest.join(found, "artifact", "left").select("artifact", problem.alias("problem")).filter("problem is not null")


def drop_versions(spark: SparkSession, base: str, keep: int) -> list[int]:
    """Delete all but the latest ``keep`` complete versions, and what was left
    incomplete before them; the manifest of a version goes first."""
    known = complete_versions(spark, base)
    if keep < 1 or len(known) <= keep:
        return []
    oldest = known[-keep]
    gone = [v for v in _numbers(spark, base, "") if v < oldest]
    for v in gone:
        for part in (f"/{MANIFEST}", ""):
            _fs(spark, base).delete(_path(spark, version_path(base, v) + part), True)
    return gone
