"""File sources and sinks: quoted multi-line CSV, idempotent landing to
Parquet, the thresholds record, model tables and the publish manifest.

Every write is a distributed DataFrame write (no ``coalesce(1)``); every
read uses an explicit schema.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from prioritext.constants import HIGH_QUANTILE, LOW_QUANTILE, VALID_LABELS
from prioritext.functions.text import blank_text
from prioritext.operators.common import EngineError, checked_dimension
from prioritext.operators.stats import merge_one_row

DOCUMENTS_SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)

RAW_CORPUS_SCHEMA = T.StructType(
    [T.StructField("condition_label", T.IntegerType()), T.StructField("medical_abstract", T.StringType())]
)

THRESHOLDS_SCHEMA = T.StructType(
    [
        T.StructField("high", T.DoubleType()),
        T.StructField("low", T.DoubleType()),
        T.StructField("q_high", T.DoubleType()),
        T.StructField("q_low", T.DoubleType()),
        T.StructField("seed", T.LongType()),
    ]
)

CSV_OPTIONS = {"header": "true", "multiLine": "true", "escape": '"', "quote": '"'}


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Header + quoted fields; texts with newlines and quotes round-trip."""
    df.write.mode(mode).options(**CSV_OPTIONS).option("quoteAll", "true").csv(path)


def csv_header(spark: SparkSession, path: str) -> DataFrame:
    """CSV files by their header alone: every column is text."""
    return spark.read.options(**CSV_OPTIONS).csv(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType, required: Sequence[str] | None = None) -> DataFrame:
    """Scan CSV with an explicit schema; ``multiLine`` keeps quoted newlines.

    ``multiLine`` makes each file one task, so land to Parquet once (``land``)
    and scan Parquet afterwards.  Columns are found by their names in the
    header, whatever their order; columns beyond the schema are left out, and
    those missing (of ``required``, else of the schema) raise.
    """
    header = csv_header(spark, path).columns
    missing = sorted(set(required or schema.names) - set(header))
    if missing:
        raise EngineError(f"{path}: missing column(s) {missing}")
    typed = {f.name: f for f in schema}
    found = T.StructType([typed.get(c, T.StructField(c, T.StringType())) for c in header])
    scan = spark.read.schema(found).options(**CSV_OPTIONS).option("enforceSchema", "false").csv(path)
    return scan.select(*(F.col(c) if c in header else F.lit(None).cast(typed[c].dataType).alias(c) for c in schema.names))


def _located(spark: SparkSession, path: str):
    """A path and the file system it is on."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _located(spark, path)
    return fs.exists(p)


def is_file(spark: SparkSession, path: str) -> bool:
    """Whether the path is one file; a folder may have a file's name (``documents.parquet/part-0``)."""
    fs, p = _located(spark, path)
    return fs.exists(p) and fs.getFileStatus(p).isFile()


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder the library has written; nothing happens where there is none."""
    fs, p = _located(spark, path)
    fs.delete(p, True)


def land(df: DataFrame, dest: str, force: bool = False) -> str:
    """Idempotent landing: keep what exists unless ``force`` (``mode('ignore')``)."""
    df.write.mode("overwrite" if force else "ignore").parquet(dest)
    return dest


def validate_dataset(df: DataFrame, text_col: str = "text", label_col: str = "label", allowed: Sequence[str] = VALID_LABELS) -> DataFrame:
    """All load-time checks of a processed table in one aggregate pass:
    ``(n_rows, n_bad_text, n_bad_label)``."""
    missing = [c for c in (text_col, label_col) if c not in df.columns]
    if missing:
        raise EngineError(f"missing required column(s) {missing}; expected at least {[text_col, label_col]}")
    bad_label = ~F.coalesce(F.col(label_col).cast("string"), F.lit("null")).isin(list(allowed))
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(blank_text(F.col(text_col))).alias("n_bad_text"),
        F.count_if(bad_label).alias("n_bad_label"),
    )


def save_thresholds(th: DataFrame, path: str, seed: int | None = None) -> str:
    """One-row JSON record ``{high, low, q_high, q_low, seed}`` (sorted keys)."""
    rec = th.select(
        "high", "low", "q_high", "q_low", F.lit(seed).cast("bigint").alias("seed")
    )
    rec.write.mode("overwrite").json(path)
    return path


def load_thresholds(spark: SparkSession, path: str) -> DataFrame:
    """Read the record back; missing quantiles / seed fall back to defaults."""
    raw = spark.read.schema(THRESHOLDS_SCHEMA).json(path)
    return raw.select(
        "low",
        "high",
        F.coalesce(F.col("q_low"), F.lit(LOW_QUANTILE)).alias("q_low"),
        F.coalesce(F.col("q_high"), F.lit(HIGH_QUANTILE)).alias("q_high"),
        F.col("seed").cast("bigint").alias("seed"),
    )


def save_tables(tables: dict[str, DataFrame], base: str) -> dict[str, str]:
    """Write each model table as Parquet under ``base/<name>``."""
    out = {}
    for name, df in tables.items():
        p = f"{base.rstrip('/')}/{name}"
        df.write.mode("overwrite").parquet(p)
        out[name] = p
    return out


def load_tables(spark: SparkSession, base: str, names: Sequence[str]) -> dict[str, DataFrame]:
    return {n: spark.read.parquet(f"{base.rstrip('/')}/{n}") for n in names}


def artifact_manifest(spark: SparkSession, base: str, names: Sequence[str]) -> DataFrame:
    """``(artifact, present)`` for each expected artefact folder (one metadata probe each)."""
    def present(n: str) -> bool:
        root = f"{base.rstrip('/')}/{n}"
        # a table folder carries _SUCCESS; a saved ML pipeline carries metadata/
        return path_exists(spark, f"{root}/_SUCCESS") or path_exists(spark, f"{root}/metadata/_SUCCESS")

    rows = [(n, present(n)) for n in names]
    return spark.createDataFrame(rows, "artifact STRING, present BOOLEAN")


def missing_artifacts(expected: DataFrame, produced: DataFrame) -> DataFrame:
    """Expected manifest anti-joined with what was produced."""
    return expected.join(produced.filter("present").select("artifact"), "artifact", "left_anti").select("artifact")


DIMENSION_SCHEMA = T.StructType(
    [T.StructField("condition_label", T.StringType()), T.StructField("condition_name", T.StringType())]
)


def read_dimension(
    spark: SparkSession, path: str, schema: T.StructType = DIMENSION_SCHEMA, key: str = "condition_label"
) -> DataFrame:
    """Scan the category dimension from CSV: columns by name, one row per key, broadcast within the checked bound.

    A missing file or column and a repeated key raise; other columns are left out.
    """
    if not path_exists(spark, path):
        raise EngineError(f"{path}: no such dimension file")
    return checked_dimension(read_csv(spark, path, schema), key, path)


def read_model_info(spark: SparkSession, base: str) -> DataFrame:
    """One row ``(model_version, classes, classes_from)`` of a model folder whose metadata may be absent.

    The class order is that of ``metadata`` (``classes``, comma-separated); where
    that table, the column or its value is missing, that of the ``classes`` table
    (``label, class_idx``); without either it can't be known and this raises.
    The version is ``trained_at`` of the metadata, else ``unknown``.
    """
    base = base.rstrip("/")
    found = {}
    if path_exists(spark, f"{base}/metadata"):
        row = spark.read.parquet(f"{base}/metadata").first()  # one row
        found = row.asDict() if row else {}
    classes, source = (found.get("classes") or "").split(","), "metadata"
    if classes == [""]:
        if not path_exists(spark, f"{base}/classes"):
            raise EngineError(f"{base}: the metadata names no classes and there is no table of classes; their order is unknown")
        rows = spark.read.parquet(f"{base}/classes").orderBy("class_idx").collect()  # k rows
        classes, source = [str(r["label"]) for r in rows], "classes"
    version = found.get("trained_at") or "unknown"
    return spark.createDataFrame([(version, classes, source)], "model_version STRING, classes ARRAY<STRING>, classes_from STRING")


def write_bench_record(
    stats: DataFrame, equivalence: DataFrame, reduction: DataFrame, path: str, about: dict[str, str] | None = None
) -> str:
    """Append one JSON record of a comparison: statistics by backend, agreement, reduction and the verdict.

    ``stats`` has a ``backend`` and a row for each; the other two are one row.
    The verdict is ``keep`` if the candidate agrees and is fast enough, else what
    is wanting first.
    """
    columns = [c for c in stats.columns if c != "backend"]
    by_backend = stats.agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("backend", F.struct(*columns))))).alias("backends")
    )
    record = merge_one_row(
        merge_one_row(by_backend, equivalence.select(F.struct(*equivalence.columns).alias("equivalence"))),
        reduction.select(F.struct(*reduction.columns).alias("p50_reduction")),
    )
    verdict = (
        F.when(~F.col("equivalence.passed"), F.lit("not_equivalent"))
        .when(~F.col("p50_reduction.met"), F.lit("not_faster"))
        .otherwise(F.lit("keep"))
    )
    given = [F.lit(v).alias(k) for k, v in sorted((about or {}).items())]
    record.select(*given, "*", verdict.alias("verdict")).write.mode("append").json(path)
    return path


BENCH_RESULT_SCHEMA = "measured_at STRING, sf STRING, job STRING, median_sec DOUBLE, rows BIGINT, per_sec DOUBLE, unit STRING"


def append_bench_results(spark: SparkSession, rows: Sequence[tuple], path: str) -> str:
    """Benchmark result sink: append one row per job to a Parquet table."""
    spark.createDataFrame(list(rows), BENCH_RESULT_SCHEMA).write.mode("append").parquet(path)
    return path
