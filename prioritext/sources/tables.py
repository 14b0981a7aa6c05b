"""Readers for the input tables and the bindings of the test tables to the
roles the engine works on (labelled texts, category dimension, request log,
route table).

All readers are plain ``spark.read.parquet`` scans: Catalyst prunes columns
and pushes filters into them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TABLES: tuple[str, ...] = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

# ---------------------------------------------------------------- fixed values
# Category dimension of the test binding: (key, name, prior), keyed by language.
LANG_CATEGORIES: tuple[tuple[str, str, float], ...] = (
    ("en", "english", 0.15),
    ("de", "german", 0.0),
    ("fr", "french", 0.05),
    ("es", "spanish", -0.05),
)
# Stand-in lexicons for the test documents (which hold no clinical vocabulary).
STANDIN_RAISING: tuple[str, ...] = ("the", "and", "that", "this", "der", "und", "el", "los", "le", "et")
STANDIN_LOWERING: tuple[str, ...] = ("of", "is", "was", "for", "die", "ist", "de", "la", "les", "un", "follow-up")
# Request-log binding of the events table.
EVENT_ENDPOINTS: tuple[tuple[str, str, str], ...] = (
    ("click", "/predict", "POST"),
    ("view", "/predict/batch", "POST"),
    ("purchase", "/model-info", "GET"),
    ("signup", "/health", "GET"),
)
OTHER_METHOD = "GET"
# Predicted label of a request-log row, by k band: k < 35 normal, k < 75 atencao, else urgente.
REQUEST_LABEL_BANDS: tuple[tuple[int, str], ...] = ((35, "normal"), (75, "atencao"))
REQUEST_LABEL_TOP = "urgente"
# Route table of the page binding: first path segment -> route template.
PAGE_ROUTES: tuple[tuple[str, str], ...] = (("en", "/en"), ("fr", "/fr"), ("de", "/de"))
# ------------------------------------------------------------ end fixed values

CATEGORY_SCHEMA = T.StructType(
    [
        T.StructField("condition_label", T.StringType(), False),
        T.StructField("condition_name", T.StringType(), False),
        T.StructField("prior", T.DoubleType(), False),
    ]
)


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def split_of(doc_id: str = "doc_id") -> F.Column:
    """Test binding of the corpus split: every fifth document is test."""
    return F.when(F.col(doc_id) % 5 == 0, F.lit("test")).otherwise(F.lit("train"))


def labelled_text_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` as the raw corpus: (doc_id, text, condition_label, split)."""
    docs = read_table(spark, sf_dir, "documents")
    return docs.select(
        "doc_id",
        "text",
        F.col("lang").alias("condition_label"),
        split_of("doc_id").alias("split"),
    )


def category_dimension(spark: SparkSession, without: tuple[str, ...] = ()) -> DataFrame:
    rows = [r for r in LANG_CATEGORIES if r[0] not in without]
    return spark.createDataFrame(rows, CATEGORY_SCHEMA)


def request_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as a request log, one row per request.

    k from ``props``; endpoint and method from the event type; status from k
    (< 90 -> 200, < 97 -> 422, else 500); an even event id with status 500
    is an unhandled exception; backend from the user id parity.
    """
    return request_log_of(read_table(spark, sf_dir, "events"))


def request_log_of(ev: DataFrame) -> DataFrame:
    """The request-log binding applied to an events DataFrame (batch or stream)."""
    k = F.regexp_extract(F.col("props"), r"(\d+)", 1).try_cast("int")
    endpoint = F.lit("unmatched")
    method = F.lit(OTHER_METHOD)
    for etype, ep, m in reversed(EVENT_ENDPOINTS):
        endpoint = F.when(F.col("event_type") == etype, F.lit(ep)).otherwise(endpoint)
        method = F.when(F.col("event_type") == etype, F.lit(m)).otherwise(method)
    status = F.when(k < 90, 200).when(k < 97, 422).otherwise(500)
    return ev.select(
        "event_id",
        "ts",
        "user_id",
        "event_type",
        k.alias("k"),
        endpoint.alias("endpoint"),
        method.alias("method"),
        status.alias("status"),
        ((status == 500) & (F.col("event_id") % 2 == 0)).alias("unhandled"),
        F.when(F.col("user_id") % 2 == 0, F.lit("base")).otherwise(F.lit("new")).alias("backend"),
        F.col("value").alias("duration_ms"),
        (F.col("value") / 1000.0).alias("duration_s"),
        request_label(k).alias("label"),
    )


def request_label(k: F.Column) -> F.Column:
    out = F.lit(REQUEST_LABEL_TOP)
    for bound, name in reversed(REQUEST_LABEL_BANDS):
        out = F.when(k < bound, F.lit(name)).otherwise(out)
    return out


def route_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(PAGE_ROUTES), "segment STRING, route STRING")


def page_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``pages`` as raw request paths: first path segment of the URL."""
    pages = read_table(spark, sf_dir, "pages")
    return pages.select(
        "page_id",
        F.regexp_extract(F.col("url"), r"^https?://[^/]+(/[^?#]*)?", 1).alias("path"),
        F.regexp_extract(F.col("url"), r"^https?://[^/]+/([^/?#]*)", 1).alias("segment"),
    )
