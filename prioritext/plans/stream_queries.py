"""Registered streaming queries (``stream_metrics`` has a SQL twin of its
closed windows; the scoring streams are rows-only).  Each runs a Structured Streaming query over the whole input table
with ``trigger(availableNow=True)`` and returns its sink read back."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from prioritext.plans.catalog import RATE_WINDOW, register
from prioritext.plans.model_queries import trained
from prioritext.session import scratch_path
from prioritext.sources import files as fs
from prioritext.sources import tables as tb
from prioritext.streaming import jobs, running

EVENTS_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StringType()),
    ]
)


def _run(query) -> None:
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))


@register("stream_score")
def q_stream_score(spark: SparkSession, sf: str) -> DataFrame:
    tm, _, _, _ = trained(spark, sf)
    base = scratch_path(spark, f"stream-score-{uuid.uuid4().hex}")
    src = jobs.read_stream_parquet(spark, tb.table_path(sf, "documents"), fs.DOCUMENTS_SCHEMA)
    _run(jobs.stream_score(src, tm, f"{base}/out", f"{base}/ckpt", "doc_id", "text", available_now=True))
    return spark.read.parquet(f"{base}/out")


@register("stream_quarantine")
def q_stream_quarantine(spark: SparkSession, sf: str) -> DataFrame:
    tm, _, _, _ = trained(spark, sf)
    base = scratch_path(spark, f"stream-quarantine-{uuid.uuid4().hex}")
    src = jobs.read_stream_parquet(spark, tb.table_path(sf, "documents"), fs.DOCUMENTS_SCHEMA)
    _run(jobs.stream_score_quarantine(src, tm, f"{base}/out", f"{base}/ckpt", "doc_id", "text", available_now=True))
    return spark.read.parquet(f"{base}/out/quarantine")


@register("stream_metrics")
def q_stream_metrics(spark: SparkSession, sf: str) -> DataFrame:
    base = scratch_path(spark, f"stream-metrics-{uuid.uuid4().hex}")
    src = jobs.read_stream_parquet(spark, tb.table_path(sf, "events"), EVENTS_SCHEMA)
    log = tb.request_log_of(jobs.as_event_time(src))
    _run(jobs.stream_metrics(log, f"{base}/out", f"{base}/ckpt", available_now=True))
    return metrics_view(spark.read.parquet(f"{base}/out"))


@register("stream_rates")
def q_stream_rates(spark: SparkSession, sf: str) -> DataFrame:
    """Sliding rate, error ratio, p50 and p95 from the sink of a five-minute metrics stream."""
    base = scratch_path(spark, f"stream-rates-{uuid.uuid4().hex}")
    src = jobs.read_stream_parquet(spark, tb.table_path(sf, "events"), EVENTS_SCHEMA)
    log = tb.request_log_of(jobs.as_event_time(src))
    size, step = RATE_WINDOW
    _run(jobs.stream_metrics(log, f"{base}/out", f"{base}/ckpt", size=f"{step} seconds", available_now=True))
    out = jobs.sliding_metrics(spark.read.parquet(f"{base}/out"), size, step)
    return out.withColumns({c: F.round(c, 6) for c in ("rate_per_s", "error_ratio", "p50", "p95")})


@register("running_series")
def q_running_series(spark: SparkSession, sf: str) -> DataFrame:
    """Current value of every series, kept by a stream that stops after half of the
    log (in several batches) and is started again when the other half has arrived."""
    base = scratch_path(spark, f"running-series-{uuid.uuid4().hex}")
    events = tb.read_table(spark, sf, "events")
    late = F.coalesce(F.col("event_id"), F.lit(0)) % 2 == 1
    for part in (~late, late):
        events.filter(part).repartition(2).write.mode("append").parquet(f"{base}/log")
        src = jobs.read_stream_parquet(spark, f"{base}/log", events.schema, max_files=1)
        log = tb.request_log_of(jobs.as_event_time(src))
        _run(running.stream_counters(log, f"{base}/out", f"{base}/ckpt", available_now=True))
    series = running.current_series(spark, f"{base}/out")
    return series.withColumn("value", F.round("value", 6))


@register("stream_sliding")
def q_stream_sliding(spark: SparkSession, sf: str) -> DataFrame:
    """Sliding rate, error ratio, p50 and p95 made on the stream by two chained operators."""
    base = scratch_path(spark, f"stream-sliding-{uuid.uuid4().hex}")
    src = jobs.read_stream_parquet(spark, tb.table_path(sf, "events"), EVENTS_SCHEMA)
    log = tb.request_log_of(jobs.as_event_time(src))
    size, step = RATE_WINDOW
    _run(running.stream_sliding(log, f"{base}/out", f"{base}/ckpt", size=size, step=step, available_now=True))
    out = spark.read.parquet(f"{base}/out")
    return out.select(
        *[F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c) for c in ("window_start", "window_end")],
        "requests",
        "errors",
        *[F.round(c, 6).alias(c) for c in ("rate_per_s", "error_ratio", "p50", "p95")],
    )


def metrics_view(out: DataFrame) -> DataFrame:
    """The metrics sink as compared with its SQL twin: window bounds as text,
    the duration sum rounded to 6 decimals, counts as they are."""
    fmt = lambda c: F.date_format(F.col(c), "yyyy-MM-dd HH:mm:ss")
    rest = [c for c in out.columns if c not in ("window_start", "window_end", "duration_sum")]
    return out.select(
        fmt("window_start").alias("window_start"),
        fmt("window_end").alias("window_end"),
        *rest,
        F.round(F.col("duration_sum"), 6).alias("duration_sum"),
    )
