"""Metrics that a stream keeps up to date.

* ``stream_counters`` — the current value of every series.  The state is one
  row per combination of labels (bounded by the labels, not by the requests),
  kept by Spark in update mode; each batch hands over the changed rows with
  their new totals, which replace the old ones in a versioned table.  A
  replayed batch writes its own version again, and a restart goes on from the
  checkpoint, so nothing is counted twice.
* ``stream_sliding`` — sliding rate, error ratio and quantiles made on the
  stream itself: short windows are counted first, and a second stateful
  operator behind them adds them up to sliding ones.  The state holds one row
  per window, never requests.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from prioritext.constants import METRICS_PATH, REQUEST_DURATION_BUCKETS
from prioritext.operators.common import EngineError
from prioritext.operators.requestlog import error_type, le_label
from prioritext.sources import versions

CELL_LABELS = ("endpoint", "method", "status", "error_type", "label")
SCORING_ENDPOINTS = ("/predict", "/predict/batch")
KEPT_VERSIONS = 3


def request_cells(
    log: DataFrame, bounds: Sequence[float] = REQUEST_DURATION_BUCKETS, value_col: str = "duration_s"
) -> DataFrame:
    """Totals per combination of labels, batch or stream; the metrics path is
    never counted, a null label is a label of its own, null durations count as
    requests only."""
    v = F.col(value_col)
    return (
        log.filter(F.col("endpoint") != METRICS_PATH)
        .groupBy("endpoint", "method", "status", F.when(F.col("status") >= 400, error_type()).alias("error_type"), "label")
        .agg(
            F.count(F.lit(1)).alias("requests"),
            *[F.count_if(v <= F.lit(float(b))).alias(f"le_{i}") for i, b in enumerate(bounds)],
            F.count(v).alias("durations"),
            F.coalesce(F.sum(v), F.lit(0.0)).alias("duration_sum"),
        )
    )


def series_values(cells: DataFrame, bounds: Sequence[float] = REQUEST_DURATION_BUCKETS) -> DataFrame:
    """``(metric, series, value)``: the current value of every series, from the cells."""

    def named(*labels: tuple[str, str]) -> Column:
        parts = [F.concat(F.lit(f"{n}="), F.coalesce(F.col(c).cast("string"), F.lit("null"))) for n, c in labels]
        return F.concat_ws(",", *parts)

    def counter(metric: str, rows: DataFrame, *labels: tuple[str, str]) -> DataFrame:
        return rows.groupBy(*[c for _, c in labels]).agg(F.sum("requests").cast("double").alias("value")).select(
            F.lit(metric).alias("metric"), named(*labels).alias("series"), "value"
        )

    counts = [f"le_{i}" for i in range(len(bounds))]
    by_endpoint = cells.groupBy("endpoint").agg(
        *[F.sum(c).cast("double").alias(c) for c in (*counts, "durations")], F.sum("duration_sum").alias("duration_sum")
    )
    at = named(("endpoint", "endpoint"))
    buckets = [
        F.struct(F.lit("request_duration_bucket").alias("metric"), F.concat(at, F.lit(f",le={le}")).alias("series"), F.col(c).alias("value"))
        for c, le in zip([*counts, "durations"], [*map(le_label, bounds), "+Inf"], strict=True)
    ]
    totals = [
        F.struct(F.lit(f"request_duration_{m}").alias("metric"), at.alias("series"), F.col(c).alias("value"))
        for m, c in (("count", "durations"), ("sum", "duration_sum"))
    ]
    return (
        counter("requests_total", cells, ("endpoint", "endpoint"), ("method", "method"), ("status", "status"))
        .unionByName(counter("errors_total", cells.filter("status >= 400"), ("endpoint", "endpoint"), ("type", "error_type")))
        .unionByName(counter("predictions_total", cells.filter(F.col("endpoint").isin(*SCORING_ENDPOINTS)), ("label", "label")))
        .unionByName(by_endpoint.select(F.inline(F.array(*buckets, *totals))))
    )


def merge_cells(spark: SparkSession, changed: DataFrame, batch_id: int, base: str) -> int:
    """Publish the cells after a batch: its rows replace those of the version
    before it, all others stay.  The same batch again gives the same version."""
    version = batch_id + 1
    latest = versions.current_version(spark, base)
    if latest is not None and latest > version:
        raise EngineError(
            f"{base} holds version {latest}, batch {batch_id} is older: a new checkpoint needs a new output folder"
        )
    before = versions.current_version(spark, base, below=version)
    cells = changed
    if before is not None:
        held = versions.read_version(spark, base, before)["cells"]
        totals = [c for c in changed.columns if c not in CELL_LABELS]
        both = held.withColumn("_new", F.lit(0)).unionByName(changed.withColumn("_new", F.lit(1)))
        cells = both.groupBy(*CELL_LABELS).agg(F.max_by(F.struct(*totals), "_new").alias("t")).select(*CELL_LABELS, "t.*")
    versions.publish_version(spark, base, {"cells": cells}, version=version)
    versions.drop_versions(spark, base, KEPT_VERSIONS)
    return version


def stream_counters(
    log_stream: DataFrame,
    out_base: str,
    checkpoint: str,
    bounds: Sequence[float] = REQUEST_DURATION_BUCKETS,
    available_now: bool = False,
) -> StreamingQuery:
    """Keep the cells of a request stream in ``out_base``; read them by :func:`current_series`."""
    spark = log_stream.sparkSession

    def handle(batch: DataFrame, batch_id: int) -> None:
        merge_cells(spark, batch, batch_id, out_base)

    writer = request_cells(log_stream, bounds).writeStream.outputMode("update").foreachBatch(handle)
    writer = writer.option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def current_series(spark: SparkSession, base: str, bounds: Sequence[float] = REQUEST_DURATION_BUCKETS) -> DataFrame:
    """Every series as of the last whole batch, while the stream runs or not."""
    return series_values(versions.read_version(spark, base)["cells"], bounds)


def bucket_quantile(counts: Sequence[Column], total: Column, q: float, bounds: Sequence[float]) -> Column:
    """Quantile of a row of cumulative bucket counts, linear inside a bucket;
    beyond the last bound that bound, without observations null."""
    rank = F.lit(float(q)) * total
    value = F.when(total <= 0, F.lit(None).cast("double"))
    below, low = F.lit(0), F.lit(0.0)
    for count, bound in zip(counts, bounds, strict=True):
        high, width = F.lit(float(bound)), count - below
        inside = F.when(width > 0, low + (high - low) * ((rank - below) / F.nullif(width, F.lit(0)))).otherwise(high)
        value = value.when(count >= rank, inside)
        below, low = count, high
    return value.otherwise(low)


def sliding_counts(
    log: DataFrame,
    size: int,
    step: int,
    bounds: Sequence[float] = REQUEST_DURATION_BUCKETS,
    ts_col: str = "ts",
    value_col: str = "duration_s",
) -> DataFrame:
    """Requests, errors and bucket counts of every sliding window that holds a
    request: tumbling windows of ``step`` seconds first, so that only their rows
    are repeated ``size / step`` times.  Batch or stream (two chained operators)."""
    if step <= 0 or size <= 0 or size % step:
        raise EngineError(f"window of {size} s is no multiple of its step of {step} s")
    les = [f"le_{i}" for i in range(len(bounds))]
    short = log.groupBy(F.window(ts_col, f"{step} seconds").alias("short")).agg(
        F.count(F.lit(1)).alias("requests"),
        F.count_if(F.col("status") >= 400).alias("errors"),
        *[F.count_if(F.col(value_col) <= F.lit(float(b))).alias(c) for c, b in zip(les, bounds, strict=True)],
    )
    return short.groupBy(F.window(F.window_time("short"), f"{size} seconds", f"{step} seconds").alias("w")).agg(
        *[F.sum(c).alias(c) for c in ("requests", "errors", *les)]
    )


def stream_sliding(
    log_stream: DataFrame,
    out_path: str,
    checkpoint: str,
    watermark: str = "10 minutes",
    size: int = 3_600,
    step: int = 300,
    bounds: Sequence[float] = REQUEST_DURATION_BUCKETS,
    ts_col: str = "ts",
    available_now: bool = False,
) -> StreamingQuery:
    """Append ``(window_start, window_end, requests, errors, rate_per_s,
    error_ratio, p50, p95)`` once the watermark has passed a sliding window's end."""
    wide = sliding_counts(log_stream.withWatermark(ts_col, watermark), size, step, bounds, ts_col)
    counts = [F.col(f"le_{i}") for i in range(len(bounds))]
    out = wide.select(
        F.col("w.start").alias("window_start"),
        F.col("w.end").alias("window_end"),
        "requests",
        "errors",
        (F.col("requests") / size).alias("rate_per_s"),
        (F.col("errors") / F.col("requests")).alias("error_ratio"),
        *[bucket_quantile(counts, F.col("requests"), q, bounds).alias(n) for n, q in (("p50", 0.5), ("p95", 0.95))],
    )
    writer = out.writeStream.format("parquet").option("path", out_path).option("checkpointLocation", checkpoint)
    writer = writer.outputMode("append")
    return (writer.trigger(availableNow=True) if available_now else writer).start()
