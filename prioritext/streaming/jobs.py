"""Structured Streaming jobs: continuous scoring with quarantine, and windowed
request metrics.

* ``stream_score`` — stateless: admission -> fitted pipeline ``transform``
  -> append to a Parquet sink.  The model is loaded once per query.
* ``stream_score_quarantine`` — ``foreachBatch``: accepted rows are scored,
  rejected rows go to a quarantine table with their reason, both written
  idempotently per batch id (a replayed batch overwrites its own folder).
* ``stream_metrics`` — event-time windows with a watermark; the state is one
  row per (window, endpoint) holding counters and cumulative bucket counts,
  never raw values.
* ``sliding_metrics`` — sliding rates, error ratio and quantiles of any window
  and step from that sink's closed windows.

Late-data rule (ours): rows older than the watermark are dropped by Spark and
reported in ``StreamingQueryProgress.stateOperators[].numRowsDroppedByWatermark``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from prioritext.constants import REQUEST_DURATION_BUCKETS
from prioritext.operators import requestlog as rl
from prioritext.operators.contracts import admission
from prioritext.operators.model import TrainedModel, score_batch
from prioritext.operators.requestlog import error_type, le_label
from prioritext.sources.files import is_file


def _start(writer, available_now: bool) -> StreamingQuery:
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def stream_score(
    docs_stream: DataFrame,
    tm: TrainedModel,
    out_path: str,
    checkpoint: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    available_now: bool = False,
) -> StreamingQuery:
    """Score admitted documents continuously; the model version is a column."""
    admitted = admission(docs_stream, text_col).filter(F.col("admitted"))
    scored = score_batch(tm, admitted, id_col, text_col).withColumn(
        "model_version", F.lit(tm.trained_at or "unknown")
    )
    writer = scored.writeStream.format("parquet").option("path", out_path).option(
        "checkpointLocation", checkpoint
    ).outputMode("append")
    return _start(writer, available_now)


def stream_score_quarantine(
    docs_stream: DataFrame,
    tm: TrainedModel,
    out_base: str,
    checkpoint: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    available_now: bool = False,
) -> StreamingQuery:
    """Accepted -> ``out_base/scores``; rejected -> ``out_base/quarantine`` with
    reason and error type ``client_error``.  Idempotent per batch id."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        checked = admission(batch, text_col).persist()
        try:
            ok = checked.filter(F.col("admitted"))
            bad = checked.filter(~F.col("admitted"))
            score_batch(tm, ok, id_col, text_col).withColumn("batch_id", F.lit(batch_id)).write.mode(
                "overwrite"
            ).parquet(f"{out_base}/scores/batch_id={batch_id}")
            bad.select(
                id_col,
                "n_chars_checked",
                "reason",
                F.lit("client_error").alias("error_type"),
                F.lit(batch_id).alias("batch_id"),
            ).write.mode("overwrite").parquet(f"{out_base}/quarantine/batch_id={batch_id}")
        finally:
            checked.unpersist()

    writer = docs_stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    return _start(writer, available_now)


def window_metrics(
    log: DataFrame,
    size: str = "1 hour",
    bounds: Sequence[float] = REQUEST_DURATION_BUCKETS,
    ts_col: str = "ts",
    value_col: str = "duration_s",
) -> DataFrame:
    """Per (window, endpoint): requests, errors by type, cumulative duration
    buckets, sum.  The same expression serves the stream and its batch twin."""
    v = F.col(value_col)
    bucket_aggs = [F.count_if(v <= F.lit(float(b))).alias(f"le_{i}") for i, b in enumerate(bounds)]
    et = error_type()
    return log.groupBy(F.window(ts_col, size).alias("w"), "endpoint").agg(
        F.count(F.lit(1)).alias("requests"),
        F.count_if(F.col("status") >= 400).alias("errors"),
        F.count_if((F.col("status") >= 400) & (et == "client_error")).alias("client_errors"),
        F.count_if((F.col("status") >= 400) & (et == "server_error")).alias("server_errors"),
        F.count_if((F.col("status") >= 400) & (et == "unhandled_exception")).alias("unhandled_exceptions"),
        *bucket_aggs,
        F.sum(v).alias("duration_sum"),
    )


def bucket_labels(bounds: Sequence[float] = REQUEST_DURATION_BUCKETS) -> list[str]:
    return [le_label(b) for b in bounds] + ["+Inf"]


def stream_metrics(
    log_stream: DataFrame,
    out_path: str,
    checkpoint: str,
    watermark: str = "10 minutes",
    size: str = "1 hour",
    ts_col: str = "ts",
    available_now: bool = False,
) -> StreamingQuery:
    """Windowed request metrics in append mode (a window is emitted once the
    watermark passes its end).  ``ts`` must be a TIMESTAMP (cast NTZ first)."""
    agg = window_metrics(log_stream.withWatermark(ts_col, watermark), size, ts_col=ts_col)
    flat = agg.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "*").drop("w")
    writer = flat.writeStream.format("parquet").option("path", out_path).option(
        "checkpointLocation", checkpoint
    ).outputMode("append")
    return _start(writer, available_now)


def sliding_metrics(
    windows: DataFrame,
    size: int = 3_600,
    step: int = 300,
    bounds: Sequence[float] = REQUEST_DURATION_BUCKETS,
) -> DataFrame:
    """Rate, error ratio, p50 and p95 over the trailing ``size`` seconds at every step.

    ``windows`` is the sink of :func:`stream_metrics` with windows of ``step``
    seconds or a divisor of it: the stream keeps no state for long windows,
    and any sliding window is made from its closed short ones.
    """
    steps = rl.steps_of_windows(windows, step, bounds)
    at = F.col("window_end")
    ratio = rl.trailing_error_ratio(steps, size, step)
    quantiles = rl.trailing_quantiles(steps, (0.5, 0.95), bounds, size, step)
    wide = quantiles.groupBy(at.alias("window_end")).agg(
        F.max(F.when(F.col("q") == 0.5, F.col("value"))).alias("p50"),
        F.max(F.when(F.col("q") == 0.95, F.col("value"))).alias("p95"),
    )
    return ratio.join(wide, "window_end").select(
        "window_end", "requests", "errors", (F.col("requests") / size).alias("rate_per_s"), "error_ratio", "p50", "p95"
    )


def as_event_time(log: DataFrame, ts_col: str = "ts") -> DataFrame:
    """Watermarks need TIMESTAMP (not TIMESTAMP_NTZ): cast in the session time zone."""
    return log.withColumn(ts_col, F.col(ts_col).cast("timestamp"))


def read_stream_parquet(spark: SparkSession, path: str, schema, max_files: int | None = None) -> DataFrame:
    """File stream over a folder, whatever its name, or over a single file (its folder is the base path)."""
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    path = path.rstrip("/")
    if is_file(spark, path):
        folder, name = path.rsplit("/", 1)
        return reader.option("pathGlobFilter", name).parquet(folder)
    return reader.parquet(path)
