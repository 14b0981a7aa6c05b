"""Request-log analytics: counters, cumulative histograms, model-info gauge,
endpoint normalisation, and the dashboard queries (running totals, rates,
counter increase with resets, quantiles from buckets, error ratio).

Scale rules followed throughout: every data-sized step is a grouped
aggregation with map-side partial aggregation; windows only ever run over
pre-aggregated rows (one per key and time bucket, or per bucket bound),
and each window partition is keyed by series *and* time bucket where the
raw rows are involved.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from prioritext.constants import (
    METRICS_PATH,
    MODEL_TYPE_BY_BACKEND,
    REQUEST_DURATION_BUCKETS,
    UNMATCHED_ENDPOINT,
)
from prioritext.operators.common import checked_broadcast
from prioritext.session import scratch_path

EPOCH = "1970-01-01 00:00:00"


def le_label(bound: float) -> str:
    """Bucket label as the metrics library writes it (``+Inf`` for the last)."""
    return repr(float(bound))


def requests_total(log: DataFrame) -> DataFrame:
    """Counter by (endpoint, method, status); the metrics path is never counted."""
    return (
        log.filter(F.col("endpoint") != METRICS_PATH)
        .groupBy("endpoint", "method", "status")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def predictions_total(scores: DataFrame, label_col: str = "label") -> DataFrame:
    """Counter by predicted label: one per scored item, not per request."""
    return scores.groupBy(F.col(label_col).alias("label")).agg(F.count(F.lit(1)).alias("n"))


def error_type(status: str = "status", unhandled: str = "unhandled") -> F.Column:
    return (
        F.when(F.col(unhandled), F.lit("unhandled_exception"))
        .when(F.col(status) < 500, F.lit("client_error"))
        .otherwise(F.lit("server_error"))
    )


def errors_total(log: DataFrame) -> DataFrame:
    """Counter by (endpoint, type) for status >= 400."""
    return (
        log.filter((F.col("status") >= 400) & (F.col("endpoint") != METRICS_PATH))
        .groupBy("endpoint", error_type().alias("type"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def cumulative_histogram(
    log: DataFrame,
    keys: Sequence[str],
    value_col: str,
    bounds: Sequence[float] = REQUEST_DURATION_BUCKETS,
) -> DataFrame:
    """Cumulative ``le`` buckets per group, plus the group's sum and count.

    One aggregation pass: each bound is a conditional count (a value equal
    to a bound falls in it), so empty buckets exist without any grid join.
    Rows ``(keys, idx, le, cumulative, sum, count)``; the last row is ``+Inf``.
    """
    keys = list(keys)
    v = F.col(value_col)
    aggs = [F.count_if(v <= F.lit(float(b))).alias(f"_b{i}") for i, b in enumerate(bounds)]
    aggs += [F.count(v).alias("_count"), F.sum(v).alias("_sum")]
    per = log.groupBy(*keys).agg(*aggs)
    labels = [le_label(b) for b in bounds] + ["+Inf"]
    entries = [
        F.struct(F.lit(i).alias("idx"), F.lit(lab).alias("le"), F.col(f"_b{i}").alias("cumulative"))
        for i, lab in enumerate(labels[:-1])
    ]
    entries.append(F.struct(F.lit(len(bounds)).alias("idx"), F.lit("+Inf").alias("le"), F.col("_count").alias("cumulative")))
    return per.select(*keys, F.explode(F.array(*entries)).alias("e"), "_sum", "_count").select(
        *keys,
        F.col("e.idx").alias("idx"),
        F.col("e.le").alias("le"),
        F.col("e.cumulative").cast("bigint").alias("cumulative"),
        F.col("_sum").alias("sum"),
        F.col("_count").cast("bigint").alias("count"),
    )


def model_info(loads: DataFrame, ts_col: str = "ts", type_map: dict[str, str] = MODEL_TYPE_BY_BACKEND) -> DataFrame:
    """The one live label set: latest (backend, model_version) by time, value 1.

    ``max_by`` is a single partial+final aggregate; ties on time are broken by
    the label values so the result is deterministic.
    """
    mapping = F.create_map(*[F.lit(x) for kv in type_map.items() for x in kv]) if type_map else None
    latest = loads.agg(
        F.max_by(F.struct("backend", "model_version"), F.struct(F.col(ts_col), "backend", "model_version")).alias("m")
    ).select("m.*")
    mtype = F.coalesce(mapping[F.col("backend")], F.col("backend")) if mapping is not None else F.col("backend")
    return latest.filter(F.col("backend").isNotNull()).select(
        "backend", "model_version", mtype.alias("model_type"), F.lit(1.0).alias("value")
    )


def endpoint_normalize(paths: DataFrame, routes: DataFrame, key_col: str = "segment", path_col: str = "path") -> DataFrame:
    """Route template per request, ``unmatched`` when no route matched; the
    metrics path is excluded.  The route table is size-checked, then broadcast."""
    r = checked_broadcast(routes.select(F.col(key_col), F.col("route")))
    return (
        paths.filter(F.coalesce(F.col(path_col), F.lit("")) != METRICS_PATH)
        .join(r, key_col, "left")
        .withColumn("endpoint", F.coalesce(F.col("route"), F.lit(UNMATCHED_ENDPOINT)))
        .drop("route")
    )


# ------------------------------------------------------------------ time axes


def hour_bucket(ts: str | F.Column) -> F.Column:
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.date_trunc("hour", c)


def hour_index(bucket: F.Column) -> F.Column:
    """Whole hours since the epoch (time-zone free for NTZ timestamps)."""
    return F.timestamp_diff("HOUR", F.lit(EPOCH).cast("timestamp_ntz"), bucket.cast("timestamp_ntz"))


def fmt_ts(c: F.Column) -> F.Column:
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss")


def running_total(df: DataFrame, keys: Sequence[str], ts_col: str = "ts") -> DataFrame:
    """Counter value since the start per key at the end of every hour.

    Rows are first reduced to ``(keys, hour) -> n``; the running sum is a
    window over those hourly rows only.
    """
    keys = list(keys)
    hourly = df.groupBy(*keys, hour_bucket(ts_col).alias("_h")).agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy(*keys).orderBy("_h").rowsBetween(Window.unboundedPreceding, 0)
    return hourly.select(*keys, fmt_ts(F.col("_h")).alias("bucket"), "n", F.sum("n").over(w).cast("bigint").alias("running"))


def event_rate(
    df: DataFrame, keys: Sequence[str], ts_col: str = "ts", size: str = "1 hour", slide: str | None = None
) -> DataFrame:
    """Exact event rate (events / second) per key in each time window."""
    keys = list(keys)
    win = F.window(ts_col, size, slide) if slide else F.window(ts_col, size)
    secs = F.timestamp_diff("SECOND", F.col("w.start"), F.col("w.end"))
    return (
        df.groupBy(win.alias("w"), *keys)
        .agg(F.count(F.lit(1)).alias("n"))
        .select(
            fmt_ts(F.col("w.start")).alias("window_start"),
            *keys,
            F.col("n").cast("bigint").alias("n"),
            (F.col("n") / secs).alias("rate_per_s"),
        )
    )


def sliding_hours(hourly: DataFrame, keys: Sequence[str], value_cols: Sequence[str], hours: int) -> DataFrame:
    """Sum hourly pre-aggregates over the trailing ``hours`` (window ending at each hour)."""
    keys = list(keys)
    w = Window.partitionBy(*keys).orderBy("_hidx").rangeBetween(-(hours - 1), 0)
    return hourly.withColumn("_hidx", hour_index(F.col("_h"))).select(
        *keys, "_h", *[F.sum(c).over(w).alias(c) for c in value_cols]
    )


def error_ratio(log: DataFrame, ts_col: str = "ts", hours: int = 24) -> DataFrame:
    """Errors / requests over a trailing window at each hour, summed over all
    labels before the division; zero requests -> null."""
    hourly = log.groupBy(hour_bucket(ts_col).alias("_h")).agg(
        F.count_if(F.col("status") >= 400).alias("errors"), F.count(F.lit(1)).alias("requests")
    )
    win = sliding_hours(hourly, [], ["errors", "requests"], hours)
    return win.select(
        fmt_ts(F.col("_h")).alias("window_end_hour"),
        F.col("errors").cast("bigint").alias("errors"),
        F.col("requests").cast("bigint").alias("requests"),
        (F.col("errors") / F.when(F.col("requests") > 0, F.col("requests"))).alias("error_ratio"),
    )


def bucket_counts_hourly(
    log: DataFrame, value_col: str, bounds: Sequence[float] = REQUEST_DURATION_BUCKETS, ts_col: str = "ts"
) -> DataFrame:
    """``(hour, idx, le_bound, cumulative)`` over all labels (``sum by (le)``)."""
    hist = cumulative_histogram(log.withColumn("_h", hour_bucket(ts_col)), ["_h"], value_col, bounds)
    bound_of = F.when(F.col("le") == "+Inf", F.lit(float("inf"))).otherwise(F.col("le").cast("double"))
    return hist.select("_h", "idx", bound_of.alias("le_bound"), "cumulative")


def histogram_quantile(hist: DataFrame, q: float, keys: Sequence[str]) -> DataFrame:
    """Quantile from cumulative bucket counts, linear inside the bucket.

    ``hist`` holds ``(keys, idx, le_bound, cumulative)`` with the ``+Inf``
    bucket last.  The lower edge of the first bucket is 0; a rank in the
    ``+Inf`` bucket returns the highest finite bound; no observations -> null.
    Windows run over at most one row per bucket bound per key.
    """
    return histogram_quantiles(hist, [q], keys)


def histogram_quantiles(hist: DataFrame, qs: Sequence[float], keys: Sequence[str]) -> DataFrame:
    """:func:`histogram_quantile` for several ``q`` in one pass: the bucket
    rows are repeated once per ``q`` (a literal array, map-only) and the
    windows are keyed by ``(keys, q)``, so the input plan runs once."""
    keys = list(keys)
    wkeys = keys + ["q"]
    w = Window.partitionBy(*wkeys).orderBy("idx")
    wall = Window.partitionBy(*wkeys)
    h = (
        hist.withColumn("q", F.explode(F.array(*[F.lit(float(q)) for q in qs])))
        .withColumn("_prev_cum", F.coalesce(F.lag("cumulative").over(w), F.lit(0)))
        .withColumn("_prev_le", F.coalesce(F.lag("le_bound").over(w), F.lit(0.0)))
        .withColumn("_total", F.max("cumulative").over(wall))
        .withColumn("_last_finite", F.max(F.when(~F.isnan("le_bound") & (F.col("le_bound") != float("inf")), F.col("le_bound"))).over(wall))
        .withColumn("_rank", F.col("q") * F.col("_total"))
    )
    hit = h.filter(F.col("cumulative") >= F.col("_rank"))
    first = hit.groupBy(*wkeys).agg(
        F.min_by(
            F.struct("le_bound", "_prev_le", "_prev_cum", "cumulative", "_rank", "_total", "_last_finite"),
            F.col("idx"),
        ).alias("b")
    )
    b = lambda c: F.col(f"b.{c}")
    inside = b("_prev_le") + (b("le_bound") - b("_prev_le")) * (
        (b("_rank") - b("_prev_cum")) / (b("cumulative") - b("_prev_cum"))
    )
    value = (
        F.when(b("_total") <= 0, F.lit(None).cast("double"))
        .when(b("le_bound") == float("inf"), b("_last_finite"))
        .when(b("cumulative") == b("_prev_cum"), b("le_bound"))
        .otherwise(inside)
    )
    return first.select(*keys, "q", value.alias("value"))


def sliding_histogram_quantile(
    log: DataFrame,
    value_col: str,
    qs: Sequence[float] = (0.5, 0.95),
    bounds: Sequence[float] = REQUEST_DURATION_BUCKETS,
    hours: int = 24,
    ts_col: str = "ts",
) -> DataFrame:
    """``histogram_quantile(q, sum(rate(bucket[window])) by (le))`` at every hour.

    Rates share one denominator per window, so quantiles of counts equal
    quantiles of rates.
    """
    hourly = bucket_counts_hourly(log, value_col, bounds, ts_col)
    win = sliding_hours(hourly.withColumnRenamed("cumulative", "cum"), ["idx", "le_bound"], ["cum"], hours)
    win = win.select("_h", "idx", "le_bound", F.col("cum").alias("cumulative"))
    out = histogram_quantiles(win, qs, ["_h"])
    return out.select(fmt_ts(F.col("_h")).alias("window_end_hour"), "q", "value")


# -------------------------------------------- trailing windows of any size and step


def _seconds(ts: str | F.Column) -> F.Column:
    """Whole seconds since the epoch by the wall clock of ``ts``."""
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.timestamp_diff("SECOND", F.lit(EPOCH).cast("timestamp_ntz"), c.cast("timestamp_ntz"))


def step_of(ts: str | F.Column, step: int) -> F.Column:
    """Number of the ``step``-second interval that ``ts`` lies in."""
    return F.floor(_seconds(ts) / step)


def step_end(number: F.Column, step: int) -> F.Column:
    """End of a step as text."""
    secs = (number + 1) * step
    at = F.make_dt_interval(F.floor(secs / 86_400).cast("int"), F.lit(0), F.lit(0), F.pmod(secs, F.lit(86_400)).cast("int"))
    return fmt_ts(F.lit(EPOCH).cast("timestamp_ntz") + at)


# Steps that one window task takes at most, besides those carried over.
CHUNK_STEPS = 1_440


def trailing_sums(
    steps: DataFrame, keys: Sequence[str], values: Sequence[str], size: int, step: int, max_gap: int | None = None
) -> DataFrame:
    """Sums of ``values`` over the trailing ``size`` seconds at the end of every step.

    ``steps`` holds ``(keys, step, values)``, one row per key and step with
    events.  Each key's steps run from its first to its last one; steps
    without events come in between as zeros, so a window that holds no event
    still has its row.  With ``max_gap`` a stretch without events ends after so
    many steps, until the next event.

    Time is cut into chunks of steps: a chunk's rows and the last ones before
    it, which its first windows reach back to, meet under ``(keys, chunk)``, and
    empty steps are made there.  So a task holds a chunk, however long the log
    or a stretch without events is, and whether there are keys or not.
    """
    if step <= 0 or size <= 0 or size % step:
        raise ValueError(f"window of {size} s is no multiple of its step of {step} s")
    keys, spark = list(keys), steps.sparkSession
    back = max(size // step - 1, max_gap or 0)
    length = max(CHUNK_STEPS, back)
    path = scratch_path(spark, f"steps-{uuid.uuid4().hex}")
    steps.filter(F.col("step").isNotNull()).write.parquet(path)  # read for the chunks and for their extent
    steps = spark.read.schema(steps.schema).parquet(path)
    chunk = F.floor(F.col("step") / length)
    reach = F.when(F.col("step") >= (chunk + 1) * length - back, F.array(chunk, chunk + 1)).otherwise(F.array(chunk))
    events = steps.select(*keys, "step", *values, F.explode(reach).alias("_chunk"))
    extent = [F.min("step").alias("_first"), F.max("step").alias("_last")]
    if keys:
        extents = steps.groupBy(*keys).agg(*extent)
        same = [f"_key_{i}" for i in range(len(keys))]
        whole = extents.select(
            *keys, "_first", "_last", F.explode(F.sequence(F.floor(F.col("_first") / length), F.floor(F.col("_last") / length))).alias("_chunk")
        )
    else:
        first, last = steps.agg(*extent).first()  # two numbers
        if first is None:
            first, last = 0, -1
        same, whole = [], spark.range(first // length, last // length + 1).select(
            F.lit(first).alias("_first"), F.lit(last).alias("_last"), F.col("id").alias("_chunk")
        )
    if max_gap is not None:  # chunks that an event is in, or reaches
        held = events.select(*[F.col(k).alias(c) for k, c in zip(keys, same, strict=True)], F.col("_chunk").alias("_held")).distinct()
        on = [whole["_chunk"] == held["_held"], *[whole[k].eqNullSafe(held[c]) for k, c in zip(keys, same, strict=True)]]
        whole = whole.join(held, on, "left_semi")
    low, high = F.greatest(F.col("_chunk") * length, "_first"), F.least((F.col("_chunk") + 1) * length - 1, "_last")
    empty = whole.filter(low <= high).select(
        *keys, F.explode(F.sequence(low, high)).alias("step"), *[F.lit(0).cast("bigint").alias(v) for v in values], "_chunk", F.lit(True).alias("_own")
    )
    both = events.withColumn("_own", F.lit(False)).unionByName(empty)
    order = Window.partitionBy(*keys, "_chunk").orderBy("step")
    trailing = order.rangeBetween(-(size // step - 1), 0)
    sums = both.select(
        *keys,
        "step",
        "_own",
        *[F.sum(v).over(trailing).cast("bigint").alias(v) for v in values],
        *([] if max_gap is None else [F.count_if(~F.col("_own")).over(order.rangeBetween(-max_gap, 0)).alias("_near")]),
    )
    return sums.filter(F.col("_own") if max_gap is None else F.col("_own") & (F.col("_near") > 0)).select(*keys, "step", *values)


def trailing_rate(
    log: DataFrame, keys: Sequence[str], ts_col: str = "ts", size: int = 300, step: int = 60, max_gap: int | None = None
) -> DataFrame:
    """Events per second over the trailing ``size`` seconds, per key at every step (0 without events)."""
    keys = list(keys)
    steps = log.groupBy(*keys, step_of(ts_col, step).alias("step")).agg(F.count(F.lit(1)).alias("n"))
    return trailing_sums(steps, keys, ["n"], size, step, max_gap).select(
        *keys, step_end(F.col("step"), step).alias("window_end"), "n", (F.col("n") / size).alias("rate_per_s")
    )


def _bound_columns(bounds: Sequence[float]) -> list[str]:
    return [f"le_{i}" for i in range(len(bounds))]


def request_steps(
    log: DataFrame,
    step: int,
    bounds: Sequence[float] = REQUEST_DURATION_BUCKETS,
    value_col: str = "duration_s",
    ts_col: str = "ts",
) -> DataFrame:
    """``(step, requests, errors, le_0, ...)`` over all labels, from the raw log."""
    return log.groupBy(step_of(ts_col, step).alias("step")).agg(
        F.count(F.lit(1)).alias("requests"),
        F.count_if(F.col("status") >= 400).alias("errors"),
        *[F.count_if(F.col(value_col) <= float(b)).alias(c) for c, b in zip(_bound_columns(bounds), bounds, strict=True)],
    )


def steps_of_windows(windows: DataFrame, step: int, bounds: Sequence[float] = REQUEST_DURATION_BUCKETS) -> DataFrame:
    """The same rows from tumbling window counts of at most ``step`` seconds (the metrics stream's sink)."""
    return windows.groupBy(step_of("window_start", step).alias("step")).agg(
        *[F.sum(c).alias(c) for c in ("requests", "errors", *_bound_columns(bounds))]
    )


def trailing_error_ratio(steps: DataFrame, size: int = 300, step: int = 60) -> DataFrame:
    """Errors / requests over the trailing ``size`` seconds at every step; null without requests."""
    return trailing_sums(steps, [], ["errors", "requests"], size, step).select(
        step_end(F.col("step"), step).alias("window_end"),
        "errors",
        "requests",
        (F.col("errors") / F.when(F.col("requests") > 0, F.col("requests"))).alias("error_ratio"),
    )


def trailing_quantiles(
    steps: DataFrame,
    qs: Sequence[float] = (0.5, 0.95),
    bounds: Sequence[float] = REQUEST_DURATION_BUCKETS,
    size: int = 300,
    step: int = 60,
) -> DataFrame:
    """Quantiles from buckets over the trailing ``size`` seconds at every step; null without requests."""
    cols = [*_bound_columns(bounds), "requests"]
    wide = trailing_sums(steps, [], cols, size, step)
    buckets = F.array(
        *[
            F.struct(F.lit(i).alias("idx"), F.lit(float(b)).alias("le_bound"), F.col(c).alias("cumulative"))
            for i, (c, b) in enumerate(zip(cols, [*bounds, float("inf")], strict=True))
        ]
    )
    hist = wide.select("step", F.inline(buckets))
    return histogram_quantiles(hist, qs, ["step"]).select(step_end(F.col("step"), step).alias("window_end"), "q", "value")


def _joined_null_safe(rows: DataFrame, table: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``rows`` with the other columns of ``table``, whose keys are unique; a null key meets a null key."""
    named = table.select(*[F.col(k).alias(f"_key_{i}") for i, k in enumerate(keys)], *[c for c in table.columns if c not in keys])
    same = [rows[k].eqNullSafe(named[f"_key_{i}"]) for i, k in enumerate(keys)]
    return rows.join(named, same, "inner").drop(*[f"_key_{i}" for i in range(len(keys))])


def counter_samples(log: DataFrame, series: Sequence[str], ts_col: str = "ts", tiebreak: str = "event_id") -> DataFrame:
    """Sampled counter table: each request is a sample of its series' counter,
    which restarts at every day (process restart); value = count since the restart.

    Distributed by (series, slot) with slots of a minute: per-slot counts (one
    row each) give every slot its offset inside the day, and the running count
    runs inside a slot only, so a busy series spreads over its minutes.
    """
    series = list(series)
    s = log.withColumn("_day", F.date_trunc("day", F.col(ts_col))).withColumn("_slot", F.date_trunc("minute", F.col(ts_col)))
    per_slot = s.groupBy(*series, "_day", "_slot").agg(F.count(F.lit(1)).alias("_n"))
    wo = Window.partitionBy(*series, "_day").orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_slot.select(*series, "_slot", F.coalesce(F.sum("_n").over(wo), F.lit(0)).alias("_off"))
    w = Window.partitionBy(*series, "_slot").orderBy(ts_col, tiebreak).rowsBetween(Window.unboundedPreceding, 0)
    return _joined_null_safe(s, offsets, [*series, "_slot"]).select(
        *series, ts_col, tiebreak, (F.col("_off") + F.count(F.lit(1)).over(w)).cast("double").alias("value")
    )


def counter_increase(
    samples: DataFrame, series: Sequence[str], ts_col: str = "ts", tiebreak: str = "event_id"
) -> DataFrame:
    """Increase per series and hour with reset handling (``d < 0`` -> use ``v``).

    Distributed by (series, slot) with slots of a minute: the first sample of a
    slot compares with the last sample of the series' previous non-empty slot,
    taken from a per-slot table (one row each), not from raw rows.
    """
    series = list(series)
    s = samples.withColumn("_slot", F.date_trunc("minute", F.col(ts_col)))
    last = s.groupBy(*series, "_slot").agg(
        F.max_by(F.col("value"), F.struct(F.col(ts_col), F.col(tiebreak))).alias("_last")
    )
    wl = Window.partitionBy(*series).orderBy("_slot")
    prev = last.select(*series, "_slot", F.lag("_last").over(wl).alias("_prev_last"))
    w = Window.partitionBy(*series, "_slot").orderBy(ts_col, tiebreak)
    joined = _joined_null_safe(s, prev, [*series, "_slot"])
    before = F.coalesce(F.lag("value").over(w), F.col("_prev_last"))
    d = F.col("value") - before
    delta = F.when(before.isNull(), F.col("value")).when(d < 0, F.col("value")).otherwise(d)
    return (
        joined.withColumn("_d", delta)
        .groupBy(*series, hour_bucket(ts_col).alias("_h"))
        .agg(F.sum("_d").alias("increase"))
        .select(*series, fmt_ts(F.col("_h")).alias("bucket"), "increase")
    )
