"""Latency statistics and request-outcome summaries over a log table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

LATENCY_QUANTILES: tuple[float, ...] = (0.5, 0.9, 0.95, 0.99)


def elapsed_seconds(ts_min: F.Column, ts_max: F.Column) -> F.Column:
    """Seconds between two timestamps (NTZ or LTZ), time-zone independent."""
    return F.timestamp_diff("MICROSECOND", ts_min, ts_max) / 1e6


def latency_summary(
    log: DataFrame,
    keys: Sequence[str],
    value_col: str,
    time_col: str | None = None,
    approx: bool = False,
    accuracy: int = 10000,
) -> DataFrame:
    """Per group: n, mean, population stdev, min, p50/p90/p95/p99, max, throughput.

    Exact quantiles (linear interpolation) by default, computed by
    ``exact_quantiles`` so no group is ever held by one task.
    ``approx=True`` switches to ``percentile_approx`` (a bounded sketch).
    Throughput = n / (max(ts) - min(ts)) in seconds; no elapsed time -> null.
    """
    keys = list(keys)
    v = F.col(value_col)
    moments = [
        F.count(v).alias("n"),
        F.avg(v).alias("mean"),
        F.stddev_pop(v).alias("stdev"),
        F.min(v).alias("min"),
        F.max(v).alias("max"),
    ]
    if time_col:
        moments += [F.min(time_col).alias("_t0"), F.max(time_col).alias("_t1")]
    base = log.groupBy(*keys).agg(*moments)
    qs = F.array(*[F.lit(q) for q in LATENCY_QUANTILES])
    if approx:
        quant = log.groupBy(*keys).agg(F.percentile_approx(v, qs, accuracy).alias("_q"))
    else:
        eq = exact_quantiles(log, keys, value_col, LATENCY_QUANTILES)
        quant = eq.select(*keys, F.array(*[F.col(f"q_{i}") for i in range(len(LATENCY_QUANTILES))]).alias("_q"))
    out = base.join(quant, keys, "left") if keys else merge_one_row(base, quant)
    cols = [F.col(k) for k in keys] + [
        F.col("n").cast("bigint").alias("n"),
        "mean",
        "stdev",
        "min",
        F.col("_q")[0].alias("p50"),
        F.col("_q")[1].alias("p90"),
        F.col("_q")[2].alias("p95"),
        F.col("_q")[3].alias("p99"),
        "max",
    ]
    if time_col:
        secs = elapsed_seconds(F.col("_t0"), F.col("_t1"))
        cols.append((F.col("n") / F.when(secs > 0, secs)).alias("throughput"))
    return out.select(*cols)


def exact_quantiles(
    df: DataFrame,
    keys: Sequence[str],
    value_col: str,
    qs: Sequence[float],
    num_partitions: int | None = None,
) -> DataFrame:
    """Exact, linearly interpolated quantiles per group, distributed.

    No group is ever held by one task: values are first counted per
    ``(keys, value)`` (map-side combine), the distinct values are
    range-partitioned on ``(keys, value)`` so a hot key spans many
    partitions, running counts are taken inside each partition, and a small
    per-(key, partition) table gives each partition its offset.  The two
    order statistics each quantile needs are then picked by conditional
    aggregates and interpolated.  Output: ``keys + q_<i>`` columns
    (``q_0`` for ``qs[0]`` ...), plus ``n``.
    """
    keys = list(keys)
    spark = df.sparkSession
    n_parts = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    v = F.col(value_col)
    counted = df.filter(v.isNotNull()).groupBy(*keys, v.alias("_v")).agg(F.count(F.lit(1)).alias("_c"))
    ranged = counted.repartitionByRange(n_parts, *[F.col(k) for k in keys], F.col("_v")).withColumn(
        "_pid", F.spark_partition_id()
    )
    wl = Window.partitionBy(*keys, "_pid").orderBy("_v").rowsBetween(Window.unboundedPreceding, -1)
    local = ranged.withColumn("_before", F.coalesce(F.sum("_c").over(wl), F.lit(0)))
    per = ranged.groupBy(*keys, "_pid").agg(F.sum("_c").alias("_pc"))  # one row per key and partition
    wo = Window.partitionBy(*keys).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offs = per.select(
        *keys,
        "_pid",
        F.coalesce(F.sum("_pc").over(wo), F.lit(0)).alias("_off"),
        F.sum("_pc").over(Window.partitionBy(*keys)).alias("_n"),
    )
    a, b = local.alias("a"), offs.alias("b")
    cond = [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in keys] + [F.col("a._pid") == F.col("b._pid")]
    rows = a.join(b, cond, "inner").select(
        *[F.col(f"a.{k}").alias(k) for k in keys], "a._v", "a._c", (F.col("b._off") + F.col("a._before")).alias("_cb"), "b._n"
    )
    aggs = [F.max("_n").alias("n")]
    for i, q in enumerate(qs):
        pos = F.lit(float(q)) * (F.col("_n") - 1)
        for side, r in (("lo", F.floor(pos)), ("hi", F.ceil(pos))):
            hit = (F.col("_cb") <= r) & (r < F.col("_cb") + F.col("_c"))
            aggs.append(F.max(F.when(hit, F.col("_v"))).alias(f"_{side}{i}"))
    picked = rows.groupBy(*keys).agg(*aggs)
    outs = []
    for i, q in enumerate(qs):
        pos = F.lit(float(q)) * (F.col("n") - 1)
        frac = pos - F.floor(pos)
        outs.append((F.col(f"_lo{i}") + frac * (F.col(f"_hi{i}") - F.col(f"_lo{i}"))).alias(f"q_{i}"))
    return picked.select(*keys, F.col("n").cast("bigint").alias("n"), *outs)


def merge_one_row(a: DataFrame, b: DataFrame) -> DataFrame:
    """Merge two one-row aggregates by a union and a two-row aggregate (no join)."""
    a_cols = [c for c in a.columns]
    b_cols = [c for c in b.columns]
    left = a.select(*[F.col(c) for c in a_cols], *[F.lit(None).cast(b.schema[c].dataType).alias(c) for c in b_cols])
    right = b.select(*[F.lit(None).cast(a.schema[c].dataType).alias(c) for c in a_cols], *[F.col(c) for c in b_cols])
    return left.unionByName(right).agg(*[F.first(c, ignorenulls=True).alias(c) for c in a_cols + b_cols])


def latency_median(log: DataFrame, keys: Sequence[str], value_col: str) -> DataFrame:
    """Median per group (mean of the two middle values for even counts), exact
    and distributed (``exact_quantiles``), not ``median`` over one task's buffer."""
    return exact_quantiles(log, keys, value_col, (0.5,)).select(*keys, F.col("q_0").alias("median"))


def load_summary(log: DataFrame, status_col: str = "status", value_col: str = "duration_ms", time_col: str = "ts") -> DataFrame:
    """1 row: requested, ok (< 400), failed, mean latency (failures included), throughput.

    Throughput = ok / elapsed seconds, 0 when no time elapsed.
    """
    agg = log.agg(
        F.count(F.lit(1)).alias("requested"),
        F.count_if(F.col(status_col) < 400).alias("ok"),
        F.avg(value_col).alias("mean_latency_ms"),
        F.min(time_col).alias("_t0"),
        F.max(time_col).alias("_t1"),
    )
    secs = elapsed_seconds(F.col("_t0"), F.col("_t1"))
    return agg.select(
        F.col("requested").cast("bigint").alias("requested"),
        F.col("ok").cast("bigint").alias("ok"),
        (F.col("requested") - F.col("ok")).cast("bigint").alias("failed"),
        "mean_latency_ms",
        F.coalesce(F.col("ok") / F.when(secs > 0, secs), F.lit(0.0)).alias("throughput"),
    )
