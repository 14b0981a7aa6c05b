"""Metrics kept by a stream: restart, replay, nulls; chained sliding windows against the raw log."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from prioritext.operators.common import EngineError
from prioritext.sources import versions
from prioritext.streaming import jobs, running

LOG = "ts TIMESTAMP, endpoint STRING, method STRING, status INT, unhandled BOOLEAN, label STRING, duration_s DOUBLE"
T0 = dt.datetime(2024, 1, 1, 0, 0, 0)


def at(seconds):
    return T0 + dt.timedelta(seconds=seconds)


def rows(n, start=0):
    endpoints = ("/predict", "/predict/batch", "/health", "/metrics", None)
    for i in range(start, start + n):
        status = (200, 422, 500, None)[i % 4]
        duration = None if i % 11 == 0 else (i % 17) / 5
        yield at(i * 37), endpoints[i % 5], None if i % 13 == 0 else "POST", status, i % 3 == 0, ("a", "b", None)[i % 3], duration


def shown(df):
    return sorted((r["metric"], r["series"], round(r["value"], 9)) for r in df.collect())


def drain(query):
    query.awaitTermination()
    assert query.exception() is None


def test_stopped_and_started_again_the_series_equal_the_batch(spark, tmp_path):
    log, out, ckpt = (f"{tmp_path}/{n}" for n in ("log", "out", "ckpt"))
    for start in (0, 150, 300):
        part = spark.createDataFrame(list(rows(150, start)), LOG)
        part.repartition(2).write.mode("append").parquet(log)
        stream = jobs.read_stream_parquet(spark, log, part.schema, max_files=1)
        drain(running.stream_counters(stream, out, ckpt, available_now=True))
        whole = running.series_values(running.request_cells(spark.read.parquet(log)))
        assert shown(running.current_series(spark, out)) == shown(whole)
    # two files a start, one batch a file; the older versions are gone
    assert versions.complete_versions(spark, out) == [4, 5, 6]
    drain(running.stream_counters(stream, out, ckpt, available_now=True))
    assert shown(running.current_series(spark, out)) == shown(whole)


def test_series_against_counts_by_hand(spark):
    cells = running.request_cells(spark.createDataFrame(list(rows(200)), LOG))
    got = {(r["metric"], r["series"]): r["value"] for r in running.series_values(cells).collect()}
    kept = [r for r in rows(200) if r[1] not in ("/metrics", None)]
    for e in ("/predict", "/health"):
        mine = [r for r in kept if r[1] == e]
        timed = [r[6] for r in mine if r[6] is not None]
        assert got["request_duration_count", f"endpoint={e}"] == len(timed)
        assert got["request_duration_sum", f"endpoint={e}"] == pytest.approx(sum(timed))
        assert got["request_duration_bucket", f"endpoint={e},le=1.0"] == sum(d <= 1.0 for d in timed)
        assert got["request_duration_bucket", f"endpoint={e},le=+Inf"] == len(timed)
        nulls = sum(r[2] is None and r[3] is None for r in mine)
        assert got.get(("requests_total", f"endpoint={e},method=null,status=null"), 0) == nulls
    scored = [r for r in kept if r[1] in running.SCORING_ENDPOINTS]
    assert got["predictions_total", "label=null"] == sum(r[5] is None for r in scored)
    assert not any("/metrics" in s for _, s in got)


def test_a_replayed_batch_counts_once_and_an_unfinished_one_is_not_seen(spark, tmp_path):
    base = f"{tmp_path}/out"
    first = running.request_cells(spark.createDataFrame(list(rows(80)), LOG))
    second = running.request_cells(spark.createDataFrame(list(rows(120)), LOG))
    running.merge_cells(spark, first, 0, base)
    before = shown(running.current_series(spark, base))
    # the writer dies after the table and before the manifest
    second.write.parquet(f"{versions.version_path(base, 2)}/cells")
    assert shown(running.current_series(spark, base)) == before
    for _ in range(2):
        assert running.merge_cells(spark, second, 1, base) == 2
        assert shown(running.current_series(spark, base)) == shown(running.series_values(second))
    with pytest.raises(EngineError, match="new output folder"):
        running.merge_cells(spark, first, 0, base)


def test_no_requests_no_series(spark, tmp_path):
    base = f"{tmp_path}/out"
    running.merge_cells(spark, running.request_cells(spark.createDataFrame([], LOG)), 0, base)
    assert shown(running.current_series(spark, base)) == []


def test_sliding_windows_on_the_stream_equal_the_raw_log(spark, tmp_path):
    size, step, bounds = 600, 120, (0.5, 1.0, 2.0)
    log, out = f"{tmp_path}/log", f"{tmp_path}/out"
    # a stretch without requests, and a late stray that only moves the watermark
    data = [*rows(60), *rows(40, 130), (at(40_000), "/health", "GET", 200, False, "a", 0.1)]
    spark.createDataFrame(data, LOG).write.parquet(log)
    stream = jobs.read_stream_parquet(spark, log, spark.read.parquet(log).schema)
    drain(running.stream_sliding(stream, out, f"{tmp_path}/ckpt", "0 seconds", size, step, bounds, available_now=True))
    got = {r["window_end"]: r for r in spark.read.parquet(out).collect()}
    seconds = [int((r[0] - T0).total_seconds()) for r in data]
    want = {}
    for end in range(step, max(seconds) + 1, step):
        inside = [r for r, s in zip(data, seconds, strict=True) if end - size <= s < end]
        if inside:
            want[at(end)] = inside
    assert set(got) == set(want)
    for end, inside in want.items():
        r, n = got[end], len(inside)
        errors = sum(x[3] is not None and x[3] >= 400 for x in inside)
        assert (r["requests"], r["errors"], r["rate_per_s"]) == (n, errors, n / size)
        assert r["error_ratio"] == pytest.approx(errors / n)
        for name, q in (("p50", 0.5), ("p95", 0.95)):
            cum = [sum(x[6] is not None and x[6] <= b for x in inside) for b in bounds]
            low, below, value = 0.0, 0, bounds[-1]
            for b, c in zip(bounds, cum, strict=True):
                if c >= q * n:
                    value = low + (b - low) * (q * n - below) / (c - below)
                    break
                low, below = b, c
            assert r[name] == pytest.approx(value)


def test_sliding_size_must_be_a_multiple_of_the_step(spark):
    with pytest.raises(EngineError, match="multiple"):
        running.sliding_counts(spark.createDataFrame([], LOG), 100, 30)


def test_quantile_of_a_row_without_observations_is_null(spark):
    df = spark.range(1).select(running.bucket_quantile([F.lit(0)], F.lit(0), 0.5, [1.0]).alias("v"))
    assert df.first()["v"] is None
