"""Request-log operators checked against brute force on small fixtures."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from prioritext.operators import requestlog as rl
from prioritext.operators import stats as st


def _prom_quantile(q, bounds, cum):
    """Reference algorithm (public PromQL semantics) on one bucket vector."""
    total = cum[-1]
    if total == 0:
        return None
    rank = q * total
    b = next(i for i, c in enumerate(cum) if c >= rank)
    if b == len(cum) - 1:
        return bounds[-1]
    start = 0.0 if b == 0 else bounds[b - 1]
    prev = 0 if b == 0 else cum[b - 1]
    if cum[b] == prev:
        return bounds[b]
    return start + (bounds[b] - start) * ((rank - prev) / (cum[b] - prev))


def test_cumulative_histogram_and_quantile_vs_brute_force(spark):
    rng = random.Random(3)
    bounds = [0.005, 0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1.0]
    rows = [("a" if i % 3 else "b", rng.expovariate(20.0)) for i in range(400)]
    rows.append(("a", 0.05))  # a value equal to a bound falls in it
    df = spark.createDataFrame(rows, "k STRING, v DOUBLE")
    hist = rl.cumulative_histogram(df, ["k"], "v", bounds)
    got = {(r["k"], r["idx"]): r["cumulative"] for r in hist.collect()}
    for key in ("a", "b"):
        vals = [v for k, v in rows if k == key]
        for i, b in enumerate(bounds):
            assert got[(key, i)] == sum(1 for v in vals if v <= b)
        assert got[(key, len(bounds))] == len(vals)
    h = hist.select("k", "idx", F.when(F.col("le") == "+Inf", float("inf")).otherwise(F.col("le").cast("double")).alias("le_bound"), "cumulative")
    for q in (0.5, 0.95, 0.999):
        res = {r["k"]: r["value"] for r in rl.histogram_quantile(h, q, ["k"]).collect()}
        for key in ("a", "b"):
            cum = [got[(key, i)] for i in range(len(bounds) + 1)]
            assert res[key] == pytest.approx(_prom_quantile(q, bounds, cum))

    # several q in one pass give the same values as one q at a time
    qs = (0.5, 0.95, 0.999)
    multi = {(r["k"], r["q"]): r["value"] for r in rl.histogram_quantiles(h, qs, ["k"]).collect()}
    assert len(multi) == 2 * len(qs)
    for q in qs:
        for r in rl.histogram_quantile(h, q, ["k"]).collect():
            assert multi[(r["k"], q)] == r["value"]


def test_counter_increase_with_resets(spark):
    t0 = dt.datetime(2024, 1, 1, 0, 0, 0)
    # series s: 1,2,3 then a restart (1,2) in the same hour; next hour 3
    vals = [1.0, 2.0, 3.0, 1.0, 2.0, 3.0]
    mins = [0, 10, 20, 30, 40, 70]
    rows = [("s", t0 + dt.timedelta(minutes=m), i, v) for i, (m, v) in enumerate(zip(mins, vals))]
    df = spark.createDataFrame(rows, "series STRING, ts TIMESTAMP_NTZ, event_id INT, value DOUBLE")
    inc = {r["bucket"]: r["increase"] for r in rl.counter_increase(df, ["series"]).collect()}
    assert inc == {"2024-01-01 00:00:00": 5.0, "2024-01-01 01:00:00": 1.0}


def test_error_ratio_and_running_total(spark):
    t0 = dt.datetime(2024, 1, 1, 0, 0, 0)
    rows = [(t0 + dt.timedelta(minutes=20 * i), 500 if i % 4 == 0 else 200, "x") for i in range(9)]
    df = spark.createDataFrame(rows, "ts TIMESTAMP_NTZ, status INT, label STRING")
    er = {r["window_end_hour"]: (r["errors"], r["requests"]) for r in rl.error_ratio(df, "ts", 2).collect()}
    assert er["2024-01-01 00:00:00"] == (1, 3)
    assert er["2024-01-01 01:00:00"] == (2, 6)
    assert er["2024-01-01 02:00:00"] == (2, 6)
    run = [r["running"] for r in rl.running_total(df, ["label"]).orderBy("bucket").collect()]
    assert run == [3, 6, 9]


def test_latency_summary_population_stdev_and_linear_quantiles(spark):
    vals = [float(i) for i in range(1, 11)]
    t0 = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([("k", v, t0 + dt.timedelta(seconds=i)) for i, v in enumerate(vals)], "b STRING, v DOUBLE, ts TIMESTAMP_NTZ")
    r = st.latency_summary(df, ["b"], "v", "ts").first()
    assert r["n"] == 10 and r["mean"] == 5.5 and r["stdev"] == pytest.approx(2.8722813232690143)
    assert r["p50"] == 5.5 and r["p90"] == pytest.approx(9.1) and r["p99"] == pytest.approx(9.91)
    assert r["throughput"] == pytest.approx(10 / 9)
    a = st.latency_summary(df, ["b"], "v", approx=True).first()
    assert a["p50"] in vals
    m = st.latency_median(df, ["b"], "v").first()
    assert m["median"] == 5.5


def test_model_info_latest_only(spark):
    t0 = dt.datetime(2024, 1, 1)
    loads = spark.createDataFrame(
        [(t0, "sklearn", "v1"), (t0 + dt.timedelta(hours=1), "onnx", "v2"), (t0 + dt.timedelta(hours=2), "custom", "v3")],
        "ts TIMESTAMP_NTZ, backend STRING, model_version STRING",
    )
    r = rl.model_info(loads).collect()
    assert [(x["backend"], x["model_version"], x["model_type"], x["value"]) for x in r] == [("custom", "v3", "custom", 1.0)]
    r2 = rl.model_info(loads.filter(F.col("backend") != "custom")).first()
    assert r2["model_type"] == "onnx-runtime"


def test_endpoint_normalize(spark):
    paths = spark.createDataFrame([(1, "/a/1", "a"), (2, "/zz", "zz"), (3, "/metrics", "metrics")], "id INT, path STRING, segment STRING")
    routes = spark.createDataFrame([("a", "/a/{id}")], "segment STRING, route STRING")
    got = {r["id"]: r["endpoint"] for r in rl.endpoint_normalize(paths, routes).collect()}
    assert got == {1: "/a/{id}", 2: "unmatched"}


def test_errors_total_types(spark):
    df = spark.createDataFrame(
        [("/p", 422, False), ("/p", 500, False), ("/p", 500, True), ("/p", 200, False)], "endpoint STRING, status INT, unhandled BOOLEAN"
    )
    got = {r["type"]: r["n"] for r in rl.errors_total(df).collect()}
    assert got == {"client_error": 1, "server_error": 1, "unhandled_exception": 1}


def test_exact_quantiles_distributed_equal_percentile(spark):
    rng = random.Random(11)
    # one hot key with many duplicates, one small key, one key with a single value
    rows = [("hot", float(rng.randint(0, 500)) / 10) for _ in range(3000)]
    rows += [("small", rng.random()) for _ in range(7)] + [("one", 4.2)]
    df = spark.createDataFrame(rows, "k STRING, v DOUBLE").repartition(5)
    qs = (0.0, 0.35, 0.5, 0.9, 0.99, 1.0)
    got = {r["k"]: r for r in st.exact_quantiles(df, ["k"], "v", qs, num_partitions=7).collect()}
    ref = df.groupBy("k").agg(F.percentile("v", F.array(*[F.lit(q) for q in qs])).alias("p"), F.count("v").alias("n")).collect()
    for r in ref:
        g = got[r["k"]]
        assert g["n"] == r["n"]
        for i, _ in enumerate(qs):
            assert g[f"q_{i}"] == pytest.approx(r["p"][i], abs=1e-12)


def test_trailing_windows_vs_brute_force(spark):
    rng = random.Random(8)
    start = dt.datetime(2024, 3, 1, 23, 50)
    rows = []
    for i in range(300):
        gap = 0 if i < 150 else 1_500  # a stretch without events
        rows.append((start + dt.timedelta(seconds=rng.uniform(0, 900) + gap), rng.choice(["/a", None]), rng.choice([200, 500]), rng.uniform(0, 3)))
    log = spark.createDataFrame(rows, "ts TIMESTAMP_NTZ, endpoint STRING, status INT, duration_s DOUBLE")
    size, step, bounds = 300, 60, (0.5, 1.0, 2.0)
    epoch = dt.datetime(1970, 1, 1)
    number = [int((r[0] - epoch).total_seconds() // step) for r in rows]
    end = lambda i: (epoch + dt.timedelta(seconds=(i + 1) * step)).strftime("%Y-%m-%d %H:%M:%S")
    inside = lambda i, key=...: [r for n, r in zip(number, rows, strict=True) if i - 5 < n <= i and key in (..., r[1])]

    want = {}
    for key in ("/a", None):
        mine = [n for n, r in zip(number, rows, strict=True) if r[1] == key]
        want |= {(key, end(i)): len(inside(i, key)) for i in range(min(mine), max(mine) + 1)}
    got = rl.trailing_rate(log, ["endpoint"], "ts", size, step).collect()
    assert {(r.endpoint, r.window_end): r.n for r in got} == want and len(got) == len(want)
    assert 0 in want.values() and all(r.rate_per_s == r.n / size for r in got)

    steps = rl.request_steps(log, step, bounds)
    ratio = {r.window_end: r.error_ratio for r in rl.trailing_error_ratio(steps, size, step).collect()}
    quantile = {(r.window_end, r.q): r.value for r in rl.trailing_quantiles(steps, (0.5, 0.95), bounds, size, step).collect()}
    for i in range(min(number), max(number) + 1):
        now = inside(i)
        assert ratio[end(i)] == (sum(r[2] >= 400 for r in now) / len(now) if now else None)
        cum = [sum(r[3] <= b for r in now) for b in bounds] + [len(now)]
        for q in (0.5, 0.95):
            assert quantile[end(i), q] == pytest.approx(_prom_quantile(q, bounds, cum))


def test_trailing_window_must_be_a_multiple_of_its_step(spark):
    log = spark.createDataFrame([(dt.datetime(2024, 1, 1),)], "ts TIMESTAMP_NTZ")
    with pytest.raises(ValueError, match="multiple"):
        rl.trailing_rate(log, [], "ts", 300, 70)


def test_counter_of_a_null_series_within_one_hour(spark):
    start = dt.datetime(2024, 5, 1, 10)
    rows = [(i, start + dt.timedelta(seconds=11 * i), None if i % 3 else "/a") for i in range(300)]
    log = spark.createDataFrame(rows, "event_id LONG, ts TIMESTAMP_NTZ, endpoint STRING")
    samples = rl.counter_samples(log, ["endpoint"]).collect()
    for key, n in ((None, 200), ("/a", 100)):
        mine = sorted((r.ts, r.value) for r in samples if r.endpoint == key)
        assert [v for _, v in mine] == [float(i + 1) for i in range(n)]
    increase = {r.endpoint: r.increase for r in rl.counter_increase(rl.counter_samples(log, ["endpoint"]), ["endpoint"]).collect()}
    assert increase == {None: 200.0, "/a": 100.0}


def _steps(spark, rows):
    return spark.createDataFrame(rows, "k STRING, step LONG, n LONG")


def test_trailing_sums_over_chunks_and_a_stray_step(spark):
    rng = random.Random(3)
    numbers = sorted(rng.sample(range(100_000, 108_000), 900))
    rows = [("a", i, rng.randrange(1, 5)) for i in numbers] + [("a", 400_000, 1), (None, 7, 2), (None, 3, 1)]
    for w, step in ((5, 60), (2_000, 60)):
        got = rl.trailing_sums(_steps(spark, rows), ["k"], ["n"], w * step, step)
        found = {(r.k, r.step): r.n for r in got.collect()}
        for key in ("a", None):
            mine = {i: n for k, i, n in rows if k == key}
            first, last, total = min(mine), max(mine), 0
            for i in range(first, last + 1):
                total += mine.get(i, 0) - mine.get(i - w, 0)
                assert found.pop((key, i)) == total
        assert not found
    bare = rl.trailing_sums(_steps(spark, rows[:-2]).drop("k"), [], ["n"], 300, 60)
    assert "SinglePartition" not in bare._jdf.queryExecution().executedPlan().toString()
    assert bare.count() == 400_000 - numbers[0] + 1
    assert rl.trailing_sums(_steps(spark, []).drop("k"), [], ["n"], 300, 60).count() == 0


def test_trailing_sums_end_in_a_long_gap(spark):
    rng = random.Random(4)
    rows = [("a", i, 1) for i in rng.sample(range(1_000, 4_000), 60)] + [("a", -25_000_000, 1), (None, 1_439, 1), (None, 1_450, 2)]
    for gap in (0, 3, 300):
        got = rl.trailing_sums(_steps(spark, rows), ["k"], ["n"], 300, 60, gap).collect()
        want = {}
        for key in ("a", None):
            mine = {i: n for k, i, n in rows if k == key}
            for i in {j for e in mine for j in range(e, min(e + gap, max(mine)) + 1)}:
                want[key, i] = sum(n for j, n in mine.items() if i - 5 < j <= i)
        assert {(r.k, r.step): r.n for r in got} == want and len(got) == len(want)
