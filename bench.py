"""Headline benchmark: batch throughput of the main jobs.

Runs on ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) with
``local[$BENCH_CPUS]``; warm session, 3 timed runs per job, median.
Every run executes the whole plan into the ``noop`` sink (nothing is
collected).  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from prioritext.operators import features as fe  # noqa: E402
from prioritext.operators import model as M  # noqa: E402
from prioritext.operators import requestlog as rl  # noqa: E402
from prioritext.operators.common import spread  # noqa: E402
from prioritext.plans import catalog  # noqa: E402
from prioritext.plans.model_queries import split_labelled  # noqa: E402
from prioritext.session import get_session  # noqa: E402
from prioritext.sources import tables as tb  # noqa: E402

RUNS = int(os.environ.get("BENCH_RUNS", "3"))


def timed(df_fn) -> float:
    t0 = time.perf_counter()
    df_fn().write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_session(f"local[{cpus}]", shuffle_partitions=int(cpus))

    docs = tb.read_table(spark, sf, "documents").select("doc_id", "text")
    n_docs = docs.count()
    n_events = tb.read_table(spark, sf, "events").count()

    # one training run (not timed as a headline job)
    t0 = time.perf_counter()
    train_df, _ = split_labelled(spark, sf)
    tm = M.train(train_df, M.TrainConfig(id_col="id", text_col="text", label_col="label"))
    train_sec = time.perf_counter() - t0
    tabs = M.export_tables(tm)
    vocab = tabs["vocab"].cache()
    coef = tabs["coef"].cache()
    vocab.count()
    coef.count()
    intercepts = M.intercept_list(tabs["intercept"])

    def q_label():
        return catalog.labelled(spark, sf)

    def q_tfidf():
        return fe.tfidf_for(docs, vocab, "doc_id", "text")

    def q_score_batch():
        return M.score_batch(tm, docs, "doc_id", "text")

    def q_score_tables():
        return M.score_text(spread(docs, key="doc_id"), vocab, coef, intercepts, "doc_id", "text", "tables")

    def q_hist():
        return rl.cumulative_histogram(tb.request_log(spark, sf), ["endpoint"], "duration_s")

    def q_hq():
        return rl.sliding_histogram_quantile(tb.request_log(spark, sf), "duration_s", (0.5, 0.95))

    jobs = {
        "label_documents": (q_label, n_docs, "documents/s"),
        "tfidf_weights": (q_tfidf, n_docs, "documents/s"),
        "score_batch": (q_score_batch, n_docs, "documents/s"),
        "score_tables": (q_score_tables, n_docs, "documents/s"),
        "duration_histogram": (q_hist, n_events, "events/s"),
        "histogram_quantile": (q_hq, n_events, "events/s"),
    }
    medians: dict[str, float] = {}
    throughput: dict[str, dict] = {}
    for name, (fn, n, unit) in jobs.items():
        timed(fn)  # warm-up
        runs = [timed(fn) for _ in range(RUNS)]
        med = statistics.median(runs)
        medians[name] = round(med, 4)
        throughput[name] = {"rows": n, "per_sec": round(n / med, 1), "unit": unit}
    out = {
        "metric": "headline_jobs_median_total",
        "value": round(sum(medians.values()), 4),
        "unit": "sec",
        "queries": medians,
        "throughput": throughput,
        "train_sec": round(train_sec, 2),
        "train_iterations": tm.pipeline.stages[-1].summary.totalIterations,
        "sf": os.path.basename(sf.rstrip("/")).replace("sf", ""),
        "cpus": int(cpus),
        "runs": RUNS,
    }
    sink = os.environ.get("BENCH_RESULTS_DIR")
    if sink:
        from datetime import datetime, timezone

        from prioritext.sources.files import append_bench_results

        at = datetime.now(timezone.utc).isoformat(timespec="seconds")
        append_bench_results(
            spark,
            [(at, out["sf"], k, medians[k], v["rows"], v["per_sec"], v["unit"]) for k, v in throughput.items()],
            sink,
        )
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    F  # noqa: B018
    main()
