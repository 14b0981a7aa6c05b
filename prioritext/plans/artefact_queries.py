"""Registered queries over files the library reads and writes beside its tables:
the category dimension, a model folder without metadata, the benchmark record."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prioritext.operators import evaluate as ev
from prioritext.operators import stats as st
from prioritext.plans.catalog import pairs, r6, register
from prioritext.session import scratch_path
from prioritext.sources import files as fs
from prioritext.sources import tables as tb


@register("dimension_scan")
def q_dimension_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Documents by the category that a dimension file names for their language. The file is derived from the
    corpus (each language but the last, named after its first source), its columns in another order, with one more."""
    docs = tb.read_table(spark, sf, "documents").select("lang", "source")
    by_lang = docs.groupBy("lang").agg(F.min("source").alias("first"), F.count(F.lit(1)).alias("n"))
    last = docs.agg(F.max("lang")).first()[0]  # one row
    path = scratch_path(spark, f"dimension-{uuid.uuid4().hex}")
    named = F.concat(F.col("lang"), F.lit(', "'), F.col("first"), F.lit('"\nsource')).alias("condition_name")
    fs.write_csv(by_lang.filter(F.col("lang") != last).select(named, "n", F.col("lang").alias("condition_label")), path)
    dim = fs.read_dimension(spark, path)
    joined = docs.join(dim, docs["lang"] == dim["condition_label"], "left")
    return joined.groupBy(F.coalesce("condition_name", F.lit("unmatched")).alias("condition_name")).agg(
        F.count(F.lit(1)).alias("n")
    )


@register("class_order_fallback")
def q_class_order_fallback(spark: SparkSession, sf: str) -> DataFrame:
    """The languages of the corpus as classes of three model folders: with full metadata, with metadata
    that names no classes, and without any."""
    docs = tb.read_table(spark, sf, "documents").select(F.col("lang").alias("label"))
    base = scratch_path(spark, f"classes-{uuid.uuid4().hex}")
    order = ev.class_order(docs)
    listed = F.concat_ws(",", F.sort_array(F.collect_set("label")))
    meta = docs.agg(F.format_string("over %d", F.count(F.lit(1))).alias("trained_at"), listed.alias("classes"))
    fs.save_tables({"metadata": meta}, f"{base}/full")
    fs.save_tables({"metadata": meta.drop("classes"), "classes": order}, f"{base}/unnamed")
    fs.save_tables({"classes": order}, f"{base}/bare")
    out = None
    for name in ("full", "unnamed", "bare"):
        row = fs.read_model_info(spark, f"{base}/{name}").select(
            F.lit(name).alias("folder"), "model_version", F.array_join("classes", ",").alias("classes"), "classes_from"
        )
        out = row if out is None else out.unionByName(row)
    return out


@register("bench_record")
def q_bench_record(spark: SparkSession, sf: str) -> DataFrame:
    """The record of a comparison of two backends, written and read back: latency by
    backend, agreement of the two labelings, reduction of the median, verdict."""
    log = tb.request_log(spark, sf)
    stats = st.latency_summary(log, ["backend"], "duration_ms").select("backend", "n", "mean", "p50", "p95")
    p = pairs(spark, sf)
    agreement = ev.equivalence(p.select("doc_id", F.col("y_true").alias("label")), p.select("doc_id", F.col("y_pred").alias("label")))
    path = scratch_path(spark, f"bench-{uuid.uuid4().hex}")
    fs.write_bench_record(stats, agreement, ev.relative_reduction(stats, "base", "new"), path, {"sf": "given"})
    got = spark.read.json(path)
    return got.select(
        "sf",
        *[r6(F.col(f"backends.{b}.{c}")).alias(f"{c}_{b}") for b in ("base", "new") for c in ("mean", "p50", "p95")],
        *[F.col(f"backends.{b}.n").alias(f"n_{b}") for b in ("base", "new")],
        F.col("equivalence.n").alias("n_pairs"),
        r6("equivalence.agreement_pct").alias("agreement_pct"),
        r6("p50_reduction.reduction_pct").alias("reduction_pct"),
        "verdict",
    )
