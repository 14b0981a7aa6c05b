"""Streams equal their batch twins (closed windows)."""

from pyspark.sql import functions as F

import __spark_entry__ as E
from prioritext.plans.stream_queries import metrics_view
from prioritext.sources import tables as tb
from prioritext.streaming import jobs


def test_stream_metrics_equal_batch_twin_on_closed_windows(spark, sf001):
    stream = E.queries()["stream_metrics"](spark, sf001)
    batch = jobs.window_metrics(tb.request_log_of(jobs.as_event_time(tb.read_table(spark, sf001, "events"))))
    batch = batch.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "*").drop("w")
    batch = metrics_view(batch)
    cols = sorted(stream.columns)
    s = sorted(tuple(r) for r in stream.select(*cols).collect())
    b = {tuple(r) for r in batch.select(*cols).collect()}
    assert s and all(r in b for r in s)
    # only the last window per endpoint stays open in append mode
    assert len(b) - len(s) <= batch.select("endpoint").distinct().count()


def test_stream_score_equals_batch_scoring_of_admitted_documents(spark, sf001):
    from prioritext.operators import model as M
    from prioritext.operators.contracts import admission
    from prioritext.plans.model_queries import trained

    stream = E.queries()["stream_score"](spark, sf001)
    tm, _, _, _ = trained(spark, sf001)  # the same memoised model the stream used
    docs = tb.read_table(spark, sf001, "documents")
    ok = admission(docs, "text").filter(F.col("admitted"))
    batch = M.score_batch(tm, ok, "doc_id", "text")
    s = {r["doc_id"]: r["label"] for r in stream.select("doc_id", "label").collect()}
    b = {r["doc_id"]: r["label"] for r in batch.select("doc_id", "label").collect()}
    assert s == b
    assert len(s) == ok.count()
    assert stream.select("model_version").distinct().count() == 1


def test_stream_reads_a_folder_named_like_a_file(spark, tmp_path):
    rows = [(i, "ab cd " * i) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id LONG, text STRING")
    folder, one = f"{tmp_path}/documents.parquet", f"{tmp_path}/one"
    docs.repartition(3).write.parquet(folder)
    docs.coalesce(1).write.parquet(one)
    (file,) = [str(p) for p in (tmp_path / "one").iterdir() if p.name.endswith(".parquet")]
    for n, path in enumerate((folder, file, one)):
        stream = jobs.read_stream_parquet(spark, path, docs.schema)
        query = stream.writeStream.format("parquet").option("path", f"{tmp_path}/out{n}")
        query.option("checkpointLocation", f"{tmp_path}/ckpt{n}").trigger(availableNow=True).start().awaitTermination()
        found = spark.read.schema(docs.schema).parquet(f"{tmp_path}/out{n}").collect()
        assert sorted(tuple(r) for r in found) == rows
