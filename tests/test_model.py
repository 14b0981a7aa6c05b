"""Training and the two scoring paths on the smallest test tables."""

import pytest
from pyspark.sql import functions as F

from prioritext.operators import features as fe
from prioritext.operators import model as M
from prioritext.operators.evaluate import equivalence
from prioritext.plans.catalog import labelled


@pytest.fixture(scope="module")
def fitted(spark, sf001):
    lab = labelled(spark, sf001).select("id", "text", "label").cache()
    tm = M.train(lab, M.TrainConfig(id_col="id", max_iter=60))
    return tm, lab


def test_class_weights_and_idf(spark):
    df = spark.createDataFrame([("a",)] * 6 + [("b",)] * 2, "label STRING")
    w = {r["label"]: r["weight"] for r in fe.class_weights(df).collect()}
    assert w == {"a": pytest.approx(8 / (2 * 6)), "b": pytest.approx(8 / (2 * 2))}
    docs = spark.createDataFrame([(1, "x y"), (2, "x z"), (3, "q")], "doc_id INT, text STRING")
    dt = fe.doc_term_counts(docs.withColumn("text", F.regexp_replace("text", r"(\w)", "$1$1")))
    v = {r["term"]: r for r in fe.fit_vocabulary(dt, 3, min_df=1, max_features=10).collect()}
    import math

    assert v["xx"]["idf"] == pytest.approx(math.log(4 / 3) + 1)
    assert v["qq"]["idf"] == pytest.approx(math.log(4 / 2) + 1)


def test_vocabulary_cap_and_min_df(spark):
    docs = spark.createDataFrame([(1, "aa bb cc"), (2, "aa bb"), (3, "aa dd")], "doc_id INT, text STRING")
    v = fe.fit_vocabulary(fe.doc_term_counts(docs), 3, min_df=2, max_features=2).collect()
    # tf: aa 3, "aa bb" 2, bb 2 (tie broken by term), cc and dd below min_df
    assert [(r["term"], r["idx"]) for r in v] == [("aa", 0), ("aa bb", 1)]


def test_probabilities_sum_to_one_and_paths_agree(spark, fitted):
    tm, lab = fitted
    a = M.score_batch(tm, lab, "id", "text")
    sums = a.select(F.aggregate(F.map_values("scores"), F.lit(0.0), lambda s, x: s + x).alias("s")).collect()
    assert all(abs(r["s"] - 1.0) < 1e-6 for r in sums)
    assert a.count() == lab.count()
    tabs = M.export_tables(tm)
    w = M.weights_for(lab, tabs["vocab"], "id", "text")
    b = M.score_tables(lab, w, tabs["coef"], M.intercept_list(tabs["intercept"]), "id")
    r = equivalence(a, b, "id", "label").first()
    assert r["unpaired"] == 0 and r["agreement_pct"] >= 99.0


def test_paths_agree_on_decomposed_text(spark):
    import unicodedata

    rows = [(i, f"maçã café número{i % 3} été", "a") for i in range(6)] + [(i, f"ação língua número{i % 3}", "b") for i in range(6, 12)]
    rows = [(i, unicodedata.normalize("NFD", t), c) for i, t, c in rows]
    docs = spark.createDataFrame(rows, "id LONG, text STRING, label STRING")
    tm = M.train(docs, M.TrainConfig(id_col="id", max_iter=20, min_df=1))
    terms = {r["term"] for r in tm.vocab.collect()}
    assert {"maca", "cafe", "ete", "acao", "lingua", "maca cafe"} <= terms
    tabs = M.export_tables(tm)
    w = M.weights_for(docs, tabs["vocab"], "id", "text")
    b = {r["id"]: r for r in M.score_tables(docs, w, tabs["coef"], M.intercept_list(tabs["intercept"]), "id").collect()}
    a = {r["id"]: r for r in M.score_batch(tm, docs, "id", "text").collect()}
    assert len(a) == len(b) == 12
    for i, _, label in rows:
        assert a[i]["label"] == b[i]["label"] == label
        for c in tm.classes:
            assert a[i]["scores"][c] == pytest.approx(b[i]["scores"][c], abs=1e-9)
    grams = tm.pipeline.stages[0].transform(docs).select("grams").collect()
    assert {g for r in grams for g in r["grams"]} == terms


def test_zero_vector_document_survives_table_path(spark, fitted):
    tm, _ = fitted
    docs = spark.createDataFrame([("z1", "qqqqzzzz xxxxyyyy"), ("z2", "")], "id STRING, text STRING")
    tabs = M.export_tables(tm)
    inter = M.intercept_list(tabs["intercept"])
    w = M.weights_for(docs, tabs["vocab"], "id", "text")
    b = {r["id"]: r for r in M.score_tables(docs, w, tabs["coef"], inter, "id").collect()}
    assert set(b) == {"z1", "z2"}
    a = {r["id"]: r for r in M.score_batch(tm, docs, "id", "text").collect()}
    for k in ("z1", "z2"):
        assert a[k]["label"] == b[k]["label"]
        for c in tm.classes:
            assert a[k]["scores"][c] == pytest.approx(b[k]["scores"][c], abs=1e-9)


def test_empty_batch_gives_empty_result(spark, fitted):
    tm, lab = fitted
    assert M.score_batch(tm, lab.limit(0), "id", "text").count() == 0


def test_quantized_tables_stay_close(spark, fitted):
    tm, lab = fitted
    tabs = M.export_tables(tm)
    q, scales = M.quantize_tables(tabs["coef"])
    assert q.schema["weights"].dataType.elementType.simpleString() == "tinyint"
    diff = tabs["coef"].join(q.withColumnRenamed("weights", "q"), "idx").select(
        F.max(F.abs(F.col("weights")[0] - F.col("q")[0] * F.lit(scales[0]))).alias("d")
    ).first()["d"]
    scale = tabs["coef"].select(F.max(F.abs(F.col("weights")[0])).alias("m")).first()["m"] / 127
    assert diff <= scale / 2 + 1e-12


def test_top_terms_equals_take_ordered(spark, sf001):
    """The distributed rank keeps exactly the k terms a TakeOrdered would keep."""
    from prioritext.sources import tables as tb

    docs = tb.read_table(spark, sf001, "documents").select("doc_id", "text")
    dt = fe.doc_term_counts(docs, "doc_id", "text", 4)
    k = 1500  # below the number of eligible terms, so the cap binds
    got = fe.fit_vocabulary(dt, 200, "doc_id", 2, k)
    stats = dt.groupBy("term").agg(F.sum("c").alias("tf"), F.count(F.lit(1)).alias("df")).filter(F.col("df") >= 2)
    assert stats.count() > k
    want = stats.orderBy(F.desc("tf"), F.asc("term")).limit(k)
    g = sorted((r["term"], r["tf"], r["df"]) for r in got.collect())
    w = sorted((r["term"], r["tf"], r["df"]) for r in want.collect())
    assert g == w
    assert sorted(r["idx"] for r in got.collect()) == list(range(k))


def test_map_only_scoring_equals_the_other_paths(spark, fitted, sf001):
    import unicodedata

    tm, lab = fitted
    tabs = M.export_tables(tm)
    inter = M.intercept_list(tabs["intercept"])
    odd = [("z1", "qqqqzzzz xxxxyyyy"), ("z2", ""), ("z4", "the the\nthe a of the"), ("z5", unicodedata.normalize("NFD", "été über"))]
    docs = lab.select("id", "text").union(spark.createDataFrame(odd, "id STRING, text STRING"))
    got = M.score_text(docs, tabs["vocab"], tabs["coef"], inter, "id", "text")
    raw = M.score_text(spark.read.parquet(f"{sf001}/documents.parquet"), tabs["vocab"], tabs["coef"], inter)
    assert "Exchange" not in raw._jdf.queryExecution().executedPlan().toString()
    found = {r["id"]: r for r in got.collect()}
    for other in (
        M.score_batch(tm, docs, "id", "text"),
        M.score_tables(docs, M.weights_for(docs, tabs["vocab"], "id", "text"), tabs["coef"], inter, "id"),
    ):
        rows = other.collect()
        assert len(rows) == len(found)
        for r in rows:
            assert r["label"] == found[r["id"]]["label"]
            for c in tm.classes:
                assert r["scores"][c] == pytest.approx(found[r["id"]]["scores"][c], abs=1e-9)


def test_map_only_scoring_of_null_and_repeated_ids(spark):
    vocab = spark.createDataFrame([("aa", 0, 1.0), ("aa bb", 1, 2.0), ("bb", 2, 1.5)], "term STRING, idx INT, idf DOUBLE")
    coef = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 3.0]), (2, [0.5, 0.0])], "idx INT, weights ARRAY<DOUBLE>")
    rows = [(None, "aa aa"), (None, "aa bb"), (None, None), (1, "bb aa"), (1, "cc"), (1, "bb aa")]
    docs = spark.createDataFrame(rows, "doc_id LONG, text STRING").coalesce(1)
    got = M.score_text(docs, vocab, coef, [("x", 0.1), ("y", 0.0)]).collect()
    z = [(1.1, 0.0), ((1 + 0.75) / 7.25**0.5 + 0.1, 6 / 7.25**0.5), (0.1, 0.0), (1.75 / 3.25**0.5 + 0.1, 0.0), (0.1, 0.0)]
    import math

    want = [(i, x, y) for (i, _), (x, y) in zip(rows, [*z, z[3]], strict=True)]
    for r, (i, x, y) in zip(got, want, strict=True):
        assert r["doc_id"] == i and r["label"] == ("x" if x >= y else "y")
        assert r["scores"]["x"] == pytest.approx(math.exp(x) / (math.exp(x) + math.exp(y)))
    assert M.score_text(docs.limit(0), vocab, coef, [("x", 0.1), ("y", 0.0)]).count() == 0
    bare = M.score_text(docs, vocab.limit(0), coef, [("x", 0.1), ("y", 0.2)])
    assert {r["label"] for r in bare.collect()} == {"y"}


def test_gradients_that_leave_tasks_do_not_grow_with_the_rows(spark):
    cores = spark.sparkContext.defaultParallelism
    assert M.training_partitions(spark, 800) == 1
    assert M.training_partitions(spark, 2_500_000) <= max(13, M.TRAIN_PARTITIONS_PER_CORE * cores)
    rows = [(i, f"word{i % 7} other{i % 5} last", "ab"[i % 2]) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id LONG, text STRING, label STRING")
    features = M.prepare(docs, M.TrainConfig(num_partitions=3)).features
    assert "Exchange" not in features._jdf.queryExecution().executedPlan().toString()
    assert features.rdd.getNumPartitions() <= 3
    parts = [[r["doc_id"] for r in p] for p in features.select("doc_id").rdd.glom().collect()]
    assert sorted(i for p in parts for i in p) == list(range(60))


def test_rows_are_counted_in_slices_of_few_words(spark, monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(fe, "COUNTED_WORDS", 5)
    words = [["aa", "bb", "aa", "bb"], None, [], ["bb"], ["aa"] * 9, ["cc", "aa"], ["aa", "cc", "aa"]]
    batch = pa.record_batch([pa.array(words, pa.list_(pa.string()))], names=["_words"])
    slices = [s.column("_words").to_pylist() for s in fe._few_words(batch, "_words")]
    assert [len(s) for s in slices] == [4, 1, 2] and [r for s in slices for r in s] == words
    assert list(fe._few_words(batch.slice(0, 0), "_words")) == []
    found = {t: (c, d) for terms, tf, df in fe._row_terms(batch.column("_words")) for t, c, d in zip(terms.to_pylist(), tf, df)}
    assert found == {
        "aa": (14, 4), "bb": (3, 2), "cc": (2, 2),
        "aa bb": (2, 1), "bb aa": (1, 1), "aa aa": (8, 1), "cc aa": (2, 2), "aa cc": (1, 1),
    }


def test_texts_with_and_without_accents_have_the_same_bigram_rule(spark):
    from prioritext.functions.text import is_ascii, ngrams, normalize_text, tokens

    rows = [(None,), ("",), ("Aa",), ("a bb",), ("BB cc  dd\tee",), ("É été Kelvin xx",), ("x_1 99 oú ab",)]
    df = spark.createDataFrame(rows, "t STRING")
    got = df.select(normalize_text("t").alias("n"), ngrams(tokens(normalize_text("t"))).alias("g"), is_ascii("t").alias("a")).collect()
    assert [r["n"] for r in got] == [None, "", "aa", "a bb", "bb cc  dd\tee", "e ete kelvin xx", "x_1 99 ou ab"]
    assert [r["a"] for r in got] == [None, True, True, True, True, False, False]
    assert [r["g"] for r in got] == [
        None, [], ["aa"], ["bb"], ["bb", "cc", "dd", "ee", "bb cc", "cc dd", "dd ee"],
        ["ete", "kelvin", "xx", "ete kelvin", "kelvin xx"], ["x_1", "99", "ou", "ab", "x_1 99", "99 ou", "ou ab"],
    ]


def test_terms_are_added_up_in_more_tasks_where_there_is_more_text(spark, monkeypatch):
    docs = spark.createDataFrame([(i, f"aa{i} bb cc{i}") for i in range(40)], "doc_id LONG, text STRING")
    monkeypatch.setattr(fe, "ADDED_BYTES", 10)
    size = sum(len(r["text"]) for r in docs.collect())
    assert fe.term_statistics(docs).rdd.getNumPartitions() == -(-size // 10) > int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert fe.adding_partitions(docs.limit(0)) == spark.sparkContext.defaultParallelism
    assert {(r["term"], r["tf"], r["df"]) for r in fe.term_statistics(docs).filter("df > 1").collect()} == {("bb", 40, 40)}


def test_no_more_tasks_add_terms_up_than_spark_sends_to_without_a_sort(spark, monkeypatch):
    docs = spark.createDataFrame([(i, f"aa{i} bb cc{i}") for i in range(40)], "doc_id LONG, text STRING")
    size = sum(len(r["text"]) for r in docs.collect())
    monkeypatch.setattr(fe, "ADDED_BYTES", 1)
    assert size > 200 and fe.adding_partitions(docs) == 200
    stats = fe.term_statistics(docs)
    assert stats.rdd.getNumPartitions() == 200
    assert {(r["term"], r["tf"], r["df"]) for r in stats.filter("df > 1").collect()} == {("bb", 40, 40)}
    # a task's share of the text is bounded all the same
    monkeypatch.setattr(fe, "MOST_ADDED_BYTES", 2)
    assert fe.adding_partitions(docs) == -(-size // 2) > 200


def test_terms_rarer_than_the_last_one_kept_are_not_ranked(spark):
    stats = spark.createDataFrame([("a", 5, 2), ("b", 5, 3), ("c", 3, 2), ("d", 3, 2), ("e", 1, 1)], "term STRING, tf LONG, df LONG")
    assert [fe._least_tf(stats, k) for k in (1, 2, 3, 4, 5, 6)] == [5, 5, 3, 3, 1, None]
    assert fe._least_tf(stats.limit(0), 1) is None
    for k in range(1, 7):
        assert sorted(r["term"] for r in fe.top_terms(stats, k).collect()) == list("abcde")[:k]


def test_documents_of_one_row_are_counted_and_weighted_inside_it(spark):
    from collections import Counter

    rows = [(1, "aa bb aa"), (2, "bb aa bb aa"), (3, None), (4, ""), (5, "q aa q"), (6, "long " * 3000)]
    twice = [(7, "aa bb"), (7, "aa bb"), (7, "cc"), (8, None), (8, "bb aa"), (None, "aa cc"), (None, "cc aa"), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id LONG, text STRING")
    both = spark.createDataFrame(rows + twice, "doc_id LONG, text STRING").repartition(3)
    plan = fe.doc_term_counts(docs)._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "Generate" not in plan and "Aggregate" not in plan

    want = Counter()
    for i, text in rows + twice:
        words = [w for w in (text or "").split() if len(w) > 1]
        want.update((i, t) for t in words + [f"{a} {b}" for a, b in zip(words, words[1:])])
    got = fe.doc_term_counts(both).collect()
    assert len(got) == len(want) and {(r["doc_id"], r["term"]): r["c"] for r in got} == want

    vocab = fe.fit_vocabulary(fe.doc_term_counts(both), 9, min_df=1).cache()
    idf = {r["term"]: (r["idx"], r["idf"]) for r in vocab.collect()}
    norm = Counter()
    for (i, t), c in want.items():
        norm[i] += (c * idf[t][1]) ** 2
    weights = fe.tfidf_for(both, vocab).collect()
    assert len(weights) == len(want) and {r["idx"] for r in weights} == {i for i, _ in idf.values()}
    for r in weights:
        at, scale = idf[r["term"]]
        assert r["idx"] == at and r["weight"] == pytest.approx(want[r["doc_id"], r["term"]] * scale / norm[r["doc_id"]] ** 0.5)
    assert "Exchange" not in fe.tfidf_for(docs, vocab, num_partitions=None)._jdf.queryExecution().executedPlan().toString().split("MapInArrow")[0]
    assert fe.tfidf_for(docs, vocab.limit(0)).count() == 0 == fe.tfidf_for(docs.limit(0), vocab).count()
