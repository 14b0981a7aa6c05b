"""The gradient of the penalised loss, the certificate made of it, and the features of training."""

import math

import pytest
from pyspark.sql import functions as F

from prioritext.functions.text import ngrams, normalize_text, tokens
from prioritext.operators import certificate as C
from prioritext.operators import features as fe
from prioritext.operators import model as M
from prioritext.operators.common import EngineError

ROWS = [
    ("aa aa bb", "x"), ("bb cc", "y"), ("aa bb", "x"), ("zz zz", "z"), ("", "y"), (None, "z"),
    ("cc aa bb", None), ("aa cc", "other"), ("aa aa bb", "x"),
]
VOCAB = [("aa", 0, 1.0), ("aa bb", 1, 2.0), ("bb", 2, 1.5), ("cc", 3, 1.25), ("qq", 4, 3.0)]
COEF = [[0.5, -0.25, 0.0], [0.0, 1.0, -1.0], [0.25, 0.0, 0.5], [-1.0, 0.75, 0.25], [0.125, 0.0, 0.0]]
BIAS = [("x", 0.1), ("y", -0.2), ("z", 0.05)]
WEIGHTS = {"x": 0.5, "y": 2.0}


def tables(spark):
    docs = spark.createDataFrame(ROWS, "text STRING, label STRING")
    vocab = spark.createDataFrame(VOCAB, "term STRING, idx INT, idf DOUBLE")
    return docs, vocab, spark.createDataFrame(list(enumerate(COEF)), "idx INT, weights ARRAY<DOUBLE>")


def features(text):
    words = (text or "").split()
    terms = words + [f"{a} {b}" for a, b in zip(words, words[1:])]
    raw = [terms.count(t) * idf for t, _, idf in VOCAB]
    size = math.sqrt(sum(v * v for v in raw))
    return [v / size if size else 0.0 for v in raw]


def objective(coef, bias, reg):
    """By the definition, and the number of rows used."""
    loss = weight = n = 0.0
    for text, label in ROWS:
        if label not in ("x", "y", "z"):
            continue
        u = features(text)
        z = [b + sum(u[t] * coef[t][c] for t in range(len(u))) for c, b in enumerate(bias)]
        s = WEIGHTS.get(label, 1.0)
        loss += s * (math.log(sum(map(math.exp, z))) - z["xyz".index(label)])
        weight, n = weight + s, n + 1
    return loss / weight + reg / 2 * sum(w * w for row in coef for w in row), weight, n


def test_gradient_equals_differences_of_the_objective(spark):
    docs, vocab, coef = tables(spark)
    bias = [b for _, b in BIAS]
    _, weight, n = objective(COEF, bias, 0.0)
    for parts in (1, 3):
        got = {r["idx"]: r for r in C.gradient_sums(docs.repartition(parts), vocab, coef, BIAS, class_weights=WEIGHTS).collect()}
        assert set(got) == {-1, 0, 1, 2, 3}  # no row holds "qq"
        assert got[-1]["rows"] == n and got[-1]["weight"] == pytest.approx(weight)
        step = 1e-5
        for t, c in [(t, c) for t in range(4) for c in range(3)]:
            up, down = ([row[:] for row in COEF] for _ in range(2))
            up[t][c] += step
            down[t][c] -= step
            slope = (objective(up, bias, 0.0)[0] - objective(down, bias, 0.0)[0]) / (2 * step)
            assert got[t]["sums"][c] / weight == pytest.approx(slope, abs=1e-8)
        for c in range(3):
            up = [b + step * (i == c) for i, b in enumerate(bias)]
            down = [b - step * (i == c) for i, b in enumerate(bias)]
            slope = (objective(COEF, up, 0.0)[0] - objective(COEF, down, 0.0)[0]) / (2 * step)
            assert got[-1]["sums"][c] / weight == pytest.approx(slope, abs=1e-8)


def test_certificate_row(spark):
    docs, vocab, coef = tables(spark)
    reg = 0.3
    row = C.certificate(docs, vocab, coef, BIAS, reg, class_weights=WEIGHTS).first()
    value, _, n = objective(COEF, [b for _, b in BIAS], reg)
    assert row["n_docs"] == n and row["objective"] == pytest.approx(value)
    assert row["gap_bound"] == pytest.approx(row["gradient_norm"] ** 2 / (2 * reg))
    with pytest.raises(EngineError):
        C.certificate(docs.limit(0), vocab, coef, BIAS, reg)
    with pytest.raises(EngineError):
        C.certificate(docs, vocab, coef, BIAS, 0.0)
    assert C.gradient_sums(docs.limit(0), vocab, coef, BIAS).count() == 0


def test_training_ends_near_the_optimum_and_stopping_early_does_not(spark):
    rows = [(i, f"alpha beta word{i % 7}", "a") for i in range(40)] + [(i, f"gamma beta word{i % 5}", "b") for i in range(40, 70)]
    docs = spark.createDataFrame(rows, "doc_id LONG, text STRING, label STRING")
    full = C.certify(M.train(docs, M.TrainConfig(min_df=1)), docs).first()
    short = C.certify(M.train(docs, M.TrainConfig(min_df=1, max_iter=1)), docs).first()
    assert full["gap_bound"] <= 0.01 * full["objective"]
    assert short["objective"] > full["objective"] and short["gap_bound"] >= short["objective"] - full["objective"] - 1e-3
    weak, strong = M.regularisation_path(docs, [10.0, 0.01], M.TrainConfig(min_df=1))
    assert C.certify(weak, docs).first()["loss"] < C.certify(strong, docs).first()["loss"]


def test_counts_inside_rows_equal_the_exploded_ones(spark):
    rows = [("Été the the\nthe été",), ("",), (None,), ("a b c",), ("the the",), ("the the",), ("long " * 3000 + "é",), ("the été",)]
    docs = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i LONG, text STRING").repartition(3)
    got = {tuple(r) for r in fe.term_statistics(docs).collect()}
    held = docs.select("i", F.explode(ngrams(tokens(normalize_text("text")))).alias("term"))
    want = held.groupBy("term").agg(F.count(F.lit(1)).alias("tf"), F.count_distinct("i").alias("df"))
    assert got == {tuple(r) for r in want.collect()} and ("the the", 4, 3) in got
    assert fe.term_statistics(docs.limit(0)).count() == 0


def test_no_text_is_shuffled_for_training(spark, sf001):
    docs = spark.read.parquet(f"{sf001}/documents.parquet")
    plan = fe.term_statistics(docs)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.index("Exchange") < plan.index("MapInArrow")
    got = M.prepare(docs.select("doc_id", "text", F.col("lang").alias("label"))).features
    assert got.columns == ["doc_id", "_label_idx", "_weight", "features"]
    assert got.count() == docs.count()


def test_counts_of_terms_are_not_kept_in_the_tasks_that_read_texts(spark):
    docs = spark.createDataFrame([(1, "aa bb aa"), (2, "bb cc"), (3, None)], "doc_id LONG, text STRING")
    stats = fe.term_statistics(docs)
    plan = stats._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Aggregate" not in plan[plan.index("Exchange"):]
    assert {(r["term"], r["tf"], r["df"]) for r in stats.collect()} == {
        ("aa", 2, 1), ("bb", 2, 2), ("cc", 1, 1), ("aa bb", 1, 1), ("bb aa", 1, 1), ("bb cc", 1, 1)
    }
