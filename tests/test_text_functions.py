"""Lexicon, score, band and text-normalisation functions (hand-computed values)."""

import pytest
from pyspark.sql import functions as F

from prioritext.constants import CLINICAL_CATEGORIES, NORMAL_TERMS, URGENT_TERMS
from prioritext.functions import text as tx
from prioritext.operators.labeling import collect_thresholds, fit_thresholds


def _score(spark, text, key=2):
    priors = {k: p for k, _, p in CLINICAL_CATEGORIES}
    df = spark.createDataFrame([(text, priors.get(key))], "text STRING, prior DOUBLE")
    return df.select(tx.urgency_score("text", "prior", URGENT_TERMS, NORMAL_TERMS).alias("s")).first()["s"]


def test_neutral_text_scores_prior(spark):
    text = "The patient was examined by the physician in the clinic today."
    for key, _, prior in CLINICAL_CATEGORIES:
        assert _score(spark, text, key) == pytest.approx(prior)
    assert _score(spark, text, 999) == 0.0


def test_case_insensitive_and_whole_words(spark):
    assert _score(spark, "acute severe emergency") == _score(spark, "ACUTE SEVERE EMERGENCY") == 3.0
    assert _score(spark, "chronic evolving presentation") < _score(spark, "chronically evolving presentation")
    assert _score(spark, "routine follow-up visit") < _score(spark, "routine appointment visit")
    assert _score(spark, "") == 0.0


def test_raw_hit_count_not_length_normalised(spark):
    short = "Acute severe emergency."
    padded = short + " " + "the patient was seen in clinic today " * 20
    assert _score(spark, short) == _score(spark, padded)
    assert _score(spark, "Acute severe") == _score(spark, "Acute condition remains severe despite treatment")


def test_unicode_case_folding_and_boundaries(spark):
    # a long s folds to s; an accented letter is a word character (no hit inside)
    assert _score(spark, "ſhock") == 1.0
    assert _score(spark, "éshock") == 0.0


def test_quantiles_exact_linear(spark):
    df = spark.createDataFrame([(float(i),) for i in range(100)], "urgency_score DOUBLE")
    low, high = collect_thresholds(fit_thresholds(df))
    assert low == pytest.approx(34.65)
    assert high == pytest.approx(74.25)


def test_empty_scores_raise(spark):
    df = spark.createDataFrame([], "urgency_score DOUBLE")
    with pytest.raises(ValueError, match="empty"):
        collect_thresholds(fit_thresholds(df))


def test_band_edges(spark):
    rows = [(-0.5,), (-0.001,), (0.0,), (0.1,), (0.199,), (0.2,), (1.0,)]
    df = spark.createDataFrame(rows, "s DOUBLE")
    got = [r["b"] for r in df.select(tx.map_band("s", 0.0, 0.2).alias("b")).collect()]
    assert got == ["normal", "normal", "atencao", "atencao", "atencao", "urgente", "urgente"]


def test_gaussian_scores_keep_every_class_above_15_percent(spark):
    import random

    rng = random.Random(42)
    df = spark.createDataFrame([(rng.gauss(0.0, 0.1),) for _ in range(5000)], "urgency_score DOUBLE")
    low, high = collect_thresholds(fit_thresholds(df))
    counts = {r["b"]: r["count"] for r in df.select(tx.map_band("urgency_score", low, high).alias("b")).groupBy("b").count().collect()}
    for label in ("normal", "atencao", "urgente"):
        assert counts[label] / 5000 >= 0.15


def test_normalize_tokens_ngrams(spark):
    df = spark.createDataFrame([("Café Crème x y",), ("one",), ("",), ("Ab",)], "text STRING")
    out = df.select(tx.ngrams(tx.tokens(tx.normalize_text("text"))).alias("g")).collect()
    assert out[0]["g"] == ["cafe", "creme", "cafe creme"]
    assert out[1]["g"] == ["one"]
    assert out[2]["g"] == []
    assert out[3]["g"] == ["ab"]


def test_accent_table_is_rule_built():
    src, dst = tx.accent_table()
    assert len(src) == len(dst) > 200
    m = dict(zip(src, dst))
    assert m["é"] == "e" and m["ñ"] == "n" and "ß" not in m and "ø" not in m


def test_blank_text_uses_unicode_whitespace(spark):
    df = spark.createDataFrame([(" \t",), (" ",), ("x",), (None,)], "text STRING")
    got = [r["b"] for r in df.select(tx.blank_text("text").alias("b")).collect()]
    assert got == [True, True, False, True]


def test_presence_counts_distinct_terms(spark):
    df = spark.createDataFrame([("Acute acute SEVERE mild",)], "text STRING")
    r = df.select(
        tx.presence_count("text", URGENT_TERMS).alias("u"), tx.presence_count("text", NORMAL_TERMS).alias("n")
    ).first()
    assert (r["u"], r["n"]) == (2, 1)
    assert df.select(tx.lexicon_hits(F.col("text"), URGENT_TERMS).alias("h")).first()["h"] == 3


def test_null_score_has_no_band(spark):
    df = spark.createDataFrame([(None,), (float("nan"),), (1.0,)], "s DOUBLE")
    assert [r["b"] for r in df.select(tx.map_band("s", 0.0, 0.2).alias("b")).collect()] == [None, None, "urgente"]


def test_decomposed_and_vietnamese_accents_are_stripped(spark):
    df = spark.createDataFrame([("été tiếng",)], "t STRING")
    assert df.select(tx.normalize_text("t").alias("n")).first()["n"] == "ete tieng"
