"""Confusion, per-class metrics, macro summary, gate and agreement."""

import pytest

from prioritext.constants import LABELS_SORTED
from prioritext.operators import evaluate as ev


def _pairs(spark, y_true, y_pred):
    return spark.createDataFrame(list(zip(y_true, y_pred)), "y_true STRING, y_pred STRING")


def _eval(spark, y_true, y_pred):
    conf = ev.confusion(_pairs(spark, y_true, y_pred))
    per = {r["label"]: r for r in ev.per_class_metrics(conf).collect()}
    summ = ev.eval_summary(ev.per_class_metrics(conf)).first()
    return conf, per, summ


def test_perfect_predictions(spark):
    y = ["normal", "atencao", "urgente"] * 4
    conf, per, s = _eval(spark, y, y)
    assert s["macro_f1"] == 1.0 and s["accuracy"] == 1.0 and s["recall_urgente"] == 1.0
    cells = {(r["y_true"], r["y_pred"]): r["n"] for r in conf.collect()}
    assert len(cells) == 9
    for t in LABELS_SORTED:
        for p in LABELS_SORTED:
            assert cells[(t, p)] == (4 if t == p else 0)


def test_urgent_missed(spark):
    y_true = ["normal", "normal", "urgente", "urgente", "atencao", "atencao"]
    y_pred = ["normal", "normal", "normal", "normal", "atencao", "atencao"]
    _, per, s = _eval(spark, y_true, y_pred)
    assert s["recall_urgente"] == 0.0
    assert per["urgente"]["support"] == 2
    assert per["normal"]["precision"] == 0.5


def test_published_confusion_matrix_reproduces_published_metrics(spark):
    # rows = true (atencao, normal, urgente), cols = predicted, same order
    matrix = [[680, 310, 142], [332, 557, 59], [152, 61, 595]]
    rows = []
    for i, t in enumerate(LABELS_SORTED):
        for j, p in enumerate(LABELS_SORTED):
            rows += [(t, p)] * matrix[i][j]
    _, per, s = _eval(spark, [r[0] for r in rows], [r[1] for r in rows])
    assert s["n_samples"] == 2888
    assert s["macro_f1"] == pytest.approx(0.6427, abs=5e-5)
    assert s["accuracy"] == pytest.approx(0.6343, abs=5e-5)
    assert s["recall_urgente"] == pytest.approx(0.7364, abs=5e-5)
    assert per["normal"]["precision"] == pytest.approx(0.6002, abs=5e-5)
    assert per["atencao"]["f1"] == pytest.approx(0.5923, abs=5e-5)
    assert per["urgente"]["f1"] == pytest.approx(0.7419, abs=5e-5)


def test_gate_failures_report_real_numbers(spark):
    y_true = ["urgente"] * 10
    y_pred = ["normal"] * 5 + ["urgente"] * 5
    conf = ev.confusion(_pairs(spark, y_true, y_pred))
    s = ev.eval_summary(ev.per_class_metrics(conf))
    gate = {r["metric"]: r for r in ev.quality_gate(s, 0.0, 0.70).collect()}
    assert gate["macro_f1"]["passed"] is True
    assert gate["recall_urgente"]["passed"] is False
    assert gate["recall_urgente"]["failure"] == "recall_urgente 0.5000 < required 0.70"


def test_gate_passes(spark):
    y = ["normal", "atencao", "urgente"] * 4
    s = ev.eval_summary(ev.per_class_metrics(ev.confusion(_pairs(spark, y, y))))
    v = ev.gate_passed(ev.quality_gate(s)).first()
    assert v["gate_passed"] is True and v["gate_failures"] == []


def test_equivalence_counts_and_vacuous(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y"), (3, "z")], "doc_id INT, label STRING")
    b = spark.createDataFrame([(1, "x"), (2, "x"), (4, "z")], "doc_id INT, label STRING")
    r = ev.equivalence(a, b).first()
    assert (r["n"], r["matches"], r["unpaired"]) == (2, 1, 2)
    assert r["agreement_pct"] == 50.0 and r["passed"] is False
    v = ev.equivalence(a, None).first()
    assert (v["n"], v["matches"], v["agreement_pct"], v["passed"]) == (0, 0, 100.0, True)
    empty = a.limit(0)
    e = ev.equivalence(empty, empty).first()
    assert e["agreement_pct"] == 100.0 and e["passed"] is True


def test_relative_reduction(spark):
    st = spark.createDataFrame([("base", 0.32), ("new", 0.098)], "backend STRING, p50 DOUBLE")
    r = ev.relative_reduction(st, "base", "new").first()
    assert r["reduction_pct"] == pytest.approx(69.375)
    assert r["met"] is True
    zero = spark.createDataFrame([("base", 0.0), ("new", 0.1)], "backend STRING, p50 DOUBLE")
    z = ev.relative_reduction(zero, "base", "new").first()
    assert z["reduction_pct"] is None and z["met"] is False


def test_equivalence_fails_on_unpaired_rows(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y"), (3, "z")], "doc_id INT, label STRING")
    r = ev.equivalence(a, a.filter("doc_id = 1")).first()
    assert (r["n"], r["unpaired"], r["agreement_pct"], r["passed"]) == (1, 2, 100.0, False)


def test_pairs_outside_the_labels_count(spark):
    y_true = ["urgente"] * 10 + ["normal"] * 5 + ["atencao"] * 3 + [None, "x"]
    y_pred = [None] * 4 + ["urgente"] * 6 + ["normal"] * 5 + ["atencao"] * 2 + ["x"] + ["normal", None]
    conf, per, s = _eval(spark, y_true, y_pred)
    assert s["n_samples"] == 20 and s["accuracy"] == 13 / 20 and s["recall_urgente"] == 0.6
    assert {k: r["support"] for k, r in per.items()} == {"urgente": 10, "normal": 5, "atencao": 3}
    assert per["normal"]["precision"] == 5 / 6 and per["urgente"]["precision"] == 1.0
    cells = {(r["y_true"], r["y_pred"]): r["n"] for r in conf.collect()}
    assert sum(cells.values()) == 20 and cells["urgente", None] == 4 and cells[None, None] == 1 and len(cells) == 9 + 4
    gate = {r["metric"]: r["passed"] for r in ev.quality_gate(ev.eval_summary(ev.per_class_metrics(conf))).collect()}
    assert gate["recall_urgente"] is False
    none = ev.eval_summary(ev.per_class_metrics(ev.confusion(_pairs(spark, [], [])))).first()
    assert none["n_samples"] == 0 and none["accuracy"] == 0.0
