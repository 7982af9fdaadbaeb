"""Logistic regression: metrics equal a hand computation; the structured error record."""

import math

from pyspark.sql import functions as F

from lakeloom.operators import ml
from lakeloom.operators import quality as q
from lakeloom.sources.files import inline


def test_separable_fixture_scores_perfectly(spark):
    rows = [(float(i), 1.0 if i >= 10 else 0.0) for i in range(20)]
    df = inline(spark, rows, "x double, label double")
    model = ml.train(df, ["x"], reg_param=0.01)
    m = ml.evaluate(model, df).first()
    assert m.accuracy == 1.0 and m.roc_auc == 1.0 and m.precision == 1.0 and m.recall == 1.0


def test_metrics_match_hand_computation(spark):
    rows = [(float(i % 7), float(i % 3 == 0)) for i in range(60)]
    df = inline(spark, rows, "x double, label double")
    model = ml.train(df, ["x"])
    m = ml.evaluate(model, df).first()
    p = ml.predict(model, df).select("label", "predicted_label", "probability").collect()
    tp = sum(r.label == 1 and r.predicted_label == 1 for r in p)
    fp = sum(r.label == 0 and r.predicted_label == 1 for r in p)
    fn = sum(r.label == 1 and r.predicted_label == 0 for r in p)
    tn = len(p) - tp - fp - fn
    assert m.accuracy == (tp + tn) / len(p)
    assert m.precision == (tp / (tp + fp) if tp + fp else 0.0)
    assert m.recall == (tp / (tp + fn) if tp + fn else 0.0)
    ll = -sum(r.label * math.log(min(max(r.probability, 1e-15), 1 - 1e-15))
              + (1 - r.label) * math.log(1 - min(max(r.probability, 1e-15), 1 - 1e-15)) for r in p) / len(p)
    assert abs(m.log_loss - ll) < 1e-9
    assert 0.0 <= m.roc_auc <= 1.0
    top = ml.predicted_by(ml.predict(model, df), "x", 3).collect()
    assert len(top) <= 3


def test_error_record(spark):
    df = inline(spark, [("t1", "-5"), ("t2", "abc")], "transaction_id string, amount string")
    out = q.error_record(q.validate(df, q.amount_rules()), "transaction_id", "aggregate", "run-7")
    recs = {r.error.record_id: r.error for r in out.select("error").collect()}
    assert recs["t1"].message == "AMOUNT_NEGATIVE;" and recs["t2"].message == "AMOUNT_NOT_NUMERIC;"
    assert recs["t1"].stage == "aggregate" and recs["t1"].correlation_id == "run-7" and recs["t1"].severity == "ERROR"
    assert out.filter(F.col("error.severity") == "ERROR").count() == 2
