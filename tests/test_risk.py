"""Risk model: label, fallback, parity with the reference objective, scoring (ML-03..10)."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from carespark import codes
from carespark.plans import risk as R
from carespark.plans.features import high_cost_label

FEATS = codes.RISK_FEATURES


def _frame(spark, X, y):
    rows = [(i, f"id{i}", *[float(v) for v in X[i]], int(y[i])) for i in range(len(y))]
    schema = "patient_key long, patient_id string, " + ", ".join(f"{c} double" for c in FEATS) + ", label int"
    return spark.createDataFrame(rows, schema)


def _reference_probs(X, y, C=1.0):
    """Newton solution of sum(logloss) + ||w||^2 / (2C) on population-standardised X."""
    mu, sd = X.mean(0), X.std(0)
    sd[sd == 0] = 1.0
    Z = np.hstack([(X - mu) / sd, np.ones((len(X), 1))])
    w = np.zeros(Z.shape[1])
    reg = np.ones(Z.shape[1]) / C
    reg[-1] = 0.0  # intercept not penalised
    for _ in range(100):
        p = 1 / (1 + np.exp(-Z @ w))
        g = Z.T @ (p - y) + reg * w
        H = (Z * (p * (1 - p))[:, None]).T @ Z + np.diag(reg)
        step = np.linalg.solve(H, g)
        w -= step
        if np.abs(step).max() < 1e-12:
            break
    return 1 / (1 + np.exp(-Z @ w))


@pytest.mark.parametrize("seed", [42, 0])
def test_parity_with_reference_objective(spark, seed):
    rng = np.random.default_rng(seed)
    X = rng.random((20, len(FEATS)))
    y = np.array([i % 2 for i in range(20)])
    df = _frame(spark, X, y)
    model = R.fit(df, 20)
    got = {r.patient_id: r.risk_score for r in R.score(model, df, phi_read=True).collect()}
    ref = _reference_probs(X, y.astype(float))
    assert max(abs(got[f"id{i}"] - ref[i]) for i in range(20)) < 1e-5


def test_null_feature_column_and_scores_in_unit_interval(spark):
    rng = np.random.default_rng(1)
    X = rng.random((20, len(FEATS)))
    y = np.array([i % 2 for i in range(20)])
    df = _frame(spark, X, y).withColumn(FEATS[0], F.lit(None).cast("double"))
    train, n = R.training_frame(df.drop("label"), df.select("patient_key", "label"))
    s = R.score(R.fit(train, n), df)
    vals = [r.risk_score for r in s.collect()]
    assert len(vals) == 20 and all(0.0 <= v <= 1.0 for v in vals)
    assert all(r.patient_id.startswith("****") for r in s.collect())  # masked by default


def test_single_patient_fallback(spark):
    X = np.ones((1, len(FEATS)))
    df = _frame(spark, X, np.array([1]))
    labels = high_cost_label(df.select("patient_key", "healthcare_expenses"))
    assert labels.first().label == 1
    train, n = R.training_frame(df.drop("label"), labels)
    assert n == 2 and sorted(r.label for r in train.collect()) == [0, 1]
    assert R.score(R.fit(train, n), df).count() == 1


def test_no_data_raises(spark):
    df = _frame(spark, np.ones((1, len(FEATS))), np.array([1])).limit(0)
    with pytest.raises(R.NoTrainingData):
        R.training_frame(df.drop("label"), df.select("patient_key", "label"))


def test_rank_label_ties_split_by_key(spark):
    df = spark.createDataFrame([(k, 100.0) for k in range(1, 9)], "patient_key long, healthcare_expenses double")
    lab = {r.patient_key: r.label for r in high_cost_label(df).collect()}
    assert [k for k, v in sorted(lab.items()) if v == 1] == [1, 2]  # floor(8/4) = 2, lowest keys


def test_save_load_and_gbt(spark, tmp_path):
    rng = np.random.default_rng(3)
    X = rng.random((30, len(FEATS)))
    y = np.array([i % 2 for i in range(30)])
    df = _frame(spark, X, y)
    m = R.fit(df, 30)
    R.save(m, str(tmp_path / "model"), FEATS, 30)
    m2, meta = R.load(str(tmp_path / "model"))
    assert meta["training_size"] == 30 and meta["feature_cols"] == FEATS
    a = [r.risk_score for r in R.score(m, df).orderBy("patient_id").collect()]
    b = [r.risk_score for r in R.score(m2, df).orderBy("patient_id").collect()]
    assert np.allclose(a, b)
    g = R.fit(df, 30, model="gbt")
    assert R.score(g, df).count() == 30
    tr, te = R.stratified_split(df, 0.7)
    assert tr.count() + te.count() == 30


def test_split_is_stable_and_cross_validation_covers_every_row(spark):
    rng = np.random.default_rng(3)
    X = rng.random((300, len(FEATS)))
    y = (X[:, 0] + 0.1 * rng.random(300) > 0.55).astype(int)
    df = _frame(spark, X, y)
    train, test = R.stratified_split(df, 0.8)
    ids = lambda d: {r.patient_key for r in d.collect()}
    assert ids(train) & ids(test) == set() and ids(train) | ids(test) == ids(df)
    assert ids(R.stratified_split(df.repartition(7).orderBy("label"), 0.8)[0]) == ids(train)
    assert 0.7 < len(ids(train)) / 300 < 0.9
    cv = R.cross_validate(df, folds=3).collect()
    assert sum(r.rows for r in cv) == 300 and sum(r.positives for r in cv) == int(y.sum())
    assert all(r.auc > 0.9 and 0 < r.log_loss < 0.6 for r in cv)


def test_certificate_tells_an_optimum_from_an_early_stop(spark):
    import numpy as np

    from carespark import codes
    from carespark.plans import risk as R

    rng = np.random.default_rng(3)
    x = rng.normal(size=(80, len(codes.RISK_FEATURES))) * 50 + 7
    rows = [(i, *map(float, v), int(v[0] + v[1] > 14)) for i, v in enumerate(x)]
    train = spark.createDataFrame(rows, "patient_key long, " + ", ".join(f"{c} double" for c in codes.RISK_FEATURES) + ", label int")
    found = {r.feature: r.gradient for r in R.optimality(R.fit(train, 80), train, 80).collect()}
    assert set(found) == {*codes.RISK_FEATURES, "intercept"} and max(map(abs, found.values())) < 1e-6
    early = R.optimality(R.fit(train, 80, max_iter=2), train, 80).collect()
    assert max(abs(r.gradient) for r in early) > 1e-4
    other = R.optimality(R.fit(train, 80, C=10.0), train, 80).collect()        # the optimum of another penalty
    assert max(abs(r.gradient) for r in other) > 1e-4
