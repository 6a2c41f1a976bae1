"""SVR with the absolute loss, landmarks to an error target, coupled probabilities."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabml.functions.sums import matrix, sum_over
from tabml.operators import prep, svm
from tabml.operators.tube import fit_tube
from tabml.plans import catalog
from tabml.plans import fixtures as fx

SF01 = "/root/testdata/sf0.01"


def objective(z, y, w, b, C, eps):
    return 0.5 * w @ w + C * np.maximum(np.abs(y - z @ w - b) - eps, 0).sum()


def tube_rows(spark, z, y, parts):
    return spark.createDataFrame([(r.tolist(), float(t)) for r, t in zip(z, y)], "_z array<double>, _y double").repartition(parts).cache()


@pytest.mark.parametrize("n,d,C,eps,noise", [(600, 4, 5.0, 0.3, 1.0), (200, 2, 100.0, 0.0, 1.0)])
def test_tube_reaches_the_optimum(spark, n, d, C, eps, noise):
    rng = np.random.default_rng(n)
    z = rng.normal(size=(n, d))
    y = z @ rng.normal(size=d) * 3 + 5 + noise * rng.standard_t(3, size=n)
    f = fit_tube(tube_rows(spark, z, y, 4), d, C, eps, 1e-6, 300, 4)
    assert f.converged and f.gap <= 1e-6 * (1 + f.objective)
    assert f.objective == pytest.approx(objective(z, y, f.coef, f.intercept, C, eps), rel=1e-9)
    for scale in (1e-4, 1e-2):  # nothing near it is better than the gap says
        for _ in range(60):
            w, b = f.coef + scale * rng.normal(size=d), f.intercept + scale * rng.normal()
            assert objective(z, y, w, b, C, eps) >= f.objective - f.gap - 1e-9


def test_tube_is_not_moved_by_outliers(spark):
    rng = np.random.default_rng(1)
    z = rng.uniform(-1, 1, size=(300, 1))
    y = 2 * z[:, 0] + 1
    y[:40] += 1000.0
    absolute = fit_tube(tube_rows(spark, z, y, 2), 1, 10.0, 0.05, 1e-6, 300, 2)
    assert abs(absolute.coef[0] - 2) < 0.2 and abs(absolute.intercept - 1) < 0.1


def test_tube_degenerate_inputs(spark):
    none = fit_tube(tube_rows(spark, np.zeros((0, 2)), [], 2).limit(0), 2, 1.0, 0.1, 1e-6, 50, 2)
    assert none.converged and none.coef.tolist() == [0, 0]
    same = fit_tube(tube_rows(spark, np.ones((5, 2)), [3.0] * 5, 2), 2, 1.0, 0.1, 1e-6, 100, 2)
    assert same.converged and same.objective <= 1e-5
    with pytest.warns(UserWarning, match="duality gap"):
        rng = np.random.default_rng(0)
        z = rng.normal(size=(100, 3))
        assert not fit_tube(tube_rows(spark, z, z.sum(axis=1) + rng.normal(size=100), 2), 3, 1.0, 0.1, 1e-9, 6, 2).converged


def test_svr_within_epsilon_of_noise_free_rows(spark):
    p2 = fx.fixture(spark, SF01, fx.P2, "part")
    x = prep.Preprocess(scaler="standard").fit(p2, catalog._P1_FEATS).transform(p2, keep=["p_partkey", "y"])
    m = svm.SVR(C=10.0, epsilon=0.1, kernel="linear").fit(x, "y")
    assert m.converged_ and m.gap_ <= 1e-5 * (1 + m.objective_)
    worst = m.predict(x).agg(F.max(F.abs(F.col("y") - F.col("prediction")))).first()[0]
    assert worst <= 0.1 + 1e-2


def test_squared_loss_stays_available(spark):
    p2 = fx.fixture(spark, SF01, fx.P2, "part").withColumn(
        "x", F.array(F.col("p_size").cast("double"), F.col("p_retailprice"), (F.col("p_type") == "PROMO").cast("double")))
    m = svm.SVR(C=10.0, epsilon=0.1, kernel="linear", loss="squared_epsilon_insensitive").fit(p2, "y", "x")
    assert m.converged_ and np.allclose(m.coef_[:2], [2.0, 0.5], atol=0.01)
    with pytest.raises(ValueError):
        svm.SVR(loss="huber")


def test_sum_over_a_tree_of_tasks(spark):
    df = spark.range(1000).select(F.array(F.col("id").cast("double"), F.lit(1.0)).alias("v"))
    for tasks in (3, 100):
        got = sum_over(df.repartition(tasks), lambda batches: sum((matrix(b.column(0), 2).sum(axis=0) for b in batches), np.zeros(2)), tasks)
        assert got.tolist() == [499500.0, 1000.0]


@pytest.mark.parametrize("kernel,tol", [("rbf", 1e-3), ("poly", 1e-6)])
def test_landmarks_reach_their_error_target(spark, kernel, tol):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, 3))
    df = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)], "id long, features array<double>").repartition(3)
    m = svm.Nystroem(kernel, coef0=1.0, landmark_tol=tol).fit(df, "id")
    assert m.landmark_error_ <= tol and len(m.landmarks_) < 400
    phi = np.array([r["phi"] for r in m.transform(df, out_col="phi").orderBy("id").collect()])
    k = svm._kernel(x, x, kernel, m.gamma_, 3, 1.0)
    left = np.trace(k) - (phi ** 2).sum()
    assert left / np.trace(k) == pytest.approx(m.landmark_error_, abs=1e-9)
    assert np.abs(k - phi @ phi.T).max() <= left + 1e-6  # the residual is positive semi-definite


def test_fewer_landmarks_are_reported(spark):
    rng = np.random.default_rng(4)
    df = spark.createDataFrame([(i, rng.normal(size=5).tolist()) for i in range(300)], "id long, features array<double>")
    with pytest.warns(UserWarning, match="landmarks leave"):
        m = svm.Nystroem(n_landmarks=20).fit(df, "id")
    assert len(m.landmarks_) == 20 and m.landmark_error_ > 0.01
    # copies of few rows need no more landmarks than there are different rows
    few = spark.createDataFrame([(i, [float(i % 4), 1.0]) for i in range(200)], "id long, features array<double>")
    assert len(svm.Nystroem(landmark_tol=1e-9).fit(few, "id").landmarks_) == 4


def brute_coupling(r, k):
    """The fixed point iteration of the method's authors, one row."""
    q = np.array([[sum(r[j, t] ** 2 for j in range(k) if j != t) if t == s else -r[s, t] * r[t, s] for s in range(k)] for t in range(k)])
    p = np.full(k, 1.0 / k)
    for _ in range(10000):
        for t in range(k):
            p[t] = (-(q[t] @ p - q[t, t] * p[t]) + p @ q @ p) / q[t, t]
            p /= p.sum()
    return p


def test_coupling_equals_the_fixed_point():
    rng = np.random.default_rng(5)
    for k in (3, 5):
        pairs = [(i, j) for i in range(k) for j in range(i + 1, k)]
        r = rng.uniform(0.02, 0.98, size=(6, len(pairs)))
        got = svm.couple(r, pairs, k)
        assert np.allclose(got.sum(axis=1), 1) and (got >= 0).all()
        for row, p in zip(r, got):
            each = np.zeros((k, k))
            for x, (i, j) in zip(row, pairs):
                each[i, j], each[j, i] = x, 1 - x
            assert np.allclose(p, brute_coupling(each, k), atol=1e-6)


def test_coupled_probabilities_of_three_classes(spark):
    rng = np.random.default_rng(6)
    centre = {"a": (0, 0), "b": (4, 0), "c": (0, 4)}
    rows = [(i, c, (np.array(centre[c]) + rng.normal(size=2)).tolist()) for i, c in enumerate("abc" * 40)]
    df = spark.createDataFrame(rows, "id long, y string, x array<double>").coalesce(2)
    m = svm.SVC(kernel="linear", probability=True, platt_cv=2, max_iter=20).fit(df, "y", "x", key="id")
    assert len(m.platt_) == 3
    got = m.predict(df).collect()
    p = np.array([r["probability"] for r in got])
    assert np.allclose(p.sum(axis=1), 1) and (p >= 0).all()
    assert np.mean([m.classes_[i] == r["y"] for i, r in zip(p.argmax(axis=1), got)]) > 0.9


def test_sigmoids_are_the_minimum(spark):
    rng = np.random.default_rng(8)
    c = rng.integers(0, 2, 300)
    score = np.column_stack([c * 2.0 - 1 + rng.normal(size=300), np.where(c == 1, 5.0, -5.0)])  # the second is separable
    rows = spark.createDataFrame([(r.tolist(), float(k)) for r, k in zip(score, c)], "s array<double>, c double").repartition(3)
    pos = int(c.sum())
    got = svm.fit_sigmoids(rows, [(0, 1, (0, 1)), (1, 1, (0, 1))], {0: 300 - pos, 1: pos})
    t = np.where(c == 1, (pos + 1) / (pos + 2), 1 / (300 - pos + 2))
    for x, (a, b) in enumerate(got):
        p = 1 / (1 + np.exp(-(a * score[:, x] + b)))
        assert abs(((p - t) * score[:, x]).sum()) < 1e-5 and abs((p - t).sum()) < 1e-5 and a > 0
