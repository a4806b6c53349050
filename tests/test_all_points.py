"""The linear queries on all 64 points against numpy."""

import numpy as np
import pytest

from edaphon.queries import QUERIES
from edaphon.queries.estimators import gold_all_points
from edaphon.queries.views import POINTS, planted


def arrays(rows):
    return np.array([r["spectrum"] for r in rows]), np.array([r["y"] for r in rows]), np.array([r["fold"] for r in rows])


@pytest.fixture(scope="module")
def samples(spark, sf):
    return arrays(planted(spark, sf).collect())


@pytest.fixture(scope="module")
def tidy(spark, sf):
    by_target = {}
    for r in gold_all_points(spark, sf).collect():
        by_target.setdefault(r["target"], []).append(r)
    return {target: arrays(rows) for target, rows in by_target.items()}


def principal(x):
    """Scaling and components of training rows: mean, scale, eigenvalues (sums of squares) and loadings."""
    mean, scale = x.mean(0), x.std(0)
    scale = np.where(scale > 0, scale, 1.0)
    _, s, v = np.linalg.svd((x - mean) / scale, full_matrices=False)
    return mean, scale, s**2, v.T


def fit(x, y, solve):
    """Coefficients and intercept on raw points; ``solve`` maps eigenvalues and X'y to weights on components."""
    mean, scale, values, vectors = principal(x)
    w = solve(values, (((x - mean) / scale) @ vectors).T @ (y - y.mean()), len(y))
    beta = vectors @ w / scale
    return beta, y.mean() - beta @ mean


def ridge(alpha):
    return lambda values, xy, n: xy / (values + alpha)


def elastic(alpha, l1):
    return lambda values, xy, n: np.sign(xy / n) * np.maximum(abs(xy / n) - alpha * l1, 0) / (values / n + alpha * (1 - l1))


def r2(x, y, beta, intercept):
    return 1 - np.sum((y - x @ beta - intercept) ** 2) / np.sum((y - y.mean()) ** 2)


@pytest.mark.parametrize("name, solve", [
    ("ridge_all_points", ridge(1.5)), ("lasso_all_points", elastic(0.05, 1.0)), ("elasticnet_all_points", elastic(0.05, 0.4)),
    ("pls_all_points", ridge(0.0)),
])
def test_fits(spark, sf, samples, name, solve):
    x, y, fold = samples
    beta, intercept = fit(x[fold >= 0], y[fold >= 0], solve)
    rows = sorted(QUERIES[name](spark, sf).collect(), key=lambda r: r["i"])
    assert len(rows) == POINTS
    np.testing.assert_allclose([r["coefficient"] for r in rows], beta, atol=2e-6)
    np.testing.assert_allclose([r["intercept"] for r in rows], intercept, atol=2e-6)


def test_cross_validation(spark, sf, samples):
    x, y, fold = samples
    got = {r["step"]: r["score"] for r in QUERIES["cv_scores_all_points"](spark, sf).collect()}
    train = [(k, (fold >= 0) & (fold != k), fold == k) for k in range(5)]
    want = {k: r2(x[out], y[out], *fit(x[within], y[within], ridge(0.0))) for k, within, out in train}
    assert got == pytest.approx(want, abs=2e-6)


def test_variance(spark, sf, samples):
    x, _, fold = samples
    got = {(r["holdout"], r["component"]): r["explained"] for r in QUERIES["pca_variance_all_points"](spark, sf).collect()}
    for k in range(-1, 5):
        values = principal(x[(fold >= 0) & (fold != k)])[2]
        np.testing.assert_allclose([got[k, j] for j in range(POINTS)], values / values.sum(), atol=2e-6)
    assert len(got) == 6 * POINTS


def test_all_targets(spark, sf, tidy):
    rows = QUERIES["all_targets_all_points"](spark, sf).collect()
    assert {r["target"] for r in rows} == set(tidy)
    for r in rows:
        x, y, fold = tidy[r["target"]]
        beta, intercept = fit(x[fold >= 0], y[fold >= 0], ridge(1.0))
        assert (r["n_train"], r["n_test"]) == ((fold >= 0).sum(), (fold < 0).sum())
        assert r["intercept"] == pytest.approx(intercept, rel=1e-6, abs=2e-6)
        assert r["test_r2"] == pytest.approx(r2(x[fold < 0], y[fold < 0], beta, intercept), rel=1e-6, abs=2e-6)


def test_leaderboard(spark, sf, tidy):
    models = {"Ridge": ridge(1.0), "Lasso": elastic(0.01, 1.0), "ElasticNet": elastic(0.01, 0.5)}
    rows = QUERIES["leaderboard_all_points"](spark, sf).collect()
    assert len(rows) == 3 * len(tidy)
    for r in rows:
        x, y, fold = tidy[r["target"]]
        solve = models[r["modelo"]]
        folds = [(x[(fold >= 0) & (fold != k)], y[(fold >= 0) & (fold != k)], x[fold == k], y[fold == k]) for k in range(5)]
        assert r["test_r2"] == pytest.approx(r2(x[fold < 0], y[fold < 0], *fit(x[fold >= 0], y[fold >= 0], solve)), abs=2e-6, rel=1e-6)
        assert r["cv_best_r2"] == pytest.approx(np.mean([r2(c, d, *fit(a, b, solve)) for a, b, c, d in folds]), abs=2e-6, rel=1e-6)
        assert (r["n_features_originais"], r["pca_componentes"]) == (POINTS, POINTS)
