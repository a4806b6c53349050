"""The moments engine and the linear family against plain numpy and MLlib."""

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import LinearRegression

from edaphon.modelling import gram as A
from edaphon.modelling import moments as G
from edaphon.modelling import search as S
from edaphon.plans.evaluate import usable_targets

SCHEMA = "target string, ssn string, fold int, y double, spectrum array<double>"


def data(n=300, p=6, seed=0, offset=50.0):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, p)) @ rng.normal(size=(p, p)) + offset
    y = x @ rng.normal(size=p) + rng.normal(size=n) + 1000
    fold = rng.integers(-1, 5, n)
    return x, y, fold


def frame(spark, x, y, fold, target="t"):
    rows = [(target, f"s{i}", int(fold[i]), float(y[i]), x[i].tolist()) for i in range(len(y))]
    return spark.createDataFrame(rows, SCHEMA)


def scaled(x, y, keep):
    mean, std = x[keep].mean(axis=0), x[keep].std(axis=0)
    return (x - mean) / std, y - y[keep].mean()


@pytest.fixture(scope="module")
def case(spark):
    x, y, fold = data()
    study = G.study(frame(spark, x, y, fold).repartition(5), x.shape[1])
    rows = {r["holdout"]: r for r in study.reduced().collect()}
    return x, y, fold, study, rows


def test_reduced_moments(case):
    x, y, fold, _, rows = case
    for holdout in (-1, 0, 4):
        keep = (fold >= 0) & (fold != holdout)
        z, c = scaled(x, y, keep)
        row = rows[holdout]
        assert row["n_train"] == keep.sum() and row["n_valid"] == (fold == holdout).sum()
        assert np.allclose(row["mean_x"], x[keep].mean(axis=0)) and np.allclose(row["scale"], x[keep].std(axis=0))
        values = np.linalg.eigvalsh(z[keep].T @ z[keep])[::-1]
        assert np.allclose(row["eigenvalues"], values) and np.isclose(row["variance"], values.sum())
        scores = z @ np.array(row["loadings"]).reshape(x.shape[1], -1)
        assert np.allclose(scores[keep].T @ c[keep], row["pca_xy"])
        held = fold == holdout
        assert np.allclose((scores[held].T @ scores[held]).ravel(), row["pca_valid_xx"])
        assert np.isclose(c[held] @ c[held], row["valid_yy"])


def test_partitions_do_not_matter(spark, case):
    x, y, fold, study, rows = case
    other = G.gram_blocks(frame(spark, x, y, fold).coalesce(1), 6, study.shift_x, study.shift_y)
    again = {r["holdout"]: r for r in G.reduce_moments(G.holdout_moments(other), 6, study.shift_x, study.shift_y).collect()}
    assert np.allclose(again[-1]["loadings"], rows[-1]["loadings"], atol=1e-9)


def test_blocks_of_a_wide_spectrum(spark):
    x, y, fold = data(n=400, p=300, seed=3, offset=0.0)
    study = G.study(frame(spark, x, y, fold).repartition(3), 300)
    row = study.reduced().filter("holdout = -1").collect()[0]
    keep = fold >= 0
    z, c = scaled(x, y, keep)
    assert len(row["eigenvalues"]) == 80
    assert np.allclose(row["eigenvalues"], np.linalg.eigvalsh(z[keep].T @ z[keep])[::-1][:80])
    r2 = (z[keep].T @ c[keep]) ** 2 / (keep.sum() * (c[keep] @ c[keep]))
    best = np.argsort(-(r2 / (1 - r2)), kind="stable")
    assert row["best"][:20] == best[:20].tolist()


def test_constant_feature(spark):
    x, y, fold = data()
    x[:, 2] = 7.0
    features = G.study(frame(spark, x, y, fold), 6).features().filter("holdout = -1").collect()
    assert [r["f_score"] is None for r in sorted(features, key=lambda r: r["i"])] == [False, False, True, False, False, False]


def test_ragged_spectra_are_an_error(spark):
    rows = [("t", "a", 0, 1.0, [1.0, 2.0]), ("t", "b", 1, 2.0, [1.0])]
    with pytest.raises(Exception, match="every spectrum must have 2 values"):
        G.study(spark.createDataFrame(rows, SCHEMA).coalesce(1), 2).reduced().collect()


@pytest.mark.parametrize("bad", [("t", "b", 1, 2.0, [1.0, None]), ("t", "b", 1, 2.0, [1.0, float("nan")]), ("t", "b", 1, None, [1.0, 2.0])])
def test_missing_values_are_an_error(spark, bad):
    rows = [("t", "a", 0, 1.0, [1.0, 2.0]), bad]
    with pytest.raises(Exception, match="missing or infinite"):
        G.study(spark.createDataFrame(rows, SCHEMA).coalesce(1), 2).reduced().collect()


def test_several_targets_in_one_pass(spark, case):
    x, y, fold, _, rows = case
    both = frame(spark, x, y, fold).unionByName(frame(spark, x, -2 * y, fold, "u"))
    found = {(r["target"], r["holdout"]): r for r in G.study(both, 6).reduced().collect()}
    assert len(found) == 12
    assert np.allclose(found["t", -1]["pca_xy"], rows[-1]["pca_xy"])
    assert np.allclose(found["u", 2]["pca_xy"], -2 * np.array(rows[2]["pca_xy"]))


def coordinate_check(xx, xy, n, alpha, l1, w):
    """Optimality of an elastic net solution."""
    slope = (xy - xx @ w) / n - alpha * (1 - l1) * w
    on = w != 0
    assert np.allclose(slope[on], alpha * l1 * np.sign(w[on]), atol=1e-5)
    assert (np.abs(slope[~on]) <= alpha * l1 + 1e-5).all()


def test_held_out_score_needs_no_data(case):
    x, y, fold, _, rows = case
    for model, params in [
        ("Ridge", {"pca_n_components": 4, "alpha": 3.0}),
        ("Lasso", {"pca_n_components": 6, "alpha": 0.1}),
        ("ElasticNet", {"pca_n_components": 5, "alpha": 0.2, "l1_ratio": 0.3}),
        ("PLS", {"pca_n_components": 6, "n_components": 2}),
        ("ElasticNet_SelectKBest", {"k_best": 3, "alpha": 0.05, "l1_ratio": 0.5}),
    ]:
        space, count, w = S.linear_weights(model, params, rows[1])
        keep, held = (fold >= 0) & (fold != 1), fold == 1
        z, c = scaled(x, y, keep)
        if space == "pca":
            features = z @ np.array(rows[1]["loadings"]).reshape(6, -1)[:, :count]
        else:
            features = z[:, rows[1]["best"][:count]]
        if model == "Ridge":
            a = features[keep]
            assert np.allclose(w, np.linalg.solve(a.T @ a + 3.0 * np.eye(count), a.T @ c[keep]))
        if model in ("Lasso", "ElasticNet", "ElasticNet_SelectKBest"):
            a, l1 = features[keep], params.get("l1_ratio", 1.0)
            coordinate_check(a.T @ a, a.T @ c[keep], keep.sum(), params["alpha"], l1, w)
        error = c[held] - features[held] @ w
        expected = 1 - error @ error / ((y[held] - y[held].mean()) ** 2).sum()
        assert np.isclose(S.held_out_r2(space, count, w, rows[1]), expected), model


def nipals(x, y, components):
    x = (x - x.mean(axis=0)) / x.std(axis=0, ddof=1)
    y = y - y.mean()
    fitted = np.zeros(len(y))
    for _ in range(components):
        w = x.T @ y
        w /= np.linalg.norm(w)
        t = x @ w
        p, q = x.T @ t / (t @ t), y @ t / (t @ t)
        x, y, fitted = x - np.outer(t, p), y - q * t, fitted + q * t
    return fitted


@pytest.mark.parametrize("components", [1, 2, 4, 6])
def test_pls_equals_deflation_of_the_data(components):
    x, y, _ = data(seed=5)
    c = x - x.mean(axis=0)
    w = A.pls_weights(c.T @ c, c.T @ (y - y.mean()), len(y), components)
    assert np.allclose(c @ w, nipals(x, y, components), atol=1e-6)


def test_pls_on_uncorrelated_features_is_least_squares():
    values, xy = np.array([9.0, 4.0, 1.0]), np.array([3.0, -1.0, 0.5])
    w = A.pls_weights(np.diag(values), xy, 50, 3)
    assert np.allclose(w, xy / values)


def test_refit_agrees_with_mllib(spark, case):
    x, y, fold, study, _ = case
    train = study.samples.filter("fold >= 0").select("y", array_to_vector("spectrum").alias("features"))
    trials = spark.createDataFrame([("t", "Ridge", 0, {"pca_n_components": 6.0, "alpha": 1e-9})],
                                   "target string, model string, trial int, params map<string,double>")
    fitted = S.linear_models(trials, study.reduced(), 6).collect()[0]
    mllib = LinearRegression(labelCol="y", solver="normal").fit(train)
    assert np.allclose(fitted["coefficients"], mllib.coefficients.toArray(), rtol=1e-5)
    assert np.isclose(fitted["intercept"], mllib.intercept, rtol=1e-5)


def test_lasso_agrees_with_mllib(spark, case):
    x, y, fold, study, rows = case
    keep = fold >= 0
    z, c = scaled(x, y, keep)
    scores = z @ np.array(rows[-1]["loadings"]).reshape(6, -1)
    train = spark.createDataFrame([(float(c[i]), scores[i].tolist()) for i in np.flatnonzero(keep)], "y double, f array<double>")
    vectors = train.select("y", array_to_vector("f").alias("features"))
    mllib = LinearRegression(labelCol="y", regParam=0.3, elasticNetParam=1.0, standardization=False, tol=1e-10).fit(vectors)
    w = S.linear_weights("Lasso", {"pca_n_components": 6, "alpha": 0.3}, rows[-1])[2]
    assert np.allclose(mllib.coefficients.toArray(), w, atol=1e-5)


def test_affine(spark):
    x, y, fold = data(n=20)
    matrix = np.arange(12.0).reshape(6, 2)
    got = G.affine(frame(spark, x, y, fold), ["ssn"], 6, np.ones(6), matrix).collect()
    assert np.allclose([r["features"] for r in got], (x - 1) @ matrix)
    empty = frame(spark, x, y, fold).filter("y < 0")
    assert G.affine(empty, ["ssn"], 6, np.ones(6), matrix).count() == 0


def test_search(spark):
    shape = spark.createDataFrame([("t", 400, 64), ("u", 12, 64)], "target string, n_train bigint, points int")
    limits = S.bounds(shape)
    got = {r["target"]: r for r in limits.collect()}
    assert (got["t"]["min_pca"], got["t"]["max_pca"], got["t"]["min_kbest"], got["t"]["max_kbest"]) == (10, 64, 30, 64)
    assert (got["u"]["min_pca"], got["u"]["max_pca"]) == (10, 11)
    small = spark.createDataFrame([("t", 400, 64), ("v", 2, 64)], shape.schema)
    kept, skipped = usable_targets(S.bounds(small), ["t", "v", "w"])
    assert [r["target"] for r in kept.collect()] == ["t"] and list(skipped) == ["v", "w"]
    with pytest.raises(ValueError, match="too few"):
        usable_targets(S.bounds(small.filter("target = 'v'")), ["v"])
    trials = S.candidates(limits, 200).collect()
    assert len(trials) == 2 * 8 * 200
    for r in trials:
        p, limit = r["params"], got[r["target"]]
        for name, kind, low, high, step in S.SPACE[r["model"]]:
            if low is not None and high is not None:
                assert low <= p[name] <= high * (1 + 1e-12)
            if kind in ("int", "choice"):
                assert p[name] == int(p[name]) and (low is None or (p[name] - low) % step == 0)
        if "pca_n_components" in p:
            assert limit["min_pca"] <= p["pca_n_components"] <= limit["max_pca"]
        if "n_components" in p:
            assert 2 <= p["n_components"] <= min(30, p["pca_n_components"])
    again = S.candidates(limits, 200).repartition(3).collect()
    assert {repr(r) for r in again} == {repr(r) for r in trials}
    other = {repr(r) for r in S.candidates(limits, 200, seed=1).collect()}
    assert other != {repr(r) for r in trials}


def test_pruning(spark):
    """Only trials that did not stop count, for the start-up and for the medians; a trial's best is compared."""
    scores = [("s", t, f, 0.1 * (t * 5 % 7) - 0.01 * f * (t % 3)) for t in range(60) for f in range(5) if (t, f) != (30, 4)]
    judged = S.prune(spark.createDataFrame(scores, "study string, trial int, step int, score double"), ["study"])
    got = {(r["trial"], r["step"]): r for r in judged.collect()}
    done: list[dict[int, float]] = []
    stopped = 0
    for t in range(60):
        means, stop = {}, False
        for f in range(5 - (t == 30)):
            own = [s for _, u, g, s in scores if u == t and g <= f]
            means[f] = np.mean(own)
            others = [d[f] for d in done if f in d]
            behind = len(done) >= 20 and f >= 1 and bool(others) and max(means.values()) < np.median(others) - 1e-12
            assert got[t, f]["pruned"] == behind and np.isclose(got[t, f]["running_mean"], means[f])
            stop |= behind
        stopped += stop
        if not stop:
            done.append(means)
    assert 0 < stopped < 40


def test_pruning_by_hand(spark):
    """One start-up trial: 1 stops behind 0, so 2 is compared with 0 alone and goes on."""
    rows = [("s", 0, 0, 0.5), ("s", 0, 1, 0.5), ("s", 1, 0, 0.1), ("s", 1, 1, 0.1), ("s", 2, 0, 0.9), ("s", 2, 1, 0.1),
            ("s", 3, 0, 0.45), ("s", 3, 1, 0.45)]
    judged = S.prune(spark.createDataFrame(rows, "study string, trial int, step int, score double"), ["study"], startup=1)
    got = {(r["trial"], r["step"]): (r["earlier_median"], r["pruned"]) for r in judged.collect()}
    assert got == {
        (0, 0): (None, False), (0, 1): (None, False), (1, 0): (0.5, False), (1, 1): (0.5, True),
        (2, 0): (0.5, False), (2, 1): (0.5, False), (3, 0): (0.7, False), (3, 1): (0.5, True),
    }
