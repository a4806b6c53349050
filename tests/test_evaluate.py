"""Networks, scores and the whole comparison."""

import math

import numpy as np
import pytest
from pyspark.ml.regression import GBTRegressionModel
from pyspark.sql import functions as F

from edaphon.modelling import score as R
from edaphon.modelling import trees
from edaphon.modelling.networks import Network, network_groups, predict_networks, sharded, train_networks
from edaphon.modelling.trees import regressor, tree_depth
from edaphon.plans import evaluate as E
from edaphon.plans import scoring
from edaphon.plans.evaluate import Options, evaluate, save_models


def rows_of(spark, n=600, p=4, seed=1):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, p))
    y = 2 * x[:, 0] - x[:, 1] + 0.5 * x[:, 2] * x[:, 3] + 0.05 * rng.normal(size=n)
    rows = [(f"s{i}", float(y[i]), x[i].tolist()) for i in range(n)]
    return spark.createDataFrame(rows, "ssn string, y double, features array<double>"), x, y


@pytest.mark.parametrize("activation", ["relu", "tanh"])
def test_gradient(activation):
    rng = np.random.default_rng(0)
    net = Network(3, (5, 4), activation, 0.1, 0.01)
    w, x, y = net.initial(1), rng.normal(size=(7, 3)), rng.normal(size=7)
    grad, _ = net.gradient(w, x, y)

    def value(flat):
        penalty = sum((m**2).sum() for m, _ in net.unpack(flat)) * 0.1 / 2 / len(y)
        return net.gradient(flat, x, y)[1] / len(y) + penalty

    for i in rng.integers(0, len(w), 12):
        step = np.zeros_like(w)
        step[i] = 1e-6
        assert np.isclose((value(w + step) - value(w - step)) / 2e-6, grad[i], atol=1e-5)


@pytest.mark.parametrize("shard_rows", [100_000, 150])
def test_networks_learn(spark, shard_rows):
    rows, x, y = rows_of(spark)
    nets = [Network(4, (32,), "relu", 1e-4, 1e-2), Network(2, (16,), "tanh", 1e-4, 1e-2)]
    history = train_networks(rows, 600, nets, rounds=12, seed=3, shard_rows=shard_rows)
    losses = np.array(history.loss)
    assert np.isfinite(losses).all() and (losses[-1] < losses[0]).all()
    scored = predict_networks(rows, nets, 4, ["ssn", "y"])
    found = {r["net"]: r["test_r2"] for r in R.regression_metrics(scored, ["net"]).collect()}
    assert found[0] > 0.5 and found[0] > found[1] - 0.1
    one = {r["ssn"]: r["yhat"] for r in scored.filter("net = 0").collect()}
    assert np.isclose(one["s5"], nets[0].predict(x[5:6])[0])


def test_networks_are_reproducible(spark):
    rows, _, _ = rows_of(spark, 200)
    first, second = (Network(4, (8,), "relu", 1e-4, 1e-2) for _ in range(2))
    train_networks(rows.repartition(1), 200, [first], rounds=3)
    train_networks(rows.repartition(6), 200, [second], rounds=3)
    assert np.allclose(first.weights, second.weights, atol=1e-9)


def test_networks_are_dealt_to_tasks(spark):
    """More groups of networks are more tasks, each with some rows, and the same weights."""
    rows, _, _ = rows_of(spark, 500)
    trained = []
    for tasks in (1, 6, 100):
        nets = [Network(4, (6 + i,), "relu", 1e-4, 1e-2) for i in range(3)]
        train_networks(rows, 500, nets, rounds=3, shard_rows=200, tasks=tasks)
        trained.append([n.weights for n in nets])
    for other in trained[1:]:
        assert all(np.allclose(a, b, atol=1e-9) for a, b in zip(trained[0], other))
    assert [network_groups(3, 3, tasks) for tasks in (1, 6, 100)] == [1, 2, 3]
    data = sharded(rows, 3, 2, "ssn", 4, 42)
    filled = data.groupBy(F.spark_partition_id().alias("p")).agg(F.countDistinct("_group", "_shard").alias("n")).collect()
    assert data.count() == 1000 and len(filled) == 6 and all(r["n"] == 1 for r in filled)


def test_rounds_against_numpy(spark):
    """Weights after each round, written out: epochs of Adam per shard from common weights, averaged by rows."""
    rows, _, _ = rows_of(spark, 500)
    net = Network(4, (6,), "tanh", 1e-3, 1e-2)
    history = train_networks(rows, 500, [net], rounds=2, seed=5, shard_rows=200)
    shards: dict = {}
    for r in sharded(rows, 3, 1, "ssn", 4, 5).sort("_shard", "_order").collect():
        shards.setdefault(r["_shard"], []).append(r)
    w = net.initial(5)
    state, step, seen = np.stack([w, 0 * w, 0 * w]), 0, [(-np.inf, w)]
    for number in range(3):
        parts, held, weights, loss, steps = [], [], [], 0.0, []
        for own in shards.values():
            x, y = np.array([r["features"] for r in own]), np.array([r["y"] for r in own])
            valid = np.array([r["_valid"] for r in own])
            held.append((y[valid], net.forward(state[0], x[valid])[-1][:, 0]))
            mine, at = state.copy(), step
            order = np.random.default_rng(5 + number).permutation(np.flatnonzero(~valid))
            for start in range(0, len(order), 200):
                chosen, at = order[start : start + 200], at + 1
                grad, value = net.gradient(mine[0], x[chosen], y[chosen])
                mine[1], mine[2] = 0.9 * mine[1] + 0.1 * grad, 0.999 * mine[2] + 0.001 * grad**2
                rate = 1e-2 * np.sqrt(1 - 0.999**at) / (1 - 0.9**at)
                mine[0] -= rate * mine[1] / (np.sqrt(mine[2]) + 1e-8)
                loss += value
            parts.append(mine)
            weights.append(len(order))
            steps.append(at)
        y, yhat = (np.concatenate(side) for side in zip(*held))
        score = 1 - ((y - yhat) ** 2).sum() / ((y - y.mean()) ** 2).sum()
        assert np.isclose(history.score[number][0], score) and np.isclose(history.loss[number][0], loss / sum(weights))
        seen.append((score, state[0].copy()))
        state, step = sum(p * n for p, n in zip(parts, weights)) / sum(weights), max(steps)
    assert np.allclose(net.weights, max(seen, key=lambda s: s[0])[1], atol=1e-9)


def test_early_stopping(spark):
    rng = np.random.default_rng(0)
    noise = [(f"s{i}", float(rng.normal()), rng.normal(size=3).tolist()) for i in range(150)]
    rows = spark.createDataFrame(noise, "ssn string, y double, features array<double>")
    history = train_networks(rows, 150, [Network(3, (8,), "tanh", 1e-4, 1e-2)], rounds=60)
    assert 10 < len(history.loss) < 61


def test_tree_mapping(spark):
    params = {"max_depth": 8, "num_leaves": 15, "n_estimators": 100, "learning_rate": 0.1, "subsample": 0.7,
              "colsample_bytree": 0.6, "reg_alpha": 1.0, "reg_lambda": 2.5}
    assert tree_depth("XGBoost", params) == 8 and tree_depth("LightGBM", params) == 4
    assert tree_depth("LightGBM", {**params, "max_depth": 3, "num_leaves": 80}) == 3
    fitted = regressor("LightGBM", params, 100)
    assert fitted.getMinInstancesPerNode() == 22 and fitted.getFeatureSubsetStrategy() == "0.6"
    assert math.isclose(fitted.getMinInfoGain(), 0.01)


def test_metrics(spark):
    pairs = [("a", 1.0, 1.5), ("a", 2.0, 2.0), ("a", 4.0, 3.0), ("b", 3.0, 3.0), ("b", 3.0, 4.0)]
    rows = spark.createDataFrame(pairs, "g string, y double, yhat double")
    found = {r["g"]: r for r in R.regression_metrics(rows, ["g"]).collect()}
    y, e = np.array([1.0, 2, 4]), np.array([-0.5, 0, 1])
    assert np.isclose(found["a"]["test_r2"], 1 - e @ e / ((y - y.mean()) ** 2).sum())
    assert np.isclose(found["a"]["test_rpd"], y.std() / np.sqrt((e**2).mean()))
    assert np.isclose(found["a"]["test_rpd"], 1 / np.sqrt(1 - found["a"]["test_r2"]))
    assert np.isclose(found["a"]["test_mae"], 0.5) and found["a"]["axis_min"] == 1.0
    assert found["b"]["test_r2"] is None and found["b"]["test_rpd"] == 0.0
    bands = spark.createDataFrame([(2.1,), (2.0,), (1.5,), (1.4,), (None,)], "rpd double")
    got = [r[0] for r in bands.select(R.rpd_band(F.col("rpd"))).collect()]
    assert got == ["good", "acceptable", "acceptable", "poor", None]


def test_log_target(spark):
    rows = spark.createDataFrame([("p", 1.0), ("p", math.e), ("q", -1.0)], "target string, y double")
    got = [r["y"] for r in R.log_target(rows, ["p"]).collect()]
    assert np.allclose(got, [0.0, 1.0, -1.0])
    with pytest.raises(Exception, match="positive"):
        R.log_target(rows).collect()
    guard = {r["target"]: r["log_allowed"] for r in R.log_guard(rows, ["target"]).collect()}
    assert guard == {"p": True, "q": False}


def test_evaluation(spark, tmp_path):
    rng = np.random.default_rng(2)
    rows = []
    for target, weight in (("ph", 1.0), ("p", 0.2)):
        for i in range(260):
            x = rng.normal(size=40) + np.linspace(0, 3, 40)
            y = weight * (x[0] - x[1] + 0.3 * x[5]) + 0.05 * rng.normal()
            rows.append((target, f"s{i}", float(np.exp(y) if target == "p" else y), x.tolist()))
    gold = spark.createDataFrame(rows, "target string, ssn string, y double, spectrum array<double>")
    options = Options(
        linear_trials=25, tree_trials=1, network_trials=1, folds=2, network_rounds=4, log_targets=("p",), exact_sizes=True,
        models=["Ridge", "PLS", "ElasticNet", "ElasticNet_SelectKBest", "Lasso", "XGBoost", "MLP"],
        tree_lengths=(3,),
    )
    found = evaluate(gold, 40, options)
    results = [r.asDict() for r in found.results.collect()]
    assert len(results) == 14 and len(results[0]) == 15
    for target in ("ph", "p"):
        own = [r for r in results if r["target"] == target]
        assert [r["test_r2"] for r in own] == sorted((r["test_r2"] for r in own), reverse=True)
        assert own[0]["test_r2"] > 0.8 and all(r["log_transform"] == (target == "p") for r in own)
        assert all(np.isclose(r["test_rpd"], 1 / np.sqrt(1 - r["test_r2"])) for r in own)
        assert all(r["n_amostras"] == 260 and r["n_features_originais"] == 40 for r in own)
        best = next(r for r in own if r["modelo"] == "ElasticNet_SelectKBest")
        assert best["pca_componentes"] is None and 30 <= best["k_best"] <= 40
    test = found.samples.filter("fold = -1")
    assert test.count() == 2 * 52
    assert found.predictions.count() == 7 * test.count()
    folder = save_models(found, str(tmp_path / "models"))
    assert spark.read.parquet(f"{folder}/linear").count() == 10
    assert spark.read.parquet(f"{folder}/networks").count() == 2
    assert GBTRegressionModel.load(f"{folder}/boosted/ph/XGBoost").getNumTrees == 3
    check_saved_models(spark, found, folder)


def check_saved_models(spark, found, folder):
    """What is loaded predicts what the models predicted before they were saved, from the spectra alone."""
    spectra = found.samples.filter("fold = -1").select(F.concat("target", F.lit("/"), "ssn").alias("ssn"), "spectrum")
    odd = spark.createDataFrame([("short", [1.0]), ("none", None), ("nan", [float("nan")] * 40)], "ssn string, spectrum array<double>")
    models = scoring.load_models(spark, folder)
    before = {(r["target"], r["model"], r["ssn"]): r["yhat"] for r in found.predictions.collect()}
    scored = scoring.score_spectra(spectra.unionByName(odd), models).collect()
    assert len(scored) == 2 * len(before)  # models of both targets see the spectra of both
    after = {(r["target"], r["model"], r["ssn"].split("/")[1]): r["yhat"] for r in scored if r["ssn"].split("/")[0] == r["target"]}
    assert after.keys() == before.keys()
    assert all(np.isclose(after[k], before[k], rtol=1e-9, atol=1e-9) for k in before)
    scoring.SCAN_BYTES, whole = 1000, scoring.SCAN_BYTES
    try:
        assert len(scoring.scans(models)) > 3
        assert scoring.score_spectra(spectra, models).count() == len(scored)
    finally:
        scoring.SCAN_BYTES = whole


def test_trials_that_fall_behind_stop(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(150, 12))
    y = x @ rng.normal(size=12)
    rows = [("t", f"s{i}", float(y[i]), x[i].tolist()) for i in range(150)]
    gold = spark.createDataFrame(rows, "target string, ssn string, y double, spectrum array<double>")
    options = Options(models=["XGBoost"], tree_trials=4, folds=3, startup_trials=1)
    samples = E.samples_of(gold, options)
    study = E.G.study(samples, 12, 3)
    reduced = E.materialise(study.reduced(), "reduced")
    limits, _ = E.usable_targets(E.S.bounds(reduced.filter("holdout = -1").selectExpr("target", "n_train", "12 as points")), ["t"])
    heavy = [
        {"target": "t", "model": "XGBoost", "trial": r["trial"], "params": {**r["params"], "n_estimators": 2.0, "max_depth": 2.0}}
        for r in E.S.candidates(limits, 4, models=["XGBoost"]).collect()
    ]
    scored = E._cross_validate(heavy, E.Projections(*E.components(study, reduced)), options)
    tried = {t: sorted(s for _, _, trial, s, _ in scored if trial == t) for t in range(4)}
    assert tried[0] == [0, 1, 2] and all(steps[:2] == [0, 1] for steps in tried.values())
    table = spark.createDataFrame(scored, E.SCORES)
    pruned = {(r["trial"], r["step"]) for r in E.S.prune(table, E.STUDY, 1).filter("pruned").collect()}
    for trial, steps in tried.items():
        stopped = [s for t, s in pruned if t == trial]
        assert steps == list(range(min(stopped, default=2) + 1))


def test_lengths_of_one_draw_share_a_fit(spark):
    """Every length scores as a fit of its own would, and trials are numbered draw by draw."""
    rng = np.random.default_rng(6)
    x = rng.normal(size=(160, 12))
    y = x[:, 0] - x[:, 1] ** 2 + 0.1 * rng.normal(size=160)
    rows = [("t", f"s{i}", float(y[i]), x[i].tolist()) for i in range(160)]
    gold = spark.createDataFrame(rows, "target string, ssn string, y double, spectrum array<double>")
    options = Options(models=["LightGBM"], folds=2)
    study = E.G.study(E.samples_of(gold, options), 12, 2)
    reduced = E.materialise(study.reduced(), "reduced")
    limits = E.S.bounds(reduced.filter("holdout = -1").selectExpr("target", "n_train", "12 as points"))
    drawn = E.S.candidates(limits, 2, models=["LightGBM"])
    trials = [r.asDict() for r in E.S.staged(drawn, (1, 4, 9)).orderBy("trial").collect()]
    assert [t["trial"] for t in trials] == list(range(6))
    assert [t["params"]["n_estimators"] for t in trials] == [1.0, 4.0, 9.0] * 2
    assert len({t["params"]["learning_rate"] for t in trials}) == 2
    projections = E.Projections(*E.components(study, reduced))
    scored = {(trial, fold): r2 for _, _, trial, fold, r2 in E._cross_validate(trials, projections, options)}
    assert len(scored) == 12
    for trial in (trials[1], trials[5]):
        own, n, width = projections.of("t", 1)
        train = trees.held_rows(own.filter("fold >= 0 and fold != 1"), n, width)
        assert train.rdd.getNumPartitions() == 1
        fitted = trees.fit_boosting(train, n, "LightGBM", trial["params"], options.seed)
        alone = R.regression_metrics(trees.predict_boosting(fitted, own.filter("fold = 1"), trial["params"]), []).first()["test_r2"]
        train.unpersist()
        assert np.isclose(scored[trial["trial"], 1], alone)
    flat = own.filter("fold = 1").withColumn("y", F.lit(1.0))
    assert trees.staged_r2(fitted, flat, trial["params"], [1, 9]) == [None, None]
