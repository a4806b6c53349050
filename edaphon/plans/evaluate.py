"""Compare the model families on every target: search, refit, score, rank."""

from __future__ import annotations

from collections import Counter
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from threading import get_ident

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edaphon.modelling import moments as G
from edaphon.modelling import search as S
from edaphon.modelling.networks import Network, predict_networks, train_networks
from edaphon.modelling.score import log_target, ranked, regression_metrics
from edaphon.modelling.split import TEST, with_exact_folds, with_folds
from edaphon.modelling.trees import fit_boosting, held_rows, predict_boosting, staged_r2
from edaphon.session import fresh_path, materialise

# The fields of a result row.
RESULT_FIELDS = [
    "modelo", "target", "log_transform", "n_amostras", "n_features_originais", "cv_best_r2", "test_r2", "test_rmse",
    "test_mae", "test_rpd", "pca_componentes", "pca_variancia_explicada", "k_best", "melhores_params",
]
BOOSTED, NETWORK = ["XGBoost", "LightGBM"], "MLP"
STUDY = ["target", "model"]
SCORES = "target string, model string, trial int, step int, score double"
PREDICTIONS = ["target", "ssn", "model", "y", "yhat"]


@dataclass
class Options:
    """Budgets of the search. Linear trials cost no data pass; tree and network trials do. A boosted draw is
    fitted once a fold, with the most trees, and scored at every number in ``tree_lengths``; each is a
    trial, so 100 tree trials at nine lengths are 12 fits a fold."""

    models: list[str] = field(default_factory=lambda: list(S.SPACE))
    linear_trials: int = 100
    tree_trials: int = 100
    tree_lengths: tuple[int, ...] = S.LENGTHS
    network_trials: int = 100
    startup_trials: int = S.STARTUP_TRIALS  # trials that are never pruned
    folds: int = 5
    test_share: float = 0.2
    exact_sizes: bool = True  # ceil(share · n) test rows and even folds, for two passes over the keys; else by digest range
    seed: int = 42
    network_rounds: int = 1500
    log_targets: tuple[str, ...] = ()
    parallel: int = 8  # fits side by side; each is a chain of small jobs


@dataclass
class Projections:
    """Component scores by target and held-out fold, with the sizes of their training parts."""

    rows: DataFrame
    sizes: dict

    def of(self, target: str, holdout: int) -> tuple[DataFrame, int, int]:
        own = self.rows.filter((F.col("target") == target) & (F.col("holdout") == holdout))
        return own, *self.sizes[target, holdout]


@dataclass
class Evaluation:
    results: DataFrame
    predictions: DataFrame
    linear: DataFrame
    samples: DataFrame
    bases: DataFrame
    boosted: dict = field(default_factory=dict)
    networks: dict = field(default_factory=dict)
    skipped: dict[str, str] = field(default_factory=dict)


def samples_of(gold: DataFrame, options: Options) -> DataFrame:
    """``(target, ssn, fold, y, spectrum)`` with the log targets transformed."""
    if options.exact_sizes:
        split = with_exact_folds(gold, "ssn", ["target"], options.seed, options.folds, options.test_share)
    else:
        split = with_folds(gold, "ssn", options.seed, options.folds, options.test_share)
    if options.log_targets:
        split = log_target(split, list(options.log_targets))
    return split.select("target", "ssn", "fold", "y", "spectrum")


def components(study: G.Study, reduced: DataFrame) -> tuple[DataFrame, dict]:
    """Scores of all samples on the components of every fold's training rows, from one pass:
    ``(target, holdout, ssn, fold, y, features)``, written by target and holdout. Also the number
    of training rows and of components per target and holdout."""
    bases, sizes = {}, {}
    # a row per target and fold; its size is set by the instrument, not by the data
    for row in reduced.select("target", "holdout", "n_train", "mean_x", "scale", "loadings").collect():
        loadings = np.array(row["loadings"]).reshape(study.points, -1)
        basis = loadings / np.array(row["scale"])[:, None]
        bases.setdefault(row["target"], []).append((row["holdout"], np.array(row["mean_x"]), basis))
        sizes[row["target"], row["holdout"]] = (row["n_train"], loadings.shape[1])
    path = fresh_path(study.samples.sparkSession, "components")
    G.project_all(study.samples, study.points, bases).write.partitionBy("target", "holdout").parquet(path)
    schema = "ssn string, fold int, y double, features array<double>, target string, holdout int"
    return study.samples.sparkSession.read.schema(schema).parquet(path), sizes


def network_of(params: dict[str, float], available: int) -> Network:
    return Network(
        inputs=min(int(params["pca_n_components"]), available),
        layers=S.LAYERS[int(params["hidden_layer_sizes"])],
        activation=S.ACTIVATIONS[int(params["activation"])],
        alpha=params["alpha"],
        rate=params["learning_rate_init"],
    )


def _r2(predictions: DataFrame, by: list[str]) -> DataFrame:
    return regression_metrics(predictions, by).select(*by, F.col("test_r2").alias("score"))


def evaluate(gold: DataFrame, points: int, options: Options | None = None) -> Evaluation:
    """``gold`` is ``(target, ssn, y, spectrum)``, best a written table: it is read once for the
    moments, once for the components if trees or networks take part, and once to predict.
    """
    options = options or Options()
    spark = gold.sparkSession
    samples = samples_of(gold, options)
    study = G.study(samples, points, options.folds)
    reduced = materialise(study.reduced(), "reduced")
    shape = reduced.filter(F.col("holdout") == TEST).select("target", "n_train", F.lit(points).alias("points"))
    limits, skipped = usable_targets(S.bounds(shape), list(study.shift_y))

    def trials_of(models: list[str], count: int) -> DataFrame:
        named = [m for m in options.models if m in models]
        if models is not BOOSTED:
            return S.candidates(limits, count, options.seed, named)
        draws = -(-count // len(options.tree_lengths))
        return S.staged(S.candidates(limits, draws, options.seed, named), options.tree_lengths)

    budgets = [(S.LINEAR, options.linear_trials), (BOOSTED, options.tree_trials), ([NETWORK], options.network_trials)]
    wanted = [(m, n) for m, n in budgets if n > 0 and set(m) & set(options.models)]
    trials = wanted and trials_of(*wanted[0])
    for more in wanted[1:]:
        trials = trials.unionByName(trials_of(*more))
    trials = materialise(trials, "trials")

    scores = S.score_linear(trials, reduced, options.folds)
    heavy = [r.asDict() for r in trials.filter(~F.col("model").isin(S.LINEAR)).orderBy("target", "model", "trial").collect()]
    projections: Projections | None = None
    if heavy:
        projections = Projections(*components(study, reduced))
        rows = _cross_validate(heavy, projections, options)
        scores = scores.unionByName(spark.createDataFrame(rows, SCORES))
    scores = materialise(scores, "scores")

    best = S.best_trials(scores, STUDY, options.startup_trials).join(trials, ["target", "model", "trial"])
    best = materialise(best, "best")
    linear = materialise(S.linear_models(best, reduced, points), "linear")
    parts = [predict_linear(study, linear)]
    boosted, networks = {}, {}
    for row in best.filter(~F.col("model").isin(S.LINEAR)).collect():
        target, model, params = row["target"], row["model"], row["params"]
        rows, n, available = projections.of(target, TEST)
        train, test = rows.filter(F.col("fold") >= 0), rows.filter(F.col("fold") == TEST)
        if model in BOOSTED:
            train = held_rows(train, n, available)
            fitted = boosted[target, model] = fit_boosting(train, n, model, params, options.seed)
            train.unpersist()
            predicted = predict_boosting(fitted, test, params)
        else:
            network = networks[target, model] = network_of(params, available)
            train_networks(train, n, [network], rounds=options.network_rounds, seed=options.seed)
            predicted = predict_networks(test, [network], network.inputs, ["ssn", "y"])
        named = predicted.withColumn("target", F.lit(target)).withColumn("model", F.lit(model))
        parts.append(named.select(*PREDICTIONS))
    predictions = parts[0]
    for part in parts[1:]:
        predictions = predictions.unionByName(part)
    predictions = materialise(predictions, "predictions")
    results = result_table(predictions, best, linear, reduced, points, options.log_targets)
    bases = reduced.filter(F.col("holdout") == TEST).select("target", "mean_x", "scale", "loadings")
    return Evaluation(results, predictions, linear, study.samples, bases, boosted, networks, skipped)


def usable_targets(limits: DataFrame, targets: list[str]) -> tuple[DataFrame, dict[str, str]]:
    """The limits of the targets large enough to search, and the others with the reason. One target
    too small does not stop the rest; if none is left, that is an error. A row per target."""
    enough = (F.col("min_pca") >= S.SMALLEST) & (F.col("min_kbest") >= S.SMALLEST)
    good = {r["target"] for r in limits.filter(enough).select("target").collect()}
    skipped = {t: "too few samples or features" for t in sorted(targets) if t not in good}
    if not good:
        raise ValueError(f"too few samples or features: {', '.join(sorted(targets))}")
    return limits.filter(enough), skipped


def _cross_validate(heavy: list[dict], projections: Projections, options: Options) -> list[tuple]:
    """Held-out scores of trees and networks, fold by fold, trials that fall behind left out of the
    later folds. Fits are Spark jobs of their own; some run side by side so that a small one does
    not leave the cluster idle."""

    def parts(target: str, fold: int) -> tuple[DataFrame, DataFrame, int, int]:
        rows, n, available = projections.of(target, fold)
        number = F.col("fold")
        return rows.filter((number >= 0) & (number != fold)), rows.filter(number == fold), n, available

    def boosted(job) -> list[tuple]:
        """All trials of one draw: the longest is fitted, the others are its first trees."""
        own, fold, (train, held, n) = job
        spark = projections.rows.sparkSession
        # a pool each, so that a long fit does not hold up the short ones (where spark.scheduler.mode is FAIR)
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"fit-{get_ident()}")
        first = max(own, key=lambda t: t["params"]["n_estimators"])
        fitted = fit_boosting(train, n, first["model"], first["params"], options.seed)
        found = staged_r2(fitted, held, first["params"], [int(t["params"]["n_estimators"]) for t in own])
        return [(t["target"], t["model"], t["trial"], fold, score) for t, score in zip(own, found)]

    def draws() -> dict[tuple, list[dict]]:
        """Trials left, by what they share: everything but the number of trees."""
        out: dict[tuple, list[dict]] = {}
        for t in heavy:
            if t["model"] in BOOSTED:
                rest = sorted((k, v) for k, v in t["params"].items() if k != "n_estimators")
                out.setdefault((t["target"], t["model"], *rest), []).append(t)
        return out

    def network(job) -> list[tuple]:
        target, fold = job
        train, held, n, available = parts(target, fold)
        own = [t for t in heavy if t["target"] == target and t["model"] == NETWORK]
        nets = [network_of(t["params"], available) for t in own]
        train_networks(train, n, nets, rounds=options.network_rounds, seed=options.seed)
        scored = predict_networks(held, nets, max(n.inputs for n in nets), ["ssn", "y"])
        return [(target, NETWORK, own[r["net"]]["trial"], fold, r["score"]) for r in _r2(scored, ["net"]).collect()]

    scored: list[tuple] = []
    studies = Counter((t["target"], t["model"]) for t in heavy)
    # so few trials are never pruned: their folds need not wait for each other
    together = max(studies.values(), default=0) <= options.startup_trials
    waves = [list(range(options.folds))] if together else [[fold] for fold in range(options.folds)]
    with ThreadPoolExecutor(options.parallel) as pool:
        for wave in waves:
            left, kept = draws(), {}
            for target in sorted({own[0]["target"] for own in left.values()}):
                for fold in wave:
                    train, held, n, available = parts(target, fold)
                    kept[target, fold] = (held_rows(train, n, available), held, n)
            trees = [(own, fold, kept[own[0]["target"], fold]) for own in left.values() for fold in wave]
            nets = [(t, fold) for t in sorted({t["target"] for t in heavy if t["model"] == NETWORK}) for fold in wave]
            for part in pool.map(boosted, trees):
                scored += part
            for train, _, _ in kept.values():
                train.unpersist()
            for part in pool.map(network, nets):
                scored += part
            if together:
                continue
            # a trial that falls behind after this fold is not tried on the next
            judged = S.prune(projections.rows.sparkSession.createDataFrame(scored, SCORES), STUDY, options.startup_trials)
            behind = {(r["target"], r["model"], r["trial"]) for r in judged.filter("pruned").collect()}
            heavy = [t for t in heavy if (t["target"], t["model"], t["trial"]) not in behind]
    return scored


def predict_linear(study: G.Study, linear: DataFrame) -> DataFrame:
    """Predictions of all linear models for the test rows: one scan, one matrix product per batch
    and target."""
    models: dict[str, list] = {}
    for row in linear.orderBy("target", "model").collect():
        models.setdefault(row["target"], []).append((row["model"], row["intercept"], np.array(row["coefficients"])))
    test = study.samples.filter(F.col("fold") == TEST)
    return G.predict_all(test, study.points, models).select(*PREDICTIONS)


def result_table(predictions: DataFrame, best: DataFrame, linear: DataFrame, reduced: DataFrame, points: int,
                 log_targets: tuple[str, ...]) -> DataFrame:
    """The 14 result fields per target and model, ranked. All inputs but the predictions are tiny."""
    metrics = regression_metrics(predictions, ["target", "model"])
    sizes = reduced.filter(F.col("holdout") == TEST).select(
        "target", (F.col("n_train") + F.col("n_valid")).alias("n_amostras"), "eigenvalues", "variance"
    )
    components_used = F.col("params")["pca_n_components"].cast("int")
    share = F.aggregate(F.slice("eigenvalues", 1, F.coalesce(components_used, F.lit(0))), F.lit(0.0), lambda a, b: a + b)
    joined = metrics.join(best, ["target", "model"]).join(sizes, "target")
    used = components_used.isNotNull()
    values = [
        F.col("model"),
        F.col("target"),
        F.col("target").isin(list(log_targets)),
        F.col("n_amostras"),
        F.lit(points),
        F.col("cv_best_r2"),
        F.col("test_r2"),
        F.col("test_rmse"),
        F.col("test_mae"),
        F.col("test_rpd"),
        components_used,
        F.when(used, F.least(share / F.col("variance"), F.lit(1.0))),
        F.col("params")["k_best"].cast("int"),
        F.col("params"),
    ]
    rows = joined.select(*[value.alias(name) for name, value in zip(RESULT_FIELDS, values, strict=True)])
    return ranked(rows)


def save_models(evaluation: Evaluation, folder: str | None = None) -> str:
    """Linear coefficients, boosted models, network weights and the components they see, below one
    folder; ``plans/scoring.py`` loads it."""
    spark = evaluation.linear.sparkSession
    folder = folder or fresh_path(spark, "models")
    evaluation.linear.write.mode("overwrite").parquet(f"{folder}/linear")
    evaluation.samples.select("target", "ssn", "fold").write.mode("overwrite").parquet(f"{folder}/split")
    evaluation.bases.write.mode("overwrite").parquet(f"{folder}/bases")
    named = [(target, model, fitted.numFeatures) for (target, model), fitted in evaluation.boosted.items()]
    spark.createDataFrame(named, "target string, model string, inputs int").write.mode("overwrite").parquet(f"{folder}/boosted_models")
    for (target, model), fitted in evaluation.boosted.items():
        fitted.write().overwrite().save(f"{folder}/boosted/{target}/{model}")
    nets = [
        (t, m, n.inputs, list(n.layers), n.activation, n.alpha, n.rate, n.weights.tolist())
        for (t, m), n in evaluation.networks.items()
    ]
    schema = (
        "target string, model string, inputs int, layers array<int>, activation string, "
        "alpha double, rate double, weights array<double>"
    )
    spark.createDataFrame(nets, schema).write.mode("overwrite").parquet(f"{folder}/networks")
    return folder
