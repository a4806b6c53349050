"""Search space, seeded candidates, held-out scores, pruning and the best trial."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from edaphon.functions.hashing import hex_uniform
from edaphon.modelling.gram import elastic_dense, elastic_diagonal, pls_weights, ridge_diagonal
from edaphon.modelling.moments import MAX_KBEST, MAX_PCA, group_tasks

# The search space. Bounds marked None come from the data, see `bounds`.
# (parameter, kind, low, high, step)
PCA_COUNT = ("pca_n_components", "int", None, None, 1)
_BOOSTING = [
    ("n_estimators", "int", 100, 500, 50),
    ("learning_rate", "log", 1e-2, 0.2, None),
    ("max_depth", "int", 2, 8, 1),
    ("subsample", "float", 0.6, 1.0, None),
    ("colsample_bytree", "float", 0.6, 1.0, None),
    ("reg_alpha", "log", 1e-4, 10.0, None),
    ("reg_lambda", "log", 1e-4, 10.0, None),
]
_ELASTIC = [("alpha", "log", 1e-4, 10.0, None), ("l1_ratio", "float", 0.05, 0.95, None)]
SPACE = {
    "Ridge": [PCA_COUNT, ("alpha", "log", 1e-3, 1e3, None)],
    "PLS": [PCA_COUNT, ("n_components", "int", 2, None, 1)],
    "ElasticNet": [PCA_COUNT, *_ELASTIC],
    "ElasticNet_SelectKBest": [("k_best", "int", None, None, 1), *_ELASTIC],
    "Lasso": [PCA_COUNT, ("alpha", "log", 1e-4, 10.0, None)],
    "XGBoost": [PCA_COUNT, *_BOOSTING],
    "LightGBM": [PCA_COUNT, *_BOOSTING, ("num_leaves", "int", 15, 80, 1)],
    "MLP": [
        PCA_COUNT,
        ("hidden_layer_sizes", "choice", 0, 3, 1),
        ("activation", "choice", 0, 1, 1),
        ("alpha", "log", 1e-5, 1e-1, None),
        ("learning_rate_init", "log", 1e-4, 1e-2, None),
    ],
}
LAYERS = [(64,), (128,), (128, 64), (256, 128)]
ACTIVATIONS = ["relu", "tanh"]
MIN_PCA, MIN_KBEST, MAX_PLS = 10, 30, 30
#: Numbers of boosted trees in the space; one fit of the longest scores them all.
LENGTHS = tuple(range(100, 501, 50))
SMALLEST = 2  # components and features below which a target cannot be searched
STARTUP_TRIALS, WARMUP_STEPS = 20, 1
LINEAR = ["Ridge", "PLS", "ElasticNet", "ElasticNet_SelectKBest", "Lasso"]


def bounds(shape: DataFrame) -> DataFrame:
    """Data-dependent bounds from ``(target, n_train, points)``."""
    n, p = F.col("n_train"), F.col("points")
    high_pca, high_best = F.least(F.lit(MAX_PCA), p, n - 1), F.least(F.lit(MAX_KBEST), p)
    return shape.select(
        "target",
        F.least(F.lit(MIN_PCA), high_pca).alias("min_pca"),
        high_pca.alias("max_pca"),
        F.least(F.lit(MIN_KBEST), high_best).alias("min_kbest"),
        high_best.alias("max_kbest"),
    )


def _draw(model: str, spec: tuple, seed: int) -> Column:
    """The value of one parameter, drawn from the digest of model, trial, parameter and seed."""
    name, kind, low, high, step = spec
    text = F.concat(F.lit(f"{model}|"), F.col("trial").cast("string"), F.lit(f"|{name}|{seed}"))
    u = hex_uniform(F.md5(text.cast("binary")))
    if name == "pca_n_components":
        low, high = F.col("min_pca"), F.col("max_pca")
    elif name == "k_best":
        low, high = F.col("min_kbest"), F.col("max_kbest")
    elif name == "n_components":
        low, high = F.lit(low), F.least(F.lit(MAX_PLS), _draw(model, PCA_COUNT, seed))
    else:
        low, high = F.lit(low), F.lit(high)
    if kind == "float":
        return low + u * (high - low)
    if kind == "log":
        return F.exp(F.ln(low) + u * (F.ln(high) - F.ln(low)))
    return (low + F.floor(u * (F.floor((high - low) / step) + 1)) * step).cast("double")


def candidates(limits: DataFrame, n_trials: int = 100, seed: int = 42, models: list[str] | None = None) -> DataFrame:
    """``(target, model, trial, params)``: every trial of every model and target."""
    trials = limits.withColumn("trial", F.explode(F.sequence(F.lit(0), F.lit(n_trials - 1))))
    drawn = []
    for model in models or SPACE:
        pairs = [part for spec in SPACE[model] for part in (F.lit(spec[0]), _draw(model, spec, seed))]
        drawn.append(F.struct(F.lit(model).alias("model"), F.create_map(*pairs).alias("params")))
    return trials.select("target", "trial", F.inline(F.array(*drawn))).select("target", "model", "trial", "params")


def staged(drawn: DataFrame, lengths: tuple[int, ...] = LENGTHS) -> DataFrame:
    """``candidates`` of boosted models with every number of trees: draw d at the i-th length is trial
    ``d * len(lengths) + i``. Trials of one draw are the same fit, read at several lengths."""
    every = F.posexplode(F.array(*[F.lit(float(n)) for n in lengths]))
    each = drawn.select("*", every.alias("_place", "_trees"))
    rest = F.map_filter("params", lambda name, _: name != "n_estimators")
    params = F.map_concat(rest, F.create_map(F.lit("n_estimators"), "_trees"))
    trial = (F.col("trial") * len(lengths) + F.col("_place")).cast("int")
    return each.select("target", "model", trial.alias("trial"), params.alias("params"))


def linear_weights(model: str, params: dict, row) -> tuple[str, int, np.ndarray]:
    """Weights on the principal components or on the best features, and how many of them."""
    if model == "ElasticNet_SelectKBest":
        k, size = int(params["k_best"]), len(row["best"])
        xx = np.asarray(row["best_xx"]).reshape(size, size)[:k, :k]
        xy = np.asarray(row["best_xy"])[:k]
        return "best", k, elastic_dense(xx, xy, row["n_train"], params["alpha"], params["l1_ratio"])
    m = int(params["pca_n_components"])
    values, xy = np.asarray(row["eigenvalues"])[:m], np.asarray(row["pca_xy"])[:m]
    if model == "Ridge":
        w = ridge_diagonal(values, xy, params["alpha"])
    elif model == "PLS":
        w = pls_weights(np.diag(values), xy, row["n_train"], int(params["n_components"]))
    elif model in ("Lasso", "ElasticNet"):
        w = elastic_diagonal(values, xy, row["n_train"], params["alpha"], params.get("l1_ratio", 1.0))
    else:
        raise ValueError(f"{model} is not a linear model")
    return "pca", m, w


def held_out_r2(space: str, count: int, w: np.ndarray, row) -> float:
    """R² on the held-out rows, from their moments alone."""
    size = len(row[f"{space}_valid_xy"])
    xx = np.asarray(row[f"{space}_valid_xx"]).reshape(size, size)[:count, :count]
    xy = np.asarray(row[f"{space}_valid_xy"])[:count]
    error = row["valid_yy"] - 2 * w @ xy + w @ xx @ w
    spread = row["valid_yy"] - row["valid_y"] ** 2 / row["n_valid"]
    return float(1 - error / spread) if spread > 0 else float("nan")


def _joined(trials: DataFrame, reduced: DataFrame, fn, schema: str, by: list[str]) -> DataFrame:
    """Trials with the moments they are solved on, group by group."""
    tasks = group_tasks(trials)
    left, right = (df.repartition(tasks, *by).groupBy(*by) for df in (trials, reduced))
    return left.cogroup(right).applyInPandas(fn, schema)


def score_linear(trials: DataFrame, reduced: DataFrame, folds: int = 5) -> DataFrame:
    """``(target, model, trial, step, score)`` of the linear families on every fold."""

    def score(trial_pdf: pd.DataFrame, reduced_pdf: pd.DataFrame) -> pd.DataFrame:
        if reduced_pdf.empty or trial_pdf.empty:
            return pd.DataFrame()
        row = reduced_pdf.iloc[0]
        scores = []
        for model, params in zip(trial_pdf["model"], trial_pdf["params"]):
            scores.append(held_out_r2(*linear_weights(model, dict(params), row), row))
        return trial_pdf.assign(score=scores, step=trial_pdf["holdout"])[["target", "model", "trial", "step", "score"]]

    numbers = F.sequence(F.lit(0), F.lit(folds - 1))
    spread = trials.filter(F.col("model").isin(LINEAR)).withColumn("holdout", F.explode(numbers))
    # a group per model family: its row of moments is a few hundred KB, its solves may take a minute
    each = reduced.withColumn("model", F.explode(F.array(*[F.lit(m) for m in LINEAR])))
    schema = "target string, model string, trial int, step int, score double"
    return _joined(spread, each, score, schema, ["target", "holdout", "model"])


def linear_models(best: DataFrame, reduced: DataFrame, points: int) -> DataFrame:
    """``(target, model, params, intercept, coefficients, pca_variance)`` refitted on all training
    rows, as weights on the raw spectrum."""

    def refit(trial_pdf: pd.DataFrame, reduced_pdf: pd.DataFrame) -> pd.DataFrame:
        if reduced_pdf.empty or trial_pdf.empty:
            return pd.DataFrame()
        row, fitted = reduced_pdf.iloc[0], []
        scale, mean_x = np.asarray(row["scale"]), np.asarray(row["mean_x"])
        vectors = np.asarray(row["loadings"]).reshape(points, -1)
        for model, params in zip(trial_pdf["model"], trial_pdf["params"]):
            space, count, w = linear_weights(model, dict(params), row)
            if space == "pca":
                beta = vectors[:, :count] @ w
                share = float(np.sum(row["eigenvalues"][:count]) / row["variance"])
            else:
                beta, share = np.zeros(points), None
                beta[np.asarray(row["best"])[:count]] = w
            beta = beta / scale
            fitted.append((float(row["mean_y"] - beta @ mean_x), beta, share))
        return trial_pdf[["target", "model", "params"]].assign(
            intercept=[f[0] for f in fitted], coefficients=[f[1] for f in fitted], pca_variance=[f[2] for f in fitted]
        )

    schema = (
        "target string, model string, params map<string,double>, "
        "intercept double, coefficients array<double>, pca_variance double"
    )
    final = best.filter(F.col("model").isin(LINEAR)).withColumn("holdout", F.lit(-1))
    return _joined(final.select("target", "holdout", "model", "params"), reduced, refit, schema, ["target", "holdout"])


def _walk(pdf: pd.DataFrame, startup: int, warmup: int) -> pd.DataFrame:
    """The trials of one study in order, with the median each was held against and whether it stopped."""
    pdf = pdf.sort_values(["trial", "step"], kind="stable")
    done: dict[int, list[float]] = {}
    completed, medians, stops = 0, [], []
    for _, rows in pdf.groupby("trial", sort=True):
        found = [float(np.median(done[s])) if s in done else None for s in rows["step"]]
        stop = [
            m is not None and completed >= startup and s >= warmup and b < m
            for m, s, b in zip(found, rows["step"], rows["best_so_far"])
        ]
        medians += found
        stops += stop
        if not any(stop):
            completed += 1
            for s, value in zip(rows["step"], rows["running_mean"]):
                done.setdefault(int(s), []).append(value)
    return pdf.assign(earlier_median=pd.Series(medians, index=pdf.index, dtype="float64"), pruned=stops)


def _running(scores: DataFrame, study: list[str]) -> DataFrame:
    """Scores with their running mean and the best of it so far, dealt by study."""
    so_far = Window.partitionBy(*study, "trial").orderBy("step").rowsBetween(Window.unboundedPreceding, 0)
    running = scores.repartition(*study).withColumn("running_mean", F.avg("score").over(so_far))
    return running.withColumn("best_so_far", F.max("running_mean").over(so_far))


def prune(scores: DataFrame, study: list[str], startup: int = STARTUP_TRIALS, warmup: int = WARMUP_STEPS) -> DataFrame:
    """Adds the running mean of a trial, the best of its running means so far, the median of the running
    means that completed earlier trials had at the step, and whether the trial stops there.

    A trial is judged once ``startup`` earlier ones have completed; one that stops completes nothing. So trials
    are walked in order, study by study: a study is at most a few hundred trials."""
    running = _running(scores, study)
    schema = T.StructType([*running.schema, T.StructField("earlier_median", T.DoubleType()), T.StructField("pruned", T.BooleanType())])
    judged = running.groupBy(*study).applyInPandas(lambda pdf: _walk(pdf, startup, warmup), schema)
    return judged.withColumn("earlier_median", F.when(~F.isnan("earlier_median"), F.col("earlier_median")))


def best_trials(scores: DataFrame, study: list[str], startup: int = STARTUP_TRIALS, warmup: int = WARMUP_STEPS) -> DataFrame:
    """``(study…, trial, cv_best_r2)``: the unpruned trial with the highest mean, lowest number on ties.

    Picked in the walk itself, so scores are shuffled once, by study."""

    def pick(pdf: pd.DataFrame) -> pd.DataFrame:
        judged = _walk(pdf, startup, warmup)
        # the running mean of a trial's last step is its mean
        trials = judged.groupby("trial", sort=True).agg(cv_best_r2=("running_mean", "last"), pruned=("pruned", "any")).reset_index()
        kept = trials[~trials["pruned"] & trials["cv_best_r2"].notna()]
        best = kept.sort_values(["cv_best_r2", "trial"], ascending=[False, True]).head(1)
        return best.assign(**{c: pdf[c].iloc[0] for c in study})[[*study, "trial", "cv_best_r2"]]

    running = _running(scores, study)
    fields = [f for f in running.schema if f.name in study]
    schema = T.StructType([*sorted(fields, key=lambda f: study.index(f.name)), running.schema["trial"], T.StructField("cv_best_r2", T.DoubleType())])
    return running.groupBy(*study).applyInPandas(pick, schema)
