"""Model queries: closed forms beside SQL, iterative fits without."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from edaphon.modelling import moments as G
from edaphon.modelling import search as S
from edaphon.modelling.networks import Network, predict_networks, train_networks
from edaphon.modelling.score import regression_metrics
from edaphon.modelling.split import TEST, with_folds
from edaphon.modelling.trees import fit_boosting, predict_boosting
from edaphon.plans.evaluate import Options, evaluate, predict_linear, save_models
from edaphon.plans.scoring import load_models, score_spectra
from edaphon.queries.registry import query
from edaphon.queries.splits import LONG_SQL, first_points, projected, rounded
from edaphon.queries.views import GOLD_SQL, PLANTED_SQL, POINTS, FOLD_SQL, gold, planted, planted_labelled
from edaphon.session import fresh_path, materialise
from edaphon.sinks.lake import read_gold, write_gold


def fixed_trials(samples: DataFrame, model: str, **params: float) -> DataFrame:
    """One trial with given parameters for each target."""
    pairs = [part for k, v in params.items() for part in (F.lit(k), F.lit(float(v)))]
    return samples.select("target").distinct().select(
        "target", F.lit(model).alias("model"), F.lit(0).alias("trial"), F.create_map(*pairs).alias("params")
    )


def fitted_rows(study: G.Study, trials: DataFrame) -> DataFrame:
    """``(target, i, coefficient, intercept)`` of models refitted on all training rows."""
    fitted = S.linear_models(trials, study.reduced(), study.points)
    return fitted.select("target", "intercept", F.posexplode("coefficients").alias("i", "coefficient"))


def rounded_fit(rows: DataFrame) -> DataFrame:
    return rows.select("i", *[rounded(F.col(c)).alias(c) for c in ("coefficient", "intercept")])


@query(
    "ridge_two_feature",
    f"""with {PLANTED_SQL},
    s as (select count(*) as n, avg(x0) as m0, avg(x1) as m1, avg(y) as my, stddev_pop(x0) as s0, stddev_pop(x1) as s1,
        corr(x0, x1) as r, covar_pop(x0, y) as c0, covar_pop(x1, y) as c1 from planted where fold >= 0),
    w as (select *, ((c0 / s0) * n * (n + 15e-1) - n * r * (c1 / s1) * n) / ((n + 15e-1) * (n + 15e-1) - n * r * n * r) as w0,
        ((c1 / s1) * n * (n + 15e-1) - n * r * (c0 / s0) * n) / ((n + 15e-1) * (n + 15e-1) - n * r * n * r) as w1 from s)
    select 0 as i, round(w0 / s0, 6) as coefficient, round(my - w0 / s0 * m0 - w1 / s1 * m1, 6) as intercept from w
    union all select 1, round(w1 / s1, 6), round(my - w0 / s0 * m0 - w1 / s1 * m1, 6) from w""",
)
def ridge_two_feature(spark: SparkSession, sf: str) -> DataFrame:
    study = G.study(first_points(spark, sf, 2), 2)
    rows = fitted_rows(study, fixed_trials(study.samples, "Ridge", pca_n_components=2, alpha=1.5))
    return rounded_fit(rows)


ONE_SQL = """s as (select count(*) as n, avg(x0) as m, avg(y) as my, stddev_pop(x0) as sd, covar_pop(x0, y) / stddev_pop(x0)
    as c from planted where fold >= 0)"""


@query(
    "lasso_one_feature",
    f"""with {PLANTED_SQL}, {ONE_SQL}, w as (select *, sign(c) * greatest(abs(c) - 5e-2, 0) as w from s)
    select 0 as i, round(w / sd, 6) as coefficient, round(my - w / sd * m, 6) as intercept from w""",
)
def lasso_one_feature(spark: SparkSession, sf: str) -> DataFrame:
    study = G.study(first_points(spark, sf, 1), 1)
    rows = fitted_rows(study, fixed_trials(study.samples, "Lasso", pca_n_components=1, alpha=0.05))
    return rounded_fit(rows)


@query(
    "elasticnet_one_feature",
    f"""with {PLANTED_SQL}, {ONE_SQL}, w as (select *, sign(c) * greatest(abs(c) - 5e-2 * 4e-1, 0) / (1 + 5e-2 * 6e-1)
    as w from s)
    select 0 as i, round(w / sd, 6) as coefficient, round(my - w / sd * m, 6) as intercept from w""",
)
def elasticnet_one_feature(spark: SparkSession, sf: str) -> DataFrame:
    study = G.study(first_points(spark, sf, 1), 1)
    trials = fixed_trials(study.samples, "ElasticNet", pca_n_components=1, alpha=0.05, l1_ratio=0.4)
    rows = fitted_rows(study, trials)
    return rounded_fit(rows)


@query(
    "pls_one_component",
    f"""with {LONG_SQL}, r as (select i, corr(x, y) as r from long where fold >= 0 group by i),
    norm as (select sqrt(sum(r * r)) as size from r)
    select cast(i as integer) as i, round(r / size, 6) + 0e0 as weight from r, norm""",
)
def pls_one_component(spark: SparkSession, sf: str) -> DataFrame:
    rows = G.study(planted(spark, sf), POINTS).features().filter(F.col("holdout") == TEST)
    return rows.select("i", rounded(F.col("pls_weight")).alias("weight"))


def _scored(spark: SparkSession, sf: str, trials) -> DataFrame:
    """Predictions of fixed linear trials for the planted test rows."""
    study = G.study(planted(spark, sf), POINTS)
    models = S.linear_models(trials(study.samples), study.reduced(), POINTS)
    return predict_linear(study, materialise(models, "linear"))


@query(
    "elasticnet_best_feature",
    f"""with {LONG_SQL}, s as (select i, corr(x, y) as r, avg(x) as m, avg(y) as my, stddev_pop(x) as sd,
        covar_pop(x, y) / stddev_pop(x) as c from long where fold >= 0 group by i),
    best as (select * from s order by r * r desc, i limit 1),
    w as (select *, sign(c) * greatest(abs(c) - 5e-2 * 4e-1, 0) / (1 + 5e-2 * 6e-1) as w from best)
    select cast(i as integer) as i, round(w / sd, 6) as coefficient, round(my - w / sd * m, 6) as intercept from w""",
)
def elasticnet_best_feature(spark: SparkSession, sf: str) -> DataFrame:
    """Elastic net on the one feature with the best F score."""
    study = G.study(planted(spark, sf), POINTS)
    trials = fixed_trials(study.samples, "ElasticNet_SelectKBest", k_best=1, alpha=0.05, l1_ratio=0.4)
    rows = fitted_rows(study, trials).filter("coefficient <> 0")
    return rounded_fit(rows)


@query(
    "pls_two_feature",
    f"""with {PLANTED_SQL},
    s as (select avg(x0) as m0, avg(x1) as m1, avg(y) as my, covar_pop(x0, x0) as v0, covar_pop(x1, x1) as v1,
        covar_pop(x0, x1) as v01, covar_pop(x0, y) as c0, covar_pop(x1, y) as c1 from planted where fold >= 0),
    w as (select *, (c0 * v1 - c1 * v01) / (v0 * v1 - v01 * v01) as b0, (c1 * v0 - c0 * v01) / (v0 * v1 - v01 * v01) as b1
        from s)
    select 0 as i, round(b0, 6) as coefficient, round(my - b0 * m0 - b1 * m1, 6) as intercept from w
    union all select 1, round(b1, 6), round(my - b0 * m0 - b1 * m1, 6) from w""",
)
def pls_two_feature(spark: SparkSession, sf: str) -> DataFrame:
    """PLS with as many components as features is least squares."""
    study = G.study(first_points(spark, sf, 2), 2)
    rows = fitted_rows(study, fixed_trials(study.samples, "PLS", pca_n_components=2, n_components=2))
    return rounded_fit(rows)


def _fit_all_points(spark: SparkSession, sf: str, model: str, **params: float) -> DataFrame:
    """One linear model on all points of the spectrum, through all its components."""
    study = G.study(planted(spark, sf), POINTS)
    return rounded_fit(fitted_rows(study, fixed_trials(study.samples, model, pca_n_components=POINTS, **params)))


@query("ridge_all_points")
def ridge_all_points(spark: SparkSession, sf: str) -> DataFrame:
    return _fit_all_points(spark, sf, "Ridge", alpha=1.5)


@query("lasso_all_points")
def lasso_all_points(spark: SparkSession, sf: str) -> DataFrame:
    return _fit_all_points(spark, sf, "Lasso", alpha=0.05)


@query("elasticnet_all_points")
def elasticnet_all_points(spark: SparkSession, sf: str) -> DataFrame:
    return _fit_all_points(spark, sf, "ElasticNet", alpha=0.05, l1_ratio=0.4)


@query("pls_all_points")
def pls_all_points(spark: SparkSession, sf: str) -> DataFrame:
    """PLS with as many components as points is least squares."""
    return _fit_all_points(spark, sf, "PLS", n_components=POINTS)


@query("elasticnet_kbest")
def elasticnet_kbest(spark: SparkSession, sf: str) -> DataFrame:
    """Elastic net on the 30 features with the best F scores: the coefficients left standing."""
    study = G.study(planted(spark, sf), POINTS)
    trials = fixed_trials(study.samples, "ElasticNet_SelectKBest", k_best=30, alpha=0.01, l1_ratio=0.5)
    rows = fitted_rows(study, trials).filter("coefficient <> 0")
    return rounded_fit(rows)


@query("pls_fit")
def pls_fit(spark: SparkSession, sf: str) -> DataFrame:
    scored = _scored(spark, sf, lambda s: fixed_trials(s, "PLS", pca_n_components=POINTS, n_components=8))
    return regression_metrics(scored, ["target", "model"])


@query(
    "cv_scores",
    f"""with {PLANTED_SQL}, folds as (select unnest([0, 1, 2, 3, 4]) as step),
    fit as (select step, regr_slope(y, x0) as b, regr_intercept(y, x0) as a from planted join folds
        on fold >= 0 and fold <> step group by step)
    select cast(step as integer) as step, round(1 - sum((y - a - b * x0) * (y - a - b * x0)) / (var_pop(y) * count(*)), 6)
    as score from planted join fit on fold = step group by step""",
)
def cv_scores(spark: SparkSession, sf: str) -> DataFrame:
    """Held-out R² of one-feature least squares, from the folds' moments alone."""
    study = G.study(first_points(spark, sf, 1), 1)
    trials = fixed_trials(study.samples, "Ridge", pca_n_components=1, alpha=0.0)
    return S.score_linear(trials, study.reduced()).select("step", rounded(F.col("score")).alias("score"))


@query("cv_scores_all_points")
def cv_scores_all_points(spark: SparkSession, sf: str) -> DataFrame:
    """Held-out R² of least squares on all points, from the folds' moments alone."""
    study = G.study(planted(spark, sf), POINTS)
    trials = fixed_trials(study.samples, "Ridge", pca_n_components=POINTS, alpha=0.0)
    return S.score_linear(trials, study.reduced()).select("step", rounded(F.col("score")).alias("score"))


def gold_all_points(spark: SparkSession, sf: str) -> DataFrame:
    """The Gold rows with their folds, written once for the passes that follow."""
    rows = with_folds(gold(spark, sf), "ssn")
    return materialise(rows.select("target", "ssn", "fold", "y", "spectrum"), "gold-all-points")


def gold_first_point(spark: SparkSession, sf: str) -> DataFrame:
    """The Gold rows with one spectral point, written once for the passes that follow."""
    rows = with_folds(gold(spark, sf).withColumn("spectrum", F.slice("spectrum", 1, 1)), "ssn")
    return materialise(rows.select("target", "ssn", "fold", "y", "spectrum"), "gold-first-point")


TARGETS_SQL = f"""{GOLD_SQL},
rows1 as (select target, ssn, y, spectrum[1] as x, {FOLD_SQL.format(key="ssn")} as fold from gold)"""


@query(
    "all_targets_baseline",
    f"""with {TARGETS_SQL},
    fit as (select target, regr_slope(y, x) as b, regr_intercept(y, x) as a, count(*) as n_train from rows1
        where fold >= 0 group by target)
    select target, n_train, count(*) as n_test, round(a, 6) as intercept, round(b, 6) as slope,
    round(1 - sum((y - a - b * x) * (y - a - b * x)) / (var_pop(y) * count(*)), 6) as test_r2
    from rows1 join fit using (target) where fold = -1 group by target, n_train, a, b""",
)
def all_targets_baseline(spark: SparkSession, sf: str) -> DataFrame:
    """One-feature least squares for each target, all from one pass of moments."""
    study = G.study(gold_first_point(spark, sf), 1)
    reduced = study.reduced().filter(F.col("holdout") == TEST)
    slope = F.get("pca_xy", F.lit(0)) / F.get("eigenvalues", F.lit(0)) * F.get("loadings", F.lit(0))
    raw = slope / F.get("scale", F.lit(0))
    xy, xx = F.get("pca_valid_xy", F.lit(0)), F.get("pca_valid_xx", F.lit(0))
    w = F.get("pca_xy", F.lit(0)) / F.get("eigenvalues", F.lit(0))
    error = F.col("valid_yy") - 2 * w * xy + w * w * xx
    spread = F.col("valid_yy") - F.col("valid_y") * F.col("valid_y") / F.col("n_valid")
    return reduced.select(
        "target",
        "n_train",
        F.col("n_valid").alias("n_test"),
        rounded(F.col("mean_y") - raw * F.get("mean_x", F.lit(0))).alias("intercept"),
        rounded(raw).alias("slope"),
        rounded(1 - error / spread).alias("test_r2"),
    )


@query("all_targets_all_points")
def all_targets_all_points(spark: SparkSession, sf: str) -> DataFrame:
    """Ridge on all points for each target, all from one pass of moments."""
    study = G.study(gold_all_points(spark, sf), POINTS)
    reduced = materialise(study.reduced(), "reduced")
    trials = fixed_trials(reduced, "Ridge", pca_n_components=POINTS, alpha=1.0)
    models = materialise(S.linear_models(trials, reduced, POINTS), "linear")
    scores = regression_metrics(predict_linear(study, models), ["target"])
    fits = reduced.filter(F.col("holdout") == TEST).select("target", "n_train", F.col("n_valid").alias("n_test"))
    fits = fits.join(models.select("target", "intercept"), "target").join(scores.select("target", "test_r2"), "target")
    return fits.select("target", "n_train", "n_test", *[rounded(F.col(c)).alias(c) for c in ("intercept", "test_r2")])


def gold_shape(spark: SparkSession, sf: str) -> DataFrame:
    rows = with_folds(gold(spark, sf), "ssn").filter("fold >= 0")
    return rows.groupBy("target").agg(F.count("*").alias("n_train"), F.lit(POINTS).alias("points"))


BOUNDS_SQL = f"""{TARGETS_SQL},
shape as (select target, count(*) as n_train, {POINTS} as points from rows1 where fold >= 0 group by target),
limits as (select target, least(10, 80, points, n_train - 1) as min_pca, least(80, points, n_train - 1) as max_pca,
    least(30, 300, points) as min_kbest, least(300, points) as max_kbest from shape)"""


@query(
    "search_bounds",
    f"with {BOUNDS_SQL} select target, cast(min_pca as bigint) as min_pca, cast(max_pca as bigint) as max_pca, "
    "cast(min_kbest as bigint) as min_kbest, cast(max_kbest as bigint) as max_kbest from limits",
)
def search_bounds(spark: SparkSession, sf: str) -> DataFrame:
    limits = S.bounds(gold_shape(spark, sf))
    return limits.select("target", *[F.col(c).cast("bigint").alias(c) for c in limits.columns[1:]])


def _space_sql() -> str:
    rows = []
    for model, specs in S.SPACE.items():
        for name, kind, low, high, step in specs:
            rows.append(f"('{model}', '{name}', '{kind}', {low or 0}::double, {high or 0}::double, {step or 0}::double)")
    rows = [r.replace("None", "0") for r in rows]
    return ", ".join(rows)


@query(
    "trial_candidates",
    f"""with {BOUNDS_SQL}, space as (select * from (values {_space_sql()}) s(model, param, kind, low, high, step)),
    draws as (select target, model, trial, param, kind, step, min_pca, max_pca,
        case param when 'pca_n_components' then min_pca when 'k_best' then min_kbest else low end as low,
        case param when 'pca_n_components' then max_pca when 'k_best' then max_kbest else high end as high,
        cast('0x' || substr(md5(concat(model, '|', cast(trial as varchar), '|', param, '|42')), 1, 8) as bigint)
            / 4294967296e0 as u,
        cast('0x' || substr(md5(concat(model, '|', cast(trial as varchar), '|pca_n_components|42')), 1, 8) as bigint)
            / 4294967296e0 as u_pca
        from limits, space, range(100) t(trial)),
    bound as (select * replace (case param when 'n_components' then least(30, min_pca + floor(u_pca * (max_pca - min_pca + 1)))
        else high end as high) from draws)
    select target, model, cast(trial as integer) as trial, param, round(case kind when 'float' then low + u * (high - low)
        when 'log' then exp(ln(case when kind = 'log' then low else 1 end) + u * (ln(case when kind = 'log' then high
        else 1 end) - ln(case when kind = 'log' then low else 1 end)))
        else low + floor(u * (floor((high - low) / case when step = 0 then 1 else step end) + 1)) * step end, 9) as value
    from bound""",
)
def trial_candidates(spark: SparkSession, sf: str) -> DataFrame:
    """100 seeded draws of every model's parameters for each target, within the target's bounds."""
    drawn = S.candidates(S.bounds(gold_shape(spark, sf)), 100)
    long = drawn.select("target", "model", "trial", F.explode("params").alias("param", "value"))
    return long.withColumn("value", F.round("value", 9))


def _components(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, int]:
    """Component scores of all planted samples and of the training ones, and how many those are."""
    rows = materialise(projected(spark, sf), "components")
    train = rows.filter("fold >= 0")
    return rows, train, train.count()


def _boosting(spark: SparkSession, sf: str, model: str, **params: float) -> DataFrame:
    rows, train, n = _components(spark, sf)
    fitted = fit_boosting(train, n, model, params)
    scored = predict_boosting(fitted, rows, params).withColumn("part", _part())
    return regression_metrics(scored, ["part"])


def _part() -> Column:
    return F.when(F.col("fold") == TEST, "test").otherwise("train")


@query("gbt_fit_depthwise")
def gbt_fit_depthwise(spark: SparkSession, sf: str) -> DataFrame:
    return _boosting(
        spark, sf, "XGBoost", pca_n_components=16, n_estimators=12, learning_rate=0.2, max_depth=3, subsample=0.9,
        colsample_bytree=0.9, reg_alpha=1e-3, reg_lambda=1.0,
    )


@query("gbt_fit_leafwise_space")
def gbt_fit_leafwise_space(spark: SparkSession, sf: str) -> DataFrame:
    return _boosting(
        spark, sf, "LightGBM", pca_n_components=16, n_estimators=12, learning_rate=0.2, max_depth=8, num_leaves=15,
        subsample=0.9, colsample_bytree=0.9, reg_alpha=1e-3, reg_lambda=1.0,
    )


def _stump_sql(rows: str, value: str, name: str, smallest: int) -> str:
    """The split of the label that explains most of a value, and the mean on either side."""
    return f"""{name}_sides as (select t.label as split, r.label <= t.label as low, count(*) as n, sum({value}) as s
        from {rows} r, (select distinct label from {rows}) t group by 1, 2),
    {name}_split as (select split from {name}_sides group by split having count(*) = 2 and min(n) >= {smallest}
        order by sum(s * s / n) desc, split limit 1),
    {name} as (select r.label <= split as low, split, avg({value}) as mean from {rows} r, {name}_split group by 1, 2)"""


def _labelled_boosting(spark: SparkSession, sf: str, model: str, **params: float) -> DataFrame:
    """Trees on the label alone, for every sample."""
    rows = planted_labelled(spark, sf).withColumn("features", F.array(F.col("label").cast("double")))
    train = rows.filter("fold >= 0")
    every = {"pca_n_components": 1, "subsample": 1.0, "colsample_bytree": 1.0, "reg_alpha": 1e-4, "reg_lambda": 1e-4}
    fitted = fit_boosting(train, train.count(), model, every | params)
    return predict_boosting(fitted, rows, every | params).select("ssn", rounded(F.col("yhat")).alias("yhat"))


@query(
    "gbt_stump",
    f"""with {PLANTED_SQL}, train as (select label, y from planted where fold >= 0), {_stump_sql("train", "y", "one", 1)}
    select ssn, round(mean, 6) + 0e0 as yhat from planted join one on (label <= split) = low""",
)
def gbt_stump(spark: SparkSession, sf: str) -> DataFrame:
    """One boosted tree with one split."""
    return _labelled_boosting(spark, sf, "XGBoost", n_estimators=1, learning_rate=0.1, max_depth=1)


@query(
    "gbt_two_stumps",
    f"""with {PLANTED_SQL}, train as (select label, y from planted where fold >= 0), {_stump_sql("train", "y", "one", 20)},
    rest as (select label, 2 * (y - mean) as e from train join one on (label <= split) = low),
    {_stump_sql("rest", "e", "two", 20)}
    select ssn, round(one.mean + 1e-1 * two.mean, 6) + 0e0 as yhat from planted
    join one on (label <= one.split) = one.low join two on (label <= two.split) = two.low""",
)
def gbt_two_stumps(spark: SparkSession, sf: str) -> DataFrame:
    """Two boosted trees with one split each, the second on the gradient the first leaves."""
    return _labelled_boosting(spark, sf, "LightGBM", n_estimators=2, learning_rate=0.1, max_depth=8, num_leaves=2)


@query("mlp_fit")
def mlp_fit(spark: SparkSession, sf: str) -> DataFrame:
    """Two networks trained in one pass per round, and their scores on both parts."""
    rows, train, n = _components(spark, sf)
    nets = [Network(POINTS, (64,), "relu", 1e-4, 1e-2), Network(32, (32, 16), "tanh", 1e-3, 1e-2)]
    train_networks(train, n, nets, rounds=20)
    scored = predict_networks(rows, nets, POINTS, ["ssn", "fold", "y"]).withColumn("part", _part())
    return regression_metrics(scored, ["net", "part"])


@query("refit_predict")
def refit_predict(spark: SparkSession, sf: str) -> DataFrame:
    """Search of the linear families, refit of the winners, predictions for the test rows."""
    samples = planted(spark, sf).select("target", "ssn", "y", "spectrum")
    return evaluate(samples, POINTS, Options(models=S.LINEAR, linear_trials=40)).predictions


@query(
    "score_saved_models",
    f"""with {PLANTED_SQL}, part as (select count(*) filter (fold = -1) as test, count(*) as n from planted)
    select model, n as scored, test as compared, 0 as differing from part, (values ('Lasso'), ('PLS'), ('Ridge')) m(model)""",
)
def score_saved_models(spark: SparkSession, sf: str) -> DataFrame:
    """Models saved, loaded and applied to all spectra; for the test rows the predictions made before saving
    are there to compare."""
    samples = planted(spark, sf).select("target", "ssn", "y", "spectrum")
    options = Options(models=["Ridge", "Lasso", "PLS"], linear_trials=10, exact_sizes=False)
    found = evaluate(samples, POINTS, options)
    scored = score_spectra(samples.select("ssn", "spectrum"), load_models(spark, save_models(found)))
    before = found.predictions.select("target", "model", "ssn", F.col("yhat").alias("before"))
    both = scored.join(before, ["target", "model", "ssn"], "left")
    return both.groupBy("model").agg(
        F.count("yhat").alias("scored"), F.count("before").alias("compared"),
        F.count_if(F.abs(F.col("yhat") - F.col("before")) > 1e-9).cast("int").alias("differing"),
    )


@query("evaluate_all_targets")
def evaluate_all_targets(spark: SparkSession, sf: str) -> DataFrame:
    """The linear families on the five Gold tables, phosphorus in logs, with exact split sizes."""
    path = write_gold(gold(spark, sf), fresh_path(spark, "gold"))
    options = Options(models=S.LINEAR, linear_trials=25, log_targets=("p",), exact_sizes=True)
    results = evaluate(read_gold(spark, path), POINTS, options).results
    return results.withColumn("melhores_params", F.to_json("melhores_params"))


@query("evaluate_models")
def evaluate_models(spark: SparkSession, sf: str) -> DataFrame:
    """All eight families on the planted target over five folds; one draw of each boosted family, read at ten
    and at twenty trees (the space begins at a hundred, which takes minutes), and two networks of eight rounds."""
    path = write_gold(planted(spark, sf).select("target", "ssn", "y", "spectrum"), fresh_path(spark, "gold"))
    options = Options(
        linear_trials=40, tree_trials=2, tree_lengths=(10, 20), network_trials=2, network_rounds=8,
    )
    results = evaluate(read_gold(spark, path), POINTS, options).results
    return results.withColumn("melhores_params", F.to_json("melhores_params"))

