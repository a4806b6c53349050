"""Scores, rankings, pruning and target transforms."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from edaphon.modelling import moments as G
from edaphon.modelling import score as R
from edaphon.modelling import search as S
from edaphon.plans.evaluate import predict_linear, result_table
from edaphon.queries.estimators import TARGETS_SQL, fixed_trials, gold_all_points, gold_first_point
from edaphon.queries.registry import query
from edaphon.queries.splits import rounded
from edaphon.queries.views import GOLD_SQL, POINTS, PREDICTIONS_SQL, TRIAL_LOG_SQL, gold, predictions, table, trial_log
from edaphon.session import fresh_path, materialise
from edaphon.sinks.lake import read_report, write_report

METRICS_SQL = f"""{PREDICTIONS_SQL},
sums as (select p_brand, count(*) as n, avg((y - yhat) * (y - yhat)) as mse, avg(abs(y - yhat)) as mae,
    var_pop(y) as v, least(min(y), min(yhat)) as low, greatest(max(y), max(yhat)) as high
    from predictions group by p_brand),
metrics as (select p_brand, n, 1 - mse / v as test_r2, sqrt(mse) as test_rmse, mae as test_mae,
    sqrt(v) / sqrt(mse) as test_rpd, low as axis_min, high as axis_max from sums)"""


@query(
    "regression_metrics",
    f"""with {METRICS_SQL} select p_brand, n, round(test_r2, 6) as test_r2, round(test_rmse, 4) as test_rmse,
    round(test_mae, 4) as test_mae, round(test_rpd, 6) as test_rpd, axis_min, axis_max from metrics""",
)
def regression_metrics(spark: SparkSession, sf: str) -> DataFrame:
    found = R.regression_metrics(predictions(spark, sf), ["p_brand"])
    return found.select(
        "p_brand",
        "n",
        rounded(F.col("test_r2")).alias("test_r2"),
        rounded(F.col("test_rmse"), 4).alias("test_rmse"),
        rounded(F.col("test_mae"), 4).alias("test_mae"),
        rounded(F.col("test_rpd")).alias("test_rpd"),
        "axis_min",
        "axis_max",
    )


@query(
    "rpd_band",
    f"""with {TRIAL_LOG_SQL}, v as (select study, trial, stddev_pop(value) / avg(value) * 3 as rpd from (select
        concat(event_type, '/', cast(user_id // 100 as varchar)) as study, user_id % 100 as trial, value from events)
        group by 1, 2)
    select study, cast(trial as integer) as trial, case when rpd > 2 then 'good' when rpd >= 15e-1 then 'acceptable'
    when rpd is not null then 'poor' end as band from v""",
)
def rpd_band(spark: SparkSession, sf: str) -> DataFrame:
    study = F.concat_ws("/", "event_type", F.expr("user_id div 100").cast("string"))
    spread = table(spark, sf, "events").groupBy(study.alias("study"), (F.col("user_id") % 100).cast("int").alias("trial"))
    rows = spread.agg((F.stddev_pop("value") / F.avg("value") * 3).alias("rpd"))
    return rows.select("study", "trial", R.rpd_band(F.col("rpd")).alias("band"))


@query(
    "observed_vs_predicted",
    f"with {PREDICTIONS_SQL} select l_orderkey, l_linenumber, l_partkey, y, yhat, y - yhat as residual from predictions",
)
def observed_vs_predicted(spark: SparkSession, sf: str) -> DataFrame:
    return R.observed_vs_predicted(predictions(spark, sf), ["l_orderkey", "l_linenumber", "l_partkey"])


@query(
    "residual_bins",
    f"""with {PREDICTIONS_SQL} select p_brand, floor((y - yhat) / 5000) * 5000e0 as bin_start, count(*) as n
    from predictions group by 1, 2""",
)
def residual_bins(spark: SparkSession, sf: str) -> DataFrame:
    return R.residual_bins(predictions(spark, sf), ["p_brand"], 5000)


@query(
    "log_target",
    f"with {GOLD_SQL} select ssn, round(ln(y), 9) as y from gold where target = 'p'",
)
def log_target(spark: SparkSession, sf: str) -> DataFrame:
    rows = R.log_target(gold(spark, sf).filter(F.col("target") == "p"))
    return rows.select("ssn", F.round("y", 9).alias("y"))


@query(
    "log_guard",
    f"""with {GOLD_SQL} select target, count(*) as n, count(*) filter (y <= 0) as not_positive,
    count(*) filter (y <= 0) = 0 as log_allowed from gold group by target""",
)
def log_guard(spark: SparkSession, sf: str) -> DataFrame:
    return R.log_guard(gold(spark, sf), ["target"])


# trials in order; only those that did not stop count for the next
PRUNED_SQL = f"""recursive {TRIAL_LOG_SQL},
means as (select *, avg(score) over (partition by study, trial order by step rows unbounded preceding) as running_mean
    from trial_log),
running as (select *, max(running_mean) over (partition by study, trial order by step rows unbounded preceding) as best_so_far,
    dense_rank() over (partition by study order by trial) as k from means),
trials as (select study, k, list({{'step': step, 'value': running_mean, 'best': best_so_far}} order by step) as points
    from running group by study, k),
walk as (
    select study, 0 as k, 0 as n, [points[1]][:0] as done from trials where k = 1
    union all
    select study, k, n + case when stops then 0 else 1 end, case when stops then done else list_concat(done, points) end
    from (select t.study, cast(t.k as integer) as k, w.n, w.done, t.points, w.n >= 20 and len(list_filter(t.points, lambda p: p.step >= 1
        and coalesce(p.best < list_median(list_transform(list_filter(w.done, lambda d: d.step = p.step), lambda d: d.value)),
        false))) > 0 as stops from walk w join trials t on t.study = w.study and t.k = w.k + 1)),
judged as (select r.*, w.n,
    list_median(list_transform(list_filter(w.done, lambda d: d.step = r.step), lambda d: d.value)) as earlier_median
    from running r join walk w on w.study = r.study and w.k = r.k - 1),
pruned as (select *, n >= 20 and step >= 1 and coalesce(best_so_far < earlier_median, false) as pruned from judged)"""


@query(
    "trial_pruning",
    f"""with {PRUNED_SQL} select study, trial, step, round(running_mean, 9) as running_mean,
    round(earlier_median, 9) as earlier_median, pruned from pruned""",
)
def trial_pruning(spark: SparkSession, sf: str) -> DataFrame:
    judged = S.prune(trial_log(spark, sf), ["study"])
    return judged.select(
        "study",
        "trial",
        "step",
        F.round("running_mean", 9).alias("running_mean"),
        F.round("earlier_median", 9).alias("earlier_median"),
        "pruned",
    )


@query(
    "best_trial",
    f"""with {PRUNED_SQL}, complete as (select study, trial, avg(score) as r2 from pruned group by study, trial
        having not bool_or(pruned)),
    ranked as (select *, row_number() over (partition by study order by r2 desc, trial) as place from complete)
    select study, trial, round(r2, 9) as cv_best_r2 from ranked where place = 1""",
)
def best_trial(spark: SparkSession, sf: str) -> DataFrame:
    best = S.best_trials(trial_log(spark, sf), ["study"])
    return best.select("study", "trial", F.round("cv_best_r2", 9).alias("cv_best_r2"))


def _leaderboard(spark: SparkSession, sf: str, points: int = 1) -> DataFrame:
    """Three models on the first point or all for each of the five targets, scored and ranked."""
    study = G.study(gold_first_point(spark, sf) if points == 1 else gold_all_points(spark, sf), points)
    reduced = materialise(study.reduced(), "reduced")
    trials = fixed_trials(reduced, "Ridge", pca_n_components=points, alpha=1.0)
    trials = trials.unionByName(fixed_trials(reduced, "Lasso", pca_n_components=points, alpha=0.01))
    trials = trials.unionByName(fixed_trials(reduced, "ElasticNet", pca_n_components=points, alpha=0.01, l1_ratio=0.5))
    scores = S.score_linear(trials, reduced)
    best = S.best_trials(scores, ["target", "model"]).join(trials, ["target", "model", "trial"])
    linear = materialise(S.linear_models(trials, reduced, points), "linear")
    results = result_table(predict_linear(study, linear), best, linear, reduced, points, ())
    return results.select(
        "position",
        "modelo",
        "target",
        "log_transform",
        "n_amostras",
        F.col("n_features_originais").cast("int").alias("n_features_originais"),
        *[rounded(F.col(c)).alias(c) for c in ("cv_best_r2", "test_r2", "test_rmse", "test_mae", "test_rpd")],
        "pca_componentes",
        F.round("pca_variancia_explicada", 6).alias("pca_variancia_explicada"),
        "k_best",
        F.concat_ws(
            ";", F.transform(F.array_sort(F.map_keys("melhores_params")), lambda k: F.concat_ws(
                "=", k, F.col("melhores_params")[k].cast("string")))
        ).alias("melhores_params"),
    )


LEADERBOARD_SQL = f"""{TARGETS_SQL},
holdouts as (select unnest([-1, 0, 1, 2, 3, 4]) as h),
fit as (select target, h, count(*) as n, avg(x) as m, stddev_pop(x) as s, avg(y) as my, covar_pop(x, y) / stddev_pop(x)
    as c from rows1 join holdouts on fold >= 0 and fold <> h group by target, h),
models as (select *, 'Ridge' as modelo, 'alpha=1.0;pca_n_components=1.0' as params, c * n / (n + 1) as w from fit union all
    select *, 'Lasso', 'alpha=0.01;pca_n_components=1.0', sign(c) * greatest(abs(c) - 1e-2, 0) from fit union all
    select *, 'ElasticNet', 'alpha=0.01;l1_ratio=0.5;pca_n_components=1.0',
        sign(c) * greatest(abs(c) - 5e-3, 0) / (1 + 5e-3) from fit),
predicted as (select r.target, modelo, params, h, y, my + w * (x - m) / s as yhat from rows1 r join models f
    on r.target = f.target and fold = h),
scored as (select target, modelo, params, h, count(*) as n, avg((y - yhat) * (y - yhat)) as mse, avg(abs(y - yhat)) as mae,
    var_pop(y) as v from predicted group by target, modelo, params, h),
cv as (select target, modelo, avg(1 - mse / v) as r2 from scored where h >= 0 group by target, modelo),
sizes as (select target, count(*) as n from rows1 group by target),
leaderboard as (select cast(row_number() over (partition by target order by 1 - mse / v desc, modelo) as integer) as
    position, modelo, target, false as log_transform, sizes.n as n_amostras, 1 as n_features_originais,
    round(r2, 6) + 0e0 as cv_best_r2, round(1 - mse / v, 6) + 0e0 as test_r2, round(sqrt(mse), 6) as test_rmse,
    round(mae, 6) as test_mae, round(sqrt(v) / sqrt(mse), 6) as test_rpd, 1 as pca_componentes,
    1e0 as pca_variancia_explicada, cast(null as integer) as k_best, params as melhores_params
    from scored join cv using (target, modelo) join sizes using (target) where h = -1)"""


@query("leaderboard", f"with {LEADERBOARD_SQL} select * from leaderboard")
def leaderboard(spark: SparkSession, sf: str) -> DataFrame:
    return _leaderboard(spark, sf)


@query("leaderboard_all_points")
def leaderboard_all_points(spark: SparkSession, sf: str) -> DataFrame:
    return _leaderboard(spark, sf, POINTS)


@query("leaderboard_csv_roundtrip", f"with {LEADERBOARD_SQL} select * from leaderboard")
def leaderboard_csv_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    board = _leaderboard(spark, sf)
    path = write_report(board, fresh_path(spark, "results"), "2024-01-01_00-00-00", ["target"])
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in board.schema.fields)
    return read_report(spark, path, schema).select(*board.columns)
