"""Split, fold, moment and selection queries."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from edaphon.functions.spectrum import lengthen
from edaphon.modelling import moments as G
from edaphon.modelling.split import TEST, exact_folds, exact_split, is_test
from edaphon.queries.registry import query
from edaphon.queries.views import PLANTED_SQL, POINTS, SPECTRA_SQL, planted, spectrum_key, table


def rounded(value: Column, digits: int = 6) -> Column:
    """Rounded, and never a negative zero."""
    return F.round(value, digits) + F.lit(0.0)


def keys(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "embeddings").select(spectrum_key().alias("ssn"))


@query(
    "split_hash",
    f"""with {SPECTRA_SQL} select ssn, case when substr(md5(ssn || '|42'), 1, 8) < '33333333' then 'test'
    else 'train' end as split from spectra""",
)
def split_hash(spark: SparkSession, sf: str) -> DataFrame:
    test = is_test(F.col("ssn"))
    return keys(spark, sf).withColumn("split", F.when(test, "test").otherwise("train"))


EXACT_SQL = f"""{SPECTRA_SQL},
ordered as (select ssn, row_number() over (order by md5(ssn || '|42')) as p, count(*) over () as n from spectra),
exact as (select ssn, case when p <= ceil(n / 5) then 'test' else 'train' end as split from ordered)"""


@query("split_exact", f"with {EXACT_SQL} select ssn, split from exact")
def split_exact(spark: SparkSession, sf: str) -> DataFrame:
    return exact_split(keys(spark, sf), "ssn")


@query(
    "kfold_assign",
    f"""with {EXACT_SQL} select ssn, cast(ntile(5) over (order by md5(ssn || '|fold42')) - 1 as integer) as fold
    from exact where split = 'train'""",
)
def kfold_assign(spark: SparkSession, sf: str) -> DataFrame:
    train = exact_split(keys(spark, sf), "ssn").filter("split = 'train'")
    return exact_folds(train, "ssn")


LONG_SQL = f"""{PLANTED_SQL},
long as (select ssn, fold, y, unnest(range({POINTS})) as i, unnest(spectrum) as x from planted)"""


@query(
    "standard_scale",
    f"""with {LONG_SQL}, fit as (select i, avg(x) as m, stddev_pop(x) as s from long where fold >= 0 group by i)
    select ssn, cast(i as integer) as i, round((x - m) / case when s = 0 then 1 else s end, 6) + 0e0 as z
    from long join fit using (i)""",
)
def standard_scale(spark: SparkSession, sf: str) -> DataFrame:
    study = G.study(planted(spark, sf), POINTS)
    row = study.reduced().filter(F.col("holdout") == TEST).select("mean_x", "scale").collect()[0]
    scaled = G.affine(study.samples, ["ssn"], POINTS, np.array(row["mean_x"]), 1 / np.array(row["scale"]), "z")
    return lengthen(scaled, ["ssn"], "z").select("ssn", "i", rounded(F.col("x")).alias("z"))


@query(
    "f_regression_scores",
    f"""with {LONG_SQL}, r as (select i, corr(x, y) as r, count(*) as n from long where fold >= 0 group by i)
    select cast(i as integer) as i, round(r * r / (1 - r * r) * (n - 2), 6) as f_score from r""",
)
def f_regression_scores(spark: SparkSession, sf: str) -> DataFrame:
    scores = G.study(planted(spark, sf), POINTS).features().filter(F.col("holdout") == TEST)
    return scores.select("i", rounded(F.col("f_score")).alias("f_score"))


@query(
    "select_k_best",
    f"""with {LONG_SQL}, folds as (select unnest([-1, 0, 1, 2, 3, 4]) as holdout),
    r as (select holdout, i, corr(x, y) as r, count(*) as n from long join folds on fold >= 0 and fold <> holdout
        group by holdout, i),
    ranked as (select holdout, i, r * r / (1 - r * r) * (n - 2) as f, row_number() over (partition by holdout
        order by r * r desc, i) as place from r)
    select cast(holdout as integer) as holdout, cast(i as integer) as i, cast(place as integer) as place,
    round(f, 6) as f_score from ranked where place <= 30""",
)
def select_k_best(spark: SparkSession, sf: str) -> DataFrame:
    """The 30 best features of every fold's training rows."""
    scores = G.study(planted(spark, sf), POINTS).features()
    best_first = Window.partitionBy("target", "holdout").orderBy(F.desc_nulls_last("f_score"), "i")
    ranked = scores.withColumn("place", F.row_number().over(best_first)).filter("place <= 30")
    return ranked.select("holdout", "i", "place", rounded(F.col("f_score")).alias("f_score"))


@query(
    "feature_covariance",
    f"""with {LONG_SQL}, train as (select ssn, i, x from long where fold >= 0)
    select cast(a.i as integer) as i, cast(b.i as integer) as j, round(covar_samp(a.x, b.x), 6) + 0e0 as covariance
    from train a join train b on a.ssn = b.ssn and a.i <= b.i group by a.i, b.i""",
)
def feature_covariance(spark: SparkSession, sf: str) -> DataFrame:
    rows = G.study(planted(spark, sf), POINTS).covariance().filter(F.col("holdout") == TEST)
    return rows.select("i", "j", rounded(F.col("covariance")).alias("covariance"))


def first_points(spark: SparkSession, sf: str, count: int) -> DataFrame:
    return planted(spark, sf).withColumn("spectrum", F.slice("spectrum", 1, count))


@query(
    "pca_two_feature_variance",
    f"""with {PLANTED_SQL}, folds as (select unnest([-1, 0, 1, 2, 3, 4]) as holdout),
    r as (select holdout, abs(corr(x0, x1)) as r from planted join folds on fold >= 0 and fold <> holdout
        group by holdout)
    select cast(holdout as integer) as holdout, 0 as component, round((1 + r) / 2, 6) as explained from r union all
    select cast(holdout as integer), 1, round((1 - r) / 2, 6) from r""",
)
def pca_two_feature_variance(spark: SparkSession, sf: str) -> DataFrame:
    reduced = G.study(first_points(spark, sf, 2), 2).reduced()
    spread = reduced.select("holdout", "variance", F.posexplode("eigenvalues").alias("component", "value"))
    return spread.select("holdout", "component", rounded(F.col("value") / F.col("variance")).alias("explained"))


@query("pca_variance_all_points")
def pca_variance_all_points(spark: SparkSession, sf: str) -> DataFrame:
    """Share of the variance that each component of all points holds, for every fold's training rows."""
    reduced = G.study(planted(spark, sf), POINTS).reduced()
    spread = reduced.select("holdout", "variance", F.posexplode("eigenvalues").alias("component", "value"))
    return spread.select("holdout", "component", rounded(F.col("value") / F.col("variance")).alias("explained"))


def projected(spark: SparkSession, sf: str) -> DataFrame:
    study = G.study(planted(spark, sf), POINTS)
    row = study.reduced().filter(F.col("holdout") == TEST).select("mean_x", "scale", "loadings").collect()[0]
    matrix = np.array(row["loadings"]).reshape(POINTS, -1) / np.array(row["scale"])[:, None]
    return G.affine(study.samples, ["ssn", "fold", "y"], POINTS, np.array(row["mean_x"]), matrix)


@query("pca_project")
def pca_project(spark: SparkSession, sf: str) -> DataFrame:
    """Scores of every sample on all principal components of the training rows."""
    long = lengthen(projected(spark, sf), ["ssn"], "features")
    return long.select("ssn", F.col("i").alias("component"), rounded(F.col("x")).alias("score"))


@query(
    "pca_row_energy",
    f"""with {LONG_SQL}, fit as (select i, avg(x) as m, stddev_pop(x) as s from long where fold >= 0 group by i)
    select ssn, round(sum(((x - m) / s) * ((x - m) / s)), 6) as energy from long join fit using (i) group by ssn""",
)
def pca_row_energy(spark: SparkSession, sf: str) -> DataFrame:
    """All components together keep the length of every scaled row."""
    square = F.aggregate("features", F.lit(0.0), lambda total, z: total + z * z)
    return projected(spark, sf).select("ssn", rounded(square).alias("energy"))
