"""Second moments once, many fits.

Scaling, feature scores, PCA, ridge, lasso, elastic net and PLS see the data only through the
sums of ``(1, y, x)(1, y, x)ᵀ``. One pass computes them per target and fold; each fold's training
moments are the other folds' sums, and the held-out error of a linear model follows from the
held-out fold's sums, so cross-validation needs no further pass.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from edaphon.modelling.gram import Gram, f_scores, pls_weights, principal, standardise
from edaphon.modelling.split import TEST

BLOCK = 256  # side of the blocks a Gram matrix travels in: 512 KB of doubles
HELD_BYTES = 1 << 29  # partial sums a task may hold
LARGE_BYTES = 1 << 24  # partial sums worth saving a shuffle of
GROUP_TASKS = 128  # most tasks for groups that are few and small but cost time
MAX_PCA, MAX_KBEST = 80, 300


def matrix_of(column: pa.Array, points: int) -> np.ndarray:
    """A list column as a dense matrix; a row of another length or a missing value is an error."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if len(flat) != len(column) * points:
        raise ValueError(f"every spectrum must have {points} values")
    if not np.isfinite(flat).all():
        raise ValueError("spectra hold missing or infinite values; Gold tables do not")
    return flat.reshape(len(column), points).astype(np.float64, copy=False)


def pilot(samples: DataFrame) -> np.ndarray:
    """Some row's spectrum, as the shift of the sums. Any shift gives the same moments; one inside
    the data keeps their digits."""
    row = samples.select("spectrum").first()
    if row is None:
        raise ValueError("no samples")
    return np.array(row[0], dtype=float)


def target_shift(samples: DataFrame) -> dict[str, float]:
    """Mean of y per target; reads no spectra."""
    return {r[0]: r[1] for r in samples.groupBy("target").agg(F.avg("y")).collect()}


def gram_blocks(samples: DataFrame, points: int, shift_x: np.ndarray, shift_y: dict[str, float], folds: int = 5) -> DataFrame:
    """``(target, fold, block_row, block_col, part)``: upper blocks of the sums of each group.

    ``samples`` is ``(target, fold, y, spectrum)``. Tasks add up their rows with matrix products;
    Spark adds up the tasks' blocks, elementwise and before the shuffle where it can.
    """
    side, groups = points + 2, folds + 1  # the folds and the test rows
    edges = [(b, min(b + BLOCK, side)) for b in range(0, side, BLOCK)]
    pairs = [(i, j) for i in range(len(edges)) for j in range(i, len(edges))]
    held = max(1, HELD_BYTES // (8 * side * side))
    schema = T.StructType(
        [
            samples.schema["target"],
            T.StructField("fold", T.IntegerType()),
            T.StructField("block_row", T.IntegerType()),
            T.StructField("block_col", T.IntegerType()),
            T.StructField("part", T.ArrayType(T.DoubleType())),
        ]
    )

    def emit(sums: dict) -> Iterator[pa.RecordBatch]:
        for (target, fold), total in sums.items():
            for i, j in pairs:
                block = total[slice(*edges[i]), slice(*edges[j])].ravel()
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([target], pa.string()),
                        pa.array([fold], pa.int32()),
                        pa.array([i], pa.int32()),
                        pa.array([j], pa.int32()),
                        pa.ListArray.from_arrays(pa.array([0, len(block)], pa.int32()), pa.array(block)),
                    ],
                    names=["target", "fold", "block_row", "block_col", "part"],
                )

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict = {}
        for batch in batches:
            if batch.num_rows == 0:
                continue
            x = matrix_of(batch.column("spectrum"), points) - shift_x
            y = batch.column("y").to_numpy(zero_copy_only=False)
            if not np.isfinite(y).all():
                raise ValueError("targets hold missing or infinite values; Gold tables do not")
            groups = pd.DataFrame({"t": batch.column("target").to_pandas(), "f": batch.column("fold").to_pandas()})
            for (target, fold), rows in groups.groupby(["t", "f"]).indices.items():
                a = np.empty((len(rows), side))
                a[:, 0], a[:, 1], a[:, 2:] = 1.0, y[rows] - shift_y[target], x[rows]
                group = (target, int(fold))
                if group not in sums and len(sums) >= held:
                    yield from emit(sums)
                    sums = {}
                sums[group] = sums.get(group, 0.0) + a.T @ a
        yield from emit(sums)

    narrow = samples.select("target", F.col("fold").cast("int").alias("fold"), "y", "spectrum")
    if groups * 8 * side * side > LARGE_BYTES:
        # A task passes on one Gram matrix per group, however few rows it saw: with wide spectra,
        # let a task stream through several input splits rather than shuffle more than was read.
        narrow = narrow.coalesce(stream_tasks(narrow))
    if len(shift_y) * groups > held:
        # A scan per target, so that a task holds the sums of one target only; a table partitioned
        # by target is still read once.
        narrow = reduce(DataFrame.unionByName, [narrow.filter(F.col("target") == t) for t in sorted(shift_y)])
    return add_blocks(narrow.mapInArrow(partial, schema), ["target", "fold"])


def stream_tasks(df: DataFrame) -> int:
    """Tasks that keep the cluster busy, also while it is still growing; more splits than that are
    read one after the other."""
    spark = df.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(4 * spark.sparkContext.defaultParallelism, partitions, 512)


def group_tasks(df: DataFrame) -> int:
    """Tasks for a few costly groups. Counted, because by size alone Spark would put them in one."""
    return min(GROUP_TASKS, 2 * df.sparkSession.sparkContext.defaultParallelism)


def add_blocks(blocks: DataFrame, by: list[str]) -> DataFrame:
    """Elementwise sums of equally placed blocks."""
    total = Summarizer.sum(array_to_vector(F.col("part")))
    added = blocks.groupBy(*by, "block_row", "block_col").agg(total.alias("v"))
    return added.select(*by, "block_row", "block_col", vector_to_array("v").alias("part"))


def holdout_moments(blocks: DataFrame, folds: int = 5) -> DataFrame:
    """``(target, holdout, role, block_row, block_col, part)``: for each held-out fold its own sums
    (``valid``) and those of all training folds together (``total``). Holdout -1 stands for the
    test rows, with all folds to train on."""
    fold = F.col("fold")
    own = F.struct(F.lit("valid").alias("role"), fold.alias("holdout"))
    shared = F.struct(F.lit("total").alias("role"), F.lit(None).cast("int").alias("holdout"))
    roles = F.when(fold >= 0, F.array(own, shared)).otherwise(F.array(own))
    dealt = blocks.select("target", F.inline(roles), "block_row", "block_col", "part")
    added = add_blocks(dealt, ["target", "role", "holdout"])
    holdouts = F.array(*[F.lit(h) for h in [TEST, *range(folds)]])
    spread = F.explode(F.when(F.col("role") == "total", holdouts).otherwise(F.array("holdout")))
    return added.select("target", spread.alias("holdout"), "role", "block_row", "block_col", "part")


def split_roles(key: tuple, pdf: pd.DataFrame, points: int, shift_y: dict[str, float],
                shift_x: np.ndarray) -> tuple[Gram, Gram] | None:
    """Training and validation sums of one target and held-out fold, None if either has no rows."""
    parts = []
    for role in ("total", "valid"):
        part = pdf[pdf["role"] == role]
        if part.empty:
            return None
        parts.append(assemble(part, points, shift_y[key[0]], shift_x))
    train, valid = parts
    if key[1] >= 0:
        train.matrix -= valid.matrix
    return (train, valid) if train.n > 0 else None


def assemble(pdf: pd.DataFrame, points: int, shift_y: float, shift_x: np.ndarray) -> Gram:
    """Blocks of one group → its Gram matrix."""
    side = points + 2
    matrix = np.zeros((side, side))
    for i, j, part in zip(pdf["block_row"], pdf["block_col"], pdf["part"]):
        r, c = slice(i * BLOCK, min((i + 1) * BLOCK, side)), slice(j * BLOCK, min((j + 1) * BLOCK, side))
        matrix[r, c] = np.asarray(part).reshape(r.stop - r.start, c.stop - c.start)
        matrix[c, r] = matrix[r, c].T
    return Gram(matrix, shift_y, shift_x)


_ARRAYS = (
    "mean_x scale eigenvalues loadings pca_xy pca_valid_xx pca_valid_xy best best_xx best_xy best_valid_xx best_valid_xy"
).split()
REDUCED = (
    "target string, holdout int, n_train bigint, n_valid bigint, mean_y double, valid_y double, valid_yy double, "
    "variance double, " + ", ".join(f"{a} array<{'int' if a == 'best' else 'double'}>" for a in _ARRAYS)
)


def reduce_moments(moments: DataFrame, points: int, shift_x: np.ndarray, shift_y: dict[str, float]) -> DataFrame:
    """One row per target and held-out fold with all that its linear models need: eigenvalues and
    loadings of the scaled training rows, and training and validation moments of the principal
    components and of the features with the best F scores.

    Each group is two Gram matrices, whatever the number of rows behind them.
    """

    def reduce_one(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        target, holdout = key
        roles = split_roles(key, pdf, points, shift_y, shift_x)
        if roles is None:
            return pd.DataFrame()
        train, valid = standardise(roles[0]), roles[1]
        count = int(min(MAX_PCA, points, train.n - 1))
        values, vectors = principal(train.xx, count)
        y1, yy, xy, xx = valid.about(train.mean_y, train.mean_x)
        xy, xx = xy / train.scale, xx / np.outer(train.scale, train.scale)
        best = np.argsort(-f_scores(train), kind="stable")[: min(MAX_KBEST, points)]
        row = {
            "target": target,
            "holdout": int(holdout),
            "n_train": int(train.n),
            "n_valid": int(valid.n),
            "mean_y": train.mean_y + shift_y[target],
            "valid_y": y1,
            "valid_yy": yy,
            "variance": float(np.trace(train.xx)),
            "mean_x": train.mean_x + shift_x,
            "scale": train.scale,
            "eigenvalues": values,
            "loadings": vectors.ravel(),
            "pca_xy": vectors.T @ train.xy,
            "pca_valid_xx": (vectors.T @ xx @ vectors).ravel(),
            "pca_valid_xy": vectors.T @ xy,
            "best": best.astype(np.int32),
            "best_xx": train.xx[np.ix_(best, best)].ravel(),
            "best_xy": train.xy[best],
            "best_valid_xx": xx[np.ix_(best, best)].ravel(),
            "best_valid_xy": xy[best],
        }
        return pd.DataFrame([row])

    spread = moments.repartition(group_tasks(moments), "target", "holdout")
    return spread.groupBy("target", "holdout").applyInPandas(reduce_one, REDUCED)


def feature_rows(moments: DataFrame, points: int, shift_x: np.ndarray, shift_y: dict[str, float]) -> DataFrame:
    """``(target, holdout, i, f_score, pls_weight)`` of the training rows: the univariate F score
    and the weight of the feature in the first PLS component."""

    def rows(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        roles = split_roles(key, pdf, points, shift_y, shift_x)
        if roles is None:
            return pd.DataFrame()
        train = standardise(roles[0])
        scores = f_scores(train)
        weights = pls_weights(train.xx, train.xy, train.n, 1)
        length = np.linalg.norm(weights)
        return pd.DataFrame(
            {
                "target": key[0],
                "holdout": int(key[1]),
                "i": np.arange(points, dtype=np.int32),
                "f_score": np.where(np.isinf(scores), np.nan, scores),
                "pls_weight": weights / length if length > 0 else weights,
            }
        )

    schema = "target string, holdout int, i int, f_score double, pls_weight double"
    return moments.groupBy("target", "holdout").applyInPandas(rows, schema)


def covariance_rows(moments: DataFrame, points: int, shift_x: np.ndarray, shift_y: dict[str, float]) -> DataFrame:
    """``(target, holdout, i, j, covariance)`` with i ≤ j, of the training rows (divisor n-1)."""

    def rows(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        roles = split_roles(key, pdf, points, shift_y, shift_x)
        if roles is None:
            return pd.DataFrame()
        gram = roles[0]
        _, _, _, xx = gram.about(*gram.means())
        i, j = np.triu_indices(points)
        values = xx[i, j] / (gram.n - 1)
        return pd.DataFrame({"target": key[0], "holdout": int(key[1]), "i": i.astype(np.int32), "j": j.astype(np.int32),
                             "covariance": values})

    schema = "target string, holdout int, i int, j int, covariance double"
    return moments.groupBy("target", "holdout").applyInPandas(rows, schema)


@dataclass
class Study:
    """Samples with the moments of every held-out fold."""

    samples: DataFrame
    points: int
    shift_x: np.ndarray
    shift_y: dict[str, float]
    moments: DataFrame

    def reduced(self) -> DataFrame:
        return reduce_moments(self.moments, self.points, self.shift_x, self.shift_y)

    def features(self) -> DataFrame:
        return feature_rows(self.moments, self.points, self.shift_x, self.shift_y)

    def covariance(self) -> DataFrame:
        return covariance_rows(self.moments, self.points, self.shift_x, self.shift_y)


def study(samples: DataFrame, points: int, folds: int = 5) -> Study:
    """One pass over ``(target, ssn, fold, y, spectrum)``, lazily."""
    shift_x, shift_y = pilot(samples), target_shift(samples)
    blocks = gram_blocks(samples, points, shift_x, shift_y, folds)
    return Study(samples, points, shift_x, shift_y, holdout_moments(blocks, folds))


def list_array(matrix: np.ndarray) -> pa.Array:
    """A dense matrix as a list column."""
    rows, width = matrix.shape
    offsets = pa.array(np.arange(rows + 1, dtype=np.int32) * width)
    return pa.ListArray.from_arrays(offsets, pa.array(np.ascontiguousarray(matrix).ravel()))


def by_target(batch: pa.RecordBatch) -> dict[str, np.ndarray]:
    """Row numbers of each target in a batch."""
    names = batch.column("target").to_pandas()
    return names.groupby(names).indices


def affine(samples: DataFrame, kept: list[str], points: int, centre: np.ndarray, matrix: np.ndarray,
           output: str = "features") -> DataFrame:
    """``(spectrum - centre) @ matrix`` as an array column beside the kept columns, one product per
    batch. A vector for ``matrix`` scales each feature."""
    schema = T.StructType([samples.schema[c] for c in kept] + [T.StructField(output, T.ArrayType(T.DoubleType()))])

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            z = matrix_of(batch.column("spectrum"), points) - centre
            z = z * matrix if matrix.ndim == 1 else z @ matrix
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], list_array(z)], names=[*kept, output])

    return samples.select(*kept, "spectrum").mapInArrow(apply, schema)


def project_all(samples: DataFrame, points: int, bases: dict[str, list]) -> DataFrame:
    """``(target, holdout, ssn, fold, y, features)``: each sample on each of its target's bases,
    given as ``{target: [(holdout, centre, matrix)]}``."""
    shared = samples.sparkSession.sparkContext.broadcast(bases)
    names = ["ssn", "fold", "y"]
    schema = "target string, holdout int, ssn string, fold int, y double, features array<double>"

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix_of(batch.column("spectrum"), points)
            for target, rows in by_target(batch).items():
                own = batch.take(pa.array(rows))
                for holdout, centre, matrix in shared.value.get(target, []):
                    columns = [
                        own.column("target"),
                        pa.array(np.full(len(rows), holdout, dtype=np.int32)),
                        *[own.column(c) for c in names],
                        list_array((x[rows] - centre) @ matrix),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, names=["target", "holdout", *names, "features"])

    narrow = samples.select("target", "ssn", F.col("fold").cast("int").alias("fold"), "y", "spectrum")
    return narrow.mapInArrow(apply, schema)


def predict_all(samples: DataFrame, points: int, models: dict[str, list]) -> DataFrame:
    """``(target, ssn, y, model, yhat)`` of linear models ``{target: [(name, intercept, weights)]}``."""
    packed = {t: (np.column_stack([w for _, _, w in rows]), np.array([i for _, i, _ in rows])) for t, rows in models.items()}
    shared = samples.sparkSession.sparkContext.broadcast(packed)
    names = F.lit(None).cast("array<string>")
    for target, rows in models.items():
        names = F.when(F.col("target") == target, F.array(*[F.lit(n) for n, _, _ in rows])).otherwise(names)
    schema = "target string, ssn string, y double, yhats array<double>"

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix_of(batch.column("spectrum"), points)
            for target, rows in by_target(batch).items():
                if target not in shared.value:
                    continue
                weights, intercepts = shared.value[target]
                own = batch.take(pa.array(rows))
                kept = [own.column(c) for c in ("target", "ssn", "y")]
                predicted = list_array(x[rows] @ weights + intercepts)
                yield pa.RecordBatch.from_arrays([*kept, predicted], names=["target", "ssn", "y", "yhats"])

    scored = samples.select("target", "ssn", "y", "spectrum").mapInArrow(apply, schema)
    pairs = F.arrays_zip(names.alias("model"), F.col("yhats").alias("yhat"))
    return scored.select("target", "ssn", "y", F.inline(pairs))
