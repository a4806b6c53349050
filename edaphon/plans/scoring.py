"""Score fresh spectra with saved models.

The models of all targets are a table. They are packed into a few matrices and meet the spectra in one
scan, a matrix product per batch: one for the linear families of all targets, one per target for the
components that its network sees. Boosted trees are MLlib's and take a scan each. Nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.regression import GBTRegressionModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from edaphon.modelling.moments import affine, list_array, matrix_of
from edaphon.modelling.networks import Network
from edaphon.modelling.trees import predict_boosting

#: Models and components that one scan carries to the tasks; more are scored in several scans.
SCAN_BYTES = 256 << 20
SCORED = ["ssn", "target", "model", "yhat"]


@dataclass
class Linear:
    target: str
    model: str
    intercept: float
    coefficients: np.ndarray


@dataclass
class Basis:
    """Centre and matrix that take spectra to the components of one target."""

    centre: np.ndarray
    matrix: np.ndarray


@dataclass
class SavedModels:
    """What ``save_models`` wrote. A row per target and model; sizes are set by the instrument."""

    linear: list[Linear]
    networks: dict[tuple[str, str], Network]
    bases: dict[str, Basis]
    boosted: dict[tuple[str, str], GBTRegressionModel] = field(default_factory=dict)
    points: int = 0


def load_models(spark: SparkSession, folder: str) -> SavedModels:
    """The models below a folder that ``save_models`` wrote, all of them or a ValueError."""
    linear = [
        Linear(r["target"], r["model"], r["intercept"], np.array(r["coefficients"]))
        for r in spark.read.parquet(f"{folder}/linear").orderBy("target", "model").collect()
    ]
    networks = {
        (r["target"], r["model"]): Network(r["inputs"], tuple(r["layers"]), r["activation"], r["alpha"], r["rate"], np.array(r["weights"]))
        for r in spark.read.parquet(f"{folder}/networks").collect()
    }
    trees = spark.read.parquet(f"{folder}/boosted_models").collect()
    boosted = {(r["target"], r["model"]): GBTRegressionModel.load(f"{folder}/boosted/{r['target']}/{r['model']}") for r in trees}
    bases = {}
    for row in spark.read.parquet(f"{folder}/bases").collect():
        loadings = np.array(row["loadings"]).reshape(len(row["mean_x"]), -1)
        bases[row["target"]] = Basis(np.array(row["mean_x"]), loadings / np.array(row["scale"])[:, None])
    lengths = {len(m.coefficients) for m in linear} | {len(b.centre) for b in bases.values()}
    missing = {t for t, _ in [*networks, *boosted]} - bases.keys()
    if len(lengths) != 1 or missing:
        raise ValueError(f"models below {folder} do not fit together: lengths {sorted(lengths)}, no components for {sorted(missing)}")
    return SavedModels(linear, networks, bases, boosted, lengths.pop())


def scans(models: SavedModels) -> list[tuple[list[Linear], dict[tuple[str, str], Network]]]:
    """The models by scan, so that none carries more than ``SCAN_BYTES`` (or one model)."""
    out: list[tuple[list[Linear], dict]] = []
    size = SCAN_BYTES + 1
    for item in [*models.linear, *models.networks.items()]:
        own = item.coefficients.nbytes if isinstance(item, Linear) else models.bases[item[0][0]].matrix.nbytes + item[1].weights.nbytes
        if size + own > SCAN_BYTES:
            out.append(([], {}))
            size = 0
        size += own
        if isinstance(item, Linear):
            out[-1][0].append(item)
        else:
            out[-1][1][item[0]] = item[1]
    return out


def _one_scan(spectra: DataFrame, points: int, linear: list[Linear], networks: dict, bases: dict[str, Basis]) -> DataFrame:
    names = [(m.target, m.model) for m in linear] + list(networks)
    weights = np.column_stack([m.coefficients for m in linear]) if linear else np.zeros((points, 0))
    intercepts = np.array([m.intercept for m in linear])
    nets = [(target, n.settings, n.weights) for (target, _), n in networks.items()]
    used = {t: (bases[t].centre, bases[t].matrix) for t, _, _ in nets}
    shared = spectra.sparkSession.sparkContext.broadcast((weights, intercepts, nets, used))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, intercepts, nets, used = shared.value
        for batch in batches:
            x = matrix_of(batch.column("spectrum"), points)
            scores = {t: (x - centre) @ matrix for t, (centre, matrix) in used.items()}
            columns = [x @ weights + intercepts]
            for target, settings, flat in nets:
                net = Network(*settings, flat)
                columns.append(net.predict(scores[target][:, : net.inputs]).reshape(-1, 1))
            yield pa.RecordBatch.from_arrays([batch.column("ssn"), list_array(np.hstack(columns))], ["ssn", "yhats"])

    scored = spectra.mapInArrow(run, "ssn string, yhats array<double>")
    named = F.array(*[F.struct(F.lit(t).alias("target"), F.lit(m).alias("model")) for t, m in names])
    pairs = F.zip_with(named, "yhats", lambda n, y: F.struct(n["target"].alias("target"), n["model"].alias("model"), y.alias("yhat")))
    return scored.select("ssn", F.inline(pairs))


def score_spectra(spectra: DataFrame, models: SavedModels) -> DataFrame:
    """``(ssn, target, model, yhat)``: every saved model for every row of ``(ssn, spectrum)``.

    A spectrum that is NULL, has another length than the models or holds a NULL or non-finite value gets
    no row. Log targets stay in log space. Repeated rows are scored as often as they occur."""
    finite = F.forall("spectrum", lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)))
    fits = (F.size("spectrum") == models.points) & finite
    rows = spectra.filter(fits).select("ssn", F.col("spectrum").cast("array<double>").alias("spectrum"))
    parts = [_one_scan(rows, models.points, linear, networks, models.bases) for linear, networks in scans(models)]
    for (target, model), fitted in models.boosted.items():
        basis = models.bases[target]
        features = affine(rows, ["ssn"], models.points, basis.centre, basis.matrix[:, : fitted.numFeatures])
        scored = predict_boosting(fitted, features, {"pca_n_components": fitted.numFeatures})
        parts.append(scored.select("ssn", F.lit(target).alias("target"), F.lit(model).alias("model"), "yhat"))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.select(*SCORED)
