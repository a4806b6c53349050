"""Feed-forward regression networks trained by data-parallel rounds.

Rows are dealt to shards of a fixed size by a digest, whatever their number. In each round every
shard runs one epoch of Adam in minibatches from the common weights, and Spark averages the shards'
results by their rows. All networks of a call train in the same pass over the data; what travels is
their weights. Where there are fewer shards than the cluster runs tasks, the networks are dealt to
groups and each group gets its own copy of the shards: a task then trains one group on one shard. Neither
the groups nor the batches rows arrive in touch the result, since a task holds its whole shard.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from edaphon.functions.hashing import hex_uniform, seeded_md5
from edaphon.modelling.moments import matrix_of

# Training defaults.
BATCH, VALID_SHARE, PATIENCE, TOLERANCE = 200, 0.1, 10, 1e-4
BETA1, BETA2, EPSILON = 0.9, 0.999, 1e-8
#: Rows of a shard, held by its task: 80 components take 5 MB.
SHARD_ROWS = 8192


@dataclass
class Network:
    """One configuration with its weights; a flat vector holds all layers."""

    inputs: int
    layers: tuple[int, ...]
    activation: str
    alpha: float
    rate: float
    weights: np.ndarray = field(default_factory=lambda: np.empty(0))

    @property
    def settings(self) -> tuple:
        """All but the weights, as plain values."""
        return self.inputs, self.layers, self.activation, self.alpha, self.rate

    @property
    def shapes(self) -> list[tuple[int, int]]:
        sides = [self.inputs, *self.layers, 1]
        return list(zip(sides[:-1], sides[1:]))

    def initial(self, seed: int) -> np.ndarray:
        rng = np.random.default_rng(seed)
        parts = []
        for rows, cols in self.shapes:
            bound = np.sqrt(6.0 / (rows + cols))
            parts += [rng.uniform(-bound, bound, rows * cols), rng.uniform(-bound, bound, cols)]
        return np.concatenate(parts)

    def unpack(self, flat: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        parts, at = [], 0
        for rows, cols in self.shapes:
            w = flat[at : at + rows * cols].reshape(rows, cols)
            parts.append((w, flat[at + rows * cols : at + rows * cols + cols]))
            at += rows * cols + cols
        return parts

    def forward(self, flat: np.ndarray, x: np.ndarray) -> list[np.ndarray]:
        """Values of every layer, the last one the prediction."""
        values, parts = [x], self.unpack(flat)
        for depth, (w, b) in enumerate(parts):
            z = values[-1] @ w + b
            if depth < len(parts) - 1:
                z = np.maximum(z, 0) if self.activation == "relu" else np.tanh(z)
            values.append(z)
        return values

    def predict(self, x: np.ndarray) -> np.ndarray:
        return self.forward(self.weights, x[:, : self.inputs])[-1][:, 0]

    def gradient(self, flat: np.ndarray, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, float]:
        """Gradient and value of half the mean squared error with the L2 penalty."""
        values, parts = self.forward(flat, x), self.unpack(flat)
        error = values[-1][:, 0] - y
        delta, grads = error[:, None] / len(y), []
        for depth in reversed(range(len(parts))):
            w, _ = parts[depth]
            grads.append(delta.sum(axis=0))
            grads.append((values[depth].T @ delta + self.alpha * w / len(y)).ravel())
            if depth:
                delta = delta @ w.T
                delta *= (values[depth] > 0) if self.activation == "relu" else 1 - values[depth] ** 2
        return np.concatenate(grads[::-1]), float(error @ error / 2)


def adam_step(network: Network, state: np.ndarray, x: np.ndarray, y: np.ndarray, step: int) -> float:
    """One step in place on the rows ``(weights, mean, mean square)`` of ``state``."""
    grad, loss = network.gradient(state[0], x[:, : network.inputs], y)
    state[1] = BETA1 * state[1] + (1 - BETA1) * grad
    state[2] = BETA2 * state[2] + (1 - BETA2) * grad**2
    rate = network.rate * np.sqrt(1 - BETA2**step) / (1 - BETA1**step)
    state[0] -= rate * state[1] / (np.sqrt(state[2]) + EPSILON)
    return loss


@dataclass
class History:
    """Training loss and validation R² of each network after each round."""

    loss: list[np.ndarray] = field(default_factory=list)
    score: list[np.ndarray] = field(default_factory=list)


ROUND = "net int, n double, part array<double>, loss double, valid array<double>"


def network_groups(networks: int, shards: int, tasks: int) -> int:
    """Into how many groups networks are dealt, so that groups times shards keep ``tasks`` tasks busy."""
    return max(1, min(networks, -(-tasks // shards)))


def sharded(rows: DataFrame, shards: int, groups: int, key: str, size: int, seed: int) -> DataFrame:
    """Training rows dealt to shards, in digest order, with the validation rows marked, once for each
    group of networks: a partition per group and shard. The deal looks at the whole row, so a repeated
    key does not fill one shard."""
    digest = seeded_md5(F.col(key), f"net{seed}")
    deal = F.xxhash64(key, "y", "features", F.lit(seed))
    dealt = rows.select(
        F.concat(F.substring(digest, 9, 8), F.hex(deal)).alias("_order"),
        F.pmod(deal, F.lit(shards)).cast("int").alias("_shard"),
        F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("_group"),
        (hex_uniform(digest) < VALID_SHARE).alias("_valid"),
        "y",
        F.slice("features", 1, size).alias("features"),
    )
    task = F.col("_group") * shards + F.col("_shard")
    return dealt.repartitionById(shards * groups, task).sortWithinPartitions("_order")


def train_networks(rows: DataFrame, n_rows: int, networks: list[Network], key: str = "ssn", rounds: int = 1500,
                   seed: int = 42, shard_rows: int = SHARD_ROWS, tasks: int | None = None) -> History:
    """Trains ``networks`` in place on the ``n_rows`` rows ``(key, y, features)`` and stops early.
    ``tasks`` is how many to keep busy, by default what the cluster runs at once.

    Ten rounds without a better validation score end a network's training, its best weights stay.
    The driver holds weights only.
    """
    size = max(n.inputs for n in networks)
    context = rows.sparkSession.sparkContext
    shards = max(1, -(-n_rows // shard_rows))
    groups = network_groups(len(networks), shards, tasks or context.defaultParallelism)
    data = sharded(rows, shards, groups, key, size, seed).persist()
    states = [np.stack([w, np.zeros_like(w), np.zeros_like(w)]) for w in (n.initial(seed) for n in networks)]
    steps, stale = [0] * len(networks), [0] * len(networks)
    best = [(-np.inf, s[0].copy()) for s in states]
    open_nets, history = list(range(len(networks))), History()
    try:
        for number in range(rounds + 1):
            shared = context.broadcast({i: (networks[i].settings, states[i], steps[i]) for i in open_nets})
            results = data.mapInArrow(_round(shared, groups, size, seed + number), ROUND)
            total = Summarizer.sum(array_to_vector("part"))
            sums = results.groupBy("net").agg(
                F.sum("n").alias("n"),
                vector_to_array(total).alias("part"),
                F.sum("loss").alias("loss"),
                *[F.sum(F.get("valid", F.lit(i))).alias(f"valid{i}") for i in range(4)],
                F.max(F.get("valid", F.lit(4))).alias("steps"),
            )
            loss, score = np.full(len(networks), np.nan), np.full(len(networks), np.nan)
            for r in sums.collect():
                i, n = r["net"], r["n"]
                count, error, total_y, square_y = (r[f"valid{k}"] for k in range(4))
                spread = square_y - total_y**2 / count if count else 0.0
                # the score is that of the weights the round began with
                score[i] = 1 - error / spread if spread > 0 else -r["loss"] / max(n, 1)
                loss[i] = r["loss"] / max(n, 1)
                stale[i] = 0 if score[i] > best[i][0] + TOLERANCE else stale[i] + 1
                if score[i] > best[i][0]:
                    best[i] = (score[i], states[i][0].copy())
                if n:
                    states[i] = (np.asarray(r["part"]) / n).reshape(3, -1)
                steps[i] = int(r["steps"])
            shared.unpersist()
            history.loss.append(loss)
            history.score.append(score)
            open_nets = [i for i in open_nets if stale[i] < PATIENCE and np.isfinite(score[i])]
            if not open_nets:
                break
    finally:
        data.unpersist()
    for network, (_, weights) in zip(networks, best):
        network.weights = weights
    return history


def _round(shared, groups: int, size: int, seed: int):
    """One epoch of a group's networks over the rows of a shard, gathered first: a shard is small."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [b for b in batches if b.num_rows]
        if not parts:
            return
        x = np.concatenate([matrix_of(b.column("features"), size) for b in parts])
        y, held = (np.concatenate([b.column(c).to_numpy(zero_copy_only=False) for b in parts]) for c in ("y", "_valid"))
        group = parts[0].column("_group")[0].as_py()
        nets = {i: (Network(*settings), state, step) for i, (settings, state, step) in shared.value.items() if i % groups == group}
        local = {i: [net, state.copy(), step] for i, (net, state, step) in nets.items()}
        count, loss = int((~held).sum()), dict.fromkeys(nets, 0.0)
        valid = {i: np.zeros(4) for i in nets}
        if held.any():
            for i, (net, state, _) in nets.items():
                error = y[held] - net.forward(state[0], x[held][:, : net.inputs])[-1][:, 0]
                valid[i] += [held.sum(), error @ error, y[held].sum(), y[held] @ y[held]]
        order = np.random.default_rng(seed).permutation(np.flatnonzero(~held))
        for start in range(0, len(order), BATCH):
            rows = order[start : start + BATCH]
            for i, one in local.items():
                one[2] += 1
                loss[i] += adam_step(one[0], one[1], x[rows], y[rows], one[2])
        for i, (_, state, step) in local.items():
            part = (state * count).ravel()
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([i], pa.int32()),
                    pa.array([float(count)]),
                    pa.array([part], pa.list_(pa.float64())),
                    pa.array([loss[i]]),
                    pa.array([np.append(valid[i], step)], pa.list_(pa.float64())),
                ],
                names=["net", "n", "part", "loss", "valid"],
            )

    return run


def predict_networks(rows: DataFrame, networks: list[Network], size: int, kept: list[str]) -> DataFrame:
    """``(kept…, net, yhat)`` of every network for every row."""
    shared = rows.sparkSession.sparkContext.broadcast([(n.settings, n.weights) for n in networks])
    schema = T.StructType(
        [rows.schema[c] for c in kept] + [T.StructField("yhats", T.ArrayType(T.DoubleType()))]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nets = [Network(*settings, weights) for settings, weights in shared.value]
        for batch in batches:
            x = matrix_of(batch.column("features"), size)
            yhat = np.column_stack([net.predict(x) for net in nets])
            offsets = np.arange(0, yhat.size + 1, yhat.shape[1], dtype=np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(yhat.ravel()))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], lists], names=[*kept, "yhats"])

    sliced = rows.select(*kept, F.slice("features", 1, size).alias("features"))
    return sliced.mapInArrow(run, schema).select(*kept, F.posexplode("yhats").alias("net", "yhat"))
