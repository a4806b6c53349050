"""Centroid clustering (Lloyd's rounds on integer vectors) over Hilbert-ordered blocks with zone maps.

Vectors are put in the order of a Hilbert curve through their leading dimensions and written once, as
blocks of neighbours with the least and the greatest value per dimension. A centroid whose least distance
to a block's box is above the greatest distance of some other centroid cannot be the nearest of any
vector in it, so a block is compared with its few candidates only, all its rows at once. A round sends
the centroids to the tasks (number of centroids x dimensions, no more), adds up sums per block, task and
centroid, and brings one row per centroid back.

The curve runs through the ``CURVE_DIMS`` dimensions that vary most, cut at ``2 ** CURVE_BITS`` equal steps
between the least and the greatest value; rows of one place are dealt on by a hash of id and vector, then by row
number, so a place that holds a third of the rows is many blocks. The order decides only how much is
skipped, never a result: distances and sums are integers, and ties go to the smaller centroid number.

Defined cases: a vector that is NULL, has another number of components, or holds a NULL or non-finite
component takes no part, nor does one whose scaled component reaches 2^27 in size (squared distances
would leave 64 bits). Rows without an id are assigned and counted but start no centroid. Rows that repeat
are vectors of their own; rows of one id start centroids in the order of their vectors. Fewer rows than
centroids: every row starts one. No rows with an id, no centroids and no result. Other columns are ignored,
whatever their names. An inertia beyond 64 bits is NULL.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edaphon.llm.base import materialise

WIDTH = 64
CENTROIDS = 40
ROUNDS = 5
SCALE = 256
SEED = 2
#: Scaled components stay below this, so that a squared distance over 64 dimensions fits 64 bits.
LARGEST = 1 << 27
CURVE_DIMS, CURVE_BITS = 12, 4
#: Rows of a block; a block is one row of the written table and bounds a task's memory.
BLOCK = 512
#: Rows of a task of the index.
TASK_ROWS = 200_000

PLACED = "vec_id bigint, v array<bigint>, place binary"
BLOCKS = "ids binary, data binary, low binary, high binary"
SUMS = "cluster int, n bigint, sums array<bigint>"
ASSIGNED = "vec_id bigint, cluster int, distance bigint"


def integer_vectors(rows: DataFrame, id: str = "vec_id", vector: str = "embedding", width: int = WIDTH, scale: int = SCALE) -> DataFrame:
    """(vec_id, v): the vectors that take part, as floor(scale * x), x as double."""
    fits = F.forall(vector, lambda e: F.coalesce(F.abs(e.cast("double")) * scale < LARGEST, F.lit(False)))
    whole = F.transform(vector, lambda e: F.floor(F.lit(float(scale)) * e.cast("double")))
    return rows.filter((F.size(vector) == width) & fits).select(F.col(id).cast("long").alias("vec_id"), whole.alias("v"))


def hilbert_places(points: np.ndarray, bits: int) -> np.ndarray:
    """The place of every point (rows of small whole numbers) along a Hilbert curve, as big-endian bytes.

    Coordinates are taken bit by bit, the highest first: where a bit is set the lower bits of the first
    coordinate are inverted, else they change places with the first's; a Gray code ends it.
    """
    x = points.astype(np.int64).T.copy()
    dims = len(x)
    for b in range(bits - 1, 0, -1):
        bit, lower = 1 << b, (1 << b) - 1
        for d in range(dims):
            on = (x[d] & bit) > 0
            swap = np.where(on, 0, (x[0] ^ x[d]) & lower)
            x[0] ^= np.where(on, lower, swap)
            x[d] ^= swap
    for d in range(1, dims):
        x[d] ^= x[d - 1]
    turn = np.zeros_like(x[0])
    for b in range(bits - 1, 0, -1):
        turn ^= np.where(x[-1] >> b & 1, (1 << b) - 1, 0)
    x ^= turn
    planes = [(x[d] >> b & 1).astype(np.uint8) for b in range(bits - 1, -1, -1) for d in range(dims)]
    return np.packbits(np.array(planes).reshape(bits * dims, -1).T, axis=1)


def matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, width)


def hilbert_order(vectors: DataFrame, width: int) -> DataFrame:
    """``vectors`` with the column ``place``, the bytes of their place on the curve."""
    edges = vectors.agg(*[f(F.col("v")[d]).alias(f"{f.__name__}{d}") for d in range(width) for f in (F.min, F.max, F.stddev_pop)]).first()
    spread = [edges[f"stddev_pop{d}"] or 0.0 for d in range(width)]
    dims = sorted(sorted(range(width), key=lambda d: -spread[d])[:CURVE_DIMS])
    low = np.array([edges[f"min{d}"] or 0 for d in dims])
    span = np.array([(edges[f"max{d}"] or 0) + 1 for d in dims]) - low

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = (matrix(batch.column("v"), width)[:, dims] - low << CURVE_BITS) // span
            places = hilbert_places(cells, CURVE_BITS)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([p.tobytes() for p in places], pa.binary())], [*batch.schema.names, "place"])

    return vectors.mapInArrow(run, PLACED)


def zone_blocks(vectors: DataFrame, width: int, rows: int) -> DataFrame:
    """The vectors as blocks along the curve: ids, components, and the box as rows of 64-bit numbers."""
    tie, row = F.xxhash64("vec_id", "v").alias("tie"), F.monotonically_increasing_id().alias("row")
    placed, order = hilbert_order(vectors, width).select("vec_id", "v", "place", tie, row), ["place", "tie", "row"]
    usual, tasks = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions")), rows // TASK_ROWS
    dealt = placed.repartitionByRange(tasks, *order) if tasks > usual else placed.repartitionByRange(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                part = batch.slice(at, BLOCK)
                data, ids = matrix(part.column("v"), width), part.column("vec_id")
                known = ids.is_valid().to_numpy(zero_copy_only=False)
                named = np.where(known, ids.fill_null(0).to_numpy(zero_copy_only=False), 0).astype(np.int64)
                row = [np.concatenate([named, known.astype(np.int64)]), data, data.min(axis=0), data.max(axis=0)]
                yield pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()) for x in row], ["ids", "data", "low", "high"])

    return dealt.sortWithinPartitions(*order).select("vec_id", "v").mapInArrow(run, BLOCKS)


def first_centroids(vectors: DataFrame, count: int, seed: int) -> np.ndarray:
    """The vectors with the smallest digests of ``seed:id``; ``count`` rows reach the driver, no more."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")).cast("binary"), 256)
    rows = vectors.filter(F.col("vec_id").isNotNull()).orderBy(digest, "v").limit(count).collect()
    return np.array([r["v"] for r in rows], dtype=np.int64)


def candidates(low: np.ndarray, high: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Numbers of the centroids that can be nearest to a vector in the box."""
    under, over = np.maximum(low - centroids, 0), np.maximum(centroids - high, 0)
    least = ((under + over) ** 2).sum(axis=1)
    most = (np.maximum(np.abs(centroids - low), np.abs(centroids - high)) ** 2).sum(axis=1)
    return np.flatnonzero(least <= most.min())


def nearest(data: np.ndarray, low: np.ndarray, high: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number of the nearest centroid, squared distance) of every row of a block.

    Products go through doubles while all their sums stay below 2^53, and through integers beyond.
    """
    near = candidates(low, high, centroids)
    some = centroids[near]
    size = max(int(np.abs(low).max()), int(np.abs(high).max()), int(np.abs(some).max()))
    if 4 * data.shape[1] * size * size < 1 << 53:
        x, c = data.astype(np.float64), some.astype(np.float64)
        distance = ((x * x).sum(axis=1)[:, None] - 2 * (x @ c.T) + (c * c).sum(axis=1)).astype(np.int64)
    else:
        distance = np.stack([((data - row) ** 2).sum(axis=1) for row in some], axis=1)
    at = distance.argmin(axis=1)
    return near[at].astype(np.int32), distance[np.arange(len(data)), at]


def parts(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple]:
    """(ids with a mark whether known, rows, low, high) of every block."""
    for batch in batches:
        for row in zip(*(batch.column(c) for c in ("ids", "data", "low", "high"))):
            ids, data, low, high = (np.frombuffer(x.as_buffer(), np.int64) for x in row)
            yield ids, data.reshape(-1, width), low, high


def cluster_sums(blocks: DataFrame, centroids: np.ndarray) -> dict[int, tuple[int, list[int]]]:
    """cluster -> (rows, sums per dimension); one row per centroid reaches the driver."""
    width = centroids.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, data, low, high in parts(batches, width):
            cluster, _ = nearest(data, low, high, centroids)
            found = np.unique(cluster)
            sums = [data[cluster == c].sum(axis=0).tolist() for c in found.tolist()]
            count = [int((cluster == c).sum()) for c in found.tolist()]
            yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(count, pa.int64()), pa.array(sums, pa.list_(pa.int64()))], ["cluster", "n", "sums"])

    per_block = blocks.select("ids", "data", "low", "high").mapInArrow(run, SUMS)
    totals = [F.sum(F.col("sums")[d].cast("decimal(38,0)")).alias(f"s{d}") for d in range(width)]
    rows = per_block.groupBy("cluster").agg(F.sum("n").alias("n"), *totals).collect()
    return {r["cluster"]: (r["n"], [int(r[f"s{d}"]) for d in range(width)]) for r in rows}


def centroid_digest(centroid: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, centroid.tolist())).encode()).hexdigest()


def assign(blocks: DataFrame, centroids: np.ndarray) -> DataFrame:
    """(vec_id, cluster, distance) of every row."""
    width = centroids.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, data, low, high in parts(batches, width):
            cluster, distance = nearest(data, low, high, centroids)
            named, known = ids[: len(data)], ids[len(data) :]
            yield pa.RecordBatch.from_arrays([pa.array(named, mask=known == 0), pa.array(cluster), pa.array(distance)], ["vec_id", "cluster", "distance"])

    return blocks.mapInArrow(run, ASSIGNED)


def centroid_clusters(vectors: DataFrame, count: int = CENTROIDS, rounds: int = ROUNDS, width: int = WIDTH, seed: int = SEED) -> tuple[DataFrame, np.ndarray]:
    """``vectors``: (vec_id, v). Assignments (vec_id, cluster, distance) and the final centroids."""
    vectors = materialise(vectors, "cluster-vectors")
    centroids = first_centroids(vectors, count, seed).reshape(-1, width)
    if not len(centroids):
        return vectors.sparkSession.createDataFrame([], ASSIGNED), centroids
    blocks = materialise(zone_blocks(vectors, width, vectors.count()), "cluster-blocks")
    for _ in range(rounds):
        for cluster, (n, sums) in cluster_sums(blocks, centroids).items():
            centroids[cluster] = [s // n for s in sums]  # floor, also below zero
    return assign(blocks, centroids), centroids


def with_inertia(assigned: DataFrame, centroids: np.ndarray) -> DataFrame:
    """Adds the summed distance of the row's cluster and of all rows, and the digest of its centroid."""
    assigned = materialise(assigned, "clusters")
    sums = assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()  # a row per centroid
    part = {r["cluster"]: int(r["s"]) for r in sums}
    whole = sum(part.values())
    facts = [(k, *(x if x < 1 << 63 else None for x in (part[k], whole)), centroid_digest(centroids[k])) for k in sorted(part)]
    schema = "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string"
    return assigned.join(F.broadcast(assigned.sparkSession.createDataFrame(facts, schema)), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )


def clusters_sql(count: int = CENTROIDS, rounds: int = ROUNDS, width: int = WIDTH, scale: int = SCALE, seed: int = SEED) -> str:
    """The same in SQL: every vector against every centroid, round by round."""
    pick = f"""
v as materialized (
  select row_number() over () as i, vec_id, list_transform(embedding, lambda x: floor({scale} * x::double)::bigint) as v from embeddings
  where len(embedding) = {width} and len(list_filter(embedding, lambda x: x is null or not isfinite(x::double))) = 0
    and len(list_filter(embedding, lambda x: isfinite(x::double) and {scale} * abs(x::double) >= {LARGEST})) = 0
),
c0 as materialized (
  select (row_number() over (order by sha256('{seed}:' || vec_id), v) - 1)::int as c, v from v where vec_id is not null
  qualify c < {count}
)"""
    near = """
a{r} as materialized (
  select i, (min_by(c, d) filter (true))::int as c, min(d) as d from (
    select v.i, k.c, (list_sum(list_transform(list_zip(v.v, k.v), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::hugeint * 4096 + k.c) as d
    from v cross join c{r} k) group by i
)"""
    move = """
s{n} as (
  select c, j, sum(x)::hugeint as s, count(*)::hugeint as n from (
    select a.c, unnest(v.v) as x, unnest(range(1, {width} + 1)) as j from a{r} a join v using (i)) group by c, j
),
c{n} as materialized (
  select k.c, coalesce(m.v, k.v) as v from c{r} k
  left join (select c, list(((s - ((s % n) + n) % n) // n)::bigint order by j) as v from s{n} group by c) m using (c)
)"""
    steps = [pick]
    for r in range(rounds):
        steps += [near.format(r=r), move.format(r=r, n=r + 1, width=width)]
    steps.append(near.format(r=rounds))
    return f"""
with {",".join(steps)},
f as (select v.vec_id, a.c as cluster, (a.d // 4096)::bigint as distance from a{rounds} a join v using (i))
select vec_id, cluster, distance, (sum(distance) over (partition by cluster))::bigint as cluster_inertia,
  (sum(distance) over ())::bigint as inertia, sha256(array_to_string(k.v, ',')) as centroid_sha256
from f join c{rounds} k on k.c = f.cluster"""
