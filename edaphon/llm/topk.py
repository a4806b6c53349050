"""Exact top-k inner products by Fagin's threshold algorithm.

Vectors are written once as blocks: a matrix and, per dimension, the block's rows sorted by that
dimension. Blocks go to tasks once per share of the queries and stay there; queries form blocks too, a
tenth of the size or less, which stream past. Within a pair every query reads the sorted lists from the
end its sign favours, a step of entries from all lists at a time; every row seen for the first time is
scored in full. The sum of the products at the reading positions bounds what has not been seen: once it
is below the k-th best score the block is done. A query's best rows over all blocks are its answer. With
a query set of a fixed share of the rows the work grows with the square of the rows, as the task demands,
in independent pairs of blocks.

Scores are integers. They are added up in double precision where that is exact (all partial sums below
2^53) and in Python's integers elsewhere.

Defined cases: vectors that are NULL, empty, or hold a NULL or non-finite component take no part, nor do
rows without an id; shorter vectors count as padded with zeros; rows equal in id and vector count once; of
different vectors under one id, each is a candidate and the smallest (as an array) is the query; candidates with the
query's own id are left out; an empty table or no candidates give no rows. Components and scores beyond a bigint
are its least or largest value, before ranking. Columns other than the two named are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from edaphon.llm.base import materialise

SCALE = 1024
K = 10
QUERY_STEP = 100
#: Rows of a block of vectors and of queries; bound a task's memory.
BLOCK = 8192
QUERY_BLOCK = 512
#: Entries of each sorted list that are read between two tests of the bound.
READ = 128
EXACT = float(1 << 53)
LOW, HIGH = -(1 << 63), (1 << 63) - 1
#: Query blocks that stream past one copy of a block of vectors.
SHARE = 256

RESULT = "query_id bigint, vec_id bigint, score bigint"


def integer_vectors(rows: DataFrame, id: str = "vec_id", vector: str = "embedding", scale: int = SCALE) -> DataFrame:
    """Distinct (vec_id, v): whole vectors as floor(scale * x), x as double."""
    x = F.col(vector)
    bad = F.exists(x, lambda e: e.isNull() | F.isnan(e.cast("double")) | (F.abs(e.cast("double")) == float("inf")))
    whole = F.transform(x, lambda e: F.floor(F.lit(float(scale)) * e.cast("double")))
    return rows.filter(F.col(id).isNotNull() & (F.size(x) > 0) & ~bad).select(F.col(id).cast("long").alias("vec_id"), whole.alias("v")).distinct()


def matrix(vectors, width: int) -> np.ndarray:
    """Rows of integers padded to ``width``."""
    out = np.zeros((len(vectors), width), dtype=np.int64)
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return out


def blocks(vectors: DataFrame, rows: int, size: int, width: int, lists: bool) -> DataFrame:
    """(block, ids, data, lists): vectors dealt to blocks of about ``size``, as bytes; with ``lists`` also the
    positions of the rows in ascending order of each dimension."""
    count = max(1, -(-rows // size))

    def build(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("vec_id", kind="stable")
        data = matrix(pdf["v"].tolist(), width)
        ids = pdf["vec_id"].to_numpy(np.int64)
        order = np.argsort(data, axis=0, kind="stable").T.astype(np.int32).tobytes() if lists else None
        return pd.DataFrame({"block": [key[0]], "ids": [ids.tobytes()], "data": [data.tobytes()], "lists": [order]})

    dealt = vectors.withColumn("block", F.pmod(F.xxhash64("vec_id", "v"), F.lit(count)).cast("int"))
    return dealt.groupBy("block").applyInPandas(build, "block int, ids binary, data binary, lists binary")


def clipped(scores: np.ndarray) -> np.ndarray:
    """Scores within a bigint; doubles are exact, so they are."""
    return scores if scores.dtype != object else np.array([min(max(s, LOW), HIGH) for s in scores.tolist()], dtype=object)


def best_rows(query: np.ndarray, own: int, data: np.ndarray, ids: np.ndarray, lists: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The threshold algorithm for one query in one block: positions and scores of its best rows."""
    rows = len(data)
    use = np.flatnonzero(query)
    if not len(use):
        use = np.arange(1)
    weights = query[use]
    lists, falls = lists[use], weights > 0
    seen = ids == own
    found, scores, depth = np.zeros(0, np.int64), np.zeros(0, query.dtype), 0
    while depth < rows:
        deep = min(rows, depth + READ)
        # each ascending list is read from the end that its weight favours
        read = np.where(falls[:, None], lists[:, rows - deep : rows - depth][:, ::-1], lists[:, depth:deep])
        fresh = np.zeros(rows, dtype=bool)
        fresh[read] = True
        fresh &= ~seen
        seen |= fresh
        new = np.flatnonzero(fresh)
        score = clipped(data[new] @ query)
        if len(found) == k:
            new, score = new[score >= scores[-1]], score[score >= scores[-1]]
        found, scores = np.concatenate([found, new]), np.concatenate([scores, score])
        keep = np.lexsort((ids[found], -scores))[:k]
        found, scores = found[keep], scores[keep]
        if seen.all() or (len(found) == k and max((weights * data[read[:, -1], use]).sum(), LOW) < scores[-1]):
            break
        depth = deep
    return found, scores


def top_k(vectors: DataFrame, is_query: Column, k: int = K) -> DataFrame:
    """``vectors``: (vec_id, v). Per query its ``k`` best rows: query_id, rank, vec_id, score."""
    vectors = materialise(vectors, "topk-vectors")
    size = vectors.agg(F.count("*").alias("n"), F.max(F.size("v")).alias("width")).first()
    queries = vectors.filter(is_query).groupBy("vec_id").agg(F.min("v").alias("v"))
    width = size["width"] or 1
    index = materialise(blocks(vectors, size["n"], BLOCK, width, lists=True), "topk-index")
    n_queries, n_blocks = queries.count(), max(1, -(-size["n"] // BLOCK))
    asked = blocks(queries, n_queries, QUERY_BLOCK, width, lists=False)
    # few blocks are copied to more tasks; many queries meet several copies, so that a task ends
    tasks = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    n_asked = max(1, -(-n_queries // QUERY_BLOCK))
    shares = max(min(n_asked, -(-tasks // n_blocks)), -(-n_asked // SHARE))
    place = F.pmod(F.col("block"), F.lit(shares)).alias("share")
    held = index.select("block", F.explode(F.sequence(F.lit(0), F.lit(shares - 1))).alias("share"), F.lit(0).alias("turn"), "ids", "data", "lists")
    passing = asked.select(F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))).alias("_to"), place, F.lit(1).alias("turn"), "ids", "data", "lists")
    rows = held.unionByName(passing.withColumnRenamed("_to", "block"))
    # a block comes before the queries that are to pass it
    rows = rows.repartition(max(tasks, n_blocks * shares), "block", "share").sortWithinPartitions("block", "share", "turn")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, ids, data, lists = None, None, None, None
        for batch in batches:
            for row in range(batch.num_rows):
                block, share, turn, ids_, data_, lists_ = (batch.column(i)[row].as_py() for i in range(6))
                ids_, data_ = np.frombuffer(ids_, np.int64), np.frombuffer(data_, np.int64).reshape(-1, width)
                if turn == 0:
                    at, ids, data = (block, share), ids_, data_
                    lists = np.frombuffer(lists_, np.int32).reshape(width, -1)
                    far, doubles = float(np.abs(data.astype(float)).max()), data.astype(np.float64)
                    continue
                if at != (block, share):  # no vector was dealt to this block
                    continue
                exact = far * float(np.abs(data_.astype(float)).max()) * width < EXACT
                rows_, asked_ = (doubles, data_.astype(np.float64)) if exact else (data.astype(object), data_.astype(object))
                out: list[tuple[int, int, int]] = []
                for own, query in zip(ids_.tolist(), asked_):
                    found, scores = best_rows(query, own, rows_, ids, lists, k)
                    out += [(own, int(ids[i]), int(s)) for i, s in zip(found.tolist(), scores.tolist())]
                columns = zip(*out) if out else ((), (), ())
                yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in columns], ["query_id", "vec_id", "score"])

    hits = rows.mapInArrow(run, RESULT).groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    place = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return hits.withColumn("rank", place).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
