"""The pipeline's SimHash stage and its run against plain Python."""

import brute
from pyspark.sql import functions as F

import corpus_pipeline
from edaphon.llm.base import materialise

SMALL = "/root/testdata/sf0.001"


def stage(spark, docs):
    return corpus_pipeline.simhash_near_dedup(spark, docs, SMALL).collect()


def expected(rows):
    """Per group the smallest id that stays (None if no row has one) and the texts it may have."""
    prints = {k: brute.fingerprint(row["text"]) for k, row in enumerate(rows)}
    groups = {}
    for k, root in brute.near_duplicates(prints).items():
        groups.setdefault(root, []).append(rows[k])
    out = []
    for group in groups.values():
        ids = [row["doc_id"] for row in group if row["doc_id"] is not None]
        least = min(ids, default=None)
        out.append((least, {row["text"] for row in group if row["doc_id"] == least}))
    return out


def agree(got, rows):
    want = expected(rows)
    assert len(got) == len(want)
    left = [(row["doc_id"], row["text"]) for row in got]
    for least, texts in sorted(want, key=lambda w: len(w[1])):
        found = next(pair for pair in left if pair[0] == least and pair[1] in texts)
        left.remove(found)


def test_rows_without_an_id(spark):
    a, b, c = ("word%d one two three four five six" % k + f" tail{k}" * 9 for k in range(3))
    docs = [(None, a, 1), (None, a, 2), (None, b, 3), (7, b, 4), (4, b, 5), (None, c, 6), (9, c, 7), (9, c, 8), (9, a, 9), (None, None, 10)]
    frame = spark.createDataFrame(docs, "doc_id long, text string, place int")
    got = stage(spark, frame)
    assert sorted((r["doc_id"] or 0, r["text"] or "") for r in got) == sorted([(9, a), (4, b), (9, c), (0, "")])
    assert sorted(map(str, got)) == sorted(map(str, stage(spark, frame.repartition(5, "place"))))
    bare = spark.createDataFrame([(None, a, 1), (None, a, 2), (None, b, 3)], "doc_id long, text string, place int")
    assert sorted(r["text"] for r in stage(spark, bare)) == sorted([a, b])


def test_stage_against_brute_force(spark, odd):
    docs = spark.read.parquet(f"{odd}/documents.parquet")
    agree(stage(spark, docs), docs.collect())
    without = docs.withColumn("doc_id", F.when(F.col("doc_id") % 3 > 0, F.col("doc_id")))
    agree(stage(spark, without), without.collect())


def test_stage_within_the_run(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    for _, before in corpus_pipeline.STAGES[:2]:
        docs = materialise(before(spark, docs, SMALL), "before")
    agree(stage(spark, docs), docs.collect())
