import hashlib
import math

import pytest
from pyspark.sql import functions as F

from edaphon.functions.hashing import hex_uniform, seeded_md5
from edaphon.modelling.split import exact_folds, exact_split, fold_of, is_test, with_exact_folds, with_folds


def keys(spark, n, parts=3):
    return spark.range(n).select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("ssn")).repartition(parts)


def digest(text):
    return hashlib.md5(text.encode()).hexdigest()


def test_hash_split_and_folds(spark):
    rows = keys(spark, 3000).select("ssn", is_test(F.col("ssn")).alias("test"), fold_of(F.col("ssn")).alias("fold")).collect()
    for r in rows[:200]:
        assert r["test"] == (int(digest(f"{r['ssn']}|42")[:8], 16) / 2**32 < 0.2)
        assert r["fold"] == int(int(digest(f"{r['ssn']}|fold42")[:8], 16) / 2**32 * 5)
    share = sum(r["test"] for r in rows) / len(rows)
    assert abs(share - 0.2) < 0.03
    assert {r["fold"] for r in rows} == set(range(5))


def test_split_does_not_depend_on_partitions(spark):
    one = {tuple(r) for r in with_folds(keys(spark, 500, 1), "ssn").collect()}
    many = {tuple(r) for r in with_folds(keys(spark, 500, 7), "ssn").collect()}
    assert one == many
    assert {f for _, f in one} == {-1, 0, 1, 2, 3, 4}


@pytest.mark.parametrize("n", [1, 7, 10, 101])
def test_exact_split(spark, n):
    rows = {r["ssn"]: r["split"] for r in exact_split(keys(spark, n), "ssn").collect()}
    test = [k for k, s in rows.items() if s == "test"]
    assert len(rows) == n and len(test) == math.ceil(n / 5)
    order = sorted(rows, key=lambda k: digest(f"{k}|42"))
    assert set(order[: len(test)]) == set(test)


@pytest.mark.parametrize("n", [3, 5, 10, 377])
def test_exact_folds(spark, n):
    rows = {r["ssn"]: r["fold"] for r in exact_folds(keys(spark, n), "ssn").collect()}
    sizes = [list(rows.values()).count(f) for f in range(5)]
    assert sizes == [n // 5 + (f < n % 5) for f in range(5)]
    order = sorted(rows, key=lambda k: digest(f"{k}|fold42"))
    assert [rows[k] for k in order] == sorted(rows.values())


def test_repeated_keys_count_once(spark):
    doubled = keys(spark, 20).unionByName(keys(spark, 20))
    assert exact_split(doubled, "ssn").count() == 20


def test_uniform(spark):
    u = keys(spark, 10).select("ssn", hex_uniform(seeded_md5(F.col("ssn"), 1)).alias("u")).collect()
    assert all(r["u"] == int(digest(f"{r['ssn']}|1")[:8], 16) / 2**32 for r in u)


def test_exact_folds_per_group(spark):
    both = keys(spark, 23).withColumn("target", F.lit("a")).unionByName(keys(spark, 40).withColumn("target", F.lit("b")))
    rows = with_exact_folds(both, "ssn", ["target"]).collect()
    for target, n in (("a", 23), ("b", 40)):
        folds = [r["fold"] for r in rows if r["target"] == target]
        test = math.ceil(n / 5)
        sizes = [(n - test) // 5 + (f < (n - test) % 5) for f in range(5)]
        assert [folds.count(f) for f in range(-1, 5)] == [test, *sizes]


def test_exact_folds_move_no_spectra(spark):
    rows = keys(spark, 200).select(F.lit("a").alias("target"), "ssn", F.array(F.lit(1.0), F.lit(2.0)).alias("spectrum"))
    both = rows.unionByName(rows.withColumn("target", F.lit(None).cast("string")))  # a NULL group is a group
    folded = with_exact_folds(both.coalesce(1), "ssn", ["target"])
    plan = folded._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "hashpartitioning" not in plan
    counts = {(r["target"], r["fold"]): r["count"] for r in folded.groupBy("target", "fold").count().collect()}
    assert counts == {(t, f): 40 if f < 0 else 32 for t in ("a", None) for f in range(-1, 5)}


def test_keys_that_are_missing_or_repeat(spark):
    some = keys(spark, 30).unionByName(keys(spark, 10)).unionByName(spark.createDataFrame([(None,)] * 4, "ssn string"))
    folded = with_exact_folds(some, "ssn", [])
    assert folded.count() == 40 and folded.filter("fold = -1").select("ssn").distinct().count() == 6
    assert exact_split(some, "ssn").count() == 30
    assert with_exact_folds(some.filter("ssn is null"), "ssn", []).count() == 0


@pytest.mark.parametrize("n", [1, 2, 3])
def test_fewer_rows_than_folds(spark, n):
    folds = sorted(r["fold"] for r in with_exact_folds(keys(spark, n), "ssn", []).collect())
    assert folds == [-1, *range(n - 1)]


def test_the_cut_is_found_inside_one_bin(spark, monkeypatch):
    from edaphon.modelling import split

    monkeypatch.setattr(split, "BIN_DIGITS", 1)  # many rows in a bin
    rows = {r["ssn"]: r["split"] for r in exact_split(keys(spark, 500), "ssn").collect()}
    order = sorted(rows, key=lambda k: digest(f"{k}|42"))
    assert [rows[k] for k in order] == ["test"] * 100 + ["train"] * 400
