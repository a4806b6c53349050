"""Listing by ranges of names, and reading by planned groups."""

import random

import pytest
from pyspark.sql import functions as F

from edaphon.sources import manifest as M
from edaphon.sources import objects as O
from edaphon.sources.spectra import decode, decode_status, scan_spectra


@pytest.fixture(scope="module")
def flat(tmp_path_factory):
    """One flat folder of 300 files, some empty, with a folder among them."""
    root = tmp_path_factory.mktemp("flat")
    folder = root / "Bruker_Alpha_KBr"
    (folder / "deep" / "er").mkdir(parents=True)
    sizes = {f"Bruker_Alpha_KBr/icr{k:05d}.0": k % 7 for k in range(300)} | {"Bruker_Alpha_KBr/deep/er/x.0": 5, "top": 2}
    for key, size in sizes.items():
        (root / key).write_bytes(b"A" * size)
    return str(root), sizes


@pytest.mark.parametrize("entries", [M.RANGE_ENTRIES, 40])
def test_ranges_list_everything_once(spark, flat, entries, monkeypatch):
    monkeypatch.setattr(M, "RANGE_ENTRIES", entries)
    monkeypatch.setattr(M, "PAGE", 16)
    root, sizes = flat
    rows = M.object_manifest(spark, root).collect()
    assert len(rows) == len(sizes) and {r["key"]: r["size"] for r in rows} == sizes
    some = M.object_manifest(spark, root, ["Bruker_Alpha_KBr/icr0001", "Bruker_Alpha_KBr/deep/"]).collect()
    assert sorted(r["key"] for r in some) == sorted(k for k in sizes if "icr0001" in k or "deep" in k)


def test_a_flat_folder_is_listed_by_several_tasks(spark, flat, monkeypatch):
    monkeypatch.setattr(M, "RANGE_ENTRIES", 40)
    root, _ = flat
    start = spark.createDataFrame([("Bruker_Alpha_KBr", None, None)], "folder string, low string, high string")
    ranges = M.list_ranges(start, root, [""])
    assert {r["kind"] for r in ranges.collect()} == {"range"}
    parts = ranges.select(F.col("key").alias("folder"), "low", "high").repartition(16, "low")
    listed = M.list_ranges(parts, root, [""]).withColumn("task", F.spark_partition_id())
    assert listed.select("task").distinct().count() > 2
    most = listed.groupBy("task").count().agg(F.max("count")).first()[0]
    assert most < 300


def test_cut_points():
    names = [f"n{k:04d}" for k in range(5000)]
    random.Random(1).shuffle(names)
    ends = M.cut_points(iter(names), 500)
    assert len(ends) == 9 and ends == sorted(ends)
    bounds = ["", *ends, "~"]
    assert all(sum(a < n <= b for n in names) <= 700 for a, b in zip(bounds, bounds[1:]))
    assert M.cut_points(iter(names), 5000) == []


def test_every_cut_makes_ranges_smaller():
    for n in range(2, 40):
        names = [f"{k:02d}" for k in range(n)]
        for entries in (1, 3):
            ends = M.cut_points(iter(names), entries)
            assert bool(ends) == (n > entries)
            bounds = ["", *ends, "~"]
            assert all(0 < sum(a < x <= b for x in names) < n for a, b in zip(bounds, bounds[1:]) if ends)


def test_sample_of_very_many_names_is_bounded(monkeypatch):
    monkeypatch.setattr(M, "SAMPLED", 10)
    assert 1 <= len(M.cut_points((f"{k:05d}" for k in range(1000)), 100)) <= 9


def test_groups_are_bounded_and_hold_every_object(spark):
    pick = random.Random(2)
    rows = [(f"k{k}", pick.choice([0, 10, 5000, 90_000])) for k in range(400)] + [("huge", 10_000_000)]
    groups = O.read_groups(spark.createDataFrame(rows, "key string, size long"), group_bytes=1 << 20).collect()
    assert sorted((r["key"], r["size"]) for r in groups) == sorted(rows)
    held = {}
    for r in groups:
        held.setdefault((r["bin"], r["group"]), []).append(r["size"] + O.OPEN_COST)
    assert all(sum(sizes) - max(sizes) <= 1 << 20 for sizes in held.values())
    assert len(held) > 20


def test_scan_reads_by_groups(spark, flat, monkeypatch):
    monkeypatch.setattr(O, "BATCH_BYTES", 3 * O.OPEN_COST)
    root, sizes = flat
    files = scan_spectra(spark, root)
    plan = files._jdf.queryExecution().executedPlan().toString()
    assert "binaryFile" not in plan and "BatchScan" in plan
    got = {r["source"][len(root) + 1 :]: len(r["content"]) for r in files.collect()}
    assert got == {k: n for k, n in sizes.items() if k.endswith(".0")}
    status = {r["decode_status"]: r["files"] for r in decode_status(decode(files)).collect()}
    assert status == {"no_spectrum": len(got)}  # an empty file has no block either


def test_reading_nothing(spark, tmp_path):
    assert scan_spectra(spark, str(tmp_path / "none")).count() == 0


def test_several_groups_are_several_tasks(spark, flat):
    root, sizes = flat
    frame = O.read_objects(spark, root, M.object_manifest(spark, root), group_bytes=8 * O.OPEN_COST)
    assert frame.rdd.getNumPartitions() > 10
    assert frame.agg(F.sum("size")).first()[0] == sum(sizes.values())
