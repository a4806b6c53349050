"""Object listings: what lies below a folder, and which configured prefix it belongs to."""

from __future__ import annotations

import os
from collections.abc import Iterator
from itertools import islice

import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from edaphon.session import materialise

LISTED = "kind string, key string, size bigint, low string, high string"
#: Names of one folder that a task lists; more are cut into ranges. Names kept to cut by, entries of a batch.
RANGE_ENTRIES, SAMPLED, PAGE = 20_000, 8_192, 2_000


def open_store(root: str) -> tuple[arrow_fs.FileSystem, str]:
    """File system and path of a folder, in the driver or in a task."""
    for scheme in ("s3a://", "s3n://"):
        if root.startswith(scheme):
            root = "s3://" + root[len(scheme):]
    if root.startswith("file:"):
        root = "/" + root[len("file:"):].lstrip("/")
    if "://" in root:
        store, path = arrow_fs.FileSystem.from_uri(root)
    else:
        store, path = arrow_fs.LocalFileSystem(), root
    return store, path.rstrip("/")


def full_root(root: str) -> str:
    """A relative path as the driver means it."""
    return root if "://" in root or root.startswith(("/", "file:")) else os.path.abspath(root)


def names_between(path: str, low: str | None, high: str | None) -> Iterator[str]:
    """Names in a local folder with ``low < name <= high``, in no order; none if it does not exist."""
    try:
        with os.scandir(path) as found:
            for entry in found:
                if (low is None or entry.name > low) and (high is None or entry.name <= high):
                    yield entry.name
    except (FileNotFoundError, NotADirectoryError):
        return


def cut_points(names: Iterator[str], entries: int) -> list[str]:
    """Upper ends of ranges of about ``entries`` names, none if there are no more names than that.

    One pass keeps every n-th name, and doubles n when it has kept many."""
    kept, every, count = [], 1, 0
    for name in names:
        if count % every == 0:
            kept.append(name)
            if len(kept) > SAMPLED:
                kept, every = kept[::2], 2 * every
        count += 1
    if count <= entries:
        return []
    parts = -(-count // entries)
    kept.sort()
    # every range but the last ends below the greatest name, so each cut makes ranges smaller
    return sorted({kept[at - 1] for k in range(1, parts) if (at := len(kept) * k // parts)})


def paged(rows: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
    """Entries (kind, key, size, low, high) in batches of bounded size."""
    kinds = [pa.string(), pa.string(), pa.int64(), pa.string(), pa.string()]
    while page := list(islice(rows, PAGE)):
        yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*page), kinds)], ["kind", "key", "size", "low", "high"])


def start_folders(prefixes: list[str]) -> set[str]:
    """The folders that hold the entries whose names the prefixes begin."""
    return {p.rpartition("/")[0] for p in prefixes}


def list_ranges(frontier: DataFrame, root: str, prefixes: list[str]) -> DataFrame:
    """The entries of the name ranges ``(folder, low, high)``: objects, folders, and of a range that
    holds too many the smaller ranges it is cut into."""

    starts = start_folders(prefixes)

    def wanted(key: str) -> bool:
        return any(key.startswith(p) for p in prefixes)

    def deeper(key: str) -> bool:
        return wanted(f"{key}/") and key not in starts  # those are listed by themselves

    def local(path: str, folder: str, low: str | None, high: str | None) -> Iterator[tuple]:
        place = f"{path}/{folder}".rstrip("/") or "/"
        lead = f"{folder}/" if folder else ""
        if ends := cut_points(names_between(place, low, high), RANGE_ENTRIES):
            yield from (("range", folder, None, a, b) for a, b in zip([low, *ends], [*ends, high]) if a != b)
            return
        for name in names_between(place, low, high):
            key, full = lead + name, f"{place}/{name}"
            if os.path.isdir(full):
                if deeper(key):
                    yield "folder", key, None, None, None
            elif wanted(key):
                try:
                    yield "object", key, os.path.getsize(full), None, None
                except FileNotFoundError:  # gone since it was named
                    continue

    def remote(store: arrow_fs.FileSystem, path: str, folder: str) -> Iterator[tuple]:
        selector = arrow_fs.FileSelector(f"{path}/{folder}".rstrip("/"), allow_not_found=True)
        for info in store.get_file_info(selector):
            key = info.path[len(path) + 1 :]
            if info.type == arrow_fs.FileType.Directory and deeper(key):
                yield "folder", key, None, None, None
            elif info.type == arrow_fs.FileType.File and wanted(key):
                yield "object", key, info.size, None, None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = open_store(root)
        for batch in batches:
            for folder, low, high in zip(*(batch.column(c).to_pylist() for c in ("folder", "low", "high"))):
                yield from paged(local(path, folder, low, high) if isinstance(store, arrow_fs.LocalFileSystem) else remote(store, path, folder))

    return frontier.select("folder", "low", "high").mapInArrow(run, LISTED)


def object_manifest(spark: SparkSession, root: str, prefixes: list[str] | None = None) -> DataFrame:
    """``(key, size)`` of the objects below ``root`` whose key starts with one of the prefixes.

    Tasks list the store, level by level: every folder is read once, by the task it is dealt to, and what
    was found is written. A folder of very many files on a file system is cut into ranges of names, which
    other tasks list in the next round, so one flat folder is not one task. (Object stores answer a folder
    in one listing with its sizes; that stays one task, and its pages leave it as they come.) Spark's file
    sources are no help here, they leave out empty files. A root that does not exist holds nothing.
    Overlapping prefixes list an object once. The listing happens when this is called.
    """
    root, wanted = full_root(root), prefixes or [""]
    own = [p for p in wanted if not any(p != q and p.startswith(q) for q in wanted)]
    tasks = 4 * spark.sparkContext.defaultParallelism
    frontier = spark.createDataFrame([(f, None, None) for f in sorted(start_folders(own))], "folder string, low string, high string")
    found = None
    while True:  # as often as folders are deep, and twice for a folder that is cut
        level = materialise(list_ranges(frontier.repartition(tasks, "folder", "low"), root, own), "listing")
        found = level if found is None else found.unionByName(level)
        frontier = level.filter("kind <> 'object'").select(F.col("key").alias("folder"), "low", "high")
        if frontier.isEmpty():
            return found.filter("kind = 'object'").select("key", "size")


def without_folders(manifest: DataFrame) -> DataFrame:
    """Object stores list folder markers as keys that end in a slash."""
    return manifest.filter(~F.col("key").endswith("/"))


def with_prefixes(manifest: DataFrame, prefixes: list[str]) -> DataFrame:
    """A row per object and configured prefix it starts with.

    The prefix list is configuration, so it becomes an expression: no join, no shuffle.
    """
    listed = F.array(*[F.lit(p) for p in prefixes])
    key = F.col("key")
    return manifest.select(F.explode(F.filter(listed, lambda p: key.startswith(p))).alias("prefix"), *manifest.columns)


def empty_prefixes(manifest: DataFrame, prefixes: list[str]) -> DataFrame:
    """The configured prefixes below which nothing lies."""
    spark = manifest.sparkSession
    listed = spark.createDataFrame([(p,) for p in prefixes], "prefix string")
    found = with_prefixes(manifest, prefixes).select("prefix").distinct()
    return listed.join(found, "prefix", "left_anti")


def prefix_counts(manifest: DataFrame, prefixes: list[str]) -> DataFrame:
    """Objects, bytes and empty objects below each prefix, zero for prefixes without objects."""
    spark = manifest.sparkSession
    listed = spark.createDataFrame([(p,) for p in prefixes], "prefix string")
    # one placeholder per prefix keeps empty prefixes without an outer join
    rows = with_prefixes(without_folders(manifest), prefixes).unionByName(listed, allowMissingColumns=True)
    return rows.groupBy("prefix").agg(
        F.count("key").alias("objects"),
        F.coalesce(F.sum("size"), F.lit(0)).alias("bytes"),
        F.count_if(F.col("size") == 0).alias("zero_byte"),
    )


def keys_by_suffix(manifest: DataFrame, suffixes: list[str]) -> DataFrame:
    """``(suffix, key)``: the first key that ends in each suffix, NULL where none does."""
    spark = manifest.sparkSession
    listed = spark.createDataFrame([(s,) for s in suffixes], "suffix string")
    ends = F.array(*[F.lit(s) for s in suffixes])
    key = F.col("key")
    hits = without_folders(manifest).select(F.explode(F.filter(ends, lambda s: key.endswith(s))).alias("suffix"), "key")
    return hits.unionByName(listed, allowMissingColumns=True).groupBy("suffix").agg(F.min("key").alias("key"))


def require_keys(found: DataFrame) -> dict[str, str]:
    """The lookup as a dictionary; raises when a suffix has no key. One row per suffix."""
    rows = {r["suffix"]: r["key"] for r in found.collect()}
    missing = sorted(s for s, k in rows.items() if k is None)
    if missing:
        raise FileNotFoundError(f"no object ends in: {', '.join(missing)}")
    return rows
