"""Contents of listed objects as a data source whose partitions are planned groups of the listing.

The listing is dealt to groups of bounded bytes by running sums inside hash bins, and written: one file
of keys per group. The driver sees the names of these files, never the objects. A task reads its file of keys and streams
the objects, so a lost executor costs its groups and nothing else. Empty objects are rows like others.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs as arrow_fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from edaphon.session import fresh_path
from edaphon.sources.manifest import full_root, open_store

FORMAT = "edaphon_objects"
CONTENT = "source string, size bigint, content binary"
#: Bytes of a group, what opening an object counts for, groups of a hash bin, bytes of an Arrow batch.
GROUP_BYTES, OPEN_COST, BIN_GROUPS, BATCH_BYTES = 128 << 20, 64 << 10, 8, 16 << 20


def read_groups(manifest: DataFrame, group_bytes: int = GROUP_BYTES) -> DataFrame:
    """``(key, size, bin, group)``: no group holds more than ``group_bytes`` and one object, opening costs included."""
    cost = F.col("size") + OPEN_COST
    total = manifest.agg(F.sum(cost)).first()[0] or 0
    bins = 1 + total // (BIN_GROUPS * group_bytes)
    dealt = manifest.select("key", "size", F.pmod(F.xxhash64("key"), F.lit(bins)).alias("bin"))
    before = Window.partitionBy("bin").orderBy("key").rowsBetween(Window.unboundedPreceding, -1)
    return dealt.withColumn("group", F.floor(F.coalesce(F.sum(cost).over(before), F.lit(0)) / group_bytes))


class Group(InputPartition):
    def __init__(self, path: str):
        self.path = path


class ObjectReader(DataSourceReader):
    def __init__(self, root: str, plan: str):
        self.root, self.plan = root, plan

    def partitions(self) -> list[Group]:
        store, path = open_store(self.plan)
        files = store.get_file_info(arrow_fs.FileSelector(path, recursive=True, allow_not_found=True))
        return [Group(f.path) for f in sorted(files, key=lambda f: f.path) if f.path.endswith(".parquet")] or [Group("")]

    def read(self, partition: Group) -> Iterator[pa.RecordBatch]:
        if not partition.path:
            return
        (plans, _), (store, root) = open_store(self.plan), open_store(self.root)
        with plans.open_input_file(partition.path) as file:
            keys = pq.ParquetFile(file).read(columns=["key"]).column("key").to_pylist()
        held: list[tuple[str, int, bytes]] = []
        for key in keys:
            with store.open_input_stream(f"{root}/{key}") as stream:
                content = stream.read()
            held.append((f"{self.root}/{key}", len(content), content))
            if sum(size for _, size, _ in held) + OPEN_COST * len(held) >= BATCH_BYTES:
                yield batch_of(held)
                held = []
        if held:
            yield batch_of(held)


def batch_of(rows: list[tuple[str, int, bytes]]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.int64(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*rows), kinds)], ["source", "size", "content"])


class ObjectSource(DataSource):
    """``spark.read.format("edaphon_objects")`` with the options ``root`` and ``plan``."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return CONTENT

    def reader(self, schema) -> ObjectReader:
        return ObjectReader(self.options["root"], self.options["plan"])


def read_objects(spark: SparkSession, root: str, manifest: DataFrame, group_bytes: int = GROUP_BYTES) -> DataFrame:
    """``(source, size, content)`` of the listed objects, a task per planned group.

    ``manifest`` (key, size) is read twice; it should be a written listing, as ``object_manifest`` gives."""
    plan = fresh_path(spark, "read-plan")
    groups = read_groups(manifest, group_bytes)
    # a group is in one task here, so it becomes one file
    groups.repartition("bin", "group").write.partitionBy("bin", "group").parquet(plan)
    spark.dataSource.register(ObjectSource)
    return spark.read.format(FORMAT).option("root", full_root(root).rstrip("/")).option("plan", plan).load()
