"""Audited, repeatable copy of objects."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edaphon.session import materialise
from edaphon.sources.manifest import empty_prefixes, full_root, open_store, with_prefixes, without_folders

# Statuses, messages and columns of the audit.
COPIED, SKIPPED, MISMATCH, FAILED, EMPTY = (
    "copied", "skipped_existing", "copied_with_size_mismatch", "failed", "empty_prefix",
)
EMPTY_MESSAGE = "Nenhum arquivo encontrado para o prefix."
MISMATCH_MESSAGE = "Tamanho no destino diferente do tamanho da origem."
MISSING_MESSAGE = "Objeto não encontrado no destino após upload: "

AUDIT_COLUMNS = [
    "execution_utc", "prefix", "source_bucket", "source_key", "dest_bucket", "dest_key",
    "source_size", "dest_size", "status", "error_message",
]
CHUNK = 8 << 20


def copy_status() -> F.Column:
    """Status of one object from its sizes: an existing destination is skipped whatever its size."""
    return (
        F.when(F.col("source_key").isNull(), EMPTY)
        .when(F.col("size_before").isNotNull(), SKIPPED)
        .when(F.col("size_after").isNull(), FAILED)
        .when(F.col("size_after") != F.col("source_size"), MISMATCH)
        .otherwise(COPIED)
    )


def _listed(source: DataFrame, prefixes: list[str], dest_prefix: str) -> DataFrame:
    return with_prefixes(without_folders(source), prefixes).select(
        "prefix",
        F.col("key").alias("source_key"),
        F.col("size").alias("source_size"),
        F.concat(F.lit(dest_prefix), "key").alias("dest_key"),
    )


def _stamped(audit: DataFrame, run: dict[str, str]) -> DataFrame:
    stamps = {c: F.lit(run[c]) for c in ("execution_utc", "source_bucket", "dest_bucket")}
    return audit.withColumns(stamps).select(*AUDIT_COLUMNS)


def copy_audit(source: DataFrame, before: DataFrame, after: DataFrame, prefixes: list[str], dest_prefix: str,
               run: dict[str, str]) -> DataFrame:
    """The audit of a copy from listings of the source and of the destination before and after.

    ``run`` gives execution_utc, source_bucket and dest_bucket. Object keys are unique within a
    listing, so neither join can be skewed.
    """
    objects = _listed(source, prefixes, dest_prefix)
    listed = objects.join(
        before.select(F.col("key").alias("dest_key"), F.col("size").alias("size_before")), "dest_key", "left"
    ).join(after.select(F.col("key").alias("dest_key"), F.col("size").alias("size_after")), "dest_key", "left")
    rows = listed.unionByName(empty_prefixes(without_folders(source), prefixes), allowMissingColumns=True)
    status = copy_status()
    audit = rows.withColumn("status", status).withColumn(
        "dest_size", F.coalesce("size_before", "size_after")
    )
    message = (
        F.when(F.col("status") == EMPTY, EMPTY_MESSAGE)
        .when(F.col("status") == FAILED, F.concat(F.lit(MISSING_MESSAGE), "dest_key"))
        .when(F.col("status") == MISMATCH, MISMATCH_MESSAGE)
        .otherwise("")
    )
    return _stamped(audit.withColumn("error_message", message), run)


@contextmanager
def _landing(dest: arrow_fs.FileSystem, path: str) -> Iterator:
    """A stream whose bytes land under a name of their own and are renamed, so a repeated or a
    concurrent attempt never leaves half an object. Object stores publish on close and need no rename."""
    if not isinstance(dest, (arrow_fs.LocalFileSystem, arrow_fs.HadoopFileSystem)):
        landing = path
    else:
        folder, name = path.rsplit("/", 1)
        dest.create_dir(folder, recursive=True)
        landing = f"{folder}/.{name}.{uuid.uuid4().hex}"
    with dest.open_output_stream(landing) as writer:
        yield writer
    if landing != path:
        dest.move(landing, path)


def _copy_one(source, source_path: str, dest, dest_path: str) -> int:
    """Streams one object and returns the size found at the destination."""
    with source.open_input_stream(source_path) as reader, _landing(dest, dest_path) as writer:
        while chunk := reader.read(CHUNK):
            writer.write(chunk)
    found = dest.get_file_info(dest_path)
    if found.type == arrow_fs.FileType.NotFound:
        raise FileNotFoundError(f"{MISSING_MESSAGE}{dest_path}")
    return found.size


def put_objects(rows: DataFrame, root: str) -> DataFrame:
    """Writes ``(key, content)`` as objects below ``root`` and returns ``(key, size)``, written.

    An object appears under its name when it is whole, so a repeated task does no harm."""
    root = full_root(root)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = open_store(root)
        for batch in batches:
            sizes = []
            for key, content in zip(batch.column("key").to_pylist(), batch.column("content")):
                with _landing(store, f"{path}/{key}") as writer:
                    writer.write(content.as_buffer() if content.is_valid else b"")
                sizes.append(len(content.as_buffer()) if content.is_valid else 0)
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(sizes, pa.int64())], ["key", "size"])

    return materialise(rows.select("key", "content").mapInArrow(run, "key string, size bigint"), "put")


def copy_objects(source: DataFrame, before: DataFrame, source_root: str, dest_root: str, prefixes: list[str],
                 dest_prefix: str, run: dict[str, str], tasks: int | None = None) -> DataFrame:
    """Copies what the destination lacks and returns the written audit.

    What to copy is decided once, from the listing ``before``; a repeated task copies its objects
    again to the same place and reports the same. An object that cannot be copied becomes a
    ``failed`` row. Bytes go from store to store through the tasks, never through the driver.
    """
    spark = source.sparkSession
    tasks = tasks or 4 * spark.sparkContext.defaultParallelism
    source_root, dest_root = full_root(source_root), full_root(dest_root)
    objects = _listed(source, prefixes, dest_prefix)
    known = before.select(F.col("key").alias("dest_key"), F.col("size").alias("size_before"))
    plan = materialise(objects.join(known, "dest_key", "left"), "copy-plan")

    def run_copies(pdfs: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        (from_fs, from_root), (to_fs, to_root) = open_store(source_root), open_store(dest_root)
        for pdf in pdfs:
            sizes, errors = [], []
            for source_key, dest_key in zip(pdf["source_key"], pdf["dest_key"]):
                size, error = None, ""
                try:
                    size = _copy_one(from_fs, f"{from_root}/{source_key}", to_fs, f"{to_root}/{dest_key}")
                except Exception as problem:  # noqa: BLE001 - every failure becomes an audit row
                    error = str(problem) or type(problem).__name__
                sizes.append(size)
                errors.append(error)
            copied = pdf[["prefix", "source_key", "source_size", "dest_key"]]
            yield copied.assign(size_after=pd.array(sizes, "Int64"), copy_error=errors)

    todo = plan.filter("size_before is null").repartition(tasks, "source_key")
    copied = todo.mapInPandas(
        run_copies,
        "prefix string, source_key string, source_size bigint, dest_key string, size_after bigint, copy_error string",
    )
    skipped = plan.filter("size_before is not null")
    empty = empty_prefixes(plan.select(F.col("source_key").alias("key")), prefixes)
    rows = copied.unionByName(skipped, allowMissingColumns=True).unionByName(empty, allowMissingColumns=True)
    judged = rows.withColumn("status", copy_status())
    message = (
        F.when(F.col("status") == EMPTY, EMPTY_MESSAGE)
        .when(F.col("status") == MISMATCH, MISMATCH_MESSAGE)
        .otherwise(F.coalesce("copy_error", F.lit("")))
    )
    audit = judged.withColumn("dest_size", F.coalesce("size_before", "size_after")).withColumn("error_message", message)
    return materialise(_stamped(audit, run), "copy-audit")


def copy_counters(audit: DataFrame) -> DataFrame:
    """Found, copied, skipped, failed, empty and mismatched objects per prefix and in total (NULL)."""
    status = F.col("status")
    mismatch = status == MISMATCH
    return audit.rollup("prefix").agg(
        F.count("source_key").alias("found"),
        F.count_if((status == COPIED) | mismatch).alias("copied"),
        F.count_if(status == SKIPPED).alias("skipped"),
        F.count_if(status == FAILED).alias("failed"),
        F.count_if(F.col("source_size") == 0).alias("zero_byte"),
        F.count_if(mismatch).alias("size_mismatch"),
    )
