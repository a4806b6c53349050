"""Silver and Gold tables and CSV reports."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from edaphon.functions.dictionary import with_comments
from edaphon.functions.spectrum import widen
from edaphon.session import fresh_path
from edaphon.sources.manifest import object_manifest

log = logging.getLogger(__name__)


def write_silver(silver: DataFrame, path: str | None = None, points: int | None = None) -> tuple[str, str]:
    """Parquet, or CSV with the spectrum widened if Parquet fails; returns ``(path, format)``.

    Tasks write in parallel: no single output file, no pass of the table through one task.
    """
    path = path or fresh_path(silver.sparkSession, "silver")
    silver = with_comments(silver)
    try:
        silver.write.mode("overwrite").parquet(path)
        return path, "parquet"
    except Exception as error:  # noqa: BLE001 - whatever stopped Parquet, the table is to be saved
        log.warning("Parquet failed (%s), writing CSV", error)
    table = silver
    if "spectrum" in silver.columns:
        if points is None:
            points = silver.agg(F.max(F.array_size("spectrum"))).first()[0] or 0
        table = widen(silver, points)
    table.write.mode("overwrite").option("header", "true").csv(f"{path}_csv")
    return f"{path}_csv", "csv"


def write_gold(tidy: DataFrame, path: str, replace_all: bool = False) -> str:
    """``(target, ssn, y, spectrum)`` partitioned by target.

    Replaces the targets that have rows and leaves the others, or replaces the whole table, so that
    a target without rows does not keep its old ones. Either way a re-run is safe. Rows are spread
    within a target, so no target is one file or one task.
    """
    mode = "static" if replace_all else "dynamic"
    tidy.write.mode("overwrite").option("partitionOverwriteMode", mode).partitionBy("target").parquet(path)
    return path


def read_gold(spark: SparkSession, path: str) -> DataFrame:
    """All targets; a filter on ``target`` reads its folder only."""
    return spark.read.schema("ssn string, y double, spectrum array<double>, target string").parquet(path)


def gold_of(gold: DataFrame, name: str, column: str, points: int | None = None) -> DataFrame:
    """One target in its own form: ``ssn``, the target's column, and the spectrum or ``wn_*``."""
    one = gold.filter(F.col("target") == name).select("ssn", F.col("y").alias(column), "spectrum")
    return one if points is None else widen(one, points)


def output_size(spark: SparkSession, path: str) -> DataFrame:
    """``(target, files, bytes)`` of a written Gold table."""
    target = F.regexp_extract("key", "(?:^|/)target=([^/]+)/", 1)
    files = object_manifest(spark, path).filter(F.col("key").endswith(".parquet"))
    return files.groupBy(target.alias("target")).agg(F.count("*").alias("files"), F.sum("size").alias("bytes"))


def write_report(report: DataFrame, folder: str, run_ts: str, by: list[str] | None = None) -> str:
    """CSV with a header in a folder named after the run. The time is given, never read here."""
    path = f"{folder.rstrip('/')}/run_ts={run_ts}"
    writer = report.write.mode("overwrite").option("header", "true")
    (writer.partitionBy(*by) if by else writer).csv(path)
    return path


def read_report(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).option("header", "true").csv(path)
