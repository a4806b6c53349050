"""Wet-chemistry tables from CSV."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from edaphon.functions.keys import with_clean_key

# The target columns as the laboratories name them (one has a leading blank).
LAB_TARGETS = ["pH", "%C", " Olsen P mg/kg", "ECEC cmolc/ kg soil", "ExBas"]
KEY = "SSN"


def read_lab_csv(spark: SparkSession, path: str, table: str) -> DataFrame:
    """Key as text, targets as double, other columns as text.

    The columns are read as text and converted with ``try_cast``: no inference job, and a stray
    word in one laboratory's file becomes NULL instead of changing the type of the column.
    """
    raw = spark.read.option("header", "true").csv(path)
    typed = raw.select(
        *[
            F.col(f"`{c}`").try_cast("double").alias(c) if c in LAB_TARGETS else F.col(f"`{c}`")
            for c in raw.columns
        ]
    )
    return with_clean_key(typed, table, KEY)
