"""One row per key, the same one on every run."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from edaphon.session import materialise


def first_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The row that sorts first, NULLs last. NULL keys form one group and keep one row.

    Spark applies the rank limit before the shuffle as well, so a key that holds much of the
    table sends one row per map task.
    """
    window = Window.partitionBy(*keys).orderBy(*[F.col(c).asc_nulls_last() for c in order])
    return df.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1").drop("_rank")


def without_repeats(df: DataFrame, keys: list[str], name: str) -> DataFrame:
    """The same rows for a written table with large rows, ``name`` naming each row and deciding.

    Ranking would sort the large rows before the shuffle. Here each key's first name and number of
    rows are added up before the shuffle, keys that repeat are few as a rule, and the names that lose
    are written and taken out by an anti join. If they are few Spark broadcasts them and the large
    rows stay where they are; if they are many it shuffles, and splits a key that holds much.
    """
    first = df.groupBy(*[F.col(k).alias(f"_{k}") for k in keys]).agg(F.min(name).alias("_first"), F.count("*").alias("_rows"))
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])
    named = df.select(*keys, name).join(first.filter("_rows > 1"), same)
    losing = materialise(named.filter(F.col(name) != F.col("_first")).select(name), "repeats")
    return df.join(losing, name, "left_anti").select(*df.columns)
