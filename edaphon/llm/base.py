"""What the operators of this folder share: words, tables, written intermediate results."""

from __future__ import annotations

import gc
import time

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from edaphon.session import fresh_path, materialise, shared_dir  # noqa: F401 - for the operators

#: ASCII white space; everything else belongs to a word (fixed by the word definition).
GAP = "[ \\t-\\r]+"
GAP_CHARS = " \t\n\x0b\f\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: Column) -> Column:
    """The words of ``text`` in order; none for NULL."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), GAP), lambda w: w != "")


def word_count(text: Column) -> Column:
    """Number of words, without building them: a gap is squeezed to one space first."""
    return F.size(words(text)).cast("long")


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def count_of(text: Column, chars: str) -> Column:
    """How many characters of ``text`` are among ``chars``."""
    return (F.length(text) - F.length(F.translate(text, chars, ""))).cast("long")


def sha256_hex(text: Column) -> Column:
    return F.sha2(F.encode(text, "UTF-8"), 256)


def settled(df: DataFrame, label: str) -> DataFrame:
    """``materialise``, then lets Spark drop the shuffle files that nothing refers to any more."""
    out = materialise(df, label)
    del df
    for _ in range(2):  # references are dropped by threads of their own, so what one round finds the next one frees
        gc.collect()
        out.sparkSession._jvm.System.gc()
        time.sleep(1)
    return out
