"""Model-ready tables, one per target, and their audit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from edaphon.functions.spectrum import complete
from edaphon.operators.quality import outside_domain

# Gold table names and their target columns.
GOLD_TARGETS = {
    "ph": "ph",
    "carbono": "pct_c",
    "p": "olsen_p_mg_kg",
    "ecec": "ecec_cmolc__kg_soil",
    "exbas": "exbas",
}
# The targets whose domain the audit checks.
CHECKED = ["ph", "pct_c", "olsen_p_mg_kg", "exbas"]
# Audit statuses, the first that applies, and the message of a target Silver lacks.
FAILED, EMPTY, DUPLICATES = "failed", "empty_gold_after_dropna", "success_with_duplicates"
INVALID, SUCCESS = "success_with_invalid_target", "success"
NO_TARGET = "Target %s não existe"
ID = "ssn"


def spectral_points(silver: DataFrame) -> int:
    """Length of the longest spectrum: the number of spectral columns of the wide form.

    The Silver metrics hold the same number, a job that has them need not ask again.
    """
    return silver.agg(F.max(F.array_size("spectrum"))).first()[0] or 0


def usable(target: str, points: int) -> Column:
    """Key, target and every spectral value present and not NaN."""
    value = F.col(target)
    return F.col(ID).isNotNull() & value.isNotNull() & ~F.isnan(value) & complete(F.col("spectrum"), points)


def gold_table(silver: DataFrame, target: str, points: int) -> DataFrame:
    """``(ssn, target, spectrum)`` without incomplete rows."""
    for column in (ID, target, "spectrum"):
        if column not in silver.columns:
            raise KeyError(f"Silver has no column {column!r}")
    return silver.filter(usable(target, points)).select(ID, target, "spectrum")


def gold_tidy(silver: DataFrame, points: int, targets: dict[str, str] = GOLD_TARGETS) -> DataFrame:
    """All Gold tables as ``(target, ssn, y, spectrum)`` from one scan of Silver."""
    present = present_in(silver, targets)
    values = F.array(*[F.struct(F.lit(g).alias("target"), F.col(t).alias("y")) for g, t in present.items()])
    whole = silver.filter(F.col(ID).isNotNull() & complete(F.col("spectrum"), points))
    tidy = whole.select(F.inline(values), ID, "spectrum")
    return tidy.filter(F.col("y").isNotNull() & ~F.isnan("y"))


COUNTS = ["input_rows", "output_rows", "null_target_rows", "duplicate_ssn", "invalid_target_rows"]


def present_in(silver: DataFrame, targets: dict[str, str]) -> dict[str, str]:
    return {g: t for g, t in targets.items() if t in silver.columns}


def gold_counts(silver: DataFrame, points: int, targets: dict[str, str] = GOLD_TARGETS) -> DataFrame:
    """``(gold_name, counts…)`` of the Gold tables Silver yields, written or not, in one pass.

    Counts per key come first (added up before the shuffle), so repeated keys of each Gold table
    are found in the same pass.
    """
    present = present_in(silver, targets)
    flags = [F.col(ID).alias("key")]
    for g, t in present.items():
        good = usable(t, points)
        bad = outside_domain(t, F.col(t)) if t in CHECKED else F.lit(False)
        flags += [
            good.cast("long").alias(f"out_{g}"),
            F.col(t).isNull().cast("long").alias(f"null_{g}"),
            (good & bad).cast("long").alias(f"bad_{g}"),
        ]
    parts = [f"{part}_{g}" for g in present for part in ("out", "null", "bad")]
    per_key = silver.select(*flags).groupBy("key").agg(F.count("*").alias("rows"), *[F.sum(p).alias(p) for p in parts])
    totals = per_key.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("input_rows"),
        *[F.coalesce(F.sum(p), F.lit(0)).alias(p) for p in parts],
        *[F.count_if(F.col(f"out_{g}") > 1).alias(f"dup_{g}") for g in present],
    )
    rows = []
    for g in present:
        names = ["input_rows", f"out_{g}", f"null_{g}", f"dup_{g}", f"bad_{g}"]
        rows.append(F.struct(F.lit(g).alias("gold_name"), *[F.col(n).alias(c) for n, c in zip(names, COUNTS)]))
    return totals.select(F.inline(F.array(*rows)))


def written_counts(silver: DataFrame, gold: DataFrame, targets: dict[str, str] = GOLD_TARGETS) -> DataFrame:
    """The same counts from the written Gold table: reads keys and targets, no spectra."""
    present = present_in(silver, targets)
    nulls = [F.count_if(F.col(t).isNull()).alias(f"null_{g}") for g, t in present.items()]
    parts = [
        F.struct(F.lit(g).alias("gold_name"), F.col("input_rows"), F.col(f"null_{g}").alias("null_target_rows"))
        for g in present
    ]
    read = silver.agg(F.count("*").alias("input_rows"), *nulls).select(F.inline(F.array(*parts)))
    bad = F.lit(False)
    for g, t in present.items():
        if t in CHECKED:
            bad = bad | ((F.col("target") == g) & outside_domain(t, F.col("y")))
    per_key = gold.groupBy(F.col("target").alias("gold_name"), ID).agg(
        F.count("*").alias("rows"), F.count_if(bad).alias("bad")
    )
    kept = per_key.groupBy("gold_name").agg(
        F.sum("rows").alias("output_rows"),
        F.count_if(F.col("rows") > 1).alias("duplicate_ssn"),
        F.sum("bad").alias("invalid_target_rows"),
    )
    return read.join(kept, "gold_name", "left").select("gold_name", *[F.coalesce(c, F.lit(0)).alias(c) for c in COUNTS])


def audit_rows(counts: DataFrame, points: int, targets: dict[str, str] = GOLD_TARGETS) -> DataFrame:
    """The audit: a row for every target, with a status; a target without counts has failed."""
    spark = counts.sparkSession
    listed = spark.createDataFrame(list(targets.items()), "gold_name string, target_col string")
    found = F.col("input_rows").isNotNull()
    rows = listed.join(counts, "gold_name", "left").withColumn(
        "error_message", F.when(found, "").otherwise(F.format_string(NO_TARGET, "target_col"))
    )
    rows = rows.withColumns({c: F.coalesce(c, F.lit(0)) for c in COUNTS})
    dropped = F.col("input_rows") - F.col("output_rows")
    share = F.when(F.col("input_rows") > 0, F.round((dropped / F.col("input_rows")) * 100, 2)).otherwise(0.0)
    status = (
        F.when(F.col("error_message") != "", FAILED)
        .when(F.col("output_rows") == 0, EMPTY)
        .when(F.col("duplicate_ssn") > 0, DUPLICATES)
        .when(F.col("invalid_target_rows") > 0, INVALID)
        .otherwise(SUCCESS)
    )
    return rows.select(
        "gold_name",
        "target_col",
        "input_rows",
        "output_rows",
        dropped.alias("dropped_rows"),
        share.alias("pct_rows_dropped"),
        "null_target_rows",
        "duplicate_ssn",
        "invalid_target_rows",
        F.lit(points).cast("long").alias("spectral_cols"),
        status.alias("status"),
        "error_message",
    )


def gold_audit(silver: DataFrame, points: int, targets: dict[str, str] = GOLD_TARGETS) -> DataFrame:
    """The audit of the Gold tables Silver yields, from one pass over Silver."""
    return audit_rows(gold_counts(silver, points, targets), points, targets)
