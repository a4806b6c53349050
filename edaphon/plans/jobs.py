"""The four jobs of the lake, from raw objects to ranked models.

Each takes its run time as text, writes its tables and its validation report, and can be repeated:
bronze skips what is there, silver and gold replace their tables, reports go to a folder per run.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from edaphon.functions.spectrum import narrow
from edaphon.operators import quality as Q
from edaphon.operators.gold import FAILED, GOLD_TARGETS, audit_rows, gold_tidy, spectral_points, written_counts
from edaphon.operators.reconcile import silver_master, with_lab_row
from edaphon.plans.evaluate import Evaluation, Options, evaluate, save_models
from edaphon.session import materialise
from edaphon.sinks.copy import copy_counters, copy_objects
from edaphon.sinks.lake import output_size, read_gold, write_gold, write_report, write_silver
from edaphon.sources.lab_tables import read_lab_csv
from edaphon.sources.manifest import keys_by_suffix, object_manifest, require_keys
from edaphon.sources.spectra import Decoder, decode, decode_status, require_spectra, scan_spectra, spectra_base

# The prefixes of the source and the names of the laboratory files.
PREFIXES = [
    "2009-2013/Dry_Chemistry/ICRAF/Bruker_Alpha_KBr/",
    "2009-2013/Wet_Chemistry/CROPNUTS/",
    "2009-2013/Wet_Chemistry/ICRAF/",
    "2009-2013/Wet_Chemistry/RRES/",
]
# in priority order
LAB_FILES = {
    "rres": "Wet_Chemistry_RRES.csv",
    "icraf": "Wet_Chemistry_ICRAF.csv",
    "cropnuts": "Wet_Chemistry_CROPNUTS.csv",
}
# The columns of the Gold audit.
AUDIT_ORDER = [
    "execution_utc", "gold_name", "target_col", "input_rows", "output_rows", "dropped_rows", "pct_rows_dropped",
    "null_target_rows", "duplicate_ssn", "invalid_target_rows", "spectral_cols", "final_path", "final_file_size",
    "status", "error_message",
]


def run_stamp(now: datetime | None = None) -> str:
    """UTC time of a run, taken once and handed to the jobs."""
    return (now or datetime.now(timezone.utc)).astimezone(timezone.utc).strftime("%Y-%m-%d-%H-%M")


@dataclass
class Lake:
    """Where the layers lie."""

    root: str

    def path(self, *parts: str) -> str:
        return "/".join([self.root.rstrip("/"), *parts])


def run_bronze(spark: SparkSession, lake: Lake, source_root: str, run_ts: str, prefixes: list[str] = PREFIXES) -> DataFrame:
    """Copies the configured prefixes and returns the counters; the audit goes to the reports."""
    source = object_manifest(spark, source_root, prefixes)
    before = object_manifest(spark, lake.root, [f"bronze/{p}" for p in prefixes])
    run = {"execution_utc": run_ts, "source_bucket": source_root, "dest_bucket": lake.root}
    audit = copy_objects(source, before, source_root, lake.root, prefixes, "bronze/", run)
    write_report(audit, lake.path("validations", "bronze"), run_ts)
    return copy_counters(audit)


def run_silver(spark: SparkSession, lake: Lake, decoder: Decoder, run_ts: str) -> DataFrame:
    """Builds Silver from the copied objects and returns its metrics."""
    bronze = lake.path("bronze")
    found = require_keys(keys_by_suffix(object_manifest(spark, bronze), list(LAB_FILES.values())))
    labs = {n: read_lab_csv(spark, f"{bronze}/{found[file]}", n) for n, file in LAB_FILES.items()}
    # decoding is the costly part, so its result is written once; from there the spectra move once,
    # to the join
    decoded = materialise(decode(scan_spectra(spark, bronze), decoder), "decoded")
    write_report(decode_status(decoded), lake.path("validations", "spectra"), run_ts)
    spectra = require_spectra(spectra_base(decoded, written=True))
    path, used = write_silver(silver_master(with_lab_row(spectra, labs), labs), lake.path("silver"))
    if used != "parquet":
        raise RuntimeError(f"Silver was saved as CSV below {path}; metrics need the Parquet table")
    silver = spark.read.parquet(path)
    tables = {Q.SPECTRA: spectra, Q.CROPNUTS: labs["cropnuts"], Q.ICRAF: labs["icraf"], Q.RRES: labs["rres"]}
    metrics = materialise(Q.silver_metrics(tables, silver), "silver-metrics")
    write_report(metrics.select("metric_name", "metric_value"), lake.path("validations", "silver"), run_ts)
    return metrics


def run_gold(spark: SparkSession, lake: Lake, run_ts: str, points: int | None = None) -> DataFrame:
    """Writes the Gold table of every target Silver has and returns the audit. Spectra are read once."""
    silver = spark.read.parquet(lake.path("silver"))
    if "spectrum" not in silver.columns:
        silver = narrow(silver)
    points = spectral_points(silver) if points is None else points
    path = write_gold(gold_tidy(silver, points), lake.path("gold"), replace_all=True)
    sizes = output_size(spark, path).select(F.col("target").alias("gold_name"), F.col("bytes").alias("final_file_size"))
    audit = audit_rows(written_counts(silver, read_gold(spark, path)), points).join(sizes, "gold_name", "left")
    done = F.col("status") != FAILED
    final = F.when(done, F.concat(F.lit(f"{path}/target="), "gold_name")).otherwise("")
    audit = audit.withColumns(
        {
            "execution_utc": F.lit(run_ts),
            "final_path": final,
            "final_file_size": F.coalesce("final_file_size", F.lit(0)),
        }
    )
    audit = materialise(audit.select(*AUDIT_ORDER), "gold-audit")
    write_report(audit, lake.path("validations", "gold"), run_ts)
    return audit


def run_models(spark: SparkSession, lake: Lake, run_ts: str, points: int, options: Options | None = None) -> Evaluation:
    """Compares the models on the Gold tables, writes the results per target and the models."""
    options = options or Options(log_targets=("p",))
    gold = read_gold(spark, lake.path("gold")).filter(F.col("target").isin(list(GOLD_TARGETS)))
    evaluation = evaluate(gold, points, options)
    results = evaluation.results.withColumn("melhores_params", F.to_json("melhores_params"))
    write_report(results, lake.path("results"), run_ts, by=["target"])
    save_models(evaluation, lake.path("models", f"run_ts={run_ts}"))
    return evaluation
