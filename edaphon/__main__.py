"""``python -m edaphon bronze|silver|gold|models --lake ROOT …``, with the session Spark is submitted with."""

from __future__ import annotations

import argparse
import logging
import time
from importlib import import_module

from pyspark.sql import SparkSession

from edaphon.plans.evaluate import Options
from edaphon.plans.jobs import PREFIXES, Lake, run_bronze, run_gold, run_models, run_silver, run_stamp

log = logging.getLogger("edaphon")


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="edaphon")
    parser.add_argument("job", choices=["bronze", "silver", "gold", "models"])
    parser.add_argument("--lake", required=True, help="root of the lake")
    parser.add_argument("--source", help="root of the objects to copy (bronze)")
    parser.add_argument("--prefix", action="append", help="prefix to copy, repeatable (bronze)")
    parser.add_argument("--decoder", default="edaphon.sources.spectra:text_decoder", help="module:function (silver)")
    parser.add_argument("--points", type=int, help="values of a spectrum (gold, models)")
    parser.add_argument("--trials", type=int, default=100, help="trials per model and target (models)")
    parser.add_argument("--log-target", action="append", default=None, help="target modelled in logs (models)")
    parser.add_argument("--exact-sizes", action="store_true", help="exact test and fold sizes (models)")
    chosen = parser.parse_args(argv)
    if chosen.job == "bronze" and not chosen.source:
        parser.error("bronze needs --source")
    if chosen.job == "models" and not chosen.points:
        parser.error("models needs --points")
    return chosen


def main(argv: list[str] | None = None) -> None:
    chosen = arguments(argv)
    spark = SparkSession.builder.appName(f"edaphon-{chosen.job}").getOrCreate()
    lake, run_ts, start = Lake(chosen.lake), run_stamp(), time.perf_counter()
    if chosen.job == "bronze":
        shown = run_bronze(spark, lake, chosen.source, run_ts, chosen.prefix or PREFIXES)
    elif chosen.job == "silver":
        module, _, name = chosen.decoder.partition(":")
        shown = run_silver(spark, lake, getattr(import_module(module), name), run_ts)
    elif chosen.job == "gold":
        shown = run_gold(spark, lake, run_ts, chosen.points)
    else:
        n = chosen.trials
        options = Options(
            linear_trials=n, tree_trials=n, network_trials=n, exact_sizes=chosen.exact_sizes,
            log_targets=tuple(chosen.log_target or ("p",)),
        )
        shown = run_models(spark, lake, run_ts, chosen.points, options).results
    shown.show(100, truncate=False)
    log.info("%s took %.2f seconds", chosen.job, time.perf_counter() - start)


if __name__ == "__main__":
    logging.basicConfig(level=logging.INFO)
    main()
