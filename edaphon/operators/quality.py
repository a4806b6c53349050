"""Data-quality metrics as tables, each from one pass."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Target columns of Silver, in metric order.
TARGETS = ["ph", "pct_c", "olsen_p_mg_kg", "ecec_cmolc__kg_soil", "exbas"]

# Name and lower / upper bound of the domain rules.
DOMAIN_RULES = {
    "ph": ("qtd_ph_fora_faixa_0_14", 0.0, 14.0),
    "pct_c": ("qtd_pct_c_negativo", 0.0, None),
    "olsen_p_mg_kg": ("qtd_olsen_p_mg_kg_negativo", 0.0, None),
    "ecec_cmolc__kg_soil": ("qtd_ecec_cmolc__kg_soil_negativo", 0.0, None),
    "exbas": ("qtd_exbas_negativo", 0.0, None),
}

# The tables as the metric names call them.
SPECTRA, CROPNUTS, ICRAF, RRES, SILVER = "bronze_espectro", "wet_cropnuts", "wet_icraf", "wet_rres", "silver_final"
LABS = [CROPNUTS, ICRAF, RRES]

# The other metric names; braces stand for a table or a column.
ROWS, NULL_KEYS, REPEATED_KEYS = "qtd_linhas_{}", "qtd_ssn_nulo_{}", "qtd_ssn_duplicado_{}"
UNIQUE_WET, UNIQUE_SPECTRA = "qtd_ssn_unicos_wet_unificado", "qtd_ssn_unicos_espectro"
MATCHED, WET_ONLY, SPECTRA_ONLY = "qtd_wet_com_match_espectro", "qtd_wet_sem_espectro", "qtd_espectro_sem_wet"
COVERAGE = "pct_cobertura_wet_com_espectro"
FILLED, MISSING = "qtd_preenchido_{}", "qtd_nulo_{}"
SILVER_COLUMNS, SPECTRAL_COLUMNS = "qtd_colunas_silver_final", "qtd_colunas_espectrais_wn"


def outside_domain(target: str, value: Column) -> Column:
    """True outside the bounds; NaN sorts above every bound and is outside an upper one."""
    _, low, high = DOMAIN_RULES[target]
    bad = value < low
    return bad | (value > high) if high is not None else bad


def percent(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, F.round((part / whole) * 100, 2)).otherwise(F.lit(0.0))


def key_census(tables: dict[str, DataFrame], key: str = "SSN") -> DataFrame:
    """One row per key with its number of rows in each table, NULL key included.

    Counts are added up before the shuffle, so replicated keys cost nothing extra; every metric on
    keys is a sum over this table.
    """
    tagged = [t.select(F.col(key).alias("key"), F.lit(n).alias("table")) for n, t in tables.items()]
    rows = reduce(DataFrame.unionByName, tagged)
    return rows.groupBy("key").agg(*[F.count_if(F.col("table") == n).alias(n) for n in tables])


def key_metrics(census: DataFrame, tables: list[str]) -> DataFrame:
    """Rows, NULL keys, repeated keys and coverage in one row of named values."""
    known = F.col("key").isNotNull()
    exprs = []
    for t in tables:
        exprs.append(F.coalesce(F.sum(t), F.lit(0)).alias(ROWS.format(t)))
        exprs.append(F.coalesce(F.sum(F.when(~known, F.col(t))), F.lit(0)).alias(NULL_KEYS.format(t)))
        exprs.append(F.count_if(known & (F.col(t) > 1)).alias(REPEATED_KEYS.format(t)))
    if SPECTRA in tables:
        labs = [t for t in LABS if t in tables]
        in_lab = known & reduce(lambda a, b: a | b, [F.col(t) > 0 for t in labs])
        scanned = F.col(SPECTRA) > 0
        exprs += [
            F.count_if(in_lab).alias(UNIQUE_WET),
            F.count_if(known & scanned).alias(UNIQUE_SPECTRA),
            F.count_if(in_lab & scanned).alias(MATCHED),
            F.count_if(in_lab & ~scanned).alias(WET_ONLY),
            F.count_if(scanned & ~in_lab).alias(SPECTRA_ONLY),
        ]
    row = census.agg(*exprs)
    if SPECTRA in tables:
        covered = percent(F.col(MATCHED), F.col(UNIQUE_WET))
        row = row.withColumn(COVERAGE, covered)
    return row


def target_aggregates(columns: list[str]) -> list[Column]:
    """Filled, NULL and out-of-domain counts of the targets present."""
    exprs = []
    for t in [t for t in TARGETS if t in columns]:
        value = F.col(t)
        exprs += [
            F.count(value).alias(FILLED.format(t)),
            F.count_if(value.isNull()).alias(MISSING.format(t)),
            F.count_if(outside_domain(t, value)).alias(DOMAIN_RULES[t][0]),
        ]
    return exprs


def spectral_aggregates(first: int = 10) -> list[Column]:
    """Number of spectral columns and the NULL count of the first ones."""
    points = F.coalesce(F.max(F.array_size("spectrum")), F.lit(0))
    nulls = [F.count_if(F.get("spectrum", F.lit(i)).isNull()).alias(MISSING.format(f"wn_{i}")) for i in range(first)]
    return [points.alias(SPECTRAL_COLUMNS), *nulls]


def as_rows(metrics: DataFrame) -> DataFrame:
    """A row of named values → ``(metric_name, metric_value, numeric_value)``."""
    pairs = [
        F.struct(
            F.lit(c).alias("metric_name"),
            F.col(c).cast("string").alias("metric_value"),
            F.col(c).cast("double").alias("numeric_value"),
        )
        for c in metrics.columns
    ]
    return metrics.select(F.inline(F.array(*pairs)))


def silver_metrics(tables: dict[str, DataFrame], silver: DataFrame) -> DataFrame:
    """The validation report of Silver: one pass over the keys, one over Silver.

    ``tables`` holds the spectra and the laboratories under their metric names. Give ``silver``
    as a written table, it is read for its keys and for its values.
    """
    census = key_census({**tables, SILVER: silver.select(F.col("ssn").alias("SSN"))})
    keys = key_metrics(census, [*tables, SILVER]).drop(NULL_KEYS.format(SILVER))
    others = len([c for c in silver.columns if c != "spectrum"])
    values = silver.agg(*target_aggregates(silver.columns), *spectral_aggregates()).withColumn(
        SILVER_COLUMNS, F.col(SPECTRAL_COLUMNS) + others
    )
    return as_rows(keys).unionByName(as_rows(values))
