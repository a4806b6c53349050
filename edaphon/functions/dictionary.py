"""Column comments."""

from __future__ import annotations

from pyspark.sql import DataFrame

# The data dictionary.
COMMENTS = {
    "ssn": "Identifier of the soil sample",
    "ph": "Soil acidity or alkalinity",
    "pct_c": "Carbon, percent of the soil",
    "olsen_p_mg_kg": "Olsen phosphorus, mg/kg",
    "ecec_cmolc__kg_soil": "Effective cation exchange capacity, cmolc/kg",
    "exbas": "Exchangeable bases",
    "spectrum": "Spectral intensities by position; element i is wn_i of the wide form",
}


def with_comments(df: DataFrame) -> DataFrame:
    """Comments on the columns that have one; they are written with the table."""
    for field in df.schema.fields:
        if field.name in COMMENTS:
            df = df.withMetadata(field.name, {**field.metadata, "comment": COMMENTS[field.name]})
    return df
