"""Sample keys, column names, object paths."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# What a sample key starts with, and the replacements of the naming rule, in order.
KEY_PREFIX = "icr"
RENAMES = (("%", "pct_"), ("/", "_"), (" ", "_"))
DROPPED = "[^a-z0-9_]"


def blank_to_null(key: Column) -> Column:
    """A key of blanks only becomes NULL; any other key keeps its blanks."""
    return F.when(F.trim(key) != "", key)


def with_clean_key(df: DataFrame, table: str, key: str = "SSN") -> DataFrame:
    if key not in df.columns:
        raise KeyError(f"table {table!r} has no key column {key!r}")
    return df.withColumn(key, blank_to_null(F.col(key)))


def file_name(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]*)/*$", 1)


def file_stem(name: Column) -> Column:
    """Name without its last suffix; a leading or a trailing dot starts no suffix."""
    return F.regexp_replace(name, r"(?s)^(.+)\.[^.]+$", "$1")


def strip(text: Column) -> Column:
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def sample_id(path: Column) -> Column:
    """``…/icr005928.0`` → ``005928``."""
    bare = F.replace(strip(file_stem(file_name(path))), F.lit(KEY_PREFIX), F.lit(""))
    return strip(bare)


def sample_key(path: Column) -> Column:
    return F.concat(F.lit(KEY_PREFIX), sample_id(path))


def uri_bucket(uri: Column) -> Column:
    return F.regexp_extract(uri, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)


def uri_key(uri: Column) -> Column:
    """Path of the URI without leading slashes, query and fragment."""
    return F.regexp_extract(uri, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*/*([^?#]*)", 1)


def snake_name(name: str) -> str:
    """The naming rule for table columns, applied to a schema."""
    text = name.strip().lower()
    for old, new in RENAMES:
        text = text.replace(old, new)
    return re.sub(DROPPED, "", text)


def snake_name_of(name: Column) -> Column:
    """The same rule for names that are data."""
    text = F.lower(strip(name))
    for old, new in RENAMES:
        text = F.replace(text, F.lit(old), F.lit(new))
    return F.regexp_replace(text, DROPPED, "")


def with_snake_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[snake_name(c) for c in df.columns])
