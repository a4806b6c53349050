"""Spectra from measurement files: key filter, decoding on the executors, one row per sample."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from edaphon.functions.keys import blank_to_null, file_name, sample_id, sample_key
from edaphon.operators.dedup import first_per_key, without_repeats
from edaphon.sources.manifest import object_manifest
from edaphon.sources.objects import read_objects

# Where the spectra lie and how their files end.
SPECTRA_FOLDER = "Bruker_Alpha_KBr/"
SPECTRA_PATTERN = r"\.0$"

Decoder = Callable[[bytes], Sequence[float] | None]
DECODED = "source string, spectrum array<double>, decode_status string, error_message string"


def is_spectrum_key(key: Column, folder: str = SPECTRA_FOLDER, pattern: str = SPECTRA_PATTERN) -> Column:
    return key.contains(folder) & key.rlike(pattern) & ~key.endswith("/")


def text_decoder(content: bytes) -> list[float] | None:
    """``AB:`` and comma-separated intensities; no ``AB`` block, no spectrum."""
    text = content.decode("utf-8")
    if not text.startswith("AB:"):
        return None
    return [float(v) for v in text[3:].split(",")]


def scan_spectra(spark: SparkSession, root: str, folder: str = SPECTRA_FOLDER, pattern: str = SPECTRA_PATTERN) -> DataFrame:
    """``(source, content)`` of the spectral files below ``root``, empty ones included.

    The listing is filtered before a file is opened, and what is left is dealt to tasks by bytes."""
    path = F.concat(F.lit(f"{root.rstrip('/')}/"), "key")
    wanted = object_manifest(spark, root).filter(is_spectrum_key(path, folder, pattern))
    return read_objects(spark, root, wanted).select("source", "content")


def decode(files: DataFrame, decoder: Decoder = text_decoder) -> DataFrame:
    """``(source, content)`` → ``(source, spectrum, decode_status, error_message)``.

    A file that cannot be decoded yields a row with a status, never a failed task.
    """

    def one(content: bytes):
        try:
            spectrum = decoder(content)
            if spectrum is None:
                return None, "no_spectrum", None
            values = np.asarray(spectrum, dtype=float)
            if values.ndim != 1:
                raise ValueError(f"a spectrum has one dimension, not {values.ndim}")
        except Exception as error:  # noqa: BLE001 - any decoder failure becomes a status
            return None, "error", f"{type(error).__name__}: {error}"
        return values, "ok", None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            results = [one(content.as_py()) for content in batch.column("content")]
            columns = [
                batch.column("source"),
                # Arrow keeps a NaN apart from a missing value, pandas would not
                pa.array([r[0] for r in results], pa.list_(pa.float64()), from_pandas=False),
                pa.array([r[1] for r in results], pa.string()),
                pa.array([r[2] for r in results], pa.string()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["source", "spectrum", "decode_status", "error_message"])

    return files.select("source", "content").mapInArrow(run, DECODED)


def spectra_base(decoded: DataFrame, written: bool = False) -> DataFrame:
    """One row per sample key: the decodable file with the lowest path. Say if ``decoded`` is a
    written table, it is then read twice to move the spectra less."""
    source = F.col("source")
    rows = decoded.filter(F.col("decode_status") == "ok").select(
        blank_to_null(sample_key(source)).alias("SSN"),
        sample_id(source).alias("sample_id"),
        file_name(source).alias("file_name"),
        source,
        "spectrum",
    )
    if written:
        return without_repeats(rows, ["SSN"], "source")
    return first_per_key(rows, ["SSN"], ["source"])


def decode_status(decoded: DataFrame) -> DataFrame:
    return decoded.groupBy("decode_status").agg(F.count("*").alias("files"))


def require_spectra(base: DataFrame) -> DataFrame:
    """Raises when not one spectrum was decoded; reads a single row."""
    if base.select("SSN").isEmpty():
        raise ValueError("no spectrum was decoded")
    return base
