"""Session defaults and the shared folder every job writes below."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

#: The folder of a local process without the setting.
_own: list[str] = []


def local_session(cores: str | int = "*", name: str = "edaphon") -> SparkSession:
    """A session for tests and benches; a cluster brings its own."""
    shuffle = os.cpu_count() if cores == "*" else int(cores)
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("EDAPHON_DRIVER_MEMORY", "8g"))
        .config("spark.sql.shuffle.partitions", str(shuffle))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors see: ``spark.checkpoint.dir``.

    Only a local session may do without the setting; it then gets a folder of its own.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    if not _own:  # kept here, since a running session does not take the setting any more
        _own.append(tempfile.mkdtemp(prefix="edaphon-"))
    return _own[0]


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that no other run uses."""
    return f"{shared_dir(spark)}/edaphon/{label}-{uuid.uuid4().hex[:12]}"


def materialise(df, label: str):
    """Write ``df`` once to the shared folder and read it back: lineage ends here and
    a lost executor costs a re-read, not a re-computation."""
    spark = df.sparkSession
    path = fresh_path(spark, label)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
