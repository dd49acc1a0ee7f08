"""Run logs: which training run does a logged run folder belong to?"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chatloom.sources.readers import _list

# Log folder prefix and the setting that names the run.
FOLDER_PREFIX = "offline-run-"
RUN_NAME_PATTERN = r"'run_name':[^\S\r\n]*'([^'\r\n]+)'"


def run_name(log_text: Column) -> Column:
    """The first ``'run_name': '...'`` of a log text; NULL without one."""
    name = F.regexp_extract(log_text, RUN_NAME_PATTERN, 1)
    return F.when(name != "", name)


def map_runs(logs: DataFrame, outputs: DataFrame) -> DataFrame:
    """Join log folders to output folders by run name.

    *logs* has ``folder`` and ``log_text``, *outputs* has ``run_name`` and ``output_dir``, one
    row per run. Folders with another prefix or without a run name are dropped.
    """
    named = (
        logs.where(F.startswith("folder", F.lit(FOLDER_PREFIX)))
        .select(
            F.col("folder"),
            F.substring_index("folder", "-", -1).alias("run_id"),
            run_name(F.col("log_text")).alias("run_name"),
        )
        .where(F.col("run_name").isNotNull())
    )
    return (
        named.join(outputs.select("run_name", "output_dir"), "run_name", "left")
        .select(
            "folder",
            "run_id",
            "run_name",
            "output_dir",
            F.col("output_dir").isNotNull().alias("output_exists"),
        )
        .orderBy("folder")
    )


def read_run_map(spark: SparkSession, logs_dir: str, outputs_dir: str) -> DataFrame:
    """:func:`map_runs` on directories: ``logs_dir/offline-run-*/logs/debug.log``."""
    pattern = f"{logs_dir}/{FOLDER_PREFIX}*/logs/debug.log"
    outputs = spark.createDataFrame(
        [(path.rstrip("/").rsplit("/", 1)[-1], path) for path, _ in _list(spark, f"{outputs_dir}/*")],
        "run_name string, output_dir string",
    )
    if not _list(spark, pattern):
        return map_runs(spark.createDataFrame([], "folder string, log_text string"), outputs)
    logs = spark.read.text(pattern, wholetext=True).select(
        F.element_at(F.split("_metadata.file_path", "/"), -3).alias("folder"),
        F.col("value").alias("log_text"),
    )
    return map_runs(logs, outputs)
