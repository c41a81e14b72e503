"""Ledger of processed files. It replaces moving files away: nothing in the drop folder is touched."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.utils import AnalysisException

# A file that is delivered again under its name differs in length or time, and is a new file.
LEDGER_SCHEMA = "path string, length bigint, modified timestamp, run_id string"


def read_ledger(spark: SparkSession, folder: str) -> DataFrame:
    """Entries so far; a ledger that was never written is empty."""
    try:
        return spark.read.schema(LEDGER_SCHEMA).parquet(folder)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return spark.createDataFrame([], LEDGER_SCHEMA)


def record_processed(spark: SparkSession, folder: str, files: list[tuple], run: str) -> None:
    """Append the files (path, length, modified) of a run's finished pairs, in one file."""
    if files:
        entries = spark.createDataFrame([(*file, run) for file in files], LEDGER_SCHEMA)
        entries.coalesce(1).write.mode("append").parquet(folder)
