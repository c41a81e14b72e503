"""Writing of results. Every run writes below its own folder, one sub-folder per table and check."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from twincheck.functions.comparability import as_text
from twincheck.functions.sqltext import alias, array, literal, quote, struct
from twincheck.operators.compare import (
    MATCHED,
    MATCHES,
    SOURCE,
    SOURCE_ROWS,
    STATUS,
    TARGET,
    TARGET_ROWS,
    RowComparison,
)

# CSV layout and compression names of exported files.
CSV_OPTIONS = {
    "header": True,
    "quoteAll": True,
    "encoding": "UTF-8",
    "escape": '"',
    # The writer trims by default, which would hide padding differences.
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}
COMPRESSIONS = ["none", "gzip"]
RUN_TIME_FORMAT = "%Y%m%d_%H_%M_%S_%f"

# Partition columns of difference exports; data columns carry a side suffix or are keys, so they rarely clash.
PARTITIONS = ["diff_table", "diff_check", "diff_status"]


def run_id(now: datetime | None = None) -> str:
    """Name of a run: its start in UTC."""
    return (now or datetime.now(timezone.utc)).strftime(RUN_TIME_FORMAT)


def export_csv(df: DataFrame, folder: str, *, compression: str = "none", single_file: bool = False) -> None:
    """Quoted UTF-8 CSV with header. ``single_file`` funnels all rows through one task; use it on small reports."""
    if compression not in COMPRESSIONS:
        raise ValueError(f"compression must be one of {COMPRESSIONS}")
    rows = df.coalesce(1) if single_file else df
    rows.write.options(**CSV_OPTIONS).option("compression", compression).mode("errorifexists").csv(folder)


def read_export(spark: SparkSession, folder: str) -> DataFrame:
    """An exported folder as text columns, cells with line breaks included."""
    return spark.read.options(**CSV_OPTIONS, multiLine=True).csv(folder)


def flat_differences(comparison: RowComparison, rows: DataFrame | None = None) -> DataFrame:
    """Differing rows as text: status, keys, row counts, and for every column both values and whether they agree."""
    rows = comparison.differences() if rows is None else rows
    pairing = comparison.pairing
    columns = [f"{STATUS} AS diff_status"]
    columns += [alias(as_text(quote(name), kind), name) for name, kind in zip(pairing.keys, pairing.key_types)]
    columns += [f"cast({name} AS string) AS {name}" for name in (SOURCE_ROWS, TARGET_ROWS)]
    for name, other in zip(pairing.columns, pairing.target_columns):
        columns += [
            alias(comparison.value_text(SOURCE, name), f"{name}_source"),
            alias(comparison.value_text(TARGET, other), f"{name}_target"),
            alias(f"cast({MATCHES}.{quote(name)} AS string)", f"{name}_match"),
        ]
    columns += [alias(comparison.value_text(SOURCE, name), f"{name}_source") for name in pairing.source_extra]
    columns += [alias(comparison.value_text(TARGET, name), f"{name}_target") for name in pairing.target_extra]
    return rows.selectExpr(*columns)


def save_differences(comparison: RowComparison, folder: str) -> tuple[RowComparison, dict[str, int]]:
    """The comparison with its differing rows written below ``folder``, and the metrics of all rows, in one job.

    The metrics are observed while the rows pass to the writer, so neither a second pass nor a cache is needed. They
    are collected in the last stage, where a task that is run again counts once.
    """
    observation = Observation()
    observed = comparison.rows.observe(observation, *comparison.metric_columns())
    differing = observed.where(f"{STATUS} <> {literal(MATCHED)}")
    differing.write.parquet(folder)
    saved = comparison.rows.sparkSession.read.schema(differing.schema).parquet(folder)
    return RowComparison(saved, comparison.pairing), dict(observation.get)


def write_differences(
    comparison: RowComparison, folder: str, *, table: str, check: str, compression: str = "gzip"
) -> None:
    """Write all difference classes of a comparison as CSV, partitioned by table, check and status."""
    if compression not in COMPRESSIONS:
        raise ValueError(f"compression must be one of {COMPRESSIONS}")
    (
        flat_differences(comparison)
        .withColumns({"diff_table": F.lit(table), "diff_check": F.lit(check)})
        .write.options(**CSV_OPTIONS)
        .option("compression", compression)
        .partitionBy(*PARTITIONS)
        .mode("append")
        .csv(folder)
    )


def export_differences(
    comparison: RowComparison, folder: str, *, table: str, check: str, compression: str = "gzip"
) -> dict[str, int]:
    """Write all difference classes in one job, partitioned by table, check and status; return the observed metrics."""
    observation = Observation()
    observed = comparison.rows.observe(observation, *comparison.metric_columns())
    write_differences(
        RowComparison(observed, comparison.pairing), folder, table=table, check=check, compression=compression
    )
    return dict(observation.get)


def export_pair_differences(comparison: RowComparison, folder: str, pairs: DataFrame, *, key: str) -> None:
    """Write the differences of many pairs in one job, partitioned by pair, table, check and status.

    ``key`` is the key that tells the pair; ``pairs`` (diff_pair, diff_table) are those to write.
    """
    flat = flat_differences(comparison).withColumnRenamed(key, "diff_pair").join(pairs, "diff_pair")
    (
        flat.withColumn("diff_check", F.lit("file"))
        .write.options(**CSV_OPTIONS)
        .partitionBy("diff_pair", *PARTITIONS)
        .mode("append")
        .csv(folder)
    )


def metric_rows(metrics: DataFrame, *, table: str, check: str) -> DataFrame:
    """A one-row metrics frame in long form: ``table_name, check_name, metric, value``."""
    cells = [
        struct({"metric": literal(name), "value": f"cast({quote(name)} AS string)"}) for name in metrics.columns
    ]
    return metrics.selectExpr(f"explode({array(cells)}) AS cell").selectExpr(
        f"{literal(table)} AS table_name", f"{literal(check)} AS check_name", "cell.metric", "cell.value"
    )
