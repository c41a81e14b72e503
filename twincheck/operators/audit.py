"""Checks around a migration: load audit, date ranges, and business queries run on both sides."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from twincheck.functions.columns import resolve_names
from twincheck.functions.comparability import EXACT, Tolerance
from twincheck.functions.sqltext import array, literal, quote, struct
from twincheck.operators.compare import RowComparison, compare_rows

# Status of a finished load, and the audit columns reported for it.
SUCCESS = "SUCCESS"
AUDIT_COLUMNS = ["source_table_name", "start_time", "load_count", "load_type", "extract_query"]


def successful_loads(audit: DataFrame, inventory: DataFrame, workflow: str) -> DataFrame:
    """Audit rows of successful loads whose job belongs to ``workflow``."""
    jobs = inventory.where(f"wf_name = {literal(workflow)}").select("job_name")
    done = audit.where(f"status = {literal(SUCCESS)}")
    return done.join(jobs, "job_name", "left_semi").select(*AUDIT_COLUMNS)


def date_columns(df: DataFrame) -> list[str]:
    dated = (T.DateType, T.TimestampType, T.TimestampNTZType)
    return [field.name for field in df.schema.fields if isinstance(field.dataType, dated)]


def future_dates(
    df: DataFrame,
    cutoff: str,
    columns: Sequence[str] | None = None,
    *,
    lowest: str = "0001-01-01",
    highest: str = "9999-12-31",
) -> DataFrame:
    """Per date column: rows that are NULL, normal, later than ``cutoff``, or outside the range of the target.

    The three dated classes are disjoint. The cutoff is given by the caller, so the result does not depend on today.
    """
    names = resolve_names(df, columns) if columns is not None else date_columns(df)
    if not names:
        raise ValueError("the table has no date column")

    def counts(name: str) -> str:
        day = f"cast({quote(name)} AS date)"
        outside = f"({day} < DATE {literal(lowest)} OR {day} > DATE {literal(highest)})"
        late = f"{day} > DATE {literal(cutoff)}"
        return struct(
            {
                "column_name": literal(name),
                "null_rows": f"count_if({day} IS NULL)",
                "normal_rows": f"count_if(NOT {outside} AND NOT {late})",
                "future_rows": f"count_if(NOT {outside} AND {late})",
                "out_of_range_rows": f"count_if({outside})",
                "latest_date": f"cast(max({day}) AS string)",
            }
        )

    return (
        df.selectExpr(f"{array(map(counts, names))} AS cells").selectExpr("explode(cells) AS cell").selectExpr("cell.*")
    )


def compare_queries(
    spark: SparkSession,
    source_query: str,
    target_query: str,
    keys: Sequence[str],
    *,
    tables: Mapping[str, DataFrame] | None = None,
    tolerance: Tolerance = EXACT,
) -> RowComparison:
    """Run one query per side and compare the results on ``keys``. Queries name given ``tables`` as ``{name}``."""
    frames = dict(tables or {})
    return compare_rows(
        spark.sql(source_query, **frames), spark.sql(target_query, **frames), keys, tolerance=tolerance
    )
