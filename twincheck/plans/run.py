"""A run over all active pairs of a configuration."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from twincheck.functions.sqltext import quote
from twincheck.operators.catalog import catalog_of, reader_schemas
from twincheck.operators.compare import DIFFERENT, ONLY_SOURCE, ONLY_TARGET, SOURCE, STATUS, TARGET
from twincheck.plans.drop import FILE_REPORT_SCHEMA, file_report, validate_drop
from twincheck.plans.pair import (
    ALL_CHECKS,
    FILES,
    STATUS_COLUMNS,
    SUMMARY_COLUMNS,
    PairChecks,
    check_report,
    plan_pair,
    select_checks,
    summarize,
)
from twincheck.plans.parallel import run_each
from twincheck.session import scratch_folder
from twincheck.sinks.exports import (
    export_csv,
    export_differences,
    metric_rows,
    run_id,
    save_differences,
    write_differences,
)
from twincheck.sources.config import ConfigError, PairSpec, active_rows, pair_from_row, parse_config
from twincheck.sources.tables import TableSpec
from twincheck.verdict import UNKNOWN

ERROR_COLUMN = "ERROR"
SUMMARY_SCHEMA = ", ".join(f"{name} string" for name in [*SUMMARY_COLUMNS, ERROR_COLUMN])
# (table name, column list, filter text, reader schema or None) -> DataFrame
Loader = Callable[[str, str, str, "str | None"], DataFrame]
# (table name, filter text) -> one-row DataFrame with the row count
Counter = Callable[[str, str], DataFrame]
Catalog = DataFrame | Callable[[str], DataFrame]


@dataclass(frozen=True)
class Systems:
    """How the tables of both sides are read, and their column catalogs if they have any.

    Catalogs give the columns of a table in the common catalog layout, as one frame for all tables or as a function of
    the full table name. For tables they fix the reader schema; without them Spark's own schema of the loaded table
    takes their place. Counters let the systems count rows themselves. With a ``staging`` folder, which all executors
    must reach, every table is read from its system once and kept there for all checks.
    """

    load_source: Loader
    load_target: Loader
    source_catalog: Catalog | None = None
    target_catalog: Catalog | None = None
    count_source: Counter | None = None
    count_target: Counter | None = None
    staging: str | None = None


@dataclass(frozen=True)
class FileDrop:
    """The folder into which extracts of the tables are dropped, and the ledger of those that earlier runs compared.

    A pair's extracts bear the name of one of its tables, with the schema or without, in any case.
    """

    folder: str
    ledger: str
    parallel: int = 1


def _split_name(table: str) -> tuple[str, str]:
    schema, _, name = table.rpartition(".")
    return schema, name


def _of_table(catalog: Catalog | None, table: str) -> DataFrame | None:
    if catalog is None:
        return None
    if not isinstance(catalog, DataFrame):
        return catalog(table)
    schema, name = _split_name(table)
    return catalog.where((F.upper("SCHEMA_NAME") == schema.upper()) & (F.upper("TABLE_NAME") == name.upper()))


def _staged(df: DataFrame, folder: str) -> DataFrame:
    df.write.parquet(folder)
    return df.sparkSession.read.parquet(folder)


def _reader_schema(catalog: DataFrame | None, spec: PairSpec, columns: str) -> str | None:
    """DDL of one table; a type without a Spark equivalent is an error instead of a silently missing column."""
    if catalog is None or spec.object_type != "TABLE":
        return None
    if columns.strip() != "*":
        catalog = catalog.where(F.upper("COLUMN_NAME").isin([c.strip().upper() for c in columns.split(",")]))
    found = reader_schemas(catalog).head()
    if found is None:
        return None
    if found["unmapped_columns"]:
        raise ConfigError(f"no Spark type for columns {found['unmapped_columns']}")
    return found["ddl"]


def plan_from_systems(
    spark: SparkSession,
    systems: Systems,
    spec: PairSpec,
    checks: Iterable[str] = (ALL_CHECKS,),
    **options,
) -> PairChecks:
    """Load both tables of a pair and plan its checks; ``options`` are those of :func:`plan_pair`."""
    source_catalog = _of_table(systems.source_catalog, spec.source_table)
    target_catalog = _of_table(systems.target_catalog, spec.target_table)
    source_schema = _reader_schema(source_catalog, spec, spec.source_columns)
    target_schema = _reader_schema(target_catalog, spec, spec.target_columns)
    source = systems.load_source(spec.source_table, spec.source_columns, spec.source_filter, source_schema)
    target = systems.load_target(spec.target_table, spec.target_columns, spec.target_filter, target_schema)
    if systems.staging is not None:
        source, target = (_staged(side, f"{systems.staging}/{uuid4().hex}") for side in (source, target))
    elif systems.count_source and systems.count_target:
        options["counts"] = (
            systems.count_source(spec.source_table, spec.source_filter),
            systems.count_target(spec.target_table, spec.target_filter),
        )
    if source_catalog is None:
        source_catalog = catalog_of(spark, source, *_split_name(spec.source_table))
    if target_catalog is None:
        target_catalog = catalog_of(spark, target, *_split_name(spec.target_table))
    return plan_pair(source, target, spec, checks, catalogs=(source_catalog, target_catalog), **options)


def export_pair(
    checks: PairChecks, folder: str, *, compression: str = "gzip", sample_size: int = 10
) -> dict[str, dict[str, int]]:
    """Write every difference class, the first ``sample_size`` rows of each, the aggregate details, the metrics and the
    other selected checks of one pair below ``folder``.

    Returns the observed metrics of the row comparisons, so the summary needs no second pass. Differing rows are written
    once and read again for export and samples, aggregates and frequencies come from one written profile: both sides are
    read twice, whatever is selected of these.
    """
    table = checks.spec.target_table
    observed = {}
    differing = None
    for check, comparison in (("data_type", checks.types), ("content", checks.content)):
        if comparison is None:
            continue
        spark = comparison.rows.sparkSession
        target_folder = f"{folder}/differences/{check}"
        if check == "content" and sample_size and _writable(comparison.rows.schema):
            differing, observed[check] = save_differences(comparison, scratch_folder(spark, "differences"))
            write_differences(differing, target_folder, table=table, check=check, compression=compression)
        else:
            observed[check] = export_differences(
                comparison, target_folder, table=table, check=check, compression=compression
            )
        # Column mismatch counts are named after their column in the report.
        names = {f"_mismatched_{i}": f"mismatched {name}" for i, name in enumerate(comparison.pairing.columns)}
        named = {names.get(metric, metric): value for metric, value in observed[check].items()}
        reported = metric_rows(_one_row(spark, named), table=table, check=check)
        if check == "content":
            spec = checks.spec
            sql = [
                ("source_query", TableSpec(spec.source_table, spec.source_columns, spec.source_filter).query),
                ("target_query", TableSpec(spec.target_table, spec.target_columns, spec.target_filter).query),
            ]
            texts = [(table, check, name, text) for name, text in sql]
            reported = reported.unionAll(spark.createDataFrame(texts, reported.schema))
        export_csv(reported, f"{folder}/metrics/{table}/{check}", single_file=True)
    if checks.content is not None and sample_size:
        statuses = [DIFFERENT, ONLY_SOURCE, ONLY_TARGET]
        sample = (differing or checks.content).sample(sample_size, statuses=statuses)
        flat = sample.selectExpr(
            f"{STATUS} AS diff_status",
            "sample_number",
            *[quote(key) for key in checks.content.pairing.keys],
            f"to_json({SOURCE}) AS source_row",
            f"to_json({TARGET}) AS target_row",
        )
        export_csv(flat, f"{folder}/samples/{table}", single_file=True)
    export_csv(check_report(checks), f"{folder}/checks/{table}", single_file=True)
    if checks.future is not None:
        export_csv(checks.future.common(), f"{folder}/future_dates/{table}", single_file=True)
    if checks.loads is not None:
        export_csv(checks.loads, f"{folder}/loads/{table}", single_file=True)
    for name, compared in checks.business:
        export_csv(metric_rows(compared.metrics(), table=table, check=name), f"{folder}/business/{name}", single_file=True)
    if checks.aggregates is not None:
        export_csv(checks.aggregates, f"{folder}/aggregates/{table}", single_file=True)
    if checks.frequencies is not None:
        uneven = checks.frequencies.where("status <> 'match'")
        export_csv(uneven, f"{folder}/frequencies/{table}", compression=compression)
    return observed


def _writable(schema: T.StructType) -> bool:
    """Whether Parquet can hold all types."""
    text = schema.simpleString()
    return not any(kind in text for kind in ("void", "interval"))


def _one_row(spark: SparkSession, values: dict[str, int]) -> DataFrame:
    schema = T.StructType([T.StructField(name, T.LongType()) for name in values])
    return spark.createDataFrame([tuple(values.values())], schema)


def _failed(spec: PairSpec, error: Exception) -> dict[str, str]:
    row = dict.fromkeys([*SUMMARY_COLUMNS, ERROR_COLUMN], "")
    row |= dict.fromkeys(["STATUS", *STATUS_COLUMNS], UNKNOWN)
    row |= {
        "SOURCE_TABLE": spec.source_table,
        "TARGET_TABLE": spec.target_table,
        "SOURCE_FILTER": spec.source_filter,
        "TARGET_FILTER": spec.target_filter,
        ERROR_COLUMN: f"{type(error).__name__}: {error}",
    }
    return row


def run_pair(
    spec: PairSpec, plan: Callable[[PairSpec], PairChecks], folder: str | None = None
) -> dict[str, str]:
    """Run one pair to its summary row. A failure becomes an UNKNOWN row with the error text; other pairs go on."""
    start = time.monotonic()
    try:
        checks = plan(spec).saved()
        metrics = None
        if folder is not None:
            observed = export_pair(checks, folder)
            if "content" in observed:
                metrics = _one_row(checks.content.rows.sparkSession, observed["content"])
        row = summarize(checks, metrics).first().asDict() | {ERROR_COLUMN: ""}
    except Exception as error:  # any failure belongs to this pair alone
        row = _failed(spec, error)
    row["VALIDATION_TIME"] = f"{time.monotonic() - start:.3f}"
    return row


def run_pairs(
    spark: SparkSession,
    specs: Sequence[PairSpec],
    plan: Callable[[PairSpec], PairChecks],
    *,
    folder: str | None = None,
    parallel: int = 1,
) -> DataFrame:
    """Summary of all pairs. ``parallel`` pairs are submitted at a time; Spark interleaves their jobs."""

    def one(numbered: tuple[int, PairSpec]) -> dict[str, str]:
        # A run may hold the same table twice, with different filters; every pair writes to a folder of its own.
        number, spec = numbered
        return run_pair(spec, plan, None if folder is None else f"{folder}/pair_{number:05d}")

    rows = run_each(spark, one, enumerate(specs, start=1), parallel)
    return spark.createDataFrame([tuple(r[n] for n in [*SUMMARY_COLUMNS, ERROR_COLUMN]) for r in rows], SUMMARY_SCHEMA)


def compare_files(spark: SparkSession, drop: FileDrop, output: str) -> DataFrame:
    """Compare all new pairs of files once, for every table of a run; the report is written and read again.

    A drop folder that cannot be read is reported to every table (no stem), and stops none of their other checks.
    """
    try:
        found = validate_drop(spark, drop.folder, output, drop.ledger, parallel=drop.parallel)
        report = file_report(*found)
        written = scratch_folder(spark, "file-report")
        report.write.parquet(written)
    except Exception as error:  # the tables can still be compared
        rows = [(None, drop.folder, UNKNOWN, f"{type(error).__name__}: {error}")]
        return spark.createDataFrame(rows, FILE_REPORT_SCHEMA)
    return spark.read.schema(FILE_REPORT_SCHEMA).parquet(written)


def run_config(
    spark: SparkSession,
    config: DataFrame,
    systems: Systems,
    checks: Iterable[str] | str = ALL_CHECKS,
    *,
    folder: str | None = None,
    parallel: int = 1,
    drop: FileDrop | None = None,
    **options,
) -> DataFrame:
    """Validate every active row of a configuration; with ``folder``, write all results and the configuration there.

    With ``drop`` the check of files compares what lies there, once for all tables; its differences, its summary and the
    unpaired files go below ``files``. ``options`` are those of :func:`plan_pair`.
    """
    started = run_id()
    selected = select_checks(checks)
    if drop is not None and FILES in selected:
        output = scratch_folder(spark, "files") if folder is None else f"{folder}/files"
        options["files"] = compare_files(spark, drop, output)
    parsed = parse_config(active_rows(config))
    specs, broken = [], []
    for row in parsed.toLocalIterator():
        try:
            specs.append(pair_from_row(row))
        except ConfigError as error:
            broken.append(_failed(PairSpec(row["SOURCE_TABLE"], row["TARGET_TABLE"]), error))

    def plan(spec: PairSpec) -> PairChecks:
        return plan_from_systems(spark, systems, spec, selected, **options)

    summary = run_pairs(spark, specs, plan, folder=folder, parallel=parallel)
    if broken:
        rows = [tuple(r[n] for n in [*SUMMARY_COLUMNS, ERROR_COLUMN]) for r in broken]
        summary = summary.unionAll(spark.createDataFrame(rows, SUMMARY_SCHEMA))
    if folder is not None:
        header = [
            ("started", started),
            ("finished", run_id()),
            ("checks", ", ".join(sorted(selected))),
            ("pairs", str(len(specs) + len(broken))),
            ("output", folder),
        ]
        export_csv(spark.createDataFrame(header, "item string, value string"), f"{folder}/run", single_file=True)
        export_csv(summary, f"{folder}/summary", single_file=True)
        export_csv(config, f"{folder}/config", single_file=True)
    return summary
