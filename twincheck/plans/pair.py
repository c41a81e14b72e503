"""All checks of one source/target pair, as lazy DataFrames that share scans where they can."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from twincheck.functions.columns import impose_schema, trim_strings, upper_names
from twincheck.functions.comparability import EXACT, Tolerance
from twincheck.functions.hashing import HASH_COLUMN
from twincheck.functions.sqltext import array, literal, struct
from twincheck.operators.aggregates import Profile, aggregate_requests, profile_sides
from twincheck.operators.audit import compare_queries, date_columns, future_dates, successful_loads
from twincheck.operators.catalog import compare_catalogs
from twincheck.operators.compare import NO_DIFFERENCE, RowComparison, compare_rows, verdict_of_metrics
from twincheck.operators.counts import compare_given_counts, compare_row_counts
from twincheck.operators.hashkeys import with_shared_hash_key
from twincheck.operators.prune import compare_pruned
from twincheck.sources.config import ConfigError, PairSpec
from twincheck.sources.tables import split_list
from twincheck.verdict import UNKNOWN, roll_up, verdict_text

# Names of the checks a run may select, and the columns of its summary.
ALL_CHECKS = "All"
ETL_AUDIT = "ETL execution (only Historical)"
ROW_COUNT = "Table Row Count"
DATA_TYPE = "Table Data Type"
AGGREGATION = "Aggregation"
CONTENT = "Content Comparison"
FILES = "File Comparison"
BUSINESS = "Business Queries"
FUTURE_DATES = "Future Dates Conversion"
CHECKS = [ETL_AUDIT, ROW_COUNT, DATA_TYPE, AGGREGATION, CONTENT, FILES, BUSINESS, FUTURE_DATES]
SUMMARY_COLUMNS = [
    "STATUS",
    "SOURCE_TABLE",
    "TARGET_TABLE",
    "ROW_COUNT_STATUS",
    "DATA_TYPE_STATUS",
    "DATA_CONTENT_STATUS",
    "AGG_STATUS",
    "SOURCE_ROW_COUNT",
    "TARGET_ROW_COUNT",
    "SOURCE_FILTER",
    "TARGET_FILTER",
    "VALIDATION_TIME",
]
_UNREPORTED_COUNT = "row count of a pruned check"
CHECK_ROW_SCHEMA = "name string, status string, source_rows bigint, target_rows bigint"
STATUS_COLUMNS = ["ROW_COUNT_STATUS", "DATA_TYPE_STATUS", "DATA_CONTENT_STATUS", "AGG_STATUS"]


def select_checks(names: str | Iterable[str] | None) -> frozenset[str]:
    """Set of checks to run; ``All`` stands for every one, an unknown or missing name is an error."""
    wanted = split_list(names) if isinstance(names, str) else [name.strip() for name in names or ()]
    if not wanted:
        raise ConfigError("no check selected")
    unknown = [name for name in wanted if name not in (*CHECKS, ALL_CHECKS)]
    if unknown:
        raise ConfigError(f"unknown checks {unknown}; known are {CHECKS}")
    return frozenset(CHECKS if ALL_CHECKS in wanted else wanted)


@dataclass(frozen=True)
class PairChecks:
    """Planned checks of a pair. A check that was not selected, or has nothing to do, is None.

    ``pruned`` marks a content check that holds differing rows only; row counts are then planned beside it.
    """

    spec: PairSpec
    selected: frozenset[str] = field(default_factory=frozenset)
    pruned: bool = False
    row_counts: DataFrame | None = None
    types: RowComparison | None = None
    profile: Profile | None = None
    content: RowComparison | None = None
    future: RowComparison | None = None
    business: tuple[tuple[str, RowComparison], ...] = ()
    loads: DataFrame | None = None
    files: DataFrame | None = None

    @property
    def aggregates(self) -> DataFrame | None:
        """Details of the MIN, MAX, SUM and AVG requests."""
        if self.profile is None or not self.profile.values:
            return None
        spec = self.spec
        return self.profile.aggregates(spec.source_table, spec.target_table, spec.source_filter, spec.target_filter)

    @property
    def frequencies(self) -> DataFrame | None:
        """Details of the COUNT requests."""
        return None if self.profile is None or not self.profile.counted else self.profile.frequencies()

    @property
    def aggregate_verdict(self) -> DataFrame | None:
        return None if self.profile is None else self.profile.verdict()

    @property
    def reported(self) -> bool:
        """Whether a check is planned that :func:`check_report` tells and the summary has no column for."""
        return bool(self.business) or any(check is not None for check in (self.future, self.loads, self.files))

    def saved(self) -> PairChecks:
        """The same checks with the profile of both sides written, so that details and verdict share one scan a side."""
        return self if self.profile is None else replace(self, profile=self.profile.saved())


@dataclass(frozen=True)
class BusinessQuery:
    """One query for each side, naming its prepared tables as ``{source}`` and ``{target}``, compared on ``keys``."""

    name: str
    source: str
    target: str
    keys: tuple[str, ...]


@dataclass(frozen=True)
class LoadAudit:
    """Audit rows, the inventory of jobs, and the workflow whose loads must have succeeded."""

    audit: DataFrame
    inventory: DataFrame
    workflow: str


def prepare(source: DataFrame, target: DataFrame, spec: PairSpec) -> tuple[DataFrame, DataFrame]:
    """Upper-case names and trimmed text on both sides; for a view the target takes the source's types."""
    source, target = upper_names(source), upper_names(target)
    if spec.object_type == "VIEW":
        shared = [field for field in source.schema.fields if field.name in target.columns]
        target = impose_schema(target, type(source.schema)(shared))
    return trim_strings(source), trim_strings(target)


def content_comparison(
    source: DataFrame, target: DataFrame, spec: PairSpec, tolerance: Tolerance = EXACT, *, prune: bool = False
) -> RowComparison:
    """Row comparison on the declared keys, or on a row hash if there are none: distinct rows then have distinct keys,
    and a row that one side holds more often is a mismatch."""
    compare = compare_pruned if prune else compare_rows
    if spec.keys:
        return compare(source, target, spec.keys, skip=spec.skip, tolerance=tolerance)
    hashed_source, hashed_target = with_shared_hash_key(source, target, spec.skip, safe=True)
    return replace(compare(hashed_source, hashed_target, [HASH_COLUMN], tolerance=tolerance), keyless=True)


def plan_pair(
    source: DataFrame,
    target: DataFrame,
    spec: PairSpec,
    checks: Iterable[str] = (ALL_CHECKS,),
    *,
    catalogs: tuple[DataFrame, DataFrame] | None = None,
    counts: tuple[DataFrame, DataFrame] | None = None,
    tolerance: Tolerance = EXACT,
    prune: bool = False,
    cutoff: str | None = None,
    business: Iterable[BusinessQuery] = (),
    audit: LoadAudit | None = None,
    files: DataFrame | None = None,
) -> PairChecks:
    """Plan the selected checks over two loaded tables. Nothing runs yet.

    ``counts`` are one-row frames with the row counts, where the systems count themselves; they are used unless the
    content check yields the counts anyway.
    ``prune`` suits large copies with few differences: equal parts are recognised by digests and never shuffled.
    ``cutoff`` (a date), ``business``, ``audit`` and ``files`` (see :func:`~twincheck.plans.drop.file_report`) feed the
    checks of future dates, business queries, loads and files; a selected check without its input is reported as UNKNOWN
    by :func:`check_report`.
    """
    selected = select_checks(checks)
    left, right = prepare(source, target, spec)
    requests = aggregate_requests(spec.aggregate_columns, spec.aggregate_functions, spec.skip)
    planned: dict = {}
    if CONTENT in selected:
        planned["content"] = content_comparison(left, right, spec, tolerance, prune=prune)
    if (ROW_COUNT in selected and CONTENT not in selected) or (CONTENT in selected and prune):
        planned["row_counts"] = compare_given_counts(*counts) if counts else compare_row_counts(source, target)
    if DATA_TYPE in selected and catalogs is not None:
        planned["types"] = compare_catalogs(*catalogs, one_table=True)
    if AGGREGATION in selected and requests:
        planned["profile"] = profile_sides(left, right, requests, tolerance=tolerance)
    if FUTURE_DATES in selected and cutoff is not None and date_columns(left) and date_columns(right):
        planned["future"] = compare_rows(future_dates(left, cutoff), future_dates(right, cutoff), ["column_name"])
    if BUSINESS in selected:
        spark = source.sparkSession
        tables = {"source": left, "target": right}
        planned["business"] = tuple(
            (q.name, compare_queries(spark, q.source, q.target, q.keys, tables=tables, tolerance=tolerance))
            for q in business
        )
    if ETL_AUDIT in selected and audit is not None:
        own = f"upper(trim(source_table_name)) = {literal(spec.source_table.split('.')[-1].strip().upper())}"
        planned["loads"] = successful_loads(audit.audit, audit.inventory, audit.workflow).where(own)
    if FILES in selected and files is not None:
        planned["files"] = files.where(f"stem IS NULL OR upper(trim(stem)) IN ({', '.join(_extract_names(spec))})")
    return PairChecks(spec=spec, selected=selected, pruned=prune, **planned)


def _extract_names(spec: PairSpec) -> list[str]:
    """SQL literals of the stems, in upper case, that a pair's extracts may bear: either table's name, with its schema or
    without."""
    full = [table.strip().upper() for table in (spec.source_table, spec.target_table)]
    return [literal(name) for name in dict.fromkeys([*full, *(name.rpartition(".")[2] for name in full)])]


def check_report(checks: PairChecks) -> DataFrame:
    """One row for each selected check, business query and pair of files that the summary has no column for:
    ``check_name, item, status, reason``. What was selected but could not run is UNKNOWN, with the reason; nothing
    selected vanishes.

    Loads MATCH if the table was loaded at least once with success. Files are those of the drop folder that are named like
    a table of the pair; ``item`` tells which, as several folders may hold such files.
    """
    reported = []

    def row(name: str, item: str, status: str, reason: str = "''") -> str:
        return struct({"check_name": literal(name), "item": literal(item), "status": status, "reason": reason})

    if checks.future is not None:
        reported.append(_exploded(checks.future.verdict(), row(FUTURE_DATES, "", "verdict", "reason")))
    for name, compared in checks.business:
        reported.append(_exploded(compared.verdict(), row(BUSINESS, name, "verdict", "reason")))
    if checks.loads is not None:
        loads = checks.loads.selectExpr("count(1) AS n")
        reported.append(_exploded(loads, row(ETL_AUDIT, "", verdict_text("n > 0"))))
    extracts = checks.files is not None and not checks.files.isEmpty()
    if extracts:
        reported.append(checks.files.selectExpr(f"{literal(FILES)} AS check_name", "item", "status", "reason"))
    missing = {
        FUTURE_DATES: (checks.future is None, "no cutoff, or no date column on both sides"),
        BUSINESS: (not checks.business, "no business query given"),
        ETL_AUDIT: (checks.loads is None, "no load audit given"),
        FILES: (not extracts, f"no {'drop folder given' if checks.files is None else 'new file is named like the table'}"),
        DATA_TYPE: (checks.types is None, "no catalogs given"),
        AGGREGATION: (checks.profile is None, "no aggregate requested"),
    }
    unknown = [
        (name, "", UNKNOWN, reason) for name, (lacking, reason) in missing.items() if name in checks.selected and lacking
    ]
    schema = "check_name string, item string, status string, reason string"
    if unknown or not reported:
        reported.append(SparkSession.active().createDataFrame(unknown, schema))
    return reduce(DataFrame.unionAll, reported)


def _check_row(name: str, status: str, *, counted: bool = False) -> str:
    missing = "cast(NULL AS bigint)"
    return struct(
        {
            "name": literal(name),
            "status": status,
            "source_rows": "source_rows" if counted else missing,
            "target_rows": "target_rows" if counted else missing,
        }
    )


def _exploded(report: DataFrame, *cells: str) -> DataFrame:
    return report.selectExpr(f"explode({array(cells)}) AS cell").selectExpr("cell.*")


def check_rows(checks: PairChecks, content_metrics: DataFrame | None = None) -> DataFrame | None:
    """One row per planned check: ``name, status, source_rows, target_rows``.

    ``content_metrics`` replaces the metrics of the content check where they are known already. The content check also
    yields the raw row counts, so counting costs no pass of its own beside it.
    """
    rows = []
    if checks.content is not None:
        metrics = checks.content.key_metrics() if content_metrics is None else content_metrics
        status = verdict_text(NO_DIFFERENCE) if checks.pruned else verdict_of_metrics()
        cells = [_check_row("DATA_CONTENT_STATUS", status)]
        if ROW_COUNT in checks.selected and not checks.pruned:
            cells.append(_check_row("ROW_COUNT_STATUS", verdict_text("source_rows = target_rows"), counted=True))
        rows.append(_exploded(metrics, *cells))
    if checks.row_counts is not None:
        name = "ROW_COUNT_STATUS" if ROW_COUNT in checks.selected else _UNREPORTED_COUNT
        rows.append(_exploded(checks.row_counts, _check_row(name, "verdict", counted=True)))
    if checks.types is not None:
        rows.append(_exploded(checks.types.key_metrics(), _check_row("DATA_TYPE_STATUS", verdict_of_metrics())))
    if checks.profile is not None:
        rows.append(_exploded(checks.aggregate_verdict, _check_row("AGG_STATUS", "verdict")))
    return reduce(DataFrame.unionAll, rows) if rows else None


def summarize(checks: PairChecks, content_metrics: DataFrame | None = None) -> DataFrame:
    """The summary row of a pair: 12 text columns. A check that did not run is UNKNOWN, so are all columns of a pair whose
    only checks are those of :func:`check_report`."""
    spec = checks.spec
    rows = check_rows(checks, content_metrics)
    if rows is None:
        if not checks.reported:
            raise ConfigError("none of the selected checks applies to this pair")
        rows = SparkSession.active().createDataFrame([], CHECK_ROW_SCHEMA)

    def of(name: str, value: str) -> str:
        return f"max(if(name = {literal(name)}, {value}, NULL))"

    statuses = {name: of(name, "status") for name in STATUS_COLUMNS}
    # An empty side proves nothing, also where the content check itself holds no row.
    empty = "(max(source_rows) = 0 OR max(target_rows) = 0)"
    statuses["DATA_CONTENT_STATUS"] = f"if({empty}, NULL, {statuses['DATA_CONTENT_STATUS']})"
    totals = rows.selectExpr(
        *[f"coalesce({status}, {literal(UNKNOWN)}) AS {name}" for name, status in statuses.items()],
        *[
            f"coalesce(cast({of('ROW_COUNT_STATUS', f'{side}_rows')} AS string), '') AS {side.upper()}_ROW_COUNT"
            for side in ("source", "target")
        ],
    )
    values = {name: name for name in totals.columns} | {
        "STATUS": roll_up(STATUS_COLUMNS),
        "SOURCE_TABLE": literal(spec.source_table),
        "TARGET_TABLE": literal(spec.target_table),
        "SOURCE_FILTER": literal(spec.source_filter),
        "TARGET_FILTER": literal(spec.target_filter),
        "VALIDATION_TIME": "''",
    }
    return totals.selectExpr(*[f"{values[name]} AS {name}" for name in SUMMARY_COLUMNS])


def validate_pair(
    source: DataFrame, target: DataFrame, spec: PairSpec, checks: Iterable[str] = (ALL_CHECKS,), **options
) -> DataFrame:
    """Summary row of one pair; ``options`` are those of :func:`plan_pair`. Requested aggregates are computed at once."""
    return summarize(plan_pair(source, target, spec, checks, **options).saved())
