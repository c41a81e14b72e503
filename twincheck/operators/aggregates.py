"""Per-column aggregates of both sides, compared value by value."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass, replace
from fractions import Fraction
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from twincheck.functions.columns import resolve_names
from twincheck.functions.comparability import EXACT, Tolerance, cast, common_type, is_numeric, orderable_columns
from twincheck.functions.exactsum import PIECES, as_double, exact_total, with_pieces
from twincheck.functions.sqltext import alias, array, literal, quote, struct
from twincheck.operators.counts import COUNT_STATUS, frequency_texts
from twincheck.session import scratch_folder
from twincheck.verdict import verdict_text

# Aggregate function names.
VALUE_FUNCTIONS = ("MIN", "MAX", "SUM", "AVG")
COUNT_FUNCTION = "COUNT"


@dataclass(frozen=True)
class AggregateRequest:
    column: str
    function: str


def aggregate_requests(
    columns: Sequence[str] | None, functions: Sequence[str] | None, skip: Iterable[str] | None = None
) -> list[AggregateRequest]:
    """Pair up the two configured lists; skipped columns are left out. Wrong input is an error before any job runs."""
    if not columns or not functions:
        return []
    if len(columns) != len(functions):
        raise ValueError(f"{len(columns)} aggregate columns but {len(functions)} aggregate functions")
    unwanted = {name.strip().upper() for name in skip or ()}
    requests = [AggregateRequest(c.strip(), f.strip().upper()) for c, f in zip(columns, functions)]
    unsupported = sorted({r.function for r in requests} - {*VALUE_FUNCTIONS, COUNT_FUNCTION})
    if unsupported:
        raise ValueError(f"aggregate functions {unsupported} are not supported")
    return [r for r in requests if r.column.upper() not in unwanted]


def _summed_type(own: T.DataType, common: T.DataType | None) -> T.DataType:
    return own if common is None else common


def _is_exact_average(r: AggregateRequest, kind: T.DataType) -> bool:
    return r.function == "AVG" and is_numeric(kind) and not isinstance(kind, (T.FloatType, T.DoubleType))


def _is_double_total(r: AggregateRequest, kind: T.DataType) -> bool:
    return r.function in ("SUM", "AVG") and isinstance(kind, (T.FloatType, T.DoubleType))


def _value(name: str, own: T.DataType, common: T.DataType | None, function: str) -> str:
    """A column on the type both sides share, so that sums and averages get the same scale."""
    value = quote(name) if common is None else cast(quote(name), own, common)
    kind = _summed_type(own, common)
    if function in ("SUM", "AVG"):
        # Integers are summed as wide decimals: exact, and no overflow error at any row count.
        if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
            value = f"cast({value} AS decimal(22,0))"
        elif isinstance(kind, T.FloatType):
            value = f"cast({value} AS double)"
    return value


_CELLS = (
    "is_source boolean, position int, text string, number double, total string, n bigint, class int, p0 bigint, p1 bigint,"
    " p2 bigint"
)


def _as_cells(
    df: DataFrame,
    names: Sequence[str],
    requests: Sequence[AggregateRequest],
    commons: Sequence[T.DataType | None],
    is_source: bool,
    counted: Sequence[str] = (),
) -> DataFrame:
    """Aggregates of one side in long form (``_CELLS``), after them for the texts ``counted`` a row for each value.

    One scan and one aggregate for all requests. A sum or average of a floating-point column has a row for each class of
    its values (see ``exactsum``) in place of a text; an average of exact numbers also has its exact total and count. Rows
    of counted values have position -1 - i, the value as text, and its count.
    """
    schema = df.schema
    kinds = [_summed_type(schema[name].dataType, common) for name, common in zip(names, commons)]
    values = [
        _value(name, schema[name].dataType, common, r.function) for name, r, common in zip(names, requests, commons)
    ]
    doubles = [i for i, (r, kind) in enumerate(zip(requests, kinds)) if _is_double_total(r, kind)]
    # A column that is summed and averaged is cut into pieces once.
    summed = list(dict.fromkeys(values[i] for i in doubles))
    plain = [i for i in range(len(requests)) if i not in doubles]
    inputs = [alias(values[i], f"a{i}") for i in plain] + [alias(value, f"s{part}") for part, value in enumerate(summed)]
    rows = df.selectExpr(*inputs, *[alias(text, f"t{i}") for i, text in enumerate(counted)])
    where = ""
    spread = bool(doubles or counted)
    if spread:
        # The row itself, a copy for each summed column, and one for each counted value.
        no_number, no_text = "cast(NULL AS double)", "cast(NULL AS string)"
        copies = [("-1", no_number, no_text)] if plain else []
        copies += [(str(part), f"s{part}", no_text) for part in range(len(summed))]
        copies += [(str(-2 - i), no_number, f"t{i}") for i in range(len(counted))]
        listed = [struct({"part": part, "number": number, "text": text}) for part, number, text in copies]
        rows = rows.selectExpr(*[f"a{i}" for i in plain], f"inline({array(listed)}) AS (_part, _number, _text)")
        # Copies are cut into pieces after they were made, so that the code does not grow with the columns.
        rows = with_pieces(rows, "_number")
        where = " FILTER (WHERE _part = -1)"
    aggregates = []
    for i in plain:
        aggregates.append(f"{requests[i].function}(a{i}){where} AS v{i}")
        if _is_exact_average(requests[i], kinds[i]):
            aggregates += [f"sum(a{i}){where} AS total{i}", f"count(a{i}){where} AS n{i}"]
    if spread:
        sums = [f"sum({name}) AS {name}" for name in PIECES] + ["count(1) AS n"]
        totals = rows.groupBy("_part", "class", "_text").agg(*map(F.expr, [*aggregates, *sums]))
    else:
        totals = rows.selectExpr(*aggregates)
    types = {field.name: field.dataType for field in totals.schema.fields}

    def cell(i: int) -> str:
        exact = _is_exact_average(requests[i], kinds[i])
        numeric = is_numeric(types[f"v{i}"])
        return struct(
            {
                "position": str(i),
                "text": f"cast(v{i} AS string)",
                "number": f"cast({f'v{i}' if numeric else 'NULL'} AS double)",
                "total": f"cast(total{i} AS string)" if exact else "cast(NULL AS string)",
                "n": f"n{i}" if exact else "cast(NULL AS bigint)",
            }
        )

    side = "true" if is_source else "false"
    if not spread:
        cells = totals.selectExpr(f"inline({array([cell(i) for i in plain])})")
        none = ", ".join(f"cast(NULL AS {kind}) AS {name}" for name, kind in (("class", "int"), *((p, "bigint") for p in PIECES)))
        return cells.selectExpr(f"{side} AS is_source", "*", *none.split(", "))

    def grouped_cell(position: str, text: str) -> str:
        return struct({"position": position, "text": text, "number": "cast(NULL AS double)", "total": "cast(NULL AS string)", "n": "n"})

    # One projection of the groups, so that the sides are read once. A summed column may be wanted by several requests.
    wanted = {part: [i for i in doubles if values[i] == value] for part, value in enumerate(summed)}
    cases = [f"WHEN _part = -1 THEN {array([cell(i) for i in plain])}"] if plain else []
    cases += [
        f"WHEN _part = {part} AND class IS NOT NULL THEN {array([grouped_cell(str(i), 'cast(NULL AS string)') for i in places])}"
        for part, places in wanted.items()
    ]
    if counted:
        cases.append(f"WHEN _part < -1 THEN {array([grouped_cell('_part + 1', '_text')])}")
    cells = totals.selectExpr("class", *PIECES, f"inline(CASE {' '.join(cases)} END)")
    return cells.selectExpr(f"{side} AS is_source", "position", "text", "number", "total", "n", "class", *PIECES)


_JOINED = (
    "position int, source_value string, target_value string, source_number double, target_number double,"
    " source_exact string, target_exact string"
)


def _finish(averages: frozenset[int]):
    """The rows of one request to one row of ``_JOINED``; exact values are fractions as text."""

    def run(table: pa.Table) -> pa.Table:
        position = table.column("position")[0].as_py()
        found = {}
        for is_source in (True, False):
            rows = [r for r in table.to_pylist() if r["is_source"] is is_source]
            text, number, exact = None, None, None
            if rows and rows[0]["class"] is None:
                text, number, n = rows[0]["text"], rows[0]["number"], rows[0]["n"]
                exact = text if n is None else str(Fraction(rows[0]["total"]) / n) if n and rows[0]["total"] else None
            elif rows:
                value = exact_total((r["class"], *(r[p] for p in PIECES)) for r in rows)
                value = value / sum(r["n"] for r in rows) if position in averages else value
                number, exact = as_double(value), str(value)
            found[is_source] = text, number, exact
        columns = [[position], *([found[side][k]] for k in range(3) for side in (True, False))]
        kinds = [pa.int32(), pa.string(), pa.string(), pa.float64(), pa.float64(), pa.string(), pa.string()]
        return pa.table([pa.array(c, k) for c, k in zip(columns, kinds)], names=[f.split()[0] for f in _JOINED.split(", ")])

    return run


@dataclass(frozen=True)
class Profile:
    """Aggregates and frequencies of both sides: one scan a side for all of them, in long form.

    ``cells`` are lazy; :meth:`saved` writes them, so that any number of reports reads them from there.
    """

    cells: DataFrame
    requests: tuple[AggregateRequest, ...]
    exact: bool
    tolerance: Tolerance = EXACT

    @property
    def values(self) -> list[AggregateRequest]:
        return [r for r in self.requests if r.function in VALUE_FUNCTIONS]

    @property
    def counted(self) -> list[str]:
        return list(dict.fromkeys(r.column for r in self.requests if r.function == COUNT_FUNCTION))

    def saved(self) -> Profile:
        spark = self.cells.sparkSession
        folder = scratch_folder(spark, "profile")
        self.cells.write.parquet(folder)
        return replace(self, cells=spark.read.schema(_CELLS).parquet(folder))

    def aggregates(
        self, source_name: str = "source", target_name: str = "target", source_filter: str = "", target_filter: str = ""
    ) -> DataFrame:
        """See :func:`compare_aggregates`."""
        wanted = self.values
        if not wanted:
            raise ValueError("no MIN, MAX, SUM or AVG requested")
        cells = self.cells.where("position >= 0")
        spark = cells.sparkSession
        if self.exact:
            averages = frozenset(i for i, r in enumerate(wanted) if r.function == "AVG")
            joined = cells.groupBy("position").applyInArrow(_finish(averages), _JOINED)
            # Columns without any value have no row.
            every = spark.range(len(wanted)).selectExpr("cast(id AS int) AS position")
            joined = every.join(joined, "position", "left").selectExpr(
                "position", "coalesce(source_value, cast(source_number AS string)) AS source_value",
                "coalesce(target_value, cast(target_number AS string)) AS target_value", "source_number",
                "target_number", "source_exact", "target_exact",
            )
            equal = "source_exact <=> target_exact"
        else:
            joined = cells.groupBy("position").agg(
                F.expr("max(if(is_source, text, NULL)) AS source_value"),
                F.expr("max(if(is_source, NULL, text)) AS target_value"),
                F.expr("max(if(is_source, number, NULL)) AS source_number"),
                F.expr("max(if(is_source, NULL, number)) AS target_number"),
            )
            equal = "source_value <=> target_value"
        tolerance = self.tolerance
        if not tolerance.exact:
            slack = f"{float(tolerance.absolute)!r}D + {float(tolerance.relative)!r}D * abs(target_number)"
            equal = f"({equal} OR coalesce(abs(source_number - target_number) <= {slack}, false))"

        def pick(items: Sequence[str]) -> str:
            return f"element_at({array(map(literal, items))}, position + 1)"

        def query(r: AggregateRequest, table: str, where: str) -> str:
            return f"SELECT {r.function}({r.column}) FROM {table} {where}".strip()

        return joined.selectExpr(
            f"{pick([r.column for r in wanted])} AS COLUMN_NAME",
            f"{pick([r.function for r in wanted])} AS AGG_FUNCTION",
            "source_value AS SOURCE_VALUE",
            "target_value AS TARGET_VALUE",
            f"{verdict_text(equal)} AS MATCH_RESULT",
            f"{pick([query(r, source_name, source_filter) for r in wanted])} AS SOURCE_QUERY",
            f"{pick([query(r, target_name, target_filter) for r in wanted])} AS TARGET_QUERY",
        )

    def frequencies(self) -> DataFrame:
        """See :func:`twincheck.operators.counts.compare_frequencies`."""
        names = array(map(literal, self.counted))
        counts = self.cells.where("position < 0").groupBy("position", "text").agg(
            F.expr("coalesce(sum(n) FILTER (WHERE is_source), 0L) AS source_rows"),
            F.expr("coalesce(sum(n) FILTER (WHERE NOT is_source), 0L) AS target_rows"),
        )
        return counts.selectExpr(
            f"element_at({names}, -position) AS column_name", "text AS value", "source_rows", "target_rows", COUNT_STATUS
        )

    def verdict(self) -> DataFrame:
        """One row: number of checks, failed checks and the verdict over all requests, COUNT included."""
        parts = []
        if self.values:
            parts.append(self.aggregates().selectExpr("MATCH_RESULT = 'MATCH' AS equal"))
        if self.counted:
            per_column = self.frequencies().groupBy("column_name").agg(F.expr("bool_and(status = 'match') AS equal"))
            parts.append(per_column.select("equal"))
        if not parts:
            # Nothing was asked for, or every column was skipped: that proves nothing.
            return self.cells.sparkSession.sql("SELECT 0L AS checks, 0L AS failed_checks, 'UNKNOWN' AS verdict")
        return reduce(DataFrame.unionAll, parts).selectExpr(
            "count(1) AS checks",
            "count_if(NOT equal) AS failed_checks",
            f"{verdict_text('bool_and(equal)')} AS verdict",
        )


def profile_sides(
    source: DataFrame, target: DataFrame, requests: Sequence[AggregateRequest], *, tolerance: Tolerance = EXACT
) -> Profile:
    """The profile of two tables for all requests."""
    empty = Profile(source.sparkSession.createDataFrame([], _CELLS), tuple(requests), False, tolerance)
    wanted, counted = empty.values, empty.counted
    if not wanted and not counted:
        return empty
    columns = [r.column for r in wanted]
    source_names, target_names = resolve_names(source, columns), resolve_names(target, columns)
    commons = [
        common_type(source.schema[s].dataType, target.schema[t].dataType) for s, t in zip(source_names, target_names)
    ]
    if counted:
        source, target = orderable_columns(source), orderable_columns(target)
    source_texts, target_texts = frequency_texts(source, target, counted)
    cells = _as_cells(source, source_names, wanted, commons, True, source_texts).unionAll(
        _as_cells(target, target_names, wanted, commons, False, target_texts)
    )
    kinds = [_summed_type(source.schema[s].dataType, common) for s, common in zip(source_names, commons)]
    exact = any(_is_double_total(r, k) or _is_exact_average(r, k) for r, k in zip(wanted, kinds))
    return replace(empty, cells=cells, exact=exact)


def compare_aggregates(
    source: DataFrame,
    target: DataFrame,
    requests: Sequence[AggregateRequest],
    *,
    tolerance: Tolerance = EXACT,
    source_name: str = "source",
    target_name: str = "target",
    source_filter: str = "",
    target_filter: str = "",
) -> DataFrame:
    """Seven text columns per MIN / MAX / SUM / AVG request. Each side is scanned once for all of them.

    Sums and averages of floating-point columns are exact, so they do not depend on the order of the rows; averages of
    all numbers are compared as fractions, not as they are rounded for the report.
    """
    names = {
        "source_name": source_name, "target_name": target_name, "source_filter": source_filter,
        "target_filter": target_filter,
    }
    values = [r for r in requests if r.function in VALUE_FUNCTIONS]
    return profile_sides(source, target, values, tolerance=tolerance).aggregates(**names)


def aggregate_verdict(
    source: DataFrame,
    target: DataFrame,
    requests: Sequence[AggregateRequest],
    *,
    tolerance: Tolerance = EXACT,
) -> DataFrame:
    """One row: number of checks, failed checks and the verdict over all requests, COUNT included."""
    return profile_sides(source, target, requests, tolerance=tolerance).verdict()
