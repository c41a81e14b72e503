"""Row comparison of two tables on declared keys.

Both sides are unioned and grouped on the keys once. Each group holds the surviving source row, the surviving target
row and how many rows each side had. Compared with de-duplicating both sides and joining them, this needs one shuffle
instead of three, is NULL-safe by nature of grouping, and combines on the map side, so a key that holds a large part
of a table leaves each map task as a single row.

Rows that share a key count as a whole: such a key matches only if both sides hold the same rows equally often, which
fixed-width digest sums of each key's rows tell. Values shown for such a key, and its per-column flags, are those of the
smallest row over the remaining columns, NULL first, which makes them independent of partitioning.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from twincheck.functions.columns import drop_columns, resolve_names
from twincheck.functions.comparability import (
    EXACT,
    Tolerance,
    as_text,
    canonical_value,
    cast,
    key_type,
    orderable_columns,
    values_match,
)
from twincheck.functions.hashing import digest_parts, null_aware_hash
from twincheck.functions.sqltext import alias, array, literal, quote, struct
from twincheck.verdict import verdict_text

# Row status values.
MATCHED = "match"
DIFFERENT = "mismatch"
ONLY_SOURCE = "only_source"
ONLY_TARGET = "only_target"

# Columns of a classified pair beside the keys.
STATUS = "row_status"
SOURCE = "source_row"
TARGET = "target_row"
MATCHES = "cell_matches"
SOURCE_ROWS = "source_rows"
TARGET_ROWS = "target_rows"
RESERVED = [STATUS, SOURCE, TARGET, MATCHES, SOURCE_ROWS, TARGET_ROWS]


def status_is(*statuses: str) -> str:
    return f"{STATUS} IN ({', '.join(map(literal, statuses))})"


@dataclass(frozen=True)
class Pairing:
    """How the columns of two tables correspond; decided from the schemas alone."""

    keys: tuple[str, ...]
    target_keys: tuple[str, ...]
    key_types: tuple[T.DataType, ...]
    columns: tuple[str, ...]
    target_columns: tuple[str, ...]
    source_extra: tuple[str, ...]
    target_extra: tuple[str, ...]
    source_schema: T.StructType = field(repr=False)
    target_schema: T.StructType = field(repr=False)

    def column_types(self, index: int) -> tuple[T.DataType, T.DataType]:
        return (
            self.source_schema[self.columns[index]].dataType,
            self.target_schema[self.target_columns[index]].dataType,
        )

    def key_values(self, target: bool = False) -> list[str]:
        """Key expressions of one side, on the common key types."""
        names, schema = (self.target_keys, self.target_schema) if target else (self.keys, self.source_schema)
        return [
            cast(quote(name), schema[name].dataType, kind)
            for name, kind in zip(names, self.key_types)
        ]


def pair_columns(
    source: DataFrame, target: DataFrame, keys: Sequence[str], *, case_sensitive: bool = False
) -> Pairing:
    """Match the columns of two tables by name, ignoring case unless told otherwise."""
    if not keys:
        raise ValueError("at least one key column is needed; add a row hash first if there is none")

    def fold(name: str) -> str:
        return name if case_sensitive else name.upper()

    source_keys = resolve_names(source, keys, case_sensitive=case_sensitive)
    target_keys = resolve_names(target, keys, case_sensitive=case_sensitive)
    clashes = [name for name in source_keys if name.lower() in RESERVED]
    if clashes:
        raise ValueError(f"key columns {clashes} bear reserved names; rename them on both sides")
    target_by_name = {fold(name): name for name in target.columns if name not in target_keys}
    values = [name for name in source.columns if name not in source_keys]
    shared = [name for name in values if fold(name) in target_by_name]
    shared_names = {fold(name) for name in shared}
    source_schema, target_schema = source.schema, target.schema
    return Pairing(
        keys=tuple(source_keys),
        target_keys=tuple(target_keys),
        key_types=tuple(
            key_type(source_schema[s].dataType, target_schema[t].dataType) for s, t in zip(source_keys, target_keys)
        ),
        columns=tuple(shared),
        target_columns=tuple(target_by_name[fold(name)] for name in shared),
        source_extra=tuple(name for name in values if fold(name) not in shared_names),
        target_extra=tuple(name for name in target_by_name.values() if fold(name) not in shared_names),
        source_schema=source_schema,
        target_schema=target_schema,
    )


def row_digests(pairing: Pairing, *, target: bool) -> list[str]:
    """``_sign`` and two digests of a row's compared values, alike on both sides where the values match exactly."""
    own, foreign = pairing.columns, pairing.target_columns
    own_schema, foreign_schema = pairing.source_schema, pairing.target_schema
    if target:
        own, foreign, own_schema, foreign_schema = foreign, own, foreign_schema, own_schema
    keys = pairing.key_values(target)
    values = keys + [
        canonical_value(quote(name), own_schema[name].dataType, foreign_schema[other].dataType, target=target)
        for name, other in zip(own, foreign)
    ]
    nulls = keys + [quote(name) for name in own]
    return [
        f"{-1 if target else 1}L AS _sign",
        f"{null_aware_hash(values, nulls, 1)} AS _d1",
        f"{null_aware_hash(values, nulls, 2)} AS _d2",
    ]


def digest_sums() -> dict[str, str]:
    """Signed sums over digests of both sides: all are zero where the sides hold the same rows equally often (up to a
    128-bit collision). The parity of the second digest widens the check."""
    sums = {"_rows": "sum(_sign)", "_parity": "bit_xor(_d2)"}
    return sums | {f"_sum{i}": f"sum(_sign * {part})" for i, part in enumerate(digest_parts("_d1"))}


def tag_sides(source: DataFrame, target: DataFrame, pairing: Pairing) -> DataFrame:
    """Union of both tables: key columns ``_k0..``, row digests, and one of the two row structs filled."""

    def side(df: DataFrame, names: Sequence[str], label: str) -> DataFrame:
        keys = [alias(key, f"_k{i}") for i, key in enumerate(pairing.key_values(label == TARGET))]
        keys += row_digests(pairing, target=label == TARGET)
        # The leading marker keeps the struct non-empty, so "struct is NULL" always means "no row on this side".
        values = {"_row": "true"} | {name: quote(name) for name in names}
        return df.selectExpr(*keys, alias(struct(values), label))

    left = side(source, [*pairing.columns, *pairing.source_extra], SOURCE)
    right = side(target, [*pairing.target_columns, *pairing.target_extra], TARGET)
    return left.unionByName(right, allowMissingColumns=True)


def classify(tagged: DataFrame, pairing: Pairing, tolerance: Tolerance = EXACT) -> DataFrame:
    """One row per key: the keys, then the columns of ``RESERVED``.

    A tolerance applies to keys with one row on each side; the rows of a repeated key must agree exactly.
    """
    same_rows = " AND ".join(f"{name} = 0" for name in digest_sums())
    grouped = tagged.groupBy(*[f"_k{i}" for i in range(len(pairing.keys))]).agg(
        F.expr(f"min({SOURCE}) AS {SOURCE}"),
        F.expr(f"min({TARGET}) AS {TARGET}"),
        F.expr(f"count({SOURCE}) AS {SOURCE_ROWS}"),
        F.expr(f"count({TARGET}) AS {TARGET_ROWS}"),
        *[F.expr(f"{value} AS {name}") for name, value in digest_sums().items()],
    )
    both = f"{SOURCE_ROWS} > 0 AND {TARGET_ROWS} > 0"
    flags = {"_row": "true"}
    for i, (name, other) in enumerate(zip(pairing.columns, pairing.target_columns)):
        source, target = f"{SOURCE}.{quote(name)}", f"{TARGET}.{quote(other)}"
        equal = values_match(source, target, *pairing.column_types(i), tolerance)
        flags[name] = f"{both} AND {equal}"
    all_equal = " AND ".join([f"{MATCHES}.{quote(name)}" for name in pairing.columns] or ["true"])
    status = (
        f"CASE WHEN {TARGET_ROWS} = 0 THEN {literal(ONLY_SOURCE)} WHEN {SOURCE_ROWS} = 0 THEN {literal(ONLY_TARGET)} "
        f"WHEN {SOURCE_ROWS} = 1 AND {TARGET_ROWS} = 1 AND {all_equal} THEN {literal(MATCHED)} "
        f"WHEN ({SOURCE_ROWS} > 1 OR {TARGET_ROWS} > 1) AND {same_rows} THEN {literal(MATCHED)} "
        f"ELSE {literal(DIFFERENT)} END AS {STATUS}"
    )
    keys = [alias(f"_k{i}", name) for i, name in enumerate(pairing.keys)]
    return grouped.selectExpr("*", alias(struct(flags), MATCHES)).selectExpr(
        *keys, status, SOURCE, TARGET, MATCHES, SOURCE_ROWS, TARGET_ROWS
    )


def bucket(keys: Sequence[str], buckets: int) -> str:
    return f"pmod({null_aware_hash(keys, keys, 0)}, {buckets}L) AS _bucket"


def column_digests(pairing: Pairing, *, target: bool) -> list[str]:
    """A digest ``_c0..`` of each compared value, alike on both sides where the values match exactly."""
    own, foreign = pairing.columns, pairing.target_columns
    own_schema, foreign_schema = pairing.source_schema, pairing.target_schema
    if target:
        own, foreign, own_schema, foreign_schema = foreign, own, foreign_schema, own_schema
    return [
        null_aware_hash(
            [canonical_value(quote(name), own_schema[name].dataType, foreign_schema[other].dataType, target=target)],
            [quote(name)],
            3,
        )
        + f" AS _c{i}"
        for i, (name, other) in enumerate(zip(own, foreign))
    ]


# Columns in a mask of flags.
MASK_BITS = 62


def mask_flag(column: int) -> str:
    """Whether a column differs, of a key with one row on each side."""
    return f"_m{column // MASK_BITS} & {1 << (column % MASK_BITS)}L <> 0"


def digest_keys(source: DataFrame, target: DataFrame, pairing: Pairing, *, columns: bool = False) -> DataFrame:
    """One short row per key: ``_k0..``, the rows of each side, and whether both hold the same rows equally often.

    Only keys and digests travel, combined before the exchange in buffers of fixed width. With ``columns`` there are masks
    ``_m0..`` of the columns that differ, 62 to each; they mean nothing for repeated keys.
    """

    def side(df: DataFrame, target: bool) -> DataFrame:
        keys = [alias(key, f"_k{i}") for i, key in enumerate(pairing.key_values(target))]
        of_columns = column_digests(pairing, target=target) if columns else []
        return df.selectExpr(*keys, *row_digests(pairing, target=target), *of_columns)

    sums = digest_sums()
    counted = {SOURCE_ROWS: "count_if(_sign > 0)", TARGET_ROWS: "count_if(_sign < 0)"} | sums
    places = range(len(pairing.columns)) if columns else range(0)
    counted |= {f"_x{i}": f"bit_xor(_c{i})" for i in places}
    keyed = side(source, False).unionAll(side(target, True)).groupBy(*[f"_k{i}" for i in range(len(pairing.keys))])
    same = " AND ".join(f"{name} = 0" for name in sums)
    masks = [
        " | ".join(f"if(_x{i} = 0, 0L, {1 << (i - start)}L)" for i in places[start : start + MASK_BITS])
        + f" AS _m{start // MASK_BITS}"
        for start in range(0, len(places), MASK_BITS)
    ]
    return keyed.agg(*[F.expr(f"{value} AS {name}") for name, value in counted.items()]).selectExpr(
        *[f"_k{i}" for i in range(len(pairing.keys))], SOURCE_ROWS, TARGET_ROWS, f"{same} AS _same", *masks
    )


# Differing keys are looked up by as many numbers at most, which bounds what is broadcast.
DIFFERING_BUCKETS = 1 << 16


# Aggregates over ``digest_keys``.
_BOTH = f"{SOURCE_ROWS} > 0 AND {TARGET_ROWS} > 0"
KEY_METRICS = [
    f"count_if({SOURCE_ROWS} > 0) AS source_keys",
    f"count_if({TARGET_ROWS} > 0) AS target_keys",
    f"count_if({_BOTH}) AS common_keys",
    f"count_if({_BOTH} AND _same) AS matched_keys",
    f"count_if({_BOTH} AND NOT _same) AS mismatched_keys",
    f"count_if({TARGET_ROWS} = 0) AS only_source_keys",
    f"count_if({SOURCE_ROWS} = 0) AS only_target_keys",
    f"coalesce(sum({SOURCE_ROWS}), 0L) AS {SOURCE_ROWS}",
    f"coalesce(sum({TARGET_ROWS}), 0L) AS {TARGET_ROWS}",
]


@dataclass(frozen=True)
class RowComparison:
    """A classified pair and the reports derived from it. Every report is a lazy DataFrame.

    With both ``sides`` given, counts, verdicts and column metrics come from digests by key, without moving whole rows.
    ``keyless`` tells that the key is a hash of all that is compared.
    """

    rows: DataFrame
    pairing: Pairing
    sides: tuple[DataFrame, DataFrame] | None = None
    keyless: bool = False

    @property
    def _keys(self) -> list[str]:
        return [quote(name) for name in self.pairing.keys]

    def with_status(self, *statuses: str) -> DataFrame:
        return self.rows.where(status_is(*statuses))

    def only_source(self) -> DataFrame:
        """Rows whose key is missing in the target, with every column of the source."""
        names = [*self.pairing.columns, *self.pairing.source_extra]
        return self.with_status(ONLY_SOURCE).selectExpr(
            *self._keys, *[alias(f"{SOURCE}.{quote(name)}", name) for name in names]
        )

    def only_target(self) -> DataFrame:
        """Rows whose key is missing in the source, with every column of the target."""
        names = [*self.pairing.target_columns, *self.pairing.target_extra]
        return self.with_status(ONLY_TARGET).selectExpr(
            *self._keys, *[alias(f"{TARGET}.{quote(name)}", name) for name in names]
        )

    def _side_by_side(self, rows: DataFrame) -> DataFrame:
        wide = []
        for name, other in zip(self.pairing.columns, self.pairing.target_columns):
            wide += [
                alias(f"{SOURCE}.{quote(name)}", f"{name}_source"),
                alias(f"{TARGET}.{quote(other)}", f"{name}_target"),
                alias(f"{MATCHES}.{quote(name)}", f"{name}_match"),
            ]
        return rows.selectExpr(*self._keys, *wide)

    def mismatched(self) -> DataFrame:
        """Keys on both sides whose rows differ: both values and a flag for every column. Of a repeated key the smallest
        rows are shown; they may agree where others do not."""
        return self._side_by_side(self.with_status(DIFFERENT))

    def common(self) -> DataFrame:
        """Keys on both sides, equal or not."""
        return self._side_by_side(self.with_status(MATCHED, DIFFERENT))

    def differences(self) -> DataFrame:
        """Every row that is not an exact match, in the classified layout."""
        return self.rows.where(f"{STATUS} <> {literal(MATCHED)}")

    def value_text(self, side: str, name: str) -> str:
        """A value of one side as text."""
        schema = self.pairing.source_schema if side == SOURCE else self.pairing.target_schema
        return as_text(f"{side}.{quote(name)}", schema[name].dataType)

    def cells(self) -> DataFrame:
        """One row per differing cell, values as text."""
        if not self.pairing.columns:
            raise ValueError("no column is compared besides the keys")
        cells = [
            struct(
                {
                    "column_name": literal(name),
                    "source_value": self.value_text(SOURCE, name),
                    "target_value": self.value_text(TARGET, other),
                    "equal": f"{MATCHES}.{quote(name)}",
                }
            )
            for name, other in zip(self.pairing.columns, self.pairing.target_columns)
        ]
        differing = f"filter({array(cells)}, cell -> NOT cell.equal)"
        return (
            self.with_status(DIFFERENT)
            .selectExpr(*self._keys, f"explode({differing}) AS cell")
            .selectExpr(*self._keys, "cell.column_name", "cell.source_value", "cell.target_value")
        )

    def sample(self, size: int = 10, *, statuses: Iterable[str] | None = None) -> DataFrame:
        """First ``size`` rows of every status in key order: status, ``sample_number``, keys and both rows.

        Each status is cut to ``size`` rows by a sort that keeps as many in every task, before they are numbered.
        """
        wanted = list(statuses or (MATCHED, DIFFERENT, ONLY_SOURCE, ONLY_TARGET))
        order = ", ".join(f"{key} ASC NULLS FIRST" for key in self._keys)
        number = f"row_number() OVER (PARTITION BY {STATUS} ORDER BY {order}) AS sample_number"
        keys = [F.col(key).asc_nulls_first() for key in self._keys]
        parts = [self.with_status(status).orderBy(*keys).limit(int(size)) for status in wanted]
        return (
            reduce(DataFrame.unionAll, parts)
            .selectExpr(STATUS, *self._keys, SOURCE, TARGET, number)
            .withColumn("sample_number", F.col("sample_number").cast("bigint"))
        )

    def class_counts(self) -> DataFrame:
        """Row count of every status that occurs."""
        if self.sides is not None:
            names = {ONLY_SOURCE: "only_source_keys", ONLY_TARGET: "only_target_keys", MATCHED: "matched_keys"}
            names[DIFFERENT] = "mismatched_keys"
            cells = [struct({STATUS: literal(status), "row_count": name}) for status, name in names.items()]
            counted = self.key_metrics().selectExpr(f"explode({array(cells)}) AS cell").selectExpr("cell.*")
            return counted.where("row_count > 0")
        return self.rows.groupBy(STATUS).agg(F.expr("count(1) AS row_count"))

    def metric_expressions(self) -> list[str]:
        """Aggregates that describe the whole comparison."""
        both = status_is(MATCHED, DIFFERENT)
        metrics = [
            f"count_if(NOT {status_is(ONLY_TARGET)}) AS source_keys",
            f"count_if(NOT {status_is(ONLY_SOURCE)}) AS target_keys",
            f"count_if({both}) AS common_keys",
            f"count_if({status_is(MATCHED)}) AS matched_keys",
            f"count_if({status_is(DIFFERENT)}) AS mismatched_keys",
            f"count_if({status_is(ONLY_SOURCE)}) AS only_source_keys",
            f"count_if({status_is(ONLY_TARGET)}) AS only_target_keys",
            f"coalesce(sum({SOURCE_ROWS}), 0L) AS {SOURCE_ROWS}",
            f"coalesce(sum({TARGET_ROWS}), 0L) AS {TARGET_ROWS}",
        ]
        return metrics + [
            f"count_if({both} AND NOT {MATCHES}.{quote(name)}) AS _mismatched_{i}"
            for i, name in enumerate(self.pairing.columns)
        ]

    def metric_columns(self) -> list[Column]:
        """The metrics in the form ``observe`` takes."""
        return [F.expr(metric) for metric in self.metric_expressions()]

    def metrics(self) -> DataFrame:
        """One row of counts, including the mismatch count of every compared column."""
        if self.sides is None:
            return self.rows.selectExpr(*self.metric_expressions())
        columns = range(len(self.pairing.columns))
        if self.keyless or not columns:
            # Rows of one hash agree in every column.
            return self.key_metrics().selectExpr("*", *[f"0L AS _mismatched_{i}" for i in columns])
        keyed = digest_keys(*self.sides, self.pairing, columns=True)
        single = f"({SOURCE_ROWS} = 1 AND {TARGET_ROWS} = 1)"
        of_single = keyed.selectExpr(
            *KEY_METRICS, *[f"count_if({single} AND {mask_flag(i)}) AS _mismatched_{i}" for i in columns]
        )
        # Of a repeated key the smallest rows are compared. Rows are fetched only where such a key of their bucket differs.
        # The condition on the masks keeps all of them in this branch, so that both read one exchange.
        whole = " AND ".join(f"bit_count(_m{i}) >= 0" for i in range(-(-len(columns) // MASK_BITS)))
        repeated = keyed.where(f"{_BOTH} AND NOT _same AND NOT {single} AND {whole}")
        names = [f"_k{i}" for i in range(len(self.pairing.keys))]
        buckets = repeated.selectExpr(bucket(names, DIFFERING_BUCKETS)).distinct()
        tagged = tag_sides(*self.sides, self.pairing).selectExpr("*", bucket(names, DIFFERING_BUCKETS))
        candidates = tagged.join(F.broadcast(buckets), "_bucket", "left_semi").drop("_bucket")
        flags = classify(candidates, self.pairing).where(f"{status_is(DIFFERENT)} AND NOT {single}")
        of_repeated = flags.selectExpr(
            *[f"count_if(NOT {MATCHES}.{quote(n)}) AS _mismatched_{i}" for i, n in enumerate(self.pairing.columns)]
        )
        both = of_single.unionByName(of_repeated, allowMissingColumns=True)
        return both.selectExpr(
            *[f"{'sum' if name.startswith('_mismatched_') else 'max'}({name}) AS {name}" for name in both.columns]
        )

    def key_metrics(self) -> DataFrame:
        """The metrics without those of single columns."""
        if self.sides is None:
            return self.metrics().drop(*[f"_mismatched_{i}" for i in range(len(self.pairing.columns))])
        return digest_keys(*self.sides, self.pairing).selectExpr(*KEY_METRICS)

    def key_metrics_by(self, key: str) -> DataFrame:
        """The metrics without those of single columns, for each value of one of the keys. Needs both sides."""
        place = f"_k{self.pairing.keys.index(key)}"
        keyed = digest_keys(*self.sides, self.pairing).withColumnRenamed(place, key)
        return keyed.groupBy(key).agg(*map(F.expr, KEY_METRICS))

    def counts(self) -> DataFrame:
        """One row: keys and raw rows per side, duplicates, and the size of every difference class."""
        return count_report(self.key_metrics())

    def match_rates(self) -> DataFrame:
        """Matched and mismatched keys of every compared column, over the common keys."""
        return match_rate_report(self.metrics(), self.pairing.columns)

    def verdict(self) -> DataFrame:
        return verdict_report(self.key_metrics())


def count_report(metrics: DataFrame) -> DataFrame:
    return metrics.selectExpr(
        "source_rows",
        "target_rows",
        "source_keys",
        "target_keys",
        "source_rows - source_keys AS source_duplicates",
        "target_rows - target_keys AS target_duplicates",
        "common_keys",
        "matched_keys",
        "mismatched_keys",
        "only_source_keys",
        "only_target_keys",
    )


def match_rate_report(metrics: DataFrame, columns: Sequence[str]) -> DataFrame:
    cells = [struct({"name": literal(name), "mismatched": f"_mismatched_{i}"}) for i, name in enumerate(columns)]
    if not cells:
        raise ValueError("no column is compared besides the keys")
    return metrics.selectExpr("common_keys", f"explode({array(cells)}) AS cell").selectExpr(
        "cell.name AS column_name",
        "common_keys - cell.mismatched AS matched",
        "cell.mismatched",
        "try_divide(common_keys - cell.mismatched, common_keys) AS match_rate",
    )


NO_DIFFERENCE = "mismatched_keys + only_source_keys + only_target_keys = 0"


def verdict_of_metrics() -> str:
    """Over metrics: MATCH only if both sides have rows and no key differs; an empty side gives UNKNOWN."""
    return verdict_text(f"if(source_keys > 0 AND target_keys > 0, {NO_DIFFERENCE}, NULL)")


def verdict_report(metrics: DataFrame) -> DataFrame:
    """One row: the verdict, the reason of an UNKNOWN, and the sizes of the difference classes."""
    return metrics.selectExpr(
        f"{verdict_of_metrics()} AS verdict",
        "CASE WHEN source_keys = 0 THEN 'source is empty' WHEN target_keys = 0 THEN 'target is empty' ELSE '' END "
        "AS reason",
        "mismatched_keys",
        "only_source_keys",
        "only_target_keys",
    )


def compare_rows(
    source: DataFrame,
    target: DataFrame,
    keys: Sequence[str],
    *,
    skip: Iterable[str] | None = None,
    tolerance: Tolerance = EXACT,
    case_sensitive: bool = False,
) -> RowComparison:
    """Compare two tables on ``keys``; every other shared column is compared unless listed in ``skip``."""
    source, target = (orderable_columns(drop_columns(side, skip)) for side in (source, target))
    pairing = pair_columns(source, target, keys, case_sensitive=case_sensitive)
    rows = classify(tag_sides(source, target, pairing), pairing, tolerance)
    # Digests know no tolerance.
    return RowComparison(rows, pairing, (source, target) if tolerance.exact else None)


def columns_only(source: DataFrame, target: DataFrame, *, case_sensitive: bool = False) -> dict[str, list[str]]:
    """Column names that only one side has."""

    def fold(name: str) -> str:
        return name if case_sensitive else name.upper()

    source_names, target_names = {fold(n) for n in source.columns}, {fold(n) for n in target.columns}
    return {
        ONLY_SOURCE: [name for name in source.columns if fold(name) not in target_names],
        ONLY_TARGET: [name for name in target.columns if fold(name) not in source_names],
    }
