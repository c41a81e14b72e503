"""Queries on whole runs: files beside tables, written results, failing pairs, empty sides, inferred types."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from twincheck.operators.aggregates import AggregateRequest
from twincheck.operators.compare import columns_only, compare_rows
from twincheck.plans.pair import AGGREGATION, CONTENT, FILES, ROW_COUNT, plan_pair
from twincheck.plans.run import FileDrop, Systems, export_pair, run_config, run_pairs
from twincheck.session import scratch_folder
from twincheck.sinks.exports import export_csv, read_export
from twincheck.sources.config import CONFIG_COLUMNS, CONFIG_SCHEMA, PairSpec
from twincheck.sources.csvfiles import read_csv_inferred
from twincheck.sources.dropfolder import SOURCE_SUFFIX, TARGET_SUFFIX
from workload import frames as w
from workload.file_queries import write_extracts
from workload.registry import plain, query, table
from workload.row_queries import ORDERS_TRIMMED
from workload.table_queries import ORDERS_SPEC, aggregate_sql


def _config(spark: SparkSession, rows: list[dict[str, str]]) -> DataFrame:
    """Configuration rows, with empty cells for the columns that are not given."""
    return spark.createDataFrame([tuple(row.get(name, "") for name in CONFIG_COLUMNS) for row in rows], CONFIG_SCHEMA)


def _config_row(name: str, key: str) -> dict[str, str]:
    return {
        "ACTIVE": "Y", "LOB": "Sales: SLS", "TYPE": "Table", "SOURCE_SCHEMA_NAME": "sales", "SOURCE_TABLE_NAME": name,
        "TARGET_SCHEMA_NAME": "copy", "TARGET_TABLE_NAME": name, "SOURCE_COLUMNS": "*", "TARGET_COLUMNS": "*",
        "UNIQUE_KEYS": key,
    }


def _systems(spark: SparkSession, sf_dir: str) -> Systems:
    def load(name: str, columns: str, condition: str, schema: str | None) -> DataFrame:
        return table(spark, sf_dir, name.rpartition(".")[2])

    return Systems(load, load)


# --- files beside tables ---------------------------------------------------------------------------------------------

_EXTRACTS = {
    "supplier": (["s_suppkey", "s_name", "s_nationkey"], "s_suppkey % 9 <> 4", "s_name", "s_suppkey % 13 = 5"),
    "customer": (["c_custkey", "c_name", "c_nationkey"], "true", "c_name", "false"),
    "part": (["p_partkey", "p_name", "p_size"], "true", "p_name", "p_partkey % 17 = 3"),
}


def _extract_sql(name: str) -> str:
    columns, kept, changed, where = _EXTRACTS[name]
    given = ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in columns)
    copied = ", ".join(
        f"CASE WHEN {where} THEN {c} || '!' ELSE {c} END AS {c}" if c == changed else f"CAST({c} AS VARCHAR) AS {c}"
        for c in columns
    )
    number = f"row_number() OVER (ORDER BY {columns[0]}) AS n"
    both = f"""(SELECT {given}, {number} FROM {name}) s
      FULL JOIN (SELECT {copied}, {number} FROM {name} WHERE {kept}) t USING (n)"""
    differs = " OR ".join(f"s.{c} <> t.{c}" for c in columns)
    return f"""SELECT '{name}' AS item, CASE WHEN d + a + b = 0 THEN 'MATCH' ELSE 'MISMATCH' END AS status,
      CASE WHEN d + a + b = 0 THEN '' ELSE d || ' rows differ, ' || a || ' more in the source, ' || b
        || ' more in the target' END AS reason
      FROM (SELECT count(*) FILTER ({differs}) AS d, count(*) FILTER (t.{columns[0]} IS NULL) AS a,
        count(*) FILTER (s.{columns[0]} IS NULL) AS b FROM {both})"""


@query(
    "run_with_files",
    " UNION ALL ".join(map(_extract_sql, _EXTRACTS))
    + """ UNION ALL SELECT 'nation', 'UNKNOWN', 'only the source file has arrived'
          UNION ALL SELECT '', 'UNKNOWN', 'no new file is named like the table'""",
)
def run_with_files(spark, sf_dir):
    """The check of files in a run over five tables: extracts of three were dropped, of one a half, of one none."""
    drop, output = scratch_folder(spark, "drop"), scratch_folder(spark, "results")
    for name, (columns, kept, changed, where) in _EXTRACTS.items():
        source = table(spark, sf_dir, name).selectExpr(f"'{name}' AS stem", *columns)
        target = source.where(kept).withColumn(changed, F.expr(f"if({where}, concat({changed}, '!'), {changed})"))
        write_extracts(source, "stem", SOURCE_SUFFIX, drop)
        write_extracts(target, "stem", TARGET_SUFFIX, drop)
    nation = table(spark, sf_dir, "nation").selectExpr("'nation' AS stem", "n_nationkey", "n_name")
    write_extracts(nation, "stem", SOURCE_SUFFIX, drop)
    keys = {name: columns[0] for name, (columns, *_) in _EXTRACTS.items()}
    keys |= {"nation": "n_nationkey", "region": "r_regionkey"}
    config = _config(spark, [_config_row(*item) for item in keys.items()])
    given = FileDrop(drop, f"{output}/ledger", parallel=3)
    run_config(spark, config, _systems(spark, sf_dir), [FILES], folder=output, parallel=5, drop=given)
    report = read_export(spark, f"{output}/pair_*/checks/*")
    return report.selectExpr(
        "coalesce(regexp_extract(item, '([^/]*)$', 1), '') AS item", "status", "coalesce(reason, '') AS reason"
    )


# --- written results -------------------------------------------------------------------------------------------------

_WRITTEN_AGGREGATES = " UNION ALL ".join(
    aggregate_sql(AggregateRequest(column, function), ("sales.orders", "copy.orders"), ("srct", "tgtt"))
    for column, function in (("O_TOTALPRICE", "SUM"), ("O_ORDERDATE", "MAX"))
)


@query("agg_export", f"WITH {ORDERS_TRIMMED} {_WRITTEN_AGGREGATES}")
def agg_export(spark, sf_dir):
    """Aggregate details as a run writes them, read back."""
    folder = scratch_folder(spark, "results")
    checks = plan_pair(*w.orders_pair(spark, sf_dir), ORDERS_SPEC, [AGGREGATION])
    export_pair(checks.saved(), folder)
    return read_export(spark, f"{folder}/aggregates/copy.orders")


@query(
    "run_folder",
    f"""WITH {w.CONFIG_SQL}
      SELECT 'config' AS part, SOURCE_TABLE_NAME AS name, ACTIVE AS value FROM config
      UNION ALL SELECT 'summary', trim(SOURCE_SCHEMA_NAME) || '.' || SOURCE_TABLE_NAME,
        CASE WHEN upper(trim(TYPE)) IN ('TABLE', 'VIEW') THEN 'UNKNOWN: ConnectionError' ELSE 'UNKNOWN: ConfigError' END
        FROM config WHERE ACTIVE = 'Y'
      UNION ALL SELECT 'run', 'pairs', CAST(count(*) AS VARCHAR) FROM config WHERE ACTIVE = 'Y'
      UNION ALL SELECT 'run', 'checks', 'Table Row Count'""",
)
def run_folder(spark, sf_dir):
    """What a run keeps beside its results, though no system answers: configuration, summary, and what was asked for."""
    folder = scratch_folder(spark, "results")

    def refuse(*_) -> DataFrame:
        raise ConnectionError("no such system")

    run_config(spark, w.config_rows(spark, sf_dir), Systems(refuse, refuse), [ROW_COUNT], folder=folder)
    parts = {
        "config": ("SOURCE_TABLE_NAME AS name", "coalesce(ACTIVE, '') AS value"),
        "summary": ("SOURCE_TABLE AS name", "concat(STATUS, ': ', substring_index(ERROR, ':', 1)) AS value"),
        "run": ("item AS name", "value"),
    }
    kept = [
        read_export(spark, f"{folder}/{part}").selectExpr(f"'{part}' AS part", *columns) for part, columns in parts.items()
    ]
    return reduce(DataFrame.unionAll, kept).where("part <> 'run' OR name IN ('pairs', 'checks')")


# --- failing pairs and empty sides -----------------------------------------------------------------------------------


@query(
    "run_isolated",
    """SELECT 'sales.' || name AS "SOURCE_TABLE", CASE WHEN name = 'absent' THEN 'UNKNOWN' ELSE 'MATCH' END AS "STATUS",
       CASE WHEN name = 'absent' THEN '' ELSE CAST(n AS VARCHAR) END AS "SOURCE_ROW_COUNT", name = 'absent' AS failed
       FROM (SELECT 'supplier' AS name, count(*) AS n FROM supplier UNION ALL SELECT 'absent', 0
             UNION ALL SELECT 'part', count(*) FROM part)""",
)
def run_isolated(spark, sf_dir):
    """Three pairs at a time, of which one cannot be read."""
    specs = [PairSpec(f"sales.{name}", f"copy.{name}", keys=(key,)) for name, key in
             (("supplier", "s_suppkey"), ("absent", "a_key"), ("part", "p_partkey"))]

    def plan(spec: PairSpec):
        copied = table(spark, sf_dir, spec.source_table.rpartition(".")[2])
        return plan_pair(copied, copied.repartition(3), spec, [ROW_COUNT, CONTENT])

    summary = run_pairs(spark, specs, plan, parallel=3)
    return summary.selectExpr("SOURCE_TABLE", "STATUS", "SOURCE_ROW_COUNT", "ERROR <> '' AS failed")


_EMPTY = {"none": "o_orderkey < 0", "all": "true"}


@query(
    "compare_empty",
    f"WITH {w.ORDERS_SQL} "
    + " UNION ALL ".join(
        f"""SELECT '{s}' AS source_kept, '{t}' AS target_kept,
        CASE WHEN n = 0 OR m = 0 THEN 'UNKNOWN' WHEN d = 0 THEN 'MATCH' ELSE 'MISMATCH' END AS verdict,
        CASE WHEN n = 0 THEN 'source is empty' WHEN m = 0 THEN 'target is empty' ELSE '' END AS reason
        FROM (SELECT (SELECT count(*) FROM src WHERE {_EMPTY[s]}) AS n, (SELECT count(*) FROM tgt WHERE {_EMPTY[t]}) AS m,
          (SELECT count(*) FROM (SELECT * FROM src EXCEPT ALL SELECT * FROM tgt)) AS d)"""
        for s in _EMPTY
        for t in _EMPTY
    ),
)
def compare_empty(spark, sf_dir):
    """Verdicts with nothing on either side: an empty side proves nothing."""
    source, target = w.orders_pair(spark, sf_dir)
    return reduce(
        DataFrame.unionAll,
        [
            compare_rows(source.where(left), target.where(right), w.ORDER_KEY)
            .verdict()
            .selectExpr(f"'{s}' AS source_kept", f"'{t}' AS target_kept", "verdict", "reason")
            for s, left in _EMPTY.items()
            for t, right in _EMPTY.items()
        ],
    )


# --- columns and types -----------------------------------------------------------------------------------------------

_PLACES = """
one AS (SELECT upper(column_name) AS c FROM (DESCRIBE {0})), other AS (SELECT upper(column_name) AS c FROM (DESCRIBE {1}))"""


@query(
    "columns_compared",
    f"""WITH {_PLACES.format("documents", "benchmark")}
      SELECT coalesce(one.c, other.c) AS column_name, CASE WHEN other.c IS NULL THEN 'only_source'
        WHEN one.c IS NULL THEN 'only_target' ELSE 'compared' END AS place FROM one FULL JOIN other ON one.c = other.c""",
)
def columns_compared(spark, sf_dir):
    """Columns that two tables share, in any case, and those that one of them lacks."""
    source = table(spark, sf_dir, "documents")
    target = table(spark, sf_dir, "benchmark")
    unique = columns_only(source, target)
    placed = [(name.upper(), place) for place, names in unique.items() for name in names]
    shared = [(name.upper(), "compared") for name in source.columns if name not in unique["only_source"]]
    return spark.createDataFrame(placed + shared, "column_name string, place string")


@query(
    "csv_inferred",
    """SELECT CAST(o_orderkey AS BIGINT) AS o_orderkey, o_orderstatus, CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR)
       AS o_totalprice, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS o_orderdate,
       'int,string,double,date' AS kinds FROM orders""",
)
def csv_inferred(spark, sf_dir):
    """Orders written as CSV and read back with the types that the text suggests."""
    folder = scratch_folder(spark, "extract")
    orders = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey", "o_orderstatus", f"cast(o_totalprice AS {w.MONEY}) AS o_totalprice",
        "cast(o_orderdate AS date) AS o_orderdate",
    )
    export_csv(orders, folder)
    found = read_csv_inferred(spark, folder)
    kinds = ",".join(kind for _, kind in found.dtypes)
    return plain(
        found.selectExpr(
            "o_orderkey", "o_orderstatus", f"cast(o_totalprice AS {w.MONEY}) AS o_totalprice", "o_orderdate",
            f"'{kinds}' AS kinds",
        )
    )
