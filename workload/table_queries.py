"""Queries on counts, aggregates, catalogs, configuration, files and whole runs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from twincheck.functions import typemap
from twincheck.functions.columns import impose_schema
from twincheck.operators.aggregates import AggregateRequest, aggregate_verdict, compare_aggregates
from twincheck.operators.audit import compare_queries, future_dates, successful_loads
from twincheck.operators.catalog import (
    columns_of,
    compare_catalogs,
    in_position_order,
    reader_schemas,
    source_catalog,
    target_catalog,
)
from twincheck.operators.counts import compare_frequencies, compare_row_counts, duplicate_keys
from twincheck.operators.filepairs import base_name, folder_name, pair_files, unpaired_files, unprocessed_files
from twincheck.plans.pair import SUMMARY_COLUMNS, plan_pair, validate_pair
from twincheck.plans.run import run_pairs
from twincheck.session import scratch_folder
from twincheck.sinks.exports import export_csv, export_differences, metric_rows, read_export
from twincheck.sources.config import CONFIG_COLUMNS, PairSpec, active_rows, parse_config, read_config
from twincheck.sources.csvfiles import read_csv
from twincheck.sources.dropfolder import list_files
from twincheck.sources.tables import TableSpec, load_table
from twincheck.streaming.arrivals import record_arrivals
from workload import frames as w
from workload import oracle_parts as o
from workload.registry import plain, query, table
from workload.row_queries import TRIMMED_CLS, trimmed_orders

# --- counts and aggregates -------------------------------------------------------------------------------------------


@query(
    "row_count_compare",
    f"""WITH {w.ORDERS_SQL} SELECT s.n AS source_rows, t.n AS target_rows, s.n - t.n AS difference,
        CASE WHEN s.n = t.n THEN 'MATCH' ELSE 'MISMATCH' END AS verdict
        FROM (SELECT count(*) AS n FROM src) s, (SELECT count(*) AS n FROM tgt) t""",
)
def row_count_compare(spark, sf_dir):
    return compare_row_counts(*w.orders_pair(spark, sf_dir))


_REQUESTS = [
    AggregateRequest("o_totalprice", "SUM"),
    AggregateRequest("o_totalprice", "AVG"),
    AggregateRequest("o_totalprice", "MAX"),
    AggregateRequest("o_custkey", "SUM"),
    AggregateRequest("o_orderpriority", "MIN"),
    AggregateRequest("o_orderdate", "MAX"),
]
_SQL_OF_REQUEST = {
    "SUM": "CAST(CAST(sum({c}) AS DECIMAL(38,{s})) AS VARCHAR)",
    "AVG": "CAST(CAST(round(CAST(sum({c}) AS DOUBLE) / count({c}), 6) AS DECIMAL(22,6)) AS VARCHAR)",
    "MIN": "CAST(min({c}) AS VARCHAR)",
    "MAX": "CAST(max({c}) AS VARCHAR)",
}


def aggregate_sql(
    request: AggregateRequest,
    names: tuple[str, str] = ("source", "target"),
    sides: tuple[str, str] = ("src", "tgt"),
) -> str:
    scale = 2 if request.column.lower() == "o_totalprice" else 0
    value = _SQL_OF_REQUEST[request.function].format(c=request.column, s=scale)
    statement = f"SELECT {request.function}({request.column}) FROM"
    return f"""SELECT '{request.column}' AS "COLUMN_NAME", '{request.function}' AS "AGG_FUNCTION",
        s.v AS "SOURCE_VALUE", t.v AS "TARGET_VALUE",
        CASE WHEN s.v IS NOT DISTINCT FROM t.v THEN 'MATCH' ELSE 'MISMATCH' END AS "MATCH_RESULT",
        '{statement} {names[0]}' AS "SOURCE_QUERY", '{statement} {names[1]}' AS "TARGET_QUERY"
        FROM (SELECT {value} AS v FROM {sides[0]}) s, (SELECT {value} AS v FROM {sides[1]}) t"""


@query("agg_compare", f"WITH {w.ORDERS_SQL} " + " UNION ALL ".join(aggregate_sql(r) for r in _REQUESTS))
def agg_compare(spark, sf_dir):
    return compare_aggregates(*w.orders_pair(spark, sf_dir), _REQUESTS)


_DOUBLES = [
    AggregateRequest(column, function)
    for column, function in (
        ("l_extendedprice", "SUM"), ("l_extendedprice", "AVG"), ("l_extendedprice", "MAX"), ("l_discount", "SUM"),
        ("l_tax", "SUM"), ("l_tax", "AVG"), ("l_linenumber", "AVG"),
    )
]
_MOVED = "l_orderkey % 1000 = 1 AND l_linenumber = 1"


def _doubles_sql(request: AggregateRequest) -> str:
    """Doubles as whole numbers of 2^-62 (prices: 2^-44), which all of them are, summed without rounding."""
    scale = 2 ** (44 if request.column == "l_extendedprice" else 62)
    whole = f"sum(CAST({{0}} * {scale}.0::DOUBLE AS HUGEINT))" if request.function != "MAX" else "max({0})"
    shown = {"SUM": "sum", "AVG": "avg", "MAX": "max"}[request.function]
    return f"""SELECT '{request.column}' AS "COLUMN_NAME", '{request.function}' AS "AGG_FUNCTION",
      CASE WHEN (SELECT {whole.format(request.column)} FROM lineitem) = (SELECT {whole.format(request.column)} FROM moved)
        THEN 'MATCH' ELSE 'MISMATCH' END AS "MATCH_RESULT",
      (SELECT round(CAST({shown}({request.column}) AS DOUBLE), 2) FROM lineitem) AS source_value"""


@query(
    "agg_compare_doubles",
    f"WITH moved AS (SELECT * REPLACE (CASE WHEN {_MOVED} THEN l_tax + 1e-12 ELSE l_tax END AS l_tax) FROM lineitem) "
    + " UNION ALL ".join(_doubles_sql(r) for r in _DOUBLES),
)
def agg_compare_doubles(spark, sf_dir):
    """Sums of doubles of a copy in other partitions and another order, in which a few taxes are off by 1e-12."""
    source = table(spark, sf_dir, "lineitem")
    moved = source.withColumn("l_tax", F.expr(f"if({_MOVED}, l_tax + 1e-12D, l_tax)")).repartition("l_orderkey", "l_linenumber")
    rows = compare_aggregates(source, moved, _DOUBLES)
    return rows.selectExpr(
        "COLUMN_NAME", "AGG_FUNCTION", "MATCH_RESULT", "round(cast(SOURCE_VALUE AS double), 2) AS source_value"
    )


@query(
    "agg_verdict",
    f"""WITH {w.ORDERS_SQL}, checks AS (
        SELECT (SELECT max(o_orderdate) FROM src) IS NOT DISTINCT FROM (SELECT max(o_orderdate) FROM tgt) AS equal
        UNION ALL SELECT (SELECT sum(o_totalprice) FROM src) IS NOT DISTINCT FROM (SELECT sum(o_totalprice) FROM tgt)
        UNION ALL SELECT NOT EXISTS (
          SELECT 1 FROM (SELECT o_orderstatus AS v, count(*) AS n FROM src GROUP BY ALL) s
          FULL JOIN (SELECT o_orderstatus AS v, count(*) AS n FROM tgt GROUP BY ALL) t
          ON s.v IS NOT DISTINCT FROM t.v WHERE s.n IS DISTINCT FROM t.n))
      SELECT count(*) AS checks, count(*) FILTER (NOT equal) AS failed_checks,
             CASE WHEN bool_and(equal) THEN 'MATCH' ELSE 'MISMATCH' END AS verdict FROM checks""",
)
def agg_verdict(spark, sf_dir):
    requests = [
        AggregateRequest("o_orderdate", "MAX"),
        AggregateRequest("o_totalprice", "SUM"),
        AggregateRequest("o_orderstatus", "COUNT"),
    ]
    return aggregate_verdict(*w.orders_pair(spark, sf_dir), requests)


def _frequency_sql(column: str) -> str:
    return f"""SELECT '{column}' AS column_name, CASE WHEN s.n IS NULL THEN t.v ELSE s.v END AS value,
        coalesce(s.n, 0) AS source_rows, coalesce(t.n, 0) AS target_rows,
        CASE WHEN t.n IS NULL THEN 'only_source' WHEN s.n IS NULL THEN 'only_target'
             WHEN s.n = t.n THEN 'match' ELSE 'mismatch' END AS status
        FROM (SELECT CAST({column} AS VARCHAR) AS v, count(*) AS n FROM src GROUP BY ALL) s
        FULL JOIN (SELECT CAST({column} AS VARCHAR) AS v, count(*) AS n FROM tgt GROUP BY ALL) t
        ON s.v IS NOT DISTINCT FROM t.v"""


@query(
    "group_count_compare",
    f"WITH {w.ORDERS_SQL} " + " UNION ALL ".join(_frequency_sql(c) for c in ["o_orderpriority", "o_custkey"]),
)
def group_count_compare(spark, sf_dir):
    return compare_frequencies(*w.orders_pair(spark, sf_dir), ["o_orderpriority", "o_custkey"])


@query(
    "duplicate_keys",
    """SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, count(*) AS row_count FROM lineitem
       GROUP BY ALL HAVING count(*) > 1""",
)
def duplicate_keys_query(spark, sf_dir):
    return plain(duplicate_keys(table(spark, sf_dir, "lineitem"), ["L_ORDERKEY", "l_linenumber"]))


# --- loading ---------------------------------------------------------------------------------------------------------


@query(
    "table_load_filtered",
    """SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_quantity, l_returnflag FROM lineitem
       WHERE l_quantity > 45 AND l_returnflag = 'R'""",
)
def table_load_filtered(spark, sf_dir):
    spec = TableSpec(
        name="sales.lineitem",
        format="parquet",
        path=f"{sf_dir}/lineitem.parquet",
        columns="L_ORDERKEY, L_LINENUMBER,L_QUANTITY, L_RETURNFLAG",
        filter="WHERE l_quantity > 45 AND l_returnflag = 'R'",
    )
    return plain(load_table(spark, spec))


@query(
    "view_schema_impose",
    """SELECT c_custkey, CAST(c_nationkey AS VARCHAR) AS c_nationkey,
       CAST(CAST(c_acctbal AS DECIMAL(18,1)) AS VARCHAR) AS c_acctbal FROM customer""",
)
def view_schema_impose(spark, sf_dir):
    schema = T.StructType(
        [
            T.StructField("c_custkey", T.LongType()),
            T.StructField("c_nationkey", T.StringType()),
            T.StructField("c_acctbal", T.DecimalType(18, 1)),
        ]
    )
    exact = table(spark, sf_dir, "customer").withColumn("c_acctbal", F.expr(f"cast(c_acctbal AS {w.MONEY})"))
    return plain(impose_schema(exact, schema))


# --- catalogs --------------------------------------------------------------------------------------------------------


def catalogs(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    source = source_catalog(w.source_tables(spark, sf_dir), w.source_columns(spark, sf_dir))
    return source, target_catalog(w.target_columns(spark, sf_dir), catalog_name="migrated")


_CATALOG_ITEMS = """schema_name AS "SCHEMA_NAME", table_name AS "TABLE_NAME", column_name AS "COLUMN_NAME",
  column_position AS "COLUMN_POSITION", data_type AS "DATA_TYPE", character_max_length AS "CHARACTER_MAX_LENGTH",
  numeric_precision AS "NUMERIC_PRECISION", numeric_scale AS "NUMERIC_SCALE" """


@query("catalog_source", f"WITH {w.CATALOG_SQL} SELECT {_CATALOG_ITEMS} FROM src")
def catalog_source(spark, sf_dir):
    return catalogs(spark, sf_dir)[0]


@query("catalog_target", f"WITH {w.CATALOG_SQL} SELECT {_CATALOG_ITEMS} FROM tgt WHERE schema_name = 'DB3'")
def catalog_target(spark, sf_dir):
    found = target_catalog(w.target_columns(spark, sf_dir), catalog_name="migrated", schema_name="db3")
    return in_position_order(found)


@query(
    "catalog_columns",
    f"""WITH {w.CATALOG_SQL} SELECT trim(ColumnName) AS column_name, ColumnId AS column_id,
        ColumnType AS column_type FROM dbcols WHERE upper(trim(DatabaseName)) = 'DB2'""",
)
def catalog_columns(spark, sf_dir):
    return columns_of(w.source_columns(spark, sf_dir), "db2 ").selectExpr(
        "trim(ColumnName) AS column_name", "ColumnId AS column_id", "trim(ColumnType) AS column_type"
    )


@query(
    "type_mapping",
    f"""WITH {w.CATALOG_SQL} SELECT ColumnId AS column_id, ColumnType AS native_code, data_type,
        CAST(character_max_length AS BIGINT) AS character_max_length, CAST(numeric_precision AS BIGINT)
        AS numeric_precision, CAST(numeric_scale AS BIGINT) AS numeric_scale FROM mapped""",
)
def type_mapping(spark, sf_dir):
    code = "trim(ColumnType)"
    return w.source_columns(spark, sf_dir).selectExpr(
        "ColumnId AS column_id",
        f"{code} AS native_code",
        f"{typemap.common_type_name(code)} AS data_type",
        f"{typemap.character_length(code, 'ColumnLength', 'ColumnFormat')} AS character_max_length",
        f"{typemap.numeric_precision(code, 'DecimalTotalDigits')} AS numeric_precision",
        f"{typemap.numeric_scale(code, 'DecimalFractionalDigits')} AS numeric_scale",
    )


@query(
    "type_to_ddl",
    f"""WITH {w.CATALOG_SQL}, items AS (
        SELECT schema_name, table_name, column_name, column_position,
          if(data_type = 'NUMBER', 'decimal(' || numeric_precision || ',' || numeric_scale || ')',
             MAP {{'TEXT': 'string', 'TIME': 'string', 'TIMESTAMP_NTZ': 'timestamp_ntz', 'TIMESTAMP_TZ': 'timestamp',
                   'DATE': 'date', 'FLOAT': 'double'}}[data_type]) AS spark_type
        FROM src)
      SELECT schema_name AS "SCHEMA_NAME", table_name AS "TABLE_NAME",
        coalesce(string_agg('`' || column_name || '` ' || spark_type, ', ' ORDER BY column_position)
                 FILTER (spark_type IS NOT NULL), '') AS ddl,
        coalesce(string_agg(column_name, ',' ORDER BY column_position) FILTER (spark_type IS NULL), '')
                 AS unmapped_columns
      FROM items GROUP BY ALL""",
)
def type_to_ddl(spark, sf_dir):
    return reader_schemas(catalogs(spark, sf_dir)[0])


@query(
    "schema_compare",
    o.classified(w.CATALOG_SQL, ["schema_name", "table_name", "column_name"], w.CATALOG_VALUES)
    + """SELECT schema_name AS "SCHEMA_NAME", table_name AS "TABLE_NAME", column_name AS "COLUMN_NAME", status,
         data_type_source, data_type_target, column_position_match, data_type_match, character_max_length_match,
         numeric_precision_match, numeric_scale_match FROM cls WHERE status <> 'match'""",
)
def schema_compare(spark, sf_dir):
    rows = compare_catalogs(*catalogs(spark, sf_dir)).differences()
    return rows.selectExpr(
        "SCHEMA_NAME",
        "TABLE_NAME",
        "COLUMN_NAME",
        "row_status AS status",
        "source_row.DATA_TYPE AS data_type_source",
        "target_row.DATA_TYPE AS data_type_target",
        *[f"cell_matches.{c.upper()} AS {c}_match" for c in w.CATALOG_VALUES],
    )


# --- configuration ---------------------------------------------------------------------------------------------------

_CONFIG_LIST = ", ".join(f'{name} AS "{name}"' for name in CONFIG_COLUMNS)


@query("csv_config_read", f"WITH {w.CONFIG_SQL} SELECT {_CONFIG_LIST} FROM config")
def csv_config_read(spark, sf_dir):
    """Configuration rows written as CSV and read back with the fixed schema."""
    folder = scratch_folder(spark, "config")
    export_csv(w.config_rows(spark, sf_dir), folder)
    return read_config(spark, folder)


@query(
    "active_config",
    f"WITH {w.CONFIG_SQL} SELECT SOURCE_TABLE_NAME AS \"SOURCE_TABLE_NAME\", TYPE AS \"TYPE\" FROM config "
    "WHERE ACTIVE = 'Y'",
)
def active_config(spark, sf_dir):
    return active_rows(w.config_rows(spark, sf_dir)).select("SOURCE_TABLE_NAME", "TYPE")


@query(
    "config_parse",
    f"""WITH {w.CONFIG_SQL} SELECT lower(right(trim(LOB), 3)) AS "LOB_CODE", upper(trim(TYPE)) AS "TYPE",
        trim(WF_NAME) AS "WF_NAME", trim(SOURCE_SCHEMA_NAME) || '.' || trim(SOURCE_TABLE_NAME) AS "SOURCE_TABLE",
        trim(TARGET_SCHEMA_NAME) || '.' || trim(TARGET_TABLE_NAME) AS "TARGET_TABLE",
        CASE WHEN trim(UNIQUE_KEYS) <> '' THEN replace(trim(UNIQUE_KEYS), ' ', '') END AS unique_keys,
        CASE WHEN trim(UNIQUE_KEYS) = '' THEN 0 ELSE len(string_split(UNIQUE_KEYS, ',')) END AS key_count,
        CASE WHEN trim(SKIP_COLUMNS) <> '' THEN replace(trim(SKIP_COLUMNS), ' ', '') END AS skip_columns,
        CASE WHEN trim(AGGREGATE_FUNCTIONS) <> '' THEN replace(AGGREGATE_FUNCTIONS, ' ', '') END AS functions,
        SOURCE_FILTER AS "SOURCE_FILTER" FROM config""",
)
def config_parse(spark, sf_dir):
    def joined(name: str) -> str:
        return f"if({name} IS NULL, NULL, concat_ws(',', {name}))"

    return parse_config(w.config_rows(spark, sf_dir)).selectExpr(
        "LOB_CODE",
        "TYPE",
        "WF_NAME",
        "SOURCE_TABLE",
        "TARGET_TABLE",
        f"{joined('UNIQUE_KEYS')} AS unique_keys",
        "cast(coalesce(size(UNIQUE_KEYS), 0) AS bigint) AS key_count",
        f"{joined('SKIP_COLUMNS')} AS skip_columns",
        f"{joined('AGGREGATE_FUNCTIONS')} AS functions",
        "SOURCE_FILTER",
    )


# --- files -----------------------------------------------------------------------------------------------------------

_SIDES_SQL = r"""sides AS (
  SELECT path, regexp_extract(path, '^(.*)/[^/]*$', 1) AS folder,
         regexp_extract(path, '([^/]*)_(td|sf)\.csv$', 1) AS stem, regexp_extract(path, '_(td|sf)\.csv$', 1) AS side
  FROM files WHERE path LIKE '%\_td.csv' ESCAPE '\' OR path LIKE '%\_sf.csv' ESCAPE '\')"""


@query(
    "file_pairs",
    f"""WITH {w.FILES_SQL}, {_SIDES_SQL} SELECT s.folder, s.stem, s.path AS source_path, t.path AS target_path
        FROM sides s JOIN sides t ON s.folder = t.folder AND s.stem = t.stem WHERE s.side = 'td' AND t.side = 'sf'""",
)
def file_pairs(spark, sf_dir):
    return pair_files(w.dropped_paths(spark, sf_dir))


@query(
    "file_unpaired",
    f"""WITH {w.FILES_SQL}, {_SIDES_SQL}
        SELECT CASE side WHEN 'td' THEN 'source' ELSE 'target' END AS side, path FROM sides s
        WHERE NOT EXISTS (SELECT 1 FROM sides t WHERE t.folder = s.folder AND t.stem = s.stem AND t.side <> s.side)""",
)
def file_unpaired(spark, sf_dir):
    return unpaired_files(w.dropped_paths(spark, sf_dir))


@query(
    "unprocessed_files",
    f"WITH {w.FILES_SQL} SELECT path FROM files WHERE path NOT IN (SELECT path FROM ledger)",
)
def unprocessed_files_query(spark, sf_dir):
    return unprocessed_files(w.dropped_paths(spark, sf_dir), w.processed_paths(spark, sf_dir))


@query(
    "csv_pair_read",
    """SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS VARCHAR)
       AS c_acctbal, CASE WHEN c_custkey % 7 <> 0 THEN c_mktsegment ELSE '' END AS c_mktsegment FROM customer""",
)
def csv_pair_read(spark, sf_dir):
    """Customers written as CSV and read back as text, NULL as the empty string."""
    folder = scratch_folder(spark, "extract")
    rows = table(spark, sf_dir, "customer").selectExpr(
        "c_custkey",
        "c_name",
        f"cast(c_acctbal AS {w.MONEY}) AS c_acctbal",
        "if(c_custkey % 7 <> 0, c_mktsegment, NULL) AS c_mktsegment",
    )
    export_csv(rows, folder)
    return read_csv(spark, folder)


def _write_by_segment(spark, sf_dir) -> str:
    folder = scratch_folder(spark, "drop")
    table(spark, sf_dir, "customer").write.partitionBy("c_mktsegment").option("header", True).csv(folder)
    return folder


def _written_folders(files: DataFrame) -> DataFrame:
    return files.selectExpr(f"{base_name(folder_name('path'))} AS folder").distinct()


_WRITTEN_SQL = "SELECT DISTINCT 'c_mktsegment=' || c_mktsegment AS folder FROM customer"


@query("file_discovery", _WRITTEN_SQL)
def file_discovery(spark, sf_dir):
    return _written_folders(list_files(spark, _write_by_segment(spark, sf_dir), ".csv"))


@query(
    "file_listing",
    """SELECT 'c_nationkey=' || c_nationkey AS folder, 1::BIGINT AS files,
       CAST(sum(strlen(c_name) + strlen(c_mktsegment) + 2) AS BIGINT) AS bytes FROM customer GROUP BY c_nationkey""",
)
def file_listing(spark, sf_dir):
    """Number and length of the files in every folder, one for each nation, told without reading them."""
    folder = scratch_folder(spark, "drop")
    lines = table(spark, sf_dir, "customer").selectExpr("c_nationkey", "concat(c_name, ',', c_mktsegment) AS line")
    lines.repartition("c_nationkey").write.partitionBy("c_nationkey").text(folder)
    listed = list_files(spark, folder, ".txt").selectExpr(f"{base_name(folder_name('path'))} AS folder", "length")
    return listed.groupBy("folder").agg(F.expr("count(1) AS files"), F.expr("sum(length) AS bytes"))


@query("file_arrivals", _WRITTEN_SQL)
def file_arrivals(spark, sf_dir):
    """The same folder taken in as a stream of files."""
    arrivals, checkpoint = scratch_folder(spark, "arrivals"), scratch_folder(spark, "arrivals-state")
    record_arrivals(spark, _write_by_segment(spark, sf_dir), arrivals, checkpoint)
    return _written_folders(spark.read.parquet(arrivals))


# --- reports and runs ------------------------------------------------------------------------------------------------


@query(
    "report_metrics",
    TRIMMED_CLS
    + f""", metrics AS ({o.METRICS})
        SELECT 'orders' AS table_name, 'content' AS check_name, metric, CAST(value AS VARCHAR) AS value
        FROM (UNPIVOT metrics ON COLUMNS(*) INTO NAME metric VALUE value)""",
)
def report_metrics(spark, sf_dir):
    return metric_rows(trimmed_orders(spark, sf_dir).counts(), table="orders", check="content")


@query(
    "csv_export_differences",
    TRIMMED_CLS
    + """SELECT 'orders' AS diff_table, 'content' AS diff_check, status AS diff_status,
         CAST(o_orderkey AS VARCHAR) AS o_orderkey, coalesce(CAST(o_totalprice_source AS VARCHAR), '') AS price_source,
         coalesce(o_orderstatus_target, '') AS status_target,
         CAST(o_totalprice_match AS VARCHAR) AS price_match FROM cls WHERE status <> 'match'""",
)
def csv_export_differences(spark, sf_dir):
    """All difference classes written in one job and read back."""
    folder = scratch_folder(spark, "differences")
    export_differences(trimmed_orders(spark, sf_dir), folder, table="orders", check="content")
    return read_export(spark, folder).selectExpr(
        "diff_table",
        "diff_check",
        "diff_status",
        "o_orderkey",
        "coalesce(o_totalprice_source, '') AS price_source",
        "coalesce(o_orderstatus_target, '') AS status_target",
        "o_totalprice_match AS price_match",
    )


ORDERS_SPEC = PairSpec(
    source_table="sales.orders",
    target_table="copy.orders",
    keys=("O_ORDERKEY",),
    aggregate_columns=("O_TOTALPRICE", "O_ORDERDATE", "O_ORDERSTATUS"),
    aggregate_functions=("SUM", "MAX", "COUNT"),
)
_FREQUENCIES = "SELECT o_orderstatus, count(*) AS n FROM {} GROUP BY o_orderstatus"
_ORDERS_SUMMARY = f""", sides AS (
    SELECT CASE WHEN sum(source_rows) = sum(target_rows) THEN 'MATCH' ELSE 'MISMATCH' END AS rows_status,
      CASE WHEN count(*) FILTER (status <> 'match') = 0 THEN 'MATCH' ELSE 'MISMATCH' END AS content_status,
      CASE WHEN (SELECT sum(o_totalprice) FROM srct) = (SELECT sum(o_totalprice) FROM tgtt)
        AND (SELECT max(o_orderdate) FROM srct) = (SELECT max(o_orderdate) FROM tgtt)
        AND NOT EXISTS ({_FREQUENCIES.format("srct")} EXCEPT {_FREQUENCIES.format("tgtt")})
        AND NOT EXISTS ({_FREQUENCIES.format("tgtt")} EXCEPT {_FREQUENCIES.format("srct")})
        THEN 'MATCH' ELSE 'MISMATCH' END AS agg_status,
      CAST(sum(source_rows) AS BIGINT) AS n, CAST(sum(target_rows) AS BIGINT) AS m FROM cls)
  SELECT CASE WHEN 'MISMATCH' IN (rows_status, content_status, agg_status) THEN 'MISMATCH' ELSE 'MATCH' END AS "STATUS",
  'sales.orders' AS "SOURCE_TABLE", 'copy.orders' AS "TARGET_TABLE", rows_status AS "ROW_COUNT_STATUS",
  'UNKNOWN' AS "DATA_TYPE_STATUS", content_status AS "DATA_CONTENT_STATUS", agg_status AS "AGG_STATUS",
  CAST(n AS VARCHAR) AS "SOURCE_ROW_COUNT", CAST(m AS VARCHAR) AS "TARGET_ROW_COUNT", '' AS "SOURCE_FILTER",
  '' AS "TARGET_FILTER" FROM sides"""


def _plain_summary(table: str, source: str, target: str) -> str:
    """Summary of two selections that are compared in rows and content alone."""
    return f"""SELECT CASE WHEN 'MISMATCH' IN (r, c) THEN 'MISMATCH' ELSE 'MATCH' END, 'sales.{table}', 'copy.{table}', r,
      'UNKNOWN', c, 'UNKNOWN', CAST(n AS VARCHAR), CAST(m AS VARCHAR), '', ''
      FROM (SELECT n, m, CASE WHEN n = m THEN 'MATCH' ELSE 'MISMATCH' END AS r,
        CASE WHEN NOT EXISTS ({source} EXCEPT ALL {target}) AND NOT EXISTS ({target} EXCEPT ALL {source})
          THEN 'MATCH' ELSE 'MISMATCH' END AS c
        FROM (SELECT (SELECT count(*) FROM ({source})) AS n, (SELECT count(*) FROM ({target})) AS m))"""


_PARTS = "SELECT p_partkey, p_name, p_brand, p_size FROM part"
_TIMELESS = [name for name in SUMMARY_COLUMNS if name != "VALIDATION_TIME"]


@query("validate_pair", TRIMMED_CLS + _ORDERS_SUMMARY)
def validate_pair_query(spark, sf_dir):
    return validate_pair(*w.orders_pair(spark, sf_dir), ORDERS_SPEC).select(*_TIMELESS)


@query("validate_pair_pruned", TRIMMED_CLS + _ORDERS_SUMMARY)
def validate_pair_pruned(spark, sf_dir):
    """The same pair with equal parts recognised by digests."""
    return validate_pair(*w.orders_pair(spark, sf_dir), ORDERS_SPEC, prune=True).select(*_TIMELESS)


@query(
    "run_summary",
    TRIMMED_CLS
    + _ORDERS_SUMMARY
    + " UNION ALL " + _plain_summary("customer", "SELECT * FROM customer", "SELECT * FROM customer")
    + " UNION ALL " + _plain_summary("part", _PARTS, f"{_PARTS} WHERE p_partkey % 101 <> 0"),
)
def run_summary(spark, sf_dir):
    """Three pairs in one run: drifted orders, an intact customer copy, and parts compared without a key."""
    customer = table(spark, sf_dir, "customer")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_size")
    pairs = {
        ORDERS_SPEC: w.orders_pair(spark, sf_dir),
        PairSpec("sales.customer", "copy.customer", "VIEW", keys=("c_custkey",)): (customer, customer),
        PairSpec("sales.part", "copy.part"): (part, part.where("p_partkey % 101 <> 0")),
    }
    summary = run_pairs(spark, list(pairs), lambda spec: plan_pair(*pairs[spec], spec), parallel=3)
    return summary.select(*_TIMELESS)


# --- checks around a migration ---------------------------------------------------------------------------------------


@query(
    "etl_audit",
    """SELECT 'table_' || user_id AS source_table_name, CAST(date_trunc('second', ts) AS VARCHAR) AS start_time,
       event_id AS load_count, 'full' AS load_type, 'SELECT * FROM table_' || user_id AS extract_query
       FROM events WHERE event_type = 'purchase' AND 'job_' || user_id IN (
         SELECT 'job_' || c_custkey FROM customer WHERE 'wf_' || c_mktsegment = 'wf_BUILDING')""",
)
def etl_audit(spark, sf_dir):
    audit = table(spark, sf_dir, "events").selectExpr(
        "concat('job_', user_id) AS job_name",
        "concat('table_', user_id) AS source_table_name",
        "cast(date_trunc('second', ts) AS timestamp_ntz) AS start_time",
        "event_id AS load_count",
        "'full' AS load_type",
        "concat('SELECT * FROM table_', user_id) AS extract_query",
        "if(event_type = 'purchase', 'SUCCESS', upper(event_type)) AS status",
    )
    inventory = table(spark, sf_dir, "customer").selectExpr(
        "concat('job_', c_custkey) AS job_name", "concat('wf_', c_mktsegment) AS wf_name"
    )
    return plain(successful_loads(audit, inventory, "wf_BUILDING"))


@query(
    "future_dates",
    """WITH dated AS (
        SELECT CASE WHEN o_orderkey % 53 = 0 THEN NULL WHEN o_orderkey % 67 = 0 THEN DATE '9999-12-31'
                    ELSE CAST(o_orderdate AS DATE) END AS valid_to, CAST(o_orderdate AS DATE) AS order_day FROM orders),
      days AS (SELECT 'valid_to' AS column_name, valid_to AS d FROM dated
               UNION ALL SELECT 'order_day', order_day FROM dated)
      SELECT column_name, count(*) FILTER (d IS NULL) AS null_rows,
        count(*) FILTER (d BETWEEN DATE '1995-02-01' AND DATE '2000-01-01') AS normal_rows,
        count(*) FILTER (d > DATE '2000-01-01' AND d <= DATE '2262-04-11') AS future_rows,
        count(*) FILTER (d < DATE '1995-02-01' OR d > DATE '2262-04-11') AS out_of_range_rows,
        CAST(max(d) AS VARCHAR) AS latest_date FROM days GROUP BY column_name""",
)
def future_dates_query(spark, sf_dir):
    dated = table(spark, sf_dir, "orders").selectExpr(
        "CASE WHEN o_orderkey % 53 = 0 THEN NULL WHEN o_orderkey % 67 = 0 THEN DATE '9999-12-31' "
        "ELSE cast(o_orderdate AS date) END AS valid_to",
        "cast(o_orderdate AS date) AS order_day",
    )
    return future_dates(dated, "2000-01-01", lowest="1995-02-01", highest="2262-04-11")


@query(
    "business_query_compare",
    f"""WITH {w.ORDERS_SQL},
      s AS (SELECT o_custkey, sum(o_totalprice) AS revenue, count(*) AS orders FROM src GROUP BY ALL),
      t AS (SELECT o_custkey, sum(o_totalprice) AS revenue, count(*) AS orders FROM tgt GROUP BY ALL)
      SELECT coalesce(s.o_custkey, t.o_custkey) AS o_custkey,
        CASE WHEN t.o_custkey IS NULL THEN 'only_source' WHEN s.o_custkey IS NULL THEN 'only_target'
             ELSE 'mismatch' END AS status,
        CAST(CAST(s.revenue AS DECIMAL(28,2)) AS VARCHAR) AS source_revenue,
        CAST(CAST(t.revenue AS DECIMAL(28,2)) AS VARCHAR) AS target_revenue
      FROM s FULL JOIN t ON s.o_custkey = t.o_custkey
      WHERE s.revenue IS DISTINCT FROM t.revenue OR s.orders IS DISTINCT FROM t.orders""",
)
def business_query_compare(spark, sf_dir):
    source, target = w.orders_pair(spark, sf_dir)
    statement = "SELECT o_custkey, sum(o_totalprice) AS revenue, count(*) AS orders FROM {%s} GROUP BY o_custkey"
    compared = compare_queries(
        spark, statement % "src", statement % "tgt", ["o_custkey"], tables={"src": source, "tgt": target}
    )
    return compared.differences().selectExpr(
        "o_custkey",
        "row_status AS status",
        "cast(source_row.revenue AS string) AS source_revenue",
        "cast(target_row.revenue AS string) AS target_revenue",
    )


@query("csv_roundtrip", "SELECT doc_id, md5(text) AS digest FROM documents")
def csv_roundtrip(spark, sf_dir):
    """Texts with quotes, backslashes and line breaks, written as CSV and read again."""
    folder = f"{scratch_folder(spark, 'csv')}/documents"
    export_csv(table(spark, sf_dir, "documents").select("doc_id", "text"), folder)
    return read_csv(spark, folder, multi_line=True).selectExpr("cast(doc_id AS bigint) AS doc_id", "md5(text) AS digest")


RENAMED_SQL = f"""{w.CATALOG_SQL},
one AS (SELECT * FROM src WHERE table_name = 'TAB_0'), other AS (SELECT * FROM tgt WHERE table_name = 'TAB_0')"""


@query(
    "schema_compare_renamed",
    o.classified(RENAMED_SQL, ["column_name"], w.CATALOG_VALUES, source="one", target="other")
    + 'SELECT column_name AS "COLUMN_NAME", status FROM cls',
)
def schema_compare_renamed(spark, sf_dir):
    """Types of one table that bears another name in the target."""
    source, target = (side.where("TABLE_NAME = 'TAB_0'") for side in catalogs(spark, sf_dir))
    renamed = target.selectExpr("* EXCEPT (SCHEMA_NAME, TABLE_NAME)", "'MOVED' AS SCHEMA_NAME", "'NEW_NAME' AS TABLE_NAME")
    return compare_catalogs(source, renamed, one_table=True).rows.selectExpr("COLUMN_NAME", "row_status AS status")
