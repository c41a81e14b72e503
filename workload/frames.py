"""Source/target pairs, catalogs, configurations and file lists, all derived from the synthetic tables.

Each Spark derivation has its SQL twin beside it, as the text of one or more common table expressions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from twincheck.functions.sqltext import array, literal
from workload.registry import table

MONEY = "decimal(18,2)"


# --- orders, with drift ----------------------------------------------------------------------------------------------

ORDER_KEY = ["o_orderkey"]
ORDER_VALUES = ["o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]


def orders_pair(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    raw = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey",
        "o_custkey",
        "o_orderstatus",
        f"cast(o_totalprice AS {MONEY}) AS o_totalprice",
        "o_orderdate",
        "o_orderpriority",
    )
    source = raw.withColumn("o_orderpriority", F.expr("if(o_orderkey % 59 <> 0, o_orderpriority, NULL)"))
    changed = source.where("o_orderkey % 97 <> 0").selectExpr(
        "o_orderkey",
        "o_custkey",
        "if(o_orderkey % 53 <> 0, o_orderstatus, NULL) AS o_orderstatus",
        f"cast(o_totalprice + if(o_orderkey % 31 = 0, 0.01, 0.00) AS {MONEY}) AS o_totalprice",
        "o_orderdate",
        "if(o_orderkey % 41 = 0, concat(o_orderpriority, '  '), o_orderpriority) AS o_orderpriority",
    )
    extra = raw.where("o_orderkey % 89 = 0").withColumn("o_orderkey", F.expr("-1 - o_orderkey"))
    return source, changed.unionByName(extra)


ORDERS_SQL = """
raw AS (
  SELECT o_orderkey, o_custkey, o_orderstatus, CAST(o_totalprice AS DECIMAL(18,2)) AS o_totalprice, o_orderdate,
         o_orderpriority
  FROM orders),
src AS (
  SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
         CASE WHEN o_orderkey % 59 <> 0 THEN o_orderpriority END AS o_orderpriority
  FROM raw),
tgt AS (
  SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 53 <> 0 THEN o_orderstatus END AS o_orderstatus,
         CAST(o_totalprice + CASE WHEN o_orderkey % 31 = 0 THEN 0.01 ELSE 0 END AS DECIMAL(18,2)) AS o_totalprice,
         o_orderdate,
         CASE WHEN o_orderkey % 41 = 0 THEN o_orderpriority || '  ' ELSE o_orderpriority END AS o_orderpriority
  FROM src WHERE o_orderkey % 97 <> 0
  UNION ALL
  SELECT -1 - o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
  FROM raw WHERE o_orderkey % 89 = 0)"""

# --- line items: a key with duplicates -------------------------------------------------------------------------------

LINE_KEY = ["l_orderkey", "l_linenumber"]
LINE_VALUES = ["l_partkey", "l_quantity", "l_returnflag"]


def lines_pair(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    source = table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey",
        "cast(l_linenumber AS bigint) AS l_linenumber",
        "l_partkey",
        f"cast(l_quantity AS {MONEY}) AS l_quantity",
        "l_returnflag",
    )
    target = source.where("l_partkey % 23 <> 0").withColumn(
        "l_returnflag", F.expr("if(l_orderkey % 29 <> 0, l_returnflag, NULL)")
    )
    return source, target


LINES_SQL = """
src AS (
  SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey,
         CAST(l_quantity AS DECIMAL(18,2)) AS l_quantity, l_returnflag
  FROM lineitem),
tgt AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_quantity,
         CASE WHEN l_orderkey % 29 <> 0 THEN l_returnflag END AS l_returnflag
  FROM src WHERE l_partkey % 23 <> 0)"""



def repeated_pair(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Repeated keys whose smallest rows agree: the target changes later rows, and how often some rows occur."""
    source, _ = lines_pair(spark, sf_dir)
    source = source.unionAll(source.where("l_orderkey % 5 = 0"))
    changed = source.withColumn("l_returnflag", F.expr("if(l_partkey % 31 = 30, NULL, l_returnflag)"))
    return source, changed.unionAll(source.where("l_orderkey % 41 = 0"))


REPEATED_SQL = """
lines AS (
  SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey,
         CAST(l_quantity AS DECIMAL(18,2)) AS l_quantity, l_returnflag
  FROM lineitem),
src AS (SELECT * FROM lines UNION ALL SELECT * FROM lines WHERE l_orderkey % 5 = 0),
tgt AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, if(l_partkey % 31 = 30, NULL, l_returnflag) AS l_returnflag
  FROM src UNION ALL SELECT * FROM src WHERE l_orderkey % 41 = 0)"""

# --- customers in file order -----------------------------------------------------------------------------------------


def customers_pair(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Scans without a shuffle, so file order is known. The source lacks some rows, so later rows shift."""
    raw = table(spark, sf_dir, "customer").selectExpr(
        "c_custkey", "c_name", f"cast(c_acctbal AS {MONEY}) AS c_acctbal", "c_mktsegment"
    )
    source = raw.where("c_custkey % 211 <> 0")
    target = raw.withColumn("c_acctbal", F.expr("if(c_custkey % 71 <> 0, c_acctbal, NULL)")).where(
        "c_custkey % 307 <> 0"
    )
    return source, target


CUSTOMERS_SQL = """
raw AS (
  SELECT c_custkey, c_name, CAST(c_acctbal AS DECIMAL(18,2)) AS c_acctbal, c_mktsegment FROM customer),
src AS (
  SELECT row_number() OVER (ORDER BY c_custkey) - 1 AS row_index, * FROM raw WHERE c_custkey % 211 <> 0),
tgt AS (
  SELECT row_number() OVER (ORDER BY c_custkey) - 1 AS row_index, c_custkey, c_name,
         CASE WHEN c_custkey % 71 <> 0 THEN c_acctbal END AS c_acctbal, c_mktsegment
  FROM raw WHERE c_custkey % 307 <> 0)"""

# --- column catalogs -------------------------------------------------------------------------------------------------

COLUMNS_PER_TABLE = 30
# Native codes, each with its common type and the rules for its length, precision and scale.
NATIVE_TYPES = [
    ("I", "NUMBER", "", "whole", ""),
    ("N", "NUMBER", "", "whole", "declared or floating"),
    ("D", "NUMBER", "", "declared", "declared"),
    ("I1", "NUMBER", "", "whole", ""),
    ("I8", "NUMBER", "", "whole", ""),
    ("I2", "NUMBER", "", "whole", ""),
    ("BO", "TEXT", "bytes", "", ""),
    ("BF", "TEXT", "bytes", "", ""),
    ("BV", "TEXT", "bytes", "", ""),
    ("CF", "TEXT", "characters", "", ""),
    ("CV", "TEXT", "characters", "", ""),
    ("CO", "TEXT", "characters", "", ""),
    ("DY", "TEXT", "interval", "", ""),
    ("DH", "TEXT", "interval", "", ""),
    ("DM", "TEXT", "interval", "", ""),
    ("DS", "TEXT", "interval", "", ""),
    ("HR", "TEXT", "interval", "", ""),
    ("HM", "TEXT", "interval", "", ""),
    ("HS", "TEXT", "interval", "", ""),
    ("MI", "TEXT", "interval", "", ""),
    ("MS", "TEXT", "interval", "", ""),
    ("MO", "TEXT", "interval", "", ""),
    ("SC", "TEXT", "interval", "", ""),
    ("YR", "TEXT", "interval", "", ""),
    ("YM", "TEXT", "interval", "", ""),
    ("PS", "TEXT", "bytes", "", ""),
    ("TS", "TIMESTAMP_NTZ", "", "", ""),
    ("SZ", "TIMESTAMP_TZ", "", "", ""),
    ("AT", "TIME", "", "", ""),
    ("DA", "DATE", "", "", ""),
    ("F", "FLOAT", "", "", ""),
]
UNKNOWN_CODE = "XX"
NATIVE_CODES = [code for code, *_ in NATIVE_TYPES] + [UNKNOWN_CODE]
OBJECT_KINDS = ["O", "T", "V", "I", "M"]


def _pick(items: list[str], number: str) -> str:
    return f"element_at({array(map(literal, items))}, cast(pmod({number}, {len(items)}) + 1 AS int))"


def source_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw source catalog: every part is a column; tables hold 30 columns each."""
    table_number = f"p_partkey DIV {COLUMNS_PER_TABLE}"
    return table(spark, sf_dir, "part").selectExpr(
        f"concat(' Db', ({table_number}) % 7) AS DatabaseName",
        f"concat('tab_', {table_number}, '  ') AS TableName",
        "concat('col_', p_partkey, ' ') AS ColumnName",
        "p_partkey AS ColumnId",
        f"rpad({_pick(NATIVE_CODES, 'p_partkey')}, 2, ' ') AS ColumnType",
        "cast(p_size AS bigint) * 2 AS ColumnLength",
        "concat('X(', p_size, ')') AS ColumnFormat",
        "cast(p_size % 18 + 19 AS bigint) AS DecimalTotalDigits",
        "cast(if(p_size % 5 = 0, -128, p_size % 5) AS bigint) AS DecimalFractionalDigits",
    )


def source_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = source_columns(spark, sf_dir).select("DatabaseName", "TableName").distinct()
    number = "cast(regexp_extract(TableName, '([0-9]+)', 1) AS bigint)"
    return names.selectExpr("*", f"{_pick(OBJECT_KINDS, number)} AS TableKind")


def target_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw information-schema columns of the migrated tables, with drift."""
    table_number = f"p_partkey DIV {COLUMNS_PER_TABLE}"
    numbers, texts = (
        ", ".join(literal(code) for code, kind, *_ in NATIVE_TYPES if kind == wanted) for wanted in ("NUMBER", "TEXT")
    )
    coded = table(spark, sf_dir, "part").where("p_partkey % 43 <> 0")
    return coded.selectExpr("*", f"{_pick(NATIVE_CODES, 'p_partkey')} AS code").selectExpr(
        "'MIGRATED' AS table_catalog",
        f"concat('DB', ({table_number}) % 7) AS table_schema",
        f"concat('TAB_', {table_number}) AS table_name",
        "concat('COL_', p_partkey) AS column_name",
        f"p_partkey % {COLUMNS_PER_TABLE} + 1 AS ordinal_position",
        f"CASE WHEN code IN ({numbers}) THEN 'NUMBER' WHEN code IN ({texts}) THEN 'TEXT' "
        "WHEN code IN ('TS', 'SZ') THEN 'TIMESTAMP_NTZ' WHEN code = 'DA' THEN 'DATE' WHEN code = 'F' THEN 'FLOAT' "
        "ELSE 'VARIANT' END AS data_type",
        f"if(code IN ({texts}), p_size, NULL) AS character_maximum_length",
        f"if(code IN ({numbers}), 38, NULL) AS numeric_precision",
        f"if(code IN ({numbers}), p_size % 5, NULL) AS numeric_scale",
    )


_CODES_SQL = "[" + ", ".join(f"'{code}'" for code in NATIVE_CODES) + "]"
_KINDS_SQL = "[" + ", ".join(f"'{kind}'" for kind in OBJECT_KINDS) + "]"
_RULES_SQL = ", ".join(f"({', '.join(map(literal, row))})" for row in NATIVE_TYPES)

CATALOG_SQL = f"""
rules(code, common_type, length_rule, precision_rule, scale_rule) AS (VALUES {_RULES_SQL}),
dbcols AS (
  SELECT ' Db' || ((p_partkey // {COLUMNS_PER_TABLE}) % 7) AS DatabaseName,
         'tab_' || (p_partkey // {COLUMNS_PER_TABLE}) || '  ' AS TableName,
         'col_' || p_partkey || ' ' AS ColumnName, p_partkey AS ColumnId,
         {_CODES_SQL}[CAST(p_partkey % {len(NATIVE_CODES)} AS INTEGER) + 1] AS ColumnType,
         CAST(p_size AS BIGINT) * 2 AS ColumnLength, 'X(' || p_size || ')' AS ColumnFormat,
         CAST(p_size % 18 + 19 AS BIGINT) AS DecimalTotalDigits,
         CAST(CASE WHEN p_size % 5 = 0 THEN -128 ELSE p_size % 5 END AS BIGINT) AS DecimalFractionalDigits,
         p_partkey // {COLUMNS_PER_TABLE} AS table_number
  FROM part),
dbtabs AS (
  SELECT DISTINCT DatabaseName, TableName,
         {_KINDS_SQL}[CAST(table_number % {len(OBJECT_KINDS)} AS INTEGER) + 1] AS TableKind
  FROM dbcols),
mapped AS (
  SELECT d.*, coalesce(common_type, 'UNKNOWN') AS data_type,
    coalesce(MAP {{'bytes': ColumnLength, 'characters': ColumnLength // 2, 'interval': 20}}[length_rule], 0)
      AS character_max_length,
    coalesce(MAP {{'whole': 38, 'declared': DecimalTotalDigits}}[precision_rule], 0) AS numeric_precision,
    coalesce(MAP {{'declared': DecimalFractionalDigits, 'declared or floating':
      if(DecimalFractionalDigits < 0, 10, DecimalFractionalDigits)}}[scale_rule], 0) AS numeric_scale
  FROM dbcols d LEFT JOIN rules ON code = ColumnType),
src AS (
  SELECT upper(trim(m.DatabaseName)) AS schema_name, upper(trim(m.TableName)) AS table_name,
         upper(trim(m.ColumnName)) AS column_name,
         row_number() OVER (PARTITION BY m.DatabaseName, m.TableName ORDER BY m.ColumnId) AS column_position,
         data_type, CAST(character_max_length AS BIGINT) AS character_max_length,
         CAST(numeric_precision AS BIGINT) AS numeric_precision, CAST(numeric_scale AS BIGINT) AS numeric_scale
  FROM mapped m JOIN dbtabs t ON m.DatabaseName = t.DatabaseName AND m.TableName = t.TableName
  WHERE t.TableKind IN ('O', 'T', 'V')),
info AS (
  SELECT 'MIGRATED' AS table_catalog, 'DB' || ((p_partkey // {COLUMNS_PER_TABLE}) % 7) AS table_schema,
         'TAB_' || (p_partkey // {COLUMNS_PER_TABLE}) AS table_name, 'COL_' || p_partkey AS column_name,
         p_partkey % {COLUMNS_PER_TABLE} + 1 AS ordinal_position,
         coalesce(MAP {{'NUMBER': 'NUMBER', 'TEXT': 'TEXT', 'TIMESTAMP_NTZ': 'TIMESTAMP_NTZ', 'FLOAT': 'FLOAT',
           'TIMESTAMP_TZ': 'TIMESTAMP_NTZ', 'DATE': 'DATE'}}[common_type], 'VARIANT') AS data_type,
         if(common_type = 'TEXT', p_size, NULL) AS character_maximum_length,
         if(common_type = 'NUMBER', 38, NULL) AS numeric_precision,
         if(common_type = 'NUMBER', p_size % 5, NULL) AS numeric_scale
  FROM part JOIN dbcols ON ColumnId = p_partkey LEFT JOIN rules ON code = ColumnType WHERE p_partkey % 43 <> 0),
tgt AS (
  SELECT table_schema AS schema_name, table_name, column_name, CAST(ordinal_position AS BIGINT) AS column_position,
         data_type, CAST(coalesce(character_maximum_length, 0) AS BIGINT) AS character_max_length,
         CAST(coalesce(numeric_precision, 0) AS BIGINT) AS numeric_precision,
         CAST(coalesce(numeric_scale, 0) AS BIGINT) AS numeric_scale
  FROM info)"""
CATALOG_VALUES = ["column_position", "data_type", "character_max_length", "numeric_precision", "numeric_scale"]

# --- configuration rows ----------------------------------------------------------------------------------------------


def config_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One configuration row per customer, with blanks, padding and missing values."""

    def pick(*items: str) -> str:
        return _pick(list(items), "c_custkey")

    return table(spark, sf_dir, "customer").selectExpr(
        f"{pick('Y', 'N', '')} AS ACTIVE",
        "concat(initcap(c_mktsegment), ': ', substring(c_mktsegment, 1, 3)) AS LOB",
        f"{pick('table', 'VIEW', ' Table ', 'report')} AS TYPE",
        "concat(' wf_', c_nationkey, ' ') AS WF_NAME",
        "concat('S', c_nationkey, ' ') AS SOURCE_SCHEMA_NAME",
        "c_name AS SOURCE_TABLE_NAME",
        "concat(' T', c_nationkey) AS TARGET_SCHEMA_NAME",
        "upper(c_name) AS TARGET_TABLE_NAME",
        f"{pick('*', 'ID, NAME', 'ID')} AS SOURCE_COLUMNS",
        "'*' AS TARGET_COLUMNS",
        f"{pick('', 'ID', ' ID , LINE ,SEQ')} AS UNIQUE_KEYS",
        "if(c_custkey % 2 = 0, 'LOADED_AT, LOADED_BY', NULL) AS SKIP_COLUMNS",
        "cast(NULL AS string) AS DELTA_COLUMNS",
        "if(c_custkey % 4 = 1, concat('WHERE day > ', c_custkey), NULL) AS SOURCE_FILTER",
        "'' AS TARGET_FILTER",
        f"{pick('', 'PRICE,QTY,FLAG')} AS AGGREGATE_COLUMNS",
        f"{pick('', 'SUM, avg,COUNT')} AS AGGREGATE_FUNCTIONS",
    )


CONFIG_SQL = """
config AS (
  SELECT ['Y', 'N', ''][CAST(c_custkey % 3 AS INTEGER) + 1] AS ACTIVE,
         upper(c_mktsegment[1]) || lower(c_mktsegment[2:]) || ': ' || c_mktsegment[1:3] AS LOB,
         ['table', 'VIEW', ' Table ', 'report'][CAST(c_custkey % 4 AS INTEGER) + 1] AS TYPE,
         ' wf_' || c_nationkey || ' ' AS WF_NAME, 'S' || c_nationkey || ' ' AS SOURCE_SCHEMA_NAME,
         c_name AS SOURCE_TABLE_NAME, ' T' || c_nationkey AS TARGET_SCHEMA_NAME, upper(c_name) AS TARGET_TABLE_NAME,
         ['*', 'ID, NAME', 'ID'][CAST(c_custkey % 3 AS INTEGER) + 1] AS SOURCE_COLUMNS, '*' AS TARGET_COLUMNS,
         ['', 'ID', ' ID , LINE ,SEQ'][CAST(c_custkey % 3 AS INTEGER) + 1] AS UNIQUE_KEYS,
         CASE WHEN c_custkey % 2 = 0 THEN 'LOADED_AT, LOADED_BY' ELSE '' END AS SKIP_COLUMNS, '' AS DELTA_COLUMNS,
         CASE WHEN c_custkey % 4 = 1 THEN 'WHERE day > ' || c_custkey ELSE '' END AS SOURCE_FILTER,
         '' AS TARGET_FILTER, ['', 'PRICE,QTY,FLAG'][CAST(c_custkey % 2 AS INTEGER) + 1] AS AGGREGATE_COLUMNS,
         ['', 'SUM, avg,COUNT'][CAST(c_custkey % 2 AS INTEGER) + 1] AS AGGREGATE_FUNCTIONS
  FROM customer)"""

# --- dropped files ---------------------------------------------------------------------------------------------------


_STEM = "concat('/drop/', source, '/report_', doc_id DIV 2, if(doc_id % 2 = 0, '', '_late'))"


def dropped_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paths of report extracts: two per document, some missing, some with names that are prefixes of others."""
    endings = (
        "array_compact(array(if(doc_id % 11 <> 0, '_td.csv', NULL), if(doc_id % 13 <> 0, '_sf.csv', NULL), "
        "if(doc_id % 17 = 0, '.zip', NULL)))"
    )
    named = table(spark, sf_dir, "documents").selectExpr(f"{_STEM} AS stem", f"explode({endings}) AS ending")
    return named.selectExpr("concat(stem, ending) AS path")


def processed_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ledger: both extracts of every report whose document was labelled good."""
    good = table(spark, sf_dir, "labels").where("quality = 1").select("doc_id")
    named = table(spark, sf_dir, "documents").select("doc_id", "source").join(good, "doc_id")
    return named.selectExpr(f"{_STEM} AS stem", "explode(array('_td.csv', '_sf.csv')) AS ending").selectExpr(
        "concat(stem, ending) AS path"
    )


_STEM_SQL = "'/drop/' || source || '/report_' || (doc_id // 2) || CASE WHEN doc_id % 2 = 0 THEN '' ELSE '_late' END"
FILES_SQL = f"""
names AS (SELECT doc_id, {_STEM_SQL} AS stem FROM documents),
files AS (
  SELECT stem || '_td.csv' AS path FROM names WHERE doc_id % 11 <> 0
  UNION ALL SELECT stem || '_sf.csv' FROM names WHERE doc_id % 13 <> 0
  UNION ALL SELECT stem || '.zip' FROM names WHERE doc_id % 17 = 0),
ledger AS (
  SELECT stem || ending AS path
  FROM names JOIN labels USING (doc_id), (VALUES ('_td.csv'), ('_sf.csv')) e(ending) WHERE quality = 1)"""
