"""Queries on CSV extracts: line breaks in cells, ragged rows, and many pairs of files in a drop folder."""

from __future__ import annotations

from datetime import timedelta
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

from twincheck.operators.catalog import catalog_of, compare_catalogs
from twincheck.operators.positions import compare_positions
from twincheck.plans.drop import validate_drop
from twincheck.session import scratch_folder
from twincheck.sinks.exports import export_csv, read_export
from twincheck.sources.dropfolder import SOURCE_SUFFIX, TARGET_SUFFIX
from twincheck.sources.records import read_records
from twincheck.streaming.arrivals import PAIR_SCHEMA, append_stream, pair_arrivals
from workload import oracle_parts as o
from workload.registry import query, table

_POSITIONS = """SELECT CASE WHEN count(*) FILTER (status <> 'match') = 0 THEN 'MATCH' ELSE 'MISMATCH' END AS verdict,
  CAST(sum(source_rows) AS BIGINT) AS source_rows, CAST(sum(target_rows) AS BIGINT) AS target_rows,
  count(*) FILTER (status = 'mismatch') AS mismatched_rows,
  count(*) FILTER (status = 'only_source') AS surplus_source_rows,
  count(*) FILTER (status = 'only_target') AS surplus_target_rows,
  '' AS source_only_columns, '' AS target_only_columns FROM cls"""

_TEXTS_SQL = """
src AS (SELECT row_number() OVER (ORDER BY doc_id) - 1 AS row_index, CAST(doc_id AS VARCHAR) AS doc_id,
  coalesce(text, '') AS text, coalesce(lang, '') AS lang FROM documents),
tgt AS (SELECT row_number() OVER (ORDER BY doc_id) - 1 AS row_index, CAST(doc_id AS VARCHAR) AS doc_id,
  CASE WHEN doc_id % 37 = 0 THEN 'one "more"' || chr(10) || chr(10) || coalesce(text, '') ELSE coalesce(text, '') END AS text,
  CASE WHEN doc_id % 53 = 0 THEN '' ELSE coalesce(lang, '') END AS lang
  FROM documents WHERE doc_id <= (SELECT max(doc_id) - 3 FROM documents))"""


@query("positional_csv_multiline", o.classified(_TEXTS_SQL, ["row_index"], ["doc_id", "text", "lang"]) + _POSITIONS)
def positional_csv_multiline(spark, sf_dir):
    """Whole texts with quotes and line breaks, written as CSV in order, read back in splits and compared row by row."""
    source = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    last = source.selectExpr("max(doc_id) - 3 AS last")
    target = source.join(last, source["doc_id"] <= last["last"]).selectExpr(
        "doc_id",
        "if(doc_id % 37 = 0, concat('one \"more\"\\n\\n', coalesce(text, '')), text) AS text",
        "if(doc_id % 53 = 0, NULL, lang) AS lang",
    )
    extracts = []
    for side, label in ((source, "source"), (target, "target")):
        folder = scratch_folder(spark, label)
        export_csv(side.orderBy("doc_id"), folder)
        extracts.append(read_records(spark, folder))
    return compare_positions(*extracts).verdict()


def _write_lines(lines: DataFrame, header: str, folder: str) -> None:
    """``line`` as it is, below a header line in each file."""
    raw = {"header": True, "sep": "\u0001", "quote": "", "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    lines.selectExpr(f"line AS `{header}`").write.options(**raw).csv(folder)


@query(
    "csv_ragged_rows",
    """SELECT 'MISMATCH' AS verdict, count(*) AS source_rows, count(*) AS target_rows,
       count(*) FILTER (c_custkey % 29 = 0 OR c_custkey % 31 = 0 OR c_custkey % 43 = 0) AS mismatched_rows,
       0::BIGINT AS surplus_source_rows, 0::BIGINT AS surplus_target_rows,
       '' AS source_only_columns, '' AS target_only_columns FROM customer""",
)
def csv_ragged_rows(spark, sf_dir):
    """Rows with thirty cells beyond the header: some differ in the last, some hold one more, some by a quoted delimiter."""
    tail = "transform(sequence(1, 30), i -> CASE WHEN i = 30 THEN {last} WHEN i = 5 THEN {fifth} ELSE concat('cell ', i) END)"
    sides = {
        "source": ("'last'", "if(c_custkey % 43 = 0, '\"a,b\"', 'a')", "NULL"),
        "target": ("if(c_custkey % 29 = 0, 'changed', 'last')", "if(c_custkey % 43 = 0, 'a,b', 'a')", "if(c_custkey % 31 = 0, 'x', NULL)"),
    }
    extracts = []
    for label, (last, fifth, more) in sides.items():
        folder = scratch_folder(spark, label)
        cells = f"c_custkey, c_name, concat_ws(',', {tail.format(last=last, fifth=fifth)}), {more}"
        lines = table(spark, sf_dir, "customer").orderBy("c_custkey").selectExpr(f"concat_ws(',', {cells}) AS line")
        _write_lines(lines, "c_custkey,c_name", folder)
        extracts.append(read_records(spark, folder))
    return compare_positions(*extracts).verdict()


PAIRS = 100


def write_extracts(frame: DataFrame, stem: str, suffix: str, folder: str) -> None:
    """One CSV file below ``folder`` for each value of ``stem``, named by it; rows go in the order of the other columns."""
    spark = frame.sparkSession
    written = scratch_folder(spark, "parts")
    rows = frame.repartition(stem).sortWithinPartitions(*frame.columns)
    rows.write.option("header", True).partitionBy(stem).csv(written)
    path = spark._jvm.org.apache.hadoop.fs.Path
    files = path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(path(folder))
    for part in files.globStatus(path(f"{written}/{stem}=*/part-*")):
        name = part.getPath().getParent().getName().removeprefix(f"{stem}=")
        files.rename(part.getPath(), path(f"{folder}/{name}{suffix}"))


_DROP_SQL = f"""
given AS (SELECT 'report_' || (c_custkey % {PAIRS}) AS stem, c_custkey, c_name,
  CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS VARCHAR) AS c_acctbal FROM customer),
src AS (SELECT *, row_number() OVER (PARTITION BY stem ORDER BY c_custkey) - 1 AS row_index FROM given),
tgt AS (SELECT stem, c_custkey, c_name, CASE WHEN c_custkey % 7 = 0 AND c_custkey % {PAIRS} % 3 = 0 THEN c_acctbal || '0'
    ELSE c_acctbal END AS c_acctbal, row_number() OVER (PARTITION BY stem ORDER BY c_custkey) - 1 AS row_index
  FROM given WHERE NOT (c_custkey % {PAIRS} % 10 = 4 AND c_custkey // {PAIRS} % 5 = 4))"""


_DROP_CLS = o.classified(_DROP_SQL, ["stem", "row_index"], ["c_custkey", "c_name", "c_acctbal"])


def _validated_drop(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, str]:
    """A hundred pairs of files written from the customers, validated in one go: the summary and the results' folder."""
    drop, output = scratch_folder(spark, "drop"), scratch_folder(spark, "results")
    source = table(spark, sf_dir, "customer").selectExpr(
        f"concat('report_', c_custkey % {PAIRS}) AS stem", "c_custkey", "c_name",
        "cast(cast(c_acctbal AS decimal(18,2)) AS string) AS c_acctbal",
    )
    target = source.where(f"NOT (c_custkey % {PAIRS} % 10 = 4 AND c_custkey DIV {PAIRS} % 5 = 4)").selectExpr(
        "stem", "c_custkey", "c_name",
        f"if(c_custkey % 7 = 0 AND c_custkey % {PAIRS} % 3 = 0, concat(c_acctbal, '0'), c_acctbal) AS c_acctbal",
    )
    write_extracts(source, "stem", SOURCE_SUFFIX, drop)
    write_extracts(target, "stem", TARGET_SUFFIX, drop)
    summary, _ = validate_drop(spark, drop, f"{output}/out", f"{output}/ledger")
    return summary, f"{output}/out"


@query(
    "drop_validate",
    _DROP_CLS
    + """SELECT stem, CASE WHEN count(*) FILTER (status <> 'match') = 0 THEN 'MATCH' ELSE 'MISMATCH' END AS verdict,
      CAST(sum(source_rows) AS BIGINT) AS source_rows, CAST(sum(target_rows) AS BIGINT) AS target_rows,
      count(*) FILTER (status = 'mismatch') AS mismatched_rows,
      count(*) FILTER (status = 'only_source') AS surplus_source_rows,
      count(*) FILTER (status = 'only_target') AS surplus_target_rows, '' AS error FROM cls GROUP BY stem""",
)
def drop_validate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A hundred pairs of files written from the customers, validated in one go."""
    return _validated_drop(spark, sf_dir)[0].drop("folder", "source_only_columns", "target_only_columns")


@query(
    "drop_differences",
    _DROP_CLS
    + """SELECT stem AS diff_table, status AS diff_status, CAST(row_index AS VARCHAR) AS row_index,
      coalesce(CAST(c_custkey_source AS VARCHAR), '') AS key_source, coalesce(c_acctbal_source, '') AS balance_source,
      coalesce(CAST(c_custkey_target AS VARCHAR), '') AS key_target, coalesce(c_acctbal_target, '') AS balance_target,
      CAST(c_acctbal_match AS VARCHAR) AS balance_match FROM cls WHERE status <> 'match'""",
)
def drop_differences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The differing rows of the same pairs, as they were written."""
    _, output = _validated_drop(spark, sf_dir)
    return read_export(spark, f"{output}/*/differences").selectExpr(
        "diff_table", "diff_status", "_row_index AS row_index",
        *[f"coalesce({column}_{side}, '') AS {name}_{side}" for side in ("source", "target")
          for column, name in (("c_custkey", "key"), ("c_acctbal", "balance"))],
        "c_acctbal_match AS balance_match",
    )


_FATES_SQL = """
WITH names AS (SELECT doc_id, '/drop/' || source AS folder, 'report_' || doc_id AS stem,
  CASE WHEN doc_id % 11 <> 0 THEN [0, 1, 3][CAST(doc_id % 3 + 1 AS INTEGER)] END AS s,
  CASE WHEN doc_id % 13 <> 0 THEN [0, 1, 3][CAST(doc_id // 3 % 3 + 1 AS INTEGER)] END AS t FROM documents)
SELECT folder, stem, CASE WHEN s IS NOT NULL THEN folder || '/' || stem || '_td.csv' END AS source_path,
  CASE WHEN t IS NOT NULL THEN folder || '/' || stem || '_sf.csv' END AS target_path,
  CASE WHEN s IS NULL OR t IS NULL THEN 'unpaired' WHEN abs(s - t) > 1.5 THEN 'late pair' ELSE 'pair' END AS status
FROM names WHERE (s IS NOT NULL AND t IS NOT NULL) OR coalesce(s, t) < 3"""


@query("drop_pair_stream", _FATES_SQL)
def drop_pair_stream(spark, sf_dir):
    """Extracts of every document that come in three drops, on days 0, 1 and 3, and may wait for 36 hours."""
    folder, pairs, state = (scratch_folder(spark, label) for label in ("listing", "pairs", "pairs-state"))
    day = "element_at(array(0, 1, 3), cast({0} % 3 + 1 AS int))"
    listed = table(spark, sf_dir, "documents").selectExpr(
        "concat('/drop/', source, '/report_', doc_id) AS stem",
        f"if(doc_id % 11 <> 0, {day.format('doc_id')}, NULL) AS s",
        f"if(doc_id % 13 <> 0, {day.format('doc_id div 3')}, NULL) AS t",
    )
    files = listed.selectExpr(
        "inline(array(struct(concat(stem, '_td.csv') AS path, s AS day), struct(concat(stem, '_sf.csv') AS path, t AS day)))"
    ).selectExpr("path", "day", "timestamp '2024-01-01 00:00:00' + make_dt_interval(day) AS modificationTime")
    for number in (0, 1, 3):
        files.where(f"day = {number}").drop("day").write.mode("append").parquet(folder)
        stream = spark.readStream.schema("path string, modificationTime timestamp").parquet(folder)
        append_stream(pair_arrivals(stream, timedelta(hours=36)), pairs, state)
    return spark.read.schema(PAIR_SCHEMA).parquet(pairs)


@query(
    "catalog_declared_types",
    """SELECT 'C_NAME' AS column_name, 'CHARACTER_MAX_LENGTH' AS differs, '25' AS source_value, '30' AS target_value
       UNION ALL SELECT 'C_ACCTBAL', 'NUMERIC_SCALE', '2', '4'""",
)
def catalog_declared_types(spark, sf_dir):
    """Two copies of the customers as tables with declared types, of which one name and one scale differ."""
    customer = table(spark, sf_dir, "customer").selectExpr(
        "c_custkey", "c_name", "c_mktsegment", "cast(c_acctbal AS decimal(12,2)) AS c_acctbal"
    )
    catalogs = []
    for length, scale in ((25, 2), (30, 4)):
        name = f"declared_{uuid4().hex}"
        columns = f"c_custkey BIGINT, c_name VARCHAR({length}), c_mktsegment CHAR(10), c_acctbal DECIMAL(12,{scale})"
        spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet LOCATION '{scratch_folder(spark, name)}'")
        customer.write.insertInto(name)
        catalogs.append(catalog_of(spark, spark.table(name), "s", "customer"))
        spark.sql(f"DROP TABLE {name}")
    cells = compare_catalogs(*catalogs, one_table=True).cells()
    return cells.toDF("column_name", "differs", "source_value", "target_value")
