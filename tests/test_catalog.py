import pytest

from twincheck.functions import typemap
from twincheck.operators.catalog import (
    CATALOG_COLUMNS,
    catalog_of,
    columns_of,
    compare_catalogs,
    in_position_order,
    reader_schemas,
    source_catalog,
    target_catalog,
)
from workload.frames import NATIVE_CODES

RAW = "ColumnType string, ColumnLength int, ColumnFormat string, DecimalTotalDigits int, DecimalFractionalDigits int"


def mapped(spark, code, length=None, shown=None, total=None, fraction=None):
    df = spark.createDataFrame([(code, length, shown, total, fraction)], RAW)
    return tuple(
        df.selectExpr(
            typemap.common_type_name("ColumnType"),
            typemap.character_length("ColumnType", "ColumnLength", "ColumnFormat"),
            typemap.numeric_precision("ColumnType", "DecimalTotalDigits"),
            typemap.numeric_scale("ColumnType", "DecimalFractionalDigits"),
        ).first()
    )


@pytest.mark.parametrize(
    "raw, expected",
    [
        (("I",), ("NUMBER", 0, 38, 0)),
        (("N", None, None, 40, -128), ("NUMBER", 0, 38, 10)),
        (("N", None, None, 40, 2), ("NUMBER", 0, 38, 2)),
        (("D", None, None, 18, 4), ("NUMBER", 0, 18, 4)),
        (("CV", 99, "X(50)"), ("TEXT", 50, 0, 0)),
        (("CV", 99, "X(64000)"), ("TEXT", 64000, 0, 0)),
        (("BF", 16), ("TEXT", 16, 0, 0)),
        (("DY", 4), ("TEXT", 20, 0, 0)),
        (("PS", 24), ("TEXT", 24, 0, 0)),
        (("SZ",), ("TIMESTAMP_TZ", 0, 0, 0)),
        (("F",), ("FLOAT", 0, 0, 0)),
        (("??",), ("UNKNOWN", 0, 0, 0)),
    ],
)
def test_native_types(spark, raw, expected):
    assert mapped(spark, *raw) == expected


def test_every_listed_code_is_known(spark):
    df = spark.createDataFrame([(code,) for code in NATIVE_CODES[:-1]], "c string")
    assert df.selectExpr(f"{typemap.common_type_name('c')} AS t").where("t = 'UNKNOWN'").isEmpty()


def raw_columns(spark):
    rows = [
        ("db1 ", "tab", "B ", 20, "I", 4, "", 0, 0),
        ("db1 ", "tab", "a", 10, "CV", 8, "X(5)", 0, 0),
        ("db1 ", "ix", "a", 10, "I", 4, "", 0, 0),
        ("db2", "tab", "a", 10, "??", 4, "", 0, 0),
    ]
    return spark.createDataFrame(
        rows, f"DatabaseName string, TableName string, ColumnName string, ColumnId int, {RAW}"
    )


def raw_tables(spark):
    rows = [("db1 ", "tab", "T"), ("db1 ", "ix", "I"), ("db2", "tab", "V")]
    return spark.createDataFrame(rows, "DatabaseName string, TableName string, TableKind string")


def test_source_catalog(spark):
    found = source_catalog(raw_tables(spark), raw_columns(spark), schema_name="DB1")
    assert found.columns == CATALOG_COLUMNS
    assert [tuple(r)[2:5] for r in in_position_order(found).collect()] == [("A", 1, "TEXT"), ("B", 2, "NUMBER")]


def test_a_column_list_does_not_renumber_positions(spark):
    found = source_catalog(raw_tables(spark), raw_columns(spark), table_name="TAB", column_names=["b"])
    assert [tuple(r)[2:4] for r in found.collect()] == [("B", 2)]
    assert columns_of(raw_columns(spark), " db2").count() == 1


def test_compare_with_the_target_and_reader_schemas(spark):
    info = spark.createDataFrame(
        [("c", "DB1", "TAB", "A", 1, "TEXT", 5, None, None), ("c", "DB1", "TAB", "B", 2, "NUMBER", None, 38, 2)],
        "table_catalog string, table_schema string, table_name string, column_name string, ordinal_position int, "
        "data_type string, character_maximum_length int, numeric_precision int, numeric_scale int",
    )
    source = source_catalog(raw_tables(spark), raw_columns(spark))
    target = target_catalog(info, catalog_name="C", column_names=["*"])
    cells = compare_catalogs(source, target).cells().collect()
    assert [tuple(c) for c in cells] == [("DB1", "TAB", "B", "NUMERIC_SCALE", "0", "2")]
    schemas = {r["SCHEMA_NAME"]: (r["ddl"], r["unmapped_columns"]) for r in reader_schemas(source).collect()}
    assert schemas == {"DB1": ("`A` string, `B` decimal(38,0)", ""), "DB2": ("", "A")}


def test_catalog_of_a_spark_table(spark):
    df = spark.sql("SELECT 1 AS a, cast(1 AS decimal(9,2)) AS b, 'x' AS c, DATE '2020-01-01' AS d, array(1) AS e")
    rows = in_position_order(catalog_of(spark, df, "s", "t")).collect()
    assert [tuple(r)[2:] for r in rows] == [
        ("A", 1, "NUMBER", 0, 38, 0),
        ("B", 2, "NUMBER", 0, 9, 2),
        ("C", 3, "TEXT", 0, 0, 0),
        ("D", 4, "DATE", 0, 0, 0),
        ("E", 5, "ARRAY", 0, 0, 0),
    ]


def test_declared_lengths_are_part_of_the_catalog(spark):
    for name, length in (("declared_a", 10), ("declared_b", 20)):
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        spark.sql(f"CREATE TABLE {name} (a VARCHAR({length}), b CHAR(5), c STRING, d DECIMAL(9,2)) USING parquet")
    try:
        a, b = (catalog_of(spark, spark.table(f"declared_{x}"), "s", "t") for x in "ab")
        assert [tuple(r)[2:6] for r in in_position_order(a).collect()] == [
            ("A", 1, "TEXT", 10), ("B", 2, "TEXT", 5), ("C", 3, "TEXT", 0), ("D", 4, "NUMBER", 0)
        ]
        cells = compare_catalogs(a, b).cells().collect()
        assert [tuple(c) for c in cells] == [("S", "T", "A", "CHARACTER_MAX_LENGTH", "10", "20")]
        renamed = spark.table("declared_a").selectExpr("a AS other", "concat(a, 'x') AS made")
        assert [r["CHARACTER_MAX_LENGTH"] for r in in_position_order(catalog_of(spark, renamed, "s", "t")).collect()] == [10, 0]
    finally:
        for name in ("declared_a", "declared_b"):
            spark.sql(f"DROP TABLE {name}")
