"""Reads. JDBC and connector reads are tested up to the options handed to Spark; no database is started."""

import pytest

from twincheck.sources.config import ConfigError, PairSpec, active_rows, pair_from_row, parse_config, read_config
from twincheck.sources.csvfiles import read_csv, read_csv_inferred
from twincheck.operators.counts import compare_given_counts
from twincheck.sources.jdbc import Connection, ReadRange, query_options
from twincheck.sources.remote import (
    catalog_query,
    count_loader,
    index_query,
    read_source_catalog,
    read_target_catalog,
    table_loader,
)
from twincheck.sources.tables import TableSpec, filter_condition, load_table, narrow, split_list


def test_query_of_a_table():
    spec = TableSpec("S.T", columns="A, B", filter=" where a = 'where' ")
    assert spec.query == "SELECT A, B FROM S.T WHERE a = 'where'"
    assert TableSpec("S.T").query == "SELECT * FROM S.T"
    assert filter_condition("WHEREVER = 1") == "WHEREVER = 1"
    assert split_list(" a, ,b ") == ["a", "b"]


def test_file_load_prunes_and_pushes_down(spark, sf_dir):
    spec = TableSpec("orders", "parquet", f"{sf_dir}/orders.parquet", columns="O_ORDERKEY", filter="WHERE o_custkey = 7")
    plan = load_table(spark, spec)._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(o_custkey,7)" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint>" in plan


def test_session_table_and_missing_column(spark):
    spark.range(5).createOrReplaceTempView("five")
    assert load_table(spark, TableSpec("five", filter="WHERE id > 2")).count() == 2
    with pytest.raises(ValueError, match="not found"):
        narrow(spark.range(5), "nope")


def test_jdbc_options():
    connection = Connection("some.Driver", "jdbc:some:url", "me", "secret", {"client_charset": "ISO8859_1"})
    options = query_options(connection, "SELECT 1 AS a", custom_schema="a bigint")
    assert options == {
        "driver": "some.Driver",
        "url": "jdbc:some:url",
        "user": "me",
        "password": "secret",
        "client_charset": "ISO8859_1",
        "fetchsize": "10000",
        "customSchema": "a bigint",
        "query": "SELECT 1 AS a",
    }


def test_split_jdbc_read_wraps_the_query():
    options = query_options(Connection("d", "u"), "SELECT 1 AS a", split=ReadRange("a", "0", "100", 4))
    assert "query" not in options and options["dbtable"] == "(SELECT 1 AS a) split_read"
    assert (options["partitionColumn"], options["numPartitions"]) == ("a", "4")
    with pytest.raises(ValueError):
        query_options(Connection("d", "u"), "SELECT 1", split=ReadRange("a", "0", "1", 0))


def test_csv_blanks(spark, tmp_path):
    (tmp_path / "f.csv").write_text('a,b,c\n"", p ,1\nx\n')
    rows = [tuple(r) for r in read_csv(spark, str(tmp_path / "f.csv")).collect()]
    assert rows == [("", " p ", "1"), ("x", "", "")]
    typed = read_csv(spark, str(tmp_path / "f.csv"), "a string, b string, c int")
    assert typed.collect()[1]["c"] is None
    assert dict(read_csv_inferred(spark, str(tmp_path / "f.csv")).dtypes)["c"] == "int"


HEADER = (
    "ACTIVE,LOB,TYPE,WF_NAME,SOURCE_SCHEMA_NAME,SOURCE_TABLE_NAME,TARGET_SCHEMA_NAME,TARGET_TABLE_NAME,SOURCE_COLUMNS,"
    "TARGET_COLUMNS,UNIQUE_KEYS,SKIP_COLUMNS,DELTA_COLUMNS,SOURCE_FILTER,TARGET_FILTER,AGGREGATE_COLUMNS,"
    "AGGREGATE_FUNCTIONS\n"
)


def test_config(spark, tmp_path):
    path = tmp_path / "config.csv"
    path.write_text(
        HEADER
        + 'Y,Tax: TAX, Table ,wf, S,T ,D,T,*,*,"A , B",,,WHERE x = 1,,"P,Q","SUM, COUNT"\n'
        + "N,,view,,S,T,D,T,*,*,,,,,,,\n"
        + ",,,,,,,,,,,,,,,,\n"
    )
    active = active_rows(read_config(spark, str(path)))
    row = parse_config(active).first()
    assert row["LOB_CODE"] == "tax" and row["SKIP_COLUMNS"] is None
    assert pair_from_row(row) == PairSpec(
        "S.T", "D.T", "TABLE", source_filter="WHERE x = 1", keys=("A", "B"), aggregate_columns=("P", "Q"),
        aggregate_functions=("SUM", "COUNT"),
    )


def test_wrong_pairs_are_refused():
    with pytest.raises(ConfigError, match="type"):
        PairSpec("a", "b", "REPORT")
    with pytest.raises(ConfigError, match="aggregate"):
        PairSpec("a", "b", aggregate_columns=("x",))


def test_remote_statements():
    sent = []

    def run(query, schema):
        sent.append((query, schema))

    table_loader(run)("S.T", "A, B", "WHERE A = 1", "A int, B int")
    count_loader(run)("S.T", "WHERE A = 1")
    assert sent == [
        ("SELECT A, B FROM S.T WHERE A = 1", "A int, B int"),
        ("SELECT CAST(COUNT(*) AS BIGINT) AS ROW_COUNT FROM S.T WHERE A = 1", "ROW_COUNT bigint"),
    ]
    assert index_query(" s", "it's").endswith(
        "WHERE upper(trim(DatabaseName)) = 'S' AND upper(trim(TableName)) = 'IT''S'"
    )
    assert catalog_query("v", "s", "t").startswith("SELECT * FROM v WHERE")


def test_remote_catalogs(spark):
    """Views of the session stand in for the catalogs of the two systems."""
    spark.sql(
        "SELECT 'S ' AS DatabaseName, 't' AS TableName, 'T' AS TableKind, 'c' AS ColumnName, 1 AS ColumnId, "
        "'D' AS ColumnType, 8 AS ColumnLength, '' AS ColumnFormat, 9 AS DecimalTotalDigits, "
        "2 AS DecimalFractionalDigits"
    ).createOrReplaceTempView("source_view")
    spark.sql(
        "SELECT 'C' AS table_catalog, 'S' AS table_schema, 'T' AS table_name, 'C' AS column_name, "
        "1 AS ordinal_position, 'NUMBER' AS data_type, NULL AS character_maximum_length, 9 AS numeric_precision, "
        "2 AS numeric_scale"
    ).createOrReplaceTempView("target_view")

    def run(query, schema):
        for view in ("dbc.tablesV", "dbc.columnsV"):
            query = query.replace(view, "source_view")
        return spark.sql(query.replace("INFORMATION_SCHEMA.COLUMNS", "target_view"))

    expected = ("S", "T", "C", 1, "NUMBER", 0, 9, 2)
    assert tuple(read_source_catalog(run, "s", "T").first()) == expected
    assert tuple(read_target_catalog(run, "C", "S", "T").first()) == expected


def test_counts_from_the_systems(spark):
    three, five = spark.sql("SELECT 3L AS ROW_COUNT"), spark.sql("SELECT 5 AS n")
    assert tuple(compare_given_counts(three, five).first()) == (3, 5, -2, "MISMATCH")


def test_each_remote_table_has_its_own_split(spark, monkeypatch):
    """The session answers the statements in place of a database."""
    from twincheck.sources import remote

    spark.sql(
        "SELECT id AS k, cast(id / 8 AS decimal(9,3)) - 1 AS price, date_add(DATE '2024-01-31', cast(id AS int)) AS day "
        "FROM range(40)"
    ).createOrReplaceTempView("split_orders")
    spark.sql("SELECT 1 AS k WHERE false").createOrReplaceTempView("split_nothing")
    sent = []

    def read(spark, connection, query, custom_schema=None, split=None):
        sent.append((query, custom_schema, split))
        return spark.sql(query)

    monkeypatch.setattr(remote, "read_query", read)
    connection = Connection("d", "u")

    def splits_of(split, columns="*", condition="", table="split_orders"):
        sent.clear()
        load = remote.jdbc_loader(spark, connection, {" Split_Orders": split, "split_nothing": split})
        load(table, columns, condition, "k bigint")
        assert sent[-1][0] == TableSpec(table, columns=columns, filter=condition).query and sent[-1][1] == "k bigint"
        return len(sent), sent[-1][2]

    given = ReadRange("k", "0", "9", 3)
    assert splits_of(given) == (1, given)
    assert splits_of(remote.SplitBy("k", 4), condition="WHERE k > 4") == (2, ReadRange("k", "5", "39", 4))
    assert sent[0][0].endswith("FROM split_orders WHERE k > 4")
    assert splits_of(remote.SplitBy("price", 2), "k, PRICE") == (2, ReadRange("price", "-1", "4", 2))
    assert splits_of(remote.SplitBy("day", 2)) == (2, ReadRange("day", "2024-01-31", "2024-03-10", 2))
    # Nothing to cut, and a table without a split: one task.
    assert splits_of(remote.SplitBy("k", 4), table="split_nothing") == (2, None)
    assert splits_of(remote.SplitBy("k", 4), condition="WHERE k < 0") == (2, None)
    spark.range(3).createOrReplaceTempView("split_other")
    assert splits_of(given, table="split_other") == (1, None)
    with pytest.raises(ValueError, match="not among the columns"):
        splits_of(given, "price")
