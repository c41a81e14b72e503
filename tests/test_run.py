"""Whole runs: one pair, many pairs, a configuration, exports."""

import pytest
from pyspark.sql import functions as F

from twincheck.operators.compare import compare_rows
from twincheck.plans.pair import (
    AGGREGATION,
    CHECKS,
    CONTENT,
    ROW_COUNT,
    SUMMARY_COLUMNS,
    plan_pair,
    prepare,
    select_checks,
    validate_pair,
)
from twincheck.plans.run import Systems, run_config, run_pairs
from twincheck.sinks.exports import export_csv, export_differences, metric_rows, read_export, run_id
from twincheck.sources.config import ConfigError, PairSpec, read_config
from twincheck.sources.tables import TableSpec, load_table
from workload import frames


@pytest.fixture
def pair(spark):
    source = spark.createDataFrame([(1, "a ", 10), (2, "b", 20)], "id int, name string, qty int")
    target = spark.createDataFrame([(1, "a", 10), (2, "b", 21), (3, "c", 1)], "ID int, NAME string, QTY int")
    return source, target


def test_select_checks():
    assert select_checks("All") == frozenset(CHECKS)
    assert select_checks(" Table Row Count , Aggregation") == {ROW_COUNT, AGGREGATION}
    for wrong in ("", None, "Row Count"):
        with pytest.raises(ConfigError):
            select_checks(wrong)


def summary(df):
    row = df.first().asDict()
    assert list(row) == SUMMARY_COLUMNS
    return row


def test_one_pair(pair):
    spec = PairSpec("s.t", "d.t", keys=("ID",), aggregate_columns=("QTY", "NAME"), aggregate_functions=("SUM", "COUNT"))
    row = summary(validate_pair(*pair, spec))
    assert row["STATUS"] == "MISMATCH" and row["DATA_TYPE_STATUS"] == "UNKNOWN"
    assert (row["SOURCE_ROW_COUNT"], row["TARGET_ROW_COUNT"]) == ("2", "3")
    counted = summary(validate_pair(*pair, spec, [ROW_COUNT]))
    assert counted["ROW_COUNT_STATUS"] == "MISMATCH" and counted["DATA_CONTENT_STATUS"] == "UNKNOWN"


def test_text_is_trimmed_and_skipped_aggregates_prove_nothing(pair):
    source, target = pair
    spec = PairSpec("s.t", "d.t", keys=("id",), skip=("qty",), aggregate_columns=("QTY",), aggregate_functions=("SUM",))
    row = summary(validate_pair(source, target.where("ID < 3"), spec))
    assert row["DATA_CONTENT_STATUS"] == "MATCH" and row["AGG_STATUS"] == "UNKNOWN" and row["STATUS"] == "MATCH"


def test_pair_without_keys_uses_the_row_hash(pair):
    source, target = pair
    checks = plan_pair(source, target, PairSpec("s.t", "d.t"), [CONTENT])
    counts = checks.content.counts().first()
    assert (counts["matched_keys"], counts["only_source_keys"], counts["only_target_keys"]) == (1, 1, 2)


def test_a_view_takes_the_types_of_the_source(spark):
    source = spark.createDataFrame([(1, 2)], "id int, v int")
    target = spark.createDataFrame([(1, "2", "x")], "id long, v string, extra string")
    _, imposed = prepare(source, target, PairSpec("s", "t", "VIEW"))
    assert imposed.dtypes == [("ID", "int"), ("V", "int")]


def test_pruned_content_check(spark, pair):
    source, target = pair
    spec = PairSpec("s.t", "d.t", keys=("ID",))
    changed = summary(validate_pair(source, target, spec, prune=True))
    assert (changed["DATA_CONTENT_STATUS"], changed["TARGET_ROW_COUNT"]) == ("MISMATCH", "3")
    intact = summary(validate_pair(source, source, spec, [CONTENT], prune=True))
    assert (intact["DATA_CONTENT_STATUS"], intact["ROW_COUNT_STATUS"], intact["SOURCE_ROW_COUNT"]) == ("MATCH", "UNKNOWN", "")
    empty = source.where("id > 99")
    assert summary(validate_pair(empty, empty, spec, prune=True))["DATA_CONTENT_STATUS"] == "UNKNOWN"
    assert summary(validate_pair(empty, empty, spec))["DATA_CONTENT_STATUS"] == "UNKNOWN"


def test_nothing_to_do_is_an_error(pair):
    with pytest.raises(ConfigError):
        validate_pair(*pair, PairSpec("s", "t", keys=("ID",)), [AGGREGATION])


def test_a_failing_pair_does_not_stop_the_others(spark, pair):
    good = PairSpec("s.good", "d.good", keys=("ID",))
    bad = PairSpec("s.bad", "d.bad", keys=("NO_SUCH",))
    for parallel in (1, 3):
        result = run_pairs(spark, [bad, good], lambda spec: plan_pair(*pair, spec), parallel=parallel).collect()
        assert [r["STATUS"] for r in result] == ["UNKNOWN", "MISMATCH"]
        assert "NO_SUCH" in result[0]["ERROR"] and result[1]["ERROR"] == ""
        assert float(result[1]["VALIDATION_TIME"]) >= 0


HEADER = ",".join(
    "ACTIVE LOB TYPE WF_NAME SOURCE_SCHEMA_NAME SOURCE_TABLE_NAME TARGET_SCHEMA_NAME TARGET_TABLE_NAME SOURCE_COLUMNS "
    "TARGET_COLUMNS UNIQUE_KEYS SKIP_COLUMNS DELTA_COLUMNS SOURCE_FILTER TARGET_FILTER AGGREGATE_COLUMNS "
    "AGGREGATE_FUNCTIONS".split()
)


def test_configured_run_with_export(spark, sf_dir, tmp_path):
    source, target = frames.orders_pair(spark, sf_dir)
    source.createOrReplaceTempView("orders_source")
    target.createOrReplaceTempView("orders_target")
    config = tmp_path / "config.csv"
    config.write_text(
        f"{HEADER}\n"
        "Y,Tax: TAX,Table,,s,orders,d,orders,*,*,O_ORDERKEY,,,,,O_TOTALPRICE,SUM\n"
        "Y,Tax: TAX,Table,,s,orders,d,orders,*,*,O_ORDERKEY,O_ORDERDATE,,WHERE o_orderkey < 5,where o_orderkey between 0 and 4,,\n"
        "Y,Tax: TAX,Report,,s,orders,d,orders,*,*,,,,,,,\n"
        "N,Tax: TAX,Table,,s,orders,d,orders,*,*,,,,,,,\n"
    )

    def loader(view):
        def load(table, columns, condition, schema):
            return load_table(spark, TableSpec(view, columns=columns, filter=condition))

        return load

    folder = str(tmp_path / "out")
    systems = Systems(loader("orders_source"), loader("orders_target"))
    rows = run_config(spark, read_config(spark, str(config)), systems, folder=folder, parallel=2).collect()
    assert len(rows) == 3
    by_filter = {(r["SOURCE_FILTER"], r["ERROR"] != ""): r for r in rows}
    drifted = by_filter["", False]
    assert (drifted["STATUS"], drifted["AGG_STATUS"], drifted["DATA_TYPE_STATUS"]) == ("MISMATCH", "MISMATCH", "MATCH")
    assert (drifted["SOURCE_ROW_COUNT"], drifted["TARGET_ROW_COUNT"]) == ("1500", "1501")
    assert "REPORT" in by_filter["", True]["ERROR"]
    narrow = by_filter["WHERE o_orderkey < 5", False]
    assert (narrow["ROW_COUNT_STATUS"], narrow["SOURCE_ROW_COUNT"], narrow["TARGET_ROW_COUNT"]) == ("MISMATCH", "5", "4")
    assert read_export(spark, f"{folder}/summary").count() == 3
    assert read_export(spark, f"{folder}/config").count() == 4
    header = {r["item"]: r["value"] for r in read_export(spark, f"{folder}/run").collect()}
    assert header["pairs"] == "3" and "Content Comparison" in header["checks"]


def test_reader_schema_from_catalogs(spark):
    layout = (
        "SCHEMA_NAME string, TABLE_NAME string, COLUMN_NAME string, COLUMN_POSITION bigint, DATA_TYPE string, "
        "CHARACTER_MAX_LENGTH bigint, NUMERIC_PRECISION bigint, NUMERIC_SCALE bigint"
    )
    good = spark.createDataFrame([("S", "T", "ID", 1, "NUMBER", 0, 38, 0)], layout)
    bad = spark.createDataFrame([("S", "T", "ID", 1, "UNKNOWN", 0, 0, 0)], layout)
    config = spark.createDataFrame(
        [("Y", "", "TABLE", "", "S", "T", "S", "T", "*", "*", "ID", "", "", "", "", "", "")],
        ", ".join(f"{name} string" for name in HEADER.split(",")),
    )
    seen = []

    def load(table, columns, condition, schema):
        seen.append(schema)
        return spark.range(3).selectExpr("id AS ID")

    row = run_config(spark, config, Systems(load, load, good, good)).first()
    assert seen == ["`ID` decimal(38,0)"] * 2 and row["STATUS"] == "MATCH" and row["DATA_TYPE_STATUS"] == "MATCH"
    row = run_config(spark, config, Systems(load, load, good, bad)).first()
    assert row["STATUS"] == "UNKNOWN" and "no Spark type" in row["ERROR"]


def test_staging_and_remote_counts(spark, tmp_path):
    config = spark.createDataFrame(
        [("Y", "", "TABLE", "", "S", "T", "S", "T", "*", "*", "ID", "", "", "", "", "", "")],
        ", ".join(f"{name} string" for name in HEADER.split(",")),
    )
    loads = []

    def load(table, columns, condition, schema):
        loads.append(table)
        return spark.range(3).selectExpr("id AS ID")

    row = run_config(spark, config, Systems(load, load, staging=str(tmp_path / "s"))).first()
    assert (row["STATUS"], row["SOURCE_ROW_COUNT"], loads) == ("MATCH", "3", ["S.T", "S.T"])
    assert len(list((tmp_path / "s").iterdir())) == 2

    def count(n):
        return lambda table, condition: spark.sql(f"SELECT {n}L AS ROW_COUNT")

    counted = Systems(load, load, count_source=count(7), count_target=count(8))
    row = run_config(spark, config, counted, ROW_COUNT).first()
    assert (row["ROW_COUNT_STATUS"], row["SOURCE_ROW_COUNT"], row["TARGET_ROW_COUNT"]) == ("MISMATCH", "7", "8")


def test_difference_export_is_one_pass_with_metrics(spark, pair, tmp_path):
    compared = compare_rows(*pair, ["id"])
    metrics = export_differences(compared, str(tmp_path / "d"), table="t", check="content")
    assert metrics == compared.metrics().first().asDict()
    written = {r["id"]: r.asDict() for r in read_export(spark, str(tmp_path / "d")).collect()}
    assert {k: v["diff_status"] for k, v in written.items()} == {"1": "mismatch", "2": "mismatch", "3": "only_target"}
    assert (written["1"]["name_source"], written["1"]["name_target"], written["1"]["name_match"]) == ("a ", "a", "false")
    long = metric_rows(compared.counts(), table="t", check="content").where("metric = 'common_keys'").first()
    assert tuple(long) == ("t", "content", "common_keys", "2")


def test_csv_export(spark, tmp_path):
    df = spark.createDataFrame([(' a "q" ', None), ("x,y", "line\\n")], "t string, u string")
    export_csv(df, str(tmp_path / "e"), compression="gzip", single_file=True)
    files = [p.name for p in (tmp_path / "e").iterdir() if p.name.startswith("part-")]
    assert len(files) == 1 and files[0].endswith(".csv.gz")
    assert [r["t"] for r in read_export(spark, str(tmp_path / "e")).collect()] == [' a "q" ', "x,y"]
    with pytest.raises(ValueError):
        export_csv(df, str(tmp_path / "f"), compression="zip")
    assert len(run_id()) == 24


def test_every_selected_check_is_reported(spark, tmp_path):
    from twincheck.plans.pair import BUSINESS, ETL_AUDIT, FILES, FUTURE_DATES, BusinessQuery, LoadAudit, check_report, plan_pair
    from twincheck.plans.run import export_pair
    from twincheck.sources.config import PairSpec

    source = spark.sql("SELECT id AS k, date_add(DATE '2020-01-01', cast(id AS int)) AS d, id % 3 AS v FROM range(50)")
    target = source.where("k <> 7").withColumn("v", F.expr("if(k = 9, 99, v)"))
    spec = PairSpec("s.t", "d.t", keys=("K",))
    bare = {r["check_name"]: r["status"] for r in check_report(plan_pair(source, target, spec)).collect()}
    assert {bare[name] for name in (BUSINESS, ETL_AUDIT, FILES, FUTURE_DATES)} == {"UNKNOWN"}
    audit = spark.sql(
        "SELECT 'T' AS source_table_name, '' AS start_time, 1 AS load_count, 'full' AS load_type, '' AS extract_query,"
        " 'j' AS job_name, 'SUCCESS' AS status"
    )
    inventory = spark.sql("SELECT 'j' AS job_name, 'w' AS wf_name")
    queries = [
        BusinessQuery("total", "SELECT 1 AS one, sum(V) AS s FROM {source}", "SELECT 1 AS one, sum(V) AS s FROM {target}", ("one",)),
        BusinessQuery("same", "SELECT max(K) AS m FROM {source}", "SELECT max(K) AS m FROM {target}", ("m",)),
    ]
    checks = plan_pair(
        source, target, spec, cutoff="2020-01-05", business=queries, audit=LoadAudit(audit, inventory, "w")
    )
    found = {(r["check_name"], r["item"]): r["status"] for r in check_report(checks).collect()}
    assert found[(FUTURE_DATES, "")] == "MISMATCH" and found[(ETL_AUDIT, "")] == "MATCH"
    assert (found[(BUSINESS, "total")], found[(BUSINESS, "same")]) == ("MISMATCH", "MATCH")
    export_pair(checks, str(tmp_path / "out"))
    sample = read_export(spark, str(tmp_path / "out" / "samples" / "d.t")).collect()
    assert {(r["diff_status"], r["K"]) for r in sample} == {("only_source", "7"), ("mismatch", "9")}
    metrics = {r["metric"]: r["value"] for r in read_export(spark, str(tmp_path / "out" / "metrics" / "d.t" / "content")).collect()}
    assert metrics["mismatched_keys"] == "1" and "s.t" in metrics["source_query"]


def test_files_of_a_table_run(spark, tmp_path):
    from twincheck.plans.pair import FILES, FUTURE_DATES
    from twincheck.plans.run import FileDrop

    drop = tmp_path / "drop"
    (drop / "x").mkdir(parents=True)
    (drop / "y").mkdir()
    for name, text in {
        "x/orders_td": "id,v\n1,a\n2,b\n", "x/orders_sf": "id,v\n1,a\n2,b\n",
        "y/D.Orders_td": "id,v\n1,a\n", "y/D.Orders_sf": "id,v\n1,c\n2,b\n",
        "x/lines_sf": "id\n1\n", "x/orders_old_td": "id\n1\n", "x/orders_old_sf": "id\n2\n",
    }.items():
        (drop / f"{name}.csv").write_text(text)
    config = tmp_path / "config.csv"
    config.write_text(f"{HEADER}\n" + "".join(
        f"Y,Tax: TAX,Table,,s,{name},d,{name},*,*,ID,,,,,,\n" for name in ("ORDERS", "LINES", "OTHER")
    ))
    rows = spark.createDataFrame([(1, "2020-01-01")], "id int, day string")
    systems = Systems(lambda *_: rows, lambda *_: rows)

    def run(label, checks, folder=drop, **options):
        out = str(tmp_path / label)
        given = FileDrop(str(folder), str(tmp_path / "ledger"))
        summary = run_config(spark, read_config(spark, str(config)), systems, checks, folder=out, drop=given, **options)
        found = read_export(spark, f"{out}/pair_*/checks/*").where("check_name = 'File Comparison'")
        return summary.collect(), sorted(
            ((r["item"] or "").rsplit("/", 1)[-1], r["status"], r["reason"] or "") for r in found.collect()
        )

    summary, found = run("first", [FILES, ROW_COUNT], parallel=2)
    assert [(r["STATUS"], r["ROW_COUNT_STATUS"], r["ERROR"]) for r in summary] == [("MATCH", "MATCH", "")] * 3
    nothing = ("", "UNKNOWN", "no new file is named like the table")
    differing = ("D.Orders", "MISMATCH", "1 rows differ, 0 more in the source, 1 more in the target")
    lonely = ("lines", "UNKNOWN", "only the target file has arrived")
    assert found == [nothing, differing, lonely, ("orders", "MATCH", "")]
    # The ledger holds what was compared. Checks without a column of the summary are enough for a run.
    summary, found = run("second", FILES)
    assert [(r["STATUS"], r["ERROR"]) for r in summary] == [("UNKNOWN", "")] * 3
    assert found == [nothing, nothing, lonely]
    # Other checks go on where the folder cannot be read.
    summary, found = run("third", [FILES, ROW_COUNT, FUTURE_DATES], tmp_path / "missing")
    assert {r["STATUS"] for r in summary} == {"MATCH"} and len(found) == 3
    assert all(status == "UNKNOWN" and "Exception" in reason for _, status, reason in found)


def test_file_check_without_a_drop_folder(spark, pair):
    from twincheck.plans.pair import FILES, check_report

    checks = plan_pair(*pair, PairSpec("s.t", "d.t", keys=("ID",)), [FILES])
    assert [tuple(r) for r in check_report(checks).collect()] == [
        ("File Comparison", "", "UNKNOWN", "no drop folder given")
    ]
