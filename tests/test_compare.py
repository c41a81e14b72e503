import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from twincheck.functions.comparability import Tolerance
from twincheck.operators.compare import columns_only, compare_rows
from twincheck.operators.prune import compare_pruned

PROPERTY = settings(
    max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow]
)


def frame(spark, rows, schema="k int, v int, t string"):
    return spark.createDataFrame(rows, schema)


def statuses(comparison, key="k"):
    return sorted(((row[key], row["row_status"]) for row in comparison.rows.collect()), key=repr)


def test_null_keys_match_each_other(spark):
    compared = compare_rows(frame(spark, [(None, 1, "a")]), frame(spark, [(None, 1, "a")]), ["k"])
    assert statuses(compared) == [(None, "match")]


def test_null_value_equals_null_and_nothing_else(spark):
    source = frame(spark, [(1, None, "a"), (2, None, None), (3, 3, "c")])
    target = frame(spark, [(1, None, "a"), (2, 2, None), (3, None, "c")])
    assert statuses(compare_rows(source, target, ["k"])) == [(1, "match"), (2, "mismatch"), (3, "mismatch")]


def test_each_class_and_its_metrics(spark):
    source = frame(spark, [(1, 1, "a"), (2, 2, "b"), (3, 3, "c"), (3, 3, "c")])
    target = frame(spark, [(2, 2, "b"), (3, 9, "c"), (4, 4, "d")])
    compared = compare_rows(source, target, ["K"])
    assert statuses(compared) == [(1, "only_source"), (2, "match"), (3, "mismatch"), (4, "only_target")]
    counts = compared.counts().first().asDict()
    assert counts["source_rows"] == 4 and counts["source_keys"] == 3 and counts["source_duplicates"] == 1
    assert counts["common_keys"] == 2 and counts["mismatched_keys"] == 1
    assert {tuple(r) for r in compared.match_rates().collect()} == {("v", 1, 1, 0.5), ("t", 2, 0, 1.0)}
    assert [tuple(r) for r in compared.cells().collect()] == [(3, "v", "3", "9")]
    assert [tuple(r) for r in compared.only_source().collect()] == [(1, 1, "a")]
    assert [tuple(r) for r in compared.only_target().collect()] == [(4, 4, "d")]


def test_all_rows_of_a_repeated_key_count_whatever_the_partitioning(spark):
    rows = [(1, v, t) for v in (5, None, 2) for t in ("b", None, "a")]
    for parts in (1, 3, 7):
        source = frame(spark, rows).repartition(parts)
        assert statuses(compare_rows(source, frame(spark, rows[::-1]), ["k"])) == [(1, "match")]
        fewer = compare_rows(source, frame(spark, [(1, None, None)]), ["k"])
        assert statuses(fewer) == [(1, "mismatch")] and fewer.rows.first()["source_rows"] == 9
    cases = [
        ([(1, 1, "A"), (1, 1, "B"), (1, 1, "B")], [(1, 1, "A"), (1, 1, "C")]),
        ([(1, 1, "A"), (1, 1, "B")], [(1, 1, "A"), (1, 1, "C")]),
        ([(1, 1, "A"), (1, 1, "A"), (1, 1, "B")], [(1, 1, "A"), (1, 1, "B"), (1, 1, "B")]),
        ([(1, 1, "A")], [(1, 1, "A"), (1, 1, "A")]),
    ]
    for left, right in cases:
        for compare in (compare_rows, compare_pruned):
            compared = compare(frame(spark, left), frame(spark, right), ["k"])
            assert statuses(compared) == [(1, "mismatch")]
        assert compare_rows(frame(spark, left), frame(spark, right), ["k"]).verdict().first()["verdict"] == "MISMATCH"


def test_exact_against_floating_numbers_loses_nothing(spark):
    source = spark.sql("SELECT * FROM VALUES (1, 9007199254740993L), (2, 9007199254740992L), (3, 7L), (4, NULL), (5, 0L) v(k, n)")
    target = spark.sql(
        "SELECT * FROM VALUES (1, 9007199254740992D), (2, 9007199254740992D), (3, 7.5D), (4, NULL), (5, double('NaN')) v(k, n)"
    )
    expected = [(1, "mismatch"), (2, "match"), (3, "mismatch"), (4, "match"), (5, "mismatch")]
    assert statuses(compare_rows(source, target, ["k"])) == expected
    assert statuses(compare_rows(target, source, ["k"])) == expected
    assert statuses(compare_pruned(source, target, ["k"])) == [e for e in expected if e[1] == "mismatch"]


_SAMPLES = [
    "'1'", "'1.50'", "'x'", "'abc'", "'true'", "1", "2", "-1L", "cast(1 AS tinyint)", "1.50", "cast(1.5 AS decimal(38,20))",
    "cast(1 AS decimal(38,0))", "1D", "1.5D", "cast(0.1 AS float)", "0.1D", "0.10", "true", "X'616263'", "DATE '1970-01-03'",
    "TIMESTAMP '1970-01-03 00:00:00'", "TIMESTAMP_NTZ '1970-01-03 00:00:00'", "array(1)", "named_struct('a', 1)",
]


@PROPERTY
@given(data=st.data())
def test_pruned_is_plain_without_the_matches_for_all_type_pairs(spark, data):
    left, right = data.draw(st.sampled_from(_SAMPLES)), data.draw(st.sampled_from(_SAMPLES))

    def side(value):
        return spark.sql(f"SELECT 1 AS k, {value} AS v UNION ALL SELECT 2, NULL UNION ALL SELECT 3, {value}")

    for copies in (1, 2):
        source, target = side(left), side(right)
        if copies == 2:
            source, target = source.unionAll(source), target.unionAll(target)
        plain = [s for s in statuses(compare_rows(source, target, ["k"])) if s[1] != "match"]
        assert statuses(compare_pruned(source, target, ["k"])) == plain


def test_text_against_number_matches_where_it_parses(spark):
    source = spark.createDataFrame([(1, "10"), (2, "x"), (3, None), (4, None), (5, "7.50")], "k int, v string")
    target = spark.createDataFrame([(1, 10.0), (2, 2.0), (3, None), (4, 4.0), (5, 7.5)], "k int, v double")
    assert statuses(compare_rows(source, target, ["k"])) == [
        (1, "match"),
        (2, "mismatch"),
        (3, "match"),
        (4, "mismatch"),
        (5, "match"),
    ]


def test_pair_without_common_type_matches_only_on_null(spark):
    source = spark.sql("SELECT 1 AS k, array(1) AS v UNION ALL SELECT 2, NULL")
    target = spark.sql("SELECT 1 AS k, 1 AS v UNION ALL SELECT 2, NULL")
    assert statuses(compare_rows(source, target, ["k"])) == [(1, "mismatch"), (2, "match")]


def test_numbers_and_times_of_different_types(spark):
    source = spark.sql("SELECT 1L AS k, 1 AS n, cast(2.50 AS decimal(10,2)) AS d, DATE '2020-01-01' AS t")
    target = spark.sql(
        "SELECT cast(1 AS decimal(5,0)) AS k, 1L AS n, cast(2.5 AS decimal(20,4)) AS d, "
        "TIMESTAMP_NTZ '2020-01-01 00:00:00' AS t"
    )
    assert compare_rows(source, target, ["k"]).class_counts().first()["row_status"] == "match"


def test_decimals_beyond_38_digits_compare_without_loss(spark):
    wide = "cast('12345678901234567890123456789012345678' AS decimal(38,0))"
    source = spark.sql(f"SELECT k, cast(d AS decimal(38,0)) AS d FROM VALUES (1, {wide}), (2, {wide}), (3, 5) v(k, d)")
    target = spark.sql("SELECT k, cast(d AS decimal(38,20)) AS d FROM VALUES (1, 1.5), (2, NULL), (3, 5) v(k, d)")
    assert statuses(compare_rows(source, target, ["k"])) == [(1, "mismatch"), (2, "mismatch"), (3, "match")]


def test_maps_variants_and_nested_values(spark):
    sql = (
        "SELECT 1 AS k, map('a', 1, 'b', {v}) AS m, array(1, 2) AS a, named_struct('x', 1) AS s, "
        "parse_json('{{\"q\": 1}}') AS j"
    )
    reordered = sql.replace("map('a', 1, 'b', {v})", "map('b', {v}, 'a', 1)")
    same = compare_rows(spark.sql(sql.format(v=2)), spark.sql(reordered.format(v=2)), ["k"])
    assert statuses(same) == [(1, "match")]
    other = compare_rows(spark.sql(sql.format(v=2)), spark.sql(sql.format(v=3)), ["k"])
    assert [r["column_name"] for r in other.cells().collect()] == ["m"]


def test_tolerance(spark):
    source = spark.createDataFrame([(1, 1.0), (2, 100.0), (3, None)], "k int, v double")
    target = spark.createDataFrame([(1, 1.05), (2, 102.0), (3, 1.0)], "k int, v double")
    assert statuses(compare_rows(source, target, ["k"])) == [(1, "mismatch"), (2, "mismatch"), (3, "mismatch")]
    loose = compare_rows(source, target, ["k"], tolerance=Tolerance(absolute=0.1, relative=0.01))
    assert statuses(loose) == [(1, "match"), (2, "mismatch"), (3, "mismatch")]


def test_all_columns_are_keys(spark):
    source = spark.createDataFrame([(1, "a")], "k int, v string")
    compared = compare_rows(source, source, ["k", "v"])
    assert compared.counts().first()["mismatched_keys"] == 0
    assert compared.verdict().first()["verdict"] == "MATCH"
    with pytest.raises(ValueError):
        compared.cells()


def test_empty_side_is_unknown(spark):
    filled, empty = frame(spark, [(1, 1, "a")]), frame(spark, [])
    verdict = compare_rows(filled, empty, ["k"]).verdict().first()
    assert (verdict["verdict"], verdict["reason"]) == ("UNKNOWN", "target is empty")


def test_skip_list_with_blanks_and_unknown_names(spark):
    source, target = frame(spark, [(1, 1, "a")]), frame(spark, [(1, 2, "b")])
    compared = compare_rows(source, target, ["k"], skip=[" V", "t ", "zzz"])
    assert statuses(compared) == [(1, "match")]


def test_columns_of_one_side_are_carried_but_not_compared(spark):
    source = spark.createDataFrame([(1, 1, "x"), (2, 2, "y")], "k int, v int, only_here string")
    target = spark.createDataFrame([(1, 1, 5)], "K int, V int, only_there int")
    compared = compare_rows(source, target, ["k"])
    assert compared.pairing.columns == ("v",)
    assert [tuple(r) for r in compared.only_source().collect()] == [(2, 2, "y")]
    assert columns_only(source, target) == {"only_source": ["only_here"], "only_target": ["only_there"]}


def test_odd_column_names(spark):
    names = ["the key", "a.b", "it's", "back`tick"]
    source = spark.createDataFrame([(1, 2, 3, 4)], "a int, b int, c int, d int").toDF(*names)
    target = spark.createDataFrame([(1, 2, 3, 5)], "a int, b int, c int, d int").toDF(*names)
    cells = compare_rows(source, target, ["the key"]).cells().collect()
    assert [tuple(c) for c in cells] == [(1, "back`tick", "4", "5")]


def test_reserved_or_missing_keys_are_refused(spark):
    df = spark.createDataFrame([(1, 1)], "row_status int, v int")
    with pytest.raises(ValueError, match="reserved"):
        compare_rows(df, df, ["row_status"])
    with pytest.raises(ValueError, match="not found"):
        compare_rows(df, df, ["nope"])
    with pytest.raises(ValueError, match="at least one key"):
        compare_rows(df, df, [])


def test_wide_table(spark):
    columns = [f"id % {i + 2} AS c{i}" for i in range(250)]
    source = spark.range(200).selectExpr("id", *columns)
    target = source.withColumn("c249", F.expr("if(id = 7, -1, c249)"))
    compared = compare_rows(source, target, ["id"])
    assert {r["column_name"] for r in compared.match_rates().where("mismatched > 0").collect()} == {"c249"}


def test_a_hot_key_is_combined_before_the_shuffle(spark):
    """One key holds most rows; each map task sends it once."""
    source = spark.range(0, 60_000, 1, 6).selectExpr("if(id % 3 = 0, id, -1L) AS k", "id % 5 AS v")
    compared = compare_rows(source, source, ["k"])
    hot = compared.rows.where("k = -1").first()
    assert (hot["source_rows"], hot["target_rows"], hot["row_status"]) == (40_000, 40_000, "match")
    plan = compared.rows._jdf.queryExecution().executedPlan().toString()
    assert plan.index("partial_min") > plan.index("Exchange hashpartitioning")


def test_sample_takes_the_first_rows_of_every_status(spark):
    source = spark.range(100).selectExpr("id AS k", "id AS v")
    target = spark.range(50, 150).selectExpr("id AS k", "if(id < 80, -id, id) AS v")
    sample = compare_rows(source, target, ["k"]).sample(3)
    found = sorted((r["row_status"], r["sample_number"], r["k"]) for r in sample.collect())
    expected = [("match", 80), ("mismatch", 50), ("only_source", 0), ("only_target", 100)]
    assert found == [(status, i + 1, first + i) for status, first in expected for i in range(3)]


value = st.one_of(st.none(), st.integers(-2, 2))
rows = st.lists(st.tuples(value, value, st.one_of(st.none(), st.sampled_from(["a", "a ", "b", ""]))), max_size=12)


@PROPERTY
@given(rows)
def test_a_table_matches_itself(spark, data):
    df = frame(spark, data)
    verdict = compare_rows(df, df.repartition(3), ["k"]).verdict().first()["verdict"]
    assert verdict == ("MATCH" if data else "UNKNOWN")


@PROPERTY
@given(rows, rows)
def test_swapping_sides_swaps_the_surplus_classes(spark, left, right):
    a, b = frame(spark, left), frame(spark, right)
    swap = {"only_source": "only_target", "only_target": "only_source"}
    forward = statuses(compare_rows(a, b, ["k"]))
    backward = [(k, swap.get(s, s)) for k, s in statuses(compare_rows(b, a, ["k"]))]
    assert forward == sorted(backward, key=repr)


@PROPERTY
@given(rows, rows, st.sampled_from([1, 2, 64]))
def test_pruned_comparison_holds_exactly_the_differences(spark, left, right, buckets):
    a, b = frame(spark, left), frame(spark, right)
    full = compare_rows(a, b, ["k"]).differences()
    pruned = compare_pruned(a, b, ["k"], buckets=buckets).rows
    assert sorted(map(repr, pruned.collect())) == sorted(map(repr, full.collect()))


@pytest.mark.parametrize(
    "left_type, right_type", [("string", "int"), ("decimal(38,0)", "decimal(38,20)"), ("double", "bigint")]
)
def test_pruned_comparison_across_types(spark, left_type, right_type):
    numbers = spark.range(50).selectExpr("id AS k", "cast(id AS string) AS v")
    left = numbers.selectExpr("k", f"try_cast(if(k % 7 = 0, 'x', v) AS {left_type}) AS v")
    right = numbers.selectExpr("k", f"try_cast(if(k % 5 = 0, NULL, v) AS {right_type}) AS v")
    full = compare_rows(left, right, ["k"]).differences()
    pruned = compare_pruned(left, right, ["k"], buckets=1024).rows
    assert sorted(map(repr, pruned.collect())) == sorted(map(repr, full.collect()))


def test_an_intact_copy_is_never_shuffled_row_by_row(spark):
    source = spark.range(1000).selectExpr("id AS k", "id * 2 AS v")
    compared = compare_pruned(source, source, ["k"])
    assert compared.rows.isEmpty()
    with pytest.raises(ValueError):
        compare_pruned(source, source, ["k"], buckets=1 << 30)
