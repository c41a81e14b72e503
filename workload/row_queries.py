"""Queries on row comparison."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from twincheck.functions.columns import lookup, trim_strings, upper_names
from twincheck.functions.hashing import with_hash_key
from twincheck.operators.compare import RowComparison, columns_only, compare_rows
from twincheck.operators.counts import multiset_differences
from twincheck.operators.hashkeys import with_shared_hash_key
from twincheck.operators.positions import compare_positions
from twincheck.operators.prune import compare_pruned
from twincheck.plans.pair import content_comparison
from twincheck.session import scratch_folder
from twincheck.sinks.exports import export_csv
from twincheck.sources.config import PairSpec
from twincheck.sources.csvfiles import read_csv
from workload import frames as w
from workload import oracle_parts as o
from workload.registry import plain, query, table

ORDER_COLUMNS = [*w.ORDER_KEY, *w.ORDER_VALUES]
ORDER_TEXT = ["o_orderstatus", "o_orderpriority"]
ORDERS_CLS = o.classified(w.ORDERS_SQL, w.ORDER_KEY, w.ORDER_VALUES)
ORDERS_TRIMMED = o.trimmed(w.ORDERS_SQL, ORDER_COLUMNS, ORDER_TEXT)
TRIMMED_CLS = o.classified(ORDERS_TRIMMED, w.ORDER_KEY, w.ORDER_VALUES, source="srct", target="tgtt")
LINES_CLS = o.classified(w.LINES_SQL, w.LINE_KEY, w.LINE_VALUES)
SIDE_BY_SIDE = ", ".join(
    f"CAST({c}_source AS VARCHAR) AS {c}_source, CAST({c}_target AS VARCHAR) AS {c}_target, {c}_match"
    for c in w.ORDER_VALUES
)


def orders(spark: SparkSession, sf_dir: str) -> RowComparison:
    return compare_rows(*w.orders_pair(spark, sf_dir), w.ORDER_KEY)


def trimmed_orders(spark: SparkSession, sf_dir: str) -> RowComparison:
    source, target = w.orders_pair(spark, sf_dir)
    return compare_rows(trim_strings(source), trim_strings(target), w.ORDER_KEY)


def side_by_side(df: DataFrame) -> DataFrame:
    return df.selectExpr(
        *[f"cast({c} AS string) AS {c}" if c.endswith(("_source", "_target")) else c for c in df.columns]
    )


def order_texts(df: DataFrame) -> DataFrame:
    return df.selectExpr("o_orderkey", *[f"cast({c} AS string) AS {c}" for c in w.ORDER_VALUES])


@query("compare_classify", ORDERS_CLS + "SELECT o_orderkey, status, source_rows, target_rows FROM cls")
def compare_classify(spark, sf_dir):
    return orders(spark, sf_dir).rows.selectExpr("o_orderkey", "row_status AS status", "source_rows", "target_rows")


@query("compare_counts", TRIMMED_CLS + o.METRICS)
def compare_counts(spark, sf_dir):
    return trimmed_orders(spark, sf_dir).counts()


@query("diff_class_counts", TRIMMED_CLS + "SELECT status, count(*) AS row_count FROM cls GROUP BY status")
def diff_class_counts(spark, sf_dir):
    return trimmed_orders(spark, sf_dir).class_counts().withColumnRenamed("row_status", "status")


@query(
    "rows_only_source",
    f"WITH {w.ORDERS_SQL} SELECT {o.texts(w.ORDER_VALUES)}, o_orderkey FROM src "
    "WHERE o_orderkey NOT IN (SELECT o_orderkey FROM tgt)",
)
def rows_only_source(spark, sf_dir):
    return order_texts(orders(spark, sf_dir).only_source())


@query(
    "rows_only_target",
    f"WITH {w.ORDERS_SQL} SELECT {o.texts(w.ORDER_VALUES)}, o_orderkey FROM tgt "
    "WHERE o_orderkey NOT IN (SELECT o_orderkey FROM src)",
)
def rows_only_target(spark, sf_dir):
    return order_texts(orders(spark, sf_dir).only_target())


@query("rows_mismatch", ORDERS_CLS + f"SELECT o_orderkey, {SIDE_BY_SIDE} FROM cls WHERE status = 'mismatch'")
def rows_mismatch(spark, sf_dir):
    return side_by_side(orders(spark, sf_dir).mismatched())


@query("rows_common", ORDERS_CLS + f"SELECT o_orderkey, {SIDE_BY_SIDE} FROM cls WHERE status IN ('match', 'mismatch')")
def rows_common(spark, sf_dir):
    return side_by_side(orders(spark, sf_dir).common())


@query("cell_diffs", ORDERS_CLS + o.cells(w.ORDER_KEY, w.ORDER_VALUES))
def cell_diffs(spark, sf_dir):
    return orders(spark, sf_dir).cells()


@query("match_rates", ORDERS_CLS + o.match_rates(w.ORDER_VALUES))
def match_rates(spark, sf_dir):
    return orders(spark, sf_dir).match_rates().withColumn("match_rate", F.round("match_rate", 6))


@query(
    "compare_verdict",
    TRIMMED_CLS
    + """SELECT CASE WHEN count(*) FILTER (status <> 'match') = 0 THEN 'MATCH' ELSE 'MISMATCH' END AS verdict,
         '' AS reason, count(*) FILTER (status = 'mismatch') AS mismatched_keys,
         count(*) FILTER (status = 'only_source') AS only_source_keys,
         count(*) FILTER (status = 'only_target') AS only_target_keys FROM cls""",
)
def compare_verdict(spark, sf_dir):
    return trimmed_orders(spark, sf_dir).verdict()


_UNSKIPPED = ["o_custkey", "o_orderdate", "o_orderpriority"]


@query(
    "compare_skip_columns",
    o.classified(w.ORDERS_SQL, w.ORDER_KEY, _UNSKIPPED) + "SELECT o_orderkey, status FROM cls WHERE status <> 'match'",
)
def compare_skip_columns(spark, sf_dir):
    skip = ["O_TOTALPRICE", " o_orderstatus", "no_such_column"]
    compared = compare_rows(*w.orders_pair(spark, sf_dir), w.ORDER_KEY, skip=skip)
    return compared.differences().selectExpr("o_orderkey", "row_status AS status")


@query(
    "compare_duplicate_keys",
    LINES_CLS
    + """SELECT l_orderkey, l_linenumber, status, source_rows, target_rows, l_partkey_source, l_partkey_match,
         CAST(l_quantity_source AS VARCHAR) AS l_quantity_source, l_quantity_match, l_returnflag_target,
         l_returnflag_match FROM cls""",
)
def compare_duplicate_keys(spark, sf_dir):
    rows = compare_rows(*w.lines_pair(spark, sf_dir), w.LINE_KEY).rows
    return rows.selectExpr(
        "l_orderkey",
        "cast(l_linenumber AS bigint) AS l_linenumber",
        "row_status AS status",
        "source_rows",
        "target_rows",
        "source_row.l_partkey AS l_partkey_source",
        "cell_matches.l_partkey AS l_partkey_match",
        "cast(source_row.l_quantity AS string) AS l_quantity_source",
        "cell_matches.l_quantity AS l_quantity_match",
        "target_row.l_returnflag AS l_returnflag_target",
        "cell_matches.l_returnflag AS l_returnflag_match",
    )


REPEATED_CLS = o.classified(w.REPEATED_SQL, w.LINE_KEY, w.LINE_VALUES)


@query(
    "compare_repeated_rows",
    REPEATED_CLS + "SELECT l_orderkey, l_linenumber, status, source_rows, target_rows FROM cls",
)
def compare_repeated_rows(spark, sf_dir):
    rows = compare_rows(*w.repeated_pair(spark, sf_dir), w.LINE_KEY).rows
    return rows.selectExpr("l_orderkey", "l_linenumber", "row_status AS status", "source_rows", "target_rows")


@query(
    "content_compare_keyless",
    f"""WITH {w.REPEATED_SQL},
    s AS (SELECT *, count(*) AS n FROM src GROUP BY ALL), t AS (SELECT *, count(*) AS n FROM tgt GROUP BY ALL)
    SELECT count(*) FILTER (t.n IS NULL) AS only_source_keys, count(*) FILTER (s.n IS NULL) AS only_target_keys,
      count(*) FILTER (s.n <> t.n) AS mismatched_keys, count(*) FILTER (s.n = t.n) AS matched_keys
    FROM s FULL JOIN t ON {o.null_safe("s", "t", [*w.LINE_KEY, *w.LINE_VALUES])}""",
)
def content_compare_keyless(spark, sf_dir):
    compared = content_comparison(*w.repeated_pair(spark, sf_dir), PairSpec("s", "t", "TABLE"))
    return compared.key_metrics().select("only_source_keys", "only_target_keys", "mismatched_keys", "matched_keys")


@query(
    "pruned_differences",
    LINES_CLS
    + """SELECT l_orderkey, l_linenumber, status, source_rows, target_rows, l_partkey_match, l_returnflag_match
         FROM cls WHERE status <> 'match'""",
)
def pruned_differences(spark, sf_dir):
    rows = compare_pruned(*w.lines_pair(spark, sf_dir), w.LINE_KEY).rows
    return rows.selectExpr(
        "l_orderkey",
        "cast(l_linenumber AS bigint) AS l_linenumber",
        "row_status AS status",
        "source_rows",
        "target_rows",
        "cell_matches.l_partkey AS l_partkey_match",
        "cell_matches.l_returnflag AS l_returnflag_match",
    )


_HASH_KEYED = f"""{ORDERS_TRIMMED},
srch AS (SELECT *, md5(concat_ws('||', {", ".join(f"CAST({c} AS VARCHAR)" for c in ORDER_COLUMNS)})) AS h FROM srct),
tgth AS (SELECT *, md5(concat_ws('||', {", ".join(f"CAST({c} AS VARCHAR)" for c in ORDER_COLUMNS)})) AS h FROM tgtt)"""


@query(
    "content_compare",
    o.classified(_HASH_KEYED, ["h"], ORDER_COLUMNS, source="srch", target="tgth")
    + """SELECT h AS row_key, status, source_rows, target_rows, o_orderkey_source, o_orderkey_target
         FROM cls WHERE status <> 'match'""",
)
def content_compare(spark, sf_dir):
    """Content check without declared keys: trimmed text, row hash as key."""
    source, target = (trim_strings(side) for side in w.orders_pair(spark, sf_dir))
    compared = compare_rows(*with_shared_hash_key(source, target), ["HASHED_UNIQUE_KEY"])
    return compared.differences().selectExpr(
        "HASHED_UNIQUE_KEY AS row_key",
        "row_status AS status",
        "source_rows",
        "target_rows",
        "source_row.o_orderkey AS o_orderkey_source",
        "target_row.o_orderkey AS o_orderkey_target",
    )


_PARITY_HASH = "md5(concat_ws('||', {}))".format(", ".join(f"CAST({c} AS VARCHAR)" for c in ORDER_COLUMNS))
_SAFE_HASH = "md5(concat_ws(',', {}))".format(
    ", ".join(f"coalesce(length(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')" for c in ORDER_COLUMNS)
)


@query(
    "hash_key",
    f"WITH {w.ORDERS_SQL} SELECT o_orderkey, {_PARITY_HASH} AS row_hash, {_SAFE_HASH} AS safe_row_hash FROM tgt",
)
def hash_key(spark, sf_dir):
    source, target = w.orders_pair(spark, sf_dir)
    _, hashed = with_shared_hash_key(source, target, name="row_hash")
    both = with_hash_key(hashed, ["row_hash"], safe=True, name="safe_row_hash")
    return both.select("o_orderkey", "row_hash", "safe_row_hash")


@query(
    "hash_multiset_diff",
    """WITH src AS (SELECT l_returnflag, l_linestatus, l_linenumber FROM lineitem),
tgt AS (SELECT * FROM src UNION ALL SELECT * FROM src WHERE l_returnflag = 'R' AND l_linenumber > 4),
hashed AS (
  SELECT TRUE AS in_source, * FROM src UNION ALL SELECT FALSE, * FROM tgt)
SELECT md5(concat_ws(',', length(l_returnflag) || ':' || l_returnflag, length(l_linestatus) || ':' || l_linestatus,
       length(CAST(l_linenumber AS VARCHAR)) || ':' || l_linenumber)) AS row_hash,
       count(*) FILTER (in_source) AS source_rows, count(*) FILTER (NOT in_source) AS target_rows
FROM hashed GROUP BY row_hash HAVING count(*) FILTER (in_source) <> count(*) FILTER (NOT in_source)""",
)
def hash_multiset_diff(spark, sf_dir):
    source = table(spark, sf_dir, "lineitem").select("l_returnflag", "l_linestatus", "l_linenumber")
    target = source.unionAll(source.where("l_returnflag = 'R' AND l_linenumber > 4"))
    return multiset_differences(source, target)


@query(
    "normalize_trim",
    f"WITH {w.ORDERS_SQL} SELECT o_orderkey, trim(o_orderstatus) AS o_orderstatus, "
    "trim(o_orderpriority) AS o_orderpriority FROM tgt",
)
def normalize_trim(spark, sf_dir):
    _, target = w.orders_pair(spark, sf_dir)
    return trim_strings(target).select("o_orderkey", "o_orderstatus", "o_orderpriority")


@query(
    "normalize_columns",
    f"""WITH {w.ORDERS_SQL} SELECT o_orderkey AS "O_ORDERKEY", o_custkey AS "O_CUSTKEY",
        o_orderstatus AS "O_ORDERSTATUS", o_orderpriority AS "O_ORDERPRIORITY" FROM src""",
)
def normalize_columns(spark, sf_dir):
    source, _ = w.orders_pair(spark, sf_dir)
    return upper_names(source).select("O_ORDERKEY", "O_CUSTKEY", "O_ORDERSTATUS", "O_ORDERPRIORITY")


_ONE_SIDED = f"""
one AS (SELECT upper(column_name) AS c FROM (DESCRIBE SELECT {", ".join(ORDER_COLUMNS)} FROM orders)),
other AS (SELECT upper(column_name) AS c FROM (
  DESCRIBE SELECT * EXCLUDE (o_totalprice, o_orderdate), CAST(NULL AS TIMESTAMP) AS loaded_at
  FROM (SELECT {", ".join(ORDER_COLUMNS)} FROM orders)))"""


@query(
    "columns_only",
    f"""WITH {_ONE_SIDED} SELECT
       (SELECT string_agg(c, ',' ORDER BY c) FROM one WHERE c NOT IN (SELECT c FROM other)) AS source_only,
       (SELECT string_agg(c, ',' ORDER BY c) FROM other WHERE c NOT IN (SELECT c FROM one)) AS target_only,
       count(*) AS source_rows FROM orders""",
)
def columns_only_query(spark, sf_dir):
    """Columns of one side only, beside the row count of the source."""
    source, _ = w.orders_pair(spark, sf_dir)
    source = upper_names(source)
    target = source.drop("O_TOTALPRICE", "O_ORDERDATE").withColumn("LOADED_AT", F.lit(None).cast("timestamp"))
    unique = columns_only(source, target)
    source_only, target_only = ",".join(sorted(unique["only_source"])), ",".join(unique["only_target"])
    return source.selectExpr(
        f"'{source_only}' AS source_only", f"'{target_only}' AS target_only", "count(1) AS source_rows"
    )


@query(
    "point_lookup",
    """SELECT c_custkey, c_name, c_nationkey::BIGINT AS c_nationkey, CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS VARCHAR)
       AS c_acctbal FROM customer WHERE c_mktsegment = 'BUILDING' AND c_nationkey = 7""",
)
def point_lookup(spark, sf_dir):
    found = lookup(table(spark, sf_dir, "customer"), {"C_MKTSEGMENT": "BUILDING", "C_NATIONKEY": 7})
    return plain(found.selectExpr("c_custkey", "c_name", "c_nationkey", f"cast(c_acctbal AS {w.MONEY}) AS c_acctbal"))


_CUSTOMER_VALUES = ["c_custkey", "c_name", "c_acctbal", "c_mktsegment"]


@query(
    "positional_compare",
    o.classified(w.CUSTOMERS_SQL, ["row_index"], _CUSTOMER_VALUES)
    + """SELECT row_index, status, c_custkey_source, c_custkey_target, c_custkey_match, c_acctbal_match,
         c_mktsegment_match FROM cls""",
)
def positional_compare(spark, sf_dir):
    rows = compare_positions(*w.customers_pair(spark, sf_dir)).rows.rows
    return rows.selectExpr(
        "_row_index AS row_index",
        "row_status AS status",
        "source_row.c_custkey AS c_custkey_source",
        "target_row.c_custkey AS c_custkey_target",
        "cell_matches.c_custkey AS c_custkey_match",
        "cell_matches.c_acctbal AS c_acctbal_match",
        "cell_matches.c_mktsegment AS c_mktsegment_match",
    )


ORACLE_VERDICT = (
    o.classified(w.CUSTOMERS_SQL, ["row_index"], _CUSTOMER_VALUES)
    + """SELECT CASE WHEN count(*) FILTER (status <> 'match') = 0 THEN 'MATCH' ELSE 'MISMATCH' END AS verdict,
         CAST(sum(source_rows) AS BIGINT) AS source_rows, CAST(sum(target_rows) AS BIGINT) AS target_rows,
         count(*) FILTER (status = 'mismatch') AS mismatched_rows,
         count(*) FILTER (status = 'only_source') AS surplus_source_rows,
         count(*) FILTER (status = 'only_target') AS surplus_target_rows,
         '' AS source_only_columns, '' AS target_only_columns FROM cls"""
)


@query("positional_verdict", ORACLE_VERDICT)
def positional_verdict(spark, sf_dir):
    return compare_positions(*w.customers_pair(spark, sf_dir)).verdict()


@query("positional_csv", ORACLE_VERDICT)
def positional_csv(spark, sf_dir):
    """The same rows written as CSV in key order, read back as text and compared row by row."""
    extracts = []
    for side, label in zip(w.customers_pair(spark, sf_dir), ("source", "target")):
        folder = scratch_folder(spark, label)
        export_csv(side.orderBy("c_custkey"), folder)
        extracts.append(read_csv(spark, folder))
    return compare_positions(*extracts).verdict()


@query(
    "diff_sample",
    ORDERS_CLS
    + """SELECT status, sample_number, o_orderkey, o_custkey_source, CAST(o_totalprice_target AS VARCHAR)
         AS o_totalprice_target
         FROM (SELECT *, row_number() OVER (PARTITION BY status ORDER BY o_orderkey) AS sample_number FROM cls)
         WHERE sample_number <= 10""",
)
def diff_sample(spark, sf_dir):
    """The first ten rows of every status: the limit is the feature."""
    return orders(spark, sf_dir).sample(10).selectExpr(
        "row_status AS status",
        "sample_number",
        "o_orderkey",
        "source_row.o_custkey AS o_custkey_source",
        "cast(target_row.o_totalprice AS string) AS o_totalprice_target",
    )
