"""Find differing rows of two nearly equal tables without shuffling the equal part.

A tree of digests: key hashes cut both tables into nodes, and one aggregate with fixed-width buffers sums the row digests of
each node, positive for the source and negative for the target. Nodes whose sums cancel hold the same rows on both sides (up
to a 128-bit digest collision) and are done. The others are cut into smaller ones, until a node has few rows; only rows of
unequal leaves enter the exact comparison. Scattered differences thus move a leaf each, however large the tables are.

Cost on an intact copy: one scan of each side and an exchange of at most ``buckets`` short rows per task. Each further level
reads keys and values again, and sums up short rows of unequal nodes alone; it is left out where it would save little. The
list of unequal nodes is at most ``MAX_BUCKETS`` integers, which bounds what is broadcast. With differences all over the
table nothing is saved; use the plain comparison then.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twincheck.functions.columns import drop_columns
from twincheck.functions.comparability import EXACT, Tolerance, orderable_columns
from twincheck.operators.compare import (
    MATCHED,
    STATUS,
    Pairing,
    RowComparison,
    bucket,
    classify,
    digest_sums,
    pair_columns,
    row_digests,
    tag_sides,
)
from twincheck.session import scratch_folder

DEFAULT_BUCKETS = 1 << 16
MAX_BUCKETS = 1 << 22
LEAF_ROWS = 1_000
#: Nodes that a node is cut into at most. Three levels of the default tell 2^56 nodes apart.
FAN_OUT = 1 << 20
#: A level that leaves more than this part of the rows is the last: their keys repeat, or most of them differ.
LEAST_GAIN = 0.9


def _row_digests(df: DataFrame, pairing: Pairing, buckets: int, *, target: bool) -> DataFrame:
    """``_bucket``, a sign and two digests of every row of one side."""
    return df.selectExpr(bucket(pairing.key_values(target), buckets), *row_digests(pairing, target=target))


def _node_totals(
    source: DataFrame, target: DataFrame, pairing: Pairing, buckets: int, within: tuple[DataFrame, int] | None
) -> DataFrame:
    """``_bucket, _size`` of the nodes whose row multisets differ, among those below the nodes ``within``."""
    both = _row_digests(source, pairing, buckets, target=False).unionAll(
        _row_digests(target, pairing, buckets, target=True)
    )
    if within is not None:
        parents, parent_buckets = within
        above = both.withColumn("_above", F.expr(f"_bucket % {parent_buckets}L"))
        both = above.join(F.broadcast(parents.selectExpr("_bucket AS _above")), "_above", "left_semi")
    sums = digest_sums()
    totals = both.groupBy("_bucket").agg(
        *[F.expr(f"{value} AS {name}") for name, value in sums.items()], F.expr("count(1) AS _size")
    )
    return totals.where(" OR ".join(f"{name} <> 0" for name in sums)).select("_bucket", "_size")


def unequal_leaves(
    source: DataFrame, target: DataFrame, pairing: Pairing, buckets: int, leaf_rows: int = LEAF_ROWS
) -> tuple[DataFrame, int]:
    """``_bucket, _size`` of the unequal leaves, and the number that key hashes are taken modulo to get ``_bucket``.

    Runs one job a level; each level is written to the shared folder, and only its number of nodes and rows is read back.
    """
    spark = source.sparkSession
    within, before = None, None
    while True:
        folder = scratch_folder(spark, "nodes")
        _node_totals(source, target, pairing, buckets, within).write.parquet(folder)
        nodes = spark.read.schema("_bucket bigint, _size bigint").parquet(folder)
        count, rows = nodes.selectExpr("count(1)", "coalesce(sum(_size), 0L)").first()
        small = count == 0 or rows <= leaf_rows * count
        if count > MAX_BUCKETS:
            # Too many to broadcast: the level above, if there is one, is the finest that prunes.
            return within if within is not None else (nodes, buckets)
        if small or (before is not None and rows > LEAST_GAIN * before) or buckets >= 1 << 56:
            return nodes, buckets
        within, before = (nodes, buckets), rows
        wanted = max(2, -(-rows // (count * leaf_rows)) * 4)
        buckets *= min(FAN_OUT, 1 << (wanted - 1).bit_length())


def unequal_buckets(source: DataFrame, target: DataFrame, pairing: Pairing, buckets: int) -> DataFrame:
    """Numbers of the buckets whose row multisets differ, in one level."""
    return _node_totals(source, target, pairing, buckets, None).select("_bucket")


def compare_pruned(
    source: DataFrame,
    target: DataFrame,
    keys: Sequence[str],
    *,
    skip: Iterable[str] | None = None,
    tolerance: Tolerance = EXACT,
    buckets: int = DEFAULT_BUCKETS,
    leaf_rows: int = LEAF_ROWS,
) -> RowComparison:
    """A comparison that holds every differing row, but no row that matches. The digests are compared when this is called."""
    if not 1 <= buckets <= MAX_BUCKETS:
        raise ValueError(f"buckets must lie between 1 and {MAX_BUCKETS}")
    source, target = (orderable_columns(drop_columns(side, skip)) for side in (source, target))
    pairing = pair_columns(source, target, keys)
    changed, buckets = unequal_leaves(source, target, pairing, buckets, leaf_rows)
    key_names = [f"_k{i}" for i in range(len(pairing.keys))]
    tagged = tag_sides(source, target, pairing).selectExpr("*", bucket(key_names, buckets))
    candidates = tagged.join(F.broadcast(changed.select("_bucket")), "_bucket", "left_semi").drop("_bucket")
    rows = classify(candidates, pairing, tolerance).where(f"{STATUS} <> '{MATCHED}'")
    return RowComparison(rows, pairing)
