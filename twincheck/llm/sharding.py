"""Reproducible shuffles: a keyed permutation of global row numbers, from which shard and slot follow by division.

Everything here is DataFrame and SQL functions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Equal rows that are numbered as one unit; more of them are several units, which lie in buckets of their own.
RUN = 65_536
#: Steps that a cycle may stay outside of the numbers. At most about sqrt(n) numbers are outside, so a walk leaves them
#: within sqrt(n) steps, and takes 64 with a chance below 64**-64 where n is above 4,096; it fails rather than stop short.
WALK = 64


def _mixed(value: str, step: str, seed: int) -> str:
    """SQL for a number from 0 to 2**60 - 1 that depends on seed, step and value."""
    return f"cast(conv(substr(md5(concat_ws('/', '{seed}', {step}, {value})), 1, 15), 16, 10) AS bigint)"


def _rounds(x: str, seed: int, rounds: int, back: bool) -> str:
    """SQL for one pass through the Feistel network over numbers l * wide + r with l below tall and r below wide."""
    sign, order = ("-", f"sequence({rounds}, 1, -1)") if back else ("+", f"sequence(1, {rounds})")
    l_part = f"pmod(s.l {sign} {_mixed('s.r', 'i', seed)} % tall, tall)"
    r_part = f"pmod(s.r {sign} {_mixed('s.l', 'i', seed)} % wide, wide)"
    return (
        f"aggregate({order}, named_struct('l', {x} div wide, 'r', {x} % wide), (s, i) -> named_struct("
        f"'l', CASE WHEN i % 2 = 1 THEN {l_part} ELSE s.l END, 'r', CASE WHEN i % 2 = 0 THEN {r_part} ELSE s.r END),"
        " s -> s.l * wide + s.r)"
    )


def permuted(frame: DataFrame, number: str, to: str, seed: int = 0, rounds: int = 6, back: bool = False) -> DataFrame:
    """Adds ``to``: where the permutation of 0 .. rows - 1 puts ``number``, or with ``back`` what it puts there.

    ``frame`` needs ``rows``. A Feistel network permutes the numbers of a grid of about sqrt(rows) on each side; numbers
    beyond ``rows`` are passed through it again (cycle walking), which leaves a permutation of the others.
    """
    grid = frame.withColumn("tall", F.expr("cast(ceil(sqrt(rows)) AS bigint)")).withColumn(
        "wide", F.expr("(rows + tall - 1) div tall")
    )
    once = grid.withColumn("walked", F.expr(_rounds(number, seed, rounds, back)))
    again = f"aggregate(sequence(1, {WALK}), walked, (y, k) -> CASE WHEN y < rows THEN y ELSE {_rounds('y', seed, rounds, back)} END)"
    done = once.withColumn("walked", F.expr(f"CASE WHEN walked < rows THEN walked ELSE {again} END"))
    checked = "CASE WHEN walked < rows THEN walked ELSE raise_error('the cycle walk did not end') END"
    return done.withColumn(to, F.expr(checked)).drop("tall", "wide", "walked")


def numbered(frame: DataFrame) -> DataFrame:
    """``frame`` as row (a struct of all columns), number (from 0, without gaps) and rows (how many there are).

    The number is the place of the row in the order of a digest of its columns, so it depends on the rows alone, not on
    files, partitions or retries. Rows that are equal in all columns are told apart by nothing and get numbers in a row.

    Rows go by digest into 16 M buckets in two levels; counts of the first level (4,096) and of the second (4,096 in each)
    give the offset of a bucket, so no task sorts more than one bucket. Equal rows are counted before the shuffle.
    Columns need types that Spark can group by.
    """
    units = (
        frame.select(F.struct("*").alias("row"))
        .groupBy("row")
        .agg(F.count("*").alias("copies"))
        .selectExpr("row", "copies", f"explode(sequence(0L, (copies - 1) div {RUN})) AS run")
        .selectExpr(
            "row", f"least(copies - run * {RUN}, {RUN}L) AS copies", "md5(concat(to_json(row), '/', run)) AS digest"
        )
        .selectExpr("*", "substr(digest, 1, 3) AS high", "substr(digest, 4, 3) AS low")
    )
    buckets = units.groupBy("high", "low").agg(F.sum("copies").alias("held"))
    of_high = (
        buckets.groupBy("high")
        .agg(F.sum("held").alias("held"))
        .selectExpr("high", "sum(held) OVER (ORDER BY high) - held AS high_start", "sum(held) OVER () AS rows")
    )
    starts = buckets.selectExpr(
        "high", "low", "sum(held) OVER (PARTITION BY high ORDER BY low) - held AS low_start"
    ).join(of_high, "high")
    placed = units.join(starts, ["high", "low"]).selectExpr(
        "row", "copies", "rows",
        "high_start + low_start + sum(copies) OVER (PARTITION BY high, low ORDER BY digest, row"
        " ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - copies AS first",
    )
    return placed.selectExpr("row", "first", "rows", "explode(sequence(0L, copies - 1)) AS copy").selectExpr(
        "row", "first + copy AS number", "rows"
    )


def shard_rows(frame: DataFrame, shards: int = 16, seed: int = 0, rounds: int = 6) -> DataFrame:
    """``frame`` as row (a struct of all columns), number, rows, position, shard and slot.

    ``position`` is the place of the row in the shuffle; shard and slot are its remainder and quotient by ``shards``, so
    shards differ by one row at most and slots have no gaps. The same rows and seed give the same shuffle on any cluster.
    Columns of any name, null values and repeated rows are carried along; an empty table has no rows.
    """
    placed = permuted(numbered(frame), "number", "position", seed, rounds)
    return placed.selectExpr(
        "*", f"cast(position % {int(shards)} AS int) AS shard", f"position div {int(shards)} AS slot"
    )


def row_numbers(places: DataFrame, shards: int = 16, seed: int = 0, rounds: int = 6) -> DataFrame:
    """``places`` (shard, slot, rows, any more columns) with the number of the row that lies there, without any data."""
    at = places.withColumn("position", F.expr(f"cast(slot AS bigint) * {int(shards)} + shard"))
    return permuted(at, "position", "number", seed, rounds, back=True).drop("position")


def write_shards(frame: DataFrame, folder: str, shards: int = 16, seed: int = 0, files: int = 1) -> None:
    """Writes ``frame`` as Parquet below ``folder``/shard=N, about ``files`` a shard, rows in the order of their slots.

    Rows are written as ``row`` (a struct) and ``slot``, so a column of the name shard or slot is kept apart.
    """
    dealt = shard_rows(frame, shards, seed).select("shard", "slot", "row")
    ordered = dealt.repartitionByRange(shards * files, "shard", "slot").sortWithinPartitions("shard", "slot")
    ordered.write.partitionBy("shard").parquet(folder)


def shard_documents(documents: DataFrame, shards: int = 16, seed: int = 0) -> DataFrame:
    """``documents`` (doc_id, text) to doc_id, size, text_crc32, law (``rows``), shard, slot, grown_shard (null).

    Size is the number of UTF-8 bytes and one more; null has no bytes, as an empty text. Rows of equal id, size and
    checksum are equal here; repeated rows and null ids are rows like all others. Other columns are ignored. Texts of any
    length stay where they are read: only id, size and checksum move.
    """
    short = documents.selectExpr(
        "cast(doc_id AS bigint) AS doc_id",
        "cast(coalesce(octet_length(cast(text AS string)), 0) + 1 AS bigint) AS size",
        "crc32(cast(coalesce(cast(text AS string), '') AS binary)) AS text_crc32",
    )
    return shard_rows(short, shards, seed).selectExpr(
        "row.doc_id", "row.size", "row.text_crc32", "'rows' AS law", "shard", "slot", "cast(NULL AS int) AS grown_shard"
    )
