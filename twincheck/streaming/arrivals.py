"""Intake of dropped files as a file stream: every file is reported once, whatever is restarted, and paired as it arrives."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from datetime import timedelta

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from twincheck.functions.sqltext import literal
from twincheck.operators.filepairs import base_name, folder_name
from twincheck.sources.dropfolder import SOURCE_SUFFIX, TARGET_SUFFIX

_BINARY_FILE = "path string, modificationTime timestamp, length bigint, content binary"
PAIR_SCHEMA = "folder string, stem string, source_path string, target_path string, status string"
#: What becomes of a name: both halves came in time, only one did, or the second came after the time was up.
PAIRED, UNPAIRED, LATE = "pair", "unpaired", "late pair"
#: One row for each open name of a bucket; ``due`` is when its half is reported, in ms, NULL once it was.
_STATE_SCHEMA = (
    "names array<struct<folder: string, stem: string, source: string, source_time: double, target: string,"
    " target_time: double, reported: boolean, due: bigint>>"
)
_HELD = ("source", "source_time", "target", "target_time", "reported", "due")
BUCKETS = 512


def arriving_files(spark: SparkSession, folder: str, suffix: str = ".csv") -> DataFrame:
    """Streaming ``path, length, modificationTime`` of files that appear below ``folder``; no content is kept."""
    return (
        spark.readStream.format("binaryFile")
        .schema(_BINARY_FILE)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", f"*{suffix}")
        .load(folder)
        .select("path", "length", "modificationTime")
    )


def append_stream(stream: DataFrame, table: str, checkpoint: str) -> None:
    """Append what is new in a stream to ``table``, then stop."""
    query = (
        stream.writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(table)
    )
    query.awaitTermination()


def record_arrivals(spark: SparkSession, folder: str, table: str, checkpoint: str, suffix: str = ".csv") -> None:
    """Append the files that are new since the last call to ``table``, then stop.

    The stream's checkpoint knows the files already seen, so nothing has to be moved out of the drop folder.
    """
    append_stream(arriving_files(spark, folder, suffix), table, checkpoint)


def _match(wait_seconds: float):
    """The state of the open names of one bucket: the halves that came, and whether the first was reported as unpaired.

    A call of a function on a group costs some milliseconds, whatever the group holds; so names are dealt with by the bucket.
    """

    def run(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        watermark = state.getCurrentWatermarkMs()
        names = {tuple(row[:2]): dict(zip(_HELD, row[2:])) for row in (state.get[0] if state.exists else ())}
        rows, came = [], defaultdict(list)
        if not state.hasTimedOut:
            for files in batches:
                for folder, stem, *file in zip(*(files[c].tolist() for c in ("folder", "stem", "side", "path", "time"))):
                    came[folder, stem].append(file)
        for name, files in came.items():
            held = names.pop(name, dict.fromkeys(_HELD))
            for side, path, time in sorted(files, key=lambda f: (f[2], f[0], f[1])):
                # A half that comes again before its counterpart takes the place of the first.
                held[side], held[f"{side}_time"] = path, time
                if held["source"] is not None and held["target"] is not None:
                    apart = abs(held["source_time"] - held["target_time"])
                    rows.append((*name, held["source"], held["target"], LATE if held["reported"] or apart > wait_seconds else PAIRED))
                    held = dict.fromkeys(_HELD)
            if held["source"] is not None or held["target"] is not None:
                names[name] = held
                if not held["reported"]:
                    latest = max(t for t in (held["source_time"], held["target_time"]) if t is not None)
                    held["due"] = max(int((latest + wait_seconds) * 1000), watermark + 1)
        for name, held in names.items():
            if held["due"] is not None and held["due"] < watermark:
                rows.append((*name, held["source"], held["target"], UNPAIRED))
                held["reported"], held["due"] = True, None
        if names:
            state.update(([(*name, *held.values()) for name, held in names.items()],))
            if waiting := [held["due"] for held in names.values() if held["due"] is not None]:
                state.setTimeoutTimestamp(min(waiting))
        else:
            state.remove()
        if rows:
            yield pd.DataFrame(rows, columns=["folder", "stem", "source_path", "target_path", "status"])

    return run


def pair_arrivals(
    files: DataFrame,
    wait: timedelta = timedelta(days=1),
    *,
    source_suffix: str = SOURCE_SUFFIX,
    target_suffix: str = TARGET_SUFFIX,
    buckets: int = BUCKETS,
) -> DataFrame:
    """A stream of files (``path, modificationTime``) to a stream of ``PAIR_SCHEMA``, each name once its fate is known.

    The first half of a pair is kept as state until the second comes: then both are a ``pair``. When files that are more
    than ``wait`` younger have come, the half is reported as ``unpaired``; a second half after that, or more than ``wait``
    younger than the first, makes a ``late pair``. After a pair its name begins anew, so redelivered pairs are paired again.
    State is a short row for each open name, so it grows with the halves that wait, not with the files that came. It is kept
    by the bucket of a name's hash, and a batch rewrites the buckets it touches: give more ``buckets`` where many millions of
    names stay open. Like the number of shuffle partitions, it stays as it is for the life of a checkpoint.
    """
    name = base_name("path")
    side = f"CASE WHEN endswith(path, {literal(source_suffix)}) THEN 'source' WHEN endswith(path, {literal(target_suffix)}) THEN 'target' END"
    sides = files.withWatermark("modificationTime", "0 seconds").selectExpr(
        "modificationTime", f"{folder_name('path')} AS folder", f"{name} AS name", f"{side} AS side", "path",
        "cast(modificationTime AS double) AS time",
    )
    stem = f"left(name, length(name) - if(side = 'source', {len(source_suffix)}, {len(target_suffix)}))"
    return (
        sides.where("side IS NOT NULL")
        .selectExpr("modificationTime", "folder", f"{stem} AS stem", "side", "path", "time")
        .withColumn("bucket", F.expr(f"pmod(hash(folder, stem), {buckets})"))
        .groupBy("bucket")
        .applyInPandasWithState(
            _match(wait.total_seconds()), PAIR_SCHEMA, _STATE_SCHEMA, "append", GroupStateTimeout.EventTimeTimeout
        )
    )


def record_pairs(
    spark: SparkSession, folder: str, table: str, checkpoint: str, wait: timedelta = timedelta(days=1)
) -> None:
    """Append the pairs, unpaired and late files that are new since the last call to ``table``, then stop."""
    append_stream(pair_arrivals(arriving_files(spark, folder), wait), table, checkpoint)

