"""Mixing sources to target weights that change over the training: how often and when each document is trained on."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BUCKET_DIGITS = 3
WORDS = r"[^\\x20\\x09-\\x0D]+"


def with_size(documents: DataFrame) -> DataFrame:
    """Adds ``size``: the number of words of the whole text; null has none."""
    return documents.withColumn("size", F.expr(f"cast(coalesce(regexp_count(text, '{WORDS}'), 0) AS bigint)"))


Schedule = Sequence[tuple[float, float]]


def integrated(schedule: Schedule) -> tuple[float, list[dict[str, float]]]:
    """The integral of a schedule, and its pieces (at, until, done, until_done, start, end) as in ``segments``.

    A schedule is a line through points (time, factor), times from 0 to 1; two points at one time are a step. Pieces
    without any weight are left out, as nothing is trained on in them.
    """
    times = [float(t) for t, _ in schedule]
    if len(times) < 2 or times != sorted(times) or times[0] != 0 or times[-1] != 1 or min(f for _, f in schedule) < 0:
        raise ValueError(f"a schedule needs factors from 0 on at rising times from 0 to 1: {schedule}")
    pieces, done = [], 0.0
    for (at, start), (until, end) in zip(schedule, schedule[1:]):
        area = (until - at) * (start + end) / 2
        if area > 0:
            piece = {"at": at, "until": until, "done": done, "until_done": done + area, "start": start, "end": end}
            pieces.append({k: float(v) for k, v in piece.items()})
            done += area
    if not pieces:
        raise ValueError(f"a schedule needs some weight: {schedule}")
    for piece in pieces:
        piece["done"] /= done
        piece["until_done"] /= done
    return done, pieces


def source_targets(
    sizes: DataFrame,
    weights: Sequence[float] = (5, 2, 1),
    percent: int = 150,
    cap: int = 2,
    swing: float = 0.5,
    schedules: Sequence[Schedule] | None = None,
) -> DataFrame:
    """Targets of the sources of ``sizes`` (source, size): source, source_size, weight, target, segments.

    Sources in code point order, null last, take the weights and the ``schedules`` in turn. A schedule (see
    :func:`integrated`) says by which factor the weight is multiplied at each time; the source's weight in all is the
    integral over the training. Without ``schedules`` they are straight lines through 1 at half time, rising by ``swing``
    for every other source and falling for the rest. The targets share ``percent`` of all words by weight; what exceeds
    ``cap`` times a source's size is shared among the others by weight, until none exceeds it.

    ``segments`` describes the schedule for :func:`training_position`: pieces (at, until, done, until_done, start, end)
    of the time axis, with the part of the integral done at their ends and the weight at both ends. One row for each
    source, so the ordered window over sources sees short rows only.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    made = [integrated(s) for s in schedules or ([(0, 1 - swing), (1, 1 + swing)], [(0, 1 + swing), (1, 1 - swing)])]
    listed = ", ".join(f"{float(w)}D" for w in weights)
    integrals = ", ".join(f"{total}D" for total, _ in made)
    segments = ", ".join(
        "array(" + ", ".join(
            "named_struct(" + ", ".join(f"'{k}', {v}D" for k, v in piece.items()) + ")" for piece in pieces
        ) + ")"
        for _, pieces in made
    )
    ranked = totals.selectExpr(
        "source", "source_size", "row_number() OVER (ORDER BY source IS NULL, source) - 1 AS place"
    ).selectExpr(
        "*",
        f"element_at(array({listed}), cast(place % {len(weights)} + 1 AS int))"
        f" * element_at(array({integrals}), cast(place % {len(made)} + 1 AS int)) AS weight",
    )
    ordered = ranked.selectExpr(
        "*",
        f"{cap} * source_size / weight AS ratio",
        f"{percent} * sum(source_size) OVER () / 100D AS demand",
        "sum(weight) OVER () AS all_weight",
    )
    before = "OVER (ORDER BY ratio, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    levels = ordered.selectExpr(
        "*",
        f"(demand - coalesce({cap} * sum(source_size) {before}, 0)) / (all_weight - coalesce(sum(weight) {before}, 0D))"
        " AS level",
    )
    # The level of the first source that its share does not fill is the level of all that follow.
    filled = levels.selectExpr(
        "*", "min(CASE WHEN level <= ratio THEN struct(ratio, place, level) END) OVER () AS first_open"
    )
    return filled.selectExpr(
        "source",
        "source_size",
        "weight",
        f"CASE WHEN first_open IS NULL OR ratio < first_open.level THEN cast({cap} * source_size AS double)"
        " ELSE first_open.level * weight END AS target",
        f"element_at(array({segments}), cast(place % {len(made)} + 1 AS int)) AS segments",
    )


def _same(a: str, b: str) -> str:
    return f"{a}.source <=> {b}.source"


def plan_mix(documents: DataFrame, targets: DataFrame, passes: int = 2, whole: bool = False) -> DataFrame:
    """``documents`` (doc_id, source, size, any more columns) with source_size, target, start and takes.

    Each source reads its documents in the order of a hash of their ids, up to ``passes`` times, until its target is
    met. ``start`` is the number of words of the source before the document. ``takes`` lists for each pass that takes
    the document (copy, words, position): the words it takes and the time in the training, from 0 to 1, at which the
    source's cumulative demand reaches the document. The last document of a source is cut where the target is met; with
    ``whole`` it is taken in full if more than half of it is due.

    Numbering needs no task to see a whole source: documents fall into buckets by their hash, bucket totals give the
    offsets, and running sums go within buckets. Null sources are a source of their own; documents without words are
    taken with no words; rows with equal ids are numbered one after another, in any order where they are alike.
    """
    keyed = documents.withColumn("order_key", F.expr("coalesce(md5(cast(doc_id AS string)), '')")).withColumn(
        "bucket", F.expr(f"substr(order_key, 1, {BUCKET_DIGITS})")
    )
    offsets = (
        keyed.groupBy("source", "bucket")
        .agg(F.sum("size").alias("bucket_size"))
        .withColumn(
            "bucket_start", F.expr("sum(bucket_size) OVER (PARTITION BY source ORDER BY bucket) - bucket_size")
        )
    )
    per_bucket = (
        offsets.alias("o")
        .join(targets.alias("t"), F.expr(_same("o", "t")))
        .selectExpr("o.source", "bucket", "bucket_start", "source_size", "target", "segments")
    )
    running = keyed.withColumn(
        "before",
        F.expr(
            "sum(size) OVER (PARTITION BY source, bucket ORDER BY order_key, doc_id, size"
            " ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - size"
        ),
    )
    placed = (
        running.alias("d")
        .join(per_bucket.alias("b"), F.expr(f"{_same('d', 'b')} AND d.bucket = b.bucket"))
        .selectExpr(
            *[f"d.`{c}`" for c in documents.columns], "source_size", "target", "bucket_start + before AS start", "segments"
        )
    )
    due = "round(target) - (p * source_size + start)"
    words = f"CASE WHEN {due} > size / 2 OR ({due} > 0 AND size = 0) THEN size ELSE -1 END" if whole else (
        f"CASE WHEN {due} > 0 THEN cast(least({due}, size) AS bigint) ELSE -1 END"
    )
    progress = "least((p * source_size + start) / nullif(target, 0D), 1D)"
    copies = (
        f"transform(sequence(0, {passes - 1}), p -> named_struct('copy', p, 'words', cast({words} AS bigint),"
        f" 'position', {training_position(progress)}))"
    )
    return placed.withColumn("takes", F.expr(f"filter({copies}, t -> t.words >= 0)")).drop("segments")


def training_position(progress: str) -> str:
    """SQL for the time at which a source has met the part ``progress`` of its demand, from its ``segments``.

    Within a piece the weight is a straight line, so the demand is a parabola, which is inverted in closed form.
    """
    piece = f"try_element_at(filter(segments, s -> {progress} <= s.until_done), 1)"
    done = f"(({progress} - {piece}.done) / ({piece}.until_done - {piece}.done))"
    area = f"({done} * ({piece}.start + {piece}.end))"
    slope = f"({piece}.end - {piece}.start)"
    # A line that begins at 0 has no area at its beginning; one that ends at 0 may round below it.
    root = f"sqrt(greatest({piece}.start * {piece}.start + {slope} * {area}, 0D))"
    part = f"coalesce({area} / nullif({piece}.start + {root}, 0D), {progress} * 0D)"
    return f"{piece}.at + ({piece}.until - {piece}.at) * {part}"


def training_order(plan: DataFrame, columns: Sequence[str], untaken: bool = False) -> DataFrame:
    """One row for each take of a plan, range-sorted by its position: ``columns``, then copy, words, position.

    With ``untaken``, documents without a take come first, copy, words and position null.
    """
    explode = F.explode_outer if untaken else F.explode
    return (
        plan.select(*columns, explode("takes").alias("take"))
        .select(*columns, "take.copy", "take.words", "take.position")
        .orderBy("position", "doc_id", "copy")
    )


def mix_positions(plan: DataFrame) -> DataFrame:
    """The training order of a plan with all documents: doc_id, size, source_size, target, taken (words of all takes of
    the document), first_copy (null if there is none), then copy, words, position of this take."""
    summed = plan.selectExpr(
        "*", "aggregate(takes, 0L, (s, t) -> s + t.words) AS taken", "get(takes, 0).copy AS first_copy"
    )
    return training_order(summed, ["doc_id", "size", "source_size", "target", "taken", "first_copy"], untaken=True)


def mix_summary(plan: DataFrame) -> DataFrame:
    """For each document: doc_id, size, source_size, target, taken (words of all its takes), first_position."""
    return plan.selectExpr(
        "doc_id",
        "size",
        "source_size",
        "target",
        "aggregate(takes, 0L, (s, t) -> s + t.words) AS taken",
        "get(takes, 0).position AS first_position",
    )
