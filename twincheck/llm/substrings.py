"""Repeated passages: content-defined chunks from a gear rolling hash, deduplicated by digest."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twincheck.llm.scratch import Scratch
from twincheck.llm.wordhash import Block, as_long, blocks, mix, powers

#: A random number for each byte value.
GEAR = (mix(np.arange(1, 257, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32)
_FIRST_BYTES = np.ones(256, dtype=bool)
_FIRST_BYTES[0x80:0xC0] = False


@dataclass(frozen=True)
class Chunking:
    """A chunk begins where the gear hash of the last 16 bytes is least among the ``radius`` places on either side.

    Only places where a character begins count. Text of a period up to ``radius`` has such a place in each period: of
    these, those are taken that lie more than ``radius`` after the one taken before, counted from the first of the run,
    so its chunks are equal wherever the run begins. Chunks are longer than ``radius`` bytes and about twice that on average; a place depends on the ``radius`` + 15
    bytes before it and the ``radius`` after it, so an insertion changes the chunks around it only. What repeats is
    reported from ``least_words`` on, with ``exact_copies`` also a copy of a whole text at any length; what comes again within ``least_words`` words is a
    phrase said over and over, not a repeat. With radius 16, a passage of 50 words of six bytes spans about seven chunks.
    """

    radius: int = 16
    least_words: int = 20
    exact_copies: bool = False
    #: A digest with more than this share of all pieces is spread over ``salts`` tasks; there are less than its inverse.
    hot_share: float = 0.001
    salts: int = 64


def gear_hashes(data: np.ndarray) -> np.ndarray:
    """The sum of the last 16 bytes' gear numbers, each shifted by its distance; the same as shifting one bit a byte."""
    h = GEAR[data]
    for step in (1, 2, 4, 8):
        h[step:] = h[step:] + (h[:-step] << np.uint32(step))
    return h


def chunk_starts(block: Block, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Where chunks begin, the texts' own beginnings (of texts that are not empty) included, and the text of each."""
    data, bounds = block.data, block.bounds
    h = np.where(_FIRST_BYTES[data], gear_hashes(data), np.uint32(0xFFFFFFFF)) if len(data) else gear_hashes(data)
    n = len(h)
    inner = np.zeros(0, dtype=np.int64)
    if n > 2 * radius:
        low, width = h, 1
        while width < radius:
            step = min(width, radius - width)
            low = np.minimum(low[: len(low) - step], low[step:])
            width += step
        at = np.arange(radius, n - radius)
        own = h[radius : n - radius]
        inner = at[(own <= low[: len(at)]) & (own <= low[radius + 1 : radius + 1 + len(at)]) & _FIRST_BYTES[data[at]]]
        text = np.searchsorted(bounds, inner, side="right") - 1
        # All that a place depends on lies within its text.
        inner = _thinned(inner[(inner - radius - 15 >= bounds[text]) & (inner + radius < bounds[text + 1])], radius)
    filled = np.flatnonzero(np.diff(bounds))
    starts = np.sort(np.concatenate([bounds[filled], inner]))
    return starts, np.searchsorted(bounds, starts, side="right") - 1


def _thinned(places: np.ndarray, radius: int) -> np.ndarray:
    """``places`` without those within ``radius`` after one that stays; only equal hashes are that close."""
    close = np.diff(places) <= radius
    if not close.any():
        return places
    kept = np.concatenate([[True], ~close])
    firsts = np.flatnonzero(kept)
    for first, end in zip(firsts.tolist(), np.append(firsts[1:], len(places)).tolist()):
        if end - first > 1:
            run = places[first:end]
            at = int(np.searchsorted(run, run[0] + radius, side="right"))
            while at < len(run):
                kept[first + at] = True
                at = int(np.searchsorted(run, run[at] + radius, side="right"))
    return places[kept]


def _pieces(rule: Chunking):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        line = TaskContext.get().partitionId() << 33
        for batch in batches:
            for block in blocks(batch.column("text")):
                yield _block_pieces(block, batch.column("doc_id").slice(block.first, block.texts), line, rule)
                line += block.texts

    return run


def _block_pieces(block: Block, doc_ids: pa.Array, line: int, rule: Chunking) -> pa.RecordBatch:
    starts, text = chunk_starts(block, rule.radius)
    if rule.exact_copies:
        # A text that is shorter than any passage is one chunk, and found as a whole only.
        kept = np.isin(starts, block.bounds) | (block.n_words >= rule.least_words)[text]
        starts, text = starts[kept], text[kept]
    # The digest of a piece: two chunks in a row of the same text, or the only one.
    same = text[:-1] == text[1:]
    alone = ~np.append(same, False) & ~np.append(False, same)[: len(text)] if len(text) else np.zeros(0, dtype=bool)
    first = np.flatnonzero(np.append(same, False)[: len(text)] | alone)
    ends = np.append(starts[1:], len(block.data))
    ends = np.minimum(ends, block.bounds[text + 1]) if len(text) else ends[:0]
    forth, back = powers(len(block.data))
    sums = np.zeros(len(block.data) + 1, dtype=np.uint64)
    np.cumsum((block.data.astype(np.uint64) + np.uint64(1)) * forth[: len(block.data)], out=sums[1:])
    begin, end = starts[first], ends[first + ~alone[first]]
    digests = mix((sums[end] - sums[begin]) * back[begin])
    owner = text[first]
    salted = mix(digests ^ mix(owner.astype(np.uint64) + np.uint64(1)))
    words = block.spans[0]
    words_before = np.searchsorted(words, begin) - block.word_bounds[owner]
    order = np.argsort(salted, kind="stable")
    again, close = np.zeros(len(first), dtype=bool), np.zeros(len(first), dtype=bool)
    again[order[1:]] = salted[order[1:]] == salted[order[:-1]]
    close[order[1:]] = again[order[1:]] & (words_before[order[1:]] - words_before[order[:-1]] < rule.least_words)
    chars = np.zeros(len(block.data) + 1, dtype=np.int64)
    np.cumsum(_FIRST_BYTES[block.data], out=chars[1:])
    edges = pa.array(np.searchsorted(owner, np.arange(block.texts + 1)).astype(np.int32))

    def lists(values, kind):
        return pa.ListArray.from_arrays(edges, pa.array(values, kind))

    base = chars[block.bounds[owner]]
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.arange(line, line + block.texts)),
            doc_ids,
            pa.ListArray.from_arrays(edges, as_long(digests)),
            pa.ListArray.from_arrays(edges, pa.array(again, pa.bool_(), mask=close)),
            lists(chars[begin] - base, pa.int32()),
            lists(chars[end] - base, pa.int32()),
            lists(words_before, pa.int32()),
            lists(np.searchsorted(words, end) - block.word_bounds[owner], pa.int32()),
        ],
        names=["line", "doc_id", "digests", "again", "starts", "ends", "words_before", "words_after"],
    )


def repeated_spans(documents: DataFrame, rule: Chunking = Chunking()) -> DataFrame:
    """Passages of ``documents`` (doc_id: long, text; more columns are ignored) that occur more than once: doc_id,
    span_start, span_end (code points), n_words, removed, first_doc_id; documents without any have no row.

    Digests are taken of every two chunks in a row, some ten words, so that chance repeats of short chunks count for
    nothing. The first occurrence, in the document with the smallest id, stays (``removed`` false); all others go.

    1. One pass writes each text's digests. 2. Digests are counted with map-side combine. 3. Occurrences of repeated
    digests are joined back (those of a hot digest by salted keys), and runs of them in a text become spans.

    A text of one chunk is a passage as a whole, and so is any of less than ``least_words`` words with ``exact_copies``. A word or short phrase said
    over and over, less than ``least_words`` words apart, is no repeat of itself, only of the same in another place. Null and empty texts have no spans. Rows with equal ids are texts of their own, all of them
    first occurrences if the id is the smallest; a null id is never first unless all are null. An empty table: no rows.
    """
    scratch = Scratch(documents.sparkSession, "substrings")
    pieces = scratch.save(
        documents.selectExpr("cast(doc_id AS bigint) AS doc_id", "cast(text AS string) AS text").mapInArrow(
            _pieces(rule),
            "line long, doc_id long, digests array<long>, again array<boolean>, starts array<int>, ends array<int>,"
            " words_before array<int>, words_after array<int>",
        ),
        "pieces",
    )
    counted = "CASE WHEN exists(again, a -> a IS NULL) THEN filter(digests, (d, i) -> again[i] IS NOT NULL) ELSE digests END"
    found = pieces.selectExpr("doc_id", f"explode({counted}) AS digest")
    repeated = scratch.save(
        found.groupBy("digest").agg(F.count("*").alias("n"), F.min("doc_id").alias("first_doc_id")).filter("n > 1"),
        "repeated",
    )
    total = pieces.selectExpr("coalesce(sum(cast(size(digests) AS bigint)), 0L)").first()[0]
    # At most 1 / hot_share rows, as the counts of all digests add up to the total.
    hot = repeated.filter(f"n > {rule.hot_share} * {total}").selectExpr("digest", "true AS hot")
    salted = (
        repeated.join(F.broadcast(hot), "digest", "left")
        .selectExpr("digest", "first_doc_id", f"explode(sequence(0, if(hot, {rule.salts - 1}, 0))) AS salt")
    )
    placed = pieces.select("line", "doc_id", F.posexplode(F.arrays_zip("digests", "again")).alias("place", "piece"))
    hits = (
        placed.selectExpr("line", "doc_id", "place", "piece.digests AS digest", "coalesce(piece.again, false) AS again")
        .join(F.broadcast(hot), "digest", "left")
        .selectExpr("line", "doc_id", "place", "digest", "again", f"if(hot, cast(pmod(xxhash64(line), {rule.salts}) AS int), 0) AS salt")
        .join(salted, ["digest", "salt"])
        .selectExpr("line", "place", "again OR NOT doc_id <=> first_doc_id AS removed", "first_doc_id")
    )
    runs = (
        hits.selectExpr("*", "place - row_number() OVER (PARTITION BY line, removed ORDER BY place) AS run")
        .groupBy("line", "removed", "run")
        .agg(F.min("place").alias("low"), F.max("place").alias("high"), F.min("first_doc_id").alias("first_doc_id"))
    )
    return (
        runs.join(pieces.drop("digests", "again"), "line")
        .selectExpr(
            "doc_id",
            "cast(starts[low] AS bigint) AS span_start",
            "cast(ends[high] AS bigint) AS span_end",
            "cast(words_after[high] - words_before[low] AS bigint) AS n_words",
            "removed",
            "first_doc_id",
            f"low = 0 AND high = size(starts) - 1 AND words_after[high] > 0 AND {str(rule.exact_copies).lower()} AS whole",
        )
        .filter(f"whole OR n_words >= {rule.least_words}")
        .drop("whole")
    )


def without_repeats(documents: DataFrame, spans: DataFrame) -> DataFrame:
    """``documents`` with the removed spans of :func:`repeated_spans` cut out of their texts. Ids must be unique."""
    cuts = (
        spans.filter("removed")
        .groupBy("doc_id")
        .agg(F.array_sort(F.collect_set(F.struct("span_start", "span_end"))).alias("_cuts"))
    )
    # From cut to cut: what lies between the end of the last one and the start of the next.
    kept = (
        "aggregate(_cuts, struct('' AS kept, 0L AS done), (s, c) -> struct(concat(s.kept,"
        " substring(text, cast(s.done + 1 AS int), cast(greatest(c.span_start - s.done, 0L) AS int))) AS kept,"
        " greatest(s.done, c.span_end) AS done), s -> concat(s.kept, substring(text, cast(s.done + 1 AS int))))"
    )
    joined = documents.join(cuts.withColumnRenamed("doc_id", "_cut_id"), F.expr("doc_id <=> _cut_id"), "left")
    return joined.withColumn("text", F.expr(f"CASE WHEN _cuts IS NULL THEN text ELSE {kept} END")).select(
        *documents.columns
    )
