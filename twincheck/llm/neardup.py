"""MinHash near-duplicate classes: fast similarity sketches, banding, exact verification, connected components."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twincheck.llm.components import connected
from twincheck.llm.scratch import Scratch
from twincheck.llm.wordhash import Block, as_long, blocks, mix

_STEP = np.uint64(0xD1342543DE82EF95)
_LOW = np.uint64(0xFFFFFFFF)
_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)
SKETCH_BYTES = 1 << 20
BITMAP_LONGS = 16


@dataclass(frozen=True)
class NearDuplicates:
    """Links texts whose sets of ``words``-word shingles have a Jaccard similarity of ``percent`` or more.

    ``coordinates`` is the sketch length, a power of two; bands take ``rows`` coordinates each. A pair at similarity 0.8
    shares no band of 42 bands of six with a chance of 3 in a million, and less above. Shingles are 64-bit hashes.
    """

    words: int = 5
    percent: int = 80
    coordinates: int = 256
    rows: int = 6

    @property
    def bands(self) -> int:
        return self.coordinates // self.rows


def shingles(block: Block, words: int) -> list[np.ndarray]:
    """For each text its distinct shingle hashes, sorted; a text of fewer words is one shingle, one without words none."""
    each = block.hashes(lower=True)
    bounds = block.word_bounds
    long = np.zeros(max(len(each) - words + 1, 0), dtype=np.uint64)
    for k in range(words):
        long = long * _STEP + each[k : k + len(long)]
    long = mix(long)
    found = []
    for at, to in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        if to - at >= words:
            own = np.sort(long[at : to - words + 1])
            keep = np.ones(len(own), dtype=bool)
            np.not_equal(own[1:], own[:-1], out=keep[1:])
            found.append(own[keep])
        elif to > at:
            own = np.full(1, to - at, dtype=np.uint64)
            for k in range(at, to):
                own = mix(own * _STEP + each[k : k + 1])
            found.append(own)
        else:
            found.append(long[:0])
    return found


def sketches(sets: list[np.ndarray], coordinates: int) -> np.ndarray:
    """One row of ``coordinates`` values for each set; values of two sets are equal in a place with the chance of their
    Jaccard similarity, and concentrated about it.

    Round i < t throws each element into one random place with a random value above those of earlier rounds, and round
    t + i throws all into place i, so after 2t rounds every place is filled. A set takes part until it has no gap, about
    t ln t / n rounds for n elements. Empty sets keep the largest value everywhere.
    """
    t = coordinates
    bits = np.uint64(64 - t.bit_length() + 1)
    out = np.full((len(sets), t), _EMPTY, dtype=np.uint64)
    sizes = np.array([len(x) for x in sets], dtype=np.int64)
    open_sets = np.flatnonzero(sizes)
    if not len(open_sets):
        return out
    values = np.concatenate([sets[i] for i in open_sets])
    owner = np.repeat(open_sets, sizes[open_sets])
    flat = out.reshape(-1)
    for i in range(2 * t):
        h = mix(values ^ np.uint64((i + 1) * int(_STEP) % (1 << 64)))
        place = owner * t + ((h >> bits).astype(np.int64) if i < t else i - t)
        np.minimum.at(flat, place, (np.uint64(i) << np.uint64(32)) | (h & _LOW))
        gaps = (out[open_sets] == _EMPTY).any(axis=1)
        if not gaps.all():
            going = np.zeros(len(sets), dtype=bool)
            going[open_sets[gaps]] = True
            open_sets = open_sets[gaps]
            if not len(open_sets):
                break
            keep = going[owner]
            values, owner = values[keep], owner[keep]
    return out


def band_keys(sketch: np.ndarray, rows: int) -> np.ndarray:
    bands = sketch.shape[1] // rows
    keys = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), (len(sketch), bands)).copy()
    for k in range(rows):
        keys = mix(keys * _STEP + sketch[:, k : bands * rows : rows])
    return keys


def _digests(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """128 bits that equal sets share, in two halves."""
    one = np.array([x.sum(dtype=np.uint64) for x in sets], dtype=np.uint64)
    two = np.array([mix(x ^ _STEP).sum(dtype=np.uint64) for x in sets], dtype=np.uint64)
    return one, two


def _sketch_task(rule: NearDuplicates):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch.column("text"), SKETCH_BYTES):
                sets = shingles(block, rule.words)
                one, two = _digests(sets)
                keys = band_keys(sketches(sets, rule.coordinates), rule.rows)
                starts = np.arange(0, keys.size + 1, rule.bands, dtype=np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(block.first, block.texts),
                        batch.column("digest").slice(block.first, block.texts),
                        pa.array([len(x) for x in sets], pa.int64()),
                        as_long(one),
                        as_long(two),
                        pa.ListArray.from_arrays(pa.array(starts), as_long(keys.reshape(-1))),
                    ],
                    names=["doc_id", "digest", "n_shingles", "digest_a", "digest_b", "bands"],
                )

    return run


def bitmaps(sets: list[np.ndarray]) -> np.ndarray:
    """A row of BITMAP_LONGS words for each set: every bit is the parity of the shingles that fall on it."""
    out = np.zeros((len(sets), BITMAP_LONGS), dtype=np.uint64)
    for row, own in zip(out, sets):
        h = mix(own ^ _STEP)
        np.bitwise_xor.at(row, (h >> np.uint64(8)).astype(np.int64) % BITMAP_LONGS, np.uint64(1) << (h & np.uint64(63)))
    return out


def _set_task(rule: NearDuplicates):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch.column("text"), SKETCH_BYTES):
                sets = shingles(block, rule.words)
                one, two = _digests(sets)
                starts = np.concatenate([[0], np.cumsum([len(x) for x in sets])]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(block.first, block.texts),
                        as_long(one),
                        as_long(two),
                        pa.ListArray.from_arrays(pa.array(starts), as_long(np.concatenate(sets))),
                        pa.ListArray.from_arrays(
                            pa.array(np.arange(0, BITMAP_LONGS * len(sets) + 1, BITMAP_LONGS, dtype=np.int32)),
                            as_long(bitmaps(sets).reshape(-1)),
                        ),
                    ],
                    names=["doc_id", "digest_a", "digest_b", "shingles", "bitmap"],
                )

    return run


def near_duplicate_classes(
    documents: DataFrame, rule: NearDuplicates = NearDuplicates(), with_digest: bool = False
) -> DataFrame:
    """``documents`` (doc_id: long, text; more columns are ignored) to doc_id, n_shingles, component_id, kept,
    and ``with_digest`` that of the text, which tells rows of equal id apart.

    1. Each text becomes a set of shingle hashes, a digest of the set, and band keys of its sketch.
    2. Texts of equal sets fall into one class by their digest, with the smallest doc_id as representative, so exact
       copies cost one comparison however many there are.
    3. Representatives that share a band key form a bucket. A bucket is never expanded into all pairs: in each round it
       compares pivots with its members of other components only, leaving out pairs that cannot be similar enough by
       their sizes or by bitmaps of their sets (bounds that never reject a link). A bucket is done when the members that have not been
       pivots lie in one component; pivots per bucket grow 64-fold with each round, so few rounds are needed.
    4. A pair counts only if its full sets agree. component_id is the smallest doc_id reachable over such links.

    Null or empty texts and texts without words have an empty set and are linked with nothing. Rows with the same doc_id
    count as one document for links. A null doc_id is linked with nothing and kept. An empty table gives no rows.
    """
    spark = documents.sparkSession
    scratch = Scratch(spark, "neardup")
    texts = documents.selectExpr("cast(doc_id AS bigint) AS doc_id", "cast(text AS string) AS text")
    made = scratch.save(
        texts.selectExpr("*", "coalesce(xxhash64(text), 0L) AS digest").mapInArrow(
            _sketch_task(rule),
            "doc_id long, digest long, n_shingles long, digest_a long, digest_b long, bands array<long>",
        ),
        "sketches",
    )
    digest = ["n_shingles", "digest_a", "digest_b"]
    real = made.filter("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = real.groupBy(*digest).agg(F.min("doc_id").alias("rep"))
    reps = (
        real.join(classes.withColumn("doc_id", F.col("rep")), [*digest, "doc_id"])
        .select("rep", "n_shingles", "digest_a", "digest_b", F.explode("bands").alias("key"))
        .distinct()
    )
    keys = reps.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1").select("key")
    members = scratch.save(reps.join(keys, "key").select("key", "rep", "n_shingles", "digest_a", "digest_b"), "members")
    labels = _components(texts, members, rule, scratch)
    nodes = classes.join(labels.withColumnRenamed("node", "rep"), "rep", "left")
    joined = made.select("doc_id", "digest", *digest).join(
        nodes.select(*digest, F.coalesce("component", "rep").alias("component")), digest, "left"
    )
    component = F.when(F.col("n_shingles") > 0, F.col("component")).otherwise(F.col("doc_id"))
    return joined.select(
        "doc_id",
        "n_shingles",
        F.when(F.col("doc_id").isNotNull(), component).alias("component_id"),
        "digest",
    ).selectExpr(
        "doc_id", "n_shingles", "component_id", "doc_id <=> component_id AS kept", *(["digest"] if with_digest else [])
    )


def _components(texts: DataFrame, members: DataFrame, rule: NearDuplicates, scratch: Scratch) -> DataFrame:
    """(node, component) of all representatives that have a link; pairs that other links already join go unchecked."""
    wanted = members.select("rep", "digest_a", "digest_b").distinct()
    sets = scratch.save(
        texts.join(wanted.select(F.col("rep").alias("doc_id")).distinct(), "doc_id", "left_semi")
        .mapInArrow(_set_task(rule), "doc_id long, digest_a long, digest_b long, shingles array<long>, bitmap array<long>")
        .join(wanted.withColumnRenamed("rep", "doc_id"), ["doc_id", "digest_a", "digest_b"], "left_semi")
        .dropDuplicates(["doc_id", "digest_a", "digest_b"])
        .select(F.col("doc_id").alias("rep"), "shingles", "bitmap"),
        "sets",
    )
    open_members = members.select("key", "rep", F.col("n_shingles").alias("n")).join(sets.select("rep", "bitmap"), "rep")
    open_members = open_members.withColumn("comp", F.col("rep"))
    # Sets differ in at least as many shingles as their bitmaps in bits.
    apart = " + ".join(f"bit_count(get(bitmap, {i}) ^ get(pivot_bitmap, {i}))" for i in range(BITMAP_LONGS))
    labels = None
    turn = 0
    while True:
        chosen = _pivots(open_members, 64**turn)
        pairs = (
            open_members.join(
                chosen.selectExpr("key", "rep AS pivot", "n AS pivot_n", "comp AS pivot_comp", "bitmap AS pivot_bitmap"),
                "key",
            )
            .filter(
                f"pivot_comp <> comp AND 100 * least(n, pivot_n) >= {rule.percent} * greatest(n, pivot_n)"
                f" AND {100 + rule.percent} * ({apart}) <= {100 - rule.percent} * (n + pivot_n)"
            )
            .select(F.least("rep", "pivot").alias("a"), F.greatest("rep", "pivot").alias("b"))
            .distinct()
        )
        new = scratch.save(_links(pairs, sets, rule), f"links-{turn}")
        if labels is None or not new.isEmpty():
            links = new if labels is None else labels.selectExpr("node AS a", "component AS b").unionByName(new)
            labels = connected(links, scratch, f"components-{turn}")
        unused = open_members.join(chosen.select("key", "rep"), ["key", "rep"], "left_anti").drop("comp")
        labelled = unused.join(labels.withColumnRenamed("node", "rep"), "rep", "left").select(
            "key", "rep", "n", "bitmap", F.coalesce("component", "rep").alias("comp")
        )
        ends = labelled.groupBy("key").agg(F.min("comp").alias("low"), F.max("comp").alias("high"))
        open_members = scratch.save(
            labelled.join(ends.filter("low < high").select("key"), "key", "left_semi"), f"open-{turn}"
        )
        turn += 1
        if open_members.isEmpty():
            return labels


def _pivots(open_members: DataFrame, each: int) -> DataFrame:
    """Up to ``each`` members of every bucket, from its smallest components first."""
    sizes = open_members.groupBy("key", "comp").agg(F.count("*").alias("size"), F.min("rep").alias("rep"))
    if each == 1:
        best = sizes.groupBy("key").agg(F.min(F.struct("size", "rep")).alias("best")).select("key", "best.rep")
        return open_members.join(best, ["key", "rep"])
    ranked = open_members.join(sizes.select("key", "comp", "size"), ["key", "comp"]).withColumn(
        "rank", F.expr("row_number() OVER (PARTITION BY key ORDER BY size, comp, rep)")
    )
    return ranked.filter(F.col("rank") <= each).drop("rank", "size")


def _links(pairs: DataFrame, sets: DataFrame, rule: NearDuplicates) -> DataFrame:
    """The pairs whose full sets are similar enough. A repeated doc_id with different texts has several sets: one that
    is similar is enough."""
    first = sets.select(F.col("rep").alias("a"), F.col("shingles").alias("set_a"))
    second = sets.select(F.col("rep").alias("b"), F.col("shingles").alias("set_b"))
    return (
        pairs.join(first, "a")
        .join(second, "b")
        .selectExpr("a", "b", "size(array_intersect(set_a, set_b)) AS common", "size(set_a) + size(set_b) AS total")
        .filter(f"100 * common >= {rule.percent} * (total - common)")
        .select("a", "b")
    )
