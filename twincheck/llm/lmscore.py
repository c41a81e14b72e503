"""Language-model scores from a log-frequency Bloom filter: quantised n-gram counts in a bit array, read by probing."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twincheck.llm.scratch import Scratch
from twincheck.llm.wordhash import Block, as_long, blocks, mix

END = mix(np.array([0x5EED], dtype=np.uint64))[0]
_PAIR = np.uint64(0xD1342543DE82EF95)
_LEVEL = np.uint64(0x9FB21C651E98DF25)
_PROBE = np.uint64(0xC2B2AE3D27D4EB4F)
SLICE_TOKENS = 1_000_000


@dataclass(frozen=True)
class Model:
    """``probes`` bits for each entry of the filter; ``prior`` tokens of weight for the unigrams in a bigram's estimate.

    The filter holds every n-gram, however rare, and grows with them. Up to ``filter_bytes`` it is broadcast; beyond, the
    n-grams of the texts go to its segments, in one round whatever their number, and find the same. A bucket is made for
    each ``bucket_bytes`` of text. ``head`` words are kept with their exact counts; those beyond are looked up by a join.
    """

    probes: int = 4
    prior: float = 4.0
    filter_bytes: int = 48 << 20
    bucket_bytes: int = 32 << 20
    head: int = 1 << 20


@dataclass
class Filter:
    """Bit segments, one for each bucket of n-grams. A count c is there as 1 + floor(log2 c) entries.

    A bucket of size 0 is empty; none of its n-grams is found.
    """

    bits: np.ndarray
    starts: np.ndarray
    sizes: np.ndarray
    probes: int

    def counts(self, grams: np.ndarray) -> np.ndarray:
        """Estimated counts of n-grams."""
        return counts_of(self.levels(grams))

    def levels(self, grams: np.ndarray) -> np.ndarray:
        """How many entries in turn are there."""
        level = np.zeros(len(grams), dtype=np.int64)
        if not len(self.sizes):
            return level
        bucket = bucket_of(grams, len(self.sizes))
        start, size = self.starts[bucket], self.sizes[bucket]
        going = np.flatnonzero(size)
        while len(going):
            here = going
            for probe in range(self.probes):
                at = start[here] + _place(grams[here], level[here] + 1, probe, size[here])
                here = here[(self.bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1]
            level[here] += 1
            going = here[level[here] < 60]
        return level


def counts_of(level: np.ndarray) -> np.ndarray:
    """The middle of the counts that make as many entries."""
    return np.where(level > 0, 1.5 * 2.0 ** (level.astype(np.int64) - 1) - 0.5, 0.0)


def bucket_of(grams: np.ndarray, buckets: int) -> np.ndarray:
    return ((mix(grams) >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)


def _place(grams: np.ndarray, level: np.ndarray, probe: int, size: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix(grams ^ (level.astype(np.uint64) * _LEVEL) ^ (np.uint64(probe + 1) * _PROBE)) % size


def segment(grams: np.ndarray, counts: np.ndarray, probes: int) -> np.ndarray:
    """The bits of one bucket, as bytes; about half of them are set."""
    levels = np.log2(np.maximum(counts, 1)).astype(np.int64) + 1
    size = max(64, int(np.ceil(levels.sum() * probes / np.log(2) / 64)) * 64) if len(grams) else 0
    bits = np.zeros(size // 8, dtype=np.uint8)
    for level in range(1, int(levels.max(initial=0)) + 1):
        own = grams[levels >= level]
        for probe in range(probes):
            at = _place(own, np.full(len(own), level), probe, np.uint64(size))
            np.bitwise_or.at(bits, at >> np.uint64(3), np.uint8(1) << (at & np.uint64(7)).astype(np.uint8))
    return bits


def tokens(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes of all texts, each closed by an end token, and where each text's tokens begin (and all end)."""
    words, bounds = block.hashes(lower=True), block.word_bounds
    found = np.full(len(words) + block.texts, END, dtype=np.uint64)
    found[np.arange(len(words)) + np.repeat(np.arange(block.texts), np.diff(bounds))] = words
    return found, bounds + np.arange(block.texts + 1)


def bigrams(found: np.ndarray) -> np.ndarray:
    """Each token with the one before; an end token stands before the first of a text."""
    before = np.concatenate([[END], found[:-1]])
    with np.errstate(over="ignore"):
        return mix(before * _PAIR + found)


def _unique(keys: list[np.ndarray], counts: list[np.ndarray] | None = None) -> tuple[np.ndarray, np.ndarray]:
    all_keys = np.concatenate(keys)
    if counts is None:
        all_keys.sort()
        first = np.flatnonzero(np.concatenate([[True], all_keys[1:] != all_keys[:-1]]))
        return all_keys[first], np.diff(np.append(first, len(all_keys)))
    order = np.argsort(all_keys)
    all_keys = all_keys[order]
    first = np.flatnonzero(np.concatenate([[True], all_keys[1:] != all_keys[:-1]]))
    return all_keys[first], np.add.reduceat(np.concatenate(counts)[order], first)


def _count_task(buckets: int):
    """Distinct n-grams and their counts in each slice of a task's tokens, one row for each bucket and order."""

    def rows(found: list[np.ndarray], order: int) -> pa.RecordBatch:
        keys, counts = _unique(found)
        bucket = bucket_of(keys, buckets)
        by = np.argsort(bucket, kind="stable")
        keys, counts = keys[by], counts[by].astype(np.uint32)
        edges = np.searchsorted(bucket[by], np.arange(buckets + 1))
        own = np.flatnonzero(np.diff(edges))
        return pa.RecordBatch.from_arrays(
            [
                pa.array(own, pa.int32()),
                pa.array(np.full(len(own), order), pa.int32()),
                pa.array([keys[edges[b] : edges[b + 1]].tobytes() for b in own], pa.binary()),
                pa.array([counts[edges[b] : edges[b + 1]].tobytes() for b in own], pa.binary()),
            ],
            names=["bucket", "size", "keys", "counts"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        for batch in batches:
            for block in blocks(batch.column("text")):
                found, _ = tokens(block)
                held.append((found, bigrams(found)))
                if sum(len(f) for f, _ in held) >= SLICE_TOKENS:
                    yield rows([f for f, _ in held], 1)
                    yield rows([b for _, b in held], 2)
                    held = []
        if held:
            yield rows([f for f, _ in held], 1)
            yield rows([b for _, b in held], 2)

    return run


def _merge_task(rule: Model):
    """Exact counts of a bucket's n-grams: unigrams go out as they are, all as a segment."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], list[list[np.ndarray]]] = {}
        for batch in batches:
            for bucket, size, keys, counts in zip(*(batch.column(i).to_pylist() for i in range(4))):
                own = held.setdefault((bucket, size), [[], []])
                own[0].append(np.frombuffer(keys, dtype=np.uint64))
                own[1].append(np.frombuffer(counts, dtype=np.uint32).astype(np.int64))
                if sum(map(len, own[0][1:])) > 2 * len(own[0][0]) + 100_000:
                    merged = _unique(*own)
                    own[:] = [[merged[0]], [merged[1]]]
        for bucket in sorted({b for b, _ in held}):
            merged = {size: _unique(*held.pop((bucket, size))) for size in (1, 2) if (bucket, size) in held}
            keys = np.concatenate([m[0] for m in merged.values()])
            counts = np.concatenate([m[1] for m in merged.values()])
            word_keys, word_counts = merged.get(1, (keys[:0], counts[:0]))
            yield _merged(bucket, word_keys, word_counts, segment(keys, counts, rule.probes).tobytes())

    return run


def _merged(bucket, words, counts, bits) -> pa.RecordBatch:
    longs = pa.list_(pa.int64())
    return pa.RecordBatch.from_arrays(
        [
            pa.array([bucket], pa.int32()),
            pa.ListArray.from_arrays([0, len(words)], as_long(words)).cast(longs),
            pa.array([counts], longs),
            pa.array([bits], pa.binary()),
        ],
        names=["bucket", "words", "counts", "bits"],
    )


def _filter(merged: DataFrame, buckets: int, rule: Model) -> Filter:
    """The segments of all buckets, where together they are small enough."""
    chosen = merged.select("bucket", "bits").toArrow()
    found = dict(zip(chosen.column("bucket").to_pylist(), chosen.column("bits").to_pylist()))
    lengths = np.array([8 * len(found.get(b, b"")) for b in range(buckets)], dtype=np.uint64)
    bits = np.frombuffer(b"".join(found[b] for b in sorted(found)), dtype=np.uint8)
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]]).astype(np.uint64)
    return Filter(bits, starts, lengths, rule.probes)


def _head(words: DataFrame, rule: Model) -> tuple[int, np.ndarray, np.ndarray]:
    """The count from which on words number ``rule.head`` at most, and those words' sorted hashes and counts."""
    # Four steps for each doubling of the count: a few hundred rows.
    steps = sorted(words.groupBy(F.expr("floor(4 * log2(c))").alias("step")).count().collect(), key=lambda r: -r["step"])
    total, low = 0, None
    for row in steps:
        total += row["count"]
        if total > rule.head:
            break
        low = row["step"]
    if low is None:
        return np.iinfo(np.int64).max, np.zeros(0, np.uint64), np.zeros(0, np.int64)
    least = int(np.ceil(2 ** (low / 4) - 1e-9))
    found = words.filter(F.col("c") >= least).toArrow().combine_chunks()
    keys = found.column("word").to_numpy().view(np.uint64)
    order = np.argsort(keys)
    return least, keys[order], found.column("c").to_numpy()[order]


@dataclass(frozen=True)
class _Scorer:
    """Scores of texts, from the levels of their words and bigrams and the exact counts of head words."""

    keys: np.ndarray
    counts: np.ndarray
    total: int
    distinct: int
    rule: Model

    def scores(self, found: np.ndarray, bounds: np.ndarray, levels: np.ndarray) -> list[pa.Array]:
        """Columns of ``_SCORES`` from the third on, for texts whose tokens ``found`` begin at ``bounds``; ``levels`` has
        a row for each token: its own and that of its bigram."""
        room = np.log10(self.total + 0.1 * (self.distinct + 1))
        each, back = np.unique(found, return_inverse=True)
        exact, known = np.zeros(len(each)), np.zeros(len(each), dtype=bool)
        if len(self.keys):
            at = np.minimum(np.searchsorted(self.keys, each), len(self.keys) - 1)
            known = self.keys[at] == each
            exact = np.where(known, self.counts[at], 0.0)
        base = np.where(known, np.log10(exact + 0.1), 0.0)
        rest = ~known[back]
        tails = np.searchsorted(np.flatnonzero(rest), bounds)
        roughly, pairs = counts_of(levels).T
        words = np.where(known[back], exact[back], roughly)
        word_p = (words + 0.1) / (self.total + 0.1 * (self.distinct + 1))
        # The last token is an end, as the one before the first.
        history = np.concatenate([words[-1:], words[:-1]])
        p = (np.minimum(pairs, history) + self.rule.prior * word_p) / (history + self.rule.prior)
        return [
            pa.array(np.diff(bounds), pa.int64()),
            pa.array(np.add.reduceat(known[back], bounds[:-1], dtype=np.int64)),
            pa.array(np.add.reduceat(base[back], bounds[:-1]) - np.diff(bounds) * room),
            pa.array(np.add.reduceat(np.log10(p), bounds[:-1])),
            pa.ListArray.from_arrays(pa.array(tails.astype(np.int32)), as_long(found[rest])),
        ]


_SCORES = (
    "line long, doc_id long, held_out boolean, n_tokens long, known long, base double, score double, tail array<long>"
)


def _scored(line: int, doc_ids: pa.Array, held_out: pa.Array, columns: list[pa.Array]) -> pa.RecordBatch:
    lines = pa.array(np.arange(line, line + len(doc_ids)))
    names = [field.split()[0] for field in _SCORES.split(", ")]
    return pa.RecordBatch.from_arrays([lines, doc_ids, held_out, *columns], names=names)


def _score_task(filter_, scorer):
    """Texts to ``_SCORES``, with the whole filter at hand."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        line = TaskContext.get().partitionId() << 33
        for batch in batches:
            for block in blocks(batch.column("text")):
                found, bounds = tokens(block)
                each, back = np.unique(found, return_inverse=True)
                pairs, pair_back = np.unique(bigrams(found), return_inverse=True)
                model = filter_.value
                levels = np.stack([model.levels(each)[back], model.levels(pairs)[pair_back]], axis=1)
                given = [batch.column(c).slice(block.first, block.texts) for c in ("doc_id", "held_out")]
                yield _scored(line, *given, scorer.value.scores(found, bounds, levels))
                line += block.texts

    return run


def _requested(found: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct words and bigrams of some texts by bucket, sorted in each, and where the buckets begin."""
    grams = np.unique(np.concatenate([found, bigrams(found)]))
    bucket = bucket_of(grams, buckets)
    by = np.argsort(bucket, kind="stable")
    return grams[by], np.searchsorted(bucket[by], np.arange(buckets + 1))


_REQUESTS = "bucket int, kind int, slice long, grams binary"
_ANSWERS = "slice long, kind int, bucket int, levels binary, doc_ids array<long>, held_out array<boolean>, texts array<string>"


def _request_task(buckets: int):
    """Texts to the n-grams that each slice asks of each bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, texts in zip(batch.column("slice").to_pylist(), batch.column("texts")):
                found, _ = tokens(next(blocks(texts.values, 1 << 62)))
                grams, edges = _requested(found, buckets)
                own = np.flatnonzero(np.diff(edges))
                n = len(own)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(own, pa.int32()), pa.array([1] * n, pa.int32()), pa.array([number] * n, pa.int64()),
                        pa.array([grams[edges[b] : edges[b + 1]].tobytes() for b in own], pa.binary()),
                    ],
                    names=["bucket", "kind", "slice", "grams"],
                )

    return run


def _slice_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts to rows of many texts, of about half a megabyte each."""
    number = TaskContext.get().partitionId() << 33
    for batch in batches:
        for block in blocks(batch.column("text")):
            given = [batch.column(c).slice(block.first, block.texts) for c in ("doc_id", "held_out", "text")]
            lists = [pa.ListArray.from_arrays(pa.array([0, block.texts], pa.int32()), column) for column in given]
            yield pa.RecordBatch.from_arrays(
                [pa.array([number], pa.int64()), *lists], names=["slice", "doc_ids", "held_out", "texts"]
            )
            number += 1


def _answer_task(rule: Model):
    """Segments and requests, sorted by bucket and kind, to the levels of the n-grams of each request, in their order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, segment_ = None, None
        for batch in batches:
            rows = []
            for own, kind, number, grams in zip(*(batch.column(c).to_pylist() for c in ("bucket", "kind", "slice", "grams"))):
                if own != bucket:
                    bucket, segment_ = own, Filter(np.zeros(0, np.uint8), *np.zeros((2, 0), np.uint64), rule.probes)
                if kind == 0:
                    bits = np.frombuffer(grams, dtype=np.uint8)
                    segment_ = Filter(bits, np.zeros(1, np.uint64), np.array([8 * len(bits)], np.uint64), rule.probes)
                else:
                    levels = segment_.levels(np.frombuffer(grams, dtype=np.uint64)).astype(np.uint8)
                    rows.append((number, own, levels.tobytes()))
            columns = list(zip(*rows)) or [(), (), ()]
            kinds = (pa.int64(), pa.int32(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["slice", "bucket", "levels"])

    return run


def _answered_score_task(scorer, buckets: int):
    """Answers and texts of slices, sorted by slice, kind and bucket, to ``_SCORES``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        line = TaskContext.get().partitionId() << 33
        answers: list[bytes] = []
        for batch in batches:
            for i, kind in enumerate(batch.column("kind").to_pylist()):
                if kind == 0:
                    answers.append(batch.column("levels")[i].as_py())
                    continue
                found, bounds = tokens(next(blocks(batch.column("texts")[i].values, 1 << 62)))
                grams, _ = _requested(found, buckets)
                level = np.frombuffer(b"".join(answers), dtype=np.uint8)
                answers = []
                order = np.argsort(grams)
                sorted_grams, sorted_level = grams[order], level[order]
                levels = np.stack(
                    [sorted_level[np.searchsorted(sorted_grams, part)] for part in (found, bigrams(found))], axis=1
                )
                given = [batch.column(c)[i].values for c in ("doc_ids", "held_out")]
                yield _scored(line, *given, scorer.value.scores(found, bounds, levels))
                line += len(given[0])

    return run


def _scores_by_shuffle(texts: DataFrame, merged: DataFrame, scorer, buckets: int, rule: Model, scratch: Scratch) -> DataFrame:
    """Scores with a filter that is nowhere held whole: texts in slices ask its segments for their n-grams."""
    slices = scratch.save(
        texts.mapInArrow(_slice_task, "slice long, doc_ids array<long>, held_out array<boolean>, texts array<string>"),
        "slices",
    )
    segments = merged.selectExpr("bucket", "0 AS kind", "0L AS slice", "bits AS grams")
    asked = segments.unionByName(slices.select("slice", "texts").mapInArrow(_request_task(buckets), _REQUESTS))
    levels = (
        asked.repartition("bucket")
        .sortWithinPartitions("bucket", "kind")
        .mapInArrow(_answer_task(rule), "slice long, bucket int, levels binary")
    )
    answers = levels.selectExpr("slice", "0 AS kind", "bucket", "levels").unionByName(
        slices.selectExpr("slice", "1 AS kind", "doc_ids", "held_out", "texts"), allowMissingColumns=True
    )
    ordered = answers.repartition("slice").sortWithinPartitions("slice", "kind", "bucket")
    return ordered.mapInArrow(_answered_score_task(scorer, buckets), _SCORES)


def score_texts(documents: DataFrame, held_out: str, rule: Model = Model()) -> DataFrame:
    """``documents`` (doc_id: long, text; more columns are ignored) to doc_id, held_out, n_tokens, n_known,
    train_tokens, base_score, score. The SQL condition ``held_out`` names the rows that are not learned from.

    Tokens are the lower-cased words and one end for each text. ``base_score`` is the exact add-0.1 unigram score.
    ``score`` is the bigram model's: P(w | u) = (c(u, w) + prior * P(w)) / (c(u) + prior). P(w) is the base's. Counts of
    head words are exact, all others those of the filter, which knows a count by its power of two: the probabilities after
    a word add up to one nearly, not exactly.

    1. Tasks count the n-grams of slices of their training texts; packed counts are shuffled by bucket and summed, so
       frequent n-grams cost one entry for each slice. Each bucket becomes a segment of the filter, in a shared folder.
    2. A filter of ``filter_bytes`` at most is broadcast. Of a larger one every task holds one segment at a time: the
       distinct n-grams of each slice of the texts are shuffled to the segments, and their levels back to the texts.
    3. Each text is scored, with the exact counts of the head words broadcast too; words outside the head are joined with
       their exact counts.

    Null and empty texts are one end token. Rows are scored each for itself, also with equal or null ids. Without
    training texts all counts are 0. An empty table gives no rows. A text may be of any length; it is one task's.
    """
    spark = documents.sparkSession
    scratch = Scratch(spark, "lmscore")
    texts = documents.selectExpr(
        "cast(doc_id AS bigint) AS doc_id", "cast(text AS string) AS text", f"coalesce({held_out}, true) AS held_out"
    )
    size = texts.selectExpr("coalesce(sum(cast(octet_length(text) AS bigint)), 0L)").first()[0]
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // rule.bucket_bytes))
    merged = scratch.save(
        texts.filter("NOT held_out")
        .select("text")
        .mapInArrow(_count_task(buckets), "bucket int, size int, keys binary, counts binary")
        .repartition(buckets, "bucket")
        .mapInArrow(_merge_task(rule), "bucket int, words array<long>, counts array<long>, bits binary"),
        "counts",
    )
    words = scratch.save(merged.selectExpr("inline(arrays_zip(words, counts)) AS (word, c)"), "words")
    totals = words.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    least, *head = _head(words, rule)
    context = spark.sparkContext
    scorer = context.broadcast(_Scorer(*head, totals["n"], totals["v"], rule))
    filter_bytes = merged.selectExpr("coalesce(sum(cast(octet_length(bits) AS bigint)), 0L)").first()[0]
    if filter_bytes <= rule.filter_bytes:
        shared = context.broadcast(_filter(merged, buckets, rule))
        scores = texts.mapInArrow(_score_task(shared, scorer), _SCORES)
    else:
        scores = _scores_by_shuffle(texts, merged, scorer, buckets, rule, scratch)
    scored = scratch.save(scores, "scored")
    tail = (
        scored.select("line", F.explode("tail").alias("word"))
        .groupBy("line", "word")
        .agg(F.count("*").alias("tf"))
        .join(words.filter(F.col("c") < least), "word", "left")
        .groupBy("line")
        .agg(
            F.sum(F.expr("CASE WHEN c IS NULL THEN 0L ELSE tf END")).alias("tail_known"),
            F.sum(F.expr("tf * log10(coalesce(c, 0L) + 0.1D)")).alias("tail_base"),
        )
    )
    return scored.join(tail, "line", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        F.expr("known + coalesce(tail_known, 0L)").alias("n_known"),
        F.lit(totals["n"]).cast("long").alias("train_tokens"),
        F.expr("base + coalesce(tail_base, 0D)").alias("base_score"),
        "score",
    )
