"""Ranked lexical search: an inverted index in shards, searched by Block-Max MaxScore, and a merge of the shards' best.

A shard holds some thousand consecutive documents. Its posting lists are cut into compressed blocks; list and block tell
their largest term frequency and their shortest document, which bound every score inside whatever the corpus statistics
turn out to be, as a score rises with the frequency and falls with the length.
"""

from __future__ import annotations

from array import array
from collections import Counter, defaultdict
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twincheck.llm.decontaminate import words
from twincheck.llm.scratch import Scratch
from twincheck.llm.terms import term_table

#: A shard ends with the document that reaches either.
SHARD_DOCUMENTS = 16_384
SHARD_POSTINGS = 1 << 20
BLOCK = 128
#: Documents that are scored between two looks at the threshold.
WINDOW = 4_096
#: Terms of queries, with repeats in different items, that are searched in one pass over the index.
PASS_TERMS = 500_000

INDEX_SCHEMA = (
    "shard long, term string, df long, terms long, ends array<int>, most array<int>, least array<int>,"
    " blocks array<binary>, doc_ids array<long>, lengths array<int>"
)
_TERMS = term_table(digits=True)
_WIDTHS = (np.uint8, np.uint16, np.uint32)


def _width(values: np.ndarray) -> np.ndarray:
    """Index in ``_WIDTHS`` of the narrowest type for each value."""
    return (values > 0xFF).astype(np.int8) + (values > 0xFFFF)


@dataclass
class _Shard:
    """Documents of a shard that is being built."""

    vocabulary: dict[bytes, int] = field(default_factory=lambda: defaultdict(count().__next__))
    doc_ids: list[int | None] = field(default_factory=list)
    lengths: list[int] = field(default_factory=list)
    sizes: list[int] = field(default_factory=list)
    ids: array = field(default_factory=lambda: array("i"))
    uses: array = field(default_factory=lambda: array("i"))

    def add(self, doc_id: int | None, text: bytes) -> None:
        terms = text.translate(_TERMS).split()
        counted = Counter(terms)
        self.ids.extend(map(self.vocabulary.__getitem__, counted))
        self.uses.extend(counted.values())
        self.doc_ids.append(doc_id)
        self.lengths.append(len(terms))
        self.sizes.append(len(counted))

    @property
    def full(self) -> bool:
        return len(self.doc_ids) >= SHARD_DOCUMENTS or len(self.ids) >= SHARD_POSTINGS

    def rows(self, shard: int) -> pa.RecordBatch:
        """One row for each term, and one of null term for the documents."""
        lengths = np.array(self.lengths, dtype=np.int32)
        ids = np.frombuffer(self.ids, dtype=np.int32) if self.ids else np.zeros(0, dtype=np.int32)
        order = np.argsort(ids, kind="stable")
        docs = np.repeat(np.arange(len(lengths), dtype=np.int64), self.sizes)[order]
        uses = np.frombuffer(self.uses, dtype=np.int32)[order] if self.uses else ids
        df = np.bincount(ids, minlength=len(self.vocabulary)).astype(np.int64)
        start = np.cumsum(df) - df
        blocks_of = -(-df // BLOCK)
        of_term = np.repeat(np.arange(len(df)), blocks_of)
        nth = np.arange(len(of_term)) - np.repeat(np.cumsum(blocks_of) - blocks_of, blocks_of)
        begin = start[of_term] + BLOCK * nth
        end = np.minimum(begin + BLOCK, (start + df)[of_term])
        gaps = np.diff(docs, prepend=0)
        gaps[start] = docs[start]
        if len(begin):
            most = np.maximum.reduceat(uses, begin)
            least = np.minimum.reduceat(lengths[docs], begin)
            gap_width, use_width = _width(np.maximum.reduceat(gaps, begin)), _width(most)
        else:
            most = least = gap_width = use_width = np.zeros(0, dtype=np.int32)
        narrow_gaps, narrow_uses = [gaps.astype(w) for w in _WIDTHS], [uses.astype(w) for w in _WIDTHS]
        packed = [
            bytes((g * 3 + u,)) + narrow_gaps[g][b:e].tobytes() + narrow_uses[u][b:e].tobytes()
            for g, u, b, e in zip(gap_width.tolist(), use_width.tolist(), begin.tolist(), end.tolist())
        ]
        offsets = np.concatenate([[0], np.cumsum(blocks_of), [len(of_term)]]).astype(np.int32)

        def per_term(values: Sequence, kind: pa.DataType) -> pa.Array:
            return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))

        n = len(df) + 1
        return pa.RecordBatch.from_pydict(
            {
                "shard": pa.array(np.full(n, shard, dtype=np.int64)),
                "term": pa.array([*self.vocabulary, None], pa.binary()).cast(pa.string()),
                "df": pa.array([*df.tolist(), int((lengths > 0).sum())], pa.int64()),
                "terms": pa.array([0] * len(df) + [int(lengths.sum(dtype=np.int64))], pa.int64()),
                "ends": per_term(docs[end - 1] if len(end) else end, pa.int32()),
                "most": per_term(most, pa.int32()),
                "least": per_term(least, pa.int32()),
                "blocks": per_term(packed, pa.binary()),
                "doc_ids": pa.array([[]] * len(df) + [self.doc_ids], pa.list_(pa.int64())),
                "lengths": pa.array([[]] * len(df) + [self.lengths], pa.list_(pa.int32())),
            }
        )


def _indexed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    first = TaskContext.get().partitionId() << 32
    shard, number = _Shard(), 0
    for batch in batches:
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
            shard.add(doc_id, text.as_py())
            if shard.full:
                yield shard.rows(first + number)
                shard, number = _Shard(), number + 1
    if shard.doc_ids:
        yield shard.rows(first + number)


def build_index(documents: DataFrame) -> DataFrame:
    """Index of all ``documents`` (doc_id: long, text): a row for each shard and term, one of null term for each shard.

    ``df`` counts the documents that hold the term (null term: any term), ``terms`` all terms of the shard; ``ends``,
    ``most`` and ``least`` are each block's last document, largest frequency and shortest document. Save it before use.
    Shards are cut inside the reading task, without a shuffle; a task holds one shard, of a text longer than that the text.
    """
    read = documents.selectExpr(
        "cast(doc_id AS bigint) AS doc_id", "cast(coalesce(cast(text AS string), '') AS binary) AS text"
    )
    return read.mapInArrow(_indexed, INDEX_SCHEMA)


@dataclass(frozen=True)
class Corpus:
    """Documents with a term, and all terms of all documents."""

    documents: int
    terms: int

    def norm(self, lengths: np.ndarray) -> np.ndarray:
        return 75 + (25 * lengths.astype(np.int64) * self.documents) // self.terms


def impact(uses: np.ndarray, norm: np.ndarray) -> np.ndarray:
    """What ``uses`` of a term are worth in a document, before the term's weight: at most a million."""
    uses = uses.astype(np.int64)
    return 1_000_000_000 * uses // (1000 * uses + 12 * norm)


class _List:
    """The posting list of a term in a shard; blocks are decompressed when first needed, and kept while the shard is."""

    def __init__(self, row: dict, corpus: Corpus, norms: np.ndarray):
        self.ends = np.array(row["ends"], dtype=np.int64)
        bounds = impact(np.array(row["most"]), corpus.norm(np.array(row["least"])))
        #: One more for documents beyond the last block.
        self.bounds = np.append(bounds, 0)
        self.bound = int(bounds.max())
        self.norms = norms
        self.packed = row["blocks"]
        self.blocks: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self.parts: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def block(self, at: int) -> tuple[np.ndarray, np.ndarray]:
        found = self.blocks.get(at)
        if found is None:
            packed = self.packed[at]
            gap, use = (np.dtype(_WIDTHS[w]) for w in divmod(packed[0], 3))
            n = (len(packed) - 1) // (gap.itemsize + use.itemsize)
            docs = np.cumsum(np.frombuffer(packed, gap, n, 1), dtype=np.int64)
            if at:
                docs += self.ends[at - 1]
            uses = np.frombuffer(packed, use, n, 1 + n * gap.itemsize)
            found = self.blocks[at] = docs, impact(uses, self.norms[docs])
        return found

    def part(self, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
        """Postings of the documents of one window."""
        found = self.parts.get(low)
        if found is None:
            first, last = np.searchsorted(self.ends, [low, high])
            held = [self.block(b) for b in range(first, min(last + 1, len(self.ends)))]
            if held:
                docs, worth = (np.concatenate(c) for c in zip(*held))
                inside = slice(*np.searchsorted(docs, [low, high]))
                found = docs[inside] - low, worth[inside]
            else:
                found = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
            self.parts[low] = found
        return found


class Searcher:
    """The best documents of one shard."""

    def __init__(self, rows: list[dict], corpus: Corpus):
        documents = next(r for r in rows if r["term"] is None)
        ids = [(i is None, i or 0) for i in documents["doc_ids"]]
        self.doc_ids = documents["doc_ids"]
        #: Place of each document in the order of ids, null last.
        self.place = np.empty(len(ids), dtype=np.int64)
        self.place[sorted(range(len(ids)), key=ids.__getitem__)] = np.arange(len(ids))
        norms = corpus.norm(np.array(documents["lengths"]))
        self.lists = {r["term"]: _List(r, corpus, norms) for r in rows if r["term"] is not None}

    def best(self, query: Sequence[tuple[str, int]], k: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents and scores of the ``k`` highest scores above 0, ties by id; ``query`` holds (term, weight).

        Lists are ordered by their bounds. The first ones, whose bounds together stay below the k-th best score, can
        bring no document into the result alone: candidates come from the others. A candidate is dropped as soon as its
        score, the bound of the block where the next list may hold it and the bounds of the lists after that stay
        below the k-th best score; blocks without candidates are never decompressed.
        """
        lists = sorted(((self.lists[t], w) for t, w in query if t in self.lists and w > 0), key=lambda x: x[0].bound * x[1])
        together = np.cumsum([0, *(one.bound * w for one, w in lists)])
        docs, scores, threshold = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), 1
        for low in range(0, len(self.doc_ids), WINDOW):
            essential = int(np.searchsorted(together[1:], threshold))
            if essential == len(lists):
                break
            high = min(low + WINDOW, len(self.doc_ids))
            score = np.zeros(high - low, dtype=np.int64)
            for one, weight in lists[essential:]:
                at, worth = one.part(low, high)
                score[at] += weight * worth
            alive = np.flatnonzero(score)
            alive = alive[score[alive] + together[essential] >= threshold]
            for i in range(essential - 1, -1, -1):
                one, weight = lists[i]
                block = np.searchsorted(one.ends, alive + low)
                hopeful = score[alive] + weight * one.bounds[block] + together[i] >= threshold
                alive, block = alive[hopeful], block[hopeful]
                for b in np.unique(block[block < len(one.ends)]).tolist():
                    of_block = alive[block == b]
                    held, worth = one.block(b)
                    at = np.minimum(np.searchsorted(held, of_block + low), len(held) - 1)
                    hit = held[at] == of_block + low
                    score[of_block[hit]] += weight * worth[at[hit]]
            alive = alive[score[alive] >= threshold]
            docs, scores = np.concatenate([docs, alive + low]), np.concatenate([scores, score[alive]])
            if len(docs) > k:
                kept = np.lexsort((self.place[docs], -scores))[:k]
                docs, scores = docs[kept], scores[kept]
            if len(docs) == k:
                threshold = max(threshold, int(scores.min()))
        return docs, scores


def _query_terms(items: DataFrame) -> DataFrame:
    """item_id, digest (of the text), term, times; equal rows are one item."""
    read = items.selectExpr("item_id", "cast(text AS string) AS text").distinct()
    split = read.selectExpr("item_id", "coalesce(xxhash64(text), 0L) AS digest", f"explode({words('text')}) AS term")
    return split.groupBy("item_id", "digest", "term").agg(F.count("*").alias("times"))


def search(documents: DataFrame, items: DataFrame, k: int = 20) -> DataFrame:
    """The ``k`` best of ``documents`` (doc_id: long, text) for each of ``items`` (item_id, text): item_id, rank, doc_id,
    score.

    Terms are runs of digits, letters and everything beyond ASCII, A-Z lowered. With N documents that hold a term, L terms
    in all and n in the document, tf uses in it and df documents, the weight of a term is
    floor(1000 * ln((2N + 2) / (2df + 1))) and the norm of a document m = 75 + (25 n N) div L; its score is the sum of
    weight * ((10**9 tf) div (1000 tf + 12 m)) over the terms of the item, repeats included.

    Only scores above 0 are ranked; equal scores rank by doc_id, null last. Null and empty texts have no terms: such an
    item has no rows, and such a document is in none. Repeated documents are ranked one by one; equal items are one item,
    items of equal id and different texts have rankings of their own. More columns of either table are ignored, an empty
    table on either side leaves no rows, and texts may be of any length.

    Each task searches one shard; of a shard, ``k`` documents an item go on, and the ranking merges them. Items are
    collected and broadcast, as many at a time as have 500,000 distinct terms; more items take more passes over the index.
    """
    spark = documents.sparkSession
    scratch = Scratch(spark, "lexical")
    index = scratch.save(build_index(documents), "index")
    n, total = index.filter("term IS NULL").selectExpr("coalesce(sum(df), 0L)", "coalesce(sum(terms), 0L)").first()
    corpus = Corpus(int(n), int(total))
    queries = scratch.save(_query_terms(items), "queries")
    df = index.filter("term IS NOT NULL").groupBy("term").agg(F.sum("df").alias("df"))
    weight = f"cast(floor(1000D * ln((2L * {corpus.documents} + 2) / (2 * df + 1))) AS bigint)"
    passes = max(1, -(-queries.count() // PASS_TERMS))
    weighed = scratch.save(
        df.join(queries, "term").selectExpr(
            "item_id", "digest", "term", f"times * {weight} AS weight", f"pmod(xxhash64(item_id, digest), {passes}) AS pass"
        ),
        "weighed",
    )
    kind = items.schema["item_id"].dataType
    found = [
        _search_pass(index, weighed.filter(f"pass = {number}"), corpus, k).selectExpr(
            f"cast(item_id AS {kind.simpleString()}) AS item_id", "digest", "doc_id", "score"
        )
        for number in range(passes)
    ]
    merged = found[0]
    for more in found[1:]:
        merged = merged.unionByName(more)
    ranked = merged.withColumn(
        "rank",
        F.expr("row_number() OVER (PARTITION BY item_id, digest ORDER BY score DESC, doc_id ASC NULLS LAST)"),
    ).filter(f"rank <= {int(k)}")
    return ranked.selectExpr("item_id", "cast(rank AS int) AS rank", "doc_id", "score")


def _search_pass(index: DataFrame, weighed: DataFrame, corpus: Corpus, k: int) -> DataFrame:
    """Best documents of each shard for the items of one pass: item_id (as text), digest, doc_id, score."""
    items: dict[tuple[str | None, int], list[tuple[str, int]]] = defaultdict(list)
    for item_id, digest, term, weight in weighed.selectExpr("cast(item_id AS string)", "digest", "term", "weight").collect():
        items[item_id, digest].append((term, weight))
    held = index.sparkSession.sparkContext.broadcast(dict(items))

    def searched(shard: pa.Table) -> pa.Table:
        rows = shard.to_pylist()
        columns = ([], [], [], [])
        if any(r["term"] is not None for r in rows):
            searcher = Searcher(rows, corpus)
            for (item_id, digest), query in held.value.items():
                docs, scores = searcher.best(query, k)
                for doc, score in zip(docs.tolist(), scores.tolist()):
                    for column, value in zip(columns, (item_id, digest, searcher.doc_ids[doc], score)):
                        column.append(value)
        kinds = (pa.string(), pa.int64(), pa.int64(), pa.int64())
        return pa.table([pa.array(c, t) for c, t in zip(columns, kinds)], ["item_id", "digest", "doc_id", "score"])

    terms = weighed.select("term").distinct()
    wanted = index.filter("term IS NOT NULL").join(terms, "term", "left_semi").unionByName(index.filter("term IS NULL"))
    return wanted.groupBy("shard").applyInArrow(searched, "item_id string, digest long, doc_id long, score long")
