"""Token ids of documents, packed into rows of fixed length by best-fit decreasing."""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

_encodings: dict[int, object] = {}
#: A longer stretch without white space is encoded in pieces of this many characters, which bounds a token search.
LONGEST_STRETCH = 20_000
_LONG_STRETCHES = re.compile(rf"\S{{{LONGEST_STRETCH + 1},}}")


@dataclass(frozen=True)
class Packing:
    """Rows of ``length`` tokens, filled from about ``window_tokens`` tokens of consecutive documents at a time.

    ``tokenizer`` is a file of base64 tokens and ranks, read on the driver and sent to the tasks; ``end_token`` closes
    each document and fills the rest of a row.
    """

    length: int = 2048
    window_tokens: int = 4_000_000
    tokenizer: str = "/opt/tokenizers/byte_bpe_50k.tiktoken"
    end_token: int = 50256

    @property
    def width(self) -> type:
        return np.uint16 if self.end_token < 1 << 16 else np.uint32


class Capacities:
    """A segment tree over free capacities: which is the least one that is large enough and that some row has?"""

    def __init__(self, most: int):
        self.leaves = 1 << most.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.rows: list[list[int]] = [[] for _ in range(most + 1)]

    def add(self, capacity: int, row: int) -> None:
        self.rows[capacity].append(row)
        self._change(capacity, 1)

    def take(self, needed: int) -> tuple[int, int] | None:
        """Remove and return (row, its capacity) of the best fit, None if no row has room."""
        node = needed + self.leaves
        count = self.count
        if not count[node]:
            # Up to the first ancestor with something on its right, then down to the leftmost of it.
            while node > 1 and (node & 1 or not count[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.leaves:
                node *= 2
                if not count[node]:
                    node += 1
        capacity = node - self.leaves
        self._change(capacity, -1)
        return self.rows[capacity].pop(), capacity

    def _change(self, capacity: int, by: int) -> None:
        node = capacity + self.leaves
        while node:
            self.count[node] += by
            node >>= 1


def best_fit_decreasing(sizes: list[int], length: int) -> list[list[int]]:
    """Rows of indices into ``sizes``; each row's sizes sum up to ``length`` at most, as each size does."""
    rows: list[list[int]] = []
    free = Capacities(length)
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        found = free.take(sizes[i])
        if found is None:
            rows.append([])
            found = len(rows) - 1, length
        rows[found[0]].append(i)
        if found[1] > sizes[i]:
            free.add(found[1] - sizes[i], found[0])
    return rows


def encoder(content: bytes):
    """The tokenizer of a file's content, made once in each process."""
    key = hash(content)
    if key not in _encodings:
        import public_tokenizers
        import tiktoken

        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, content.splitlines())}
        _encodings[key] = tiktoken.Encoding(
            "packing", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
        )
    return _encodings[key]


def encode(encoding, text: str) -> np.ndarray:
    """The tokenizer's ids; only inside of stretches beyond ``LONGEST_STRETCH`` may they differ from those of one piece."""
    cuts = [0]
    if len(text) > LONGEST_STRETCH:
        for stretch in _LONG_STRETCHES.finditer(text):
            cuts += range(stretch.start() + LONGEST_STRETCH, stretch.end(), LONGEST_STRETCH)
    parts = [encoding.encode_ordinary(text[low:high]) for low, high in zip(cuts, [*cuts[1:], len(text)])]
    return np.concatenate([np.array(p, dtype=np.uint32) for p in parts])


SCHEMA = (
    "shard int, row long, n_tokens int, n_segments int, ids binary, cu_seqlens array<int>, position_resets array<int>,"
    " doc_ids array<long>, doc_starts array<int>"
)


def pack_documents(documents: DataFrame, rule: Packing = Packing(), within: str | None = None) -> DataFrame:
    """``documents`` (doc_id: long, text; more columns are ignored) to rows of an id matrix.

    ``ids``: ``length`` little-endian token ids of 16 bits (32 where ``end_token`` needs them), after ``n_tokens``
    filled up with the end token. ``cu_seqlens``: 0 and the end of each segment. ``position_resets``: where position
    ids start again at 0, the filling included. ``doc_ids`` and ``doc_starts``: whose tokens a segment holds, and from
    which token of the document on. A document is its text's tokens and the end token; one longer than a row is cut into
    pieces, and the pieces in order give back every token. ``shard`` and ``row`` number the rows of each task.

    ``within`` is SQL for the run of documents that a document is read in, such as the part of a file. No row holds
    documents of two runs, and the result has the run as ``sequence``: sorted by it and ``row``, packed rows follow the
    order of the runs, whichever tasks read them.

    One pass without a shuffle: a task packs the documents it reads in windows of ``window_tokens``, so its memory does
    not grow with the data. Null and empty texts give no tokens; rows with equal or null ids are packed each for itself;
    an empty table gives no rows. A text of any length is one task's; stretches of more than 20,000 characters without
    white space are encoded in pieces (see :func:`encode`), which decode to the same text.
    """
    with open(rule.tokenizer, "rb") as file:
        content = documents.sparkSession.sparkContext.broadcast(file.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = encoder(content.value)
        shard, made = TaskContext.get().partitionId(), 0
        held: list[tuple[int | None, int, np.ndarray]] = []
        tokens, sequence = 0, None
        for batch in batches:
            for doc_id, text, run_of in zip(batch.column("doc_id"), batch.column("text"), batch.column("sequence")):
                text = text.as_py()
                if not text:
                    continue
                if run_of.as_py() != sequence:
                    if held:
                        packed = _packed(held, rule, shard, made, sequence)
                        made, held, tokens = made + packed.num_rows, [], 0
                        yield packed
                    sequence = run_of.as_py()
                ids = np.append(encode(encoding, text), rule.end_token).astype(rule.width)
                held += [(doc_id.as_py(), at, ids[at : at + rule.length]) for at in range(0, len(ids), rule.length)]
                tokens += len(ids)
                if tokens >= rule.window_tokens:
                    packed = _packed(held, rule, shard, made, sequence)
                    made, held, tokens = made + packed.num_rows, [], 0
                    yield packed
        if held:
            yield _packed(held, rule, shard, made, sequence)

    read = documents.selectExpr(
        "cast(doc_id AS bigint) AS doc_id", "cast(text AS string) AS text", f"cast({within or 'NULL'} AS string) AS sequence"
    )
    packed = read.mapInArrow(run, SCHEMA + ", sequence string")
    return packed if within else packed.drop("sequence")


def _packed(held, rule: Packing, shard: int, made: int, sequence: str | None) -> pa.RecordBatch:
    rows = best_fit_decreasing([len(ids) for _, _, ids in held], rule.length)
    n_tokens, ids, ends, resets, doc_ids, starts = [], [], [], [], [], []
    for row in rows:
        segments = [held[i] for i in row]
        filled = np.full(rule.length, rule.end_token, dtype=rule.width)
        edges = np.concatenate([[0], np.cumsum([len(s[2]) for s in segments])])
        filled[: edges[-1]] = np.concatenate([s[2] for s in segments])
        n_tokens.append(int(edges[-1]))
        ids.append(filled.astype(filled.dtype.newbyteorder("<")).tobytes())
        ends.append(edges)
        resets.append(edges if edges[-1] < rule.length else edges[:-1])
        doc_ids.append([s[0] for s in segments])
        starts.append([s[1] for s in segments])
    ints = pa.list_(pa.int32())
    return pa.RecordBatch.from_arrays(
        [
            pa.array([shard] * len(rows), pa.int32()),
            pa.array(range(made, made + len(rows)), pa.int64()),
            pa.array(n_tokens, pa.int32()),
            pa.array([len(row) for row in rows], pa.int32()),
            pa.array(ids, pa.binary()),
            pa.array(ends, ints),
            pa.array(resets, ints),
            pa.array(doc_ids, pa.list_(pa.int64())),
            pa.array(starts, ints),
            pa.array([sequence] * len(rows), pa.string()),
        ],
        names=[*(field.split()[0] for field in SCHEMA.split(", ")), "sequence"],
    )


def position_ids(resets: list[int], length: int) -> np.ndarray:
    """The position ids of one row."""
    at = np.arange(length)
    return at - np.asarray(resets)[np.searchsorted(resets, at, side="right") - 1]


def write_packed(packed: DataFrame, folder: str) -> None:
    """Write packed rows as Parquet, one file for each shard at least."""
    packed.write.mode("error").parquet(folder)
