"""Quality rules: document statistics, fixed limits on them, and boosted trees trained on labelled documents."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twincheck.llm.trees import Boosting, Forest, fit
from twincheck.llm.wordhash import _SPACE, Block, blocks, mix, powers

WINDOW = 5

#: Statistics the trees see; -1: a higher value never makes a document better.
FEATURES = {
    "log_words": 0,
    "mean_word_chars": 0,
    "symbol_share": -1,
    "dup_line_share": -1,
    "repeat_word_share": -1,
    "upper_share": -1,
    "exclamation_share": -1,
    "digit_share": 0,
    "punctuation_share": 0,
    "distinct_word_share": 0,
    "words_a_line": 0,
    "long_word_share": 0,
    "log_lines": 0,
}
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _table(chars: str) -> np.ndarray:
    found = np.zeros(256, dtype=bool)
    found[[ord(c) for c in chars]] = True
    return found


_SYMBOLS = _table("#*$%&|<>")
_UPPER = _table("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
_EXCLAIM = _table("!")
_DIGITS = _table("0123456789")
_PUNCTUATION = _table(".,;:?'\"()-")
_STARTS = np.ones(256, dtype=bool)
_STARTS[0x80:0xC0] = False


@dataclass(frozen=True)
class QualityRules:
    """Limits every document must keep; the trees judge what is left, kept from probability ``cut`` on.

    At most ``sample`` labelled documents train the trees: those with the smallest hashes of their ids.
    """

    least_words: int = 10
    most_repeated_percent: int = 20
    sample: int = 20_000
    cut: float = 0.5

    def boosting(self) -> Boosting:
        return Boosting(monotone={i: d for i, d in enumerate(FEATURES.values()) if d})


def _per_text(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.zeros(len(flags) + 1, dtype=np.int64)
    np.cumsum(flags, out=total[1:])
    return np.diff(total[bounds])


def _repeats(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each key, whether it occurs elsewhere, and whether it does before."""
    order = np.argsort(keys, kind="stable")
    same = np.zeros(len(keys) + 1, dtype=bool)
    same[1:-1] = keys[order[1:]] == keys[order[:-1]]
    again, before = np.empty(len(keys), dtype=bool), np.empty(len(keys), dtype=bool)
    before[order] = same[:-1]
    again[order] = same[:-1] | same[1:]
    return again, before


def statistics(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """The base statistics (integers) and the features of each text of a block."""
    data, bounds, texts = block.data, block.bounds, block.texts
    n_words, word_bounds = block.n_words, block.word_bounds
    of_text = np.repeat(np.arange(texts, dtype=np.uint64), n_words)
    salt = mix(np.arange(1, texts + 1, dtype=np.uint64))

    words = block.hashes(lower=False)
    n = max(len(words) - WINDOW + 1, 0)
    windows = np.zeros(n, dtype=np.uint64)
    for k in range(WINDOW):
        windows = windows * np.uint64(0xD1342543DE82EF95) + words[k : k + n]
    whole = of_text[:n] == of_text[WINDOW - 1 :] if n else np.zeros(0, dtype=bool)
    at = np.flatnonzero(whole)
    again, _ = _repeats(mix(windows[at] + salt[of_text[at]]))
    edge = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(edge, at[again], 1)
    np.add.at(edge, at[again] + WINDOW, -1)
    n_repeat = _per_text(np.cumsum(edge[:-1]) > 0, word_bounds)
    _, seen = _repeats(mix(words + salt[of_text])) if len(words) else (None, np.zeros(0, dtype=bool))
    distinct = n_words - _per_text(seen, word_bounds)

    # A line ends before a line break or at the end of its text, which comes before a break at the same place.
    breaks = np.flatnonzero(data == 0x0A)
    ends = np.sort(np.concatenate([bounds[1:], breaks]))
    last_line = np.searchsorted(breaks, bounds[1:], side="left") + np.arange(texts)
    begins = np.concatenate([[0], ends[:-1] + 1])
    begins[last_line[:-1] + 1] = bounds[1:-1]
    line_text = np.repeat(np.arange(texts), np.diff(np.concatenate([[-1], last_line])))
    forth, back = powers(len(data))
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * forth[: len(data)], out=sums[1:])
    filled = np.zeros(len(data) + 1, dtype=np.int64)
    np.cumsum(~_SPACE[data], out=filled[1:])
    with_word = np.flatnonzero(filled[ends] > filled[begins])
    lines = (sums[ends] - sums[begins])[with_word] * back[begins[with_word]]
    _, repeated = _repeats(mix(mix(lines) + salt[line_text[with_word]]))
    n_dup = np.bincount(line_text[with_word[repeated]], minlength=texts)
    n_lines = np.bincount(line_text[with_word], minlength=texts)

    chars = _per_text(_STARTS[data], bounds)
    word_chars = _per_text(_STARTS[data] & ~_SPACE[data], bounds)
    n_symbols = _per_text(_SYMBOLS[data], bounds)
    lengths = block.spans[1] - block.spans[0]
    long_words = _per_text(lengths > 12, word_bounds)
    base = np.stack([n_words, word_chars, n_symbols, n_dup, n_repeat], axis=1)
    w, c, ln = np.maximum(n_words, 1), np.maximum(chars, 1), np.maximum(n_lines, 1)
    features = np.stack(
        [
            np.log1p(n_words), word_chars / w, n_symbols / w, n_dup / ln, n_repeat / w, _per_text(_UPPER[data], bounds) / c,
            _per_text(_EXCLAIM[data], bounds) / w, _per_text(_DIGITS[data], bounds) / c,
            _per_text(_PUNCTUATION[data], bounds) / w, distinct / w, n_words / ln, long_words / w, np.log1p(n_lines),
        ],
        axis=1,
    )
    return base, features


def _feature_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for block in blocks(batch.column("text")):
            _, features = statistics(block)
            starts = pa.array(np.arange(0, features.size + 1, features.shape[1], dtype=np.int32))
            rows = [batch.column(c).slice(block.first, block.texts) for c in ("doc_id", "label")]
            rows.append(pa.ListArray.from_arrays(starts, pa.array(features.reshape(-1))))
            yield pa.RecordBatch.from_arrays(rows, names=["doc_id", "label", "features"])


def train_quality(documents: DataFrame, labels: DataFrame, rules: QualityRules = QualityRules()) -> Forest:
    """Boosted trees from ``labels`` (doc_id, quality 0 or 1) of at most ``rules.sample`` documents.

    Labels with a null are ignored; a document with several labels takes the lowest, one with several texts the one
    whose features come first. Without labels of both kinds the forest has no trees and keeps what the limits keep.
    """
    chosen = (
        labels.filter("doc_id IS NOT NULL AND quality IN (0, 1)")
        .groupBy("doc_id")
        .agg(F.min("quality").cast("int").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(rules.sample)
    )
    # The broadcast holds at most rules.sample short rows.
    rows = documents.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("doc_id", "label", "text")
    found = (
        rows.mapInArrow(_feature_task, "doc_id long, label int, features array<double>")
        .groupBy("doc_id")
        .agg(F.min("label").alias("label"), F.min("features").alias("features"))
        .orderBy("doc_id")
        .toArrow()
    )
    features = np.array(found.column("features").to_pylist(), dtype=float).reshape(-1, len(FEATURES))
    return fit(features, found.column("label").to_numpy().astype(float), rules.boosting())


def _judge(block: Block, forest: Forest, rules: QualityRules):
    base, features = statistics(block)
    failed = (base[:, 0] < rules.least_words) | (100 * base[:, 4] > rules.most_repeated_percent * base[:, 0])
    score = forest.probability(features)
    kept = ~failed & ((score >= rules.cut) | (len(forest.roots) == 0))
    return base, failed, score, kept


def judge_quality(documents: DataFrame, forest: Forest, rules: QualityRules = QualityRules()) -> DataFrame:
    """``documents`` (doc_id: long, text; more columns are ignored) to doc_id, n_words, word_chars, n_symbols,
    n_dup_lines, n_repeat_words, base_failed, kept, score (the trees' probability of quality).

    One pass without a shuffle. Null and empty texts have no words and fail; every row, repeated or with a null doc_id,
    is judged by its own text; an empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch.column("text")):
                base, failed, score, kept = _judge(block, forest, rules)
                columns = [batch.column("doc_id").slice(block.first, block.texts)]
                columns += [pa.array(base[:, i], pa.int64()) for i in range(len(BASE))]
                columns += [pa.array(failed), pa.array(kept), pa.array(score)]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", *BASE, "base_failed", "kept", "score"])

    longs = ", ".join(f"{name} long" for name in BASE)
    texts = documents.selectExpr("cast(doc_id AS bigint) AS doc_id", "cast(text AS string) AS text")
    return texts.mapInArrow(run, f"doc_id long, {longs}, base_failed boolean, kept boolean, score double")


def keep_quality(documents: DataFrame, forest: Forest, rules: QualityRules = QualityRules()) -> DataFrame:
    """The rows of ``documents`` that :func:`judge_quality` keeps, with all their columns, in one pass."""
    kept: Callable = lambda block: _judge(block, forest, rules)[3]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [kept(block) for block in blocks(batch.column("text"))]
            if found:
                yield batch.filter(pa.array(np.concatenate(found)))

    return documents.mapInArrow(run, documents.schema)
