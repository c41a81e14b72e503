import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from twincheck.llm import lmscore
from twincheck.llm.lmscore import Filter, Model, bucket_of, score_texts, segment

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}
HELD = "crc32(cast(doc_id AS string)) % 10 = 0"


def plain(rows):
    tokens = [[*WORD.findall((t or "").translate(LOWER)), None] for _, t in rows]
    held = [d is None or zlib.crc32(str(d).encode()) % 10 == 0 for d, _ in rows]
    counts = Counter(w for t, h in zip(tokens, held) if not h for w in t)
    n, v = sum(counts.values()), len(counts)
    return [
        (d, h, len(t), sum(counts[w] > 0 for w in t), n, sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in t))
        for (d, _), t, h in zip(rows, tokens, held)
    ]


def check(found, expected):
    def key(row):
        return repr(row[:4]), row[5]

    for row, other in zip(sorted(found, key=key), sorted(expected, key=key), strict=True):
        assert tuple(row)[:5] == other[:5] and row[5] == pytest.approx(other[5], rel=1e-9)
        assert row[6] <= 0 and math.isfinite(row[6])


@pytest.mark.parametrize("head", [1 << 20, 50, 0])
def test_base_scores_are_exact_whatever_the_head(documents, texts, head):
    check(score_texts(documents, HELD, Model(head=head)).collect(), plain(texts))


def test_the_model_beats_the_base_on_held_out_texts(spark):
    documents = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [r for r in score_texts(documents, HELD).collect() if r["held_out"]]
    assert sum(r["score"] for r in rows) > sum(r["base_score"] for r in rows)


def test_filter_counts():
    rng = np.random.default_rng(7)
    grams = np.unique(rng.integers(0, 2**63, 20_000).astype(np.uint64))
    counts = rng.zipf(1.7, len(grams)).clip(1, 10**9)
    bucket = bucket_of(grams, 3)
    parts = [segment(grams[bucket == b], counts[bucket == b], 4) for b in range(3)]
    sizes = np.array([8 * len(p) for p in parts], dtype=np.uint64)
    model = Filter(np.concatenate(parts), np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.uint64), sizes, 4)
    found = model.counts(grams)
    # Never below the class of the count; above it only by chance hits.
    assert (found >= 1.5 * 2.0 ** np.floor(np.log2(counts)) - 0.5).all()
    assert (found <= 1.5 * 2.0 ** np.floor(np.log2(counts)) - 0.5).mean() > 0.85
    assert (model.counts(rng.integers(2**63, 2**64, 20_000, dtype=np.uint64)) == 0).mean() > 0.9


def test_a_small_filter_keeps_the_frequent(documents, texts, monkeypatch):
    monkeypatch.setattr(lmscore, "SLICE_TOKENS", 5000)
    check(score_texts(documents, HELD, Model(filter_bytes=4000)).collect(), plain(texts))
    check(score_texts(documents, HELD, Model(filter_bytes=0)).collect(), plain(texts))


def test_scores_do_not_depend_on_the_size_of_the_broadcast(documents):
    whole = sorted(map(tuple, score_texts(documents, HELD).collect()))
    for filter_bytes in (200_000, 0):
        assert sorted(map(tuple, score_texts(documents, HELD, Model(filter_bytes=filter_bytes)).collect())) == whole


def test_rare_words_and_bigrams_count_in_any_group(frame):
    documents = frame([(1, "rare pair"), (2, "common " * 200), (10, "rare pair"), (31, "odd other")])
    scores = {r["doc_id"]: r["score"] for r in score_texts(documents, "doc_id >= 10", Model(filter_bytes=0)).collect()}
    assert scores[10] == scores[1] > scores[31] + 3


def test_edge_cases(frame):
    rows = [(1, None), (2, ""), (3, "A a\tb"), (3, "A a\tb"), (None, "b c"), (10, "x " * 50_000), (31, "q")]
    documents = frame(rows).withColumnRenamed("n_chars", "score")
    check(score_texts(documents, HELD).collect(), plain(rows))
    untrained = score_texts(documents, "true").collect()
    assert {r["train_tokens"] for r in untrained} == {0} and {r["n_known"] for r in untrained} == {0}
    assert score_texts(documents.limit(0), HELD).count() == 0


@pytest.mark.parametrize(("filter_bytes", "head"), [(1 << 20, 1 << 20), (0, 1 << 20), (1 << 20, 0)])
def test_scores_against_brute_force(frame, filter_bytes, head):
    """With sixteen probes no n-gram is found by chance here."""
    rows = [(i, " ".join("abcdefgh"[(i * k * k + k) % (3 + i % 6)] for k in range(5 + i % 40))) for i in range(150)]
    rows += [(500, "never seen words"), (501, None)]
    tokens = {i: [*WORD.findall(t or ""), None] for i, t in rows}
    held = {i: zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in rows}
    words, pairs = Counter(), Counter()
    for i, own in tokens.items():
        if not held[i]:
            words.update(own)
            pairs.update(zip([None, *own], own))
    total, distinct = sum(words.values()), len(words)

    def rough(count):
        return 1.5 * 2 ** (count.bit_length() - 1) - 0.5 if count else 0.0

    def count(word):
        return words[word] if head else rough(words[word])

    for r in score_texts(frame(rows), HELD, Model(probes=16, filter_bytes=filter_bytes, head=head)).collect():
        own, expected = tokens[r["doc_id"]], 0.0
        for u, w in zip([None, *own], own):
            word_p = (count(w) + 0.1) / (total + 0.1 * (distinct + 1))
            expected += math.log10((min(rough(pairs[u, w]), count(u)) + 4 * word_p) / (count(u) + 4))
        assert r["score"] == pytest.approx(expected, rel=1e-9)


def test_buckets_follow_the_size_of_the_texts(documents, texts):
    whole = sorted(map(tuple, score_texts(documents, HELD).collect()))
    rule = Model(bucket_bytes=20_000, filter_bytes=0)
    check(score_texts(documents, HELD, rule).collect(), plain(texts))
    assert sorted(map(tuple, score_texts(documents, HELD, Model(bucket_bytes=1 << 20)).collect())) == whole
