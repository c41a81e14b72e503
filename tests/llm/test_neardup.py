import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from twincheck.llm.components import connected
from twincheck.llm.neardup import NearDuplicates, bitmaps, near_duplicate_classes, shingles, sketches
from twincheck.llm.scratch import Scratch
from twincheck.llm.wordhash import blocks

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def plain_set(text, k):
    words = WORD.findall((text or "").translate(LOWER))
    return {tuple(words[i : i + k]) for i in range(max(len(words) - k + 1, 1))} if words else set()


def plain_classes(rows, k, percent=80):
    sets = [plain_set(t, k) for _, t in rows]
    low = list(range(len(rows)))
    changed = True
    labels = [i for i, _ in rows]
    links = [
        (x, y)
        for x in range(len(rows))
        for y in range(x)
        if sets[x] and 100 * len(sets[x] & sets[y]) >= percent * len(sets[x] | sets[y])
    ]
    while changed:
        changed = False
        for x, y in links:
            m = min(labels[x], labels[y])
            if labels[x] != m or labels[y] != m:
                labels[x] = labels[y] = m
                changed = True
    del low
    return sorted((i, len(s), c, i == c) for (i, _), s, c in zip(rows, sets, labels))


def found_classes(documents, rule):
    return sorted(map(tuple, near_duplicate_classes(documents, rule).collect()))


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(alphabet="aAbé \n\x00", max_size=30), max_size=6), st.sampled_from([1, 1 << 20]))
def test_shingle_sets(texts, limit):
    found = [s for b in blocks(pa.array(texts, pa.string()), limit) for s in shingles(b, 4)]
    assert [len(s) for s in found] == [len(plain_set(t, 4)) for t in texts]


def test_sketches_estimate_similarity_and_fill():
    rng = np.random.default_rng(3)
    for size, common in [(1, 1), (3, 2), (40, 30), (3000, 2500)]:
        x = rng.integers(0, 2**63, size).astype(np.uint64)
        y = np.concatenate([x[:common], rng.integers(0, 2**63, size - common).astype(np.uint64)])
        both = sketches([np.sort(x), np.sort(y), x[:0]], 256)
        assert (both[:2] != np.uint64(2**64 - 1)).all() and (both[2] == np.uint64(2**64 - 1)).all()
        assert abs((both[0] == both[1]).mean() - common / (2 * size - common)) < 0.2


def test_bitmaps_never_differ_more_than_the_sets():
    rng = np.random.default_rng(4)
    for size in (1, 50, 2000):
        x = rng.integers(0, 2**63, size).astype(np.uint64)
        y = np.concatenate([x[: size // 2], rng.integers(0, 2**63, size // 3).astype(np.uint64)])
        one, two = bitmaps([x, y])
        differing = len(np.setxor1d(x, y))
        assert sum(int(w).bit_count() for w in one ^ two) <= differing


def variants(seed, base, count, changes):
    rng = np.random.default_rng(seed)
    words = [f"w{rng.integers(5000)}" for _ in range(base)]
    for _ in range(count):
        own = list(words)
        for at in rng.integers(0, base, rng.integers(0, changes + 1)):
            own[at] = f"x{rng.integers(10**9)}"
        yield " ".join(own)


def test_large_groups_of_copies_and_near_copies(frame):
    texts = [*variants(1, 120, 60, 9), *variants(2, 60, 20, 3), *variants(3, 400, 10, 20), *(["same words in a row"] * 30)]
    rows = [(1000 - i, t) for i, t in enumerate(texts)]
    assert found_classes(frame(rows), NearDuplicates(words=4)) == plain_classes(rows, 4)


def test_documents_with_five_words(documents, texts):
    assert found_classes(documents, NearDuplicates()) == plain_classes(texts, 5)


def test_edge_cases(frame):
    rows = [(5, None), (4, ""), (3, " \n"), (9, "One two"), (2, "one TWO"), (7, "one"), (None, "one two"), (8, "z " * 40_000)]
    found = near_duplicate_classes(frame(rows).withColumnRenamed("n_chars", "kept"), NearDuplicates(words=4)).collect()
    assert {(r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in found} == {
        (5, 0, 5, True), (4, 0, 4, True), (3, 0, 3, True), (9, 1, 2, False), (2, 1, 2, True), (7, 1, 7, True),
        (None, 1, None, True), (8, 1, 8, True),
    }
    twice = near_duplicate_classes(frame([(1, "a b c d e"), (1, "a b c d e"), (1, "q r s t u")])).collect()
    assert [r["component_id"] for r in twice] == [1, 1, 1]
    assert near_duplicate_classes(frame(rows).limit(0)).count() == 0


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(0, 60)] + [(100, i) for i in range(101, 140)] + [(300, 300), (200, 201), (201, 200)]
    frame = spark.createDataFrame(links, "a long, b long")
    found = dict(connected(frame, Scratch(spark, "test"), "c").collect())
    assert found == {**{i: 0 for i in range(61)}, **{i: 100 for i in range(100, 140)}, 200: 200, 201: 200}
    assert connected(frame.limit(0), Scratch(spark, "test"), "c").count() == 0
