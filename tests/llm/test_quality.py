import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import pyarrow as pa

from twincheck.llm import quality
from twincheck.llm.trees import Boosting, fit
from twincheck.llm.wordhash import blocks

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_statistics(text):
    words = WORD.findall(text)
    lines, seen, dup = text.split("\n"), set(), 0
    for line in lines:
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    counts, hit = Counter(windows), set()
    for i, window in enumerate(windows):
        if counts[window] > 1:
            hit.update(range(i, i + 5))
    return [len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(hit)]


def vector_statistics(texts, limit=1 << 19):
    found = [quality.statistics(b)[0] for b in blocks(pa.array(texts, pa.string()), limit)]
    return np.concatenate(found).tolist() if found else []


def test_statistics_of_the_documents(texts):
    given_texts = [t for _, t in texts]
    assert vector_statistics(given_texts, 20_000) == [plain_statistics(t) for t in given_texts]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet="ab \n\t\r\x00\x85é#日", max_size=40), max_size=8), st.sampled_from([1, 20, 1 << 19]))
def test_statistics_of_odd_texts(texts, limit):
    assert vector_statistics(texts, limit) == [plain_statistics(t) for t in texts]


def test_trees_keep_their_constraints_and_learn():
    rng = np.random.default_rng(1)
    rows = rng.random((3000, 3))
    target = (rows[:, 0] + 0.3 * np.sin(9 * rows[:, 1]) + 0.1 * rng.standard_normal(3000) < 0.5).astype(float)
    forest = fit(rows, target, Boosting(monotone={0: -1}))
    assert ((forest.probability(rows) > 0.5) == target).mean() > 0.92
    grid = np.linspace(0, 1, 200)
    for other in rng.random((20, 3)):
        line = np.tile(other, (200, 1))
        line[:, 0] = grid
        assert (np.diff(forest.margin(line)) <= 1e-12).all()
    assert len(fit(rows, np.ones(3000)).roots) == 0


def test_flat_nodes_agree_with_walking_each_row():
    rng = np.random.default_rng(2)
    rows = rng.random((500, 4))
    forest = fit(rows, (rows[:, 1] > rows[:, 2]).astype(float), Boosting(trees=7))

    def walk(row):
        total = forest.base
        for node in forest.roots:
            while forest.feature[node] >= 0:
                go_left = row[forest.feature[node]] <= forest.cut[node]
                node = (forest.left if go_left else forest.right)[node]
            total += forest.value[node]
        return total

    assert np.allclose(forest.margin(rows), [walk(r) for r in rows])


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet("/root/testdata/sf0.01/labels.parquet")


def test_held_out_labels_are_found(spark, labels):
    documents = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    forest = quality.train_quality(documents, labels.filter("doc_id % 2 = 0"))
    judged = quality.judge_quality(documents, forest).join(labels.filter("doc_id % 2 = 1"), "doc_id").collect()
    right = [r["kept"] == (r["quality"] == 1) for r in judged]
    assert len(right) > 100 and sum(right) / len(right) >= 0.95
    clean = [r["kept"] for r in judged if r["quality"] == 1 and not r["base_failed"]]
    assert sum(clean) / len(clean) >= 0.97


def test_edge_cases(spark, frame, labels):
    good = " ".join(f"w{i}" for i in range(12))
    rows = [(1, None), (2, ""), (3, "  \n "), (4, good), (4, good), (None, good), (5, "x " * 30_000), (6, "one two")]
    documents = frame(rows)
    no_model = quality.train_quality(documents, labels.filter("false"))
    judged = quality.judge_quality(documents.withColumnRenamed("n_chars", "kept"), no_model).collect()
    assert [(r["doc_id"], r["kept"]) for r in judged] == [
        (1, False), (2, False), (3, False), (4, True), (4, True), (None, True), (5, False), (6, False)
    ]
    kept = quality.keep_quality(documents, no_model)
    assert kept.columns == documents.columns and kept.count() == 3
    assert quality.judge_quality(documents.limit(0), no_model).count() == 0
    repeated = labels.limit(5).unionByName(labels.limit(5)).unionByName(labels.selectExpr("null", "1", "0").limit(1).toDF(*labels.columns))
    quality.train_quality(documents, repeated)
