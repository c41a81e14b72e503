import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from twincheck.llm import lexical

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def plain(documents, items, k=20):
    """Every score by the definition: sorted (item_id, rank, doc_id, score)."""
    held = [(i, Counter(t), len(t)) for i, text in documents if (t := terms(text))]
    n, total = len(held), sum(x[2] for x in held)
    df = Counter(t for _, c, _ in held for t in c)
    weight = {t: math.floor(1000 * math.log((2 * n + 2) / (2 * d + 1))) for t, d in df.items()}
    out = []
    for item, text in set(items):
        asked = terms(text)
        scored = []
        for doc, counts, length in held:
            m = 100 - 25 + (25 * length * n) // total
            score = sum(weight[t] * ((10**9 * counts[t]) // (1000 * counts[t] + 12 * m)) for t in asked if t in counts)
            if score > 0:
                scored.append((-score, doc is None, doc))
        out += [(item, r, d, -s) for r, (s, _, d) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=repr)


def searched(spark, documents, items, k=20):
    found = lexical.search(
        spark.createDataFrame(documents, "doc_id long, text string"),
        spark.createDataFrame(items, "item_id long, text string"),
        k,
    )
    return sorted((tuple(r) for r in found.collect()), key=repr)


def corpus(seed, n):
    rng = random.Random(seed)
    common = [f"w{int(rng.paretovariate(0.6))}" for _ in range(3000)]
    return [(i, " ".join(rng.choices(common, k=rng.randint(0, 60)))) for i in range(n)]


@pytest.mark.parametrize(("window", "block", "postings"), [(4096, 128, 1 << 20), (16, 4, 900)])
def test_against_all_scores(spark, monkeypatch, window, block, postings):
    monkeypatch.setattr(lexical, "WINDOW", window)
    monkeypatch.setattr(lexical, "BLOCK", block)
    monkeypatch.setattr(lexical, "SHARD_POSTINGS", postings)
    documents = corpus(1, 700)
    items = [(i, text + " " + text[: len(text) // 2]) for i, text in corpus(2, 25)]
    for k in (1, 20):
        assert searched(spark, documents, items, k) == plain(documents, items, k)


def test_edge_cases(spark):
    documents = [(5, "Aa bb"), (3, "aa BB"), (3, "aa BB"), (None, "aa bb"), (1, None), (2, ""), (4, "_ . "), (9, "cc " * 40_000)]
    documents += [(6, "É é 12"), (7, "zz " * 300 + "aa")]
    items = [(1, "aa bb aa"), (1, "aa bb aa"), (1, "cc"), (2, None), (3, "..."), (4, "nowhere"), (None, "É 12 zz")]
    assert searched(spark, documents, items) == plain(documents, items)
    assert searched(spark, documents, []) == searched(spark, [], items) == searched(spark, [(1, None)], items) == []


def test_a_term_of_all_documents_has_no_weight(spark):
    documents = [(i, "all" + " one" * (i % 2)) for i in range(2000)]
    items = [(1, "all"), (2, "all one")]
    found = searched(spark, documents, items)
    assert found == plain(documents, items) and {r[0] for r in found} == {2}


def test_more_columns_and_other_item_types(spark):
    documents = spark.createDataFrame([(1, "a b", "x", 1), (2, "b", "y", 2)], "doc_id long, text string, term string, score int")
    items = spark.createDataFrame([("q", "a", 1)], "item_id string, text string, doc_id int")
    found = lexical.search(documents, items).collect()
    assert [(r["item_id"], r["rank"], r["doc_id"]) for r in found] == [("q", 1, 1)]


def test_several_passes_over_the_index(spark, monkeypatch):
    documents, items = corpus(4, 200), corpus(5, 20)
    expected = plain(documents, items)
    monkeypatch.setattr(lexical, "PASS_TERMS", 40)
    assert searched(spark, documents, items) == expected


def test_blocks_are_rejected_before_they_are_decompressed(spark):
    """One rare term decides; the common list is touched only where its blocks may still matter."""
    documents = [(i, "rare rare rare" if i in (3, 9_000) else "common" + " other" * (i % 5 + 1)) for i in range(12_000)]
    shard = lexical._Shard()
    for i, text in documents:
        shard.add(i, text.encode())
    rows = shard.rows(0).to_pylist()
    summary = next(r for r in rows if r["term"] is None)
    searcher = lexical.Searcher(rows, lexical.Corpus(summary["df"], summary["terms"]))
    docs, _ = searcher.best([("rare", 9000), ("common", 3)], 1)
    assert docs.tolist() == [3]
    common = searcher.lists["common"]
    assert 0 < len(common.blocks) < len(common.ends) / 2


def test_blocks_hold_what_was_packed():
    shard = lexical._Shard()
    rng = np.random.default_rng(0)
    given = [b"a " * int(rng.choice([0, 1, 300, 70_000], p=[0.6, 0.3, 0.09, 0.01])) + b"b" for _ in range(3000)]
    for i, text in enumerate(given):
        shard.add(i, text)
    rows = shard.rows(7).to_pylist()
    total = next(r for r in rows if r["term"] is None)
    corpus = lexical.Corpus(total["df"], total["terms"])
    norms = corpus.norm(np.array(total["lengths"]))
    one = lexical._List(next(r for r in rows if r["term"] == "a"), corpus, norms)
    docs = np.concatenate([one.block(b)[0] for b in range(len(one.ends))])
    worth = np.concatenate([one.block(b)[1] for b in range(len(one.ends))])
    uses = np.array([t.count(b"a") for t in given])
    assert docs.tolist() == np.flatnonzero(uses).tolist()
    assert worth.tolist() == lexical.impact(uses[docs], norms[docs]).tolist()
    assert all((one.block(b)[1] <= one.bounds[b]).all() for b in range(len(one.ends)))
