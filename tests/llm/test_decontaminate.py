import hashlib
import random
import re

from twincheck.llm.decontaminate import Winnowing, decontaminate

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}
COLUMNS = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]


def plain(docs, items, span=10):
    def words(text):
        return WORD.findall((text or "").translate(LOWER))

    rows = []
    for doc_id, text in docs:
        own, hit, names = words(text), set(), set()
        for item_id, item in items:
            w = words(item)
            k = min(len(w), span)
            windows = {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if k else set()
            for i in range(len(own) - k + 1):
                if k and tuple(own[i : i + k]) in windows:
                    hit.update(range(i, i + k))
                    if item_id is not None:
                        names.add(str(item_id))
        digest = hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()
        rows.append((doc_id, len(own), len(hit), len(names), digest, bool(hit)))
    return sorted(rows, key=repr)


def found(spark, docs, items, **rule):
    items = spark.createDataFrame(items, "item_id long, text string")
    rows = decontaminate(docs, items, Winnowing(**rule)).select(*COLUMNS).collect()
    return sorted(map(tuple, rows), key=repr)


def test_random_texts_of_few_words(spark, frame):
    rng = random.Random(5)
    docs = [(i, " ".join(rng.choice("abC") for _ in range(rng.choice([3, 30, 80])))) for i in range(40)]
    items = [(i, " ".join(rng.choice("abc") for _ in range(rng.choice([1, 4, 7, 9, 10, 11, 25])))) for i in range(12)]
    assert found(spark, frame(docs), items) == plain(docs, items)


def test_shared_spans_of_exactly_the_guaranteed_length(spark, frame):
    rng = random.Random(6)
    items = [(i, " ".join(f"w{rng.randrange(400)}" for _ in range(40))) for i in range(5)]
    docs = []
    for i in range(60):
        words = items[i % 5][1].split()
        at, n = rng.randrange(30), rng.choice([9, 10, 11])
        noise = [f"n{rng.randrange(999)}" for _ in range(50)]
        docs.append((i, ", ".join(noise[:20] + words[at : at + n] + noise[20:]).upper()))
    assert found(spark, frame(docs), items) == plain(docs, items)


def test_edge_cases(spark, frame):
    docs = [(1, None), (2, ""), (3, "..."), (4, "É a-b C"), (4, "É a-b C"), (4, "other"), (None, "a b"), (6, "a " * 30_000)]
    items = [(1, None), (2, ""), (3, "a B!"), (3, "a B!"), (None, "c"), (5, "É"), (3, "zz")]
    assert found(spark, frame(docs).withColumnRenamed("source", "n_hit"), items) == plain(docs, items)
    assert found(spark, frame(docs), []) == plain(docs, [])
    assert found(spark, frame(docs).limit(0), items) == []


def test_equal_words_cost_no_pairs_of_places(spark, frame):
    """30,000 equal words against an item of 10,000: all pairs of places would be 300 M, each compared over the item."""
    docs = [(1, "a " * 30_000), (2, "b " * 9), (3, "x " + "a " * 9)]
    items = [(1, "a " * 10_000), (2, "a " * 10_000 + "c"), (3, "b b")]
    rows = found(spark, frame(docs), items)
    assert [r[:4] for r in rows] == [(1, 30_000, 30_000, 2), (2, 9, 9, 1), (3, 10, 0, 0)]
