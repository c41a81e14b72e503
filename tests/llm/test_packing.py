import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from twincheck.llm.packing import Packing, best_fit_decreasing, encode, encoder, pack_documents, position_ids, write_packed

RULE = Packing(length=256, window_tokens=5000)


@pytest.fixture(scope="module")
def encoding():
    with open(RULE.tokenizer, "rb") as file:
        return encoder(file.read())


def plain_best_fit(sizes, length):
    """The emptiest-fitting row by looking at all of them; of equal ones the latest that became so."""
    free, rows = [], []
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        fitting = [f for f in free if f[0] >= sizes[i]]
        if fitting:
            best = min(fitting, key=lambda f: f[0])
        else:
            best = [length, len(rows)]
            free.append(best)
            rows.append([])
        best[0] -= sizes[i]
        rows[best[1]].append(i)
    return rows


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 20), max_size=60))
def test_packing_is_best_fit_decreasing(sizes):
    found = best_fit_decreasing(sizes, 20)
    assert sorted(i for row in found for i in row) == list(range(len(sizes)))
    assert all(sum(sizes[i] for i in row) <= 20 for row in found)
    assert len(found) == len(plain_best_fit(sizes, 20))
    assert sorted(sum(sizes[i] for i in row) for row in found) == sorted(
        sum(sizes[i] for i in row) for row in plain_best_fit(sizes, 20)
    )


def rebuilt(rows, rule):
    """Token ids of each document, from the packed rows alone."""
    pieces = {}
    for r in rows:
        ids = np.frombuffer(r["ids"], dtype="<u2")
        assert len(ids) == rule.length and r["n_tokens"] == r["cu_seqlens"][-1] <= rule.length
        assert (ids[r["n_tokens"] :] == rule.end_token).all() and len(r["doc_ids"]) == r["n_segments"]
        positions = position_ids(r["position_resets"], rule.length)
        for doc_id, at, low, high in zip(r["doc_ids"], r["doc_starts"], r["cu_seqlens"], r["cu_seqlens"][1:]):
            assert positions[low] == 0 and (np.diff(positions[low:high]) == 1).all()
            pieces.setdefault(doc_id, []).append((at, ids[low:high]))
    found = {}
    for doc_id, own in pieces.items():
        own.sort(key=lambda p: p[0])
        assert [at for at, _ in own] == np.cumsum([0, *[len(p) for _, p in own[:-1]]]).tolist()
        found[doc_id] = np.concatenate([p for _, p in own])
    return found


def test_every_token_comes_back(documents, texts, encoding):
    rows = pack_documents(documents, RULE).collect()
    found = rebuilt(rows, RULE)
    assert found.keys() == {d for d, t in texts if t}
    for doc_id, text in texts:
        assert found[doc_id][-1] == RULE.end_token
        assert found[doc_id][:-1].tolist() == encoding.encode_ordinary(text)
    assert sum(r["n_tokens"] for r in rows) >= 0.95 * len(rows) * RULE.length
    assert len({(r["shard"], r["row"]) for r in rows}) == len(rows)


def test_edge_cases(spark, frame, encoding, tmp_path):
    rows = [(1, None), (2, ""), (3, "<|endoftext|> is text"), (None, "no id"), (5, "a" * 50_000), (6, "日本 " * 9000)]
    documents = frame(rows).withColumnRenamed("n_chars", "ids")
    packed = pack_documents(documents.coalesce(1), RULE)
    found = rebuilt(packed.collect(), RULE)
    assert found.keys() == {3, None, 5, 6}
    for doc_id, text in rows[2:]:
        assert found[doc_id][:-1].tolist() == encode(encoding, text).tolist()
        assert encoding.decode(found[doc_id][:-1].tolist()) == text
    same = pack_documents(frame([(7, "one two three")] * 5).coalesce(1), RULE).collect()
    assert sum(r["n_segments"] for r in same) == 5
    assert pack_documents(frame(rows).limit(0), RULE).count() == 0
    write_packed(packed, str(tmp_path / "packed"))
    assert spark.read.parquet(str(tmp_path / "packed")).count() == packed.count()


def test_only_the_long_stretch_is_cut(encoding):
    words = "ordinary words, " * 1800
    text = words + "x" * 45_000 + " and " + words + "é" * 20_001
    ids = encode(encoding, text).tolist()
    whole, after = encoding.encode_ordinary(words), encoding.encode_ordinary(" and " + words[:-1])
    assert encoding.decode(ids) == text
    assert ids[: len(whole) - 1] == whole[:-1]
    assert any(ids[i : i + len(after)] == after for i in range(len(whole), len(ids)))
    assert encode(encoding, words * 3).tolist() == encoding.encode_ordinary(words * 3)


def test_runs_are_packed_apart_and_named(frame):
    documents = frame([(i, f"text number {i}") for i in range(40)]).coalesce(1)
    rows = pack_documents(documents, RULE, within="doc_id div 10").collect()
    assert [sorted(r["doc_ids"]) for r in rows] == [list(range(i, i + 10)) for i in (0, 10, 20, 30)]
    assert [r["sequence"] for r in rows] == ["0", "1", "2", "3"] and [r["row"] for r in rows] == [0, 1, 2, 3]
