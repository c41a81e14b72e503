import random

import numpy as np
import pyarrow as pa

from twincheck.llm.substrings import GEAR, Chunking, chunk_starts, gear_hashes, repeated_spans, without_repeats
from twincheck.llm.wordhash import blocks


def prose(rng, n):
    return " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randrange(2, 10))) for _ in range(n))


def test_gear_hash_is_the_rolling_one():
    data = np.frombuffer(random.Random(1).randbytes(500), dtype=np.uint8)
    rolling, found = 0, []
    for byte in data:
        rolling = ((rolling << 1) + int(GEAR[byte])) & 0xFFFFFFFF
        found.append(rolling & 0xFFFF)
    # The low 16 bits of the endless rolling hash hold the last 16 bytes.
    assert (gear_hashes(data) & 0xFFFF).tolist() == found


def test_chunks_do_not_depend_on_the_texts_around_and_resist_shifts():
    rng = random.Random(2)
    texts = [prose(rng, 200), "", "é" * 50, prose(rng, 5), prose(rng, 3000)]
    block = next(blocks(pa.array(texts), 1 << 22))
    starts, owner = chunk_starts(block, 16)
    for i, text in enumerate(texts):
        if text:
            alone, _ = chunk_starts(next(blocks(pa.array([text]))), 16)
            assert (starts[owner == i] - block.bounds[i]).tolist() == alone.tolist()
    text = texts[4]
    before, _ = chunk_starts(next(blocks(pa.array([text]))), 16)
    after, _ = chunk_starts(next(blocks(pa.array([text[:5000] + "inserted" + text[5000:]]))), 16)
    assert len({*before.tolist()} - {a if a <= 5000 else a - 8 for a in after.tolist()}) <= 3
    assert np.diff(before).min() > 16 and 25 < np.diff(before).mean() < 45


def test_planted_passages_are_found_and_clean_texts_left_alone(frame):
    rng = random.Random(3)
    rows, planted = [], set()
    passages = [prose(rng, 51) for _ in range(20)]
    for i in range(300):
        text = prose(rng, rng.randrange(20, 200))
        if i % 3 == 0:
            text = f"{text}\n{passages[i // 3 % 20]} {prose(rng, 30)}"
            planted.add(i)
        rows.append((i, text))
    spans = repeated_spans(frame(rows)).collect()
    assert {r["doc_id"] for r in spans} == planted
    texts = dict(rows)
    for r in spans:
        piece = texts[r["doc_id"]][r["span_start"] : r["span_end"]]
        assert piece in passages[r["doc_id"] // 3 % 20] and r["n_words"] >= 20
        assert r["removed"] == (r["doc_id"] != r["first_doc_id"]) and r["first_doc_id"] == r["doc_id"] // 3 % 20 * 3


def test_copies_are_cut_out(spark, frame):
    rng = random.Random(4)
    one, two, passage = prose(rng, 90), prose(rng, 90), prose(rng, 80)
    documents = frame([(1, f"{one} {passage}"), (2, f"{passage} {two}"), (3, one), (4, None), (5, "né " + two)])
    texts = {r["doc_id"]: r["text"] for r in without_repeats(documents, repeated_spans(documents)).collect()}
    assert texts[1] == f"{one} {passage}" and texts[4] is None
    assert passage[60:-60] not in texts[2] and two in texts[2]
    assert len(texts[3]) < 60 and texts[5].startswith("né ") and len(texts[5]) < 120
    assert without_repeats(documents, repeated_spans(documents)).columns == documents.columns


def test_passages_of_a_repeated_word_are_found(frame):
    rng = random.Random(6)
    rows, passages = [], {}
    for n, word in enumerate(["so", "again", "é", "日本", "repeated", "a b c d", "fifteen-letters"]):
        for words in (51, 80):
            passage = " ".join(" ".join([word] * words).split()[:words])
            for copy in range(2):
                doc = len(rows)
                rows.append((doc, f"{prose(rng, 40 + 7 * copy)} {passage} {prose(rng, 30)}"))
                passages[doc] = passage
    spans = repeated_spans(frame(rows), Chunking(least_words=20)).collect()
    texts = dict(rows)
    for doc, passage in passages.items():
        own = [r for r in spans if r["doc_id"] == doc]
        covered = set()
        for r in own:
            piece = texts[doc][r["span_start"] : r["span_end"]]
            assert set(piece.split()) <= set(passage.split()) | {""} or piece.strip() in passage
            covered |= set(range(r["span_start"], r["span_end"]))
        assert own and len(covered) > 0.5 * len(passage) - 40, (doc, passage[:20])


def test_exact_copies_of_texts_of_repeated_words_or_of_one_chunk(frame):
    short = " ".join("abcdefghijklmnopqrstuv")
    loop, other = "loop " * 200, "日本 " * 60
    rows = [(1, loop), (2, loop), (3, short), (4, short), (5, other), (6, other), (7, "x " * 10)]
    spans = repeated_spans(frame(rows)).collect()
    found = {(r["doc_id"], r["removed"]) for r in spans}
    assert {(2, True), (3, False), (4, True), (6, True)} <= found and 7 not in {d for d, _ in found}
    whole = {r["doc_id"]: (r["span_start"], r["span_end"]) for r in spans if r["removed"]}
    assert whole[2] == (0, len(loop)) and whole[4] == (0, len(short)) and whole[6] == (0, len(other))


def test_no_chunk_is_longer_than_a_bound():
    for text in ("z" * 5000, "no " * 2000, "é" * 3000, "日本語" * 1000, "fourteen bytes" * 300):
        starts, _ = chunk_starts(next(blocks(pa.array([text]))), 16)
        gaps = np.diff(np.append(starts, len(text.encode())))
        assert gaps.max() <= 64 and gaps[:-1].min() > 16
        assert len(set(gaps[1:-1].tolist())) == 1


def test_edge_cases(frame):
    rng = random.Random(5)
    long = prose(rng, 40_000)
    again = prose(rng, 60)
    rows = [(1, None), (2, ""), (3, "short"), (3, "short"), (7, long), (8, long), (None, again), (9, f"{again} {again}"),
            (4, "z" * 5000)]
    found = repeated_spans(frame(rows).withColumnRenamed("n_chars", "removed")).collect()
    assert {(r["doc_id"], r["removed"]) for r in found} == {(7, False), (8, True), (None, True), (9, False), (9, True)}
    whole = {r["doc_id"]: (r["span_start"], r["span_end"], r["n_words"]) for r in found if r["doc_id"] in (7, 8)}
    assert whole[7] == whole[8] == (0, len(long), 40_000)
    assert repeated_spans(frame(rows).limit(0)).count() == 0
    assert repeated_spans(frame(rows), Chunking(least_words=100_000)).count() == 0


def spanned(frame, rows, **rule):
    return sorted((r["doc_id"], r["removed"], r["n_words"]) for r in repeated_spans(frame(rows), Chunking(**rule)).collect())


def test_exact_copies_of_any_length(frame):
    rng = random.Random(8)
    text = prose(rng, 17)
    rows = [(1, text), (2, text), (3, "one"), (4, "one"), (5, f"{text} {prose(rng, 30)}"), (6, " "), (7, " "), (8, "two")]
    assert spanned(frame, rows, exact_copies=True) == [(1, False, 17), (2, True, 17), (3, False, 1), (4, True, 1)]
    assert spanned(frame, rows) == []


def test_a_phrase_said_over_and_over_is_no_repeat_of_itself(frame):
    rng = random.Random(9)
    loop = "ha " * 200
    assert spanned(frame, [(1, "start " + loop), (2, prose(rng, 100))]) == []
    passage = prose(rng, 60)
    assert {(d, r) for d, r, _ in spanned(frame, [(1, f"{passage} {passage}")])} == {(1, False), (1, True)}
    assert {(d, r) for d, r, _ in spanned(frame, [(1, "start " + loop), (2, prose(rng, 9) + " " + loop)])} == {(1, False), (2, True)}


def test_hot_digests_are_salted_without_a_change(frame):
    rng = random.Random(10)
    line = prose(rng, 40)
    rows = [(i, f"{prose(rng, 30)}\n{line}\n{prose(rng, 10)}") for i in range(120)]
    plain = spanned(frame, rows, hot_share=1.0)
    assert len(plain) == 120 and spanned(frame, rows, hot_share=0.0001, salts=7) == plain


def test_shared_spans_of_small_texts_against_brute_force(frame):
    """What two texts share over at least 40 words is found in both; what is reported occurs twice."""
    rng = random.Random(11)
    parts = [prose(rng, 45) for _ in range(6)]
    rows = [(i, " ".join([prose(rng, 8), *rng.sample(parts, rng.randrange(0, 3)), prose(rng, 8)])) for i in range(25)]
    texts = dict(rows)
    spans = repeated_spans(frame(rows)).collect()
    covered = {i: set() for i in texts}
    for r in spans:
        piece = texts[r["doc_id"]][r["span_start"] : r["span_end"]]
        assert all(any(piece[at : at + 30] in t for i, t in rows if i != r["doc_id"]) for at in range(0, len(piece) - 30, 15))
        covered[r["doc_id"]].update(range(r["span_start"], r["span_end"]))
    for part in parts:
        holders = [i for i, t in rows if part in t]
        for i in holders if len(holders) > 1 else []:
            at = texts[i].index(part)
            assert len(covered[i] & set(range(at, at + len(part)))) > 0.6 * len(part)
        assert len(holders) != 1 or not covered[holders[0]] & set(range(texts[holders[0]].index(part) + 60, texts[holders[0]].index(part) + 120))
