import re

import pytest

import corpus_pipeline
from twincheck.llm import quality
from twincheck.llm.scratch import Scratch

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def stages(spark):
    """The documents and what every stage makes of them."""
    scratch = Scratch(spark, "test-pipeline")
    found = [spark.read.parquet(f"{SF}/documents.parquet")]
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        found.append(scratch.save(stage(spark, found[-1], SF), f"s{i}"))
    return found


def ids(frame):
    return sorted(r["doc_id"] for r in frame.select("doc_id").collect())


def test_stages_are_the_dealt_ones_and_keep_the_columns(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality rules", "near-duplicates", "decontamination", "mixing", "packing"]
    for before, after in zip(stages, stages[1:5]):
        assert after.columns == before.columns and after.schema == before.schema


def test_quality_stage(spark, stages):
    forest = quality.train_quality(stages[0], spark.read.parquet(f"{SF}/labels.parquet"))
    kept = quality.judge_quality(stages[0], forest).filter("kept")
    assert ids(stages[1]) == ids(kept)


def test_near_duplicate_stage(stages):
    def shingles(text):
        words = WORD.findall(text.translate({c: c + 32 for c in range(65, 91)}))
        return {tuple(words[i : i + 5]) for i in range(max(len(words) - 4, 1))}

    rows = sorted((r["doc_id"], shingles(r["text"])) for r in stages[1].collect())
    group = {i: i for i, _ in rows}

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for n, (i, a) in enumerate(rows):
        for j, b in rows[:n]:
            if 100 * len(a & b) >= 80 * len(a | b):
                low, high = sorted((root(i), root(j)))
                group[high] = low
    assert ids(stages[2]) == [i for i, _ in rows if root(i) == i]


def test_decontamination_stage(spark, stages):
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    lower = {c: c + 32 for c in range(65, 91)}
    windows = set()
    for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect():
        w = word.findall(r["text"].translate(lower))
        windows |= {tuple(w[i : i + 10]) for i in range(len(w) - 9)} if len(w) > 9 else {tuple(w)}
    sizes = {len(w) for w in windows}

    def clean(text):
        w = word.findall(text.translate(lower))
        return not any(tuple(w[i : i + k]) in windows for k in sizes for i in range(len(w) - k + 1))

    assert ids(stages[3]) == sorted(r["doc_id"] for r in stages[2].collect() if clean(r["text"]))


def test_mixing_stage(stages):
    size = {r["doc_id"]: (r["source"], len(WORD.findall(r["text"]))) for r in stages[3].collect()}
    taken = ids(stages[4])
    assert all(taken.count(i) <= 2 for i in set(taken)) and set(taken) <= set(size)
    total = 1.5 * sum(n for _, n in size.values())
    assert abs(sum(size[i][1] for i in taken) - total) <= 20 * max(n for _, n in size.values()) / 2


def test_packing_stage(stages):
    packed = stages[5].collect()
    documents = {r["doc_id"] for r in stages[4].collect()}
    assert {i for r in packed for i in r["doc_ids"]} == documents
    segments = sum(at == 0 for r in packed for at in r["doc_starts"])
    assert segments == stages[4].count()


def test_repeated_rows_nulls_and_clashing_columns(spark, stages):
    rows = [(1, None), (2, "one two three"), (2, "one two three"), (None, "one two three"), (5, "")]
    docs = spark.createDataFrame(
        [(i, t, "en", "s", 1, 7, 8, "x") for i, t in rows],
        "doc_id long, text string, lang string, source string, n_chars long, size long, target long, whole string",
    )
    for _, stage in corpus_pipeline.STAGES[:4]:
        assert stage(spark, docs, SF).columns == docs.columns
        assert stage(spark, docs.limit(0), SF).count() == 0
    unique = corpus_pipeline.near_duplicates(spark, docs, SF)
    assert sorted((repr(r["doc_id"]), r["text"]) for r in unique.filter("text <> ''").collect()) == [
        ("2", "one two three"), ("None", "one two three")
    ]
    assert corpus_pipeline.without_benchmark(spark, docs, SF).count() == 5


def rows_of(spark, rows):
    return spark.createDataFrame(
        [(i, t, "en", s, len(t or "")) for i, t, s in rows], "doc_id long, text string, lang string, source string, n_chars long"
    )


def test_an_id_with_two_texts_loses_only_the_copy(spark):
    x, y = " ".join(f"x{i}" for i in range(30)), " ".join(f"y{i}" for i in range(30))
    found = corpus_pipeline.near_duplicates(spark, rows_of(spark, [(1, x, "s"), (2, x, "s"), (2, y, "s")]), SF).collect()
    assert sorted((r["doc_id"], r["text"]) for r in found) == [(1, x), (2, y)]


def test_rows_equal_but_in_source_leave_the_same_one_in_every_run(spark):
    rows = [(4, "some words here", s) for s in ("c", "a", None, "b")]
    for order in (rows, rows[::-1], rows[2:] + rows[:2]):
        found = corpus_pipeline.near_duplicates(spark, rows_of(spark, order).repartition(3), SF).collect()
        assert [r["source"] for r in found] == [None]


def test_the_order_of_the_mix_reaches_the_packed_rows(spark, tmp_path):
    """Files of unequal size, which a scan reads largest first."""
    folder = str(tmp_path / "mixed")
    at = 0
    for part, size in enumerate([40, 900, 5, 300, 900, 60]):
        rows = [(i, f"document {i} " + "word " * 40, "s") for i in range(at, at + size)]
        rows_of(spark, rows).coalesce(1).write.mode("append").parquet(f"{folder}/{part}")
        at += size
    docs = spark.read.option("recursiveFileLookup", True).parquet(folder)
    packed = corpus_pipeline.pack_tokens(spark, docs, SF).orderBy("sequence", "row").collect()
    spans = {}
    for r in packed:
        low, high = spans.get(r["sequence"], (at, -1))
        spans[r["sequence"]] = min(low, *r["doc_ids"]), max(high, *r["doc_ids"])
    found = [spans[s] for s in sorted(spans)]
    assert len(found) == 6 and found[0][0] == 0 and found[-1][1] == at - 1
    assert all(before[1] + 1 == after[0] for before, after in zip(found, found[1:]))


def test_packing_of_nulls_clashing_columns_and_no_rows(spark, tmp_path):
    docs = spark.createDataFrame(
        [(1, None, "a"), (None, "no id", "b"), (3, "", "c"), (3, "three", "d"), (3, "three", "d")],
        "doc_id long, text string, sequence string",
    )
    for given in (docs, docs.limit(0)):
        path = str(tmp_path / f"docs{given.count()}")
        given.write.parquet(path)
        for read in (given, spark.read.parquet(path)):
            packed = corpus_pipeline.pack_tokens(spark, read, SF).collect()
            assert sorted((i or 0 for r in packed for i in r["doc_ids"])) == ([0, 3, 3] if given is docs else [])
