import math
from collections import Counter

import numpy as np

from twincheck.llm.language import _MULTIPLIERS, LanguageModel, LanguageRule, grams, letters, predict_language, train_language


def test_features_depend_on_a_text_alone():
    texts = ["Das Haus", "", "123 !", "das  haus?", "x" * 300_000, "日本"]
    together = [(i.tolist(), c.tolist()) for i, c in grams(texts, 12)]
    alone = [(i.tolist(), c.tolist()) for t in texts for i, c in grams([t], 12)]
    assert together == alone and len(together) == len(texts)
    assert not together[1][0] and not together[2][0] and together[5][0]
    table = letters()
    plain = Counter(chr(table[ord(c)]) for c in "Das Haus")
    assert plain["a"] == 2 and plain["d"] == 1


def test_held_out_accuracy_and_calibration(spark):
    documents = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = train_language(documents.filter("doc_id % 4 <> 2"), LanguageRule(sample=400))
    assert np.mean(model.weights == 0) > 0.3
    held = predict_language(documents, model).join(documents.select("doc_id", "lang"), "doc_id").filter("doc_id % 4 = 2")
    rows = held.collect()
    assert sum(r["lang_pred"] == r["lang"] for r in rows) / len(rows) >= 0.97
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_edge_cases(spark, frame):
    rows = [(1, None), (2, ""), (3, "12 .."), (4, "the house"), (4, "la maison"), (None, "la maison"), (6, "word " * 60_000)]
    documents = frame(rows)
    nothing = train_language(documents.limit(0))
    assert {(r["lang_pred"], r["score"]) for r in predict_language(documents, nothing).collect()} == {("und", 0.0)}
    odd = documents.selectExpr("doc_id", "text", "CASE WHEN doc_id = 4 THEN 'en' WHEN doc_id IS NULL THEN 'fr' END AS lang")
    model = train_language(odd.unionAll(odd))
    assert model.languages == ["en"]
    found = predict_language(documents.withColumnRenamed("n_chars", "score"), model).collect()
    assert [(r["doc_id"], r["lang_pred"]) for r in found] == [
        (1, "und"), (2, "und"), (3, "und"), (4, "en"), (4, "en"), (None, "en"), (6, "en")
    ]
    assert predict_language(documents.limit(0), model).count() == 0
    assert LanguageModel([], np.zeros(1), np.zeros((1, 0)), 1.0).predict(np.array([0]), np.array([1])) == ("und", 0.0)


def plain_prediction(model, text, bits):
    """One n-gram at a time, in whole numbers and plain floats."""
    table = letters()
    points = [int(table[ord(c)]) for c in f"  {text}  "]
    counts = Counter()
    for start in range(1, len(text) + 2):
        key = 0
        for order in range(3):
            key = ((key ^ (points[start + order] + order + 1)) * int(_MULTIPLIERS[order])) % 2**32 if start + order < len(points) else key
            if start + order < len(points) and any(p != 32 for p in points[start : start + order + 1]):
                counts[((key ^ (key >> 15)) * 0x27D4EB2F) % 2**32 >> (32 - bits)] += 1
    if not counts:
        return "und", 0.0
    x = {i: (1 + math.log(n)) * float(model.idf[i]) for i, n in counts.items()}
    length = math.sqrt(sum(v * v for v in x.values()))
    logits = [
        sum(v / length * float(model.weights[i, k]) for i, v in x.items()) / model.temperature for k in range(len(model.languages))
    ]
    powers = [math.exp(z - max(logits)) for z in logits]
    return model.languages[powers.index(max(powers))], max(powers) / sum(powers)


def test_predictions_against_brute_force(spark, documents, frame):
    model = train_language(documents, LanguageRule(sample=120))
    texts = [r["text"] for r in documents.limit(25).collect()] + ["", "12", "a", "É", "日本 x", "Straße IST\tlang"]
    found = {r["doc_id"]: r for r in predict_language(frame(list(enumerate(texts))), model).collect()}
    for i, text in enumerate(texts):
        language, score = plain_prediction(model, text, LanguageRule().bits)
        assert found[i]["lang_pred"] == language and abs(found[i]["score"] - score) < 1e-9
