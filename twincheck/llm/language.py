"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams, trained with
follow-the-regularised-leader and elastic-net penalties, then calibrated by a temperature."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

UNKNOWN = "und"
_ORDERS = 3
_BLOCK_CHARS = 1 << 18
_MULTIPLIERS = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D], dtype=np.uint32)


@dataclass(frozen=True)
class LanguageRule:
    """N-grams of one to three letters are hashed to ``2**bits`` features. At most ``sample`` documents are fitted, dealt
    evenly over the languages in the order of a hash of their ids; one in ``calibrate`` of them sets the temperature."""

    bits: int = 15
    sample: int = 4000
    per_language: int = 1000
    epochs: int = 3
    alpha: float = 0.3
    beta: float = 1.0
    l1: float = 0.002
    l2: float = 0.001
    calibrate: int = 5

    @property
    def features(self) -> int:
        return 1 << self.bits


@dataclass
class LanguageModel:
    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray
    temperature: float

    def predict(self, ids: np.ndarray, counts: np.ndarray) -> tuple[str, float]:
        """The language of a text's features and its probability; no features or no languages: unknown."""
        if not len(ids) or not self.languages:
            return UNKNOWN, 0.0
        p = softmax(self.logits(ids, counts) / self.temperature)
        best = int(np.argmax(p))
        return self.languages[best], float(p[best])

    def logits(self, ids: np.ndarray, counts: np.ndarray) -> np.ndarray:
        return unit(counts, self.idf[ids]) @ self.weights[ids]


@cache
def letters() -> np.ndarray:
    """For each code point its lower-case letter, or a space for everything that is no letter."""
    found = np.full(0x110000, 32, dtype=np.uint32)
    for point in range(0x110000):
        char = chr(point)
        if char.isalpha():
            low = char.lower()
            found[point] = ord(low) if len(low) == 1 else point
    return found


def grams(texts: list[str], bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each text its features, in order, and how often each occurs; none without a letter. Texts are read whole."""
    held: list[str] = []
    size = 0
    for text in texts:
        held.append(text)
        size += len(text)
        if size >= _BLOCK_CHARS:
            yield from _block_grams(held, bits)
            held, size = [], 0
    if held:
        yield from _block_grams(held, bits)


def _block_grams(texts: list[str], bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    # Two spaces around each text keep n-grams within it.
    joined = "  " + "  ".join(texts) + "  "
    points = letters()[np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)]
    filled = points != 32
    ids, keep = [], []
    key = np.zeros(len(points), dtype=np.uint32)
    some = np.zeros(len(points), dtype=bool)
    for order in range(_ORDERS):
        n = len(points) - order
        key = (key[:n] ^ (points[order:] + np.uint32(order + 1))) * _MULTIPLIERS[order]
        some = some[:n] | filled[order:]
        h = key ^ (key >> np.uint32(15))
        ids.append(((h * np.uint32(0x27D4EB2F)) >> np.uint32(32 - bits)).astype(np.int32))
        keep.append(some)
    at = 0
    for text in texts:
        # From one space before the text on; n-grams end one space after it at most.
        to = at + len(text) + 2
        own = np.concatenate([i[at + 1 : to][k[at + 1 : to]] for i, k in zip(ids, keep)])
        counts = np.bincount(own, minlength=1 << bits)
        found = np.flatnonzero(counts)
        yield found, counts[found]
        at = to


def unit(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = (1 + np.log(counts)) * idf
    return x / np.sqrt((x * x).sum())


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max())
    return e / e.sum()


def fit(rows: list[tuple[np.ndarray, np.ndarray, int]], languages: list[str], idf: np.ndarray, rule: LanguageRule):
    """A model from (features, counts, language index) in any fixed order."""
    learn = [r for i, r in enumerate(rows) if i % rule.calibrate]
    held = [r for i, r in enumerate(rows) if i % rule.calibrate == 0]
    shape = (rule.features, len(languages))
    z, n = np.zeros(shape), np.zeros(shape)

    def weights(at):
        own = z[at]
        rate = (rule.beta + np.sqrt(n[at])) / rule.alpha + rule.l2
        return np.where(np.abs(own) <= rule.l1, 0.0, (np.sign(own) * rule.l1 - own) / rate)

    for _ in range(rule.epochs):
        for ids, counts, language in learn:
            x = unit(counts, idf[ids])
            w = weights(ids)
            error = softmax(x @ w)
            error[language] -= 1
            g = x[:, None] * error
            step = (np.sqrt(n[ids] + g * g) - np.sqrt(n[ids])) / rule.alpha
            z[ids] += g - step * w
            n[ids] += g * g
    model = LanguageModel(languages, idf, weights(slice(None)), 1.0)
    scored = [(model.logits(ids, counts), language) for ids, counts, language in held]
    if scored:
        def loss(t):
            return -sum(np.log(softmax(x / t)[k] + 1e-300) for x, k in scored)

        model.temperature = float(min(np.geomspace(0.02, 5, 60), key=loss))
    return model


def _texts(column: pa.Array) -> list[str]:
    return [t or "" for t in column.to_pylist()]


def train_language(documents: DataFrame, rule: LanguageRule = LanguageRule()) -> LanguageModel:
    """A model from ``documents`` (doc_id, text, lang). Document frequencies count every row with a language.

    Rows with a null lang are ignored, rows with a null doc_id are counted but never fitted; a repeated doc_id is fitted
    once for each of its languages. Without rows the model knows no language.
    """
    known = documents.filter("lang IS NOT NULL").select("doc_id", "text", F.col("lang").cast("string").alias("lang"))

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, texts = np.zeros(rule.features, dtype=np.int64), 0
        for batch in batches:
            for ids, _ in grams(_texts(batch.column("text")), rule.bits):
                df[ids] += 1
                texts += 1
        at = np.flatnonzero(df)
        # Feature -1 counts the texts.
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(at, -1).astype(np.int32)), pa.array(np.append(df[at], texts))], names=["feature", "df"]
        )

    found = known.select("text").mapInArrow(frequencies, "feature int, df long").groupBy("feature").sum("df").toArrow()
    df = np.zeros(rule.features + 1)
    df[found.column(0).to_numpy()] = found.column(1).to_numpy()
    idf = np.log((1 + df[-1]) / (1 + df[:-1])) + 1

    # About four times the documents wanted of each language go on to the ranking, however many it has. No more
    # languages than sampled documents can be learned, which bounds the broadcast.
    named = known.filter("doc_id IS NOT NULL").select("doc_id", "lang")
    sizes = named.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(rule.sample)
    drawn = named.join(F.broadcast(sizes), "lang").filter(
        f"pmod(xxhash64(doc_id), {1 << 31}) < {4 * rule.per_language << 31}L / n"
    )
    order = "xxhash64(doc_id), doc_id"
    chosen = (
        drawn.selectExpr("doc_id", "lang", f"row_number() OVER (PARTITION BY lang ORDER BY {order}) AS turn")
        .filter(F.col("turn") <= rule.per_language)
        .orderBy("turn", F.xxhash64("doc_id", "lang"), "doc_id", "lang")
        .limit(rule.sample)
        .select("doc_id", "lang")
        .distinct()
    )

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists = pa.list_(pa.int32())
        for batch in batches:
            found = list(grams(_texts(batch.column("text")), rule.bits))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), batch.column("lang"),
                    pa.array([ids for ids, _ in found], lists), pa.array([counts for _, counts in found], lists),
                ],
                names=["doc_id", "lang", "ids", "counts"],
            )

    # At most rule.sample short rows are broadcast, and as many feature lists come back.
    sample = (
        known.join(F.broadcast(chosen), ["doc_id", "lang"])
        .selectExpr("cast(doc_id AS string) AS doc_id", "lang", "text")
        .mapInArrow(counted, "doc_id string, lang string, ids array<int>, counts array<int>")
        .groupBy("doc_id", "lang")
        .agg(F.min(F.struct("ids", "counts")).alias("grams"))
        .orderBy(F.xxhash64("doc_id"), "doc_id", "lang")
        .select("lang", "grams.ids", "grams.counts")
        .toArrow()
    )
    languages = sorted(set(sample.column("lang").to_pylist()))
    rows = [
        (np.asarray(ids.values, dtype=np.int64), np.asarray(counts.values, dtype=np.int64), languages.index(lang.as_py()))
        for lang, ids, counts in zip(*(sample.column(c) for c in ("lang", "ids", "counts")))
    ]
    return fit([r for r in rows if len(r[0])], languages, idf, rule)


def predict_language(documents: DataFrame, model: LanguageModel, rule: LanguageRule = LanguageRule()) -> DataFrame:
    """``documents`` (doc_id: long, text; more columns are ignored) to doc_id, lang_pred, score, in one pass.

    Texts that are null or have no letter are ``und`` with score 0; every row is judged by its own text; an empty table
    gives no rows.
    """
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            found = [known.predict(*row) for row in grams(_texts(batch.column("text")), rule.bits)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([lang for lang, _ in found], pa.string()),
                    pa.array([score for _, score in found], pa.float64()),
                ],
                names=["doc_id", "lang_pred", "score"],
            )

    return documents.selectExpr("cast(doc_id AS bigint) AS doc_id", "cast(text AS string) AS text").mapInArrow(
        run, "doc_id long, lang_pred string, score double"
    )
