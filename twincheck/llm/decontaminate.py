"""Benchmark decontamination by winnowing: shared fingerprints are extended to whole windows of words, which are compared.

Everything here is DataFrame and SQL functions.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from twincheck.llm.scratch import Scratch

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_BETWEEN = r"[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
_NO_LONGS = "cast(array() AS array<bigint>)"


@dataclass(frozen=True)
class Winnowing:
    """Hashes of ``gram`` words, the least one kept in each run of ``span - gram + 1``: two texts that share ``span``
    words keep a common hash inside them, at the same place."""

    span: int = 10
    gram: int = 5

    @property
    def window(self) -> int:
        return self.span - self.gram + 1


def words(text: str) -> str:
    """SQL for the lower-cased words of a text: digits, letters a-z and everything beyond ASCII."""
    return f"array_remove(split(translate(coalesce({text}, ''), '{_UPPER}', '{_LOWER}'), '{_BETWEEN}'), '')"


def _grams(hashes: str, size: int) -> str:
    """SQL for the hash of each ``size`` consecutive words, from the hashes of the words."""
    parts = ", ".join(f"get({hashes}, i + {k})" for k in range(size))
    return (
        f"CASE WHEN size({hashes}) >= {size} THEN transform(sequence(0, size({hashes}) - {size}), i -> xxhash64({parts}))"
        f" ELSE {_NO_LONGS} END"
    )


def _least(grams: str, window: int) -> str:
    """SQL for the distinct least hashes of all windows."""
    if window == 1:
        return f"array_distinct({grams})"
    parts = ", ".join(f"get({grams}, i + {k})" for k in range(window))
    return (
        f"CASE WHEN size({grams}) >= {window} THEN"
        f" array_distinct(transform(sequence(0, size({grams}) - {window}), i -> least({parts}))) ELSE {_NO_LONGS} END"
    )


def _placed(grams: str, window: int, span: int) -> str:
    """SQL for the (print, back, span) of all windows; back is minus the place of the least hash's last occurrence.

    Neighbouring windows often share them. array_distinct() would compare structs pair by pair, so they stay.
    """
    return (
        f"CASE WHEN size({grams}) >= {window} THEN transform(sequence(0, size({grams}) - {window}),"
        f" i -> array_min(transform(sequence(i, i + {window - 1}),"
        f" j -> struct(get({grams}, j) AS print, -j AS back, {span} AS span))))"
        " ELSE cast(array() AS array<struct<print: bigint, back: int, span: int>>) END"
    )


def _hashed(texts: DataFrame) -> DataFrame:
    return texts.withColumn("h", F.expr("transform(w, x -> xxhash64(x))"))


def _with_grams(texts: DataFrame, sizes: list[int]) -> DataFrame:
    return _hashed(texts).select("*", *[F.expr(_grams("h", k)).alias(f"g{k}") for k in sizes])


def _same(a: str, b: str, key: str) -> Column:
    return F.expr(f"{a}.{key} <=> {b}.{key} AND {a}.digest = {b}.digest")


def decontaminate(documents: DataFrame, benchmark: DataFrame, rule: Winnowing = Winnowing()) -> DataFrame:
    """``documents`` (doc_id: long, text) against ``benchmark`` (item_id, text): doc_id, n_words, n_hit, n_items,
    items_sha256, contaminated, digest (of the text), for every row of ``documents``; more columns of either are ignored.

    A window is ``span`` consecutive words of an item, or the whole item if it has fewer. ``n_hit`` counts a document's
    words inside any occurrence of a window, ``n_items`` the items with occurring windows.

    1. Both sides keep the least hash of each run of word grams; items shorter than ``span`` are one gram of their own
       size, looked up at every place. Documents that share a kept hash with an item are candidates.
    2. A shared hash in a candidate is extended to all windows of words around it. Every window that the document shares
       with an item holds a kept hash of both at the same place, so none is missed.
    3. These windows are looked up by their words among the distinct windows of the items. A place is looked up once,
       whatever the number of places and items that repeat its window.

    Items join by shuffle unless Spark sees that they are small. Null and empty texts have no words; a null item_id can
    hit but is not counted or listed; repeated rows and ids are judged by their own texts; an empty table on either side
    leaves nothing contaminated. Texts may be of any length: a task holds the words and the windows of one at a time.
    """
    scratch = Scratch(documents.sparkSession, "decontaminate")
    items = scratch.save(
        benchmark.selectExpr("cast(item_id AS string) AS item_id", f"{words('cast(text AS string)')} AS w")
        .filter("size(w) > 0")
        .selectExpr("item_id", "xxhash64(w) AS digest", "w")
        .distinct(),
        "items",
    )
    # At most span - 1 numbers.
    short = sorted(r[0] for r in items.filter(f"size(w) < {rule.span}").selectExpr("size(w)").distinct().collect())
    sizes = sorted({rule.gram, *short})
    windows = [(rule.gram, rule.window, rule.span), *((k, 1, k) for k in short)]

    item_windows = scratch.save(
        items.selectExpr("item_id", "w", f"least(size(w), {rule.span}) AS span")
        .selectExpr("item_id", "span", "explode(transform(sequence(0, size(w) - span), i -> array_join(slice(w, i + 1, span), ' '))) AS gram")
        .distinct(),
        "item-windows",
    )
    item_prints = scratch.save(
        _with_grams(items, sizes)
        .withColumn("span", F.expr(f"least(size(w), {rule.span})"))
        .withColumn(
            "kept",
            F.expr(
                f"CASE WHEN span = {rule.span} THEN {_least(f'g{rule.gram}', rule.window)} "
                + " ".join(f"WHEN span = {k} THEN {_least(f'g{k}', 1)}" for k in short)
                + " END"
            ),
        )
        # explode() would let Spark infer a filter on the array's size, which computes all its parts once for each word.
        .select("span", F.explode_outer("kept").alias("print"))
        .filter("print IS NOT NULL")
        .distinct(),
        "item-prints",
    )

    texts = documents.selectExpr("cast(doc_id AS bigint) AS doc_id", "cast(text AS string) AS text").selectExpr(
        "doc_id", "coalesce(xxhash64(text), 0) AS digest", "text"
    )
    split = texts.selectExpr("doc_id", "digest", f"{words('text')} AS w")
    prints = "concat(" + ", ".join(_least(f"g{k}", window) for k, window, _ in windows) + ")"
    marked = scratch.save(
        _with_grams(split, sizes)
        .selectExpr("doc_id", "digest", "cast(size(w) AS bigint) AS n_words", f"explode_outer({prints}) AS print")
        .join(item_prints.select("print", F.lit(1).alias("found")).distinct(), "print", "left")
        .groupBy("doc_id", "digest", "n_words")
        .agg(F.max("found").alias("found")),
        "marked",
    )
    # A table of its own has a known size, by which Spark chooses the join.
    wanted = scratch.save(marked.filter("found = 1").select("doc_id", "digest"), "wanted")
    candidates = scratch.save(
        split.alias("d").join(wanted.alias("c"), _same("d", "c", "doc_id"), "left_semi"), "candidates"
    )
    placed = ", ".join(_placed(f"g{k}", window, span) for k, window, span in windows)
    places = (
        _with_grams(candidates, sizes)
        .select("doc_id", "digest", F.explode_outer(F.expr(f"concat({placed})")).alias("kept"))
        .filter("kept IS NOT NULL")
        .selectExpr("doc_id", "digest", "kept.print AS print", "kept.span AS span", "-kept.back AS at")
        .join(item_prints, ["print", "span"], "left_semi")
        # The places of one document, at most as many as it has words.
        .groupBy("doc_id", "digest", "span")
        .agg(F.collect_set("at").alias("places"))
    )
    around = (
        f"CASE WHEN span = {rule.span} THEN sequence(greatest(at - {rule.window - 1}, 0), least(at, size(w) - span))"
        " ELSE array(at) END"
    )
    extended = scratch.save(
        places.alias("p")
        .join(candidates.distinct().alias("d"), _same("p", "d", "doc_id"))
        .selectExpr("p.doc_id", "p.digest", "span", "w", f"array_distinct(flatten(transform(places, at -> {around}))) AS starts")
        .selectExpr(
            "doc_id", "digest", "span",
            "explode(transform(starts, s -> struct(s AS at, array_join(slice(w, s + 1, span), ' ') AS gram))) AS start",
        )
        .selectExpr("doc_id", "digest", "span", "start.at AS at", "start.gram AS gram")
        .join(item_windows.select("span", "gram").distinct(), ["span", "gram"], "left_semi"),
        "extended",
    )
    hit_words = (
        extended.selectExpr("doc_id", "digest", "explode(sequence(at, at + span - 1)) AS at")
        .distinct()
        .groupBy("doc_id", "digest")
        .agg(F.count("*").alias("n_hit"))
    )
    hit_items = (
        extended.select("doc_id", "digest", "span", "gram")
        .distinct()
        .join(item_windows, ["span", "gram"])
        .groupBy("doc_id", "digest")
        .agg(F.array_sort(F.collect_set("item_id")).alias("hit_items"))
    )
    hits = (
        hit_words.alias("h")
        .join(hit_items.alias("i"), _same("h", "i", "doc_id"), "left")
        .select("h.doc_id", "h.digest", "n_hit", "hit_items")
    )
    judged = (
        marked.alias("m")
        .join(hits.alias("h"), _same("m", "h", "doc_id"), "left")
        .selectExpr(
            "m.doc_id",
            "m.digest",
            "m.n_words",
            "coalesce(n_hit, 0L) AS n_hit",
            "cast(coalesce(size(hit_items), 0) AS bigint) AS n_items",
            "sha2(concat_ws(',', hit_items), 256) AS items_sha256",
        )
    )
    return (
        texts.select("doc_id", "digest")
        .alias("t")
        .join(judged.alias("j"), _same("t", "j", "doc_id"))
        .selectExpr("t.doc_id", "n_words", "n_hit", "n_items", "items_sha256", "n_hit > 0 AS contaminated", "t.digest")
    )
