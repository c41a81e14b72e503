"""Audit of how far the sources of each language diverge in their terms, priced from joint tables of count levels.

A group is a (lang, source). For two groups, the joint table tells how many terms occur c times in the one and d times in
the other, for all levels (c, d). With one indicator column for each (group, level), a block of terms is a matrix of zeros
and ones, and its transpose times itself holds the joint tables of all pairs of its groups at once. A table cell is priced
once, however many terms it counts.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twincheck.llm.scratch import Scratch
from twincheck.llm.terms import term_table

SCALE = 1_000_000_000
#: Terms in a block and groups on each side of it, on average; a task holds one block.
BLOCK_TERMS = 1024
BLOCK_GROUPS = 64
#: Indicator columns of a matrix; terms are split until they have no more, or only one term is left.
MATRIX_COLUMNS = 640
#: Counters that a task holds before it hands them on.
HELD_COUNTERS = 1 << 18

_TERMS = term_table(digits=False)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, source, text as bytes) to (lang, source, term, uses, docs), and a row with null term for each group."""
    uses: dict[tuple[str, str], Counter] = {}
    docs: dict[tuple[str, str], Counter] = {}
    held = 0

    def handed_on() -> Iterator[pa.RecordBatch]:
        for group, counter in uses.items():
            terms, within = list(counter), docs[group]
            yield pa.RecordBatch.from_pydict(
                {
                    "lang": pa.array([group[0]] * (len(terms) + 1), pa.string()),
                    "source": pa.array([group[1]] * (len(terms) + 1), pa.string()),
                    "term": pa.array([None, *terms], pa.binary()).cast(pa.string()),
                    "uses": pa.array([0, *counter.values()], pa.int64()),
                    "docs": pa.array([0, *(within[t] for t in terms)], pa.int64()),
                }
            )

    for batch in batches:
        langs, sources = batch.column("lang").to_pylist(), batch.column("source").to_pylist()
        for group, text in zip(zip(langs, sources), batch.column("text")):
            terms = Counter(text.as_py().translate(_TERMS).split())
            total = uses.setdefault(group, Counter())
            held -= len(total)
            total.update(terms)
            held += len(total)
            docs.setdefault(group, Counter()).update(terms.keys())
            if held > HELD_COUNTERS:
                yield from handed_on()
                uses, docs, held = {}, {}, 0
    yield from handed_on()


def term_counts(documents: DataFrame) -> DataFrame:
    """lang, source, term, uses, docs (rows of ``documents`` that hold the term), and for each group a row of null term."""
    read = documents.selectExpr(
        "coalesce(cast(lang AS string), '') AS lang",
        "coalesce(cast(source AS string), '') AS source",
        "cast(coalesce(cast(text AS string), '') AS binary) AS text",
    )
    counted = read.mapInArrow(_counted, "lang string, source string, term string, uses long, docs long")
    return counted.groupBy("lang", "source", "term").agg(F.sum("uses").alias("uses"), F.sum("docs").alias("docs"))


def _price(count: str, total: str, terms: str) -> str:
    """SQL for the price of a count; products are decimals, so no count overflows."""
    return f"1 + (cast({SCALE} AS decimal(10, 0)) * cast({count} + 2 AS decimal(20, 0))) div ({total} + 2 * {terms})"


def _levels(prices: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One-hot matrix of (terms x groups) prices: group and price of each indicator column, and the column of each cell."""
    keys = (np.arange(prices.shape[1], dtype=np.int64) << 32) | prices
    levels, column = np.unique(keys, return_inverse=True)
    return levels >> 32, levels & 0xFFFFFFFF, column.reshape(prices.shape)


def joint_tables(prices: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    """Cells (group a, price in a, group b, price in b, terms) of the joint tables of all groups, a < b.

    Rows with large prices have many levels and are multiplied a few at a time; those of the long tail share a few levels
    and go together. A product of ones over fewer than 2**24 rows is exact in single precision.
    """
    todo = [prices[np.argsort(prices.max(axis=1), kind="stable")]] if prices.size else []
    while todo:
        block = todo.pop()
        group, price, column = _levels(block)
        if len(block) > 1 and (len(group) > MATRIX_COLUMNS or len(block) >= 1 << 24):
            todo += [block[: len(block) // 2], block[len(block) // 2 :]]
            continue
        hot = np.zeros((len(block), len(group)), dtype=np.float32)
        hot[np.arange(len(block))[:, None], column] = 1
        joint = hot.T @ hot
        a, b = np.nonzero(joint)
        of_pair = group[a] < group[b]
        a, b = a[of_pair], b[of_pair]
        yield group[a], price[a], group[b], price[b], joint[a, b].astype(np.int64)


def _price_block(table: pa.Table) -> pa.Table:
    """Rows (lang, source, side, term, p) of one block, base prices with null term, to (lang, a, b, value), a < b."""
    names = sorted(set(table.column("source").to_pylist()), key=str.encode)
    source = pa.compute.index_in(table.column("source"), pa.array(names, pa.string())).to_numpy()
    p = table.column("p").to_numpy()
    base = pa.compute.is_null(table.column("term")).to_numpy(zero_copy_only=False)
    term = table.column("term").combine_chunks().dictionary_encode()
    prices = np.empty((len(term.dictionary), len(names)), dtype=np.int64)
    sides = np.empty(len(names), dtype=np.int64)
    prices[:, source[base]] = p[base]
    sides[source[base]] = table.column("side").to_numpy()[base]
    prices[term.indices.filter(pa.array(~base)).to_numpy(), source[~base]] = p[~base]
    value = np.zeros((len(names), len(names)), dtype=np.int64)
    for a, p_a, b, p_b, terms in joint_tables(prices):
        np.add.at(value, (a, b), terms * ((p_a - p_b) ** 2 // (p_a + p_b)))
    # A block of two sides holds the pairs across them; those within a side belong to the block of that side alone.
    a, b = np.nonzero(np.triu((sides[:, None] != sides) | (len(set(sides)) == 1), 1))
    lang = table.column("lang")[0].as_py()
    return pa.table(
        {
            "lang": pa.array([lang] * len(a), pa.string()),
            "a": pa.array([names[i] for i in a], pa.string()),
            "b": pa.array([names[i] for i in b], pa.string()),
            "value": pa.array(value[a, b], pa.int64()),
        }
    )


def audit_sources(documents: DataFrame, least_docs: int = 10, top: int = 10) -> DataFrame:
    """``documents`` (text, lang, source) to lang, source, part, item, value, rank; other columns are ignored.

    A language keeps the terms that at least ``least_docs`` of its documents hold. A count is priced with two added to it,
    as a share of all, in billionths; the divergence of prices p and q is (p - q)**2 / (p + q), in whole numbers. Part
    ``pair``: each other source of the language, with the divergence summed over all kept terms. Part ``term``: the
    ``top`` kept terms of the group whose price exceeds the language's.

    Null text, lang and source are empty ones. A group without terms has pairs; a language without kept terms has pairs of
    value 0; a language of one source has none; an empty table has no rows. Repeated rows count as often as they occur.
    Ties rank by item. A text may be of any length; it is split by the one task that reads it.

    Terms are counted within tasks before the shuffle, so hot groups cost no more than others. Blocks of terms go to
    tasks by hash, and groups in sides of about 64, so no task sees all groups or all terms. The result itself has a row
    for each two sources of a language.
    """
    scratch = Scratch(documents.sparkSession, "divergence")
    counts = scratch.save(term_counts(documents), "counts")
    kept = scratch.save(
        counts.filter("term IS NOT NULL")
        .selectExpr(
            "lang", "source", "term", "uses", "sum(uses) OVER (PARTITION BY lang, term) AS lang_uses",
            "sum(docs) OVER (PARTITION BY lang, term) AS lang_docs",
        )
        .filter(f"lang_docs >= {int(least_docs)}")
        .drop("lang_docs"),
        "kept",
    )
    langs = (
        kept.groupBy("lang", "term")
        .agg(F.max("lang_uses").alias("uses"))
        .groupBy("lang")
        .agg(F.count("*").alias("terms"), F.sum("uses").alias("lang_total"))
    )
    totals = kept.groupBy("lang", "source").agg(F.sum("uses").alias("total"))
    all_groups = counts.filter("term IS NULL").select("lang", "source")
    groups = scratch.save(
        all_groups.join(totals, ["lang", "source"], "left")
        .join(langs, "lang", "left")
        .join(all_groups.groupBy("lang").agg(F.count("*").alias("sources")), "lang")
        .selectExpr(
            "lang", "source", "coalesce(total, 0L) AS total", "coalesce(terms, 0L) AS terms", "lang_total",
            f"greatest(1, cast(ceil(terms / {BLOCK_TERMS}) AS int)) AS blocks",
            f"cast(ceil(sources / {BLOCK_GROUPS}) AS int) AS sides",
        ),
        "groups",
    )
    priced = kept.join(groups, ["lang", "source"]).selectExpr(
        "lang", "source", "term", "lang_uses", "lang_total", "terms", "blocks", "sides",
        f"{_price('uses', 'total', 'terms')} AS p",
    )
    result = _term_part(priced, top).unionByName(_pair_part(priced, groups))
    return result.selectExpr("lang", "source", "part", "item", "value", "cast(rank AS int) AS rank")


_RANK = "row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS rank"


def _term_part(priced: DataFrame, top: int) -> DataFrame:
    return (
        priced.selectExpr("*", f"{_price('lang_uses', 'lang_total', 'terms')} AS q")
        .filter("p > q")
        .selectExpr("lang", "source", "'term' AS part", "term AS item", "((p - q) * (p - q)) div (p + q) AS value")
        .selectExpr("*", _RANK)
        .filter(f"rank <= {int(top)}")
    )


def _pair_part(priced: DataFrame, groups: DataFrame) -> DataFrame:
    side = "cast(pmod(xxhash64(source), sides) AS int) AS side"
    rows = priced.selectExpr(
        "lang", "source", "term", "p", "sides", side, "cast(pmod(xxhash64(term), blocks) AS int) AS block"
    )
    # Every block knows every group of its language, at the price of no occurrence.
    bases = groups.selectExpr(
        "lang", "source", "cast(NULL AS string) AS term",
        f"CASE WHEN terms = 0 THEN 0L ELSE {_price('0', 'total', 'terms')} END AS p", "sides", side,
        "explode(sequence(0, blocks - 1)) AS block",
    )
    dealt = rows.unionByName(bases).selectExpr(
        "lang", "block", "explode(sequence(0, sides - 1)) AS other", "source", "side", "term", "p"
    )
    cells = dealt.selectExpr(
        "lang", "block", "least(side, other) AS low", "greatest(side, other) AS high", "source", "side", "term", "p"
    )
    values = (
        cells.groupBy("lang", "block", "low", "high")
        .applyInArrow(_price_block, "lang string, a string, b string, value long")
        .groupBy("lang", "a", "b")
        .agg(F.sum("value").alias("value"))
    )
    both = values.selectExpr("lang", "value", "explode(array(struct(a, b), struct(b AS a, a AS b))) AS way")
    return both.selectExpr("lang", "way.a AS source", "'pair' AS part", "way.b AS item", "value").selectExpr("*", _RANK)
