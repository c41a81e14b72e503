import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from twincheck.llm import divergence

ROWS = "doc_id long, text string, lang string, source string"


def plain(rows, least=10, top=10):
    """(lang, source, part, item, value, rank) by the definition, one term at a time."""
    table = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    uses, docs, groups = defaultdict(Counter), defaultdict(Counter), set()
    for _, text, lang, source in rows:
        lang, source = lang or "", source or ""
        terms = [t.translate(table) for t in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text or "")]
        groups.add((lang, source))
        uses[lang, source].update(terms)
        docs[lang].update(set(terms))
    out = []
    for lang in {g[0] for g in groups}:
        kept = [t for t, n in docs[lang].items() if n >= least]
        sources = sorted(s for x, s in groups if x == lang)
        whole = Counter()
        for s in sources:
            whole.update(uses[lang, s])

        def price(counts):
            n = sum(counts[t] for t in kept) + 2 * len(kept)
            return {t: 1 + 10**9 * (counts[t] + 2) // n for t in kept}

        q = price(whole)
        p = {s: price(uses[lang, s]) for s in sources}
        for s in sources:
            pairs = [
                (o, sum((p[s][t] - p[o][t]) ** 2 // (p[s][t] + p[o][t]) for t in kept)) for o in sources if o != s
            ]
            terms = [
                (t, (p[s][t] - q[t]) ** 2 // (p[s][t] + q[t])) for t in kept if uses[lang, s][t] and p[s][t] > q[t]
            ]
            for part, items, most in (("pair", pairs, None), ("term", terms, top)):
                items.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, i, v, r) for r, (i, v) in enumerate(items[:most], 1)]
    return sorted(out)


def audited(spark, rows, **rules):
    return sorted(tuple(r) for r in divergence.audit_sources(spark.createDataFrame(rows, ROWS), **rules).collect())


def test_documents(spark, documents):
    rows = [tuple(r) for r in documents.select("doc_id", "text", "lang", "source").collect()]
    assert audited(spark, rows) == plain(rows)


def test_edge_cases(spark):
    rows = [(i, f"Aa b1b Ünï_{'x' * (i % 3)} aa", "l", f"s{i % 4}") for i in range(40)]
    rows += [(1, None, None, None), (1, "", "", "a"), (None, "zz " * 30_000, "l", "s9"), (7, "é É", "m", "only")]
    rows += [(5, "aa b", "l", "ä")] * 12 + [(6, "12 .", "l", "𝄞"), (6, "12 .", "l", "")]
    assert audited(spark, rows, least_docs=2, top=2) == plain(rows, 2, 2)
    found = audited(spark, rows)
    assert found == plain(rows) and ("", "", "pair", "a", 0, 1) in found
    assert not [r for r in found if r[0] == "m"]
    assert audited(spark, []) == []


def test_other_columns_are_ignored(spark):
    rows = [(i, "a b c"[: i % 6], "l", f"s{i % 3}") for i in range(60)]
    frame = spark.createDataFrame(rows, ROWS).selectExpr("*", "doc_id AS term", "'x' AS part", "1 AS value", "2 AS rank")
    assert sorted(tuple(r) for r in divergence.audit_sources(frame).collect()) == plain(rows)


def test_many_groups_and_blocks(spark, monkeypatch):
    rows = [(i, " ".join(chr(97 + (i * k) % 26) * (1 + k % 3) for k in range(i % 40)), "l", f"s{i % 23}") for i in range(400)]
    expected = plain(rows)
    monkeypatch.setattr(divergence, "BLOCK_TERMS", 7)
    monkeypatch.setattr(divergence, "BLOCK_GROUPS", 4)
    assert audited(spark, rows) == expected


def test_counters_are_handed_on_in_parts(spark, monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(divergence, "HELD_COUNTERS", 3)
    batch = pa.RecordBatch.from_pydict({"lang": ["l"] * 6, "source": ["s"] * 6, "text": [b"a b c", b"a", b"d e f", b"", b"a A", b"g"]})
    uses, docs = Counter(), Counter()
    parts = list(divergence._counted(iter([batch])))
    assert len(parts) > 1
    for part in parts:
        for row in part.to_pylist():
            uses[row["term"]] += row["uses"]
            docs[row["term"]] += row["docs"]
    assert uses["a"] == 4 and docs["a"] == 3 and uses["g"] == docs["g"] == 1


@pytest.mark.parametrize("columns", [1, 5, 50, 10_000])
def test_joint_tables_count_every_term_once(monkeypatch, columns):
    monkeypatch.setattr(divergence, "MATRIX_COLUMNS", columns)
    prices = np.random.default_rng(3).integers(1, 9, (60, 5)) ** 3
    seen = Counter()
    for a, p, b, q, n in divergence.joint_tables(prices):
        for key, times in zip(zip(a.tolist(), p.tolist(), b.tolist(), q.tolist()), n.tolist()):
            seen[key] += times
    expected = Counter(
        (a, int(row[a]), b, int(row[b])) for row in prices for a in range(5) for b in range(a + 1, 5)
    )
    assert seen == expected
