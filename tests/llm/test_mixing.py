from collections import defaultdict

import pytest

from twincheck.llm import mixing, queries


def mixed(documents, whole=False, **rules):
    sized = mixing.with_size(documents)
    return mixing.plan_mix(sized, mixing.source_targets(sized.select("source", "size"), **rules), whole=whole)


def plain_targets(sizes):
    """Share again and again until no source exceeds twice its size."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = dict(zip(order, [5, 2, 1] * len(order)))
    total, capped = 1.5 * sum(sizes.values()), {}
    while True:
        free = [s for s in order if s not in capped]
        left = total - sum(capped.values())
        shares = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s: 2 * sizes[s] for s in free if shares[s] > 2 * sizes[s]}
        if not over:
            return {**capped, **shares}
        capped.update(over)


def test_targets_and_taken_words(documents):
    rows = mixing.mix_summary(mixed(documents)).join(documents.select("doc_id", "source"), "doc_id").collect()
    sizes, taken, target = defaultdict(int), defaultdict(int), {}
    for r in rows:
        sizes[r["source"]] += r["size"]
        taken[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
        assert 0 <= r["taken"] <= 2 * r["size"]
    expected = plain_targets(sizes)
    for source in sizes:
        assert target[source] == pytest.approx(expected[source])
        assert abs(taken[source] - target[source]) <= 1


def test_positions_follow_the_schedule(documents):
    plan = mixed(documents)
    order = mixing.training_order(plan, ["doc_id", "source", "target", "source_size", "start"]).collect()
    positions = [r["position"] for r in order]
    assert positions == sorted(positions) and 0 <= positions[0] and positions[-1] <= 1
    sources = sorted({r["source"] for r in order})
    for r in order:
        start, end = (0.5, 1.5) if sources.index(r["source"]) % 2 == 0 else (1.5, 0.5)
        t = r["position"]
        done = start * t + (end - start) * t * t / 2
        assert done == pytest.approx((r["copy"] * r["source_size"] + r["start"]) / r["target"], abs=1e-9)


def test_whole_documents(documents):
    plan = mixed(documents, whole=True).selectExpr("*", "explode(takes) AS take").collect()
    assert all(r["take"]["words"] == r["size"] for r in plan)


def test_edge_cases(frame):
    rows = [(1, None, "a"), (2, "", "a"), (3, "x y z", "a"), (3, "x y z", "a"), (None, "q " * 50_000, None), (5, "k", "é")]
    found = mixing.mix_summary(mixed(frame(rows).withColumnRenamed("n_chars", "taken"))).collect()
    assert sorted((r["size"], r["source_size"]) for r in found) == [
        (0, 6), (0, 6), (1, 1), (3, 6), (3, 6), (50_000, 50_000)
    ]
    assert mixing.mix_summary(mixed(frame(rows[:2]))).selectExpr("sum(taken)").first()[0] == 0
    assert mixed(frame(rows).limit(0)).count() == 0


STEPS = [(0, 0), (0.25, 2), (0.25, 0), (0.5, 0), (0.5, 1), (1, 0)], [(0, 1), (0.2, 1), (0.2, 3), (1, 3)]


def area(schedule, t):
    """The integral of a schedule up to ``t``, by adding up thin slices of each piece."""
    total = 0.0
    for (a, f), (b, g) in zip(schedule, schedule[1:]):
        until = min(b, t)
        if until > a:
            total += (until - a) * (f + f + (g - f) * (until - a) / (b - a)) / 2
    return total


def test_schedules_of_several_pieces_are_integrated_and_inverted(documents):
    plan = mixed(documents, schedules=STEPS, cap=1000)
    order = mixing.training_order(plan, ["doc_id", "source", "target", "source_size", "start"]).collect()
    positions = [r["position"] for r in order]
    assert positions == sorted(positions) and 0 <= positions[0] and positions[-1] <= 1
    sources = sorted({r["source"] for r in plan.select("source").distinct().collect()})
    assert not any(0.25 + 1e-9 < r["position"] < 0.5 - 1e-9 for r in order if r["source"] in sources[::2])
    whole, weight, target = {}, {}, {}
    for i, source in enumerate(sources):
        weight[source] = [5, 2, 1][i % 3] * area(STEPS[i % 2], 1)
        whole[source] = STEPS[i % 2]
    for r in order:
        target[r["source"]] = r["target"]
        part = area(whole[r["source"]], r["position"]) / area(whole[r["source"]], 1)
        assert part == pytest.approx((r["copy"] * r["source_size"] + r["start"]) / r["target"], abs=1e-7)
    shares = {target[s] / weight[s] for s in target}
    assert max(shares) == pytest.approx(min(shares))


@pytest.mark.parametrize("schedule", [[(0, 1)], [(0, 1), (0.5, 1)], [(0, 0), (1, 0)], [(0, -1), (1, 4)]])
def test_schedules_that_are_none(schedule):
    with pytest.raises(ValueError):
        mixing.integrated(schedule)


def test_the_queries_go_through_the_training_order(spark, sf_dir):
    order = queries.QUERIES["mixing_positions"](spark, sf_dir).collect()
    taken = [r for r in order if r["position"] is not None]
    positions = [r["position"] for r in taken]
    assert len(set(positions)) > 100 and sorted(positions) == positions and positions[-1] <= 1
    rows = queries.QUERIES["op6_mixing_curriculum"](spark, sf_dir).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted({r["doc_id"] for r in order})
    words = defaultdict(int)
    for r in taken:
        words[r["doc_id"]] += r["words"]
    assert {r["doc_id"]: r["taken"] for r in rows if r["taken"]} == {k: v for k, v in words.items() if v}
