from __future__ import annotations

import pytest

from ledgerloom.llm import mixing


def brute_targets(sizes, cycle=(1, 2, 3), most=3):
    """The rule as stated: share by weight, stop at ``most`` times the size, share the excess again."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: cycle[k % len(cycle)] for k, s in enumerate(order)}
    target = {s: 0.0 for s in order}
    free, left = set(order), float(sum(sizes.values()))
    while free and left > 1e-9:
        share = left / sum(weight[s] for s in free)
        over = {s for s in free if target[s] + weight[s] * share >= most * sizes[s]}
        if not over:
            for s in free:
                target[s] += weight[s] * share
            break
        # those that stop take what they can; the rest of everything is shared anew
        for s in over:
            target[s] = float(most * sizes[s])
        free -= over
        left = sum(sizes.values()) - sum(target[s] for s in order if s not in free)
    return target


@pytest.mark.parametrize(
    "sizes",
    [
        {"a": 100, "b": 100, "c": 100},
        {"a": 1000, "b": 10, "c": 5, "d": 700, None: 40},
        {"a": 0, "b": 0},
        {"a": 0, "b": 7, "c": 1},
        {"z": 1, "é": 2, "A": 500, None: 3},
    ],
)
def test_targets(spark, sizes):
    rows = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    found = {row["source"]: row["target"] for row in mixing.targets(rows).collect()}
    assert found == pytest.approx(brute_targets(sizes))


def test_plan_takes_whole_copies_and_agrees_with_itself(documents):
    rows = [(k, "w " * (k % 7 + 1), "abc"[k % 3]) for k in range(600)]
    plan = mixing.plan(documents(rows)).collect()
    again = mixing.plan(documents(rows).repartition(5)).collect()
    assert sorted(plan) == sorted(again)
    for row in plan:
        rate = row["target"] / row["source_size"]
        assert row["copies"] in (int(rate), int(rate) + 1) and row["copies"] <= 3
    for source in "abc":
        mine = [row for row in plan if row["source"] == source]
        assert sum(r["size"] * r["copies"] for r in mine) == pytest.approx(mine[0]["target"], rel=0.15)


def test_edges(documents, clashing, spark):
    rows = [(1, None, "a"), (None, "x y", None), (None, "z", None), (2, "", "a"), (2, "", "a"), (3, "\x0b \t", "b"), (4, "q " * 50, "c")]
    docs = clashing(documents(rows))
    plan = mixing.plan(docs).collect()
    assert len(plan) == len(rows) and sum(row["size"] for row in plan) == 53
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    assert mixed.count() == sum(row["copies"] for row in plan)
    assert mixing.mix(documents([])).count() == 0


def test_no_python_on_the_way(documents):
    plan = mixing.plan(documents([(1, "a", "s")]))._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))
