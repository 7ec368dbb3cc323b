import random
from collections import deque

import pytest
from millrace.operators import links
from pyspark.sql import functions as F


def totals(parents, flow):
    out = dict(flow)
    for g in parents:
        p = parents[g]
        while p in flow:
            out[p] += flow[g]
            p = parents[p]
    return out


@pytest.mark.parametrize("shape", ["chain", "random", "star"])
def test_totals_equal_a_walk_up(spark, shape):
    rng = random.Random(3)
    n = 300
    parents = {i: {"chain": i - 1 if i else None, "random": rng.randrange(i) if i else None, "star": 0 if i else None}[shape] for i in range(n)}
    parents[n] = 999_999  # its parent is no group
    flow = {i: rng.randrange(100) for i in parents}
    df = spark.createDataFrame([(i, p, flow[i], flow[i] / 2) for i, p in parents.items()], "id long, parent long, f long, g double")
    out = links.group_status(df, "id", "parent", ["f", "g"]).collect()
    assert {r.id: r.total_f for r in out} == totals(parents, flow) and all(r.total_g == r.total_f / 2 for r in out)


def test_depth_limits_and_cycles(spark):
    chain = spark.range(20).select(F.col("id"), F.when(F.col("id") > 0, F.col("id") - 1).alias("p"), F.lit(1).alias("f"))
    assert links.group_status(chain, "id", "p", ["f"], 19).agg(F.max("total_f")).first()[0] == 20
    for depth in (18, 15, 3, 0):
        with pytest.raises(RuntimeError):
            links.group_status(chain, "id", "p", ["f"], depth)
    assert links.group_status(chain.limit(0), "id", "p", ["f"]).count() == 0
    for ring in ([(1, 2), (2, 3), (3, 1)], [(1, 1)], [(1, 2), (2, 1), (3, None), (4, 3)]):
        with pytest.raises(ValueError):
            links.group_status(spark.createDataFrame([(a, b, 1) for a, b in ring], "id long, p long, f int"), "id", "p", ["f"])


def steps(edges, start):
    near, seen, todo = {}, dict.fromkeys(start, 0), deque(start)
    for a, b in edges:
        near.setdefault(a, set()).add(b)
        near.setdefault(b, set()).add(a)
    while todo:
        x = todo.popleft()
        for y in near.get(x, ()):
            if y not in seen:
                seen[y] = seen[x] + 1
                todo.append(y)
    return seen


def graphs():
    rng = random.Random(8)
    yield "chain", [(i, i + 1) for i in range(200)], [90]
    yield "ring and tail", [(i, (i + 1) % 60) for i in range(60)] + [(30, 100)] + [(i, i + 1) for i in range(100, 140)], [0]
    yield "caterpillar", [(i, i + 1) for i in range(100)] + [(i, 1000 + i) for i in range(0, 100, 2)] + [(1000 + i, 2000 + i) for i in range(0, 100, 4)], [0, 60]
    yield "tree", [(i, rng.randrange(max(0, i - 4), i)) for i in range(1, 250)], [0]
    yield "ladder", [(i, i + 2) for i in range(120)] + [(i, i + 1) for i in range(0, 120, 8)], [1]
    yield "apart", [(i, i + 1) for i in range(40)] + [(100 + i, 100 + (i + 1) % 30) for i in range(30)], [0]
    yield "loops and repeats", [(1, 1), (1, 2), (2, 1), (1, 2)], [1, 7]


@pytest.mark.parametrize("name,edges,start", list(graphs()), ids=lambda x: x if isinstance(x, str) else "")
def test_distances_equal_single_steps(spark, monkeypatch, name, edges, start):
    monkeypatch.setattr(links, "NEAR_STEPS", 3)
    df, first = spark.createDataFrame(edges, "parent long, child long"), spark.createDataFrame([(s,) for s in start], "x long")
    want = steps(edges, start)
    got = links.lineage(df, first).collect()
    assert len(got) == len(want) and {r.item: r.depth for r in got} == want
    if max(want.values()) > 4:
        with pytest.raises(RuntimeError):
            links.lineage(df, first, most_depth=max(want.values()) - 1)


def test_a_chain_of_50_000_takes_few_rounds(spark, monkeypatch):
    made = []
    monkeypatch.setattr(links, "written", lambda df, label, w=links.written: made.append(label) or w(df, label))
    chain = spark.range(50_000).select("id", F.when(F.col("id") > 0, F.col("id") - 1).alias("p"), F.lit(1).alias("f"))
    assert links.group_status(chain, "id", "p", ["f"]).agg(F.sum("total_f")).first()[0] == 50_000 * 50_001 // 2
    assert made.count("group-totals") <= 20
    made.clear()
    far = links.lineage(chain.filter("p IS NOT NULL"), spark.range(1), "p", "id").agg(F.count("*"), F.max("depth")).first()
    assert tuple(far) == (50_000, 49_999) and made.count("half-edges") + made.count("lineage") <= 20
