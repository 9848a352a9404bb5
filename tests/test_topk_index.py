"""Norm-ordered blocks and the two-way kernel."""

import numpy as np
import pytest

from conftest import SF01
from hourglass.operators import ALSConfig, fit_als, recommend_for_items, recommend_for_users
from hourglass.operators import topk
from hourglass.operators.topk import norm_index, pack, top_k_by_dot, top_k_visits, two_way_top_k
from hourglass.sources import embedding_factors

SCHEMA = "id int, features array<double>"


def brute(q, c, k):
    out = []
    for i, x in q:
        s = sorted(((-float(np.dot(x, y)), j) for j, y in c))[:k]
        out += [(i, r, j, round(-v, 9)) for r, (v, j) in enumerate(s, 1)]
    return sorted(out)


def rows(df):
    return sorted((r[0], r[1], r[2], round(r[3], 9)) for r in df.collect())


@pytest.fixture(scope="module")
def tables(spark):
    rng = np.random.default_rng(2)
    # norms that fall off fast, ties, zero vectors, negative scores only
    c = [(i, (rng.normal(size=4) * 10.0 / (1 + i)).round(3).tolist()) for i in range(500)] + [(1000 + i, [1.0, 0.0, 0.0, 0.0]) for i in range(40)] + [(2000, [0.0] * 4)]
    q = [(i, rng.normal(size=4).round(3).tolist()) for i in range(60)] + [(100, [0.0] * 4), (101, [-50.0, 0.0, 0.0, 0.0])]
    return q, c, spark.createDataFrame(q, SCHEMA).repartition(3), spark.createDataFrame(c, SCHEMA).repartition(5)


def test_index_is_ordered_by_norm(tables):
    got = norm_index(tables[3], 50).collect()
    by_block = {}
    for r in got:
        by_block.setdefault(r["block"], []).append(r["norm"])
    assert len(got) == len(tables[1]) and max(map(len, by_block.values())) <= 50
    order = sorted(by_block)
    assert all(min(by_block[a]) >= max(by_block[b]) for a, b in zip(order, order[1:]))


@pytest.mark.parametrize("block_rows", [7, 50, 4096])
def test_pruned_search_is_exact(tables, block_rows, monkeypatch):
    q, c, qs, cs = tables
    monkeypatch.setattr(topk, "GROUP_LEAST", 10)
    assert rows(top_k_by_dot(qs, cs, 5, block_rows=block_rows)) == brute(q, c, 5)


def test_blocks_below_the_bound_are_not_visited(tables, spark):
    q, c, qs, cs = tables
    some = [r for r in q if r[0] < 60]
    found, report = top_k_visits(spark.createDataFrame(some, SCHEMA), cs, 3, block_rows=20)
    r = report.first()
    assert rows(found) == brute(some, c, 3)
    assert r["pairs"] == r["groups"] * r["blocks"] and r["visited"] < 0.5 * r["pairs"]
    assert 0 < r["products"] < 0.5 * len(some) * len(c)


def test_tasks_never_exceed_the_sessions_partitions(spark, tables, monkeypatch):
    _, _, qs, cs = tables
    monkeypatch.setattr(topk, "GROUP_ROWS", 3)  # many groups
    seen = []
    real = topk._meet
    monkeypatch.setattr(topk, "_meet", lambda *a, **b: seen.append(real(*a, **b)) or seen[-1])
    q, c = tables[:2]
    assert rows(top_k_by_dot(qs, cs, 4, block_rows=9)) == brute(q, c, 4)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert seen and all(s.rdd.getNumPartitions() <= n for s in seen)


def test_rows_sent_grow_with_the_tables_not_with_their_product(tables, spark, monkeypatch):
    monkeypatch.setattr(topk, "GROUP_LEAST", 1)
    q, c, qs, cs = tables
    sent = {}

    def meet(left, right, k, groups, slices=1, both=False):
        sent[size] = sent.get(size, 0) + left.count() * slices + right.count()
        return real_meet(left, right, k, groups, slices, both)

    real_meet = topk._meet
    monkeypatch.setattr(topk, "_meet", meet)
    many = lambda df, n: df.crossJoin(spark.range(n).withColumnRenamed("id", "t")).select((topk.F.col("id") + topk.F.col("t") * 10_000).cast("int").alias("id"), "features")
    for size in (1, 4, 16):
        two_way_top_k(many(qs, size), many(cs, size), 3)
    assert sent[4] <= 4.5 * sent[1] and sent[16] <= 4.5 * sent[4]


def test_cells_are_even_and_bounded():
    for n, m, tasks in ((2051, 8205, 200), (20_512, 82_048, 200), (123_000, 492_000, 200), (123_000, 492_000, 24), (10**6, 300, 64), (300, 10**6, 64), (5, 0, 8)):
        groups, slices = topk._cells(n, m, tasks)
        assert groups * slices <= max(tasks, -(-n // topk.GROUP_ROWS)) and n <= groups * topk.GROUP_ROWS
        assert n * slices + m * groups <= 4 * (n * m * tasks) ** 0.5 + 4 * (n + m)


@pytest.mark.parametrize("density", [0.001, 0.5])
def test_few_or_many_contenders_merge_alike(density):
    rng = np.random.default_rng(5)
    k, n, width = 4, 30, 200
    scores = np.sort(rng.integers(90, 99, (n, k)).astype(float), axis=1)[:, ::-1]
    ids = np.argsort(scores * 0, axis=1, kind="stable") + 1000 * np.arange(1, k + 1)
    new = np.where(rng.random((n, width)) < density, rng.integers(90, 99, (n, width)), 0).astype(float)
    got, at = topk._merged(scores, ids, new, np.arange(width), k)
    for r in range(n):
        best = sorted([(-s, i) for s, i in zip(scores[r], ids[r])] + [(-s, i) for i, s in enumerate(new[r])])[:k]
        assert [(-s, i) for s, i in zip(got[r], at[r])] == best


def test_two_ways_equal_two_searches(tables, monkeypatch):
    q, c, qs, cs = tables
    monkeypatch.setattr(topk, "GROUP_LEAST", 8)
    users, items = two_way_top_k(qs, cs, 4)
    assert rows(users) == brute(q, c, 4) and rows(items) == brute(c, q, 4)


def test_two_ways_equal_both_mllib_lists(spark):
    from hourglass.plans.workflow import name_recommendations, prepare
    from hourglass.sources import events_interactions

    p = prepare(events_interactions(spark, SF01), behavior="view")
    m = fit_als(p.train, ALSConfig(rank=6, max_iter=3, num_blocks=2))
    by_user, by_item = two_way_top_k(m.userFactors, m.itemFactors, 5)
    for ours, theirs, key in ((pack(by_user), recommend_for_users(m, 5), "user"), (pack(by_item, "item", "user"), recommend_for_items(m, 5), "item")):
        a, b = ({r[key]: [x["rating"] for x in r["recommendations"]] for r in df.collect()} for df in (ours, theirs))
        assert a.keys() == b.keys()
        assert all(a[i] == pytest.approx(b[i], abs=1e-4) for i in a)
    users, items = name_recommendations(p, m, 5)
    assert users.count() == 5 * m.userFactors.count() and items.count() == 5 * m.itemFactors.count()


def test_empty_sides_and_bad_rows(spark):
    uf, itf = embedding_factors(spark, SF01)
    for a, b in ((uf.limit(0), itf), (uf, itf.limit(0))):
        assert [x.count() for x in two_way_top_k(a, b, 3)] == [0, 0]
        assert top_k_by_dot(a, b, 3).count() == 0
    bad = spark.createDataFrame([(1, None), (None, [1.0]), (2, [float("nan")]), (3, [float("inf")]), (4, [2.0])], SCHEMA)
    assert rows(top_k_by_dot(bad, bad, 3)) == [(4, 1, 4, 4.0)]
