"""Bitmap counts, posting lists, the keyed permutation and bucketed scoring."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF001, SF01
from hourglass.functions.permutation import grid, permuted
from hourglass.operators import bitmaps, colocated, postings
from hourglass.operators.model import score_with_factors
from hourglass.plans.workflow import prepare
from hourglass.sources import embedding_factors, events_interactions


def test_bitmaps_count_and_merge(spark):
    rnd = random.Random(2)
    rows = [(rnd.choice(["a", "b", None]), rnd.choice([None, 0, 1, 5, 32767, 32768, 32769, 70_000, rnd.randrange(200_000)])) for _ in range(4000)]
    df = spark.createDataFrame(rows, "k string, id int").repartition(5)
    want = {k: len({i for x, i in rows if x == k and i is not None}) for k in ("a", "b", None)}
    maps = bitmaps.distinct_bitmaps(df, "id", ("k",))
    assert {r["k"]: r["n"] for r in bitmaps.bitmap_counts(maps, ("k",)).collect()} == want
    halves = [bitmaps.distinct_bitmaps(df.where(c), "id", ("k",)) for c in ("id % 2 = 0", "id % 3 = 0 or id % 2 = 1")]
    merged = bitmaps.merge_bitmaps(*halves, keys=("k",))
    assert {r["k"]: r["n"] for r in bitmaps.bitmap_counts(merged, ("k",)).collect()} == want
    assert bitmaps.bitmap_counts(bitmaps.merge_bitmaps(maps)).first()["n"] == len({i for _, i in rows if i is not None})
    assert bitmaps.bitmap_counts(bitmaps.distinct_bitmaps(df.limit(0), "id")).count() == 0


def test_cardinalities_by_counts_null_behaviour(spark):
    rows = [(1, "x", "play"), (1, "y", "play"), (2, None, "play"), (None, "x", None), (3, "x", None)]
    df = spark.createDataFrame(rows, "user_id long, game string, behavior string")
    got = {r["behavior"]: tuple(r)[1:] for r in bitmaps.cardinalities_by(df).collect()}
    assert got == {"play": (3, 2, 2), None: (2, 1, 1)}


def test_posting_lists_of_a_hot_user(spark):
    rnd = random.Random(3)
    pairs = [(0, rnd.randrange(5000)) for _ in range(6000)] + [(rnd.randrange(1, 300), rnd.randrange(50)) for _ in range(6000)] + [(None, 1), (1, None)]
    df = spark.createDataFrame(pairs, "user int, item int").repartition(6)
    own = {}
    for u, i in pairs:
        if u is not None and i is not None:
            own.setdefault(u, set()).add(i)
    for size in (1000, 7):
        lists = postings.posting_lists(df, size=size)
        got = {}
        for r in lists.collect():
            got.setdefault(r["user"], {})[r["chunk"]] = r["items"]
        for u, items in own.items():
            s = sorted(items)
            assert got[u] == {c: s[c * size:(c + 1) * size] for c in range(-(-len(s) // size))}
        assert set(got) == set(own)
    assert {r["user"]: r["n"] for r in postings.sizes(lists).collect()} == {u: len(s) for u, s in own.items()}
    half = postings.posting_lists(df.where("item % 2 = 0"), size=11)
    assert {r["user"]: r["n"] for r in postings.shared(lists, half).collect()} == {u: n for u, s in own.items() if (n := sum(i % 2 == 0 for i in s))}
    assert postings.posting_lists(df.limit(0)).count() == 0


@pytest.mark.parametrize("n", [1, 2, 3, 7, 64, 101, 1009])
def test_every_key_permutes_all_numbers(spark, n):
    a, b = grid(n)
    assert a * b >= n
    df = spark.range(6).select(F.col("id").alias("key")).withColumn("place", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
    got = {}
    for r in df.select("key", "place", permuted(F.col("place"), F.col("key"), n, "s").alias("x")).collect():
        got.setdefault(r["key"], []).append((r["place"], r["x"]))
    orders = [[x for _, x in sorted(v)] for v in got.values()]
    assert all(sorted(o) == list(range(n)) for o in orders)
    if n > 60:
        assert len({tuple(o) for o in orders}) == 6


def test_places_are_independent(spark):
    n, keys = 20, 4000
    df = spark.range(keys).select(permuted(F.lit(0), F.col("id"), n, 1).alias("x"), permuted(F.lit(1), F.col("id"), n, 1).alias("y"))
    pairs = Counter((r["x"], r["y"]) for r in df.collect())
    # each ordered pair of different numbers is equally likely
    want = keys / (n * (n - 1))
    chi = sum((pairs.get((x, y), 0) - want) ** 2 / want for x in range(n) for y in range(n) if x != y)
    free = n * (n - 1) - 1
    assert all(x != y for x, y in pairs) and chi < free + 5 * np.sqrt(2 * free)


def test_bucketed_scoring_leaves_the_test_rows_in_place(spark):
    p = prepare(events_interactions(spark, SF01), behavior="view")
    uf, itf = embedding_factors(spark, SF01)
    test = colocated.bucketed(p.test)
    for cold in (False, True):
        ours = colocated.score_bucketed(test, uf, itf, cold)
        key = lambda r: (r["user"], r["item"], r["rating"], str(r["prediction"]))
        assert sorted(map(key, ours.collect())) == sorted(map(key, score_with_factors(p.test, uf, itf, keep_cold=cold).collect()))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = colocated.score_bucketed(test, uf, itf, n_items=400, rank=64)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    shuffled = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert len(shuffled) == 1 and "SortMergeJoin" in plan  # the user factors alone
    # the scan of the bucketed rows reaches the join without an exchange
    after = plan[plan.index("SortMergeJoin"):]
    assert after.index("Bucketed: true") < after.index("Exchange hashpartitioning")


def test_predictions_of_a_model_from_buckets(spark):
    from hourglass.operators import ALSConfig, fit_als, predict

    p = prepare(events_interactions(spark, SF001), behavior="view")
    m = fit_als(p.train, ALSConfig(rank=4, max_iter=2, num_blocks=1))
    ours = {(r["user"], r["item"], r["rating"]): r["prediction"] for r in colocated.predict_bucketed(m, colocated.bucketed(p.test)).collect()}
    theirs = {(r["user"], r["item"], r["rating"]): r["prediction"] for r in predict(m, p.test).collect()}
    assert ours.keys() == theirs.keys() and all(abs(ours[k] - theirs[k]) < 1e-5 for k in ours)
