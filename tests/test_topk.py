import numpy as np
import pytest

from conftest import SF01
from hourglass.operators.topk import pack, top_k_by_dot
from hourglass.sources import embedding_factors


def _rows(df):
    return sorted((r[0], r[1], r[2], round(r[3], 9)) for r in df.collect())


def test_blocked_equals_single_and_brute_force(spark):
    uf, itf = embedding_factors(spark, SF01)
    one = top_k_by_dot(uf, itf, 7)
    many = top_k_by_dot(uf, itf, 7, block_rows=60)  # several blocks on both sides
    assert _rows(one) == _rows(many)
    U = {r["id"]: np.array(r["features"], dtype=np.float64) for r in uf.collect()}
    items = sorted((r["id"], np.array(r["features"], dtype=np.float64)) for r in itf.collect())
    ids = np.array([i for i, _ in items])
    M = np.stack([v for _, v in items])
    got = {}
    for u, rank, item, score in _rows(one):
        got.setdefault(u, []).append(item)
    for u, vec in U.items():
        s = M @ vec
        order = np.lexsort((ids, -s))[:7]
        assert got[u] == list(ids[order])


def test_k_larger_than_candidates_and_empty(spark):
    uf, itf = embedding_factors(spark, SF01)
    few = itf.where("id < 3")
    out = top_k_by_dot(uf, few, 10).collect()
    assert len(out) == 100 * 3
    assert top_k_by_dot(uf, itf.limit(0), 5).count() == 0


def test_pack_matches_mllib_recommend_for_all(spark):
    from hourglass.operators import ALSConfig, fit_als, recommend_for_users
    from hourglass.plans.workflow import prepare
    from hourglass.sources import events_interactions

    p = prepare(events_interactions(spark, SF01), behavior="view")
    m = fit_als(p.train, ALSConfig(rank=6, max_iter=3, num_blocks=2))
    ours = {r["user"]: r["recommendations"] for r in pack(top_k_by_dot(m.userFactors, m.itemFactors, 5)).collect()}
    theirs = {r["user"]: r["recommendations"] for r in recommend_for_users(m, 5).collect()}
    assert ours.keys() == theirs.keys()
    for u in ours:
        assert [x["rating"] for x in ours[u]] == pytest.approx([x["rating"] for x in theirs[u]], abs=1e-4)


def test_nan_null_and_boundary_ties(spark):
    schema = "id INT, features ARRAY<DOUBLE>"
    q = spark.createDataFrame([(0, [1.0, 0.0]), (1, None), (2, [float("nan"), 1.0])], schema)
    c = spark.createDataFrame(
        [(9, [2.0, 0.0]), (4, [2.0, 5.0]), (7, [2.0, 1.0]), (1, [float("nan"), 0.0]), (2, [None, 1.0]), (3, None), (5, [1.0, 1.0])], schema
    )
    for rows in (1, 2, 100):
        got = [tuple(r) for r in top_k_by_dot(q, c, 2, block_rows=rows).orderBy("user", "rank").collect()]
        assert got == [(0, 1, 4, 2.0), (0, 2, 7, 2.0)]
    assert top_k_by_dot(q, c, 10).count() == 4


def test_metrics_accept_flat_top_k(spark):
    from hourglass.operators import ranking_metrics
    from hourglass.plans.workflow import prepare
    from hourglass.sources import events_interactions

    p = prepare(events_interactions(spark, SF01), behavior="view")
    uf, itf = embedding_factors(spark, SF01)
    flat = top_k_by_dot(uf, itf, 10)
    a = {r["k"]: tuple(r)[1:] for r in ranking_metrics(flat, p.test, (5, 10)).collect()}
    b = {r["k"]: tuple(r)[1:] for r in ranking_metrics(pack(flat), p.test, (5, 10)).collect()}
    assert a.keys() == b.keys()
    for k in a:
        assert a[k][0] == b[k][0] and a[k][1:] == pytest.approx(b[k][1:], abs=1e-12)
