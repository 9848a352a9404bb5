"""The certificate against numpy, and what it must refuse."""

import dataclasses

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF01
from hourglass.operators import ALSConfig, fit_als
from hourglass.operators.certificate import certificate, gramian, residuals
from hourglass.plans.workflow import prepare
from hourglass.sources import events_interactions


@pytest.fixture(scope="module")
def train(spark):
    return prepare(events_interactions(spark, SF01), behavior="view").train.persist()


@pytest.mark.parametrize("config", [ALSConfig(rank=6, max_iter=3, num_blocks=2), ALSConfig(rank=5, max_iter=2, alpha=8.0, reg_param=0.01, num_blocks=3), ALSConfig(rank=4, max_iter=2, implicit=False, num_blocks=2)])
def test_fits_are_certified(train, config):
    row = certificate(fit_als(train, config), train, config).first()
    assert row["certified"] and row["worst"] < 1e-5
    assert row["n_ratings"] == train.count() and row["n_users"] == train.select("user").distinct().count()


def test_other_factors_or_data_are_refused(spark, train):
    config = ALSConfig(rank=6, max_iter=2, num_blocks=2)
    m = fit_als(train, config)
    for other in (dataclasses.replace(config, reg_param=0.5), dataclasses.replace(config, alpha=2.0)):
        assert not certificate(m, train, other).first()["certified"]
    assert not certificate(m, train.where("item > 0"), config).first()["certified"]  # ratings missing
    assert not certificate(m, train.withColumn("rating", F.col("rating") * 2), config).first()["certified"]
    assert not certificate(m, train.unionByName(train.limit(1).withColumn("item", F.lit(10**6))), config).first()["certified"]  # no such item
    moved = m.userFactors.withColumn("features", F.transform("features", lambda x: x + F.when(F.col("id") == 3, 0.01).otherwise(0.0)))
    worst = {r["user"]: r["residual"] for r in residuals(moved, m.itemFactors, train, config).collect()}
    assert [u for u, v in worst.items() if v > 1e-5] == [3]
    with pytest.raises(ValueError, match="nonnegative"):
        certificate(m, train, dataclasses.replace(config, nonnegative=True))


def test_residuals_equal_numpy(spark):
    rng = np.random.default_rng(1)
    k, x, y = 3, rng.normal(size=(4, 3)).astype(np.float32), rng.normal(size=(6, 3)).astype(np.float32)
    rows = [(u, i, r) for u, i, r in [(0, 1, 2.0), (0, 1, 3.0), (0, 2, -1.0), (1, 0, 0.0), (2, 5, 4.0), (2, 4, 1.0)]]
    frame = lambda m: spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(m)], "id int, features array<float>")
    ratings = spark.createDataFrame(rows, "user int, item int, rating double").repartition(3)
    config = ALSConfig(rank=k, alpha=1.5, reg_param=0.2)
    got = {r["user"]: r["residual"] for r in residuals(frame(x), frame(y), ratings, config).collect()}
    x, y = x.astype(float), y.astype(float)
    g = y.T @ y
    assert np.allclose(gramian(frame(y), k), g)
    for u in (0, 1, 2):
        own = [(i, r) for v, i, r in rows if v == u]
        a, b = g.copy(), np.zeros(k)
        size, liked = 0.0, 0
        for i, r in own:
            c = 1.5 * abs(r)
            a += c * np.outer(y[i], y[i])
            b += ((1 + c) if r > 0 else 0) * y[i]
            liked += r > 0
            size += (c * abs(x[u] @ y[i]) + ((1 + c) if r > 0 else 0)) * np.linalg.norm(y[i])
        a += 0.2 * liked * np.eye(k)
        scale = size + np.linalg.norm(g @ x[u]) + 0.2 * liked * np.linalg.norm(x[u])
        assert got[u] == pytest.approx(np.linalg.norm(a @ x[u] - b) / scale, rel=1e-6)
    assert set(got) == {0, 1, 2}


def test_a_user_with_a_third_of_all_ratings(spark):
    rows = [(0, i, 1.0 + i % 3) for i in range(300)] + [(1 + i % 50, i % 300, 1.0) for i in range(600)]
    train = spark.createDataFrame(rows, "user int, item int, rating double").repartition(7)
    config = ALSConfig(rank=4, max_iter=2, num_blocks=2)
    assert certificate(fit_als(train, config), train, config).first()["certified"]
