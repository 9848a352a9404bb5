from hourglass.operators import best_config, leaderboard, param_grid, rank_marginals, runs_for, tradeoff_points
from hourglass.sources import runs_frame


def test_param_grid(spark):
    g = param_grid(spark).orderBy("ord").collect()
    assert len(g) == 27
    assert g[0]["run_name"] == "ALS_r10_reg0.01_iter10"
    assert g[-1]["run_name"] == "ALS_r50_reg0.5_iter20"


def _runs(spark):
    return runs_frame(
        spark,
        [
            {"run_name": "a", "model": "als", "rank": 20, "regParam": 0.1, "maxIter": 10, "rmse": 2.0, "map_at_10": 0.30, "precision_at_10": 0.1},
            {"run_name": "b", "model": "als", "rank": 10, "regParam": 0.5, "maxIter": 15, "rmse": 1.0, "map_at_10": 0.30, "precision_at_10": 0.3},
            {"run_name": "c", "model": "als", "rank": 10, "regParam": 0.01, "maxIter": 20, "rmse": 3.0, "map_at_10": 0.10, "precision_at_10": 0.2},
        ],
    )


def test_leaderboard_ties_fall_to_params(spark):
    runs = _runs(spark)
    assert [r["run_name"] for r in leaderboard(runs, 5).collect()] == ["b", "a", "c"]
    assert best_config(runs).first()["run_name"] == "b"
    marg = {(r["maxIter"], r["rank"]): r["avg_precision_at_10"] for r in rank_marginals(runs).collect()}
    assert marg[(15, 10)] == 0.3
    assert tradeoff_points(runs).count() == 3
    assert [r["run_name"] for r in runs_for(runs, rank=10).collect()] == ["b", "c"]


def test_grid_search_logs_and_resumes(spark):
    import uuid

    from conftest import SF01
    from hourglass.operators import ALSConfig, grid_search
    from hourglass.plans.workflow import prepare
    from hourglass.session import scratch_path
    from hourglass.sources import events_interactions, read_runs

    p = prepare(events_interactions(spark, SF01), behavior="view")
    log = scratch_path(spark, "test-grid", uuid.uuid4().hex)
    base = ALSConfig(seed=5, num_blocks=1)
    small = param_grid(spark, ranks=(5,), reg_params=(0.1,), max_iters=(2, 3))
    first = grid_search(p.train, p.test, small, base=base, log_path=log, split_id="md5-42")
    assert first.count() == 2 and read_runs(spark, log).count() == 2
    bigger = param_grid(spark, ranks=(5,), reg_params=(0.1,), max_iters=(2, 3, 4))
    second = grid_search(p.train, p.test, bigger, base=base, log_path=log, split_id="md5-42")
    assert second.count() == 3
    assert read_runs(spark, log).count() == 3  # the two logged configs were not refitted


def test_sequential_grid_releases_model_factors(spark):
    from conftest import SF01
    from hourglass.operators import ALSConfig, grid_search
    from hourglass.operators.model import persistent_rdd_ids
    from hourglass.plans.workflow import prepare
    from hourglass.sources import events_interactions

    p = prepare(events_interactions(spark, SF01), behavior="view")
    before = persistent_rdd_ids(spark)
    grid = param_grid(spark, ranks=(4,), reg_params=(0.1,), max_iters=(2, 3, 4))
    runs = grid_search(p.train, p.test, grid, base=ALSConfig(num_blocks=1), parallelism=2)
    assert runs.count() == 3
    assert persistent_rdd_ids(spark) - before == set()  # nothing left cached by the three fits


def test_release_keeps_the_grid_caches(spark):
    from conftest import SF01
    from hourglass.operators import ALSConfig
    from hourglass.operators.model import persistent_rdd_ids
    from hourglass.operators.tuning import evaluate_config
    from hourglass.plans.workflow import prepare
    from hourglass.sources import events_interactions

    p = prepare(events_interactions(spark, SF01), behavior="view")
    before_caches = persistent_rdd_ids(spark)
    train, test = p.train.persist(), p.test.persist()
    train.count(), test.count()
    cached = persistent_rdd_ids(spark)
    caches = cached - before_caches  # the train and test cache RDDs
    assert caches
    evaluate_config(train, test, ALSConfig(rank=3, max_iter=2, num_blocks=1), release=True)
    after = persistent_rdd_ids(spark)
    # (other RDDs may be cleaned up by Spark meanwhile, so compare as sets)
    assert after - cached == set()  # the fit left nothing cached
    assert caches <= after  # and the caches it was given are still there
    train.unpersist(), test.unpersist()


def test_grid_refuses_a_hot_id_before_fitting(spark):
    import pytest

    from hourglass.operators import grid_search

    rows = [(0, i, 1.0) for i in range(30)] + [(1, 0, 1.0)]
    train = spark.createDataFrame(rows, "user INT, item INT, rating DOUBLE")
    with pytest.raises(ValueError, match="max_ratings_per_id"):
        grid_search(train, train, param_grid(spark, ranks=(2,), reg_params=(0.1,), max_iters=(1,)), max_ratings_per_id=10)


def test_resume_tells_settings_and_data_apart(spark):
    import dataclasses
    import uuid

    import pytest
    from pyspark.sql import functions as F

    from hourglass.operators import ALSConfig, grid_search
    from hourglass.session import scratch_path
    from hourglass.sources import read_runs

    rows = [(u, i, float(1 + (u * i) % 3)) for u in range(12) for i in range(8) if (u + i) % 3]
    train = spark.createDataFrame(rows, "user INT, item INT, rating DOUBLE")
    test = spark.createDataFrame([(u, u % 8, 1.0) for u in range(12)], "user INT, item INT, rating DOUBLE")
    grid = param_grid(spark, ranks=(2,), reg_params=(0.1,), max_iters=(1,))
    log = scratch_path(spark, "test-resume", uuid.uuid4().hex)
    base = ALSConfig(num_blocks=2)
    first = grid_search(train, test, grid, base=base, log_path=log).first()
    for other in (dataclasses.replace(base, alpha=40.0), dataclasses.replace(base, nonnegative=True), dataclasses.replace(base, num_blocks=1)):
        row = grid_search(train, test, grid, base=other, log_path=log).first()
        assert (row["alpha"], row["nonnegative"], row["num_blocks"]) == (other.alpha, other.nonnegative, other.num_blocks)
    changed = grid_search(train.withColumn("rating", F.col("rating") * 50), test, grid, base=base, log_path=log).first()
    assert changed["data_id"] != first["data_id"]
    assert read_runs(spark, log).count() == 5
    grid_search(train, test, grid, base=base, log_path=log)
    assert read_runs(spark, log).count() == 5
    with pytest.raises(ValueError, match="K = 5"):
        grid_search(train, test, grid, base=base, k=5)


def _shuffle_bytes(spark) -> int:
    """Bytes of the shuffle files of this local session."""
    import os

    dirs = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    found = [os.path.join(at, f) for d in dirs for at, _, names in os.walk(d.getPath()) for f in names if f.startswith("shuffle_")]
    return sum(os.path.getsize(f) for f in found if os.path.exists(f))


def _settles_below(spark, most: int) -> int:
    """Bytes once they are below ``most``, or after ten seconds: Spark deletes files in the background."""
    import time

    for _ in range(100):
        if (now := _shuffle_bytes(spark)) < most:
            break
        time.sleep(0.1)
    return now


def test_a_search_holds_the_shuffles_of_one_iteration(spark, monkeypatch):
    import time

    from hourglass.operators import ALSConfig, grid_search, tuning

    n_users, rank, blocks = 2000, 16, 4
    train = spark.range(n_users).selectExpr("int(id) user", "explode(sequence(0, 11)) j").selectExpr("user", "(user + j * 7) % 40 item", "double(1 + j % 3) rating")
    test = train.where("item = user % 40")
    grid = param_grid(spark, ranks=(rank,), reg_params=(0.1, 0.5), max_iters=(9,))
    once = n_users * blocks * rank * 4  # the factors of every user, sent to every block of items
    fit, held = tuning.fit_als, []

    def watched(*a, **kw):
        model = fit(*a, **kw)
        held.append(_settles_below(spark, start + 3 * once) - start)
        return model

    monkeypatch.setattr(tuning, "fit_als", watched)
    spark._jvm.System.gc()
    time.sleep(1)  # what other tests left is deleted first
    start = _shuffle_bytes(spark)
    runs = grid_search(train, test, grid, base=ALSConfig(num_blocks=blocks), parallelism=1, certify=True)
    assert _settles_below(spark, start + once) - start < once  # and what the two fits left is deleted
    assert len(held) == 2 and max(held) < 3 * once  # nine iterations would be above six
    assert [(r["checkpoint_interval"], r["certified"], r["n_scored"]) for r in runs.collect()] == [(10, True, test.count())] * 2


def test_sparing_disk_fits_the_same_factors(spark):
    import numpy as np

    from hourglass.operators import ALSConfig, fit_als

    train = spark.range(60).selectExpr("int(id) user", "explode(sequence(0, 5)) j").selectExpr("user", "(user + j * 3) % 20 item", "double(1 + j % 3) rating")
    for other in ({}, {"implicit": False}, {"checkpoint_interval": -1}):
        config = ALSConfig(rank=3, max_iter=2, num_blocks=2, **other)
        plain, spare = fit_als(train, config), fit_als(train, config, spare_disk=True)
        for side in ("userFactors", "itemFactors"):
            a, b = ([(r["id"], r["features"]) for r in getattr(m, side).orderBy("id").collect()] for m in (plain, spare))
            assert [x[0] for x in a] == [x[0] for x in b]
            assert np.allclose([x[1] for x in a], [x[1] for x in b], atol=1e-4)
        cut = "ReliableCheckpointRDD" in spare.itemFactors.rdd.toDebugString().decode()
        assert cut == (config.checkpoint_interval > 0)
