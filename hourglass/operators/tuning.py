"""Hyperparameter search over ALS configurations, and the run table views.

The grid is a DataFrame (cross product of the three value lists). Each
configuration is one distributed ALS fit; the driver only loops over the
configurations (27 by default), never over data. Train and test are persisted
once and reused by every fit. Results are run rows, appended to the run log.
"""

from __future__ import annotations

import dataclasses
import itertools
import time
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import RUN_NAME_FORMAT, run_name
from ..session import sweep
from ..sources.runs import RUN_COLUMNS, RUNS, append_runs, read_runs, runs_frame
from .certificate import certificate
from .metrics import ranking_metrics, score_report
from .model import (
    ALSConfig,
    check_id_load,
    fit_als,
    predict,
    recommend_for_users,
    release as release_factors,
)

# The reference's search grid.
RANKS = (10, 20, 50)
REG_PARAMS = (0.01, 0.1, 0.5)
MAX_ITERS = (10, 15, 20)

K_RECORD = 10
# Fits submitted at once by default; a plain number, so a search does the same
# work on every cluster.
PARALLEL_FITS = 4
# Seconds of a fit from which its measuring sweeps after each step: a sweep takes
# about a second, and what short fits write is little.
LONG_FIT_S = 20


def param_grid(
    spark: SparkSession, ranks=RANKS, reg_params=REG_PARAMS, max_iters=MAX_ITERS
) -> DataFrame:
    """(rank INT, regParam DOUBLE, maxIter INT, run_name STRING), one row per
    configuration, in the reference's loop order."""
    rows = [
        (i, int(r), float(g), int(m))
        for i, (r, g, m) in enumerate(itertools.product(ranks, reg_params, max_iters))
    ]
    grid = spark.createDataFrame(rows, "ord INT, rank INT, regParam DOUBLE, maxIter INT")
    return grid.withColumn("run_name", run_name("rank", "regParam", "maxIter"))


def evaluate_config(
    train: DataFrame,
    test: DataFrame,
    config: ALSConfig,
    k: int = 10,
    split_name: str = "test",
    release: bool = False,
    test_users: DataFrame | None = None,
    data_id: str | None = None,
    certify: bool = False,
) -> dict:
    """Fit one configuration and measure it: a run record (dict).

    The record's metric columns are those at K = 10, so ``k`` must be 10.
    With ``release`` the model's own cached factor RDDs are unpersisted as soon
    as it is measured (at scale a user-factor table is tens of GB; 27 of them
    must not wait for garbage collection), the fit spares disk
    (``fit_als(spare_disk=True)``), and after a long fit the shuffle files of
    each step are deleted before the next. ``test_users`` may pass the distinct
    test users, so a search computes them once. With ``certify`` the fit is held
    against its normal equations, and the record says if they hold.
    """
    if k != K_RECORD:
        raise ValueError(f"a run record holds the metrics at K = {K_RECORD}; use ranking_metrics for K = {k}")
    t0 = time.perf_counter()
    model = fit_als(train, config, spare_disk=release)
    fit_s = time.perf_counter() - t0

    def step_done() -> None:
        if release and fit_s > LONG_FIT_S:
            sweep(train.sparkSession)

    step_done()
    report = score_report(predict(model, test, keep_cold=True)).first()
    step_done()
    recs = recommend_for_users(model, k, test.select("user").distinct() if test_users is None else test_users)
    m = ranking_metrics(recs, test, ks=(k,)).first()
    del recs
    step_done()
    certified = bool(certificate(model, train, config).first()["certified"]) if certify else None
    if release:
        release_factors(model)
    return run_record(config, report, m, fit_s, split_name, data_id) | {"certified": certified}


def config_columns(config: ALSConfig) -> dict:
    """The run-log columns that say how a model was fitted."""
    return {
        "rank": int(config.rank),
        "regParam": float(config.reg_param),
        "maxIter": int(config.max_iter),
        "alpha": float(config.alpha),
        "implicit": bool(config.implicit),
        "nonnegative": bool(config.nonnegative),
        "num_blocks": int(config.num_blocks),
        "checkpoint_interval": int(config.checkpoint_interval),
        "seed": int(config.seed),
    }


def data_id(train: DataFrame, test: DataFrame) -> str:
    """Names the rows of train and test: counts and sums of row hashes."""
    def part(df: DataFrame) -> str:
        h = F.sum(F.xxhash64("user", "item", "rating").cast("decimal(38,0)"))
        r = df.agg(F.count(F.lit(1)).alias("n"), h.alias("h")).first()
        return f"{r['n']}:{r['h'] or 0}"

    return f"{part(train)}/{part(test)}"


def run_record(config: ALSConfig, report, m, fit_s: float | None = None, split_name: str = "test", data_id: str | None = None) -> dict:
    """A run-log record from a configuration, its score report row and its
    ranking-metrics row at K = 10."""
    return {
        "run_name": RUN_NAME_FORMAT % (config.rank, str(float(config.reg_param)), config.max_iter),
        "model": "als",
        **config_columns(config),
        "split": split_name,
        "data_id": data_id,
        "n_test": report["n_test"],
        "n_scored": report["n_scored"],
        "coverage": report["coverage"],
        "rmse": report["rmse"],
        "rmse_preference": report["rmse_preference"],
        "n_users": m["n_users"] if m else 0,
        "precision_at_10": m["precision"] if m else None,
        "recall_at_10": m["recall"] if m else None,
        "map_at_10": m["map"] if m else None,
        "fit_seconds": fit_s,
    }


def grid_search(
    train: DataFrame,
    test: DataFrame,
    grid: DataFrame | None = None,
    base: ALSConfig | None = None,
    k: int = 10,
    parallelism: int = PARALLEL_FITS,
    log_path: str | None = None,
    split_id: str = "test",
    max_ratings_per_id: int | None = None,
    certify: bool = False,
) -> DataFrame:
    """Run every configuration of ``grid``; return the runs DataFrame.

    The grid table is small by construction (its size is the number of
    configurations), so it is the one thing read back to the driver.
    ``parallelism`` > 1 submits several fits at once from a thread pool, as
    ``CrossValidator(parallelism=…)`` does. Each fit's cached factors are
    released and its shuffle files deleted once it is measured, so the disk
    that a search takes grows with the fits at work and not with the grid.

    With ``max_ratings_per_id`` the search first checks ``id_load`` and stops
    up front if one user or item has more ratings; the default is no bound.

    With ``log_path`` every run is appended to the run log as soon as it
    finishes, and configurations already logged there with the same settings,
    ``split_id`` and data (``data_id``) are not fitted again: a search
    interrupted by a lost driver resumes where it stopped. The result is then read from the log.
    """
    spark = train.sparkSession
    base = base or ALSConfig()
    grid = grid if grid is not None else param_grid(spark)
    configs = [
        dataclasses.replace(base, rank=int(r["rank"]), max_iter=int(r["maxIter"]), reg_param=float(r["regParam"]))
        for r in grid.orderBy("ord" if "ord" in grid.columns else "rank").collect()
    ]
    todo, data = configs, None
    if log_path is not None:
        data = data_id(train, test)
        done = _logged(spark, log_path, split_id, data)
        todo = [c for c in configs if tuple(config_columns(c).values()) not in done]
    rows: list[dict] = []
    if todo:
        train = train.persist()
        test = test.persist()
        test_users = test.select("user").distinct().persist()
        if max_ratings_per_id is not None:
            check_id_load(train, max_ratings_per_id)

        def one(c: ALSConfig) -> dict:
            row = evaluate_config(train, test, c, k, split_id, release=True, test_users=test_users, data_id=data, certify=certify)
            sweep(spark)
            if log_path is not None:
                append_runs(runs_frame(spark, [row]), log_path)
            return row

        try:
            if parallelism > 1:
                with ThreadPoolExecutor(max_workers=parallelism) as pool:
                    rows = list(pool.map(one, todo))
            else:
                rows = [one(c) for c in todo]
        finally:
            train.unpersist()
            test.unpersist()
            test_users.unpersist()
    if log_path is None:
        return runs_frame(spark, rows)
    keys = list(config_columns(base))
    types = {f.name: f.dataType.simpleString() for f in RUNS.fields}
    wanted = spark.createDataFrame([tuple(config_columns(c).values()) for c in configs], ", ".join(f"{x} {types[x]}" for x in keys))
    logged = _runs_of(read_runs(spark, log_path), split_id, data).join(wanted, keys, "left_semi")
    turn = Window.partitionBy(*keys).orderBy("fit_seconds", "map_at_10")  # a run logged twice counts once
    return logged.withColumn("_turn", F.row_number().over(turn)).where("_turn = 1").drop("_turn").select(*RUN_COLUMNS)


def _runs_of(runs: DataFrame, split_id: str, data: str | None) -> DataFrame:
    return runs.where((F.col("model") == "als") & (F.col("split") == F.lit(split_id)) & F.col("data_id").eqNullSafe(F.lit(data)))


def _logged(spark, log_path: str, split_id: str, data: str | None) -> set:
    keys = list(config_columns(ALSConfig()))
    return {tuple(r) for r in _runs_of(read_runs(spark, log_path), split_id, data).select(*keys).distinct().collect()}


def _tie():
    return (F.col("rank").asc_nulls_last(), F.col("regParam").asc_nulls_last(), F.col("maxIter").asc_nulls_last())


def leaderboard(runs: DataFrame, n: int = 5, metric: str = "map_at_10") -> DataFrame:
    """Top ``n`` runs by ``metric`` (desc); ties by rank, regParam, maxIter."""
    return runs.orderBy(F.col(metric).desc_nulls_last(), *_tie()).limit(n)


def best_config(runs: DataFrame, metric: str = "map_at_10") -> DataFrame:
    return leaderboard(runs, 1, metric)


def rank_marginals(runs: DataFrame, metric: str = "precision_at_10") -> DataFrame:
    """Mean of ``metric`` per (maxIter, rank) – one series per maxIter."""
    return runs.groupBy("maxIter", "rank").agg(F.avg(metric).alias(f"avg_{metric}"))


def tradeoff_points(runs: DataFrame) -> DataFrame:
    """(regParam, rank, maxIter, rmse, map_at_10) points of the trade-off view."""
    return runs.select("regParam", "rank", "maxIter", "rmse", "map_at_10")


def runs_for(runs: DataFrame, **equals) -> DataFrame:
    """Slice of the run table by hyperparameter values."""
    cond = F.lit(True)
    for key, value in equals.items():
        cond = cond & (F.col(key) == F.lit(value))
    return runs.where(cond)


__all__ = [
    "MAX_ITERS", "RANKS", "REG_PARAMS", "RUN_COLUMNS", "best_config", "evaluate_config",
    "grid_search", "leaderboard", "param_grid", "rank_marginals", "runs_for", "tradeoff_points",
]
