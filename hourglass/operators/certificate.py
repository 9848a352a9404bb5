"""Optimality certificate of a fitted ALS model.

ALS solves one side after the other; the side solved last must satisfy its
normal equations exactly, whatever the start factors and the number of
iterations. For a user u with the ratings r and the items' factors y,

    implicit:  (G + sum c y y' + reg * n I) x = sum over r > 0 of (1 + c) y,
               c = alpha * |r|, n the ratings above 0, G the sum of y y' over all items
    explicit:  (sum y y' + reg * n I) x = sum r y, n the ratings

so the fit can be checked without knowing the solution. A matrix is never
formed for a user: each rating adds a multiple of its item's factors to the
residual. Three distributed parts:

* the Gramian G: each task sums the outer products of its factors, and the
  partial matrices (rank² cells a task) are added up cell by cell;
* the residual's sum over ratings: ratings meet both factors by equi-joins (the
  users' by a merge, so that their table never passes the driver), a
  task sums its rows per user, and the partial vectors are added per user, so
  that a user with a third of all ratings is many tasks' work;
* what depends on the user alone (G x, reg * n * x), and the norms.

The residual is set against the sum of the norms of its terms. Factors are
stored in single precision, so a solved system leaves about 1e-7.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml.recommendation import ALSModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .model import ALSConfig

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: A relative residual up to which a system counts as solved.
TOLERANCE = 1e-5


def _matrix(column: pa.Array, rank: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, rank)


def gramian(factors: DataFrame, rank: int) -> np.ndarray:
    """Sum of y y' over the rows (id, features); rank² numbers reach the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((rank, rank))
        for batch in batches:
            y = _matrix(batch.column("features"), rank)
            total += y.T @ y
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(rank * rank, dtype=np.int32)), pa.array(total.ravel())], names=["cell", "value"])

    cells = factors.select("features").mapInArrow(run, "cell int, value double").groupBy("cell").agg(F.sum("value").alias("value")).collect()
    out = np.zeros(rank * rank)
    for r in cells:
        out[r["cell"]] = r["value"]
    return out.reshape(rank, rank)


def _terms(config: ALSConfig):
    """Per user and batch: the sum of the ratings' terms, of their norms, and
    the number of ratings that count for the penalty."""
    rank, alpha, implicit = config.rank, config.alpha, config.implicit

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            user = batch.column("user").to_numpy()
            r = batch.column("rating").to_numpy(zero_copy_only=False).astype(np.float32).astype(np.float64)
            x, y = _matrix(batch.column("x"), rank), _matrix(batch.column("y"), rank)
            score, size = (x * y).sum(1), np.sqrt((y * y).sum(1))
            if implicit:
                c, liked = alpha * np.abs(r), r > 0
                left, right = c * score, np.where(liked, 1 + c, 0.0)
                counts = liked
            else:
                left, right, counts = score, r, np.ones(len(r), bool)
            order = np.argsort(user, kind="stable")
            first = np.flatnonzero(np.r_[True, np.diff(user[order]) != 0])
            add = lambda v: np.add.reduceat(v[order], first, axis=0)
            vectors = add((left - right)[:, None] * y)
            yield pa.RecordBatch.from_arrays(
                [pa.array(user[order][first]), pa.ListArray.from_arrays(pa.array(np.arange(len(first) + 1, dtype=np.int32) * rank), pa.array(vectors.ravel())),
                 pa.array(add((np.abs(left) + np.abs(right)) * size)), pa.array(add(counts.astype(np.int64))), pa.array(add(np.ones(len(r), np.int64)))],
                names=["user", "terms", "size", "counted", "n_ratings"])

    return run


def _residuals(config: ALSConfig, g: np.ndarray):
    rank, reg = config.rank, config.reg_param

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        norm = lambda v: np.sqrt((v * v).sum(1))
        for batch in batches:
            x, terms = _matrix(batch.column("x"), rank), _matrix(batch.column("terms"), rank)
            counted, size = batch.column("counted").to_numpy().astype(np.float64), batch.column("size").to_numpy()
            whole, penalty = x @ g, (reg * counted)[:, None] * x
            scale = size + norm(whole) + norm(penalty)
            rest = norm(terms + whole + penalty)
            value = np.divide(rest, scale, out=np.zeros(len(rest)), where=scale > 0)
            yield pa.RecordBatch.from_arrays([batch.column("user"), pa.array(value), batch.column("n_ratings")], names=["user", "residual", "n_ratings"])

    return run


def residuals(user_factors: DataFrame, item_factors: DataFrame, ratings: DataFrame, config: ALSConfig) -> DataFrame:
    """(user, residual, n_ratings): the relative residual of each user's
    normal equations over ``ratings`` (user, item, rating)."""
    rank = config.rank
    if config.nonnegative:
        raise ValueError("a nonnegative fit is a constrained problem; its normal equations need not hold")
    x = user_factors.select(F.col("id").alias("user"), F.col("features").alias("x")).hint("merge")
    y = item_factors.select(F.col("id").alias("item"), F.col("features").alias("y"))
    rows = ratings.select("user", "item", "rating").join(y, "item").join(x, "user").select("user", "rating", "x", "y")
    parts = rows.mapInArrow(_terms(config), "user int, terms array<double>, size double, counted long, n_ratings long")
    cells = [F.sum(F.get("terms", F.lit(i))).alias(f"t{i}") for i in range(rank)]
    sums = parts.groupBy("user").agg(*cells, *[F.sum(c).alias(c) for c in ("size", "counted", "n_ratings")])
    each = sums.select("user", F.array(*[f"t{i}" for i in range(rank)]).alias("terms"), "size", "counted", "n_ratings").join(x, "user")
    g = gramian(item_factors, rank) if config.implicit else np.zeros((rank, rank))
    return each.mapInArrow(_residuals(config, g), "user int, residual double, n_ratings long")


def certificate(model: ALSModel, train: DataFrame, config: ALSConfig, tolerance: float = TOLERANCE) -> DataFrame:
    """One row (n_users, n_ratings, worst, certified): certified if every rating of
    ``train`` belongs to a user and an item with factors, every user with
    factors has ratings, and no residual is above ``tolerance``."""
    each = residuals(model.userFactors, model.itemFactors, train, config)
    got = each.agg(F.count(F.lit(1)).alias("n_users"), F.coalesce(F.sum("n_ratings"), F.lit(0)).cast("long").alias("n_ratings"), F.max("residual").alias("worst"))
    asked, fitted = train.count(), model.userFactors.count()
    whole = (F.col("n_ratings") == F.lit(asked)) & (F.col("n_users") == F.lit(fitted))
    worst = F.coalesce(F.col("worst"), F.lit(0.0))
    return got.select("n_users", "n_ratings", "worst", (whole & ~F.isnan(worst) & (worst <= F.lit(tolerance))).alias("certified"))
