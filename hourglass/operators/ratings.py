"""Ratings table (user INT, item INT, rating DOUBLE) and train/test splits."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import HASH_SPACE, hash_bucket
from .indexing import Dictionary, encode
from .joins import BROADCAST_MAX_BYTES, BROADCAST_MAX_ROWS


def index_interactions(
    df: DataFrame,
    users: Dictionary,
    items: Dictionary,
    user_col: str = "user_id",
    item_col: str = "game",
    max_broadcast_rows: int = BROADCAST_MAX_ROWS,
    max_broadcast_bytes: int = BROADCAST_MAX_BYTES,
) -> DataFrame:
    """Add ``user`` and ``item`` INT ids (rows with unknown/NULL labels dropped).

    Each dictionary is broadcast when within the bounds (a map-side join, the
    interactions are not shuffled), otherwise joined by a shuffle on its label.
    """
    bounds = dict(max_broadcast_rows=max_broadcast_rows, max_broadcast_bytes=max_broadcast_bytes)
    return encode(encode(df, items, item_col, "item", **bounds), users, user_col, "user", **bounds)


def build_ratings(
    indexed: DataFrame,
    value: str = "value",
    merge: str = "none",
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Project to ``(user INT, item INT, rating DOUBLE)``.

    ``merge="none"`` keeps repeated (user, item) rows as separate ratings, as
    the reference does. ``merge="sum"`` adds their values in one partial +
    final aggregate; it also bounds the rows any single user sends to ALS by
    the number of items.
    """
    cols = [F.col("user").cast("int").alias("user"), F.col("item").cast("int").alias("item"), F.col(value).cast("double").alias("rating")]
    cols += [F.col(c) for c in keep]
    out = indexed.select(*cols)
    if merge == "none":
        return out
    if merge == "sum":
        return out.groupBy("user", "item", *keep).agg(F.sum("rating").alias("rating")).select("user", "item", "rating", *keep)
    raise ValueError(f"unknown merge {merge!r}")


def with_split(
    df: DataFrame,
    keys: tuple[str, ...] = ("user_id", "game"),
    test_fraction: float = 0.2,
    seed: int = 42,
) -> DataFrame:
    """Add ``split`` = 'test' / 'train' from an md5 bucket of the key columns.

    A pure row function: no shuffle, the same result for any partitioning
    or engine, and all rows of one (user, item) pair land on the same side.
    """
    cut = int(round(test_fraction * HASH_SPACE))
    b = hash_bucket(*keys, seed=seed)
    return df.withColumn("split", F.when(b < F.lit(cut), F.lit("test")).otherwise(F.lit("train")))


@dataclass(frozen=True)
class Split:
    train: DataFrame
    test: DataFrame


def hash_split(df: DataFrame, keys=("user_id", "game"), test_fraction: float = 0.2, seed: int = 42) -> Split:
    s = with_split(df, keys, test_fraction, seed)
    return Split(
        train=s.where(F.col("split") == "train").drop("split"),
        test=s.where(F.col("split") == "test").drop("split"),
    )


def random_split(df: DataFrame, weights=(0.8, 0.2), seed: int = 42) -> Split:
    """``randomSplit`` for parity with the reference; depends on partitioning."""
    train, test = df.randomSplit(list(weights), seed=seed)
    return Split(train=train, test=test)


def split_counts(df_with_split: DataFrame) -> DataFrame:
    """Rows per side in one job."""
    return df_with_split.groupBy("split").agg(F.count(F.lit(1)).alias("n"))


def cold_start_coverage(train: DataFrame, test: DataFrame, user: str = "user", item: str = "item") -> DataFrame:
    """Test rows whose user and item both occur in train, and the share of them.

    Known users and items are distinct-id sets joined to the test rows (each
    test row meets at most one row per set), then one aggregate counts both.
    """
    tu = train.select(user).distinct().withColumn("_ku", F.lit(1))
    ti = train.select(item).distinct().withColumn("_ki", F.lit(1))
    flagged = test.select(user, item).join(tu, user, "left").join(ti, item, "left")
    return flagged.agg(
        F.count(F.lit(1)).alias("n_test"),
        F.coalesce(F.sum(F.col("_ku") * F.col("_ki")), F.lit(0)).cast("bigint").alias("n_scored"),
    ).select("n_test", "n_scored", F.try_divide(F.col("n_scored"), F.col("n_test")).alias("coverage"))
