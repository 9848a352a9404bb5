"""Implicit-feedback ALS: configuration, fit, scoring and recommendation.

The solver is Spark MLlib's ALS, as in the reference. What this module adds:
a frozen configuration with an explicit seed (MLlib's default seed differs
between Python processes) and an explicit block count (MLlib draws its start
factors per block, so the count is part of the model; the default is MLlib's),
and lineage checkpoints in the shared checkpoint folder for long fits.
"""

from __future__ import annotations

import math
import re
from dataclasses import asdict, dataclass

from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import dot
from ..session import ensure_checkpoint_dir

@dataclass(frozen=True)
class ALSConfig:
    rank: int = 20
    max_iter: int = 10
    reg_param: float = 0.1
    alpha: float = 1.0
    implicit: bool = True
    seed: int = 42
    cold_start: str = "drop"
    nonnegative: bool = False
    num_blocks: int = 10
    checkpoint_interval: int = 10

    def params(self) -> dict:
        return asdict(self)


# Fixed values of the reference workflow: the first trained model (maxIter 15)
# and the tracked baseline (maxIter 10), both rank 20, regParam 0.1.
FIRST_MODEL = ALSConfig(rank=20, max_iter=15, reg_param=0.1)
BASELINE = ALSConfig(rank=20, max_iter=10, reg_param=0.1)


def suggest_blocks(n_ratings: int, rows_per_block: int = 50_000_000) -> int:
    """Advice for ``num_blocks``: at least MLlib's 10, and one block per
    ``rows_per_block`` ratings. It depends on the data alone; nothing applies
    it unasked, because another count gives another model."""
    return max(10, math.ceil(n_ratings / rows_per_block))


def make_als(config: ALSConfig, user: str = "user", item: str = "item", rating: str = "rating") -> ALS:
    return ALS(
        userCol=user,
        itemCol=item,
        ratingCol=rating,
        implicitPrefs=config.implicit,
        rank=config.rank,
        maxIter=config.max_iter,
        regParam=config.reg_param,
        alpha=config.alpha,
        nonnegative=config.nonnegative,
        coldStartStrategy=config.cold_start,
        seed=config.seed,
        numUserBlocks=config.num_blocks,
        numItemBlocks=config.num_blocks,
        checkpointInterval=config.checkpoint_interval,
    )


def id_load(ratings: DataFrame, user: str = "user", item: str = "item") -> DataFrame:
    """(max_per_user, max_per_item): the most ratings any one user / item has.

    MLlib solves each id's normal equations in one task over all of its
    ratings, so these two numbers bound the largest ALS task. Per-id counts
    are aggregated map-side first; only the two maxima reach the driver.
    """
    def top(key: str, kind: str) -> DataFrame:
        per_id = ratings.groupBy(key).agg(F.count(F.lit(1)).alias("c"))
        return per_id.agg(F.max("c").alias("m")).select(F.lit(kind).alias("kind"), "m")

    both = top(user, "user").unionByName(top(item, "item"))
    return both.agg(
        F.max(F.when(F.col("kind") == "user", F.col("m"))).alias("max_per_user"),
        F.max(F.when(F.col("kind") == "item", F.col("m"))).alias("max_per_item"),
    )


def check_id_load(ratings: DataFrame, max_ratings_per_id: int) -> None:
    """Raise if any one user or item has more than ``max_ratings_per_id`` ratings."""
    load = id_load(ratings).first()
    worst = max(load["max_per_user"] or 0, load["max_per_item"] or 0)
    if worst > max_ratings_per_id:
        raise ValueError(
            f"one id has {worst} ratings (users: {load['max_per_user']}, items: {load['max_per_item']}), "
            f"above max_ratings_per_id={max_ratings_per_id}; merge repeated pairs "
            "(build_ratings(merge='sum')) or split the hot id before fitting"
        )


def fit_als(
    train: DataFrame,
    config: ALSConfig = BASELINE,
    max_ratings_per_id: int | None = None,
    spare_disk: bool = False,
    **cols,
) -> ALSModel:
    """Fit ALS on ``train`` (user INT, item INT, rating DOUBLE).

    ``max_ratings_per_id`` checks ``id_load`` first and refuses to start a fit
    whose largest task would exceed it, instead of failing deep inside it.

    Every iteration shuffles each user's factors to the item blocks that need
    them, by far the most a fit writes. MLlib deletes that shuffle when it
    checkpoints the item factors made from it; those of the iterations between
    two checkpoints stay. With ``spare_disk`` the item factors are checkpointed
    in every iteration, whatever ``config.checkpoint_interval`` (but -1, never),
    so that a fit holds one such shuffle at a time. The factors are the same.
    """
    spark = train.sparkSession
    ensure_checkpoint_dir(spark)
    if max_ratings_per_id is not None:
        check_id_load(train, max_ratings_per_id)
    als = make_als(config, **cols)
    if spare_disk and config.checkpoint_interval > 0:
        als = als.setCheckpointInterval(1)
    return als.fit(train)


def predict(model: ALSModel, test: DataFrame, keep_cold: bool = False) -> DataFrame:
    """``test`` + ``prediction`` FLOAT. Cold ids are dropped, or kept with a
    NaN prediction when ``keep_cold`` (so coverage can be measured in the
    same pass). Test rows and user factors both grow with the users and are
    merged; no factor table of users passes the driver."""
    strategy = "nan" if keep_cold else "drop"
    return model.copy().setColdStartStrategy(strategy).transform(test.hint("merge"))


def recommend_for_users(model: ALSModel, k: int, users: DataFrame | None = None) -> DataFrame:
    """(user, recommendations ARRAY<STRUCT<item INT, rating FLOAT>>).

    With ``users`` only those users are scored (``recommendForUserSubset``),
    instead of scoring everyone and filtering; they are merged with the
    factors, as both grow alike.
    """
    if users is None:
        return model.recommendForAllUsers(k)
    return model.recommendForUserSubset(users.hint("merge"), k)


def recommend_for_items(model: ALSModel, k: int, items: DataFrame | None = None) -> DataFrame:
    """(item, recommendations ARRAY<STRUCT<user INT, rating FLOAT>>)."""
    if items is None:
        return model.recommendForAllItems(k)
    return model.recommendForItemSubset(items, k)


def persistent_rdd_ids(spark) -> set[int]:
    """Ids of the RDDs currently persisted in this application (Spark's
    ``SparkContext.getPersistentRDDs``, reached through the JVM context)."""
    jmap = spark.sparkContext._jsc.getPersistentRDDs()  # java.util.Map<Integer, JavaRDD>
    return {int(key) for key in jmap.keySet().toArray()}


def release(model: ALSModel) -> int:
    """Unpersist the factor RDDs that the fit of ``model`` left cached, and no
    others. Returns how many were released. The model can still be used; its
    factors are then computed again from their checkpoint or the training data."""
    released = 0
    jmap = model.userFactors.sparkSession.sparkContext._jsc.getPersistentRDDs()
    for df, name in ((model.userFactors, "userFactors"), (model.itemFactors, "itemFactors")):
        lineage = df.rdd.toDebugString().decode()
        own = re.search(name + r" \w+\[(\d+)\]", lineage)
        rdd = jmap.get(int(own[1])) if own else None
        if rdd is not None:
            rdd.unpersist(False)
            released += 1
    return released


def factors(model: ALSModel) -> tuple[DataFrame, DataFrame]:
    """(userFactors, itemFactors): (id INT, features ARRAY<FLOAT>)."""
    return model.userFactors, model.itemFactors


def score_with_factors(
    pairs: DataFrame,
    user_factors: DataFrame,
    item_factors: DataFrame,
    user: str = "user",
    item: str = "item",
    keep_cold: bool = False,
    dtype: str = "float",
) -> DataFrame:
    """Score (user, item) rows with factor tables (id INT, features ARRAY).

    Two equi-joins with the factor tables and an array dot product – the
    relational form of ``ALSModel.transform``. Pairs whose user or item has no
    factor are dropped, or kept with a NaN prediction when ``keep_cold``.
    """
    how = "left" if keep_cold else "inner"
    uf = user_factors.select(F.col("id").alias(user), F.col("features").alias("_uf"))
    itf = item_factors.select(F.col("id").alias(item), F.col("features").alias("_if"))
    score = F.when(F.col("_uf").isNull() | F.col("_if").isNull(), F.lit(float("nan"))).otherwise(dot("_uf", "_if"))
    return pairs.join(uf, user, how).join(itf, item, how).withColumn("prediction", score.cast(dtype)).drop("_uf", "_if")


def score_pairs(model: ALSModel, pairs: DataFrame, user: str = "user", item: str = "item") -> DataFrame:
    """Relational scoring with a fitted model's factors. Equal to ``predict``
    with cold ids dropped; useful to check it."""
    return score_with_factors(pairs, model.userFactors, model.itemFactors, user, item)
