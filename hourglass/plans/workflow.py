"""The reference workflow as composable plans.

``prepare``: plays → clean → dictionaries → ids → split → ratings.
``train_evaluate``: fit → score (with coverage) → recommend once at max K →
ranking metrics for every K.
``name_recommendations``: flatten + names for both directions.
Each step returns DataFrames; only scalars (sizes, counts) reach the driver.
"""

from __future__ import annotations

import time
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.clean import clean_interactions
from ..operators.explore import behavior_counts, cardinalities, plays, top_items, top_users
from ..operators.indexing import Dictionary, build_dictionaries
from ..operators.metrics import KS, ranking_metrics, score_report
from ..operators.model import BASELINE, ALSConfig, fit_als, predict, recommend_for_items, recommend_for_users
from ..operators.topk import pack, two_way_top_k
from ..operators.present import readable_item_recs, readable_user_recs
from ..operators.ratings import build_ratings, index_interactions, with_split
from ..session import stable_table


@dataclass
class Prepared:
    plays: DataFrame  # cleaned rows of the modelled behaviour, with labels
    users: Dictionary
    items: Dictionary
    ratings: DataFrame  # user, item, rating, split
    seed: int = 42

    @property
    def train(self) -> DataFrame:
        return self.ratings.where(F.col("split") == "train").drop("split")

    @property
    def test(self) -> DataFrame:
        return self.ratings.where(F.col("split") == "test").drop("split")


def explore(df: DataFrame, behavior: str | None = "play", n: int = 10) -> dict[str, DataFrame]:
    return {
        "behavior_counts": behavior_counts(df),
        "top_items": top_items(df, n, behavior, labels=True),
        "top_users": top_users(df, n, behavior),
        "cardinalities": cardinalities(df),
    }


def prepare(
    interactions: DataFrame,
    behavior: str | None = "play",
    test_fraction: float = 0.2,
    seed: int = 42,
    merge: str = "none",
    min_value: float | None = None,
    materialize: bool = True,
    split: str = "hash",
    max_broadcast_bytes: int | None = None,
    stage: bool = True,
) -> Prepared:
    """Dictionaries are built on all cleaned rows before the split (as the
    reference fits its indexers), so test-only ids get an id but no factor –
    they show up as lost coverage, not as errors.

    The cleaned rows (three columns) are used twice, for the dictionaries and to
    encode. With ``stage`` they are written once to the shared folder, so that the
    source (a CSV to parse, a join) runs once.
    With ``materialize`` the compact ratings table (user, item, rating, split)
    is written as Parquet to the shared folder, partitioned by ``split``, so
    every later fit, score and metric reads it (train or test only, by folder
    pruning) instead of re-scanning and re-joining the raw interactions, and a
    lost executor recomputes from that table, not from the source.

    ``split="hash"`` (default) is the portable md5 split on (user, game);
    ``split="random"`` reproduces ``randomSplit([1 - f, f], seed)`` on the
    ratings rows, which depends on their partitioning (so it is applied to
    the materialised table).

    ``max_broadcast_bytes`` raises (or lowers) the size up to which a
    dictionary is broadcast for encoding; above it the interactions are
    shuffled by label to meet the dictionary."""
    rows = clean_interactions(plays(interactions, behavior), min_value=min_value)
    if stage and materialize:
        rows = stable_table(rows, "cleaned")
    dicts = build_dictionaries(rows, {"user": "user_id", "item": "game"})
    users, items = dicts["user"], dicts["item"]
    bounds = {} if max_broadcast_bytes is None else {"max_broadcast_bytes": max_broadcast_bytes}
    indexed = index_interactions(rows, users, items, **bounds)
    if split == "hash":
        ratings = build_ratings(with_split(indexed, ("user_id", "game"), test_fraction, seed), merge=merge, keep=("split",))
        if materialize:
            ratings = stable_table(ratings, "ratings", partition_by=("split",))
    elif split == "random":
        base = build_ratings(indexed, merge=merge)
        base = stable_table(base, "ratings") if materialize else base
        train, test = base.randomSplit([1.0 - test_fraction, test_fraction], seed=seed)
        ratings = train.withColumn("split", F.lit("train")).unionByName(test.withColumn("split", F.lit("test")))
    else:
        raise ValueError(f"unknown split {split!r}")
    return Prepared(plays=rows, users=users, items=items, ratings=ratings, seed=seed)


@dataclass
class Evaluation:
    config: ALSConfig
    model: object
    scored: DataFrame
    report: DataFrame
    user_recs: DataFrame
    metrics: DataFrame
    extra: dict = field(default_factory=dict)


def train_evaluate(prep: Prepared, config: ALSConfig = BASELINE, ks=KS) -> Evaluation:
    t0 = time.perf_counter()
    model = fit_als(prep.train, config)
    fit_s = time.perf_counter() - t0
    scored = predict(model, prep.test, keep_cold=True)
    # Only users with a test item can be evaluated: score just those.
    recs = recommend_for_users(model, max(ks), prep.test.select("user").distinct())
    return Evaluation(
        config=config,
        model=model,
        scored=scored,
        report=score_report(scored),
        user_recs=recs,
        metrics=ranking_metrics(recs, prep.test, ks),
        extra={"fit_seconds": fit_s},
    )


def name_recommendations(
    prep: Prepared, model, k: int = 5, users: DataFrame | None = None, items: DataFrame | None = None
) -> tuple[DataFrame, DataFrame]:
    """Named top-``k`` lists in both directions. Scoring every user against
    every item grows with users × items; pass ``users`` (column ``user``) /
    ``items`` (column ``item``) to score only those ids."""
    if users is None and items is None:
        # both directions from one product of each user with each item
        by_user, by_item = two_way_top_k(model.userFactors, model.itemFactors, k)
        user_recs, item_recs = pack(by_user, "user", "item"), pack(by_item, "item", "user")
    else:
        user_recs = recommend_for_users(model, k, users)
        item_recs = recommend_for_items(model, k, items)
    return (
        readable_user_recs(user_recs, prep.items, prep.users),
        readable_item_recs(item_recs, prep.items, prep.users),
    )


def evaluate_at_k(model, actual: DataFrame, k: int, user: str = "user", item: str = "item") -> tuple[float, float, float]:
    """(precision@k, recall@k, map@k) of ``model`` – the reference's call shape.

    ``actual`` is either test rows (user, item, …) or one row per user with an
    array of items (user, actual_items). Only users in ``actual`` are scored.
    Three numbers come back to the driver; the work is one distributed plan.
    """
    arrays = [f.name for f in actual.schema.fields if isinstance(f.dataType, T.ArrayType)]
    pairs = actual.select(user, F.explode(arrays[0]).alias(item)) if arrays and item not in actual.columns else actual
    recs = recommend_for_users(model, k, pairs.select(user).distinct())
    row = ranking_metrics(recs, pairs, (k,)).first()
    return (row["precision"], row["recall"], row["map"]) if row else (float("nan"),) * 3
