"""Readable recommendations: flatten nested lists and put names on ids.

The reference moves every recommendation row to the driver and looks names up
in a Python list. Here the names come from the index dictionary through a
join (broadcast when the dictionary is small, shuffled otherwise), and the
lookups for one user or one game stay filters on DataFrames.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .indexing import Dictionary, decode, encode
from .model import recommend_for_items, recommend_for_users


def flatten_user_recs(recs: DataFrame) -> DataFrame:
    """(user, rank, game_id, score): one row per recommendation, rank from 1."""
    return recs.select("user", F.posexplode("recommendations").alias("pos", "rec")).select(
        F.col("user"),
        (F.col("pos") + 1).cast("int").alias("rank"),
        F.col("rec.item").alias("game_id"),
        F.col("rec.rating").alias("score"),
    )


def flatten_item_recs(recs: DataFrame) -> DataFrame:
    """(game_id, rank, recommended_user, score)."""
    return recs.select("item", F.posexplode("recommendations").alias("pos", "rec")).select(
        F.col("item").alias("game_id"),
        (F.col("pos") + 1).cast("int").alias("rank"),
        F.col("rec.user").alias("recommended_user"),
        F.col("rec.rating").alias("score"),
    )


def readable_user_recs(recs: DataFrame, items: Dictionary, users: Dictionary | None = None) -> DataFrame:
    """(user, rank, game_id, score, game[, user_id])."""
    out = decode(flatten_user_recs(recs), items, "game_id", "game")
    if users is not None:
        out = decode(out, users, "user", "user_id")
    return out


def readable_item_recs(recs: DataFrame, items: Dictionary, users: Dictionary | None = None) -> DataFrame:
    """(game_id, rank, recommended_user, score, game[, recommended_user_id])."""
    out = decode(flatten_item_recs(recs), items, "game_id", "game")
    if users is not None:
        out = decode(out, users, "recommended_user", "recommended_user_id")
    return out


def recs_for_user(readable: DataFrame, user: int) -> DataFrame:
    """One user's recommendations, best first (ties by game id)."""
    return readable.where(F.col("user") == F.lit(user)).orderBy(F.col("score").desc(), F.col("game_id").asc())


def recs_for_user_label(readable: DataFrame, user_label: str) -> DataFrame:
    """Same, selected by the original user id (needs ``user_id`` column)."""
    return readable.where(F.col("user_id") == F.lit(user_label)).orderBy(F.col("score").desc(), F.col("game_id").asc())


def users_for_game(readable_items: DataFrame, game: str) -> DataFrame:
    """Likely users of one game, selected by name, best first."""
    return readable_items.where(F.col("game") == F.lit(game)).orderBy(
        F.col("score").desc(), F.col("recommended_user").asc()
    )


def first_rows(flat: DataFrame, n: int = 10, key: str = "user") -> DataFrame:
    """The first ``n`` flattened rows in (key, rank) order."""
    return flat.orderBy(F.col(key).asc(), F.col("rank").asc()).limit(n)


def recommend_for_user_labels(model, users: Dictionary, labels: DataFrame, k: int, label_col: str = "user_id") -> DataFrame:
    """Score only the users named in ``labels`` (original ids): labels → ids
    through the dictionary (a join, no driver lookup) → ``recommendForUserSubset``."""
    ids = encode(labels.select(label_col).distinct(), users, label_col, "user").select("user")
    return recommend_for_users(model, k, ids)


def recommend_users_for_game_names(model, items: Dictionary, names: DataFrame, k: int, name_col: str = "game") -> DataFrame:
    """Score only the games named in ``names`` → ``recommendForItemSubset``."""
    ids = encode(names.select(name_col).distinct(), items, name_col, "item").select("item")
    return recommend_for_items(model, k, ids)
