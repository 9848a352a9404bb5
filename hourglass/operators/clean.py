"""Cleaning and profiling of interaction rows before indexing.

ALS rejects NULL/NaN ratings and the indexers skip NULL ids; doing both in one
explicit step makes the rejected rows countable (``profile``) instead of
silently dropped deep inside a fit.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _valid_value(value: str):
    return F.col(value).isNotNull() & ~F.isnan(F.col(value))


def clean_interactions(
    df: DataFrame,
    user_col: str = "user_id",
    item_col: str = "game",
    value: str = "value",
    min_value: float | None = None,
) -> DataFrame:
    """Keep rows with a user, a game and a usable value.

    ``min_value`` (exclusive) optionally drops non-positive or tiny values;
    by default they are kept, as in the reference, where they act as
    preference 0 in implicit ALS.
    """
    cond = F.col(user_col).isNotNull() & F.col(item_col).isNotNull() & _valid_value(value)
    if min_value is not None:
        cond = cond & (F.col(value) > F.lit(min_value))
    return df.where(cond)


def profile(
    df: DataFrame,
    user_col: str = "user_id",
    item_col: str = "game",
    value: str = "value",
) -> DataFrame:
    """Data-quality counts as ``(metric, n)`` rows, including two skew gauges:
    ``max_rows_per_user`` and ``max_items_per_user`` (rows with a user and a
    game). A user far above the rest sends that many rows to one ALS block;
    ``build_ratings(merge="sum")`` bounds it by ``max_items_per_user``.

    One scan and a linear chain of aggregates: per (user, game) pair, then
    per user, then global. NULL keys form their own groups, and each level
    aggregates map-side first, so a hot user or pair is combined before it is
    shuffled.
    """
    ok_value = _valid_value(value)
    u, g = F.col(user_col), F.col(item_col)
    pairs = df.groupBy(user_col, item_col).agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum(F.col(value).isNull().cast("long")).alias("null_value"),
        F.sum((F.col(value).isNotNull() & F.isnan(F.col(value))).cast("long")).alias("nan_value"),
        F.sum((ok_value & (F.col(value) <= 0)).cast("long")).alias("non_positive_value"),
        F.sum(ok_value.cast("long")).alias("valid"),
        F.max(F.when(ok_value, F.col(value))).alias("max_valid"),
    )
    dup = g.isNotNull() & (F.col("rows") > 1)
    per_user = pairs.groupBy(user_col).agg(
        F.sum("rows").alias("rows"),
        F.sum(F.when(g.isNull(), F.col("rows"))).alias("null_item"),
        F.sum("null_value").alias("null_value"),
        F.sum("nan_value").alias("nan_value"),
        F.sum("non_positive_value").alias("non_positive_value"),
        F.sum(F.when(g.isNotNull(), F.col("valid"))).alias("clean_rows"),
        F.sum(F.when(dup, F.lit(1))).alias("duplicate_pairs"),
        F.sum(F.when(dup, F.col("rows") - 1)).alias("duplicate_rows"),
        # the user's largest usable value over pairs with a game
        F.max(F.when(g.isNotNull() & (F.col("valid") > 0), F.col("max_valid"))).alias("mx"),
        F.sum(F.when(g.isNotNull(), F.col("rows"))).alias("keyed_rows"),
        F.count(g).alias("items"),
    )
    totals = per_user.agg(
        F.sum("rows").alias("rows"),
        F.sum(F.when(u.isNull(), F.col("rows"))).alias("null_user"),
        F.sum("null_item").alias("null_item"),
        F.sum("null_value").alias("null_value"),
        F.sum("nan_value").alias("nan_value"),
        F.sum("non_positive_value").alias("non_positive_value"),
        F.sum(F.when(u.isNotNull(), F.col("clean_rows"))).alias("clean_rows"),
        F.sum(F.when(u.isNotNull(), F.col("duplicate_pairs"))).alias("duplicate_pairs"),
        F.sum(F.when(u.isNotNull(), F.col("duplicate_rows"))).alias("duplicate_rows"),
        F.sum(F.when(u.isNotNull() & (F.col("mx") <= 0), F.lit(1))).alias("users_without_positive"),
        # skew: the most rows, and the most distinct games, of any one user
        F.max(F.when(u.isNotNull(), F.col("keyed_rows"))).alias("max_rows_per_user"),
        F.max(F.when(u.isNotNull(), F.col("items"))).alias("max_items_per_user"),
    )
    names = [
        "rows", "null_user", "null_item", "null_value", "nan_value", "non_positive_value",
        "clean_rows", "duplicate_pairs", "duplicate_rows", "users_without_positive",
        "max_rows_per_user", "max_items_per_user",
    ]
    cells = [F.struct(F.lit(m).alias("metric"), F.coalesce(F.col(m), F.lit(0)).cast("bigint").alias("n")) for m in names]
    return totals.select(F.explode(F.array(*cells)).alias("m")).select("m.metric", "m.n")
