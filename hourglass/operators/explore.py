"""Exploration: behaviour counts, totals, top-N, cardinalities.

Every operator is a declarative aggregate: Catalyst pushes the behaviour
filter into the scan, reads only the needed columns, aggregates map-side
(partial HashAggregate) so a hot user or game is combined before the shuffle,
and fuses sort + limit into ``TakeOrderedAndProject`` so only ``n`` rows per
partition ever move.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import hours_label
from .joins import sized_broadcast


def plays(df: DataFrame, behavior: str | None = "play", col: str = "behavior") -> DataFrame:
    """Rows of one behaviour (``None`` keeps every row)."""
    if behavior is None:
        return df
    return df.where(F.col(col) == F.lit(behavior))


def behavior_counts(df: DataFrame, col: str = "behavior") -> DataFrame:
    """Rows per behaviour value (NULL is its own group)."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))


def totals(df: DataFrame, key: str, value: str = "value", alias: str = "total_hours") -> DataFrame:
    """Sum of ``value`` per ``key``."""
    return df.groupBy(key).agg(F.sum(value).alias(alias))


def top_n(df: DataFrame, order_col: str, key: str, n: int = 10) -> DataFrame:
    """The ``n`` rows with the largest ``order_col``; ties broken by ``key``."""
    return df.orderBy(F.col(order_col).desc_nulls_last(), F.col(key).asc_nulls_last()).limit(n)


def _with_labels(top: DataFrame, total: str) -> DataFrame:
    # The window runs over the n rows left after the limit: bounded, no shuffle
    # of the input.
    w = Window.partitionBy()
    return top.withColumn("hours_label", hours_label(total)).withColumn(
        "share_of_max", F.try_divide(F.col(total), F.max(total).over(w))
    )


def top_items(
    df: DataFrame,
    n: int = 10,
    behavior: str | None = "play",
    item_col: str = "game",
    value: str = "value",
    labels: bool = False,
) -> DataFrame:
    """Games with the most hours: filter → sum per game → top ``n``."""
    top = top_n(totals(plays(df, behavior), item_col, value), "total_hours", item_col, n)
    return _with_labels(top, "total_hours") if labels else top


def top_users(
    df: DataFrame,
    n: int = 10,
    behavior: str | None = "play",
    user_col: str = "user_id",
    value: str = "value",
    labels: bool = True,
) -> DataFrame:
    """Users with the most hours, with the chart's label and share-of-max."""
    top = top_n(totals(plays(df, behavior), user_col, value), "total_hours", user_col, n)
    if not labels:
        return top
    return _with_labels(top, "total_hours").withColumn("user_label", F.col(user_col).cast("string"))


def distinct_ids(df: DataFrame, col: str) -> DataFrame:
    """Distinct values of one column (NULL kept as a value)."""
    return df.select(col).distinct()


def cardinalities(
    df: DataFrame, cols: tuple[str, ...] = ("user_id", "game"), approx: bool = False, rsd: float = 0.05
) -> DataFrame:
    """Row count and, per column, distinct values with and without NULL.

    ``<c>_distinct`` equals ``select(c).distinct().count()`` (NULL counted as
    one value); ``<c>_non_null`` equals ``countDistinct(c)``. One job for all
    columns. ``approx=True`` uses HyperLogLog++ (relative standard error
    ``rsd``) instead of an exact distinct, which avoids shuffling every
    distinct value at very large scale.
    """
    aggs = [F.count(F.lit(1)).alias("n_rows")]
    for c in cols:
        nn = F.approx_count_distinct(c, rsd) if approx else F.countDistinct(c)
        has_null = F.coalesce(F.max(F.col(c).isNull().cast("int")), F.lit(0))
        aggs.append((nn + has_null).cast("bigint").alias(f"{c}_distinct"))
        aggs.append(nn.cast("bigint").alias(f"{c}_non_null"))
    return df.agg(*aggs)


def with_names(top: DataFrame, names: DataFrame, n: int, key: str = "game", name_col: str = "name") -> DataFrame:
    """Attach readable names to a top-``n`` result by key.

    ``top`` has at most ``n`` rows (its limit): its keys are broadcast through
    the size check and the names table is streamed past them (an inner join
    may build on either side; an outer join could only build on the names),
    leaving at most ``n`` name rows, which are then attached to ``top`` with a
    left join of two tiny inputs.
    """
    keys = sized_broadcast(top.select(key), n)
    found = keys.join(names.select(key, name_col), key, "inner")
    return top.join(found, key, "left")
