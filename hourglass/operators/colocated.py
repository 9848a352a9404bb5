"""Storage-partitioned scoring: the test rows are bucketed by user once, and
every later model scores them without moving them.

A grid search scores one test table with 27 models. Each scoring is a join on
the user and one on the item; here the test rows lie in a bucketed table, so the
join on the user shuffles the factors of that model only (users x rank numbers)
and never the test rows. The item factors are the small side; the join on the
item keeps the rows where they are while these are broadcast by their counted
size, and shuffles only above it.
"""

from __future__ import annotations

import uuid

from pyspark.ml.recommendation import ALSModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import dot
from ..session import scratch_path
from .joins import sized_broadcast


def bucketed(rows: DataFrame, key: str = "user", buckets: int | None = None, name: str = "bucketed") -> DataFrame:
    """``rows`` as a table in the shared folder, bucketed and sorted by ``key``.
    The number of buckets is the session's shuffle partitions by default, so
    that joins don't deal the rows out again."""
    spark = rows.sparkSession
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    table = f"{name}_{uuid.uuid4().hex}"
    # one file a bucket: rows are dealt as the buckets are before the write
    dealt = rows.repartition(n, key)
    dealt.write.bucketBy(n, key).sortBy(key).option("path", scratch_path(spark, "tables", table)).format("parquet").saveAsTable(table)
    return spark.table(table)


def score_bucketed(test: DataFrame, user_factors: DataFrame, item_factors: DataFrame, keep_cold: bool = False, n_items: int | None = None, rank: int | None = None, dtype: str = "float") -> DataFrame:
    """``test`` (bucketed by user) with ``prediction``, as
    ``model.score_with_factors`` gives it. ``n_items`` and ``rank`` say how large
    the item factors are; without them nothing is broadcast by hand."""
    how = "left" if keep_cold else "inner"
    x = user_factors.select(F.col("id").alias("user"), F.col("features").alias("_x"))
    y = item_factors.select(F.col("id").alias("item"), F.col("features").alias("_y"))
    y = sized_broadcast(y, n_items, n_bytes=None if n_items is None or rank is None else n_items * rank * 4)
    # the factors are shuffled to the buckets, never broadcast: there are as
    # many as users
    rows = test.join(x.hint("merge"), "user", how).join(y, "item", how)
    score = F.when(F.col("_x").isNull() | F.col("_y").isNull(), F.lit(float("nan"))).otherwise(dot("_x", "_y"))
    return rows.withColumn("prediction", score.cast(dtype)).select(*test.columns, "prediction")


def predict_bucketed(model: ALSModel, test: DataFrame, keep_cold: bool = False, n_items: int | None = None) -> DataFrame:
    """``model.predict`` over a table from ``bucketed``."""
    return score_bucketed(test, model.userFactors, model.itemFactors, keep_cold, n_items, model.rank)
