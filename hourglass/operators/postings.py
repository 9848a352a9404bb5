"""Chunked posting lists: the items of each owner as sorted lists of bounded
length.

``collect_set`` puts an owner's items into one array, so a user with a third of
all rows is one row of one task. Here an owner's distinct items are numbered in
order and cut into chunks of ``size``; each chunk is a row. Rows are dealt by
ranges of (owner, item), so a large owner spreads over many partitions. Numbers
within a partition come from a window over its slice of an owner; only slices
that begin in the middle of an owner need to know how many items came before,
and there is at most one of these a partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import stable_table

CHUNK = 1000


def posting_lists(pairs: DataFrame, owner: str = "user", item: str = "item", size: int = CHUNK) -> DataFrame:
    """(owner, chunk INT, items ARRAY sorted): chunks from 0, each but an owner's
    last of exactly ``size`` distinct items. NULLs have no place."""
    each = pairs.select(F.col(owner).alias("o"), F.col(item).alias("i")).where(F.col("o").isNotNull() & F.col("i").isNotNull()).distinct()
    parts = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = each.repartitionByRange(parts, "o", "i").withColumn("p", F.spark_partition_id())
    dealt = stable_table(dealt, "postings")
    slices = dealt.groupBy("o", "p").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("o").orderBy("p").rowsBetween(Window.unboundedPreceding, -1)
    # at most one slice a partition begins in the middle of an owner
    later = slices.withColumn("before", F.sum("n").over(earlier)).where("before is not null").select("o", "p", "before")
    ranked = dealt.withColumn("turn", F.row_number().over(Window.partitionBy("p", "o").orderBy("i")))
    ranked = ranked.join(F.broadcast(later), ["o", "p"], "left")
    place = F.col("turn") - 1 + F.coalesce("before", F.lit(0))
    chunked = ranked.select("o", "i", F.floor(place / F.lit(size)).cast("int").alias("chunk"))
    lists = chunked.groupBy("o", "chunk").agg(F.array_sort(F.collect_list("i")).alias("items"))
    return lists.select(F.col("o").alias(owner), "chunk", "items")


def sizes(lists: DataFrame, owner: str = "user") -> DataFrame:
    """(owner, n): how many items the chunks of an owner hold."""
    return lists.groupBy(owner).agg(F.sum(F.size("items")).alias("n"))


def shared(a: DataFrame, b: DataFrame, owner: str = "user", item: str = "item") -> DataFrame:
    """(owner, n): how many items two tables of chunks share per owner. Chunks
    are unfolded row by row and meet by (owner, item), which no owner makes hot."""
    flat = lambda t: t.select(F.col(owner), F.explode("items").alias(item))
    return flat(a).join(flat(b), [owner, item]).groupBy(owner).agg(F.count(F.lit(1)).alias("n"))
