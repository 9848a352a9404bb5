"""Adapters that present the shared test tables as interaction tables.

``events``: the JSON key ``k`` of ``props`` is the game, ``event_type`` the
behaviour; ``view`` plays the role of "play".
``sales``: ``lineitem`` joined with ``orders``; the customer is the user, the
part (as text) the game, the return flag the behaviour, the quantity the value.
Both adapters only project and join, so Catalyst prunes the parquet scans to
the columns used and pushes any later behaviour filter into them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .interactions import as_interactions

EVENTS_PLAY = "view"
SALES_PLAY = None  # every sales row is an interaction


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def adapt_events(ev: DataFrame) -> DataFrame:
    """events rows → interaction rows (works on batch and streaming frames)."""
    return as_interactions(
        ev.select(
            F.col("user_id"),
            F.get_json_object("props", "$.k").alias("game"),
            F.col("event_type").alias("behavior"),
            F.col("value"),
        )
    )


def events_interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return adapt_events(table(spark, sf_dir, "events"))


def sales_interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_returnflag", "l_quantity")
    od = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    # orders is a dimension of lineitem (one order per line); the join is a
    # plain equi-join on the order key and AQE picks broadcast or sort-merge
    # from the runtime size of orders.
    joined = li.join(od, li.l_orderkey == od.o_orderkey, "inner")
    return as_interactions(
        joined.select(
            F.col("o_custkey").alias("user_id"),
            F.col("l_partkey").cast("string").alias("game"),
            F.col("l_returnflag").alias("behavior"),
            F.col("l_quantity").alias("value"),
        )
    )


def sales_item_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readable, unique names for sales items: ``p_name#p_partkey``."""
    part = table(spark, sf_dir, "part")
    return part.select(
        F.col("p_partkey").cast("string").alias("game"),
        F.concat_ws("#", F.col("p_name"), F.col("p_partkey").cast("string")).alias("name"),
    )


def embedding_factors(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Fixed factors from ``embeddings``: every fifth vector is a user (id =
    vec_id / 5), the others are items (numbered without gaps), so both sides
    grow with the table."""
    emb = table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").alias("features"))
    fifth = F.floor(F.col("vec_id") / 5)
    users = emb.where(F.col("vec_id") % 5 == 0).select(fifth.cast("int").alias("id"), "features")
    items = emb.where(F.col("vec_id") % 5 != 0).select((F.col("vec_id") - fifth - 1).cast("int").alias("id"), "features")
    return users, items
