"""Adapter sanity: the published shapes of the events and sales adapters."""

import pytest
from pyspark.sql import functions as F

from hourglass.sources import events_interactions, sales_interactions

EVENTS = {  # sf: rows, users, items, (user, item) pairs, view rows, view values <= 0
    "0.001": (1_000, 15, 100, 739, 188, 0),
    "0.01": (10_000, 150, 100, 7_310, 1_982, 0),
    "0.1": (100_000, 1_500, 100, 73_004, 19_941, 3),
}
SALES = {  # sf: users, items, distinct pairs
    "0.001": (150, 200, 5_382),
    "0.01": (1_500, 2_000, 59_391),
    "0.1": (14_999, 20_000, 599_351),
}


@pytest.mark.parametrize("sf", sorted(EVENTS))
def test_events_adapter_shape(spark, sf):
    df = events_interactions(spark, f"/root/testdata/sf{sf}")
    r = df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.countDistinct("user_id").alias("users"),
        F.countDistinct("game").alias("items"),
        F.countDistinct("user_id", "game").alias("pairs"),
        F.sum((F.col("behavior") == "view").cast("long")).alias("views"),
        F.sum(((F.col("behavior") == "view") & (F.col("value") <= 0)).cast("long")).alias("non_pos"),
    ).first()
    assert tuple(r) == EVENTS[sf]


@pytest.mark.parametrize("sf", sorted(SALES))
def test_sales_adapter_shape(spark, sf):
    df = sales_interactions(spark, f"/root/testdata/sf{sf}")
    r = df.agg(F.countDistinct("user_id"), F.countDistinct("game"), F.countDistinct("user_id", "game")).first()
    assert tuple(r) == SALES[sf]
