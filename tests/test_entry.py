import pytest

import __spark_entry__ as E
from compare import compare, duck
from conftest import SF001


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["user", "rank", "game_id", "score", "game", "user_id"]
    assert df.count() > 0


def test_oracle_keys_are_queries():
    assert set(E.oracle_sql()) <= set(E.queries())


FAST = [
    "plays", "behavior_counts", "cardinalities", "top_items", "top_users_sales", "clean_profile",
    "item_index", "item_index_sales", "split_counts", "coverage", "ranking_metrics",
    "readable_item_recs", "users_for_game", "stream_item_totals", "csv_scan",
    "stream_user_totals", "topk_dot_users", "fixed_factor_score_report", "ranking_metrics_sales",
    "top_items_sales_named", "als_coverage", "als_user_recs_shape",
]


@pytest.mark.parametrize("name", FAST)
def test_matches_oracle_sf0001(spark, name):
    r = compare(spark, SF001, name, E.queries()[name], E.oracle_sql()[name], duck(SF001))
    assert r["values"], r
