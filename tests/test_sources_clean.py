from pyspark.sql import functions as F

from hourglass.operators import clean_interactions, profile
from hourglass.sources import read_interactions, runs_frame, append_runs, read_runs
from hourglass.session import scratch_path

CSV = """1,"Game, The Sequel",purchase,1.0
1,"Game, The Sequel",play,12
2,Other,play,0.5
,Other,play,3.0
3,Other,play,
3,,play,2.0
4,Other,play,0
5,Other,play,-1.5
2,Other,play,0.5
"""


def test_csv_explicit_schema_keeps_quoted_comma(spark, tmp_csv):
    df = read_interactions(spark, tmp_csv(CSV))
    assert [f.dataType.simpleString() for f in df.schema.fields] == ["bigint", "string", "string", "double"]
    rows = df.collect()
    assert len(rows) == 9
    assert rows[0]["game"] == "Game, The Sequel"
    assert rows[1]["value"] == 12.0 and rows[2]["value"] == 0.5


def test_csv_inferred_schema(spark, tmp_csv):
    df = read_interactions(spark, tmp_csv(CSV), infer=True)
    assert df.columns == ["user_id", "game", "behavior", "value"]
    assert [f.dataType.simpleString() for f in df.schema.fields] == ["int", "string", "string", "double"]


def test_clean_and_profile(spark, tmp_csv):
    df = read_interactions(spark, tmp_csv(CSV)).where(F.col("behavior") == "play")
    kept = clean_interactions(df)
    # null user, null value, null game dropped; zero and negative kept
    assert kept.count() == 5
    assert clean_interactions(df, min_value=0.0).count() == 3
    prof = {r["metric"]: r["n"] for r in profile(df).collect()}
    assert prof["rows"] == 8
    assert prof["null_user"] == 1 and prof["null_item"] == 1 and prof["null_value"] == 1
    assert prof["non_positive_value"] == 2
    assert prof["clean_rows"] == 5
    assert prof["duplicate_pairs"] == 1 and prof["duplicate_rows"] == 1
    # users 4 and 5 only have non-positive values
    assert prof["users_without_positive"] == 2


def test_run_log_round_trip(spark):
    path = scratch_path(spark, "test-runs", "a")
    append_runs(runs_frame(spark, [{"run_name": "x", "model": "als", "rank": 10, "map_at_10": 0.5}]), path)
    append_runs(runs_frame(spark, [{"run_name": "y", "model": "random", "map_at_10": 0.1}]), path)
    back = read_runs(spark, path)
    assert sorted(r["run_name"] for r in back.collect()) == ["x", "y"]


def test_convert_to_parquet_prunes_by_behavior(spark, tmp_csv):
    from hourglass.sources import convert_to_parquet

    out = scratch_path(spark, "test-parquet", "conv")
    pq = convert_to_parquet(spark, tmp_csv(CSV), out, partition_by=("behavior",))
    assert pq.count() == 9
    plays = pq.where(F.col("behavior") == "play")
    assert plays.count() == 8
    plan = plays._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "behavior" in plan
