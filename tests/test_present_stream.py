
from conftest import SF001
from hourglass.operators import build_dictionary, first_rows, flatten_user_recs, readable_item_recs, readable_user_recs, users_for_game
from hourglass.streaming import item_totals_from_files

REC_U = "user INT, recommendations ARRAY<STRUCT<item: INT, rating: FLOAT>>"
REC_I = "item INT, recommendations ARRAY<STRUCT<user: INT, rating: FLOAT>>"


def test_readable_recs_both_directions(spark):
    items = build_dictionary(spark.createDataFrame([("Go",), ("Go",), ("Chess",)], "game STRING"), "game")
    users = build_dictionary(spark.createDataFrame([(7,), (9,), (9,)], "user_id BIGINT"), "user_id")
    urecs = spark.createDataFrame([(0, [(1, 0.9), (0, 0.5)])], REC_U)
    rows = readable_user_recs(urecs, items, users).orderBy("rank").collect()
    assert [(r["rank"], r["game_id"], r["game"], r["user_id"]) for r in rows] == [(1, 1, "Chess", "9"), (2, 0, "Go", "9")]
    irecs = spark.createDataFrame([(0, [(1, 0.7), (0, 0.8)])], REC_I)
    named = readable_item_recs(irecs, items, users)
    got = users_for_game(named, "Go").collect()
    assert [r["recommended_user"] for r in got] == [0, 1]  # best score first
    assert [r["recommended_user_id"] for r in got] == ["9", "7"]
    assert first_rows(flatten_user_recs(urecs), 1).first()["rank"] == 1


def test_streaming_totals_equal_batch(spark):
    from hourglass.operators import plays, totals
    from hourglass.sources import events_interactions

    stream = {r["game"]: r["total_hours"] for r in item_totals_from_files(spark, SF001, "events.parquet", "view").collect()}
    batch = {r["game"]: r["total_hours"] for r in totals(plays(events_interactions(spark, SF001), "view"), "game").collect()}
    assert stream.keys() == batch.keys()
    assert all(abs(stream[k] - batch[k]) < 1e-9 for k in batch)


def test_streaming_totals_resume_from_checkpoint(spark, tmp_path):
    import shutil

    from hourglass.operators import plays, totals
    from hourglass.session import scratch_path
    from hourglass.sources import events_interactions
    from hourglass.streaming import item_totals_job

    src = tmp_path / "events"
    src.mkdir()
    shutil.copy(f"{SF001}/events.parquet", src / "part-1.parquet")
    out = scratch_path(spark, "test-stream", "totals")
    ckpt = scratch_path(spark, "test-stream", "state")
    first = {r["game"]: r["total_hours"] for r in item_totals_job(spark, str(src), out, ckpt).collect()}
    shutil.copy(f"{SF001}/events.parquet", src / "part-2.parquet")  # two more files arrive
    shutil.copy(f"{SF001}/events.parquet", src / "part-3.parquet")
    second = {
        r["game"]: r["total_hours"]
        for r in item_totals_job(spark, str(src), out, ckpt, max_files_per_trigger=1).collect()  # one file per batch
    }
    batch = {r["game"]: r["total_hours"] for r in totals(plays(events_interactions(spark, SF001), "view"), "game").collect()}
    assert all(abs(first[g] - batch[g]) < 1e-9 for g in batch)
    assert all(abs(second[g] - 3 * batch[g]) < 1e-9 for g in batch)  # three files, each counted once
