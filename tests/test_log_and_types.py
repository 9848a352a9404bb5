"""Commit protocol of the run log, and type inference as an aggregate."""

import uuid
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from hourglass.session import scratch_path
from hourglass.sources import append_runs, read_runs, runs_frame, write_interactions_csv
from hourglass.sources.typed_csv import lattice, merge_lattices, read_inferred, read_text, schema_table


def _many(spark, name, n):
    return runs_frame(spark, [{"run_name": f"{name}-{i}", "model": "als", "rank": i} for i in range(n)]).repartition(4)


def test_two_writers_and_a_failed_one(spark):
    path = scratch_path(spark, "test-log", uuid.uuid4().hex)
    assert read_runs(spark, path).count() == 0  # no log yet
    with ThreadPoolExecutor(2) as pool:
        list(pool.map(lambda name: append_runs(_many(spark, name, 25), path), ["a", "b"]))
    # a task that fails after others have written their files
    fails = F.udf(lambda r: 1 // (r - 23) and r, "int")
    with pytest.raises(Exception):
        append_runs(_many(spark, "c", 25).withColumn("rank", fails("rank")), path)
    names = [r["run_name"] for r in read_runs(spark, path).collect()]
    assert sorted(names) == sorted(f"{x}-{i}" for x in "ab" for i in range(25))
    append_runs(runs_frame(spark, []), path)  # an append of nothing
    append_runs(_many(spark, "d", 1), path)
    assert read_runs(spark, path).count() == 51


def test_an_append_without_its_manifest_is_not_seen(spark):
    from hourglass.sources.committed import CommittedWriter, read_committed
    from hourglass.sources.runs import RUNS

    path = scratch_path(spark, "test-log", uuid.uuid4().hex)
    writer = CommittedWriter(path)
    batch = _many(spark, "x", 3).toArrow().to_batches()
    first = writer.write(iter(batch))
    assert first.rows == 3 and read_committed(spark, path).count() == 0
    writer.write(iter(batch))  # a repeated task, whose message is dropped
    writer.commit([first])
    got = read_committed(spark, path)
    assert got.count() == 3 and got.schema.simpleString() == RUNS.simpleString()
    gone = writer.write(iter(batch))
    writer.abort([gone, None])
    assert read_committed(spark, path).count() == 3


LINES = """1,Game A,play,1.5
2,"Game, B",play,2
too,few
30000000000,Game C,purchase,1e3
5,Game D,play,7,too,many
,,,
"""


def test_inferred_types_and_corrupt_rows(spark, tmp_csv):
    path = tmp_csv(LINES)
    df = read_inferred(spark, path)
    assert [f.dataType.simpleString() for f in df.schema.fields] == ["bigint", "string", "string", "double", "string"]
    rows = df.collect()
    assert [r["_corrupt_record"] for r in rows if r["_corrupt_record"]] == ["too,few", "5,Game D,play,7,too,many"]
    assert all(r["user_id"] is None and r["game"] is None for r in rows if r["_corrupt_record"])
    good = [tuple(r)[:4] for r in rows if not r["_corrupt_record"]]
    assert good == [(1, "Game A", "play", 1.5), (2, "Game, B", "play", 2.0), (30000000000, "Game C", "purchase", 1000.0), (None, None, None, None)]
    assert tuple(lattice(read_text(spark, path)).select("n_rows", "n_corrupt").first()) == (6, 2)
    assert [tuple(r) for r in schema_table(spark, path).orderBy("position").collect()] == [(0, "user_id", "bigint"), (1, "game", "string"), (2, "behavior", "string"), (3, "value", "double")]


@pytest.mark.parametrize("values, want", [
    (["1", "2"], "int"), (["1", "3000000000"], "bigint"), (["1", "2.5", "NaN"], "double"), (["1", "x"], "string"), (["2024-01-31", "2024-02-01"], "date"),
    (["2024-01-31", "2024-01-31 10:11:12"], "timestamp"), (["true", "False"], "boolean"), (["true", "1"], "string"), (["2024-02-31"], "string"), (["2024-01-31", "7"], "string"), (["", ""], "string"),
])
def test_least_common_type(spark, tmp_path, values, want):
    (tmp_path / "x.csv").write_text("".join(f'k,"{v}"\n' for v in values))
    got = {r["name"]: r["type"] for r in schema_table(spark, str(tmp_path / "x.csv"), ("k", "v")).collect()}
    assert got == {"k": "string", "v": want}
    df = read_inferred(spark, str(tmp_path / "x.csv"), ("k", "v"))
    assert df.schema["v"].dataType.simpleString() == want and df.count() == len(values)


def test_lattices_merge_and_agree_with_spark(spark):
    base = spark.range(200).select(F.col("id").alias("user_id"), F.concat(F.lit("g"), F.col("id") % 7).alias("game"), F.lit("play").alias("behavior"), (F.col("id") / 4).alias("value"))
    paths = [scratch_path(spark, "test-types", uuid.uuid4().hex) for _ in range(2)]
    write_interactions_csv(base, paths[0])
    write_interactions_csv(base.withColumn("user_id", F.col("user_id") + 10**10), paths[1])
    merged = merge_lattices(*[lattice(read_text(spark, p)) for p in paths]).first()
    both = lattice(spark.read.schema(read_text(spark, paths[0]).schema).csv(paths)).first()
    assert tuple(merged) == tuple(both)
    for p in paths:
        ours = [f.dataType.simpleString() for f in read_inferred(spark, p).schema.fields][:4]
        assert ours == [f.dataType.simpleString() for f in spark.read.option("inferSchema", True).csv(p).schema.fields]
