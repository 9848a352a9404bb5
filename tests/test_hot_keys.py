"""One user holding a third of all rows: results stay whole and exact, and
the shuffle join on that user is split by AQE instead of running as one task."""

import contextlib
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from hourglass.operators import build_dictionaries, encode, profile, ranking_metrics

AQE_SMALL = {
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
}


@contextlib.contextmanager
def conf(spark, values):
    old = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def _hot(spark, n=300_000):
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id") % 5000 + 2).alias("user_id"),
        (F.col("id") % 997).cast("string").alias("game"),
        F.lit(1.0).alias("value"),
    )


def test_hot_user_encode_is_whole_and_split(spark):
    with conf(spark, AQE_SMALL):
        df = _hot(spark)
        d = build_dictionaries(df, {"user": "user_id", "item": "game"})
        assert d["user"].table.where("label = '1'").first()["idx"] == 0  # most rows → id 0
        enc = encode(df, d["user"], "user_id", "user", max_broadcast_rows=0)  # force the shuffle join
        rows = enc.collect()
        plan = enc._jdf.queryExecution().executedPlan().toString()
    assert len(rows) == 300_000
    assert sum(1 for r in rows if r["user_id"] == 1) == 100_000
    assert "skew=true" in plan


def test_hot_user_profile_counts(spark):
    prof = {r["metric"]: r["n"] for r in profile(_hot(spark, 30_000)).collect()}
    assert prof["rows"] == 30_000 and prof["clean_rows"] == 30_000
    # user 1 meets each game about 10 times: 997 duplicate pairs for that user alone
    assert prof["duplicate_pairs"] >= 997
    assert prof["max_rows_per_user"] == 10_000 and prof["max_items_per_user"] == 997


def sql_metrics(recs, actual, k):
    """(n_users, precision, recall, map) by their definitions, in DuckDB SQL."""
    con = duckdb.connect()
    con.execute("CREATE TABLE rec (u INTEGER, pos INTEGER, item INTEGER)")
    con.execute("CREATE TABLE act (u INTEGER, item INTEGER)")
    con.execute("CREATE TABLE listed (u INTEGER)")
    con.executemany("INSERT INTO listed VALUES (?)", [(u,) for u in recs])
    rows = [(u, j + 1, i) for u, r in recs.items() for j, i in enumerate(r[:k])]
    if rows:
        con.executemany("INSERT INTO rec VALUES (?, ?, ?)", rows)
    con.executemany("INSERT INTO act VALUES (?, ?)", [(u, i) for u, its in actual.items() for i in its])
    return con.execute(f"""
        WITH wanted AS (SELECT DISTINCT u, item FROM act),
        size AS (SELECT u, count(*) AS n FROM wanted GROUP BY u),
        judged AS (SELECT size.u, n FROM size SEMI JOIN listed USING (u)),
        hit AS (SELECT u, pos, row_number() OVER (PARTITION BY u ORDER BY pos) AS nth FROM rec SEMI JOIN wanted USING (u, item)),
        per AS (SELECT u, count(*) AS hits, sum(nth / pos) AS run FROM hit GROUP BY u)
        SELECT count(*), avg(coalesce(hits, 0) / {k}), avg(coalesce(hits, 0) / n), avg(coalesce(run, 0) / least(n, {k}))
        FROM judged LEFT JOIN per USING (u)""").fetchone()


def test_ranking_metrics_with_hot_user_match_sql(spark):
    rnd = random.Random(5)
    n_items, k = 300, 10
    recs = {u: rnd.sample(range(n_items), k) for u in range(60)}
    actual = {u: [rnd.randrange(n_items) for _ in range(rnd.randint(1, 12))] for u in range(70)}
    actual[0] = [rnd.randrange(n_items) for _ in range(3000)]  # hot user: most test rows
    recs_df = spark.createDataFrame(
        [(u, [(i, 1.0 / (j + 1)) for j, i in enumerate(r)]) for u, r in recs.items()],
        "user INT, recommendations ARRAY<STRUCT<item: INT, rating: FLOAT>>",
    )
    test_df = spark.createDataFrame([(u, i) for u, its in actual.items() for i in its], "user INT, item INT")
    got = ranking_metrics(recs_df, test_df, (k,)).first()
    _, p, r, m = sql_metrics(recs, actual, k)
    assert got["precision"] == pytest.approx(p, abs=1e-12)
    assert got["recall"] == pytest.approx(r, abs=1e-12)
    assert got["map"] == pytest.approx(m, abs=1e-12)


def test_hot_item_encode_is_whole_and_split(spark):
    with conf(spark, AQE_SMALL):
        df = spark.range(300_000).select(
            (F.col("id") % 5000).alias("user_id"),
            F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") % 997).cast("string")).alias("game"),
            F.lit(1.0).alias("value"),
        )
        d = build_dictionaries(df, {"user": "user_id", "item": "game"})
        assert d["item"].table.where("label = 'hot'").first()["idx"] == 0
        enc = encode(df, d["item"], "game", "item", max_broadcast_rows=0)
        rows = enc.collect()
        plan = enc._jdf.queryExecution().executedPlan().toString()
    assert len(rows) == 300_000 and sum(1 for r in rows if r["game"] == "hot") == 100_000
    assert "skew=true" in plan
