import pytest
from pyspark.ml.evaluation import RankingEvaluator, RegressionEvaluator
from pyspark.sql import functions as F

from conftest import SF01
from hourglass.operators import cold_start_coverage, ranking_metrics, ranking_per_user, random_recs, rmse, score_report
from hourglass.plans.workflow import prepare
from hourglass.sources import events_interactions

REC_T = "user INT, recommendations ARRAY<STRUCT<item: INT, rating: FLOAT>>"


def _recs(spark, lists):
    rows = [(u, [(i, float(10 - j)) for j, i in enumerate(items)]) for u, items in lists.items()]
    return spark.createDataFrame(rows, REC_T)


def _test(spark, actual):
    rows = [(u, i, 1.0) for u, items in actual.items() for i in items]
    return spark.createDataFrame(rows, "user INT, item INT, rating DOUBLE")


def test_ranking_fixture_k5(spark):
    recs = _recs(spark, {0: [1, 2, 3, 4, 5], 1: [1, 2, 3, 4, 5], 2: [1, 2, 3, 4, 5], 3: [7, 8]})
    test = _test(spark, {0: [1, 5, 6], 1: [9], 2: [1, 2, 3, 4, 5, 6], 3: [7], 4: [3]})
    per = {r["user"]: r for r in ranking_per_user(recs, test, (5,)).collect()}
    assert set(per) == {0, 1, 2, 3}  # user 4 unknown to the model: left out
    assert per[0]["precision_5"] == pytest.approx(0.4)
    assert per[0]["recall_5"] == pytest.approx(2 / 3)
    assert per[0]["ap_5"] == pytest.approx((1 + 2 / 5) / 3)
    assert per[3]["precision_5"] == pytest.approx(0.2) and per[3]["ap_5"] == pytest.approx(1.0)
    m = ranking_metrics(recs, test, (5,)).first()
    assert m["n_users"] == 4
    assert m["precision"] == pytest.approx(0.4)
    assert m["recall"] == pytest.approx(0.625)
    assert m["map"] == pytest.approx(0.616667, abs=1e-6)


def test_duplicate_test_rows_count_once(spark):
    recs = _recs(spark, {0: [1, 2]})
    test = _test(spark, {0: [1, 1, 1]})
    m = ranking_metrics(recs, test, (2,)).first()
    assert m["recall"] == 1.0 and m["precision"] == 0.5


def test_agrees_with_ranking_evaluator(spark):
    prep = prepare(events_interactions(spark, SF01), behavior="view")
    users = prep.train.select("user").distinct()
    recs = random_recs(users, prep.items.size, 10, seed=3)
    ours = {r["k"]: r for r in ranking_metrics(recs, prep.test, (5, 10)).collect()}
    actual = prep.test.groupBy("user").agg(F.collect_set(F.col("item").cast("double")).alias("label"))
    for k in (5, 10):
        pred = recs.select("user", F.slice(F.col("recommendations.item"), 1, k).cast("array<double>").alias("prediction"))
        joined = actual.join(pred, "user")
        for metric, col in (("precisionAtK", "precision"), ("recallAtK", "recall"), ("meanAveragePrecisionAtK", "map")):
            ev = RankingEvaluator(metricName=metric, k=k, labelCol="label", predictionCol="prediction")
            assert ev.evaluate(joined) == pytest.approx(ours[k][col], abs=1e-12)


def test_random_recs_distinct_and_uniform(spark):
    users = spark.range(2000).select(F.col("id").cast("int").alias("user"))
    recs = random_recs(users, 50, 10, seed=1)
    rows = recs.collect()
    assert all(len(set(x["item"] for x in r["recommendations"])) == 10 for r in rows)
    counts = recs.select(F.explode("recommendations.item").alias("i")).groupBy("i").count().collect()
    assert len(counts) == 50
    expected = 2000 * 10 / 50
    assert all(abs(c["count"] - expected) < 0.35 * expected for c in counts)
    # fewer candidates than k: every candidate once
    small = random_recs(users.limit(3), 4, 10).collect()
    assert all(sorted(x["item"] for x in r["recommendations"]) == [0, 1, 2, 3] for r in small)


def test_cold_start_coverage(spark):
    train = spark.createDataFrame([(0, 0), (0, 1), (1, 0)], "user INT, item INT")
    test = spark.createDataFrame([(0, 1), (1, 1), (2, 0), (0, 9)], "user INT, item INT")
    r = cold_start_coverage(train, test).first()
    assert (r["n_test"], r["n_scored"], r["coverage"]) == (4, 2, 0.5)


def test_score_report_rmse_forms(spark):
    df = spark.createDataFrame(
        [(3.0, 1.0), (0.0, 0.5), (2.0, float("nan")), (1.0, None)], "rating DOUBLE, prediction FLOAT"
    )
    r = score_report(df).first()
    assert r["n_test"] == 4 and r["n_scored"] == 2 and r["coverage"] == 0.5
    assert r["rmse"] == pytest.approx(((2.0**2 + 0.5**2) / 2) ** 0.5)
    assert r["rmse_preference"] == pytest.approx(((0.0**2 + 0.5**2) / 2) ** 0.5)
    scored = df.where(F.col("prediction").isNotNull() & ~F.isnan("prediction"))
    ev = RegressionEvaluator(metricName="rmse", labelCol="rating", predictionCol="prediction").evaluate(scored)
    assert rmse(scored).first()["rmse"] == pytest.approx(ev)
    empty = score_report(df.limit(0)).first()
    assert empty["rmse"] is None and empty["n_scored"] == 0


def test_empty_rec_list_counts_as_evaluated_with_zero(spark):
    recs = spark.createDataFrame([(0, [(1, 1.0)]), (1, [])], REC_T)
    test = _test(spark, {0: [1], 1: [2]})
    m = ranking_metrics(recs, test, (5,)).first()
    assert m["n_users"] == 2
    assert m["recall"] == pytest.approx(0.5) and m["map"] == pytest.approx(0.5)
    assert m["precision"] == pytest.approx(0.1)


def test_random_baseline_near_its_expectation(spark):
    from hourglass.operators.metrics import precision_random_expectation

    prep = prepare(events_interactions(spark, "/root/testdata/sf0.1"), behavior="view")
    users = prep.train.select("user").distinct()
    measured = [
        ranking_metrics(random_recs(users, prep.items.size, 10, seed=s), prep.test, (10,)).first()["precision"]
        for s in (1, 2, 3)
    ]
    expected = precision_random_expectation(prep.test, prep.items.size, 10).first()["expected_precision"]
    assert abs(sum(measured) / 3 - expected) < 0.25 * expected


def test_metric_properties(spark):
    prep = prepare(events_interactions(spark, SF01), behavior="view")
    # perfect recommendations: each user's own test items (|actual| <= K) first
    actual = prep.test.groupBy("user").agg(F.array_sort(F.collect_set("item")).alias("items"))
    perfect = actual.where(F.size("items") <= 10).select(
        "user", F.transform("items", lambda i: F.struct(i.alias("item"), F.lit(1.0).cast("float").alias("rating"))).alias("recommendations")
    )
    m = ranking_metrics(perfect, prep.test, (10,)).first()
    assert m["recall"] == pytest.approx(1.0) and m["map"] == pytest.approx(1.0)
    rnd = {r["k"]: r for r in ranking_metrics(random_recs(prep.train.select("user").distinct(), prep.items.size, 10, 9), prep.test, (5, 10)).collect()}
    assert rnd[10]["recall"] >= rnd[5]["recall"]
    for r in rnd.values():
        assert all(0.0 <= r[c] <= 1.0 for c in ("precision", "recall", "map"))


def test_random_recs_use_all_shuffle_partitions(spark):
    ids = spark.range(2000).select((F.col("id") % 500).cast("int").alias("user")).distinct()
    recs = random_recs(ids, 40, 10)
    counts = recs.groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert len(counts) == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert sum(r["count"] for r in counts) == 500


def test_tables_of_users_are_merged_not_broadcast(spark):
    from hourglass.operators.certificate import residuals
    from hourglass.operators.model import ALSConfig, fit_als, predict, recommend_for_users

    rows = spark.range(400).select((F.col("id") % 60).cast("int").alias("user"), (F.col("id") % 7).cast("int").alias("item"), F.lit(1.0).alias("rating"))
    config = ALSConfig(rank=3, max_iter=1, num_blocks=2)
    m = fit_als(rows, config)
    recs = recommend_for_users(m, 3, rows.select("user").distinct())
    cases = {
        "ranking": (ranking_metrics(recs, rows, (3,)), 3),
        "predict": (predict(m, rows, keep_cold=True), 1),
        "recommend": (recs, 1),
        "certificate": (residuals(m.userFactors, m.itemFactors, rows, config), 2),
    }
    for name, (df, merges) in cases.items():
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        assert plan.count("SortMergeJoin") >= merges, name
        assert "BroadcastHashJoin [user" not in plan and "BroadcastHashJoin [id" not in plan, name
