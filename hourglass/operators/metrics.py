"""Evaluation: RMSE forms, coverage, ranking metrics at K, random baseline.

Ranking metrics follow the reference's definitions exactly:

* evaluated users = users with a test item AND a recommendation row (test
  users unknown to the model are left out, not scored 0);
* hits = distinct test items ∩ distinct recommended items;
* Precision@K = hits / K (even when fewer than K items were recommended);
* Recall@K = hits / distinct test items;
* AP@K = Σ over hit positions of (hits so far)/(position from 1), divided by
  min(|test items|, K); 0 without a hit;
* each metric is the unweighted mean over evaluated users.

They are computed as one relational plan. Nothing is collected per user:
recommendation positions (≤ K per user) are joined to the distinct test
pairs on (user, item), so a user with a huge test history adds rows to a
partial aggregate, never to a single in-memory list. Both sides of these joins
grow with the users, so they are merged and not sent through the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.permutation import permuted

KS = (5, 10)


def score_report(scored: DataFrame, rating: str = "rating", prediction: str = "prediction") -> DataFrame:
    """n_test, n_scored, coverage, rmse, rmse_preference in one aggregate.

    ``scored`` holds every test row, with NaN/NULL predictions for cold ids
    (``predict(..., keep_cold=True)``). ``rmse`` compares the raw value with
    the prediction (the reference's number); ``rmse_preference`` compares the
    implicit preference (1 when the value is > 0) the model actually fits.
    RMSE is NULL, not an error, when nothing was scored.
    """
    p = F.col(prediction).cast("double")
    ok = p.isNotNull() & ~F.isnan(p)
    err = F.when(ok, F.pow(F.col(rating) - p, 2))
    pref = F.when(F.col(rating) > 0, F.lit(1.0)).otherwise(F.lit(0.0))
    err_pref = F.when(ok, F.pow(pref - p, 2))
    return scored.agg(
        F.count(F.lit(1)).alias("n_test"),
        F.sum(ok.cast("long")).alias("n_scored"),
        F.sqrt(F.avg(err)).alias("rmse"),
        F.sqrt(F.avg(err_pref)).alias("rmse_preference"),
    ).select(
        "n_test",
        F.coalesce(F.col("n_scored"), F.lit(0)).cast("bigint").alias("n_scored"),
        F.try_divide(F.coalesce(F.col("n_scored"), F.lit(0)), F.col("n_test")).alias("coverage"),
        "rmse",
        "rmse_preference",
    )


def rmse(predictions: DataFrame, rating: str = "rating", prediction: str = "prediction") -> DataFrame:
    """Plain RMSE over scored rows (same value as ``RegressionEvaluator``)."""
    return predictions.agg(F.sqrt(F.avg(F.pow(F.col(rating) - F.col(prediction), 2))).alias("rmse"))


def actual_items(test: DataFrame, user: str = "user", item: str = "item") -> DataFrame:
    """(user, actual_items ARRAY<INT> sorted) – the test set per user.

    For presentation and small users; the metrics below do not need it.
    """
    return test.groupBy(user).agg(F.array_sort(F.collect_set(item)).alias("actual_items"))


def rec_items(recs: DataFrame, user: str = "user", field: str = "item") -> DataFrame:
    """(user, rec_items_ordered, rec_items): the recommended ids in rank order
    and as a sorted set; a per-row projection, no regrouping."""
    ordered = F.col(f"recommendations.{field}")
    return recs.select(
        user,
        ordered.alias("rec_items_ordered"),
        F.array_sort(F.array_distinct(ordered)).alias("rec_items"),
    )


def rec_positions(recs: DataFrame, k: int, user: str = "user", field: str = "item") -> DataFrame:
    """(user, pos, item): first ``k`` distinct recommended ids, 0-based rank."""
    ordered = F.slice(F.array_distinct(F.col(f"recommendations.{field}")), 1, k)
    return recs.select(user, F.posexplode(ordered).alias("pos", field))


def _actual_pairs(test: DataFrame, user: str, item: str) -> DataFrame:
    return test.select(user, item).where(F.col(user).isNotNull() & F.col(item).isNotNull()).distinct()


def _rec_steps(recs: DataFrame, test: DataFrame, k: int, user: str, item: str) -> DataFrame:
    """(user, pos, item, hit, hit_no, precision_at_hit) for every recommended
    position in the top ``k``; a user with an empty list keeps one row with
    NULL pos/item so it still counts as having recommendations.

    ``recs`` is read exactly once: every figure below derives from this one
    flow, so an expensive recommendation plan is never computed twice.

    ``recs`` is either nested (user, recommendations ARRAY<STRUCT<item, …>>),
    as from ``recommendForAll*``, or flat (user, rank, item) with rank from 1
    and distinct items per user, as from ``topk.top_k_by_dot``.
    """
    actual = _actual_pairs(test, user, item).withColumn("_hit", F.lit(1))
    if "recommendations" in recs.columns:
        ordered = F.slice(F.array_distinct(F.col(f"recommendations.{item}")), 1, k)
        pos = recs.select(user, F.posexplode_outer(ordered).alias("pos", item))
    else:
        pos = recs.where(F.col("rank") <= F.lit(k)).select(user, (F.col("rank") - 1).cast("int").alias("pos"), item)
    flagged = pos.join(actual.hint("merge"), [user, item], "left").select(
        user, "pos", item, F.coalesce(F.col("_hit"), F.lit(0)).alias("hit")
    )
    w = Window.partitionBy(user).orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    hit_no = F.sum("hit").over(w)
    return flagged.withColumn("hit_no", hit_no).withColumn(
        "precision_at_hit",
        F.when(F.col("hit") == 1, F.col("hit_no") / (F.col("pos") + F.lit(1))).otherwise(F.lit(0.0)),
    )


def hits_per_user(recs: DataFrame, test: DataFrame, k: int, user: str = "user", item: str = "item") -> DataFrame:
    """(user, n_actual, n_recs, hits) for every evaluated user."""
    n_actual = _actual_pairs(test, user, item).groupBy(user).agg(F.count(F.lit(1)).alias("n_actual"))
    per_user = _rec_steps(recs, test, k, user, item).groupBy(user).agg(
        F.count(item).alias("n_recs"), F.sum("hit").cast("bigint").alias("hits")
    )
    return n_actual.join(per_user, user, "inner").select(user, "n_actual", "n_recs", "hits")


def running_precision(recs: DataFrame, test: DataFrame, k: int, user: str = "user", item: str = "item") -> DataFrame:
    """(user, pos, item, hit_no, precision_at_hit) for each hit in the top ``k``.

    ``hit_no`` is the running hit count (a window over at most ``k`` rows per
    user) and ``precision_at_hit`` = hit_no / (pos + 1), the AP summand.
    """
    steps = _rec_steps(recs, test, k, user, item)
    return steps.where(F.col("hit") == 1).select(user, "pos", item, F.col("hit_no").cast("bigint").alias("hit_no"), "precision_at_hit")


def ranking_per_user(recs: DataFrame, test: DataFrame, ks=KS, user: str = "user", item: str = "item") -> DataFrame:
    """Per evaluated user: n_actual and precision/recall/ap for each K."""
    ks = tuple(sorted(set(int(k) for k in ks)))
    kmax = ks[-1]
    n_actual = _actual_pairs(test, user, item).groupBy(user).agg(F.count(F.lit(1)).alias("n_actual"))
    aggs = []
    for k in ks:
        in_k = F.col("pos") < F.lit(k)
        aggs.append(F.sum(F.when(in_k, F.col("hit")).otherwise(F.lit(0))).alias(f"hits_{k}"))
        aggs.append(F.sum(F.when(in_k, F.col("precision_at_hit")).otherwise(F.lit(0.0))).alias(f"ap_sum_{k}"))
    per_user = _rec_steps(recs, test, kmax, user, item).groupBy(user).agg(*aggs)
    base = n_actual.where(F.col("n_actual") > 0).join(per_user.hint("merge"), user, "inner")
    cols = [F.col(user), F.col("n_actual")]
    for k in ks:
        h = F.col(f"hits_{k}").cast("double")
        cols.append((h / F.lit(float(k))).alias(f"precision_{k}"))
        cols.append((h / F.col("n_actual")).alias(f"recall_{k}"))
        cols.append((F.col(f"ap_sum_{k}") / F.least(F.col("n_actual"), F.lit(k)).cast("double")).alias(f"ap_{k}"))
    return base.select(*cols)


def ranking_metrics(recs: DataFrame, test: DataFrame, ks=KS, user: str = "user", item: str = "item") -> DataFrame:
    """(k INT, n_users BIGINT, precision, recall, map): one row per K.

    Recommendations fetched once at max(K) serve every smaller K.
    """
    ks = tuple(sorted(set(int(k) for k in ks)))
    per_user = ranking_per_user(recs, test, ks, user, item)
    aggs = [F.count(F.lit(1)).alias("n_users")]
    for k in ks:
        aggs += [
            F.avg(f"precision_{k}").alias(f"p{k}"),
            F.avg(f"recall_{k}").alias(f"r{k}"),
            F.avg(f"ap_{k}").alias(f"m{k}"),
        ]
    wide = per_user.agg(*aggs)
    rows = F.array(
        *[
            F.struct(
                F.lit(k).cast("int").alias("k"),
                F.col("n_users").cast("bigint").alias("n_users"),
                F.col(f"p{k}").alias("precision"),
                F.col(f"r{k}").alias("recall"),
                F.col(f"m{k}").alias("map"),
            )
            for k in ks
        ]
    )
    return wide.select(F.explode(rows).alias("m")).select("m.*")


def random_recs(ids: DataFrame, n_candidates: int, k: int, seed: int = 42, id_col: str = "user", field: str = "item") -> DataFrame:
    """Random recommender: ``min(k, n)`` distinct candidate ids per row of ``ids``.

    Candidates are the dense ids ``0..n-1`` of a dictionary. Each id of ``ids``
    orders all candidates by a permutation of its own (``functions.permutation``)
    and gets the first ``k``: a uniform sample without replacement, whose
    positions are independent – the random baseline the reference quotes in
    prose – without enumerating any user × item pairs. The ids are dealt over
    all shuffle partitions first: they are few bytes but much work, and adaptive
    execution would leave them to as many tasks as their bytes fill.
    Output: (id_col, recommendations ARRAY<STRUCT<field INT, rating FLOAT>>),
    ratings 1, 1/2, 1/3, … in rank order.
    """
    m = min(int(k), int(n_candidates))
    if m <= 0:
        empty = F.array().cast(f"array<struct<{field}:int,rating:float>>")
        return ids.select(id_col, empty.alias("recommendations"))
    tasks = int(ids.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    recs = F.transform(
        F.sequence(F.lit(0), F.lit(m - 1)),
        lambda j: F.struct(
            permuted(j, F.col(id_col), int(n_candidates), f"random:{seed}").cast("int").alias(field),
            (F.lit(1.0) / (j + F.lit(1))).cast("float").alias("rating"),
        ),
    )
    # a hash of the hash: by the id itself it would be dropped after a distinct
    return ids.repartition(tasks, F.xxhash64(id_col)).select(id_col, recs.alias("recommendations"))


def precision_random_expectation(test: DataFrame, n_items: int, k: int, user: str = "user", item: str = "item") -> DataFrame:
    """Expected Precision@K of a uniform random recommender: mean |actual| / n."""
    actual = _actual_pairs(test, user, item)
    per_user = actual.groupBy(user).agg(F.count(F.lit(1)).alias("n_actual"))
    m = min(k, n_items)
    return per_user.agg(
        (F.avg(F.least(F.col("n_actual"), F.lit(n_items)) * F.lit(m / max(n_items, 1))) / F.lit(float(k))).alias(
            "expected_precision"
        )
    )

