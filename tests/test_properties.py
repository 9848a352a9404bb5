"""Property tests: Spark operators against plain-Python statements of the
same definitions on random small inputs."""

import hashlib
from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from hourglass.functions import hash_bucket
from hourglass.operators import build_dictionary, ranking_metrics
from test_hot_keys import sql_metrics

SLOW = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))

recs_st = st.dictionaries(
    st.integers(0, 8), st.lists(st.integers(0, 30), min_size=0, max_size=12, unique=True), min_size=1, max_size=6
)
actual_st = st.dictionaries(st.integers(0, 10), st.lists(st.integers(0, 30), min_size=1, max_size=15), min_size=1, max_size=8)


@SLOW
@given(recs=recs_st, actual=actual_st, k=st.sampled_from([1, 3, 5, 10]))
def test_ranking_metrics_match_definition(spark, recs, actual, k):
    evaluated = [u for u in recs if u in actual]
    recs_df = spark.createDataFrame(
        [(u, [(i, 1.0) for i in r]) for u, r in recs.items()],
        "user INT, recommendations ARRAY<STRUCT<item: INT, rating: FLOAT>>",
    )
    test_df = spark.createDataFrame([(u, i) for u, its in actual.items() for i in its], "user INT, item INT")
    got = ranking_metrics(recs_df, test_df, (k,)).collect()
    if not evaluated:
        assert got[0]["n_users"] == 0
        return
    _, p, r, m = sql_metrics(recs, actual, k)
    assert got[0]["n_users"] == len(evaluated)
    assert got[0]["precision"] == pytest.approx(p, abs=1e-12)
    assert got[0]["recall"] == pytest.approx(r, abs=1e-12)
    assert got[0]["map"] == pytest.approx(m, abs=1e-12)


@SLOW
@given(labels=st.lists(st.text(alphabet="abcxyz09", min_size=1, max_size=3), min_size=1, max_size=60))
def test_dictionary_order_matches_rule(spark, labels):
    d = build_dictionary(spark.createDataFrame([(x,) for x in labels], "game STRING"), "game", partitions=3)
    counts = Counter(labels)
    expected = sorted(counts, key=lambda x: (-counts[x], x.encode()))
    got = {r["label"]: (r["idx"], r["n"]) for r in d.table.collect()}
    assert {lab: got[lab][0] for lab in got} == {lab: i for i, lab in enumerate(expected)}
    assert all(got[lab][1] == counts[lab] for lab in counts)


@SLOW
@given(pairs=st.lists(st.tuples(st.integers(0, 10**12), st.text(min_size=0, max_size=8)), min_size=1, max_size=30))
def test_md5_split_bucket_is_portable(spark, pairs):
    df = spark.createDataFrame(pairs, "user_id BIGINT, game STRING")
    got = [r["b"] for r in df.select(hash_bucket("user_id", "game", seed=42).alias("b")).collect()]
    want = [int(hashlib.md5(f"{u}|{g}|42".encode()).hexdigest()[:8], 16) % 10_000 for u, g in pairs]
    assert got == want
