"""NULL / NaN / duplicate semantics on random small tables: the Spark
operators against DuckDB SQL over the same rows (the shared test tables have
no NULLs, so the oracle queries never reach these branches)."""

import math

import duckdb
import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from hourglass.operators import cardinalities, clean_interactions, profile, top_n, totals

SLOW = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))

value_st = st.one_of(st.none(), st.just(float("nan")), st.sampled_from([0.0, -1.5, 0.25, 2.0, 10.0]))
row_st = st.tuples(
    st.one_of(st.none(), st.integers(1, 4)),
    st.one_of(st.none(), st.sampled_from(["a", "b", "c"])),
    st.sampled_from(["play", "purchase"]),
    value_st,
)
SCHEMA = "user_id BIGINT, game STRING, behavior STRING, value DOUBLE"


def _duck(rows):
    pdf = pd.DataFrame(rows, columns=["user_id", "game", "behavior", "value"]).astype(
        {"user_id": "Int64", "game": "object", "behavior": "object", "value": "float64"}
    )
    con = duckdb.connect()
    con.register("pl_raw", pdf)
    # pandas NaN in a float column is NULL for DuckDB unless kept apart: rebuild NaN explicitly
    flags = [v is not None and isinstance(v, float) and math.isnan(v) for (_, _, _, v) in rows]
    con.register("nanflags", pd.DataFrame({"i": range(len(rows)), "is_nan": flags}))
    con.execute(
        """CREATE VIEW pl AS SELECT r.user_id, r.game, r.behavior,
                  CASE WHEN f.is_nan THEN 'NaN'::DOUBLE ELSE r.value END AS value
           FROM (SELECT *, row_number() OVER () - 1 AS i FROM pl_raw) r JOIN nanflags f USING (i)"""
    )
    return con


PROFILE_SQL = """
WITH pairs AS (SELECT user_id, game, count(*) AS c FROM pl WHERE user_id IS NOT NULL AND game IS NOT NULL GROUP BY 1, 2),
ok AS (SELECT * FROM pl WHERE user_id IS NOT NULL AND game IS NOT NULL AND value IS NOT NULL AND NOT isnan(value)),
pu AS (SELECT user_id, max(value) AS mx FROM ok GROUP BY 1)
SELECT 'rows' AS metric, count(*) AS n FROM pl
UNION ALL SELECT 'null_user', count(*) FROM pl WHERE user_id IS NULL
UNION ALL SELECT 'null_item', count(*) FROM pl WHERE game IS NULL
UNION ALL SELECT 'null_value', count(*) FROM pl WHERE value IS NULL
UNION ALL SELECT 'nan_value', count(*) FROM pl WHERE value IS NOT NULL AND isnan(value)
UNION ALL SELECT 'non_positive_value', count(*) FROM pl WHERE value IS NOT NULL AND NOT isnan(value) AND value <= 0
UNION ALL SELECT 'clean_rows', count(*) FROM ok
UNION ALL SELECT 'duplicate_pairs', count(*) FROM pairs WHERE c > 1
UNION ALL SELECT 'duplicate_rows', CAST(coalesce(sum(c - 1), 0) AS BIGINT) FROM pairs WHERE c > 1
UNION ALL SELECT 'users_without_positive', count(*) FROM pu WHERE mx <= 0
UNION ALL SELECT 'max_rows_per_user', coalesce(max(c), 0) FROM (SELECT user_id, count(*) AS c FROM pl WHERE user_id IS NOT NULL AND game IS NOT NULL GROUP BY 1)
UNION ALL SELECT 'max_items_per_user', coalesce(max(c), 0) FROM (SELECT user_id, count(DISTINCT game) AS c FROM pl WHERE user_id IS NOT NULL AND game IS NOT NULL GROUP BY 1)
"""


@SLOW
@given(rows=st.lists(row_st, min_size=0, max_size=25))
def test_profile_and_cleaning_match_sql(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    con = _duck(rows)
    ours = {r["metric"]: r["n"] for r in profile(df).collect()}
    want = {m: n for m, n in con.execute(PROFILE_SQL).fetchall()}
    assert ours == want
    assert clean_interactions(df).count() == want["clean_rows"]


@SLOW
@given(rows=st.lists(row_st, min_size=0, max_size=25))
def test_cardinalities_and_totals_match_sql(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    con = _duck(rows)
    c = cardinalities(df).first()
    want = con.execute(
        """SELECT count(*), count(DISTINCT user_id) + coalesce(max(CASE WHEN user_id IS NULL THEN 1 ELSE 0 END), 0),
                  count(DISTINCT user_id), count(DISTINCT game) + coalesce(max(CASE WHEN game IS NULL THEN 1 ELSE 0 END), 0),
                  count(DISTINCT game) FROM pl"""
    ).fetchone()
    assert (c["n_rows"], c["user_id_distinct"], c["user_id_non_null"], c["game_distinct"], c["game_non_null"]) == want
    # top games by summed value: NULL game is its own group, NULL/NaN sums order last-by-value rules
    ours = [(r["game"], r["total_hours"]) for r in top_n(totals(df.where("value IS NOT NULL AND NOT isnan(value)"), "game"), "total_hours", "game", 3).collect()]
    sql = con.execute(
        """SELECT game, sum(value) AS t FROM pl WHERE value IS NOT NULL AND NOT isnan(value)
           GROUP BY 1 ORDER BY t DESC NULLS LAST, game ASC NULLS LAST LIMIT 3"""
    ).fetchall()
    assert [(g, round(t, 9)) for g, t in ours] == [(g, round(t, 9)) for g, t in sql]
