"""DuckDB SQL for every SQL-expressible registered query.

Written independently of the Spark operators: dictionaries use a global
``row_number()``, the split and the random recommender use md5 text, metrics
use a window and plain aggregates. Tables are the pre-registered views.
"""

from __future__ import annotations

SEED = "42"

# Fixture E: events as interactions; 'view' is the modelled behaviour.
_EV = """
ev AS (SELECT user_id, json_extract_string(props, '$.k') AS game, event_type AS behavior, value FROM events),
pl AS (SELECT * FROM ev WHERE behavior = 'view'),
cl AS (SELECT * FROM pl WHERE user_id IS NOT NULL AND game IS NOT NULL AND value IS NOT NULL AND NOT isnan(value))
"""

# Fixture S: lineitem joined with orders.
_SALES = """
sa AS (SELECT o.o_custkey AS user_id, CAST(l.l_partkey AS VARCHAR) AS game, l.l_returnflag AS behavior, l.l_quantity AS value
       FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)
"""


def _dict(src: str, expr: str) -> str:
    return f"""SELECT label, CAST(row_number() OVER (ORDER BY n DESC, label) - 1 AS INTEGER) AS idx, n
       FROM (SELECT CAST({expr} AS VARCHAR) AS label, count(*) AS n FROM {src} WHERE {expr} IS NOT NULL GROUP BY 1)"""


def _prep_chain(src: str, clean_cte: str) -> str:
    """dictionaries → ids → md5 split → ratings, over the cleaned rows ``clean_cte``."""
    return src + f""",
idict AS ({_dict(clean_cte, 'game')}),
udict AS ({_dict(clean_cte, 'user_id')}),
enc AS (SELECT c.user_id, c.game, c.value, u.idx AS "user", i.idx AS item
        FROM {clean_cte} c JOIN udict u ON CAST(c.user_id AS VARCHAR) = u.label JOIN idict i ON c.game = i.label),
sp AS (SELECT *, CASE WHEN ('0x' || substr(md5(concat_ws('|', CAST(user_id AS VARCHAR), game, '{SEED}')), 1, 8))::BIGINT % 10000 < 2000
                      THEN 'test' ELSE 'train' END AS split FROM enc),
rt AS (SELECT "user", item, CAST(value AS DOUBLE) AS rating, split FROM sp),
train AS (SELECT "user", item, rating FROM rt WHERE split = 'train'),
test AS (SELECT "user", item, rating FROM rt WHERE split = 'test')
"""


_SALES_CLEAN = _SALES + """,
scl AS (SELECT * FROM sa WHERE user_id IS NOT NULL AND game IS NOT NULL AND value IS NOT NULL AND NOT isnan(value))
"""

_PREP_SALES = _prep_chain(_SALES_CLEAN, "scl")

_PREP = _prep_chain(_EV, "cl")


def _random(ids_sql: str, id_col: str, field: str, n_sql: str, k: int, seed: str = SEED) -> str:
    """The first k numbers of each id's permutation of 0 .. n - 1: six rounds
    over a grid a x b, again while the number is n or more."""
    md5 = lambda half: f"('0x' || substr(md5(concat_ws('|', CAST(w.id AS VARCHAR), CAST(turn % 6 AS VARCHAR), CAST({half} AS VARCHAR), 'random:{seed}')), 1, 8))::BIGINT % 2147483647"
    return f"""SELECT id AS {id_col}, pos, CAST(l * b + r AS INTEGER) AS {field}, CAST(1.0 / (pos + 1) AS FLOAT) AS rating FROM (
       WITH RECURSIVE nn AS ({n_sql}),
       root AS (SELECT n, CAST(ceil(sqrt(n)) AS BIGINT) AS root FROM nn),
       sides AS (SELECT n, root + s AS a, (n + root + s - 1) // (root + s) AS b FROM root, range(0, 100) t(s)),
       side AS (SELECT n, a, b FROM sides ORDER BY a * b, a LIMIT 1),
       w AS (SELECT ids.{id_col} AS id, CAST(g.j AS INTEGER) AS pos, 0 AS turn, CAST(g.j // b AS BIGINT) AS l, CAST(g.j % b AS BIGINT) AS r
             FROM ({ids_sql}) ids, side, generate_series(0, {k - 1}) g(j) WHERE g.j < n
             UNION ALL
             SELECT w.id, w.pos, turn + 1, CASE WHEN turn % 2 = 0 THEN (l + {md5('r')}) % a ELSE l END,
                    CASE WHEN turn % 2 = 1 THEN (r + {md5('l')}) % b ELSE r END
             FROM w, side WHERE turn = 0 OR turn % 6 <> 0 OR l * b + r >= n)
       SELECT w.*, b FROM w, side WHERE turn > 0 AND turn % 6 = 0 AND l * b + r < n)"""


def _rr10(prep: str) -> str:
    return prep + f""",
rr AS ({_random('SELECT DISTINCT "user" FROM train', '"user"', 'item', 'SELECT count(*) AS n FROM idict', 10)}),
te AS (SELECT DISTINCT "user", item FROM test WHERE item IS NOT NULL),
na AS (SELECT "user", count(*) AS n_actual FROM te GROUP BY 1),
hit AS (SELECT rr."user", rr.pos, rr.item FROM rr JOIN te ON rr."user" = te."user" AND rr.item = te.item),
run AS (SELECT "user", pos, item,
               count(*) OVER (PARTITION BY "user" ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS hit_no
        FROM hit)
"""


_RR10 = _rr10(_PREP)


def _metrics_sql(ks=(5, 10), prep: str | None = None) -> str:
    ph = ", ".join(
        f"sum(CASE WHEN pos < {k} THEN 1 ELSE 0 END) AS h{k}, sum(CASE WHEN pos < {k} THEN hit_no / (pos + 1) ELSE 0 END) AS a{k}"
        for k in ks
    )
    pu = ", ".join(
        f"coalesce(h{k}, 0) / {k}.0 AS p{k}, coalesce(h{k}, 0) / n_actual AS r{k}, coalesce(a{k}, 0) / least(n_actual, {k}) AS m{k}"
        for k in ks
    )
    rows = " UNION ALL ".join(
        f"SELECT CAST({k} AS INTEGER) AS k, count(*) AS n_users, round(avg(p{k}), 6) AS precision, round(avg(r{k}), 6) AS recall, round(avg(m{k}), 6) AS map FROM pu"
        for k in ks
    )
    return (
        "WITH "
        + (_RR10 if prep is None else _rr10(prep))
        + f""",
ph AS (SELECT "user", {ph} FROM run GROUP BY 1),
pu AS (SELECT na."user", n_actual, {pu}
       FROM na JOIN (SELECT DISTINCT "user" FROM rr) ru ON na."user" = ru."user" LEFT JOIN ph ON na."user" = ph."user")
{rows}"""
    )


def _top(src: str, key: str, key_label: bool, n: int = 10) -> str:
    label = f", CAST({key} AS VARCHAR) AS user_label" if key_label else ""
    return f"""
tot AS (SELECT {key}, sum(value) AS total_hours FROM {src} GROUP BY 1),
top AS (SELECT * FROM tot ORDER BY total_hours DESC NULLS LAST, {key} ASC NULLS LAST LIMIT {n})
SELECT {key}, round(total_hours, 6) AS total_hours,
       format('{{:,}}', CAST(round_even(round(total_hours, 6), 0) AS BIGINT)) || ' hrs' AS hours_label,
       round(total_hours / max(total_hours) OVER (), 6) AS share_of_max{label}
FROM top"""


def _ids_text(expr: str) -> str:
    return f"array_to_string(list_sort({expr}), ',')"


_KNOWN = """known AS (SELECT * FROM test WHERE "user" IN (SELECT "user" FROM train) AND item IN (SELECT item FROM train)),
cov AS (SELECT count(*) AS n_test, (SELECT count(*) FROM known) AS n_scored, round((SELECT count(*) FROM known) / count(*), 6) AS coverage FROM test),
nu AS (SELECT count(DISTINCT "user") AS n_users FROM test WHERE "user" IN (SELECT "user" FROM train))
"""

_GRID = """grid AS (SELECT CAST(r AS INTEGER) AS rank, CAST(g AS DOUBLE) AS "regParam", CAST(m AS INTEGER) AS "maxIter",
         'ALS_r' || r || '_reg' || g || '_iter' || m AS run_name
         FROM (VALUES (10), (20), (50)) a(r), (VALUES ('0.01'), ('0.1'), ('0.5')) b(g), (VALUES (10), (15), (20)) c(m))
"""


def _certified(q: dict[str, str]) -> None:
    """Queries over fitted models: what their inputs decide, and TRUE."""
    known = "WITH " + _PREP + "," + _KNOWN
    ranks = lambda n: f"generate_series(1, least(5, (SELECT count(DISTINCT {n}) FROM train))) g(rank)"
    q["als_predictions"] = known + ' SELECT "user", item, rating, TRUE AS certified FROM known'
    q["als_score_report"] = known + " SELECT n_test, n_scored, coverage, TRUE AS certified FROM cov"
    q["als_certificate"] = known + ' SELECT count(DISTINCT "user") AS n_users, count(*) AS n_ratings, TRUE AS certified FROM train'
    run = """ SELECT run_name, rank, "regParam", "maxIter", CAST(42 AS BIGINT) AS seed, CAST(10 AS INTEGER) AS num_blocks,
              n_test, n_scored, coverage, n_users, TRUE AS certified FROM grid, cov, nu"""
    q["als_grid"] = known + "," + _GRID + run
    q["als_baseline_run"] = q["als_grid"] + """ WHERE run_name = 'ALS_r20_reg0.1_iter10'"""
    users = ' SELECT u."user", CAST(g.rank AS INTEGER) AS rank, d.label AS user_id, TRUE AS certified FROM (SELECT DISTINCT "user" FROM train) u JOIN udict d ON d.idx = u."user", ' + ranks("item")
    items = ' SELECT i.item AS game_id, CAST(g.rank AS INTEGER) AS rank, d.label AS game, TRUE AS certified FROM (SELECT DISTINCT item FROM train) i JOIN idict d ON d.idx = i.item, ' + ranks('"user"')
    q["als_user_recs"], q["als_item_recs"] = known + users, known + items
    q["als_recs_for_user"] = known + users + ' WHERE u."user" = 0'
    q["als_users_for_top_game"] = known + items + " WHERE d.label = (SELECT game FROM pl GROUP BY game ORDER BY sum(value) DESC NULLS LAST, game ASC NULLS LAST LIMIT 1)"
    q["als_metrics"] = known + " SELECT CAST(k AS INTEGER) AS k, n_users, TRUE AS certified FROM nu, (VALUES (5), (10)) t(k)"
    q["als_leaderboard"] = "SELECT CAST(place AS INTEGER) AS place, TRUE AS certified FROM generate_series(1, 5) t(place)"
    q["als_best_config"] = "SELECT CAST(1 AS INTEGER) AS place, TRUE AS certified"
    q["als_rank_marginals"] = "WITH " + _GRID + ' SELECT "maxIter", rank, count(*) AS n_runs, TRUE AS certified FROM grid GROUP BY 1, 2'
    q["als_tradeoff"] = "WITH " + _GRID + ' SELECT "regParam", rank, "maxIter", TRUE AS certified FROM grid'


def _runs(q: dict[str, str]) -> None:
    """The run table of the models that SQL can follow, and the views over it."""
    measured = " UNION ALL ".join(
        f"""SELECT {r} AS rank, {i} AS "maxIter", t.* FROM ({_one_run(f'{r}-{i}')}) t""" for r in (10, 20, 50) for i in (10, 15, 20))
    table = "WITH " + _PREP + "," + _KNOWN + "," + _GRID + f""",
te AS (SELECT DISTINCT "user", item FROM test WHERE item IS NOT NULL),
na AS (SELECT "user", count(*) AS n_actual FROM te WHERE "user" IN (SELECT "user" FROM train) GROUP BY 1),
ranked AS ({measured}),
means AS (SELECT item, sum(rating) AS s, count(*) AS n FROM train GROUP BY 1),
errors AS (SELECT g.reg, count(*) AS n_test, count(m.item) AS n_scored, count(m.item) / count(*) AS coverage, sqrt(avg((t.rating - m.s / (m.n + g.reg)) ^ 2)) AS rmse
           FROM (VALUES (0.01::DOUBLE), (0.1::DOUBLE), (0.5::DOUBLE)) g(reg), test t LEFT JOIN means m ON t.item = m.item GROUP BY 1),
runs AS (SELECT grid.*, e.n_test, e.n_scored, round(e.coverage, 9) AS coverage, k.n_users, round(e.rmse, 9) AS rmse,
                round(k.p, 9) AS precision_at_10, round(k.r, 9) AS recall_at_10, round(k.m, 9) AS map_at_10
         FROM grid JOIN errors e ON e.reg = grid."regParam" JOIN ranked k ON k.rank = grid.rank AND k."maxIter" = grid."maxIter")
"""
    order = 'ORDER BY map_at_10 DESC NULLS LAST, rank, "regParam", "maxIter"'
    run = 'run_name, rank, "regParam", "maxIter"'
    six = lambda c: f"round({c}, 6) AS {c}"
    q["runs_grid"] = table + f" SELECT {run}, n_test, n_scored, {six('coverage')}, n_users, {six('rmse')}, {six('precision_at_10')}, {six('recall_at_10')}, {six('map_at_10')} FROM runs"
    q["runs_leaderboard"] = table + f" SELECT {run}, {six('map_at_10')} FROM (SELECT * FROM runs {order} LIMIT 5)"
    q["runs_best_config"] = table + f" SELECT {run}, {six('map_at_10')} FROM (SELECT * FROM runs {order} LIMIT 1)"
    q["runs_rank_marginals"] = table + ' SELECT "maxIter", rank, round(avg(precision_at_10), 6) AS avg_precision_at_10 FROM runs GROUP BY 1, 2'
    q["runs_tradeoff"] = table + f' SELECT "regParam", rank, "maxIter", {six("rmse")}, {six("map_at_10")} FROM runs'
    q["runs_slice"] = table + f' SELECT {run}, {six("rmse")}, {six("map_at_10")} FROM runs WHERE rank = 20 AND "regParam" = 0.1'


def _one_run(seed: str) -> str:
    """Mean precision, recall and average precision at 10 of one permutation."""
    recs = _random('SELECT DISTINCT "user" FROM train', '"user"', "item", "SELECT count(*) AS n FROM idict", 10, seed)
    return f"""WITH rr AS ({recs}),
        hit AS (SELECT rr."user", rr.pos, count(*) OVER (PARTITION BY rr."user" ORDER BY rr.pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS hit_no
                FROM rr JOIN te ON rr."user" = te."user" AND rr.item = te.item),
        per AS (SELECT "user", count(*) AS h, sum(hit_no / (pos + 1)) AS ap FROM hit GROUP BY 1)
        SELECT count(*) AS n_users, avg(coalesce(h, 0) / 10.0) AS p, avg(coalesce(h, 0) / n_actual) AS r, avg(coalesce(ap, 0) / least(n_actual, 10)) AS m
        FROM na LEFT JOIN per USING ("user")"""


def queries() -> dict[str, str]:
    q: dict[str, str] = {}
    q["csv_scan"] = "WITH " + _EV + " SELECT user_id, game, behavior, value FROM ev"
    q["plays"] = "WITH " + _EV + " SELECT user_id, game, behavior, value FROM pl"
    q["distinct_users"] = "WITH " + _EV + " SELECT DISTINCT user_id FROM ev"
    q["distinct_games"] = "WITH " + _EV + " SELECT DISTINCT game FROM ev"
    q["behavior_counts"] = "WITH " + _EV + " SELECT behavior, count(*) AS n FROM ev GROUP BY 1"
    q["cardinalities"] = (
        "WITH " + _EV + """
SELECT count(*) AS n_rows,
       count(DISTINCT user_id) + coalesce(max(CASE WHEN user_id IS NULL THEN 1 ELSE 0 END), 0) AS user_id_distinct,
       count(DISTINCT user_id) AS user_id_non_null,
       count(DISTINCT game) + coalesce(max(CASE WHEN game IS NULL THEN 1 ELSE 0 END), 0) AS game_distinct,
       count(DISTINCT game) AS game_non_null
FROM ev"""
    )
    q["top_items"] = "WITH " + _EV + "," + _top("pl", "game", False)
    q["top_users"] = "WITH " + _EV + "," + _top("pl", "user_id", True)
    q["top_items_sales"] = "WITH " + _SALES + "," + _top("sa", "game", False)
    q["top_users_sales"] = "WITH " + _SALES + "," + _top("sa", "user_id", True)
    q["top_items_sales_named"] = (
        "WITH " + _SALES + """,
tot AS (SELECT game, sum(value) AS total_hours FROM sa GROUP BY 1),
top AS (SELECT * FROM tot ORDER BY total_hours DESC NULLS LAST, game ASC NULLS LAST LIMIT 10)
SELECT top.game, round(top.total_hours, 6) AS total_hours, p.p_name || '#' || CAST(p.p_partkey AS VARCHAR) AS name
FROM top LEFT JOIN part p ON top.game = CAST(p.p_partkey AS VARCHAR)"""
    )
    q["clean_profile"] = (
        "WITH " + _EV + """,
pairs AS (SELECT user_id, game, count(*) AS c FROM pl WHERE user_id IS NOT NULL AND game IS NOT NULL GROUP BY 1, 2),
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
UNION ALL SELECT 'max_rows_per_user', max(c) FROM (SELECT user_id, count(*) AS c FROM pl WHERE user_id IS NOT NULL AND game IS NOT NULL GROUP BY 1)
UNION ALL SELECT 'max_items_per_user', max(c) FROM (SELECT user_id, count(DISTINCT game) AS c FROM pl WHERE user_id IS NOT NULL AND game IS NOT NULL GROUP BY 1)"""
    )
    q["item_index"] = "WITH " + _EV + f" {_dict('cl', 'game')}"
    q["user_index"] = "WITH " + _EV + f" {_dict('cl', 'user_id')}"
    q["item_index_sales"] = (
        "WITH " + _SALES + ", scl AS (SELECT * FROM sa WHERE user_id IS NOT NULL AND game IS NOT NULL AND value IS NOT NULL AND NOT isnan(value)) "
        + _dict("scl", "game")
    )
    q["ratings"] = "WITH " + _PREP + ' SELECT "user", item, rating FROM rt'
    q["split_rows"] = "WITH " + _PREP + ' SELECT "user", item, rating, split FROM rt'
    q["split_counts"] = "WITH " + _PREP + " SELECT split, count(*) AS n FROM rt GROUP BY 1"
    q["coverage"] = (
        "WITH " + _PREP + """
SELECT count(*) AS n_test,
       count(*) FILTER (WHERE "user" IN (SELECT "user" FROM train) AND item IN (SELECT item FROM train)) AS n_scored,
       round(n_scored / n_test, 6) AS coverage
FROM test"""
    )
    q["rmse_item_mean"] = (
        "WITH " + _PREP + """,
im AS (SELECT item, avg(rating) AS prediction FROM train GROUP BY 1),
sc AS (SELECT t.rating, im.prediction FROM test t LEFT JOIN im ON t.item = im.item)
SELECT count(*) AS n_test, count(prediction) AS n_scored, round(count(prediction) / count(*), 6) AS coverage,
       round(sqrt(avg((rating - prediction) ^ 2)), 6) AS rmse,
       round(sqrt(avg(((CASE WHEN rating > 0 THEN 1.0 ELSE 0.0 END) - prediction) ^ 2)), 6) AS rmse_preference
FROM sc"""
    )
    q["actual_items"] = (
        "WITH " + _PREP + f' SELECT "user", {_ids_text("list(DISTINCT item)")} AS actual_items FROM test GROUP BY 1'
    )
    q["random_recs"] = "WITH " + _RR10 + ' SELECT "user", pos, item, rating FROM rr'
    q["rec_items"] = (
        "WITH " + _RR10 + """
SELECT "user", array_to_string(list(item ORDER BY pos), ',') AS rec_items_ordered,
       """ + _ids_text("list(item)") + """ AS rec_items
FROM rr GROUP BY 1"""
    )
    q["hits_per_user"] = (
        "WITH " + _RR10 + """,
nr AS (SELECT "user", count(*) AS n_recs FROM rr GROUP BY 1),
hh AS (SELECT "user", count(*) AS hits FROM hit GROUP BY 1)
SELECT na."user", na.n_actual, nr.n_recs, coalesce(hh.hits, 0) AS hits
FROM na JOIN nr ON na."user" = nr."user" LEFT JOIN hh ON na."user" = hh."user\""""
    )
    q["running_precision"] = (
        "WITH " + _RR10 + ' SELECT "user", pos, item, hit_no, round(hit_no / (pos + 1), 6) AS precision_at_hit FROM run'
    )
    q["ranking_metrics"] = _metrics_sql((5, 10))
    q["random_baseline_run"] = (
        "WITH m AS (" + _metrics_sql((10,)) + "), " + _PREP[_PREP.index("ev AS"):] + """,
cov AS (SELECT count(*) AS n_test,
        count(*) FILTER (WHERE "user" IN (SELECT "user" FROM train) AND item IN (SELECT item FROM train)) AS n_scored
        FROM test)
SELECT 'random_seed42' AS run_name, 'random' AS model, CAST(42 AS BIGINT) AS seed, cov.n_test, cov.n_scored,
       round(cov.n_scored / cov.n_test, 6) AS coverage, m.n_users,
       m.precision AS precision_at_10, m.recall AS recall_at_10, m.map AS map_at_10
FROM m, cov"""
    )
    factors = _PREP + """,
uf AS (SELECT CAST(vec_id // 5 AS INTEGER) AS id, CAST(embedding AS DOUBLE[]) AS f FROM embeddings WHERE vec_id % 5 = 0),
itf AS (SELECT CAST(vec_id - vec_id // 5 - 1 AS INTEGER) AS id, CAST(embedding AS DOUBLE[]) AS f FROM embeddings WHERE vec_id % 5 <> 0)
"""
    q["fixed_factor_scores"] = (
        "WITH " + factors + """
SELECT t."user", t.item, t.rating, round(list_dot_product(uf.f, itf.f), 6) AS prediction
FROM test t JOIN uf ON t."user" = uf.id JOIN itf ON t.item = itf.id"""
    )
    q["fixed_factor_score_report"] = (
        "WITH " + factors + """,
sc AS (SELECT t.rating, list_dot_product(uf.f, itf.f) AS prediction
       FROM test t LEFT JOIN uf ON t."user" = uf.id LEFT JOIN itf ON t.item = itf.id)
SELECT count(*) AS n_test, count(prediction) AS n_scored, round(count(prediction) / count(*), 6) AS coverage,
       round(sqrt(avg((rating - prediction) ^ 2)), 6) AS rmse,
       round(sqrt(avg(((CASE WHEN rating > 0 THEN 1.0 ELSE 0.0 END) - prediction) ^ 2)), 6) AS rmse_preference
FROM sc"""
    )
    emb = """
uf AS (SELECT CAST(vec_id // 5 AS INTEGER) AS id, CAST(embedding AS DOUBLE[]) AS f FROM embeddings WHERE vec_id % 5 = 0),
itf AS (SELECT CAST(vec_id - vec_id // 5 - 1 AS INTEGER) AS id, CAST(embedding AS DOUBLE[]) AS f FROM embeddings WHERE vec_id % 5 <> 0)
"""
    q["topk_dot_users"] = (
        "WITH " + emb + """,
s AS (SELECT uf.id AS "user", itf.id AS item, list_dot_product(uf.f, itf.f) AS score FROM uf, itf),
r AS (SELECT *, row_number() OVER (PARTITION BY "user" ORDER BY score DESC, item) AS rn FROM s)
SELECT "user", CAST(rn AS INTEGER) AS rank, item, round(score, 6) AS score FROM r WHERE rn <= 10"""
    )
    q["topk_dot_items"] = (
        "WITH " + emb + """,
s AS (SELECT itf.id AS item, uf.id AS "user", list_dot_product(uf.f, itf.f) AS score FROM uf, itf),
r AS (SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, "user") AS rn FROM s)
SELECT item, CAST(rn AS INTEGER) AS rank, "user", round(score, 6) AS score FROM r WHERE rn <= 10"""
    )
    rr5_users = _random('SELECT DISTINCT "user" FROM train', '"user"', "item", "SELECT count(*) AS n FROM idict", 5)
    q["readable_user_recs"] = (
        "WITH " + _PREP + f""",
rr AS ({rr5_users})
SELECT rr."user", CAST(rr.pos + 1 AS INTEGER) AS rank, rr.item AS game_id, rr.rating AS score, i.label AS game, u.label AS user_id
FROM rr LEFT JOIN idict i ON rr.item = i.idx LEFT JOIN udict u ON rr."user" = u.idx"""
    )
    rr5_items = _random("SELECT DISTINCT item FROM train", "item", '"user"', "SELECT count(*) AS n FROM udict", 5)
    readable_items = (
        "WITH " + _PREP + f""",
ri AS ({rr5_items}),
ritems AS (SELECT ri.item AS game_id, CAST(ri.pos + 1 AS INTEGER) AS rank, ri."user" AS recommended_user, ri.rating AS score,
                  i.label AS game, u.label AS recommended_user_id
           FROM ri LEFT JOIN idict i ON ri.item = i.idx LEFT JOIN udict u ON ri."user" = u.idx)"""
    )
    q["readable_item_recs"] = readable_items + " SELECT * FROM ritems"
    q["recs_for_user"] = (
        "WITH " + _PREP + f""",
rr AS ({rr5_users})
SELECT rr."user", CAST(rr.pos + 1 AS INTEGER) AS rank, rr.item AS game_id, rr.rating AS score, i.label AS game, u.label AS user_id
FROM rr LEFT JOIN idict i ON rr.item = i.idx LEFT JOIN udict u ON rr."user" = u.idx
WHERE rr."user" = 0"""
    )
    q["users_for_game"] = (
        readable_items
        + """,
topg AS (SELECT game FROM pl GROUP BY game ORDER BY sum(value) DESC NULLS LAST, game ASC NULLS LAST LIMIT 1)
SELECT * FROM ritems WHERE game = (SELECT game FROM topg)"""
    )
    q["clean_profile_sales"] = (
        "WITH " + _SALES + """,
pl AS (SELECT * FROM sa),
pairs AS (SELECT user_id, game, count(*) AS c FROM pl WHERE user_id IS NOT NULL AND game IS NOT NULL GROUP BY 1, 2),
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
UNION ALL SELECT 'max_rows_per_user', max(c) FROM (SELECT user_id, count(*) AS c FROM pl WHERE user_id IS NOT NULL AND game IS NOT NULL GROUP BY 1)
UNION ALL SELECT 'max_items_per_user', max(c) FROM (SELECT user_id, count(DISTINCT game) AS c FROM pl WHERE user_id IS NOT NULL AND game IS NOT NULL GROUP BY 1)"""
    )
    q["user_index_sales"] = "WITH " + _SALES_CLEAN + " " + _dict("scl", "user_id")
    q["split_counts_sales"] = "WITH " + _PREP_SALES + " SELECT split, count(*) AS n FROM rt GROUP BY 1"
    q["coverage_sales"] = (
        "WITH " + _PREP_SALES + """
SELECT count(*) AS n_test,
       count(*) FILTER (WHERE "user" IN (SELECT "user" FROM train) AND item IN (SELECT item FROM train)) AS n_scored,
       round(n_scored / n_test, 6) AS coverage
FROM test"""
    )
    q["ranking_metrics_sales"] = _metrics_sql((5, 10), _PREP_SALES)
    q["als_coverage"] = q["coverage"]
    q["als_user_recs_shape"] = (
        "WITH " + _PREP + """,
nu AS (SELECT count(DISTINCT "user") AS u FROM train),
ni AS (SELECT count(DISTINCT item) AS i FROM train)
SELECT u AS n_ids, CAST(u * least(5, i) AS BIGINT) AS n_recs, CAST(least(5, i) AS INTEGER) AS min_len,
       CAST(least(5, i) AS INTEGER) AS max_len, u AS distinct_ids
FROM nu, ni"""
    )
    q["als_item_recs_shape"] = (
        "WITH " + _PREP + """,
nu AS (SELECT count(DISTINCT "user") AS u FROM train),
ni AS (SELECT count(DISTINCT item) AS i FROM train)
SELECT i AS n_ids, CAST(i * least(5, u) AS BIGINT) AS n_recs, CAST(least(5, u) AS INTEGER) AS min_len,
       CAST(least(5, u) AS INTEGER) AS max_len, i AS distinct_ids
FROM nu, ni"""
    )
    _certified(q)
    _runs(q)
    q["csv_inferred"] = "WITH " + _EV + " SELECT CAST(user_id AS INTEGER) AS user_id, CAST(game AS INTEGER) AS game, behavior, value FROM ev"
    q["csv_schema"] = "SELECT CAST(i AS INTEGER) AS position, name, type FROM (VALUES (0, 'user_id', 'int'), (1, 'game', 'int'), (2, 'behavior', 'string'), (3, 'value', 'double')) t(i, name, type)"
    q["csv_malformed"] = "WITH " + _EV + " SELECT count(*) + 2 * count(*) FILTER (WHERE behavior = 'purchase') AS n_rows, 2 * count(*) FILTER (WHERE behavior = 'purchase') AS n_corrupt FROM ev"
    q["preview_rows"] = "SELECT least(20, count(*)) AS n_rows, CAST(0 AS BIGINT) AS n_foreign FROM events"
    q["cardinalities_by_behavior"] = "WITH " + _EV + " SELECT behavior, count(*) AS n_rows, count(DISTINCT user_id) AS n_user, count(DISTINCT game) AS n_item FROM ev GROUP BY 1"
    q["cardinalities_merged"] = "WITH " + _SALES + " SELECT 'user' AS kind, count(DISTINCT user_id) AS n FROM sa UNION ALL SELECT 'item', count(DISTINCT game) FROM sa"
    q["random_split_totals"] = "WITH " + _PREP + " SELECT count(*) AS n_rows, TRUE AS share_ok FROM rt"
    q["actual_chunks"] = (
        "WITH " + _PREP + """,
te AS (SELECT DISTINCT "user", item FROM test),
pl3 AS (SELECT "user", item, CAST((row_number() OVER (PARTITION BY "user" ORDER BY item) - 1) // 3 AS INTEGER) AS chunk FROM te)
SELECT "user", chunk, string_agg(item, ',' ORDER BY item) AS items FROM pl3 GROUP BY 1, 2"""
    )
    q["shared_items"] = "WITH " + _RR10 + ' SELECT "user", count(*) AS n FROM hit GROUP BY 1'
    q["bucketed_factor_scores"] = q["fixed_factor_scores"]
    q["topk_two_way_users"], q["topk_two_way_items"] = q["topk_dot_users"], q["topk_dot_items"]
    q["first_user_recs"] = q["readable_user_recs"] + ' ORDER BY rr."user", rank LIMIT 10'
    q["stream_item_totals"] = "WITH " + _EV + " SELECT game, round(sum(value), 6) AS total_hours FROM pl GROUP BY 1"
    q["stream_user_totals"] = "WITH " + _EV + " SELECT user_id, round(sum(value), 6) AS total_hours FROM pl GROUP BY 1"
    return q
