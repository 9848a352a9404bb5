"""Exact top-k by inner product over a norm-ordered block index, one way and
both ways at once, for factor tables (id INT, features ARRAY).

**Index.** Candidates are range-partitioned by descending norm (ties by id) and
cut into blocks of at most ``block_rows``; a block knows its largest norm. The
index is a written table.

**One way** (``top_k_by_dot``). Queries are dealt into groups by a hash of the
id. Every group first meets the leading block, which gives each query a score
that its k-th best will reach at least. A block is then left out for a group if
for each of its queries |q| * (largest norm) is below that score: no candidate
of the block can enter. What is left is shipped and streamed in order of norms,
and a task leaves a query out as soon as its own k-th best is above the bound of
what is still to come. Ties are never left out, so results are exact.

**Cells.** The candidates of a group are dealt into slices, and a cell (group,
slice) is a task's work: queries travel once a slice, candidates once a group, k
results a query once a slice. There are about as many cells as the session has
shuffle partitions, shaped so that both sides send the same number of rows
(``_cells``), so what travels grows with the tables and not with their product.
A cell holds one group of queries (``GROUP_ROWS`` at most) and a batch of
candidates; only tables beyond ``GROUP_ROWS`` * groups get more cells for it.

**Both ways** (``two_way_top_k``). The best items of each user and the best users
of each item come from the same products: a group of users meets each batch of
items once, keeps k per user, and returns k users per item, which are merged
over the cells.

No user x item pair is ever a row, and nothing passes the driver but counts.
Order: score descending, then id ascending (exact ties resolved the same way
everywhere). Scores are in double precision. Rows whose id or features are NULL,
or whose features hold a NULL, a NaN or an infinity, take no part.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import stable_table

# the task function travels by value: executors need no copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BLOCK_ROWS = 4096
#: Most queries of a group, and how few don't make another one.
GROUP_ROWS, GROUP_LEAST = 32_768, 256
#: Scores a task holds at a time.
AT_ONCE = 1 << 22
#: Room for rounding in |q| * |c| as a bound of their product.
SLACK = 1 + 1e-9

_FOUND = "g long, side int, id long, other long, score double"


def _merged(scores: np.ndarray, ids: np.ndarray, new: np.ndarray, new_ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` best of each row of ``scores`` beside ``new``; ids alike."""
    row, col = np.nonzero(new >= scores[:, -1:])
    if len(row) * 16 < new.size:
        # few contend: these alone are sorted in among the k of their rows
        some = np.unique(row)
        row, s, i = np.r_[np.repeat(some, k), row], np.r_[scores[some].ravel(), new[row, col]], np.r_[ids[some].ravel(), new_ids[col]]
        order = np.lexsort((i, -s, row))
        order = order[np.arange(len(row)) - np.searchsorted(row[order], row[order], side="left") < k]
        scores, ids = scores.copy(), ids.copy()
        scores[some], ids[some] = s[order].reshape(-1, k), i[order].reshape(-1, k)
        return scores, ids
    s = np.concatenate([scores, new], axis=1)
    i = np.concatenate([ids, np.broadcast_to(new_ids, new.shape)], axis=1)
    # every score at or above the k-th largest contends, so that exact ties
    # are resolved by id
    edge = np.partition(s, s.shape[1] - k, axis=1)[:, s.shape[1] - k]
    row, col = np.nonzero(s >= edge[:, None])
    order = np.lexsort((i[row, col], -s[row, col], row))
    row, col = row[order], col[order]
    keep = np.arange(len(row)) - np.searchsorted(row, row, side="left") < k
    row, col = row[keep], col[keep]
    return s[row, col].reshape(-1, k), i[row, col].reshape(-1, k)


class _Group:
    """The queries of one group and their best candidates so far."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, norms: np.ndarray, floors: np.ndarray, k: int):
        self.ids, self.x, self.norms, self.floors, self.k = ids, x, norms, floors, k
        self.scores = np.full((len(ids), k), -np.inf)
        self.best = np.full((len(ids), k), np.iinfo(np.int64).max)
        self.products = 0

    def meet(self, ids: np.ndarray, y: np.ndarray, norm: float, both: bool) -> list[tuple]:
        """Take in candidates of at most ``norm``; with ``both`` also return
        (candidate, query, score): the best queries of each candidate."""
        least = np.maximum(self.floors, self.scores[:, -1])
        # a query whose least score no candidate can reach is left out
        some = np.arange(len(self.ids)) if both else np.flatnonzero(self.norms * norm * SLACK >= least)
        step = max(1, AT_ONCE // len(ids))
        top, its = np.full((len(ids), self.k), -np.inf), np.full((len(ids), self.k), np.iinfo(np.int64).max)
        for a in range(0, len(some), step):
            rows = some[a:a + step]
            s = self.x[rows] @ y.T
            self.products += s.size
            self.scores[rows], self.best[rows] = _merged(self.scores[rows], self.best[rows], s, ids, self.k)
            if both:
                top, its = _merged(top, its, s.T, self.ids[rows], self.k)
        if not both:
            return []
        row, col = np.nonzero(top > -np.inf)
        return [(ids[row], its[row, col], top[row, col])]

    def found(self) -> tuple:
        # below its floor a candidate isn't among the best of all
        row, col = np.nonzero((self.scores > -np.inf) & (self.scores >= self.floors[:, None]))
        return self.ids[row], self.best[row, col], self.scores[row, col]


def _kernel(k: int, both: bool):
    """Task function over rows sorted by cell: its queries, then candidates by
    descending norm. Side 0 are a query's best, side 1 a candidate's; a row of
    side 2 says how many products the cell took."""

    def batch_of(g: int, side: int, ids, other, scores) -> pa.RecordBatch:
        n = len(ids)
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(n, g, np.int64)), pa.array(np.full(n, side, np.int32)), pa.array(np.asarray(ids, np.int64)), pa.array(np.asarray(other, np.int64)), pa.array(np.asarray(scores, np.float64))],
            names=["g", "side", "id", "other", "score"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        g, parts, group = None, [], None

        def end() -> Iterator[pa.RecordBatch]:
            if group is not None:
                yield batch_of(g, 0, *group.found())
                yield batch_of(g, 2, [0], [group.products], [0.0])

        for batch in batches:
            gs, kind, ids, norms, floors = (batch.column(c).to_numpy() for c in ("g", "kind", "id", "norm", "floor"))
            if not len(gs):
                continue
            f = batch.column("f")
            sizes = np.diff(f.offsets.to_numpy())
            if (sizes != sizes[0]).any():
                raise ValueError("features must have one common length")
            x = f.flatten().to_numpy().astype(np.float64, copy=False).reshape(len(gs), sizes[0])
            cuts = np.flatnonzero((gs[1:] != gs[:-1]) | (kind[1:] != kind[:-1])) + 1
            for a, z in zip(np.r_[0, cuts].tolist(), np.r_[cuts, len(gs)].tolist()):
                if gs[a] != g:
                    yield from end()
                    g, parts, group = int(gs[a]), [], None
                if kind[a] == 0:
                    parts.append((ids[a:z], x[a:z], norms[a:z], floors[a:z]))
                    continue
                if not parts:
                    continue
                group = group or _Group(*(np.concatenate(c) for c in zip(*parts)), k)
                for i, j, s in group.meet(ids[a:z], x[a:z], float(norms[a]), both):
                    yield batch_of(g, 1, i, j, s)
        yield from end()

    return run


def _usable(df: DataFrame) -> DataFrame:
    """Rows (id, f, norm) that can be scored; single precision stays single until
    the products are taken."""
    kind = "array<float>" if isinstance(df.schema["features"].dataType.elementType, T.FloatType) else "array<double>"
    finite = F.forall("features", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = df.where(F.col("id").isNotNull() & F.coalesce(finite, F.lit(False))).select(F.col("id").cast("long").alias("id"), F.col("features").cast(kind).alias("f"))
    return rows.withColumn("norm", F.sqrt(F.aggregate("f", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))))


def _partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def norm_index(candidates: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Written table (block, id, f, norm): blocks of at most ``block_rows`` rows,
    numbered by descending norm."""
    dealt = _usable(candidates).repartitionByRange(_partitions(candidates), F.desc("norm"), F.asc("id")).sortWithinPartitions(F.desc("norm"), F.asc("id"))
    rows = stable_table(dealt.withColumn("place", F.monotonically_increasing_id()), "topk-index")
    # places are counted anew in each partition, far apart from one to the next
    return rows.select(F.expr(f"place div {int(block_rows)}").alias("block"), "id", "f", "norm")


def _cells(n: int, m: int, tasks: int) -> tuple[int, int]:
    """(groups, slices) for ``n`` queries and ``m`` candidates: n * slices and
    m * groups, the rows sent, are about even, in about ``tasks`` cells."""
    groups = max(1, math.ceil(n / GROUP_ROWS), min(math.ceil(n / GROUP_LEAST), tasks, round(math.sqrt(tasks * n / max(m, 1)))))
    return groups, max(1, min(tasks // groups, math.ceil(m / GROUP_LEAST)))


def _grouped(queries: DataFrame, groups: int) -> DataFrame:
    return queries.withColumn("g", F.pmod(F.xxhash64("id"), F.lit(groups).cast("long")))


def _meet(queries: DataFrame, candidates: DataFrame, k: int, groups: int, slices: int = 1, both: bool = False) -> DataFrame:
    """The task function over queries (g, id, f, norm, floor), each in every
    slice, and candidates (g, id, f, norm), each in one; a partition takes a cell,
    or more if there are more than the session has partitions."""
    cell = lambda s: (F.col("g") * F.lit(slices) + s).alias("g")
    left = queries.withColumn("s", _each(slices)).select(cell(F.col("s")), F.lit(0).alias("kind"), "id", "norm", "floor", "f")
    # another seed than that of the groups
    dealt = F.pmod(F.xxhash64("id", F.lit(1)), F.lit(slices).cast("long"))
    right = candidates.select(cell(dealt), F.lit(1).alias("kind"), "id", "norm", F.lit(0.0).alias("floor"), "f")
    rows = left.unionByName(right).repartitionById(min(groups * slices, _partitions(queries)), F.col("g").cast("int"))
    return rows.sortWithinPartitions("g", "kind", F.desc("norm"), "id").mapInArrow(_kernel(k, both), _FOUND)


def _ranked(found: DataFrame, k: int, query_col: str, cand_col: str) -> DataFrame:
    w = Window.partitionBy("id").orderBy(F.desc("score"), F.asc("other"))
    ranked = found.withColumn("rank", F.row_number().over(w).cast("int")).where(F.col("rank") <= k)
    return ranked.select(F.col("id").cast("int").alias(query_col), "rank", F.col("other").cast("int").alias(cand_col), "score")


def _each(n: int):
    return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))


def _none(df: DataFrame, query_col: str, cand_col: str) -> DataFrame:
    return df.sparkSession.createDataFrame([], f"{query_col} INT, rank INT, {cand_col} INT, score DOUBLE")


def top_k_visits(
    queries: DataFrame,
    candidates: DataFrame,
    k: int,
    query_col: str = "user",
    cand_col: str = "item",
    block_rows: int = BLOCK_ROWS,
) -> tuple[DataFrame, DataFrame]:
    """``top_k_by_dot`` and a row (groups, blocks, pairs, visited, products):
    the block pairs there are and those shipped, and the products taken."""
    spark = queries.sparkSession
    report = "groups long, blocks long, pairs long, visited long, products long"
    q = stable_table(_usable(queries), "topk-queries")
    n = q.count()
    if k <= 0 or not n:
        return _none(queries, query_col, cand_col), spark.createDataFrame([(0, 0, 0, 0, 0)], report)
    index = norm_index(candidates, block_rows)
    blocks = stable_table(index.groupBy("block").agg(F.max("norm").alias("top"), F.count(F.lit(1)).alias("n")), "topk-blocks")
    n_blocks, m = blocks.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    groups, slices = _cells(n, m, _partitions(queries))
    q = _grouped(q, groups)
    if not n_blocks:
        return _none(queries, query_col, cand_col), spark.createDataFrame([(groups, 0, 0, 0, 0)], report)
    first = blocks.agg(F.min("block")).first()[0]
    open_ = q.withColumn("floor", F.lit(float("-inf")))
    lead = index.where(F.col("block") == first).withColumn("g", _each(groups))
    found = stable_table(_meet(open_, lead, k, groups), "topk-lead")
    visited = groups
    if n_blocks > 1:
        # the k-th score so far, and what norm a candidate needs to reach it
        kth = found.where("side = 0").groupBy("id").agg(F.when(F.count(F.lit(1)) >= k, F.min("score")).alias("kth"))
        floors = q.join(kth, "id", "left").withColumn("floor", F.coalesce("kth", F.lit(float("-inf")))).drop("kth")
        floors = stable_table(floors, "topk-floors")
        need = floors.groupBy("g").agg(F.min(F.when(F.col("norm") > 0, F.col("floor") / F.col("norm")).otherwise(F.lit(float("-inf")))).alias("need"))
        # one row a block and one a group; blocks are few: rows / block_rows
        left = F.broadcast(blocks.where(F.col("block") != first).drop("n"))
        pairs = stable_table(need.join(left, F.col("top") * F.lit(SLACK) >= F.col("need")).select("g", "block"), "topk-pairs")
        visited += pairs.count()
        rest = _meet(floors, index.join(pairs, "block"), k, groups, slices)
        found = found.unionByName(stable_table(rest, "topk-rest"))
    products = found.where("side = 2").agg(F.sum("other").alias("products"))
    sizes = [F.lit(v).cast("long").alias(c) for c, v in (("groups", groups), ("blocks", n_blocks), ("pairs", groups * n_blocks), ("visited", visited))]
    return _ranked(found.where("side = 0"), k, query_col, cand_col), products.select(*sizes, "products")


def top_k_by_dot(
    queries: DataFrame,
    candidates: DataFrame,
    k: int,
    query_col: str = "user",
    cand_col: str = "item",
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """(query_col, rank, cand_col, score): the ``k`` best candidates per query.

    ``queries`` and ``candidates`` are factor tables (id INT, features
    ARRAY<FLOAT|DOUBLE>) of one common rank.
    """
    return top_k_visits(queries, candidates, k, query_col, cand_col, block_rows)[0]


def two_way_top_k(users: DataFrame, items: DataFrame, k: int, user_col: str = "user", item_col: str = "item") -> tuple[DataFrame, DataFrame]:
    """(user, rank, item, score) and (item, rank, user, score), as two calls of
    ``top_k_by_dot`` would give, from one product of each pair."""
    q = stable_table(_usable(users), "topk-queries")
    n = q.count()
    if k <= 0 or not n:
        return _none(users, user_col, item_col), _none(users, item_col, user_col)
    all_items = stable_table(_usable(items), "topk-items")
    groups, slices = _cells(n, all_items.count(), _partitions(users))
    open_ = _grouped(q, groups).withColumn("floor", F.lit(float("-inf")))
    found = _meet(open_, all_items.withColumn("g", _each(groups)), k, groups, slices, both=True)
    found = stable_table(found.where("side < 2"), "topk-two-way")
    return _ranked(found.where("side = 0"), k, user_col, item_col), _ranked(found.where("side = 1"), k, item_col, user_col)


def pack(top: DataFrame, query_col: str = "user", cand_col: str = "item") -> DataFrame:
    """Flat top-k rows → (query_col, recommendations ARRAY<STRUCT<cand_col, rating FLOAT>>),
    the shape of ``recommendForAll*``."""
    entries = F.array_sort(
        F.collect_list(F.struct(F.col("rank"), F.col(cand_col), F.col("score").cast("float").alias("rating")))
    )
    return top.groupBy(query_col).agg(entries.alias("_e")).select(
        query_col, F.transform("_e", lambda e: F.struct(e[cand_col].alias(cand_col), e["rating"].alias("rating"))).alias("recommendations")
    )
