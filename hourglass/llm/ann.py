"""Approximate nearest neighbours by a hierarchical k-means tree.

Method. A tree is fitted by recursive k-means on a bounded sample (at most
``SAMPLE`` vectors with the least hash of their id); leaves are about
``LEAF`` vectors of the whole table, so their number follows the input up to
``MAX_LEAVES``. Every vector is put into the leaf that it descends to. A query
goes best-bin-first: a priority queue holds the branches not taken, the most
promising one is opened next, until the number of visited leaves is reached.
That number is widened on calibration queries (held against brute force)
until their recall reaches ``TARGET``. Visits widen in rounds; after each,
leaves only answer with what reaches the query's k-th best so far.

Distribution. The tree is the only broadcast (at most MAX_LEAVES centroids
and as many inner nodes). Vectors are dealt by (leaf, block), blocks of at
most ``BLOCK`` rows, so a leaf with a third of all rows is many tasks'
work; the queries that visit a leaf come to each of its blocks. A block answers
each of its queries with its own ``k`` best, and these are cut to ``k`` by
each task and then over all. Scores are inner products of the original vectors in double
precision; ties go to the smaller id.

Cases. Vectors that are null, empty, zero, hold a null or non-finite component,
or differ in length from the commonest length take no part. Nor do rows with a
null id. Each repeated row is a candidate, except to queries of its id; the
queries of one id are answered together. Fewer candidates than ``k``: all of them.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import written

SAMPLE = 20_000
LEAF = 256
MAX_LEAVES = 16_384
BRANCH = 16
BLOCK = 4096
CALIBRATION = 200
TARGET = 0.94
#: Leaves of the first round, and the factor from round to round.
FIRST, WIDEN = 4, 4


#: A tree has ``centroids``; ``children[i]``, the node numbers below node i; and
#: ``leaf[i]``, the leaf number of a node without children, else -1. A plain
#: namespace: a broadcast of it can be read without this package.
Tree = SimpleNamespace


def n_leaves(tree: Tree) -> int:
    return int((tree.leaf >= 0).sum())


def _kmeans(x: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 12) -> np.ndarray:
    c = x[rng.choice(len(x), k, replace=False)]
    for _ in range(rounds):
        own = _nearest(x, c)
        sums = np.zeros_like(c)
        np.add.at(sums, own, x)
        n = np.bincount(own, minlength=k)
        c = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], c)
    return c


def _nearest(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return np.argmin((c * c).sum(1)[None, :] - 2 * (x @ c.T), axis=1)


def fit_tree(x: np.ndarray, leaves: int, branch: int = BRANCH, seed: int = 5) -> Tree:
    """Split the sample ``x`` until a node has its share of it per leaf."""
    rng = np.random.default_rng(seed)
    share = max(2.0, len(x) / max(1, leaves))
    centroids, children, leaf = [x.mean(0) if len(x) else np.zeros(1)], [np.zeros(0, int)], [-1]
    todo = [(0, np.arange(len(x)))]
    made = 0
    while todo:
        node, rows = todo.pop()
        k = min(branch, math.ceil(len(rows) / share))
        if k < 2 or (x[rows] == x[rows[0]]).all():
            leaf[node], made = made, made + 1
            continue
        c = _kmeans(x[rows], k, rng)
        own = _nearest(x[rows], c)
        used = [i for i in range(k) if (own == i).any()]
        if len(used) < 2:
            leaf[node], made = made, made + 1
            continue
        ids = np.arange(len(centroids), len(centroids) + len(used))
        children[node] = ids
        for i, j in zip(ids.tolist(), used):
            centroids.append(c[j])
            children.append(np.zeros(0, int))
            leaf.append(-1)
            todo.append((i, rows[own == j]))
    return Tree(centroids=np.array(centroids), children=children, leaf=np.array(leaf))


def descend(tree: Tree, x: np.ndarray) -> np.ndarray:
    """Leaf number of each row of ``x``."""
    out, todo = np.zeros(len(x), np.int64), [(0, np.arange(len(x)))]
    while todo:
        node, rows = todo.pop()
        below = tree.children[node]
        if not len(below):
            out[rows] = tree.leaf[node]
            continue
        own = _nearest(x[rows], tree.centroids[below])
        todo += [(int(b), rows[own == i]) for i, b in enumerate(below) if (own == i).any()]
    return out


def visits(tree: Tree, q: np.ndarray, most: int) -> list[int]:
    """The first ``most`` leaves of a best-bin-first traversal for query q: the
    branch whose centroid has the largest inner product is opened next."""
    queue, out = [(0.0, 0)], []
    while queue and len(out) < most:
        _, node = heapq.heappop(queue)
        while len(tree.children[node]):
            below = tree.children[node]
            score = tree.centroids[below] @ q
            best = int(np.argmax(score))
            for i, b in enumerate(below.tolist()):
                if i != best:
                    heapq.heappush(queue, (-float(score[i]), b))
            node = int(below[best])
        out.append(int(tree.leaf[node]))
    return out


def _matrix(column: pa.Array) -> np.ndarray:
    n = len(column)
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(n, -1) if n else np.zeros((0, 1))


def usable(vectors: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """Rows (id, v) with a finite nonzero vector of the commonest length."""
    e = F.col(embedding).cast("array<double>")
    good = F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(e, lambda x: x != 0)
    rows = vectors.select(F.col(vec_id).cast("long").alias("id"), e.alias("v")).where(good & F.col("id").isNotNull())
    return rows


def calibrate(tree: Tree, rows: DataFrame, queries: np.ndarray, query_ids: np.ndarray, k: int, target: float) -> int:
    """Leaves to visit, from brute force for a few queries over all rows."""
    top = top_candidates(rows, queries, query_ids, k)
    order = [{leaf: i for i, leaf in enumerate(visits(tree, q, n_leaves(tree)))} for q in queries]
    rank = np.array(sorted(order[q][leaf] for q, leaf in top)) if top else np.zeros(1, int)
    need = int(rank[min(len(rank) - 1, math.ceil(target * len(rank)) - 1)]) + 1
    return min(n_leaves(tree), need)


def top_candidates(rows: DataFrame, queries: np.ndarray, query_ids: np.ndarray, k: int) -> list[tuple[int, int]]:
    """(query number, leaf) of the true ``k`` nearest of each query: each batch
    answers with its own best, each task cuts them to ``k``, then all do."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            s = queries @ _matrix(b.column("v")).T
            ids, leaf = b.column("id").to_numpy(), b.column("leaf").to_numpy()
            s[query_ids[:, None] == ids[None, :]] = -np.inf
            m = min(k, s.shape[1])
            at = np.argpartition(-s, m - 1, axis=1)[:, :m]
            q = np.repeat(np.arange(len(queries)), m)
            at = at.ravel()
            yield pa.RecordBatch.from_arrays([pa.array(q), pa.array(s[q, at]), pa.array(ids[at]), pa.array(leaf[at])], names=["q", "score", "id", "leaf"])

    best = rows.mapInArrow(run, "q long, score double, id long, leaf long").where(F.col("score") > float("-inf"))
    # at most k rows a query and task are shuffled, and k a query collected
    turn = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "id"))
    return [(r["q"], r["leaf"]) for r in best.withColumn("turn", turn).where(F.col("turn") <= k).select("q", "leaf").collect()]


def search(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", k: int = 20, every: int = 20, target: float = TARGET,
           sample: int = SAMPLE, leaf_rows: int = LEAF, block: int = BLOCK, branch: int = BRANCH, first: int = FIRST) -> DataFrame:
    """Rows (query_id, rank, vec_id, score): for each row whose id is divisible
    by ``every``, the ``k`` largest inner products found among all others."""
    rows = usable(vectors, vec_id, embedding)
    sizes = rows.groupBy(F.size("v").alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "d").limit(1).collect()
    spark = vectors.sparkSession
    if not sizes:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    d, n = sizes[0]["d"], sizes[0]["n"]
    rows = rows.where(F.size("v") == d)
    some = rows.orderBy(F.xxhash64("id"), "id").limit(sample).select("v").collect()
    leaves = max(1, min(MAX_LEAVES, math.ceil(n / leaf_rows), sample // 2))
    tree = fit_tree(np.array([r["v"] for r in some]), leaves, branch)
    known = spark.sparkContext.broadcast(tree)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("v"), pa.array(descend(known.value, _matrix(b.column("v"))), pa.int64())], names=["id", "v", "leaf"])

    placed = written(rows.mapInArrow(place, "id long, v array<double>, leaf long"), "ann-index")
    asked = placed.where(F.pmod("id", F.lit(every)) == 0).select("id", "v")
    trial = asked.orderBy(F.xxhash64("id", F.lit(1)), "id").limit(CALIBRATION).collect()
    if not trial:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    most = calibrate(tree, placed, np.array([r["v"] for r in trial]), np.array([r["id"] for r in trial]), k, target)

    def plan(first: int, last: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                q, floor = _matrix(b.column("v")), b.column("floor")
                for i in range(b.num_rows):
                    to = visits(known.value, q[i], last)[first:]
                    n = len(to)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([b.column("id")[i].as_py()] * n, pa.int64()), pa.array([q[i]] * n, pa.list_(pa.float64())), pa.array([floor[i].as_py()] * n, pa.float64()), pa.array(to, pa.int64())],
                        names=["id", "v", "floor", "leaf"])

        return run

    # leaves of more than ``block`` rows are cut; their queries come to each part
    parts = written(placed.groupBy("leaf").agg(F.ceil(F.count(F.lit(1)) / block).cast("long").alias("parts")), "ann-leaves")
    members = placed.join(F.broadcast(parts), "leaf").select("leaf", F.pmod(F.xxhash64("id"), F.col("parts")).alias("part"), "id", "v", F.lit(0.0).alias("floor"), F.lit(False).alias("asks"))
    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by (leaf, part), members before queries."""
        key, ids, held = None, [], []
        cand = np.zeros((0, d))
        cand_ids = np.zeros(0, np.int64)
        for b in batches:
            if not b.num_rows:
                continue
            leaf, part, asking = b.column("leaf").to_numpy(), b.column("part").to_numpy(), b.column("asks").to_numpy(zero_copy_only=False)
            vid, v, floor = b.column("id").to_numpy(), _matrix(b.column("v")), b.column("floor").to_numpy()
            head = np.flatnonzero(np.r_[True, (leaf[1:] != leaf[:-1]) | (part[1:] != part[:-1]) | (asking[1:] != asking[:-1])])
            for a, z in zip(head.tolist(), [*head[1:].tolist(), len(leaf)]):
                now = (int(leaf[a]), int(part[a]))
                if now != key:
                    key, ids, held = now, [], []
                if not asking[a]:
                    ids.append(vid[a:z])
                    held.append(v[a:z])
                    cand, cand_ids = np.concatenate(held), np.concatenate(ids)
                elif held:
                    for i in range(a, z, 256):
                        yield _best(vid[i:min(z, i + 256)], v[i:min(z, i + 256)], floor[i:min(z, i + 256)], cand_ids, cand, k)

    n_parts = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def probe(queries: DataFrame, first: int, last: int) -> DataFrame:
        """What leaves number ``first`` to ``last`` of each query's traversal
        have for it, from its floor up."""
        asks = queries.mapInArrow(plan(first, last), "id long, v array<double>, floor double, leaf long").join(F.broadcast(parts), "leaf")
        asks = asks.select("leaf", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"), "id", "v", "floor", F.lit(True).alias("asks"))
        both = members.unionByName(asks).repartition(n_parts, F.xxhash64("leaf", "part")).sortWithinPartitions("leaf", "part", "asks")
        return both.mapInArrow(answer, "query_id long, vec_id long, score double")

    def best(found: DataFrame) -> DataFrame:
        # cut to k by each task, then over all: no list is longer than k. Its
        # order is that of the result: largest score, smaller id
        turn = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
        some = found.withColumn("turn", turn).where(F.col("turn") <= k)
        return some.groupBy("query_id").agg(F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("s"), "vec_id"))).alias("top"))

    # Rounds of widening: each visits WIDEN times as many leaves as all before
    # it, and answers only with what reaches the k-th best found so far. A
    # query thus sends about k rows for each round and not for each leaf.
    asked = asked.distinct()
    reach = min(first, most)
    top = best(probe(asked.withColumn("floor", F.lit(float("-inf"))), 0, reach))
    while reach < most:
        near = written(top, "ann-round")
        kth = near.select("query_id", F.when(F.size("top") >= k, -F.element_at("top", -1)["s"]).alias("floor"))
        again = asked.join(kth, F.col("id") == F.col("query_id"), "left").select("id", "v", F.coalesce("floor", F.lit(float("-inf"))).alias("floor"))
        found = near.select("query_id", F.explode("top").alias("x")).select("query_id", F.col("x.vec_id").alias("vec_id"), (-F.col("x.s")).alias("score"))
        last = min(most, WIDEN * reach)
        top = best(found.unionByName(probe(again, reach, last)))
        reach = last
    rows = top.select("query_id", F.posexplode("top").alias("p", "x"))
    return rows.select("query_id", (F.col("p") + 1).cast("int").alias("rank"), F.col("x.vec_id").alias("vec_id"), (-F.col("x.s")).alias("score"))


def _best(qid: np.ndarray, q: np.ndarray, floor: np.ndarray, ids: np.ndarray, x: np.ndarray, k: int) -> pa.RecordBatch:
    """The ``k`` best of a block for each query, from its floor up (a tie with
    the floor may still win by its id), ties to the smaller id. Scores
    are summed in the order of components, so equal vectors score equally."""
    s = np.zeros((len(q), len(x)))
    for c in range(x.shape[1]):
        s += q[:, c, None] * x[None, :, c]
    s[qid[:, None] == ids[None, :]] = -np.inf
    out_q, out_i, out_s = [], [], []
    for row in range(len(q)):
        at = np.arange(len(ids))
        if len(ids) > k:
            edge = np.partition(s[row], len(ids) - k)[len(ids) - k]
            at = np.flatnonzero(s[row] >= edge)
        at = at[np.lexsort((ids[at], -s[row][at]))][:k]
        at = at[(s[row][at] > -np.inf) & (s[row][at] >= floor[row])]
        out_q.append(np.full(len(at), qid[row]))
        out_i.append(ids[at])
        out_s.append(s[row][at])
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in (out_q, out_i, out_s)], names=["query_id", "vec_id", "score"])
