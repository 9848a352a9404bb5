"""Hard negatives by slot-decomposed selection.

Every anchor has its ``positives``: the best other rows of its label. For each
of them it wants the ``k`` best rows of other labels in a window of scores that
hangs on the positive's: ``low * p <= scale * score <= high * p``.

Method. The upper limits of an anchor's positives, in descending order, split
the scores into disjoint slots: slot j lies below the limits of positives 1 to
j and above the others. The windows overlap, the slots don't, and a row is
put into one slot only. Combiners keep ``k`` rows a slot: first in each block
of rows, then over all blocks. Scores of slot j are above those of slot j + 1,
so the k best below limit j are the head of slot j followed by the answer for
j + 1: one merge from the last slot to the first answers all windows, and a
window's lower end cuts the tail of its answer.

Distribution. Anchors are the stated query set. Anchors and rows are dealt into
blocks by a hash of the row, so that neither a hot label nor a common vector
gathers; each block of anchors meets each block of rows in a group of its own
(at most ``ANCHORS`` and ``ROWS`` rows). A group returns at most (positives x
k) rows an anchor. Scores are 64-bit integers: matrix products in double
precision where they are exact (below 2**53), Python integers elsewhere, cut
off at the ends of the long range.

Cases. Rows with a null label, a null vector or a null component take no part.
A row never meets rows of its own id. A null id is no anchor, but a candidate;
it comes after all ids of the same score. Repeated rows are rows of their own,
as anchors too. Vectors of different lengths have no score. Fewer rows than
asked for: all of them. Other columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written

POSITIVES, K = 5, 10
#: Most anchors and rows of a group, and rows below which a block isn't split.
ANCHORS, ROWS, FEW = 8192, 65_536, 2048
#: Stands for a null id: after all others.
LAST = 2**63 - 1
#: Scores held at a time by a task.
AT_ONCE = 1 << 22

FOUND = "a long, slot int, id long, score long"
RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def _scores(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Exact integer inner products of the rows of x with those of y."""
    bound = x.shape[1] * float(np.abs(x.astype(np.float64)).max(initial=0)) * float(np.abs(y.astype(np.float64)).max(initial=0))
    if bound < 2**53:
        return (x.astype(np.float64) @ y.astype(np.float64).T).astype(np.int64)
    return np.clip(x.astype(object) @ y.astype(object).T, -LAST, LAST).astype(np.int64)


def best(s: np.ndarray, k: int) -> np.ndarray:
    """Places of the k largest of ``s``, descending, ties by place."""
    at = np.arange(len(s))
    if len(s) > k:
        edge = np.partition(s, len(s) - k)[len(s) - k]
        above = np.flatnonzero(s > edge)
        at = np.r_[above, np.flatnonzero(s == edge)[:k - len(above)]]
    return at[np.lexsort((at, -s[at]))]


def _vectors(column: pa.ChunkedArray) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """For each length of vector: the rows that have it, and their vectors."""
    column = column.combine_chunks()
    if isinstance(column, pa.ChunkedArray):
        column = column.chunk(0) if column.num_chunks else pa.array([], column.type)
    n = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy()
    start = np.cumsum(n) - n
    out = {}
    for size in np.unique(n).tolist():
        rows = np.flatnonzero(n == size)
        out[size] = rows, flat[(start[rows][:, None] + np.arange(size)).ravel()].reshape(len(rows), size)
    return out


def _group(choose):
    """A function over one block of anchors and one of rows; ``choose(anchor,
    ids, scores, same label)`` gives the slots and places of an anchor's rows."""

    def run(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if anchors.num_rows and rows.num_rows:
            # in order of ids, so that an earlier place wins a tie
            rows = rows.take(pa.array(np.argsort(rows.column("its_id").to_numpy(), kind="stable")))
            ids, labels = rows.column("its_id").to_numpy(), rows.column("its_label").to_numpy()
            own, own_label, key = (anchors.column(c).to_numpy() for c in ("id", "label", "a"))
            extra = [c for c in ("limits", "least") if c in anchors.column_names]
            more = [anchors.column(c).to_pylist() for c in extra]
            theirs = _vectors(rows.column("its_vec"))
            for size, (at, x) in _vectors(anchors.column("vec")).items():
                if size not in theirs:
                    continue
                place, y = theirs[size]
                step = max(1, AT_ONCE // len(place))
                for i in range(0, len(at), step):
                    s = _scores(x[i:i + step], y)
                    for row, one in zip(at[i:i + step].tolist(), s):
                        other = ids[place] != own[row]
                        same = labels[place] == own_label[row]
                        slot, found = choose([m[row] for m in more], one, other & same, other & ~same)
                        if len(found):
                            out.append((np.full(len(found), key[row]), slot, ids[place[found]], one[found]))
        a, slot, i, s = (np.concatenate(x) for x in zip(*out)) if out else [np.zeros(0, np.int64)] * 4
        return pa.table({"a": a, "slot": slot.astype(np.int32), "id": i, "score": s})

    return run


def _positives(n: int):
    def choose(_, scores, same, different):
        at = np.flatnonzero(same)
        at = at[best(scores[at], n)]
        return np.zeros(len(at), np.int32), at

    return choose


def _slots(k: int):
    def choose(more, scores, same, different):
        limits, least = np.array(more[0], np.int64), more[1]  # descending
        at = np.flatnonzero(different & (scores <= limits[0]) & (scores >= least))
        # a slot's number is that of the limits above it
        slot = len(limits) - np.searchsorted(limits[::-1], scores[at])
        parts = [at[slot == j] for j in np.unique(slot).tolist()]
        parts = [p[best(scores[p], k)] for p in parts]
        return np.repeat(np.unique(slot), [len(p) for p in parts]), np.concatenate([*parts, np.zeros(0, np.int64)])

    return choose


def _meet(anchors: DataFrame, rows: DataFrame, anchor_blocks: int, row_blocks: int, run) -> DataFrame:
    """The stated queries against all rows, block by block."""
    each = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    left = anchors.withColumns({"x": F.pmod(F.xxhash64("a"), F.lit(anchor_blocks)), "y": each(row_blocks)})
    # other names throughout: both sides come from one table
    right = rows.select(*[F.col(c).alias(f"its_{c}") for c in ("id", "label", "vec")], F.pmod(F.xxhash64("a"), F.lit(row_blocks)).alias("its_y"), each(anchor_blocks).alias("its_x"))
    return left.groupBy("x", "y").cogroup(right.groupBy("its_x", "its_y")).applyInArrow(run, FOUND)


def _floor(x: Column, by: int) -> Column:
    """Exact floor of x / by, x a decimal."""
    return ((x - F.pmod(x, F.lit(by))) / F.lit(by)).cast("decimal(20,0)").cast("long")


def mine(rows: DataFrame, anchor: Column, row_id: str = "id", label: str = "label", vector: str = "vector",
         positives: int = POSITIVES, k: int = K, low: int = 30, high: int = 90, scale: int = 100) -> DataFrame:
    """Rows (anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score). ``vector`` holds integers; ``anchor`` marks the anchors."""
    spark = rows.sparkSession
    whole = F.coalesce(F.forall(vector, lambda v: v.isNotNull()), F.lit(False))
    base = rows.where(F.col(label).isNotNull() & whole).select(
        F.coalesce(F.col(row_id).cast("long"), F.lit(LAST)).alias("id"), F.col(label).cast("long").alias("label"), F.col(vector).cast("array<bigint>").alias("vec"),
        (F.coalesce(anchor, F.lit(False)) & F.col(row_id).isNotNull()).alias("anchor"), F.monotonically_increasing_id().alias("a"))
    base = written(base, "negatives-rows")
    n, m = base.agg(F.count(F.lit(1)), F.count_if("anchor")).first()
    if not m:
        return spark.createDataFrame([], RESULT)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    blocks = (math.ceil(m / ANCHORS), max(math.ceil(n / ROWS), min(parts, math.ceil(n / FEW))))
    anchors, all_rows = base.where("anchor").select("a", "id", "label", "vec"), base.select("a", "id", "label", "vec")
    order = [F.desc("score"), F.asc("id")]
    near = _meet(anchors, all_rows, *blocks, _group(_positives(positives)))
    near = near.withColumn("j", F.row_number().over(Window.partitionBy("a").orderBy(*order))).where(F.col("j") <= positives)
    score = F.col("score").cast("decimal(20,0)")
    near = near.select("a", "j", F.col("id").alias("positive"), "score", _floor(score * F.lit(high), scale).alias("limit"), (-_floor(-score * F.lit(low), scale)).alias("least"))
    near = written(near, "negatives-positives")
    # a descending list of limits for each anchor
    limits = near.groupBy("a").agg(F.reverse(F.array_sort(F.collect_list("limit"))).alias("limits"), F.min("least").alias("least"))
    found = _meet(anchors.join(limits, "a"), all_rows, *blocks, _group(_slots(k)))
    found = found.withColumn("rank", F.row_number().over(Window.partitionBy("a", "slot").orderBy(*order))).where(F.col("rank") <= k)
    # at most positives x k rows an anchor; from the last slot to the first
    listed = found.groupBy("a").agg(F.array_sort(F.collect_list(F.struct("slot", "rank", "id", "score"))).alias("all"))
    slots = F.transform(F.sequence(F.lit(positives), F.lit(1), F.lit(-1)), lambda j: F.filter("all", lambda x: x["slot"] == j))
    kind = "array<array<struct<slot:int,rank:int,id:bigint,score:bigint>>>"
    merge = lambda done, slot: F.concat(F.array(F.slice(F.concat(slot, F.coalesce(F.get(done, F.lit(0)), F.slice(slot, 1, 0))), 1, k)), done)
    windows = listed.select("a", F.posexplode(F.aggregate(slots, F.array().cast(kind), merge)).alias("p", "best"))
    one = near.join(windows.withColumn("j", F.col("p") + 1).drop("p"), ["a", "j"]).join(anchors.select("a", F.col("id").alias("anchor_id")), "a")
    one = one.select("anchor_id", "positive", "score", "least", F.posexplode("best").alias("p", "n")).where(F.col("n.score") >= F.col("least"))
    null_last = lambda c: F.nullif(c, F.lit(LAST))
    return one.select("anchor_id", null_last(F.col("positive")).alias("positive_id"), (F.col("p") + 1).cast("int").alias("rank"),
                      null_last(F.col("n.id")).alias("negative_id"), F.col("score").alias("positive_score"), F.col("n.score").alias("negative_score"))
