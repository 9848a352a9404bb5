"""Hard negatives against a direct sort of every score."""

import math
import random

import numpy as np
from pyspark.sql import functions as F

from conftest import SF01
from hourglass.llm import hard_negatives
from hourglass.llm.queries import q_op11

COLUMNS = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
LAST = 2**63 - 1


def brute(rows, is_anchor, positives=5, k=10, low=30, high=90, scale=100):
    """rows (id, label, integer vector), a row each."""
    out = []
    for i, label, x in rows:
        if i is None or not is_anchor(i):
            continue
        near = []
        for j, other, y in rows:
            if j != i and len(x) == len(y):
                s = max(-LAST, min(LAST, sum(a * b for a, b in zip(x, y))))
                near.append((-s, LAST if j is None else j, j, other))
        near.sort(key=lambda r: r[:2])
        for s, _, j, _ in [r for r in near if r[3] == label][:positives]:
            hard = [r for r in near if r[3] != label and low * -s <= scale * -r[0] <= high * -s][:k]
            out += [(i, j, rank, r[2], -s, -r[0]) for rank, r in enumerate(hard, 1)]
    return sorted(map(str, out))


def got(df):
    return sorted(str(tuple(r[c] for c in COLUMNS)) for r in df.collect())


def frame(spark, rows):
    return spark.createDataFrame([(i, label, x, 1, 2.0) for i, label, x in rows], "id long, label int, vector array<long>, a int, score double")


def test_equals_a_direct_sort(spark, monkeypatch):
    rnd = random.Random(1)
    vec = lambda: [rnd.randrange(-40, 60) for _ in range(6)]
    common = vec()
    rows = [(i, rnd.choice([0, 0, 0, 1, 2, 3]), common if i % 3 == 0 else vec()) for i in range(400)]
    rows += [(7, 1, vec()), (7, 1, rows[7][2]), (20, 2, vec()), (None, 1, vec()), (None, 0, common), (500, 9, [1, 2]), (520, 9, [3, 4]), (540, 8, [2, 2]), (560, 7, []), (-20, 1, vec())]
    rnd.shuffle(rows)
    df = frame(spark, rows)
    want = brute(rows, lambda i: i % 20 == 0)
    assert got(hard_negatives.mine(df, F.col("id") % 20 == 0)) == want and len(want) > 300
    # many blocks of both kinds
    monkeypatch.setattr(hard_negatives, "ANCHORS", 7)
    monkeypatch.setattr(hard_negatives, "ROWS", 50)
    monkeypatch.setattr(hard_negatives, "AT_ONCE", 100)
    assert got(hard_negatives.mine(df, F.col("id") % 20 == 0)) == want
    few = brute(rows, lambda i: i % 20 == 0, 3, 4, -50, 80, 90)
    assert got(hard_negatives.mine(df, F.col("id") % 20 == 0, positives=3, k=4, low=-50, high=80, scale=90)) == few


def test_large_numbers_and_odd_rows(spark):
    big = 2**40
    rows = [(0, 1, [big, 3]), (1, 1, [big - 1, 5]), (2, 2, [big // 2, 1]), (3, 2, [big // 2, 2]), (4, 3, [-big, 0]), (5, 3, [2**62, 2**62])]
    df = frame(spark, rows)
    assert got(hard_negatives.mine(df, F.col("id") == 0)) == brute(rows, lambda i: i == 0)
    odd = [(0, None, [1]), (100, 1, None), (200, 1, [1, None]), (300, 1, [2, 3]), (301, 2, [1, 1])]
    assert hard_negatives.mine(frame(spark, odd), F.col("id") % 100 == 0).count() == 0  # no positive
    assert hard_negatives.mine(df.limit(0), F.col("id") == 0).count() == 0
    assert hard_negatives.mine(df, F.col("id") == 77).columns == COLUMNS


def test_query_prepares_vectors(spark, tmp_path):
    emb = spark.read.parquet(f"{SF01}/embeddings.parquet").select("vec_id", "embedding", "label").collect()
    odd = [(100_000, None, 3), (100_100, [float("nan")] * 64, 3), (100_200, [float("inf")] * 64, 3), (100_300, [1.0] * 64, None), (None, [0.1] * 64, 3), (100_400, [1e30] * 64, 3), (100_401, [1e30] * 64, 4)]
    rows = [(r["vec_id"], r["embedding"], r["label"]) for r in emb] + odd
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").write.parquet(f"{tmp_path}/embeddings.parquet")
    clean = [(i, (lab + 1) % 10 if i is not None and i % 7 == 0 else lab, [max(-2**63, min(LAST, math.floor(256.0 * float(np.float32(x))))) for x in v])
             for i, v, lab in rows if lab is not None and v is not None and all(math.isfinite(x) for x in v)]
    assert got(q_op11(spark, str(tmp_path))) == brute(clean, lambda i: i % 100 == 0)
