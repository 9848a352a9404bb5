"""Periodic runs against a direct search of every period."""

import hashlib
import random
import re
from fractions import Fraction

import numpy as np
import pytest

from conftest import SF001
from hourglass.llm import periodic
from hourglass.llm.queries import q_op13, repeated

FIELDS = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def all_runs(words, e, m):
    n, best = len(words), {}
    for q in range(1, n):
        i = 0
        while i < n - q:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j < n - q and words[j] == words[j + q]:
                j += 1
            if j - i + q >= m and j - i + q >= e * q:
                best.setdefault((i, j - i + q), q)
            i = j
    return sorted((a, n, q) for (a, n), q in best.items())


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def expected(key, text):
    words = repeated(key, words_of(text))
    runs = all_runs(words, 3, 24)
    stay = [not any(a + q <= i < a + n for a, n, q in runs) for i in range(len(words))]
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None, None, None))
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (key, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
            sha("".join(f"{a},{n},{q}\n" for a, n, q in runs)), sha(" ".join(w for w, k in zip(words, stay) if k)))


@pytest.fixture(autouse=True)
def wrap():
    with np.errstate(over="ignore"):
        yield


@pytest.mark.parametrize("e,m", [(2, 2), (3, 24), (Fraction(5, 2), 6), (4, 8)])
def test_catcher_equals_a_direct_search(e, m):
    rnd = random.Random(m)
    for _ in range(80):
        n, k = rnd.randrange(0, 110), rnd.choice([1, 2, 3, 60])
        words = [rnd.randrange(k) for _ in range(n)]
        for _ in range(rnd.randrange(3) if n > 4 else 0):
            a, z = rnd.randrange(n), rnd.randrange(n)
            p = rnd.randrange(1, max(2, (n - a) // 2))
            words[a:z] = [words[a + (i - a) % p] for i in range(a, z)]
        want = all_runs(words, e, m)
        # appended one by one, a few at a time, and all at once
        for chunk in (1, 7, 1 << 16):
            assert periodic.word_runs(words, e, m, chunk=chunk) == want


def test_catchers_expire_and_long_runs_merge():
    catcher = periodic.Catcher(3, 24)
    for i in range(0, 40_000, 1000):
        catcher.append(np.arange(i, i + 1000) % 7)
        assert all(len(x.names) <= (x.most + 2000) // x.block + 3 for x in catcher.levels)
        assert len(catcher.live[0]) < 3000
    assert catcher.runs() == [(0, 40_000, 7)]


def test_query_equals_brute_force(spark, tmp_path):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").limit(80).select("doc_id", "text", "source").collect()
    rnd = random.Random(3)
    odd = [(None, "a b " * 30), (-1, None), (-2, ""), (-3, " \t\n"), (-4, "x " * 23), (-5, "x " * 24), (-6, "p q r s t\x1cu " * 9), (-7, "m n " * 12 + "o " + "m n " * 12),
           (-8, " ".join(f"w{i % 9}" for i in range(300)) + " w0 w1 zz"), (-9, " ".join(rnd.choice("ab") for _ in range(200))), (-5, "x " * 24), (-5, "y " * 40)]
    rows = [(r["doc_id"], r["text"], r["source"], 1, 2) for r in docs] + [(k, t, None, 1, 2) for k, t in odd]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, runs int, start int").repartition(3)
    df.write.parquet(f"{tmp_path}/documents.parquet")
    got = [tuple(r[f] for f in FIELDS) for r in q_op13(spark, str(tmp_path)).collect()]
    want = [expected(r[0], r[1]) for r in rows]
    assert sorted(map(str, got)) == sorted(map(str, want))
    assert sum(w[1] > 0 for w in want) > 5
    df.limit(0).write.parquet(f"{tmp_path}/none/documents.parquet")
    assert q_op13(spark, f"{tmp_path}/none").count() == 0


def test_found_texts(spark):
    df = spark.createDataFrame([(1, "go " + "ab cd " * 5 + "end"), (2, "one two three")], "doc_id long, text string")
    got = {r["doc_id"]: (r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in periodic.find(df).collect()}
    assert got == {1: (12, [(1, 10, 2)], "go ab cd end"), 2: (3, [], "one two three")}
