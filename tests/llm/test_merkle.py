"""Merkle fingerprints against a direct construction."""

import hashlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from hourglass.llm import merkle
from hourglass.llm.queries import q_op12


def md5(s):
    return hashlib.md5(s.encode()).hexdigest()


def cut(items, last):
    out, group = [], []
    for i, x in enumerate(items):
        group.append(x)
        if last(x) or i == len(items) - 1:
            out.append(group)
            group = []
    return out


def build(text):
    """(fingerprint, short piece hashes, short paragraph hashes)"""
    paragraphs = []
    for line in text.split("\n"):
        pieces = [md5(" ".join(p)) for p in cut(line.split(" "), lambda w: ((ord(w[0]) if w else 0) + len(w)) % merkle.PIECE == 0)]
        paragraphs.append((md5("".join(pieces)), [p[:8] for p in pieces]))
    sections = [(md5("".join(h for h, _ in s)), s) for s in cut(paragraphs, lambda p: p[0][0] < "4")]
    root = hashlib.sha256("".join(h for h, _ in sections).encode()).hexdigest()
    written = ";".join(h[:8] + "=" + ",".join(p[:8] + "." + "".join(x) for p, x in s) for h, s in sections)
    return f"{root}/{written}", [x for _, s in sections for _, p in s for x in p], [h[:8] for h, _ in paragraphs]


def like(a, b):
    return 2 * sum((Counter(a) & Counter(b)).values()) / (len(a) + len(b))


def edit(a, b):
    head = 0
    while head < min(len(a), len(b)) and a[head] == b[head]:
        head += 1
    tail = 0
    while tail < min(len(a), len(b)) - head and a[-1 - tail] == b[-1 - tail]:
        tail += 1
    return head, len(a) - tail, head, len(b) - tail


def brute(rows):
    order = sorted({(k is not None, k or 0, md5(t or ""), t or "") for k, t in rows})
    texts = [r[3] for r in order]
    then = {(r[0], r[1], r[3]): texts[(i + 1) % len(texts)] for i, r in enumerate(order)}
    out = []
    for k, t in rows:
        t = t or ""
        nxt = then[(k is not None, k or 0, t)]
        e = len(t) // 4
        new = t[:len(t) - e] + nxt[:e]
        a, b, c = build(t), build(new), build(nxt)
        out.append((k, len(t), hashlib.sha256(new.encode()).hexdigest(), a[0], b[0], like(a[1], b[1]), like(a[1], c[1]), edit(a[2], b[2])[0] if a[0].split("/")[0] != b[0].split("/")[0] else None))
    return sorted(map(str, out))


COLUMNS = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "edit_first"]


@pytest.fixture(scope="module")
def rows(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF001}/documents.parquet").limit(60).collect()]
    odd = [(None, None), (None, "no id"), (-5, ""), (-4, "\n\n"), (-3, "é 😀 ab\U0001f600 cd\n" * 5), (3, "shared id"), (3, "shared id"), (3, docs[5][1]), (10**9, "x" * 5000), (10**9 + 1, "a b " * 20_000)]
    return docs + odd


def test_query_equals_brute_force(spark, rows, tmp_path):
    df = spark.createDataFrame([(k, t, 1, "r", "x") for k, t in rows], "doc_id long, text string, n int, tree string, `next` string")
    df.repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(str(tuple(r[c] for c in COLUMNS)) for r in q_op12(spark, str(tmp_path)).collect())
    assert got == brute(rows)
    df.limit(0).write.parquet(f"{tmp_path}/none/documents.parquet")
    assert q_op12(spark, f"{tmp_path}/none").count() == 0


def test_one_document_and_many_equal_rows(spark):
    one = spark.createDataFrame([(4, "abcdefgh ij")], "doc_id long, text string")
    assert [r["edited"] for r in merkle.edited_fingerprints(one).collect()] == ["abcdefgh ab"]
    many = spark.createDataFrame([(1, "one two three four")] * 500 + [(2, "five six seven")], "doc_id long, text string")
    got = merkle.edited_fingerprints(many).groupBy("doc_id", "edited").count().collect()
    assert sorted(tuple(r) for r in got) == [(1, "one two three five", 500), (2, "five six seone", 1)]


def test_roots_and_located_edits(spark):
    base = "\n".join(f"paragraph {i} says {i * 7919 % 1000} words about {i % 5}" for i in range(60)).split("\n")
    changed = {
        "same": base, "middle": base[:30] + ["something else"] + base[31:], "added": base[:10] + ["a new one", "and more"] + base[10:],
        "dropped": base[:20] + base[25:], "first": ["new", *base[1:]], "last": [*base[:-1], "new"], "none": ["nothing", "in", "common"], "prefix": base[:40],
    }
    df = spark.createDataFrame([(k, "\n".join(base), "\n".join(v)) for k, v in changed.items()], "name string, a string, b string")
    df = df.select("name", merkle.tree(F.col("a")).alias("a"), merkle.tree(F.col("b")).alias("b"))
    got = {r["name"]: r for r in df.select("name", (F.col("a.root") == F.col("b.root")).alias("same"), merkle.edit(F.col("a"), F.col("b")).alias("edit"), merkle.likeness(merkle.leaves(F.col("a")), merkle.leaves(F.col("b"))).alias("near")).collect()}
    for name, lines in changed.items():
        r = got[name]
        assert r["same"] == (name == "same")
        assert (r["edit"] and tuple(r["edit"])) == (None if name == "same" else edit(build("\n".join(base))[2], build("\n".join(lines))[2]))
        assert r["near"] == like(build("\n".join(base))[1], build("\n".join(lines))[1])
    assert got["same"]["near"] == 1 and got["none"]["near"] == 0 and got["middle"]["near"] > 0.9


def test_successors_over_many_ranges(spark):
    keys = [(i * 7 % 1009 - 3, f"t{i % 2}", i) for i in range(1009)]
    got = {(r["id"], r["tag"]): tuple(r["next"]) for r in merkle.successors(spark.createDataFrame(keys, "id long, tag string, n long").repartition(13)).collect()}
    order = sorted(k[:2] for k in keys)
    assert got == dict(zip(order, order[1:] + order[:1]))
