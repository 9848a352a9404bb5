"""Text operators against brute force on small tables with nulls, empty and
long texts, ties, repeated rows and columns whose names clash."""

import hashlib
import re
import sys
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from conftest import SF001
from hourglass.llm import license_scan, line_dedup, packing, quality, simhash, suffix_dedup
from hourglass.llm.components import components
from hourglass.llm.queries import PACKING_TOKENIZER, tokenizer_path

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, fp long, h string, row int, _w string, block string"
EMPTY = "doc_id long, text string, lang string, source string, n_chars long"


def words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", t or "")


@pytest.fixture(scope="module")
def texts(spark):
    base = [r["text"] for r in spark.read.parquet(f"{SF001}/documents.parquet").orderBy("doc_id").limit(60).collect()]
    rows = [(i, t, ("en", "de", None)[i % 3], f"s{i % 2}") for i, t in enumerate(base)]
    rows += [
        (100, None, "en", "s0"), (101, "", "en", None), (102, " \t\n", None, "s1"), (103, base[0], "en", "s0"), (103, base[0], "en", "s0"),
        (None, base[1][:400] + "é" * 70 + base[2], "en", "s0"), (104, "x " * 30_000, "en", "s1"), (105, "Word" * 200, "en", "s1"),
        (106, "\n".join(["same line here"] * 60), "de", "s1"), (7, base[9], "en", "s0"),
    ]
    return rows


@pytest.fixture(scope="module")
def docs(spark, texts):
    full = [(i, t, lang, s, len(t or ""), 1, "h", 2, "w", "b") for i, t, lang, s in texts]
    return spark.createDataFrame(full, SCHEMA).repartition(3).persist()


def test_empty_tables(spark):
    none = spark.createDataFrame([], EMPTY)
    path = tokenizer_path(PACKING_TOKENIZER)
    for out in (quality.judge(none), quality.keep(none), line_dedup.strip_documents(none), simhash.near_duplicates(none), simhash.keep_one(none),
                suffix_dedup.strip_documents(none), packing.packed_digest(none, path), license_scan.scan(none)):
        assert out.count() == 0


def test_base_statistics(docs, texts):
    got = sorted((r["doc_id"] is not None, r["doc_id"] or 0, *[r[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")]) for r in quality.judge(docs).collect())
    want = []
    for i, t, _, _ in texts:
        w = words(t)
        lines = [x for x in (t or "").split("\n") if words(x)]
        grams = [tuple(w[j:j + 3]) for j in range(len(w) - 2)]
        seen = {}
        for g in grams:
            seen[g] = seen.get(g, 0) + 1
        rep = len({j + k for j, g in enumerate(grams) if seen[g] > 1 for k in range(3)})
        want.append((i is not None, i or 0, len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t or "")), len(lines) - len(set(lines)), rep, len(w) < 50 or 100 * rep > 50 * len(w)))
    assert got == sorted(want)


def test_mcd_finds_planted_outliers(spark):
    rng = np.random.default_rng(3)
    rows = [(i, " ".join("".join(rng.choice(list("abcdefgh"), rng.integers(3, 9))) for _ in range(rng.integers(80, 300))), "en", "s") for i in range(120)]
    bad = [(1000 + i, " ".join("".join(rng.choice(list("abcdefgh"), 5)) + "%%%" for _ in range(150)), "en", "s") for i in range(25)]
    df = spark.createDataFrame(rows + bad, "doc_id long, text string, lang string, source string")
    kept = {r["doc_id"]: r["kept"] for r in quality.judge(df).collect()}
    assert all(kept[i] for i in range(120)) and not any(kept[1000 + i] for i in range(25))
    assert sorted(r["doc_id"] for r in quality.keep(df).collect()) == list(range(120))


def _clean(rng, n):
    return [" ".join("".join(rng.choice(list("abcdefgh"), rng.integers(3, 9))) for _ in range(rng.integers(80, 300))) for _ in range(n)]


def test_small_groups_are_judged_by_wider_ones(spark):
    rng = np.random.default_rng(4)
    junk = " ".join("".join(rng.choice(list("abcdefgh"), 5)) + "%%%" for _ in range(150))
    rows = [(i, t, "en", "big") for i, t in enumerate(_clean(rng, 40))]
    rows += [(100 + i, t, "en", "three") for i, t in enumerate([*_clean(rng, 2), junk])]  # judged by its language
    rows += [(200 + i, t, None, None) for i, t in enumerate([*_clean(rng, 2), junk])]  # judged by all documents
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = quality.judge(df).collect()
    assert len(got) == len(rows) and all(r["distance2"] is not None for r in got)
    assert sorted(r["doc_id"] for r in got if not r["kept"]) == [102, 202]
    assert sorted(r["doc_id"] for r in quality.keep(df).collect()) == sorted(set(r[0] for r in rows) - {102, 202})
    few = quality.judge(df.where("doc_id between 100 and 102")).collect()  # nothing wider to judge by
    assert all(r["kept"] and r["distance2"] is None for r in few)


def test_a_third_of_a_group_as_junk_copies(spark):
    rng = np.random.default_rng(5)
    junk = " ".join("".join(rng.choice(list("abcdefgh"), 5)) + "%%%" for _ in range(150))
    rows = [(i, t, "en", "s") for i, t in enumerate(_clean(rng, 60))] + [(1000 + i, junk, "en", "s") for i in range(30)]
    got = quality.judge(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()
    assert sorted(r["doc_id"] for r in got if r["kept"]) == list(range(60))


def test_line_dedup_both_ways(docs, texts):
    def brute(ratio, least):
        host, out = {}, []
        for _, t, _, s in texts:
            host.setdefault(s, []).append({x for x in (t or "").split("\n") if words(x)})
        drop = {s: {x for d in ds for x in d if sum(x in e for e in ds) >= max(least, ratio * len(ds))} for s, ds in host.items()}
        for i, t, _, s in texts:
            out.append((str(i), None if t is None else "\n".join(x for x in t.split("\n") if x not in drop[s])))
        return sorted(out, key=str)

    for rows in (1000, 0):  # broadcast drop lists; joined drop lists
        got = line_dedup.drop_lines(docs, ratio=0.05, min_pages=2, broadcast_rows=rows)
        assert got.columns == [*docs.columns, "n_lines", "n_dropped"]
        assert sorted(((str(r["doc_id"]), r["text"]) for r in got.collect()), key=str) == brute(0.05, 2)


def test_small_hosts_lose_their_boilerplate(spark):
    rows = [(i, f"page {i}\nfooter of nine", "nine") for i in range(9)] + [(20, "alone\nonly page", "one")]
    rows += [(100 + i, "rare line\nx" if i < 2 else f"own {i}", "hundred") for i in range(100)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r["doc_id"]: r["text"] for r in line_dedup.drop_lines(df).collect()}
    assert [got[i] for i in range(9)] == [f"page {i}" for i in range(9)]
    assert got[20] == "alone\nonly page" and got[100] == "rare line\nx"  # one page; two of a hundred


CLASHES = ("kept", "n_bytes", "n_removed", "n_spans", "n_lines", "n_dropped", "doc", "part", "sha", "key", "marks", "more", "kind", "bucket", "context", "start", "stop", "c0", "c1",
           "host", "its", "of", "tag", "of_tag", "its_h", "h", "lines", "left", "drop", "total", "pages", "share", "row", "__host", "__tag", "__lines", "__left", "__drop",
           "id", "fp", "root", "component", "its_tag", "n", "least", "__k", "__t", "distance2", "n_words", "base_failed", "word_chars", "g", "node", "u", "v", "_host", "_h")


@pytest.mark.parametrize("stage", [quality.keep, line_dedup.strip_documents, simhash.keep_one, suffix_dedup.strip_documents])
def test_stages_pass_columns_of_any_name(spark, texts, stage):
    base = [(i, t, lang, s) for i, t, lang, s in texts[:40] + texts[60:66]] + [(3, texts[3][1], "en", "s0")]
    plain = spark.createDataFrame(base, "doc_id long, text string, lang string, source string")
    clash = plain.select("*", *[F.concat(F.lit(f"{c}:"), F.coalesce(F.col("doc_id"), F.lit(-1)), F.lit("/"), F.xxhash64("text")).alias(c) for c in CLASHES])
    key = lambda r: (str(r["doc_id"]), str(r["text"]))
    out = stage(clash)
    assert out.columns == clash.columns
    got = sorted(out.collect(), key=key)
    assert [key(r) for r in got] == sorted(key(r) for r in stage(plain).collect())
    before = {r[CLASHES[0]].split(":", 1)[1] for r in clash.collect()}
    for r in got:
        assert len({r[c].removeprefix(f"{c}:") for c in CLASHES}) == 1 and r["kept"].split(":", 1)[1] in before


def test_simhash_fingerprints_and_components(docs, texts):
    import xxhash

    def brute(t):
        w = words("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
        if not w:
            return 0
        h = [xxhash.xxh64_intdigest(" ".join(w[j:j + 4]).encode(), 42) for j in range(max(1, len(w) - 3))]
        return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))

    near = simhash.near_duplicates(docs).collect()
    want = sorted((simhash.NULL_ID if i is None else i, brute(t)) for i, t, _, _ in texts)
    assert sorted((r["id"], r["fp"] % 2**64) for r in near) == want
    root = {a: a for _, a in want}
    for _ in range(10):
        for a in root:
            root[a] = min(root[b] for b in root if bin(a ^ b).count("1") <= 4)
    ids = {}
    for i, a in want:
        ids.setdefault(root[a], []).append(i)
    names = {r: min((i for i in own if i != simhash.NULL_ID), default=None) for r, own in ids.items()}
    assert sorted((r["id"], r["fp"] % 2**64, r["component"]) for r in near) == sorted((i, a, names[root[a]]) for i, a in want)
    groups = {}
    for r in near:
        groups.setdefault(r["root"], set()).add(root[r["fp"] % 2**64])
    assert all(len(g) == 1 for g in groups.values()) and len(groups) == len(ids)
    kept = [simhash.NULL_ID if r["doc_id"] is None else r["doc_id"] for r in simhash.keep_one(docs).collect()]
    assert sorted(kept) == sorted(min(own) for own in ids.values())


def test_shared_and_null_ids_lose_no_group(spark, texts):
    a, b, c, d, e, f = (texts[i][1] for i in (7, 9, 11, 13, 15, 17))  # unrelated texts
    fps = [simhash.fingerprint(t) for t in (a, b, c, d, e, f)]
    assert min(bin(x ^ y).count("1") for i, x in enumerate(fps) for y in fps[:i]) > 4
    rows = [(None, a), (None, b), (8, b), (5, c), (6, c), (5, d), (3, d), (1, e), (1, e), (None, a)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = sorted([(None, a), (None, b), (5, c), (3, d), (1, e)], key=str)
    assert sorted(((r["doc_id"], r["text"]) for r in simhash.keep_one(df).collect()), key=str) == want
    # one id is the least of two groups
    two = spark.createDataFrame([(5, c), (6, c), (5, d), (7, d)], "doc_id long, text string")
    kept = corpus_pipeline.near_duplicates(spark, two, SF001).collect()
    assert sorted((r["doc_id"], r["text"]) for r in kept) == sorted([(5, c), (5, d)])
    # rows without an id beside two groups: the names stay apart
    mixed = [(None, a), (5, a), (6, a), (None, b), (7, b), (8, b), (None, c), (None, c)]
    near = simhash.near_duplicates(spark.createDataFrame(mixed, "doc_id long, text string")).collect()
    assert sorted(str(r["component"]) for r in near) == ["5"] * 3 + ["7"] * 3 + ["None"] * 2
    assert len({r["root"] for r in near}) == 3


def test_frequent_fingerprints_and_odd_columns(spark, texts, monkeypatch):
    a, b, c = (texts[i][1] for i in (7, 9, 11))
    monkeypatch.setattr(simhash, "HOT_ROWS", 3)
    monkeypatch.setattr(simhash, "HOT_SHARE", 0.2)
    rows = [(i, a, {"k": i}) for i in range(5)] + [(9, b, {"x": 1}), (9, b, {"x": 2}), (12, c, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, tags map<string,int>")
    near = {(r["id"], r["component"]) for r in simhash.near_duplicates(df).collect()}
    assert near == {(i, 0) for i in range(5)} | {(9, 9), (12, 12)}
    assert sorted((r["doc_id"], str(r["tags"])) for r in simhash.keep_one(df).collect()) == [(0, "{'k': 0}"), (9, "{'x': 1}"), (12, "None")]


def test_covering_masks_miss_no_pair():
    masks = simhash.masks()
    rng = np.random.default_rng(1)
    for _ in range(3000):
        bits = rng.choice(64, 4, replace=False).tolist()
        assert any(not any(m >> b & 1 for b in bits) for m in masks)


def test_oversize_buckets_lose_no_link(spark):
    rng = np.random.default_rng(2)
    fps = np.unique(np.array([int(sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 6), replace=False))) for _ in range(400)], np.uint64)).view(np.int64)
    df = spark.createDataFrame([(int(f),) for f in fps], "fp long")
    found = []
    for block in (16, 4096):
        comp = components(simhash.edges(df, block=block))
        found.append({r["node"]: r["component"] for r in comp.collect()})
    assert found[0] == found[1]


def test_bucket_rows_are_not_broadcast(spark, tmp_path):
    """A row of each mask is many times the fingerprints, whose file is small."""
    at = str(tmp_path / "fps")
    spark.range(4000).select(F.xxhash64("id").alias("fp")).write.parquet(at)
    plan = simhash.edges(spark.read.parquet(at))._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan


def suffix_brute(rows):
    """rows (key, bytes), one a document, in order; equal rows are one."""
    first, docs = {}, sorted(set(rows), key=lambda r: (r[0], hashlib.sha256(r[1]).hexdigest()))
    for d, (_, b) in enumerate(docs):
        for s in range(len(b) - 99):
            first.setdefault(b[s:s + 100], (d, s))
    out = {}
    for d, (key, b) in enumerate(docs):
        gone = np.zeros(len(b), bool)
        for s in range(len(b) - 99):
            if first[b[s:s + 100]] != (d, s):
                gone[s:s + 100] = True
        left = np.frombuffer(b, np.uint8)[~gone].tobytes()
        spans = int((gone & ~np.r_[False, gone[:-1]]).sum()) if len(b) else 0
        out[key, b] = (key, len(b), int(gone.sum()), spans, hashlib.sha256(left).hexdigest())
    return sorted(out[r] for r in rows)


def suffix_rows(df):
    out = suffix_dedup.remove_repeats(df).withColumn("sha", F.sha2("kept", 256))
    return sorted((suffix_dedup.NULL_ID if r["doc_id"] is None else r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["sha"]) for r in out.collect())


@pytest.mark.parametrize("slice_, hot", [(1 << 20, 40), (64, 1)])
def test_suffix_dedup(spark, docs, texts, monkeypatch, slice_, hot):
    monkeypatch.setattr(suffix_dedup, "SLICE", slice_)  # long texts are cut; every bucket is frequent
    monkeypatch.setattr(suffix_dedup, "HOT", hot)
    monkeypatch.setattr(suffix_dedup, "SAMPLE", 1 if hot == 1 else 64)
    rows = [(suffix_dedup.NULL_ID if i is None else i, (t or "").encode()) for i, t, _, _ in texts]
    assert suffix_rows(docs.select("doc_id", "text", "h")) == suffix_brute(rows)
    # every id once: no rows are merged first
    each = {i: (i, t) for i, t, _, _ in texts}
    df = spark.createDataFrame(list(each.values()), "doc_id long, text string")
    assert suffix_rows(df) == suffix_brute([(suffix_dedup.NULL_ID if i is None else i, (t or "").encode()) for i, t in each.values()])


def test_suffix_dedup_of_repeated_and_null_ids(spark, texts):
    rng = np.random.default_rng(8)
    text = lambda n: "".join(rng.choice(list("abcdefgh "), n))
    long, shared, a, b = text(8000), text(150), text(300), text(300)
    # thousands of equal rows; null ids that share a passage; one id on several texts
    rows = [(5, long)] * 5000 + [(None, a + shared), (None, shared + b), (None, a + shared), (7, b), (7, shared), (7, None), (9, long[:500])]
    got = suffix_rows(spark.createDataFrame(rows, "doc_id long, text string").repartition(8))
    keyed = [(suffix_dedup.NULL_ID if i is None else i, (t or "").encode()) for i, t in rows]
    few = suffix_brute([(5, long.encode())] + keyed[5000:])
    assert got == sorted([r for r in few if r[0] == 5] * 5000 + [r for r in few if r[0] != 5])
    assert any(r[0] == suffix_dedup.NULL_ID and r[2] for r in got)


def test_second_identifier_follows_the_bytes():
    rng = np.random.default_rng(9)
    data = rng.integers(0, 3, 400).astype(np.uint8)
    with np.errstate(over="ignore"):
        one, two = suffix_dedup.other(np.r_[data, data]), suffix_dedup.other(data)
    assert (one[:301] == two).all() and (one[400:] == two).all() and len(set(one[:400].tolist())) == 400


def test_packing_round_trip(docs, texts):
    from tokenizers import Tokenizer

    path = tokenizer_path(PACKING_TOKENIZER)
    tok = Tokenizer.from_file(path)
    rows = packing.pack(docs, path, group_tokens=20_000).collect()
    seqs, pieces = {}, {}
    for r in rows:
        seqs.setdefault(r["sequence_id"], []).append(r)
    for parts in seqs.values():
        parts.sort(key=lambda r: r["offset"])
        ends = [0, *np.cumsum([r["length"] for r in parts]).tolist()]
        assert [r["offset"] for r in parts] == ends[:-1]
        n = ends[-1]
        assert n <= 4096 and n & (n - 1) == 0 and {r["sequence_length"] for r in parts} == {n}
        assert len({r["step_group"] for r in parts}) == 1
    for r in rows:
        pieces.setdefault(r["doc_id"], []).append(r)
    want = {}
    for i, t, _, _ in texts:
        want.setdefault(i, []).append([*tok.encode(t or "", add_special_tokens=False).ids, 2])
    for i, lists in want.items():
        ids = sum(any(np.frombuffer(r["ids"], np.uint32).tolist() == x[r["start"]:r["start"] + r["length"]] for x in lists) for r in pieces[i])
        assert ids == len(pieces[i]) and sum(r["length"] for r in pieces[i]) == sum(map(len, lists))
    some = packing.packed_digest(docs, path).where("doc_id = 5").collect()
    assert all(r["ids_crc32"] == zlib.crc32(np.array(want[5][0][r["start"]:r["start"] + r["length"]], np.uint32).tobytes()) for r in some)


def test_packing_keeps_few_words(monkeypatch):
    """Full caches keep what is in use, stay within their bounds, and give the tokenizer's ids."""
    monkeypatch.setattr(packing, "CACHE_WORDS", 60)
    monkeypatch.setattr(packing, "CACHE_STEMS", 50)
    enc = packing._Words(tokenizer_path(PACKING_TOKENIZER))
    for k in range(6):
        text = " ".join(f"often, {chr(97 + i)}{chr(97 + k)}w. Q{i}{k}" for i in range(20))
        ids, at = enc.encode(pa.array([text, None]), 2)
        assert ids.tolist() == [*enc.tok.encode(text, add_special_tokens=False).ids, 2, 2] and at.tolist() == [0, len(ids) - 1, len(ids)]
        assert len(enc.known) <= 60 and len(enc.stems) <= 50 and "often," in enc.known
    learned = []
    monkeypatch.setattr(enc, "learn", learned.extend)
    monkeypatch.setattr(packing, "CACHE_WORDS", 0)
    enc.encode(pa.array([text]), 2)
    assert learned == []


def test_packing_words_are_no_python_objects(monkeypatch):
    """Words met before are looked up and put in place by Arrow alone, with the tokenizer's ids
    for every letter whose lower case may be plain."""
    enc = packing._Words(tokenizer_path(PACKING_TOKENIZER))
    letters = [chr(c) for c in [*range(1, 0x250), 0x3A3, 0x1E9E, 0x2126, 0x212A, 0x212B, 0x2C62, 0x2C64, 0x1F600]]
    texts = [None, "", *(f"A{c}b {c}{c}. x{c} Q.{c},{c}" for c in letters), "Don't stop,now. 3.14 $5 (ok)!!! ...", "Word" * 200]
    want = [[*enc.tok.encode(t or "", add_special_tokens=False).ids, 2] for t in texts]
    for again in (False, True):
        if again:
            monkeypatch.setattr(enc, "tok", None)
        ids, at = enc.encode(pa.array(["skipped" * (not again), *texts]).slice(1), 2)
        assert [ids[a:b].tolist() for a, b in zip(at, at[1:])] == want and at[-1] == len(ids)
    assert isinstance(enc.known.words, pa.Array) and isinstance(enc.stems.words, pa.Array)
    ids, at = enc.encode(pa.array([], pa.string()), 2)
    assert not len(ids) and at.tolist() == [0]


def test_packing_frees_words():
    """A worker drops its words before it reads pieces, and widens few pieces at a time."""
    path = tokenizer_path(PACKING_TOKENIZER)
    packing._words(path).encode(pa.array(["some words"]), 2)
    n = 2 * packing.PIECES_AT_ONCE + 1
    stored = [np.array([i % 65536, 7], "<u2").tobytes() for i in range(n)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(n)), pa.array(stored)], names=["doc_id", "ids"])
    out = list(packing._widen(iter([batch]), "<u2", "crc", pa.int64(), zlib.crc32))
    assert packing._KEPT not in sys.modules
    assert max(b.num_rows for b in out) == packing.PIECES_AT_ONCE
    got = pa.Table.from_batches(out).to_pydict()
    assert got == {"doc_id": list(range(n)), "crc": [zlib.crc32(np.array([i % 65536, 7], "<u4").tobytes()) for i in range(n)]}


def test_license_scan(spark):
    mit = license_scan.TEMPLATES[0][1].split()
    noisy = mit[:20] + ["really"] + mit[20:30] + mit[31:]
    rows = [
        (1, "Foo. Released under the MIT-License! bar MIT license"), (2, None), (3, ""), (4, "a " * 40 + " ".join(noisy).title() + " tail"),
        (5, "GNU General Public License and the Apache LICENSE, x"), (6, "clean text about software without any charge"), (None, "Licensed under CC BY-NC 4.0."), (6, "mİt license K mıt"),
    ]
    got = sorted((str(r["doc_id"]), r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"], r["labels"]) for r in license_scan.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    n = 40 + len(noisy) + 1
    assert got == sorted([
        ("1", 9, 2, 4, 7, "mit", "mit"), ("2", 0, 0, None, None, "", ""), ("3", 0, 0, None, None, "", ""), ("4", n, 0, None, None, "", "mit"),
        ("5", 9, 2, 1, 6, "apache,gpl", "apache,gpl"), ("6", 7, 0, None, None, "", ""), ("None", 7, 0, None, None, "", "cc-by-nc"), ("6", 4, 0, None, None, "", ""),
    ])


def scan_brute(key, text):
    """Labels and score of one text from the definitions."""
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    k = license_scan.K
    base = [(i, label) for phrase, label in license_scan.PHRASES for i in range(len(w)) if tuple(w[i:i + len(phrase)]) == phrase]
    labels, best = {x for _, x in base}, 0.0
    jac = lambda a, b: len(a & b) / len(a | b)
    pairs = lambda x: set(zip(x, x[1:]))
    for label, template in license_scan.TEMPLATES:
        t = template.split()
        places = {}
        for j in range(len(t) - k + 1):
            places.setdefault(tuple(t[j:j + k]), []).append(j)
        diagonals = {}
        for i in range(len(w) - k + 1):
            for j in places.get(tuple(w[i:i + k]), []):
                diagonals.setdefault(i - j, []).append((i, j))
        group = []
        for d in [*sorted(diagonals), None]:
            if group and (d is None or d - group[-1] > license_scan.DRIFT):
                hits = [h for g in group for h in diagonals[g]]
                a, z = min(i for i, _ in hits), max(i for i, _ in hits) + k
                if len({j for _, j in hits}) >= license_scan.COVER * max(1, len(t) - k + 1):
                    agree = round(jac(set(t), set(w[a:z])), 6)
                    if agree >= license_scan.AGREE and round(jac(pairs(t), pairs(w[a:z])), 6) >= license_scan.ORDER:
                        labels.add(label)
                        best = max(best, agree)
                group = []
            group.append(d)
    at = [i for i, _ in base]
    return (str(key), len(w), len(base), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in base})), ",".join(sorted(labels)), 1.0 if base else best)


def test_license_scan_equals_brute_force(spark):
    rng = np.random.default_rng(12)
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()]
    for n, (label, t) in enumerate(license_scan.TEMPLATES):
        for kind in range(4):
            x = t.split()
            if kind == 1:  # edited words
                for i in rng.choice(len(x), max(1, len(x) // 12), replace=False):
                    x[i] = "edited"
            elif kind == 2:  # the same words in another order, but for a stretch
                x = x[:k] + list(rng.permutation(x[k:])) if (k := len(x) // 2) else x
            elif kind == 3:  # twice, cut off the second time
                x = x + ["and"] * 9 + x[: 2 * len(x) // 3]
            rows.append((10_000 + 10 * n + kind, "Foo bar, " + " ".join(x).title() + ". Baz"))
    rows += [(None, None), (-1, ""), (-1, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = sorted(str((str(r["doc_id"]), r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"], r["labels"], r["score"])) for r in license_scan.scan(df).collect())
    want = [scan_brute(*r) for r in rows]
    assert got == sorted(map(str, want))
    assert sum(bool(x[6]) for x in want) > 30 and any(x[6] != x[5] for x in want)


def test_components(spark):
    edges = [(i, i + 1) for i in range(50)] + [(100, 200), (200, 150), (7, 7)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(51)}, 100: 100, 150: 100, 200: 100}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0
