"""Suffix-array dedup by bucket-pointer refinement.

A byte is removed when some ``LENGTH``-byte string that covers it also starts
earlier in the corpus (smaller document id; same document, earlier start).

Method. The initial bucket of a suffix is that of its first Q = 25 bytes. A
bucket is refined by the bucket identifier of the suffix Q bytes later, which
sorts to depth 50; these identifiers are reused at offset 50 and sort to depth
100, the length asked for, where refinement is settled. Identifiers are 64-bit
hashes of the pointers they come from, so a refinement needs no exchange of its
own, and only suffixes that share a bucket are refined. Strings count as equal
if two independent identifiers, 128 bits in all, are equal.

Suffixes are sampled first. Every string of LENGTH bytes holds LENGTH-Q+1
initial buckets; its leftmost least one is its anchor. Equal strings have equal
anchors, so only strings whose anchors share a bucket can be equal, and one
suffix in 38 stands for all. An anchor's context is the run of strings that it
anchors; by the refined pointers at the two ends it is known whole.

1. Anchors are sorted by initial bucket. A bucket with one anchor is done. Of
   anchors with equal contexts all but the earliest are covered whole.
2. What is left of buckets with several contexts is refined string by string:
   the depth-100 identifiers of each context are sorted within the bucket, and
   each but the earliest is covered.
3. The covered intervals are united document by document.

Distribution. Text is read once for step 1 and shuffled once for steps 2 and 3
(the exchange is reused). If ids repeat, rows equal in id and text are judged
once, through one written row, and the verdict is joined back. Each task first combines equal contexts of its batch,
so thousands of copies send one row. Buckets that a sample of documents finds
very frequent are dealt by (bucket, context), and later by string, instead of
by bucket; that choice moves rows and changes no result. Tasks stream over
sorted rows and hold one bucket at a time.

Cases. Null text is empty; texts below LENGTH bytes lose nothing. Null ids sort
first. Rows that repeat an id (or a null id) and its text are one document: all
lose the same bytes, none is a copy of the other. Texts that share an id, or
have none, are documents of their own, in order of their SHA-256. Very long
texts are hashed in slices. Other columns pass through; those named like a
column that ``remove_repeats`` adds are replaced by it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import NULL_ID, written

LENGTH = 100
Q = 25
WINDOW = LENGTH - Q + 1
#: Starts hashed at a time.
SLICE = 1 << 20
#: One document in SAMPLE looks for frequent buckets; HOT anchors there make a
#: bucket one; at most HOT_KEYS are told to the tasks (the most frequent).
SAMPLE, HOT, HOT_KEYS = 64, 40, 4096

ANCHOR, COVERED, SPREAD = 0, 1, 2
_BYTE = np.random.default_rng(7).integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_OTHER = np.random.default_rng(11).integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_M1, _M2, _M3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * _M2
    x = (x ^ (x >> np.uint64(27))) * _M3
    return x ^ (x >> np.uint64(31))


def _power(n: int) -> np.uint64:
    return np.uint64(pow(int(_M1), n, 2**64))


def _pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return _mix(a * _M3 + _mix(b + _M1))


def buckets(data: np.ndarray) -> np.ndarray:
    """Identifier of the first Q bytes of each suffix (Q = 16 + 8 + 1)."""
    one = _BYTE[data]
    h = one
    for k in (1, 2, 4):
        h = h[:-k] * _power(k) + h[k:]
    eight = h
    h = h[:-8] * _power(8) + h[8:]
    m = len(data) - Q + 1
    return _mix((h[:m] * _power(8) + eight[16:16 + m]) * _power(1) + one[24:24 + m])


def other(data: np.ndarray) -> np.ndarray:
    """A second identifier at depth LENGTH (64 + 32 + 4), independent of the
    first."""
    at, h, span = {}, _OTHER[data], 1
    while True:
        at[span] = h
        if span == 64:
            break
        h = h[:-span] * _power(span) + h[span:]
        span *= 2
    m = len(data) - LENGTH + 1
    return _mix((at[64][:m] * _power(32) + at[32][64:64 + m]) * _power(4) + at[4][96:96 + m])


def refined(b: np.ndarray) -> np.ndarray:
    """Identifier at depth LENGTH from the initial buckets: two refinements."""
    b = _pair(b[:-Q], b[Q:])
    return _pair(b[:-2 * Q], b[2 * Q:])


def _least(b: np.ndarray) -> np.ndarray:
    """For each run of WINDOW buckets, the place of its leftmost least."""
    at, span = np.arange(len(b), dtype=np.int32), 1
    while 2 * span <= WINDOW:
        x, y = at[:-span], at[span:]
        at = np.where(b[y] < b[x], y, x)
        span *= 2
    rest = WINDOW - span
    m = len(b) - WINDOW + 1
    x, y = at[:m], at[rest:rest + m]
    return np.where(b[y] < b[x], y, x)


def _slices(n: int) -> Iterator[tuple[int, int]]:
    """(first start, bytes' end) of each slice of a text of n bytes."""
    for s in range(0, n - LENGTH + 1, SLICE):
        yield s, min(n, s + SLICE + LENGTH - 1)


def anchors(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bucket, context, first and last string start of each anchor of a text."""
    out = []
    for s, e in _slices(len(data)):
        b = buckets(data[s:e])
        deep, least = refined(b), _least(b)
        first = np.flatnonzero(np.r_[True, least[1:] != least[:-1]])
        last = np.r_[first[1:], len(least)] - 1
        t = least[first]
        shape = ((t - first) * LENGTH + (last - first)).astype(np.uint64)
        out.append((b[t], _pair(_pair(deep[first], deep[last]), shape), first + s, last + s))
    if not out:
        return tuple(np.zeros(0, d) for d in (np.uint64, np.uint64, np.int64, np.int64))
    return tuple(np.concatenate(x) for x in zip(*out))


def _texts(column: pa.Array) -> list[np.ndarray]:
    """The UTF-8 bytes of each text of an Arrow column, without a copy."""
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1] if len(column) else [0]
    data = np.frombuffer(column.buffers()[2], np.uint8) if column.buffers()[2] is not None else np.zeros(0, np.uint8)
    return [data[a:b] for a, b in zip(offsets, offsets[1:])]


def _i64(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64) if x.dtype == np.uint64 else x.astype(np.int64))


def _runs(owner: np.ndarray, start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Union of the intervals [start, stop) of each owner."""
    if not len(owner):
        return owner, start, stop
    order = np.lexsort((start, owner))
    owner, start, stop = owner[order], start[order], stop[order]
    new = np.r_[True, owner[1:] != owner[:-1]]
    # a running maximum that restarts with each owner: owners are lifted apart
    lift = np.cumsum(new).astype(np.int64) * (int(stop.max()) + 2)
    reach = np.maximum.accumulate(stop + lift)
    head = np.r_[True, start[1:] + lift[1:] > reach[:-1]]
    tail = np.r_[head[1:], True]
    return owner[head], start[head], (reach - lift)[tail]


def _later(one: np.ndarray, two: np.ndarray, doc: np.ndarray, part: np.ndarray, start: np.ndarray) -> np.ndarray:
    """True where equal identifiers stand at a smaller (doc, part, start)."""
    order = np.lexsort((start, part, doc, two, one))
    a, b = one[order], two[order]
    head = np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])]
    out = np.empty(len(a), bool)
    out[order] = ~head
    return out


ROW = "kind int, bucket long, context long, doc long, part long, start long, stop long"


def _rows(kind, bucket, context, doc, part, start, stop) -> pa.RecordBatch:
    n = len(doc)
    k = np.full(n, kind, np.int32) if np.isscalar(kind) else kind.astype(np.int32)
    return pa.RecordBatch.from_arrays(
        [pa.array(k), _i64(bucket), _i64(context), _i64(doc), _i64(part), _i64(start), _i64(stop)],
        names=["kind", "bucket", "context", "doc", "part", "start", "stop"])


def _hot_or(keys: list[int]):
    return np.array(sorted(keys), np.int64).view(np.uint64) if keys else np.zeros(0, np.uint64)


def _is_hot(b: np.ndarray, hot: np.ndarray) -> np.ndarray:
    return np.isin(b, hot) if len(hot) else np.zeros(len(b), bool)


def _covered_rows(owner: np.ndarray, start: np.ndarray, stop: np.ndarray, doc: np.ndarray, part: np.ndarray) -> pa.RecordBatch:
    """Intervals whose owner is a row number of (doc, part); dealt by document."""
    o, a, z = _runs(owner, start, stop)
    spread = _mix(doc[o].astype(np.int64).view(np.uint64))
    return _rows(COVERED, spread, spread, doc[o], part[o], a, z)


def _anchor_rows(hot_keys: list[int]):
    hot_list = list(hot_keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        np.seterr(over="ignore")
        hot = _hot_or(hot_list)
        for batch in batches:
            doc, part = batch.column("doc").to_numpy(), batch.column("part").to_numpy()
            found = [anchors(t) for t in _texts(batch.column("text"))]
            owner = np.repeat(np.arange(len(doc)), [len(f[0]) for f in found])
            if not len(owner):
                continue
            b, c, first, last = (np.concatenate(x) for x in zip(*found))
            late = _later(b, c, doc[owner], part[owner], first)
            if late.any():
                yield _covered_rows(owner[late], first[late], last[late] + LENGTH, doc, part)
            b, c, first, last, owner = (x[~late] for x in (b, c, first, last, owner))
            yield _rows(np.where(_is_hot(b, hot), SPREAD, ANCHOR), b, c, doc[owner], part[owner], first, last)

    return run


def _groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Tables of whole groups from batches sorted by ``key``."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        k = batch.column(key).to_numpy()
        edges = np.flatnonzero(k[1:] != k[:-1])
        # the held rows are all of one group; it goes on if the key does
        if held and held[-1].column(key)[-1].as_py() != k[0]:
            yield pa.Table.from_batches(held)
            held = []
        if not len(edges):
            held.append(batch)
            continue
        cut = int(edges[-1]) + 1
        yield pa.Table.from_batches([*held, batch.slice(0, cut)])
        held = [batch.slice(cut)]
    if held:
        yield pa.Table.from_batches(held)


def _sort_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Step 1 over rows sorted by bucket: covered intervals pass, and contexts
    that have to be refined come out as ANCHOR or SPREAD rows."""
    np.seterr(over="ignore")
    for group in _groups(batches, "bucket"):
        kind, b, c, doc, part, first, last = (group.column(i).to_numpy() for i in range(7))
        done = kind == COVERED
        if done.any():
            yield _rows(COVERED, b[done], c[done], doc[done], part[done], first[done], last[done])
        head = np.flatnonzero(np.r_[True, b[1:] != b[:-1]])
        size = np.diff(np.r_[head, len(b)])
        more = (np.repeat(size, size) > 1) | (kind == SPREAD)
        more &= ~done
        if not more.any():
            continue
        kind, b, c, doc, part, first, last = (x[more] for x in (kind, b, c, doc, part, first, last))
        late = _later(b, c, doc, part, first)
        if late.any():
            yield _rows(COVERED, b[late], c[late], doc[late], part[late], first[late], last[late] + LENGTH)
        kind, b, c, doc, part, first, last = (x[~late] for x in (kind, b, c, doc, part, first, last))
        # a bucket with one context left has nothing to refine
        head = np.flatnonzero(np.r_[True, b[1:] != b[:-1]])
        size = np.diff(np.r_[head, len(b)])
        several = (np.repeat(size, size) > 1) | (kind == SPREAD)
        if several.any():
            yield _rows(kind[several], b[several], c[several], doc[several], part[several], first[several], last[several])


STRINGS = "kind int, bucket long, doc long, part long, start long, stop long, ids binary"


def _string_rows(kind, bucket, doc, part, start, stop, ids) -> pa.RecordBatch:
    n = len(doc)
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(n, kind, np.int32)), _i64(bucket), _i64(doc), _i64(part), _i64(start), _i64(stop), pa.array(ids, pa.binary())],
        names=["kind", "bucket", "doc", "part", "start", "stop", "ids"])


def _expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Step 2: the depth-LENGTH identifiers of the strings to be refined. One
    row for each context, or for each string of a frequent bucket."""
    np.seterr(over="ignore")
    for batch in batches:
        docs, parts = batch.column("doc").to_numpy(), batch.column("part").to_numpy()
        plain: list[list] = [[], [], [], [], [], []]
        spread: list[list] = [[], [], [], []]
        for row, (text, marks) in enumerate(zip(_texts(batch.column("text")), batch.column("marks"))):
            if not marks.is_valid:
                continue
            m = marks.values.flatten()
            kind, bucket, start, stop = (x.to_numpy() for x in m)
            todo = np.flatnonzero(kind != COVERED)
            if not len(todo):
                continue
            deep = np.concatenate([refined(buckets(text[s:e])) for s, e in _slices(len(text))])
            twin = np.concatenate([other(text[s:e]) for s, e in _slices(len(text))]) if (kind == SPREAD).any() else None
            for i in todo.tolist():
                a, z = int(start[i]), int(stop[i])
                if kind[i] == SPREAD:
                    spread[0].append(deep[a:z + 1])
                    spread[1].append(np.full(z + 1 - a, row))
                    spread[2].append(np.arange(a, z + 1))
                    spread[3].append(twin[a:z + 1])
                else:
                    for x, v in zip(plain, (bucket[i], docs[row], parts[row], a, z, deep[a:z + 1].tobytes())):
                        x.append(v)
        if plain[0]:
            yield _string_rows(ANCHOR, *[np.array(x, np.int64) for x in plain[:5]], plain[5])
        if spread[0]:
            ids, owner, at, second = (np.concatenate(x) for x in spread)
            late = _later(ids, second, docs[owner], parts[owner], at)
            if late.any():
                o, a, z = _runs(owner[late], at[late], at[late] + LENGTH)
                yield _string_rows(COVERED, _mix(docs[o].astype(np.int64).view(np.uint64)), docs[o], parts[o], a, z, [b""] * len(o))
            ids, owner, at, second = ids[~late], owner[~late], at[~late], second[~late]
            yield _string_rows(SPREAD, ids, docs[owner], parts[owner], at, at, [x.tobytes() for x in second])


def _sort_strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Covered intervals of step 2 from rows sorted by bucket."""
    np.seterr(over="ignore")
    for group in _groups(batches, "bucket"):
        kind, b, doc, part, start, stop = (group.column(i).to_numpy() for i in range(6))
        done = kind == COVERED
        out = [(doc[done], part[done], start[done], stop[done])]
        todo = np.flatnonzero(~done)
        if len(todo):
            ids = np.frombuffer(b"".join(group.column("ids").take(pa.array(todo)).to_pylist()), np.uint64)
            n = (stop - start + 1)[todo]
            row = np.repeat(todo, n)
            at = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n) + start[row]
            late = _later(b[row], ids, doc[row], part[row], at)
            o, a, z = _runs(row[late], at[late], at[late] + LENGTH)
            out.append((doc[o], part[o], a, z))
        d, p, a, z = (np.concatenate(x) for x in zip(*out))
        if len(d):
            yield pa.RecordBatch.from_arrays([_i64(d), _i64(p), _i64(a), _i64(z)], names=["doc", "part", "start", "stop"])


def _cut(columns: list[str], as_text: bool):
    names = list(columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, removed, spans, sizes = [], [], [], []
            for text, one, two in zip(_texts(batch.column("text")), batch.column("marks"), batch.column("more")):
                a = z = np.zeros(0, np.int64)
                if one.is_valid:
                    kind, _, start, stop = (x.to_numpy() for x in one.values.flatten())
                    a, z = start[kind == COVERED], stop[kind == COVERED]
                if two.is_valid:
                    s, e = (x.to_numpy() for x in two.values.flatten())
                    a, z = np.r_[a, s], np.r_[z, e]
                _, a, z = _runs(np.zeros(len(a), np.int64), a, z)
                left = [text[x:y] for x, y in zip(np.r_[0, z], np.r_[a, len(text)])]
                data = np.concatenate(left).tobytes()
                kept.append(data.decode("utf-8", "ignore") if as_text else data)
                sizes.append(len(text))
                removed.append(len(text) - len(data))
                spans.append(len(a))
            arrays = [batch.column(c) for c in names]
            extra = [pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(kept, pa.string() if as_text else pa.binary())]
            yield pa.RecordBatch.from_arrays([*arrays, *extra], names=[*names, "n_bytes", "n_removed", "n_spans", "kept"])

    return run


def _frequent(rows: DataFrame) -> list[int]:
    """The most frequent buckets of one document in SAMPLE: at most HOT_KEYS."""
    some = rows.where(F.pmod(F.xxhash64("doc", "part"), F.lit(SAMPLE)) == 0).mapInArrow(_anchor_rows([]), ROW)
    counts = some.where(F.col("kind") == ANCHOR).groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= HOT)
    return [r["bucket"] for r in counts.orderBy(F.desc("n"), "bucket").limit(HOT_KEYS).collect()]


def _judged(rows: DataFrame, others: dict[str, str], as_text: bool) -> DataFrame:
    """The verdict on different (doc, part), with the columns ``others``."""
    source = rows.select("doc", "part", "text")
    found = source.mapInArrow(_anchor_rows(_frequent(source)), ROW)
    dealt = F.when(F.col("kind") == ANCHOR, F.xxhash64("bucket")).otherwise(F.xxhash64("bucket", "context"))
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    marks = found.repartition(n, dealt).sortWithinPartitions("bucket").mapInArrow(_sort_anchors, ROW)
    marks = written(marks.drop("context"), "suffix-marks")
    lists = marks.groupBy("doc", "part").agg(F.collect_list(F.struct("kind", "bucket", "start", "stop")).alias("marks"))
    whole = rows.join(lists, ["doc", "part"], "left")
    strings = whole.mapInArrow(_expand, STRINGS).repartition(n, F.xxhash64("bucket")).sortWithinPartitions("bucket").mapInArrow(_sort_strings, "doc long, part long, start long, stop long")
    more = strings.groupBy("doc", "part").agg(F.collect_list(F.struct("start", "stop")).alias("more"))
    final = whole.join(more, ["doc", "part"], "left")
    types = "".join(f"{c} {t}, " for c, t in others.items())
    kept = "string" if as_text else "binary"
    return final.mapInArrow(_cut(list(others), as_text), f"{types}n_bytes long, n_removed long, n_spans long, kept {kept}")


ADDED = ("n_bytes", "n_removed", "n_spans", "kept")


def _removed(docs: DataFrame, doc_id: str, text: str, as_text: bool) -> tuple[DataFrame, dict[str, str]]:
    """The columns of ``docs`` but the text under numbered names, and ADDED."""
    names = {c: f"c{i}" for i, c in enumerate(docs.columns) if c != text}
    rows = docs.select(
        F.coalesce(F.col(doc_id).cast("long"), F.lit(NULL_ID)).alias("doc"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
        *[F.col(c).alias(n) for c, n in names.items()])
    if rows.groupBy("doc").agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty():
        types = {n: docs.schema[c].dataType.simpleString() for c, n in names.items()}
        return _judged(rows.withColumn("part", F.lit(0).cast("long")), types, as_text), names
    # one row for each text of an id; numbers rise with (id, hash of the text)
    rows = rows.withColumn("sha", F.sha2(F.col("text").cast("binary"), 256))
    each = rows.select("doc", "sha", "text").dropDuplicates(["doc", "sha"])
    each = each.repartitionByRange(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), "doc", "sha").sortWithinPartitions("doc", "sha")
    each = each.withColumn("part", F.monotonically_increasing_id())
    each = written(each, "suffix-texts").withColumn("key", F.col("doc"))
    verdict = _judged(each, {"key": "bigint", "sha": "string"}, as_text).withColumnRenamed("key", "doc")
    return rows.drop("text").join(verdict, ["doc", "sha"]), names


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", as_text: bool = False) -> DataFrame:
    """``docs`` without the text, plus n_bytes, n_removed, n_spans and ``kept``:
    the bytes that stay (binary), or with ``as_text`` the text of those that
    are whole characters."""
    out, names = _removed(docs, doc_id, text, as_text)
    return out.select(*[F.col(n).alias(c) for c, n in names.items() if c not in ADDED], *ADDED)


def strip_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The pipeline's form: ``docs`` with repeated bytes taken out of the text
    (a character cut in two goes whole) and ``n_chars`` counted anew."""
    out, names = _removed(docs, doc_id, text, as_text=True)

    def column(c: str):
        if c == text:
            return F.col("kept").alias(c)
        if c == "n_chars":
            return F.when(F.col("n_removed") > 0, F.length("kept")).otherwise(F.col(names[c])).cast(docs.schema[c].dataType).alias(c)
        return F.col(names[c]).alias(c)

    return out.select(*[column(c) for c in docs.columns])
