"""SimHash near-dedup by covering locality-sensitive hashing.

Method. A document's fingerprint has bit b set when more than half of its
shingle hashes have it. Fingerprints at most ``radius`` bits apart are linked.
A covering family gives each bit position i a vector m(i) of radius+1 bits and
has one table for each nonzero vector v of radius+1 bits; its mask holds the
positions where the inner product of m(i) and v is odd. The at most ``radius``
positions in which two fingerprints differ span less than the whole space, so
some v is orthogonal to all of them: in that table the masked fingerprints are
equal. No pair within the radius is missed, whatever the data.

Distribution. Only different fingerprints are hashed, so thousands of copies
weigh one row. Inside a bucket a search grows each component from a pivot and
never looks at a linked fingerprint again; it returns at most one edge a
member, never all pairs. Buckets of more than ``BLOCK`` fingerprints are cut
into blocks of that size, and each pair of blocks is a task of its own, so no
task holds more than two blocks and no pair is lost. Components follow from
the edges by star contraction.

Cases. Null or empty text, and text without a word, has fingerprint zero and is
linked like any other. A text with fewer words than a shingle is one shingle.
Repeated rows have equal fingerprints. Rows without an id are documents of
their own, linked by their texts alone. Groups are told apart by their least
fingerprint, ``root``, so an id on unrelated texts doesn't join them. The
``component`` that names a group is its least id that isn't null; several may
share it, and a group of null ids has none.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import NULL_ID, checkpointed, small, written
from .components import components

SHINGLE = 4
RADIUS = 4
BLOCK = 4096
#: A fingerprint is frequent from this many rows and this share of all rows on;
#: so there are at most 1 / share frequent ones, whose groups are broadcast.
HOT_ROWS, HOT_SHARE = 1000, 1 / 2000
_WORDS = re.compile(r"[^\x20\x09-\x0D]+")
_LOWER = {i: i + 32 for i in range(65, 91)}


def fingerprint(text: str | None, k: int = SHINGLE) -> int:
    """The 64-bit fingerprint of one whole text."""
    words = _WORDS.findall((text or "").translate(_LOWER))
    if not words:
        return 0
    line = " ".join(words).encode("utf-8", "surrogatepass")
    if len(words) <= k:
        hashes = [xxhash.xxh64_intdigest(line, 42)]
    else:
        at = np.flatnonzero(np.frombuffer(line, np.uint8) == 32)
        starts = [0, *(at + 1).tolist()]
        ends = [*at.tolist(), len(line)][k - 1:]
        digest = xxhash.xxh64_intdigest
        hashes = [digest(line[a:b], 42) for a, b in zip(starts, ends)]
    h = np.array(hashes, np.uint64)
    total = np.zeros(64, np.int64)
    for i in range(0, len(h), 8192):  # a long text is summed in slices
        bits = np.unpackbits(h[i:i + 8192].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        total += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * total > len(h), bitorder="little").view(np.uint64)[0])


def _tag(text: str) -> Column:
    return F.xxhash64(F.coalesce(F.col(text).cast("string"), F.lit("")))


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", k: int = SHINGLE) -> DataFrame:
    """Rows (id, tag, fp): a hash of the text, and the fingerprint as a signed
    64-bit integer."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.array([fingerprint(t, k) for t in b.column("text").to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("tag"), pa.array(fp.view(np.int64))], names=["id", "tag", "fp"])

    rows = docs.select(F.coalesce(F.col(doc_id).cast("long"), F.lit(NULL_ID)).alias("id"), _tag(text).alias("tag"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(run, "id long, tag long, fp long")


def masks(radius: int = RADIUS, bits: int = 64, seed: int = 1) -> list[int]:
    """The covering family's masks: one for each nonzero vector of radius+1
    bits. The vectors of the positions are a balanced random deal."""
    n = 2 ** (radius + 1)
    deal = [i % n for i in range(bits)]
    random.Random(seed).shuffle(deal)
    return [sum(1 << i for i, m in enumerate(deal) if bin(m & v).count("1") % 2) for v in range(1, n)]


def _signed(x: int) -> int:
    return x - 2**64 if x >= 2**63 else x


def link(fps: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges (root, member) that connect the fingerprints of one bucket just as
    all links within the radius do. A pivot is compared with those not reached
    yet, and these shrink with every link."""
    rest = np.unique(fps).view(np.uint64)
    roots, members = [], []
    while len(rest) > 1:
        root, queue, rest = rest[0], [rest[:1]], rest[1:]
        while queue and len(rest):
            for pivot in queue.pop():
                near = np.bitwise_count(rest ^ pivot) <= radius
                if near.any():
                    found, rest = rest[near], rest[~near]
                    queue.append(found)
                    members.append(found)
                    roots.append(np.full(len(found), root))
                    if not len(rest):
                        break
    if not roots:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(roots).view(np.int64), np.concatenate(members).view(np.int64)


def edges(fps: DataFrame, radius: int = RADIUS, block: int = BLOCK) -> DataFrame:
    """Rows (u, v) over different fingerprints ``fp``: their components are
    those of all links within ``radius``."""
    each = F.explode(F.array(*[F.struct(F.lit(t).alias("t"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("key")) for t, m in enumerate(masks(radius))]))
    rows = fps.select("fp", each.alias("b")).select("fp", "b.t", "b.key")
    sizes = rows.groupBy("t", "key").agg(F.count(F.lit(1)).alias("n"), F.min("fp").alias("a"), F.max("fp").alias("z")).where("n > 1")
    # two members need no task: their link is decided on the spot
    pair = sizes.where("n = 2").where(F.bit_count(F.col("a").bitwiseXOR(F.col("z"))) <= radius).select(F.col("a").alias("u"), F.col("z").alias("v"))
    # merged, as Spark takes rows to be no larger than ``fps`` and would broadcast them
    many = rows.join(sizes.where("n > 2").select("t", "key", F.ceil(F.col("n") / block).cast("int").alias("blocks")).hint("merge"), ["t", "key"])
    # block i meets block j in the bucket part (i, j), i <= j
    own = F.when(F.col("blocks") > 1, F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")).otherwise(F.lit(0))
    parts = many.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    parts = parts.groupBy("t", "key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j")).agg(F.collect_list("fp").alias("fps"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = b.column("fps")
            values, offsets = lists.values.to_numpy(), lists.offsets.to_numpy()
            out = [link(values[x:y], radius) for x, y in zip(offsets, offsets[1:])]
            u, v = (np.concatenate([o[k] for o in out]) if out else np.zeros(0, np.int64) for k in (0, 1))
            yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])

    return parts.select("fps").mapInArrow(run, "u long, v long").unionByName(pair).distinct()


def _grouped(docs: DataFrame, doc_id: str, text: str, k: int, radius: int) -> DataFrame:
    """Rows (id, tag, fp, root, component): ``root`` is the least fingerprint
    of the group, ``component`` its least id that isn't null, if any."""
    rows = written(fingerprints(docs, doc_id, text, k), "simhash-fingerprints")
    known = F.when(F.col("id") != NULL_ID, F.col("id"))
    nodes = written(rows.groupBy("fp").agg(F.min(known).alias("least"), F.count(F.lit(1)).alias("n")), "simhash-nodes")
    comp = components(edges(nodes.select("fp"), radius)).withColumnsRenamed({"node": "fp", "component": "root"})
    linked = checkpointed(nodes.join(comp, "fp"))
    names = checkpointed(linked.groupBy("root").agg(F.min("least").alias("component")))
    linked = linked.select("fp", "root").join(small(names), "root")
    by_fp = nodes.join(linked, "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"), F.when(F.col("root").isNull(), F.col("least")).otherwise(F.col("component")).alias("component"), "n")
    by_fp = written(by_fp, "simhash-groups")
    total = by_fp.agg(F.sum("n")).first()[0] or 0
    often = by_fp.where(F.col("n") >= max(HOT_ROWS, total * HOT_SHARE)).drop("n")
    # rows of a frequent fingerprint meet its group where they are
    here = rows.join(F.broadcast(often), "fp")
    rest = rows.join(F.broadcast(often.select("fp")), "fp", "left_anti").join(by_fp.drop("n"), "fp")
    return here.unionByName(rest).select("id", "tag", "fp", "root", "component")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", k: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """Rows (id, fp, component, root): ``component`` is the least id reachable
    over links of at most ``radius`` differing bits, the row itself included;
    ``root`` is the least fingerprint and tells groups of null ids apart. A null
    id is ``NULL_ID`` here."""
    return _grouped(docs, doc_id, text, k, radius).select("id", "fp", "component", "root")


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", k: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """``docs`` with one row of each group: the one with the smallest id (null
    ids first), then fingerprint, then hash of text. An id on unrelated texts
    stands for several documents; each group keeps a row."""
    near = _grouped(docs, doc_id, text, k, radius)
    stay = near.groupBy("root").agg(F.min(F.struct("id", "fp", "tag")).alias("m")).select(F.col("m.id").alias("its"), F.col("m.tag").alias("its_tag"))
    stay = written(stay, "simhash-kept")
    df = docs.select(F.struct("*").alias("row"), F.coalesce(F.col(doc_id).cast("long"), F.lit(NULL_ID)).alias("id"), _tag(text).alias("tag"))
    df = df.join(stay, (F.col("id") == F.col("its")) & (F.col("tag") == F.col("its_tag"))).select("row", "id", "tag")
    # of rows equal in id and text, the one with the least other columns stays
    repeated = near.groupBy("id", "tag").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    repeated = written(repeated.select(F.col("id").alias("its"), F.col("tag").alias("its_tag")), "simhash-repeated-rows")
    if repeated.isEmpty():
        return df.select("row.*")
    same = (F.col("id") == F.col("its")) & (F.col("tag") == F.col("its_tag"))
    again = df.join(repeated, same, "left_semi")
    first = again.groupBy("id", "tag").agg(F.min_by("row", F.to_json("row")).alias("row"))
    return df.join(repeated, same, "left_anti").select("row.*").unionByName(first.select("row.*"))
