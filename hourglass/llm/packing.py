"""Hierarchical multi-length packing.

Method. Documents are turned into token ids (``EOS`` appended). Each gives as
many whole windows of 4096 ids as it fills; the rest of it is routed to the
shortest context tier (4096, 2048, 1024, 512, 256) that holds it.

- Long rests (tier 4096) each open a window. The gaps of these windows are
  filled from the shorter tiers, longest first, cutting a document where a gap
  ends.
- Long rests beyond what the shorter tiers can fill are packed end to end into
  windows of 4096.
- What the gaps leave of each shorter tier is packed end to end into sequences
  of the tier's own length.
- The open end of each tier is cut into powers of two.

Every sequence is thus full: its length is 4096, a tier or a power of two, and
no padding is needed. Sequences, longest first, are dealt into step groups of
``STEP_TOKENS`` ids; because lengths are powers of two, each step group but the
last of a pack group holds exactly that many.

Distribution. Ids are written once as a table, in 16 bits each if the
vocabulary allows it. Packing works on lengths: pack
groups of about ``GROUP_TOKENS`` ids, dealt by hash of the row, are laid on a
line by running sums within the group, and cutting the line at both sets of
boundaries gives the pieces. The number of groups follows the input; no group
depends on another. Pieces are joined to the ids by row.

Cases. Null text is empty: its only id is ``EOS``. Repeated rows and null ids
are documents of their own. Texts of any length are packed whole.
"""

from __future__ import annotations

import math
import sys
import types
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written

EOS = 2
CONTEXT = 4096
TIERS = (4096, 2048, 1024, 512, 256)
GROUP_TOKENS = 8_000_000
STEP_TOKENS = 1 << 17
#: Words, and their lower-cased letter runs and punctuation, that a worker
#: keeps between tasks; a slice of texts that has more keeps its own.
CACHE_WORDS = 250_000
CACHE_STEMS = 500_000
WORDS_AT_ONCE = 4000
BYTES_AT_ONCE = 4 << 20
PIECES_AT_ONCE = 1000
#: The module that keeps a worker's encoders.
_KEPT = "_packing_encoders"


#: A plain word, lower-cased: letters below U+0250 and then ASCII punctuation,
#: which the tokenizer splits just there.
_PLAIN = "^(?P<a>[a-zß-öø-ɏ]+)(?P<b>[!-&(-/:-@\\[-`{-~']*)$"


class _Kept:
    """Different strings with the ids of each, as two Arrow arrays: a string
    costs its bytes and offsets, and many are looked up in one call."""

    def __init__(self):
        self.words, self.ids = pa.array([], pa.string()), pa.array([], pa.large_binary())

    def __len__(self) -> int:
        return len(self.words)

    def __contains__(self, word: str) -> bool:
        return pc.index(self.words, word).as_py() >= 0

    def look(self, words: pa.Array, learn: Callable[[pa.Array], pa.Array], limit: int) -> pa.Array:
        """The ids of each of ``words``, which differ; ``learn`` gives those of
        new ones. Beyond ``limit`` only these words stay."""
        at = pc.index_in(words, value_set=self.words)
        new, ids = words.filter(at.is_null()), self.ids
        if len(new):
            ids = pa.concat_arrays([ids, learn(new)])
            place = at.fill_null(-1).to_numpy().copy()
            place[place < 0] = np.arange(len(self.words), len(ids))
            at = pa.array(place)
        found = ids.take(at)
        if len(ids) > limit:
            # those in use stay, and with them the frequent ones
            self.words, self.ids = words, found
        elif len(new):
            self.words, self.ids = pa.concat_arrays([self.words, new]), ids
        return found


class _Words:
    """Ids of the words of texts, each word encoded once.

    The tokenizer drops white space and never joins across it, so a text's ids
    are those of its words in turn. Arrow splits the texts, numbers the
    different words of a batch, looks them up and puts their ids in place; no
    word is a Python object. New words are encoded many at a time: a stretch
    of plain words and punctuation is one call, and its ids are cut at the pieces
    that end a word."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.ends = None
        self.kind = np.dtype(id_type(self.tok))
        vocab = self.tok.get_vocab()
        if sum(v.endswith("</w>") for v in vocab) > 1000:
            self.ends = np.zeros(max(vocab.values()) + 1, bool)
            self.ends[[i for v, i in vocab.items() if v.endswith("</w>")]] = True
        self.known, self.stems = _Kept(), _Kept()

    def _each(self, words: pa.Array) -> pa.Array:
        ids = (self.tok.encode(w, add_special_tokens=False).ids for w in words.to_pylist())
        return pa.array([np.array(i, self.kind).tobytes() for i in ids], pa.large_binary())

    def _stems(self, stems: pa.Array) -> pa.Array:
        out = [pa.array([], pa.large_binary())]
        for i in range(0, len(stems), WORDS_AT_ONCE):
            some = stems.slice(i, WORDS_AT_ONCE)
            # ids alone: no offsets of the characters are worked out
            ids = np.array(self.tok.encode_batch_fast([" ".join(some.to_pylist())], add_special_tokens=False)[0].ids, self.kind)
            stop = np.flatnonzero(self.ends[ids]) + 1
            out.append(_cut(ids, np.r_[0, stop]) if len(stop) == len(some) else self._each(some))
        return pa.concat_arrays(out)

    def learn(self, words: pa.Array) -> pa.Array:
        """The ids of new words."""
        if self.ends is None:
            return self._each(words)
        # a word that isn't plain has no parts; the lower case of U+0130 is two characters
        parts = pc.extract_regex(pc.utf8_lower(words), _PLAIN)
        plain = pc.and_(parts.is_valid(), pc.invert(pc.match_substring(words, "\u0130")))
        parts = parts.filter(plain)
        both = pa.concat_arrays([parts.field(0), parts.field(1)]).dictionary_encode()
        stems = both.dictionary
        full = pc.not_equal(stems, "")
        ids = self.stems.look(stems.filter(full), self._stems, CACHE_STEMS)
        # an empty part has no ids
        mask = full.to_numpy(zero_copy_only=False)
        place = np.where(mask, np.cumsum(mask) - 1, len(ids))
        ids = pa.concat_arrays([ids, pa.array([b""], pa.large_binary())]).take(pa.array(place).take(both.indices))
        n = len(parts)
        joined = pc.binary_join_element_wise(ids.slice(0, n), ids.slice(n), pa.scalar(b"", pa.large_binary()))
        other = pc.invert(plain)
        both = pa.concat_arrays([joined, self._each(words.filter(other))])
        mask = plain.to_numpy(zero_copy_only=False)
        return both.take(pa.array(np.where(mask, np.cumsum(mask), n + np.cumsum(~mask)) - 1))

    def encode(self, texts: pa.Array, eos: int) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts on end, each with ``eos`` behind, and where each
        text begins (one place more than texts)."""
        lists = pc.split_pattern(pc.replace_substring(pc.fill_null(texts, ""), "\n", " "), " ")
        if not len(lists):
            return np.zeros(0, self.kind), np.zeros(1, np.int64)
        numbered = lists.flatten().dictionary_encode()
        words = numbered.dictionary.cast(pa.string())
        ids = self.known.look(words, self.learn, CACHE_WORDS)
        # the end of a text is one word more
        ids = pa.concat_arrays([ids, _cut(np.array([eos], self.kind), np.array([0, 1]))])
        ends = lists.offsets.to_numpy()[1:] - lists.offsets.to_numpy()[0]
        out = ids.take(pa.array(np.insert(numbered.indices.to_numpy(), ends, len(words))))
        _, at, data = out.buffers()
        at = np.frombuffer(at, np.int64) // self.kind.itemsize
        return np.frombuffer(data or b"", self.kind, at[-1]), np.r_[0, at[ends + np.arange(1, len(ends) + 1)]]


def _cut(ids: np.ndarray, at: np.ndarray) -> pa.Array:
    """``ids`` cut at places, from 0 to their number, as bytes."""
    offsets = pa.py_buffer(at.astype(np.int64) * ids.itemsize)
    return pa.Array.from_buffers(pa.large_binary(), len(at) - 1, [None, offsets, pa.py_buffer(ids)])


def id_type(tok) -> str:
    """The narrowest little-endian type that holds every id of a tokenizer."""
    return "<u2" if tok.get_vocab_size() <= 1 << 16 and max(tok.get_vocab().values()) < 1 << 16 else "<u4"


def _words(path: str) -> _Words:
    """One encoder a worker: a module of its own keeps it between tasks."""
    kept = sys.modules.setdefault(_KEPT, types.ModuleType(_KEPT)).__dict__
    if path not in kept:
        kept[path] = _Words(path)
    return kept[path]


def token_table(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", eos: int = EOS) -> DataFrame:
    """Written table (doc_id, n, ids): ids as little-endian unsigned integers
    of ``id_type``, ``eos`` last."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = _words(path)
        for batch in batches:
            bytes_ = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            # slices of about BYTES_AT_ONCE; a longer text is one of its own
            part = (np.cumsum(bytes_) - bytes_) // BYTES_AT_ONCE
            cuts = np.flatnonzero(np.diff(part)) + 1
            for i, j in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
                rows = batch.slice(i, j - i)
                ids, at = enc.encode(rows.column("text"), eos)
                offsets = pa.py_buffer((at * enc.kind.itemsize).astype(np.int32 if ids.nbytes < 2**31 else np.int64))
                whole = pa.binary() if ids.nbytes < 2**31 else pa.large_binary()
                data = pa.Array.from_buffers(whole, len(rows), [None, offsets, pa.py_buffer(np.ascontiguousarray(ids))])
                yield pa.RecordBatch.from_arrays([rows.column("doc_id"), pa.array(np.diff(at)), data.cast(pa.binary())], names=["doc_id", "n", "ids"])
            pa.default_memory_pool().release_unused()

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return written(rows.mapInArrow(run, "doc_id long, n long, ids binary").withColumn("row", F.monotonically_increasing_id()), "packing-ids")


def _before(value: Column, w) -> Column:
    return F.coalesce(F.sum(value).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).cast("long")


def _tail_cuts(rest: Column) -> Column:
    """Offsets at which ``rest`` ids are cut into powers of two, longest first:
    the numbers made of its highest bits."""
    kept = F.transform(F.sequence(F.lit(12), F.lit(0), F.lit(-1)), lambda b: (rest - F.pmod(rest, F.pow(F.lit(2), b).cast("long"))).cast("long"))
    return F.array_distinct(kept)


def pieces(lengths: DataFrame, groups: int, step_tokens: int = STEP_TOKENS) -> DataFrame:
    """The plan: rows (row, start, length, sequence_id, offset, sequence_length,
    step_group) from rows (row, n)."""
    d = lengths.select("row", "n", F.pmod(F.xxhash64("row"), F.lit(groups)).cast("int").alias("g"))
    d = d.withColumns({"whole": F.floor(F.col("n") / CONTEXT).cast("long"), "rest": F.pmod("n", F.lit(CONTEXT)).cast("long")})
    tier = F.lit(TIERS[0])
    for t in TIERS[1:]:
        tier = F.when(F.col("rest") <= t, t).otherwise(tier)
    d = d.withColumn("tier", tier)
    full = d.where("whole > 0").select("g", "row", F.explode(F.sequence(F.lit(0), F.col("whole") - 1)).alias("k"))
    full = full.select("g", "row", (F.col("k") * CONTEXT).alias("start"), F.lit(CONTEXT).cast("long").alias("length"), F.lit("w").alias("line"), F.concat_ws(":", "row", "k").alias("seq"), F.lit(0).cast("long").alias("offset"))
    rest = d.where("rest > 0").withColumn("start0", F.col("whole") * CONTEXT)
    # the short tiers on one line, longest tier first; the gaps on another,
    # smallest gap first, as far as the short tiers reach
    order = Window.partitionBy("g").orderBy(F.desc("tier"), F.xxhash64("row"), "row")
    short = rest.where(F.col("tier") < CONTEXT).withColumn("a", _before(F.col("rest"), order)).withColumn("all", F.sum("rest").over(Window.partitionBy("g")))
    supply = short.groupBy("g").agg(F.max("all").alias("supply"))
    long = rest.where(F.col("tier") == CONTEXT).withColumn("gap", CONTEXT - F.col("rest"))
    by_gap = Window.partitionBy("g").orderBy("gap", F.xxhash64("row"), "row")
    long = long.withColumn("a", _before(F.col("gap"), by_gap)).join(supply, "g", "left").withColumn("host", F.col("a") + F.col("gap") <= F.coalesce("supply", F.lit(0)))
    host = long.where("host")
    used = host.groupBy("g").agg(F.sum("gap").alias("used"))
    own = host.select("g", "row", F.col("start0").alias("start"), F.col("rest").alias("length"), F.lit("h").alias("line"), F.col("row").cast("string").alias("seq"), F.lit(0).cast("long").alias("offset"))
    # cut the line at both sets of boundaries; each stretch has one document
    # and one gap, the last that began
    short = short.join(used, "g", "left").withColumn("used", F.coalesce("used", F.lit(0)).cast("long"))
    marks = short.where("a < used").select("g", "a", F.lit(1).alias("o"), F.struct("row", "start0", F.col("a").alias("from"), F.least(F.col("a") + F.col("rest"), F.col("used")).alias("to")).alias("s"), F.lit(None).cast("struct<row:bigint,rest:bigint,from:bigint,to:bigint>").alias("h"))
    gaps = host.where("gap > 0").select("g", "a", F.lit(0).alias("o"), F.lit(None).cast("struct<row:bigint,start0:bigint,from:bigint,to:bigint>").alias("s"), F.struct("row", "rest", F.col("a").alias("from"), (F.col("a") + F.col("gap")).alias("to")).alias("h"))
    line = Window.partitionBy("g").orderBy("a", "o")
    cut = marks.unionByName(gaps).select("g", "a", F.last("s", True).over(line).alias("s"), F.last("h", True).over(line).alias("h")).where("s is not null and h is not null")
    cut = cut.withColumn("z", F.least("s.to", "h.to")).where("z > a")
    fill = cut.select("g", F.col("s.row").alias("row"), (F.col("s.start0") + F.col("a") - F.col("s.from")).alias("start"), (F.col("z") - F.col("a")).alias("length"), F.lit("h").alias("line"), F.col("h.row").cast("string").alias("seq"), (F.col("h.rest") + F.col("a") - F.col("h.from")).alias("offset"))
    # what is left of each tier, end to end
    left = short.where(F.col("a") + F.col("rest") > F.col("used")).select("g", "tier", "row", (F.col("start0") + F.greatest(F.lit(0), F.col("used") - F.col("a"))).alias("start"), (F.col("a") + F.col("rest") - F.greatest("used", "a")).alias("length"))
    left = left.unionByName(long.where("not host").select("g", "tier", "row", F.col("start0").alias("start"), F.col("rest").alias("length")))
    by_tier = Window.partitionBy("g", "tier")
    left = left.withColumn("a", _before(F.col("length"), by_tier.orderBy(F.xxhash64("row"), "row"))).withColumn("total", F.sum("length").over(by_tier))
    left = left.withColumns({"z": F.col("a") + F.col("length"), "open": F.col("total") - F.pmod("total", F.col("tier"))})
    whole = left.where("a < open").withColumn("k", F.explode(F.sequence(F.floor(F.col("a") / F.col("tier")), F.floor((F.least("z", "open") - 1) / F.col("tier")))))
    whole = whole.select("*", (F.col("k") * F.col("tier")).alias("lo"), ((F.col("k") + 1) * F.col("tier")).alias("hi"))
    cuts = _tail_cuts(F.col("total") - F.col("open"))
    tail = left.where("z > open").withColumn("cuts", cuts).withColumn("k", F.explode(F.sequence(F.lit(0).cast("long"), (F.size("cuts") - 2).cast("long"))))
    tail = tail.select("*", (F.col("open") + F.get("cuts", F.col("k").cast("int"))).alias("lo"), (F.col("open") + F.get("cuts", F.col("k").cast("int") + 1)).alias("hi")).where("a < hi and z > lo")
    packed = whole.unionByName(tail.drop("cuts")).withColumns({"x": F.greatest("a", "lo"), "y": F.least("z", "hi")})
    packed = packed.select("g", "row", (F.col("start") + F.col("x") - F.col("a")).alias("start"), (F.col("y") - F.col("x")).alias("length"), F.concat(F.lit("t"), F.col("tier")).alias("line"), F.col("lo").cast("string").alias("seq"), (F.col("x") - F.col("lo")).alias("offset"))
    all_ = full.unionByName(own).unionByName(fill).unionByName(packed)
    # sequences are numbered within their group, longest first
    size = F.sum("length").over(Window.partitionBy("g", "line", "seq"))
    turn = Window.partitionBy("g").orderBy(F.desc("sequence_length"), "line", "seq")
    out = all_.withColumn("sequence_length", size).withColumn("k", F.dense_rank().over(turn))
    before = _before(F.when(F.col("offset") == 0, F.col("sequence_length")).otherwise(F.lit(0)), turn.orderBy("k", "offset"))
    # every piece of a sequence has the ids of earlier sequences before it
    out = out.withColumn("ids", F.when(F.col("offset") == 0, before).otherwise(before - F.col("sequence_length")))
    return out.select("row", "start", "length", (F.col("g").cast("long") * F.lit(2**32) + F.col("k") - 1).alias("sequence_id"), "offset", "sequence_length", (F.col("g").cast("long") * F.lit(2**32) + F.floor(F.col("ids") / step_tokens)).alias("step_group"))


PIECE = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, sequence_length long, step_group long"


def _pieces_of(docs: DataFrame, path: str, doc_id: str, text: str, group_tokens: int) -> tuple[DataFrame, str]:
    """One row a piece with its ids as they are stored, and their type."""
    from tokenizers import Tokenizer

    kind = id_type(Tokenizer.from_file(path))
    width = np.dtype(kind).itemsize
    ids = token_table(docs, path, doc_id, text)
    total = ids.agg(F.sum("n")).first()[0] or 0
    plan = pieces(ids.select("row", "n"), max(1, math.ceil(total / group_tokens)))
    both = plan.join(ids.withColumnRenamed("n", "doc_tokens"), "row")
    piece = F.substring(F.col("ids"), (F.col("start") * width + 1).cast("int"), (F.col("length") * width).cast("int"))
    return both.select("doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "sequence_length", "step_group", piece.alias("ids")), kind


def _widen(batches: Iterator[pa.RecordBatch], kind: str, name: str, as_type: pa.DataType, made) -> Iterator[pa.RecordBatch]:
    # a worker that encoded texts has no more use for its words
    sys.modules.pop(_KEPT, None)
    pa.default_memory_pool().release_unused()
    for whole in batches:
        for i in range(0, whole.num_rows, PIECES_AT_ONCE):
            batch = whole.slice(i, PIECES_AT_ONCE)
            wide = [made(np.frombuffer(x, kind).astype("<u4").tobytes()) for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(wide, as_type)], names=[*batch.schema.names[:-1], name])


def _widened(stored: DataFrame, kind: str, name: str, as_type: pa.DataType, made) -> DataFrame:
    """``stored`` with ``made`` of each piece's ids as 32-bit integers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _widen(batches, kind, name, as_type, made)

    return stored.mapInArrow(run, f"{PIECE}, {name} {'long' if as_type == pa.int64() else 'binary'}")


COLUMNS = ("doc_tokens", "sequence_id", "offset", "sequence_length", "step_group")


def pack(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", group_tokens: int = GROUP_TOKENS) -> DataFrame:
    """One row a piece: doc_id, start, length, ids (binary, little-endian 32-bit
    integers), doc_tokens, sequence_id, offset, sequence_length, step_group."""
    wide = _widened(*_pieces_of(docs, path, doc_id, text, group_tokens), "ids", pa.binary(), bytes)
    return wide.select("doc_id", "start", "length", "ids", *COLUMNS)


def packed_digest(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``pack`` with the CRC-32 of each piece in place of its ids."""
    crc = _widened(*_pieces_of(docs, path, doc_id, text, GROUP_TOKENS), "ids_crc32", pa.int64(), zlib.crc32)
    return crc.select("doc_id", "start", "length", "ids_crc32", *COLUMNS)
