"""SentencePiece encoding and decoding on a relational lattice.

Method. A text is normalized as the model says (space to U+2581, one in front)
and cut into words at places that no piece crosses. Every different word's
substrings of bounded length are exploded and equi-joined to the piece table;
the edges found are grouped by word, and a higher-order aggregate folds them
into the word's ids:

- a unigram table by Viterbi: for each end the best sum of scores;
- a BPE table by its merges: the fold's state is the set of cuts, as bits of an
  integer, and the edges, best score first, take out the cut inside them if
  they span exactly two symbols at their turn (see ``late_pieces``). (Viterbi over a BPE table's scores gives other ids
  than the model's own encoder, because scores there are merge ranks.)

Characters outside the table become the ids of their UTF-8 bytes. Decoding
joins ids to the piece table and concatenates the pieces' bytes; ``encode``
decodes every different word and compares.

Distribution. One pass reads the texts, where they stand: it cuts them into
words and writes, for blocks of about ``BLOCK_BYTES`` of text, the documents as
numbers of words and the block's words, packed by bucket (hash of the word), to
a table that is bucketed by block. Texts are not read again, and what stands
for them is not shuffled. The words' buckets of all blocks meet, so that the
lattice is built once for each different word (once for about ``CHUNK`` blocks,
so that no list of a word's places is long), and the ids go back, packed as the
words came, to the blocks, where a cogroup puts them in the numbers' places. A
block has a bound in text and in words, whatever its rows. Words longer than
``WORD`` characters don't fit the integer and are merged in the first pass, as
are words with a line end, which parts packed words. The piece table is bounded
by the model.

Cases. Null text is empty and has no ids; a text of spaces has ids. Equal rows
are encoded alike; a null id passes through. Texts of any length are encoded
whole.
"""

from __future__ import annotations

import math
import re
import uuid
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

SPACE = "▁"
#: Characters of a word in the lattice at most: its cuts are bits of a long.
WORD = 60
#: Bits of an id, and of id, length and start together, in an edge.
ID = 24
RANK = ID + 12
#: Marks an edge of a late piece, in the id's bits.
LATE = 1 << ID - 1
#: A block ends with the document that reaches one of these bounds.
MAX_WORDS = 1_000_000
BLOCK_BYTES = 32 << 20
#: Blocks whose words meet: a word's places are a list of about as many.
CHUNK = 1000
#: Buckets of words for each shuffle partition.
BUCKETS = 4
#: Bits of a word's position in its place; the rest names the block.
NUMBER = 26
#: Blocks of a task, as bits of the block's name.
TURN = 14
#: Characters below this have their ids in an array; others need an edge.
DIRECT = 0x2600
#: Fixed value: what an unknown character costs below the worst score.
UNKNOWN_PENALTY = 10.0


@dataclass
class Model:
    """Piece table of a model file."""

    pieces: list[tuple[str, int, float]]
    byte_ids: list[int]
    unigram: bool
    prefix: bool
    alone: str = ""
    longest: int = field(default=1)

    @property
    def worst(self) -> float:
        return min(s for _, _, s in self.pieces) - UNKNOWN_PENALTY


def load(path: str) -> Model:
    """Read a model file. Only models with byte fallback, without a character
    map and without white space removal are taken."""
    from sentencepiece import sentencepiece_model_pb2 as pb

    m = pb.ModelProto()
    with open(path, "rb") as f:
        m.ParseFromString(f.read())
    n, t = m.normalizer_spec, m.trainer_spec
    if n.precompiled_charsmap or n.remove_extra_whitespaces or not n.escape_whitespaces or not t.byte_fallback or t.model_type not in (1, 2):
        raise ValueError("the model needs a normalizer or a kind that isn't supported")
    pieces = [(p.piece, i, p.score) for i, p in enumerate(m.pieces) if p.type in (1, 4)]
    if any(SPACE in p.lstrip(SPACE) for p, _, _ in pieces):
        raise ValueError("pieces cross words")
    if len(m.pieces) >= LATE:
        raise ValueError("the table is too large for an edge's integer")
    number = {p.piece: i for i, p in enumerate(m.pieces) if p.type == 6}
    byte_ids = [number[f"<0x{b:02X}>"] for b in range(256)]
    held = set("".join(p for p, _, _ in pieces))
    alone = "".join(c for c in "\n\t" if c not in held)
    return Model(pieces, byte_ids, t.model_type == 1, n.add_dummy_prefix, alone, max(len(p) for p, _, _ in pieces))


def word_pattern(model: Model) -> bytes:
    """A word, with spaces for U+2581: a run of spaces and what follows up to the
    next; characters that stand in no piece and may end a line are words of
    their own."""
    if not model.alone:
        return b" *[^ ]+| +"
    alone = "".join({"\n": "\\n", "\t": "\\t"}[c] for c in model.alone).encode()
    return b" *[^ " + alone + b"]+| +|[" + alone + b"]"


def _ranks(model: Model) -> list[float]:
    """The table's scores, best first, each once; a rank is a place in it."""
    return sorted({s for _, _, s in model.pieces}, reverse=True)


def piece_table(spark: SparkSession, model: Model) -> DataFrame:
    """Rows (piece, code): rank of the score and id in one integer."""
    rank = {s: r for r, s in enumerate(_ranks(model))}
    late = set() if model.unigram else set(late_pieces(model))
    return spark.createDataFrame([(p, rank[s] << RANK | i | (LATE if i in late else 0)) for p, i, s in model.pieces], "piece string, code long")


def _array(values: list, kind: str) -> Column:
    """A constant array, from one string."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast(f"array<{kind}>")


def lattice(words: DataFrame, model: Model) -> DataFrame:
    """Rows (bucket, word, places, n, edges, late) of rows (bucket, word,
    places): the edges of each word as integers, from the top rank, start,
    length and id; so they sort by score, then leftmost. Rows that were dealt by
    bucket are not shuffled again: they are numbered, and the edges of a number
    stand together. Merging needs no edge of one character, where its id is in
    an array."""
    least = F.lit(1) if model.unigram else F.when(F.col("word").rlike(f"[^\\u0000-\\u{DIRECT - 1:04x}]"), 1).otherwise(2)
    w = words.where(F.length("word").between(1, WORD))
    w = w.select(F.monotonically_increasing_id().alias("row"), "bucket", "word", "places", F.length("word").alias("n"), least.alias("least"))
    subs = w.select("*", F.explode(F.sequence(F.lit(0), F.greatest(F.lit(0), F.col("n") - F.col("least")))).alias("s"))
    subs = subs.select("*", F.explode(F.sequence("least", F.greatest("least", F.least(F.lit(model.longest), F.col("n") - F.col("s"))))).alias("l"))
    piece = F.when(F.col("s") + F.col("l") <= F.col("n"), F.substring("word", F.col("s") + 1, F.col("l")))
    first = (F.col("s") == 0) & (F.col("l") == F.col("least"))
    subs = subs.select("row", "bucket", "word", "s", "l", piece.alias("piece"), first.alias("first"), F.when(first, F.col("places")).alias("places"))
    hit = subs.join(F.broadcast(piece_table(words.sparkSession, model)), "piece", "left")
    # a word's first substring brings its places, with an edge or without
    hit = hit.where(F.col("code").isNotNull() | F.col("first"))
    edge = F.col("code").bitwiseOR(F.shiftleft((F.col("s") * 64 + F.col("l")).cast("long"), ID))
    out = hit.groupBy("row", "bucket", "word").agg(F.sort_array(F.collect_list(edge)).alias("edges"), F.first("places", ignorenulls=True).alias("places"), F.bit_or("code").alias("marks"))
    late = F.coalesce(F.col("marks"), F.lit(0)).bitwiseAND(F.lit(LATE)) != 0
    return out.select("bucket", "word", "places", F.length("word").alias("n"), "edges", late.alias("late"))


def _id(edge: Column) -> Column:
    return edge.bitwiseAND(F.lit(LATE - 1)).cast("int")


def _place(edge: Column) -> Column:
    """64 * start + length."""
    return F.shiftright(edge, ID).bitwiseAND(F.lit(4095)).cast("int")


def _start(edge: Column) -> Column:
    return F.shiftright(edge, ID + 6).bitwiseAND(F.lit(63)).cast("int")


def _length(edge: Column) -> Column:
    return F.shiftright(edge, ID).bitwiseAND(F.lit(63)).cast("int")


def _bit(at: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), at)


def late_pieces(model: Model) -> list[int]:
    """Ids of the pieces that merging by score doesn't make from two symbols
    with better-scored merges alone. Cuts at a piece's ends seclude what
    happens between them, so every other piece is due at its own turn, and one
    pass over a word's edges, best first, makes the same merges as choosing
    the best one again after each merge."""
    score = {p: s for p, _, s in model.pieces}
    late = []
    for piece, number, own in model.pieces:
        parts = list(piece)
        while len(parts) > 2:
            best, at = max((score.get(parts[i] + parts[i + 1], -math.inf), -i) for i in range(len(parts) - 1))
            if best <= own:
                late.append(number)
                break
            parts[-at:2 - at] = [parts[-at] + parts[1 - at]]
    return late


def _merged(model: Model) -> Column:
    """Cuts that are left when no merge applies, as bits. A pass over the moves
    (edges of two characters or more, as bits of the cuts at and between their
    ends) takes out the cut inside each that spans two symbols at its turn. A
    word with a late piece is searched for its best move after each merge."""
    def move(e: Column) -> Column:
        a, z = _start(e), _start(e) + _length(e)
        return F.struct(_bit(a).bitwiseOR(_bit(z)).alias("ends"), (_bit(z) - _bit(a + 1)).alias("inner"))

    def fits(cuts: Column, e: Column) -> Column:
        return (F.bit_count(cuts.bitwiseAND(e["inner"])) == 1) & (cuts.bitwiseAND(e["ends"]) == e["ends"])

    def without(cuts: Column, e: Column) -> Column:
        return cuts.bitwiseAND(F.bitwise_not(e["inner"]))

    every = _bit(F.col("n") + 1) - F.lit(1).cast("long")
    moves = F.transform(F.filter("edges", lambda e: _length(e) > 1), move)
    once = F.aggregate(moves, every, lambda cuts, e: F.when(fits(cuts, e), without(cuts, e)).otherwise(cuts))
    if not late_pieces(model):
        return once

    def step(state: Column, _: Column) -> Column:
        first = F.get(F.filter(state["moves"], lambda e: fits(state["cuts"], e)), F.lit(0))
        return F.struct(F.coalesce(without(state["cuts"], first), state["cuts"]).alias("cuts"), state["moves"].alias("moves"))

    start = F.struct(every.alias("cuts"), moves.alias("moves"))
    again = F.aggregate(F.sequence(F.lit(1), F.greatest(F.lit(1), F.col("n") - 1)), start, step)["cuts"]
    return F.when(F.col("late"), again).otherwise(once)


def _viterbi(model: Model) -> Column:
    """Cuts of the best path, as bits. State: for each end the best sum and the
    cuts of its path; a single character without an edge costs ``worst``."""
    worst = F.lit(model.worst)
    scores = _array([repr(r) for r in _ranks(model)], "double")

    def step(best: Column, end: Column) -> Column:
        into = F.filter("edges", lambda e: _start(e) + _length(e) == end)

        def path(e: Column) -> Column:
            before = F.get(best, _start(e))
            total = before["sum"] + F.get(scores, F.shiftright(e, RANK).cast("int"))
            return F.struct(total.alias("sum"), before["cuts"].bitwiseOR(_bit(end)).alias("cuts"))

        paths = F.transform(into, path)
        last = F.get(best, end - 1)
        alone = F.struct((last["sum"] + worst).alias("sum"), last["cuts"].bitwiseOR(_bit(end)).alias("cuts"))
        single = F.exists(into, lambda e: _length(e) == 1)
        return F.concat(best, F.array(F.array_max(F.when(single, paths).otherwise(F.concat(paths, F.array(alone))))))

    start = F.array(F.struct(F.lit(0.0).alias("sum"), F.lit(1).cast("long").alias("cuts")))
    return F.element_at(F.aggregate(F.sequence(F.lit(1), F.col("n")), start, step), -1)["cuts"]


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is worked out once: a column that stands in
    a lambda may be merged into it and be worked out for each element."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _bytes(model: Model) -> dict[int, bytes]:
    """What each id stands for in the text."""
    return {i: p.replace(SPACE, " ").encode() for p, i, _ in model.pieces} | {i: bytes([b]) for b, i in enumerate(model.byte_ids)}


def word_ids(words: DataFrame, model: Model) -> DataFrame:
    """Rows (bucket, places, ids, same) of rows (bucket, word, places) of at
    most ``WORD`` characters; ``same``: the ids decode to the word."""
    cuts = _viterbi(model) if model.unigram else _merged(model)
    at = _let(cuts, lambda c: F.filter(F.sequence(F.lit(0), F.col("n")), lambda i: F.getbit(c, i) == 1))
    byte_ids = F.array(*[F.lit(i) for i in model.byte_ids])
    alone = {ord(p): i for p, i, _ in model.pieces if len(p) == 1}
    direct = _array([alone.get(c, -1) for c in range(DIRECT)], "int")
    stands = _bytes(model)
    spelled = _array([stands.get(i, b"").hex().upper() for i in range(max(stands) + 1)], "string")

    def ids(keys: Column, s: Column, z: Column) -> Column:
        text = F.substr("word", s + 1, z - s)
        one = F.when(z - s == 1, F.get(direct, F.ascii(text)))
        place = F.array_position(keys, s * 64 + z - s).cast("int")
        code = F.hex(F.encode(text, "utf-8"))
        fallback = F.transform(F.sequence(F.lit(1), F.length(code), F.lit(2)), lambda k: F.get(byte_ids, F.conv(F.substr(code, k, F.lit(2)), 16, 10).cast("int")))
        return F.when(one >= 0, F.array(one)).when(place > 0, F.array(_id(F.get("edges", place - 1)))).otherwise(fallback)

    def parts(b: Column) -> Column:
        ends = F.slice(b["at"], 2, F.greatest(F.lit(0), F.size(b["at"]) - 1))
        return F.flatten(F.transform(ends, lambda z, j: ids(b["keys"], F.get(b["at"], j), z)))

    def decoded(i: Column) -> Column:
        back = F.array_join(F.transform(i, lambda x: F.get(spelled, x)), "")
        return F.struct(i.alias("ids"), (back == F.hex(F.encode(F.replace("word", F.lit(SPACE), F.lit(" ")), "utf-8"))).alias("same"))

    both = F.struct(at.alias("at"), F.transform("edges", _place).alias("keys"))
    done = lattice(words, model).select("bucket", "places", _let(_let(both, parts), decoded).alias("d"))
    return done.select("bucket", "places", "d.ids", "d.same")


def long_word(word: str, model: Model, table: dict[str, tuple[int, float]]) -> list[int]:
    """Ids of one word beyond the lattice's length, by the same rules."""
    if model.unigram:
        best: list[tuple[float, int]] = [(0.0, 0)]
        for z in range(1, len(word) + 1):
            paths = [(best[a][0] + table[word[a:z]][1], a) for a in range(max(0, z - model.longest), z) if word[a:z] in table]
            if word[z - 1:z] not in table:
                paths.append((best[z - 1][0] + model.worst, z - 1))
            best.append(max(paths))
        cuts, z = [], len(word)
        while z:
            cuts.append((best[z][1], z))
            z = best[z][1]
        parts = [word[a:z] for a, z in reversed(cuts)]
    else:
        import heapq

        right = list(range(1, len(word) + 1))
        left = list(range(-1, len(word) - 1))
        size = [1] * len(word)
        heap: list[tuple[float, int, int]] = []

        def offer(a: int) -> None:
            b = right[a]
            if a >= 0 and b < len(word) and (p := word[a:b + size[b]]) in table:
                heapq.heappush(heap, (-table[p][1], a, len(p)))

        for a in range(len(word)):
            offer(a)
        while heap:
            _, a, n = heapq.heappop(heap)
            if not size[a] or right[a] >= len(word) or size[a] + size[right[a]] != n:
                continue
            b = right[a]
            size[a], size[b], right[a] = n, 0, right[b]
            if right[a] < len(word):
                left[right[a]] = a
            offer(a)
            if left[a] >= 0:
                offer(left[a])
        parts = [word[a:a + n] for a, n in enumerate(size) if n]
    return [i for p in parts for i in ([table[p][0]] if p in table else [model.byte_ids[b] for b in p.encode()])]


def decode(encoded: DataFrame, model: Model, key: str = "key", ids: str = "ids") -> DataFrame:
    """Rows (key, text) of rows (key, ids): ids joined to their pieces."""
    pieces = encoded.sparkSession.createDataFrame(list(_bytes(model).items()), "id int, bytes binary")
    each = encoded.select(F.col(key).alias("key"), F.posexplode(ids).alias("at", "id")).join(F.broadcast(pieces), "id")
    parts = each.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("at", F.hex("bytes").alias("b")))).alias("parts"))
    data = F.unhex(F.array_join(F.transform("parts", lambda p: p["b"]), ""))
    text = F.decode(data, "utf-8")
    out = encoded.select(F.col(key).alias("key")).join(parts.select("key", text.alias("text")), "key", "left")
    text = F.coalesce("text", F.lit(""))
    return out.select("key", F.when(F.startswith(text, F.lit(" ")), F.substr(text, F.lit(2))).otherwise(text).alias("text") if model.prefix else text.alias("text"))


class _Numbers(dict):
    """Words by number, in the order they are met."""

    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self)
        return n


#: Rows of the first pass, by block: some documents (ids, numbers of words in
#: all and whether words make up the text, the words' numbers); the words of a
#: bucket; the numbers of all buckets' words, in order; the ids of a long word.
FIRST_PASS = ("block long, keys array<long>, counts array<int>, whole array<boolean>, numbers binary, "
              "bucket int, words string, sequence binary, long int, ids array<int>, same boolean")
FIRST_TYPES = pa.schema([
    ("block", pa.int64()), ("keys", pa.list_(pa.int64())), ("counts", pa.list_(pa.int32())), ("whole", pa.list_(pa.bool_())), ("numbers", pa.binary()),
    ("bucket", pa.int32()), ("words", pa.string()), ("sequence", pa.binary()), ("long", pa.int32()), ("ids", pa.list_(pa.int32())), ("same", pa.bool_())])


def _row(**columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([columns.get(f.name)], f.type) for f in FIRST_TYPES], schema=FIRST_TYPES)


def _packed(values: np.ndarray) -> bytes:
    """32-bit values, their bytes by rank, compressed."""
    return pa.compress(values.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes(), codec="zstd", asbytes=True)


def _unpacked(data: bytes, n: int) -> np.ndarray:
    flat = np.frombuffer(pa.decompress(data, decompressed_size=4 * n, codec="zstd"), np.uint8)
    return flat.reshape(4, -1).T.copy().view("<u4").ravel()


def _numbering(model: Model, max_words: int, block_bytes: int, buckets: int):
    """The first pass, over rows (doc_id, text)."""
    pattern = word_pattern(model)

    def words_of(block: int, numbers: _Numbers) -> Iterator[pa.RecordBatch]:
        words = list(numbers)
        bucket = np.array([zlib.crc32(w) % buckets if (len(w) <= WORD or len(w.decode()) <= WORD) and b"\n" not in w else -1 for w in words], np.int64)
        turn = np.argsort(bucket, kind="stable")
        long, turn = turn[:np.sum(bucket < 0)], turn[np.sum(bucket < 0):]
        yield _row(block=block, sequence=_packed(np.diff(turn, prepend=0) & 0xFFFFFFFF))
        for part in np.split(turn, np.flatnonzero(np.diff(bucket[turn])) + 1):
            if len(part):
                yield _row(block=block, bucket=int(bucket[part[0]]), words=b"\n".join([words[i] for i in part.tolist()]).decode())
        if len(long):
            stands, table = _bytes(model), {p: (i, s) for p, i, s in model.pieces}
            for n in long.tolist():
                ids = long_word(words[n].decode().replace(" ", SPACE), model, table)
                same = b"".join(map(stands.__getitem__, ids)) == words[n]
                yield _row(block=block, long=n, ids=ids, same=same)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        find, space = re.compile(pattern).findall, SPACE.encode()
        block = TaskContext.get().partitionId() << TURN
        last = block + (1 << TURN) - 1
        numbers, size = _Numbers(), 0
        keys, codes, whole, held = [], [], [], 0

        def documents() -> pa.RecordBatch:
            row = _row(block=block, keys=keys[:], counts=[len(c) for c in codes], whole=whole[:], numbers=_packed(np.concatenate(codes)))
            keys.clear(), codes.clear(), whole.clear()
            return row

        for b in batches:
            for i in range(0, b.num_rows, 256):
                part = b.slice(i, 256)
                for key, t in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    t = t or b""
                    s = (b" " if model.prefix and t else b"") + t.replace(space, b" ")
                    found = find(s)
                    codes.append(np.fromiter(map(numbers.__getitem__, found), np.uint32, len(found)))
                    keys.append(key)
                    whole.append(sum(map(len, found)) == len(s))
                    held += 4 * len(found) + 64
                    size += len(t) + 64
                    full = size >= block_bytes or len(numbers) >= max_words
                    if full or held >= 4 << 20:
                        yield documents()
                        held = 0
                    if full:
                        yield from words_of(block, numbers)
                        numbers, size, block = _Numbers(), 0, block + 1
                        if block > last:
                            raise ValueError("a task has too many blocks: more partitions or larger blocks are needed")
        if keys:
            yield documents()
        yield from words_of(block, numbers)

    return run


def _meeting(name: str, kind: pa.DataType, value: Callable[[bytes], object]):
    """Puts a block's ids in the places of its documents' numbers."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), (name, kind), ("decoded_ok", pa.bool_())])

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        own = left.filter(pc.is_valid(left.column("long")))
        size_of, ids_of = [own.column("ids").combine_chunks().value_lengths().to_numpy()], [own.column("ids").combine_chunks().flatten().to_numpy()]
        number_of, same_of = [own.column("long").to_numpy()], [own.column("same").to_numpy()]
        places = pc.sum(pc.list_value_length(right.column("sizes"))).as_py() or 0
        sequence = next(x for x in left.column("sequence").to_pylist() if x is not None)
        number_of.append(np.cumsum(_unpacked(sequence, places), dtype=np.uint32))
        for b in sorted(right.to_batches(max_chunksize=1), key=lambda b: b.column("bucket")[0].as_py()):
            sizes = b.column("sizes").flatten().to_numpy()
            size_of.append(np.abs(sizes))
            same_of.append(sizes >= 0)
            ids_of.append(b.column("ids").flatten().to_numpy())
        number, sizes, flat = np.concatenate(number_of), np.concatenate(size_of).astype(np.int64), np.concatenate(ids_of).astype("<i4")
        start, size, same = (np.zeros(len(number), t) for t in (np.int64, np.int64, bool))
        start[number], size[number], same[number] = np.cumsum(sizes) - sizes, sizes, np.concatenate(same_of).astype(bool)
        out = []
        docs = left.filter(pc.is_valid(left.column("numbers")))
        for row in docs.to_batches(max_chunksize=1):
            counts = row.column("counts").flatten().to_numpy()
            at = _unpacked(row.column("numbers")[0].as_py(), int(counts.sum()))
            n = size[at]
            ends = np.cumsum(n)
            ids = flat[np.repeat(start[at] - ends + n, n) + np.arange(n.sum())]
            stop = np.r_[0, np.cumsum(counts)]
            bound = np.r_[0, ends][stop]
            bad = np.r_[0, np.cumsum(~same[at])][stop]
            whole = row.column("whole").flatten().to_numpy(zero_copy_only=False).astype(bool)
            out.append(pa.RecordBatch.from_arrays([
                row.column("keys").flatten(), pa.array(np.diff(bound), pa.int64()), pa.array([value(ids[a:z].tobytes()) for a, z in zip(bound, bound[1:])], kind),
                pa.array((np.diff(bad) == 0) & whole)], schema=schema))
        return pa.Table.from_batches(out, schema)

    return run


def _by_block(rows: DataFrame, buckets: int) -> DataFrame:
    """``rows`` as a table in the shared folder that is bucketed by block. A
    task's blocks are its own, so nothing is dealt out before the write."""
    name = f"sentencepiece_{uuid.uuid4().hex}"
    path = scratch_path(rows.sparkSession, "tables", name)
    rows.write.bucketBy(buckets, "block").option("path", path).format("parquet").saveAsTable(name)
    return rows.sparkSession.table(name)


def _encoded(docs: DataFrame, path: str, doc_id: str, text: str, max_words: int, block_bytes: int, name: str, kind: str, arrow: pa.DataType, value: Callable[[bytes], object]) -> DataFrame:
    spark, model = docs.sparkSession, load(path)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.make_valid_utf8(F.col(text).cast("string")).cast("binary").alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, math.ceil(size / block_bytes))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # small partitions are read together, so that a block meets its words once
    first = rows.coalesce(blocks).mapInArrow(_numbering(model, max_words, block_bytes, parts * BUCKETS), FIRST_PASS)
    first = _by_block(first, parts)
    # a word becomes some fifty substrings: the partitions must not be merged by their size
    words = first.where("words is not null").select("bucket", "block", "words").repartition(parts, "bucket")
    words = words.select("bucket", "block", F.posexplode(F.split("words", "\n")).alias("pos", "word"))
    words = words.select("bucket", "word", F.shiftleft("block", NUMBER).bitwiseOR(F.col("pos").cast("long")).alias("place"))
    by = ["word", "bucket"]
    if blocks > CHUNK:
        by, words = [*by, "chunk"], words.withColumn("chunk", F.pmod(F.xxhash64(F.shiftright("place", NUMBER)), F.lit(math.ceil(blocks / CHUNK))).cast("int"))
    words = words.groupBy(*by).agg(F.collect_list("place").alias("places"))
    words = words.withColumn("word", F.replace("word", F.lit(" "), F.lit(SPACE)))
    ids = word_ids(words, model).select("bucket", F.explode("places").alias("place"), "ids", "same")
    each = F.struct(F.col("place").bitwiseAND(F.lit((1 << NUMBER) - 1)).cast("int").alias("pos"), "ids", "same")
    back = ids.select("bucket", F.shiftright("place", NUMBER).alias("at"), each.alias("one")).groupBy("bucket", "at").agg(F.collect_list("one").alias("all"))
    narrow = "array<smallint>" if max(_bytes(model)) < 1 << 15 else "array<int>"
    back = back.select("at", "bucket", F.sort_array("all").alias("all"))
    sizes = F.transform("all", lambda x: F.when(x["same"], F.size(x["ids"])).otherwise(-F.size(x["ids"])).cast("smallint"))
    back = back.select("at", "bucket", sizes.alias("sizes"), F.flatten("all.ids").cast(narrow).alias("ids"))
    own = first.where("words is null").drop("bucket", "words")
    out = f"doc_id long, n_tokens long, {name} {kind}, decoded_ok boolean"
    return own.groupBy("block").cogroup(back.groupBy("at")).applyInArrow(_meeting(name, arrow, value), out)


def encode(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", max_words: int = MAX_WORDS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row a document: doc_id, n_tokens, ids (little-endian 32-bit
    integers), decoded_ok (decoding the ids gives the text again)."""
    return _encoded(docs, path, doc_id, text, max_words, block_bytes, "ids", "binary", pa.binary(), bytes)


def digest(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``encode`` with the CRC-32 of the ids in place of them."""
    return _encoded(docs, path, doc_id, text, MAX_WORDS, BLOCK_BYTES, "ids_crc32", "long", pa.int64(), zlib.crc32)
