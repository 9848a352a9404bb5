"""Document fingerprints: Merkle trees over pieces, paragraphs and sections.

Method. A text's lines are its paragraphs. A paragraph is cut into pieces: a
piece ends with a word whose first code point plus length is a multiple of
``PIECE``, or with the paragraph, so that cuts follow the words and not their
place. A section ends with a paragraph whose hash begins with 0 to 3, or with
the text. A piece's hash is the MD5 of its text, that of a paragraph or
section the MD5 of its children's, and the root the SHA-256 of the sections'.
The parts hold every character, so equal roots mean equal texts. A fingerprint
is written ``root/section=paragraph.pieces,...;...`` with the first eight digits
of each hash below the root.

``likeness`` of two fingerprints is the share of pieces that they have in common,
repeats counted: 2 * common / all. ``edit`` goes down from the roots: from both
ends it skips equal sections, then equal paragraphs, and names the paragraphs
that are left.

Distribution. DataFrame functions only. A document's successor is found on keys
(id, MD5 of the text) alone: they are dealt by ranges, and each range looks
within itself and to the next range's head. Then each document gives what its
predecessor needs (its first characters and its pieces' hashes) and the texts,
which are shuffled once, meet it by key. No text is sorted over the whole
table, and no range of ids is gathered.

Cases. Null text is empty: one empty piece. Documents are ordered by id, then
MD5 of the text, null ids first. Rows equal in id and text are one document:
each has the same successor. A lone document is its own successor. Other
columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import NULL_ID, written

PIECE = 4
TREE = "struct<root:string,sections:array<struct<hash:string,paragraphs:array<struct<hash:string,pieces:array<string>>>>>>"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value worked out once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _short(h: Column) -> Column:
    return F.substring(h, 1, 8)


def _grouped(items: Column, last: Callable[[Column], Column], each: Callable[[Column], Column]) -> Column:
    """``each`` over the stretches of ``items`` that end where ``last`` holds."""

    def cut(x: Column) -> Column:
        ends = F.filter(F.sequence(F.lit(1), F.size(x)), lambda i: (i == F.size(x)) | last(F.get(x, i - 1)))
        start = lambda e, k: F.when(k == 0, F.lit(1)).otherwise(F.get(e, k - 1) + 1)
        return _let(ends, lambda e: F.transform(e, lambda z, k: each(F.slice(x, start(e, k), z - start(e, k) + 1))))

    return _let(items, cut)


def _pieces(paragraph: Column) -> Column:
    """MD5 of each piece of a paragraph."""
    last = lambda w: F.pmod(F.ascii(w) + F.length(w), F.lit(PIECE)) == 0
    return _grouped(F.split(paragraph, " "), last, lambda words: F.md5(F.array_join(words, " ").cast("binary")))


def _joined(hashes: Column) -> Column:
    return F.array_join(hashes, "").cast("binary")


def pieces(text: Column) -> Column:
    """Short hashes of all pieces of a text, in order."""
    each = F.transform(F.split(text, "\n"), lambda p: F.transform(_pieces(p), _short))
    return F.flatten(each)


def tree(text: Column) -> Column:
    """The tree of a text, as ``TREE``. Hashes below the root are short."""
    paragraph = lambda p: _let(_pieces(p), lambda h: F.struct(F.md5(_joined(h)).alias("hash"), F.transform(h, _short).alias("pieces")))
    short = lambda p: F.struct(_short(p["hash"]).alias("hash"), p["pieces"].alias("pieces"))
    section = lambda ps: F.struct(F.md5(_joined(F.transform(ps, lambda p: p["hash"]))).alias("hash"), F.transform(ps, short).alias("paragraphs"))
    sections = _grouped(F.transform(F.split(text, "\n"), paragraph), lambda p: F.substring(p["hash"], 1, 1) < "4", section)
    return _let(sections, lambda s: F.struct(
        F.sha2(_joined(F.transform(s, lambda x: x["hash"])), 256).alias("root"),
        F.transform(s, lambda x: F.struct(_short(x["hash"]).alias("hash"), x["paragraphs"].alias("paragraphs"))).alias("sections")))


def fingerprint(t: Column) -> Column:
    """A tree written down."""
    paragraph = lambda p: F.concat(p["hash"], F.lit("."), F.array_join(p["pieces"], ""))
    section = lambda s: F.concat(s["hash"], F.lit("="), F.array_join(F.transform(s["paragraphs"], paragraph), ","))
    return F.concat(t["root"], F.lit("/"), F.array_join(F.transform(t["sections"], section), ";"))


def leaves(t: Column) -> Column:
    """Short hashes of all pieces of a tree."""
    return F.flatten(F.transform(t["sections"], lambda s: F.flatten(F.transform(s["paragraphs"], lambda p: p["pieces"]))))


def likeness(a: Column, b: Column) -> Column:
    """Share of common pieces of two lists of hashes, repeats counted."""
    # in sorted order, each hash of b takes one of the same hashes of a
    tagged = F.array_sort(F.concat(F.transform(a, lambda x: F.concat(x, F.lit("a"))), F.transform(b, lambda x: F.concat(x, F.lit("b")))))
    zero = F.struct(F.lit("").alias("h"), F.lit(0).alias("free"), F.lit(0).alias("common"))

    def step(s: Column, x: Column) -> Column:
        h, of_a = F.substring(x, 1, 8), F.substring(x, 9, 1) == "a"
        free = F.when(s["h"] == h, s["free"]).otherwise(F.lit(0))
        return F.struct(h.alias("h"), F.when(of_a, free + 1).otherwise(F.greatest(free - 1, F.lit(0))).alias("free"), (s["common"] + F.when(~of_a & (free > 0), 1).otherwise(0)).alias("common"))

    common = F.when(F.arrays_overlap(a, b), F.aggregate(tagged, zero, step, lambda s: s["common"])).otherwise(F.lit(0))
    return F.lit(2.0) * common / (F.size(a) + F.size(b))


def edit(a: Column, b: Column) -> Column:
    """Where tree b differs from tree a: struct (first, end, first_b, end_b) of
    paragraph numbers from 0, ends exclusive; null for equal roots."""
    flat = lambda s: F.flatten(F.transform(s, lambda x: F.transform(x["paragraphs"], lambda p: p["hash"])))

    def heads(x: Column, y: Column) -> Column:
        """How many entries at the head of two lists are equal."""
        n = F.least(F.size(x), F.size(y))
        differ = F.array_position(F.zip_with(F.slice(x, 1, n), F.slice(y, 1, n), lambda p, q: p == q), F.lit(False))
        return F.when(differ > 0, differ - 1).otherwise(n).cast("int")

    hashes = lambda s: F.transform(s, lambda x: x["hash"])
    # whole sections first, then paragraphs of those that differ
    skip = heads(hashes(a["sections"]), hashes(b["sections"]))
    rest = lambda t, k: F.slice(t["sections"], k + 1, F.size(t["sections"]))
    before = lambda t, k: F.size(flat(F.slice(t["sections"], 1, k)))
    found = _let(F.struct(a.alias("a"), b.alias("b"), skip.alias("k")), lambda s: _let(
        F.struct(flat(rest(s["a"], s["k"])).alias("x"), flat(rest(s["b"], s["k"])).alias("y"), before(s["a"], s["k"]).alias("n")), lambda r: _let(
            F.struct(r["x"].alias("x"), r["y"].alias("y"), r["n"].alias("n"), heads(r["x"], r["y"]).alias("head")), lambda u: _let(
                heads(F.reverse(F.slice(u["x"], u["head"] + 1, F.size(u["x"]))), F.reverse(F.slice(u["y"], u["head"] + 1, F.size(u["y"])))), lambda tail: F.struct(
                    (u["n"] + u["head"]).alias("first"), (u["n"] + F.size(u["x"]) - tail).alias("end"),
                    (u["n"] + u["head"]).alias("first_b"), (u["n"] + F.size(u["y"]) - tail).alias("end_b"))))))
    return F.when(a["root"] != b["root"], found)


def successors(keys: DataFrame) -> DataFrame:
    """Rows (id, tag, n, next) from a table of different (id, tag, n): the key
    that follows in order, after the last the first."""
    spark = keys.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = written(keys.repartitionByRange(parts, "id", "tag").withColumn("p", F.spark_partition_id()), "merkle-ranges")
    inside = ranged.withColumn("next", F.lead(F.struct("id", "tag")).over(Window.partitionBy("p").orderBy("id", "tag")))
    # one row a range: its own head and that of the range after it
    heads = ranged.groupBy("p").agg(F.min(F.struct("id", "tag")).alias("head"))
    after, whole = Window.orderBy("p"), Window.orderBy("p").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    heads = heads.select("p", F.coalesce(F.lead("head").over(after), F.first("head").over(whole)).alias("then"))
    return inside.join(F.broadcast(heads), "p").select("id", "tag", "n", F.coalesce("next", "then").alias("next"))


def with_successor(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", give: Callable[[Column, Column], list[Column]] | None = None) -> DataFrame:
    """Rows (id, text, n) with what ``give(text, n)`` makes of the text of the
    next document and the own number of characters."""
    rows = docs.select(F.coalesce(F.col(doc_id).cast("long"), F.lit(NULL_ID)).alias("id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    rows = rows.select("id", F.md5(F.col("text").cast("binary")).alias("tag"), "text")
    keys = written(rows.groupBy("id", "tag").agg(F.first(F.length("text")).alias("n"), F.count(F.lit(1)).alias("copies")), "merkle-keys")
    again = not keys.where("copies > 1").isEmpty()
    asked = successors(keys.select("id", "tag", "n")).select(F.col("id").alias("to_id"), F.col("tag").alias("to_tag"), "n", F.col("next.id").alias("id"), F.col("next.tag").alias("tag"))
    givers = rows.dropDuplicates(["id", "tag"]) if again else rows
    given = givers.join(asked, ["id", "tag"]).select(F.col("to_id").alias("id"), F.col("to_tag").alias("tag"), "n", *give(F.col("text"), F.col("n")))
    return rows.join(given, ["id", "tag"])


def edited_fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", part: int = 4) -> DataFrame:
    """Each document beside an edited text of its own, whose last 1 / ``part``
    of the characters are the first ones of the next document. Rows (doc_id,
    n_chars, edited, tree, edited_tree, near_edited, near_next, edit)."""
    share = lambda n: F.floor(n / part).cast("int")
    # a list of short hashes travels as bytes
    give = lambda t, n: [F.substring(t, F.lit(1), share(n)).alias("head"), F.unhex(F.array_join(pieces(t), "")).alias("theirs")]
    both = with_successor(docs, doc_id, text, give)
    both = both.select("id", "n", F.concat(F.substring("text", F.lit(1), F.col("n") - share(F.col("n"))), "head").alias("edited"), "theirs", tree(F.col("text")).alias("tree"))
    both = both.withColumn("edited_tree", tree(F.col("edited")))
    both = both.withColumns({"own": leaves(F.col("tree")), "new": leaves(F.col("edited_tree")), "next": F.regexp_extract_all(F.lower(F.hex("theirs")), F.lit(".{8}"), F.lit(0))})
    return both.select(
        F.nullif("id", F.lit(NULL_ID)).alias("doc_id"), F.col("n").cast("long").alias("n_chars"), "edited", "tree", "edited_tree",
        likeness(F.col("own"), F.col("new")).alias("near_edited"), likeness(F.col("own"), F.col("next")).alias("near_next"), edit(F.col("tree"), F.col("edited_tree")).alias("edit"))
