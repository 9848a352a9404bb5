"""Line dedup by site-relative frequency.

Method. Rows are grouped by host. A line that holds a word is boilerplate of
its host when it stands on at least the share ``ratio`` of the host's pages, and
on two pages (``min_pages``), so that a host of one page stays whole; every
occurrence on that host is dropped.

Distribution. Only DataFrame functions. Each page contributes a line once; the
pairs (host, hash of line) are counted with partial sums, so a host with a
third of all pages is never in one task. A host has at most (its mean number
of different lines a page) / ``ratio`` boilerplate lines, which are written as
a table. If that table is small by count, and no host's list is long, it is
broadcast, and text isn't shuffled; otherwise the line hashes are joined to it
by (host, hash) and only a page's own drop list returns to it.

Cases. Null text has no line and stays null; empty text stays empty. Lines
without a word are never dropped. A null host is a host of its own. Repeated
rows count as pages of their own. A text whose lines are all dropped becomes
the empty text; the row stays. Columns other than the text (and ``n_chars``,
if asked for) pass through, whatever their names; ``drop_lines`` replaces those
named like a column that it adds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, written

RATIO = 0.1
MIN_PAGES = 2
#: The longest drop list of a host that each of its lines is looked up in.
LONGEST = 1000
WORD = "[^\\x20\\x09-\\x0D]"


def _hashes(text: Column) -> Column:
    """Hash of each different line that holds a word."""
    lines = F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: x.rlike(WORD))
    return F.array_distinct(F.transform(lines, lambda x: F.xxhash64(x)))


def boilerplate(docs: DataFrame, text: str = "text", host: str = "source", ratio: float = RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """Rows (host, h, pages, share): the lines to drop on each host."""
    rows = docs.select(F.col(host).alias("host"), F.col(text).alias("text"))
    totals = rows.groupBy("host").agg(F.count(F.lit(1)).alias("total"))
    counts = rows.select("host", F.explode(_hashes(F.col("text"))).alias("h")).groupBy("host", "h").agg(F.count(F.lit(1)).alias("pages")).where(F.col("pages") >= min_pages)
    t = totals.withColumnRenamed("host", "_host")
    both = counts.join(t, F.col("host").eqNullSafe(F.col("_host")))
    return both.where(F.col("pages") >= F.col("total") * F.lit(ratio)).select("host", "h", "pages", (F.col("pages") / F.col("total")).alias("share"))


def _without(docs: DataFrame, text: str, host: str, ratio: float, min_pages: int, broadcast_rows: int) -> DataFrame:
    """Rows (row, lines, left): the whole row of ``docs``, its lines and those
    that stay, both null for null text."""
    drops = written(boilerplate(docs, text, host, ratio, min_pages).select("host", "h"), "boilerplate-lines")
    rows = docs.select(F.struct("*").alias("row"), F.col(host).alias("host"), F.col(text).alias("text"))
    lists = drops.groupBy("host").agg(F.count(F.lit(1)).alias("n"))
    if drops.limit(broadcast_rows + 1).count() <= broadcast_rows and (lists.agg(F.max("n")).first()[0] or 0) <= LONGEST:
        sets = drops.groupBy(F.col("host").alias("its")).agg(F.collect_list("h").alias("drop"))
        df = rows.join(F.broadcast(sets), F.col("host").eqNullSafe(F.col("its")), "left")
    else:
        # rows equal in host and text lose the same lines
        rows = rows.withColumn("tag", F.sha2(F.coalesce(F.col("text"), F.lit("")).cast("binary"), 256))
        lines = rows.select("host", "tag", F.explode(_hashes(F.col("text"))).alias("h")).distinct()
        d = drops.withColumnsRenamed({"host": "its", "h": "its_h"})
        hit = lines.join(d, F.col("host").eqNullSafe(F.col("its")) & (F.col("h") == F.col("its_h")))
        sets = hit.groupBy(F.col("host").alias("of"), F.col("tag").alias("of_tag")).agg(F.collect_list("h").alias("drop"))
        df = rows.join(sets, F.col("host").eqNullSafe(F.col("of")) & (F.col("tag") == F.col("of_tag")), "left")
    drop = F.coalesce("drop", F.array().cast("array<bigint>"))
    df = df.select("row", F.split("text", "\n").alias("lines"), drop.alias("drop"))
    left = F.filter("lines", lambda x: ~(x.rlike(WORD) & F.array_contains(F.col("drop"), F.xxhash64(x))))
    return df.select("row", "lines", F.when(F.size("drop") > 0, left).otherwise(F.col("lines")).alias("left"))


def _new(text: str):
    return F.when(F.size("left") < F.size("lines"), F.array_join("left", "\n")).otherwise(F.col("row")[text])


def drop_lines(docs: DataFrame, text: str = "text", host: str = "source", ratio: float = RATIO, min_pages: int = MIN_PAGES,
               broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """``docs`` without boilerplate lines; adds ``n_lines`` and ``n_dropped``."""
    df = _without(docs, text, host, ratio, min_pages, broadcast_rows)
    n = lambda c: F.coalesce(c, F.lit(0)).cast("long")
    columns = [_new(c).alias(c) if c == text else F.col("row")[c].alias(c) for c in docs.columns if c not in ("n_lines", "n_dropped")]
    return df.select(*columns, n(F.size("lines")).alias("n_lines"), n(F.size("lines") - F.size("left")).alias("n_dropped"))


def strip_documents(docs: DataFrame, text: str = "text", host: str = "source", ratio: float = RATIO, min_pages: int = MIN_PAGES,
                    broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """The pipeline's form: the columns of ``docs`` and nothing else; ``n_chars``,
    if there is one, follows a text that changed."""
    df = _without(docs, text, host, ratio, min_pages, broadcast_rows)

    def column(c: str):
        if c == text:
            return _new(c).alias(c)
        if c == "n_chars":
            length = F.length(F.array_join("left", "\n"))
            return F.when(F.size("left") < F.size("lines"), length).otherwise(F.col("row")[c]).cast(docs.schema[c].dataType).alias(c)
        return F.col("row")[c].alias(c)

    return df.select(*[column(c) for c in docs.columns])
