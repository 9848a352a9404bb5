"""Exact distinct counts from bitmaps over dictionary ids.

``count(DISTINCT a), count(DISTINCT b)`` makes a copy of every row for each
counted column and shuffles every value. Dictionary ids are dense, so a set of
them is a bitmap: 32,768 ids a bucket, one bit each. Map tasks build their own
bitmaps, so what is shuffled is bounded by the ids and not by the rows. The
bitmaps of two days, files or behaviours are merged by OR, which a stored count
can't be: counts over any union come from the bitmaps alone.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .indexing import build_dictionaries, encode


def distinct_bitmaps(rows: DataFrame, col: str, keys: tuple[str, ...] = (), kind: str | None = None) -> DataFrame:
    """(keys..., kind, bucket, bits): the ids of ``col`` that each key has; NULL
    ids have no bit."""
    some = rows.where(F.col(col).isNotNull()).select(*keys, F.bitmap_bucket_number(F.col(col)).alias("bucket"), F.bitmap_bit_position(F.col(col)).alias("bit"))
    bits = some.groupBy(*keys, "bucket").agg(F.bitmap_construct_agg("bit").alias("bits"))
    return bits.select(*keys, F.lit(kind or col).alias("kind"), "bucket", "bits")


def merge_bitmaps(*frames: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """The union of bitmap tables, with the ids of all of them per ``keys``;
    keys left out are merged away."""
    cols = [*keys, "kind", "bucket"]
    both = reduce(DataFrame.unionByName, [f.select(*cols, "bits") for f in frames])
    return both.groupBy(*cols).agg(F.bitmap_or_agg("bits").alias("bits"))


def bitmap_counts(bitmaps: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """(keys..., kind, n): how many ids the bitmaps hold."""
    return bitmaps.groupBy(*keys, "kind").agg(F.sum(F.bitmap_count("bits")).alias("n"))


def interaction_bitmaps(df: DataFrame, keys: tuple[str, ...] = ("behavior",), cols: dict[str, str] | None = None) -> DataFrame:
    """Bitmaps of the users and games of an interaction table, per behaviour."""
    cols = cols or {"user": "user_id", "item": "game"}
    dicts = build_dictionaries(df, cols)
    return reduce(DataFrame.unionByName, [
        distinct_bitmaps(encode(df.select(*keys, c), dicts[kind], c, kind), kind, keys) for kind, c in cols.items()])


def cardinalities_by(df: DataFrame, by: str = "behavior", cols: dict[str, str] | None = None) -> DataFrame:
    """(by, n_rows, n_<kind>...): rows and distinct non-NULL ids of each value of
    ``by`` (NULL is a value)."""
    cols = cols or {"user": "user_id", "item": "game"}
    counts = bitmap_counts(interaction_bitmaps(df, (by,), cols), (by,))
    wide = counts.groupBy(by).agg(*[F.max(F.when(F.col("kind") == k, F.col("n"))).alias(f"n_{k}") for k in cols])
    rows = df.groupBy(by).agg(F.count(F.lit(1)).alias("n_rows"))
    wide = wide.withColumnRenamed(by, "_by")
    both = rows.join(wide, F.col(by).eqNullSafe(F.col("_by")), "left")
    return both.select(by, "n_rows", *[F.coalesce(f"n_{k}", F.lit(0)).cast("long").alias(f"n_{k}") for k in cols])
