"""Index dictionaries: label ↔ dense INT id, built and applied distributed.

Order rule (same as ``StringIndexer(stringOrderType="frequencyDesc")``): most
frequent label first, ties by label text, ids from 0.

``StringIndexer`` collects every label to the driver and ships the array to
each task. For user ids at scale that array grows with the data, so the
dictionary here is a DataFrame:

1. ``groupBy(label).count()`` – partial aggregation, so a hot label is
   combined map-side before the shuffle.
2. ``repartitionByRange`` on ``(count desc, label)`` + sort within
   partitions – a total order spread over many tasks (a skewed count value
   is split by label, not piled into one window partition).
3. ``monotonically_increasing_id`` gives (partition, position); the rows are
   written once as Parquet in the shared folder, so the ids cannot shift on
   recomputation and later reads are columnar scans.
4. Per-partition sizes (one number per partition) → prefix offsets → a
   literal array indexed by partition, so the dictionary is a narrow
   projection of the checkpointed rows: no join or window on each use.

Applying it is a join: broadcast when the dictionary's known size is small,
sort-merge otherwise (AQE splits a hot key's partition).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import default_parallelism, stable_table
from .joins import BROADCAST_MAX_BYTES, BROADCAST_MAX_ROWS, sized_broadcast

INT_MAX = 2**31 - 1
_POS_BITS = 33  # monotonically_increasing_id = partition << 33 | row in partition


@dataclass(frozen=True)
class Dictionary:
    """``table``: (label STRING, idx INT, n BIGINT); ``size``: number of
    labels; ``label_bytes``: total UTF-8 bytes of the labels (for the
    broadcast size check)."""

    table: DataFrame
    size: int
    name: str = "label"
    label_bytes: int | None = None

    def labels(self) -> DataFrame:
        return self.table


def _shuffle_partitions(spark) -> int:
    try:
        return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    except (TypeError, ValueError):  # a non-numeric setting: use the cluster's cores
        return default_parallelism(spark)


def build_dictionaries(df: DataFrame, cols: dict[str, str], partitions: int | None = None) -> dict[str, Dictionary]:
    """Dictionaries for several columns from ONE scan of ``df``.

    ``cols`` maps a dictionary name to its column. Each row contributes one
    (kind, label) entry per column; a single partial + final aggregate counts
    them, one range shuffle orders them by (kind, count desc, label), and one
    Parquet write fixes every label's position. The per-(kind, partition) sizes –
    bounded by kinds × partitions, not by the data – become the id offsets.
    """
    spark = df.sparkSession
    entries = F.array(
        *[F.struct(F.lit(kind).alias("kind"), F.col(c).cast("string").alias("label")) for kind, c in cols.items()]
    )
    counts = (
        df.select(F.explode(entries).alias("e"))
        .select("e.kind", "e.label")
        .where(F.col("label").isNotNull())
        .groupBy("kind", "label")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    n_parts = partitions or _shuffle_partitions(spark)
    order = (F.col("kind").asc(), F.col("n").desc(), F.col("label").asc())
    ordered = counts.repartitionByRange(n_parts, *order).sortWithinPartitions(*order)
    # Materialise once: the (partition, position) of every label is stored in
    # ``_mid``, so the ids no longer depend on how the rows are read back.
    tagged = stable_table(
        ordered.select("kind", "label", "n", F.monotonically_increasing_id().alias("_mid")), "dictionary", ("kind",)
    )
    tagged = tagged.select(
        "kind",
        "label",
        "n",
        F.shiftright("_mid", _POS_BITS).alias("_part"),
        F.col("_mid").bitwiseAND(F.lit((1 << _POS_BITS) - 1)).alias("_pos"),
    )
    # rows of each (kind, partition): kinds × partitions rows, not data
    sizes = stable_table(
        tagged.groupBy("kind", "_part").agg(F.count(F.lit(1)).alias("c"), F.sum(F.octet_length("label")).alias("b")), "dictionary-sizes"
    )
    totals = {r["kind"]: r for r in sizes.groupBy("kind").agg(F.sum("c").alias("c"), F.sum("b").alias("b")).collect()}
    # Rows are kind-major, so within a partition the kinds appear in sorted
    # order; id = (this kind's rows in earlier partitions) + (position in the
    # partition) - (rows of smaller kinds earlier in the same partition).
    earlier = F.coalesce(F.sum("c").over(Window.partitionBy("kind").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    smaller = F.coalesce(F.sum("c").over(Window.partitionBy("_part").orderBy("kind").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = sizes.select("kind", "_part", (earlier - smaller).alias("_base"))
    out = {}
    for kind in cols:
        size = int(totals[kind]["c"]) if kind in totals else 0
        if size > INT_MAX:
            raise ValueError(f"{size} distinct {kind} labels exceed the INT id range ALS requires")
        # at most one row per partition, so the broadcast is bounded by n_parts
        base = F.broadcast(offsets.where(F.col("kind") == F.lit(kind)).select("_part", "_base"))
        idx = (F.col("_base") + F.col("_pos")).cast("int")
        table = tagged.where(F.col("kind") == F.lit(kind)).join(base, "_part").select("label", idx.alias("idx"), F.col("n").cast("bigint").alias("n"))
        out[kind] = Dictionary(table=table, size=size, name=kind, label_bytes=int(totals[kind]["b"] or 0) if kind in totals else 0)
    return out


def build_dictionary(df: DataFrame, col: str, name: str | None = None, partitions: int | None = None) -> Dictionary:
    """Dictionary of the non-NULL values of ``col`` (cast to text)."""
    kind = name or col
    return build_dictionaries(df, {kind: col}, partitions)[kind]


def encode(
    df: DataFrame,
    dictionary: Dictionary,
    col: str,
    out: str,
    max_broadcast_rows: int = BROADCAST_MAX_ROWS,
    max_broadcast_bytes: int = BROADCAST_MAX_BYTES,
) -> DataFrame:
    """Add the INT id of ``col`` as ``out``; rows with NULL or unknown labels
    are dropped (``handleInvalid="skip"``)."""
    key = f"__{out}_label"
    d = dictionary.table.select(F.col("label").alias(key), F.col("idx").alias(out))
    d = sized_broadcast(d, dictionary.size, max_broadcast_rows, dictionary.label_bytes, max_broadcast_bytes)
    return df.join(d, F.col(col).cast("string") == F.col(key), "inner").drop(key)


def decode(
    df: DataFrame,
    dictionary: Dictionary,
    col: str,
    out: str,
    how: str = "left",
    max_broadcast_rows: int = BROADCAST_MAX_ROWS,
) -> DataFrame:
    """Add the label of INT id ``col`` as ``out``."""
    key = f"__{out}_idx"
    d = dictionary.table.select(F.col("idx").alias(key), F.col("label").alias(out))
    d = sized_broadcast(d, dictionary.size, max_broadcast_rows, dictionary.label_bytes)
    return df.join(d, F.col(col) == F.col(key), how).drop(key)


def lookup_index(dictionary: Dictionary, label: str) -> DataFrame:
    """One-row frame with the id of ``label`` (empty when unknown)."""
    return dictionary.table.where(F.col("label") == F.lit(label)).select("idx")
