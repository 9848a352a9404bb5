"""Interaction tables: one row per (user, game, behaviour, value) record."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

COLUMNS = ("user_id", "game", "behavior", "value")

# Explicit schema for the headerless four-column file. Ids are read as BIGINT so
# that id spaces beyond 2^31 load unchanged; the index dictionaries map them to
# the dense INT ids ALS needs.
INTERACTIONS = T.StructType(
    [
        T.StructField("user_id", T.LongType(), True),
        T.StructField("game", T.StringType(), True),
        T.StructField("behavior", T.StringType(), True),
        T.StructField("value", T.DoubleType(), True),
    ]
)


def read_interactions(
    spark: SparkSession,
    path: str,
    fmt: str = "csv",
    infer: bool = False,
    mode: str = "PERMISSIVE",
    schema: T.StructType = INTERACTIONS,
) -> DataFrame:
    """Read an interaction table.

    ``fmt="csv"`` reads a headerless file. With ``infer=False`` (default) the
    explicit schema is used, so no inference job runs and malformed fields
    become NULL (``mode="PERMISSIVE"``) or fail the read (``"FAILFAST"``).
    ``infer=True`` reproduces type inference with positional renaming.
    ``fmt="parquet"`` selects the four columns by name, so the scan reads
    only those.
    """
    if fmt == "csv":
        reader = spark.read.option("header", "false").option("mode", mode)
        if infer:
            return reader.option("inferSchema", "true").csv(path).toDF(*COLUMNS)
        return reader.schema(schema).csv(path)
    if fmt == "parquet":
        return spark.read.parquet(path).select(*COLUMNS)
    raise ValueError(f"unsupported format {fmt!r}")


def write_interactions_csv(df: DataFrame, path: str) -> None:
    """Write the four columns as a headerless CSV folder (one file per task)."""
    df.select(*COLUMNS).write.mode("overwrite").option("header", "false").csv(path)


def convert_to_parquet(
    spark: SparkSession,
    csv_path: str,
    parquet_path: str,
    infer: bool = False,
    mode: str = "PERMISSIVE",
    partition_by: tuple[str, ...] = (),
) -> DataFrame:
    """Read the headerless CSV once and store it as Parquet.

    CSV scans row by row; Parquet scans in vectorised batches, prunes columns
    and skips row groups by the pushed filters. ``partition_by=("behavior",)``
    additionally lets a behaviour filter prune whole folders.
    Returns the Parquet table.
    """
    df = read_interactions(spark, csv_path, fmt="csv", infer=infer, mode=mode)
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(parquet_path)
    return spark.read.parquet(parquet_path).select(*COLUMNS)


def preview(df: DataFrame, n: int = 20) -> DataFrame:
    """The first ``n`` rows as a DataFrame (the reference prints them)."""
    return df.limit(n)


def as_interactions(df: DataFrame) -> DataFrame:
    """Cast a frame with the four named columns to the interaction schema."""
    return df.select(
        F.col("user_id").cast("bigint").alias("user_id"),
        F.col("game").cast("string").alias("game"),
        F.col("behavior").cast("string").alias("behavior"),
        F.col("value").cast("double").alias("value"),
    )
