"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import stable_table

#: Rows a table may have at most to be broadcast after it was counted.
BROADCAST_ROWS = 200_000

#: Stands for a null integer id inside an operator: it sorts before every other.
NULL_ID = -(2**63)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet in the shared folder and read back, so that
    a lost executor costs a re-read and not a recomputation."""
    return stable_table(df, name)


def checkpointed(df: DataFrame) -> DataFrame:
    return df.checkpoint(eager=True)


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` (a materialised table) marked for broadcast if it has at most
    ``rows`` rows; unchanged otherwise, and the join shuffles."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def word_split(text: Column) -> Column:
    """Maximal runs without ASCII white space; null text has none."""
    parts = F.split(F.coalesce(text, F.lit("")), "[\\x20\\x09-\\x0D]+")
    return F.filter(parts, lambda w: w != "")

