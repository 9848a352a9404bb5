"""Run log: one row per trained configuration, appended to a Parquet table.

This replaces the reference's external tracking service: parameters and
metrics of every run are columns of a table that any Spark job can read. An
append shows whole or not at all (``sources.committed``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

RUNS = T.StructType(
    [
        T.StructField("run_name", T.StringType(), False),
        T.StructField("model", T.StringType(), False),
        T.StructField("rank", T.IntegerType(), True),
        T.StructField("regParam", T.DoubleType(), True),
        T.StructField("maxIter", T.IntegerType(), True),
        T.StructField("alpha", T.DoubleType(), True),
        T.StructField("implicit", T.BooleanType(), True),
        T.StructField("nonnegative", T.BooleanType(), True),
        T.StructField("num_blocks", T.IntegerType(), True),
        T.StructField("checkpoint_interval", T.IntegerType(), True),
        T.StructField("seed", T.LongType(), True),
        T.StructField("split", T.StringType(), True),
        T.StructField("data_id", T.StringType(), True),
        T.StructField("n_test", T.LongType(), True),
        T.StructField("n_scored", T.LongType(), True),
        T.StructField("coverage", T.DoubleType(), True),
        T.StructField("rmse", T.DoubleType(), True),
        T.StructField("rmse_preference", T.DoubleType(), True),
        T.StructField("n_users", T.LongType(), True),
        T.StructField("precision_at_10", T.DoubleType(), True),
        T.StructField("recall_at_10", T.DoubleType(), True),
        T.StructField("map_at_10", T.DoubleType(), True),
        T.StructField("fit_seconds", T.DoubleType(), True),
        T.StructField("certified", T.BooleanType(), True),
    ]
)

RUN_COLUMNS = tuple(f.name for f in RUNS.fields)


def runs_frame(spark: SparkSession, rows: list[dict]) -> DataFrame:
    """A runs DataFrame from a list of run records (missing fields are NULL)."""
    return spark.createDataFrame([tuple(r.get(c) for c in RUN_COLUMNS) for r in rows], RUNS)


def append_runs(runs: DataFrame, path: str) -> None:
    """Append run rows to the log at ``path``: all of them or none, also beside
    other fits and drivers that append at the same time."""
    from .committed import append_committed

    append_committed(runs, path)


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """The rows of all committed appends; none for a log that isn't there."""
    from .committed import read_committed

    return read_committed(spark, path)
