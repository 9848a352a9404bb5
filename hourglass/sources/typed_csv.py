"""Type inference for headerless CSV as one aggregate.

Every value of a position is an element of a lattice: empty, int, bigint,
double, date, timestamp, boolean, string. A position's type is the least one
that holds all its values: int and bigint and double are a chain, a date is a
timestamp, and whatever has no common type is a string. A value's element is a
bit, so a position is one ``bit_or`` over all files, whatever their order; the
whole file needs one pass, and tables inferred apart can be merged.

Lines with too few or too many fields are malformed: they don't take part in
the inference and come out as rows of NULLs with the line in ``_corrupt_record``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .interactions import COLUMNS

CORRUPT = "_corrupt_record"
#: Bits of the lattice, from the narrowest.
INT, BIGINT, DOUBLE, DATE, TIMESTAMP, BOOLEAN, STRING = (1 << i for i in range(7))
_DATE = r"^\d{4}-\d{2}-\d{2}$"
_TIMESTAMP = r"^\d{4}-\d{2}-\d{2}[ T]\d{2}:\d{2}(:\d{2}(\.\d+)?)?([zZ]|[+-]\d{2}:?\d{2})?$"
_WHOLE = r"^[+-]?\d+$"


def element(value: Column) -> Column:
    """The lattice bit of one text value; 0 for NULL and empty."""
    whole = value.rlike(_WHOLE)
    return (
        F.when(value.isNull() | (value == ""), 0)
        .when(whole & value.try_cast("int").isNotNull(), INT)
        .when(whole & value.try_cast("bigint").isNotNull(), BIGINT)
        .when(value.try_cast("double").isNotNull(), DOUBLE)
        .when(value.rlike(_DATE) & value.try_cast("date").isNotNull(), DATE)
        .when(value.rlike(_TIMESTAMP) & value.try_cast("timestamp").isNotNull(), TIMESTAMP)
        .when(F.lower(value).isin("true", "false"), BOOLEAN)
        .otherwise(STRING)
    )


def type_of(mask: int | None) -> str:
    """The least type that holds all elements of a mask; nothing is a string."""
    m = mask or 0
    for bits, name in ((INT, "int"), (INT | BIGINT, "bigint"), (INT | BIGINT | DOUBLE, "double"), (DATE, "date"), (DATE | TIMESTAMP, "timestamp"), (BOOLEAN, "boolean")):
        if m and m & ~bits == 0:
            return name
    return "string"


def read_text(spark: SparkSession, path: str, columns: tuple[str, ...] = COLUMNS) -> DataFrame:
    """All positions as text, and ``_corrupt_record`` for malformed lines. Every
    line is parsed whole, so that what counts as malformed doesn't depend on the
    columns that a query reads."""
    schema = ", ".join(f"`{c}` string" for c in (*columns, CORRUPT))
    return spark.read.schema(schema).option("header", "false").option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT).option("columnPruning", "false").csv(path)


def lattice(text: DataFrame, columns: tuple[str, ...] = COLUMNS) -> DataFrame:
    """One row: the mask of each position, and n_rows and n_corrupt."""
    good = F.col(CORRUPT).isNull()
    masks = [F.coalesce(F.bit_or(F.when(good, element(F.col(c)))), F.lit(0)).alias(c) for c in columns]
    # Spark refuses to read the corrupt column alone, so a text column stays
    corrupt = F.count_if(~good & (F.length(F.coalesce(columns[0], F.lit(""))) >= 0))
    return text.agg(*masks, F.count(F.lit(1)).alias("n_rows"), corrupt.alias("n_corrupt"))


def merge_lattices(*rows: DataFrame, columns: tuple[str, ...] = COLUMNS) -> DataFrame:
    """The lattice row of the union of several tables."""
    both = reduce(DataFrame.unionByName, rows)
    return both.agg(*[F.bit_or(c).alias(c) for c in columns], F.sum("n_rows").alias("n_rows"), F.sum("n_corrupt").alias("n_corrupt"))


def read_inferred(spark: SparkSession, path: str, columns: tuple[str, ...] = COLUMNS) -> DataFrame:
    """The headerless file with inferred types and positional names; malformed
    lines are rows of NULLs with the line in ``_corrupt_record``. One row of
    masks reaches the driver."""
    text = read_text(spark, path, columns)
    found = lattice(text, columns).first()
    good = F.col(CORRUPT).isNull()
    typed = [F.when(good, F.nullif(F.col(c), F.lit("")).cast(type_of(found[c]))).alias(c) for c in columns]
    return text.select(*typed, CORRUPT)


def schema_table(spark: SparkSession, path: str, columns: tuple[str, ...] = COLUMNS) -> DataFrame:
    """(position INT, name, type): what ``read_inferred`` decides, computed by
    Spark from the one row of masks."""
    masks = lattice(read_text(spark, path, columns), columns)
    rows = F.array(*[F.struct(F.lit(i).alias("position"), F.lit(c).alias("name"), F.col(c).alias("mask")) for i, c in enumerate(columns)])
    m = F.col("mask")
    name = F.when(m == 0, "string")
    for bits, t in ((INT, "int"), (INT | BIGINT, "bigint"), (INT | BIGINT | DOUBLE, "double"), (DATE, "date"), (DATE | TIMESTAMP, "timestamp"), (BOOLEAN, "boolean")):
        name = name.when(m.bitwiseAND(F.lit(~bits)) == 0, t)
    return masks.select(F.explode(rows).alias("r")).select("r.*").select("position", "name", name.otherwise("string").alias("type"))
