"""Column expressions shared by the operators. All are built-in Spark SQL
functions and stay in the JVM; the higher-order ones (``dot``) are interpreted,
not part of whole-stage codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HASH_SPACE = 10_000

# Output formats that must equal the reference's.
#   run name     ALS_r<rank>_reg<regParam>_iter<maxIter>   e.g. ALS_r10_reg0.01_iter20
#   hours label  <hours with thousands separators, no decimals> hrs   e.g. 11,754 hrs
RUN_NAME_FORMAT = "ALS_r%d_reg%s_iter%d"
HOURS_SUFFIX = " hrs"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def hash_bucket(*cols, seed: int | str = 42, space: int = HASH_SPACE) -> Column:
    """Deterministic bucket in ``[0, space)`` from the md5 of ``c1|c2|...|seed``.

    Uses the first 8 hex digits of the digest, so the value is the same in any
    engine with md5 and does not depend on partitioning or row order.
    """
    text = F.concat_ws("|", *[_c(c).cast("string") for c in cols], F.lit(str(seed)))
    return (F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint") % F.lit(space)).cast("int")


def hours_label(c) -> Column:
    """``1,234 hrs``: thousands separators, no decimals (half-even). Six places
    are kept first, so the order in which a sum was taken doesn't show."""
    return F.concat(F.format_number(F.round(_c(c), 6), 0), F.lit(HOURS_SUFFIX))


def run_name(rank, reg_param, max_iter) -> Column:
    """``ALS_r<rank>_reg<regParam>_iter<maxIter>``."""
    return F.format_string(RUN_NAME_FORMAT, _c(rank), _c(reg_param).cast("string"), _c(max_iter))


def dot(a, b) -> Column:
    """Dot product of two numeric arrays, accumulated in double precision."""
    return F.aggregate(
        F.zip_with(_c(a), _c(b), lambda x, y: x.cast("double") * y.cast("double")),
        F.lit(0.0).cast("double"),
        lambda acc, v: acc + v,
    )


def as_label(c) -> Column:
    """Dictionary labels are text, whatever the source type of the id."""
    return _c(c).cast("string")


__all__ = ["HASH_SPACE", "as_label", "dot", "hash_bucket", "hours_label", "run_name"]
