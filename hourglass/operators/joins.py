"""Join helpers: broadcast only behind a size check."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Rows a dimension may have and still be shipped to every executor. A
# dictionary row is (label, idx, n): ~50-100 bytes, so 2M rows stay well under
# the tens of MB a broadcast should cost. Beyond it the join shuffles on its
# key (sort-merge), with AQE splitting a skewed hot key.
BROADCAST_MAX_ROWS = 2_000_000
# ... and at most this many bytes (labels can be long titles).
BROADCAST_MAX_BYTES = 64 * 1024 * 1024
# Per-row overhead of a broadcast hash relation entry beyond the label text
# (row header, id and count fields, hash slot).
ROW_OVERHEAD_BYTES = 48


def sized_broadcast(
    df: DataFrame,
    n_rows: int | None,
    max_rows: int = BROADCAST_MAX_ROWS,
    n_bytes: int | None = None,
    max_bytes: int = BROADCAST_MAX_BYTES,
) -> DataFrame:
    """``broadcast(df)`` if its known size is within ``max_rows`` rows and,
    when known, ``max_bytes`` bytes.

    Sizes must come from counts the caller already has (a dictionary records
    its row count and label bytes when it is built); unknown sizes are never
    broadcast by hand and are left to AQE, which can still switch to a
    broadcast join from runtime statistics.
    """
    if n_rows is None or n_rows > max_rows:
        return df
    if n_bytes is not None and n_bytes + n_rows * ROW_OVERHEAD_BYTES > max_bytes:
        return df
    return F.broadcast(df)
