"""Broadcasts by counted size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bytes up to which a written dimension is sent to every executor.
MOST_BYTES = 64 << 20


def counted_bytes(df: DataFrame) -> int:
    """Bytes of the values of all rows: what strings hold, and 16 for every other column."""
    width = F.lit(16 * len(df.columns)).cast("long")
    for f in df.schema:
        if isinstance(f.dataType, T.StringType):
            width = width + F.coalesce(F.octet_length(F.col(f.name)), F.lit(0))
    return df.agg(F.sum(width)).first()[0] or 0


def broadcast_if_small(df: DataFrame, most_bytes: int = MOST_BYTES) -> DataFrame:
    """A written table with the hint to broadcast it, if its counted size allows that; the table itself beyond.

    The other side of a join is then neither shuffled nor sorted. Beyond the
    limit a join shuffles both sides, and AQE splits what is skewed.
    """
    return F.broadcast(df) if counted_bytes(df) <= most_bytes else df
