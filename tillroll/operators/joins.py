"""Join helpers: broadcast only behind a size check."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A lookup side is broadcast only when its values take at most this many bytes;
# above it the join falls back to a shuffle join (sort-merge, with AQE's
# skew-join splitting a hot key).
MAX_BROADCAST_BYTES = 64 << 20


def row_bytes(df: DataFrame) -> F.Column:
    """About what a row takes in a hash table: 16 bytes a column and the length of its texts."""
    texts = [F.coalesce(F.octet_length(F.col(f"`{f.name}`")), F.lit(0)) for f in df.schema.fields
             if isinstance(f.dataType, (T.StringType, T.BinaryType))]
    return sum(texts, F.lit(16 * len(df.columns))).cast("long")


def table_bytes(df: DataFrame) -> int:
    """About what the table takes in a hash table (see ``row_bytes``); an action, for persisted tables."""
    return df.agg(F.sum(row_bytes(df))).first()[0] or 0


def sized_broadcast(side: DataFrame, max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """Persist a lookup table, measure it, and hint a broadcast only if small.

    The side is derived data (one row per stock code, hour, rule ...), so its
    size does not follow the fact table; measuring is a cheap action on an
    already persisted aggregate and reuses the blocks for the join itself. The
    planner's own estimate of an aggregate is its input's size, far too large.
    """
    side = side.persist()
    return F.broadcast(side) if table_bytes(side) <= max_bytes else side
