"""Broadcast only what is proven small.

A dimension built from the data (regions, a model table) has no size bound by
construction. ``small_side`` materialises it once in the reliable checkpoint
folder, measures it there (rows and bytes), and hints a broadcast only under both
limits; above them the frame is returned as it is and the planner uses a shuffle join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

# Above either, a side is joined by shuffle instead of broadcast.
BROADCAST_ROW_LIMIT = 200_000
BROADCAST_BYTES = 32_000_000


def small_side(df: DataFrame, max_rows: int = BROADCAST_ROW_LIMIT, materialised: bool = False) -> DataFrame:
    """Return ``df`` with a broadcast hint if it has at most ``max_rows`` rows and
    ``BROADCAST_BYTES`` bytes (as text, which is at least about the size in memory).

    ``materialised=True`` says ``df`` already reads stored data (a written table or
    a checkpoint), so counting it is cheap and it is not checkpointed again.
    """
    if not materialised:
        ensure_checkpoint_dir(df.sparkSession)
        df = df.checkpoint(eager=True)
    size = F.octet_length(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}))
    n, size = df.limit(max_rows + 1).select(size.alias("b")).agg(F.count(F.lit(1)), F.coalesce(F.sum("b"), F.lit(0))).first()
    return F.broadcast(df) if n <= max_rows and size <= BROADCAST_BYTES else df
