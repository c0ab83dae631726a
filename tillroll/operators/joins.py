"""Join helpers: broadcast only behind a size check."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.session import ensure_checkpoint_dir

# Upper bound on rows shipped to every executor. Dimension rows here are
# a few dozen bytes, so this stays well under the default 8 GB broadcast cap.
MAX_BROADCAST_ROWS = 2_000_000


def checked_broadcast(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS,
                      materialize: bool = True) -> DataFrame:
    """Broadcast ``df`` only when it has at most ``max_rows`` rows.

    The side is first checkpointed to the shared checkpoint folder (so the
    size check and the join read the same rows and the lineage is cut),
    then counted up to ``max_rows + 1``. Above the bound the plain
    DataFrame is returned and the planner / AQE choose a shuffle join.
    """
    if materialize:
        ensure_checkpoint_dir(df.sparkSession)
        df = df.checkpoint(eager=True)
    n = df.limit(max_rows + 1).count()
    return F.broadcast(df) if n <= max_rows else df
