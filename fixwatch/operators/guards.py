"""Size checks and lineage cuts used where a plan depends on how large a side is."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fixwatch.session import ensure_checkpoint_dir

# A few columns of this many rows stay far below the executor's broadcast memory.
BROADCAST_ROWS = 500_000


def at_most(df: DataFrame, limit: int) -> bool:
    """True when `df` has no more than `limit` rows; reads at most limit + 1 of them."""
    return df.limit(limit + 1).count() <= limit


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast only after counting; a larger side keeps the shuffle join
    (with adaptive skew splitting)."""
    return F.broadcast(df) if at_most(df, limit) else df


# A task that holds or parses this many rows stays far below its memory and time.
ROWS_PER_TASK = 250_000
# For rows that become some 5 kB wide.
WIDE_ROWS_PER_TASK = 50_000


def deal(df: DataFrame, *keys: str, n_rows: int | None = None, per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Rows with equal keys in one task, tasks in proportion to the rows, so that what a task
    holds does not grow with the table. For keys of a few rows each, where combining before
    the shuffle would hold nearly every row. `n_rows` saves the count."""
    rows = df.count() if n_rows is None else n_rows
    tasks = max(df.sparkSession.sparkContext.defaultParallelism, -(-rows // per_task))
    return df.repartition(tasks, *keys)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write `df` to the reliable checkpoint folder so later passes survive executor
    loss without recomputing what lies before it."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def require_columns(df: DataFrame, expected: list[str], what: str) -> None:
    missing = sorted(set(expected) - set(df.columns))
    if missing:
        raise ValueError(f"{what} lacks columns {missing}")
