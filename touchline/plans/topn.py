"""Top-n patterns that stay bounded when one group is huge.

``top_n_per_group`` filters ``row_number() <= n`` over a partitioned window.
Spark plans that as ``WindowGroupLimit`` twice: a partial limit *before* the
shuffle (each map task forwards at most ``n`` rows per group) and a final one
after it, so a group holding a third of all rows never reaches one task whole.

``top_k`` is ``orderBy(...).limit(k)``, planned as ``TakeOrderedAndProject``:
every partition keeps its own k best rows and only those are merged.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _cols(items: Sequence[ColumnOrName]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in items]


def top_n_per_group(
    df: DataFrame,
    group: Sequence[ColumnOrName],
    order: Sequence[ColumnOrName],
    n: int,
    rank_col: str | None = None,
) -> DataFrame:
    """Keep the first ``n`` rows of each group under ``order``.

    ``order`` must end in a unique key for a deterministic answer. The rank is
    kept as ``rank_col`` (an int) or dropped when ``rank_col`` is None.
    """
    name = rank_col or "__rank"
    window = Window.partitionBy(*_cols(group)).orderBy(*_cols(order))
    ranked = df.withColumn(name, F.row_number().over(window)).filter(F.col(name) <= n)
    return ranked if rank_col else ranked.drop(name)


def top_k(df: DataFrame, order: Sequence[ColumnOrName], k: int) -> DataFrame:
    """The first ``k`` rows under ``order`` (ties must be broken inside ``order``)."""
    return df.orderBy(*_cols(order)).limit(k)


def rank_within(
    df: DataFrame, group: Sequence[ColumnOrName], order: Sequence[ColumnOrName], rank_col: str
) -> DataFrame:
    """Add a 1-based position column within each group (no rows dropped)."""
    window = Window.partitionBy(*_cols(group)).orderBy(*_cols(order))
    return df.withColumn(rank_col, F.row_number().over(window))
