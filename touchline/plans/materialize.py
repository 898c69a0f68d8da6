"""Materialise a small intermediate that one query reads more than once.

Spark reuses a shuffle between two branches of one plan only when both
branches are identical after column pruning, which a top-1 branch (that keeps
only the key) never is. For an aggregate that is small compared to its input
- e.g. sales rolled up to (publisher, year) - writing it once with a reliable
``checkpoint()`` to the shared ``spark.checkpoint.dir`` means the large input
is scanned once, and the lineage below the checkpoint is cut, so a lost
executor re-reads the checkpoint instead of re-scanning the source.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from touchline.session import ensure_checkpoint_dir


def materialize(df: DataFrame) -> DataFrame:
    """Eagerly write ``df`` to the shared checkpoint folder and read it back."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
