"""The package on the Python workers."""

from __future__ import annotations

import shutil
import tempfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Hand this package to the Python workers (once a Spark application), as
    ``--py-files`` would; Spark itself carries the archive to the executors."""
    sc = spark.sparkContext
    if sc.applicationId not in _shipped:
        root = Path(__file__).resolve().parents[1]
        with tempfile.TemporaryDirectory() as tmp:
            for f in root.rglob("*.py"):
                to = Path(tmp, "src", root.name, f.relative_to(root))
                to.parent.mkdir(parents=True, exist_ok=True)
                shutil.copy(f, to)
            sc.addPyFile(shutil.make_archive(str(Path(tempfile.mkdtemp(), "touchline_package")), "zip", Path(tmp, "src")))
        _shipped.add(sc.applicationId)
