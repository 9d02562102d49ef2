"""Makes this package importable in Python workers."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parent


def ship(spark: SparkSession) -> None:
    """Once per context, unless PYTHONPATH has the package already: the driver serves its sources to the executors."""
    sc = spark.sparkContext
    on_path = str(ROOT.parent) in map(os.path.abspath, filter(None, os.environ.get("PYTHONPATH", "").split(os.pathsep)))
    if on_path or getattr(sc, "_linkloom_shipped", False):
        return
    archive = Path(tempfile.mkdtemp()).resolve() / "linkloom-src.zip"  # read by the driver's own file server only
    with zipfile.ZipFile(archive, "w") as z:
        for f in sorted(ROOT.rglob("*.py")):
            z.write(f, f.relative_to(ROOT.parent))
    sc.addPyFile(str(archive))
    sc._linkloom_shipped = True
