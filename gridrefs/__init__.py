"""PySpark jobs for collections of gridded array files."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path


def on_workers(spark) -> None:
    """Ship this package to the Python workers of a session, once for each Spark context."""
    context, here = spark.sparkContext, Path(__file__).resolve().parent
    if getattr(context, "_gridrefs_shipped", False):
        return
    path = f"{tempfile.mkdtemp(prefix='gridrefs-')}/gridrefs.zip"  # Spark's file server sends it from here
    with zipfile.ZipFile(path, "w") as z:
        for source in sorted(here.rglob("*.py")):
            z.write(source, source.relative_to(here.parent))
    context.addPyFile(path)
    context._gridrefs_shipped = True
