"""Makes this package importable in tasks."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

import perigee

_shipped: set[str] = set()


def ship_code(spark: SparkSession) -> None:
    """Send the package to the executors, once per application, as submitting with --py-files would.

    Functions that run in tasks refer to it by name. The driver serves the archive to executors, also to
    those that join later; nobody else has to see the file.
    """
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = Path(perigee.__file__).parent
    with tempfile.NamedTemporaryFile(prefix="perigee-", suffix=".zip", delete=False) as file:
        with zipfile.ZipFile(file, "w") as archive:
            for path in sorted(root.rglob("*.py")):
                archive.write(path, Path("perigee") / path.relative_to(root))
    context.addPyFile(file.name)
    _shipped.add(context.applicationId)
