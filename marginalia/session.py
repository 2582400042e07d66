"""A session with the settings the operators assume."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def session(name: str = "marginalia", **more: str) -> SparkSession:
    """The running session or a new one; keyword settings use ``_`` for ``.``."""
    return SparkSession.builder.appName(name).config(map=SETTINGS | {k.replace("_", "."): v for k, v in more.items()}).getOrCreate()


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the executors this package, once an application: they needn't have it installed or share a folder with it."""
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        _shipped.add(context.applicationId)
        package = Path(__file__).resolve().parent
        at = os.path.join(tempfile.mkdtemp(prefix="marginalia-"), f"{package.name}.zip")
        with zipfile.ZipFile(at, "w") as z:
            for f in sorted(package.rglob("*.py")):
                z.write(f, f.relative_to(package.parent))
        context.addPyFile(at)
