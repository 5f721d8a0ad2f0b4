"""Making the package available to Python workers."""

from __future__ import annotations

import os
import shutil
import tempfile

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def ship(spark: SparkSession) -> SparkSession:
    """Send this package to the executors once per application.

    Not needed where it is installed on every node; harmless there.
    """
    sc = spark.sparkContext
    if sc.applicationId not in _shipped:
        package = os.path.dirname(os.path.abspath(__file__))
        base = os.path.join(tempfile.mkdtemp(prefix="strata-ship-"), "strata")
        sc.addPyFile(shutil.make_archive(base, "zip", os.path.dirname(package), os.path.basename(package)))
        _shipped.add(sc.applicationId)
    return spark
