"""Sending this package, and rows by bounded batches, to the executors' Python workers."""

from __future__ import annotations

import os
import shutil
import tempfile

from pyspark.sql import SparkSession

from orderwell.sources.tables import at_most

_SENT: set[str] = set()

#: What a Python worker is handed at a time.  Spark's own bound is 10,000 rows, whatever
#: is in them, and a batch lies in the executor and in the worker, in pieces of its own too.
BATCH_BYTES = 4 << 20


def ship(spark: SparkSession) -> None:
    """Adds the package to the application's Python files, once, and bounds the batches
    of the session, which are made when a frame is run; a smaller bound holds.

    Needed where the executors do not have it installed; the driver serves the
    archive, so its folder need not be shared.
    """
    batches = "spark.sql.execution.arrow.maxBytesPerBatch"
    spark.conf.set(batches, at_most(spark, spark.conf.get(batches, None), BATCH_BYTES))
    context = spark.sparkContext
    if context.applicationId in _SENT:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    root, name = os.path.split(package)
    archive = os.path.join(tempfile.mkdtemp(prefix=f"{name}-"), name)
    context.addPyFile(shutil.make_archive(archive, "zip", root, name))
    _SENT.add(context.applicationId)
