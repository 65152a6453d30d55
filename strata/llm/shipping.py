"""Makes this package importable in Python workers, and bounds what they are sent at once.

A cluster job normally ships it with `--py-files`; a session started without
that gets the package's source files added once per application.
"""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

_SHIPPED: set[str] = set()
#: Bytes of rows in one Arrow batch: a batch exists several times over, in the JVM and in the worker.
BATCH_BYTES = "8m"


def ship_package(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    name = os.path.basename(package)
    # The archive is read by the driver alone, which serves it to the workers.
    archive = os.path.join(tempfile.mkdtemp(prefix="pyfiles-"), f"{name}.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for folder, _, files in os.walk(package):
            for f in sorted(files):
                if f.endswith(".py"):
                    path = os.path.join(folder, f)
                    z.write(path, os.path.join(name, os.path.relpath(path, package)))
    spark.sparkContext.addPyFile(archive)
    _SHIPPED.add(app)
