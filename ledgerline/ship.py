"""Make the package importable in Python workers."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the workers, once per application.

    Needed when the session was not started with the package installed or in
    ``spark.submit.pyFiles``.
    """
    application = spark.sparkContext.applicationId
    if application in _SHIPPED:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="ledgerline-"), "ledgerline.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.join("ledgerline", os.path.relpath(path, root)))
    context = spark.sparkContext
    context.addPyFile(archive)
    # Stream processors also start a Python worker beside the driver, which
    # looks at the path variable only.
    known = context.environment.get("PYTHONPATH", os.environ.get("PYTHONPATH", ""))
    context.environment["PYTHONPATH"] = os.pathsep.join(p for p in (os.path.dirname(root), known) if p)
    _SHIPPED.add(application)
