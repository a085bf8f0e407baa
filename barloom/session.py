"""Session defaults and shipping of this package's code to executors."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str = "local[8]", app: str = "barloom", **conf: str) -> SparkSession:
    """A local session with the engine's defaults; ``conf`` uses ``__`` for dots."""
    builder = SparkSession.builder.master(master).appName(app)
    for key, value in {**DEFAULTS, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_shipped: set[str] = set()


def ship_code(spark: SparkSession, root: str) -> None:
    """Sends the package to the executors once per application, as one zip."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    path = os.path.join(tempfile.mkdtemp(prefix="barloom-"), "barloom-code.zip")
    with zipfile.ZipFile(path, "w") as out:
        for folder, _, names in os.walk(os.path.join(root, "barloom")):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    out.write(full, os.path.relpath(full, root))
        pipeline = os.path.join(root, "corpus_pipeline.py")
        if os.path.exists(pipeline):
            out.write(pipeline, "corpus_pipeline.py")
    context.addPyFile(path)
    _shipped.add(context.applicationId)
