"""Makes the package importable on executors."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

#: Rows of an Arrow batch, where the session has Spark's default: rows hold whole documents here.
BATCH_ROWS, DEFAULT_ROWS = "1000", "10000"
BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"
#: Bytes of an Arrow batch, where the session leaves it open: a thousand very long documents are no batch. A longer row is one of its own.
BATCH_BYTES, BYTES_SETTING = 8 << 20, "spark.sql.execution.arrow.maxBytesPerBatch"


def ship(spark: SparkSession) -> None:
    """Sends this package's modules to the executors once a session, for tasks that run Python, and bounds their batches by rows and bytes."""
    if spark.conf.get(BATCH_SETTING, DEFAULT_ROWS) == DEFAULT_ROWS:
        spark.conf.set(BATCH_SETTING, BATCH_ROWS)
    if spark.conf.get(BYTES_SETTING, None) is None:
        spark.conf.set(BYTES_SETTING, str(BATCH_BYTES))
    context = spark.sparkContext
    if getattr(context, "_strandlake_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="strandlake-"), "strandlake_modules.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in sorted(os.walk(root)):
            for name in sorted(n for n in names if n.endswith(".py")):
                full = os.path.join(folder, name)
                z.write(full, os.path.join("strandlake", os.path.relpath(full, root)))
    context.addPyFile(path)
    context._strandlake_shipped = True


def shared_folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir, which all executors share. A local one stands in where it is unset, in local
    mode only, as in tests; a cluster without the setting is an error."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="strandlake-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder
