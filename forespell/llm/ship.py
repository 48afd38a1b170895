"""Make this package importable in Python workers, as ``--py-files`` does for a submitted job."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import tempfile
import zipfile
from pathlib import Path

import pyarrow as pa
from pyspark.sql import SparkSession

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send the package to the executors, once per application, and keep Arrow batches small.

    Rows here are whole texts; batches by count alone would hold any number of bytes.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(8 << 20))
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="package-")) / "forespell_package.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for path in sorted(package.rglob("*.py")):
            out.write(path, path.relative_to(package.parent))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)


def give_back() -> None:
    """Return freed memory of this Python to the system: the driver's after a model was fitted, a worker's after a task."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # another C library
        ctypes.CDLL("libc.so.6").malloc_trim(0)
