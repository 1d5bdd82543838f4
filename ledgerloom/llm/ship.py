"""Give this package to the executors' Python workers."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

from ledgerloom.sources.scratch import shared_folder

PACKAGE = Path(__file__).resolve().parents[1]
_shipped: set[str] = set()


def ship(spark: SparkSession) -> SparkSession:
    """Add the package as a zip file to the application, once.

    Python workers then import it wherever they run, also where the
    repository is not on their path.  The file lies in the shared folder, from
    which Spark gives it to executors, later ones included.
    """
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        path_of = spark._jvm.org.apache.hadoop.fs.Path
        with tempfile.TemporaryDirectory() as folder:
            path = Path(folder, f"{PACKAGE.name}.zip")
            with zipfile.ZipFile(path, "w") as archive:
                for source in sorted(PACKAGE.rglob("*.py")):
                    archive.write(source, source.relative_to(PACKAGE.parent))
            to = path_of(f"{shared_folder(spark)}/code-{uuid.uuid4().hex}.zip")
            files = to.getFileSystem(context._jsc.hadoopConfiguration())
            files.copyFromLocalFile(path_of(path.as_uri()), to)
        context.addPyFile(files.makeQualified(to).toString())
        _shipped.add(context.applicationId)
    return spark
