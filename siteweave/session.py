"""Session helpers: code for the Python workers, and storage that driver and executors share."""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_shipped: set[str] = set()


def ship(spark: SparkSession) -> SparkSession:
    """Sends this package to the Python workers once per application, so that no install or shared path is needed."""
    app = spark.sparkContext.applicationId
    if app not in _shipped:
        root = Path(__file__).resolve().parent
        handle, path = tempfile.mkstemp(suffix=".zip", prefix="siteweave-")
        os.close(handle)
        atexit.register(Path(path).unlink, missing_ok=True)  # the driver serves it until then
        with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as archive:
            for file in sorted(root.rglob("*.py")):
                archive.write(file, file.relative_to(root.parent))
        spark.sparkContext.addPyFile(path)
        _shipped.add(app)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Where it is unset in one process, as in tests,
    a folder that goes when the process ends; on a cluster no folder of one machine will do."""
    where = spark.conf.get("spark.checkpoint.dir", None)
    if not where:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        own = tempfile.mkdtemp(prefix="siteweave-")
        atexit.register(shutil.rmtree, own, ignore_errors=True)
        where = f"file://{own}"
        spark.conf.set("spark.checkpoint.dir", where)
        spark.sparkContext.setCheckpointDir(where)
    return where.rstrip("/")


def work_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/siteweave/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Cuts the lineage with a written table in the shared folder; its path is kept in ``written_at``."""
    path = work_path(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)  # a given schema spares a job that would look for it
    out.written_at = path
    return out


def filesystem(uri: str):
    """(pyarrow filesystem, path) for any URI that pyarrow knows: file, hdfs, s3, gs, or a plain path."""
    from pyarrow import fs

    if "://" not in uri and not uri.startswith("file:"):
        return fs.LocalFileSystem(), uri
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri[len("file:") :]
    return fs.FileSystem.from_uri(uri)
