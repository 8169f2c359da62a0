"""Sessions, the package on the executors, and tables that cut lineage."""

from __future__ import annotations

import atexit
import io
import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_shipped: set[str] = set()
_settled: dict[str, list[str]] = {}


def session(master: str | None = None, **conf: str) -> SparkSession:
    """A session with this engine's defaults; whatever is set already stays."""
    builder = SparkSession.builder.appName("ledgerloom")
    if master:
        builder = builder.master(master)
    defaults = {"spark.sql.adaptive.enabled": "true", "spark.sql.session.timeZone": "UTC", "spark.sql.execution.arrow.pyspark.enabled": "true"}
    for key, value in {**defaults, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ship(spark: SparkSession) -> SparkSession:
    """Make this package importable in the executors' Python, once per application.

    Functions that run in Python workers are sent by reference to their module.
    """
    app = spark.sparkContext.applicationId
    if app not in _shipped:
        _shipped.add(app)
        root = Path(__file__).resolve().parent
        packed = io.BytesIO()
        with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as z:
            for path in sorted(root.rglob("*.py")):
                z.write(path, path.relative_to(root.parent))
        folder = tempfile.mkdtemp(prefix="ledgerloom-")  # only read by the driver, which serves it
        target = os.path.join(folder, "ledgerloom.zip")
        Path(target).write_bytes(packed.getvalue())
        spark.sparkContext.addPyFile(target)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir; where it is unset, one of our own in local mode, an error on a cluster."""
    conf = spark.sparkContext.getConf()
    named = conf.get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if conf.get("spark.master", "").startswith("local"):
        folder = tempfile.mkdtemp(prefix="ledgerloom-shared-")
    else:
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def settled(df: DataFrame) -> DataFrame:
    """The same rows, written once to the shared folder and read from there.

    Cuts lineage, so that several uses don't compute the rows again, and a lost
    executor doesn't either. The files are removed by ``forget``, or when the driver ends.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark).rstrip('/')}/settled-{uuid.uuid4().hex}"
    df.write.parquet(path)
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(where)
    _settled.setdefault(spark.sparkContext.applicationId, []).append(path)
    return spark.read.schema(df.schema).parquet(path)


def forget(spark: SparkSession) -> None:
    """Remove the settled tables so far, once what was computed from them has been written."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    for path in _settled.pop(spark.sparkContext.applicationId, []):
        where = hadoop.Path(path)
        where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


@atexit.register
def _forget() -> None:
    _shipped.clear()
