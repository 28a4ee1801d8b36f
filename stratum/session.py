"""Spark session with the settings that the operators rely on."""

from __future__ import annotations

import shutil
import tempfile
from pathlib import Path

from pyspark.sql import SparkSession

#: UTC timestamps, strict casts, runtime re-planning; everything else is the cluster's business.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.speculation": "false",  # a second copy of a task would repeat external calls
}
_shipped: set[str] = set()


def session(app: str = "stratum", **settings: str) -> SparkSession:
    """The active session, or a new one, with SETTINGS and the given ones."""
    return SparkSession.builder.appName(app).config(map=SETTINGS | settings).getOrCreate()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once for each application, so that tasks can import it."""
    app = spark.sparkContext.applicationId
    if app not in _shipped:
        _shipped.add(app)
        package = Path(__file__).parent
        archive = shutil.make_archive(f"{tempfile.mkdtemp()}/{package.name}", "zip", package.parent, package.name)
        spark.sparkContext.addPyFile(archive)


def shared_folder(spark: SparkSession) -> str:
    """The folder in `spark.checkpoint.dir`, which driver and executors share.

    Where it is unset, a temporary folder serves, but only in local mode, in
    which driver and executors are one process on one machine.
    """
    folder = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    folder = "file://" + tempfile.mkdtemp(prefix="spark-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder
