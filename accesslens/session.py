"""Spark session and the shared folder for written intermediates."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from functools import cache
from pathlib import Path

from pyspark.sql import SparkSession

# Settings the engine is tested with. Results do not depend on them: times are
# kept without a zone and ANSI mode stays on. How much memory, how many cores and
# how many shuffle partitions there are is the cluster's to say.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(
    name: str = "accesslens",
    master: str | None = None,
    settings: dict[str, str] | None = None,
) -> SparkSession:
    """A session with the settings above; ``settings`` adds to or replaces them."""
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **(settings or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="accesslens-")


def shared_folder(spark: SparkSession) -> str:
    """A folder all executors see: the one the cluster names for checkpoints.

    Only a local session without the setting gets a temporary folder, the same
    one for the life of the process.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    folder = folder or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return _local_folder()


def new_folder(spark: SparkSession, purpose: str) -> str:
    """Path of a folder below the shared one that nothing else uses."""
    return f"{shared_folder(spark)}/{purpose}-{uuid.uuid4().hex}"


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Makes this package importable in Python workers, as ``--py-files`` would.

    For sessions that were started without it: the package is zipped once for each
    application and handed to Spark, whose file server gives it to every executor,
    also those that start later.
    """
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="package-")) / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, file.relative_to(package.parent))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)
