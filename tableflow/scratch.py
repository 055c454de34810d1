"""Scratch folders and shipped code, for results that are read repeatedly."""

from __future__ import annotations

import atexit
import pathlib
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

_shipped: set[str] = set()
_local_bases: dict[str, str] = {}
_folders: list[tuple[SparkSession, str]] = []


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new path under the session's shared checkpoint folder (``spark.checkpoint.dir``).

    Without that setting, a local master uses a temporary folder of its own; a cluster, whose
    executors could not see it, is refused. The session's settings stay as they are. What is
    written there is removed when the driver's process ends.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        application = spark.sparkContext.applicationId
        if application not in _local_bases:
            _local_bases[application] = tempfile.mkdtemp(prefix="tableflow-")
        base = _local_bases[application]
    path = f"{base.rstrip('/')}/{unique(name)}"
    if not _folders:
        atexit.unregister(remove_scratch)
        atexit.register(remove_scratch)  # only now, so that it runs before the gateway ends
    _folders.append((spark, path))
    return path


def written(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """The rows as a parquet table in the shared scratch folder: computed once, read anywhere."""
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def written_last(df: DataFrame, name: str, since: int) -> DataFrame:
    """Like ``written``; then the scratch handed out after ``since`` (``handed_out()``) is removed.

    For a step whose result needs nothing of what was written on the way to it.
    """
    spark = df.sparkSession
    found = written(df, name)
    done = [folder for folder in _folders[since:-1] if folder[0] is spark]
    for folder in done:
        _remove(*folder)
        _folders.remove(folder)
    return found


def handed_out() -> int:
    """How many scratch folders are in use."""
    return len(_folders)


def remove_scratch() -> None:
    """Remove the scratch folders handed out so far whose application still runs."""
    while _folders:
        _remove(*_folders.pop())


def _remove(spark: SparkSession, path: str) -> None:
    context = spark.sparkContext
    if context._jsc is None or context._jsc.sc().isStopped():
        return
    folder = context._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(context._jsc.hadoopConfiguration()).delete(folder, True)


def unique(name: str) -> str:
    """A name no other run uses, valid as a table or folder name."""
    return f"{name}_{uuid.uuid4().hex[:12]}"


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, once per application, for code that runs there."""
    application = spark.sparkContext.applicationId
    if application in _shipped:
        return
    package = pathlib.Path(__file__).parent
    archive = pathlib.Path(tempfile.mkdtemp(prefix="tableflow-")) / "tableflow.zip"
    with zipfile.ZipFile(archive, "w") as bundle:
        for source in sorted(package.rglob("*.py")):
            bundle.write(source, source.relative_to(package.parent))
    spark.sparkContext.addPyFile(str(archive))
    _shipped.add(application)
