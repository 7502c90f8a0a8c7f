"""Session factory and the two things every operator shares: table loading and lineage cutting."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "orebody", master: str | None = None, **conf: str) -> SparkSession:
    """A session with UTC, AQE and Arrow on; anything the cluster already sets stays as it is."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",  # files of a checkpoint go when nothing refers to it
    } | conf
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once a session: they need not have it installed."""
    context = spark.sparkContext
    if getattr(context, "_orebody_shipped", False):
        return
    root = Path(__file__).resolve().parent
    folder = tempfile.mkdtemp(prefix="orebody-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    packed = Path(folder, "orebody-package.zip")
    with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as z:
        for source in sorted(root.rglob("*.py")):
            z.write(source, source.relative_to(root.parent))
    context.addPyFile(str(packed))  # executors fetch it from the driver's file server
    context._orebody_shipped = True


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table of a directory, as a lazily read parquet scan."""
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _checkpoint_dir(spark: SparkSession) -> None:
    """The cluster names a shared folder in spark.checkpoint.dir; only where it names none (tests) is a local one set."""
    context = spark.sparkContext
    if context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None):
        if context._jsc.sc().getCheckpointDir().isEmpty():
            context.setCheckpointDir(context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir"))
        return
    if context._jsc.sc().getCheckpointDir().isEmpty():
        if context.master != "local" and not context.master.startswith("local["):  # more than one process
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="orebody-checkpoint-"))


@contextmanager
def shared_folder(spark: SparkSession) -> Iterator[str]:
    """A new folder below the checkpoint folder, which all executors share; deleted at the end with all that is in it."""
    _checkpoint_dir(spark)
    context = spark.sparkContext
    where = context._jvm.org.apache.hadoop.fs.Path(f"{context._jsc.sc().getCheckpointDir().get()}/files-{uuid.uuid4().hex}")
    files = where.getFileSystem(context._jsc.hadoopConfiguration())
    files.mkdirs(where)
    try:
        yield where.toString()
    finally:
        files.delete(where, True)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise df in the shared checkpoint folder; a lost executor then costs no recomputation of what came before."""
    _checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
