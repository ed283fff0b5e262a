"""Session defaults and the two ways this package cuts a plan."""

from __future__ import annotations

import contextlib
import contextvars
import io
import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(app: str = "patronlens", master: str | None = None, **conf) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ship(spark: SparkSession, root: str) -> None:
    """Send the package below ``root`` to the Python workers, once for each Spark application.

    Functions that run on executors import it, and executors need not see the driver's folders.
    """
    context = spark.sparkContext
    name = "patronlens-shipped.zip"
    if any(f.endswith(name) for f in context.listFiles):
        return
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w") as out:
        for folder, _, files in os.walk(os.path.join(root, "patronlens")):
            for file in files:
                if file.endswith(".py"):
                    path = os.path.join(folder, file)
                    out.write(path, os.path.relpath(path, root))
    path = os.path.join(tempfile.mkdtemp(prefix="patronlens-"), name)
    with open(path, "wb") as out:
        out.write(packed.getvalue())
    context.addPyFile(path)


def work_dir(spark: SparkSession) -> str:
    """Shared folder for intermediate tables.

    It is the folder the cluster names in ``spark.checkpoint.dir``. Only a local
    master may fall back to a temporary folder of this machine.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="patronlens-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


#: Paths written in each open block of ``temporary_tables``, the innermost last.
_written: contextvars.ContextVar[tuple[list[str], ...]] = contextvars.ContextVar("written", default=())


@contextlib.contextmanager
def temporary_tables(spark: SparkSession) -> Iterator[list[str]]:
    """Tables that ``materialise`` writes inside the block are deleted when it ends, also after an error.

    Results that read them must be used inside the block. Only paths written in the block are deleted, through the
    file system of the shared folder. Blocks may be nested; each deletes its own. A table written with ``outlives`` belongs
    to the block around this one, or to none.
    """
    paths: list[str] = []
    token = _written.set((*_written.get(), paths))
    try:
        yield paths
    finally:
        _written.reset(token)
        for path in paths:
            where = spark._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


#: Spark's setting that removes a query's shuffle files when the query ends.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextlib.contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Queries run in the block leave no shuffle files; otherwise those stay until the driver's garbage collector meets them."""
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)


def materialise(df: DataFrame, outlives: bool = False) -> DataFrame:
    """Write ``df`` once to the shared folder and continue from the written table.

    Used where a result is read many times (model fits) or must not change
    between two reads (row positions). Being a table, it survives lost executors
    and gives the optimizer its true size. ``outlives``: the table stays when the innermost ``temporary_tables`` ends.
    The write's shuffle files are removed with its end: nothing reads them again.
    """
    path = f"{work_dir(df.sparkSession)}/patronlens/{uuid.uuid4().hex}"
    if blocks := _written.get()[: -1 if outlives else None]:
        blocks[-1].append(path)  # before the write, so that a failed one is deleted too
    with shuffles_removed(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

