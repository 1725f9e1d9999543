"""Session helpers: where lineage may be cut, and a local session for tests and the bench."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str | int = "*", app: str = "meridia", **conf: str) -> SparkSession:
    """A local session; on a cluster the job's own session is used instead."""
    settings = {
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.driver.memory": "12g",
        **conf,
    }
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for key, value in settings.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    ship(session)
    return session


def shared_folder(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder; on a cluster such a folder would be
    private to one machine, so a missing setting is an error there.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if context.getCheckpointDir() is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="meridia-"))
    return context.getCheckpointDir()


def ship(spark: SparkSession) -> None:
    """Give the package's own source to the Python workers, once per session's context.

    Functions that run in workers are found there by module name, so this makes a program work from any
    folder, and on executors where the package is not installed.
    """
    context = spark.sparkContext
    if getattr(context, "_meridia_shipped", False):
        return
    package = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="meridia-"), "meridia.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for folder, _, names in os.walk(package):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.relpath(path, os.path.dirname(package)))
    context.addPyFile(archive)
    context._meridia_shipped = True


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder once and go on from the written copy.

    What follows no longer depends on how the table was made: lost executors read it again, and
    loops of many fits plan against one plain scan.
    """
    spark = df.sparkSession
    ship(spark)
    path = f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.parquet(path)
