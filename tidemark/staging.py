"""Where intermediate tables live, and how lineage is cut."""

from __future__ import annotations

import tempfile
import uuid
import warnings

from pyspark.sql import DataFrame, SparkSession

from tidemark.errors import TidemarkError


# The JVM never compiles a method above 8000 bytes of bytecode. Cleaning many columns at
# once can exceed that; with this limit Spark splits the work into smaller methods.
JOB_SETTINGS = {"spark.sql.codegen.hugeMethodLimit": "8000"}


def job_session(spark: SparkSession) -> SparkSession:
    """A session with the caller's settings and those of a job; the caller's own stay as they are."""
    session = spark.newSession()
    for key, value in {**spark.conf.getAll, **JOB_SETTINGS}.items():
        if session.conf.isModifiable(key):
            session.conf.set(key, value)
    return session


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared folder for checkpoints and staged tables.

    Taken from ``spark.checkpoint.dir``, else from the context. Only a local session
    without either gets a temporary folder of its own; a cluster without them is an
    error, because a folder on one machine is lost with that machine.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if named:
        if named.startswith("file:") and not context.master.startswith("local"):
            # It may be a network mount, which looks the same; a folder of one machine would fail at the next read.
            warnings.warn(f"{named} must be a mount that all executors share.", stacklevel=2)
        return named
    if not context.master.startswith("local"):
        raise TidemarkError("Set spark.checkpoint.dir to a folder that all executors share.")
    folder = tempfile.mkdtemp(prefix="tidemark-")
    context.setCheckpointDir(folder)
    return folder


def cut_lineage(frame: DataFrame) -> DataFrame:
    """Reliable checkpoint: computed once, and still there when executors are lost."""
    context = frame.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(frame.sparkSession))
    return frame.checkpoint()


class Stage:
    """Staged tables of one run, below the shared folder."""

    def __init__(self, spark: SparkSession, root: str | None = None, run_id: str | None = None):
        self.spark = spark
        self.run_id = run_id or uuid.uuid4().hex
        self.root = f"{(root or shared_folder(spark)).rstrip('/')}/stage-{self.run_id}"

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def write(self, frame: DataFrame, name: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
        """Write a table and read it back, so later steps start from storage."""
        schema = frame.schema
        frame.write.mode("overwrite").partitionBy(*partition_by).parquet(self.path(name))
        return self.spark.read.schema(schema).parquet(self.path(name))

    def remove(self) -> None:
        """Delete the stage folder; results that a caller still reads must lie elsewhere."""
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.root)
        path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
