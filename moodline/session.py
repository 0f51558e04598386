"""Session settings the library relies on, and stage tables that cut lineage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"

# Runtime settings that change results (time zone) or plans (adaptive execution).
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # rows are whole texts: keep what goes to a Python worker at once small
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
}


def build_session(app_name: str = "moodline", master: str | None = None, **conf: str) -> SparkSession:
    """Get or create a session. Cluster sizing stays with the caller's ``conf``."""
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    for key, value in {**RUNTIME_CONF, **conf}.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else created."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


_own_folders: dict[str, str] = {}  # application id -> folder


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for stage tables: the session's setting.

    Only a local session may go without; it gets a new local folder. Executors on
    other machines could not read one.
    """
    folder = spark.conf.get(CHECKPOINT_DIR, None)
    if folder:
        return folder
    context = spark.sparkContext
    folder = context.getCheckpointDir()  # by setCheckpointDir
    if folder:
        return folder
    if not context.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder all executors can reach")
    app = context.applicationId
    if app not in _own_folders:
        _own_folders[app] = tempfile.mkdtemp(prefix="moodline-stage-")
    return _own_folders[app]


def stage_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/moodline/{name}-{uuid.uuid4().hex}"
    for made in _recording:
        made.append(path)
    return path


_recording: list[list[str]] = []


@contextmanager
def stages_made() -> Iterator[list[str]]:
    """The paths of the stage tables made inside, in order, to be dropped once their last reader is done."""
    made: list[str] = []
    _recording.append(made)
    try:
        yield made
    finally:
        _recording[:] = [m for m in _recording if m is not made]  # by identity: equal lists are others


def drop_stages(spark: SparkSession, paths: Iterable[str]) -> None:
    """Delete stage tables by their paths; those that are gone already don't matter."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for path in paths:
        place = jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(conf).delete(place, True)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back.

    The result has no lineage, so a lost executor costs one file scan and not a
    rerun of everything before it; it also has real size statistics.
    """
    path = stage_path(df.sparkSession, name)
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
