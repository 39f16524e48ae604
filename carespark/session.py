"""SparkSession helpers.

The library never creates hidden sessions: every operator takes DataFrames.
``get_session`` is a convenience for tests, the bench and scripts.
"""

from __future__ import annotations

import os
import tempfile
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import SparkSession

# Settings the library relies on (also documented in the README):
# - ANSI mode stays on; every cast of untrusted text is a try_cast.
# - UTC session time zone so dates never shift.
# - AQE on: runtime coalescing, skew-join splitting, runtime broadcast only
#   when the measured size is under autoBroadcastJoinThreshold.
BASE_CONF = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
    # Long-lived drivers: let the context cleaner release broadcasts and
    # shuffle files of finished queries promptly (default is 30 minutes).
    "spark.cleaner.periodicGC.interval": "1min",
    # CSV landing must see every field to detect short/long lines (trap T9).
    "spark.sql.csv.parser.columnPruning.enabled": "false",
}


def get_session(
    master: str | None = None,
    app_name: str = "carespark",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint directory, setting one only when unset.

    On a cluster ``spark.checkpoint.dir`` names a shared folder (HDFS/S3/...)
    and is respected as is. Only when nothing is configured (local tests) is a
    fresh scratch folder created.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None
    )
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir() or conf_dir
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set: on a cluster it must name a shared folder "
            "(stages written there must survive executor loss)"
        )
    local = tempfile.mkdtemp(prefix="carespark-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir() or local


# Folders of the stages made so far, where a caller deletes them.
_MADE: ContextVar[list[str] | None] = ContextVar("made", default=None)


def stable_table(df, name: str = "stage", rows_per_file: int | None = None):
    """Write ``df`` as Parquet under the shared checkpoint folder and read it back.

    This cuts lineage like a reliable checkpoint (survives executor loss,
    nothing machine-local on a cluster) but stores columnar data whose size
    statistics let adaptive execution broadcast small results later on.
    Folders are unique per call; :func:`staged` removes its own, :func:`drop_stages` an application's.
    ``rows_per_file`` bounds a file where rows take few bytes: files are packed into read tasks by
    their bytes and a cost per file, so it also bounds the rows of a task.
    """
    import uuid

    spark = df.sparkSession
    base = ensure_checkpoint_dir(spark).rstrip("/")
    # the folder of this application's stages; nothing else is stored below it
    path = f"{base}/{STAGE_ROOT}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"
    if (made := _MADE.get()) is not None:
        made.append(path)
    w = df.write.mode("overwrite")
    (w.option("maxRecordsPerFile", rows_per_file) if rows_per_file else w).parquet(path)
    # the schema is known: reading it back needs no footer-inference job
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def short_shuffles(spark: SparkSession):
    """In a ``with`` block a query's shuffle files are deleted when it ends, not when the driver's garbage
    collection finds that nothing refers to them: what the block needs on disk is its largest query's."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


STAGE_ROOT = "carespark-stages"


def _stage_folders(spark: SparkSession):
    """(file system, {application id: folder}) below every stage root of the checkpoint folder."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path
    here = path(ensure_checkpoint_dir(spark))
    fs = here.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    around = [here]
    # Spark puts a folder of its own per application below a configured one
    configured = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if configured and fs.exists(path(configured)):
        around += [st.getPath() for st in fs.listStatus(path(configured)) if st.isDirectory()]
    out = {}
    for parent in around:
        root = path(parent, STAGE_ROOT)
        if fs.exists(root):
            out |= {st.getPath().getName(): st.getPath() for st in fs.listStatus(root) if st.isDirectory()}
    return fs, out


@contextmanager
def stages_dropped(spark: SparkSession):
    """The stages that are made in a ``with`` block are deleted at its end: nothing that reads them may be read later."""
    made: list[str] = []
    before = _MADE.set(made)
    try:
        yield
    finally:
        _MADE.reset(before)
        _delete(spark, made)


@contextmanager
def staged(df, name: str = "stage", rows_per_file: int | None = None):
    """A :func:`stable_table` for a ``with`` block, at whose end its folder is deleted, and no other one:
    neither the frame nor one made from it may be read later."""
    made: list[str] = []
    before = _MADE.set(made)
    try:
        out = stable_table(df, name, rows_per_file)
    finally:
        _MADE.reset(before)
    try:
        yield out
    finally:
        _delete(df.sparkSession, made)


def _delete(spark: SparkSession, folders: list[str]) -> None:
    sc = spark.sparkContext
    for folder in folders:
        path = sc._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)


def drop_stages(spark: SparkSession) -> bool:
    """Delete the stages of this application: call it when no frame that reads
    one is used any more, e.g. at the end of a pipeline. Marts, exports and
    audit tables lie elsewhere and stay."""
    fs, folders = _stage_folders(spark)
    mine = folders.get(spark.sparkContext.applicationId)
    return bool(mine is not None and fs.delete(mine, True))


def purge_stages(spark: SparkSession, older_than_hours: float = 24.0) -> int:
    """Delete the stages of other applications in which nothing was written for
    ``older_than_hours`` (housekeeping for what ended without drop_stages).
    This application's own stages are never touched. Returns the number of
    applications whose stages were removed."""
    import time

    cutoff = (time.time() - older_than_hours * 3600) * 1000
    fs, folders = _stage_folders(spark)
    removed = 0
    for app, folder in folders.items():
        newest = max([fs.getFileStatus(folder).getModificationTime(),
                      *[st.getModificationTime() for st in fs.listStatus(folder)]])
        if app != spark.sparkContext.applicationId and newest < cutoff:
            fs.delete(folder, True)
            removed += 1
    return removed
