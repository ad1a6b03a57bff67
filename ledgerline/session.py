"""SparkSession defaults shared by jobs, tests and the benchmark.

Cluster settings win: every option below is applied only when the caller's
configuration has not already set it.  The checkpoint folder is read from
``spark.checkpoint.dir``; a scratch folder is chosen only when it is unset
(local tests).
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # cp1251 CSV and decode() need the legacy charset list in Spark 4
    "spark.sql.legacy.javaCharsets": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, app: str = "ledgerline",
                shuffle_partitions: int | None = None,
                extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULTS)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Unset on a cluster it is an error; only a one-machine ``local`` master, as in
    tests, gets a scratch folder.
    """
    sc = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not d:
        # one machine only (tests): a cluster has to name its shared folder
        if not re.fullmatch(r"local(\[[^]]*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="ledgerline-ckpt-")
        sc.setCheckpointDir(d)
    return d


def checkpoint_path(spark: SparkSession, name: str) -> str:
    return os.path.join(ensure_checkpoint_dir(spark), name)


def java_charsets(spark: SparkSession):
    """Java's charsets (cp1251) for what is written, or built with ``decode``, inside.

    A session made elsewhere knows Spark's short list only.
    """
    return setting(spark, "spark.sql.legacy.javaCharsets", "true")


@contextmanager
def setting(spark: SparkSession, key: str, value: str):
    """A setting for what is planned or run inside; the session's own is put back after."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def materialize(df: DataFrame) -> DataFrame:
    """Compute an intermediate once and cut its lineage in the shared checkpoint folder.

    Persisting first makes the checkpoint write read the computed blocks instead of
    running the plan a second time; the cache is dropped right after.  Meant for
    small tables read several times (one row per group); a lost executor only
    costs a reread of the checkpoint files.
    """
    ensure_checkpoint_dir(df.sparkSession)
    cached = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return cached.checkpoint(eager=True)
    finally:
        cached.unpersist()


def create_once(spark: SparkSession, path: str, text: str) -> bool:
    """Create a small file whole, unless there is one of that name; whether it was created.

    Written under a hidden name and renamed without overwriting, by the file system that the path names:
    of several that try, one wins where the file system renames atomically (as HDFS does).
    """
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    fs_package = jvm.org.apache.hadoop.fs
    target = fs_package.Path(path)
    fs = target.getFileSystem(conf)
    target = fs.makeQualified(target)
    hidden = fs_package.Path(target.getParent(), f".{target.getName()}.{uuid.uuid4().hex}")
    out = fs.create(hidden, False)
    out.write(bytearray(text.encode()))
    out.close()
    no_overwrite = spark.sparkContext._gateway.new_array(fs_package.Options.Rename, 1)
    no_overwrite[0] = getattr(fs_package.Options.Rename, "NONE")
    try:
        fs_package.FileContext.getFileContext(target.toUri(), conf).rename(hidden, target, no_overwrite)
        return True
    except Py4JJavaError as e:
        if not e.java_exception.getClass().getSimpleName() == "FileAlreadyExistsException":
            raise
        fs.delete(hidden, False)
        return False
