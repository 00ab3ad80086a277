"""Session helpers."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the shared folder named in ``spark.checkpoint.dir``.

    Only a local session without that setting (tests) gets a folder of its own.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is not None:
        return
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        context.setCheckpointDir(shared)
    elif context.master.startswith("local"):
        context.setCheckpointDir(tempfile.mkdtemp(prefix="flowspark-checkpoint-"))
    else:
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared checkpoint folder."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, by: str | None = None) -> DataFrame:
    """Write ``df`` once as a table in the shared checkpoint folder, ``by`` a column if need be, and continue from there.

    Used where several outputs read one expensive result. The table outlives a
    lost executor, so nothing upstream is computed again, and its known size
    lets later joins choose a broadcast.
    """
    path = shared_path(df.sparkSession, "stage")
    (df.write.partitionBy(by) if by else df.write).parquet(path)
    _STAGES.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_STAGES: list[str] = []


def staged() -> list[str]:
    """Folders of the tables ``materialize`` has written and nothing has released."""
    return list(_STAGES)


def release_stages(spark: SparkSession, paths: list[str] | None = None, part: str | None = None) -> int:
    """Delete tables of ``materialize``, all or those in ``paths``; call it when no result that reads them is needed any more.

    Of tables stored by a column, ``part`` (``column=value``) deletes these rows alone.
    """
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    released = 0
    for name in staged() if paths is None else paths:
        if name in _STAGES:
            if part is None:
                _STAGES.remove(name)
            path = jvm.org.apache.hadoop.fs.Path(name if part is None else f"{name}/{part}")
            released += path.getFileSystem(conf).delete(path, True)
    return released
