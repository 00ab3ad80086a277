"""Tables that change by whole publications.

A publication writes its rows aside, in a folder of its own, and then a new manifest: which publication holds each
partition. The manifest's completion is the switch. Until then readers see what they saw before; a job that fails half way
leaves nothing they would see, and running it again under its name goes on where it stopped.

``<path>/data/run=<run>/<first partition>=…`` holds rows, ``<path>/manifests/<number>-<run>`` the manifests, the newest of
which that is complete counts. One job at a time publishes to a table.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RUN = "run"


def _folder(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def _exists(spark: SparkSession, path: str) -> bool:
    files, folder = _folder(spark, path)
    return files.exists(folder)


def _delete(spark: SparkSession, path: str) -> None:
    files, folder = _folder(spark, path)
    files.delete(folder, True)


def _names(spark: SparkSession, path: str) -> list[str]:
    files, folder = _folder(spark, path)
    return sorted(f.getPath().getName() for f in files.listStatus(folder)) if files.exists(folder) else []


def publications(spark: SparkSession, path: str) -> list[tuple[int, str]]:
    """Number and run of every manifest that is complete, oldest first."""
    complete = [name for name in _names(spark, f"{path}/manifests") if _exists(spark, f"{path}/manifests/{name}/_SUCCESS")]
    return [(int(name[:10]), name[11:]) for name in complete]


def _manifest_path(path: str, number: int, run: str) -> str:
    return f"{path}/manifests/{number:010d}-{run}"


def _manifest(spark: SparkSession, path: str) -> DataFrame | None:
    """Partition values and the run that holds them."""
    done = publications(spark, path)
    return spark.read.parquet(_manifest_path(path, *done[-1])) if done else None


def publish(df: DataFrame, path: str, partitions: list[str], run: str | None = None) -> str:
    """Make ``df`` the content of the partitions that occur in it; all others stay. Returns the run's name.

    Rows lie in one folder per value of the first partition column, sorted by the others. ``run`` names the publication: a repeated call with the name
    of one that is complete does nothing, and one whose rows were written only switches. An empty ``df`` changes nothing.
    """
    spark = df.sparkSession
    run = run or uuid.uuid4().hex
    done = publications(spark, path)
    if any(name == run for _, name in done):
        return run
    data = f"{path}/data/{RUN}={run}"
    if not _exists(spark, f"{data}/_SUCCESS"):
        arranged = df.hint("rebalance", partitions[0]).sortWithinPartitions(*[F.col(f"`{name}`") for name in partitions])
        arranged.write.mode("overwrite").option("compression", "snappy").partitionBy(partitions[0]).parquet(data)
    held = spark.read.schema(df.schema).parquet(data).select(*partitions).distinct().withColumn(RUN, F.lit(run))
    if not held.head(1):
        _delete(spark, data)
        return run
    before = _manifest(spark, path)
    if before is not None:
        held = held.unionByName(before.join(held.select(*partitions), partitions, "left_anti"))
    number = done[-1][0] + 1 if done else 1
    held.write.mode("overwrite").parquet(_manifest_path(path, number, run))
    return run


def read(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The table as last published, with its declared types: rows of each partition from the run that holds it.

    The manifest is a small table next to the rows; its runs and first partition values prune the folders that are read.
    """
    manifest = _manifest(spark, path)
    if manifest is None:
        return spark.createDataFrame([], schema)
    whole = T.StructType([*schema.fields, T.StructField(RUN, T.StringType())])
    return spark.read.schema(whole).parquet(f"{path}/data").join(manifest, manifest.columns, "left_semi").select(*schema.names)


def vacuum(spark: SparkSession, path: str, keep: int = 2) -> int:
    """Delete the complete manifests but the ``keep`` newest, and the rows no kept manifest names. Returns how many folders went.

    Rows of a run without a manifest, one that is under way or has failed, stay.
    """
    done = publications(spark, path)
    kept = done[-max(keep, 1) :]
    if not kept:
        return 0
    named = spark.read.parquet(*[_manifest_path(path, *entry) for entry in kept]).select(RUN).distinct()
    used = {row[RUN] for row in named.collect()}  # a row per publication
    gone = [_manifest_path(path, *entry) for entry in done if entry not in kept]
    gone += [f"{path}/data/{RUN}={run}" for _, run in done if run not in used]
    for folder in gone:
        _delete(spark, folder)
    return len(gone)
