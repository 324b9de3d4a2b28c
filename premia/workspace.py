"""Where jobs keep checkpoints and intermediate tables.

On a cluster the shared folder comes from ``spark.checkpoint.dir``. Only a local session without that setting gets
a temporary folder, because there the machine is the whole cluster.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_CONF = "spark.checkpoint.dir"
_local_roots: dict[str, str] = {}


def shared_root(spark: SparkSession) -> str:
    named = spark.conf.get(_CONF, None) or spark.sparkContext.getConf().get(_CONF)
    if named:
        return named.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"{_CONF} must name a shared folder on a cluster")
    app = spark.sparkContext.applicationId
    if app not in _local_roots:
        _local_roots[app] = tempfile.mkdtemp(prefix="premia-")
    return _local_roots[app]


_written: dict[str, list[str]] = {}


def fresh_path(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder, remembered for ``clear_scratch``."""
    path = f"{shared_root(spark)}/{label}-{uuid.uuid4().hex}"
    _written.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def stored(df: DataFrame, label: str, *by: str, **options) -> DataFrame:
    """Write once to the shared folder and read back, for results that several jobs use. With ``by`` there is a folder per
    value of these columns, so a job that filters on them reads its own folders alone. ``options`` are the writer's.

    The table carries no lineage and survives the loss of executors; unlike a checkpoint it is computed once and stays
    columnar.
    """
    path = fresh_path(df.sparkSession, label)
    writer = df.write.mode("overwrite").options(**options)
    (writer.partitionBy(*by) if by else writer).parquet(path)
    read = df.sparkSession.read.schema(df.schema).parquet(path)
    return read.select(*df.columns) if by else read


def discard(*tables: DataFrame) -> None:
    """Delete stored tables that nothing reads any more."""
    for df in tables:
        spark = df.sparkSession
        for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            target = spark._jvm.org.apache.hadoop.fs.Path(folder)
            target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def clear_scratch(spark: SparkSession) -> int:
    """Delete the scratch tables this application made; DataFrames that read them are invalid afterwards."""
    paths = _written.pop(spark.sparkContext.applicationId, [])
    for path in paths:
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
    return len(paths)
