"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"
_OWN: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder named in spark.checkpoint.dir; on a local master without that setting, one of our own."""
    folder = spark.conf.get(SETTING, None) or spark.sparkContext.getConf().get(SETTING)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"{SETTING} is unset: a cluster must name a folder that all executors share")
    return _OWN.setdefault("folder", "file://" + tempfile.mkdtemp(prefix="folioscope-"))


def _drop(spark: SparkSession, path: str) -> None:
    try:
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
    except Exception:  # the session has ended: the cluster's own clean-up of the folder remains
        pass


#: Inputs above this size have splits enough of their own.
SMALL_BYTES = 64 << 20


def spread(df: DataFrame) -> DataFrame:
    """df as it is, but for a small input in fewer files than the cluster has cores: its rows are dealt out to all cores.

    For stages of which a row costs far more than its transport.  Inputs of a cluster's size stay as they are split.
    """
    spark = df.sparkSession
    cores = spark.sparkContext.defaultParallelism
    if df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes() > SMALL_BYTES or df.isStreaming:
        return df
    return df if len(df.inputFiles()) * 2 > cores else df.repartition(cores)


def stored(df: DataFrame, name: str, compression: str = "zstd") -> DataFrame:
    """df, written once as Parquet to the shared folder and read back: it cuts the lineage and survives lost executors.

    It is removed when the session ends, or before by ``release``.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", compression).parquet(path)
    atexit.register(_drop, spark, path)
    return spark.read.schema(df.schema).parquet(path)


def release(df: DataFrame) -> None:
    """Remove the files of a table that ``stored`` returned; what was planned from it can't be run any more."""
    folder = shared_folder(df.sparkSession)
    for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if path.startswith(folder) or path.removeprefix("file://").startswith(folder.removeprefix("file://").removeprefix("file:")):
            _drop(df.sparkSession, path)
