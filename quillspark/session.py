"""What a session needs: this package on every executor, and tables cut in the folder that all machines share."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

_shipped: set[str] = set()
#: Rows and bytes in one Arrow batch, so that a batch of long texts stays small.
BATCH_ROWS, BATCH_BYTES = 2000, 16 << 20


def ship(spark: SparkSession) -> None:
    """Send this package to the executors' Python workers, once per application, and keep their Arrow batches small."""
    sc = spark.sparkContext
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    if sc.applicationId in _shipped:
        return
    top = os.path.dirname(os.path.abspath(__file__))
    target = os.path.join(tempfile.mkdtemp(prefix="quillspark-zip-"), "quillspark.zip")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(top):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.join("quillspark", os.path.relpath(full, top)))
    sc.addPyFile(target)
    _shipped.add(sc.applicationId)


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share. Where none is set a local session gets a temporary one, as in
    tests; on a cluster that would be a folder of one machine, so it is an error.
    """
    where = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not where:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        where = tempfile.mkdtemp(prefix="quillspark-")
        spark.sparkContext.setCheckpointDir(where)
        spark.conf.set("spark.checkpoint.dir", where)
    return where


def cut(df: DataFrame, name: str = "cut") -> DataFrame:
    """Write to the shared folder and read again: short lineage that outlives a lost executor."""
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._quill_path = path
    return out


def drop_cut(df: DataFrame) -> None:
    """Remove the files of a table that cut() wrote and nothing reads any more."""
    path = getattr(df, "_quill_path", None)
    if path:
        jvm = df.sparkSession.sparkContext._jvm
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
