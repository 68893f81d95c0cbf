"""Files that arrive over time through the same operators, with exactly one output row per file."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def file_stream(spark: SparkSession, path: str, pattern: str = "*.txt", per_trigger: int = 1000) -> DataFrame:
    """``path, modificationTime, length, content`` of new files below a folder."""
    schema = "path string, modificationTime timestamp, length long, content binary"
    return spark.readStream.format("binaryFile").schema(schema).option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", per_trigger).load(path)


def run_available(stream: DataFrame, operator: Callable[[DataFrame], DataFrame], out: str, checkpoint: str, key: str = "path"):
    """Applies an operator to what is there and not done yet; a batch that is run again adds nothing twice."""

    def write(batch: DataFrame, number: int) -> None:
        made = operator(batch)
        made.withColumn("_batch", F.lit(number)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("_batch").parquet(out)

    query = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query
