"""New archives as they arrive: each micro-batch is scanned, appended to the tables and compared with what came before."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from feedloom.plans.config import Config
from feedloom.sources import gtfs_zip

CONTENT = "path string, modificationTime timestamp, length long, content binary"


def arrivals(spark: SparkSession, folder: str) -> DataFrame:
    """A stream of the archives in a folder; each is seen once, however often the stream is restarted."""
    return spark.readStream.format("binaryFile").schema(CONTENT).option("pathGlobFilter", "*.zip").load(folder)


def ingest(stream: DataFrame, out: str, checkpoint: str, config: Config | None = None, after: Callable[[DataFrame, int], None] | None = None) -> StreamingQuery:
    """Appends the records of arriving archives to out/files and out/rows until nothing new is there.

    A batch that runs again after a failure overwrites its own partition, so nothing is stored twice. `after` gets each
    batch's scanned rows.
    """
    config = config or Config()

    def store(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        paths = [r.path for r in batch.select("path").collect()]
        if not paths:
            return
        scanned = gtfs_zip.scan(spark, ",".join(paths) if len(paths) == 1 else paths, config).withColumn("batch", F.lit(number)).persist()
        for name, part in (("files", gtfs_zip.files), ("rows", gtfs_zip.rows)):
            part(scanned).withColumn("batch", F.lit(number)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(f"{out}/{name}")
        if after:
            after(scanned, number)
        scanned.unpersist()

    return stream.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def hourly_departures(events: DataFrame, late: str = "10 minutes") -> DataFrame:
    """Events of a stream (ts, event_type) by hour and type; rows later than the watermark are left out."""
    return events.withWatermark("ts", late).groupBy(F.window("ts", "1 hour").alias("hour"), "event_type").agg(F.count("*").alias("n"))
