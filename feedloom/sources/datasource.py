"""The gtfs_zip data source: spark.read.format("gtfs_zip").load(folder) gives the records of the archives in a folder.

It opens local or mounted paths itself, an archive per partition; scan() reads paths that only Spark can open.
"""

from __future__ import annotations

from collections.abc import Iterator
from pathlib import Path

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from feedloom.plans.config import Config
from feedloom.sources.gtfs_zip import ROWS, archive_rows


class _Reader(DataSourceReader):
    def __init__(self, path: str):
        self.path = path

    def partitions(self) -> list[InputPartition]:
        root = Path(self.path.removeprefix("file://"))
        return [InputPartition(str(p)) for p in (sorted(root.rglob("*.zip")) if root.is_dir() else [root])]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        for row in archive_rows(partition.value, Path(partition.value).read_bytes(), Config()):
            if row["kind"] == "row":
                yield row["path"], row["file"], row["row_no"], row["cells"]


class GtfsZip(DataSource):
    @classmethod
    def name(cls) -> str:
        return "gtfs_zip"

    def schema(self) -> str:
        return ROWS

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options["path"])


def register(spark: SparkSession) -> None:
    spark.dataSource.register(GtfsZip)
