"""Intermediate tables of one operator call, in the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from flowlake.runtime import scratch_path


class Scratch:
    """Tables written once: they cut lineage, survive lost executors and fix random row numbers.

    What a result still needs stays until the application ends or calls ``runtime.release_scratch``;
    tables that no later step reads are dropped by the operator itself.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.root = spark, scratch_path(spark, name)
        self._number = 0

    def path(self, name: str) -> str:
        self._number += 1
        return f"{self.root}/{self._number:03d}-{name}"

    def store(self, df: DataFrame, name: str) -> DataFrame:
        path = self.path(name)
        df.write.parquet(path)
        table = self.spark.read.schema(df.schema).parquet(path)
        table._scratch_path = path
        return table

    def drop(self, *tables: DataFrame) -> None:
        for table in tables:
            self.remove(table._scratch_path)

    def remove(self, path: str) -> None:
        place = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(place, True)
