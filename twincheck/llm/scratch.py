"""Tables written between the steps of an operator, in the folder all machines share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from twincheck.session import scratch_folder


class Scratch:
    """Cuts lineage: a saved table is reread from Parquet, so a lost executor costs no earlier step.

    Results are lazy and read these tables, so the tables stay until :meth:`clear` is called.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.folder = scratch_folder(spark, name)

    def save(self, frame: DataFrame, name: str) -> DataFrame:
        path = f"{self.folder}/{name}"
        frame.write.parquet(path)
        return self.spark.read.schema(frame.schema).parquet(path)

    def clear(self) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.folder)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
