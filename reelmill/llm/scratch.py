"""Tables written between the steps of an operator, in the folder the cluster shares."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


class Scratch:
    """One folder below ``spark.checkpoint.dir`` for the tables of one call.

    Written tables cut lineage and survive lost executors. Only a local session that
    names no shared folder gets a temporary one; any other session without it fails.
    """

    def __init__(self, spark: SparkSession, name: str) -> None:
        self.spark = spark
        base = spark.conf.get(CHECKPOINT_DIR, None)
        if not base:
            if not spark.sparkContext.master.startswith("local["):
                raise ValueError(f"set {CHECKPOINT_DIR} to a folder that all executors share")
            base = tempfile.mkdtemp(prefix="llm-")
        self.root = f"{base.rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def store(self, df: DataFrame, table: str, compression: str = "snappy") -> DataFrame:
        """Write ``df`` and read it back under the same schema."""
        df.write.option("compression", compression).parquet(self.path(table))
        return self.read(table, df)

    def read(self, table: str, like: DataFrame) -> DataFrame:
        return self.spark.read.schema(like.schema).parquet(self.path(table))

    def drop(self, *tables: str) -> None:
        """Delete tables that no later step and no returned result reads."""
        hadoop = self.spark._jvm.org.apache.hadoop.fs
        conf = self.spark._jsc.hadoopConfiguration()
        for table in tables:
            folder = hadoop.Path(self.path(table))
            folder.getFileSystem(conf).delete(folder, True)
