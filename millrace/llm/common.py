"""Small helpers shared by the operators of this package."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from millrace.session import fresh_path, shared_dir

#: ASCII capitals to small letters, for UTF-8 bytes.
LOWER_ASCII = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a folder through the file system that holds it."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


class Scratch:
    """Tables written to the shared folder, each under its own path.

    ``drop`` deletes those that no later read needs, so that the rounds of an
    iteration do not add up on the disk.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.name = spark, name
        shared_dir(spark)

    def pin(self, df: DataFrame) -> DataFrame:
        """Write ``df`` and read it back; cuts lineage, survives lost executors."""
        path = fresh_path(self.spark, self.name)
        df.write.parquet(path)
        back = self.spark.read.schema(df.schema).parquet(path)
        back._scratch_path = path
        return back

    def drop(self, *pinned: DataFrame) -> None:
        for df in pinned:
            if path := getattr(df, "_scratch_path", None):
                drop_path(self.spark, path)
