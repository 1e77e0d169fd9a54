"""Tables that a stream fills batch by batch, safe to replay.

Every micro-batch owns the folder ``batch_id=N``. Writing it again after a
failure replaces it, so a replayed batch never counts twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery


def write_batch(df: DataFrame, path: str, batch_id: int) -> None:
    df.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


def read_batches(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """All batches with their ``batch_id``."""
    return spark.read.schema(f"{schema}, batch_id bigint").parquet(path)


def batch_ids(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the batch folders, from the folder listing."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(folder):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(folder) if s.isDirectory()]
    return sorted(int(n.split("=", 1)[1]) for n in names if n.startswith("batch_id="))


def read_stream(spark: SparkSession, path: str, schema, max_files: int | None = None, format: str = "parquet") -> DataFrame:
    """File stream; ``max_files`` bounds how much one batch takes in."""
    reader = spark.readStream.format(format).schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def run(stream: DataFrame, on_batch, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Start ``on_batch(df, batch_id)``: on a timer (``every='1 minute'``), or once over what is there.

    ``checkpoint`` must be the same folder when the application starts again;
    otherwise everything would be read and counted a second time.
    """
    writer = stream.writeStream.foreachBatch(on_batch).option("checkpointLocation", checkpoint)
    if every:
        return writer.trigger(processingTime=every).start()
    return writer.trigger(availableNow=True).start()
