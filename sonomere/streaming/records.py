"""Features of records as they arrive.

Records are independent of each other, so every workflow runs on a stream as it does on a table:
stateless, in append mode, without watermarks. Streams of samples become records in ``samples``;
``levels`` sums levels up over windows of time.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery


def stream_records(spark: SparkSession, path: str, schema, max_files: int = 1000) -> DataFrame:
    """Records read from the Parquet files that appear under ``path``."""
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def write_features(
    records: DataFrame,
    workflow: Callable[[DataFrame, float], DataFrame],
    fs: float,
    path: str,
    checkpoint: str,
) -> StreamingQuery:
    """Append the features of arriving records to Parquet files, then stop when none are left."""
    return write_stream(workflow(records, fs), path, checkpoint)


def write_stream(rows: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append the rows of a stream to Parquet files, then stop when none are left."""
    return (
        rows.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
