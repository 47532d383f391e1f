"""Book files as a stream: every new file is flattened once, and the tables grow by its rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from foliant.operators import nested
from foliant.session import ship


def ingest(spark: SparkSession, source: str, target: str, checkpoint: str, schema: str = "raw_id bigint, file_name string, payload string, received_at timestamp") -> StreamingQuery:
    """Flatten new Parquet files of raw books into `target`, partitioned by tag; exactly once, by the checkpoint."""
    ship(spark)
    rows = spark.readStream.schema(schema).parquet(source)
    nodes = nested.flatten(rows, "raw_id", "payload")
    return nodes.writeStream.format("parquet").partitionBy("tag").option("path", target).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def arrivals(rows: DataFrame, late: str = "1 hour", width: str = "1 day") -> DataFrame:
    """Files and bytes by day of arrival; a file that comes later than the watermark allows is left out."""
    return rows.withWatermark("received_at", late).groupBy(F.window("received_at", width)).agg(F.count(F.lit(1)).alias("files"), F.sum(F.octet_length("payload")).alias("bytes"))
