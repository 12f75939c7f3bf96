"""Parquet sources.

Every table is read lazily with ``spark.read.parquet``; Catalyst prunes the
columns a query uses and pushes its filters into the scan.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from snapfold.session import is_folder

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def event_stream(spark: SparkSession, sf_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """``events`` as a streaming source. A table that is a folder of part files is
    streamed itself; one that is a single file lies in the folder that all tables
    share, so the file source is narrowed to it with ``pathGlobFilter``."""
    path = table_path(sf_dir, "events")
    reader = spark.readStream.schema(read_table(spark, sf_dir, "events").schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    if is_folder(spark, path):
        return reader.parquet(path)
    return reader.option("pathGlobFilter", os.path.basename(path)).parquet(sf_dir)


def kafka_event_stream(spark: SparkSession, servers: str, topic: str, schema,
                       starting_offsets: str = "latest") -> DataFrame:
    """``events`` from a Kafka topic of JSON values (deployment source; needs
    the spark-sql-kafka package on the classpath). Same columns as the file
    source, so every streaming job takes either."""
    from pyspark.sql import functions as F
    raw = (spark.readStream.format("kafka")
           .option("kafka.bootstrap.servers", servers).option("subscribe", topic)
           .option("startingOffsets", starting_offsets).load())
    return (raw.select(F.from_json(F.col("value").cast("string"), schema).alias("e"))
               .select("e.*"))
