"""Alert messages: a key, a JSON value as bytes and the ingest time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tocsin import schemas


def encode(
    df: DataFrame, key: str | None = "incident_type", ingest_time: Column | None = None
) -> DataFrame:
    """Frame of ``key`` and JSON ``value``, as message sinks expect it. Files have no
    broker to stamp messages, so they also get the ingest time in ``timestamp``."""
    columns = [F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).cast("binary").alias("value")]
    if key is not None:
        columns.insert(0, F.col(key).cast("string").alias("key"))
    if ingest_time is not None:
        columns.append(ingest_time.alias("timestamp"))
    return df.select(*columns)


def publish(messages: DataFrame, fmt: str = "kafka", **options: str) -> None:
    """Write encoded messages, for example ``fmt="kafka"`` with its server and topic
    options. Needs the matching connector on the class path."""
    messages.write.format(fmt).options(**options).mode("append").save()


def kafka_stream(spark: SparkSession, servers: str, topic: str, **options: str) -> DataFrame:
    """Topic as a stream from the latest offsets on. Needs the connector package."""
    settings = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": "latest"}
    return spark.readStream.format("kafka").options(**{**settings, **options}).load()


def file_stream(
    spark: SparkSession, path: str, schema: T.StructType = schemas.MESSAGE, **options: str
) -> DataFrame:
    """Parquet files as a stream; each new file is read once."""
    return spark.readStream.schema(schema).options(**options).parquet(path)
