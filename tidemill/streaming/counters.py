"""Structured Streaming: the same counters, windows and de-duplication on tables that grow.

Every function takes a streaming (or batch) frame and returns one, so that batch and stream share the plan; ``drain`` runs
a stream over what is there and returns what it wrote, with its checkpoint in the shared folder.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tidemill.session import shared_dir


def follow(spark: SparkSession, d: str, name: str, files_per_trigger: int = 8) -> DataFrame:
    """A stream over a table that is one parquet file or a folder of them."""
    path = f"{d}/{name}.parquet"
    schema = spark.read.parquet(path).schema
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger)
    if path.startswith("/") and os.path.isfile(path):  # a single file is followed in its folder
        return reader.option("pathGlobFilter", f"{name}.parquet").parquet(d)
    return reader.parquet(path)


def drain(out: DataFrame, mode: str = "append", keys: list[str] | None = None) -> DataFrame:
    """Runs a stream over all input there is and returns its result, with its checkpoint in the shared folder.

    append: rows are final when they come (windows once the watermark has passed them). update: every batch adds the rows it
    changed with its number, and the last one per ``keys`` counts; state that the watermark has passed is dropped.
    """
    spark = out.sparkSession
    root = f"{shared_dir(spark)}/stream-{uuid.uuid4().hex}"
    w = out.writeStream.option("checkpointLocation", f"{root}/state").trigger(availableNow=True)
    if mode == "append":
        w.outputMode("append").format("parquet").start(f"{root}/out").awaitTermination()
        return spark.read.schema(out.schema).parquet(f"{root}/out")

    def add(df: DataFrame, epoch: int) -> None:  # a batch that is run again replaces what it wrote
        df.write.mode("overwrite").parquet(f"{root}/out/epoch={epoch}")

    w.outputMode("update").foreachBatch(add).start().awaitTermination()
    rest = [c for c in out.columns if c not in (keys or [])]
    schema = StructType([*out.schema.fields, StructField("epoch", LongType())])
    all_ = spark.read.schema(schema).parquet(f"{root}/out")
    return all_.groupBy(*keys).agg(F.max_by(F.struct(*rest), "epoch").alias("_v")).select(*keys, "_v.*").select(*out.columns)


def counts(events: DataFrame) -> DataFrame:
    return events.groupBy("event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 2).alias("value"))


def tumbling(events: DataFrame, late: str = "1 hour", width: str = "1 day") -> DataFrame:
    e = events.withColumn("at", F.col("ts").cast("timestamp")).withWatermark("at", late)
    by = e.groupBy(F.window("at", width), "event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 2).alias("value"))
    return by.select(F.col("window.start").alias("start"), "event_type", "n", "value")


def sliding(events: DataFrame, late: str = "1 hour", width: str = "2 days", step: str = "1 day") -> DataFrame:
    e = events.withColumn("at", F.col("ts").cast("timestamp")).withWatermark("at", late)
    return e.groupBy(F.window("at", width, step)).agg(F.count("*").alias("n")).select(F.col("window.start").alias("start"), "n")


def sessions(events: DataFrame, late: str = "1 hour", gap: str = "30 minutes") -> DataFrame:
    e = events.withColumn("at", F.col("ts").cast("timestamp")).withWatermark("at", late)
    by = e.groupBy(F.session_window("at", gap), "user_id").agg(F.count("*").alias("n"))
    return by.select("user_id", F.col("session_window.start").alias("start"), "n")


def first_seen(events: DataFrame, late: str = "1 hour") -> DataFrame:
    """One row per user and type within the watermark."""
    e = events.withColumn("at", F.col("ts").cast("timestamp")).withWatermark("at", late)
    return e.dropDuplicatesWithinWatermark(["event_id"]).select("event_id", "user_id", "event_type")


def grow_map(spark: SparkSession, batch: DataFrame, path: str, key: str, value: str) -> None:
    """Appends the keys that the persisted map doesn't know, each with its smallest value; known keys never move."""
    new = batch.groupBy(key).agg(F.min(value).alias(value))
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    there = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place)
    known = spark.read.parquet(path) if there else None  # none before the first batch
    (new if known is None else new.join(known.select(key), key, "left_anti")).write.mode("append").parquet(path)
