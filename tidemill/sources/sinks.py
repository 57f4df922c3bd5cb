"""Sinks: sharded parquet, tar shards, and manifests of what was written."""

from __future__ import annotations

import io
import json
import tarfile
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemill.operators.sample import running


def write_sharded(df: DataFrame, path: str, partition: list[str], order: list[str], rows_per_file: int) -> None:
    """Parquet by partition columns, rows in order within files of at most ``rows_per_file``. Rows of one partition value are
    spread over tasks by range of the order, so that a hot value is written in parallel."""
    out = df.repartitionByRange(*partition, *order).sortWithinPartitions(*partition, *order)
    out.write.option("maxRecordsPerFile", rows_per_file).option("compression", "zstd").partitionBy(*partition).mode("overwrite").parquet(path)


def row_bytes(df: DataFrame) -> Column:
    """Bytes of a row as they count for a file's bound: the length of texts and binaries, 8 for every other value, 1 for null."""
    one = lambda f: F.octet_length(f.name) if f.dataType.typeName() in ("string", "binary") else F.lit(8)
    parts = [F.coalesce(F.when(F.col(f.name).isNotNull(), one(f)), F.lit(1)).cast("bigint") for f in df.schema.fields]
    return sum(parts[1:], parts[0])


def write_bounded(df: DataFrame, path: str, partition: str, order: str, bytes_per_file: int) -> DataFrame:
    """Parquet files ``<partition>/<value>-<number>-of-<count>.parquet``, rows in order, each of about ``bytes_per_file`` before
    compression: a row is in the file that its first byte falls in, so a file holds at most that and one row. Returns the manifest
    (value, shard, rows, bytes).

    Bytes are summed over all rows in order without one task for a hot value. Files get their names when all are written, so a
    reader never sees a part of them; null partition values are written as "none".
    """
    spark = df.sparkSession
    value = F.coalesce(F.col(partition).cast("string"), F.lit("none"))
    x = running(df.withColumns({"_value": value, "_bytes": row_bytes(df)}), ["_value", order], {"_at": F.col("_bytes")})
    first = x.groupBy("_value").agg(F.min("_at").alias("_first"))
    x = x.join(F.broadcast(first) if first.count() <= 1 << 16 else first, "_value").withColumn("_shard", F.floor((F.col("_at") - F.col("_first")) / bytes_per_file).cast("int"))
    dense = F.dense_rank().over(Window.partitionBy("_value").orderBy("_shard")) - 1  # a row per shard
    shards = x.groupBy("_value", "_shard").agg(F.count("*").alias("rows"), F.sum("_bytes").alias("bytes"))
    shards = shards.withColumns({"shard": dense, "of": F.count("*").over(Window.partitionBy("_value"))})
    x = x.join(shards.select("_value", "_shard", "shard", "of"), ["_value", "_shard"])
    name = F.format_string("%s-%05d-of-%05d", F.col("_value"), "shard", "of")
    staged = f"{path}/.staged-{uuid.uuid4().hex}"
    out = x.withColumn("_name", name).repartition("_name").sortWithinPartitions("_name", order)
    out.select(*df.columns, "_name").write.option("compression", "zstd").partitionBy("_name").parquet(staged)
    hadoop = spark._jvm.org.apache.hadoop.fs
    system = hadoop.Path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    system.mkdirs(hadoop.Path(f"{path}/{partition}"))
    for folder in system.listStatus(hadoop.Path(staged)):  # one entry per file
        own = folder.getPath().getName()
        if own.startswith("_name="):
            part = next(f.getPath() for f in system.listStatus(folder.getPath()) if f.getPath().getName().startswith("part-"))
            system.rename(part, hadoop.Path(f"{path}/{partition}/{own[6:]}.parquet"))
    system.delete(hadoop.Path(staged), True)
    return shards.select(F.col("_value").alias("value"), "shard", "rows", "bytes")


def label_index(df: DataFrame, label: str) -> DataFrame:
    """(label, number): the labels of tar shards in order, numbered from 0; null labels have none."""
    n = df.filter(F.col(label).isNotNull()).select(F.col(label).cast("string").alias("label")).distinct()
    return n.select("label", (F.row_number().over(Window.orderBy("label")) - 1).alias("number"))  # a row per label


def tar_shards(df: DataFrame, key: str, payload: str, extension: str, shards: int) -> DataFrame:
    """(shard, members, tar): members sorted by key with a JSON sidecar of the other columns, the tar as binary; rows go to
    shards by the hash of their key, so a shard's size is bounded by the number of shards."""
    kinds = [c for c in df.columns if c not in (key, payload)]

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        buffer = io.BytesIO()
        pdf = pdf.sort_values(key)
        with tarfile.open(fileobj=buffer, mode="w", format=tarfile.USTAR_FORMAT) as tar:
            for r in pdf.to_dict("records"):
                body = r[payload] if isinstance(r[payload], bytes | bytearray) else str(r[payload] or "").encode()
                side = json.dumps({k: None if r[k] is None or r[k] != r[k] else r[k] for k in kinds}, sort_keys=True, default=str).encode()
                for name, data in ((f"{r[key]}.{extension}", body), (f"{r[key]}.json", side)):
                    info = tarfile.TarInfo(name)
                    info.size = len(data)
                    tar.addfile(info, io.BytesIO(data))
        return pd.DataFrame({"shard": [int(pdf["shard"].iloc[0])], "members": [len(pdf)], "tar": [buffer.getvalue()]})

    x = df.filter(F.col(key).isNotNull()).withColumn("shard", F.pmod(F.xxhash64(key), F.lit(shards)).cast("int"))
    return x.groupBy("shard").applyInPandas(pack, "shard int, members int, tar binary")


def read_tars(spark: SparkSession, shards: DataFrame) -> DataFrame:
    """(name, content) of every member of tar shards."""

    def unpack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for raw in b["tar"]:
                with tarfile.open(fileobj=io.BytesIO(raw)) as tar:
                    rows = [(m.name, tar.extractfile(m).read()) for m in tar if m.isfile()]
                yield pd.DataFrame(rows, columns=["name", "content"])

    return shards.select("tar").mapInPandas(unpack, "name string, content binary")


def file_manifest(spark: SparkSession, path: str) -> DataFrame:
    """(file, bytes, sha256) of every file under a folder, relative to it."""
    t = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return t.select(F.substring_index("path", path.rstrip("/") + "/", -1).alias("file"), F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))


def manifest_changes(old: DataFrame, new: DataFrame) -> DataFrame:
    """(file, change) of files that were added, removed or changed."""
    j = old.alias("o").join(new.alias("n"), F.col("o.file") == F.col("n.file"), "full_outer")
    change = F.when(F.col("o.file").isNull(), "added").when(F.col("n.file").isNull(), "removed").when(~F.col("o.sha256").eqNullSafe(F.col("n.sha256")), "changed")
    return j.select(F.coalesce("o.file", "n.file").alias("file"), change.alias("change")).filter("change is not null")
