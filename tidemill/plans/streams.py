"""Streaming queries on the events table; each must equal its batch twin."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.session import shared_dir
from tidemill.streaming import counters as S

#: A bound that all of the test table meets: a single pass has no late rows.
LATE = "400 days"


def stream_counters(spark: SparkSession, d: str) -> DataFrame:
    return S.drain(S.counts(S.follow(spark, d, "events")), "update", ["event_type"])


def stream_tumbling(spark: SparkSession, d: str) -> DataFrame:
    return S.drain(S.tumbling(S.follow(spark, d, "events"), LATE), "update", ["start", "event_type"]).withColumn("start", F.col("start").cast("date"))


def stream_sliding(spark: SparkSession, d: str) -> DataFrame:
    return S.drain(S.sliding(S.follow(spark, d, "events"), LATE), "update", ["start"]).withColumn("start", F.col("start").cast("date"))


def batch_sessions(spark: SparkSession, d: str) -> DataFrame:
    """Sessions per user, their number and greatest length (the batch plan of the streaming operator)."""
    s = S.sessions(spark.read.parquet(f"{d}/events.parquet"))
    return s.groupBy("user_id").agg(F.count("*").alias("sessions"), F.max("n").alias("longest"))


def stream_first_seen(spark: SparkSession, d: str) -> DataFrame:
    return S.drain(S.first_seen(S.follow(spark, d, "events"), LATE))


def stream_map(spark: SparkSession, d: str) -> DataFrame:
    """A map of users to their first event, grown batch by batch."""
    root = f"{shared_dir(spark)}/map-{uuid.uuid4().hex}"
    e = S.follow(spark, d, "events").select("user_id", "event_id")
    q = e.writeStream.option("checkpointLocation", f"{root}/state").trigger(availableNow=True)
    q.foreachBatch(lambda df, _: S.grow_map(spark, df, f"{root}/map", "user_id", "event_id")).start().awaitTermination()
    return spark.read.parquet(f"{root}/map")


#: Batches of the late stream, and how long it waits.
PARTS, WAIT = 4, "1 day"


def stream_late(spark: SparkSession, d: str) -> DataFrame:
    """Daily counts of a stream whose later batches hold old events again: each batch is a file with every fourth event, so what
    lies before the watermark of the batches before last comes too late and is dropped; the last days stay open."""
    root = f"{shared_dir(spark)}/late-{uuid.uuid4().hex}"
    e = spark.read.parquet(f"{d}/events.parquet")
    for i in range(PARTS):
        e.filter(F.pmod("event_id", F.lit(PARTS)) == i).coalesce(1).write.parquet(f"{root}/in/part={i}")
    stream = spark.readStream.schema(e.schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(f"{root}/in")
    at = stream.withColumn("at", F.col("ts").cast("timestamp")).withWatermark("at", WAIT)
    by = at.groupBy(F.window("at", "1 day")).agg(F.count("*").alias("n")).select(F.col("window.start").cast("date").alias("start"), "n")
    return S.drain(by)


def stream_sessions(spark: SparkSession, d: str) -> DataFrame:
    """Sessions of a user as a stream in append mode: those that the watermark has passed when the input ends."""
    return S.drain(S.sessions(S.follow(spark, d, "events"))).groupBy("user_id").agg(F.count("*").alias("sessions"), F.max("n").alias("longest"))


QUERIES = {f.__name__: f for f in (stream_late, stream_sessions, stream_counters, stream_tumbling, stream_sliding, batch_sessions, stream_first_seen, stream_map)}
SQL = {
    "stream_late": """with e as (select event_id % 4 as part, ts, ts::date as day from events), m as (select part, max(ts) as last from e group by 1),
 w as (select p as part, (select max(last) from m where m.part <= p - 2) - interval 1 day as mark from (select unnest(range(0, 4)) as p)),
 k as (select day from e join w using (part) where mark is null or day + interval 1 day > mark)
 select day as start, count(*) as n from k where day + interval 1 day <= (select max(ts) from events) - interval 1 day group by 1""",
    "stream_sessions": "with g as (select user_id, ts, coalesce(epoch_us(ts) - epoch_us(lag(ts) over w) >= 1800000000, true) as fresh from events window w as (partition by user_id order by ts)), s as (select user_id, ts, sum(fresh::int) over (partition by user_id order by ts rows unbounded preceding) as s from g), n as (select user_id, s, count(*) as n, max(ts) as last from s group by 1, 2) select user_id, count(*) as sessions, max(n) as longest from n where last + interval 30 minutes <= (select max(ts) from events) - interval 1 hour group by 1",
    "stream_counters": "select event_type, count(*) as n, round(sum(value), 2) as value from events group by 1",
    "stream_tumbling": "select ts::date as start, event_type, count(*) as n, round(sum(value), 2) as value from events group by 1, 2",
    "stream_sliding": "with x as (select (epoch_us(ts) // 86400000000)::bigint as day from events), w as (select day - o as first, count(*) as n from x, (select unnest([0, 1]) as o) group by 1) select (date '1970-01-01' + first::int) as start, n from w",
    "batch_sessions": "with g as (select user_id, ts, coalesce(epoch_us(ts) - epoch_us(lag(ts) over w) >= 1800000000, true) as fresh from events window w as (partition by user_id order by ts)), s as (select user_id, sum(fresh::int) over (partition by user_id order by ts rows unbounded preceding) as s from g), n as (select user_id, s, count(*) as n from s group by 1, 2) select user_id, count(*) as sessions, max(n) as longest from n group by 1",
    "stream_first_seen": "select event_id, user_id, event_type from events",
    "stream_map": "select user_id, min(event_id) as event_id from events group by 1",
}
