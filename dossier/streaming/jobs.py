"""Structured Streaming jobs over landed events, each run to the end of what is there (``availableNow``)."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dossier.session import prepare, shared_folder


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table as a file stream; ``ts`` as a timestamp, since watermarks need one."""
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    # The source lists a folder; the glob picks the table whether it is one file or a folder of files.
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 8).option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").parquet(f"{sf_dir}/events.parquet*")
    return stream.withColumn("ts", F.col("ts").cast("timestamp"))


def run_to_end(df: DataFrame, mode: str) -> DataFrame:
    """Write the stream's batches to a folder of their own and read them back: ``append`` the rows, ``update`` with their batch number."""
    spark = df.sparkSession
    folder = f"{shared_folder(spark)}/stream-{uuid.uuid4().hex}"

    def write(batch: DataFrame, number: int) -> None:
        # Written by batch number: a batch that is run again replaces itself.
        batch.withColumn("_batch", F.lit(number)).write.mode("overwrite").parquet(f"{folder}/out/batch={number}")

    query = df.writeStream.outputMode(mode).option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).foreachBatch(write).start()
    query.awaitTermination()
    return spark.read.parquet(f"{folder}/out/*")


def hourly_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(event_type, hour_ts, n): tumbling windows of one hour; the newest state of each wins."""
    counts = event_stream(prepare(spark), sf_dir).groupBy("event_type", F.window("ts", "1 hour").alias("w")).agg(F.count("*").alias("n"))
    done = run_to_end(counts.select("event_type", F.col("w.start").alias("hour_ts"), "n"), "update")
    return done.groupBy("event_type", "hour_ts").agg(F.max_by("n", "_batch").alias("n")).withColumn("hour_ts", F.col("hour_ts").cast("timestamp_ntz"))


def user_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(user_id, start_ts, events): sessions that a pause of 30 minutes ends; the largest state of each start wins."""
    events = event_stream(prepare(spark), sf_dir).where("user_id is not null")
    sessions = events.groupBy("user_id", F.session_window("ts", "30 minutes").alias("w")).agg(F.count("*").alias("events"))
    done = run_to_end(sessions.select("user_id", F.col("w.start").alias("start_ts"), "events"), "complete")
    # In complete mode every batch has all sessions, so the last one counts.
    last = done.agg(F.max("_batch").alias("_batch"))
    return done.join(F.broadcast(last), "_batch").select("user_id", F.col("start_ts").cast("timestamp_ntz").alias("start_ts"), "events")


def first_of_kind(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(user_id, event_type): each kind of event of each user once, deduplicated within a watermark wider than the data."""
    events = event_stream(prepare(spark), sf_dir).select("user_id", "event_type", "ts").withWatermark("ts", "3650 days")
    return run_to_end(events.dropDuplicatesWithinWatermark(["user_id", "event_type"]), "append").select("user_id", "event_type")


def latest_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(user_id, event_type, event_id): the newest event of each user, kept as stream state (the heartbeat pattern)."""
    newest = event_stream(prepare(spark), sf_dir).where("user_id is not null").groupBy("user_id").agg(F.max(F.struct("ts", "event_id", "event_type")).alias("e"))
    done = run_to_end(newest.select("user_id", "e.event_type", "e.event_id"), "update")
    return done.groupBy("user_id").agg(F.max_by(F.struct("event_type", "event_id"), "_batch").alias("e")).select("user_id", "e.event_type", "e.event_id")


def queries():
    return {"stream_hourly_counts": hourly_counts, "stream_user_sessions": user_sessions, "stream_first_of_kind": first_of_kind, "stream_latest_state": latest_state}


def oracle_sql() -> dict[str, str]:
    return {
        "stream_hourly_counts": "SELECT event_type, CAST(date_trunc('hour', ts) AS timestamp) AS hour_ts, count(*) AS n FROM events GROUP BY ALL",
        "stream_user_sessions": "WITH m AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER w < INTERVAL '30' MINUTE THEN 0 ELSE 1 END AS fresh FROM events WHERE user_id IS NOT NULL WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),"
        " s AS (SELECT user_id, ts, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM m) SELECT user_id, min(ts) AS start_ts, count(*) AS events FROM s GROUP BY user_id, k",
        "stream_first_of_kind": "SELECT DISTINCT user_id, event_type FROM events",
        "stream_latest_state": "SELECT user_id, arg_max(event_type, (ts, event_id)) AS event_type, arg_max(event_id, (ts, event_id)) AS event_id FROM events WHERE user_id IS NOT NULL GROUP BY user_id",
    }
