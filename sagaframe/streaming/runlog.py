"""Run logs: status and progress as views of an append-only log, and the same log as a stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def run_status(log: DataFrame, run: str, at: str, ok: Column, failed: Column, skipped: Column) -> DataFrame:
    """Counters, last time and status of each run."""
    agg = log.groupBy(run).agg(F.count(F.lit(1)).alias("total_items"), F.count_if(ok).alias("success_count"), F.count_if(failed).alias("failure_count"), F.count_if(skipped).alias("skipped_count"), F.max(at).alias("updated_at"))
    done = F.col("success_count") + F.col("failure_count") + F.col("skipped_count")
    out = agg.withColumn("processed_items", done).withColumn("pending_items", F.col("total_items") - done).withColumn("progress_ratio", F.round(done / F.col("total_items"), 4))
    return out.withColumn("status", F.when(F.col("pending_items") > 0, "running").when(F.col("failure_count") > 0, "completed_with_failures").otherwise("completed"))


def log_tail(log: DataFrame, order: str, n: int) -> DataFrame:
    return log.orderBy(F.col(order).desc()).limit(n)


def latest(log: DataFrame, run: str, at: str) -> DataFrame:
    """The last row of each run."""
    return log.withColumn("_r", F.row_number().over(Window.partitionBy(run).orderBy(F.col(at).desc()))).filter("_r = 1").drop("_r")


def utc(c: Column) -> Column:
    """The instant of a time without a zone, read as UTC whatever the session's zone."""
    return F.to_timestamp(F.concat(F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("Z")))


def shown(c: str, form: str) -> Column:
    """An instant as text in UTC."""
    return F.date_format(F.to_utc_timestamp(c, F.current_timezone()), form)


def stream(spark: SparkSession, folder: str, like: DataFrame, name: str = "*", files: int = 8) -> DataFrame:
    """A folder of parquet files as a stream with a known schema."""
    rows = spark.readStream.schema(like.schema).option("maxFilesPerTrigger", files).option("pathGlobFilter", name).parquet(folder)
    return rows.withColumns({c: utc(F.col(c)) for c, kind in like.dtypes if kind == "timestamp_ntz"})  # watermarks need instants


def tumbling(events: DataFrame, at: str, kind: str, width: str, late: str) -> DataFrame:
    return events.withWatermark(at, late).groupBy(F.window(at, width).alias("w"), kind).agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 4).alias("total")).select(F.col("w.start").alias("window_start"), kind, "n", "total")


def sessions(events: DataFrame, at: str, user: str, gap: str, late: str) -> DataFrame:
    return events.withWatermark(at, late).groupBy(F.session_window(at, gap).alias("w"), user).agg(F.count(F.lit(1)).alias("n")).select(user, F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), "n")


def first_seen(events: DataFrame, at: str, key: list[str], late: str) -> DataFrame:
    """Events without repeats of a key within the time that lateness allows."""
    return events.withWatermark(at, late).dropDuplicatesWithinWatermark(key)


def drain(df: DataFrame, path: str, checkpoint: str, mode: str = "append") -> DataFrame:
    """Run a stream over all that is there now and read what it wrote. A run that is cut off goes on from its checkpoint."""
    query = df.writeStream.format("parquet").outputMode(mode).option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return df.sparkSession.read.schema(df.schema).parquet(path)
