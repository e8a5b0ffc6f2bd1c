"""Cleaning and task tracking as streams.

Sources are folders of Parquet files; a stream reads what is new since its checkpoint, so a
restarted query resumes where it stopped.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators.dedup import dedup_exact_name
from ..operators.merge import flush, upsert
from ..operators.normalize import normalize
from ..sources.tables import export_json, publish


def parquet_stream(spark: SparkSession, folder: str, pattern: str, schema, files_per_trigger: int = 1) -> DataFrame:
    return spark.readStream.schema(schema).option("pathGlobFilter", pattern).option("maxFilesPerTrigger", files_per_trigger).parquet(folder)


def dedup_batches(stream: DataFrame, path: str, checkpoint: str, key: str = "name", seq: str = "id"):
    """Each micro-batch is deduplicated by name; the batch's number makes the write repeatable."""

    def write(batch: DataFrame, number: int) -> None:
        dedup_exact_name(batch, key, seq).withColumn("batch_id", F.lit(number)).write.mode("overwrite").parquet(f"{path}/batch={number}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def normalise_stream(stream: DataFrame) -> DataFrame:
    """Raw records as business records, record by record: rows without a name or a place are dropped."""
    return normalize(stream)


#: After so many micro-batches the changes are gathered into a whole table again.
GATHER = 20


def _versions(spark: SparkSession, path: str, kind: str) -> list[int]:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [f.getPath().getName() for f in files.listStatus(at)] if files.exists(at) else []
    done = [n for n in names if n.startswith(f"{kind}=") and files.exists(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/{n}/_SUCCESS"))]
    return sorted(int(n.split("=")[1]) for n in done)


def _drop_before(spark: SparkSession, path: str, number: int) -> None:
    for kind in ("changes", "whole"):
        for n in _versions(spark, path, kind):
            if n < number:
                old = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/{kind}={n}")
                old.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(old, True)


def stored_rows(spark: SparkSession, path: str, empty: DataFrame, upto: int | None = None, key: str = "id") -> DataFrame:
    """The stored table after micro-batch ``upto`` (the last one if None): the last whole table and, of the changes since, the last row of each key."""
    limit = float("inf") if upto is None else upto
    whole = [n for n in _versions(spark, path, "whole") if n <= limit][-1:]
    changes = [n for n in _versions(spark, path, "changes") if n <= limit and n > (whole[0] if whole else -1)]
    parts = [spark.read.schema(empty.schema).parquet(f"{path}/{kind}={n}").withColumn("_n", F.lit(n)) for kind, some in (("whole", whole), ("changes", changes)) for n in some]
    if not parts:
        return empty
    rows = functools.reduce(DataFrame.unionByName, parts)
    return rows.groupBy(key).agg(F.max_by(F.struct(*empty.columns), "_n").alias("r")).select("r.*") if changes else rows.drop("_n")


def storage_batches(stream: DataFrame, path: str, checkpoint: str, empty: DataFrame, seq: str = "seq", metres: float = 100.0, gather: int = GATHER):
    """Keeps the stored table: each micro-batch is deduplicated by name and merged by the three tiers; ``stored_rows`` reads it. ``empty`` has the table's columns.

    A batch writes the rows that it has changed or added, not the table. It reads what batches before it have left, so one that is repeated after a
    failure writes the same rows again. Every ``gather`` batches the changes become a whole table, and what came before the one before it goes.
    """

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        old = stored_rows(spark, path, empty, number - 1)
        one = dedup_exact_name(batch, "name", seq)
        upsert(old, one, seq, metres, changed_only=True).write.mode("overwrite").parquet(f"{path}/changes={number}")
        if number % gather == gather - 1:
            stored_rows(spark, path, empty, number).write.mode("overwrite").parquet(f"{path}/whole={number}")
            _drop_before(spark, path, number - gather)

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def drain(query, path: str, empty: DataFrame, mappings: DataFrame, table: str, export: str, seq: str = "id") -> dict[str, int]:
    """Ends a run in order: the stream takes what is left, the stored rows that are clean are curated and inserted into ``table`` (conflicts ignored), and the table is
    exported as JSON. Each step begins after the one before has ended, so a failure leaves later copies as they were; another drain goes on from there. Returns the counts of the insert.
    """
    query.processAllAvailable()
    query.stop()
    spark, counters = mappings.sparkSession, Observation()
    rows = stored_rows(spark, path, empty)
    flushed, _ = flush(rows if "is_active" in rows.columns else rows.withColumn("is_active", F.lit(True)), mappings, spark.read.parquet(table), seq, counters)
    publish(flushed, table)
    export_json(spark.read.parquet(table), export)
    return {k: int(v or 0) for k, v in counters.get.items()}


def ledger(stream: DataFrame, path: str, checkpoint: str):
    """Keeps the current state of each task as keyed state of the stream; every micro-batch writes the tasks that it has changed, and a repeated one the same."""
    state = stream.groupBy("task").agg(
        F.max_by("status", "seq").alias("status"), F.max(F.when(F.col("status") == "completed", F.struct("seq", "results_count"))).alias("done"), F.count_if(F.col("status") == "failed").alias("retry_count")
    )

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/changes={number}")

    return state.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def ledger_state(spark: SparkSession, path: str) -> DataFrame:
    """The last state of each task."""
    rows = spark.read.option("basePath", path).parquet(*(f"{path}/changes={n}" for n in _versions(spark, path, "changes")))
    last = rows.groupBy("task").agg(F.max_by(F.struct("status", "done", "retry_count"), "changes").alias("s"))
    return last.select("task", "s.status", F.col("s.done.results_count").alias("results_count"), "s.retry_count")


def unfinished(stream: DataFrame, state: DataFrame) -> DataFrame:
    """The tasks of a stream that a former run hasn't completed: what a producer that resumes lets through. state: task, status."""
    return stream.join(state.where(F.col("status") == "completed").select("task"), "task", "left_anti")


def windows(events: DataFrame, length: str, slide: str | None = None, late: str = "1 hour") -> DataFrame:
    """Extension: counts and sums by event type in tumbling or sliding windows, with late rows up to the watermark."""
    timed = events.withColumn("t", F.col("ts").cast("timestamp")).withWatermark("t", late)
    return timed.groupBy(F.window("t", length, slide), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total"))
