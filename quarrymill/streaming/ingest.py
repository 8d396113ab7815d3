"""Incremental work on append-only logs with Structured Streaming: resume, latest state, what is left, windows."""

from __future__ import annotations

import threading
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.listener import StreamingQueryListener

from ..operators.relational import latest_per_key
from ..sources.logs import append_log, read_log, work_dir


def open_stream(spark: SparkSession, path: str) -> DataFrame:
    """A stream over a table's files; its schema is read from them. The path is given as a glob, so one file is a table too."""
    return spark.readStream.schema(spark.read.parquet(path).schema).parquet(f"{path[:-1]}[{path[-1]}]")


def ingest(stream: DataFrame, sink: str, checkpoint: str) -> None:
    """Append what is new to the sink and stop. A second run resumes from the checkpoint and adds nothing twice."""
    stream.writeStream.format("parquet").option("checkpointLocation", checkpoint).option("path", sink).trigger(availableNow=True).start().awaitTermination()


def upsert_latest(stream: DataFrame, keys: list[str], order: list[str], checkpoint: str) -> None:
    """Keep the last row of each key as keyed state: a batch writes the keys it changes, Spark removes old versions of the state.

    A second run with the same checkpoint takes what is new. The rows are read by state().
    """
    rest = [c for c in stream.columns if c not in keys]
    latest = stream.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("row"))
    latest.writeStream.outputMode("update").format("noop").option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def state(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The last row of each key, read from the state that upsert_latest keeps."""
    return spark.read.format("statestore").load(checkpoint).select("key.*", "value.valueWithExtremumOrdering.*")


def last_version(spark: SparkSession, sink: str) -> DataFrame:
    """The table of the last batch under sink/<batch>."""
    path = spark._jvm.org.apache.hadoop.fs.Path(sink)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return spark.read.parquet(f"{sink}/{max(int(s.getPath().getName()) for s in fs.listStatus(path))}")


def new_place(spark: SparkSession, name: str) -> tuple[str, str]:
    """(sink, checkpoint) in the shared folder."""
    at = f"{work_dir(spark)}/{name}-{uuid.uuid4().hex}"
    return f"{at}/data", f"{at}/checkpoint"


def todo(keys: DataFrame, results: DataFrame, key: list[str], order: list[str], status: str, final: list[str]) -> DataFrame:
    """Keys whose latest result isn't final, or that have none."""
    settled = latest_per_key(results.select(*key, *order, status), key, order).where(F.col(status).isin(*final))
    return keys.join(settled.select(*key), key, "left_anti")


def process_once(df: DataFrame, key: str, text: str, fn) -> DataFrame:
    """key, hash, result: fn (Column -> Column) runs once for each distinct text, all its rows share the result."""
    hashed = df.select(key, text, F.sha2(text, 256).alias("hash"))
    done = hashed.where("hash is not null").dropDuplicates(["hash"]).select("hash", fn(F.col(text)).alias("result"))
    return hashed.select(key, "hash").join(done, "hash", "left").select(key, "hash", "result")


def reconcile(pages: DataFrame, log: str, seq: str, cursor: str, counted: str, stated: str) -> DataFrame:
    """log, complete (its last page has no cursor), counted, stated, difference."""
    g = pages.groupBy(log).agg(F.max_by(F.col(cursor).isNull(), seq).alias("complete"), F.sum(counted).alias("counted"), F.max_by(stated, seq).alias("stated"))
    return g.withColumn("difference", F.col("stated") - F.col("counted"))


def window_counts(stream: DataFrame, at: str, width: str, late: str, by: list[str], sink_name: str) -> DataFrame:
    """Counts by tumbling window over all that is available, as a table (complete mode)."""
    timed = stream.withColumn("__at", F.col(at).cast("timestamp")).withWatermark("__at", late)
    counts = timed.groupBy(F.window("__at", width).alias("w"), *by).agg(F.count("*").alias("n"), F.sum("value").alias("total"))
    flat = counts.select(F.col("w.start").alias("start"), *by, "n", "total")
    spark = stream.sparkSession
    sink, checkpoint = new_place(spark, sink_name)
    put = lambda batch, number: batch.write.mode("overwrite").parquet(f"{sink}/{number}")
    flat.writeStream.outputMode("complete").foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    return last_version(spark, sink)


def closed_windows(stream: DataFrame, at: str, width: str, late: str, by: list[str], value: str, sink: str, checkpoint: str) -> DataFrame:
    """start, by, n, total of each tumbling window that the watermark (the latest time seen less `late`) has closed.

    Append mode: a window is written once, when nothing more can come, and its state is dropped; open windows wait in the
    state for the next run with the same checkpoint. Rows later than the watermark are counted as dropped in the progress.
    """
    timed = stream.withColumn("__at", F.col(at).cast("timestamp")).withWatermark("__at", late)
    counts = timed.groupBy(F.window("__at", width).alias("w"), *by).agg(F.count("*").alias("n"), F.sum(value).alias("total"))
    flat = counts.select(F.col("w.start").alias("start"), *by, "n", "total")
    flat.writeStream.outputMode("append").format("parquet").option("path", sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    return stream.sparkSession.read.schema(flat.schema).parquet(sink)


PROGRESS = "batch long, rows long, late_rows long, state_rows long, seen map<string,double>"


class _Progress(StreamingQueryListener):
    """Numbers of each micro-batch of the queries that run while it listens."""

    def __init__(self) -> None:
        self.rows, self.ended = [], threading.Event()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        seen = {k: float(v) for row in p.observedMetrics.values() for k, v in row.asDict().items() if v is not None}
        self.rows.append((p.batchId, p.numInputRows, sum(o.numRowsDroppedByWatermark for o in p.stateOperators), sum(o.numRowsTotal for o in p.stateOperators), seen))

    def onQueryTerminated(self, event) -> None:
        self.ended.set()


def run_measured(stream: DataFrame, measures: dict[str, Column], run, log: str) -> DataFrame:
    """Run one query, run(stream), to its end and append a row for each of its batches to a log; returns the whole log.

    measures are observed on what the stream reads; rows, late_rows (behind the watermark) and state_rows come from the
    query's progress. What reaches the driver is a row for each batch.
    """
    spark = stream.sparkSession
    listener = _Progress()
    spark.streams.addListener(listener)
    try:
        run(stream.observe("measures", *[c.alias(n) for n, c in measures.items()]))
        if not listener.ended.wait(60):
            raise TimeoutError("the query's end wasn't reported")
    finally:
        spark.streams.removeListener(listener)
    append_log(spark.createDataFrame(listener.rows, PROGRESS), log)
    return read_log(spark, log, PROGRESS)
