"""Corpus and chat preparation on Structured Streaming.

Classification, chunking and message building are stateless per line, so
the batch operators run unchanged on ``readStream.text``: no watermark, no
state store. Each micro-batch is written by the file sink with its commit
log in ``checkpoint``; a restarted query resumes from there (exactly-once
files). Line numbers are not available on a stream: rows carry the source file
path instead, and rejects come from the batch job over the same files.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import quality as Q
from ..operators.chat import to_messages
from ..options import ChatOptions, CorpusOptions
from ..session import ship_package
from ..sinks.writers import messages_json


def read_line_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    r = spark.readStream.format("text")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.load(path).select("value", F.col("_metadata.file_path").alias("file"))


def corpus_chunks_stream(lines: DataFrame, opts: CorpusOptions = CorpusOptions()) -> DataFrame:
    from ..plans.jobs import prepare_corpus
    return prepare_corpus(lines, opts, ids=["file"]).output


def chat_messages_stream(lines: DataFrame, opts: ChatOptions = ChatOptions()) -> DataFrame:
    c = Q.classify_chats(lines)
    ok = Q.ok_rows(c, "items", ["file"])
    return to_messages(ok, "items", opts.role_map, opts.system_prompt).drop("items")


def start_corpus_stream(spark: SparkSession, in_path: str, out_path: str, checkpoint: str,
                        opts: CorpusOptions = CorpusOptions(), available_now: bool = True,
                        processing_time: str | None = None, max_files_per_trigger: int | None = None) -> StreamingQuery:
    """D1 as a stream: chunk JSONL files ``{"text": chunk}`` under ``out_path``."""
    chunks = corpus_chunks_stream(read_line_stream(spark, in_path, max_files_per_trigger), opts).select("text")
    w = chunks.writeStream.format("json").option("path", out_path).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time or "1 minute")
    return w.start()


def start_chat_stream(spark: SparkSession, in_path: str, out_path: str, checkpoint: str,
                      opts: ChatOptions = ChatOptions(), available_now: bool = True,
                      processing_time: str | None = None) -> StreamingQuery:
    """D2 as a stream: one JSON array of messages per line under ``out_path``."""
    msgs = chat_messages_stream(read_line_stream(spark, in_path), opts)
    out = msgs.select(messages_json("messages").alias("value"))
    w = out.writeStream.format("text").option("path", out_path).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time or "1 minute")
    return w.start()


def start_counters_stream(spark: SparkSession, in_path: str, table_path: str, checkpoint: str,
                          chat: bool = False, max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Per-micro-batch outcome counters appended to a parquet table
    (``batch_id, outcome, n``) with ``foreachBatch``; idempotent per batch id."""
    lines = read_line_stream(spark, in_path, max_files_per_trigger)
    c = Q.classify_chats(lines) if chat else Q.classify_corpus(lines)

    def write(batch: DataFrame, batch_id: int) -> None:
        (Q.run_counters(batch).withColumn("batch_id", F.lit(batch_id))
         .write.mode("overwrite").parquet(f"{table_path}/batch_id={batch_id}"))

    return (c.select("outcome").writeStream.foreachBatch(write)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def _minutes_left(key, batches, state):
    """State of a run: its start time, and the steps that came before it was known."""
    import pandas as pd

    run, = key
    start, waiting = state.get if state.exists else (None, "[]")
    rows = pd.concat([pd.DataFrame(json.loads(waiting), columns=["step", "steps_per_epoch", "micros"]),
                      *(b[["step", "steps_per_epoch", "micros"]] for b in batches)])
    first = rows.loc[rows["step"] == 0, "micros"]
    if start is None and len(first):
        start = int(first.min())
    if start is None:
        state.update((None, rows.to_json(orient="values")))
        return
    state.update((start, "[]"))
    spent = (rows["micros"].astype("float64") - start) / 1e6
    left = (spent / (rows["step"] + 1) * rows["steps_per_epoch"]) // 60 - spent // 60
    yield pd.DataFrame({"run": run, "step": rows["step"].astype("int64"), "spent_sec": spent,
                        "minutes_left": left.astype("int64")})


def progress_stream(metrics: DataFrame, run: str = "run", step: str = "step",
                    steps_per_epoch: str = "steps_per_epoch", ts: str = "ts") -> DataFrame:
    """Minutes left at every logged step of a stream of metrics, from event times:
    ``(run, step, spent_sec, minutes_left)``. A run starts at its step 0; the state of a run
    is that time, and the steps that arrive before it, so order of arrival does not matter."""
    ship_package(metrics.sparkSession)
    m = metrics.select(F.col(run).cast("long").alias("run"), F.col(step).cast("long").alias("step"),
                       F.col(steps_per_epoch).cast("long").alias("steps_per_epoch"), F.unix_micros(F.col(ts).cast("timestamp")).alias("micros"))
    return m.groupBy("run").applyInPandasWithState(
        _minutes_left, "run long, step long, spent_sec double, minutes_left long", "start long, waiting string",
        "append", "NoTimeout")


def start_progress_stream(metrics: DataFrame, out_path: str, checkpoint: str) -> StreamingQuery:
    """``progress_stream`` appended to parquet files under ``out_path``."""
    return (progress_stream(metrics).writeStream.format("parquet").option("path", out_path)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
