"""Batch = stream for D1/D2; line numbering; sinks read back intact."""

import json
import os
import tempfile

from pyspark.sql import functions as F

from tessera.plans import jobs as JB
from tessera.sinks import write_chunks, write_messages
from tessera.sources import read_chunks, read_lines, read_messages
from tessera.streaming import start_chat_stream, start_corpus_stream

CORPUS = ['{"text":"' + "ab" * 400 + '"}', "", '{"nt":1}', "{bad", '{"text":"short"}', '[1]',
          '{"text":"' + "é😀" * 300 + '"}']
CHATS = ['{"conversations":[{"from":"human","value":"h"},{"from":"assistant","value":null}]}',
         '{"conversations":[]}', '{"other":1}', '{"conversations":[{"from":"x","value":"z"}]}']


def _write(dirpath, name, lines):
    os.makedirs(dirpath, exist_ok=True)
    with open(os.path.join(dirpath, name), "w", encoding="utf-8") as f:
        f.write("\n".join(lines) + "\n")


def test_line_numbers(spark):
    d = tempfile.mkdtemp(prefix="tessera-lines-")
    _write(d, "a.jsonl", CORPUS)
    _write(d, "b.jsonl", CHATS)
    rows = read_lines(spark, d, number=True).collect()
    by = {}
    for r in rows:
        by.setdefault(os.path.basename(r.file), []).append((r.line_id, r.value))
    assert sorted(by["a.jsonl"]) == [(i + 1, v) for i, v in enumerate(CORPUS)]
    assert sorted(by["b.jsonl"]) == [(i + 1, v) for i, v in enumerate(CHATS)]


def test_corpus_batch_equals_stream(spark):
    d = tempfile.mkdtemp(prefix="tessera-stream-")
    _write(os.path.join(d, "in"), "part1.jsonl", CORPUS[:4])
    _write(os.path.join(d, "in"), "part2.jsonl", CORPUS[4:])
    q = start_corpus_stream(spark, os.path.join(d, "in"), os.path.join(d, "out"), os.path.join(d, "ckpt"))
    q.awaitTermination(120)
    streamed = sorted(r.text for r in read_chunks(spark, os.path.join(d, "out")).collect())
    lines = read_lines(spark, os.path.join(d, "in"), number=True)
    r = JB.prepare_corpus(lines)
    batch = sorted(x.text for x in r.output.collect())
    assert streamed == batch and len(batch) == 5
    assert {x.outcome: x.n for x in r.counters.collect()} == {"ok": 3, "skip": 1, "error": 2, "blank": 1}


def test_chat_batch_equals_stream_and_sink_roundtrip(spark):
    d = tempfile.mkdtemp(prefix="tessera-chat-")
    _write(os.path.join(d, "in"), "c.jsonl", CHATS)
    q = start_chat_stream(spark, os.path.join(d, "in"), os.path.join(d, "out"), os.path.join(d, "ckpt"))
    q.awaitTermination(120)
    streamed = sorted(json.dumps(r.messages and [m.asDict() for m in r.messages])
                      for r in read_messages(spark, os.path.join(d, "out")).collect())
    r = JB.prepare_chats(read_lines(spark, os.path.join(d, "in"), number=True))
    write_messages(r.output, os.path.join(d, "batch"))
    batch = sorted(json.dumps([m.asDict() for m in x.messages])
                   for x in read_messages(spark, os.path.join(d, "batch")).collect())
    assert streamed == batch and len(batch) == 3
    assert any('"content": null' in b for b in batch)  # null content kept through the sink


def test_chunk_sink_roundtrip(spark):
    d = tempfile.mkdtemp(prefix="tessera-chunks-")
    df = spark.createDataFrame([("a\\n\"b\" é",), ("x",)], "text string")
    write_chunks(df, os.path.join(d, "o"))
    assert sorted(r.text for r in read_chunks(spark, os.path.join(d, "o")).collect()) == sorted(["a\\n\"b\" é", "x"])


def test_preparation_jobs_have_no_exchange(spark):
    d = tempfile.mkdtemp(prefix="tessera-plan-")
    _write(d, "a.jsonl", CORPUS)
    lines = spark.read.text(d).withColumn("line_id", F.monotonically_increasing_id())
    for out in (JB.prepare_corpus(lines).output, JB.prepare_chats(lines).output):
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan


def test_streaming_counters(spark):
    from tessera.streaming import start_counters_stream
    d = tempfile.mkdtemp(prefix="tessera-counters-")
    _write(os.path.join(d, "in"), "a.jsonl", CORPUS)
    q = start_counters_stream(spark, os.path.join(d, "in"), os.path.join(d, "tbl"), os.path.join(d, "ckpt"))
    q.awaitTermination(120)
    got = {}
    for r in spark.read.parquet(os.path.join(d, "tbl")).collect():
        got[r.outcome] = got.get(r.outcome, 0) + r.n
    assert got == {"ok": 3, "skip": 1, "error": 2, "blank": 1}


def test_progress_stream_waits_for_the_start_of_a_run(spark, tmp_path):
    from tessera.streaming.streams import start_progress_stream

    rows = [(1, 0, 100, 0), (1, 9, 100, 60), (2, 4, 10, 700), (2, 0, 10, 100), (3, 5, 10, 50)]
    schema = "run long, step long, steps_per_epoch long, sec long"
    for i in (1, 2, 0, 3, 4):  # steps before their run's start, one file a batch
        df = spark.createDataFrame([rows[i]], schema).selectExpr("run", "step", "steps_per_epoch", "timestamp_seconds(sec) as ts")
        df.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", "1").parquet(str(tmp_path / "in"))
    start_progress_stream(stream, str(tmp_path / "out"), str(tmp_path / "log")).awaitTermination()
    got = sorted(tuple(r) for r in spark.read.parquet(str(tmp_path / "out")).collect())
    assert got == [(1, 0, 0.0, 0), (1, 9, 60.0, 9), (2, 0, 0.0, 0), (2, 4, 600.0, 10)]  # run 3 has no start
