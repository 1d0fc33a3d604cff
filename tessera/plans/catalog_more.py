"""More registered queries: edge lines, rejects of files, layouts for loaders, runs of
several epochs, streams with restarts and state, prompts and outputs as files."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators import batching as B
from ..operators import masks as M
from ..operators import quality as Q
from ..operators import scoring as S
from ..operators import tokens as TK
from ..options import (BATCH_SIZE, MAX_LENGTH, SEED, SPECIAL_TOKENS, CorpusOptions, RunOptions)
from ..session import run_folder
from ..sinks.writers import read_batch_files, write_batch_files, write_generations
from ..sources.lines import expand_file_prompts, read_chunks, read_lines, read_messages, read_table
from ..sources.vocab import byte_vocab
from ..streaming.streams import (start_chat_stream, start_corpus_stream, start_counters_stream, start_progress_stream)
from ..operators import chat as C
from . import catalog as K
from . import jobs as JB
from . import samples as SP


# --------------------------------------------------------------------------
# lines that only the strict route can judge
# --------------------------------------------------------------------------
#: kind, text before and after the turn's text as JSON, outcome and reason
_ODD = [
    ("trailing", '{"text":', "} junk", "error", "json"),
    ("two_objects", '{"text":"a"}{"text":', "}", "error", "json"),
    ("listed", '{"text":', '},{"text":"b"}', "error", "json"),
    ("last_wins", '{"text":5,"text":', "}", "ok", None),
    ("last_is_number", '{"text":', ',"text":5}', "error", "type:BIGINT"),
    ("not_a_number", '{"x":NaN,"text":', "}", "ok", None),
    ("infinity", '{"text":', ',"x":-Infinity}', "ok", None),
    ("nested_twice", '{"x":{"y":1,"y":2},"text":', "}", "ok", None),
    ("single_quotes", "{'text':", "}", "error", "json"),
    ("comma", '{"text":', ",}", "error", "json"),
    ("plain", '{"text":', "}", "ok", None),
]


def q_strict_outcomes(spark: SparkSession, sf: str) -> DataFrame:
    """Every turn in eleven spellings, most of which the first parser cannot judge."""
    text = F.get_json_object(F.to_json(F.struct("text")), "$.text")
    quoted = F.expr("substring(j_, 9, length(j_) - 9)")  # of {"text":...}
    kinds = F.array(*[F.struct(F.lit(k).alias("kind"), F.concat(F.lit(a), quoted, F.lit(b)).alias("value"))
                      for k, a, b, _, _ in _ODD])
    t = (K._turns(spark, sf).select("conv_id", "turn", text.alias("text")).withColumn("j_", F.to_json(F.struct("text")))
         .select("conv_id", "turn", F.explode(kinds).alias("k")).select("conv_id", "turn", "k.*"))
    c = Q.classify_corpus(t)
    return c.select("conv_id", "turn", "kind", "outcome", "reason", F.length("text").cast("long").alias("n_chars"))


def _sql_strict() -> str:
    def lit(x):
        return "CAST(NULL AS VARCHAR)" if x is None else f"'{x}'"

    rows = ", ".join(f"('{k}', '{o}', {lit(r)})" for k, _, _, o, r in _ODD)
    ok = f"regexp_matches(c.text, '{K.NOT_BLANK_RX}')"
    return f"""
SELECT c.conv_id, c.turn, k.kind, CASE WHEN k.outcome = 'ok' AND NOT {ok} THEN 'skip' ELSE k.outcome END AS outcome, k.reason,
       CASE WHEN k.outcome = 'ok' AND {ok} THEN length(c.text) END AS n_chars
FROM conversations c, (VALUES {rows}) k(kind, outcome, reason)"""


def q_corpus_file_rejects(spark: SparkSession, sf: str) -> DataFrame:
    """All rejects of the file job; each one's file and line number must lead back to its line."""
    src = K._as_files(K._corpus_lines(spark, sf), "corpus-lines")
    job = JB.corpus_file_job(spark, src, run_folder(spark, "chunks"), CorpusOptions())
    lines = read_lines(spark, src, number=True).select(
        "file", "line_id", F.substring(Q.strip_blank(F.col("value")), 1, 50).alias("there"))
    found = job.rejects.join(lines, ["file", "line_id"], "left")
    return found.select("reason", "excerpt", F.coalesce(F.col("excerpt") == F.col("there"), F.lit(False)).alias("same_line"))


SQL_CORPUS_FILE_REJECTS = "WITH " + K._SQL_LINES + """
SELECT reason, substring(sv, 1, 50) AS excerpt, true AS same_line FROM cl WHERE outcome = 'error'
"""


# --------------------------------------------------------------------------
# vocabulary, masks, draws
# --------------------------------------------------------------------------
def q_token_usage(spark: SparkSession, sf: str) -> DataFrame:
    """The vocabulary table with each token's number of uses in the documents."""
    ids = TK.encode(K._docs(spark, sf).select("text"), "text", "ids").select(F.explode("ids").alias("token_id"))
    used = ids.groupBy("token_id").agg(F.count(F.lit(1)).alias("n"))
    hexed = F.hex(F.encode("piece", "ISO-8859-1"))
    return (byte_vocab(spark).join(used, "token_id", "left")
            .select("token_id", "kind", F.when(F.col("kind") == "byte", hexed).otherwise(F.col("piece")).alias("piece"),
                    F.coalesce("n", F.lit(0).cast("long")).alias("n_used")))


SQL_TOKEN_USAGE = f"""
WITH {K._d_encode("SELECT doc_id, text FROM documents", "doc_id", "text", "e")},
v AS (SELECT CAST(id AS INTEGER) AS token_id, 'byte' AS kind, lpad(hex(b), 2, '0') AS piece FROM e_bt
      UNION ALL SELECT i - 1, 'special', t FROM (SELECT unnest({list(SPECIAL_TOKENS)}) AS t, unnest(range(1, {len(SPECIAL_TOKENS) + 1})) AS i)),
u AS (SELECT id, count(*) AS n FROM e GROUP BY id)
SELECT CAST(v.token_id AS INTEGER) AS token_id, kind, piece, coalesce(n, 0) AS n_used FROM v LEFT JOIN u ON u.id = v.token_id
"""


def q_answer_mask_long(spark: SparkSession, sf: str) -> DataFrame:
    """The answer mask by the relational form over one row per position."""
    d = TK.fit_length(TK.encode(K._chat_text(spark, sf), "text", "ids"), "ids", MAX_LENGTH)
    long = M.span_mask_long(d.select("conv_id", F.posexplode("ids").alias("pos", "id")), "conv_id")
    marks = long.where("pos >= 1").groupBy("conv_id").agg(
        F.sum("mark").cast("int").alias("n_marked"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "mark"))), lambda x: x["mark"].cast("string")), " ")
        .alias("mask_text"))
    return marks


SQL_ANSWER_MASK_LONG = f"SELECT conv_id, n_marked, mask_text FROM ({K.SQL_ANSWER_MASK})"

MANY_DRAWS = 1000


def q_many_draws(spark: SparkSession, sf: str) -> DataFrame:
    """MANY_DRAWS draws for every context from its cumulative probabilities."""
    return S.draw_many(K._bigram(spark, sf), "prev_id", "next_id", "score", MANY_DRAWS, SEED, K.SAMPLE_TEMPERATURE, K.SAMPLE_TOP_K)


SQL_MANY_DRAWS = K._SQL_SCORES + f""",
kt AS (
  SELECT prev_id, next_id, score / {K.SAMPLE_TEMPERATURE} AS s FROM (
    SELECT *, rank() OVER (PARTITION BY prev_id ORDER BY score DESC) AS r FROM sc) WHERE r <= {K.SAMPLE_TOP_K}),
wt AS (SELECT prev_id, next_id, exp(s - max(s) OVER (PARTITION BY prev_id)) AS w FROM kt),
cm AS (SELECT prev_id, next_id, sum(w) OVER (PARTITION BY prev_id ORDER BY next_id ROWS UNBOUNDED PRECEDING) AS c FROM wt),
cx AS (SELECT prev_id, next_id, c / max(c) OVER (PARTITION BY prev_id) AS x FROM cm),
dr AS (
  SELECT prev_id, CAST(d.draw AS INTEGER) AS draw,
    (('0x' || substring(md5('{SEED}:' || prev_id || ':' || d.draw), 1, 13))::BIGINT + 0.5) / {float(2 ** 52)} AS u
  FROM (SELECT DISTINCT prev_id FROM cx), range({MANY_DRAWS}) d(draw))
SELECT dr.prev_id, dr.draw, cx.next_id FROM dr ASOF JOIN cx ON dr.prev_id = cx.prev_id AND dr.u <= cx.x
"""


# --------------------------------------------------------------------------
# loader layout, several epochs
# --------------------------------------------------------------------------
LAYOUT_BATCHES = 8


def q_batch_files(spark: SparkSession, sf: str) -> DataFrame:
    """Samples laid out for a loader and read back through the batch index: the files that
    hold a batch, its samples in order, and their ids. Chunks get their places in the run as
    texts; the tasks that write the files make their samples."""
    keys = ["doc_id", "chunk_no"]
    chunks = K._chunks(spark, sf).select(*keys, F.col("chunk").alias("text"))
    batches, _ = JB.plan_run(chunks, keys, RunOptions())
    path = run_folder(spark, "samples")
    index = write_batch_files(batches.select(*keys, "epoch", "batch_id", "batch_pos", "text"), path, LAYOUT_BATCHES,
                              build=lambda laid: SP.pretrain_samples(laid, "text").drop("n_real"))
    total = F.aggregate("x", F.lit(0).cast("long"), lambda a, i: a + i)
    back = (read_batch_files(spark, path).groupBy("epoch", "batch_id")
            .agg(F.sum(total).alias("id_sum"), F.max("batch_pos").cast("long").alias("last_pos")))
    files = index.groupBy("epoch", "batch_id").agg(F.count(F.lit(1)).alias("n_files"), F.sum("n_samples").alias("n_samples"))
    return files.join(back, ["epoch", "batch_id"]).select("batch_id", "n_files", "n_samples", "id_sum", "last_pos")


SQL_BATCH_FILES = K._SQL_PADDED + f""",
o AS (
  SELECT doc_id, chunk_no, row_number() OVER (ORDER BY md5('{SEED}:0:' || doc_id || ':' || chunk_no), doc_id, chunk_no) - 1 AS idx
  FROM k),
t AS (SELECT doc_id, chunk_no, sum(id) AS s FROM p WHERE pos < {MAX_LENGTH - 1} GROUP BY doc_id, chunk_no)
SELECT idx // {BATCH_SIZE} AS batch_id, CAST(1 AS BIGINT) AS n_files, count(*) AS n_samples, CAST(sum(s) AS BIGINT) AS id_sum,
       count(*) - 1 AS last_pos
FROM o JOIN t USING (doc_id, chunk_no) GROUP BY 1
"""

EPOCH_OPTS = RunOptions(epochs=3)


def q_epoch_updates(spark: SparkSession, sf: str) -> DataFrame:
    """Three epochs, each in its own order: the batch of every sample and the update that
    uses its gradient (null: behind the last update, lost)."""
    keys = ["doc_id", "chunk_no"]
    chunks = K._chunks(spark, sf).select(*keys)
    batches, _ = JB.plan_run(chunks, keys, EPOCH_OPTS)
    per = B.steps_per_epoch(chunks.count(), EPOCH_OPTS.batch_size)
    return B.update_numbers(batches, per, EPOCH_OPTS, step="batch_id").select(*keys, "epoch", "batch_id", "batch_pos", "update_no")


SQL_EPOCH_UPDATES = f"""
WITH c AS ({K.SQL_CHUNK_TEXT}),
o AS (
  SELECT doc_id, chunk_no, CAST(e.epoch AS INTEGER) AS epoch,
         row_number() OVER (PARTITION BY e.epoch ORDER BY md5('{SEED}:' || e.epoch || ':' || doc_id || ':' || chunk_no), doc_id, chunk_no) - 1 AS idx
  FROM c, range({EPOCH_OPTS.epochs}) e(epoch)),
b AS (SELECT *, idx // {BATCH_SIZE} AS batch_id, CAST(idx % {BATCH_SIZE} AS INTEGER) AS batch_pos FROM o),
st AS (SELECT DISTINCT epoch, batch_id FROM b),
up AS (SELECT epoch, batch_id, row_number() OVER (ORDER BY epoch, batch_id) - 1 AS update_no
       FROM st WHERE (batch_id + 1) % {EPOCH_OPTS.accumulation_steps} = 0),
us AS (SELECT st.epoch, st.batch_id, min(up.update_no) AS update_no FROM st
       LEFT JOIN up ON up.epoch > st.epoch OR (up.epoch = st.epoch AND up.batch_id >= st.batch_id) GROUP BY ALL)
SELECT doc_id, chunk_no, b.epoch, b.batch_id, batch_pos, us.update_no FROM b JOIN us ON us.epoch = b.epoch AND us.batch_id = b.batch_id
"""


# --------------------------------------------------------------------------
# streams: restart in mid-input, counters, chats, progress
# --------------------------------------------------------------------------
def _stopped_after_one_batch(start) -> None:
    """Start a stream, stop it once a batch is through (wherever the next one is then)."""
    q = start()
    while q.isActive and q.lastProgress is None:
        time.sleep(0.05)
    q.stop()


def q_stream_restart(spark: SparkSession, sf: str) -> DataFrame:
    """The corpus stream, one file a batch, stopped in mid-input and started again."""
    src = K._as_files(K._corpus_lines(spark, sf), "corpus-lines")
    out, log = run_folder(spark, "chunks"), run_folder(spark, "stream-log")

    def start():
        return start_corpus_stream(spark, src, out, log, max_files_per_trigger=1)

    _stopped_after_one_batch(start)
    start().awaitTermination()
    return read_chunks(spark, out).select("text")


def q_stream_counters(spark: SparkSession, sf: str) -> DataFrame:
    """Outcome counters per micro-batch, stopped and started again: a batch that is run
    twice replaces its own rows."""
    src = K._as_files(K._corpus_lines(spark, sf), "corpus-lines")
    out, log = run_folder(spark, "counters"), run_folder(spark, "stream-log")

    def start():
        return start_counters_stream(spark, src, out, log, max_files_per_trigger=2)

    _stopped_after_one_batch(start)
    start().awaitTermination()
    return spark.read.parquet(out).groupBy("outcome").agg(F.sum("n").alias("n"))


SQL_STREAM_COUNTERS = "WITH " + K._SQL_LINES + """
SELECT outcome, CAST(count(*) AS BIGINT) AS n FROM cl GROUP BY outcome
"""


def q_chat_stream(spark: SparkSession, sf: str) -> DataFrame:
    """D2 as a stream, rendered."""
    src = K._as_files(K._chat_lines(spark, sf), "chat-lines")
    out = run_folder(spark, "messages")
    start_chat_stream(spark, src, out, run_folder(spark, "stream-log")).awaitTermination()
    return C.render_messages(read_messages(spark, out), "messages", out="text").select("text")


LOG_EVERY = 5


def q_progress_minutes(spark: SparkSession, sf: str) -> DataFrame:
    """Every user's events as the steps of a run, every fifth one logged: minutes left at
    each, from a stream with one state per run."""
    e = read_table(spark, sf, "events").where("user_id is not null and ts is not null")
    order = Window.partitionBy("user_id").orderBy("ts", "event_id")
    e = e.select(F.col("user_id").alias("run"), "ts", (F.row_number().over(order) - 1).cast("long").alias("step"),
                 F.count(F.lit(1)).over(Window.partitionBy("user_id")).alias("steps_per_epoch"))
    src, out = run_folder(spark, "metrics"), run_folder(spark, "progress")
    e.where(F.col("step") % LOG_EVERY == 0).write.parquet(src)
    schema = spark.read.parquet(src).schema
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", "4").parquet(src)
    start_progress_stream(stream, out, run_folder(spark, "stream-log")).awaitTermination()
    return spark.read.parquet(out).select("run", "step", F.round("spent_sec", 6).alias("spent_sec"), "minutes_left")


SQL_PROGRESS_MINUTES = f"""
WITH s AS (
  SELECT user_id AS run, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS step,
         count(*) OVER (PARTITION BY user_id) AS per,
         (epoch_us(ts) - min(epoch_us(ts)) OVER (PARTITION BY user_id)) / 1e6 AS spent
  FROM events WHERE user_id IS NOT NULL AND ts IS NOT NULL)
SELECT run, step, round(spent, 6) AS spent_sec,
       CAST(floor(spent / (step + 1) * per / 60) - floor(spent / 60) AS BIGINT) AS minutes_left
FROM s WHERE step % {LOG_EVERY} = 0
"""


# --------------------------------------------------------------------------
# prompts from files, generations as files
# --------------------------------------------------------------------------
def q_file_prompts(spark: SparkSession, sf: str) -> DataFrame:
    """Every benchmark item as a file of its own, named by a ``FILE:`` prompt."""
    items = read_table(spark, sf, "benchmark").select("item_id", F.col("text").alias("value"))
    path = run_folder(spark, "prompts")
    items.repartition("item_id").write.partitionBy("item_id").text(path)
    named = spark.read.text(path, wholetext=True).select(
        F.col("item_id").cast("long").alias("prompt_id"), F.concat(F.lit("FILE:"), F.col("_metadata.file_path")).alias("prompt"))
    return expand_file_prompts(spark, named).select("prompt_id", "prompt")


SQL_FILE_PROMPTS = "SELECT CAST(item_id AS BIGINT) AS prompt_id, text || chr(10) AS prompt FROM benchmark"


def q_generation_files(spark: SparkSession, sf: str) -> DataFrame:
    """Every assistant turn as a generation of its conversation, written and read back."""
    t = K._turns(spark, sf).where("role = 'assistant'")
    path = run_folder(spark, "generations")
    write_generations(t.select(F.col("conv_id").alias("prompt_id"), F.col("turn").cast("int").alias("sample_no"), "text"), path)
    return spark.read.schema("prompt_id long, sample_no int, text string").json(path)


SQL_GENERATION_FILES = """
SELECT CAST(conv_id AS BIGINT) AS prompt_id, CAST(turn AS INTEGER) AS sample_no, text FROM conversations WHERE role = 'assistant'
"""

QUERIES = {
    "strict_outcomes": q_strict_outcomes,
    "corpus_file_rejects": q_corpus_file_rejects,
    "token_usage": q_token_usage,
    "answer_mask_long": q_answer_mask_long,
    "many_draws": q_many_draws,
    "batch_files": q_batch_files,
    "epoch_updates": q_epoch_updates,
    "stream_restart": q_stream_restart,
    "stream_counters": q_stream_counters,
    "chat_stream": q_chat_stream,
    "progress_minutes": q_progress_minutes,
    "file_prompts": q_file_prompts,
    "generation_files": q_generation_files,
}

ORACLE = {
    "strict_outcomes": _sql_strict(),
    "corpus_file_rejects": SQL_CORPUS_FILE_REJECTS,
    "token_usage": SQL_TOKEN_USAGE,
    "answer_mask_long": SQL_ANSWER_MASK_LONG,
    "many_draws": SQL_MANY_DRAWS,
    "batch_files": SQL_BATCH_FILES,
    "epoch_updates": SQL_EPOCH_UPDATES,
    "stream_restart": K.SQL_CORPUS_STREAM,
    "stream_counters": SQL_STREAM_COUNTERS,
    "chat_stream": K.SQL_CHAT_FILES,
    "progress_minutes": SQL_PROGRESS_MINUTES,
    "file_prompts": SQL_FILE_PROMPTS,
    "generation_files": SQL_GENERATION_FILES,
}
