"""Registered queries over the prepared tables and their DuckDB oracles.

Each query takes ``(spark, sf_dir)`` and returns a DataFrame over whole
tables. The oracle SQL computes the same rows in DuckDB; column names match.
Driver-table mapping: ``documents.text`` is the corpus, ``conversations``
(ordered by ``turn``) the chat file with ``role`` as the speaker,
``embeddings`` the id-to-vector table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import arrays as A
from ..functions.text import blank_class
from ..operators import chat as C
from ..operators import masks as M
from ..operators import text as T
from ..operators import tokens as TK
from ..operators import batching as B
from ..operators import beam as BM
from ..operators import bpe as BPE
from ..operators import lookup as L
from ..operators import scoring as S
from . import jobs as JB
from . import samples as SP
from ..options import (BATCH_SIZE, SEED, ChatOptions, CorpusOptions, SelectOptions, RunOptions, BOS_TOKEN, CHUNK_WIDTH, GENERATION_PROMPT, MAX_LENGTH, PAD_ID, PREPARE_SYSTEM_PROMPT,
                       SAMPLING_SYSTEM_PROMPT, SPECIAL_TOKENS, FIRST_MERGE_ID)
from ..session import cut_lineage, run_folder
from ..sinks.writers import append_metrics
from ..sources.lines import read_chunks, read_messages, read_prompts, read_table, spread
from ..streaming.streams import start_corpus_stream

# --------------------------------------------------------------------------
# SQL helpers for the oracles (DuckDB dialect)
# --------------------------------------------------------------------------
NOT_BLANK_RX = "[^" + blank_class() + "]"


def _dq(s: str) -> str:
    """DuckDB string literal; newlines spelled with chr(10)."""
    parts = s.split("\n")
    lits = ["'" + p.replace("'", "''") + "'" for p in parts]
    return " || chr(10) || ".join(lits) if len(lits) > 1 else lits[0]


def _dpiece(role_sql: str, content_sql: str) -> str:
    return (f"CASE WHEN {role_sql} IN ('system','user','assistant') THEN "
            f"'<|im_start|>' || {role_sql} || chr(10) || coalesce({content_sql}, 'None') "
            f"|| '<|im_end|>' || chr(10) ELSE '' END")


def _docs(spark, sf):
    return spread(read_table(spark, sf, "documents"), "doc_id")


def _turns(spark, sf):
    return read_table(spark, sf, "conversations")


# --------------------------------------------------------------------------
# corpus text
# --------------------------------------------------------------------------
def q_blank_filter(spark: SparkSession, sf: str) -> DataFrame:
    d = T.drop_blank(_docs(spark, sf).select("doc_id", "source", "text"))
    return d.select("doc_id", "source", F.length("text").cast("long").alias("text_chars"))


SQL_BLANK_FILTER = f"""
SELECT doc_id, source, length(text) AS text_chars
FROM documents WHERE regexp_matches(text, '{NOT_BLANK_RX}')
"""


def q_chunk_text(spark: SparkSession, sf: str) -> DataFrame:
    c = T.chunk_text(_docs(spark, sf).select("doc_id", "text"), "text", CHUNK_WIDTH)
    return c.select("doc_id", "chunk_no", F.length("chunk").cast("long").alias("chunk_chars"), "chunk")


_SQL_CHUNKS = f"""
WITH d AS (
  SELECT doc_id, source, text FROM documents WHERE regexp_matches(text, '{NOT_BLANK_RX}')
), p AS (
  SELECT doc_id, source, text,
         unnest(range(0, CAST(ceil(length(text) / {CHUNK_WIDTH}.0) AS BIGINT))) AS chunk_no
  FROM d
), c AS (
  SELECT doc_id, source, chunk_no, substring(text, chunk_no * {CHUNK_WIDTH} + 1, {CHUNK_WIDTH}) AS chunk
  FROM p
)
SELECT * FROM c WHERE regexp_matches(chunk, '{NOT_BLANK_RX}')
"""

SQL_CHUNK_TEXT = f"""
{_SQL_CHUNKS}
""".replace("SELECT * FROM c WHERE", "SELECT doc_id, chunk_no, length(chunk) AS chunk_chars, chunk FROM c WHERE")


def q_chunk_counts(spark: SparkSession, sf: str) -> DataFrame:
    c = T.chunk_text(_docs(spark, sf).select("source", "text"), "text", CHUNK_WIDTH)
    return T.chunk_counts(c, "source")


SQL_CHUNK_COUNTS = _SQL_CHUNKS.replace(
    "SELECT * FROM c WHERE regexp_matches(chunk, '" + NOT_BLANK_RX + "')",
    "SELECT source, count(*) AS n_chunks, CAST(sum(length(chunk)) AS BIGINT) AS n_chars FROM c "
    "WHERE regexp_matches(chunk, '" + NOT_BLANK_RX + "') GROUP BY source")


# --------------------------------------------------------------------------
# chats
# --------------------------------------------------------------------------
def q_to_messages(spark: SparkSession, sf: str) -> DataFrame:
    return C.messages_long(_turns(spark, sf))


SQL_TO_MESSAGES = f"""
SELECT DISTINCT conv_id, CAST(-1 AS BIGINT) AS seq, 'system' AS role, {_dq(PREPARE_SYSTEM_PROMPT)} AS content
FROM conversations
UNION ALL
SELECT conv_id, turn AS seq, role, text AS content
FROM conversations WHERE role IN ('user', 'assistant')
"""


def q_render_chat(spark: SparkSession, sf: str) -> DataFrame:
    return C.render_turns(_turns(spark, sf))


SQL_RENDER_CHAT = f"""
WITH m AS ({SQL_TO_MESSAGES})
SELECT conv_id, string_agg({_dpiece('role', 'content')}, '' ORDER BY seq) AS text
FROM m GROUP BY conv_id
"""


def q_render_prompt(spark: SparkSession, sf: str) -> DataFrame:
    p = _turns(spark, sf).filter(F.col("role") == "user").select("conv_id", "turn",
                                                                 F.col("text").alias("prompt"))
    return C.render_prompt(p, "prompt").select("conv_id", "turn", "text")


SQL_RENDER_PROMPT = f"""
SELECT conv_id, turn,
       {_dpiece("'system'", _dq(SAMPLING_SYSTEM_PROMPT))} || {_dpiece("'user'", 'text')}
       || {_dq(GENERATION_PROMPT)} AS text
FROM conversations WHERE role = 'user'
"""



# --------------------------------------------------------------------------
# tokens and samples
# --------------------------------------------------------------------------
_PUA = 57344  # private-use code points stand in for the special tokens in the oracle


def _d_encode(src: str, keys: str, text: str, tag: str) -> str:
    """DuckDB CTEs: ``{tag}`` = (keys, pos, id) for the text of ``src``.

    Character-level route: special tokens are first replaced by private-use
    characters, then each character becomes its special id or the ids of its
    UTF-8 bytes; byte ids come from a ranked 256-row table."""
    t = text
    for i, tok in enumerate(SPECIAL_TOKENS):
        t = f"replace({t}, '{tok}', chr({_PUA + i}))"
    return f"""
{tag}_bt AS (
  SELECT b, 4 + row_number() OVER (ORDER BY CASE WHEN b BETWEEN 33 AND 126 OR b BETWEEN 161 AND 172
                                               OR b BETWEEN 174 AND 255 THEN 0 ELSE 1 END, b) AS id
  FROM range(256) r(b)
), {tag}_s AS (
  SELECT {keys}, {t} AS t_ FROM ({src})
), {tag}_c AS (
  SELECT {keys}, ch, ci FROM {tag}_s, unnest(str_split(t_, '')) WITH ORDINALITY AS u(ch, ci)
  WHERE ch <> ''
), {tag}_b AS (
  SELECT {keys}, ci, 0 AS bi, unicode(ch) - {_PUA} AS id FROM {tag}_c
  WHERE unicode(ch) BETWEEN {_PUA} AND {_PUA + len(SPECIAL_TOKENS) - 1}
  UNION ALL
  SELECT {keys}, ci, bi, bt.id FROM (
    SELECT {keys}, ci, ch, unnest(range(0, octet_length(encode(ch)))) AS bi FROM {tag}_c
    WHERE NOT unicode(ch) BETWEEN {_PUA} AND {_PUA + len(SPECIAL_TOKENS) - 1}
  ) x JOIN {tag}_bt bt ON bt.b = ('0x' || substring(hex(encode(ch)), 2 * bi + 1, 2))::INTEGER
), {tag} AS (
  SELECT {keys}, row_number() OVER (PARTITION BY {keys} ORDER BY ci, bi) - 1 AS pos, id FROM {tag}_b
)"""


def _join_ids(col: str):
    return F.array_join(F.col(col), " ")


def q_byte_encode(spark: SparkSession, sf: str) -> DataFrame:
    d = TK.encode(_docs(spark, sf).select("doc_id", "text"), "text", "ids")
    return d.select("doc_id", F.size("ids").cast("long").alias("n_ids"), _join_ids("ids").alias("ids_text"))


SQL_BYTE_ENCODE = f"""
WITH {_d_encode("SELECT doc_id, text FROM documents", "doc_id", "text", "e")}
SELECT doc_id, count(*) AS n_ids, string_agg(CAST(id AS VARCHAR), ' ' ORDER BY pos) AS ids_text
FROM e GROUP BY doc_id
"""


def q_byte_decode(spark: SparkSession, sf: str) -> DataFrame:
    d = TK.encode(_docs(spark, sf).select("doc_id", "text"), "text", "ids")
    return TK.decode(d, "ids", "decoded").select("doc_id", "decoded")


SQL_BYTE_DECODE = "SELECT doc_id, text AS decoded FROM documents"


def _chunks(spark, sf):
    return T.chunk_text(_docs(spark, sf).select("doc_id", "text"), "text", CHUNK_WIDTH)


_SQL_CHUNK_SRC = ("SELECT doc_id, chunk_no, '" + BOS_TOKEN + "' || chunk AS t FROM ("
                  + SQL_CHUNK_TEXT + ")")


def _pretrain_fitted(spark, sf):
    d = C.with_bos(_chunks(spark, sf), "chunk", out="t")
    d = TK.encode(d.select("doc_id", "chunk_no", "t"), "t", "ids")
    return TK.fit_length(d, "ids", MAX_LENGTH, 0)


def q_pad_truncate(spark: SparkSession, sf: str) -> DataFrame:
    d = _pretrain_fitted(spark, sf)
    return d.select("doc_id", "chunk_no", F.col("n_real").cast("long").alias("n_real"), _join_ids("ids").alias("ids_text"))


_SQL_PADDED = f"""
WITH {_d_encode(_SQL_CHUNK_SRC, "doc_id, chunk_no", "t", "e")},
k AS (SELECT doc_id, chunk_no, least(count(*), {MAX_LENGTH}) AS n_real FROM e GROUP BY doc_id, chunk_no),
p AS (
  SELECT k.doc_id, k.chunk_no, k.n_real, r.pos, coalesce(e.id, 0) AS id,
         CASE WHEN r.pos < k.n_real THEN 1 ELSE 0 END AS m
  FROM k CROSS JOIN range({MAX_LENGTH}) r(pos)
  LEFT JOIN e ON e.doc_id = k.doc_id AND e.chunk_no = k.chunk_no AND e.pos = r.pos
)"""

SQL_PAD_TRUNCATE = _SQL_PADDED + """
SELECT doc_id, chunk_no, n_real, string_agg(CAST(id AS VARCHAR), ' ' ORDER BY pos) AS ids_text
FROM p GROUP BY doc_id, chunk_no, n_real
"""


def q_pretrain_mask(spark: SparkSession, sf: str) -> DataFrame:
    d = M.real_mask(_pretrain_fitted(spark, sf), "n_real", MAX_LENGTH)
    return d.select("doc_id", "chunk_no", F.col("n_real").cast("long").alias("n_real"), _join_ids("loss_mask").alias("mask_text"))


SQL_PRETRAIN_MASK = _SQL_PADDED + """
SELECT doc_id, chunk_no, n_real, string_agg(CAST(m AS VARCHAR), ' ' ORDER BY pos) AS mask_text
FROM p GROUP BY doc_id, chunk_no, n_real
"""


def q_shift_xy(spark: SparkSession, sf: str) -> DataFrame:
    d = SP.pretrain_samples(_chunks(spark, sf).select("doc_id", "chunk_no", F.col("chunk").alias("text")),
                            "text", ["doc_id", "chunk_no"])
    return d.select("doc_id", "chunk_no", _join_ids("x").alias("x_text"), _join_ids("y").alias("y_text"),
                    _join_ids("loss_mask").alias("mask_text"))


SQL_SHIFT_XY = _SQL_PADDED + f"""
SELECT doc_id, chunk_no,
  string_agg(CAST(id AS VARCHAR), ' ' ORDER BY pos) FILTER (WHERE pos < {MAX_LENGTH - 1}) AS x_text,
  string_agg(CAST(id AS VARCHAR), ' ' ORDER BY pos) FILTER (WHERE pos >= 1) AS y_text,
  string_agg(CAST(m AS VARCHAR), ' ' ORDER BY pos) FILTER (WHERE pos >= 1) AS mask_text
FROM p GROUP BY doc_id, chunk_no
"""


def _chat_text(spark, sf):
    return C.render_turns(_turns(spark, sf))


def q_answer_mask(spark: SparkSession, sf: str) -> DataFrame:
    d = SP.chat_samples(_chat_text(spark, sf), messages=None, text="text", keys=["conv_id"])
    return d.select("conv_id", F.col("n_real").cast("long").alias("n_real"),
                    F.aggregate("loss_mask", F.lit(0), lambda a, x: a + x).alias("n_marked"),
                    _join_ids("loss_mask").alias("mask_text"))


def _d_header_match(tok: str = "id") -> str:
    hdr = [3, 69, 87, 87, 77, 87, 88, 69, 82, 88, 203]  # <|im_start|>, the bytes of "assistant", line feed
    h = len(hdr)
    conds = []
    for k, hid in enumerate(hdr):
        lagn = h - 1 - k
        ref = tok if lagn == 0 else f"lag({tok}, {lagn}) OVER (PARTITION BY conv_id ORDER BY pos)"
        conds.append(f"coalesce({ref} = {hid}, false)")
    return " AND ".join(conds)


SQL_ANSWER_MASK = f"""
WITH m AS ({SQL_TO_MESSAGES}),
ct AS (SELECT conv_id, string_agg({_dpiece('role', 'content')}, '' ORDER BY seq) AS text FROM m GROUP BY conv_id),
{_d_encode("SELECT conv_id, text FROM ct", "conv_id", "text", "e")},
k AS (SELECT conv_id, least(count(*), {MAX_LENGTH}) AS n_real FROM e GROUP BY conv_id),
p AS (
  SELECT k.conv_id, k.n_real, r.pos, coalesce(e.id, 0) AS id
  FROM k CROSS JOIN range({MAX_LENGTH}) r(pos)
  LEFT JOIN e ON e.conv_id = k.conv_id AND e.pos = r.pos
), h AS (
  SELECT *, {_d_header_match()} AS hdr,
         coalesce(sum(CASE WHEN id = 4 THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY pos
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS seg
  FROM p
), g AS (
  SELECT *, max(CASE WHEN hdr THEN seg END) OVER (PARTITION BY conv_id ORDER BY pos
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS hseg,
         max(CASE WHEN id = 4 THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY pos
                  ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS end_after
  FROM h
), mk AS (
  SELECT conv_id, n_real, pos, CASE WHEN hseg = seg AND end_after = 1 THEN 1 ELSE 0 END AS mark FROM g
)
SELECT conv_id, n_real,
  CAST(sum(mark) FILTER (WHERE pos >= 1) AS INTEGER) AS n_marked,
  string_agg(CAST(mark AS VARCHAR), ' ' ORDER BY pos) FILTER (WHERE pos >= 1) AS mask_text
FROM mk GROUP BY conv_id, n_real
"""



# --------------------------------------------------------------------------
# order, batches, plan
# --------------------------------------------------------------------------
def q_shuffle_batch(spark: SparkSession, sf: str) -> DataFrame:
    c = _chunks(spark, sf).select("doc_id", "chunk_no")
    b = B.assign_batches(c, ["doc_id", "chunk_no"], batch=BATCH_SIZE, epochs=1, seed=SEED)
    return b.select("doc_id", "chunk_no", "batch_id", "batch_pos")


SQL_SHUFFLE_BATCH = f"""
WITH c AS ({SQL_CHUNK_TEXT}),
o AS (
  SELECT doc_id, chunk_no,
         row_number() OVER (ORDER BY md5('{SEED}:0:' || doc_id || ':' || chunk_no), doc_id, chunk_no) - 1 AS idx
  FROM c
)
SELECT doc_id, chunk_no, idx // {BATCH_SIZE} AS batch_id, CAST(idx % {BATCH_SIZE} AS INTEGER) AS batch_pos FROM o
"""


def _plan_cols(df):
    return df.select("epoch", "step", "global_step", "steps_per_epoch",
                     F.round("lr", 12).alias("lr"), "is_update", "is_log", "is_save",
                     "is_tagged_save", "carries_over")


def q_run_plan(spark: SparkSession, sf: str) -> DataFrame:
    return _plan_cols(B.run_plan(spark, _chunks(spark, sf), RunOptions()))


def _sql_plan(o: RunOptions) -> str:
    base, floor, w = o.learning_rate, o.learning_rate / 10, o.warmup_iters
    warm = f"{base} * g / {w}" if w > 0 else "NULL"
    return f"""
WITH c AS ({SQL_CHUNK_TEXT}),
n AS (SELECT CAST(ceil(count(*) / {o.batch_size}.0) AS BIGINT) AS per FROM c),
s AS (SELECT r.g, n.per, n.per * {o.epochs} AS total FROM n, range(n.per * {o.epochs}) r(g)),
t AS (
  SELECT CAST(g // per AS INTEGER) AS epoch, g % per AS step, g AS global_step, per AS steps_per_epoch,
    CASE WHEN g < {w} THEN {warm}
         WHEN g > total THEN {floor}
         WHEN total = {w} THEN {floor}
         ELSE {floor} + 0.5 * (1 + cos(pi() * (g - {w}) / (total - {w}))) * ({base} - {floor}) END AS lr,
    per
  FROM s
)
SELECT epoch, step, global_step, steps_per_epoch, round(lr, 12) AS lr,
  (step + 1) % {o.accumulation_steps} = 0 AS is_update,
  step % {o.log_interval} = 0 AS is_log,
  (step + 1) % {o.save_interval} = 0 AS is_save,
  (step + 1) % {o.tagged_save_interval} = 0 AS is_tagged_save,
  step >= (per // {o.accumulation_steps}) * {o.accumulation_steps} AS carries_over
FROM t
"""


SQL_RUN_PLAN = _sql_plan(RunOptions())

LR_OPTS = RunOptions(epochs=2, warmup_iters=10)


def q_lr_schedule(spark: SparkSession, sf: str) -> DataFrame:
    return _plan_cols(B.run_plan(spark, _chunks(spark, sf), LR_OPTS)).select("global_step", "lr")


SQL_LR_SCHEDULE = "SELECT global_step, lr FROM (" + _sql_plan(LR_OPTS) + ")"


# --------------------------------------------------------------------------
# scores, selection, losses
# --------------------------------------------------------------------------
TOPK_TIES_K = 5
SAMPLE_TEMPERATURE = 0.7
SAMPLE_TOP_K = 40
NUM_SAMPLES = 3


def _samples(spark, sf):
    c = _chunks(spark, sf).select("doc_id", "chunk_no", F.col("chunk").alias("text"))
    return SP.pretrain_samples(c, "text", ["doc_id", "chunk_no"])


def _bigram(spark, sf):
    return S.bigram_scores(S.pairs_from_samples(_samples(spark, sf)))


def q_bigram_scores(spark: SparkSession, sf: str) -> DataFrame:
    return _bigram(spark, sf).select("prev_id", "next_id", "n", F.round("score", 9).alias("score"))


_SQL_SCORES = _SQL_PADDED + """,
pr AS (
  SELECT id AS prev_id,
         lead(id) OVER (PARTITION BY doc_id, chunk_no ORDER BY pos) AS next_id,
         lead(m) OVER (PARTITION BY doc_id, chunk_no ORDER BY pos) AS m1
  FROM p
), bg AS (
  SELECT CAST(prev_id AS INTEGER) AS prev_id, CAST(next_id AS INTEGER) AS next_id, count(*) AS n
  FROM pr WHERE m1 = 1 GROUP BY 1, 2
), sc AS (
  SELECT prev_id, next_id, n, ln(n / sum(n) OVER (PARTITION BY prev_id)) AS score FROM bg
)"""

SQL_BIGRAM_SCORES = _SQL_SCORES + """
SELECT prev_id, next_id, n, round(score, 9) AS score FROM sc
"""


def q_topk_ties(spark: SparkSession, sf: str) -> DataFrame:
    d = S.top_k(_bigram(spark, sf), "prev_id", "next_id", "score", TOPK_TIES_K)
    return d.select("prev_id", "next_id", "rank")


SQL_TOPK_TIES = _SQL_SCORES + f"""
SELECT prev_id, next_id, rank FROM (
  SELECT prev_id, next_id, CAST(rank() OVER (PARTITION BY prev_id ORDER BY score DESC) AS INTEGER) AS rank
  FROM sc) WHERE rank <= {TOPK_TIES_K}
"""


def q_softmax(spark: SparkSession, sf: str) -> DataFrame:
    d = S.softmax_top_k(_bigram(spark, sf), "prev_id", "next_id", "score", SAMPLE_TOP_K,
                        SAMPLE_TEMPERATURE)
    return d.select("prev_id", "next_id", F.round("prob", 9).alias("prob"))


SQL_SOFTMAX = _SQL_SCORES + f""",
kt AS (
  SELECT prev_id, next_id, score / {SAMPLE_TEMPERATURE} AS s FROM (
    SELECT *, rank() OVER (PARTITION BY prev_id ORDER BY score DESC) AS r FROM sc) WHERE r <= {SAMPLE_TOP_K}
), mx AS (
  SELECT *, max(s) OVER (PARTITION BY prev_id) AS m FROM kt
)
SELECT prev_id, next_id, round(exp(s - m) / sum(exp(s - m)) OVER (PARTITION BY prev_id), 9) AS prob FROM mx
"""


def q_greedy_pick(spark: SparkSession, sf: str) -> DataFrame:
    return S.greedy(_bigram(spark, sf), "prev_id", "next_id", "score")


SQL_GREEDY_PICK = _SQL_SCORES + """
SELECT prev_id, next_id FROM (
  SELECT prev_id, next_id, row_number() OVER (PARTITION BY prev_id ORDER BY score DESC, next_id ASC) AS r
  FROM sc) WHERE r = 1
"""


def q_seeded_draw(spark: SparkSession, sf: str) -> DataFrame:
    return S.draw(_bigram(spark, sf), "prev_id", "next_id", "score", n=NUM_SAMPLES, seed=SEED,
                  temperature=SAMPLE_TEMPERATURE, k=SAMPLE_TOP_K)


SQL_SEEDED_DRAW = _SQL_SCORES + f""",
kt AS (
  SELECT prev_id, next_id, score FROM (
    SELECT *, rank() OVER (PARTITION BY prev_id ORDER BY score DESC) AS r FROM sc) WHERE r <= {SAMPLE_TOP_K}
), dr AS (
  SELECT kt.*, CAST(d.draw AS INTEGER) AS draw,
    (('0x' || substring(md5('{SEED}:' || prev_id || ':' || next_id || ':' || d.draw), 1, 13))::BIGINT + 0.5)
      / {float(2 ** 52)} AS u
  FROM kt, range({NUM_SAMPLES}) d(draw)
)
SELECT prev_id, draw, arg_max(next_id, score / {SAMPLE_TEMPERATURE} - ln(-ln(u))) AS next_id
FROM dr GROUP BY prev_id, draw
"""


def _sample_losses(spark, sf):
    return S.sample_losses(_samples(spark, sf), _bigram(spark, sf), ["doc_id", "chunk_no"])


def q_cross_entropy(spark: SparkSession, sf: str) -> DataFrame:
    return _sample_losses(spark, sf).select("doc_id", "chunk_no", F.round("loss_sum", 6).alias("loss_sum"),
                                            F.col("n_tokens").cast("long").alias("n_targets"))


_SQL_TOKEN_LOSS = _SQL_SCORES + """,
tg AS (
  SELECT doc_id, chunk_no, pos, id AS prev_id,
         lead(id) OVER (PARTITION BY doc_id, chunk_no ORDER BY pos) AS next_id,
         lead(m) OVER (PARTITION BY doc_id, chunk_no ORDER BY pos) AS mask
  FROM p
), lse AS (
  SELECT prev_id, max(score) + ln(sum(exp(score - mx))) AS lse FROM (
    SELECT *, max(score) OVER (PARTITION BY prev_id) AS mx FROM sc) GROUP BY prev_id
), tl AS (
  SELECT tg.doc_id, tg.chunk_no, tg.mask,
         CASE WHEN tg.next_id = 0 THEN 0.0 ELSE lse.lse - sc.score END AS loss
  FROM tg LEFT JOIN lse ON lse.prev_id = tg.prev_id
  LEFT JOIN sc ON sc.prev_id = tg.prev_id AND sc.next_id = tg.next_id
  WHERE tg.next_id IS NOT NULL
)"""

SQL_CROSS_ENTROPY = _SQL_TOKEN_LOSS + """
SELECT doc_id, chunk_no, round(sum(loss * mask), 6) AS loss_sum, CAST(sum(mask) AS BIGINT) AS n_targets
FROM tl GROUP BY doc_id, chunk_no
"""


def _batched(spark, sf, per_sample):
    """Batch numbers joined to per-sample sums: the order is made on keys alone."""
    keys = B.assign_batches(_chunks(spark, sf).select("doc_id", "chunk_no"), ["doc_id", "chunk_no"],
                            batch=BATCH_SIZE, epochs=1, seed=SEED).select("doc_id", "chunk_no", "batch_id")
    return per_sample.join(keys, ["doc_id", "chunk_no"])


def q_masked_loss(spark: SparkSession, sf: str) -> DataFrame:
    m = S.batch_losses(_batched(spark, sf, _sample_losses(spark, sf)))
    return m.select("batch_id", F.round("loss", 6).alias("loss"), F.col("n_tokens").cast("long").alias("n_tokens"),
                    F.col("n_unscored").cast("long").alias("n_unscored"))


SQL_MASKED_LOSS = _SQL_TOKEN_LOSS + f""",
o AS (
  SELECT doc_id, chunk_no,
         (row_number() OVER (ORDER BY md5('{SEED}:0:' || doc_id || ':' || chunk_no), doc_id, chunk_no) - 1)
           // {BATCH_SIZE} AS batch_id
  FROM (SELECT DISTINCT doc_id, chunk_no FROM p)
)
SELECT o.batch_id, round(sum(loss * mask) / sum(mask), 6) AS loss, CAST(sum(mask) AS BIGINT) AS n_tokens,
       CAST(0 AS BIGINT) AS n_unscored
FROM tl JOIN o USING (doc_id, chunk_no) GROUP BY o.batch_id
"""


UNSCORED_LOSS = 12.0


def q_held_out_loss(spark: SparkSession, sf: str) -> DataFrame:
    """Batches of ``documents`` under scores learned from ``benchmark``: targets
    without a score are counted, make the loss null, and cost ``UNSCORED_LOSS``
    in ``floored_loss``."""
    bench = read_table(spark, sf, "benchmark").select(
        F.col("item_id").alias("doc_id"), F.lit(0).cast("long").alias("chunk_no"), "text")
    scores = S.bigram_scores(S.pairs_from_samples(SP.pretrain_samples(bench, "text", ["doc_id", "chunk_no"])))
    both = S.sample_losses(_samples(spark, sf), scores, ["doc_id", "chunk_no"], UNSCORED_LOSS)
    m = (_batched(spark, sf, both).groupBy("batch_id")
         .agg(F.sum("loss_sum").alias("s"), F.sum("n_tokens").alias("n"), F.sum("n_unscored").alias("u")))
    return m.select("batch_id", F.when(F.col("u") == 0, F.round(F.col("s") / F.col("n"), 6)).alias("loss"),
                    F.round(F.col("s") / F.col("n"), 6).alias("floored_loss"),
                    F.col("n").cast("long").alias("n_tokens"), F.col("u").cast("long").alias("n_unscored"))


SQL_HELD_OUT_LOSS = _SQL_PADDED + f""",
{_d_encode("SELECT item_id, '" + BOS_TOKEN + "' || text AS t FROM benchmark", "item_id", "t", "be")},
bp AS (SELECT CAST(id AS INTEGER) AS prev_id, lead(id) OVER (PARTITION BY item_id ORDER BY pos) AS next_id
       FROM be WHERE pos < {MAX_LENGTH}),
bg AS (SELECT prev_id, CAST(next_id AS INTEGER) AS next_id, count(*) AS n FROM bp WHERE next_id IS NOT NULL GROUP BY 1, 2),
sc AS (SELECT prev_id, next_id, ln(n / sum(n) OVER (PARTITION BY prev_id)) AS score FROM bg),
lse AS (SELECT prev_id, max(score) + ln(sum(exp(score - mx))) AS lse FROM (
  SELECT *, max(score) OVER (PARTITION BY prev_id) AS mx FROM sc) GROUP BY prev_id),
tg AS (
  SELECT doc_id, chunk_no, id AS prev_id, lead(id) OVER (PARTITION BY doc_id, chunk_no ORDER BY pos) AS next_id,
         lead(m) OVER (PARTITION BY doc_id, chunk_no ORDER BY pos) AS mask FROM p),
tl AS (SELECT tg.doc_id, tg.chunk_no, lse.lse - sc.score AS loss FROM tg
  LEFT JOIN lse ON lse.prev_id = tg.prev_id
  LEFT JOIN sc ON sc.prev_id = tg.prev_id AND sc.next_id = tg.next_id WHERE mask = 1),
o AS (
  SELECT doc_id, chunk_no,
         (row_number() OVER (ORDER BY md5('{SEED}:0:' || doc_id || ':' || chunk_no), doc_id, chunk_no) - 1)
           // {BATCH_SIZE} AS batch_id
  FROM (SELECT DISTINCT doc_id, chunk_no FROM p))
SELECT o.batch_id, CASE WHEN count(*) = count(loss) THEN round(sum(loss) / count(*), 6) END AS loss,
       round(sum(coalesce(loss, {UNSCORED_LOSS})) / count(*), 6) AS floored_loss, count(*) AS n_tokens,
       count(*) - count(loss) AS n_unscored
FROM tl JOIN o USING (doc_id, chunk_no) GROUP BY o.batch_id
"""


# --------------------------------------------------------------------------
# decoding over the score table
# --------------------------------------------------------------------------
BEAM_WIDTH = 2
BEAM_STEPS = 8
GEN_STEPS = 16
STOP_ID = 18  # the full stop: it occurs in the score table
CHAT_STOP_ID = 4


def _prompts(spark, sf):
    """Plain prompts: BOS + each user turn, encoded (prompt_id = conv_id:turn)."""
    t = _turns(spark, sf).filter(F.col("role") == "user").select(
        F.concat_ws(":", "conv_id", "turn").alias("prompt_id"),
        F.concat(F.lit(BOS_TOKEN), F.col("text")).alias("t"))
    return TK.encode(t, "t", "ids").select("prompt_id", "ids")


def _scores9(spark, sf):
    """Bigram log-probabilities rounded to 9 places (a quantised score table)."""
    return _bigram(spark, sf).select("prev_id", "next_id", F.round("score", 9).alias("score"))


def q_beam_step(spark: SparkSession, sf: str) -> DataFrame:
    cands = L.checked_broadcast(cut_lineage(BM.candidate_table(_scores9(spark, sf), BEAM_WIDTH, normalise=False)))
    b = BM.beam_step(BM.init_beams(_prompts(spark, sf)), cands, BEAM_WIDTH)
    return b.select("prompt_id", "beam_rank", F.col("last_id").alias("next_id"),
                    F.round("score", 9).alias("score"))


def q_beam_search(spark: SparkSession, sf: str) -> DataFrame:
    b = BM.beam_search(_prompts(spark, sf), _scores9(spark, sf), BEAM_STEPS, BEAM_WIDTH,
                       stop_id=STOP_ID, normalise=False)
    return b.select("prompt_id", _join_ids("new_ids").alias("new_ids_text"),
                    F.round("score", 9).alias("score"))


def q_select_beam(spark: SparkSession, sf: str) -> DataFrame:
    """``select`` with several beams: temperature, top-k with ties and log-softmax."""
    opts = SelectOptions(max_new_tokens=BEAM_STEPS, num_beams=BEAM_WIDTH, stop_id=STOP_ID,
                         temperature=SAMPLE_TEMPERATURE, top_k=SAMPLE_TOP_K)
    g = JB.select(_prompts(spark, sf), _scores9(spark, sf), opts)
    return g.select("prompt_id", "sample_no", _join_ids("new_ids").alias("new_ids_text"))


def q_greedy_generate(spark: SparkSession, sf: str) -> DataFrame:
    opts = SelectOptions(max_new_tokens=GEN_STEPS, stop_id=STOP_ID)
    g = JB.select(_prompts(spark, sf), _scores9(spark, sf), opts)
    return g.select("prompt_id", "sample_no", _join_ids("new_ids").alias("new_ids_text"))


def q_sample_generate(spark: SparkSession, sf: str) -> DataFrame:
    opts = SelectOptions(max_new_tokens=GEN_STEPS, stop_id=STOP_ID, do_sample=True, temperature=SAMPLE_TEMPERATURE,
                         top_k=SAMPLE_TOP_K, num_samples=NUM_SAMPLES, seed=SEED)
    g = JB.select(_prompts(spark, sf), _scores9(spark, sf), opts)
    return g.select("prompt_id", "sample_no", _join_ids("new_ids").alias("new_ids_text"))


_SQL_DECODE_BASE = _SQL_SCORES + f""",
{_d_encode("SELECT conv_id || ':' || turn AS prompt_id, '" + BOS_TOKEN + "' || text AS t FROM conversations WHERE role = 'user'", "prompt_id", "t", "pe")},
pl AS (SELECT prompt_id, CAST(arg_max(id, pos) AS INTEGER) AS last_id FROM pe GROUP BY prompt_id),
sc9 AS (SELECT prev_id, next_id, round(score, 9) AS score FROM sc)"""


def _sql_beam_search(cands: str, out: str) -> str:
    parts = [_SQL_DECODE_BASE + f""",
lp AS ({cands}),
cands AS MATERIALIZED (
  SELECT prev_id, next_id, log_prob,
         row_number() OVER (PARTITION BY prev_id ORDER BY log_prob DESC, next_id) - 1 AS cand_rank
  FROM lp QUALIFY cand_rank < {BEAM_WIDTH}
),
b0 AS MATERIALIZED (
  SELECT prompt_id, 0 AS beam_rank, CAST([] AS INTEGER[]) AS toks, last_id, CAST(0.0 AS DOUBLE) AS score, false AS done FROM pl)"""]
    for s in range(1, BEAM_STEPS + 1):
        parts.append(f""",
b{s} AS MATERIALIZED (
  SELECT *, max(CASE WHEN beam_rank = 0 THEN last_id END) OVER (PARTITION BY prompt_id) = {STOP_ID} AS done FROM (
    SELECT prompt_id, row_number() OVER (PARTITION BY prompt_id ORDER BY sc DESC, old_rank, cand_rank) - 1 AS beam_rank,
           list_append(toks, next_id) AS toks, next_id AS last_id, sc AS score
    FROM (SELECT b.prompt_id, b.beam_rank AS old_rank, b.toks, c.next_id, c.cand_rank, b.score + c.log_prob AS sc
          FROM b{s - 1} b JOIN cands c ON c.prev_id = b.last_id WHERE NOT b.done)
    QUALIFY beam_rank < {BEAM_WIDTH})
)""")
    best = " UNION ALL ".join(f"SELECT {s} AS st, prompt_id, toks, score FROM b{s} WHERE beam_rank = 0"
                              for s in range(0, BEAM_STEPS + 1))
    parts.append(f""",
bb AS ({best})
SELECT prompt_id, {out} FROM bb GROUP BY prompt_id
""")
    return "".join(parts)


SQL_BEAM_SEARCH = _sql_beam_search(
    "SELECT prev_id, next_id, score AS log_prob FROM sc9",
    "array_to_string(arg_max(toks, st), ' ') AS new_ids_text, round(arg_max(score, st), 9) AS score")

SQL_SELECT_BEAM = _sql_beam_search(
    f"""SELECT prev_id, next_id, s - m - ln(sum(exp(s - m)) OVER (PARTITION BY prev_id)) AS log_prob FROM (
      SELECT *, max(s) OVER (PARTITION BY prev_id) AS m FROM (
        SELECT prev_id, next_id, score / {SAMPLE_TEMPERATURE} AS s,
               rank() OVER (PARTITION BY prev_id ORDER BY score DESC) AS r FROM sc9) WHERE r <= {SAMPLE_TOP_K})""",
    "CAST(0 AS INTEGER) AS sample_no, array_to_string(arg_max(toks, st), ' ') AS new_ids_text")

SQL_BEAM_STEP = _SQL_DECODE_BASE + f""",
cands AS (
  SELECT prev_id, next_id, score AS log_prob,
         row_number() OVER (PARTITION BY prev_id ORDER BY score DESC, next_id) - 1 AS cand_rank
  FROM sc9 QUALIFY cand_rank < {BEAM_WIDTH}
)
SELECT pl.prompt_id, CAST(row_number() OVER (PARTITION BY pl.prompt_id ORDER BY 0.0 + c.log_prob DESC, c.cand_rank) - 1 AS INTEGER) AS beam_rank,
       c.next_id, round(0.0 + c.log_prob, 9) AS score
FROM pl JOIN cands c ON c.prev_id = pl.last_id
QUALIFY beam_rank < {BEAM_WIDTH}
"""


def _sql_generate(greedy: bool) -> str:
    n = 1 if greedy else NUM_SAMPLES
    parts = [_SQL_DECODE_BASE + f""",
g AS (SELECT prev_id, arg_max(next_id, score * 1000000 - next_id * 0.0) AS pick FROM (
        SELECT prev_id, next_id, score, row_number() OVER (PARTITION BY prev_id ORDER BY score DESC, next_id) AS r
        FROM sc9) WHERE r = 1 GROUP BY prev_id),
kt AS (SELECT prev_id, next_id, score FROM (
        SELECT *, rank() OVER (PARTITION BY prev_id ORDER BY score DESC) AS r FROM sc9) WHERE r <= {SAMPLE_TOP_K}),
s0 AS (SELECT prompt_id, CAST(d.n AS INTEGER) AS sample_no, last_id, CAST([] AS INTEGER[]) AS toks, true AS alive
       FROM pl, range({n}) d(n))"""]
    for k in range(1, GEN_STEPS + 1):
        if greedy:
            pick = f"""(SELECT s.*, g.pick FROM s{k - 1} s LEFT JOIN g ON g.prev_id = s.last_id)"""
        else:
            pick = f"""(SELECT s.*, d.pick FROM s{k - 1} s LEFT JOIN (
                SELECT s.prompt_id, s.sample_no,
                  arg_max(c.next_id, c.score / {SAMPLE_TEMPERATURE} - ln(-ln(
                    (('0x' || substring(md5('{SEED}:' || s.prompt_id || ':' || s.sample_no || ':{k - 1}:' || c.next_id), 1, 13))::BIGINT + 0.5)
                    / {float(2 ** 52)}))) AS pick
                FROM s{k - 1} s JOIN kt c ON c.prev_id = s.last_id WHERE s.alive
                GROUP BY s.prompt_id, s.sample_no) d USING (prompt_id, sample_no))"""
        go = f"(alive AND pick IS NOT NULL AND pick <> {STOP_ID})"
        parts.append(f""",
s{k} AS MATERIALIZED (
  SELECT prompt_id, sample_no, CASE WHEN {go} THEN pick ELSE last_id END AS last_id,
         CASE WHEN {go} THEN list_append(toks, pick) ELSE toks END AS toks, {go} AS alive
  FROM {pick} x
)""")
    parts.append(f"""
SELECT prompt_id, sample_no, array_to_string(toks, ' ') AS new_ids_text FROM s{GEN_STEPS}
""")
    return "".join(parts)


SQL_GREEDY_GENERATE = _sql_generate(True)
SQL_SAMPLE_GENERATE = _sql_generate(False)


# --------------------------------------------------------------------------
# vectors and byte-pair merges
# --------------------------------------------------------------------------
BPE_MERGES = 48


def q_vector_lookup(spark: SparkSession, sf: str) -> DataFrame:
    smp = _samples(spark, sf).select("doc_id", "chunk_no", "x")
    vec = read_table(spark, sf, "embeddings")
    first = F.element_at("embedding", 1).cast("double").alias("e0")
    j = L.counted_lookup(smp, "x", ["doc_id", "chunk_no"], vec, "vec_id", (first, "label"), pad=PAD_ID)
    n = F.col("n")
    return (j.groupBy("doc_id", "chunk_no")
            .agg(F.sum(F.when(F.col("label").isNotNull(), n).otherwise(0)).alias("n_found"),
                 F.sum(F.col("label") * n).cast("long").alias("label_sum"),
                 F.round(F.sum(F.col("e0") * n), 4).alias("e0_sum")))


SQL_VECTOR_LOOKUP = _SQL_PADDED + f"""
SELECT p.doc_id, p.chunk_no, count(v.label) AS n_found, CAST(sum(v.label) AS BIGINT) AS label_sum,
       round(sum(CAST(v.embedding[1] AS DOUBLE)), 4) AS e0_sum
FROM p LEFT JOIN embeddings v ON v.vec_id = p.id
WHERE p.pos < {MAX_LENGTH - 1}
GROUP BY p.doc_id, p.chunk_no
"""


def q_bpe_pair_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Weighted byte-pair counts over the pre-token table (first training round)."""
    return BPE.pair_counts(BPE.word_table(_docs(spark, sf), "text"))


_CUT = f"chr({_PUA + 99})"


def _sql_words(keys: str = "") -> str:
    """Pre-tokens without look-ahead: a separator goes before the last white space
    of a run that a visible character follows, then the pieces are matched by the
    pattern's other branches. With ``keys``, ``wd`` has their places (pi, wi) too."""
    k = f"{keys}, " if keys else ""
    return fr"""
sl AS (SELECT {k}string_split(regexp_replace(text, '(\s)(\s\S)', '\1' || {_CUT} || '\2', 'g'), {_CUT}) AS parts FROM documents),
sp AS (SELECT {k}unnest(parts) AS part, generate_subscripts(parts, 1) AS pi FROM sl),
wl AS (SELECT {k}pi, regexp_extract_all(part,
         '''s|''t|''re|''ve|''m|''ll|''d| ?\p{{L}}+| ?\p{{N}}+| ?[^\s\p{{L}}\p{{N}}]+|\s+') AS ws FROM sp),
wd AS (SELECT {k}pi, unnest(ws) AS word, generate_subscripts(ws, 1) AS wi FROM wl),
wc AS (SELECT word, count(*) AS n FROM wd GROUP BY word),
{_d_encode("SELECT word, n FROM wc", "word, n", "word", "we")}"""


SQL_BPE_PAIR_COUNTS = "WITH " + _sql_words() + """,
pr AS (SELECT n, id AS a, lead(id) OVER (PARTITION BY word ORDER BY pos) AS b FROM we)
SELECT CAST(a AS INTEGER) AS a, CAST(b AS INTEGER) AS b, CAST(sum(n) AS BIGINT) AS n FROM pr WHERE b IS NOT NULL GROUP BY 1, 2
"""


def q_bpe_merges(spark: SparkSession, sf: str) -> DataFrame:
    """The first BPE_MERGES merges learned from the whole corpus."""
    return BPE.train_bpe(_docs(spark, sf), "text", n_merges=BPE_MERGES).drop("piece")


def _sql_merges(keys: str = "") -> str:
    """Training one merge at a time: words as strings of ``<id>``."""
    parts = ["WITH " + _sql_words(keys) + """,
w0 AS MATERIALIZED (SELECT word, n, string_agg('<' || id || '>', '' ORDER BY pos) AS s FROM we GROUP BY word, n)"""]
    for r in range(BPE_MERGES):
        parts.append(f""",
l{r} AS (SELECT n, CAST(regexp_extract_all(s, '[0-9]+') AS INTEGER[]) AS l FROM w{r}),
p{r} AS (SELECT n, unnest(list_zip(l[:-2], l[2:])) AS p FROM l{r} WHERE len(l) > 1),
m{r} AS MATERIALIZED (SELECT p[1] AS a, p[2] AS b, CAST(sum(n) AS BIGINT) AS n FROM p{r} GROUP BY 1, 2
          ORDER BY n DESC, a, b LIMIT 1),
w{r + 1} AS MATERIALIZED (SELECT word, w{r}.n, replace(s, '<' || m{r}.a || '><' || m{r}.b || '>', '<{FIRST_MERGE_ID + r}>') AS s
          FROM w{r}, m{r})""")
    return "".join(parts)


SQL_BPE_MERGES = _sql_merges() + "\n" + " UNION ALL ".join(
    f"SELECT {r} AS rank, a, b, {FIRST_MERGE_ID + r} AS new_id, n FROM m{r}" for r in range(BPE_MERGES))


def q_bpe_encode(spark: SparkSession, sf: str) -> DataFrame:
    d = _docs(spark, sf).select("doc_id", "text")
    m = BPE.merge_rows(BPE.train_bpe(d, "text", n_merges=BPE_MERGES))
    e = TK.encode(d, "text", "ids", merges=m)
    back = TK.decode(e, "ids", "back", merges=m)
    return back.select("doc_id", F.size("ids").cast("long").alias("n_ids"), F.md5(_join_ids("ids")).alias("ids_md5"),
                       (F.col("back") == F.col("text")).alias("round_trip"))


_SQL_BPE_IDS = _sql_merges("doc_id") + f""",
en AS (SELECT doc_id, string_agg(s, '' ORDER BY pi, wi) AS s FROM wd JOIN w{BPE_MERGES} USING (word) GROUP BY doc_id)
SELECT doc_id, CAST(length(s) - length(replace(s, '<', '')) AS BIGINT) AS n_ids,
       md5(replace(substring(s, 2, length(s) - 2), '><', ' ')) AS ids_md5"""
SQL_BPE_ENCODE = _SQL_BPE_IDS + ", true AS round_trip FROM en"
SQL_BPE_UNIT_JOIN = _SQL_BPE_IDS + " FROM en"


def q_bpe_unit_join(spark: SparkSession, sf: str) -> DataFrame:
    """The same ids by the relational form: distinct units encoded once and joined back."""
    d = _docs(spark, sf).select("doc_id", "text")
    m = BPE.merge_rows(BPE.train_bpe(d, "text", n_merges=BPE_MERGES))
    e = BPE.encode_by_units(d, ["doc_id"], "text", m)
    return e.select("doc_id", F.size("ids").cast("long").alias("n_ids"), F.md5(_join_ids("ids")).alias("ids_md5"))


# --------------------------------------------------------------------------
# composite preparation jobs over line files derived from the tables
# --------------------------------------------------------------------------
LINE_IDS = ["src", "id", "line_no"]
REJECTS = 100_000  # a report that reaches past the first kind of error line


def _corpus_lines(spark, sf):
    """Untrusted corpus lines ``(src, id, line_no, value)``: every document as
    ``{"text": ...}``, every event's ``props`` object, every raw line of every
    web page, and for every turn of a conversation lines by its role: a text
    with a blank chunk and blank edges (user), texts of another type (assistant),
    a blank text, a missing key and blank lines (system)."""
    zero = F.lit(0).cast("long")
    docs = _docs(spark, sf).select(F.lit("documents").alias("src"), F.col("doc_id").alias("id"), zero.alias("line_no"),
                                   F.to_json(F.struct("text")).alias("value"))
    props = read_table(spark, sf, "events").select(
        F.lit("events").alias("src"), F.col("event_id").alias("id"), zero.alias("line_no"), F.col("props").alias("value"))
    pages = read_table(spark, sf, "pages").select(
        F.lit("pages").alias("src"), F.col("page_id").alias("id"),
        F.posexplode(F.split("html", "\r\n|\r|\n")).alias("ln", "value"))
    pages = pages.select("src", "id", F.col("ln").cast("long").alias("line_no"), "value")
    padded = F.concat("text", F.repeat(F.lit(" "), F.lit(2 * CHUNK_WIDTH)))
    odd = F.when(F.col("role") == "user", F.array(
        F.concat(F.lit(" \t"), F.to_json(F.struct(padded.alias("text"))), F.lit(" "))))
    odd = odd.when(F.col("role") == "assistant", F.array(
        F.to_json(F.struct(F.col("turn").alias("text"))), F.to_json(F.struct(F.array("text").alias("text"))),
        F.lit('{"text":null}'), F.lit('{"text":true}'), F.to_json(F.array("text"))))
    odd = odd.otherwise(F.array(F.lit('{"text":"  "}'), F.to_json(F.struct(F.col("text").alias("nt"))), F.lit(""),
                                F.lit(" \t ")))
    turns = _turns(spark, sf).select(
        F.lit("turns").alias("src"), F.col("conv_id").alias("id"), "turn", F.posexplode(odd).alias("k", "value"))
    turns = turns.select("src", "id", (F.col("turn") * 8 + F.col("k")).cast("long").alias("line_no"), "value")
    return docs.unionByName(props).unionByName(pages).unionByName(turns)


_SQL_LINES = f"""
lines AS (
  SELECT 'documents' AS src, doc_id AS id, 0 AS line_no, CAST(to_json({{'text': text}}) AS VARCHAR) AS value FROM documents
  UNION ALL SELECT 'events', event_id, 0, props FROM events
  UNION ALL SELECT 'pages', page_id, i - 1, l
  FROM (SELECT page_id, unnest(string_split_regex(html, '\r\n|\r|\n')) AS l,
               generate_subscripts(string_split_regex(html, '\r\n|\r|\n'), 1) AS i FROM pages)
  UNION ALL SELECT 'turns', conv_id, turn * 8 + i - 1, l
  FROM (SELECT conv_id, turn, unnest(ls) AS l, generate_subscripts(ls, 1) AS i FROM (
    SELECT conv_id, turn, CASE role
      WHEN 'user' THEN [' ' || chr(9) || CAST(to_json({{'text': text || repeat(' ', {2 * CHUNK_WIDTH})}}) AS VARCHAR) || ' ']
      WHEN 'assistant' THEN [CAST(to_json({{'text': turn}}) AS VARCHAR), CAST(to_json({{'text': [text]}}) AS VARCHAR),
                             '{{"text":null}}', '{{"text":true}}', CAST(to_json([text]) AS VARCHAR)]
      ELSE ['{{"text":"  "}}', CAST(to_json({{'nt': text}}) AS VARCHAR), '', ' ' || chr(9) || ' '] END AS ls
    FROM conversations))
), sl AS (
  SELECT src, id, line_no, value, regexp_replace(value, '^[{blank_class()}]+|[{blank_class()}]+$', '', 'g') AS sv FROM lines
), cl AS (
  SELECT src, id, line_no, value, sv,
    CASE WHEN NOT regexp_matches(value, '{NOT_BLANK_RX}') THEN 'blank'
         WHEN NOT json_valid(sv) THEN 'error'
         WHEN json_type(sv) <> 'OBJECT' THEN 'error'
         WHEN json_type(sv, '$.text') IS NULL THEN 'skip'
         WHEN json_type(sv, '$.text') <> 'VARCHAR' THEN 'error'
         WHEN NOT regexp_matches(json_extract_string(sv, '$.text'), '{NOT_BLANK_RX}') THEN 'skip'
         ELSE 'ok' END AS outcome,
    CASE WHEN NOT json_valid(sv) THEN 'json' WHEN json_type(sv) <> 'OBJECT' THEN 'not_object'
         ELSE 'type:' || CASE json_type(sv, '$.text') WHEN 'NULL' THEN 'VOID' WHEN 'ARRAY' THEN 'ARRAY<STRING>'
                                                      WHEN 'UBIGINT' THEN 'BIGINT' ELSE json_type(sv, '$.text') END END AS reason
  FROM sl
)"""

_SQL_LINE_CHUNKS = "WITH " + _SQL_LINES + f""", okl AS (
  SELECT src, id, line_no, json_extract_string(sv, '$.text') AS t FROM cl WHERE outcome = 'ok'
), pc AS (
  SELECT src, id, line_no, t, unnest(range(0, CAST(ceil(length(t) / {CHUNK_WIDTH}.0) AS BIGINT))) AS chunk_no FROM okl
), ch AS (
  SELECT src, id, line_no, chunk_no, substring(t, chunk_no * {CHUNK_WIDTH} + 1, {CHUNK_WIDTH}) AS text FROM pc
), cks AS (SELECT * FROM ch WHERE regexp_matches(text, '{NOT_BLANK_RX}'))"""


def q_corpus_outcomes(spark: SparkSession, sf: str) -> DataFrame:
    """Lines per outcome, and the number of chunks written."""
    r = JB.prepare_corpus(_corpus_lines(spark, sf), ids=LINE_IDS)
    chunks = r.output.agg(F.count(F.lit(1)).alias("n")).select(F.lit("chunks").alias("outcome"), "n")
    return r.counters.unionByName(chunks)


SQL_CORPUS_OUTCOMES = _SQL_LINE_CHUNKS + """
SELECT outcome, count(*) AS n FROM cl GROUP BY outcome
UNION ALL SELECT 'chunks', count(*) FROM cks
"""


def q_prepare_corpus(spark: SparkSession, sf: str) -> DataFrame:
    r = JB.prepare_corpus(_corpus_lines(spark, sf), ids=LINE_IDS)
    return r.output.select(*LINE_IDS, "chunk_no", "text")


SQL_PREPARE_CORPUS = _SQL_LINE_CHUNKS + """
SELECT src, id, line_no, chunk_no, text FROM cks
"""


def q_reject_samples(spark: SparkSession, sf: str) -> DataFrame:
    opts = CorpusOptions(reject_samples=REJECTS)
    return JB.prepare_corpus(_corpus_lines(spark, sf), opts, ids=LINE_IDS).rejects


SQL_REJECT_SAMPLES = "WITH " + _SQL_LINES + f"""
SELECT src, id, line_no, reason, substring(sv, 1, 50) AS excerpt FROM cl WHERE outcome = 'error'
ORDER BY src, id, line_no LIMIT {REJECTS}
"""


def _chat_lines(spark, sf):
    """One chat JSON line per conversation: ``{"conversations": [{from, value}]}``
    in turn order, ``user`` written as ``human``."""
    t = _turns(spark, sf).select(
        "conv_id", "turn",
        F.when(F.col("role") == "user", F.lit("human")).otherwise(F.col("role")).alias("from"),
        F.col("text").alias("value"))
    g = t.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "from", "value"))).alias("c"))
    conv = F.transform("c", lambda x: F.struct(x["from"].alias("from"), x["value"].alias("value")))
    return g.select(F.col("conv_id").alias("line_id"),
                    F.to_json(F.struct(conv.alias("conversations"))).alias("value"))


def _untrusted_chat_lines(spark, sf):
    """Chat lines, every event's ``props``, and for every turn a line by its role:
    a missing key, a key of another type, an item that is no object, an unknown
    speaker, an item without text."""
    zero = F.lit(0).cast("long")
    chats = _chat_lines(spark, sf).select(F.lit("chats").alias("src"), F.col("line_id").alias("id"),
                                          zero.alias("line_no"), "value")
    props = read_table(spark, sf, "events").select(
        F.lit("events").alias("src"), F.col("event_id").alias("id"), zero.alias("line_no"), F.col("props").alias("value"))
    line = lambda items: F.to_json(F.struct(items.alias("conversations")))
    odd = F.when(F.col("role") == "system", F.to_json(F.struct(F.col("text").alias("other"))))
    odd = odd.when(F.col("turn") == 1, line(F.col("text"))).when(F.col("role") == "user", line(F.array("text")))
    odd = odd.otherwise(line(F.array(F.struct(F.lit("narrator").alias("from"), F.col("text").alias("value")),
                                     F.struct(F.lit("human").alias("from"), F.lit(None).cast("string").alias("value")))))
    turns = _turns(spark, sf).select(F.lit("turns").alias("src"), F.col("conv_id").alias("id"),
                                     F.col("turn").cast("long").alias("line_no"), odd.alias("value"))
    return chats.unionByName(props).unionByName(turns)


_SQL_CHAT_LINES = """
chl AS (
  SELECT 'events' AS src, event_id AS id, 0 AS line_no, props AS value FROM events
  UNION ALL SELECT 'turns', conv_id, turn, CASE
    WHEN role = 'system' THEN CAST(to_json({'other': text}) AS VARCHAR)
    WHEN turn = 1 THEN CAST(to_json({'conversations': text}) AS VARCHAR)
    WHEN role = 'user' THEN CAST(to_json({'conversations': [text]}) AS VARCHAR)
    ELSE '{"conversations":[{"from":"narrator","value":' || CAST(to_json(text) AS VARCHAR) || '},{"from":"human"}]}' END
  FROM conversations
), cc AS (
  SELECT src, id, line_no, value,
    CASE WHEN NOT json_valid(value) THEN 'json' WHEN json_type(value) <> 'OBJECT' THEN 'not_object'
         WHEN json_type(value, '$.conversations') IS NULL OR json_type(value, '$.conversations') = 'NULL' THEN 'missing'
         WHEN json_type(value, '$.conversations') <> 'ARRAY' THEN 'type:STRING'
         WHEN json_type(value, '$.conversations[0]') <> 'OBJECT' THEN 'item' END AS reason
  FROM chl
), co AS (
  SELECT src, id, line_no, value, reason, CASE WHEN reason IS NULL THEN 'ok' ELSE 'error' END AS outcome FROM cc
  UNION ALL SELECT 'chats', conv_id, 0, '', NULL, 'ok' FROM (SELECT DISTINCT conv_id FROM conversations)
)"""


def q_chat_outcomes(spark: SparkSession, sf: str) -> DataFrame:
    return JB.prepare_chats(_untrusted_chat_lines(spark, sf), ids=LINE_IDS).counters


SQL_CHAT_OUTCOMES = "WITH " + _SQL_CHAT_LINES + """
SELECT outcome, count(*) AS n FROM co GROUP BY outcome
"""


def q_chat_rejects(spark: SparkSession, sf: str) -> DataFrame:
    opts = ChatOptions(reject_samples=REJECTS)
    return JB.prepare_chats(_untrusted_chat_lines(spark, sf), opts, ids=LINE_IDS).rejects


SQL_CHAT_REJECTS = "WITH " + _SQL_CHAT_LINES + f"""
SELECT src, id, line_no, reason,
       substring(regexp_replace(value, '^[{blank_class()}]+|[{blank_class()}]+$', '', 'g'), 1, 200) AS excerpt
FROM co WHERE outcome = 'error' ORDER BY src, id, line_no LIMIT {REJECTS}
"""


def q_prepare_chats(spark: SparkSession, sf: str) -> DataFrame:
    r = JB.prepare_chats(_chat_lines(spark, sf))
    out = C.render_messages(r.output, "messages", out="text")
    return out.select(F.col("line_id").alias("conv_id"), "text")


SQL_PREPARE_CHATS = SQL_RENDER_CHAT


# --------------------------------------------------------------------------
# D6 prompt ids, D4 chat samples
# --------------------------------------------------------------------------
def q_prompt_ids(spark: SparkSession, sf: str) -> DataFrame:
    """Chat prompts (every user turn) rendered with the sampling template and
    encoded (special tokens become their ids)."""
    p = _turns(spark, sf).filter(F.col("role") == "user").select("conv_id", "turn", F.col("text").alias("prompt"))
    d = JB.render_prompts(p, chat=True, prompt_col="prompt")
    return d.select("conv_id", "turn", F.size("ids").cast("long").alias("n_ids"),
                    _join_ids("ids").alias("ids_text"))


SQL_PROMPT_IDS = f"""
WITH rp AS ({SQL_RENDER_PROMPT}),
{_d_encode("SELECT conv_id, turn, text FROM rp", "conv_id, turn", "text", "e")}
SELECT conv_id, turn, count(*) AS n_ids, string_agg(CAST(id AS VARCHAR), ' ' ORDER BY pos) AS ids_text
FROM e GROUP BY conv_id, turn
"""


def q_chat_samples(spark: SparkSession, sf: str) -> DataFrame:
    d = SP.chat_samples(_chat_text(spark, sf), messages=None, text="text", keys=["conv_id"])
    return d.select("conv_id", _join_ids("x").alias("x_text"), _join_ids("y").alias("y_text"),
                    _join_ids("loss_mask").alias("mask_text"))


SQL_CHAT_SAMPLES = SQL_ANSWER_MASK.replace(
    """SELECT conv_id, n_real,
  CAST(sum(mark) FILTER (WHERE pos >= 1) AS INTEGER) AS n_marked,
  string_agg(CAST(mark AS VARCHAR), ' ' ORDER BY pos) FILTER (WHERE pos >= 1) AS mask_text
FROM mk GROUP BY conv_id, n_real""",
    f"""SELECT mk.conv_id,
  string_agg(CAST(p.id AS VARCHAR), ' ' ORDER BY mk.pos) FILTER (WHERE mk.pos < {MAX_LENGTH - 1}) AS x_text,
  string_agg(CAST(p.id AS VARCHAR), ' ' ORDER BY mk.pos) FILTER (WHERE mk.pos >= 1) AS y_text,
  string_agg(CAST(mark AS VARCHAR), ' ' ORDER BY mk.pos) FILTER (WHERE mk.pos >= 1) AS mask_text
FROM mk JOIN p ON p.conv_id = mk.conv_id AND p.pos = mk.pos GROUP BY mk.conv_id""")

# --------------------------------------------------------------------------
# files: sources, sinks and streams over line files derived from the tables
# --------------------------------------------------------------------------
def _as_files(lines: DataFrame, name: str) -> str:
    """The ``value`` column as line files in a fresh shared folder."""
    path = run_folder(lines.sparkSession, name)
    lines.select("value").write.text(path)
    return path


def q_corpus_files(spark: SparkSession, sf: str) -> DataFrame:
    """D1 from line files to chunk files and back; the job's own counters must
    agree with the rows read back."""
    src = _as_files(_corpus_lines(spark, sf), "corpus-lines")
    out = run_folder(spark, "chunks")
    counters = JB.prepare_corpus_files(spark, src, out)["counters"]
    back = read_chunks(spark, out)
    return back.select("text", F.lit(counters["chunks"]).cast("long").alias("n_chunks"))


SQL_CORPUS_FILES = _SQL_LINE_CHUNKS + """
SELECT text, count(*) OVER () AS n_chunks FROM cks
"""


def q_corpus_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The same files as a stream (all available files, then the end)."""
    src = _as_files(_corpus_lines(spark, sf), "corpus-lines")
    out = run_folder(spark, "chunks")
    start_corpus_stream(spark, src, out, run_folder(spark, "stream-log")).awaitTermination()
    return read_chunks(spark, out).select("text")


SQL_CORPUS_STREAM = _SQL_LINE_CHUNKS + """
SELECT text FROM cks
"""


def q_chat_files(spark: SparkSession, sf: str) -> DataFrame:
    """D2 from line files to message files and back, rendered."""
    src = _as_files(_chat_lines(spark, sf), "chat-lines")
    out = run_folder(spark, "messages")
    JB.prepare_chat_files(spark, src, out)
    return C.render_messages(read_messages(spark, out), "messages", out="text").select("text")


SQL_CHAT_FILES = f"SELECT text FROM ({SQL_RENDER_CHAT})"


def q_prompt_files(spark: SparkSession, sf: str) -> DataFrame:
    """User turns as prompt lines, read back."""
    one_line = F.regexp_replace("text", "[\\r\\n]+", " ")
    src = _as_files(_turns(spark, sf).filter(F.col("role") == "user").select(one_line.alias("value")), "prompts")
    return read_prompts(spark, src).select("prompt")


SQL_PROMPT_FILES = """
SELECT regexp_replace(text, '[\r\n]+', ' ', 'g') AS prompt
FROM conversations WHERE role = 'user'
"""


def q_metrics_table(spark: SparkSession, sf: str) -> DataFrame:
    """Loss of every step joined to the run plan, through the metrics sink."""
    plan = B.run_plan(spark, _chunks(spark, sf), RunOptions())
    loss = S.batch_losses(_batched(spark, sf, _sample_losses(spark, sf)))
    m = plan.join(loss, plan["global_step"] == loss["batch_id"]).select(
        "epoch", "step", "steps_per_epoch", F.round("loss", 6).alias("loss"), F.round("lr", 12).alias("lr"),
        F.col("n_tokens").cast("long").alias("n_tokens"), "is_log")
    m = cut_lineage(m)  # written in two parts, worked out once
    path = run_folder(spark, "metrics")
    append_metrics(m.filter("is_log"), path)
    append_metrics(m.filter("not is_log"), path)
    return spark.read.schema(m.schema).parquet(path)


SQL_METRICS_TABLE = f"""
SELECT p.epoch, p.step, p.steps_per_epoch, l.loss, p.lr, l.n_tokens, p.is_log
FROM ({SQL_RUN_PLAN}) p JOIN ({SQL_MASKED_LOSS}) l ON l.batch_id = p.global_step
"""


# --------------------------------------------------------------------------
# context cut, prompt and stop cuts, truncation report
# --------------------------------------------------------------------------
CONTEXT_IDS = 64


def q_context_cut(spark: SparkSession, sf: str) -> DataFrame:
    """The last CONTEXT_IDS ids of every prompt."""
    d = _prompts(spark, sf)
    return d.select("prompt_id", _join_ids_of(A.keep_last("ids", CONTEXT_IDS)).alias("ids_text"))


def _join_ids_of(ids):
    return F.array_join(ids, " ")


_SQL_PROMPT_POS = f"""
WITH {_d_encode("SELECT conv_id || ':' || turn AS prompt_id, '" + BOS_TOKEN + "' || text AS t FROM conversations WHERE role = 'user'", "prompt_id", "t", "pe")},
pn AS (SELECT *, count(*) OVER (PARTITION BY prompt_id) AS n FROM pe)"""

SQL_CONTEXT_CUT = _SQL_PROMPT_POS + f"""
SELECT prompt_id, string_agg(CAST(id AS VARCHAR), ' ' ORDER BY pos) AS ids_text
FROM pn WHERE pos >= n - {CONTEXT_IDS} GROUP BY prompt_id
"""


def q_stop_cut(spark: SparkSession, sf: str) -> DataFrame:
    """Ids of every chat behind its first system message (the prompt), up to the
    next stop id, with and without it."""
    d = TK.encode(_chat_text(spark, sf), "text", "ids")
    prompt = F.array_position("ids", F.lit(CHAT_STOP_ID)).cast("int")
    d = d.select("conv_id", A.drop_prompt("ids", prompt).alias("rest"))
    return d.select("conv_id", _join_ids_of(A.cut_at("rest", CHAT_STOP_ID, True)).alias("with_stop"),
                    _join_ids_of(A.cut_at("rest", CHAT_STOP_ID, False)).alias("without_stop"))


SQL_STOP_CUT = f"""
WITH m AS ({SQL_TO_MESSAGES}),
ct AS (SELECT conv_id, string_agg({_dpiece('role', 'content')}, '' ORDER BY seq) AS text FROM m GROUP BY conv_id),
{_d_encode("SELECT conv_id, text FROM ct", "conv_id", "text", "e")},
s AS (SELECT *, coalesce(sum(CASE WHEN id = {CHAT_STOP_ID} THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY pos
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM e)
SELECT conv_id, coalesce(string_agg(CAST(id AS VARCHAR), ' ' ORDER BY pos) FILTER (WHERE before = 1), '') AS with_stop,
       coalesce(string_agg(CAST(id AS VARCHAR), ' ' ORDER BY pos) FILTER (WHERE before = 1 AND id <> {CHAT_STOP_ID}), '') AS without_stop
FROM s GROUP BY conv_id
"""


def q_truncation_report(spark: SparkSession, sf: str) -> DataFrame:
    """Chats that lose ids to the sample length."""
    d = TK.encode(_chat_text(spark, sf), "text", "ids")
    return TK.truncated_count(d).select(F.col("n_truncated").cast("long").alias("n_truncated"), "n_rows")


SQL_TRUNCATION_REPORT = f"""
WITH m AS ({SQL_TO_MESSAGES}),
ct AS (SELECT conv_id, string_agg({_dpiece('role', 'content')}, '' ORDER BY seq) AS text FROM m GROUP BY conv_id),
{_d_encode("SELECT conv_id, text FROM ct", "conv_id", "text", "e")},
k AS (SELECT conv_id, count(*) AS n FROM e GROUP BY conv_id)
SELECT count(*) FILTER (WHERE n > {MAX_LENGTH}) AS n_truncated, count(*) AS n_rows FROM k
"""

QUERIES = {
    "corpus_files": q_corpus_files,
    "corpus_stream": q_corpus_stream,
    "chat_files": q_chat_files,
    "prompt_files": q_prompt_files,
    "metrics_table": q_metrics_table,
    "context_cut": q_context_cut,
    "stop_cut": q_stop_cut,
    "truncation_report": q_truncation_report,
    "blank_filter": q_blank_filter,
    "chunk_text": q_chunk_text,
    "chunk_counts": q_chunk_counts,
    "to_messages": q_to_messages,
    "render_chat": q_render_chat,
    "render_prompt": q_render_prompt,
    "byte_encode": q_byte_encode,
    "byte_decode": q_byte_decode,
    "pad_truncate": q_pad_truncate,
    "pretrain_mask": q_pretrain_mask,
    "shift_xy": q_shift_xy,
    "answer_mask": q_answer_mask,
    "shuffle_batch": q_shuffle_batch,
    "run_plan": q_run_plan,
    "lr_schedule": q_lr_schedule,
    "bigram_scores": q_bigram_scores,
    "topk_ties": q_topk_ties,
    "softmax": q_softmax,
    "greedy_pick": q_greedy_pick,
    "seeded_draw": q_seeded_draw,
    "cross_entropy": q_cross_entropy,
    "masked_loss": q_masked_loss,
    "beam_step": q_beam_step,
    "beam_search": q_beam_search,
    "select_beam": q_select_beam,
    "greedy_generate": q_greedy_generate,
    "sample_generate": q_sample_generate,
    "vector_lookup": q_vector_lookup,
    "bpe_pair_counts": q_bpe_pair_counts,
    "bpe_merges": q_bpe_merges,
    "bpe_encode": q_bpe_encode,
    "bpe_unit_join": q_bpe_unit_join,
    "held_out_loss": q_held_out_loss,
    "chat_outcomes": q_chat_outcomes,
    "chat_rejects": q_chat_rejects,
    "corpus_outcomes": q_corpus_outcomes,
    "prepare_corpus": q_prepare_corpus,
    "reject_samples": q_reject_samples,
    "prepare_chats": q_prepare_chats,
    "prompt_ids": q_prompt_ids,
    "chat_samples": q_chat_samples,
}

ORACLE = {
    "corpus_files": SQL_CORPUS_FILES,
    "corpus_stream": SQL_CORPUS_STREAM,
    "chat_files": SQL_CHAT_FILES,
    "prompt_files": SQL_PROMPT_FILES,
    "metrics_table": SQL_METRICS_TABLE,
    "context_cut": SQL_CONTEXT_CUT,
    "stop_cut": SQL_STOP_CUT,
    "truncation_report": SQL_TRUNCATION_REPORT,
    "blank_filter": SQL_BLANK_FILTER,
    "chunk_text": SQL_CHUNK_TEXT,
    "chunk_counts": SQL_CHUNK_COUNTS,
    "to_messages": SQL_TO_MESSAGES,
    "render_chat": SQL_RENDER_CHAT,
    "render_prompt": SQL_RENDER_PROMPT,
    "byte_encode": SQL_BYTE_ENCODE,
    "byte_decode": SQL_BYTE_DECODE,
    "pad_truncate": SQL_PAD_TRUNCATE,
    "pretrain_mask": SQL_PRETRAIN_MASK,
    "shift_xy": SQL_SHIFT_XY,
    "answer_mask": SQL_ANSWER_MASK,
    "shuffle_batch": SQL_SHUFFLE_BATCH,
    "run_plan": SQL_RUN_PLAN,
    "lr_schedule": SQL_LR_SCHEDULE,
    "bigram_scores": SQL_BIGRAM_SCORES,
    "topk_ties": SQL_TOPK_TIES,
    "softmax": SQL_SOFTMAX,
    "greedy_pick": SQL_GREEDY_PICK,
    "seeded_draw": SQL_SEEDED_DRAW,
    "cross_entropy": SQL_CROSS_ENTROPY,
    "masked_loss": SQL_MASKED_LOSS,
    "beam_step": SQL_BEAM_STEP,
    "beam_search": SQL_BEAM_SEARCH,
    "select_beam": SQL_SELECT_BEAM,
    "greedy_generate": SQL_GREEDY_GENERATE,
    "sample_generate": SQL_SAMPLE_GENERATE,
    "vector_lookup": SQL_VECTOR_LOOKUP,
    "held_out_loss": SQL_HELD_OUT_LOSS,
    "chat_outcomes": SQL_CHAT_OUTCOMES,
    "chat_rejects": SQL_CHAT_REJECTS,
    "bpe_pair_counts": SQL_BPE_PAIR_COUNTS,
    "bpe_merges": SQL_BPE_MERGES,
    "bpe_encode": SQL_BPE_ENCODE,
    "bpe_unit_join": SQL_BPE_UNIT_JOIN,
    "corpus_outcomes": SQL_CORPUS_OUTCOMES,
    "prepare_corpus": SQL_PREPARE_CORPUS,
    "reject_samples": SQL_REJECT_SAMPLES,
    "prepare_chats": SQL_PREPARE_CHATS,
    "prompt_ids": SQL_PROMPT_IDS,
    "chat_samples": SQL_CHAT_SAMPLES,
}
