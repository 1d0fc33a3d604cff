"""Composite jobs D1-D8 (public API).

D1 ``prepare_corpus``   lines -> classify -> text -> chunks (+ counters, rejects)
D2 ``prepare_chats``    lines -> classify -> messages (+ counters, rejects)
D3 ``pretrain_samples`` / D4 ``chat_samples``: see ``samples``
D5 ``plan_run``         samples -> seeded batches per epoch + run plan
D6 ``render_prompts``   prompts -> (chat template) -> ids
D7 ``select``           prompts x scores -> continuations (beam / greedy / sample)
D8 ``evaluate``         batched samples x scores -> per-batch masked loss

D1 and D2 outputs are one stage each (no exchange): classification, chunking
and message building are per-line expressions. The file jobs read the text once
into a staged table, from which output, counters and numbered rejects come.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import batching as B
from ..operators import beam as BM
from ..operators import quality as Q
from ..operators import scoring as S
from ..operators import tokens as TK
from ..operators.chat import render_prompt, to_messages
from ..functions.text import excerpt, not_blank
from ..functions.text import pieces as F_pieces
from ..options import ChatOptions, CorpusOptions, RunOptions, SelectOptions
from ..sinks import write_chunks, write_messages
from ..session import run_folder
from ..sources import read_lines
from ..sources.lines import PLACE, numbered, split_offsets, with_places
from . import samples as SP


@dataclass
class JobResult:
    output: DataFrame
    counters: DataFrame
    rejects: DataFrame


def line_ids(lines: DataFrame) -> list[str]:
    """The columns that name a line: its file, where known, and its number."""
    return [c for c in ("file", "line_id") if c in lines.columns]


def _chunks(classified: DataFrame, keep: list[str], opts: CorpusOptions) -> DataFrame:
    # one generator: pieces of ok texts, nothing for other rows (blank texts
    # are already 'skip'), then the blank-chunk filter on the generated column
    pieces = F.when(F.col("outcome") == Q.OK, F_pieces("text", opts.chunk_width))
    return (classified.select(*keep, F.posexplode(pieces).alias("chunk_no", "text"))
            .filter(not_blank("text"))
            .withColumn("chunk_no", F.col("chunk_no").cast("long")))


def _messages(classified: DataFrame, keep: list[str], opts: ChatOptions) -> DataFrame:
    ok = Q.ok_rows(classified, "items", keep)
    return to_messages(ok, "items", opts.role_map, opts.system_prompt).drop("items")


def prepare_corpus(lines: DataFrame, opts: CorpusOptions = CorpusOptions(),
                   ids: list[str] | None = None) -> JobResult:
    """D1 over ``(*ids, value)``: chunks of the ``text`` field of every valid
    line, counters per outcome and the first rejects by ``ids``."""
    ids = line_ids(lines) if ids is None else ids
    c = Q.classify_corpus(lines)
    rejects = Q.reject_samples(c, opts.reject_samples, ids, "value", opts.excerpt_chars)
    return JobResult(_chunks(c, ids, opts), Q.run_counters(c), rejects)


def prepare_chats(lines: DataFrame, opts: ChatOptions = ChatOptions(),
                  ids: list[str] | None = None) -> JobResult:
    """D2 over ``(*ids, value)``: messages of every valid line."""
    ids = line_ids(lines) if ids is None else ids
    c = Q.classify_chats(lines)
    rejects = Q.reject_samples(c, opts.reject_samples, ids, "value", opts.excerpt_chars)
    return JobResult(_messages(c, ids, opts), Q.run_counters(c), rejects)


@dataclass
class FileJob:
    """Result of a file job: outcome counts (and written rows), and all rejected lines."""
    counters: dict
    rejects: DataFrame

    def samples(self, n: int) -> list[dict]:
        """The first ``n`` rejects by file and line (a top-k)."""
        return [r.asDict() for r in self.rejects.orderBy("file", "line_id").limit(n).collect()]


def _file_job(spark: SparkSession, in_path: str, out_path: str, classify, payload, write, what: str,
              excerpt_chars: int) -> FileJob:
    """One scan of the text: lines are classified and kept as a staged table in the shared
    folder (place, outcome, excerpt of rejects, output records). Output, counters, split
    offsets and rejects are column reads of that table, and only rejects get line numbers."""
    c = classify(with_places(read_lines(spark, in_path)))
    short = excerpt(Q.strip_blank(F.col("value")), excerpt_chars)
    staged = c.select(*PLACE, "outcome", "reason", F.when(F.col("outcome") == Q.ERROR, short).alias("excerpt"),
                      payload.alias("records"))
    path = run_folder(spark, "classified")
    staged.write.parquet(path)
    staged = spark.read.schema(staged.schema).parquet(path)
    write(staged.select(F.explode("records").alias("record")), out_path)
    counts = staged.groupBy("outcome").agg(F.count(F.lit(1)).alias("n"),
                                           F.sum(F.greatest(F.size("records"), F.lit(0))).alias("written")).collect()
    counters = {r["outcome"]: r["n"] for r in counts} | {what: sum(r["written"] for r in counts)}
    rejects = staged.where(F.col("outcome") == Q.ERROR).select(*PLACE, "reason", "excerpt")
    return FileJob({k: n for k, n in counters.items() if n}, numbered(rejects, split_offsets(staged)))


def corpus_file_job(spark: SparkSession, in_path: str, out_path: str, opts: CorpusOptions = CorpusOptions()) -> FileJob:
    """D1 over files: chunk JSONL under ``out_path``."""
    chunks = F.filter(F.when(F.col("outcome") == Q.OK, F_pieces("text", opts.chunk_width)), lambda x: not_blank(x))
    return _file_job(spark, in_path, out_path, Q.classify_corpus, chunks,
                     lambda d, path: write_chunks(d.select(F.col("record").alias("text")), path), "chunks", opts.excerpt_chars)


def chat_file_job(spark: SparkSession, in_path: str, out_path: str, opts: ChatOptions = ChatOptions()) -> FileJob:
    """D2 over files: message JSONL under ``out_path``."""
    def classify(lines):
        return to_messages(Q.classify_chats(lines), "items", opts.role_map, opts.system_prompt)

    chats = F.when(F.col("outcome") == Q.OK, F.array("messages"))
    return _file_job(spark, in_path, out_path, classify, chats,
                     lambda d, path: write_messages(d.select(F.col("record").alias("messages")), path), "chats",
                     opts.excerpt_chars)


def prepare_corpus_files(spark: SparkSession, in_path: str, out_path: str,
                         opts: CorpusOptions = CorpusOptions()) -> dict:
    """Read a JSONL corpus, write chunk JSONL, return the counters (``chunks``
    written included) and the reject samples (small, bounded results)."""
    job = corpus_file_job(spark, in_path, out_path, opts)
    return {"counters": job.counters, "rejects": job.samples(opts.reject_samples)}


def prepare_chat_files(spark: SparkSession, in_path: str, out_path: str,
                       opts: ChatOptions = ChatOptions()) -> dict:
    job = chat_file_job(spark, in_path, out_path, opts)
    return {"counters": job.counters, "rejects": job.samples(opts.reject_samples)}


def plan_run(samples: DataFrame, id_cols: list[str], opts: RunOptions = RunOptions()):
    """D5: batches per epoch and the step plan. Returns ``(batches, plan)``."""
    batches = B.assign_batches(samples, id_cols, opts.batch_size, opts.epochs, opts.seed)
    plan = B.run_plan(samples.sparkSession, samples, opts)
    return batches, plan


def render_prompts(prompts: DataFrame, chat: bool = True, prompt_col: str = "prompt") -> DataFrame:
    """D6: chat prompts get the sampling template and the open assistant
    header; plain prompts are encoded as they are."""
    d = render_prompt(prompts, prompt_col, out="rendered") if chat else \
        prompts.withColumn("rendered", F.col(prompt_col))
    return TK.encode(d, "rendered", "ids")


def select(prompts: DataFrame, scores: DataFrame, opts: SelectOptions) -> DataFrame:
    """D7 (see ``beam.select``)."""
    return BM.select(prompts, scores, opts)


def evaluate(batched: DataFrame, scores: DataFrame, batch: str = "batch_id") -> DataFrame:
    """D8: per-token cross-entropy under ``scores``, masked mean per batch
    (token-weighted; null for a batch without counted tokens, or with a target
    that has no score: see ``n_unscored``)."""
    return S.batch_losses(S.sample_losses(batched, scores, [batch], merge_pairs=True), batch)


__all__ = ["FileJob", "JobResult", "corpus_file_job", "chat_file_job", "prepare_corpus", "prepare_chats", "prepare_corpus_files",
           "prepare_chat_files", "plan_run", "render_prompts", "select", "evaluate",
           "SP"]
