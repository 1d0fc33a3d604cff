"""Decoding rules over a score table: beam search, greedy and sampled
continuation, and the strategy choice.

The score table ``(prev_id, next_id, score)`` gives the next-id scores for a
context ending in ``prev_id`` (e.g. ``scoring.bigram_scores``); a network is
not part of this library. Prompts are ``(prompt_id, ids)``.

Every step is a DataFrame job over all live prompts at once: the per-context
candidate table is bounded by vocabulary x width rows and is broadcast, so
many prompts sharing one context id do not meet in one task; ranking happens
inside a prompt (at most width x width rows). Prompts that finish are split
off. Each step reads the previous state once (one join to the broadcast
candidates, one per-prompt window or aggregate), so the plan grows linearly
and lineage is cut with a reliable checkpoint every ``checkpoint_every``
steps (``spark.checkpoint.dir``); finished prompts ride along flagged
``done``. The state is small (prompts x width rows).

Differences from a dense per-step loop: candidates without a score (not in
the table) are treated as impossible and never materialised, so a beam at
-inf is not kept; when no live beam has any candidate the prompt ends with
its current best beam. An empty prompt has no context and gets an empty
continuation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.arrays import first_numbers
from ..options import SEED, SelectOptions
from ..session import cut_lineage
from . import scoring as S
from .lookup import checked_broadcast


def candidate_table(scores: DataFrame, width: int, temperature: float = 1.0,
                    top_k: int | None = None, normalise: bool = True,
                    prev: str = "prev_id", nxt: str = "next_id", score: str = "score") -> DataFrame:
    """Per context: the ``width`` best next ids with their log-probabilities
    (temperature, top-k with ties, log-softmax), ranked by log-prob then id.
    With ``normalise=False`` the scores are taken as log-probabilities, which
    leaves no temperature or top-k to apply."""
    if not normalise and (temperature != 1.0 or top_k is not None):
        raise ValueError("temperature and top_k need normalise=True")
    d = scores.select(F.col(prev).alias("prev_id"), F.col(nxt).alias("next_id"),
                      F.col(score).alias("score"))
    if normalise:
        t = 1.0 if temperature == 1.0 else temperature
        d = S.softmax_top_k(d, "prev_id", "next_id", "score", top_k, t)
        d = d.select("prev_id", "next_id", F.col("log_prob"))
    else:
        d = d.select("prev_id", "next_id", F.col("score").alias("log_prob"))
    d = S.top_k(d, "prev_id", "next_id", "log_prob", width, out="r_")
    w = Window.partitionBy("prev_id").orderBy(F.col("log_prob").desc(), F.col("next_id"))
    return (d.withColumn("cand_rank", F.row_number().over(w) - 1)
             .filter(F.col("cand_rank") < width).drop("r_"))


def init_beams(prompts: DataFrame, ids: str = "ids") -> DataFrame:
    """One live beam per prompt, score 0."""
    return prompts.select("prompt_id", F.lit(0).alias("beam_rank"),
                          F.col(ids).cast("array<int>").alias("tokens"),
                          F.try_element_at(ids, F.lit(-1)).cast("int").alias("last_id"),
                          F.lit(0.0).alias("score"), F.size(ids).alias("prompt_len"))


def beam_step(beams: DataFrame, cands: DataFrame, width: int) -> DataFrame:
    """Each beam proposes its candidates; per prompt keep the ``width`` best
    summed log-probabilities, ties by previous beam order then candidate
    rank (a stable sort of the proposals). ``cands`` is used as given: pass
    it through ``checked_broadcast`` after materialising it."""
    e = beams.join(cands, beams["last_id"] == cands["prev_id"])
    key = F.col("score") + F.col("log_prob")
    w = Window.partitionBy("prompt_id").orderBy(key.desc(), F.col("beam_rank"), F.col("cand_rank"))
    return (e.withColumn("nr_", F.row_number().over(w) - 1)
             .filter(F.col("nr_") < width)
             .select("prompt_id", F.col("nr_").alias("beam_rank"),
                     F.array_append("tokens", F.col("next_id")).alias("tokens"),
                     F.col("next_id").cast("int").alias("last_id"),
                     key.alias("score"), "prompt_len"))


def _search_step(state: DataFrame, cands: DataFrame, width: int, stop_id: int | None) -> DataFrame:
    """One expansion over the whole beam state with a single per-prompt
    window (one shuffle) and one projection.

    Live beams propose their candidates; a prompt that got proposals keeps
    its ``width`` best new beams and is ``done`` when the best one ends in
    ``stop_id``. A prompt without proposals (already done, or no candidate
    for any beam) keeps its best beam, flagged ``done``."""
    cond = (state["last_id"] == cands["prev_id"]) & ~state["done"]
    e = state.join(cands, cond, "left")
    key = F.col("score") + F.col("log_prob")
    has = F.col("next_id").isNotNull()
    wp = Window.partitionBy("prompt_id")
    w = wp.orderBy((~has).asc(), key.desc(), F.col("beam_rank"), F.col("cand_rank"))
    stop = F.lit(False) if stop_id is None else (F.col("next_id") == F.lit(stop_id))
    e = (e.withColumn("nr_", F.row_number().over(w) - 1)
          .withColumn("any_", F.max(has.cast("int")).over(wp) == 1)
          .withColumn("stop_", F.max(((F.col("nr_") == 0) & has & stop).cast("int")).over(wp) == 1))
    grown = F.col("any_")
    keep = (grown & (F.col("nr_") < width)) | (~grown & (F.col("beam_rank") == 0))
    return e.filter(keep).select(
        "prompt_id",
        F.when(grown, F.col("nr_")).otherwise(F.col("beam_rank")).cast("int").alias("beam_rank"),
        F.when(grown, F.array_append("tokens", F.col("next_id").cast("int"))).otherwise(F.col("tokens")).alias("tokens"),
        F.when(grown, F.col("next_id").cast("int")).otherwise(F.col("last_id")).alias("last_id"),
        F.when(grown, key).otherwise(F.col("score")).alias("score"),
        "prompt_len",
        F.when(grown, F.col("stop_")).otherwise(F.lit(True)).alias("done"))


def _best(beams: DataFrame) -> DataFrame:
    return beams.filter(F.col("beam_rank") == 0)


def beam_search(prompts: DataFrame, scores: DataFrame, steps: int, width: int,
                stop_id: int | None = None, temperature: float = 1.0, top_k: int | None = None,
                normalise: bool = True, ids: str = "ids", checkpoint_every: int = 8) -> DataFrame:
    """Best beam per prompt after at most ``steps`` expansions; a prompt ends
    early when its best beam ends in ``stop_id`` (kept in the output).
    Output ``(prompt_id, new_ids, score)``. Each step reads the previous
    state once, so lineage is cut only every ``checkpoint_every`` steps."""
    # bounded by vocabulary x width rows; computed once, not once per step
    cands = checked_broadcast(cut_lineage(candidate_table(scores, width, temperature, top_k, normalise)))
    state = init_beams(prompts, ids).withColumn("done", F.lit(False))
    for s in range(steps):
        state = _search_step(state, cands, width, stop_id)
        if checkpoint_every and (s + 1) % checkpoint_every == 0 and s + 1 < steps:
            state = cut_lineage(state)
            if state.filter(~F.col("done")).isEmpty():
                break
    return _best(state).select(
        "prompt_id",
        F.slice("tokens", F.col("prompt_len") + 1, F.size("tokens") - F.col("prompt_len")).alias("new_ids"),
        "score")


def _next_greedy(cands_all: DataFrame) -> DataFrame:
    return S.greedy(cands_all, "prev_id", "next_id", "score").withColumnRenamed("next_id", "pick")


def _noisy(next_id: Column, score: Column, seed: int, step: int, temperature: float) -> Column:
    """The score of a candidate with its seeded Gumbel noise."""
    u = S.uniform(F.lit(seed), F.col("prompt_id"), F.col("sample_no"), F.lit(step), next_id)
    return score / F.lit(float(temperature)) - F.log(-F.log(u))


def _drawn(cands: str, seed: int, step: int, temperature: float) -> Column:
    """The candidate of an array with the largest noisy score, null where none has one."""
    noisy = F.transform(cands, lambda c: F.struct(_noisy(c["next_id"], c["score"], seed, step, temperature).alias("g"),
                                                  c["next_id"].alias("next_id")))
    return F.array_max(F.filter(noisy, lambda x: x["g"].isNotNull()))["next_id"]


def _candidate_sets(table: DataFrame) -> DataFrame:
    """``(prev_id, cands)``: the candidates of each context in one row, broadcast when the
    table is small; a row holds one context's candidates, so at most the vocabulary."""
    sets = cut_lineage(table.groupBy("prev_id").agg(F.collect_list(F.struct("next_id", "score")).alias("cands")))
    n, contexts = table.count(), max(1, sets.count())
    return checked_broadcast(sets, 32 * (1 + n // contexts))


def generate(prompts: DataFrame, scores: DataFrame, steps: int, stop_id: int | None = None,
             temperature: float = 1.0, top_k: int | None = None, greedy: bool = False,
             num_samples: int = 1, seed: int = SEED, ids: str = "ids",
             checkpoint_every: int = 8) -> DataFrame:
    """Greedy or sampled continuation, ``num_samples`` independent runs per
    prompt. A picked ``stop_id`` ends the run and is not kept. Sampling
    draws from ``softmax(score/temperature)`` over the top-k set with
    md5-seeded Gumbel noise keyed by (seed, prompt, sample, step, candidate).
    Output ``(prompt_id, sample_no, new_ids)``."""
    sc = scores.select("prev_id", "next_id", "score")
    # the per-context table is bounded by vocabulary x (1 or top-k) rows;
    # computed once and broadcast to every step
    if greedy:
        table = checked_broadcast(cut_lineage(_next_greedy(sc)))
    else:
        table = checked_broadcast(cut_lineage(sc if top_k is None else
                                        S.top_k(sc, "prev_id", "next_id", "score", top_k).drop("rank")))
    runs = prompts.select("*", F.explode(first_numbers(num_samples)).alias("sample_no"))
    live = runs.select("prompt_id", "sample_no", F.lit(True).alias("alive"),
                       F.array().cast("array<int>").alias("new_ids"),
                       F.try_element_at(ids, F.lit(-1)).cast("int").alias("last_id"))
    if not greedy:
        sets = _candidate_sets(table)
        spark = prompts.sparkSession
        # the state is few bytes but much work a row: it is dealt to all tasks, not merged by size
        parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    for s in range(steps):
        if greedy:
            picked = live.join(table, live["last_id"] == table["prev_id"], "left") \
                .select("prompt_id", "sample_no", "alive", "new_ids", "last_id", "pick")
        elif s == 0:
            # one aggregate, which also merges prompts that share an id
            cond = (live["last_id"] == table["prev_id"]) & live["alive"]
            e = live.repartition(parts, "prompt_id", "sample_no").join(table, cond, "left")
            picked = e.groupBy("prompt_id", "sample_no").agg(
                F.first("alive").alias("alive"), F.first("new_ids").alias("new_ids"),
                F.first("last_id").alias("last_id"),
                F.max_by("next_id", _noisy(F.col("next_id"), F.col("score"), seed, s, temperature)).alias("pick"))
        else:
            # every run is one row: the draw is taken inside its context's candidates
            cond = (live["last_id"] == sets["prev_id"]) & live["alive"]
            picked = live.join(sets, cond, "left").select(
                "prompt_id", "sample_no", "alive", "new_ids", "last_id", _drawn("cands", seed, s, temperature).alias("pick"))
        stop = F.col("pick").isNull() | ((F.col("pick") == F.lit(stop_id)) if stop_id is not None
                                         else F.lit(False))
        live = picked.select(
            "prompt_id", "sample_no",
            (F.col("alive") & ~stop).alias("alive"),
            F.when(F.col("alive") & ~stop, F.array_append("new_ids", F.col("pick").cast("int")))
             .otherwise(F.col("new_ids")).alias("new_ids"),
            F.when(F.col("alive") & ~stop, F.col("pick").cast("int")).otherwise(F.col("last_id")).alias("last_id"))
        if checkpoint_every and (s + 1) % checkpoint_every == 0 and s + 1 < steps:
            live = cut_lineage(live)
            if live.filter("alive").isEmpty():
                break
    return live.select("prompt_id", "sample_no", "new_ids")


def select(prompts: DataFrame, scores: DataFrame, opts: SelectOptions) -> DataFrame:
    """Strategy choice: temperature <= 0 -> 0.001, beams < 1 -> 1, top_k < 1
    -> none; beam search when not sampling with several beams; sampling when
    asked; otherwise greedy (the documented meaning of ``do_sample=False,
    num_beams=1``)."""
    o = opts.normalised()
    if not o.do_sample and o.num_beams > 1:
        b = beam_search(prompts, scores, o.max_new_tokens, o.num_beams, o.stop_id,
                        o.temperature, o.top_k)
        return b.select("prompt_id", F.lit(0).alias("sample_no"), "new_ids")
    return generate(prompts, scores, o.max_new_tokens, o.stop_id, o.temperature, o.top_k,
                    greedy=not o.do_sample, num_samples=o.num_samples, seed=o.seed)


def basic_generate(prompts: DataFrame, scores: DataFrame, steps: int, stop_id: int | None = None,
                   temperature: float = 1.0, top_k: int | None = None, num_samples: int = 1,
                   seed: int = SEED) -> DataFrame:
    """The basic continuation rule: greedy exactly at temperature 0,
    otherwise temperature, top-k (ties kept), softmax and a seeded draw."""
    return generate(prompts, scores, steps, stop_id, temperature if temperature != 0 else 1.0,
                    top_k, greedy=(temperature == 0), num_samples=num_samples, seed=seed)
