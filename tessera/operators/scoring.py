"""Selection over scored candidates and loss arithmetic.

Input tables are long: ``(group, candidate, score)``, e.g. next-token
scores per context id, retrieval results per query, replies per prompt.
Every operator works on millions of groups at once.

Skew: a group may be very large. Per-group statistics (max, sum, arg-max,
draws) are aggregates, so partial aggregation runs map-side before the
shuffle; results are joined back on the group key, where AQE broadcasts the
per-group table when its measured size is small and splits hot keys
otherwise. Top-k deals a group into parts and merges their best (``kth_ranks``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.arrays import first_numbers
from ..options import SEED
from ..session import cut_lineage
from .lookup import checked_broadcast

TWO_52 = float(2 ** 52)


# ---------------------------------------------------------------------------
# score source
# ---------------------------------------------------------------------------
def pairs_from_ids(df: DataFrame, ids: str = "ids") -> DataFrame:
    """Adjacent id pairs ``(prev_id, next_id)`` of each sequence (no window:
    the pairs come from zipping the array with itself shifted by one)."""
    n = F.size(ids)
    z = F.when(n >= 2, F.arrays_zip(F.slice(ids, 1, n - 1).alias("prev_id"),
                                    F.slice(ids, 2, n - 1).alias("next_id")))
    return df.select(F.explode(z).alias("p_")).select("p_.prev_id", "p_.next_id")


def pairs_from_samples(df: DataFrame, x: str = "x", y: str = "y", mask: str = "loss_mask") -> DataFrame:
    """``(x[i], y[i])`` pairs of training samples where the target counts."""
    z = F.arrays_zip(F.col(x).alias("prev_id"), F.col(y).alias("next_id"), F.col(mask).alias("m"))
    return (df.select(F.explode(z).alias("p_"))
              .filter(F.col("p_.m") == 1).select("p_.prev_id", "p_.next_id"))


def bigram_scores(pairs: DataFrame) -> DataFrame:
    """``(prev_id, next_id, n, score = ln(n / n(prev)))`` from id pairs.

    A stand-in score source so that selection and loss operators run end to
    end; not a language model. The pair count is a partial aggregate; the
    per-``prev_id`` total is a window over the aggregated table, whose groups
    are bounded by the vocabulary size."""
    counts = pairs.groupBy("prev_id", "next_id").agg(F.count(F.lit(1)).alias("n"))
    tot = F.sum("n").over(Window.partitionBy("prev_id"))
    return counts.withColumn("score", F.log(F.col("n") / tot))


# ---------------------------------------------------------------------------
# per-group statistics
# ---------------------------------------------------------------------------
def _scaled(score: str, temperature: float) -> Column:
    return F.col(score) / F.lit(float(temperature)) if temperature != 1.0 else F.col(score)


def log_softmax(df: DataFrame, group: str, score: str, temperature: float = 1.0,
                out: str = "log_prob") -> DataFrame:
    """Adds ``log_prob`` (and ``prob``) normalised within each group:
    ``s/t - max - ln(sum(exp(s/t - max)))``. Two aggregates over the group,
    each joined back on the group key."""
    d = df.withColumn("s_", _scaled(score, temperature))
    mx = d.groupBy(group).agg(F.max("s_").alias("mx_"))
    d = d.join(mx, group)
    lse = d.groupBy(group).agg(F.log(F.sum(F.exp(F.col("s_") - F.col("mx_")))).alias("lse_"))
    d = d.join(lse, group)
    lp = F.col("s_") - F.col("mx_") - F.col("lse_")
    return d.withColumn(out, lp).withColumn("prob", F.exp(lp)).drop("s_", "mx_", "lse_")


#: parts that a group's candidates are dealt to before its k best are known
SALTS = 64


def kth_ranks(df: DataFrame, group: str, cand: str, score: str, k: int, out: str = "rank") -> DataFrame:
    """``(group, score, rank)``: the distinct scores of rank at most ``k`` of each group. A
    mergeable top-k: every group is dealt into ``SALTS`` parts, each part keeps its ``k``
    largest scores (at most ``k`` rows a task leave for the shuffle), and the ranks come
    from those few; no task sees a whole group."""
    salt = F.pmod(F.xxhash64(cand), F.lit(SALTS))
    part = Window.partitionBy(group, "salt_").orderBy(F.col(score).desc())
    some = (df.select(group, F.col(score), salt.alias("salt_")).withColumn("n_", F.row_number().over(part))
            .where(F.col("n_") <= k))
    ranked = some.withColumn(out, F.rank().over(Window.partitionBy(group).orderBy(F.col(score).desc())))
    return ranked.where(F.col(out) <= k).select(group, score, out).distinct()


def top_k(df: DataFrame, group: str, cand: str, score: str, k: int,
          out: str = "rank") -> DataFrame:
    """Keep candidates whose score is >= the k-th largest in their group; ties may keep
    more than k (``rank()``, not ``row_number()``). The few scores that stay, with their
    ranks, are joined back on group and score (a hot score is split by AQE, and small
    tables of ranks are broadcast)."""
    if k is None:
        return df.withColumn(out, F.lit(None).cast("int"))
    ranks = kth_ranks(df, group, cand, score, k, out).select(
        F.col(group).alias("g_"), F.col(score).alias("t_"), out)
    kept = df.join(ranks, F.col(group).eqNullSafe(F.col("g_")) & F.col(score).eqNullSafe(F.col("t_")))
    return kept.select(*df.columns, out)


def softmax_top_k(df: DataFrame, group: str, cand: str, score: str, k: int | None = None,
                  temperature: float = 1.0) -> DataFrame:
    """Temperature, top-k with ties, then probabilities over the kept set.
    After the top-k cut every group is bounded, so plain windows are used."""
    d = top_k(df, group, cand, score, k) if k is not None else df
    if k is None:
        return log_softmax(d, group, score, temperature)
    w = Window.partitionBy(group)
    s = _scaled(score, temperature)
    d = d.withColumn("s_", s).withColumn("mx_", F.max("s_").over(w))
    d = d.withColumn("lse_", F.log(F.sum(F.exp(F.col("s_") - F.col("mx_"))).over(w)))
    lp = F.col("s_") - F.col("mx_") - F.col("lse_")
    return d.withColumn("log_prob", lp).withColumn("prob", F.exp(lp)).drop("s_", "mx_", "lse_")


def greedy(df: DataFrame, group: str, cand: str, score: str, out: str | None = None) -> DataFrame:
    """Best candidate per group; ties go to the lowest candidate id."""
    best = F.max_by(F.col(cand), F.struct(F.col(score), -F.col(cand)))
    return df.groupBy(group).agg(best.alias(out or cand))


def uniform(*parts: Column) -> Column:
    """Reproducible uniform in (0, 1) from 52 bits of ``md5(p1:p2:...)``."""
    h = F.md5(F.concat_ws(":", *[p.cast("string") for p in parts]))
    return (F.conv(F.substring(h, 1, 13), 16, 10).cast("double") + F.lit(0.5)) / F.lit(TWO_52)


def draw(df: DataFrame, group: str, cand: str, score: str, n: int = 1, seed: int = SEED,
         temperature: float = 1.0, k: int | None = None, out: str | None = None) -> DataFrame:
    """``n`` independent draws per group with probability
    ``softmax(score / temperature)`` over the top-k set (Gumbel-max:
    ``argmax(s/t - ln(-ln(u)))``, ``u`` from md5 of seed, group, candidate and
    draw number). Output ``(group, draw, cand)``. The arg-max is an
    aggregate, so a large group costs one partial result per task. Each candidate is
    looked at once a draw; for many draws use ``draw_many``."""
    d = top_k(df, group, cand, score, k) if k is not None else df
    d = d.select("*", F.explode(first_numbers(n)).alias("draw"))
    u = uniform(F.lit(seed), F.col(group), F.col(cand), F.col("draw"))
    key = _scaled(score, temperature) - F.log(-F.log(u))
    return d.groupBy(group, "draw").agg(F.max_by(F.col(cand), key).alias(out or cand))


def draw_many(df: DataFrame, group: str, cand: str, score: str, n: int, seed: int = SEED,
              temperature: float = 1.0, k: int | None = None, out: str | None = None) -> DataFrame:
    """``n`` independent draws per group by inverse transform: ``(group, draw, cand)``.

    A group's candidates, in order of ``cand``, get cumulative probabilities; one uniform
    number per draw (md5 of seed, group and draw) picks the first that reaches it. Draws
    and candidates are merged in one order per group, so there are candidates + draws rows
    and one hash a draw, never candidates x draws. A group's candidates are bounded by
    ``k`` (ties beside) or by what can be a candidate at all."""
    d = top_k(df, group, cand, score, k) if k is not None else df
    by = Window.partitionBy(group)
    d = d.select(group, F.col(cand).alias("c_"), _scaled(score, temperature).alias("s_"))
    d = d.withColumn("w_", F.exp(F.col("s_") - F.max("s_").over(by)))
    d = d.withColumn("cum_", F.sum("w_").over(by.orderBy("c_").rowsBetween(Window.unboundedPreceding, 0)))
    d = d.withColumn("x_", F.col("cum_") / F.max("cum_").over(by))
    draws = (d.select(group).distinct()
             .withColumn("draw", F.explode(F.sequence(F.lit(0), F.lit(n - 1)))) if n > 0 else
             d.select(group, F.lit(0).alias("draw")).limit(0))
    draws = draws.select(group, uniform(F.lit(seed), F.col(group), F.col("draw")).alias("x_"), "draw",
                         F.lit(None).cast(d.schema["c_"].dataType).alias("c_"))
    both = draws.unionByName(d.select(group, "x_", F.lit(None).cast("int").alias("draw"), "c_"))
    # from the top down the last candidate seen is the first that reaches the draw
    down = by.orderBy(F.col("x_").desc(), F.col("draw").isNull().desc(), F.col("c_").desc())
    down = down.rowsBetween(Window.unboundedPreceding, 0)
    found = both.withColumn("pick_", F.last("c_", ignorenulls=True).over(down)).where("draw is not null")
    return found.select(group, "draw", F.col("pick_").alias(out or cand))


# ---------------------------------------------------------------------------
# losses
# ---------------------------------------------------------------------------
def cross_entropy(targets: DataFrame, scores: DataFrame, prev: str = "prev_id",
                  target: str = "next_id", score: str = "score", ignore: int = 0,
                  out: str = "loss") -> DataFrame:
    """Per target: ``logsumexp(scores of its context) - score(target)``;
    0 when the target is ``ignore``; null when the pair has no score.

    ``targets`` holds one row per predicted position with the context id in
    ``prev`` and the target in ``target``. The score table is read once: the
    log-sum-exp is a window per context, whose rows are that context's
    candidate ids and so at most the vocabulary size. The lookup is one
    equi-join on ``(prev, target)``: the scores are worked out once and broadcast
    below ``BROADCAST_BYTES``, so the positions are not shuffled to them (left to AQE,
    they are written out before the size of the scores is known); a larger table is
    joined by shuffle, where AQE splits hot pairs of the target side."""
    w = Window.partitionBy(prev)
    sc = (scores.select(F.col(prev), F.col(target), F.col(score).alias("s_"))
          .withColumn("mx_", F.max("s_").over(w)))
    sc = sc.withColumn("lse_", F.col("mx_") + F.log(F.sum(F.exp(F.col("s_") - F.col("mx_"))).over(w)))
    sc = checked_broadcast(cut_lineage(sc.select(prev, target, "s_", "lse_")))
    d = targets.join(sc, [prev, target], "left")
    loss = F.when(F.col(target) == F.lit(ignore), F.lit(0.0)).otherwise(F.col("lse_") - F.col("s_"))
    return d.withColumn(out, loss).drop("lse_", "s_")


def masked_loss(tokens: DataFrame, batch: str = "batch_id", loss: str = "loss",
                mask: str = "mask", out: str = "loss", unscored: float | None = None) -> DataFrame:
    """Per batch ``sum(loss * mask) / sum(mask)`` (token-weighted), with the
    number of counted tokens and of those without a score (null loss).

    The loss is null when the batch has no counted token, or when one of them
    has no score; with ``unscored`` such a token costs that much instead. An
    aggregate: skew-safe."""
    cost = F.col(loss) if unscored is None else F.coalesce(F.col(loss), F.lit(float(unscored)))
    den = F.sum(F.col(mask))
    lost = F.sum(F.when(F.col(loss).isNull(), F.col(mask)).otherwise(0))
    whole = (den > 0) if unscored is not None else (den > 0) & (lost == 0)
    return tokens.groupBy(batch).agg(
        F.when(whole, F.sum(cost * F.col(mask)) / den).alias(out), den.alias("n_tokens"),
        lost.alias("n_unscored"))


def pair_targets(df: DataFrame, keys: list[str], x: str = "x", y: str = "y",
                 mask: str = "loss_mask") -> DataFrame:
    """``keys + (prev_id, next_id, mask)``: the targets of ``targets_from_samples``
    with equal (context, target) pairs of a key added up, ``mask`` counting them;
    uncounted positions are left out. Smaller than one row per position before
    any join with scores."""
    z = F.arrays_zip(F.col(x).alias("prev_id"), F.col(y).alias("next_id"), F.col(mask).alias("mask"))
    counted = F.filter(z, lambda t: t["mask"] != 0)
    return (df.select(*keys, F.explode(counted).alias("t_"))
              .groupBy(*keys, F.col("t_.prev_id").alias("prev_id"), F.col("t_.next_id").alias("next_id"))
              .agg(F.sum("t_.mask").alias("mask")))


def sample_losses(df: DataFrame, scores: DataFrame, keys: list[str], unscored: float | None = None,
                  merge_pairs: bool = False) -> DataFrame:
    """``keys + (loss_sum, n_tokens, n_unscored)`` per key; ``loss_sum`` counts
    scored targets, and unscored ones at ``unscored`` each when given.

    ``merge_pairs`` adds up equal (context, target) pairs of a key before the join:
    worth it when a key covers many samples (a batch), not for single samples,
    whose pairs hardly repeat."""
    if merge_pairs:
        targets = pair_targets(df, keys)
    else:
        targets = targets_from_samples(df, keys).filter("mask <> 0")
    ce = cross_entropy(targets, scores)
    lost = F.col("loss").isNull()
    cost = F.when(lost, F.lit(float(unscored or 0))).otherwise(F.col("loss"))
    return ce.groupBy(*keys).agg(
        F.sum(cost * F.col("mask")).alias("loss_sum"), F.sum("mask").alias("n_tokens"),
        F.sum(F.when(lost, F.col("mask")).otherwise(0)).alias("n_unscored"))


def batch_losses(per_sample: DataFrame, batch: str = "batch_id", floored: bool = False) -> DataFrame:
    """Per batch the token-weighted loss of ``sample_losses`` rows, by the rules
    of ``masked_loss`` (``floored``: unscored targets carry a cost already)."""
    den, lost = F.sum("n_tokens"), F.sum("n_unscored")
    whole = (den > 0) if floored else (den > 0) & (lost == 0)
    return per_sample.groupBy(batch).agg(
        F.when(whole, F.sum("loss_sum") / den).alias("loss"), den.alias("n_tokens"), lost.alias("n_unscored"))


def targets_from_samples(df: DataFrame, keys: list[str], x: str = "x", y: str = "y",
                         mask: str = "loss_mask") -> DataFrame:
    """One row per position: ``keys + (pos, prev_id, next_id, mask)``."""
    z = F.arrays_zip(F.col(x).alias("prev_id"), F.col(y).alias("next_id"), F.col(mask).alias("mask"))
    return (df.select(*keys, F.posexplode(z).alias("pos", "t_"))
              .select(*keys, "pos", "t_.prev_id", "t_.next_id", "t_.mask"))
