"""Token-level audits over logged log-probabilities.

Input is one row per sequence with parallel arrays (``logps``, ``old_logps``,
``ref_logps``, ``masks`` ...). What concerns one sequence stays inside its row;
what concerns a batch is exploded and aggregated with map-side partial sums, so
no token is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollforge.functions import numeric as N
from rollforge.operators.groups import BATCH
from rollforge.plans.skew import attach_stats, exact_quantile
from rollforge.schemas import EOS_ID, PAD_ID, one_of, require


def token_rows(df: DataFrame, keys: Sequence[str], arrays: dict[str, str], masked: str | None = "masks") -> DataFrame:
    """Tokens as rows; ``arrays`` maps new names to array columns, and only
    tokens with mask 1 are kept."""
    fields = [F.col(c).alias(n) for n, c in arrays.items()]
    if masked:
        fields.append(F.col(masked).alias("__mask"))
    rows = df.select(*keys, F.explode(F.arrays_zip(*fields)).alias("t")).select(
        *keys, *[F.col(f"t.{n}").alias(n) for n in arrays], *([F.col("t.__mask")] if masked else []))
    return rows.where(F.col("__mask") == 1).drop("__mask") if masked else rows


# ------------------------------------------------------------ sequence sums

def sequence_logps(df: DataFrame, logps: str = "logps", mask: str = "masks", average: bool = False, name: str = "seq_logp") -> DataFrame:
    """Sum or mean of the token log-probs the mask covers."""
    total = N.masked_sum(F.col(logps), F.col(mask))
    if average:
        n = N.mask_count(F.col(mask))
        total = F.when(n > 0, total / n)
    return df.withColumn(name, total)


def label_mask(labels: Column, ignored: int = -100) -> Column:
    return F.transform(labels, lambda x: (x != ignored).cast("int"))


def shared_length_logps(
    pairs: DataFrame, chosen: str, rejected: str, ld_alpha: float
) -> DataFrame:
    """Sums in which tokens past the shorter response count ``ld_alpha``."""
    shared = F.least(F.size(chosen), F.size(rejected))

    def weighted(c: str) -> Column:
        parts = N.bound({"x": F.col(c), "shared": shared}, lambda row: F.transform(
            row["x"], lambda x, i: F.when(i < row["shared"], x).otherwise(x * ld_alpha)))
        return N.array_total(parts)

    return pairs.withColumns({f"{chosen}_sum": weighted(chosen), f"{rejected}_sum": weighted(rejected)})


def k3_kl(df: DataFrame, name: str = "kl") -> DataFrame:
    """Masked sum of the non-negative KL estimate per sequence."""
    kl = F.zip_with("ref_logps", "logps", lambda r, p: N.k3(r, p))
    return df.withColumn(name, N.masked_sum(kl, F.col("masks")))


# ---------------------------------------------------------------- objective

def policy_rows(
    df: DataFrame,
    level: str = "token",
    eps_low: float = 0.2,
    eps_high: float = 0.2,
    delta: float | None = None,
    beta: float = 0.0,
    ratio_cap: float | None = None,
    log_clamp: float = 20.0,
    keep_mask: str | None = None,
) -> DataFrame:
    """Clipped-ratio objective per sequence.

    Adds ``loss_sum`` and ``kl_sum`` over masked tokens, ``tokens`` and
    ``row_loss`` (their masked mean). ``keep_mask`` is an optional 0/1 array
    (for instance ``top_entropy_mask``); ``ratio_cap`` weights tokens by the
    capped ratio of ``old_logps`` to ``sampling_logps``.
    """
    one_of(level, ["token", "sequence"], "ratio level")
    require(df, ["logps", "old_logps", "masks", "advantage"], "policy_rows")
    n = N.mask_count(F.col("masks"))
    log_ratio = F.zip_with("logps", "old_logps", lambda p, o: p - o)
    if level == "sequence":
        mean = N.masked_sum(log_ratio, F.col("masks")) / F.greatest(n, F.lit(1.0))
        log_ratio = N.bound({"p": F.col("logps"), "mean": mean}, lambda row: F.transform(row["p"], lambda _: row["mean"]))
    used = {"logps": beta, "ref_logps": beta, "old_logps": ratio_cap is not None, "sampling_logps": ratio_cap is not None}
    named = {"log_ratio": log_ratio, "advantage": F.col("advantage"), **{c: F.col(c) for c, yes in used.items() if yes}}
    if keep_mask:
        named["keep"] = F.col(keep_mask)

    def token_loss(row: Column, x: Column, i: Column) -> Column:
        advantage = row["advantage"]
        ratio = F.exp(N.clamp(x, -log_clamp, log_clamp))
        clipped = N.clamp(ratio, 1 - eps_low, 1 + eps_high)
        if delta is not None:
            ratio = F.least(ratio, F.lit(float(delta)))
        loss = -F.least(ratio * advantage, clipped * advantage)
        if keep_mask:
            loss = loss * F.get(row["keep"], i)
        if ratio_cap is not None:
            drift = F.get(row["old_logps"], i) - F.get(row["sampling_logps"], i)
            loss = loss * F.least(F.exp(drift), F.lit(float(ratio_cap)))
        if beta:
            loss = loss + N.k3(F.get(row["ref_logps"], i), F.get(row["logps"], i)) * beta
        return loss

    losses = N.bound(named, lambda row: F.transform(row["log_ratio"], lambda x, i: token_loss(row, x, i)))
    rows = df.withColumn("token_loss", losses)
    out = rows.withColumn("loss_sum", N.masked_sum(F.col("token_loss"), F.col("masks"))).withColumn("tokens", n)
    return out.withColumn("row_loss", F.col("loss_sum") / F.greatest(F.col("tokens"), F.lit(1.0)))


POLICY_LOSSES = ("grpo", "bnpo", "dr_grpo", "dapo")


def reduce_policy_loss(
    rows: DataFrame, loss_types: Sequence[str], keys: Sequence[str] = BATCH, max_completion: int | None = None,
    workers: int = 1, accumulation: int = 1,
) -> DataFrame:
    """Batch losses from the per-sequence sums, one ``loss_<type>`` column each
    from a single aggregation.

    ``grpo``: mean of masked means; ``bnpo``: token sum / tokens; ``dr_grpo``:
    token sum / (rows * max_completion); ``dapo``: token sum / (tokens / workers).
    The first three are divided by ``accumulation``.
    """
    total, tokens = F.sum("loss_sum"), F.greatest(F.sum("tokens"), F.lit(1.0))
    losses = []
    for loss_type in loss_types:
        one_of(loss_type, POLICY_LOSSES, "loss type")
        if loss_type == "grpo":
            loss = F.avg("row_loss") / accumulation
        elif loss_type == "bnpo":
            loss = total / tokens / accumulation
        elif loss_type == "dr_grpo":
            if not max_completion:
                raise ValueError("dr_grpo needs max_completion")
            loss = total / (F.count(F.lit(1)) * max_completion) / accumulation
        else:
            loss = total / (tokens / workers)
        losses.append(loss.alias(f"loss_{loss_type}"))
    return rows.groupBy(*keys).agg(*losses)


def sequence_ratio(df: DataFrame, eps_low: float = 0.2, eps_high: float = 0.2) -> DataFrame:
    """Clipped objective on the ratio of whole-sequence log-probs."""
    new = N.masked_sum(F.col("logps"), F.col("masks"))
    old = N.masked_sum(F.col("old_logps"), F.col("masks"))
    ratio = df.withColumn("ratio", F.exp(new - old))
    clipped = N.clamp(F.col("ratio"), 1 - eps_low, 1 + eps_high)
    return ratio.withColumn("loss", -F.least(F.col("ratio") * F.col("advantage"), clipped * F.col("advantage")))


# ------------------------------------------------------------- batch figures

def token_kl_entropy(df: DataFrame, keys: Sequence[str] = BATCH) -> DataFrame:
    t = token_rows(df, keys, {"p": "logps", "r": "ref_logps", "e": "entropys"})
    return t.groupBy(*keys).agg(F.avg(N.k3(F.col("r"), F.col("p"))).alias("kl"), F.avg("e").alias("entropy"))


def clip_fractions(
    df: DataFrame, keys: Sequence[str] = BATCH, shard: str | None = None, eps_low: float = 0.2, eps_high: float = 0.2
) -> DataFrame:
    """Share of tokens clipped low, high or either. With a ``shard`` column the
    means are of shard means, and the smallest low and largest high are added."""
    inner = [*keys, shard] if shard else list(keys)
    t = token_rows(df, [*inner, "advantage"], {"p": "logps", "o": "old_logps"})
    ratio = F.exp(F.col("p") - F.col("o"))
    low = (ratio < 1 - eps_low) & (F.col("advantage") < 0)
    high = (ratio > 1 + eps_high) & (F.col("advantage") > 0)
    parts = t.groupBy(*inner).agg(
        F.avg(low.cast("double")).alias("low"), F.avg(high.cast("double")).alias("high"),
        F.avg((low | high).cast("double")).alias("either"))
    if not shard:
        return parts
    return parts.groupBy(*keys).agg(
        F.avg("low").alias("low"), F.min("low").alias("low_min"), F.avg("high").alias("high"),
        F.max("high").alias("high_max"), F.avg("either").alias("either"))


def sampling_mismatch(df: DataFrame, keys: Sequence[str] = BATCH, cap: float = 2.0) -> DataFrame:
    """Distance of trainer and sampler log-probs and the capped ratio."""
    t = token_rows(df, keys, {"o": "old_logps", "s": "sampling_logps"})
    gap, ratio = F.abs(F.col("o") - F.col("s")), F.least(F.exp(F.col("o") - F.col("s")), F.lit(float(cap)))
    return t.groupBy(*keys).agg(
        F.avg(gap).alias("gap_mean"), F.max(gap).alias("gap_max"), F.min(ratio).alias("ratio_min"),
        F.avg(ratio).alias("ratio_mean"), F.max(ratio).alias("ratio_max"))


def completion_length_stats(df: DataFrame, keys: Sequence[str] = BATCH, eos: int = EOS_ID) -> DataFrame:
    """Masked lengths of all and of finished completions, and the share that
    did not finish; 0 where a batch has no finished one."""
    length = N.mask_count(F.col("masks"))
    rows = df.select(*keys, length.alias("len"), F.array_contains("token_ids", F.lit(eos).cast("bigint")).alias("done"))
    done = F.when(F.col("done"), F.col("len"))
    return rows.groupBy(*keys).agg(
        F.avg("len").alias("mean"), F.min("len").alias("min"), F.max("len").alias("max"),
        F.coalesce(F.avg(done), F.lit(0.0)).alias("done_mean"), F.coalesce(F.min(done), F.lit(0.0)).alias("done_min"),
        F.coalesce(F.max(done), F.lit(0.0)).alias("done_max"),
        (1 - F.avg(F.col("done").cast("double"))).alias("clipped"))


def top_entropy_mask(df: DataFrame, share: float, keys: Sequence[str] = BATCH) -> DataFrame:
    """1 for masked tokens whose entropy reaches the batch's exact ``1 - share``
    quantile (linear interpolation)."""
    tokens = token_rows(df, keys, {"entropy": "entropys"})
    threshold = exact_quantile(tokens, keys, "entropy", 1 - share)
    threshold = threshold.withColumnsRenamed({"n": "__n", "threshold": "__edge"})
    rows = attach_stats(df, threshold, keys, n="__n")
    hit = F.zip_with("entropys", "masks", lambda e, m: ((e >= F.col("__edge")) & (m == 1)).cast("int"))
    mask = F.coalesce(hit, F.transform("masks", lambda _: F.lit(0)))
    return rows.withColumn("entropy_mask", F.when(F.col("__edge").isNotNull(), mask).otherwise(
        F.transform("masks", lambda _: F.lit(0)))).drop("__n", "__edge")


def masked_whiten(
    df: DataFrame, values: str, mask: str = "masks", keys: Sequence[str] = BATCH, shift_mean: bool = True, eps: float = 1e-8
) -> DataFrame:
    """Whiten token values over the unmasked tokens of the batch; masked
    positions become 0. ``shift_mean=False`` keeps the mean."""
    t = token_rows(df, keys, {"v": values}, mask)
    moments = t.groupBy(*keys).agg(F.avg("v").alias("__m"), F.var_samp("v").alias("__var"), F.count("v").alias("__n"))
    rows = attach_stats(df, moments, keys, n="__n")
    scale = F.sqrt(F.col("__var") + eps)
    back = F.lit(0.0) if shift_mean else F.col("__m")
    white = F.zip_with(values, mask, lambda v, m: F.when(m == 1, (v - F.col("__m")) / scale + back).otherwise(0.0))
    return rows.withColumn(f"{values}_white", white).drop("__m", "__var", "__n")


# -------------------------------------------------------- rewards, advantage

def last_real(token_ids: Column, pad: int = PAD_ID) -> Column:
    """0-based position of the last token before the first padding."""
    first_pad = F.array_position(token_ids, F.lit(pad).cast("bigint"))
    return F.when(first_pad > 0, first_pad - 2).otherwise(F.size(token_ids).cast("bigint") - 1)


def token_rewards(df: DataFrame, kl_coef: float = 0.05, estimator: str = "k1", name: str = "token_rewards") -> DataFrame:
    """-kl_coef * KL per real token, and the score at the position after the
    last real token, or at that token when the sequence is full."""
    one_of(estimator, ["k1", "k3"], "KL estimator")

    def rewards(row: Column, at: Column) -> Column:
        end = F.when(at["last"] + 1 < at["n"], at["last"] + 1).otherwise(at["last"])

        def reward(p: Column, i: Column) -> Column:
            ref = F.get(row["ref"], i)
            kl = p - ref if estimator == "k1" else N.k3(ref, p)
            penalty = F.when(i <= at["last"], kl * -kl_coef).otherwise(0.0)
            return penalty + F.when(i == end, row["score"]).otherwise(0.0)

        return F.transform(row["p"], reward)

    named = {"p": F.col("logps"), "ref": F.col("ref_logps"), "ids": F.col("token_ids"), "score": F.col("score")}
    return df.withColumn(name, N.bound(named, lambda row: N.bound(
        {"last": last_real(row["ids"]), "n": F.size(row["ids"])}, lambda at: rewards(row, at))))


def _discounted(rho: float):
    """Reverse recursion A[t] = d[t] + rho * A[t+1] for each array of a batch.

    An array fold would copy its result at every step, so this one runs on
    padded matrices of a bounded number of cells: one vector step per position.
    """

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        cells = 2_000_000
        for batch in batches:
            out = []
            arrays = [None if a is None else np.asarray(a, dtype="float64") for a in batch]
            sizes = [0 if a is None else len(a) for a in arrays]
            start = 0
            while start < len(arrays):
                stop, width = start, 0
                while stop < len(arrays):
                    wider = max(width, sizes[stop])
                    if stop > start and wider * (stop - start + 1) > cells:
                        break
                    stop, width = stop + 1, wider
                block = np.zeros((stop - start, width))
                for i, n in enumerate(sizes[start:stop]):
                    if n:
                        block[i, :n] = arrays[start + i]
                for t in range(width - 2, -1, -1):
                    block[:, t] += rho * block[:, t + 1]
                out.extend(None if a is None else block[i, : len(a)] for i, a in enumerate(arrays[start:stop]))
                start = stop
            yield pd.Series(out, index=batch.index, dtype=object)

    return F.pandas_udf(run, "array<double>")


def gae(
    df: DataFrame, rewards: str = "token_rewards", values: str = "values", gamma: float = 1.0, lam: float = 0.95
) -> DataFrame:
    """Generalised advantages and returns per token; no shuffle.

    Spark does not run a Python function whose argument holds a lambda that uses
    a variable of a lambda around it, and a column of ``df`` may bring one into the
    argument. The explode of one array keeps all lambdas below the function.
    """
    delta = F.transform(
        F.col(rewards),
        lambda r, i: r + F.coalesce(F.get(F.col(values), i + 1), F.lit(0.0)) * gamma - F.get(F.col(values), i))
    rows = df.withColumn("__delta", F.explode(F.array(delta)))
    rows = rows.withColumn("advantages", _discounted(gamma * lam)(F.col("__delta"))).drop("__delta")
    return rows.withColumn("returns", F.zip_with("advantages", values, lambda a, v: a + v))


def audit_value(df: DataFrame, keys: Sequence[str] = BATCH, clip_value: float = 0.2, clip_ratio: float = 0.2) -> DataFrame:
    """Clipped value loss, clip fractions and approximate KL of a batch; arrays
    ``new_values``, ``values``, ``returns``, ``token_advantages``."""
    t = token_rows(df, keys, {
        "v": "new_values", "old": "values", "ret": "returns", "p": "logps", "o": "old_logps", "adv": "token_advantages"})
    v, ret = F.col("v"), F.col("ret")
    clipped = N.clamp(v, F.col("old") - clip_value, F.col("old") + clip_value)
    plain, held = F.pow(v - ret, 2), F.pow(clipped - ret, 2)
    diff = F.col("p") - F.col("o")
    ratio = F.exp(diff)
    free = -F.col("adv") * ratio
    bound = -F.col("adv") * N.clamp(ratio, 1 - clip_ratio, 1 + clip_ratio)
    return t.groupBy(*keys).agg(
        (F.avg(F.greatest(plain, held)) * 0.5).alias("value_loss"),
        F.avg((held > plain).cast("double")).alias("value_clipped"),
        F.avg(F.greatest(free, bound)).alias("policy_loss"),
        F.avg((bound > free).cast("double")).alias("policy_clipped"),
        (F.avg(diff * diff) * 0.5).alias("approx_kl"), F.avg(ratio).alias("ratio"))


def rollout_summary(df: DataFrame, keys: Sequence[str] = BATCH, kl_coef: float = 0.05, eos: int = EOS_ID) -> DataFrame:
    """Batch means of the per-sequence KL and entropy sums, rewards and scores."""
    kl = N.masked_sum(F.zip_with("logps", "ref_logps", lambda p, r: p - r), F.col("masks"))
    rows = df.select(
        *keys, kl.alias("kl"), (-N.masked_sum(F.col("logps"), F.col("masks"))).alias("entropy"), "score",
        F.size(F.filter("token_ids", lambda x: x == eos)).alias("eos"))
    return rows.groupBy(*keys).agg(
        F.avg("kl").alias("kl"), F.avg("entropy").alias("entropy"), F.avg(F.col("kl") * -kl_coef).alias("non_score_reward"),
        (F.avg(F.col("kl") * -kl_coef) + F.avg("score")).alias("total_reward"), F.avg("score").alias("score"),
        F.sum("eos").alias("eos_tokens"))
