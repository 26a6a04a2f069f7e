"""Preference objectives and metrics over logged log-probabilities.

``c, r`` are policy log-probs of the chosen and rejected response, ``c0, r0``
the reference's. Every objective is a Column, so several are one projection.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rollforge.functions import numeric as N
from rollforge.operators.joins import rank_align
from rollforge.plans.skew import attach_stats, range_running
from rollforge.schemas import one_of, require

DIVERGENCES = ("reverse_kl", "alpha", "js")
ROW_LOSSES = (
    "sigmoid", "robust", "exo_pair", "hinge", "ipo", "sppo_hard", "nca_pair", "apo_zero", "apo_down", "discopop",
)
# losses that need a figure of the whole batch
BATCH_LOSSES = ("bco_pair", "sft", "aot", "aot_pair")


@dataclass(frozen=True)
class Settings:
    beta: float = 0.1
    label_smoothing: float = 0.0
    divergence: str = "reverse_kl"
    alpha: float = 1.0
    tau: float = 0.05
    reference_free: bool = False


def log_ratios(s: Settings, c: Column, r: Column, c0: Column, r0: Column) -> tuple[Column, Column, Column]:
    """(a, b, h): chosen and rejected log-ratio, and the pair's logit."""
    one_of(s.divergence, DIVERGENCES, "divergence")
    a, b = (c, r) if s.reference_free else (c - c0, r - r0)
    if s.divergence == "alpha":
        return a, b, (N.capped_exp(b * -s.alpha) - N.capped_exp(a * -s.alpha)) / s.alpha
    h = a - b
    if s.divergence == "js":
        h = h - (N.softplus(a) - N.softplus(b))
    return a, b, h


def smoothed(x: Column, smoothing: float) -> Column:
    """-log sigmoid(x), with the label taken as wrong with some probability."""
    if smoothing == 0:
        return -N.log_sigmoid(x)
    return -N.log_sigmoid(x) * (1 - smoothing) - N.log_sigmoid(-x) * smoothing


def row_loss(
    loss: str, s: Settings, a: Column, b: Column, h: Column, mean_h: Column | None = None,
    raw: tuple[Column, Column] | None = None,
) -> Column:
    """One objective from the log-ratios of a row. ``ipo`` uses ``mean_h``, the
    logit of length-averaged log-probs, where given. ``sppo_hard``, ``nca_pair``
    and ``discopop`` are defined on the ratios to the reference, whatever the
    divergence and with ``reference_free`` too: those are ``raw``."""
    one_of(loss, ROW_LOSSES, "loss type")
    beta, e = s.beta, s.label_smoothing
    if raw is not None and loss in ("sppo_hard", "nca_pair", "discopop"):
        a, b = raw
        h = a - b
    x = h * beta
    if loss == "sigmoid":
        return smoothed(x, e)
    if loss == "robust":
        return (-N.log_sigmoid(x) * (1 - e) + N.log_sigmoid(-x) * e) / (1 - 2 * e)
    if loss == "exo_pair":
        e = e or 1e-3
        return N.sigmoid(x) * (N.log_sigmoid(x) - F.log(F.lit(1 - e))) + N.sigmoid(-x) * (
            N.log_sigmoid(-x) - F.log(F.lit(e)))
    if loss == "hinge":
        return F.greatest(F.lit(0.0), 1 - x)
    if loss == "ipo":
        return F.pow((h if mean_h is None else mean_h) - 1 / (2 * beta), 2)
    if loss == "sppo_hard":
        return F.pow(a - 0.5 / beta, 2) + F.pow(b + 0.5 / beta, 2)
    if loss == "nca_pair":
        return -N.log_sigmoid(a * beta) - N.log_sigmoid(-a * beta) * 0.5 - N.log_sigmoid(-b * beta) * 0.5
    if loss == "apo_zero":
        return 1 - N.sigmoid(a * beta) + N.sigmoid(b * beta)
    if loss == "apo_down":
        return N.sigmoid(a * beta) + 1 - N.sigmoid((a - b) * beta)
    modulation = N.sigmoid(x / s.tau)
    return -N.log_sigmoid(x) * (1 - modulation) + F.exp(-x) * modulation


def audit_rows(df: DataFrame, losses: Sequence[str] = ROW_LOSSES, s: Settings = Settings()) -> DataFrame:
    """``loss_<type>`` per pair, in one projection."""
    require(df, ["c", "r", "c0", "r0"], "audit_rows")
    c, r, c0, r0 = (F.col(x) for x in ("c", "r", "c0", "r0"))
    a, b, h = log_ratios(s, c, r, c0, r0)
    mean_h = None
    if {"n_c", "n_r"} <= set(df.columns):
        n_c, n_r = F.col("n_c"), F.col("n_r")
        means = [F.try_divide(x, n) for x, n in ((c, n_c), (r, n_r), (c0, n_c), (r0, n_r))]
        mean_h = log_ratios(s, *means)[2]
    raw = (c - c0, r - r0)
    return df.select("*", *[row_loss(x, s, a, b, h, mean_h, raw).alias(f"loss_{x}") for x in losses])


def implicit_rewards(df: DataFrame, beta: float = 0.1) -> DataFrame:
    return df.withColumns({
        "reward_chosen": (F.col("c") - F.col("c0")) * beta, "reward_rejected": (F.col("r") - F.col("r0")) * beta})


def reward_baseline(
    rewards: DataFrame, order: str, value: str, weight: str = "per_row", keys: Sequence[str] = ()
) -> DataFrame:
    """Mean of all rewards up to and including each step. ``per_row`` weighs
    every row alike, ``per_batch`` every step. Only step sums enter the window."""
    one_of(weight, ["per_row", "per_batch"], "baseline weight")
    keys = list(keys)
    steps = rewards.groupBy(*keys, order).agg(F.sum(value).alias("__s"), F.count(value).alias("__n"))
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    if weight == "per_row":
        mean = F.try_divide(F.sum("__s").over(w), F.sum("__n").over(w))
    else:
        mean = F.avg(F.try_divide("__s", "__n")).over(w)
    return steps.select(*keys, order, mean.alias("delta"), F.col("__n").alias("n"))


def audit_running_baseline(
    df: DataFrame, step: str = "step", s: Settings = Settings(), keys: Sequence[str] = ()
) -> DataFrame:
    """``bco_pair``: both rewards against the running mean of all rewards of the
    run that ``keys`` name."""
    rewarded = implicit_rewards(df, s.beta)
    both = rewarded.select(*keys, step, F.explode(F.array("reward_chosen", "reward_rejected")).alias("reward"))
    delta = reward_baseline(both, step, "reward", "per_batch", keys)
    rows = attach_stats(rewarded, delta.withColumnRenamed("n", "__n"), [*keys, step], n="__n")
    loss = -N.log_sigmoid(F.col("reward_chosen") - F.col("delta")) - N.log_sigmoid(
        F.col("delta") - F.col("reward_rejected"))
    return rows.withColumn("loss_bco_pair", loss).drop("__n")


def audit_sft(df: DataFrame, keys: Sequence[str] = ("step",)) -> DataFrame:
    """Batch negative log-likelihood per chosen token, the same for each row;
    this objective defines no implicit rewards."""
    nll = df.groupBy(*keys).agg(
        F.try_divide(-F.sum("c"), F.sum("n_c")).alias("loss_sft"), F.count(F.lit(1)).alias("__n"))
    empty = F.lit(None).cast("double")
    return attach_stats(df, nll, keys, n="__n").drop("__n").withColumns({"reward_chosen": empty, "reward_rejected": empty})


def audit_aligned(df: DataFrame, loss: str, row: str, keys: Sequence[str], s: Settings = Settings()) -> DataFrame:
    """``aot`` / ``aot_pair``: sigmoid objective on rank-aligned differences."""
    one_of(loss, ["aot", "aot_pair"], "loss type")
    if loss == "aot_pair":
        a, b = F.col("c") - F.col("c0"), F.col("r") - F.col("r0")
    else:
        a, b = F.col("c") - F.col("r"), F.col("c0") - F.col("r0")
    aligned = rank_align(df.select(*keys, row, a.alias("a"), b.alias("b")), keys, row, "a", "b")
    return aligned.withColumn(f"loss_{loss}", smoothed(F.col("delta") * s.beta, s.label_smoothing))


def audit_mix(
    df: DataFrame,
    weights: Mapping[str, float],
    s: Settings = Settings(),
    rpo_alpha: float = 0.0,
    use_weighting: bool = False,
    step: str = "step",
    keys: Sequence[str] = (),
    row: str = "pair_id",
) -> DataFrame:
    """Weighted sum of objectives, of a row or of its batch: ``sft``,
    ``bco_pair``, ``aot`` and ``aot_pair`` are per (``keys``, ``step``). The loss
    of the aligned differences of rank i goes to the i-th row of the batch in
    order of ``row``. Optionally plus ``rpo_alpha`` times the
    pair's negative log-likelihood, and times ``min(1, exp(w_c + w_r))`` with
    the mean token log-probs as weights."""
    rows = df
    if "sft" in weights:
        rows = audit_sft(rows, [*keys, step]).drop("reward_chosen", "reward_rejected")
    if "bco_pair" in weights:
        rows = audit_running_baseline(rows, step, s, keys).drop("reward_chosen", "reward_rejected", "delta")
    rows = audit_rows(rows, [x for x in weights if x not in BATCH_LOSSES], s)
    batch = [*keys, step]
    aligned = [x for x in weights if x in ("aot", "aot_pair")]
    if aligned:
        rows = range_running(rows, batch, [row], name="__rank")
    for loss in aligned:
        by_rank = audit_aligned(df, loss, row, batch, s).select(*batch, F.col("rank").alias("__rank"), f"loss_{loss}")
        rows = rows.join(by_rank, [*batch, "__rank"])
    rows = rows.drop("__rank")
    total = sum((F.col(f"loss_{x}") * float(w) for x, w in weights.items()), F.lit(0.0))
    if rpo_alpha:
        total = total + F.col("nll") * float(rpo_alpha)
    if use_weighting:
        total = total * F.least(F.lit(1.0), F.exp(F.try_divide("c", "n_c") + F.try_divide("r", "n_r")))
    scale = float(sum(weights.values()))
    rewarded = implicit_rewards(rows, s.beta * scale)
    return rewarded.withColumn("loss", total)


def step_means(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(*[F.avg(c).alias(c) for c in columns])


def preference_metrics(df: DataFrame, keys: Sequence[str], beta: float = 0.1) -> DataFrame:
    """Mean implicit rewards, accuracy, margin and log-probs per batch."""
    r = implicit_rewards(df, beta)
    a, b = F.col("reward_chosen"), F.col("reward_rejected")
    extra = [F.avg(c).alias(c) for c in ("logits_chosen", "logits_rejected") if c in df.columns]
    return r.groupBy(*keys).agg(
        F.avg(a).alias("reward_chosen"), F.avg(b).alias("reward_rejected"),
        F.avg((a > b).cast("double")).alias("accuracy"), F.avg(a - b).alias("margin"),
        F.avg("c").alias("logps_chosen"), F.avg("r").alias("logps_rejected"), *extra,
    )


# ------------------------------------------------------------ reference-free

def audit_reference_free(
    df: DataFrame, loss: str, beta: float = 0.1, smoothing: float = 0.0, gamma: float = 0.5, alpha: float = 0.0,
    nll_weight: float = 0.0,
) -> DataFrame:
    """Objectives without a reference model; ``alpha`` switches to transformed
    rewards ``(1 - p^-alpha) / alpha``."""
    one_of(loss, ["sigmoid", "hinge", "ipo", "simpo"], "loss type")
    c, r = F.col("c"), F.col("r")
    if alpha:
        c, r = ((1 - F.exp(x * -alpha)) / alpha for x in (c, r))
    h = c - r
    if loss == "simpo":
        h = h - gamma / beta
    if loss == "hinge":
        value = F.greatest(F.lit(0.0), 1 - h * beta)
    elif loss == "ipo":
        value = F.pow(h - 1 / (2 * beta), 2)
    else:
        value = smoothed(h * beta, smoothing)
    if nll_weight:
        value = value + F.col("nll") * nll_weight
    return df.withColumns({"loss": value, "reward_chosen": c * beta, "reward_rejected": r * beta})


def odds_ratio(df: DataFrame, beta: float = 0.1) -> DataFrame:
    """Log-odds and its log-sigmoid; undefined (NULL) where a log-prob is 0."""

    def log1mexp(x: Column) -> Column:
        return F.when(x < 0, F.log1p(-F.exp(x)))

    log_odds = (F.col("c") - F.col("r")) - (log1mexp(F.col("c")) - log1mexp(F.col("r")))
    odds = df.withColumn("log_odds", log_odds)
    odds = odds.withColumn("ratio", N.log_sigmoid(F.col("log_odds")))
    return odds.withColumn("loss", F.col("nll") - F.col("ratio") * beta)


def odds_ratio_summary(df: DataFrame, keys: Sequence[str], beta: float = 0.1) -> DataFrame:
    o = odds_ratio(df, beta)
    return o.groupBy(*keys).agg(
        F.avg("log_odds").alias("log_odds"), F.avg("ratio").alias("ratio"),
        (F.avg("nll") - F.avg("ratio") * beta).alias("loss"))


# ------------------------------------------------------------------ unpaired

def audit_unpaired(
    df: DataFrame, keys: Sequence[str], loss: str = "kto", beta: float = 0.1,
    desirable_weight: float = 1.0, undesirable_weight: float = 1.0,
) -> DataFrame:
    """Labelled rows against the batch's KL estimate, which is the mean
    log-ratio of the mismatched pairs, at least 0."""
    one_of(loss, ["kto", "apo_zero_unpaired"], "loss type")
    kl = df.groupBy(*keys).agg(
        F.greatest(F.lit(0.0), F.avg(F.col("kl_logp") - F.col("kl_ref_logp"))).alias("kl"),
        F.count(F.lit(1)).alias("__n"))
    rows = attach_stats(df, kl, keys, n="__n").drop("__n")
    ratio, k = F.col("logp") - F.col("ref_logp"), F.col("kl")
    if loss == "kto":
        good, bad = 1 - N.sigmoid((ratio - k) * beta), 1 - N.sigmoid((k - ratio) * beta)
    else:
        good, bad = 1 - N.sigmoid(ratio * beta), N.sigmoid(ratio * beta)
    value = F.when(F.col("label"), good * desirable_weight).otherwise(bad * undesirable_weight)
    return rows.withColumns({"reward": ratio * beta, "loss": value})


def unpaired_metrics(df: DataFrame, keys: Sequence[str], beta: float = 0.1) -> DataFrame:
    """Class means from class sums and counts, and the reward margin."""
    reward = (F.col("logp") - F.col("ref_logp")) * beta
    values = {"rewards": reward, "logps": F.col("logp"), "logits": F.col("logits")}
    sides = {"chosen": F.col("label"), "rejected": ~F.col("label")}
    # fixed-point sums do not depend on the order of the rows
    exact = {n: v.cast("decimal(38,9)") for n, v in values.items()}
    sums = df.groupBy(*keys).agg(
        *[
            F.sum(F.when(test, v)).cast("double").alias(f"{n}_{side}_sum")
            for side, test in sides.items() for n, v in exact.items()
        ],
        *[F.count(F.when(test, 1)).alias(f"count_{side}") for side, test in sides.items()],
    )
    means = sums.select(
        *keys, "count_chosen", "count_rejected",
        *[
            F.when(F.col(f"count_{side}") > 0, F.col(f"{n}_{side}_sum") / F.col(f"count_{side}")).alias(f"{n}_{side}")
            for side in sides for n in values
        ],
    )
    return means.withColumn("margin", F.col("rewards_chosen") - F.col("rewards_rejected"))


def class_balance(df: DataFrame, desirable_weight: float = 1.0, undesirable_weight: float = 1.0) -> DataFrame:
    """Class counts and the recommended ranges of the class weights."""
    counts = df.agg(F.sum(F.col("label").cast("bigint")).alias("d"), F.count(F.lit(1)).alias("n"))
    counts = counts.withColumn("desirable", F.greatest(F.coalesce("d", F.lit(0)), F.lit(1)))
    counts = counts.withColumn("undesirable", F.greatest(F.col("n") - F.col("desirable"), F.lit(1)))
    up = F.col("undesirable") * undesirable_weight / F.col("desirable")
    down = F.col("desirable") * desirable_weight / F.col("undesirable")
    out = counts.select(
        "desirable", "undesirable",
        F.round(up, 2).alias("des_low"), F.round(up * 1.33, 2).alias("des_high"),
        F.round(down / 1.33, 2).alias("und_low"), F.round(down, 2).alias("und_high"),
    )
    return out.withColumns({
        "des_in_range": F.lit(desirable_weight).between(F.col("des_low"), F.col("des_high")),
        "und_in_range": F.lit(undesirable_weight).between(F.col("und_low"), F.col("und_high"))})


def audit_binary_classifier(
    df: DataFrame, step: str, weight: str = "per_row", beta: float = 0.1, density: str | None = None,
    keys: Sequence[str] = (),
) -> DataFrame:
    """Rewards against the running mean reward of the run that ``keys`` name;
    undesirable rows optionally weighted by a density ratio."""
    rewarded = df.withColumn("reward", (F.col("logp") - F.col("ref_logp")) * beta)
    delta = reward_baseline(rewarded, step, "reward", weight, keys).withColumnRenamed("n", "__n")
    rows = attach_stats(rewarded, delta, [*keys, step], n="__n").drop("__n")
    x = F.col("reward") - F.col("delta")
    w = F.lit(1.0) if density is None else F.col(density)
    return rows.withColumn("loss", F.when(F.col("label"), -N.log_sigmoid(x)).otherwise(-N.log_sigmoid(-x) * w))


def density_ratio_weights(
    embeddings: DataFrame, key: str, vector: str, label: str, low: float = 0.5, high: float = 10.0, c: float = 1.0
) -> tuple[DataFrame, DataFrame]:
    """Weights of undesirable rows by how desirable their prompt embedding
    looks to a balanced logistic regression, and its accuracy per class. The
    regression has an L2 term of inverse strength ``c``: the sum of weighted
    losses times ``c`` plus half the squared coefficients is least."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.functions import array_to_vector, vector_to_array

    rows = embeddings.select(key, array_to_vector(F.col(vector).cast("array<double>")).alias("features"),
                             F.col(label).cast("double").alias("label"))
    sizes = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if set(sizes) != {0.0, 1.0}:
        raise ValueError("density_ratio_weights needs both classes")
    total = sum(sizes.values())
    balanced = F.when(F.col("label") == 1, total / (2 * sizes[1.0])).otherwise(total / (2 * sizes[0.0]))
    # balanced weights add up to the number of rows
    fitted = LogisticRegression(
        weightCol="weight", maxIter=200, tol=1e-9, regParam=1.0 / (c * total), elasticNetParam=0.0, standardization=False
    ).fit(rows.withColumn("weight", balanced))
    scored = fitted.transform(rows).withColumn("p", vector_to_array("probability")[1])
    ratio = N.clamp(F.col("p") / (1 - F.col("p") + 1e-8), low, high)
    weights = scored.where(F.col("label") == 0).select(key, "p", ratio.alias("weight"))
    accuracy = scored.groupBy("label").agg(F.avg((F.col("prediction") == F.col("label")).cast("double")).alias("accuracy"))
    return weights, accuracy


# -------------------------------------------------------------- scored pairs

def audit_margin(df: DataFrame, keys: Sequence[str], centre: float | None = None, margin: bool = True) -> DataFrame:
    x = F.col("score_chosen") - F.col("score_rejected")
    if margin:
        x = x - F.col("margin")
    loss = F.avg(-N.log_sigmoid(x))
    if centre is not None:
        loss = loss + F.avg(F.pow(F.col("score_chosen") + F.col("score_rejected"), 2)) * centre
    return df.groupBy(*keys).agg(loss.alias("loss"))


def scored_pair_accuracy(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.avg((F.col("score_chosen") > F.col("score_rejected")).cast("double")).alias("accuracy"))


# -------------------------------------------- online, exploration, game audits

def pair_objective(loss: str, logits: Column, beta: float) -> Column:
    one_of(loss, ["sigmoid", "ipo"], "loss type")
    return -N.log_sigmoid(logits * beta) if loss == "sigmoid" else F.pow(logits - 1 / (2 * beta), 2)


def audit_online_pair(pairs: DataFrame, loss: str = "sigmoid", beta: float = 0.1) -> DataFrame:
    """Objective of scored pairs from the log-prob sums of both completions."""
    logits = (F.col("chosen_logp") - F.col("rejected_logp")) - (F.col("chosen_ref") - F.col("rejected_ref"))
    return pairs.withColumn("loss", pair_objective(loss, logits, beta))


def online_pair_summary(pairs: DataFrame, keys: Sequence[str], beta: float = 0.1) -> DataFrame:
    """Batch means over pairs, and over both completions where a figure is per
    completion."""
    a = (F.col("chosen_logp") - F.col("chosen_ref")) * beta
    b = (F.col("rejected_logp") - F.col("rejected_ref")) * beta
    kl = F.col("chosen_logp") - F.col("chosen_ref") + F.col("rejected_logp") - F.col("rejected_ref")
    scores = F.col("chosen_score") + F.col("rejected_score")
    return pairs.groupBy(*keys).agg(
        F.avg(F.col("chosen_score") - F.col("rejected_score")).alias("scores_margin"),
        F.avg(scores / 2).alias("scores"),
        F.avg((F.col("chosen_eos").cast("double") + F.col("rejected_eos").cast("double")) / 2).alias("eos_rate"),
        F.avg("chosen_logp").alias("logps_chosen"), F.avg("rejected_logp").alias("logps_rejected"),
        F.avg(kl / 2).alias("kl"), F.avg(kl * (-beta / 2)).alias("non_score_reward"),
        F.avg(scores / 2 - kl * (beta / 2)).alias("total_reward"),
        F.avg(-(F.col("chosen_logp") + F.col("rejected_logp")) / 2).alias("entropy"),
        F.avg(a).alias("reward_chosen"), F.avg(b).alias("reward_rejected"), F.avg(a - b).alias("margin"),
        F.avg((a > b).cast("double")).alias("accuracy"),
    )


def audit_exploration(selected: DataFrame, loss: str = "sigmoid", beta: float = 0.1, alpha: float = 1e-5) -> DataFrame:
    """Pair objective plus ``alpha`` times the model's log-prob of the reference
    completion; input is ``model_vs_ref``."""
    logits = (F.col("chosen_model") - F.col("chosen_ref")) - (F.col("rejected_model") - F.col("rejected_ref"))
    return selected.withColumns({
        "pair_loss": pair_objective(loss, logits, beta), "explore_loss": F.col("model_on_ref") * alpha
    }).withColumn("loss", F.col("pair_loss") + F.col("explore_loss"))


def explore_pair_summary(audited: DataFrame, keys: Sequence[str], beta: float = 0.1) -> DataFrame:
    a = (F.col("chosen_model") - F.col("chosen_ref")) * beta
    b = (F.col("rejected_model") - F.col("rejected_ref")) * beta
    kl = F.col("model_on_model") - F.col("ref_on_model") + F.col("model_on_ref") - F.col("ref_on_ref")
    return audited.groupBy(*keys).agg(
        F.avg("pair_loss").alias("pair_loss"), F.avg("explore_loss").alias("explore_loss"),
        F.avg("model_score").alias("model_scores"), F.avg("ref_score").alias("ref_scores"),
        F.avg(F.col("model_score") - F.col("ref_score")).alias("scores_margin"),
        F.avg(F.col("chosen_model") + F.col("chosen_ref")).alias("logps_chosen"),
        F.avg(F.col("rejected_model") + F.col("rejected_ref")).alias("logps_rejected"),
        F.avg(a).alias("reward_chosen"), F.avg(b).alias("reward_rejected"), F.avg(kl / 2).alias("kl"),
        F.avg(-(F.col("model_on_model") + F.col("model_on_ref")) / 2).alias("entropy"),
        F.avg(a - b).alias("margin"), F.avg((a - b > 0).cast("double")).alias("accuracy"),
        F.avg(F.col("model_eos").cast("double")).alias("model_eos"),
        F.avg(F.col("ref_eos").cast("double")).alias("ref_eos"),
    )


def audit_game(df: DataFrame, beta: float = 0.1) -> DataFrame:
    """beta * sum((logp - ref) * logp) - (prob - 0.5) * sum(logp) over the
    completion; arrays ``logps`` and ``ref_logps``."""
    product = N.array_total(F.zip_with("logps", "ref_logps", lambda p, r: (p - r) * p))
    total, ref = N.array_total(F.col("logps")), N.array_total(F.col("ref_logps"))
    scored = df.withColumns({
        "logp_sum": total, "ref_sum": ref, "kl_loss": product}).withColumns({
        "game_score": (F.col("prob") - 0.5) * F.col("logp_sum"), "kl": F.col("logp_sum") - F.col("ref_sum")})
    return scored.withColumn("loss", F.col("kl_loss") * beta - F.col("game_score"))


def game_summary(audited: DataFrame, keys: Sequence[str]) -> DataFrame:
    margin = F.col("logp_sum") - F.col("ref_sum")
    return audited.groupBy(*keys).agg(
        F.avg("game_score").alias("score"), F.avg("kl").alias("kl"), F.avg("logp_sum").alias("logps_chosen"),
        F.avg("ref_sum").alias("logps_rejected"), F.avg("model_score").alias("reward_chosen"),
        F.avg("mixture_score").alias("reward_rejected"), F.avg("prob").alias("probability"),
        F.avg(-F.col("logp_sum")).alias("entropy"), F.avg(margin).alias("margin"),
        F.avg((margin > 0).cast("double")).alias("accuracy"),
        F.avg(F.col("model_eos").cast("double")).alias("model_eos"),
        F.avg(F.col("mixture_eos").cast("double")).alias("mixture_eos"),
    )


def generalized_jsd(dist: DataFrame, beta: float, student: str, teacher: str, keys: Sequence[str] = ("pos",)) -> DataFrame:
    """Divergence of two logged token distributions per position. A token that
    only one side lists has probability 0 on the other."""
    if not 0.0 <= beta <= 1.0:
        raise ValueError("beta must be between 0 and 1")
    both = dist.groupBy(*keys, "token").agg(
        F.max(F.when(F.col("side") == student, F.col("logp"))).alias("s"),
        F.max(F.when(F.col("side") == teacher, F.col("logp"))).alias("t"),
    )
    p_s, p_t = F.coalesce(F.exp("s"), F.lit(0.0)), F.coalesce(F.exp("t"), F.lit(0.0))

    def kl(p: Column, log_p: Column, log_q: Column) -> Column:
        return F.when(p > 0, p * (log_p - log_q)).otherwise(0.0)

    infinite = F.lit(float("inf"))
    if beta == 0:
        value = F.when((p_t > 0) & F.col("s").isNull(), infinite).otherwise(kl(p_t, F.col("t"), F.col("s")))
    elif beta == 1:
        value = F.when((p_s > 0) & F.col("t").isNull(), infinite).otherwise(kl(p_s, F.col("s"), F.col("t")))
    else:
        mix = F.log(p_s * (1 - beta) + p_t * beta)
        value = kl(p_t, F.col("t"), mix) * beta + kl(p_s, F.col("s"), mix) * (1 - beta)
    return both.groupBy(*keys).agg(F.sum(value).alias("jsd"))
