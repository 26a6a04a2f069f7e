"""Group and batch statistics, and the advantages built from them.

A group is ``(run_id, step, prompt_id)``, a batch ``(run_id, step)``. Statistics
are partial+final hash aggregates; rows get them back through
``attach_stats``, so a group of any size never sits in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rollforge.plans.skew import attach_stats
from rollforge.schemas import one_of, require

GROUP = ("run_id", "step", "prompt_id")
BATCH = ("run_id", "step")
ZERO_STD = 1e-8


def stats(df: DataFrame, keys: Sequence[str], value: str = "reward", prefix: str = "") -> DataFrame:
    """Count, sum, mean, sample deviation, extremes per key."""
    require(df, [*keys, value], "stats")
    v = F.col(value)
    return df.groupBy(*keys).agg(
        F.count(v).alias(f"{prefix}n"),
        F.sum(v).alias(f"{prefix}sum"),
        F.avg(v).alias(f"{prefix}mean"),
        F.stddev_samp(v).alias(f"{prefix}std"),
        F.min(v).alias(f"{prefix}min"),
        F.max(v).alias(f"{prefix}max"),
    )


def _with(df: DataFrame, keys: Sequence[str], value: str, prefix: str, source: DataFrame | None = None) -> DataFrame:
    """``source``: the rows of ``df`` before other figures were joined to them, not to join them twice."""
    moments = stats(df if source is None else source, keys, value, prefix).select(
        *keys, f"{prefix}n", f"{prefix}sum", f"{prefix}mean", f"{prefix}std"
    )
    return attach_stats(df, moments, keys, n=f"{prefix}n")


def _drop(df: DataFrame, prefix: str) -> DataFrame:
    return df.drop(*[f"{prefix}{c}" for c in ("n", "sum", "mean", "std")])


def group_z(
    df: DataFrame, value: str = "reward", keys: Sequence[str] = GROUP, eps: float = 1e-8, name: str = "advantage"
) -> DataFrame:
    """(r - mean) / (std + eps) per group; a std of 0 counts as 1. A group of
    one row has no sample deviation and gets NULL."""
    j = _with(df, keys, value, "__g_")
    std = F.when(F.col("__g_std") == 0, 1.0).otherwise(F.col("__g_std"))
    return _drop(j.withColumn(name, (F.col(value) - F.col("__g_mean")) / (std + eps)), "__g_")


def scaled(
    df: DataFrame,
    scale: str = "group",
    value: str = "reward",
    group: Sequence[str] = GROUP,
    batch: Sequence[str] = BATCH,
    eps: float = 1e-4,
) -> DataFrame:
    """r - group mean, divided by the group's or the batch's std, or by nothing.
    ``zero_std`` marks rows whose scaling deviation is about 0."""
    one_of(scale, ["group", "batch", "none"], "scale")
    j = _with(df, group, value, "__g_")
    centred = F.col(value) - F.col("__g_mean")
    if scale == "batch":
        j = _with(j, batch, value, "__b_", df)
        std = F.col("__b_std")
    else:
        std = F.col("__g_std")
    advantage = centred if scale == "none" else centred / (std + eps)
    out = j.withColumn("advantage", advantage).withColumn("zero_std", F.abs(std) <= ZERO_STD)
    return _drop(_drop(out, "__g_"), "__b_")


def batch_z(df: DataFrame, value: str = "reward", keys: Sequence[str] = BATCH, eps: float = 1e-8) -> DataFrame:
    """Normalise over the whole batch, whatever the prompt."""
    j = _with(df, keys, value, "__b_")
    std = F.when(F.col("__b_std") == 0, 1.0).otherwise(F.col("__b_std"))
    return _drop(j.withColumn("advantage", (F.col(value) - F.col("__b_mean")) / (std + eps)), "__b_")


def leave_one_out(df: DataFrame, value: str = "reward", keys: Sequence[str] = GROUP) -> DataFrame:
    """r - mean of the other rows of the group; NULL for a group of one."""
    j = _with(df, keys, value, "__g_")
    others = F.col("__g_n") - 1
    baseline = F.when(others > 0, (F.col("__g_sum") - F.col(value)) / others)
    return _drop(j.withColumn("advantage", F.col(value) - baseline), "__g_")


def whiten(
    df: DataFrame, value: str = "advantage", keys: Sequence[str] = BATCH, eps: float = 1e-4, name: str = "whitened"
) -> DataFrame:
    j = _with(df, keys, value, "__b_")
    return _drop(j.withColumn(name, (F.col(value) - F.col("__b_mean")) / (F.col("__b_std") + eps)), "__b_")


def batch_reward_stats(df: DataFrame, advantage: str = "advantage") -> DataFrame:
    r, a = F.col("reward"), F.col(advantage)
    return df.groupBy(*BATCH).agg(
        F.avg(r).alias("reward_mean"), F.stddev_samp(r).alias("reward_std"), F.min(r).alias("reward_min"),
        F.max(r).alias("reward_max"), F.avg(a).alias("advantage_mean"), F.stddev_samp(a).alias("advantage_std"),
    )


def epoch_rewards(df: DataFrame, keys: Sequence[str] = ("run_id", "epoch")) -> DataFrame:
    r = F.col("reward")
    return df.groupBy(*keys).agg(
        F.sum(r).alias("reward_sum"), F.avg(r).alias("reward_mean"), F.count(r).alias("n")
    )


def func_summary(long: DataFrame) -> DataFrame:
    """Mean and deviation of each function over the rows it applied to."""
    return long.groupBy(*BATCH, "func").agg(
        F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"), F.count("value").alias("applied")
    )


def overall_summary(df: DataFrame) -> DataFrame:
    """Batch means of the group mean, group deviation and zero-deviation share."""
    groups = stats(df, GROUP)
    return groups.groupBy(*BATCH).agg(
        F.avg("mean").alias("reward"), F.avg("std").alias("reward_std"),
        F.avg((F.abs(F.col("std")) <= ZERO_STD).cast("double")).alias("frac_zero_std"),
    )


def running_total(df: DataFrame, keys: Sequence[str], order: str, value: Column, name: str) -> DataFrame:
    """Running total over steps; only per-step sums reach the window."""
    per_step = df.groupBy(*keys, order).agg(F.sum(value).alias("__v"))
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return per_step.withColumn(name, F.sum("__v").over(w)).drop("__v")
