"""Training-metric logs in batch."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollforge.operators.groups import running_total
from rollforge.plans.skew import attach_stats
from rollforge.plans.storage import materialize

# Folders of one flush of the metric table.
RUN_BUCKETS = 64


def long_metrics(wide: DataFrame, keys: Sequence[str], names: Sequence[str]) -> DataFrame:
    """One row per metric from one column per metric; missing values are left out."""
    entries = F.array(*[F.struct(F.lit(n).alias("name"), F.col(f"`{n}`").cast("double").alias("value")) for n in names])
    rows = wide.select(*keys, F.explode(entries).alias("m")).select(*keys, "m.name", "m.value")
    return rows.where(F.col("value").isNotNull())


def flatten_metrics(df: DataFrame, keys: Sequence[str], nested: str) -> DataFrame:
    """``group -> (name -> value)`` maps as ``group/name`` rows."""
    outer = df.select(*keys, F.explode(nested).alias("__group", "__inner"))
    return outer.select(*keys, "__group", F.explode("__inner").alias("__name", "value")).select(
        *keys, F.concat_ws("/", "__group", "__name").alias("name"), "value")


def append_metrics(metrics: DataFrame, path: str, flush: int = 0) -> None:
    """Add a flush of rows to the metric table, partitioned by flush and by
    ``run_bucket``, a fold of the run.

    A flush that is appended again (after a lost run) replaces its rows of the
    runs it has; other flushes and runs stay as they are. A flush has
    ``RUN_BUCKETS`` folders at most, however many runs there are. Runs share a
    folder, so appends of one flush must take turns. A null run is a run.
    """
    fold = F.pmod(F.xxhash64(F.col("run_id").cast("string")), F.lit(RUN_BUCKETS)).cast("int")
    rows = metrics.withColumn("flush", F.lit(flush)).withColumn("run_bucket", fold)
    spark = metrics.sparkSession
    try:
        earlier = spark.read.option("basePath", path).option("mergeSchema", True).parquet(f"{path}/flush={flush}")
    except AnalysisException as e:  # the flush is new
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        earlier = None
    if earlier is not None:
        rows = materialize(rows, "flush")
        touched = [r[0] for r in rows.select("run_bucket").distinct().collect()]
        runs = rows.select(F.col("run_id").alias("__run")).distinct()
        kept = earlier.where(F.col("run_bucket").isin(touched))
        kept = kept.join(runs, F.col("run_id").eqNullSafe(F.col("__run")), "left_anti")
        # written apart first: the folders it is read from are replaced
        rows = rows.unionByName(materialize(kept, "kept_runs"), allowMissingColumns=True)
    # few files a folder, but more than one task for a run that holds most rows
    rows = rows.hint("rebalance", "run_bucket")
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("flush", "run_bucket").parquet(path)


def tokens_seen(tokens: DataFrame, keys: Sequence[str], step: str, n: str) -> DataFrame:
    return running_total(tokens, keys, step, F.col(n), "tokens_seen")


def run_summary(metrics: DataFrame, loss: str, reward: str, order: str = "event_id") -> DataFrame:
    """Last, mean and least loss; mean, largest and least reward of each run."""
    is_loss, is_reward = F.col("name") == loss, F.col("name") == reward
    lv, rv = F.when(is_loss, F.col("value")), F.when(is_reward, F.col("value"))
    return metrics.where(is_loss | is_reward).groupBy("run_id").agg(
        F.max_by(lv, F.when(is_loss, F.col(order))).alias("loss_last"), F.avg(lv).alias("loss_mean"),
        F.min(lv).alias("loss_min"), F.avg(rv).alias("reward_mean"), F.max(rv).alias("reward_max"),
        F.min(rv).alias("reward_min"))


def flush_average(metrics: DataFrame, logging_steps: int, mode: str | None = None) -> DataFrame:
    """Mean of each metric per logging interval; names of evaluation rows get
    the ``eval_`` prefix."""
    name = F.col("name") if mode is None else F.when(
        F.col(mode) == "eval", F.concat(F.lit("eval_"), "name")).otherwise(F.col("name"))
    interval = F.expr(f"step div {int(logging_steps)}")
    return metrics.groupBy("run_id", interval.alias("interval"), name.alias("name")).agg(
        F.avg("value").alias("value"), F.count("value").alias("n"))


def histogram(df: DataFrame, keys: Sequence[str], value: str, bins: int = 20) -> DataFrame:
    """Equal-width bins between the least and the largest value of each key; the
    largest value belongs to the last bin."""
    present = df.where(F.col(value).isNotNull())
    edges = present.groupBy(*keys).agg(F.min(value).alias("__lo"), F.max(value).alias("__hi"), F.count(value).alias("__n"))
    # few edges are broadcast and rows binned where they are, so that only bins are shuffled
    rows = attach_stats(present.select(*keys, value), edges, keys, n="__n")
    width = (F.col("__hi") - F.col("__lo")) / bins
    slot = F.when(width == 0, 1).otherwise(
        F.least(F.lit(bins), F.floor((F.col(value) - F.col("__lo")) / (F.col("__hi") - F.col("__lo")) * bins).cast("int") + 1))
    return rows.groupBy(*keys, slot.alias("bin")).agg(
        F.count(F.lit(1)).alias("n"), F.min(F.col("__lo") + (slot - 1) * width).alias("low"))


def compute_metrics(df: DataFrame, keys: Sequence[str], metrics: Mapping[str, Column]) -> DataFrame:
    """User metrics per key: aggregate Columns, or a grouped ``pandas_udf``."""
    return df.groupBy(*keys).agg(*[c.alias(n) for n, c in metrics.items()])
