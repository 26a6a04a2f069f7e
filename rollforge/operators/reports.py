"""Bounded previews and completion tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rollforge.functions import text as X
from rollforge.operators.groups import group_z
from rollforge.operators.sampling import random_k


def top_rows(df: DataFrame, keys: Sequence[str], order: Sequence[str], n: int) -> DataFrame:
    """First n rows per key with their ``rank``. For n up to 1000 the rank
    filter is applied per partition before the shuffle."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)


def sample_table(top: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Ranked, scored samples as printed rows. Score after ``top_rows``, so that
    only the printed rows are scored."""
    return top.select(
        *keys, F.format_string("Sample %d", "rank").alias("sample"), X.cut(F.col("prompt"), 100).alias("prompt"),
        X.cut(F.col("response"), 200).alias("response"), F.format_string("%.4f", "reward").alias("reward"),
    )


def completions_table(scored: DataFrame, keys: Sequence[str], funcs: Sequence[str]) -> DataFrame:
    """One row per completion: a column per reward function, and the group
    advantage of the total. Scored rows hold all of it but the group figures."""
    wide = scored.select(*keys, "reward", *[F.col(f"reward_{f}").alias(f) for f in funcs])
    return group_z(wide).select(*keys, *funcs, "advantage")


def pivot_rewards(rewards: DataFrame, keys: Sequence[str], funcs: Sequence[str]) -> DataFrame:
    """The same columns from a long reward table: one aggregation over a fixed
    list of names, folded before the shuffle to one row per completion."""
    return rewards.groupBy(*keys).agg(
        *[F.first(F.when(F.col("func") == f, F.col("value")), ignorenulls=True).alias(f) for f in funcs])


def first_rows(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key, the first in an explicit order."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rank", F.row_number().over(w)).where(F.col("__rank") == 1).drop("__rank")


def game_log(df: DataFrame, key: str, k: int, seed: int = 42) -> DataFrame:
    """k random rows; policy and reference text without the prompt's length."""

    def rest(c: str):
        return F.substring(F.col(c), F.length("prompt") + 1, F.length(c)).alias(c)

    picked = random_k(df, key, k, seed)
    return picked.select(key, "prompt", rest("policy"), rest("reference"))


def scored_pair_preview(df: DataFrame, key: str, n: int) -> DataFrame:
    """First n pairs with the two-way softmax of their scores, 4 decimals."""
    top = F.greatest("score_chosen", "score_rejected")
    a, b = F.exp(F.col("score_chosen") - top), F.exp(F.col("score_rejected") - top)
    return df.orderBy(key).limit(n).select(
        key, "chosen", "rejected", F.round(a / (a + b), 4).alias("p_chosen"), F.round(b / (a + b), 4).alias("p_rejected"))


def scored_query_preview(df: DataFrame, key: str, n: int = 5) -> DataFrame:
    return df.orderBy(key).limit(n).select(key, "query", "response", "score")
