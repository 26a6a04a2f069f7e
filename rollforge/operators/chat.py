"""Conversation, prompt and row-format jobs."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rollforge.functions import text as X
from rollforge.plans.skew import attach_stats
from rollforge.schemas import require


def keep_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The columns a job uses; the scan reads no others."""
    return require(df, columns, "keep_columns").select(*columns)


def render(
    turns: DataFrame,
    template: Mapping[str, tuple[str, str]] = X.CHAT_TEMPLATE,
    generation_prompt: str = X.GENERATION_PROMPT,
    part_turns: int | None = None,
) -> DataFrame:
    """Conversation text: rendered turns in order plus the generation prompt.

    One row per conversation, which is one row of model context. With
    ``part_turns`` one row per conversation and that many turns, ``part`` from
    0; joined in part order they are the whole text.
    """
    require(turns, ["conv_id", "turn", "role", "text"], "render")
    if part_turns is None:
        part = F.lit(0)
    else:
        place = F.row_number().over(Window.partitionBy("conv_id").orderBy("turn"))
        turns, part = turns.withColumn("__place", place), F.floor((F.col("__place") - 1) / part_turns).cast("int")
    message = X.render_message(F.col("role"), F.col("text"), template)
    parts = turns.groupBy("conv_id", part.alias("part")).agg(
        F.array_join(
            F.transform(
                F.sort_array(F.collect_list(F.struct("turn", message.alias("m")))), lambda s: s["m"]
            ),
            "",
        ).alias("text")
    )
    last = turns.groupBy("conv_id").agg(F.max(part).alias("last_part"))
    tail = F.when(F.col("part") == F.col("last_part"), F.lit(generation_prompt)).otherwise(F.lit(""))
    return parts.join(last, "conv_id").select("conv_id", "part", F.concat("text", tail).alias("text"))


def last_user_turn(turns: DataFrame) -> DataFrame:
    return turns.where(F.col("role") == "user").groupBy("conv_id").agg(
        F.max("turn").alias("turn"), F.max_by("text", "turn").alias("text")
    )


def split_bootstrap(turns: DataFrame) -> DataFrame:
    """Mark the last turn when it is an assistant turn: it leaves the prompt and
    is put before the completion."""
    last = turns.groupBy("conv_id").agg(
        F.max("turn").alias("last_turn"), F.max_by("role", "turn").alias("last_role"), F.count(F.lit(1)).alias("__n")
    )
    marked = attach_stats(turns, last, ["conv_id"], n="__n")
    is_last = (F.col("turn") == F.col("last_turn")) & (F.col("last_role") == "assistant")
    return marked.withColumn("is_bootstrap", is_last).drop("last_turn", "last_role", "__n")


def extract_prompt(pairs: DataFrame) -> DataFrame:
    """Pairs without a prompt: the shared leading part becomes the prompt."""
    shared = X.leading_common(F.col("chosen"), F.col("rejected"))
    short = F.least(shared, F.length("chosen").cast("bigint"), F.length("rejected").cast("bigint")).cast("int")
    cutpoint = pairs.withColumn("__n", short)
    rest = [
        F.substring(F.col(c), F.col("__n") + 1, F.length(c)).alias(c) for c in ("chosen", "rejected")
    ]
    others = [c for c in pairs.columns if c not in ("chosen", "rejected", "prompt")]
    return cutpoint.select(*others, F.substring(F.col("chosen"), F.lit(1), F.col("__n")).alias("prompt"), *rest)


def format_rows(df: DataFrame, formatter: Callable[[DataFrame], Column], keep: Sequence[str]) -> DataFrame:
    """One row to many texts; ``formatter`` gives an array-of-string Column."""
    return df.select(*keep, F.posexplode(formatter(df)).alias("part", "text"))


def double_bos(df: DataFrame, column: str, bos: str, template: str = "") -> DataFrame:
    """How many rows would get the begin marker twice."""
    if bos in template:
        doubled = F.count(F.lit(1))
    else:
        doubled = F.count(F.when(F.col(column).startswith(bos), 1))
    return df.agg(F.count(F.lit(1)).alias("rows"), doubled.alias("doubled"))
