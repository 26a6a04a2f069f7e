"""Reward functions as Columns, and the jobs that score a rollout table.

A reward function takes the prompt, response and answer Columns (and any extra
columns it names) and returns a double Column; NULL means "does not apply".
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollforge.functions import numeric as N
from rollforge.functions import text as X
from rollforge.schemas import one_of, require

RewardFn = Callable[..., Column]


@dataclass(frozen=True)
class RewardSpec:
    """A named, weighted reward function; ``extra`` lists further columns it
    receives by keyword."""

    name: str
    fn: RewardFn
    weight: float = 1.0
    extra: tuple[str, ...] = ()


def _points(test: Column, points: float, otherwise: float = 0.0) -> Column:
    return F.when(test, points).otherwise(otherwise)


def correctness(prompt: Column, response: Column, answer: Column) -> Column:
    given = X.normalize_answer(X.tagged_answer(response))
    return _points(given == X.normalize_answer(answer), 2.0)


def correctness_strict(prompt: Column, response: Column, answer: Column) -> Column:
    return _points(X.tagged_answer(response) == answer, 2.0)


def digit(prompt: Column, response: Column, answer: Column) -> Column:
    return _points(X.tagged_answer(response).rlike(r"\A[0-9]+\z"), 0.5)


def format_partial(prompt: Column, response: Column, answer: Column) -> Column:
    think = X.has(response, X.THINK_OPEN, X.THINK_CLOSE)
    tagged = X.has(response, X.ANSWER_OPEN, X.ANSWER_CLOSE)
    return F.when(think & tagged, 0.5).when(tagged, 0.25).otherwise(0.0)


# fixed value: the exact layout the strict format reward accepts
STRICT_LAYOUT = r"(?d)^<think>\n.*?\n</think>\n<answer>\n.*?\n</answer>\n$"


def format_strict(prompt: Column, response: Column, answer: Column) -> Column:
    return _points(response.rlike(STRICT_LAYOUT), 0.5)


def marks(prompt: Column, response: Column, answer: Column) -> Column:
    return sum((_points(response.contains(t), 0.125) for t in X.TAGS), F.lit(0.0))


def marks_strict(prompt: Column, response: Column, answer: Column) -> Column:
    # each tag followed by a line break, exactly once
    return sum((_points(X.occurrences(response, t + "\n") == 1, 0.125) for t in X.TAGS), F.lit(0.0))


def heuristic(prompt: Column, response: Column, answer: Column, word_boundary: bool = False) -> Column:
    length = F.least(X.word_count(response) / F.lit(100.0), F.lit(1.0)) * 0.1
    found = (answer != "") & F.lower(response).contains(F.lower(answer))
    tags = X.has(response, X.THINK_OPEN, X.ANSWER_OPEN)
    cue = r"because|therefore|thus|so"  # fixed values
    cues = F.lower(response).rlike(rf"\b({cue})\b" if word_boundary else cue)
    return length + _points(found, 0.5) + _points(tags, 0.3) + _points(cues, 0.1)


def steps(prompt: Column, response: Column, answer: Column) -> Column:
    return F.least(F.lit(1.0), X.occurrences(response, "\n") * 0.1)


def unique_chars(prompt: Column, response: Column, answer: Column) -> Column:
    characters = F.filter(F.split(response, ""), lambda c: c != "")
    return F.size(F.array_distinct(characters)).cast("double")


STANDARD = (
    RewardSpec("correctness", correctness),
    RewardSpec("digit", digit),
    RewardSpec("format", format_partial),
    RewardSpec("marks", marks),
)
STRICT = (
    RewardSpec("correctness", correctness_strict),
    RewardSpec("digit", digit),
    RewardSpec("format", format_strict),
    RewardSpec("marks", marks_strict),
)


def score(rollouts: DataFrame, specs: Sequence[RewardSpec], prompt: str = "prompt") -> DataFrame:
    """Add one ``reward_<name>`` column per function; a narrow projection."""
    extra = {c for s in specs for c in s.extra}
    require(rollouts, ["response", "answer", *extra], "score")
    prompt_col = F.col(prompt) if prompt in rollouts.columns else F.lit(None).cast("string")
    return rollouts.select(
        "*",
        *[
            s.fn(prompt_col, F.col("response"), F.col("answer"), **{c: F.col(c) for c in s.extra})
            .cast("double")
            .alias(f"reward_{s.name}")
            for s in specs
        ],
    )


def combine(
    scored: DataFrame, specs: Sequence[RewardSpec], missing: str = "zero_total", name: str = "reward"
) -> DataFrame:
    """Weighted total. ``zero_total``: one missing value makes the total 0 and
    infinities become +-10; ``skip``: a missing value counts as 0."""
    one_of(missing, ["zero_total", "skip"], "missing policy")
    values = [N.nan_to_null(F.col(f"reward_{s.name}")) * float(s.weight) for s in specs]
    if missing == "skip":
        return scored.withColumn(name, sum((F.coalesce(v, F.lit(0.0)) for v in values), F.lit(0.0)))
    total = sum(values, F.lit(0.0))
    infinite = F.lit(float("inf"))
    return scored.withColumn(
        name,
        F.when(total.isNull() | F.isnan(total), 0.0)
        .when(total == infinite, 10.0)
        .when(total == -infinite, -10.0)
        .otherwise(total),
    )


def weighted(specs: Sequence[RewardSpec], weights: Sequence[float] | None) -> list[RewardSpec]:
    """Specs with the given weights, one per function."""
    if weights is None:
        return list(specs)
    if len(weights) != len(specs):
        raise ValueError(f"{len(weights)} weights for {len(specs)} reward functions")
    return [RewardSpec(s.name, s.fn, float(w), s.extra) for s, w in zip(specs, weights)]


def long_rewards(scored: DataFrame, specs: Sequence[RewardSpec], keys: Sequence[str]) -> DataFrame:
    """One row per rollout and function."""
    pairs = [F.struct(F.lit(s.name).alias("func"), F.col(f"reward_{s.name}").alias("value")) for s in specs]
    return scored.select(*keys, F.explode(F.array(*pairs)).alias("r")).select(*keys, "r.func", "r.value")


def combine_long(
    rewards: DataFrame, keys: Sequence[str], weights: dict[str, float], missing: str = "zero_total"
) -> DataFrame:
    """The same totals from a long reward table; the per-rollout sum is
    map-side combined before the shuffle."""
    one_of(missing, ["zero_total", "skip"], "missing policy")
    weight = F.lit(1.0)
    for func, w in weights.items():
        weight = F.when(F.col("func") == func, float(w)).otherwise(weight)
    value = N.nan_to_null(F.col("value"))
    summed = rewards.groupBy(*keys).agg(
        F.coalesce(F.sum(value * weight), F.lit(0.0)).alias("total"),
        F.max(value.isNull().cast("int")).alias("missing"),
    )
    total = F.col("total")
    if missing == "zero_total":
        infinite = F.lit(float("inf"))
        total = (
            F.when((F.col("missing") == 1) | F.isnan(total), 0.0)
            .when(total == infinite, 10.0)
            .when(total == -infinite, -10.0)
            .otherwise(total)
        )
    return summed.select(*keys, total.alias("reward"))


def clip(scored: DataFrame, low: float, high: float, column: str = "reward") -> DataFrame:
    return scored.withColumn(column, N.clamp(F.col(column), low, high))


def missing_stop_penalty(score: Column, token_ids: Column, eos: int, penalty: float) -> Column:
    stopped = F.array_contains(token_ids, F.lit(eos).cast("bigint"))
    return score - F.when(stopped, 0.0).otherwise(float(penalty))


def kl_penalised(total: Column, old: Column, ref: Column, mask: Column, beta: float) -> Column:
    return total - float(beta) * N.masked_sum(F.zip_with(old, ref, lambda o, r: o - r), mask)


def unscored(scored: DataFrame, specs: Sequence[RewardSpec]) -> DataFrame:
    """Rollouts to which no function applied."""
    nothing = F.coalesce(*[N.nan_to_null(F.col(f"reward_{s.name}")) for s in specs]).isNull()
    return scored.where(nothing)


def grader_disagreement(rollouts: DataFrame) -> DataFrame:
    """Counts of strict against normalised grading, with shares."""
    p, r, a = F.lit(None).cast("string"), F.col("response"), F.col("answer")
    graded = rollouts.select(
        (correctness_strict(p, r, a) > 0).alias("strict"), (correctness(p, r, a) > 0).alias("lenient")
    )
    return graded.groupBy("strict", "lenient").agg(F.count(F.lit(1)).alias("n"))


def false_negative_rate(rollouts: DataFrame) -> DataFrame:
    """Share of rows only the strict grader calls wrong."""
    counts = grader_disagreement(rollouts)
    return counts.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum(F.when(~F.col("strict") & F.col("lenient"), F.col("n"))), F.lit(0)).alias("false_negatives"),
    ).withColumn("rate", F.try_divide("false_negatives", "rows"))
