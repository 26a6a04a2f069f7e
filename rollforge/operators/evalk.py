"""Pass@k evaluation and the reports built on it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rollforge.functions import text as X
from rollforge.schemas import require

KEYS = ("run_id", "epoch")
COLUMNS = ("question_id", "sample_idx", "decode", "truth", "response")


def grade(rollouts: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Normalised answer, normalised truth and correctness of each response."""
    require(rollouts, [*keys, *COLUMNS], "grade")
    given = X.normalize_answer(X.tagged_answer(F.col("response")))
    truth = X.normalize_answer(F.col("truth"))
    return rollouts.select(
        *keys, "question_id", "sample_idx", "decode", given.alias("given"), truth.alias("truth"),
        (given == truth).alias("correct"),
    )


def _greedy() -> Column:
    return F.col("decode") == "greedy"


def _sampled(k: int) -> Column:
    return (F.col("decode") == "sample") & (F.col("sample_idx") < k)


def per_question(
    graded: DataFrame, keys: Sequence[str] = KEYS, ks: Sequence[int] = (5, 10), extra: Sequence[Column] = ()
) -> DataFrame:
    """Flags, counts and the greedy answer of each question; one aggregation."""
    hit = F.col("correct").cast("int")
    return graded.groupBy(*keys, "question_id").agg(
        F.coalesce(F.max(F.when(_greedy(), hit)), F.lit(0)).alias("pass_1"),
        *[F.coalesce(F.max(F.when(_sampled(k), hit)), F.lit(0)).alias(f"pass_{k}") for k in ks],
        *[F.coalesce(F.sum(F.when(_sampled(k), hit)), F.lit(0)).alias(f"correct_in_{k}") for k in ks],
        F.max(F.when(_greedy(), F.col("given"))).alias("greedy_answer"),
        F.max("truth").alias("truth"),
        *extra,
    )


def pass_at_k(graded: DataFrame, keys: Sequence[str] = KEYS, ks: Sequence[int] = (5, 10)) -> DataFrame:
    """Greedy accuracy and share of questions with a correct answer in the
    first k samples; without keys an empty input gives 0.0."""
    q = per_question(graded, keys, ks)
    return q.groupBy(*keys).agg(
        *[F.coalesce(F.avg(f"pass_{k}"), F.lit(0.0)).alias(f"pass_at_{k}") for k in (1, *ks)],
        F.count(F.lit(1)).alias("questions"),
    )


def detail(graded: DataFrame, keys: Sequence[str] = KEYS, samples: int = 10) -> DataFrame:
    """Per question: the greedy answer, the first ``samples`` sampled answers in
    order, counts and flags. The answer list holds ``samples`` entries at most."""
    answer = F.when(_sampled(samples), F.struct("sample_idx", "given"))
    answers = F.sort_array(F.collect_set(answer))["given"].alias("sampled_answers")
    return per_question(graded, keys, (5, 10), [answers])


def order_violations(passes: DataFrame) -> DataFrame:
    """Rows where pass@1 <= pass@5 <= pass@10 does not hold."""
    return passes.where(
        (F.col("pass_at_1") > F.col("pass_at_5")) | (F.col("pass_at_5") > F.col("pass_at_10"))
    )


def transitions(graded: DataFrame, run: str = "run_id") -> DataFrame:
    """Per question and epoch: did the greedy answer change, become right or
    wrong, and for how many epochs has it been the same. The window runs over
    one row per epoch."""
    greedy = graded.where(_greedy())
    q = per_question(greedy, (run, "epoch"), ()).select(run, "question_id", "epoch", "greedy_answer", "pass_1")
    w = Window.partitionBy(run, "question_id").orderBy("epoch")
    before, right_before = F.lag("greedy_answer").over(w), F.lag("pass_1").over(w)
    changed = F.when(before.isNull(), False).otherwise(~before.eqNullSafe(F.col("greedy_answer")))
    marked = q.select(
        "*",
        changed.alias("changed"),
        F.coalesce((right_before == 0) & (F.col("pass_1") == 1), F.lit(False)).alias("became_right"),
        F.coalesce((right_before == 1) & (F.col("pass_1") == 0), F.lit(False)).alias("became_wrong"),
    )
    last_change = F.max(F.when(F.col("changed"), F.col("epoch"))).over(w)
    first = F.min("epoch").over(w)
    return marked.withColumn("stuck_for", F.col("epoch") - F.coalesce(last_change, first))


def sample_trend(graded: DataFrame, run: str = "run_id") -> DataFrame:
    """Correct samples per question and epoch, and the change since the last."""
    q = per_question(graded, (run, "epoch"))
    w = Window.partitionBy(run, "question_id").orderBy("epoch")
    return q.select(
        run, "question_id", "epoch", "correct_in_5", "correct_in_10",
        (F.col("correct_in_5") - F.lag("correct_in_5").over(w)).alias("delta_5"),
        (F.col("correct_in_10") - F.lag("correct_in_10").over(w)).alias("delta_10"),
    )


def baseline_vs_epoch(graded: DataFrame, run: str = "run_id", baseline: int = 0) -> DataFrame:
    """Each later result of a question next to its result before training; the
    window runs over one row per epoch."""
    q = per_question(graded, (run, "epoch"))
    w = Window.partitionBy(run, "question_id")
    both = q.withColumns({
        f"base_{k}": F.max(F.when(F.col("epoch") == baseline, F.col(f"pass_{k}"))).over(w) for k in (1, 10)})
    later = both.where((F.col("epoch") != baseline) & F.col("base_1").isNotNull())
    return later.select(
        run, "question_id", "epoch",
        (F.col("pass_1") - F.col("base_1")).alias("delta_1"),
        (F.col("pass_10") - F.col("base_10")).alias("delta_10"),
    )


def diversity(graded: DataFrame, keys: Sequence[str] = KEYS, k: int = 10) -> DataFrame:
    """Distinct normalised answers per question, and whether all are the same.

    One shuffle of a row per question and task: a set holds one answer per sample
    number below ``k`` at most, unless numbers repeat in a question. A distinct
    count would shuffle every answer, and then its counts again.
    """
    return (
        graded.where(_sampled(k))
        .groupBy(*keys, "question_id")
        .agg(F.size(F.collect_set("given")).cast("bigint").alias("distinct_answers"))
        .withColumn("all_same", F.col("distinct_answers") == 1)
    )


def same_as_greedy(graded: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Share of questions whose pass@5 outcome equals the greedy outcome."""
    q = per_question(graded, keys)
    return q.groupBy(*keys).agg(F.avg((F.col("pass_5") == F.col("pass_1")).cast("double")).alias("same_share"))
