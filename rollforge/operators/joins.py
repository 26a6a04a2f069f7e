"""Keyed joins in place of association by list position."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rollforge.plans.skew import fits_broadcast, join_lookup, range_running
from rollforge.plans.storage import materialize
from rollforge.schemas import require


def join_answers(rollouts: DataFrame, prompts: DataFrame, key: str = "prompt_id") -> DataFrame:
    """Answer and other prompt columns repeated to each of its rollouts; a
    prompt may have any number of them."""
    require(rollouts, [key], "join_answers")
    return join_lookup(rollouts, require(prompts, [key], "join_answers"), key)


def unmatched(rows: DataFrame, lookup: DataFrame, key: str) -> DataFrame:
    """Rows, and rows whose key is not in ``lookup``; both sides are reduced to
    one row per key first."""
    sizes = rows.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    known = lookup.select(key).distinct().withColumn("known", F.lit(True))
    return sizes.join(known, key, "left").agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum(F.when(F.col("known").isNull(), F.col("n"))), F.lit(0)).alias("without_prompt"),
    )


def key_list(key: str | Sequence[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def _checked(frame: DataFrame, names: Sequence[str], missing: Column, message: Column) -> list[Column]:
    """The columns, each of which fails where ``missing``: the check holds
    whichever of them a caller keeps."""
    return [
        F.when(missing, F.raise_error(message).cast(frame.schema[c].dataType)).otherwise(F.col(c)).alias(c) for c in names
    ]


def attach_required(rows: DataFrame, columns: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Add precomputed columns by key; a row without them is an error."""
    keys = key_list(key)
    joined = rows.join(columns.withColumn("__found", F.lit(True)), keys, "left")
    shown = F.concat_ws(",", *[F.col(k).cast("string") for k in keys])
    message = F.concat(F.lit(f"no values for {','.join(keys)} "), shown)
    added = [c for c in columns.columns if c not in keys]
    names = [*rows.columns, *added]
    return joined.select(*_checked(joined, names, F.col("__found").isNull(), message))


def concat_columns(left: DataFrame, right: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Put the columns of two equally long tables side by side by row key."""
    keys = key_list(key)
    both = left.withColumn("__l", F.lit(1)).join(right.withColumn("__r", F.lit(1)), keys, "full_outer")
    missing = F.col("__l").isNull() | F.col("__r").isNull()
    names = [*left.columns, *[c for c in right.columns if c not in keys]]
    return both.select(*_checked(both, names, missing, F.lit("concat_columns: row keys differ")))


def _pick(pairs: DataFrame, first_wins: Column, columns: Sequence[str]) -> list[Column]:
    out = []
    for c in columns:
        name = "idx" if c == "sample_idx" else c
        suffix = {"idx": ("chosen_idx", "rejected_idx"), "response": ("chosen", "rejected")}.get(
            name, (f"chosen_{name}", f"rejected_{name}"))
        out.append(F.when(first_wins, F.col(f"{c}_a")).otherwise(F.col(f"{c}_b")).alias(suffix[0]))
        out.append(F.when(first_wins, F.col(f"{c}_b")).otherwise(F.col(f"{c}_a")).alias(suffix[1]))
    return out


def side_by_side(samples: DataFrame, key: str | Sequence[str]) -> tuple[DataFrame, list[str]]:
    """Samples 0 and 1 of each key in one row, as ``<column>_a`` and
    ``<column>_b``: one scan and one shuffle of two rows per key. A key names
    one group of samples, so a sample number that repeats in it is an error."""
    keys = key_list(key)
    columns = [c for c in samples.columns if c not in keys]
    w = Window.partitionBy(*keys).orderBy("sample_idx")
    two = samples.where(F.col("sample_idx").between(0, 1))
    error = F.raise_error(F.lit(f"sample_idx repeats within {','.join(keys)}")).cast("boolean")
    twice = F.lead("sample_idx").over(w) == F.col("sample_idx")
    both = two.withColumn("__b", F.lead(F.struct(*columns)).over(w)).withColumn("__twice", twice).where(
        F.when(F.col("__twice"), error).otherwise((F.col("sample_idx") == 0) & (F.col("__b.sample_idx") == 1)))
    return both.select(
        *keys, *[F.col(c).alias(f"{c}_a") for c in columns], *[F.col(f"__b.{c}").alias(f"{c}_b") for c in columns]
    ), columns


def pair_by_score(samples: DataFrame, key: str | Sequence[str] = "prompt_id", score: str = "reward") -> DataFrame:
    """Two completions per key into chosen and rejected; a tie goes to the
    first. ``key`` names the group: the prompt, or run, step and prompt."""
    both, columns = side_by_side(samples, key)
    return both.select(*key_list(key), *_pick(both, F.col(f"{score}_a") >= F.col(f"{score}_b"), columns))


def pair_by_judge(samples: DataFrame, ranks: DataFrame, key: str | Sequence[str] = "prompt_id") -> DataFrame:
    """The same, decided by an external judge: rank 0 means the first is better."""
    keys = key_list(key)
    both, columns = side_by_side(samples, keys)
    judged = both.join(ranks.select(*keys, F.col("rank").alias("__rank")), keys)
    return judged.select(*keys, *_pick(judged, F.col("__rank") == 0, columns))


def model_vs_ref(model: DataFrame, ref: DataFrame, key: str | Sequence[str] = "prompt_id") -> DataFrame:
    """Log-prob sums of the better and worse of a model and a reference
    completion; the model's wins a tie."""
    joined = model.join(ref, key_list(key))
    wins = F.col("model_score") >= F.col("ref_score")
    return joined.select(
        "*",
        wins.alias("model_wins"),
        F.when(wins, F.col("model_on_model")).otherwise(F.col("model_on_ref")).alias("chosen_model"),
        F.when(wins, F.col("ref_on_model")).otherwise(F.col("ref_on_ref")).alias("chosen_ref"),
        F.when(wins, F.col("model_on_ref")).otherwise(F.col("model_on_model")).alias("rejected_model"),
        F.when(wins, F.col("ref_on_ref")).otherwise(F.col("ref_on_model")).alias("rejected_ref"),
    )


def rank_align(df: DataFrame, keys: Sequence[str], row: str, a: str, b: str) -> DataFrame:
    """Sort two columns independently within ``keys`` and subtract by rank.

    Ranks come from range slices, so that a large batch is never sorted in one
    task; both sides then meet on the unique ``(keys, rank)``.
    """
    keys = list(keys)
    left = range_running(df.select(*keys, row, a), keys, [a, row], name="rank").drop(row)
    right = range_running(df.select(*keys, row, b), keys, [b, row], name="rank").drop(row)
    return left.join(right, [*keys, "rank"]).withColumn("delta", F.col(a) - F.col(b))


def leakage(rows: DataFrame, held_out: DataFrame, text: str) -> DataFrame:
    """How many rows repeat a held-out text, and how many do not. Copies are
    counted before the join, so a much copied text is one row there; texts are
    compared by digest, so that only digests move. A null text is not held out."""
    name = F.sha2(F.col(text), 256).alias("name")
    sizes = rows.groupBy(name).agg(F.count(F.lit(1)).alias("n"))
    known = held_out.select(name).distinct().withColumn("known", F.lit(True))
    return sizes.join(known, "name", "left").agg(
        F.coalesce(F.sum(F.when(F.col("known"), F.col("n"))), F.lit(0)).alias("leaked"),
        F.coalesce(F.sum(F.when(F.col("known").isNull(), F.col("n"))), F.lit(0)).alias("clean"),
    )


def without_leaked(rows: DataFrame, held_out: DataFrame, text: str) -> DataFrame:
    """Rows whose text is not held out, by digest. A held-out set beyond the
    broadcast size is joined by shuffle, where adaptive execution splits a much
    copied text."""
    name = F.sha2(F.col(text), 256)
    known = materialize(held_out.select(name.alias("__name")).distinct(), "held-out")
    known = F.broadcast(known) if fits_broadcast(known) else known
    return rows.withColumn("__name", name).join(known, "__name", "left_anti").select(*rows.columns)
