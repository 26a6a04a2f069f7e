"""Splits, samples and schedules in a seeded hash order.

The order of a row depends on its key and the seed only, not on partitioning.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rollforge.plans.skew import digest, fits_broadcast, hash_position, range_running
from rollforge.schemas import require

# Up to this many rows, a top-n over all partitions is cheaper than numbering
# every row; the result is the same.
TOP_N_ROWS = 10_000
SLOTS = 1 << 32


def first_in_hash_order(df: DataFrame, key: str, n: int, seed: int) -> DataFrame:
    """The first ``n`` rows with their 0-based ``position``."""
    require(df, [key], "first_in_hash_order")
    if n > TOP_N_ROWS:
        return hash_position(df, key, seed, limit=n)
    top = df.withColumn("__digest", digest(F.col(key), seed)).orderBy("__digest", key).limit(n)
    w = Window.orderBy("__digest", key)
    return top.withColumn("position", (F.row_number().over(w) - 1).cast("bigint")).drop("__digest")


def seeded_split(df: DataFrame, key: str, train: int, test: int, seed: int = 42) -> DataFrame:
    """First ``test`` rows of the shuffled table are test, the next ``train`` train."""
    rows = first_in_hash_order(df, key, test + train, seed)
    return rows.withColumn("split", F.when(F.col("position") < test, "test").otherwise("train"))


def seeded_sample(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    return first_in_hash_order(df, key, n, seed)


def fraction_split(df: DataFrame, key: str, shares: Mapping[str, float], seed: int = 42) -> DataFrame:
    """Split by shares of the rows, to within 2**-32; a narrow projection, no
    sort and no shuffle."""
    if sum(shares.values()) > 1.0 + 1e-9:
        raise ValueError("shares add up to more than 1")
    slot = F.conv(F.substring(digest(F.col(key), seed), 1, 8), 16, 10).cast("bigint")
    names, edge = list(shares.items()), 0.0
    split = F.lit(None).cast("string")
    for name, share in names:
        low, edge = edge, edge + share
        split = F.when((slot >= round(low * SLOTS)) & (slot < round(edge * SLOTS)), name).otherwise(split)
    return df.withColumn("split", split).where(F.col("split").isNotNull())


def random_k(df: DataFrame, key: str, k: int, seed: int = 42) -> DataFrame:
    """k rows without replacement."""
    return first_in_hash_order(df, key, k, seed).drop("position")


def bootstrap_sample(df: DataFrame, key: str, cls: str, n: int, seed: int = 42) -> DataFrame:
    """``min(n, class size)`` draws with replacement from each class."""
    rows = hash_position(df.select(key, cls), key, seed, groups=[cls])
    sizes = df.groupBy(cls).agg(F.count(F.lit(1)).alias("__size"))
    last = F.least(F.lit(n).cast("bigint"), F.col("__size")) - 1
    draws = sizes.withColumn("draw", F.explode(F.sequence(F.lit(0).cast("bigint"), last)))
    pick = F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(cls).cast("string"),
                                                F.col("draw").cast("string"))), 1, 15), 16, 10).cast("bigint")
    picked = draws.withColumn("position", pick % F.col("__size")).drop("__size")
    return picked.join(rows, [cls, "position"]).select(cls, "draw", key)


def head_limit(df: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    """First n rows in an explicit order, which must be total for a large n:
    those are numbered by range slices instead of being sorted in one task."""
    if n > TOP_N_ROWS:
        return range_running(df, [], order, name="__index").where(F.col("__index") < n).drop("__index")
    return df.orderBy(*order).limit(n)


def replicate(df: DataFrame, k: int) -> DataFrame:
    """Every row k times, numbered by ``copy``; generated inside the row."""
    return df.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(k - 1))))


def cycle_to_n(df: DataFrame, key: str, n: int) -> DataFrame:
    """Repeat the table in ``key`` order until there are n rows, numbered by
    ``row``, the last column."""
    spark = df.sparkSession
    columns = [*df.columns, "row"]
    rows = range_running(df, [], [key], name="__index")
    size = rows.count()
    if size == 0:
        return rows.withColumn("row", F.col("__index")).select(*columns)
    if fits_broadcast(rows):
        slots = spark.range(n).withColumn("__index", F.col("id") % size).withColumnRenamed("id", "row")
        return slots.join(F.broadcast(rows), "__index").select(*columns)
    kept = rows.where(F.col("__index") < n)
    return kept.withColumn("row", F.explode(F.sequence(F.col("__index"), F.lit(n - 1), F.lit(size)))).select(*columns)


def rollout_schedule(
    prompts: DataFrame,
    key: str,
    generations: int,
    generation_batch: int,
    iterations: int = 1,
    steps_per_generation: int = 1,
    seed: int = 42,
    drop_last: bool = True,
) -> DataFrame:
    """Which prompt is sampled at which step.

    Prompts in seeded order are cut into batches of ``generation_batch /
    generations``; a prompt is repeated ``generations`` times and each batch is
    replayed ``iterations * steps_per_generation`` times.
    """
    if generation_batch % generations:
        raise ValueError("generation_batch must be a multiple of generations")
    size, replays = generation_batch // generations, iterations * steps_per_generation
    rows = hash_position(prompts.select(key), key, seed)
    rows = rows.withColumn("batch", F.floor(F.col("position") / size).cast("bigint"))
    if drop_last:
        rows = rows.where(F.col("position") < prompts.count() // size * size)
    rows = rows.withColumn("replay", F.explode(F.sequence(F.lit(0), F.lit(replays - 1))))
    rows = rows.withColumn("sample_idx", F.explode(F.sequence(F.lit(0), F.lit(generations - 1))))
    return rows.select(
        (F.col("batch") * replays + F.col("replay")).alias("step"), "batch", "replay",
        (F.col("position") % size).alias("slot"), "sample_idx", key,
    )


def kl_mismatch_pairs(df: DataFrame, key: str, batch_size: int, seed: int = 42, reverse: bool = False) -> DataFrame:
    """Give each prompt the completion of another row of its batch.

    Batches are ``batch_size`` consecutive rows of the seeded order, so a window
    over one batch is small; a single row left over joins the batch before it.
    Default: rotation by one, which never returns a row its own completion
    (unless it is the only row); ``reverse`` mirrors the batch instead.
    """
    if batch_size <= 1:
        raise ValueError("batch_size must be greater than 1")
    last = (df.count() - 2) // batch_size  # the batch that a single last row joins
    batch = F.least(F.floor(F.col("position") / batch_size), F.lit(max(0, last))).cast("bigint")
    rows = hash_position(df, key, seed).withColumn("batch", batch)
    w = Window.partitionBy("batch").orderBy("position")
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    if not reverse:
        other = F.coalesce(F.lag("completion", 1).over(w), F.last("completion").over(whole))
        return rows.withColumn("kl_completion", other).drop("position")
    place = F.row_number().over(w)
    placed = rows.withColumn("__place", place).withColumn("__mirror", F.count(F.lit(1)).over(whole) + 1 - place)
    mirror = placed.select("batch", F.col("__mirror").alias("__place"), F.col("completion").alias("kl_completion"))
    return placed.join(mirror, ["batch", "__place"]).select(*df.columns, "batch", "kl_completion")
