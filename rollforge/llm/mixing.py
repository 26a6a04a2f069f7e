"""Mixing sources to target weights by Sainte-Lague apportionment, in DataFrame
functions only.

The words of a source stand in a seeded order of its documents and are cut into
blocks of equal size. Blocks are awarded to sources by highest quotients
target / (2k - 1); awards in that order fill one mix shard after the other, so
a shard's quotas are differences of apportionments of growing size. Each shard
takes its quota of a source's blocks in the seeded order where the shard before
stopped, from the source's begin again when all are used, so documents are taken
whole but for those in which a quota ends. No block is ever a row: what a
document gives to each shard is a closed form of its place in the order.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rollforge.llm.common import attach, bucket_offsets, copies, table, text_or_empty
from rollforge.plans.storage import materialize

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2
SEED = 10
MIX_SHARDS = 8
BLOCK_WORDS = 1024
# blocks per source at least, so that rounding to blocks stays under 1/200 of a target
LEAST_BLOCKS = 200
BUCKET_ROWS = 512
WORD = r"[^\x20\x09-\x0D]+"


def words_of(text: str) -> Column:
    return F.regexp_count(text_or_empty(text), F.lit(WORD)).cast("bigint")


def text_hash(text: str) -> Column:
    """Tells texts apart that have id, source and size in common."""
    return F.xxhash64(text_or_empty(text)).alias("text_hash")


def source_key(source: str = "source") -> Column:
    """A key that is never null: null is a source of its own."""
    return F.coalesce(F.concat(F.lit("="), F.col(source).cast("string")), F.lit(""))


def targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """Add ``target`` to one row per source (key, source, source_size).

    Sources by code point, null last, have ``weights`` in turn and share
    ``share`` times all sizes; a target stops at ``most`` times the source's
    size and the excess is shared again by weight. That is the level at which
    capped sources (lowest cap per weight first) and shares by weight meet.
    """
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    weighted = sizes.withColumn(
        "weight", F.get(F.array(*[F.lit(float(w)) for w in weights]), ((rank - 1) % len(weights)))
    )
    cap = F.col("source_size") * float(most)
    order = Window.orderBy("ratio", "key")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    leveled = (
        weighted.withColumn("cap", cap).withColumn("ratio", F.col("cap") / F.col("weight"))
        .withColumn(
            "level",
            (F.lit(share) * F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
            / F.sum("weight").over(after),
        )
    )
    # the first source, by cap per weight, that the level does not lift above its cap
    level = F.min(F.when(F.col("level") <= F.col("ratio"), F.struct("ratio", "level"))).over(everything)["level"]
    return leveled.withColumn(
        "target", F.least(F.col("cap"), F.coalesce(level, F.lit(0.0)) * F.col("weight"))
    ).select("key", "source", "source_size", "target")


def quotas(goals: DataFrame, block: int, shards: int = MIX_SHARDS, most: int = MOST) -> DataFrame:
    """Blocks per (mix shard, source): key, shard, quota, until (quotas up to this
    shard), blocks (in the source).

    Shard h gets the awards between house sizes T*h/shards and T*(h+1)/shards.
    Each house size is apportioned from the rounded ideal shares, corrected by
    the awards with the highest (or lowest) quotients; no source gets more than
    ``most`` times its blocks. Equal quotients go by source key.
    """
    sized = goals.withColumn("blocks", F.ceil(F.col("source_size") / F.lit(block))).withColumn(
        "all_targets", F.sum("target").over(Window.partitionBy())
    )
    houses = sized.where(F.col("target") > 0).withColumn("house", F.explode(F.sequence(F.lit(1), F.lit(shards))))
    size = F.floor(F.round(F.col("all_targets") / block) * F.col("house") / shards)
    by_house = Window.partitionBy("house")
    ideal = F.floor(F.col("target") * F.col("size") / F.col("all_targets") + 0.5)
    first = (
        houses.withColumn("size", size).withColumn("most", F.col("blocks") * most)
        .withColumn("got", F.least(ideal, F.col("most")))
        .withColumn("missing", (F.col("size") - F.sum("got").over(by_house)).cast("bigint"))
    )
    tries = F.sequence(F.lit(1).cast("bigint"), F.greatest(F.lit(1).cast("bigint"), F.abs("missing")))
    steps = first.where(F.col("missing") != 0).withColumn("i", F.explode(tries))
    seat = F.when(F.col("missing") > 0, F.col("got") + F.col("i")).otherwise(F.col("got") - F.col("i") + 1)
    steps = steps.withColumn("seat", seat).where((F.col("seat") >= 1) & (F.col("seat") <= F.col("most")))
    steps = steps.withColumn("quotient", F.col("target") / (2 * F.col("seat") - 1))
    up = F.when(F.col("missing") > 0, -F.col("quotient")).otherwise(F.col("quotient"))
    chosen = steps.withColumn("place", F.row_number().over(by_house.orderBy(up, "key")))
    change = (
        chosen.where(F.col("place") <= F.abs("missing")).groupBy("house", "key")
        .agg(F.sum(F.signum("missing")).cast("bigint").alias("change"))
    )
    reached = first.join(change, ["house", "key"], "left").withColumn(
        "reached", F.col("got") + F.coalesce("change", F.lit(0))
    )
    earlier = F.coalesce(F.lag("reached").over(Window.partitionBy("key").orderBy("house")), F.lit(0))
    return reached.select(
        "key", (F.col("house") - 1).alias("shard"), (F.col("reached") - earlier).cast("bigint").alias("quota"),
        F.col("reached").cast("bigint").alias("until"),
        F.col("blocks").cast("bigint").alias("blocks"),
    )


def block_words(goals: DataFrame, block: int = BLOCK_WORDS) -> int:
    """Words of a block: ``block``, less when the smallest target needs finer
    ones, more when a source would have over 2**30 (products stay exact)."""
    small, large = goals.where(F.col("target") > 0).agg(F.min("target"), F.max("source_size")).first()
    if small is None:
        return 1
    return max(1, min(block, int(small // LEAST_BLOCKS)), math.ceil(large / (1 << 30)))


def mix(
    docs: DataFrame, seed: int = SEED, id_col: str = "doc_id", text: str = "text", source: str = "source",
    weights: Sequence[int] = WEIGHTS, share: float = SHARE, most: int = MOST, block: int = BLOCK_WORDS,
    keep_source: bool = False, shards: int = MIX_SHARDS,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, size, source_size, target, taken,
    by_shard (the words taken into each mix shard; their sum is ``taken``), and
    with ``keep_source`` the source's key and the text's hash.

    Size is the number of words; a null or wordless text has none and nothing
    of it is taken. A null source is a source. Repeated rows are rows like
    others. An empty table gives no rows; other columns are ignored.
    """
    kept = ["key", "text_hash"] if keep_source else []
    rows = docs.select(
        F.col(id_col).alias("doc_id"), F.col(source).cast("string").alias("source"), words_of(text).alias("size"),
        *([text_hash(text)] if keep_source else []),
    )
    rows = materialize(
        rows.withColumn("key", source_key()).groupBy("doc_id", "key", "source", "size", *kept[1:])
        .agg(F.count(F.lit(1)).alias("n")), "sizes",
    )
    sources = materialize(
        rows.groupBy("key", "source").agg(
            F.sum(F.col("size") * F.col("n")).alias("source_size"), F.count(F.lit(1)).alias("docs")
        ), "sources",
    )
    goals = materialize(targets(sources, weights, share, most), "targets")
    block = block_words(goals, block)
    shard_quotas = quotas(goals, block, shards, most).groupBy("key").agg(
        F.array_sort(F.collect_list(F.struct("shard", "until"))).alias("until"), F.max("blocks").alias("blocks")
    )
    plan = goals.join(shard_quotas, "key", "left").select(
        "key", "source_size", "target", "blocks", F.col("until.until").alias("until")
    )
    count = sources.agg(F.sum("docs")).first()[0] or 0
    buckets = max(1, math.ceil(count / BUCKET_ROWS))
    rows = rows.withColumn("hash", F.xxhash64(F.lit(seed), "doc_id", "size")).withColumn(
        "bucket", F.pmod("hash", F.lit(buckets))
    )
    words = F.col("size") * F.col("n")
    sums = rows.groupBy("key", "bucket").agg(F.sum(words).alias("words"), F.count(F.lit(1)).alias("docs"))
    offsets = bucket_offsets(sums, ["key"], "bucket", "words", buckets).drop("words")
    inside = Window.partitionBy("key", "bucket").orderBy("hash", "doc_id", "size", *kept[1:]).rowsBetween(
        Window.unboundedPreceding, -1
    )
    placed = rows.withColumn("inside", F.coalesce(F.sum(words).over(inside), F.lit(0))).join(
        offsets.drop("docs"), ["key", "bucket"]
    )
    # written, because attach() has it in its plan twice: with windows and joins that fills the driver
    placed = materialize(
        placed.select("doc_id", "key", "size", *kept[1:], "n", (F.col("__offset") + F.col("inside")).alias("start")), "placed",
    )
    full = materialize(plan.join(sources.select("key", "docs"), "key"), "plan")
    found = copies(attach(placed, full, ["key"], "docs"), "n", "copy")

    start = F.col("start") + F.col("copy") * F.col("size")

    def words_until(quota: Column) -> Column:
        """Words that a quota of blocks, from the source's begin, takes of the document."""
        passes, rest = F.floor(quota / F.col("blocks")), (quota % F.col("blocks")) * block

        def upto(x: Column) -> Column:
            return passes * x + F.least(x, rest)

        return (upto(start + F.col("size")) - upto(start)).cast("bigint")

    nothing = F.array_repeat(F.lit(0).cast("bigint"), shards)
    found = found.withColumn("until", F.coalesce(F.transform("until", words_until), nothing))
    return found.select(
        "doc_id", *kept, "size", "source_size", "target", F.element_at("until", -1).alias("taken"),
        F.transform("until", lambda w, i: w - F.coalesce(F.get("until", i - 1), F.lit(0))).alias("by_shard"),
    )


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).drop("by_shard")
