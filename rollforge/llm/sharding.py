"""Sharding by a two-pass external shuffle, in DataFrame functions only.

Pass 1 scatters records uniformly, by a seeded hash, over buckets small enough
for memory. Pass 2 permutes each bucket by a Fisher-Yates shuffle whose draws
are seeded hashes of (bucket, step), and lays the buckets one after the other.
Positions depend on the records and the seed, not on partitions.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rollforge.llm.common import bucket_offsets, copies, table, text_or_empty
from rollforge.plans.storage import materialize

SHARDS = 8
SEED = 20
BUCKET_ROWS = 256


def fisher_yates(n: Column, bucket: Column, seed: int) -> Column:
    """Permutation of 0..n-1: for i = n-1 .. 1, swap i with a draw from 0..i."""

    def swap(order: Column, i: Column) -> Column:
        j = F.pmod(F.xxhash64(F.lit(seed), bucket, i), i + 1).cast("int")
        return F.when(j == i, order).otherwise(
            F.concat(
                F.slice(order, F.lit(1), j),
                F.array(F.get(order, i)),
                F.slice(order, j + 2, i - j - 1),
                F.array(F.get(order, j)),
                F.slice(order, i + 2, n),
            )
        )

    start = F.sequence(F.lit(0), n - 1)
    steps = F.sequence(n - 1, F.lit(1), F.lit(-1))
    return F.when(n > 1, F.aggregate(steps, start, swap)).otherwise(start)


def external_shuffle(
    records: DataFrame, seed: int = SEED, bucket_rows: int = BUCKET_ROWS
) -> tuple[DataFrame, int]:
    """``records`` with their ``__position`` (0 to rows - 1) in a seeded random
    order, and the number of rows.

    Equal records are counted before the shuffle and told apart by a copy
    number, so that a record that repeats is scattered like any other. All
    columns must be of types that can be grouped.
    """
    names = list(records.columns)
    counted = records.groupBy(*names).agg(F.count(F.lit(1)).alias("__n"))
    counted = materialize(counted, "records")
    rows = counted.agg(F.coalesce(F.sum("__n"), F.lit(0))).first()[0]
    buckets = max(1, math.ceil(rows / bucket_rows))
    bucket = F.pmod(F.xxhash64(F.lit(seed), *names, "__copy"), F.lit(buckets))
    scattered = materialize(copies(counted, "__n", "__copy").withColumn("__bucket", bucket), "scattered")
    sizes = materialize(scattered.groupBy("__bucket").agg(F.count(F.lit(1)).alias("__size")), "bucket_sizes")
    offsets = bucket_offsets(sizes, [], "__bucket", "__size", buckets)
    # sizes are few bytes but dear to permute: dealt over tasks by count, not by bytes
    offsets = offsets.repartition(max(1, math.isqrt(buckets)), "__bucket")
    orders = offsets.withColumn("__order", fisher_yates(F.col("__size").cast("int"), F.col("__bucket"), seed))
    # the window sorts a bucket in place; only its order, not its records, is an array
    index = F.row_number().over(Window.partitionBy("__bucket").orderBy(*names, "__copy")) - 1
    placed = scattered.withColumn("__index", index).join(
        orders.drop("__size").hint("shuffle_hash"), "__bucket"
    )
    return placed.select(
        *names, (F.col("__offset") + F.get("__order", F.col("__index"))).alias("__position")
    ), rows


def place(shuffled: DataFrame, rows: int, shards: int) -> DataFrame:
    """Consecutive positions fill one shard after the other; the first
    ``rows % shards`` shards get one row more. Slots count from 0."""
    each, extra = divmod(rows, shards)
    wide = extra * (each + 1)
    p = F.col("__position")
    shard = F.when(p < wide, F.floor(p / F.lit(each + 1))).otherwise(extra + F.floor((p - wide) / F.lit(max(1, each))))
    start = F.col("__shard") * each + F.least(F.col("__shard"), F.lit(extra))
    return shuffled.withColumn("__shard", shard.cast("int")).withColumn("__slot", (p - start).cast("bigint"))


def assign(
    docs: DataFrame, shards: int = SHARDS, seed: int = SEED, id_col: str = "doc_id", text: str = "text",
    bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, size, text_crc32, law, shard, slot,
    grown_shard.

    Law ``rows``: shard sizes differ by one row at most. A null text is empty:
    size 1, checksum 0. Null ids and repeated rows are rows like others; an
    empty table gives no rows. Other columns are ignored. Only ids, sizes and
    checksums are shuffled.
    """
    body = text_or_empty(text)
    records = docs.select(
        F.col(id_col).alias("doc_id"),
        (F.octet_length(body) + 1).cast("bigint").alias("size"),
        F.crc32(body).cast("bigint").alias("text_crc32"),
    )
    shuffled, rows = external_shuffle(records, seed, bucket_rows)
    return place(shuffled, rows, shards).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), F.col("__shard").alias("shard"),
        F.col("__slot").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def write_shards(
    docs: DataFrame, path: str, shards: int = SHARDS, seed: int = SEED, bucket_rows: int = BUCKET_ROWS
) -> None:
    """Write whole records, shuffled, as Parquet under ``path``/shard=N (shard_=N
    if the records have a column shard), in slot order within each file. A
    bucket holds about ``bucket_rows`` records, which a task sorts with spill,
    so neither short nor very long records fill a task's memory."""
    shuffled, rows = external_shuffle(docs, seed, bucket_rows)
    folder = "shard"
    while folder in docs.columns:
        folder += "_"
    (
        place(shuffled, rows, shards).repartitionByRange("__shard", "__slot").sortWithinPartitions("__shard", "__slot")
        .select(*docs.columns, F.col("__shard").alias(folder)).write.partitionBy(folder).parquet(path)
    )


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assign(table(spark, sf_dir, "documents"))
