"""Small helpers shared by the operators of this package."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# A group with at least 1/HOT of all rows is hot: there are at most HOT such groups.
HOT = 256
CHUNK = 4096
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


@contextmanager
def small_batches(spark: SparkSession, size: int = 4 << 20) -> Iterator[None]:
    """What is run inside gives its Python tasks about ``size`` bytes at a time, or one
    row. Spark's 64 MB lie three times in an executor, for each of its tasks: twice
    while the batch grows, once in Python. A query takes the setting when it is run."""
    before = spark.conf.get(BATCH_BYTES)
    spark.conf.set(BATCH_BYTES, str(size))
    try:
        yield
    finally:
        spark.conf.set(BATCH_BYTES, before)


def copies(df: DataFrame, n: str, name: str) -> DataFrame:
    """``n`` rows for each row, numbered from 0 in ``name``; no array is longer
    than max(``CHUNK``, n / ``CHUNK``)."""
    return (
        df.withColumn("__chunk", F.explode(F.expr(f"sequence(0L, (`{n}` - 1) div {CHUNK})")))
        .withColumn(
            name, F.explode(F.expr(f"sequence(__chunk * {CHUNK}, least(`{n}`, (__chunk + 1) * {CHUNK}) - 1)"))
        )
        .drop("__chunk", n)
    )


def attach(rows: DataFrame, groups: DataFrame, keys: Sequence[str], n: str) -> DataFrame:
    """Inner join of ``rows`` with ``groups`` (one row per ``keys``, which are
    never null; ``n`` = rows of the group), whatever share one group has.

    Groups with 1/HOT of all rows or more are at most HOT, so they are
    broadcast and their rows stay where they are; the others are joined by
    shuffle. Both tables are read twice: pass written or cheap ones.
    """
    keys = list(keys)
    total = groups.agg(F.sum(n)).first()[0] or 0
    large = F.col(n) * HOT >= total
    hot = F.broadcast(groups.where(large))
    values = [c for c in groups.columns if c not in keys]
    columns = [*rows.columns, *values]
    cold = rows.join(F.broadcast(groups.where(large).select(*keys)), keys, "left_anti")
    return (
        rows.join(hot, keys).select(*columns).unionByName(cold.join(groups.where(~large), keys).select(*columns))
    )


def bucket_offsets(
    sums: DataFrame, groups: Sequence[str], bucket: str, value: str, buckets: int, name: str = "__offset"
) -> DataFrame:
    """Sum of ``value`` over the lower buckets of the group, for one row per
    (group, bucket) with buckets 0 to ``buckets - 1``. Buckets are summed in
    runs of about sqrt(``buckets``), so that no task orders more than that."""
    groups = list(groups)
    width = max(1, math.isqrt(buckets))
    runs = sums.withColumn("__run", F.floor(F.col(bucket) / F.lit(width)))
    before = (-(1 << 63), -1)
    inner = Window.partitionBy(*groups, "__run").orderBy(bucket).rowsBetween(*before)
    outer = Window.partitionBy(*groups).orderBy("__run").rowsBetween(*before)
    totals = runs.groupBy(*groups, "__run").agg(F.sum(value).alias("__total"))
    totals = totals.withColumn("__before", F.coalesce(F.sum("__total").over(outer), F.lit(0))).drop("__total")
    return (
        runs.withColumn("__within", F.coalesce(F.sum(value).over(inner), F.lit(0)))
        .join(totals, [*groups, "__run"])
        .withColumn(name, F.col("__before") + F.col("__within"))
        .drop("__run", "__before", "__within")
    )


def all_of(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)
