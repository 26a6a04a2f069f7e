"""Joining per-group figures back to rows, and numbering rows, when one group
may hold a large share of all rows.

No function here gathers a whole group in one task: groups are aggregated with
map-side partial aggregation, and ordered work runs on bounded slices of a
group whose offsets come from a small table of slice counts.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollforge.plans.storage import materialize

# A table is broadcast only after its rows and bytes were counted.
BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 64 << 20
HOT_GROUPS = 1024
SALTS = 256


def size_of(df: DataFrame) -> tuple[int, int]:
    """Rows, and bytes of the values (fixed-size values count 16)."""
    sizes = [
        F.coalesce(F.octet_length(f.name), F.lit(0)) + 16 if isinstance(f.dataType, (T.StringType, T.BinaryType))
        else F.size(f.name) * 16 + 16 if isinstance(f.dataType, T.ArrayType) else F.lit(16)
        for f in df.schema.fields
    ]
    row = df.agg(F.count(F.lit(1)), F.coalesce(F.sum(sum(sizes, F.lit(0)).cast("bigint")), F.lit(0))).first()
    return row[0], row[1]


def fits_broadcast(df: DataFrame, rows: int | None = None) -> bool:
    n, size = size_of(df)
    return n <= (BROADCAST_ROWS if rows is None else rows) and size <= BROADCAST_BYTES


def _same(left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]]) -> Column:
    return reduce(lambda a, b: a & b, [left[a].eqNullSafe(right[b]) for a, b in pairs])


def attach_stats(
    rows: DataFrame,
    stats: DataFrame,
    keys: Sequence[str],
    n: str = "n",
    broadcast_rows: int | None = None,
    hot_groups: int = HOT_GROUPS,
) -> DataFrame:
    """Add the columns of ``stats`` (one row per ``keys``, ``n`` = group size)
    to every row. Rows are told apart by their columns: count copies first.

    A null key is a key. The columns are those of ``rows``, then the figures.

    * ``stats`` is written once, then its rows and bytes are counted.
    * A table that fits is joined by broadcast, rows do not move.
    * More: the ``hot_groups`` largest groups (a bounded table) are joined by
      broadcast, and only rows of the other groups need the shuffle join. Hot
      rows are spread over ``SALTS`` salted keys that match nothing there.
    """
    keys = list(keys)
    if not keys:
        raise ValueError("attach_stats needs at least one key")
    values = [c for c in stats.columns if c not in keys]
    taken = sorted(set(values) & set(rows.columns))
    if taken:
        raise ValueError(f"rows already have columns {taken}")
    stats = materialize(stats, "stats")
    if fits_broadcast(stats, broadcast_rows):
        small = stats.select(*[F.col(k).alias(f"__key_{k}") for k in keys], *values)
        joined = rows.join(F.broadcast(small), _same(rows, small, [(k, f"__key_{k}") for k in keys]), "left")
        return joined.select(*rows.columns, *values)

    hot = stats.orderBy(F.desc(n), *keys).limit(hot_groups)
    hot = hot.select(
        *[F.col(k).alias(f"__hot_{k}") for k in keys], *[F.col(v).alias(f"__hot_{v}") for v in values]
    )
    marked = rows.join(F.broadcast(hot), _same(rows, hot, [(k, f"__hot_{k}") for k in keys]), "left")
    is_hot = F.col(f"__hot_{n}").isNotNull()
    spread = F.pmod(F.xxhash64(*[F.col(c) for c in rows.columns]), F.lit(SALTS)) + 1
    marked = marked.withColumn("__salt", F.when(is_hot, spread).otherwise(F.lit(0).cast("bigint")))
    cold = stats.select(
        *[F.col(k).alias(f"__cold_{k}") for k in keys],
        F.lit(0).cast("bigint").alias("__cold_salt"),
        *[F.col(v).alias(f"__cold_{v}") for v in values],
    )
    on = _same(marked, cold, [(k, f"__cold_{k}") for k in keys] + [("__salt", "__cold_salt")])
    joined = marked.join(cold, on, "left")
    return joined.select(
        *rows.columns,
        *[F.when(is_hot, F.col(f"__hot_{v}")).otherwise(F.col(f"__cold_{v}")).alias(v) for v in values],
    )


def join_lookup(rows: DataFrame, lookup: DataFrame, key: str, broadcast_rows: int | None = None) -> DataFrame:
    """Inner join with a table of unique keys, whatever the key distribution of
    ``rows``: by broadcast when the table fits, else with the frequent keys
    found by a count first."""
    columns = [*rows.columns, *[c for c in lookup.columns if c != key]]
    if fits_broadcast(lookup, broadcast_rows):
        return rows.join(F.broadcast(lookup), key).select(*columns)
    sizes = rows.groupBy(key).agg(F.count(F.lit(1)).alias("__n"))
    found = attach_stats(rows, lookup.join(sizes, key), [key], n="__n", broadcast_rows=broadcast_rows)
    return found.where(F.col("__n").isNotNull()).select(*columns)


def digest(key: Column, seed: int) -> Column:
    """Hex digest that orders rows the same way on every cluster."""
    return F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))


def hash_position(
    df: DataFrame,
    key: str,
    seed: int,
    groups: Sequence[str] = (),
    hex_digits: int = 3,
    name: str = "position",
    limit: int | None = None,
) -> DataFrame:
    """0-based position of each row in the seeded hash order of ``key``.

    ``key`` must be unique within a group. Rows are cut into ``16**hex_digits``
    digest buckets; only a bucket is ever sorted in one task. With ``limit``,
    rows of buckets past the first ``limit`` positions are dropped before the
    shuffle.
    """
    groups = list(groups)
    marked = df.withColumn("__digest", digest(F.col(key), seed)).withColumn(
        "__bucket", F.substring("__digest", 1, hex_digits)
    )
    counts = marked.groupBy(*groups, "__bucket").agg(F.count(F.lit(1)).alias("__count"))
    before = Window.partitionBy(*groups).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("__offset", F.coalesce(F.sum("__count").over(before), F.lit(0)))
    offsets = offsets.drop("__count")
    if limit is not None:
        offsets = offsets.where(F.col("__offset") < limit)
    if not groups:  # at most 16**hex_digits rows
        offsets = F.broadcast(offsets)
    inside = Window.partitionBy(*groups, "__bucket").orderBy("__digest", key)
    placed = (
        marked.join(offsets, [*groups, "__bucket"])
        .withColumn(name, F.col("__offset") + F.row_number().over(inside) - 1)
        .drop("__digest", "__bucket", "__offset")
    )
    return placed if limit is None else placed.where(F.col(name) < limit)


def range_running(
    df: DataFrame,
    groups: Sequence[str],
    order: Sequence[str],
    weight: str | None = None,
    name: str = "before",
    partitions: int | None = None,
) -> DataFrame:
    """Sum of ``weight`` (1 if None) over the rows that precede a row in its group.

    ``order`` must be total within a group. Rows are range-partitioned on
    ``(groups, order)``, so that a large group covers many partitions, and the
    partitioned table is written once; each partition is summed by itself and
    shifted by the sums of the partitions before it.
    """
    groups, order = list(groups), list(order)
    w = F.lit(1).cast("bigint") if weight is None else F.col(weight)
    by = [*groups, *order]
    # without a number, adaptive execution joins neighbouring small slices
    ranged = df.repartitionByRange(partitions, *by) if partitions else df.repartitionByRange(*by)
    sliced = materialize(ranged.withColumn("__part", F.spark_partition_id()), "ranges")
    sums = sliced.groupBy(*groups, "__part").agg(F.sum(w).alias("__sum"))
    earlier = Window.partitionBy(*groups).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.withColumn("__offset", F.coalesce(F.sum("__sum").over(earlier), F.lit(0))).drop("__sum")
    offsets = materialize(offsets, "offsets")
    if fits_broadcast(offsets):
        offsets = F.broadcast(offsets)
    inside = Window.partitionBy("__part", *groups).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (
        sliced.withColumn("__inside", F.coalesce(F.sum(w).over(inside), F.lit(0)))
        .join(offsets, [*groups, "__part"])
        .withColumn(name, F.col("__offset") + F.col("__inside"))
        .drop("__part", "__inside", "__offset")
    )


@F.arrow_udf(T.LongType())
def ordered_bits(values: pa.Array) -> pa.Array:
    """Whole numbers that are ordered as the doubles are: NaN last, both zeros equal."""
    x = values.to_numpy(zero_copy_only=False) + 0.0
    x = np.where(np.isnan(x), np.nan, x)
    bits = x.view(np.int64)
    return pa.array(np.where(bits < 0, bits ^ np.int64(0x7FFFFFFFFFFFFFFF), bits))


RADIX_BITS = 16
# So many rows of a group that share their leading bits are told apart in one round.
LAST_ROUND = 1_000_000


def exact_quantile(
    df: DataFrame, groups: Sequence[str], value: str, q: float, name: str = "threshold"
) -> DataFrame:
    """Exact linearly interpolated quantile per group (columns ``groups``, n,
    ``name``), by radix selection.

    Each of four rounds counts the next 16 bits of the values that still can be
    one of the two order statistics next to ``q * (n - 1)``: at most 2**16
    partial counts a group, whatever its size, and nothing is sorted. A null
    group is a group; null values are left out. The last round comes earlier if
    no more than ``LAST_ROUND`` rows are left of each group.
    """
    groups = list(groups)
    if not groups:
        raise ValueError("exact_quantile needs at least one group column")
    values = df.where(F.col(value).isNotNull()).select(*groups, F.col(value).cast("double").alias("__value"))
    values = materialize(values.withColumn("__bits", ordered_bits("__value")), "ordered_bits")

    def place(counts: DataFrame, keys: Sequence[str]) -> DataFrame:
        """The digit that holds the rank, and the rank inside it."""
        before = Window.partitionBy(*keys).orderBy("__digit").rowsBetween(Window.unboundedPreceding, -1)
        placed = counts.withColumn("__before", F.coalesce(F.sum("__n").over(before), F.lit(0)))
        inside = (F.col("__before") <= F.col("__rank")) & (F.col("__rank") < F.col("__before") + F.col("__n"))
        return placed.where(inside).withColumn("__rank", F.col("__rank") - F.col("__before")).withColumnRenamed(
            "__n", "__left"
        ).drop("__before")

    first = 64 - RADIX_BITS
    counts = values.groupBy(*groups, F.shiftright("__bits", first).alias("__digit")).agg(F.count(F.lit(1)).alias("__n"))
    total = Window.partitionBy(*groups)
    rank = F.lit(float(q)) * (F.col("n") - 1)
    counts = materialize(counts, "digit_counts").withColumn("n", F.sum("__n").over(total)).withColumn(
        "__which", F.explode(F.array(F.lit(0), F.lit(1)))
    ).withColumn("__rank", F.when(F.col("__which") == 0, F.floor(rank)).otherwise(F.ceil(rank)).cast("bigint"))
    wanted = place(counts, [*groups, "__which"])
    known = first
    while known:
        wanted = materialize(wanted, "ranks")
        n_ranks, most = wanted.agg(F.count(F.lit(1)), F.max("__left")).first()
        shift = 0 if (most or 0) <= LAST_ROUND else known - RADIX_BITS
        named = wanted.select(*[F.col(g).alias(f"__of_{g}") for g in groups], "n", "__which", "__rank", F.col("__digit").alias("__prefix"))
        if n_ranks <= BROADCAST_ROWS:  # a few numbers a row
            named = F.broadcast(named)
        same = _same(values, named, [(g, f"__of_{g}") for g in groups])
        left = values.join(named, same & (F.shiftright(values["__bits"], known) == named["__prefix"]))
        wanted = place(
            left.groupBy(*groups, "n", "__which", "__rank", F.shiftright("__bits", shift).alias("__digit")).agg(
                F.count(F.lit(1)).alias("__n"), F.min("__value").alias("__value")
            ), [*groups, "__which"],
        )
        known = shift
    low, high = (F.max(F.when(F.col("__which") == i, F.col("__value"))) for i in (0, 1))
    found = wanted.groupBy(*groups).agg(F.max("n").alias("n"), low.alias("__low"), high.alias("__high"))
    part = F.lit(float(q)) * (F.col("n") - 1) - F.floor(F.lit(float(q)) * (F.col("n") - 1))
    between = F.when(part == 0, F.col("__low")).otherwise(F.col("__low") + (F.col("__high") - F.col("__low")) * part)
    return found.select(*groups, "n", between.alias(name))
