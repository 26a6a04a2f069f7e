"""Sample groups that complete by count or expire by the clock.

State is kept per open group only: it goes when the group is complete, or when
the watermark passes the group's event-time timer. Everything that happens to a
group is a row of one result with a ``kind``:

* ``complete``: all ``expected`` samples arrived; mean and deviation of rewards;
* ``expired``: the timer passed first; figures of the samples there were;
* ``late``: samples older than the watermark, counted and in no group.

``group_results`` keeps the groups in Spark's state store and calls Python for
each of them: for streams of small micro-batches. ``group_results_to`` gives the
same results by built-in aggregates and a join, for batches of many groups.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from datetime import UTC, datetime
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from rollforge.plans.storage import materialize

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
RESULT = "kind string, seen long, expected long, mean double, std double"
STATE = "seen long, expected long, n long, mean double, m2 double, open_until long"
OPEN = "seen long, expected long, n long, mean double, m2 double, timer long"


def milliseconds(ts: datetime) -> int:
    return int((ts if ts.tzinfo else ts.astimezone(UTC)).timestamp() * 1000)


class GroupCollector(StatefulProcessor):
    """Collects the samples of one group; its first sample sets the timer."""

    def __init__(self, keys: Sequence[str], wait_ms: int) -> None:
        self.keys, self.wait_ms = list(keys), wait_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.group = handle.getValueState("group", STATE)

    def _row(self, key: Any, kind: str, seen: int, expected: int | None, n: int, mean: float, m2: float) -> Row:
        figures = {"mean": mean if n else None, "std": math.sqrt(m2 / (n - 1)) if n > 1 else None}
        return Row(**dict(zip(self.keys, key, strict=True)), kind=kind, seen=seen, expected=expected, **figures)

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:  # noqa: N802, N803
        watermark = timerValues.getCurrentWatermarkInMs()
        state: tuple | None = None
        known = late = 0
        for row in rows:
            at = milliseconds(row["ts"])
            if at < watermark:
                late += 1
                continue
            if state is None:
                state = tuple(self.group.get() or (0, 0, 0, 0.0, 0.0, 0))
                known = state[0]
            seen, expected, n, mean, m2, until = state
            if row["reward"] is not None:
                n += 1
                step = row["reward"] - mean
                mean += step / n
                m2 += step * (row["reward"] - mean)
            state = (seen + 1, max(expected, row["n"] or 0), n, mean, m2, min(until, at + self.wait_ms) if until else at + self.wait_ms)
        if late:
            yield self._row(key, "late", late, None, 0, 0.0, 0.0)
        if state is None:
            return
        if state[0] >= state[1]:
            if known:
                for timer in list(self.handle.listTimers()):
                    self.handle.deleteTimer(timer)
                self.group.clear()
            yield self._row(key, "complete", *state[:5])
            return
        self.group.update(state)
        if not known:
            self.handle.registerTimer(max(state[5], watermark + 1))

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[Row]:  # noqa: N802, N803
        state = self.group.get()
        if state is not None:
            self.group.clear()
            yield self._row(key, "expired", *tuple(state)[:5])

    def close(self) -> None:
        pass


def group_results(scored: DataFrame, keys: Sequence[str], late: str = "1 hour", wait_ms: int = 86_400_000) -> DataFrame:
    """Stream of group results: ``keys``, kind, seen, expected, mean, std.

    ``scored`` has ``keys``, ts (event time), reward (null: a sample without
    reward) and n (samples of its group). A group that is not complete
    ``wait_ms`` after its first sample's event time leaves its state as soon as
    the watermark, ``late`` behind the largest event time, passes that point.
    Samples that come after their group left form a group of their own. A null
    n counts as 0.
    """
    keys = list(keys)
    schema = T.StructType([scored.schema[k] for k in keys] + T.StructType.fromDDL(RESULT).fields)
    # a plain copy of the event time: by the marked column itself the operator would drop late rows unseen
    timed = scored.withWatermark("ts", late).select(
        *keys, F.timestamp_micros(F.unix_micros("ts")).alias("ts"), F.col("reward").cast("double").alias("reward"),
        F.col("n").cast("bigint").alias("n"),
    )
    return timed.groupBy(*keys).transformWithState(
        statefulProcessor=GroupCollector(keys, wait_ms), outputStructType=schema, outputMode="Update", timeMode="EventTime"
    )


def _steps(batch: DataFrame, open_groups: DataFrame, keys: Sequence[str], watermark: int, wait_ms: int) -> DataFrame:
    """One row per group that is open or has rows in the batch: the figures it has now."""
    known = F.coalesce(F.unix_millis("ts") < watermark, F.lit(False))
    rows = batch.select(*keys, F.unix_millis("ts").alias("at"), known.alias("late"),
                        F.col("reward").cast("double").alias("reward"), F.col("n").cast("bigint").alias("n"))
    in_time = ~F.col("late")
    reward = F.when(in_time, F.col("reward"))
    new = rows.groupBy(*[F.col(k).alias(f"__{k}") for k in keys]).agg(
        F.count_if("late").alias("new_late"), F.count_if(in_time).alias("new_seen"),
        F.max(F.when(in_time, F.col("n"))).alias("new_expected"), F.count(reward).alias("new_n"),
        F.avg(reward).alias("new_mean"), (F.var_pop(reward) * F.count(reward)).alias("new_m2"),
        F.min(F.when(in_time, F.col("at"))).alias("new_first"), F.max("at").alias("last"))
    same = reduce(lambda a, b: a & b, [open_groups[k].eqNullSafe(new[f"__{k}"]) for k in keys])
    both = open_groups.withColumn("held", F.lit(True)).join(new, same, "full_outer")

    def count(name: str) -> Column:
        return F.coalesce(name, F.lit(0).cast("bigint"))

    n, more = count("n"), count("new_n")
    apart = F.col("new_mean") - F.col("mean")
    mean = F.when(n == 0, F.col("new_mean")).when(more == 0, F.col("mean")).otherwise(F.col("mean") + apart * more / (n + more))
    m2 = F.when(n == 0, F.col("new_m2")).when(more == 0, F.col("m2")).otherwise(
        F.col("m2") + F.col("new_m2") + apart * apart * n * more / (n + more))
    held = F.coalesce("held", F.lit(False))
    first = F.coalesce("new_first", F.lit(watermark))
    return both.select(
        *[F.when(held, F.col(k)).otherwise(F.col(f"__{k}")).alias(k) for k in keys],
        (count("seen") + count("new_seen")).alias("seen"),
        F.greatest(count("expected"), count("new_expected")).alias("expected"),
        (n + more).alias("n"), mean.alias("mean"), m2.alias("m2"),
        F.coalesce("timer", F.greatest(first + wait_ms, F.lit(watermark + 1))).alias("timer"),
        count("new_late").alias("late"), (count("new_seen") > 0).alias("fed"), held.alias("held"), "last")


def group_results_to(
    scored: DataFrame, path: str, state: str, keys: Sequence[str], late_ms: int = 3_600_000, wait_ms: int = 86_400_000
) -> StreamingQuery:
    """The rows of ``group_results``, written to ``path`` by micro-batch.

    A batch folds its rows by group and joins them to the table of open groups,
    which it writes anew: no Python call per group, and work that grows with the
    batch and the open groups. The table lies under ``state``, in the two places
    of even and odd batches, beside the watermark; a repeated batch reads the
    place of the batch before it and replaces its own. Groups whose timer the
    batch's own watermark passes leave with it.
    """
    spark, keys = scored.sparkSession, list(keys)
    kept = T.StructType([scored.schema[k] for k in keys] + T.StructType.fromDDL(OPEN).fields)

    def write(batch: DataFrame, batch_id: int) -> None:
        here, before = f"{state}/open/{batch_id % 2}", f"{state}/open/{(batch_id + 1) % 2}"
        watermark, open_groups = 0, spark.createDataFrame([], kept)
        if batch_id:
            watermark = spark.read.parquet(f"{before}/watermark").first()[0]
            open_groups = spark.read.schema(kept).parquet(f"{before}/groups")
        steps = materialize(_steps(batch, open_groups, keys, watermark, wait_ms), "group_steps")
        last = steps.agg(F.max("last")).first()[0]
        clock = watermark if last is None else max(watermark, last - late_ms)
        complete = F.col("fed") & (F.col("seen") >= F.col("expected"))
        lives = (F.col("fed") | F.col("held")) & ~complete
        expired = lives & (F.col("timer") <= clock)
        none = F.lit(None)
        std = F.when(F.col("n") > 1, F.sqrt(F.col("m2") / (F.col("n") - 1)))
        left = F.when(F.col("late") > 0, F.struct(
            F.lit("late").alias("kind"), F.col("late").alias("seen"), none.cast("bigint").alias("expected"),
            none.cast("double").alias("mean"), none.cast("double").alias("std")))
        ended = F.when(complete | expired, F.struct(
            F.when(complete, "complete").otherwise("expired").alias("kind"), "seen", "expected", "mean", std.alias("std")))
        results = steps.select(*keys, F.explode(F.array_compact(F.array(left, ended))).alias("r")).select(*keys, "r.*")
        results.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
        steps.where(lives & ~expired).select(*kept.names).write.mode("overwrite").parquet(f"{here}/groups")
        spark.range(1).select(F.lit(clock).cast("bigint").alias("ms")).write.mode("overwrite").parquet(f"{here}/watermark")

    return (
        scored.writeStream.foreachBatch(write).option("checkpointLocation", f"{state}/checkpoint")
        .outputMode("append").trigger(availableNow=True).start()
    )


@contextmanager
def timers_allowed(spark: SparkSession) -> Iterator[None]:
    """Timers need the RocksDB state store; a query takes the setting when it starts."""
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        yield
    finally:
        spark.conf.set(PROVIDER, before) if before else spark.conf.unset(PROVIDER)
