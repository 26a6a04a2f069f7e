"""Structured Streaming twins of the batch jobs.

Jobs are ``DataFrame -> DataFrame`` on a streaming input and use built-in state;
groups that complete or expire are in ``groups``. On the same closed input each
equals its batch twin.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from rollforge.operators import rewards as R
from rollforge.plans.skew import fits_broadcast
from rollforge.plans.storage import materialize, scratch_path


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A folder's ``<name>.parquet`` files as a stream, with the table's schema."""
    file = f"{name}.parquet"
    schema = spark.read.parquet(f"{folder}/{file}").schema
    return spark.readStream.schema(schema).option("pathGlobFilter", file).parquet(folder)


# --------------------------------------------------------------------- jobs

def score(rollouts: DataFrame, specs: Sequence[R.RewardSpec]) -> DataFrame:
    """Reward columns of arriving rollouts; stateless, append mode."""
    return R.combine(R.score(rollouts, specs), specs)


def metric_windows(
    metrics: DataFrame, width: str = "10 minutes", slide: str | None = None, late: str = "1 hour"
) -> DataFrame:
    """Tumbling or sliding event-time windows per metric name."""
    w = F.window("ts", width, slide) if slide else F.window("ts", width)
    return metrics.withWatermark("ts", late).groupBy(w.alias("w"), "name").agg(
        F.avg("value").alias("avg"), F.min("value").alias("min"), F.max("value").alias("max"),
        F.count("value").alias("n"),
    ).select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), "name", "avg", "min", "max", "n")


def running_moments(rewards: DataFrame, key: str, value: str) -> DataFrame:
    """Running count, sum and sum of squares, and the mean; update mode."""
    v = F.col(value)
    return rewards.groupBy(key).agg(
        F.count(v).alias("n"), F.sum(v).alias("sum"), F.sum(v * v).alias("sum_sq"), F.avg(v).alias("mean"))


def tokens_seen(tokens: DataFrame, key: str, n: str) -> DataFrame:
    return tokens.groupBy(key).agg(F.sum(n).alias("tokens_seen"))


# ------------------------------------------------------------------ running

def append_to(stream: DataFrame, path: str, checkpoint: str, partition_by: Sequence[str] = ()) -> StreamingQuery:
    """Process what is there and append it to a Parquet folder, exactly once;
    a metric log is partitioned by ``run_id``."""
    writer = stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return writer.outputMode("append").trigger(availableNow=True).start()


def update_to(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Process what is there in update mode. Each micro-batch owns one folder,
    so a repeated batch replaces its first attempt."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return (
        stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
        .outputMode("update").trigger(availableNow=True).start()
    )


def unique_to(stream: DataFrame, path: str, checkpoint: str, key: str = "prompt", order: Sequence[str] = ("ts",)) -> StreamingQuery:
    """The first row of every ``key`` ever seen, appended to ``path``.

    The stream holds no state: the folder of earlier results is the memory. A
    micro-batch keeps its first row of each key (by ``order``, then all
    columns), and of these the ones whose key no earlier batch wrote. If the
    keys of the batch fit a broadcast they are sent to the scan of the earlier
    ones, so that only matches move; else both sides are shuffled. A batch owns
    one folder and reads those before it, so a repeated batch replaces itself.
    A null key is a key.
    """
    spark = stream.sparkSession
    columns = stream.columns
    digest = F.unhex(F.sha2(F.coalesce(F.concat(F.lit("k"), F.col(key).cast("string")), F.lit("")), 256)).alias("__digest")

    def write(batch: DataFrame, batch_id: int) -> None:
        first = batch.select(digest, F.struct(*order, *[c for c in columns if c not in order]).alias("row"))
        first = materialize(first.groupBy("__digest").agg(F.min("row").alias("row")), "first_rows")
        try:
            earlier = spark.read.parquet(path).where(F.col("batch_id") < batch_id).select("__digest")
        except AnalysisException:  # nothing was written yet
            earlier = None
        if earlier is not None:
            keys = first.select("__digest")
            if fits_broadcast(keys):
                earlier = earlier.join(F.broadcast(keys), "__digest", "left_semi")
            first = first.join(earlier, "__digest", "left_anti")
        first.select("__digest", *[F.col(f"row.{c}").alias(c) for c in columns]).write.mode("overwrite").parquet(
            f"{path}/batch_id={batch_id}"
        )

    return (
        stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
        .outputMode("append").trigger(availableNow=True).start()
    )


def dropped_rows(query: StreamingQuery) -> int:
    """Rows that came after the watermark, over all micro-batches."""
    return sum(
        int(op["numRowsDroppedByWatermark"]) for p in query.recentProgress for op in p["stateOperators"]
    )


def latest(updates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Last update of each key of a folder written by ``update_to``."""
    values = [c for c in updates.columns if c not in (*keys, "batch_id")]
    return updates.groupBy(*keys).agg(F.max_by(F.struct(*values), "batch_id").alias("v")).select(*keys, "v.*")


def run_append(stream: DataFrame, label: str) -> DataFrame:
    spark = stream.sparkSession
    base = scratch_path(spark, label)
    append_to(stream, f"{base}/out", f"{base}/state").awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{base}/out")


def run_update(stream: DataFrame, label: str, keys: Sequence[str]) -> DataFrame:
    spark = stream.sparkSession
    base = scratch_path(spark, label)
    update_to(stream, f"{base}/out", f"{base}/state").awaitTermination()
    return latest(spark.read.parquet(f"{base}/out"), keys)
