"""Tables stored once in buckets of their row key, so that joins on it move no rows.

A log-probability pass writes its columns long after the rows were written, and
every later job joins the two. Stored in the same number of buckets of the same
key and sorted inside them, both are read bucket by bucket and merged in place.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BUCKETS = 64


class ColocatedTable:
    """A Parquet table at ``path`` in ``buckets`` buckets of ``keys``.

    The path outlives the session; ``open`` it again with the keys, buckets and
    columns it was written with. Only the session's catalog knows the name.
    """

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], buckets: int = BUCKETS) -> None:
        self.spark, self.path, self.keys, self.buckets = spark, path, list(keys), buckets
        self.name = f"colocated_{uuid.uuid5(uuid.NAMESPACE_URL, path).hex}"

    def write(self, df: DataFrame) -> ColocatedTable:
        """Replace the table by ``df``: one shuffle, one file a bucket. Null keys
        are dealt out with the others and, as in any join, match nothing."""
        (
            df.repartition(self.buckets, *self.keys).sortWithinPartitions(*self.keys).write.format("parquet").mode("overwrite")
            .option("path", self.path).bucketBy(self.buckets, *self.keys).sortBy(*self.keys).saveAsTable(self.name)
        )
        return self

    def open(self, schema: str) -> ColocatedTable:
        columns = ",".join(f"`{k}`" for k in self.keys)
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.name} ({schema}) USING PARQUET CLUSTERED BY ({columns}) SORTED BY ({columns})"
            f" INTO {int(self.buckets)} BUCKETS LOCATION '{self.path}'"
        )
        return self

    def read(self) -> DataFrame:
        return self.spark.table(self.name)

    def forget(self) -> None:
        """Take the name out of the session's catalog; the files stay."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")

    def join(self, other: ColocatedTable, how: str = "inner") -> DataFrame:
        """Join on the keys by merging bucket with bucket."""
        if (self.keys, self.buckets) != (other.keys, other.buckets):
            raise ValueError(f"{self.keys} in {self.buckets} buckets do not lie with {other.keys} in {other.buckets}")
        return self.read().hint("merge").join(other.read(), self.keys, how)


def attach_stored(rows: ColocatedTable, columns: ColocatedTable) -> DataFrame:
    """All rows with the stored columns; ``stored`` is false where they are
    missing (their columns are null then). A key that ``columns`` repeats is an
    error that names it."""
    keys = rows.keys
    joined = rows.read().hint("merge").join(columns.read().withColumn("__n", F.lit(1)), keys, "left")
    shown = F.concat_ws(",", *[F.col(k).cast("string") for k in keys])
    stored = F.col("__n").isNotNull()
    once = columns.read().groupBy(*keys).agg(F.count(F.lit(1)).alias("__times"))  # in place as well
    checked = joined.hint("merge").join(once, keys, "left").withColumn(
        "stored", F.when(F.col("__times") > 1, F.raise_error(F.concat(F.lit("repeated key "), shown)).cast("boolean")).otherwise(stored)
    )
    return checked.drop("__n", "__times")
