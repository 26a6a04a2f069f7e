"""Session settings used by the tests and the benchmark.

On a cluster the jobs run in whatever session they are given; nothing here is
required by the library.
"""

from __future__ import annotations

from pyspark.sql import SparkSession


def build_session(
    name: str = "rollforge", cores: int | str = "*", partitions: int = 8, checkpoint_dir: str | None = None
) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
    )
    if checkpoint_dir:
        builder = builder.config("spark.checkpoint.dir", checkpoint_dir)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
