"""Exact deduplication against a persistent digest index.

The index is a table bucketed and sorted by the SHA-256 of the text. A batch
is grouped by digest, joined to the index by a sort-merge anti-join that reads
the index without shuffling it, and the digests that are new are appended under
the batch's name, so that a batch offered again gets the same answers.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollforge.llm.common import attach, copies, table, text_or_empty
from rollforge.plans.storage import materialize, scratch_path

BUCKETS = 64
BATCHES = 2


class DigestIndex:
    """One row (digest, keep_id, batch) per text ever accepted.

    ``path`` outlives the session; opening an existing path continues it, and
    ``buckets`` must then be the number it was made with. ``close`` takes the
    name out of the session's catalog and leaves the files.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int = BUCKETS) -> None:
        self.spark, self.path, self.buckets = spark, path, buckets
        self.name = f"digest_index_{uuid.uuid5(uuid.NAMESPACE_URL, path).hex}"
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.name} (digest BINARY, keep_id BIGINT, batch STRING) USING PARQUET "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {int(buckets)} BUCKETS LOCATION '{path}'"
        )

    def read(self) -> DataFrame:
        return self.spark.table(self.name)

    def unseen(self, groups: DataFrame) -> DataFrame:
        """The rows of ``groups`` (unique ``digest``) that the index lacks."""
        return groups.hint("merge").join(self.read().select("digest"), "digest", "left_anti")

    def append(self, fresh: DataFrame, batch: str) -> None:
        fresh = fresh.select(
            "digest", F.col("keep_id").cast("bigint").alias("keep_id"), F.lit(batch).alias("batch")
        )
        (
            fresh.repartition(self.buckets, "digest").sortWithinPartitions("digest")
            .write.format("parquet").mode("append").option("path", self.path)
            .bucketBy(self.buckets, "digest").sortBy("digest").saveAsTable(self.name)
        )
        self.spark.catalog.refreshTable(self.name)

    def close(self) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")


def dedup(
    docs: DataFrame, index: DigestIndex, batch: str, id_col: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical; null counts as empty. A text that the index
    has from other batches keeps that row: no row of this batch is kept and
    keep_id is the earlier one. Else the row with the largest id stays (ids that
    are null come last); of repeated rows with that id and text, one stays.
    group_size counts the rows of this batch. ``batch`` names the rows: the same
    rows under the same name, as after a lost run, are answered as the first
    time. An empty table gives no rows and appends nothing. Other columns are
    ignored.
    """
    digest = F.unhex(F.sha2(text_or_empty(text), 256))
    rows = docs.select(F.col(id_col).alias("doc_id"), digest.alias("digest"))
    rows = materialize(rows.groupBy("doc_id", "digest").agg(F.count(F.lit(1)).alias("n")), "digests")
    groups = materialize(
        rows.groupBy("digest").agg(F.max("doc_id").alias("keep_id"), F.sum("n").alias("group_size")), "digest_groups"
    )
    index.append(materialize(index.unseen(groups).select("digest", "keep_id"), "fresh"), batch)
    # every digest of the batch is in the index now; its batch tells new from known
    judged = groups.drop("keep_id").hint("merge").join(index.read(), "digest").select(
        "digest", "keep_id", "group_size", (F.col("batch") == batch).alias("fresh")
    )
    found = attach(rows, materialize(judged, "judged"), ["digest"], "group_size")
    return copies(found, "n", "copy").select(
        "doc_id", "keep_id", "group_size",
        (F.col("fresh") & F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 0)).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def dedup_in_batches(
    docs: DataFrame, index: DigestIndex, batches: int = BATCHES, id_col: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``dedup`` of a table fed to ``index`` in ranges of falling ids, so that the
    row kept for a text is the one with its largest id, in whichever range it
    comes again; null ids are in the last range. group_size counts the rows of
    all ranges."""
    low, high = docs.agg(F.min(id_col), F.max(id_col)).first()
    if low is None:
        batches, low, high = 1, 0, 0
    width = (high - low) // batches + 1
    place = F.coalesce(F.floor((F.lit(high) - F.col(id_col)) / F.lit(width)), F.lit(batches - 1))
    parts = [dedup(docs.where(place == i), index, f"range-{i}", id_col, text) for i in range(batches)]
    answers = materialize(reduce(DataFrame.unionByName, parts).drop("group_size"), "answers")
    sizes = materialize(answers.groupBy("text_sha256").agg(F.count(F.lit(1)).alias("group_size")), "group_sizes")
    return attach(answers, sizes, ["text_sha256"], "group_size").select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256"
    )


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in two batches through one new index."""
    index = DigestIndex(spark, scratch_path(spark, "digest_index"))
    found = dedup_in_batches(table(spark, sf_dir, "documents"), index)
    index.close()
    return found


OP3_SQL = """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))
"""
