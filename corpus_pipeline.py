"""A training corpus from raw documents: stages that each apply one operator.

Every stage reads all its predecessor kept, takes effect on it, and returns the
columns of documents; the last returns the shard assignment.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rollforge.llm import decontam, jaccard_join, mixing, sharding, toxicity
from rollforge.llm.common import table, text_or_empty
from rollforge.plans.storage import materialize


def without(docs: DataFrame, key: Column, rejected: DataFrame) -> DataFrame:
    """``docs`` less the rows whose key (never null) is in ``rejected`` (column ``__key``)."""
    return (
        docs.withColumn("__key", key).join(rejected.distinct().hint("shuffle_hash"), "__key", "left_anti")
        .select(*docs.columns)
    )


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored 0.3 or more go. The score depends on the text alone, so
    texts are rejected, not ids; null and empty texts are scored like others."""
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), ~toxicity.held_out())
    found = toxicity.score(docs, model, keep_key=True)
    rejected = materialize(found.where("predicted = 1").select(F.col("text_key").alias("__key")), "toxic")
    return without(docs, toxicity.text_key("text"), rejected)


def one_per_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents, copies included, the one with the
    smallest id stays (a null id only in a group without ids). Texts without
    words are linked with nothing and stay."""
    found = materialize(jaccard_join.link_components(docs, count_links=False).select("doc_id", "text_key", "group"), "groups")

    def row_key(doc_id: Column, text_key: Column) -> Column:
        return F.concat(F.coalesce(doc_id.cast("string"), F.lit("~")), F.lit(":"), F.hex(text_key))

    named = found.withColumn("__key", row_key(F.col("doc_id"), F.col("text_key")))
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "__key"))["__key"]
    grouped = named.where(F.col("group").isNotNull())
    stay = grouped.groupBy("group").agg(first.alias("__key"), F.count(F.lit(1)).alias("n")).select("__key")
    copies = grouped.groupBy("__key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("__key")
    stay = materialize(stay.join(copies.withColumn("repeated", F.lit(True)), "__key", "left"), "kept_rows")
    stay = stay.withColumn("repeated", F.coalesce("repeated", F.lit(False)))
    alone = named.where(F.col("group").isNull()).select("__key", F.lit(False).alias("repeated"))
    kept = docs.withColumn("__key", row_key(F.col("doc_id").cast("bigint"), F.unhex(F.md5(text_or_empty())))).join(
        stay.unionByName(alone.distinct()).hint("shuffle_hash"), "__key"
    )
    # rows that repeat with id and text: the least of their copies
    least = kept.where("repeated").groupBy("__key").agg(F.min(F.struct(*docs.columns)).alias("__row"))
    return kept.where("not repeated").select(*docs.columns).unionByName(least.select("__row.*"))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share a window of words with a benchmark item go."""
    found = decontam.contamination(docs, table(spark, sf_dir, "benchmark"))
    rejected = materialize(found.where("contaminated").select(F.col("text_key").alias("__key")), "contaminated")
    return without(docs, decontam.text_key("text"), rejected)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes its words: not at all, once or
    twice. The mix takes documents whole, in a seeded order, but for the one in
    which a source's quota ends; that one is rounded, so a source misses its
    target by half a document at most, besides the rounding to blocks. Rows that
    repeat with id, source and text (the stages before leave none) are rounded
    together. Texts without words are not in a mix of words."""
    names = ["__id", "__source", "__size", "__hash"]
    key = {
        "__id": F.coalesce(F.col("doc_id").cast("string"), F.lit("~")), "__source": mixing.source_key(),
        "__size": mixing.words_of("text"), "__hash": mixing.text_hash("text"),
    }
    taken = mixing.mix(docs, keep_source=True).select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("~")).alias("__id"), F.col("key").alias("__source"),
        F.col("size").alias("__size"), F.col("text_hash").alias("__hash"), "taken",
    )
    times = taken.where("__size > 0").groupBy(*names).agg(
        F.floor(F.sum("taken") / F.sum("__size") + 0.5).cast("int").alias("__times")
    )
    times = materialize(times.where("__times > 0"), "times")
    return (
        docs.withColumns(key).join(times.hint("shuffle_hash"), names)
        .withColumn("__copy", F.explode(F.expr("sequence(1, __times)"))).select(*docs.columns)
    )


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sharding.assign(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("jaccard_join", one_per_group),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("sharding", shard),
]

# Scores of fitted trees have no SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage_{name}")
    return docs
