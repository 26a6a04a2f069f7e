"""Filter interaction audit: what each of several filters removes in every order.

Every document gets one bit per filter it fails. Exact duplicates of an earlier
document are found by an existential self-join: a left-semi join on the hash of
the text, the exact text and a smaller id. The rows it finds are united with the
rows that fail other filters, bits are combined per document, and documents are
counted by combination, so that every order of the filters is computed from at
most 2**k counts a part.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Callable, Iterator, Mapping

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollforge.llm.common import HOT, table, text_or_empty
from rollforge.plans.storage import materialize

# Copies of a hot text are dealt to up to so many salted keys.
SALTS = 64
DUPLICATE = "E"
SLICE = 4 << 20
SPACE = re.compile(rb"[\x20\x09-\x0D]")


def slices(text: bytes) -> Iterator[bytes]:
    """The text in slices of about ``SLICE`` bytes that end behind white space."""
    at = 0
    while at < len(text):
        end = SPACE.search(text, at + SLICE)
        stop = end.end() if end else len(text)
        yield text[at:stop]
        at = stop


@F.arrow_udf(T.StructType([T.StructField("words", T.LongType()), T.StructField("distinct", T.LongType())]))
def word_counts(texts: pa.Array) -> pa.Array:
    """Words of each text (runs without ASCII white space) and different ones. Spark's
    array_distinct compares every pair of strings, so words are kept in a set here."""
    counts = []
    for text in texts.cast(pa.large_binary()).to_pylist():
        n, seen = 0, set()
        for part in slices(text or b""):
            words = part.split()
            n += len(words)
            seen.update(words)
        counts.append({"words": n, "distinct": len(seen)})
    return pa.array(counts, pa.struct([("words", pa.int64()), ("distinct", pa.int64())]))


def standard_filters(text: Column) -> dict[str, Column]:
    """Failure conditions on the text alone."""
    counts = word_counts(text)
    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", ""))
    return {
        "A": counts["words"] < 50,
        "B": counts["distinct"] * 100 < counts["words"] * 65,
        "C": capitals * 100 > F.length(text) * 5,
        "D": text.rlike(r"[#$%&*|]"),
    }


def earlier_copies(docs: DataFrame, total: int) -> DataFrame:
    """The rows of ``docs`` (doc_id, text) whose text a smaller doc_id has too:
    doc_id and digest, one row each.

    Texts whose hash is unique are not shipped. The other side of the semi-join
    is the smallest id of each text, so no pairs are made; a text that 1/HOT of
    all rows share meets it under as many salted keys as it has rows, at most
    ``SALTS``.
    """
    hashed = docs.where(F.col("doc_id").isNotNull()).withColumn("h", F.xxhash64("text"))
    sizes = materialize(hashed.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "copied_hashes")
    hot = sizes.where(F.col("n") * HOT >= total).select("h", F.least(F.col("n"), F.lit(SALTS)).alias("salts"))
    copied = (
        hashed.join(sizes.select("h"), "h", "left_semi").join(F.broadcast(hot), "h", "left")
        .withColumn("salts", F.coalesce("salts", F.lit(1)))
    )
    rows = copied.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.col("salts")))
    first = (
        copied.groupBy("h", "text", "salts").agg(F.min("doc_id").alias("first_id"))
        .withColumn("salt", F.explode(F.expr("sequence(0L, salts - 1L)"))).drop("salts")
    )
    a, b = rows.alias("a"), first.alias("b")
    same = (
        (F.col("a.h") == F.col("b.h")) & (F.col("a.salt") == F.col("b.salt")) & (F.col("a.text") == F.col("b.text"))
        & (F.col("b.first_id") < F.col("a.doc_id"))
    )
    return a.join(b.hint("merge"), same, "left_semi").select("doc_id", F.md5("text").alias("digest"))


def failure_bits(docs: DataFrame, labels: DataFrame, filters: Mapping[str, Column], duplicate: str) -> DataFrame:
    """Distinct documents (doc_id, digest, part) with ``n`` rows, ``bits`` and
    the flags good and toxic. ``docs`` has doc_id, part and text (not null)."""
    bits = sum((F.when(failed, F.lit(1 << i)).otherwise(0) for i, failed in enumerate(filters.values())), F.lit(0))
    scanned = docs.select("doc_id", F.md5("text").alias("digest"), "part", bits.alias("bits"))
    others = materialize(
        scanned.groupBy("doc_id", "digest", "part").agg(F.first("bits").alias("bits"), F.count(F.lit(1)).alias("n")),
        "failures",
    )
    total = others.agg(F.sum("n")).first()[0] or 0
    copies = materialize(
        earlier_copies(docs.select("doc_id", "text"), total).distinct()
        .select("doc_id", "digest", F.lit(1 << len(filters)).alias("bits")),
        "earlier_copies",
    )
    # a copy's id may be in several parts; rows without an id have no smaller one
    marked = others.where("doc_id is not null").select("doc_id", "digest", "part", "n", "bits").unionByName(
        others.select("doc_id", "digest", "part").join(copies, ["doc_id", "digest"]).withColumn("n", F.lit(0).cast("bigint"))
    )
    combined = marked.groupBy("doc_id", "digest", "part").agg(
        F.bit_or("bits").cast("int").alias("bits"), F.sum("n").alias("n")
    )
    known = labels.where("doc_id is not null").groupBy("doc_id").agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"),
    )
    judged = combined.join(known, "doc_id", "left").select(
        "part", "bits", "n", F.coalesce("good", F.lit(False)).alias("good"), F.coalesce("toxic", F.lit(False)).alias("toxic")
    )
    nameless = others.where("doc_id is null").select(
        "part", F.col("bits").cast("int").alias("bits"), "n", F.lit(False).alias("good"), F.lit(False).alias("toxic")
    )
    return judged.unionByName(nameless)


def every_order(counts: DataFrame, letters: str) -> DataFrame:
    """All orders and steps of one row per part, from its array ``entries`` of
    (key: bits, value: n, good, toxic).

    A step's counts depend on its filter and on the set of those before it, so
    they are summed once for each such pair and then looked up by every order.
    """
    orders = ["".join(order) for order in itertools.permutations(letters)]
    sets = 1 << len(letters)
    # a filter is first among the m that a document fails in 1/m of all orders
    shares = F.array(*[F.lit(len(orders) // m) for m in range(1, len(letters) + 1)])

    def counted(pair: Column) -> Column:
        mask = F.element_at(F.array(*[F.lit(1 << i) for i in range(len(letters))]), (pair / sets).cast("int") + 1)
        before = pair % sets

        def fails(bits: Column) -> Column:
            return bits.bitwiseAND(mask) != 0

        def earlier(bits: Column) -> Column:
            return bits.bitwiseAND(before) != 0

        def total(wanted: Callable[[Column], Column], value: Callable[[Column], Column]) -> Column:
            return F.aggregate(
                "entries", F.lit(0).cast("bigint"),
                lambda acc, e: acc + F.when(wanted(e["key"]), value(e)).otherwise(F.lit(0).cast("bigint")),
            )

        def n(entry: Column) -> Column:
            return entry["value"]["n"]

        return F.struct(
            total(lambda b: ~fails(b) & ~earlier(b), n).alias("kept"),
            total(lambda b: fails(b) & ~earlier(b), n).alias("removed"),
            total(lambda b: fails(b) & earlier(b), n).alias("redundant"),
            total(lambda b: b == mask, n).alias("unique_fails"),
            total(lambda b: fails(b) & ~earlier(b), lambda e: e["value"]["good"]).alias("good_lost"),
            total(lambda b: fails(b) & ~earlier(b), lambda e: e["value"]["toxic"]).alias("toxic_lost"),
            total(fails, lambda e: n(e) * F.element_at(shares, F.bit_count(e["key"]))).alias("shapley"),
        )

    def pairs(order: Column) -> Column:
        """For each step of an order its filter's number and the set before it, as one number."""
        filters = F.transform(F.split(order, ""), lambda c: F.instr(F.lit(letters), c) - 1)
        masks = F.transform(filters, lambda f: F.element_at(F.array(*[F.lit(1 << i) for i in range(len(letters))]), f + 1))

        def before(step: Column) -> Column:
            return F.aggregate(F.slice(masks, F.lit(1), step), F.lit(0), lambda acc, mask: acc + mask)

        return F.transform(filters, lambda f, step: f * sets + before(step))

    placed = counts.withColumn("sums", F.transform(F.expr(f"sequence(0, {len(letters) * sets - 1})"), counted))
    placed = placed.select("part", "sums", F.explode(F.split(F.lit(",".join(orders)), ",")).alias("filter_order"))
    placed = placed.select("part", "sums", "filter_order", F.posexplode(pairs(F.col("filter_order"))).alias("step", "pair"))
    return placed.select(
        "part", "filter_order", (F.col("step") + 1).alias("step"), F.element_at("sums", F.col("pair") + 1).alias("sums")
    ).select("part", "filter_order", "step", "sums.*")


def audit(
    docs: DataFrame, labels: DataFrame, filters: Mapping[str, Column] | None = None, duplicate: str = DUPLICATE,
    id_col: str = "doc_id", text: str = "text", part: str = "source",
) -> DataFrame:
    """One row per part, order of all filters and step; zeros included.

    ``filters`` maps letters to failure conditions on the column ``text`` (null:
    empty) of the given documents; a null condition is no failure. ``duplicate``
    names the filter of texts that a smaller id has too, in any part. A null
    part is the empty string. A null id is smaller than none and never a copy;
    rows that repeat with id and text are counted each, and are no copies of one
    another. Labels are joined by id; of repeated ones, any that is 1 counts. An
    empty table gives no rows; other columns are ignored.
    """
    rows = docs.select(
        F.col(id_col).alias("doc_id"), text_or_empty(text).alias("text"), F.coalesce(F.col(part), F.lit("")).alias("part")
    )
    filters = {k: F.coalesce(v, F.lit(False)) for k, v in (filters or standard_filters(F.col("text"))).items()}
    letters = "".join([*filters, duplicate])
    combos = failure_bits(rows, labels, filters, duplicate).groupBy("part", "bits").agg(
        F.sum("n").alias("n"), F.sum(F.when(F.col("good"), F.col("n")).otherwise(0)).alias("good"),
        F.sum(F.when(F.col("toxic"), F.col("n")).otherwise(0)).alias("toxic"),
    )
    # at most 2**filters entries a part
    counts = combos.groupBy("part").agg(
        F.collect_list(F.struct(F.col("bits").alias("key"), F.struct("n", "good", "toxic").alias("value"))).alias("entries")
    )
    return every_order(counts, letters)


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


OP12_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, coalesce(source, '') AS part,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), l AS (
  SELECT doc_id, max(quality = 1) AS good, max(toxic = 1) AS toxic FROM labels GROUP BY doc_id
), f AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
    CASE WHEN len(w) < 50 THEN 1 ELSE 0 END
    + CASE WHEN 100 * len(list_distinct(w)) < 65 * len(w) THEN 2 ELSE 0 END
    + CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * length(t) THEN 4 ELSE 0 END
    + CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END
    + CASE WHEN coalesce(min(doc_id) OVER (PARTITION BY t) < doc_id, false) THEN 16 ELSE 0 END AS bits
  FROM d LEFT JOIN l USING (doc_id)
), c AS (
  SELECT part, bits, count(*) AS n, sum(good::INT) AS good, sum(toxic::INT) AS toxic FROM f GROUP BY part, bits
), x AS (
  SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS letter, unnest([1, 2, 4, 8, 16]) AS mask
), o AS (
  SELECT a.letter || b.letter || c.letter || d.letter || e.letter AS filter_order,
    [a.mask, b.mask, c.mask, d.mask, e.mask] AS masks
  FROM x a, x b, x c, x d, x e WHERE a.mask + b.mask + c.mask + d.mask + e.mask = 31
    AND len(list_distinct([a.mask, b.mask, c.mask, d.mask, e.mask])) = 5
), s AS (
  SELECT filter_order, step, masks[step] AS mask, coalesce(list_sum(masks[1:step - 1]), 0)::INT AS before
  FROM o, (SELECT unnest(range(1, 6)) AS step)
), r AS (
  SELECT part, filter_order, step, c.bits, c.n, c.good, c.toxic, mask,
    (c.bits & mask) <> 0 AS fails, (c.bits & before) <> 0 AS earlier
  FROM c, s
), a AS (
  SELECT part, filter_order, step, mask,
    sum(CASE WHEN NOT fails AND NOT earlier THEN n ELSE 0 END)::BIGINT AS kept,
    sum(CASE WHEN fails AND NOT earlier THEN n ELSE 0 END)::BIGINT AS removed,
    sum(CASE WHEN fails AND earlier THEN n ELSE 0 END)::BIGINT AS redundant,
    sum(CASE WHEN bits = mask THEN n ELSE 0 END)::BIGINT AS unique_fails,
    sum(CASE WHEN fails AND NOT earlier THEN good ELSE 0 END)::BIGINT AS good_lost,
    sum(CASE WHEN fails AND NOT earlier THEN toxic ELSE 0 END)::BIGINT AS toxic_lost
  FROM r GROUP BY ALL
)
SELECT part, filter_order, CAST(step AS INT) AS step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
  (sum(removed) OVER (PARTITION BY part, mask))::BIGINT AS shapley
FROM a
"""
