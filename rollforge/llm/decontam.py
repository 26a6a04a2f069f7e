"""Benchmark decontamination by winnowing.

A window is 10 consecutive words of a benchmark item (all words of a shorter
one). Of the k-grams in a window the one with the least hash is its
fingerprint, so a window of a document that equals one of an item has the same
fingerprint: joining fingerprints finds every shared window. Hits are then
extended to whole windows, which are compared by a 128-bit digest of their
words.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rollforge.llm.common import table
from rollforge.llm.textscan import U64, Words, buffers, find_words, lower_ascii, mixed, pieces
from rollforge.plans.storage import materialize

WINDOW = 10
# Up to so many item fingerprints (8 bytes each) are sent to every task; more are joined by shuffle.
SENT_FINGERPRINTS = 1_000_000
# Up to so many item windows are joined by broadcast.
SENT_WINDOWS = 200_000
LOWER = lower_ascii()


def word_bytes() -> np.ndarray:
    """Bytes that words are made of, after lower-casing: 0-9, a-z, and 0x80 up."""
    flags = np.zeros(256, dtype=np.int8)
    flags[48:58] = 1
    flags[65:91] = 1
    flags[97:123] = 1
    flags[128:] = 1
    return flags


INSIDE = word_bytes()


def gram(length: int) -> int:
    """Words of the k-grams that a window of ``length`` words is fingerprinted by."""
    return (length + 1) // 2


def windows(words: Words, length: int) -> tuple[np.ndarray, np.ndarray]:
    """First words of all windows of ``length`` words that lie in one text, and
    their fingerprints: the least k-gram hash in each."""
    n, k = len(words.code), gram(length)
    if n < length:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=U64)
    with np.errstate(over="ignore"):
        grams = words.code[: n - k + 1].copy()
        for i in range(1, k):
            grams = mixed(grams) + words.code[i: n - k + 1 + i]
        grams = mixed(grams ^ U64(k))
    least = grams[: n - length + 1].copy()
    for i in range(1, length - k + 1):
        np.minimum(least, grams[i: n - length + 1 + i], out=least)
    crossing = np.zeros(n - length + 1, dtype=bool)
    for bound in words.bounds[1:-1]:
        crossing[max(0, bound - length + 1): bound] = True
    first = np.flatnonzero(~crossing)
    return first, least[first]


class Member:
    """Whether fingerprints are in a fixed set."""

    def __init__(self, values: np.ndarray) -> None:
        self.values = np.sort(values)
        self.low = np.zeros(1 << 22, dtype=bool)
        self.low[(values & U64((1 << 22) - 1)).astype(np.int64)] = True

    def of(self, found: np.ndarray) -> np.ndarray:
        out = self.low[(found & U64((1 << 22) - 1)).astype(np.int64)]
        at = np.flatnonzero(out)
        if len(at):
            place = np.minimum(np.searchsorted(self.values, found[at]), len(self.values) - 1)
            out[at] = self.values[place] == found[at]
        return out


def digest(raw: np.ndarray, words: Words, first: int, length: int) -> bytes:
    parts = [raw[words.start[i]: words.end[i]].tobytes() for i in range(first, first + length)]
    return hashlib.blake2b(b" ".join(parts), digest_size=16).digest()


ITEM_ROWS = "item_id string, length int, fingerprint long, window binary"
DOC_ROWS = "doc_id long, text_key binary, n_words long, hits array<struct<first:int,length:int,window:binary>>"


def item_windows(items: DataFrame, id_col: str, text: str) -> DataFrame:
    """All windows of all items: item_id, length, fingerprint, window (digest)."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_pylist()
            raw, at = buffers(batch.column(1))
            raw = LOWER[raw]
            out: list[tuple] = []
            for t, name in enumerate(ids):
                piece = raw[at[t]: at[t + 1]]
                words = find_words(piece, np.array([0, len(piece)]), INSIDE, LOWER)
                length = min(WINDOW, len(words.code))
                if not length:
                    continue
                for first, value in zip(*windows(words, length), strict=True):
                    out.append((name, length, int(value.astype(np.int64)), digest(piece, words, first, length)))
                if len(out) > 50_000:
                    yield rows(out)
                    out = []
            yield rows(out)

    def rows(out: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*out, strict=True)) if out else [(), (), (), ()]
        kinds = [pa.string(), pa.int32(), pa.int64(), pa.binary()]
        names = ["item_id", "length", "fingerprint", "window"]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    asked = items.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.col(text).cast("string"))
    return asked.mapInArrow(scan, ITEM_ROWS)


def text_key(text: str) -> Column:
    return F.unhex(F.sha2(F.coalesce(F.col(text), F.lit("")), 256))


def doc_fingerprints(docs: DataFrame, lengths: list[int]) -> DataFrame:
    """Distinct (text_key, length, fingerprint) of the windows of ``docs``."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(0)
            raw, at = buffers(batch.column(1))
            for a, b in pieces(at):
                words = find_words(raw[at[a]: at[b]], at[a: b + 1] - at[a], INSIDE, LOWER)
                for length in lengths:
                    first, found = windows(words, length)
                    owner = np.searchsorted(words.bounds, first, side="right") - 1
                    pairs = np.unique(np.rec.fromarrays([owner, found]))
                    yield pa.RecordBatch.from_arrays(
                        [
                            keys.take(pa.array(pairs.f0 + a)), pa.array(np.full(len(pairs), length, dtype=np.int32)),
                            pa.array(pairs.f1.view(np.int64)),
                        ],
                        names=["text_key", "length", "fingerprint"],
                    )

    return docs.select("text_key", "text").mapInArrow(scan, "text_key binary, length int, fingerprint long")


def hit_windows(docs: DataFrame, lengths: list[int], sent: dict[int, np.ndarray] | None) -> DataFrame:
    """Per row of ``docs`` its words and the windows with an item's fingerprint.

    The fingerprints are ``sent`` with the task, or stand in the row's column
    ``wanted`` (length, fingerprint) if None.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        members = {n: Member(v) for n, v in sent.items()} if sent is not None else {}
        for batch in batches:
            raw, at = buffers(batch.column(2))
            wanted = batch.column(3).to_pylist() if sent is None else None
            for a, b in pieces(at) if sent is not None else [(i, i + 1) for i in range(len(at) - 1)]:
                piece = LOWER[raw[at[a]: at[b]]]
                words = find_words(piece, at[a: b + 1] - at[a], INSIDE, LOWER)
                hits: list[list[dict]] = [[] for _ in range(a, b)]
                if sent is None:
                    mine = {n: [w["fingerprint"] for w in wanted[a] or () if w["length"] == n] for n in lengths}
                    members = {n: np.array(v, dtype=np.int64).view(U64) for n, v in mine.items() if v}
                for length, member in members.items():
                    first, found = windows(words, length)
                    keep = first[member.of(found) if sent is not None else np.isin(found, member)]
                    owner = np.searchsorted(words.bounds, keep, side="right") - 1
                    for t, w in zip(owner, keep, strict=True):
                        hits[t].append({
                            "first": int(w - words.bounds[t]), "length": length,
                            "window": digest(piece, words, w, length),
                        })
                kind = pa.list_(pa.struct([("first", pa.int32()), ("length", pa.int32()), ("window", pa.binary())]))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a),
                        pa.array(np.diff(words.bounds).astype(np.int64)), pa.array(hits, kind),
                    ],
                    names=["doc_id", "text_key", "n_words", "hits"],
                )

    columns = ["doc_id", "text_key", "text"] + (["wanted"] if sent is None else [])
    return docs.select(*columns).mapInArrow(scan, DOC_ROWS)


def union_length(spans: Column) -> Column:
    """Words covered by an array of (first, length), sorted."""
    zero = F.struct(F.lit(0).alias("end"), F.lit(0).cast("bigint").alias("covered"))
    return F.aggregate(
        spans, zero,
        lambda a, s: F.struct(
            F.greatest(a["end"], s["first"] + s["length"]).alias("end"),
            (a["covered"] + F.greatest(F.lit(0), s["first"] + s["length"] - F.greatest(a["end"], s["first"])))
            .cast("bigint").alias("covered"),
        ),
        lambda a: a["covered"],
    )


def contamination(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text: str = "text", item_id: str = "item_id",
    item_text: str = "text", sent_fingerprints: int = SENT_FINGERPRINTS, sent_windows: int = SENT_WINDOWS,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, text_key, n_words, n_hit, n_items,
    items_sha256, contaminated.

    Null and wordless texts have no words and no hits; items without words have
    no windows; a null item id is the empty string, and items that share an id
    count once. Repeated rows are rows like others. Without items nothing is
    contaminated; an empty table gives no rows; other columns are ignored.
    """
    found = materialize(item_windows(items, item_id, item_text).distinct(), "item_windows")
    prints = found.select("length", "fingerprint").distinct()
    lengths = sorted(r[0] for r in found.select("length").distinct().collect())  # 1 to WINDOW
    asked = docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"), text_key(text).alias("text_key"), F.col(text).alias("text")
    )
    if prints.count() <= sent_fingerprints:
        sent: dict[int, np.ndarray] = {}
        rows = prints.toPandas()
        for length, values in rows.groupby("length")["fingerprint"]:
            sent[int(length)] = values.to_numpy().view(U64)
        marked = hit_windows(asked, lengths, sent)
    else:
        shared = doc_fingerprints(asked, lengths).distinct().join(prints, ["length", "fingerprint"], "left_semi")
        # distinct fingerprints of one text: not more than its words
        wanted = shared.groupBy("text_key").agg(F.collect_list(F.struct("length", "fingerprint")).alias("wanted"))
        marked = hit_windows(asked.join(wanted.hint("shuffle_hash"), "text_key", "left"), lengths, None)
    marked = materialize(marked.withColumn("row", F.monotonically_increasing_id()), "marked")

    hits = marked.select("row", F.explode("hits").alias("hit")).select("row", "hit.*")
    known = found.select("length", "window", "item_id").distinct()
    if known.count() <= sent_windows:
        known = F.broadcast(known)
    joined = hits.join(known, ["length", "window"])
    spans = joined.groupBy("row", "first", "length").agg(F.lit(1).alias("one")).groupBy("row").agg(
        union_length(F.array_sort(F.collect_list(F.struct("first", "length")))).alias("n_hit")
    )
    names = joined.select("row", "item_id").distinct().groupBy("row").agg(
        F.count(F.lit(1)).alias("n_items"),
        F.sha2(F.concat_ws(",", F.array_sort(F.collect_list("item_id"))), 256).alias("items_sha256"),
    )
    none = F.sha2(F.lit(""), 256)
    return marked.drop("hits").join(spans, "row", "left").join(names, "row", "left").select(
        "doc_id", "text_key", "n_words", F.coalesce("n_hit", F.lit(0)).cast("bigint").alias("n_hit"),
        F.coalesce("n_items", F.lit(0)).cast("bigint").alias("n_items"),
        F.coalesce("items_sha256", none).alias("items_sha256"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
    )


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("text_key")


OP6_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), i AS (
  SELECT CAST(item_id AS VARCHAR) AS item_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
), iw AS (
  SELECT DISTINCT item_id, n, array_to_string(w[s:s + n - 1], ' ') AS win FROM (
    SELECT item_id, w, least(10, len(w)) AS n, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS s
    FROM i WHERE len(w) > 0)
), dw AS (
  SELECT doc_id, s, n, array_to_string(w[s:s + n - 1], ' ') AS win FROM (
    SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM d, (SELECT DISTINCT n FROM iw))
), hits AS (
  SELECT DISTINCT doc_id, s, n, item_id FROM dw JOIN iw USING (n, win)
), words AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM hits) GROUP BY doc_id
), items AS (
  SELECT doc_id, count(*) AS n_items, sha256(string_agg(item_id, ',' ORDER BY item_id)) AS items_sha256
  FROM (SELECT DISTINCT doc_id, item_id FROM hits) GROUP BY doc_id
)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       coalesce(items_sha256, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""
