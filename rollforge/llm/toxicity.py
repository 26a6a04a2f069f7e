"""Toxicity scores: gradient-boosted trees over dense features of a text,
calibrated by isotonic regression.

Features are densities of two lexicons (a given one, and words and word stems
learned from the labels), their nearness to second-person words, and rates of
capitals, punctuation and obfuscated words. Lexicon, trees and calibration are
fitted on a bounded sample of labelled rows; scoring reads every whole text.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rollforge.llm.common import table
from rollforge.plans.storage import materialize

# About so many labelled rows, chosen by a hash of their ids, are learned from.
SAMPLE = 20_000
# Evidence (log-likelihood ratio) from which a word or stem enters the learned lexicon, and its size at most.
EVIDENCE = 14.0
LEXICON = 5_000
STEMS = (3, 4, 5)
# Log odds from which a learned term counts as strong.
STRONG = 3.0
PARTS = 4
NEAR = 4
THRESHOLD = 0.3
TREES, DEPTH, STEP = 20, 3, 0.3

# General words of abuse and second-person words.
ABUSE = frozenset((
    "idiot idiots idiotic moron morons stupid dumb fool loser losers scum trash garbage worthless pathetic disgusting "
    "clown clowns ugly filthy vermin parasite pig pigs liar coward imbecile jerk creep freak"
).split())
SECOND_PERSON = frozenset((
    "you your yours yourself yourselves u ur du dich dir dein deine ihr euch euer tu te toi ton ta tes vous votre vos "
    "tú ti tus usted ustedes vosotros"
).split())
UNMASK = str.maketrans("013457@$!", "oieastasi")

WORD = re.compile(r"\w+")
MASK = re.compile(r"(?<=[^\W\d_])[0-9@$!*#]+(?=[^\W\d_])")
FEATURES = (
    "abuse", "learned", "learned_odds", "learned_most", "learned_strong", "abuse_near_you", "learned_near_you",
    "second_person", "upper_words", "marks", "capitals", "shouts", "masked", "words_log",
)


class Lexicon:
    """Words and word stems (marked by a final ``*``) with their log odds."""

    def __init__(self, weights: dict[str, float]) -> None:
        self.words = {t: w for t, w in weights.items() if t[-1] != "*"}
        self.stems = {t[:-1]: w for t, w in weights.items() if t[-1] == "*"}
        self.heads = frozenset(t[: STEMS[0]] for t in (*self.words, *self.stems))

    def weight(self, word: str) -> float:
        if word[: STEMS[0]] not in self.heads:
            return 0.0
        return max(self.words.get(word, 0.0), *[self.stems.get(word[:n], 0.0) for n in STEMS])


def masked_words(text: str) -> list[str]:
    """Words with digits or symbols between letters."""
    out, done = [], 0
    for m in MASK.finditer(text):
        a, b = m.span()
        if a < done:
            continue
        while a and text[a - 1].isalpha():
            a -= 1
        while b < len(text) and (text[b].isalpha() or text[b] in "0123456789@$!*#"):
            b += 1
        out.append(text[a:b])
        done = b
    return out


def features(text: str, lexicon: Lexicon) -> list[float]:
    """Of a whole text; nearly all 0 for one without words."""
    written = WORD.findall(text)
    n = len(written)
    if not n:
        return [0.0] * 9 + [float(bool(text) and not text.isspace()), 0.0, 0.0, 0.0, 0.0]
    words = [w.lower() for w in written]
    heads, first = lexicon.heads, STEMS[0]
    learned = {i: x for i, w in enumerate(words) if w[:first] in heads and (x := lexicon.weight(w))}
    given = [i for i, w in enumerate(words) if w in ABUSE]
    second = [i for i, w in enumerate(words) if w in SECOND_PERSON]

    def near(hits: list[int]) -> int:
        if not hits or not second:
            return 0
        at = np.searchsorted(second, hits)
        of = np.array([-(1 << 40), *second, 1 << 40])
        gap = np.minimum(np.array(hits) - of[at], of[at + 1] - np.array(hits))
        return int((gap <= NEAR).sum())

    upper = sum(1 for w in written if w.isupper() and len(w) > 1)
    capitals = sum(1 for w in written if w[0].isupper())
    letters = sum(map(len, written))
    masked = masked_words(text)
    plain = [w.lower().translate(UNMASK).replace("*", "").replace("#", "") for w in masked]
    hidden = sum(1 for w in plain if w in ABUSE or lexicon.weight(w))
    per = 100.0 / len(words)
    strong = sum(1 for x in learned.values() if x >= STRONG)
    return [
        len(given) * per, len(learned) * per, sum(learned.values()) * per, max(learned.values(), default=0.0),
        float(np.log1p(strong)), near(given) * per, near(list(learned)) * per, len(second) * per, upper / n,
        (len(text) - letters) / len(text), capitals / n,
        100.0 * (text.count("!") + text.count("?")) / len(text), (len(masked) + hidden) * per, float(np.log1p(n)),
    ]


def terms(text: str) -> set[str]:
    """Words, and stems marked by a final ``*``, of a text."""
    words = set(WORD.findall(text.lower()))
    return words | {f"{w[:n]}*" for w in words for n in STEMS if len(w) >= n}


def term_counts(sample: DataFrame, only: pa.Array | None = None) -> DataFrame:
    """(part, term, n): how many texts of a part have each term (of ``only``)."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, Counter[str]] = {}
        wanted = None if only is None else frozenset(only.to_pylist())
        for batch in batches:
            for part, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                mine = terms(text or "")
                found.setdefault(part, Counter()).update(mine if wanted is None else mine & wanted)
        for part, counted in found.items():
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([part] * len(counted), pa.int32()), pa.array(list(counted), pa.string()),
                    pa.array(list(counted.values()), pa.int64()),
                ],
                names=["part", "term", "n"],
            )

    counted = sample.select("part", "text").mapInArrow(scan, "part int, term string, n long")
    return counted.groupBy("part", "term").agg(F.sum("n").alias("n"))


def learn_lexicons(
    sample: DataFrame, parts: int = PARTS, evidence: float = EVIDENCE, most: int = LEXICON
) -> list[Lexicon]:
    """A lexicon from all parts but p, for each part p of ``sample`` (part,
    label, text), and last one from all. A lexicon has the terms that toxic
    texts have far more often than others: by log-likelihood ratio, the
    strongest ``most``. The sample bounds what reaches the driver."""
    sizes = np.zeros((2, parts))
    for r in sample.groupBy("label", "part").count().collect():
        sizes[r["label"], r["part"]] = r["count"]
    share = sizes[1].sum() / max(1.0, sizes.sum())
    if not 0 < share < 1:
        return [Lexicon({})] * (parts + 1)
    least = max(2, int(np.ceil(evidence / (2 * np.log(1 / share)))))  # fewer texts can't reach the evidence
    toxic = materialize(term_counts(sample.where(F.col("label") == 1)), "toxic_terms")
    often = toxic.groupBy("term").agg(F.sum("n").alias("n")).where(F.col("n") >= least).select("term").toArrow()
    often = often.column("term").combine_chunks()  # Arrow, not Python strings: those stay in the driver's memory
    counts = np.zeros((2, parts, len(often)))
    for label, found in ((1, toxic), (0, term_counts(sample.where(F.col("label") == 0), often))):
        rows = found.where(F.col("n") > 0).join(F.broadcast(toxic.groupBy("term").agg(
            F.sum("n").alias("all")).where(F.col("all") >= least).select("term")), "term").toArrow()
        place = pc.index_in(rows.column("term"), value_set=often).to_numpy()
        counts[label, rows.column("part").to_numpy(), place] = rows.column("n").to_numpy()
    out = []
    for left_out in range(parts + 1):
        keep = np.arange(parts) != left_out
        k, m = counts[1, keep].sum(axis=0), counts[0, keep].sum(axis=0)
        bad, good = sizes[1, keep].sum(), sizes[0, keep].sum()
        if not bad or not good:
            out.append(Lexicon({}))
            continue
        p, q, both = k / bad, m / good, (k + m) / (bad + good)
        with np.errstate(divide="ignore", invalid="ignore"):
            ratio = 2 * sum(
                np.where(n > 0, n * np.log(x / y), 0.0)
                for n, x, y in ((k, p, both), (m, q, both), (bad - k, 1 - p, 1 - both), (good - m, 1 - q, 1 - both))
            )
        odds = np.log((k + 0.5) / (bad + 1)) - np.log((m + 0.5) / (good + 1))
        fit = np.flatnonzero((ratio >= evidence) & (p > 4 * q))
        names = often.take(pa.array(fit)).to_pylist()
        first = np.lexsort((np.array(names, dtype=str), -ratio[fit]))[:most]
        out.append(Lexicon({names[i]: float(odds[fit[i]]) for i in first}))
    return out


def with_features(docs: DataFrame, lexicons: list[Lexicon], keys: Sequence[str] = ()) -> DataFrame:
    """A table (doc_id, label, part, text, binary ``keys``) with the text
    replaced by its features, by the lexicon that its part names."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts, texts = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            found = [features(t or "", lexicons[p]) for p, t in zip(parts, texts, strict=True)]
            found = np.array(found, dtype=float).reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], *batch.columns[4:], *[pa.array(found[:, i]) for i in range(len(FEATURES))]],
                names=["doc_id", "label", "part", *keys, *FEATURES],
            )

    kinds = ", ".join(f"{f} double" for f in FEATURES)
    kinds = ", ".join([*[f"{k} binary" for k in keys], kinds])
    rows = docs.select("doc_id", "label", "part", "text", *keys)
    return rows.mapInArrow(scan, f"doc_id long, label int, part int, {kinds}")


@dataclass
class Model:
    """A fitted lexicon, trees and calibration; without trees, a fixed score."""

    lexicon: Lexicon
    trees: GBTClassificationModel | None
    calibration: IsotonicRegressionModel | None
    base: float

    def score(self, measured: DataFrame) -> DataFrame:
        if self.trees is None:
            return measured.withColumn("score", F.lit(self.base))
        vectors = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(measured)
        return self.calibration.transform(self.trees.transform(vectors))


def sampled(docs: DataFrame, labels: DataFrame, learn: Column, sample: int) -> DataFrame:
    """(doc_id, label, text) of about ``sample`` labelled rows, by hash of the id.
    A document with several labels has the highest."""
    marked = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & learn).groupBy("doc_id").agg(
        F.max("toxic").cast("int").alias("label")
    )
    marked = materialize(marked, "labels")
    share = min(1.0, sample / max(1, marked.count()))
    chosen = marked.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < int(share * (1 << 20)))
    # at most about ``sample`` pairs of numbers
    return docs.join(F.broadcast(chosen), "doc_id").select("doc_id", "label", "text")


def train(docs: DataFrame, labels: DataFrame, learn: Column, sample: int = SAMPLE) -> Model:
    """Fit on rows with ``learn`` (on doc_id) true, in parts by a hash of the
    id. A row's features come from the lexicon of the other parts, the trees
    from all parts but 0, the calibration from part 0. Without labels of both
    kinds in each the score is the share of toxic rows."""
    chosen = sampled(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text"), labels, learn, sample)
    part = F.pmod(F.xxhash64(F.lit(5), "doc_id"), F.lit(PARTS)).cast("int")
    chosen = materialize(chosen.withColumn("part", part).repartition(12), "toxic_sample")
    lexicons = learn_lexicons(chosen)
    measured = materialize(with_features(chosen, lexicons), "toxic_features")
    sizes = {(r["label"], r["part"] == 0): r["n"] for r in
             measured.groupBy("label", "part").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(sizes) < 4:
        total = measured.count()
        toxic = measured.where("label = 1").count()
        return Model(lexicons[-1], None, None, toxic / total if total else 0.0)
    assembler = VectorAssembler(inputCols=list(FEATURES), outputCol="features")
    boosted = GBTClassifier(
        labelCol="label", featuresCol="features", maxIter=TREES, maxDepth=DEPTH, stepSize=STEP, seed=5,
        minInstancesPerNode=3,
    ).fit(assembler.transform(measured.where("part > 0")).repartition(6))
    margins = boosted.transform(assembler.transform(measured.where("part = 0")))
    calibration = IsotonicRegression(
        featuresCol="probability", featureIndex=1, labelCol="label", predictionCol="score"
    ).fit(margins.select("probability", F.col("label").cast("double").alias("label")))
    return Model(lexicons[-1], boosted, calibration, 0.0)


def text_key(text: str) -> Column:
    return F.unhex(F.md5(F.coalesce(F.col(text).cast("string"), F.lit(""))))


def score(
    docs: DataFrame, model: Model, id_col: str = "doc_id", text: str = "text", threshold: float = THRESHOLD,
    keep_key: bool = False,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, score (0 to 1), predicted (0 or 1),
    and with ``keep_key`` the text's digest ``text_key``.

    Null and empty texts have features of 0 and are scored like others.
    Repeated rows are rows like others; an empty table gives no rows; other
    columns are ignored.
    """
    rows = docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"), F.lit(0).alias("label"), F.lit(0).alias("part"),
        F.col(text).cast("string").alias("text"), text_key(text).alias("text_key"),
    )
    found = model.score(with_features(rows, [model.lexicon], ["text_key"] if keep_key else []))
    keys = ["text_key"] if keep_key else []
    return found.select(
        "doc_id", *keys, F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.col("score"))).alias("score")
    ).withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def held_out(id_col: str = "doc_id") -> Column:
    """A null id counts as the empty text: it is not held out."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % 4 == 2


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = train(docs, table(spark, sf_dir, "labels"), ~held_out())
    return score(docs, model).withColumn("held_out", held_out())
