"""Language identification of mixed-language text.

A word's script narrows its candidate languages. Each candidate scores the word
by the log-probabilities of its letter trigrams; Viterbi over a text's words,
with a penalty for every switch, labels spans. A text's language is the one
with the most labelled letters.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rollforge.llm.common import table
from rollforge.llm.textscan import U64, mixed

# The model is fitted on about so many texts of each language, chosen by a hash of their ids.
SAMPLE = 2000
BUCKETS = 1 << 16
PENALTY = 8.0
SMOOTHING = 0.5
# Share of a language's letters from which a script is one of its own.
SCRIPT_SHARE = 0.01
# Letters and other characters that a worker scans together.
SCAN_CHARS = 2 << 20

# First code points of Unicode script ranges and their script.
SCRIPT_RANGES = (
    (0x0000, "latin"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"), (0x0590, "hebrew"),
    (0x0600, "arabic"), (0x0780, "other"), (0x0900, "devanagari"), (0x0980, "bengali"), (0x0A00, "other"),
    (0x0B80, "tamil"), (0x0C00, "telugu"), (0x0C80, "other"), (0x0E00, "thai"), (0x0E80, "other"),
    (0x10A0, "georgian"), (0x1100, "hangul"), (0x1200, "ethiopic"), (0x1400, "other"), (0x1E00, "latin"),
    (0x1F00, "greek"), (0x2000, "other"), (0x2C60, "latin"), (0x2C80, "other"), (0x3040, "kana"),
    (0x3100, "other"), (0x3130, "hangul"), (0x3190, "other"), (0x3400, "han"), (0xA000, "other"),
    (0xA640, "cyrillic"), (0xA720, "latin"), (0xA800, "other"), (0xAC00, "hangul"), (0xD7B0, "other"),
    (0xF900, "han"), (0xFB00, "latin"), (0xFB13, "other"), (0xFF21, "latin"), (0xFF5B, "other"), (0x20000, "han"),
)
SCRIPTS = tuple(dict.fromkeys(name for _, name in SCRIPT_RANGES))


@cache
def characters() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For every code point: 2 for a letter, 1 for a mark (which words may
    hold), else 0; its lower-case form (if one code point); its script's number."""
    import unicodedata

    n = sys.maxunicode + 1
    letter = np.zeros(n, dtype=np.int8)
    low = np.arange(n, dtype=np.uint32)
    for c in range(n):
        if 0xD800 <= c < 0xE000:
            continue
        x = chr(c)
        if x.isalpha():
            letter[c] = 2
            lower = x.lower()
            if len(lower) == 1:
                low[c] = ord(lower)
        elif unicodedata.category(x)[0] == "M":
            letter[c] = 1
    first = np.array([a for a, _ in SCRIPT_RANGES])
    numbers = np.array([SCRIPTS.index(s) for _, s in SCRIPT_RANGES], dtype=np.int8)
    return letter, low, numbers[np.searchsorted(first, np.arange(n), side="right") - 1]


@dataclass
class Scan:
    """Words (runs of letters and marks) of several texts."""

    first: np.ndarray
    size: np.ndarray
    letters: np.ndarray
    script: np.ndarray
    bounds: np.ndarray
    grams: np.ndarray
    gram_bounds: np.ndarray


def scan_words(texts: list[str]) -> Scan:
    """Words, their scripts, and the buckets of their padded letter trigrams:
    a word of n letters has n + 1 of them."""
    letter, low, script = characters()
    joined = "\n".join(texts) + "\n"
    code = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    kind = letter[code]
    mark = kind > 0
    edge = np.diff(np.concatenate(([0], mark.astype(np.int8), [0])))
    first, last = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    ends = np.cumsum(np.fromiter((len(t) + 1 for t in texts), dtype=np.int64, count=len(texts)))
    bounds = np.searchsorted(first, np.concatenate(([0], ends)))
    # letters keep their lower-case code, everything else is the pad 0
    padded = np.zeros(len(code) + 3, dtype=np.uint64)
    padded[2:-1] = np.where(mark, low[code], 0)
    with np.errstate(over="ignore"):
        hashed = mixed((padded[:-2] * U64(0x9E3779B97F4A7C15) + padded[1:-1]) * U64(0xD6E8FEB86659FD93) + padded[2:])
    bucket = (hashed & U64(BUCKETS - 1)).astype(np.int32)
    # hashed[i] covers characters i-2, i-1, i: a word's trigrams end at its letters and one past it
    sizes = last - first
    counts = sizes + 1
    gram_bounds = np.concatenate(([0], np.cumsum(counts)))
    at = np.repeat(first - gram_bounds[:-1], counts) + np.arange(gram_bounds[-1])
    letters = np.concatenate(([0], np.cumsum(kind == 2)))
    return Scan(
        first, sizes, letters[last] - letters[first], script[code[first]], bounds, bucket[at], gram_bounds
    )


def groups_of(texts: list[str], most: int = SCAN_CHARS) -> Iterator[tuple[int, int]]:
    first, size = 0, 0
    for i, t in enumerate(texts):
        if i > first and size + len(t) > most:
            yield first, i
            first, size = i, 0
        size += len(t)
    if first < len(texts):
        yield first, len(texts)


@dataclass
class Model:
    """Languages, log-probabilities by (bucket, language), scripts by (script, language)."""

    langs: list[str]
    logs: np.ndarray
    scripts: np.ndarray
    prior: np.ndarray

    def word_scores(self, s: Scan) -> np.ndarray:
        """By (word, language); languages that don't use a word's script get a
        score below any other, unless none uses it: then all score 0."""
        if not len(s.first):
            return np.zeros((0, len(self.langs)), dtype=np.float32)
        scores = np.add.reduceat(self.logs[s.grams], s.gram_bounds[:-1], axis=0)
        fits = self.scripts[s.script]
        none = ~fits.any(axis=1)
        scores[none] = 0
        scores[~fits & ~none[:, None]] = -1e6
        return scores

    def label(self, s: Scan, penalty: float = PENALTY) -> np.ndarray:
        """Viterbi: a language per word. Texts run side by side, word by word,
        the longest first, so that a step works on those still running."""
        scores = self.word_scores(s)
        out = np.zeros(len(scores), dtype=np.int16)
        if len(self.langs) == 1 or not len(scores):
            return out
        lengths = np.diff(s.bounds)
        order = np.argsort(-lengths, kind="stable")
        order = order[lengths[order] > 0]
        starts, lengths = s.bounds[order], lengths[order]
        running = np.searchsorted(-lengths, -np.arange(lengths[0]), side="left")
        switch = np.zeros(scores.shape, dtype=bool)
        come = np.zeros(len(scores), dtype=np.int16)
        best = scores[starts] + self.prior
        for step in range(1, lengths[0]):
            n = running[step]
            at = starts[:n] + step
            here = best[:n]
            top = here.argmax(axis=1)
            change = here[np.arange(n), top] - penalty
            swap = change[:, None] > here
            come[at] = top
            switch[at] = swap
            best[:n] = np.where(swap, change[:, None], here) + scores[at]
        # backwards: each text begins at its own last word
        label = best.argmax(axis=1).astype(np.int16)
        out[starts + lengths - 1] = label
        for step in range(lengths[0] - 1, 0, -1):
            n = running[step]
            at = starts[:n] + step
            now = out[at]
            out[at - 1] = np.where(switch[at, now], come[at], now)
        return out

    def spans(self, text: str, penalty: float = PENALTY) -> list[tuple[int, int, str]]:
        """(first character, end, language) of the runs of words with one label."""
        s = scan_words([text])
        found = self.label(s, penalty)
        cuts = np.flatnonzero(np.diff(found)) + 1
        edges = np.concatenate(([0], cuts, [len(found)])) if len(found) else np.zeros(1, int)
        return [
            (int(s.first[a]), int(s.first[b - 1] + s.size[b - 1]), self.langs[found[a]])
            for a, b in zip(edges[:-1], edges[1:], strict=True)
        ]

    def predict(self, texts: list[str], penalty: float = PENALTY) -> list[tuple[str, float]]:
        """Language with the most letters and its share of the letters; ``und``
        and 0 without letters (or without a learned language)."""
        out: list[tuple[str, float]] = []
        for a, b in groups_of(texts):
            s = scan_words(texts[a:b])
            if not self.langs:
                out += [("und", 0.0)] * (b - a)
                continue
            found = self.label(s, penalty)
            owner = np.repeat(np.arange(b - a), np.diff(s.bounds))
            letters = np.zeros((b - a, len(self.langs)))
            np.add.at(letters, (owner, found), s.letters)
            total = letters.sum(axis=1)
            top = letters.argmax(axis=1)
            share = letters[np.arange(b - a), top] / np.maximum(total, 1)
            out += [
                (self.langs[k], float(p)) if n else ("und", 0.0) for k, p, n in zip(top, share, total, strict=True)
            ]
        return out


def fold(id_col: str, parts: int) -> Column:
    """A null id counts as the empty text: it is in part 0."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % parts


def counts(sample: DataFrame) -> DataFrame:
    """(lang, kind, bucket, n) of a table (lang, text): trigrams by bucket, and
    letters by script."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[str, str], np.ndarray] = {}
        for batch in batches:
            langs = batch.column(0).to_pylist()
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for a, b in groups_of(texts):
                s = scan_words(texts[a:b])
                owner = np.repeat(np.arange(a, b), np.diff(s.bounds))
                of = np.array([langs[i] for i in owner], dtype=object)
                for lang in set(langs[a:b]):
                    mine = of == lang if len(of) else np.zeros(0, dtype=bool)
                    grams = s.grams[np.repeat(mine, s.size + 1)]
                    for kind, n in (
                        ("gram", np.bincount(grams, minlength=BUCKETS)),
                        ("script", np.bincount(s.script[mine], weights=s.letters[mine], minlength=len(SCRIPTS))),
                    ):
                        sums[lang, kind] = sums.get((lang, kind), 0) + n.astype(np.int64)
        for (lang, kind), n in sums.items():
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(at)), pa.array([kind] * len(at)), pa.array(at.astype(np.int32)), pa.array(n[at])],
                names=["lang", "kind", "bucket", "n"],
            )

    found = sample.select("lang", "text").mapInArrow(scan, "lang string, kind string, bucket int, n long")
    return found.groupBy("lang", "kind", "bucket").agg(F.sum("n").alias("n"))


def train(
    docs: DataFrame, learn: Column, sample: int = SAMPLE, id_col: str = "doc_id", text: str = "text",
    lang: str = "lang",
) -> Model:
    """Fit on about ``sample`` texts per language, chosen by a hash of the id
    among the rows with ``learn`` true and a language. What reaches the driver
    is bounded by languages times trigram buckets."""
    known = docs.where(learn & F.col(lang).isNotNull()).select(
        F.col(lang).alias("lang"), F.col(id_col).alias("doc_id"), F.col(text).alias("text")
    )
    sizes = F.broadcast(known.groupBy("lang").agg(F.count(F.lit(1)).alias("of")))  # a row per language
    share = F.least(F.lit(1.0), F.lit(float(sample)) / F.col("of")) * float(1 << 20)
    taken = known.join(sizes, "lang").where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < share)
    found = counts(taken).toPandas()
    langs = sorted(found["lang"].unique())
    logs = np.zeros((BUCKETS, len(langs)), dtype=np.float32)
    scripts = np.zeros((len(SCRIPTS), len(langs)), dtype=bool)
    for k, name in enumerate(langs):
        mine = found[found["lang"] == name]
        grams = mine[mine["kind"] == "gram"]
        n = np.zeros(BUCKETS)
        n[grams["bucket"].to_numpy()] = grams["n"].to_numpy()
        logs[:, k] = np.log((n + SMOOTHING) / (n.sum() + SMOOTHING * BUCKETS))
        use = mine[mine["kind"] == "script"]
        share = use["n"].to_numpy() / max(1, use["n"].sum())
        scripts[use["bucket"].to_numpy()[share >= SCRIPT_SHARE], k] = True
    return Model(langs, logs, scripts, np.zeros(len(langs), dtype=np.float32))


def identify(
    docs: DataFrame, model: Model, penalty: float = PENALTY, id_col: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per row of ``docs``: doc_id, lang_pred, score, n_spans.

    Score is the share of the text's letters labelled with lang_pred. A text
    that is null or has no letter is ``und`` with score 0. Equal shares go to
    the first language by name. Repeated rows are rows like others; an empty
    table gives no rows; other columns are ignored.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = sent.value
        for batch in batches:
            found = fitted.predict([t or "" for t in batch.column(1).to_pylist()], penalty)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([x for x, _ in found], pa.string()), pa.array([p for _, p in found], pa.float64())],
                names=["doc_id", "lang_pred", "score"],
            )

    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(scan, "doc_id long, lang_pred string, score double")


def label_spans(
    docs: DataFrame, model: Model, penalty: float = PENALTY, id_col: str = "doc_id", text: str = "text"
) -> DataFrame:
    """The language spans: doc_id, first (character), end, lang; none for a
    text without letters."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = sent.value
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            out = [(i, *span) for i, t in zip(ids, texts, strict=True) for span in fitted.spans(t or "", penalty)]
            yield pa.RecordBatch.from_pylist(
                [{"doc_id": i, "first": a, "end": b, "lang": x} for i, a, b, x in out],
                schema=pa.schema([("doc_id", pa.int64()), ("first", pa.int64()), ("end", pa.int64()), ("lang", pa.string())]),
            )

    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(scan, "doc_id long, first long, end long, lang string")


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    part = fold("doc_id", 5)
    found = identify(docs, train(docs, part != 0))
    return found.withColumn("held_out", part == 0)
