"""Phrase collocation mining with broadcast double-array tries.

Words that reach the minimum count get small codes, and texts are written once
as code arrays. Then phrases grow word by word. Frequent phrases go into
double-array tries of bounded size that are sent to every task; numpy walks all
positions of a text piece together, digit by digit, and each leaf reached with
the next word is an occurrence of a longer phrase. That one can only be frequent
if the phrase without its first word is (Apriori: the next position reaches a
leaf too), and if the bucket that its hash falls in is: tasks add up buckets
first, up to the minimum count, and only phrases of full buckets are counted one
by one. Counts of tasks
are summed by phrase, so they are exact, and are scored in SQL functions. There
are as many counting tasks as cores: what they send to be summed goes by the
phrases, not by phrases times splits of the texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rollforge.llm.common import small_batches, table
from rollforge.llm.double_array import DoubleArray, digits_of, spelled
from rollforge.llm.textscan import buffers, lower_ascii, pieces
from rollforge.plans.skew import hash_position
from rollforge.plans.storage import materialize

MIN_COUNT = 100
MAX_WORDS = 5
TOP = 2000
# Phrases in one trie; more are looked up with several tries, one after the other.
TRIE_PHRASES = 1_000_000
# Frequent words sent to every task; more are looked up by shuffle.
SENT_WORDS = 1_000_000
# Buckets that extensions of phrases are hashed to, a byte each for counts below 256, and buckets sent in one row.
BUCKETS = 1 << 24
BUCKET_RUN = 1 << 16
# Extensions that a task counts before it sends them.
HELD = 1 << 20
# Codes in one row of the written texts, and bytes of a long text taken at once.
ROW_CODES = 1 << 18
SLICE = 1 << 20
# Bytes of texts taken from a batch at once.
PART = 4 << 20
UNKNOWN = "und"

LOWER = lower_ascii()
GAP = np.zeros(256, dtype=bool)
GAP[[9, 32, 10, 11, 12, 13, *b".,;:!?"]] = True
BREAK = np.zeros(256, dtype=bool)
BREAK[[10, 11, 12, 13, *b".,;:!?"]] = True


def text_slices(raw: np.ndarray, at: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Bytes, lower-cased, and first bytes of the texts in them. Short texts are
    taken together, long ones in slices that end before a gap; a slice that
    continues a text does not list it as a first byte."""
    for a, b in pieces(at, SLICE):
        piece = raw[at[a]: at[b]]
        if len(piece) <= 2 * SLICE:
            yield LOWER[piece], at[a:b] - at[a]
            continue
        start, firsts = 0, np.zeros(1, dtype=np.int64)  # one long text
        while start < len(piece):
            stop = min(start + SLICE, len(piece))
            while stop < len(piece):
                gaps = np.flatnonzero(GAP[piece[stop: stop + SLICE]])
                if len(gaps):
                    stop += int(gaps[0])
                    break
                stop = min(stop + SLICE, len(piece))
            yield LOWER[piece[start:stop]], firsts
            start, firsts = stop, np.zeros(0, dtype=np.int64)


def words_of(piece: np.ndarray, firsts: np.ndarray) -> tuple[pa.Array, np.ndarray, int]:
    """The words of a slice, for each the number of breaks before it (texts' starts
    included), and the breaks of the slice."""
    inside = np.zeros(len(piece) + 2, dtype=np.int8)
    inside[1:-1] = ~GAP[piece]
    edges = np.diff(inside)
    # words of neighbouring texts do not join: the first byte of a text starts a word
    firsts = firsts[firsts < len(piece)]
    joined = firsts[firsts > 0]
    joined = joined[(inside[joined] & inside[joined + 1]) == 1]
    starts = np.union1d(np.flatnonzero(edges == 1), joined)
    ends = np.union1d(np.flatnonzero(edges == -1), joined)
    breaks = BREAK[piece].astype(np.int32)
    np.add.at(breaks, firsts, 1)
    seen = np.cumsum(breaks)
    offsets = np.zeros(len(starts) + 1, dtype=np.int32)
    np.cumsum(ends - starts, out=offsets[1:])
    data = piece[inside[1:-1].astype(bool)]
    words = pa.Array.from_buffers(pa.string(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
    return words, seen[starts], int(seen[-1]) if len(seen) else 0


def worded(raw: np.ndarray, at: np.ndarray) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """Slice by slice the words of all texts, and whether a break is before each."""
    pending = True
    for piece, firsts in text_slices(raw, at):
        words, seen, breaks = words_of(piece, firsts)
        if len(words):
            gap = np.diff(seen, prepend=0) > 0
            gap[0] |= pending
            pending = breaks > seen[-1]
            yield words, gap
        else:
            pending |= breaks > 0


def by_language(batch: pa.RecordBatch) -> Iterator[tuple[str, np.ndarray, np.ndarray]]:
    """Bytes and offsets of texts of one language (lang, text); a batch is taken in
    parts of about ``PART`` bytes, so that no copy of it all is made."""
    sizes = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False)
    for a, b in pieces(np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)]), PART):
        part = batch.slice(a, b - a)
        for lang in pc.unique(part.column(0)).to_pylist():
            yield lang, *buffers(part.filter(pc.equal(part.column(0), lang)).column(1))


def count_words(docs: DataFrame) -> DataFrame:
    """Occurrences of every word of every language: lang, word, n (partial sums)."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, raw, at in by_language(batch):
                for words, _ in worded(raw, at):
                    coded = words.dictionary_encode()
                    n = np.bincount(coded.indices.to_numpy(zero_copy_only=False), minlength=len(coded.dictionary))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(n), pa.string()), coded.dictionary, pa.array(n.astype(np.int64))],
                        names=["lang", "word", "n"],
                    )

    return docs.mapInArrow(scan, "lang string, word string, n long")


def written(codes: np.ndarray, gap: np.ndarray) -> np.ndarray:
    """Codes with a 0 at each gap; words without code are 0 too, runs of 0 become one."""
    out = np.zeros(len(codes) + int(gap.sum()), dtype=np.int32)
    out[np.arange(len(codes)) + np.cumsum(gap)] = codes
    keep = np.ones(len(out), dtype=bool)
    keep[1:] = (out[1:] > 0) | (out[:-1] > 0)
    return out[keep]


CODE_ROWS = "lang string, codes binary, core int"


def code_rows(lang: str, codes: np.ndarray, overlap: int) -> Iterator[pa.RecordBatch]:
    """Rows of ``core`` codes plus the ``overlap`` codes that a phrase may reach into."""
    for first in range(0, len(codes), ROW_CODES):
        core = min(ROW_CODES, len(codes) - first)
        if core == 1 and codes[first] == 0:
            continue
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang]), pa.array([codes[first: first + core + overlap].tobytes()], pa.binary()),
             pa.array([core], pa.int32())],
            names=["lang", "codes", "core"],
        )


def encode_sent(docs: DataFrame, words: pa.Array, overlap: int) -> DataFrame:
    """Texts as codes; the code of ``words[i]`` is i + 1."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, raw, at in by_language(batch):
                parts = []
                for found, gap in worded(raw, at):
                    coded = found.dictionary_encode()
                    known = pc.fill_null(pc.index_in(coded.dictionary, value_set=words), -1)
                    known = known.to_numpy(zero_copy_only=False).astype(np.int32) + 1
                    parts.append(written(known[coded.indices.to_numpy(zero_copy_only=False)], gap))
                if parts:
                    yield from code_rows(lang, np.concatenate([*parts, np.zeros(1, dtype=np.int32)]), overlap)

    return docs.mapInArrow(scan, CODE_ROWS)


def encode_shuffled(docs: DataFrame, words: DataFrame, overlap: int) -> DataFrame:
    """The same for any number of ``words`` (word, code): each slice sends its
    different words with their places, meets the codes and is put together again."""

    def scatter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, slice_id = TaskContext.get().partitionId() << 40, 0
        for batch in batches:
            for lang, raw, at in by_language(batch):
                whole = list(worded(raw, at))
                if not whole:
                    continue
                found = pa.chunked_array([w for w, _ in whole]).combine_chunks()
                gaps = np.flatnonzero(np.concatenate([gap for _, gap in whole]))
                coded = found.dictionary_encode()
                here = coded.indices.to_numpy(zero_copy_only=False)
                order = np.argsort(here, kind="stable")
                counts = np.bincount(here, minlength=len(coded.dictionary))
                places = [p.astype(np.int64) for p in np.split(order, np.cumsum(counts)[:-1])]
                slice_id += 1
                names = ["slice", "lang", "word", "places", "gaps", "n"]
                n = len(places)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([task + slice_id] * n), pa.array([lang] * n), coded.dictionary,
                     pa.array([p.tobytes() for p in places], pa.binary()), pa.array([None] * n, pa.binary()),
                     pa.array([None] * n, pa.int64())], names=names,
                )
                yield pa.RecordBatch.from_arrays(
                    [pa.array([task + slice_id]), pa.array([lang]), pa.array([None], pa.string()),
                     pa.array([None], pa.binary()), pa.array([gaps.tobytes()], pa.binary()), pa.array([len(here)])],
                    names=names,
                )

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, parts, gaps, n in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                codes = np.zeros(n, dtype=np.int32)
                for part in parts or ():
                    codes[np.frombuffer(part["places"], dtype=np.int64)] = part["code"]
                gap = np.zeros(n, dtype=bool)
                gap[np.frombuffer(gaps, dtype=np.int64)] = True
                yield from code_rows(lang, np.append(written(codes, gap), np.int32(0)), overlap)

    sent = materialize(
        docs.mapInArrow(scatter, "slice long, lang string, word string, places binary, gaps binary, n long"), "word_places"
    )
    coded = sent.where("word is not null").join(words, "word").groupBy("slice").agg(
        F.collect_list(F.struct("places", "code")).alias("parts")  # the words of one slice
    )
    whole = sent.where("word is null").join(coded, "slice", "left").select("lang", "parts", "gaps", "n")
    return whole.mapInArrow(gather, CODE_ROWS)


class Phrases:
    """A double-array trie of phrases (lang, words as codes), with their ids."""

    def __init__(self, rows: pa.Table, length: int, width: int) -> None:
        langs = rows.column("lang").combine_chunks().dictionary_encode()
        words = rows.column("words").combine_chunks().flatten().to_numpy().reshape(-1, length)
        self.ids = rows.column("id").to_numpy()
        self.length, self.width = length, width
        self.lang_width = digits_of(len(langs.dictionary))
        self.langs = {lang: i for i, lang in enumerate(langs.dictionary.to_pylist())}
        parts = [spelled(langs.indices.to_numpy(), self.lang_width)]
        parts += [spelled(words[:, k], width) for k in range(length)]
        self.trie = DoubleArray(np.concatenate(parts, axis=1))

    def found(self, lang: str, codes: np.ndarray, core: int) -> tuple[np.ndarray, np.ndarray]:
        """Places below ``core`` where a phrase starts, and which one."""
        none = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int32)
        if lang not in self.langs:
            return none
        root = np.zeros(1, dtype=np.int32)
        for digit in spelled(np.array([self.langs[lang]]), self.lang_width)[0]:
            root, _ = self.trie.step(root, digit)
        at = np.flatnonzero(codes[:core])
        at = at[at + self.length <= len(codes)]
        state = np.full(len(at), root[0], dtype=np.int32)
        for level in range(self.length):
            for shift in range(8 * (self.width - 1), -1, -8):
                state, inside = self.trie.step(state, (codes[at + level] >> shift) & 255)
                at, state = at[inside], state[inside]
        return at, self.trie.leaf[state]


def each_row(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, np.ndarray, int]]:
    for batch in batches:
        for lang, codes, core in zip(*batch.columns, strict=True):
            yield lang.as_py(), np.frombuffer(codes.as_buffer(), dtype=np.int32), core.as_py()


def bucket_of(ids: np.ndarray, words: np.ndarray, buckets: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) ^ (words.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))
        x = (x ^ (x >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)
    return (x >> np.uint64(20)).astype(np.int64) & (buckets - 1)


def longer(phrases: Phrases, lang: str, codes: np.ndarray, core: int, alone: bool) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the phrases found that a word with a code follows, and that
    word's code. If the trie is ``alone`` (it holds all phrases of its length), the
    phrase that starts one word later has to be found too."""
    at, leaf = phrases.found(lang, codes, core + 1)
    follows = (at < core) & (at + phrases.length < len(codes))
    if alone:
        follows[:-1] &= at[1:] == at[:-1] + 1
        follows[-1:] = False
    at, leaf = at[follows], leaf[follows]
    after = codes[at + phrases.length]
    return leaf[after > 0], after[after > 0]


def added(total: np.ndarray, more: np.ndarray, most: int) -> np.ndarray:
    """``total + more``, or ``most`` where the sum is larger: a sum of such sums
    reaches ``most`` exactly if the sum of the counts does."""
    return np.minimum(total.astype(np.int64) + more, most).astype(total.dtype)


def bucket_sums(texts: DataFrame, phrases: Phrases, buckets: int, alone: bool, min_count: int) -> DataFrame:
    """Occurrences of "phrase plus next word" by bucket, up to ``min_count``: run,
    counts (of its buckets). A task has a row for each run with occurrences."""
    dtype = np.min_scalar_type(min_count)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, dtype=dtype)
        for lang, codes, core in each_row(batches):
            leaf, after = longer(phrases, lang, codes, core, alone)
            found, n = np.unique(bucket_of(phrases.ids[leaf], after, buckets), return_counts=True)
            total[found] = added(total[found], n, min_count)
        for run, first in enumerate(range(0, buckets, BUCKET_RUN)):
            part = total[first: first + BUCKET_RUN]
            if part.any():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([run], pa.int32()), pa.array([part.tobytes()], pa.binary())], names=["run", "counts"]
                )

    return texts.mapInArrow(scan, "run int, counts binary")


def full_buckets(sums: DataFrame, buckets: int, min_count: int) -> np.ndarray:
    """A bit for each bucket (packed), set if the tasks' sums (run, counts) reach ``min_count``."""
    dtype = np.min_scalar_type(min_count)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for run, counts in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                more = np.frombuffer(counts.as_buffer(), dtype=dtype)
                total[run] = added(total[run], more, min_count) if run in total else more.copy()
        for run, counts in total.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([run], pa.int32()), pa.array([np.packbits(counts >= min_count).tobytes()], pa.binary())],
                names=["run", "full"],
            )

    packed = np.zeros(-(-buckets // 8), dtype=np.uint8)
    rows = sums.repartition("run").mapInArrow(scan, "run int, full binary").toArrow()
    for run, full in zip(rows.column("run").to_pylist(), rows.column("full").to_pylist(), strict=True):
        first = run * BUCKET_RUN // 8
        packed[first: first + len(full)] = np.frombuffer(full, dtype=np.uint8)
    return packed


def extensions(texts: DataFrame, phrases: Phrases, full: np.ndarray, alone: bool) -> DataFrame:
    """Occurrences of "phrase plus next word" of ``full`` buckets (packed bits): id,
    code, n (to be summed: one row a task and extension, more beyond ``HELD`` of them)."""
    buckets = 8 * len(full)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        for lang, codes, core in each_row(batches):
            leaf, after = longer(phrases, lang, codes, core, alone)
            bucket = bucket_of(phrases.ids[leaf], after, buckets)
            keep = (full[bucket >> 3] << (bucket & 7)) & 128 > 0
            found, n = np.unique((leaf[keep].astype(np.int64) << 32) | after[keep], return_counts=True)
            both, place = np.unique(np.concatenate([held, found]), return_inverse=True)
            summed = np.zeros(len(both), dtype=np.int64)
            summed[place[: len(held)]] = count
            summed[place[len(held):]] += n
            held, count = both, summed
            if len(held) > HELD:
                yield rows(held, count)
                held, count = held[:0], count[:0]
        yield rows(held, count)

    def rows(held: np.ndarray, count: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(phrases.ids[held >> 32]), pa.array((held & 0xFFFFFFFF).astype(np.int32)), pa.array(count)],
            names=["id", "code", "n"],
        )

    return texts.mapInArrow(scan, "id long, code int, n long")


def tries(phrases: DataFrame, length: int, width: int, limit: int) -> Iterator[Phrases]:
    """The phrases in tries of about ``limit`` each (by id); every one is read to the driver and sent."""
    shards = -(-phrases.count() // limit)
    for shard in range(shards):
        part = phrases.where(F.pmod(F.xxhash64("id"), F.lit(shards)) == shard)
        yield Phrases(part.select("id", "lang", "words").toArrow(), length, width)


def union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def frequent_phrases(
    texts: DataFrame, words: DataFrame, min_count: int, max_words: int, trie_phrases: int, width: int
) -> DataFrame:
    """All phrases of up to ``max_words`` words with ``min_count`` occurrences:
    lang, length, phrase, n. ``words`` has lang, word, code, n."""
    level = materialize(
        words.select(
            F.monotonically_increasing_id().alias("id"), "lang", F.col("word").alias("phrase"), F.array("code").alias("words"), "n"
        ), "frequent_1",
    )
    vocabulary = words.select("lang", F.col("word").alias("last"), "code")
    known = [level]
    texts = texts.coalesce(texts.sparkSession.sparkContext.defaultParallelism)
    for length in range(2, max_words + 1):
        alone = level.count() <= trie_phrases
        sums = [bucket_sums(texts, trie, BUCKETS, alone, min_count) for trie in tries(level, length - 1, width, trie_phrases)]
        if not sums:
            break
        full = full_buckets(union(sums), BUCKETS, min_count)
        counted = [extensions(texts, trie, full, alone) for trie in tries(level, length - 1, width, trie_phrases)]
        counts = union(counted).groupBy("id", "code").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)
        grown = counts.join(level.select("id", "lang", "phrase", "words"), "id").join(vocabulary, ["lang", "code"])
        level = materialize(
            grown.select(
                F.monotonically_increasing_id().alias("id"), "lang", F.concat_ws(" ", "phrase", "last").alias("phrase"),
                F.concat("words", F.array("code")).alias("words"), "n",
            ), f"frequent_{length}",
        )
        known.append(level)
    return union([k.select("lang", F.size("words").alias("length"), "phrase", "n") for k in known])


def scored(found: DataFrame, totals: DataFrame) -> DataFrame:
    """Phrases of two words and more with the cut that scores lowest: lang,
    phrase, length, a, l, r, n, score. Products are decimals of 38 digits
    (a up to 10**15, n up to 10**16), and the division is whole-numbered."""
    whole = found.where("length > 1").join(totals, "lang")
    parts = found.select("lang", "phrase", "n")
    words = F.split("phrase", " ")
    cuts = whole.withColumnRenamed("n", "a").withColumn("k", F.explode(F.expr("sequence(1, length - 1)"))).select(
        "lang", "phrase", "length", "a", "total", "k",
        F.array_join(F.slice(words, F.lit(1), F.col("k")), " ").alias("left"),
        F.array_join(F.slice(words, F.col("k") + 1, F.col("length")), " ").alias("right"),
    )
    cuts = cuts.join(parts.toDF("lang", "left", "l"), ["lang", "left"]).join(parts.toDF("lang", "right", "r"), ["lang", "right"])
    score = F.expr(
        "(cast(1000 as decimal(4)) * (cast(a as decimal(15)) * cast(total as decimal(16))))"
        " div (cast(l as decimal(15)) * cast(r as decimal(15)))"
    )
    lowest = F.min_by(F.struct("l", "r", "score"), F.struct("score", "k")).alias("cut")
    return cuts.withColumn("score", score).groupBy("lang", "phrase", "length", "a", "total").agg(lowest).select(
        "lang", "phrase", "length", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), F.col("total").alias("n"),
        F.col("cut.score").alias("score"),
    )


def contained(found: DataFrame, max_words: int) -> DataFrame:
    """(lang, phrase, most): the largest count among longer phrases that hold the phrase."""
    words = F.split("phrase", " ")
    inner = found.where("length > 2").withColumn("size", F.explode(F.expr("sequence(2, length - 1)")))
    inner = inner.withColumn("first", F.explode(F.expr("sequence(1, length - size + 1)")))
    return inner.select("lang", F.array_join(F.slice(words, F.col("first"), F.col("size")), " ").alias("phrase"), "n").groupBy(
        "lang", "phrase"
    ).agg(F.max("n").alias("most"))


def collocations(
    docs: DataFrame, lang: str = "lang", text: str = "text", min_count: int = MIN_COUNT, max_words: int = MAX_WORDS,
    top: int = TOP, trie_phrases: int = TRIE_PHRASES, sent_words: int = SENT_WORDS,
) -> DataFrame:
    """The ``top`` phrases of each language: lang, rank, phrase, a, l, r, n, score.

    Phrases have 2 to ``max_words`` words, occur ``min_count`` times or more
    (overlaps counted), and do not cross ``.,;:!?`` or line ends; A-Z are
    lower-cased. Null texts are empty, a null language is ``und``, and languages
    without such phrases give no rows; repeated rows count each; other columns
    are ignored. Neither ``trie_phrases`` nor ``sent_words`` changes results:
    beyond them phrases are counted with several tries and words are coded by
    shuffle.
    """
    rows = docs.select(
        F.coalesce(F.col(lang), F.lit(UNKNOWN)).alias("lang"), F.coalesce(F.col(text), F.lit("")).alias("text")
    )
    with small_batches(docs.sparkSession):
        counts = materialize(count_words(rows).groupBy("lang", "word").agg(F.sum("n").alias("n")), "word_counts")
        totals = materialize(counts.groupBy("lang").agg(F.sum("n").alias("total")), "language_totals")
        frequent = counts.where(F.col("n") >= min_count)
        coded = materialize(
            hash_position(frequent.select("word").distinct(), "word", seed=0, name="position")
            .select("word", (F.col("position") + 1).cast("int").alias("code")), "vocabulary",
        )
        n_words = coded.count()
        overlap = max_words
        if n_words <= sent_words:
            sent = coded.orderBy("code").select("word").toArrow().column("word").combine_chunks()
            encoded = encode_sent(rows, sent, overlap)
        else:
            encoded = encode_shuffled(rows, coded, overlap)
        texts = materialize(encoded, "coded_texts")
        found = materialize(
            frequent_phrases(
                texts, frequent.join(coded, "word"), min_count, max_words, trie_phrases, digits_of(n_words)
            ), "frequent_phrases",
        )
    best = scored(found, totals).join(contained(found, max_words), ["lang", "phrase"], "left")
    best = best.where(F.col("most").isNull() | (F.col("most") * 100 < F.col("a") * 100))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return best.withColumn("rank", F.row_number().over(order).cast("bigint")).where(F.col("rank") <= top).select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score"
    )


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


OP11_SQL = r"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[.,;:!?\x0A-\x0D]')) AS piece FROM documents
), w AS (
  SELECT lang, w FROM (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p) WHERE len(w) > 0
), s AS (
  SELECT lang, len(w) AS words, unnest(range(1, len(w) + 1)) AS i, w FROM w
), f AS (
  SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, count(*) AS f
  FROM s, (SELECT unnest(range(1, 6)) AS k) WHERE i + k - 1 <= words GROUP BY ALL
), n AS (
  SELECT lang, sum(f)::HUGEINT AS n FROM f WHERE k = 1 GROUP BY lang
), c AS (
  SELECT lang, k, phrase, string_split(phrase, ' ') AS w, f AS a FROM f WHERE k > 1 AND f >= 100
), cut AS (
  SELECT c.lang, c.phrase, c.k, c.a, h AS cut, l.f AS l, r.f AS r, n.n,
    (1000::HUGEINT * c.a * n.n) // (l.f::HUGEINT * r.f) AS score
  FROM (SELECT *, unnest(range(1, k)) AS h FROM c) c JOIN n USING (lang)
  JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(c.w[1:h], ' ')
  JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(c.w[h + 1:c.k], ' ')
), best AS (
  SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1
), inner_phrases AS (
  SELECT lang, array_to_string(w[i:i + m - 1], ' ') AS phrase, max(a) AS most
  FROM (SELECT *, unnest(range(1, k - m + 2)) AS i FROM (SELECT *, unnest(range(2, k)) AS m FROM c)) GROUP BY ALL
)
SELECT * FROM (
  SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r,
    n::BIGINT AS n, score::BIGINT AS score
  FROM best LEFT JOIN inner_phrases i USING (lang, phrase) WHERE i.most IS NULL OR i.most < a
) WHERE rank <= 2000
"""
