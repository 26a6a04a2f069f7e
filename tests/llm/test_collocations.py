"""Collocations against brute force, and the trie and text slices by themselves."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from rollforge.llm import collocations as co
from rollforge.llm.common import BATCH_BYTES
from rollforge.llm.double_array import DoubleArray, spelled
from rollforge.llm.textscan import buffers

LOWER = {i: i + 32 for i in range(65, 91)}


def brute(docs, min_count, max_words, top):
    n, f = Counter(), defaultdict(Counter)
    for lang, text in docs:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang or "und"] += len(words)
            for k in range(1, max_words + 1):
                f[lang or "und"].update(tuple(words[i:i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, counts in f.items():
        kept = {p: c for p, c in counts.items() if len(p) > 1 and c >= min_count}
        rows = []
        for p, a in kept.items():
            cuts = [(1000 * a * n[lang] // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            inside = any(
                len(q) > len(p) and 100 * c >= 100 * a and any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1))
                for q, c in kept.items()
            )
            if not inside:
                rows.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for rank, (score, a, p, left, right) in enumerate(sorted(rows)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def got(df):
    return sorted(map(tuple, df.collect()))


@pytest.fixture(scope="module")
def docs(data):
    return duckdb.sql(f"SELECT lang, text FROM '{data}/documents.parquet'").fetchall()


@pytest.mark.parametrize(("min_count", "top", "trie_phrases", "sent_words"), [(8, 2000, 10**6, 10**6), (12, 40, 700, 0)])
def test_against_brute_force(spark, docs, min_count, top, trie_phrases, sent_words):
    df = spark.createDataFrame(docs, "lang string, text string").repartition(3)
    found = co.collocations(df, min_count=min_count, top=top, trie_phrases=trie_phrases, sent_words=sent_words)
    assert found.dtypes[0] == ("lang", "string") and {t for _, t in found.dtypes[3:]} == {"bigint"}
    expected = brute(docs, min_count, 5, top)
    assert len(expected) > 50
    assert got(found) == expected


AWKWARD = [
    (None, "a b a b a b. A B"), ("en", None), ("en", ""), ("en", " \t\n"), ("en", "x y\tx y"), ("en", "x y\tx y"),
    ("fr", "é é è é é è"), ("de", "nur. hier! a:b"), (None, "a\x0bb a\x0cb a b"), ("en", "\x00 y \x00 y"),
]


@pytest.mark.parametrize("sent_words", [0, 1000])
def test_awkward_rows(spark, sent_words):
    df = spark.createDataFrame([(*r, "n", 1) for r in AWKWARD], "lang string, text string, word string, id int")
    assert got(co.collocations(df, min_count=2, sent_words=sent_words)) == brute(AWKWARD, 2, 5, 2000)
    assert co.collocations(df.where("false"), min_count=2, sent_words=sent_words).count() == 0


@pytest.mark.parametrize("sent_words", [0, 1000])
def test_a_long_text_is_counted_over_its_slices(spark, sent_words):
    words = [f"w{i % 7}" + ("." if i % 1001 == 0 else "") for i in range(1_700_000)]
    text = " ".join(words)
    assert len(text) > 2 * co.SLICE
    df = spark.createDataFrame([("en", text)], "lang string, text string")
    assert got(co.collocations(df, min_count=1000, sent_words=sent_words)) == brute([("en", text)], 1000, 5, 2000)


def test_slices_keep_words_and_breaks(monkeypatch):
    texts = ["ab cd. ef", "", "gh", "....", "  ij kl" * 9 + "!!!!!!!!!!!!!!!!!!!!!!!!! " + "m" * 50 + " n"] * 3
    raw, at = buffers(pa.array(texts))
    whole = [(w, bool(g)) for words, gap in co.worded(raw, at) for w, g in zip(words.to_pylist(), gap, strict=True)]
    monkeypatch.setattr(co, "SLICE", 8)
    small = [(w, bool(g)) for words, gap in co.worded(raw, at) for w, g in zip(words.to_pylist(), gap, strict=True)]
    assert small == whole
    expected = []
    for text in texts:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            expected += [(w, i == 0) for i, w in enumerate(re.findall(r"[^\x20\x09]+", piece))]
    assert whole == expected


def test_trie_holds_its_rows_and_no_others():
    random = np.random.default_rng(3)
    symbols = np.unique(np.minimum(random.zipf(1.4, (5000, 3)), 70_000), axis=0)
    rows = np.concatenate([spelled(symbols[:, k], 3) for k in range(3)], axis=1)
    trie = DoubleArray(rows[::2])
    state, inside = np.zeros(len(rows), dtype=np.int32), np.ones(len(rows), dtype=bool)
    for k in range(rows.shape[1]):
        to, ok = trie.step(state, rows[:, k])
        inside &= ok
        state = np.where(inside, to, 0).astype(np.int32)
    assert inside[::2].all() and not inside[1::2].any()
    assert (trie.leaf[state[::2]] == np.arange(len(rows[::2]))).all()


def test_counts_sent_go_by_cores_not_by_splits(spark, monkeypatch):
    """200 texts "a b c" in 40 splits: a task and phrase send one row, a task a core."""
    sent, real = [], co.extensions
    monkeypatch.setattr(co, "extensions", lambda *args: sent.append(real(*args)) or sent[-1])
    codes = bytearray(np.array([1, 2, 3, 0], dtype=np.int32).tobytes())
    texts = spark.createDataFrame([("en", codes, 4)] * 200, co.CODE_ROWS).repartition(40)
    words = spark.createDataFrame([("en", w, i + 1, 200) for i, w in enumerate("abc")], "lang string, word string, code int, n long")
    got = {r.phrase: r.n for r in co.frequent_phrases(texts, words, 100, 3, 10, 1).collect()}
    assert got == dict.fromkeys(["a", "b", "c", "a b", "b c", "a b c"], 200)
    cores = spark.sparkContext.defaultParallelism
    assert cores < 40 and [s.count() <= n * cores for s, n in zip(sent, (2, 1), strict=True)] == [True, True]


@pytest.mark.parametrize("min_count", [100, 1000])
def test_bucket_sums_are_one_row_a_run(spark, min_count):
    """Nine tasks each hold a ninth of what makes a bucket full, one bucket just misses it; a task's
    rows go by runs of buckets, not by buckets."""
    buckets, step = 4 * co.BUCKET_RUN, min_count // 10
    phrases = co.Phrases(pa.table({"lang": ["en"], "words": [[1]], "id": [7]}), 1, 1)
    few = np.tile([1, 2, 1, 3], step).astype(np.int32)  # "1 2" and "1 3", a tenth of the count
    rows = [("en", bytearray(np.append(few, 0).astype(np.int32).tobytes()), 4 * step + 1)] * 9
    rows.append(("en", bytearray(np.tile([1, 2], step).astype(np.int32).tobytes()), 2 * step))
    texts = spark.createDataFrame(rows, co.CODE_ROWS).repartition(10)
    sums = co.bucket_sums(texts, phrases, buckets, False, min_count)
    assert sums.count() <= 10 * 4
    full = np.unpackbits(co.full_buckets(sums, buckets, min_count))
    at = co.bucket_of(np.array([7, 7]), np.array([2, 3]), buckets)
    assert len(full) == buckets and np.flatnonzero(full).tolist() == [at[0]]
    counts = {(r.id, r.code): r.n for r in co.extensions(texts, phrases, np.packbits(full), False).groupBy("id", "code").sum("n").toDF("id", "code", "n").collect()}
    assert counts == {(7, 2): min_count}


def test_tasks_get_texts_in_small_batches(spark, monkeypatch):
    """24 MB of codes in one task come a few MB at a time, not as one batch."""
    docs = spark.range(40, numPartitions=1).selectExpr("'en' as lang", "repeat('aa b ', 75000) as text")
    sizes, counted = [], co.bucket_sums

    def seen(texts, *args):
        each = texts.mapInArrow(lambda batches: (pa.record_batch({"n": [b.nbytes]}) for b in batches), "n long")
        sizes.append([r.n for r in each.collect()])
        return counted(texts, *args)

    monkeypatch.setattr(co, "bucket_sums", seen)
    before = spark.conf.get(BATCH_BYTES)
    assert co.collocations(docs, max_words=2).count() == 2
    assert sum(sizes[0]) > 20 << 20 and max(sizes[0]) < 8 << 20 and spark.conf.get(BATCH_BYTES) == before


def test_products_beyond_64_bits(spark):
    big = 10**14
    found = spark.createDataFrame(
        [("en", 1, "a", 9 * big), ("en", 1, "b", 7 * big), ("en", 2, "a b", 3 * big)], "lang string, length int, phrase string, n long"
    )
    totals = spark.createDataFrame([("en", 20 * big)], "lang string, total long")
    row = co.scored(found, totals).first()
    assert row["score"] == 1000 * 3 * big * 20 * big // (9 * big * 7 * big)
