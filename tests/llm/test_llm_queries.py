"""Every query of the package: against its SQL where it has one, else against
a brute-force version on small tables."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from rollforge.llm import catalog, decontam, jaccard_join, language_id, mixing, sharding, suffix_dedup, token_counts
from rollforge.llm import toxicity, url_filter
from rollforge.llm.exact_dedup import DigestIndex, dedup, dedup_in_batches
from rollforge.plans.storage import scratch_path

NATIVE = ("op4_sharding", "op8_url_filter", "op10_mixing")
AWKWARD = [
    (1, "same words here and there again"), (2, "same words here and there again"), (2, "same words here and there again"),
    (3, None), (4, ""), (5, "   \n"), (None, "a null id, some words in a row"), (6, "x" * 5000), (7, "x" * 5000),
    (8, "one"), (9, "One two three"), (10, "été Ünï words 中文 ▁ mark"), (11, "same words here and there again now"),
    (12, "ab" * 900 + " tail"), (13, "\x00\t odd \r\x0b\x0c bytes é"),
]


@pytest.fixture(scope="module")
def awkward(spark):
    rows = [(i, t, "en" if k % 2 else None, None if k % 3 else "s1", 7, "clash") for k, (i, t) in enumerate(AWKWARD)]
    return spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long, position string"
    )


@pytest.fixture(scope="module")
def empty(awkward):
    return awkward.where("false")


@pytest.fixture(scope="module")
def rows(data):
    return duckdb.sql(f"SELECT doc_id, text FROM '{data}/documents.parquet'").fetchall()


def by_id(df, *columns):
    out = defaultdict(list)
    for r in df.select("doc_id", *columns).collect():
        out[r[0]].append(tuple(r[1:]))
    return {k: sorted(v, key=repr) for k, v in out.items()}


def grouped(pairs):
    out = defaultdict(list)
    for i, *rest in pairs:
        out[i].append(tuple(rest))
    return {k: sorted(v, key=repr) for k, v in out.items()}


@pytest.mark.parametrize("name", sorted(catalog.CHECKS))
def test_against_sql(spark, data, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "labels", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{data}/{t}.parquet'")
    cursor = con.execute(catalog.CHECKS[name])
    names = [d[0] for d in cursor.description]
    df = catalog.QUERIES[name](spark, data)
    assert sorted(df.columns) == sorted(names)
    assert sorted(map(repr, map(tuple, df.select(*names).collect()))) == sorted(map(repr, cursor.fetchall()))


@pytest.mark.parametrize("name", NATIVE)
def test_native_plans_have_no_python(spark, data, name):
    plan = catalog.QUERIES[name](spark, data)._jdf.queryExecution().executedPlan().toString()
    for node in ("Python", "Pandas", "Arrow", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in plan


def test_no_unbounded_joins(spark, data):
    for name, query in catalog.QUERIES.items():
        plan = query(spark, data)._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name


# 1

def brute_repeats(pairs, length):
    count = Counter()
    for _, t in pairs:
        b = (t or "").encode()
        count.update(b[i: i + length] for i in range(len(b) - length + 1))
    out = []
    for i, t in pairs:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for s in range(len(b) - length + 1):
            if count[b[s: s + length]] > 1:
                gone[s: s + length] = b"\x01" * length
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        runs = len(re.findall(rb"\x01+", bytes(gone)))
        out.append((i, len(b), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return grouped(out)


COLUMNS1 = ("n_bytes", "n_removed", "n_spans", "kept_sha256")


def test_repeats_of_the_query(spark, data, rows):
    assert by_id(catalog.QUERIES["op1_suffix_dedup"](spark, data), *COLUMNS1) == brute_repeats(rows, 400)


@pytest.mark.parametrize(("length", "cluster"), [(1, 100), (7, 100), (12, 1), (40, 2)])
def test_repeats_of_awkward_texts(spark, awkward, length, cluster):
    got = suffix_dedup.remove_repeats(awkward, length, cluster=cluster)
    assert by_id(got, *COLUMNS1) == brute_repeats(AWKWARD, length)


def test_repeats_in_long_texts(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "PIECE", 300)
    texts = [(1, "".join(chr(97 + (i * i // 7) % 23) for i in range(2000))), (2, "begin " + "".join(
        chr(97 + (i * i // 7) % 23) for i in range(100, 900)) + " end"), (3, "short")]
    raw = [t.encode() for _, t in texts]
    at = [0, *[sum(map(len, raw[: i + 1])) for i in range(3)]]
    import numpy as np

    parts = list(suffix_dedup.parts_of(np.array(at), 12))
    assert len(parts) > 3 and max(e - s for *_, s, e in parts) <= 2 * 300 + 12
    df = spark.createDataFrame(texts, "doc_id long, text string")
    assert by_id(suffix_dedup.remove_repeats(df, 12), *COLUMNS1) == brute_repeats(texts, 12)


def test_rows_without_ids_that_repeat_share_one_list(spark):
    body = "".join(chr(97 + (i * i // 7) % 23) for i in range(300))
    df = spark.range(20_000).selectExpr("cast(null as long) as doc_id", f"'{body}' as text")
    got = suffix_dedup.remove_repeats(df, 100)
    assert got.count() == 20_000
    assert got.where("n_removed <> 300 or n_spans <> 1 or size(spans) <> 1").count() == 0


def test_repeats_of_nothing(empty):
    assert suffix_dedup.remove_repeats(empty, 5).count() == 0


def test_loser_tree_merges_front_coded_runs():
    import random

    rng = random.Random(3)
    words = sorted("".join(rng.choice("ab") for _ in range(rng.randint(0, 12))).encode() for _ in range(300))
    runs = [[] for _ in range(5)]
    for w in words:
        runs[rng.randrange(5)].append(w)

    def coded(run):
        before = b""
        for w in run:
            k = suffix_dedup.shared(before, w)
            yield k, w[k:], (w,)
            before = w

    before, got = b"", []
    for known, suffix, (w,) in suffix_dedup.LoserTree([coded(r) for r in runs]):
        assert suffix == w and known == suffix_dedup.shared(before, suffix)
        before = suffix
        got.append(suffix)
    assert got == words


# 2

def test_language_of_held_out_rows(spark, data):
    found = catalog.QUERIES["op2_language_id"](spark, data).collect()
    langs = dict(duckdb.sql(f"SELECT doc_id, lang FROM '{data}/documents.parquet'").fetchall())
    held = [r for r in found if r.held_out]
    assert len(found) == len(langs)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in found)
    assert sum(r.lang_pred == langs[r.doc_id] for r in held) >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 for r in found)


def test_language_spans_and_edges(spark, data, awkward, empty):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    model = language_id.train(docs, language_id.fold("doc_id", 5) != 0)
    de = docs.where("lang = 'de'").first().text[:300]
    en = docs.where("lang = 'en'").first().text[:300]
    spans = model.spans(f"{en}\n{de}")
    assert [s[2] for s in spans] == ["en", "de"] and abs(spans[1][0] - len(en)) < 40
    found = by_id(language_id.identify(awkward, model), "lang_pred", "score")
    for i in (3, 4, 5):
        assert found[i] == [("und", 0.0)]
    assert found[10][0][0] in model.langs and sum(map(len, found.values())) == len(AWKWARD)
    assert language_id.identify(empty, model).count() == 0
    assert language_id.label_spans(awkward.where("doc_id = 4"), model).count() == 0
    none = language_id.train(empty, language_id.fold("doc_id", 5) != 0)
    assert {x for v in by_id(language_id.identify(awkward, none), "lang_pred").values() for x in v} == {("und",)}


def test_viterbi_is_exact():
    import itertools

    import numpy as np

    rng = np.random.default_rng(1)
    for _ in range(20):
        n, k = int(rng.integers(1, 6)), 3
        scores = rng.normal(0, 3, (n, k)).astype(np.float32)
        model = language_id.Model(list("abc"), np.zeros((1, k)), np.ones((1, k), bool), np.zeros(k, np.float32))
        model.word_scores = lambda s, scores=scores: scores
        scan = language_id.Scan(None, None, None, None, np.array([0, n]), None, None)
        got = model.label(scan, 2.0)

        def value(path):
            return sum(scores[i, p] for i, p in enumerate(path)) - 2.0 * sum(a != b for a, b in itertools.pairwise(path))

        best = max(map(value, itertools.product(range(k), repeat=n)))
        assert abs(value(list(got)) - best) < 1e-4


def test_script_narrows_candidates():
    import numpy as np

    scripts = np.zeros((len(language_id.SCRIPTS), 2), dtype=bool)
    scripts[language_id.SCRIPTS.index("latin"), 0] = scripts[language_id.SCRIPTS.index("cyrillic"), 1] = True
    model = language_id.Model(["aa", "bb"], np.zeros((language_id.BUCKETS, 2), np.float32), scripts, np.zeros(2, np.float32))
    assert [s[2] for s in model.spans("hello world привет мир")] == ["aa", "bb"]


# 3

def test_exact_dedup_of_awkward_rows(awkward, empty, spark):
    index = DigestIndex(spark, scratch_path(spark, "index"), 4)
    got = dedup(awkward, index, "one")
    groups = defaultdict(list)
    for i, t in AWKWARD:
        groups[t or ""].append(i)
    assert got.count() == len(AWKWARD)
    for r in got.collect():
        members = next(v for t, v in groups.items() if hashlib.sha256(t.encode()).hexdigest() == r.text_sha256)
        assert r.group_size == len(members) and r.keep_id == max((m for m in members if m is not None), default=None)
    assert got.where("kept").count() == len(groups)
    assert dedup(empty, index, "two").count() == 0


def test_digest_index_persists(spark):
    path = scratch_path(spark, "index")
    one = spark.createDataFrame([(1, "a"), (2, "b"), (3, "a")], "doc_id long, text string")
    two = spark.createDataFrame([(9, "a"), (7, "c"), (8, "c")], "doc_id long, text string")
    assert by_id(dedup(one, DigestIndex(spark, path, 4), "one"), "keep_id", "kept") == {1: [(3, False)], 2: [(2, True)], 3: [(3, True)]}
    again = DigestIndex(spark, path, 4)
    want = {9: [(3, False)], 7: [(8, False)], 8: [(8, True)]}
    assert by_id(dedup(two, again, "two"), "keep_id", "kept") == want
    assert by_id(dedup(two, again, "two"), "keep_id", "kept") == want  # the same batch after a lost run
    assert by_id(dedup(two, again, "three"), "kept") == {9: [(False,)], 7: [(False,)], 8: [(False,)]}
    assert again.read().count() == 3
    again.close()
    assert not spark.catalog.tableExists(again.name)
    assert DigestIndex(spark, path, 4).read().count() == 3


@pytest.mark.parametrize("batches", [1, 3])
def test_batches_of_falling_ids_give_the_whole_answer(spark, awkward, empty, batches):
    whole = dedup(awkward, DigestIndex(spark, scratch_path(spark, "index"), 4), "all")
    got = dedup_in_batches(awkward, DigestIndex(spark, scratch_path(spark, "index"), 4), batches)
    columns = ("keep_id", "group_size", "kept", "text_sha256")
    assert by_id(got, *columns) == by_id(whole, *columns)
    assert dedup_in_batches(empty, DigestIndex(spark, scratch_path(spark, "index"), 4), batches).count() == 0
    unnamed = awkward.withColumn("doc_id", awkward.doc_id * None)
    got = dedup_in_batches(unnamed, DigestIndex(spark, scratch_path(spark, "index"), 4), batches)
    assert got.count() == len(AWKWARD) and got.where("kept").count() == len({t or "" for _, t in AWKWARD})


def test_anti_join_does_not_shuffle_the_index(spark):
    index = DigestIndex(spark, scratch_path(spark, "index"), 4)
    index.append(spark.createDataFrame([(bytes([i]) * 32, i) for i in range(20)], "digest binary, keep_id long"), "one")
    asked = spark.createDataFrame([(bytes([3]) * 32,), (bytes([30]) * 32,)], "digest binary")
    plan = index.unseen(asked.groupBy("digest").count())
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in text and text.count("Exchange hashpartitioning") <= 1
    assert plan.count() == 1


# 4

def test_shards(spark, data, rows, awkward, empty):
    got = catalog.QUERIES["op4_sharding"](spark, data).collect()
    want = {i: (len(t.encode()) + 1, zlib.crc32(t.encode())) for i, t in rows}
    assert {r.doc_id: (r["size"], r.text_crc32) for r in got} == want
    sizes = Counter(r.shard for r in got)
    assert set(sizes) == set(range(8)) and max(sizes.values()) - min(sizes.values()) <= 1
    for s, n in sizes.items():
        assert sorted(r.slot for r in got if r.shard == s) == list(range(n))
    order = [r.doc_id for r in sorted(got, key=lambda r: (r.shard, r.slot))]
    assert order != sorted(order)
    odd = sharding.assign(awkward, bucket_rows=3).collect()
    assert Counter(r.doc_id for r in odd) == Counter(i for i, _ in AWKWARD)
    assert sorted((r.shard, r.slot) for r in odd) == sorted(set((r.shard, r.slot) for r in odd))
    assert {(r["size"], r.text_crc32) for r in odd if r.doc_id in (3, 4)} == {(1, 0)}
    assert sharding.assign(empty).count() == 0


def test_shards_do_not_depend_on_partitions(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    columns = ("shard", "slot")
    assert by_id(sharding.assign(docs), *columns) == by_id(sharding.assign(docs.repartition(7)), *columns)
    assert by_id(sharding.assign(docs, seed=1), *columns) != by_id(sharding.assign(docs), *columns)


def test_fisher_yates_permutes(spark):
    from pyspark.sql import functions as F

    df = spark.range(200).select(sharding.fisher_yates((F.col("id") % 9 + 1).cast("int"), F.col("id"), 1).alias("p"))
    found = [r.p for r in df.collect()]
    assert all(sorted(p) == list(range(len(p))) for p in found) and len({tuple(p) for p in found}) > 60


def test_write_shards_round_trip(spark, awkward, tmp_path):
    sharding.write_shards(awkward, str(tmp_path / "out"), shards=3)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert {r[0] for r in back.select("shard").distinct().collect()} == {0, 1, 2}
    got = back.select(*awkward.columns).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, map(tuple, awkward.collect())))


def test_short_and_long_records_are_written(spark, tmp_path):
    df = spark.range(60_000).selectExpr("id as doc_id", "if(id % 20000 = 7, repeat('long ', 400000), 'x') as text")
    sharding.write_shards(df, str(tmp_path / "out"), shards=4)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == 60_000 and back.select("doc_id").distinct().count() == 60_000
    assert {r["count"] for r in back.groupBy("shard").count().collect()} == {15_000}
    assert back.where("length(text) = 2000000").count() == 3


def test_hot_repeated_row_is_spread(spark):
    df = spark.range(9000).selectExpr("if(id % 3 = 0, 1, id) as doc_id", "if(id % 3 = 0, 'hot', 'x') as text")
    got = sharding.assign(df)
    per = {r.shard: r.n for r in got.where("doc_id = 1 and text_crc32 = crc32('hot')").groupBy("shard").agg({"*": "count"}).toDF("shard", "n").collect()}
    assert sum(per.values()) == 3000 and max(per.values()) < 600


# 5

def test_toxicity_of_held_out_rows(spark, data):
    found = catalog.QUERIES["op5_toxicity"](spark, data).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in found)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in found)


def test_toxicity_learns(spark, awkward, empty):
    import random

    rng = random.Random(1)

    def text(bad):
        words = [rng.choice("lorem ipsum dolor sit amet elit sed do magna you".split()) for _ in range(60)]
        if bad:
            for _ in range(4):
                words[rng.randrange(60)] = "grubbl" + rng.choice("aeiou") + rng.choice("xyz")
        return " ".join(words)

    rows = [(i, text(i % 5 == 0), int(i % 5 == 0)) for i in range(500)]
    both = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.train(both.select("doc_id", "text"), both.select("doc_id", "toxic"), ~toxicity.held_out())
    assert any("grubb".startswith(s) for s in model.lexicon.stems)
    got = by_id(toxicity.score(both, model), "predicted")
    held = [i for i, *_ in rows if zlib.crc32(str(i).encode()) % 4 == 2]
    assert sum(got[i] == [(int(i % 5 == 0),)] for i in held) >= 0.98 * len(held)
    odd = toxicity.score(awkward, model)
    assert odd.count() == len(AWKWARD) and odd.where("score is null or score < 0 or score > 1").count() == 0
    assert toxicity.score(empty, model).count() == 0
    none = toxicity.train(both.select("doc_id", "text"), both.where("false").select("doc_id", "toxic"), ~toxicity.held_out())
    assert {x for v in by_id(toxicity.score(awkward, none), "score").values() for x in v} == {(0.0,)}


def test_features_see_disguise_and_address():
    plain = toxicity.Lexicon({})
    at = toxicity.FEATURES.index
    assert toxicity.features("you are an idiot", plain)[at("abuse_near_you")] > 0
    assert toxicity.features("what an 1d1ot or st*pid thing", plain)[at("masked")] > 0
    assert len(toxicity.features("", plain)) == len(toxicity.FEATURES) == len(toxicity.features("a", plain))


# 6

def test_contamination_by_shuffle_agrees(spark, data):
    docs, items = (spark.read.parquet(f"{data}/{t}.parquet") for t in ("documents", "benchmark"))
    sent = decontam.contamination(docs, items)
    moved = decontam.contamination(docs, items, sent_fingerprints=0, sent_windows=0)
    columns = [c for c in sent.columns if c != "doc_id"]
    assert by_id(sent, *columns) == by_id(moved, *columns)


@pytest.mark.parametrize("sent", [1000, 0])
def test_contamination_of_short_items_and_awkward_rows(spark, awkward, empty, sent):
    items = spark.createDataFrame(
        [("i1", "words here and"), ("i2", None), ("i3", "..."), ("i4", "ONE"), ("i5", "again"), (None, "two three"),
         ("i6", "a b c d e f g h i j k l"), ("i1", "words here and")], "item_id string, text string",
    )
    docs = awkward.unionByName(spark.createDataFrame(
        [(20, "z a b c d e f g h i j, K l a b c", None, None, 0, "")], awkward.schema))
    got = by_id(decontam.contamination(docs, items, sent_fingerprints=sent), "n_words", "n_hit", "n_items", "contaminated")
    assert got[1] == [(6, 4, 2, True)] and got[2] == [(6, 4, 2, True)] * 2
    assert got[3] == got[4] == got[5] == [(0, 0, 0, False)]
    assert got[8] == [(1, 1, 1, True)] and got[9] == [(3, 3, 2, True)]
    assert got[20] == [(16, 12, 1, True)]
    assert decontam.contamination(empty, items, sent_fingerprints=sent).count() == 0
    none = decontam.contamination(awkward, items.where("false"), sent_fingerprints=sent)
    assert none.where("contaminated or n_hit > 0").count() == 0 and none.count() == len(AWKWARD)


# 7

def brute_components(pairs, words=5, percent=75):
    strip = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})
    sets = []
    for _, t in pairs:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(strip))
        sets.append({tuple(w[k: k + words]) for k in range(max(1, len(w) - words + 1))} if w else set())
    parent = list(range(len(pairs)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    lists = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            lists[x].append(i)
    for i, s in enumerate(sets):
        common = Counter(j for x in s for j in lists[x] if j < i)
        for j, n in common.items():
            if 100 * n >= percent * (len(s) + len(sets[j]) - n):
                parent[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(pairs):
        if d is not None:
            least[root(i)] = min(d, least.get(root(i), d))
    return grouped((d, len(sets[i]), least.get(root(i)) if sets[i] else d) for i, (d, _) in enumerate(pairs))


def test_components_of_the_query(spark, data, rows):
    got = catalog.QUERIES["op7_jaccard_join"](spark, data)
    assert by_id(got, "n_shingles", "component_id") == brute_components(rows)


@pytest.mark.parametrize("list_part", [4000, 3])
def test_components_of_near_copies(spark, list_part, monkeypatch):
    """Chains of near copies, shared passages and frequent shingles, in lists split into parts."""
    import random

    monkeypatch.setattr(jaccard_join, "SENT_KEYS", 0)
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(300)]
    passage = [rng.choice(vocabulary) for _ in range(60)]
    pairs, i = [], 0
    for _ in range(12):
        words = [rng.choice(vocabulary) for _ in range(rng.randint(4, 120))]
        for _ in range(rng.randint(1, 9)):
            words = words.copy()
            if rng.random() < 0.8:
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
            if rng.random() < 0.2:
                words += passage
            pairs.append((i, " ".join(words)))
            i += 1
    pairs += AWKWARD
    df = spark.createDataFrame(pairs, "doc_id long, text string")
    got = jaccard_join.link_components(df, list_part=list_part)
    assert by_id(got, "n_shingles", "component_id") == brute_components(pairs)


@pytest.mark.parametrize("part", [256, 3])
def test_every_link_is_counted(spark, part, monkeypatch):
    """Links of each set with others, against brute force: a group of mutual links, chains, sets of many sizes."""
    import random

    monkeypatch.setattr(jaccard_join, "COMPONENT_PART", part)
    monkeypatch.setattr(jaccard_join, "CHUNK_COLUMNS", 16)
    rng = random.Random(8)
    vocabulary = [f"w{i}" for i in range(500)]
    texts = []
    for k in range(8):
        words = [rng.choice(vocabulary) for _ in range((150, 40, 12)[k % 3])]
        for _ in range((30, 12)[k % 2]):
            copy = words.copy()
            copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            texts.append(" ".join(copy + [rng.choice(vocabulary) for _ in range(rng.randint(0, 2))]))
            if k % 2:
                words = copy + [rng.choice(vocabulary) for _ in range(rng.randint(0, 9))]
    texts += [texts[0], texts[0].upper(), "", None, "alone here"]
    sets = []
    for t in texts:
        w = (t or "").lower().split()
        sets.append(frozenset(tuple(w[k: k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset())
    want = [sum(4 * len(s & o) >= 3 * len(s | o) for o in set(sets) - {s} if s and o) for s in sets]
    assert max(want) >= 29
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.n_links for r in jaccard_join.link_components(df).collect()}
    assert got == dict(enumerate(want))


@pytest.mark.parametrize("block", [1, 2])
def test_skipped_blocks_hold_no_link(spark, block, monkeypatch):
    """Sets and supersets whose further shingles are rarer, so that the common one stands later: J is 0.8."""
    import numpy as np

    monkeypatch.setattr(jaccard_join, "SKIP_BLOCK", block)
    rng = np.random.default_rng(1)
    rows, want = [], set()
    for k in range(4):
        y = rng.integers(0, 2**63, 80).astype(np.uint64)
        for j, (value, pos) in enumerate([(y, 0), (np.concatenate([y, rng.integers(0, 2**63, 20).astype(np.uint64)]), 20)]):
            narrow, _ = jaccard_join.bitmaps(np.array([0, len(value)]), value)
            sid = 10 * k + j
            rows.append((0, 7, 0, 0, 0, sid, sid, len(value), pos, narrow[0].as_py()))
        want.add((10 * k, 10 * k + 1))
    lists = spark.createDataFrame(
        sorted(rows, key=lambda r: (r[7], r[5])),
        "place long, token long, part int, other int, own int, sid long, label long, size int, pos int, bitmap binary",
    ).coalesce(1)
    got = {(r.a, r.b) for r in jaccard_join.cross_pairs(lists, jaccard_join.PERCENT, every=True).collect()}
    assert want <= got


@pytest.mark.parametrize("every", [False, True])
def test_large_sets_that_share_one_shingle_are_no_candidates(spark, every):
    """Bitmaps of fixed size are full for large sets and let all of their pairs through."""
    import numpy as np

    rng = np.random.default_rng(2)
    sets, rows = [], []
    for sid in range(12):
        value = np.sort(rng.integers(0, 2**63, 5000).astype(np.uint64))
        if sid == 11:  # a near copy of the one before
            value = np.sort(np.concatenate([last[200:], value[:200]]))
        _, wide = jaccard_join.bitmaps(np.array([0, len(value)]), value)
        sets.append((sid, wide[0].as_py()))
        rows += [(3, token, 0, 0, 0, sid, sid, len(value), 0) for token in (7, 8)]
        last = value
    lists = spark.createDataFrame(
        rows, "place long, token long, part int, other int, own int, sid long, label long, size int, pos int"
    )
    bitmaps = spark.createDataFrame(sets, "sid long, bitmap binary")
    got = jaccard_join.cross_pairs(lists, jaccard_join.PERCENT, every, bitmaps).collect()
    assert [(r.a, r.b) for r in got] == [(10, 11)]


def test_components_of_nothing(empty):
    assert jaccard_join.link_components(empty).count() == 0


def test_next_pairs_of_all_lists_are_compared_once(monkeypatch):
    """Forty lists hold the same sets, others parts of them: pairs are those of list by list, bitmaps meet once."""
    random = np.random.default_rng(7)
    base = random.integers(0, 1 << 63, 400, dtype=np.uint64)
    values = [np.sort(np.append(base[: 300 + i], random.integers(0, 1 << 63, 2 + 9 * (i % 5), dtype=np.uint64))) for i in range(30)]
    size = np.array([len(v) for v in values])
    by = np.argsort(size, kind="stable")
    values, size = [values[i] for i in by], size[by]
    wide = [jaccard_join.bitmaps(np.array([0, len(v)]), v)[1][0].as_py() for v in values]
    bits, label = jaccard_join.Bits(wide, size, 75), random.integers(0, 6, 30)
    lists = [np.arange(30)] * 40 + [np.flatnonzero(random.random(30) < 0.5) for _ in range(20)]

    def one(mine):
        for i, x in enumerate(mine):
            for y in mine[i + 1: i + 1 + jaccard_join.NEXT]:
                a, b = np.array([x]), np.array([y])
                if label[x] != label[y] and bits.may_link(a, b)[0] and bits.still_may(a, b)[0]:
                    yield int(x), int(y)
                    break

    expected = {pair for mine in lists for pair in one(mine)}
    compared, real = [], jaccard_join.Bits.may_link
    monkeypatch.setattr(jaccard_join.Bits, "may_link", lambda self, x, y: compared.append(len(x)) or real(self, x, y))
    ends = np.cumsum([len(mine) for mine in lists])
    got = jaccard_join.next_pairs(np.concatenate(lists), np.repeat(ends, np.diff(ends, prepend=0)), label, bits)
    assert {(a, b) for a, b in got.T.tolist()} == expected and len(expected) == got.shape[1] > 20
    assert len(compared) <= jaccard_join.NEXT and sum(compared) < 30 * 29


def test_shingles_are_sorted_by_text_short_texts_between_long_ones():
    texts = ["b a", "e d c b a f g e d c b a", "", "x", "a b c d e f g h i", "a b c d e"]
    raw, at = jaccard_join.buffers(pa.array(texts))
    text, value = jaccard_join.shingles(raw, at)
    assert text.tolist() == [0] + [1] * 7 + [3] + [4] * 5 + [5]
    for i, t in enumerate(texts):
        alone = np.frombuffer(t.encode(), dtype=np.uint8)
        mine = value[text == i].tolist()
        assert mine == sorted(set(mine)) == jaccard_join.shingles(alone, np.array([0, len(alone)]))[1].tolist()


# 8

def test_verdicts(spark, data, empty):
    got = catalog.QUERIES["op8_url_filter"](spark, data).collect()
    urls = dict(duckdb.sql(f"SELECT page_id, url FROM '{data}/pages.parquet'").fetchall())
    assert len(got) == len(urls)
    for r in got:
        host, path = re.match(r"(?:.*?)://([^/?#]*)([^?#]*)", urls[r.page_id]).groups()
        assert (r.host, r.path) == (host.lower(), path)
        fits = [x for x in url_filter.RULES if (r.host == x.host or r.host.endswith("." + x.host)) and path.startswith(x.path)]
        best = max(fits, key=lambda x: len(x.name), default=None)
        assert r.rule == (best.name if best else None)
        if best:
            assert r.verdict == ("allow" if best.allow else "block")
    pages = spark.createDataFrame(
        [(1, None), (2, "no scheme"), (3, "http://"), (4, "HTTP://WWW.Example.COM?x=/en/"), (5, "x://a@b.co.uk:80/p#q"),
         (5, "x://a@b.co.uk:80/p#q"), (None, "http://10.0.0.1/a")], "page_id long, url string")
    odd = grouped(tuple(r) for r in url_filter.judge(pages).select("page_id", "host", "path", "rule", "verdict").collect())
    assert odd[1] == odd[2] == odd[3] == [("", "", None, "allow")]
    assert odd[4] == [("www.example.com", "", None, "allow")] and odd[5] == [("a@b.co.uk:80", "/p", None, "allow")] * 2
    assert url_filter.judge(pages.where("false")).count() == 0


def test_reputation_shrinks(spark):
    rows = [(f"h{i}.bad.org", 40, 38) for i in range(6)] + [(f"h{i}.good.org", 40, 1) for i in range(6)]
    rows += [("new.bad.org", 0, 0), ("new.good.org", 0, 0), ("one.good.org", 1, 1), ("lone.xyz", 0, 0)]
    hosts = spark.createDataFrame([(h, n, float(b)) for h, n, b in rows], "host string, n long, bad double")
    got = {r.host: r for r in url_filter.reputation(hosts).collect()}
    assert got["new.bad.org"].rate > 0.8 and got["new.good.org"].rate < 0.2
    assert got["new.bad.org"].low < got["h0.bad.org"].low and got["one.good.org"].rate < 0.5
    assert got["h0.bad.org"].blocked and not got["lone.xyz"].blocked and not got["one.good.org"].blocked


# 9

def test_token_counts(spark, data, rows, awkward, empty):
    import public_tokenizers
    import sentencepiece

    path = public_tokenizers.path(token_counts.MODEL)
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    got = by_id(catalog.QUERIES["op9_token_counts"](spark, data), "n_bytes", "n_tokens", "over_limit")
    assert got == grouped((i, len(t.encode()), n := len(model.encode(t)), n > 4096) for i, t in rows)
    odd = by_id(token_counts.count_tokens(awkward, path), "n_tokens")
    assert odd == grouped((i, len(model.encode(t or ""))) for i, t in AWKWARD)
    assert token_counts.count_tokens(empty, path).count() == 0


def test_shortcut_agrees_with_the_library():
    import random

    import public_tokenizers

    counter = token_counts.Counter(public_tokenizers.path(token_counts.MODEL))
    assert counter.splits and counter.fine is token_counts.FINE and len(counter.whole) > 10_000
    rng = random.Random(2)
    parts = [" ", "  ", "a", "the", "▁", "\n", "\r\n", "\t", "é", "ﬁ", "<s>", "</s>", "<unk>", "<0x0A>", "中", "😀", "\xa0", ".", ", ",
             "!”", "»,", "²", "_", "'s", "1", "23", "\x00", "ll", "();", " x"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 14))) for _ in range(4000)]
    assert counter.count(texts) == [len(i) for i in counter.model.encode(texts)]


# 10

def test_mix(spark, data):
    got = catalog.QUERIES["op10_mixing"](spark, data).collect()
    docs = duckdb.sql(f"SELECT doc_id, text, source FROM '{data}/documents.parquet'").fetchall()
    size = {i: len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t, _ in docs}
    source = {i: s for i, _, s in docs}
    sums = Counter()
    for i, n in size.items():
        sums[source[i]] += n
    goal = want_targets(sums)
    taken = Counter()
    for r in got:
        assert r["size"] == size[r.doc_id] and r.source_size == sums[source[r.doc_id]]
        assert r.target == pytest.approx(goal[source[r.doc_id]], rel=1e-9) and 0 <= r.taken <= 2 * r["size"]
        taken[source[r.doc_id]] += r.taken
    for s, t in goal.items():
        assert abs(taken[s] - t) <= 0.01 * t + 2
    assert sorted(map(tuple, got)) == sorted(map(tuple, catalog.QUERIES["op10_mixing"](spark, data).collect()))


def want_targets(sums, share=1.5):
    """Shares by weight, the excess over twice a source's size shared again until none is above."""
    order = sorted(sums, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(order)}
    goal, open_, left = {}, set(order), share * sum(sums.values())
    while open_:
        per = left / sum(weight[s] for s in open_)
        over = {s for s in open_ if per * weight[s] > 2 * sums[s]}
        if not over:
            return goal | {s: per * weight[s] for s in open_}
        for s in over:
            goal[s] = 2 * sums[s]
            left -= goal[s]
        open_ -= over
    return goal


def test_mix_of_awkward_rows(awkward, empty):
    got = mixing.mix(awkward).collect()
    assert Counter(r.doc_id for r in got) == Counter(i for i, _ in AWKWARD)
    assert all(r.taken == 0 for r in got if r["size"] == 0) and all(0 <= r.taken <= 2 * r["size"] for r in got)
    assert mixing.mix(empty).count() == 0
    assert mixing.mix(awkward.where("doc_id in (3, 4, 5)")).where("target <> 0 or taken <> 0").count() == 0


def test_quotas_follow_highest_quotients(spark):
    sizes = {"a": 5000, "b": 300, "c": 1700, "d": 90}
    goals = spark.createDataFrame(
        [(s, s, n, float(t)) for (s, n), t in zip(sizes.items(), (7000, 600, 2000, 130), strict=True)],
        "key string, source string, source_size long, target double",
    )
    got = mixing.quotas(goals, 10, shards=4).collect()
    house = round(9730 / 10)
    seats, order = Counter(), []
    targets = {r.key: r.target for r in goals.collect()}
    most = {s: 2 * -(-n // 10) for s, n in sizes.items()}
    for _ in range(house):
        s = max((s for s in targets if seats[s] < most[s]), key=lambda s: (targets[s] / (2 * seats[s] + 1), -ord(s)))
        seats[s] += 1
        order.append(s)
    for h in range(4):
        part = Counter(order[house * h // 4: house * (h + 1) // 4])
        assert {r.key: r.quota for r in got if r.shard == h} == {s: part[s] for s in sizes}


def test_documents_of_a_mix_are_placed_once(spark, data):
    """Windows and joins that place the documents are not part of the plan that is run for both kinds of sources."""
    plan = mixing.mix(spark.read.parquet(f"{data}/documents.parquet"))._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and plan.count("Join") == 3


def test_mix_shards_take_their_quotas(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    got = mixing.mix(docs, keep_source=True, shards=5).collect()
    sums = {r.key: (r.source_size, r.target) for r in got}
    goals = spark.createDataFrame(
        [(k, k, n, t) for k, (n, t) in sums.items()], "key string, source string, source_size long, target double")
    block = mixing.block_words(goals)
    words = Counter()
    for r in got:
        assert len(r.by_shard) == 5 and sum(r.by_shard) == r.taken and min(r.by_shard) >= 0
        for shard, n in enumerate(r.by_shard):
            words[r.key, shard] += n
    for q in mixing.quotas(goals, block, shards=5).collect():
        # the last block of a source may be short, once in each pass
        assert q.quota * block - 2 * block < words[q.key, q.shard] <= q.quota * block


def test_mix_splits_a_hot_row(spark):
    df = spark.range(3000).selectExpr(
        "if(id % 3 = 0, 1, id) as doc_id", "if(id % 3 = 0, 'hot row of six words here', 'a b c') as text", "'s' as source")
    got = mixing.mix(df)
    assert got.count() == 3000 and got.where("taken > 2 * size").count() == 0
    total = got.selectExpr("sum(taken) as t", "max(target) as g").first()
    assert abs(total.t - total.g) <= 0.01 * total.g


# the pipeline

def test_pipeline_stages(spark, data, rows):
    """Each stage against brute force on what its predecessor kept."""
    docs = spark.read.parquet(f"{data}/documents.parquet")
    columns = docs.columns
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = corpus_pipeline.materialize(stage(spark, docs, data), name)
        kept[name] = (before, docs)
        if name != "sharding":
            assert docs.columns == columns
    ids = {n: (Counter(r[0] for r in a.select("doc_id").collect()), Counter(r[0] for r in b.select("doc_id").collect()))
           for n, (a, b) in kept.items()}
    before, after = ids["toxicity"]
    model = toxicity.train(kept["toxicity"][0], spark.read.parquet(f"{data}/labels.parquet"), ~toxicity.held_out())
    bad = {r[0] for r in toxicity.score(kept["toxicity"][0], model).where("predicted = 1").select("doc_id").collect()}
    assert set(before) - set(after) == bad and not any(n > 1 for n in after.values())
    before, after = ids["jaccard_join"]
    pairs = [(i, t) for i, t in rows if i in before]
    want = brute_components(pairs)
    assert set(after) == {i for i, v in want.items() if v[0][1] == i}
    before, after = ids["decontamination"]
    found = decontam.contamination(kept["decontamination"][0], spark.read.parquet(f"{data}/benchmark.parquet"))
    assert set(before) - set(after) == {r.doc_id for r in found.where("contaminated").collect()}
    before, after = ids["mixing"]
    times = {r.doc_id: int(r.taken / r["size"] + 0.5) for r in mixing.mix(kept["mixing"][0]).collect() if r["size"]}
    assert after == Counter({i: n for i, n in times.items() if n})
    before, after = ids["sharding"]
    assert before == after


def test_pipeline_stages_take_awkward_rows(spark, awkward, empty, data):
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, awkward, data)
        if name != "sharding":
            assert out.columns == awkward.columns
        assert out.count() >= 1, name
        assert stage(spark, empty, data).count() == 0, name


def test_one_copy_of_repeated_rows_stays(spark, awkward, data):
    got = Counter(r.doc_id for r in corpus_pipeline.one_per_group(spark, awkward, data).collect())
    assert got[1] == 1 and got[2] == 0 and got[6] == 1 and got[7] == 0 and got[3] == got[4] == got[5] == 1


@pytest.mark.parametrize("table", ["documents", "long", "no_ids"])
def test_whole_documents_reach_the_targets(spark, data, table):
    """Each source's words against its target, whatever a block is: half a document and the blocks' rounding apart."""
    if table == "documents":
        docs = spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text", "source")
    else:
        # long documents beside one tiny source, which makes blocks small
        docs = spark.range(900).selectExpr(
            "if({}, null, id) as doc_id".format("true" if table == "no_ids" else "false"),
            "if(id < 4, concat('w', id), concat(repeat(concat('w', id, ' '), 400), 'end')) as text",
            "if(id < 4, 'tiny', concat('s', id % 3)) as source")
    count = lambda rows: [(r.source, len(re.findall(r"[^\x20\x09-\x0D]+", r.text or ""))) for r in rows]
    sizes, got, largest = Counter(), Counter(), Counter()
    for s, n in count(docs.collect()):
        sizes[s] += n
        largest[s] = max(largest[s], n)
    for s, n in count(corpus_pipeline.mix_sources(spark, docs, data).collect()):
        got[s] += n
    for s, t in want_targets(sizes).items():
        assert abs(got[s] - t) <= largest[s] / 2 + 0.01 * t + 2, (s, got[s], t)
