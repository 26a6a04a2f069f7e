from __future__ import annotations

import bisect
import json
import re
from collections import Counter

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rollforge.functions import tokens as K
from rollforge.operators import prep as P
from rollforge.operators import reports as V
from rollforge.plans.packing import best_fit_plan
from rollforge.schemas import RECORD
from rollforge.sources import records


def by_table(table):
    """Tokenizer that maps known words to given ids."""
    pairs = F.create_map(*[x for w, i in table.items() for x in (F.lit(w), F.lit(i).cast("bigint"))])
    return lambda text: F.transform(K.words(text), lambda w: pairs[w])


def test_prep_pairs_example(spark):
    tok = by_table({"The": 11, "sky": 12, "is": 13, "blue": 14, "green": 15, "grass": 16})
    pairs = spark.createDataFrame([("so The sky is", "blue grass sky green", "green")], "prompt string, chosen string, rejected string")
    out = P.prep_pairs(pairs, tok, max_prompt=3, max_completion=3).first()
    assert (out["prompt_ids"], out["chosen_ids"], out["rejected_ids"]) == ([11, 12, 13], [14, 16, 12], [15, 2])


def test_prep_pairs_joint_limits(spark):
    text = " ".join(f"w{i}" for i in range(30))
    pairs = spark.createDataFrame([(1, text, text, "a b"), (2, "a b", "c", "d"), (3, "a", text, "b")],
                                  "pair_id int, prompt string, chosen string, rejected string")
    for mode in ("keep_start", "keep_end"):
        for r in P.prep_pairs_joint(pairs, 20, 8, mode).collect():
            for side in ("chosen", "rejected"):
                ids, labels = r[f"{side}_ids"], r[f"{side}_labels"]
                n = len(r["prompt_ids"])
                assert len(ids) == len(labels) <= 20 and labels[:n] == [-100] * n and labels[n:] == ids[n:]
    with pytest.raises(ValueError):
        P.prep_pairs_joint(pairs, 20, 8, "keep_middle")


def test_prep_steps_labels(spark):
    steps = spark.createDataFrame([(1, 0, "a b", True), (1, 2, "c", False), (2, 0, "d e f", True)],
                                  "k int, turn int, step_text string, label boolean")
    prompts = spark.createDataFrame([(1, "p q"), (2, "r")], "k int, prompt string")
    out = {r["k"]: r for r in P.prep_steps(steps, prompts, "k", [3], 50).collect()}
    assert out[1]["labels"] == [-100] * 3 + [-100, -100, 1] + [-100, 0]
    assert out[1]["input_ids"][0] == 1 and out[1]["input_ids"][5] == 3 and len(out[1]["input_ids"]) == 8
    last = {r["k"]: r["labels"] for r in P.prep_steps(steps, prompts, "k", [3], 50, last_step_only=True).collect()}
    assert last[1] == [-100] * 7 + [0]
    short = {r["k"]: r for r in P.prep_steps(steps, prompts, "k", [3], 50, max_completion=3).collect()}
    assert short[1]["labels"] == [-100] * 5 + [1] and short[2]["labels"] == [-100] * 5


def test_prep_steps_has_no_limit_by_default(spark):
    steps = spark.range(1500).selectExpr("1 as k", "cast(id as int) as turn", "'a' as step_text", "id % 2 = 0 as label")
    prompts = spark.createDataFrame([(1, "p")], "k int, prompt string")
    row = P.prep_steps(steps, prompts, "k", [], 5000).first()
    assert len(row["input_ids"]) == len(row["labels"]) == 1502 and row["labels"][-2:] == [1, 0]


def test_steps_without_tokens_have_no_label(spark):
    steps = spark.createDataFrame([(1, 0, "", True), (1, 1, "a b", False)], "k int, turn int, step_text string, label boolean")
    prompts = spark.createDataFrame([(1, "p")], "k int, prompt string")
    row = P.prep_steps(steps, prompts, "k", [], 50).first()
    assert len(row["input_ids"]) == 4 and row["labels"] == [-100, -100, -100, 0]


def test_encode_keeps_wordless_texts(spark):
    docs = spark.createDataFrame([(1, "a b a"), (2, "  "), (3, None)], "doc_id int, text string")
    got = {r["doc_id"]: len(r["input_ids"]) for r in P.encode(docs, P.build_vocab(docs), "doc_id").collect()}
    assert got == {1: 3, 2: 0, 3: 0}


def test_padding_without_keys_pads_to_the_table(spark):
    df = spark.createDataFrame([([5, 6],), ([7],)], "ids array<bigint>")
    assert sorted(r["ids"] for r in P.pad_sequences(df, "ids").collect()) == [[0, 7], [5, 6]]


def test_array_builders(spark):
    df = spark.createDataFrame([([0, 0, 5, 6, 2, 7, 0],), ([4, 4],), ([],)], "a array<bigint>")
    out = df.select(
        K.until_stop(F.col("a")).alias("stop"), K.stop_mask(F.col("a"), drop_unfinished=True).alias("mask"),
        K.pads_last(F.col("a")).alias("packed"), K.count_real(F.col("a")).alias("n"), K.last_n(F.col("a"), 3).alias("tail"),
        K.pad_to(F.col("a"), F.lit(8), "left").alias("left"), K.ensure_bos(F.col("a")).alias("bos"),
        K.ensure_eos(F.col("a")).alias("eos")).collect()
    assert [r["stop"] for r in out] == [[0, 0, 5, 6, 2], [4, 4], []]
    assert [r["mask"] for r in out] == [[1, 1, 1, 1, 1, 0, 0], [0, 0], []]
    assert [r["packed"] for r in out] == [[5, 6, 2, 7, 0, 0, 0], [4, 4], []]
    assert [r["n"] for r in out] == [3, 2, 0]
    assert [r["tail"] for r in out] == [[2, 7, 0], [4, 4], []]
    assert [len(r["left"]) for r in out] == [8, 8, 8]
    assert [r["bos"][0] for r in out] == [1, 1, 1] and [r["eos"][-1] for r in out] == [2, 2, 2]


def test_completion_mask_example(spark):
    rows = spark.createDataFrame([("r", [0, 0, 7, 8, 9, 0]), ("r", [6, 7, 7, 8, 9, 9])], "run_id string, a array<bigint>")
    out = sorted(r["completion_mask"] for r in P.completion_masks(rows, "a", 4, ["run_id"]).collect())
    # the row without padding gives two prompt tokens to the window
    assert out == [[0, 0, 1, 1], [1, 1, 1, 0]]


def sequences(spark):
    return spark.range(200).select(
        F.col("id").alias("key"),
        F.transform(F.sequence(F.lit(1), (F.col("id") * 37 % 90).cast("int") + 1), lambda i: F.col("id") * 1000 + i).alias("ids"))


def test_packing_keeps_every_token(spark):
    seqs = sequences(spark)
    want = Counter(t for r in seqs.collect() for t in r["ids"])
    for packed in (P.pack_wrapped(seqs, "key", "ids", 32, 3), P.pack_best_fit(seqs, "key", "ids", 32)):
        blocks = [r["input_ids"] for r in packed.collect()]
        assert max(map(len, blocks)) <= 32
        assert Counter(t for b in blocks for t in b) == want


def test_wrapped_blocks_are_full_but_the_last(spark):
    rows = P.pack_wrapped(sequences(spark), "key", "ids", 32, 3).orderBy("shard", "block").collect()
    for a, b in zip(rows, rows[1:]):
        if a["shard"] == b["shard"]:
            assert len(a["input_ids"]) == 32


def test_best_fit_keeps_short_sequences_whole(spark):
    seqs = sequences(spark).where(F.size("ids") <= 32)
    blocks = [r["input_ids"] for r in P.pack_best_fit(seqs, "key", "ids", 32).collect()]
    for r in seqs.collect():
        assert sum(any(b[i:i + len(r["ids"])] == r["ids"] for i in range(len(b))) for b in blocks) == 1
    total = sum(len(b) for b in blocks)
    assert len(blocks) <= 2 * (total // 32 + 2)


def best_fit_one_by_one(lengths, block):
    """Blocks of best-fit decreasing, sequence by sequence."""
    spaces, used = [], 0
    for n in sorted(lengths, reverse=True):
        i = bisect.bisect_left(spaces, (n, -1))
        if i < len(spaces):
            space, b = spaces.pop(i)
        else:
            space, b, used = block, used, used + 1
        if space > n:
            bisect.insort(spaces, (space - n, b))
    return used, sorted(s for s, _ in spaces)


@given(st.lists(st.integers(1, 40), max_size=300), st.sampled_from([40, 64, 100]))
@settings(max_examples=60, deadline=None)
def test_plan_from_counts_is_best_fit(lengths, block):
    fill, seen = Counter(), Counter()
    for p in best_fit_plan(Counter(lengths).items(), block):
        assert seen[p.length] == p.first_rank
        seen[p.length] += p.count
        for j in range(p.count):
            b = p.first_block + j // p.per_block
            assert fill[b] == p.used + j % p.per_block * p.length
            fill[b] += p.length
    assert seen == Counter(lengths)
    assert (len(fill), sorted(block - n for n in fill.values() if n < block)) == best_fit_one_by_one(lengths, block)


def test_plan_is_small_for_any_number_of_sequences():
    plan = best_fit_plan([(n, 10**12 + n * 12_345_677) for n in range(1, 513)], 512)
    assert len(plan) < 5_000 and sum(p.count for p in plan) == sum(10**12 + n * 12_345_677 for n in range(1, 513))


def test_best_fit_over_the_table_equals_the_twin(spark):
    seqs = sequences(spark)
    rows = P.pack_best_fit(seqs.repartition(7), "key", "ids", 32).collect()
    assert sorted(map(repr, rows)) == sorted(map(repr, P.pack_best_fit(seqs.coalesce(1), "key", "ids", 32).collect()))
    lengths = [min(32, n - low) for r in seqs.collect() for n in [len(r["ids"])] for low in range(0, n, 32)]
    used, spaces = best_fit_one_by_one(lengths, 32)
    assert sorted(r["block"] for r in rows) == list(range(used))
    assert sorted(32 - len(r["input_ids"]) for r in rows if len(r["input_ids"]) < 32) == spaces
    assert P.pack_best_fit(seqs.where("false"), "key", "ids", 32).count() == 0


@pytest.mark.parametrize("head", [0, 3, 1000])
def test_encoding_with_any_head(spark, head):
    rows = [(1, "a b a c"), (2, None), (3, ""), (4, " \t\n"), (5, "c  rare\u00a0word a\x0bb "), (1, "b b"), (None, "d a")]
    df = spark.createDataFrame(rows, "id int, text string").repartition(3)
    vocab = P.build_vocab(df)
    table = {r["token_id"]: r["token"] for r in vocab.collect()}
    got = sorted((repr(r["id"]), [table[t] for t in r["input_ids"]]) for r in P.encode(df, vocab, "id", head_tokens=head).collect())
    assert got == sorted((repr(i), re.findall(r"[^ \t\n\x0b\f\r]+", t or "")) for i, t in rows)


def test_vocabulary_roundtrip_with_frequent_token(spark, monkeypatch):
    df = spark.range(50).select("id", F.concat_ws(" ", F.lit("the"), F.concat(F.lit("w"), F.col("id") % 7), F.lit("the")).alias("text"))
    vocab = P.build_vocab(df)
    table = {r["token_id"]: r["token"] for r in vocab.collect()}
    assert sorted(table) == list(range(4, 12))
    back = {r["id"]: " ".join(table[t] for t in r["input_ids"]) for r in P.encode(df, vocab, "id").collect()}
    assert back == {r["id"]: r["text"] for r in df.collect()}


def test_unpair_doubles_rows(spark):
    pairs = spark.createDataFrame([(1, "c", "r"), (2, "x", "y")], "pair_id int, chosen string, rejected string")
    out = sorted((r["pair_id"], r["completion"], r["label"]) for r in P.unpair(pairs).collect())
    assert out == [(1, "c", True), (1, "r", False), (2, "x", True), (2, "y", False)]


def test_records_roundtrip(spark, tmp_path):
    rows = [(0, "问题", "甲"), (1, 'quote " and \n', ""), (2, "x", None)]
    df = spark.createDataFrame(rows, "id int, prompt string, answer string")
    records.write_arrays(df, str(tmp_path / "arrays"), "id", 2, ["prompt", "answer"])
    back = records.scan(spark, str(tmp_path / "arrays"), RECORD, recursive=True, pattern="*.txt")
    want = sorted((p, a or "", "", "") for _, p, a in rows)
    assert sorted((r["prompt"], r["answer"], r["instruction"], r["input"]) for r in back.collect()) == want
    records.write_lines(df.drop("id"), str(tmp_path / "lines"))
    lines = records.scan(spark, str(tmp_path / "lines"), RECORD, lines=True)
    assert sorted((r["prompt"], r["answer"], r["instruction"], r["input"]) for r in lines.collect()) == want
    (tmp_path / "one.json").write_text('[{"prompt": "a", "extra": 1}, {"answer": "b"}]', encoding="utf-8")
    one = records.scan(spark, str(tmp_path / "one.json"), RECORD).orderBy("file", "ord").collect()
    assert [(r["prompt"], r["answer"]) for r in one] == [("a", ""), ("", "b")]


def test_preview_cuts_and_formats(spark):
    rows = [("r", 0, i, "p" * (99 + i), "q" * 201, i / 3) for i in range(4)]
    df = spark.createDataFrame(rows, "run_id string, step int, i int, prompt string, response string, reward double")
    out = V.sample_table(V.top_rows(df, ["run_id", "step"], ["i"], 3), ["run_id", "step"]).orderBy("sample").collect()
    assert [r["sample"] for r in out] == ["Sample 1", "Sample 2", "Sample 3"]
    assert out[1]["prompt"] == "p" * 100 and out[2]["prompt"] == "p" * 100 + "..." and out[0]["response"].endswith("...")
    assert out[1]["reward"] == "0.3333"


TORN = [
    {"prompt": 'a } b { " c', "answer": "x\\", "instruction": "}{", "input": "é   \n"},
    {"prompt": '{"no": "record"}', "answer": "],[{", "instruction": '\\"}', "input": ""},
    {},
    {"prompt": "", "more": {"deep": [{"a": "}"}, {}]}, "answer": "1"},
    {"prompt": "p" * 300, "answer": "}" * 40, "instruction": '"' * 40, "input": "\\" * 41},
]


@pytest.mark.parametrize("size", [61, 128, 1 << 20])
def test_one_array_file_is_read_by_many_tasks(spark, tmp_path, size):
    rows = [{**TORN[i % len(TORN)], "instruction": f"{i}"} for i in range(60)]
    (tmp_path / "a.json").write_text(json.dumps(rows, ensure_ascii=False, indent=1), encoding="utf-8")
    (tmp_path / "b.json").write_text(json.dumps(rows[:3]), encoding="utf-8")
    (tmp_path / "c.json").write_text("[ ]\n")
    (tmp_path / "d.json").write_text("")
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = [spark.conf.get(n) for n in names]
    try:
        for n in names:
            spark.conf.set(n, str(size))
        df = records.scan(spark, str(tmp_path), RECORD)
        found = df.orderBy("file", "ord").collect()
        tasks = spark.read.option("lineSep", "}").text(str(tmp_path / "a.json")).rdd.getNumPartitions()
    finally:
        for n, v in zip(names, before, strict=True):
            spark.conf.set(n, v)
    assert tasks == 1 or size < 200 and tasks > 50
    want = [[r.get(c, "") for c in RECORD.fieldNames()] for r in rows]
    assert [list(r[2:]) for r in found if r["file"].endswith("a.json")] == want
    assert [list(r[2:]) for r in found if r["file"].endswith("b.json")] == want[:3]
    assert len(found) == 63


def test_splits_beyond_broadcast(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(records, "fits_broadcast", lambda df: False)
    (tmp_path / "a.json").write_text(json.dumps(TORN))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "70")
    try:
        found = records.scan(spark, str(tmp_path / "a.json"), RECORD).orderBy("ord").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert [list(r[2:]) for r in found] == [[r.get(c, "") for c in RECORD.fieldNames()] for r in TORN]


def test_arrays_are_valid_json_in_key_order(spark, tmp_path):
    df = spark.range(25).select("id", F.concat(F.lit("p}"), "id").alias("prompt")).repartition(5)
    records.write_arrays(df, str(tmp_path / "out"), "id", 10, ["prompt"])
    files = sorted((tmp_path / "out").glob("block=*/*.txt"))
    assert [[r["prompt"] for r in json.loads(f.read_text())] for f in files] == [
        [f"p}}{i}" for i in range(a, min(25, a + 10))] for a in (0, 10, 20)
    ]


def test_a_repeated_flush_replaces_itself(spark, tmp_path):
    from rollforge.operators import runs

    path = str(tmp_path / "metrics")
    first = spark.createDataFrame([("a", "loss", 1.0), ("b", "loss", 2.0)], "run_id string, name string, value double")
    runs.append_metrics(first, path, 0)
    runs.append_metrics(first, path, 1)
    runs.append_metrics(first.where("run_id = 'a'").withColumn("value", F.lit(5.0)), path, 1)
    got = sorted((r["run_id"], r["flush"], r["value"]) for r in spark.read.parquet(path).collect())
    assert got == [("a", 0, 1.0), ("a", 1, 5.0), ("b", 0, 2.0), ("b", 1, 2.0)]


def test_a_flush_of_many_runs_has_few_folders(spark, tmp_path):
    from rollforge.operators import runs

    path = str(tmp_path / "metrics")
    rows = spark.range(500).select(
        F.when(F.col("id") > 0, F.col("id")).alias("run_id"), F.lit("loss").alias("name"), F.lit(1.0).alias("value"))
    runs.append_metrics(rows, path, 0)
    runs.append_metrics(rows, path, 1)
    again = rows.where("run_id is null or run_id % 5 = 0").withColumn("value", F.lit(5.0))
    runs.append_metrics(again, path, 1)
    assert len({f.parent for f in (tmp_path / "metrics").rglob("*.parquet")}) <= 2 * runs.RUN_BUCKETS
    got = {(r["flush"], r["run_id"]): r["value"] for r in spark.read.parquet(path).collect()}
    assert spark.read.parquet(path).count() == len(got) == 1000
    assert all(v == (5.0 if flush and (run is None or run % 5 == 0) else 1.0) for (flush, run), v in got.items())


@pytest.mark.parametrize("head", [3, 1000])
def test_texts_are_coded_in_slices(spark, monkeypatch, head):
    texts = [None, "", "b a " * 300, "x1 a c", " ", "c x2 x3 a", "x4 " * 900, "a"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id int, text string").coalesce(1)
    vocab = P.build_vocab(df)
    ids = {r["token"]: r["token_id"] for r in vocab.collect()}
    for most in (1 << 30, 64):
        monkeypatch.setattr(P, "SLICE_BYTES", most)
        got = {r["doc_id"]: r["input_ids"] for r in P.encode(df, vocab, "doc_id", head_tokens=head).collect()}
        assert got == {i: [ids[w] for w in (t or "").split()] for i, t in enumerate(texts)}
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"])
    assert [s.num_rows for s in P._by_text([batch], 0)] == [3, 4, 1] and [s.num_rows for s in P._by_text([batch.slice(0, 0)], 0)] == []
