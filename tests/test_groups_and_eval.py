from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from rollforge.operators import evalk as E
from rollforge.operators import groups as G
from rollforge.operators import joins as J
from rollforge.operators import sampling as S
from rollforge.plans import skew


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of all rows in one group, and many identical rows."""
    return spark.range(3000).select(
        "id", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 97).alias("k"),
        F.when(F.col("id") % 5 == 0, 1.0).otherwise((F.col("id") * 7919 % 1000) / 10).alias("v"))


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


def test_attach_stats_paths_agree(skewed):
    stats = skewed.groupBy("k").agg(F.count("v").alias("n"), F.sum("v").alias("s"))
    small = skew.attach_stats(skewed, stats, ["k"]).select("id", "k", "v", "n", "s")
    split = skew.attach_stats(skewed, stats, ["k"], broadcast_rows=0, hot_groups=2).select("id", "k", "v", "n", "s")
    assert rows_of(small) == rows_of(split)
    assert "__salt" in split._jdf.queryExecution().toString()


def test_attach_stats_keeps_null_keys(spark):
    rows = spark.createDataFrame([(None, 1.0), (None, 2.0), ("a", 3.0)], "k string, v double")
    stats = rows.groupBy("k").agg(F.count("v").alias("n"))
    out = skew.attach_stats(rows, stats, ["k"], broadcast_rows=0, hot_groups=1)
    assert out.count() == 3


def test_hash_position_is_a_sort(skewed):
    got = {r["id"]: r["position"] for r in skew.hash_position(skewed, "id", 5).collect()}
    order = Window.orderBy(skew.digest(F.col("id"), 5), "id")
    want = {r["id"]: r["p"] - 1 for r in skewed.select("id", F.row_number().over(order).alias("p")).collect()}
    assert got == want


@pytest.mark.parametrize("partitions", [1, 3, 16])
def test_range_running_equals_window(skewed, partitions):
    got = skew.range_running(skewed, ["k"], ["v", "id"], partitions=partitions).select("id", "before")
    w = Window.partitionBy("k").orderBy("v", "id")
    want = skewed.select("id", (F.row_number().over(w) - 1).cast("bigint").alias("before"))
    assert rows_of(got) == rows_of(want)


def test_exact_quantile_equals_numpy(skewed):
    local = skewed.toPandas()
    for q in (0.0, 0.2, 0.8, 1.0):
        got = {r["k"]: r["threshold"] for r in skew.exact_quantile(skewed, ["k"], "v", q).collect()}
        want = local.groupby("k")["v"].quantile(q).to_dict()
        assert got.keys() == want.keys()
        assert all(math.isclose(got[k], want[k], abs_tol=1e-9) for k in want)


def reward_rows(spark, groups):
    rows = [("r", 0, p, i, float(v)) for p, vs in groups.items() for i, v in enumerate(vs)]
    return spark.createDataFrame(rows, "run_id string, step int, prompt_id int, sample_idx int, reward double")


def test_group_advantage_example(spark):
    df = reward_rows(spark, {1: [2, 0, 2, 0], 2: [1, 1, 1], 3: [5]})
    out = {(r["prompt_id"], r["sample_idx"]): r["advantage"] for r in G.group_z(df).collect()}
    assert [round(out[1, i], 4) for i in range(4)] == [0.866, -0.866, 0.866, -0.866]
    assert [out[2, i] for i in range(3)] == [0.0, 0.0, 0.0]
    assert out[3, 0] is None


def test_advantages_sum_to_zero_per_group(spark):
    df = reward_rows(spark, {p: [(p * 7 + i * 3) % 5 for i in range(p % 6 + 2)] for p in range(40)})
    for adv in (G.group_z(df), G.leave_one_out(df), G.scaled(df, "none")):
        worst = adv.groupBy(*G.GROUP).agg(F.abs(F.sum("advantage")).alias("s")).agg(F.max("s")).first()[0]
        assert worst < 1e-9
    whole = [r["advantage"] for r in G.batch_z(df).collect()]
    assert abs(sum(whole)) < 1e-9 and np.std(whole, ddof=1) == pytest.approx(1.0, abs=1e-6)


def test_unknown_scale_is_an_error(spark):
    with pytest.raises(ValueError):
        G.scaled(reward_rows(spark, {1: [1, 2]}), "prompt")


def eval_rows(spark, rows):
    schema = "run_id string, epoch int, question_id int, sample_idx int, decode string, truth string, response string"
    return spark.createDataFrame(rows, schema)


def test_pass_at_k_example(spark):
    samples = ["108", "96", "72 dollars", "96", "$72", "1", "72", "2", "<answer>72</answer>", "3"]
    rows = [("r", 0, 1, 0, "greedy", "72", "<answer>96</answer>")]
    rows += [("r", 0, 1, i, "sample", "72", f"<answer>{s}</answer>" if "<" not in s else s) for i, s in enumerate(samples)]
    rows += [("r", 0, 2, 0, "greedy", "5", "<answer>5</answer>"), ("r", 0, 2, 0, "sample", "5", "<answer>6</answer>")]
    graded = E.grade(eval_rows(spark, rows))
    d = {r["question_id"]: r for r in E.detail(graded).collect()}
    assert (d[1]["pass_1"], d[1]["correct_in_5"], d[1]["correct_in_10"]) == (0, 2, 4)
    assert d[1]["sampled_answers"] == ["108", "96", "72", "96", "72", "1", "72", "2", "72", "3"]
    p = E.pass_at_k(graded)
    assert [p.first()[f"pass_at_{k}"] for k in (1, 5, 10)] == [0.5, 0.5, 0.5]
    assert E.order_violations(p).count() == 0
    same = E.same_as_greedy(graded).first()["same_share"]
    assert same == 0.0


def test_pass_at_k_of_nothing_is_zero(spark):
    graded = E.grade(eval_rows(spark, []))
    total = E.pass_at_k(graded, keys=()).first()
    assert (total["pass_at_1"], total["pass_at_10"], total["questions"]) == (0.0, 0.0, 0)


def test_transitions(spark):
    answers = {1: ["5", "5", "6", "6"], 2: ["1", "7", "7", "1"]}
    rows = [("r", e, q, 0, "greedy", "6" if q == 1 else "7", f"<answer>{a}</answer>") for q, s in answers.items() for e, a in enumerate(s)]
    out = {(r["question_id"], r["epoch"]): r for r in E.transitions(E.grade(eval_rows(spark, rows))).collect()}
    assert [out[1, e]["changed"] for e in range(4)] == [False, False, True, False]
    assert [out[1, e]["stuck_for"] for e in range(4)] == [0, 1, 0, 1]
    assert out[1, 2]["became_right"] and out[2, 3]["became_wrong"] and not out[2, 0]["changed"]


def test_seeded_order_ignores_partitioning(spark):
    base = spark.range(500).withColumnRenamed("id", "key")
    results = []
    for parts in (1, 4, 200):
        df = base.repartition(parts)
        small = rows_of(S.seeded_split(df, "key", 30, 20).select("key", "split"))
        results.append((small, rows_of(S.rollout_schedule(df, "key", 2, 8, 2, 1))))
    assert results[0] == results[1] == results[2]
    names = [s for _, s in results[0][0]]
    assert names.count("test") == 20 and names.count("train") == 30


def test_large_and_small_split_agree(spark, monkeypatch):
    df = spark.range(300).withColumnRenamed("id", "key")
    small = rows_of(S.first_in_hash_order(df, "key", 40, 9).select("key", "position"))
    monkeypatch.setattr(S, "TOP_N_ROWS", 10)
    assert rows_of(S.first_in_hash_order(df, "key", 40, 9).select("key", "position")) == small


def test_schedule_shape(spark):
    df = spark.range(25).withColumnRenamed("id", "key")
    plan = S.rollout_schedule(df, "key", generations=2, generation_batch=6, iterations=1, steps_per_generation=4)
    per_step = plan.groupBy("step").agg(F.count("*").alias("n"), F.countDistinct("key").alias("k")).collect()
    assert len(per_step) == 8 * 4 and {(r["n"], r["k"]) for r in per_step} == {(6, 3)}
    assert plan.select("key").distinct().count() == 24
    rest = S.rollout_schedule(df, "key", 2, 6, drop_last=False)
    assert rest.select("key").distinct().count() == 25


def test_fraction_split_is_disjoint_and_whole(spark):
    df = spark.range(5000).withColumnRenamed("id", "key")
    out = S.fraction_split(df, "key", {"test": 0.2, "train": 0.8}).groupBy("split").count().collect()
    sizes = {r["split"]: r["count"] for r in out}
    assert sum(sizes.values()) == 5000 and 850 < sizes["test"] < 1150


def test_kl_pairs_never_match_themselves(spark):
    df = spark.range(41).select(F.col("id").alias("key"), F.concat(F.lit("c"), "id").alias("completion"))
    out = S.kl_mismatch_pairs(df, "key", 4)  # 41 rows: the last one joins the batch before it
    assert out.where(F.col("completion") == F.col("kl_completion")).count() == 0
    assert out.agg(F.max("batch")).first()[0] == 9
    same = sorted(r[0] for r in out.select("completion").collect())
    assert sorted(r[0] for r in out.select("kl_completion").collect()) == same
    mirrored = S.kl_mismatch_pairs(df, "key", 4, reverse=True)
    assert sorted(r[0] for r in mirrored.select("kl_completion").collect()) == same


def test_cycle_to_n_paths_agree(spark, monkeypatch):
    df = spark.createDataFrame([(k,) for k in "abc"], "key string")
    small = rows_of(S.cycle_to_n(df, "key", 8).select("row", "key"))
    monkeypatch.setattr(skew, "BROADCAST_ROWS", 1)
    assert rows_of(S.cycle_to_n(df, "key", 8).select("row", "key")) == small
    assert [k for _, k in small] == list("abcabcab")
    assert S.cycle_to_n(df, "key", 2).count() == 2
    assert S.cycle_to_n(df, "key", 8).columns == ["key", "row"]
    monkeypatch.undo()
    assert S.cycle_to_n(df, "key", 8).columns == ["key", "row"]


def test_diversity_shuffles_once(spark):
    """Null, empty and spaced answers, repeated rows and sample numbers, null keys and numbers, a question without answers."""
    schema = "run_id string, epoch int, question_id long, sample_idx int, decode string, given string, truth string, correct boolean"
    samples = [(0, "a"), (0, "a"), (0, "b"), (1, "a"), (2, None), (-1, ""), (3, " a"), (None, "x"), (10, "out")]
    rows = [("r", 0, q, i, "sample", a, "7", False) for q in (1, None) for i, a in samples]
    rows += [("r", 0, 1, 4, "greedy", "g", "7", False), ("r", 0, 1, 5, None, "y", "7", False), ("r", 0, 4, 0, "greedy", "g", "7", False)]
    rows += [("r", 0, 2, i, "sample", None, None, None) for i in range(2)] + [(None, None, 3, i, "sample", "7", "7", True) for i in range(10)]
    found = E.diversity(spark.createDataFrame(rows, schema).repartition(3))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "partial_collect_set(given" in plan
    got = {r["question_id"]: (r["distinct_answers"], r["all_same"]) for r in found.collect()}
    assert got == {1: (4, False), None: (4, False), 2: (0, False), 3: (1, True)}
    assert found.dtypes[-2:] == [("distinct_answers", "bigint"), ("all_same", "boolean")]


def test_bootstrap_draws_per_class(spark):
    df = spark.range(60).select(F.col("id").alias("key"), (F.col("id") < 10).alias("good"))
    sizes = {r["good"]: r["count"] for r in S.bootstrap_sample(df, "key", "good", 20).groupBy("good").count().collect()}
    assert sizes == {True: 10, False: 20}


def test_rank_align_on_one_hot_batch(spark):
    rng = np.random.default_rng(1)
    values = [(i, 0, float(a), float(b)) for i, (a, b) in enumerate(rng.integers(0, 20, (500, 2)))]
    df = spark.createDataFrame(values, "row int, step int, a double, b double")
    got = [r["delta"] for r in J.rank_align(df, ["step"], "row", "a", "b").orderBy("rank").collect()]
    want = np.sort([v[2] for v in values]) - np.sort([v[3] for v in values])
    assert got == want.tolist()


def test_required_join_fails_on_missing(spark):
    rows = spark.createDataFrame([(1,), (2,)], "k int")
    some = spark.createDataFrame([(1, 0.5)], "k int, x double")
    assert J.attach_required(rows.where("k = 1"), some, "k").collect()[0]["x"] == 0.5
    with pytest.raises(Exception, match="no values for k"):
        J.attach_required(rows, some, "k").collect()
    with pytest.raises(Exception, match="row keys differ"):
        J.concat_columns(rows, some, "k").collect()


def test_pairing_ties_and_hot_prompts(spark):
    rows = [(1, 0, "a", 1.0), (1, 1, "b", 1.0), (2, 0, "c", 0.0), (2, 1, "d", 3.0), (3, 0, "alone", 1.0)]
    s = spark.createDataFrame(rows, "prompt_id int, sample_idx int, response string, reward double")
    out = {r["prompt_id"]: (r["chosen"], r["rejected"]) for r in J.pair_by_score(s).collect()}
    assert out == {1: ("a", "b"), 2: ("d", "c")}
    prompts = spark.createDataFrame([(1, "p1"), (2, "p2"), (9, "p9")], "prompt_id int, answer string")
    small = J.join_answers(s, prompts)
    split = skew.join_lookup(s, prompts, "prompt_id", broadcast_rows=0).select(small.columns)
    assert rows_of(small) == rows_of(split) and small.count() == 4
    assert skew.join_lookup(s, prompts, "prompt_id").columns == skew.join_lookup(s, prompts, "prompt_id", broadcast_rows=0).columns


def test_pairs_stay_in_their_step(spark):
    rows = [("r", 1, 7, 0, "a", 1.0), ("r", 1, 7, 1, "b", 2.0), ("r", 2, 7, 0, "c", 3.0), ("r", 2, 7, 1, "d", 0.0)]
    s = spark.createDataFrame(rows, "run_id string, step int, prompt_id int, sample_idx int, response string, reward double")
    keys = ["run_id", "step", "prompt_id"]
    got = {r["step"]: (r["chosen"], r["rejected"]) for r in J.pair_by_score(s, keys).collect()}
    assert got == {1: ("b", "a"), 2: ("c", "d")}
    ranks = s.select(*keys).distinct().withColumn("rank", F.col("step") - 1)
    got = {r["step"]: r["chosen"] for r in J.pair_by_judge(s, ranks, keys).collect()}
    assert got == {1: "a", 2: "d"}
    with pytest.raises(Exception, match="sample_idx repeats"):
        J.pair_by_score(s.drop("run_id", "step")).collect()


def test_required_join_checks_every_column(spark):
    rows = spark.createDataFrame([(1, 2.0), (2, 3.0)], "k int, c double")
    some = spark.createDataFrame([(1, 0.5)], "k int, c0 double")
    for column in ("c", "c0"):
        with pytest.raises(Exception, match="no values for k"):
            J.attach_required(rows, some, "k").select(column).collect()
        with pytest.raises(Exception, match="row keys differ"):
            J.concat_columns(rows, some, "k").select(column).collect()


def test_attach_stats_means_the_same_at_every_size(spark):
    rows = spark.createDataFrame([(1, None, "a"), (2, "k", "b"), (3, None, "c"), (4, "m", "d")], "i int, g string, x string")
    stats = rows.groupBy("g").agg(F.count(F.lit(1)).alias("n"), F.max("x").alias("top"))
    small = skew.attach_stats(rows, stats, ["g"])
    cold = skew.attach_stats(rows, stats, ["g"], broadcast_rows=0, hot_groups=1)
    assert small.columns == cold.columns == ["i", "g", "x", "n", "top"]
    want = [(1, None, "a", 2, "c"), (2, "k", "b", 1, "b"), (3, None, "c", 2, "c"), (4, "m", "d", 1, "d")]
    assert sorted(map(tuple, small.collect())) == sorted(map(tuple, cold.collect())) == want


def test_small_shares_are_not_lost(spark):
    df = spark.range(200000).withColumnRenamed("id", "key")
    n = S.fraction_split(df, "key", {"tiny": 0.00004, "rest": 0.5}).where("split = 'tiny'").count()
    assert 1 <= n <= 25


def test_size_is_counted_in_bytes(spark, monkeypatch):
    df = spark.createDataFrame([("x" * 1000,)] * 3, "t string")
    assert skew.size_of(df) == (3, 3 * 1016)
    monkeypatch.setattr(skew, "BROADCAST_BYTES", 2000)
    assert not skew.fits_broadcast(df) and skew.fits_broadcast(df.limit(1))


def test_head_limit_paths_agree(spark, monkeypatch):
    df = spark.range(200).select((F.col("id") * 37 % 200).alias("k"))
    small = rows_of(S.head_limit(df, ["k"], 30))
    monkeypatch.setattr(S, "TOP_N_ROWS", 5)
    assert rows_of(S.head_limit(df, ["k"], 30)) == small == [(i,) for i in range(30)]


def test_clean_rows_without_broadcast(spark, monkeypatch):
    rows = spark.createDataFrame([(i, f"t{i % 4}") for i in range(40)], "i int, text string")
    held = spark.createDataFrame([("t1",), ("t9",)], "text string")
    small = rows_of(J.without_leaked(rows, held, "text"))
    monkeypatch.setattr(skew, "BROADCAST_ROWS", 0)
    assert rows_of(J.without_leaked(rows, held, "text")) == small and len(small) == 30


def test_batch_figures_do_not_join_the_group_figures_again(spark, monkeypatch):
    """The batch's figures come from the rows given, not from their join with the groups' figures."""
    read, stats = [], G.stats
    monkeypatch.setattr(G, "stats", lambda df, *a: read.append(df.columns) or stats(df, *a))
    df = spark.createDataFrame([("r", 0, 1, 1.0), ("r", 0, 1, 3.0), ("r", 0, 2, 6.0)], "run_id string, step int, prompt_id int, reward double")
    got = sorted(r["advantage"] for r in G.scaled(df, "batch").collect())
    std = (sum((x - 10 / 3) ** 2 for x in (1, 3, 6)) / 2) ** 0.5 + 1e-4
    assert got == [pytest.approx(-1 / std), pytest.approx(0.0), pytest.approx(1 / std)] and read == [df.columns] * 2
