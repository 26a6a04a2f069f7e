"""Every registered query against its SQL, and rules its plan must keep."""

from __future__ import annotations

import math

import duckdb
import pytest

import __spark_entry__ as entry_points
from rollforge.catalog.registry import CHECKS, QUERIES
from rollforge.schemas import RECORD

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()
# queries whose work needs Python on the executors
PYTHON = {"gae", "top_entropy_mask", "audit_policy_ratio_entropy", "format_rows_batches", "reward_python"}


@pytest.fixture(scope="module")
def engine(data):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{data}/{t}.parquet'")
    yield con
    con.close()


def canonical(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])

    def cell(v):
        if v is None or (isinstance(v, float) and math.isnan(v)):
            return "~"
        if isinstance(v, bool) or isinstance(v, str):
            return str(v)
        return repr(float(v)) if isinstance(v, (int, float)) else str(v)

    return sorted(tuple(cell(r[i]) for i in order) for r in rows)


def check(df, engine, name):
    rows = [tuple(r) for r in df.collect()]
    cursor = engine.execute(CHECKS[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == sorted(df.columns)
    assert canonical(df.columns, rows) == canonical(names, cursor.fetchall())


LARGE = (
    "advantage_group_z", "advantage_scaled_batch", "advantage_whiten", "assistant_bootstrap", "audit_preference_aot",
    "audit_preference_bco", "audit_unpaired", "build_vocab_ids", "join_answers", "masked_whiten", "pad_sequences",
    "replicate_cycle", "reward_histogram", "seeded_split", "split_leakage_clean", "top_entropy_mask",
)


@pytest.mark.parametrize("name", LARGE)
def test_query_beyond_broadcast(spark, engine, data, name, monkeypatch):
    """The same result when no table fits a broadcast and few groups are hot."""
    from rollforge.operators import sampling
    from rollforge.plans import skew

    monkeypatch.setattr(skew, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(sampling, "TOP_N_ROWS", 5)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        check(QUERIES[name](spark, data), engine, name)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, engine, data, name):
    df = QUERIES[name](spark, data)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython"):
        assert node not in plan, f"{name} plans a {node}"
    if name not in PYTHON:
        assert "EvalPython" not in plan and "InPandas" not in plan
    if name in CHECKS:
        check(df, engine, name)
    else:
        assert df.count() > 0


def test_entry_returns_rows(spark):
    df = entry_points.entry(spark)
    assert df.columns == ["run_id", "epoch", "pass_at_1", "pass_at_5", "pass_at_10", "questions"] and df.count() > 0


def test_scoring_is_one_narrow_stage(spark, data):
    plan = QUERIES["reward_heuristic"](spark, data)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") <= 1 and "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint>" in plan


def test_group_figures_shuffle_once(spark, data):
    from rollforge.catalog.groups_eval import rewarded
    from rollforge.operators import groups as G

    plan = G.stats(rewarded(spark, data), G.GROUP)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("hashpartitioning") == 1 and "partial_avg" in plan and "SortAggregate" not in plan


def test_rank_filter_runs_before_the_shuffle(spark, data):
    plan = QUERIES["unique_prompts"](spark, data)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_filter_reaches_the_partition(spark, data):
    plan = QUERIES["scan_split"](spark, data)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(split" in plan


def test_record_schema_is_explicit():
    assert RECORD.fieldNames() == ["prompt", "answer", "instruction", "input"]


def test_quantile_plan_has_no_sort_of_all_rows(spark):
    from pyspark.sql import functions as F

    from rollforge.plans import skew

    df = spark.range(1000).select((F.col("id") % 3).alias("g"), F.rand(1).alias("v"))
    plan = skew.exact_quantile(df, ["g"], "v", 0.3)._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan


@pytest.mark.parametrize(("rows", "last"), [(0, 50), (500_000, 0), (500_000, 1_000_000)])
def test_quantile_equals_sorting(spark, monkeypatch, rows, last):
    import random

    from rollforge.plans import skew

    monkeypatch.setattr(skew, "BROADCAST_ROWS", rows)
    monkeypatch.setattr(skew, "LAST_ROUND", last)
    random.seed(5)
    groups = {
        "a": [random.gauss(0, 1e3) for _ in range(501)], "b": [random.choice([1.5, -2.0, 0.0, -0.0]) for _ in range(400)],
        "c": [7.25], None: [1e-300, -1e300, 3.0, float("inf")], "d": [i / 1e9 for i in range(300)],
    }
    data = [(g, v) for g, values in groups.items() for v in values] + [("c", None), ("e", None)]
    df = spark.createDataFrame(data, "g string, v double").repartition(6)
    for q in (0.0, 0.37, 1.0):
        got = {r["g"]: (r["n"], r["threshold"]) for r in skew.exact_quantile(df, ["g"], "v", q).collect()}
        want = {}
        for g, values in groups.items():
            values, at = sorted(values), q * (len(values) - 1)
            low, part = values[math.floor(at)], at - math.floor(at)
            want[g] = (len(values), low + (values[math.ceil(at)] - low) * part if part else low)
        assert got == {g: (n, pytest.approx(v)) for g, (n, v) in want.items()}


def test_colocated_join_has_no_exchange(spark, tmp_path):
    from pyspark.sql import functions as F

    from rollforge.sources.colocated import ColocatedTable, attach_stored

    rows = [(1, "a"), (1, "b"), (2, "c"), (None, "d"), (7, "e")]
    a = ColocatedTable(spark, str(tmp_path / "a"), ["k"], 4).write(spark.createDataFrame(rows, "k int, v string"))
    stored = spark.createDataFrame([(1, 0.5), (2, None), (None, 9.0), (8, 1.0)], "k int, ref double")
    b = ColocatedTable(spark, str(tmp_path / "b"), ["k"], 4).write(stored)
    for df in (a.join(b), attach_stored(a, b)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "SortMergeJoin" in plan
    assert sorted(map(tuple, a.join(b).collect()), key=repr) == [(1, "a", 0.5), (1, "b", 0.5), (2, "c", None)]
    assert sorted(map(tuple, attach_stored(a, b).select("v", "ref", "stored").collect())) == [
        ("a", 0.5, True), ("b", 0.5, True), ("c", None, True), ("d", None, False), ("e", None, False)]
    b.forget()
    again = ColocatedTable(spark, str(tmp_path / "b"), ["k"], 4).open("k int, ref double")
    assert again.read().count() == 4
    twice = ColocatedTable(spark, str(tmp_path / "c"), ["k"], 4).write(stored.union(stored.where("k = 2")))
    with pytest.raises(Exception, match="repeated key 2"):
        attach_stored(a, twice).collect()
    with pytest.raises(ValueError, match="do not lie"):
        a.join(ColocatedTable(spark, str(tmp_path / "d"), ["k"], 8))
    assert attach_stored(a, b).where(F.col("k") == 3).count() == 0


def test_user_functions_are_checked(spark):
    from rollforge.operators import hatches, rewards

    df = spark.createDataFrame([(1, "p", "a b", "x"), (2, None, None, None)], "k int, prompt string, response string, answer string")

    def run(fn):
        return [r["reward_f"] for r in rewards.score(df, [rewards.RewardSpec("f", hatches.python_reward(fn))]).orderBy("k").collect()]

    assert run(lambda p, r, a: [None if x is None else 1 for x in r]) == [1.0, None]
    for wrong in (lambda p, r, a: [1.0], lambda p, r, a: ["x" for _ in r]):
        with pytest.raises(Exception, match="reward <lambda>"):
            if len(run(wrong)) == 2 and df.coalesce(1).count():  # one value may fit a batch of one row
                rewards.score(df.coalesce(1), [rewards.RewardSpec("f", hatches.python_reward(wrong))]).collect()
    made = hatches.format_batches(df, lambda b: [None if r is None else r.split() for r in b["response"]], ["response"], ["k"])
    assert sorted(map(tuple, made.collect())) == [(1, 0, "a"), (1, 1, "b")]
    with pytest.raises(Exception, match="metric: columns"):
        hatches.batch_metric(df, ["k"], ["prompt"], lambda b: b, {"n": ("bigint", "sum")}).collect()
    with pytest.raises(ValueError, match="unknown merge"):
        hatches.batch_metric(df, ["k"], ["prompt"], lambda b: b, {"n": ("bigint", "mean")})


def test_scans_are_dealt_out_by_their_rows(spark):
    from rollforge.sources import tables

    df = spark.range(0, 1000, 1, 8)
    assert tables.spread(df).rdd.getNumPartitions() == 8
    many = tables.spread(df, rows=30)
    assert many.rdd.getNumPartitions() == 34 and many.distinct().count() == 1000


def test_pivot_shuffles_once(spark):
    from rollforge.operators import reports as V

    rows = [(1, "a", 1.5), (1, "bb", 2.0), (2, "a", None), (2, "bb", 3.0), (None, "bb", 1.0)]
    p = V.pivot_rewards(spark.createDataFrame(rows, "k int, func string, value double"), ["k"], ["a", "bb", "c"])
    assert p._jdf.queryExecution().executedPlan().toString().count("hashpartitioning") == 1
    assert sorted(map(tuple, p.collect()), key=str) == [
        (1, 1.5, 2.0, None), (2, None, 3.0, None), (None, None, 1.0, None)]
