from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from rollforge.functions import numeric as N
from rollforge.operators import policy as Y
from rollforge.operators import prefs as D
from rollforge.operators import rewards as R
from rollforge.operators import runs as U
from rollforge.streaming import jobs as S
from rollforge.streaming.groups import group_results, group_results_to, timers_allowed


def test_stable_functions_at_extremes(spark):
    xs = [-800.0, -30.0, -1.0, 0.0, 1.0, 30.0, 800.0]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    x = F.col("x")
    out = df.select("x", N.log_sigmoid(x), N.sigmoid(x), N.softplus(x)).collect()
    for v, ls, s, sp in out:
        assert ls == pytest.approx(-np.logaddexp(0, -v)) and sp == pytest.approx(np.logaddexp(0, v))
        assert s == pytest.approx(math.exp(-np.logaddexp(0, -v)), abs=1e-12)


def pair(spark, **over):
    values = {"c": -1.0, "r": -3.0, "c0": -1.5, "r0": -2.0, **over}
    return spark.createDataFrame([(1, *values.values())], "pair_id int, " + ", ".join(f"{k} double" for k in values))


def test_pair_objectives_by_hand(spark):
    got = D.audit_rows(pair(spark), s=D.Settings(beta=0.5)).first()
    a, b = 0.5, -1.0
    h, sig = a - b, lambda x: 1 / (1 + math.exp(-x))
    assert got["loss_sigmoid"] == pytest.approx(-math.log(sig(0.5 * h)))
    assert got["loss_hinge"] == pytest.approx(max(0, 1 - 0.5 * h))
    assert got["loss_ipo"] == pytest.approx((h - 1) ** 2)
    assert got["loss_sppo_hard"] == pytest.approx((a - 1) ** 2 + (b + 1) ** 2)
    assert got["loss_apo_zero"] == pytest.approx(1 - sig(0.25) + sig(-0.5))
    assert got["loss_apo_down"] == pytest.approx(sig(0.25) + 1 - sig(0.75))
    with pytest.raises(ValueError):
        D.audit_rows(pair(spark), ["nothing"])


def test_odds_ratio_undefined_at_zero(spark):
    df = pair(spark, c=0.0).withColumn("nll", F.lit(1.0))
    assert D.odds_ratio(df).first()["log_odds"] is None


def test_jsd_with_missing_tokens(spark):
    rows = [("p", "s", 1, math.log(0.5)), ("p", "s", 2, math.log(0.5)), ("p", "t", 1, 0.0)]
    df = spark.createDataFrame(rows, "pos string, side string, token int, logp double")
    want = 0.5 * math.log(1 / 0.75) + 0.5 * (0.5 * math.log(0.5 / 0.75) + 0.5 * math.log(0.5 / 0.25))
    assert D.generalized_jsd(df, 0.5, "s", "t").first()["jsd"] == pytest.approx(want)
    assert D.generalized_jsd(df, 0.0, "s", "t").first()["jsd"] == pytest.approx(math.log(2))
    assert D.generalized_jsd(df, 1.0, "s", "t").first()["jsd"] == math.inf


def test_baseline_weights(spark):
    rows = [("r", 0, 1.0), ("r", 0, 3.0), ("r", 1, 8.0)]
    df = spark.createDataFrame(rows, "run_id string, step int, reward double")
    row = {r["step"]: r["delta"] for r in D.reward_baseline(df, "step", "reward", "per_row", ["run_id"]).collect()}
    batch = {r["step"]: r["delta"] for r in D.reward_baseline(df, "step", "reward", "per_batch", ["run_id"]).collect()}
    assert row == {0: 2.0, 1: 4.0} and batch == {0: 2.0, 1: 5.0}


def token_table(spark, n=40):
    rng = np.random.default_rng(3)
    rows = []
    for i in range(n):
        k = int(rng.integers(1, 30))
        r = [rng.normal(size=k).round(3).tolist() for _ in range(5)]
        rows.append(("r", 0, i, *r, [int(x) for x in rng.integers(0, 2, k)], float(rng.normal())))
    return rows, spark.createDataFrame(
        rows, "run_id string, step int, seq_id int, logps array<double>, old_logps array<double>, ref_logps array<double>,"
        " values array<double>, entropys array<double>, masks array<int>, advantage double")


def test_gae_equals_recursion(spark):
    rows, df = token_table(spark)
    out = {r["seq_id"]: r for r in Y.gae(df.withColumnRenamed("logps", "token_rewards"), gamma=0.97, lam=0.9).collect()}
    for r in rows:
        rewards, values, run, want = r[3], r[6], 0.0, []
        for t in reversed(range(len(rewards))):
            nxt = values[t + 1] if t + 1 < len(values) else 0.0
            run = rewards[t] + 0.97 * nxt - values[t] + 0.97 * 0.9 * run
            want.append(run)
        assert out[r[2]]["advantages"] == pytest.approx(want[::-1])
        assert out[r[2]]["returns"] == pytest.approx([a + v for a, v in zip(want[::-1], values)])


def test_policy_rows_by_hand(spark):
    rows, df = token_table(spark)
    out = {r["seq_id"]: r for r in Y.policy_rows(df, beta=0.1).collect()}
    for r in rows:
        new, old, ref, mask, adv = map(np.array, (r[3], r[4], r[5], r[8], r[9]))
        ratio = np.exp(np.clip(new - old, -20, 20))
        loss = -np.minimum(ratio * adv, np.clip(ratio, 0.8, 1.2) * adv) + 0.1 * (np.exp(ref - new) - (ref - new) - 1)
        assert out[r[2]]["loss_sum"] == pytest.approx(float((loss * mask).sum()))
        assert out[r[2]]["row_loss"] == pytest.approx(float((loss * mask).sum() / max(mask.sum(), 1)))
    kl = Y.k3_kl(df).agg(F.min("kl")).first()[0]
    assert kl >= 0
    with pytest.raises(ValueError):
        Y.reduce_policy_loss(Y.policy_rows(df), ["mean"])


def test_entropy_mask_and_whitening(spark):
    rows, df = token_table(spark)
    kept = [e for r in rows for e, m in zip(r[7], r[8]) if m]
    edge = np.quantile(kept, 0.8)
    for r in Y.top_entropy_mask(df, 0.2).collect():
        want = [int(e >= edge and m == 1) for e, m in zip(r["entropys"], r["masks"])]
        assert r["entropy_mask"] == want
    white = [v for r in Y.masked_whiten(df, "values").collect() for v, m in zip(r["values_white"], r["masks"]) if m]
    assert np.mean(white) == pytest.approx(0, abs=1e-9) and np.std(white, ddof=1) == pytest.approx(1, abs=1e-6)


def test_token_reward_position(spark):
    rows = [(1, [5, 6, 0, 0], 2.0), (2, [5, 6, 7, 8], 3.0), (3, [5, 0, 0, 0], 4.0)]
    df = spark.createDataFrame(rows, "seq_id int, token_ids array<bigint>, score double").withColumns({
        "logps": F.transform("token_ids", lambda x: F.lit(-1.0)), "ref_logps": F.transform("token_ids", lambda x: F.lit(-2.0))})
    out = {r["seq_id"]: r["token_rewards"] for r in Y.token_rewards(df, 0.5).collect()}
    assert out == {1: [-0.5, -0.5, 2.0, 0.0], 2: [-0.5, -0.5, -0.5, 2.5], 3: [-0.5, 4.0, 0.0, 0.0]}


@pytest.mark.parametrize("name", ["token_rewards", "token_rewards_k3"])
def test_token_rewards_are_computed_once(spark, tmp_path, name):
    """No filter on the rewards below the shuffle; orders without tokens (null keys, no length) have no rows, repeated ones come twice."""
    import __spark_entry__
    from rollforge.catalog.registry import rounded
    from rollforge.sources import tables as T

    rows = [(1, 3), (2, 4), (2, 4), (5, None), (None, 6), (None, None), (7, -17), (9, 0)]
    spark.createDataFrame(rows, "o_orderkey long, o_custkey long").write.parquet(f"{tmp_path}/orders.parquet")
    found = __spark_entry__.queries()[name](spark, str(tmp_path))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Filter ") == 1 and "Filter isnotnull(pos" in plan
    arrays = Y.token_rewards(T.sequences(spark, str(tmp_path)), 0.05, "k1" if name == "token_rewards" else "k3")
    want = arrays.select("seq_id", F.posexplode("token_rewards").alias("pos", "reward")).withColumn("reward", rounded("reward"))
    got = sorted(map(tuple, found.collect()), key=str)
    assert found.dtypes == want.dtypes and got == sorted(map(tuple, want.collect()), key=str)
    assert {r[0] for r in got} >= {1, 2, 9} and 5 not in {r[0] for r in got} and sum(r[:2] == (2, 0) for r in got) == 2


def test_run_summary_series(spark):
    rows = [(1, s, n, v) for s in range(5) for n, v in (("loss", 1.0 - 0.1 * s), ("reward", 0.5 + 0.1 * s))]
    df = spark.createDataFrame(rows, "run_id int, step int, name string, value double")
    r = U.run_summary(df, "loss", "reward", "step").first()
    assert [round(r[c], 6) for c in ("loss_last", "loss_mean", "loss_min", "reward_mean", "reward_max", "reward_min")] == [
        0.6, 0.8, 0.6, 0.7, 0.9, 0.5]


def test_user_metrics(spark):
    df = spark.createDataFrame([("a", 1.0, 0.5), ("a", 0.0, 2.0)], "k string, chosen double, rejected double")
    out = U.compute_metrics(df, ["k"], {"accuracy": F.avg((F.col("chosen") > F.col("rejected")).cast("double"))})
    assert out.collect() == [("a", 0.5)]


def test_histogram_keeps_the_maximum(spark):
    df = spark.createDataFrame([("a", float(v)) for v in range(101)] + [("b", 1.0)], "k string, v double")
    out = U.histogram(df, ["k"], "v")
    assert out.groupBy("k").agg(F.sum("n").alias("n"), F.max("bin").alias("b")).orderBy("k").collect() == [("a", 101, 20), ("b", 1, 1)]


# ---------------------------------------------------------------- streaming

def metric_files(spark, folder, batches):
    for i, rows in enumerate(batches):
        df = spark.createDataFrame(rows, "ts string, name string, value double").withColumn("ts", F.to_timestamp("ts"))
        df.coalesce(1).write.mode("append").parquet(str(folder))


def test_stream_windows_over_several_batches_equal_batch(spark, tmp_path):
    src = tmp_path / "src"
    metric_files(spark, src, [
        [("2024-01-01 00:01:00", "loss", 1.0), ("2024-01-01 00:04:00", "loss", 3.0)],
        [("2024-01-01 00:09:00", "loss", 5.0), ("2024-01-01 00:21:00", "kl", 2.0)],
    ])
    schema = spark.read.parquet(str(src)).schema
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(src))
    out = S.run_update(S.metric_windows(stream), "t", ["start", "end", "name"])
    got = sorted((str(r["start"]), r["name"], r["avg"], r["n"]) for r in out.collect())
    batch = spark.read.parquet(str(src)).groupBy(F.window("ts", "10 minutes").alias("w"), "name").agg(
        F.avg("value").alias("a"), F.count("value").alias("n"))
    assert got == sorted((str(r["w"]["start"]), r["name"], r["a"], r["n"]) for r in batch.collect())


def put(spark, folder, rows, schema):
    spark.createDataFrame(rows, schema).withColumn("ts", F.to_timestamp("ts")).coalesce(1).write.mode("append").parquet(str(folder))


def test_stream_groups_complete_expire_and_late(spark, tmp_path):
    schema = "run_id string, prompt_id int, ts timestamp, reward double, n int"
    held = []

    def drain(rows):
        put(spark, tmp_path / "src", rows, schema.replace("timestamp", "string"))
        with timers_allowed(spark):
            stream = group_results(spark.readStream.schema(schema).parquet(str(tmp_path / "src")), ["run_id", "prompt_id"])
            query = S.update_to(stream, str(tmp_path / "out"), str(tmp_path / "state"))
            query.awaitTermination()
        held.append(query.recentProgress[-1]["stateOperators"][0]["numRowsTotal"])

    def results():
        return sorted((r["kind"], r["prompt_id"], r["seen"], r["expected"], r["mean"], r["std"])
                      for r in spark.read.parquet(str(tmp_path / "out")).collect())

    drain([("r", 1, "2024-01-01 00:00:00", 1.0, 2), ("r", 2, "2024-01-01 00:00:00", 1.0, 3), ("r", 3, "2024-01-01 00:00:00", None, 1)])
    assert results() == [("complete", 3, 1, 1, None, None)]
    drain([("r", 1, "2024-01-01 00:10:00", 3.0, 2), ("r", 2, "2024-01-01 00:20:00", None, 3)])
    done = ("complete", 1, 2, 2, 2.0, pytest.approx(2 ** 0.5))
    assert results() == [done, ("complete", 3, 1, 1, None, None)]
    # within the day that groups wait: nothing leaves; a sample behind the watermark is late
    drain([("r", 9, "2024-01-01 12:00:00", 0.0, 1)])
    drain([("r", 2, "2024-01-01 00:30:00", 5.0, 3), ("r", 2, "2024-01-01 00:40:00", 5.0, 3)])
    assert ("late", 2, 2, None, None, None) in results() and not [r for r in results() if r[0] == "expired"]
    # the clock passes the timer: the group leaves once, with what it had
    drain([("r", 8, "2024-01-05 00:00:00", 2.0, 2)])
    drain([("r", 8, "2024-01-05 00:00:01", 4.0, 2)])
    assert [r for r in results() if r[0] == "expired"] == [("expired", 2, 2, 3, 1.0, None)]
    assert sum(r[0] == "complete" for r in results()) == 4 and len(results()) == 6
    # state: groups 1 and 2, then 2 alone, then the open one, then none
    assert held[0] > held[1] >= held[2] > 0 and held[-1] == 0


def test_stream_score_equals_batch(spark, tmp_path):
    rows = [(i, f"<answer>{i % 3}</answer>", "1") for i in range(20)]
    df = spark.createDataFrame(rows, "i int, response string, answer string")
    df.repartition(3).write.parquet(str(tmp_path / "src"))
    stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "src"))
    got = S.run_append(S.score(stream, R.STANDARD), "s").select("i", "reward")
    want = R.combine(R.score(df, R.STANDARD), R.STANDARD).select("i", "reward")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


@pytest.mark.parametrize("broadcast", [True, False])
def test_stream_unique_prompts(spark, tmp_path, monkeypatch, broadcast):
    from rollforge.plans import skew

    if not broadcast:
        monkeypatch.setattr(skew, "BROADCAST_ROWS", 0)
    schema = "prompt string, ts timestamp, v int"

    def drain(rows):
        put(spark, tmp_path / "src", rows, schema.replace("timestamp", "string"))
        stream = spark.readStream.schema(schema).parquet(str(tmp_path / "src"))
        query = S.unique_to(stream, str(tmp_path / "out"), str(tmp_path / "state"))
        query.awaitTermination()
        assert not query.recentProgress[-1]["stateOperators"]

    drain([("a", "2024-01-02 00:00:00", 2), ("a", "2024-01-01 00:00:00", 1), ("b", "2024-01-01 00:00:00", 3), (None, "2024-01-01 00:00:00", 4)])
    # years apart and out of order
    drain([("a", "2034-01-01 00:00:00", 5), ("c", "2034-01-01 00:00:00", 6), ("", "2034-01-01 00:00:00", 7)])
    drain([("b", "2004-01-01 00:00:00", 8), (None, "2044-01-01 00:00:00", 9), ("", "2044-01-01 00:00:00", 9), ("c", "2044-01-01 00:00:00", 9)])
    got = spark.read.parquet(str(tmp_path / "out")).collect()
    assert sorted((r["v"], r["prompt"]) for r in got) == [(1, "a"), (3, "b"), (4, None), (6, "c"), (7, "")]


def test_objectives_on_raw_ratios(spark):
    """``sppo_hard``, ``nca_pair`` and ``discopop`` by hand, reference-free."""
    df = spark.createDataFrame([(-1.0, -2.0, -1.5, -1.8)], "c double, r double, c0 double, r0 double")
    s = D.Settings(0.1, reference_free=True)
    row = D.audit_rows(df, ("sppo_hard", "nca_pair", "discopop", "hinge"), s).first()
    assert row["loss_sppo_hard"] == pytest.approx((0.5 - 5) ** 2 + (-0.2 + 5) ** 2)
    sp = lambda x: math.log1p(math.exp(x))
    assert row["loss_nca_pair"] == pytest.approx(sp(-0.05) + 0.5 * sp(0.05) + 0.5 * sp(-0.02), abs=1e-6)
    m = 1 / (1 + math.exp(-0.07 / 0.05))
    assert row["loss_discopop"] == pytest.approx(sp(-0.07) * (1 - m) + math.exp(-0.07) * m)
    assert row["loss_hinge"] == pytest.approx(0.9)


def test_running_means_are_per_run(spark):
    rows = [("a", 0, 0.0, 0.0, -1.0, -1.0), ("b", 0, -10.0, -10.0, 0.0, 0.0)]
    df = spark.createDataFrame(rows, "run_id string, step int, c double, r double, c0 double, r0 double")
    got = {r["run_id"]: r["delta"] for r in D.audit_running_baseline(df, keys=["run_id"]).collect()}
    assert got == {"a": pytest.approx(0.1), "b": pytest.approx(-1.0)}


def test_mix_with_batch_objectives(spark):
    rows = [(0, -1.0, -2.0, -1.5, -1.8, 4, 5), (0, -2.0, -1.0, -2.5, -0.8, 2, 3), (1, -3.0, -1.0, -2.0, -1.5, 6, 2)]
    df = spark.createDataFrame(rows, "step int, c double, r double, c0 double, r0 double, n_c int, n_r int")
    got = sorted(r["loss"] for r in D.audit_mix(df, {"sft": 0.5, "bco_pair": 1.0, "hinge": 2.0}).collect())
    sp = lambda x: math.log1p(math.exp(x))
    rewards = {s: [0.1 * v for t, c, r, c0, r0, *_ in rows if t == s for v in (c - c0, r - r0)] for s in (0, 1)}
    means = {s: sum(v) / len(v) for s, v in rewards.items()}
    delta = {0: means[0], 1: (means[0] + means[1]) / 2}
    sft = {0: 3.0 / 6, 1: 3.0 / 6}
    want = []
    for t, c, r, c0, r0, *_ in rows:
        a, b = 0.1 * (c - c0), 0.1 * (r - r0)
        want.append(0.5 * sft[t] + sp(-(a - delta[t])) + sp(-(delta[t] - b)) + 2 * max(0, 1 - (a - b)))
    assert got == pytest.approx(sorted(want))


def test_density_ratio_is_regularised(spark):
    """Separable classes: the score equations with the L2 term hold."""
    rows = [(i, [float(i)], i >= 10) for i in range(20)]
    df = spark.createDataFrame(rows, "k int, v array<double>, label boolean")
    weights, accuracy = D.density_ratio_weights(df, "k", "v", "label")
    p = {r["k"]: r["p"] for r in weights.collect()}
    w0 = math.log(p[9] / (1 - p[9])) - math.log(p[8] / (1 - p[8]))
    b = math.log(p[9] / (1 - p[9])) - 9 * w0
    gradient = sum((1 / (1 + math.exp(-(b + w0 * x))) - (x >= 10)) * x for x in range(20)) + w0
    assert abs(gradient) < 1e-2 and min(p.values()) > 1e-8 and {r["accuracy"] for r in accuracy.collect()} == {1.0}


def test_stream_groups_by_join_equal_groups_by_state(spark, tmp_path):
    """Both ways over one stream: groups that grow, complete, open again, expire on either side of the clock, come late."""
    schema = "run_id string, prompt_id int, ts timestamp, reward double, n int"
    day = "2024-01-0{} {}".format
    waves = [
        [("r", 1, day(1, "00:00:00"), 1.0, 3), ("r", 2, day(1, "00:00:00"), 1.0, 2), ("r", 2, day(1, "00:10:00"), 4.0, 2),
         (None, 3, day(1, "00:20:00"), None, 2), ("r", 4, day(1, "00:59:59.500"), 0.5, 9), ("r", 5, day(1, "01:00:00"), None, None)],
        [("r", 1, day(1, "00:30:00"), None, 3), (None, 3, day(1, "00:05:00"), 2.0, 5), ("r", 2, day(1, "02:00:00"), 8.0, 2),
         ("r", 4, day(1, "01:30:00"), 2.5, 9), ("r", 4, day(1, "01:40:00"), 7.0, 9)],
        [("r", 1, day(1, "00:40:00"), 3.0, 3), ("r", 1, day(1, "01:10:00"), 9.0, 3), ("r", 6, day(2, "01:59:59.500"), 1.0, 2)],
        [("r", 7, day(2, "01:59:59.501"), 1.0, 2), ("r", 4, day(2, "01:00:00"), 1.0, 9)],
        [("r", 8, day(5, "00:00:00"), 1.0, 1)],
    ]

    def rows(out):
        found = spark.read.parquet(str(tmp_path / out)).drop("batch_id").collect()
        return sorted((tuple(r[c] for c in ("kind", "run_id", "prompt_id", "seen", "expected", "mean", "std")) for r in found), key=str)

    for wave in waves:
        put(spark, tmp_path / "src", wave, schema.replace("timestamp", "string"))
        stream = spark.readStream.schema(schema).parquet(str(tmp_path / "src"))
        with timers_allowed(spark):
            S.update_to(group_results(stream, ["run_id", "prompt_id"]), str(tmp_path / "a"), str(tmp_path / "a_state")).awaitTermination()
        group_results_to(stream, str(tmp_path / "b"), str(tmp_path / "b_state"), ["run_id", "prompt_id"]).awaitTermination()
        want, got = rows("a"), rows("b")
        assert [r[:5] for r in got] == [r[:5] for r in want]
        assert [r[5:] for r in got] == [tuple(v if v is None else pytest.approx(v) for v in r[5:]) for r in want]
    assert {r[0] for r in rows("b")} == {"complete", "expired", "late"}


def test_token_arrays_are_computed_once_a_row(spark):
    """No lambda over the tokens of a row holds the expression of another derived array."""
    df = spark.range(1, 4).select("id", F.lit(2.0).alias("score"), *[
        F.transform(F.sequence(F.lit(0).cast("bigint"), F.col("id") + 6), lambda i: v).alias(c) for c, v in (
            ("token_ids", F.col("id")), ("logps", F.col("id") * -1.0), ("ref_logps", F.col("id") * -2.0), ("old_logps", F.col("id") * -1.0),
            ("values", F.col("id") * 0.5), ("masks", F.lit(1)))])
    rewards = Y.token_rewards(df, 0.5)
    sums = Y.policy_rows(df.withColumn("advantage", F.lit(1.0)), beta=0.1, level="sequence")
    for found in (rewards.select("token_rewards"), Y.gae(rewards).select("advantages"), sums.select("loss_sum")):
        plan = found._jdf.queryExecution().optimizedPlan().toString()
        assert "sequence(" in plan and "get(transform(sequence(" not in plan
    assert [r[0] for r in rewards.orderBy("id").select("token_rewards").collect()] == [[-0.5 * i] * (6 + i) + [2.0 - 0.5 * i] for i in (1, 2, 3)]


def test_gae_takes_derived_columns(spark):
    """Rewards and values that hold lambdas in lambdas, alone or with other columns; null and empty arrays."""
    rows = [(1, [1.0, -2.0, 0.5], [0.5, 0.25, 1.0, 4.0]), (2, [], []), (3, None, [1.0]), (4, [1.0], None), (5, [1.0, 2.0], [None, 0.5]), (6, [3.0], [1.0])]
    df = spark.createDataFrame(rows, "seq_id int, r array<double>, v array<double>").coalesce(1)

    def same(c):
        return N.bound({"a": F.col(c), "zero": F.lit(0.0)}, lambda row: F.transform(
            row["a"], lambda x, i: x * 1.0 + row["zero"] * i + F.coalesce(F.get(row["a"], i + 1), F.lit(0.0)) * 0.0))

    want = {1: [0.5 + 0.9 * 0.25 + 0.72 * (-2.25 + 0.9 + 0.72 * (-0.5 + 0.9 * 4.0)), -2.25 + 0.9 + 0.72 * (-0.5 + 0.9 * 4.0), -0.5 + 0.9 * 4.0],
            2: [], 3: None, 4: [None], 5: [None, 1.5], 6: [2.0]}
    for columns in ({}, {"r": same("r")}, {"v": same("v")}, {"r": same("r"), "v": same("v")}):
        out = Y.gae(df.withColumns(columns), "r", "v", gamma=0.9, lam=0.8)
        assert out.columns == ["seq_id", "r", "v", "advantages", "returns"]
        for found in (out, out.select("seq_id", "advantages")):
            got = {x["seq_id"]: x["advantages"] for x in found.collect()}
            assert got == {k: a if a is None else [x if x is None else pytest.approx(x) for x in a] for k, a in want.items()}
    logps = df.select("seq_id", F.col("r").alias("logps"), F.col("r").alias("ref_logps"), F.col("v").alias("values"),
                      F.array(*[F.lit(i).cast("bigint") for i in (5, 2, 0)]).alias("token_ids"), F.lit(1.5).alias("score"))
    found = Y.gae(Y.token_rewards(logps)).select(F.get("advantages", F.lit(2)).alias("third")).collect()
    assert [x["third"] for x in found if x["third"] is not None] == [1.5 + 4.0 - 1.0]
