"""Queries: group statistics, advantages and pass@k evaluation."""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F

from rollforge.catalog.registry import q, query, rounded, sql_normal, sql_tagged
from rollforge.catalog.text_rewards import SQL_REWARD
from rollforge.operators import evalk as E
from rollforge.operators import groups as G
from rollforge.operators import hatches
from rollforge.operators import joins as J
from rollforge.operators import rewards as R
from rollforge.operators import runs as U
from rollforge.plans.storage import materialize, scratch_path
from rollforge.sources import tables as T
from rollforge.sources.colocated import ColocatedTable, attach_stored

SPECS = list(R.STANDARD)
_SUM = " + ".join(f"({SQL_REWARD[f]})" for f in ("correctness", "digit", "format_partial", "marks"))
REWARDED_SQL = f"rewarded AS (SELECT *, {_SUM} AS reward FROM rollouts)"
_G, _B = "run_id, step, prompt_id", "run_id, step"
ROW = ("run_id", "step", "prompt_id", "sample_idx")
_ROW = "run_id, step, prompt_id, sample_idx"


def rewarded(spark, sf):
    return R.combine(R.score(T.rollouts(spark, sf), SPECS), SPECS).select(
        "run_id", "step", "epoch", "prompt_id", "sample_idx", "reward")


def scored_once(spark, sf):
    """Rewards as a written narrow table, for jobs that read them twice (for
    the group figures and for the rows): response text is read once."""
    return materialize(rewarded(spark, sf).drop("epoch"), "scored")


_Z_SQL = (f"z AS (SELECT {_ROW}, reward, (reward - avg(reward) OVER g) / (CASE WHEN stddev_samp(reward) OVER g = 0"
          f" THEN 1e0 ELSE stddev_samp(reward) OVER g END + 1e-8) AS advantage FROM rewarded"
          f" WINDOW g AS (PARTITION BY {_G}))")


@query("group_reward_stats", uses=["rollouts"], ctes=REWARDED_SQL, sql=f"""
SELECT {_G}, count(reward) AS n, {q('avg(reward)', 'mean')}, {q('stddev_samp(reward)', 'std')},
 {q('min(reward)', 'min')}, {q('max(reward)', 'max')} FROM rewarded GROUP BY {_G}""")
def _(spark, sf):
    s = G.stats(rewarded(spark, sf), G.GROUP)
    return s.select(*G.GROUP, "n", *[rounded(c) for c in ("mean", "std", "min", "max")])


@query("batch_reward_stats", uses=["rollouts"], ctes=f"{REWARDED_SQL}, {_Z_SQL}", sql=f"""
SELECT {_B}, {q('avg(reward)', 'reward_mean')}, {q('stddev_samp(reward)', 'reward_std')},
 {q('min(reward)', 'reward_min')}, {q('max(reward)', 'reward_max')},
 {q('avg(advantage)', 'advantage_mean')}, {q('stddev_samp(advantage)', 'advantage_std')} FROM z GROUP BY {_B}""")
def _(spark, sf):
    s = G.batch_reward_stats(G.group_z(scored_once(spark, sf)))
    return s.select(*G.BATCH, *[rounded(c) for c in s.columns if c not in G.BATCH])


@query("epoch_rewards", uses=["rollouts"], ctes=REWARDED_SQL, sql=f"""
SELECT run_id, epoch, {q('sum(reward)', 'reward_sum')}, {q('avg(reward)', 'reward_mean')}, count(reward) AS n
FROM rewarded GROUP BY run_id, epoch""")
def _(spark, sf):
    s = G.epoch_rewards(rewarded(spark, sf))
    return s.select("run_id", "epoch", rounded("reward_sum"), rounded("reward_mean"), "n")


_LONG_SQL = "longr AS (" + " UNION ALL ".join(
    f"SELECT {_B}, '{n}' AS func, {e} AS value FROM rollouts" for n, e in
    [("correctness", SQL_REWARD["correctness"]), ("digit", SQL_REWARD["digit"]),
     ("format", SQL_REWARD["format_partial"]), ("marks", SQL_REWARD["marks"]),
     ("tagged_digit", f"CASE WHEN contains(response, '<answer>') THEN {SQL_REWARD['digit']} END")]) + ")"


@query("reward_func_summary", uses=["rollouts"], ctes=_LONG_SQL, sql=f"""
SELECT {_B}, func, {q('avg(value)', 'mean')}, {q('stddev_samp(value)', 'std')}, count(value) AS applied
FROM longr GROUP BY {_B}, func""")
def _(spark, sf):
    from rollforge.catalog.text_rewards import MIXED, scored

    s = G.func_summary(R.long_rewards(scored(spark, sf), MIXED, G.BATCH))
    return s.select(*G.BATCH, "func", rounded("mean"), rounded("std"), "applied")


@query("reward_overall_summary", uses=["rollouts"], ctes=f"""{REWARDED_SQL},
g AS (SELECT {_G}, avg(reward) AS m, stddev_samp(reward) AS s FROM rewarded GROUP BY {_G})""", sql=f"""
SELECT {_B}, {q('avg(m)', 'reward')}, {q('avg(s)', 'reward_std')},
 {q('avg(CAST(abs(s) <= 1e-8 AS DOUBLE))', 'frac_zero_std')} FROM g GROUP BY {_B}""")
def _(spark, sf):
    s = G.overall_summary(rewarded(spark, sf))
    return s.select(*G.BATCH, rounded("reward"), rounded("reward_std"), rounded("frac_zero_std"))


@query("advantage_group_z", uses=["rollouts"], ctes=f"{REWARDED_SQL}, {_Z_SQL}",
       sql=f"SELECT {_ROW}, {q('advantage', 'advantage')} FROM z")
def _(spark, sf):
    return G.group_z(scored_once(spark, sf)).select(*ROW, rounded("advantage"))


_ZERO = "abs(stddev_samp(reward) OVER {w}) <= 1e-8 AS zero_std"


def _scaled_query(scale: str) -> None:
    centred = "(reward - avg(reward) OVER g)"
    expr = {"group": f"{centred} / (stddev_samp(reward) OVER g + 1e-4)",
            "batch": f"{centred} / (stddev_samp(reward) OVER b + 1e-4)", "none": centred}[scale]
    zero = _ZERO.format(w="b" if scale == "batch" else "g")

    @query("advantage_scaled" if scale == "group" else f"advantage_scaled_{scale}", uses=["rollouts"],
           ctes=REWARDED_SQL, sql=f"SELECT {_ROW}, {q(expr, 'advantage')}, {zero} FROM rewarded"
           f" WINDOW g AS (PARTITION BY {_G}), b AS (PARTITION BY {_B})")
    def _(spark, sf):
        return G.scaled(scored_once(spark, sf), scale).select(*ROW, rounded("advantage"), "zero_std")


for _scale in ("group", "batch", "none"):
    _scaled_query(_scale)


@query("advantage_batch_z", uses=["rollouts"], ctes=REWARDED_SQL, sql=f"""
SELECT {_ROW}, {q('''(reward - avg(reward) OVER b) / (CASE WHEN stddev_samp(reward) OVER b = 0 THEN 1e0
 ELSE stddev_samp(reward) OVER b END + 1e-8)''', 'advantage')} FROM rewarded WINDOW b AS (PARTITION BY {_B})""")
def _(spark, sf):
    return G.batch_z(scored_once(spark, sf)).select(*ROW, rounded("advantage"))


_LOO = "CASE WHEN count(reward) OVER g > 1 THEN reward - (sum(reward) OVER g - reward) / (count(reward) OVER g - 1) END"


@query("advantage_rloo", uses=["rollouts"], ctes=REWARDED_SQL,
       sql=f"SELECT {_ROW}, {q(_LOO, 'advantage')} FROM rewarded WINDOW g AS (PARTITION BY {_G})")
def _(spark, sf):
    return G.leave_one_out(scored_once(spark, sf)).select(*ROW, rounded("advantage"))


@query("advantage_whiten", uses=["rollouts"], ctes=f"""{REWARDED_SQL},
l AS (SELECT {_ROW}, {_LOO} AS a FROM rewarded WINDOW g AS (PARTITION BY {_G}))""", sql=f"""
SELECT {_ROW}, {q('(a - avg(a) OVER b) / (stddev_samp(a) OVER b + 1e-4)', 'whitened')} FROM l
WINDOW b AS (PARTITION BY {_B})""")
def _(spark, sf):
    return G.whiten(G.leave_one_out(scored_once(spark, sf))).select(*ROW, rounded("whitened"))


# --------------------------------------------------------------- evaluation

GRADED_SQL = (f"graded AS (SELECT run_id, epoch, question_id, sample_idx, decode, {sql_normal('given')} AS given,"
              f" {sql_normal('truth')} AS truth, CAST({sql_normal('given')} = {sql_normal('truth')} AS INT) AS hit"
              f" FROM (SELECT *, {sql_tagged('response')} AS given FROM eval_rollouts))")


def _hit(k: int, fn: str = "max") -> str:
    return f"coalesce({fn}(CASE WHEN decode = 'sample' AND sample_idx < {k} THEN hit END), 0)"


PERQ_SQL = f"""perq AS (SELECT run_id, epoch, question_id,
 coalesce(max(CASE WHEN decode = 'greedy' THEN hit END), 0) AS pass_1, {_hit(5)} AS pass_5, {_hit(10)} AS pass_10,
 {_hit(5, 'sum')}::BIGINT AS correct_in_5, {_hit(10, 'sum')}::BIGINT AS correct_in_10,
 max(CASE WHEN decode = 'greedy' THEN given END) AS greedy_answer, max(truth) AS truth
 FROM graded GROUP BY run_id, epoch, question_id)"""
_EVAL = dict(uses=["eval_rollouts"], ctes=f"{GRADED_SQL}, {PERQ_SQL}")
_PASS = (f"SELECT run_id, epoch, {q('avg(pass_1)', 'pass_at_1')}, {q('avg(pass_5)', 'pass_at_5')},"
         f" {q('avg(pass_10)', 'pass_at_10')}, count(*) AS questions FROM perq GROUP BY run_id, epoch")


def graded(spark, sf):
    return E.grade(T.eval_rollouts(spark, sf))


def _passes(spark, sf):
    p = E.pass_at_k(graded(spark, sf))
    return p.select("run_id", "epoch", *[rounded(f"pass_at_{k}") for k in (1, 5, 10)], "questions")


query("pass_at_k", sql=_PASS, **_EVAL)(_passes)


@query("pass_at_k_detail", sql="""
SELECT p.*, coalesce(a.answers, '') AS sampled_answers FROM perq p LEFT JOIN (
 SELECT run_id, epoch, question_id, string_agg(given, ',' ORDER BY sample_idx) AS answers FROM graded
 WHERE decode = 'sample' AND sample_idx < 10 GROUP BY run_id, epoch, question_id) a
 ON p.run_id = a.run_id AND p.epoch = a.epoch AND p.question_id = a.question_id""", **_EVAL)
def _(spark, sf):
    return E.detail(graded(spark, sf)).withColumn("sampled_answers", F.array_join("sampled_answers", ","))


@query("pass_at_k_sanity", uses=["eval_rollouts"], ctes=f"{GRADED_SQL}, {PERQ_SQL}, p AS ({_PASS})",
       sql="SELECT run_id, epoch, pass_at_1, pass_at_5, pass_at_10 FROM p WHERE pass_at_1 > pass_at_5 OR pass_at_5 > pass_at_10")
def _(spark, sf):
    p = E.order_violations(E.pass_at_k(graded(spark, sf)))
    return p.select("run_id", "epoch", *[rounded(f"pass_at_{k}") for k in (1, 5, 10)])


@query("answer_diversity", sql="""
SELECT run_id, epoch, question_id, count(DISTINCT given) AS distinct_answers, count(DISTINCT given) = 1 AS all_same
FROM graded WHERE decode = 'sample' AND sample_idx < 10 GROUP BY run_id, epoch, question_id""", **_EVAL)
def _(spark, sf):
    return E.diversity(graded(spark, sf))


@query("answer_same_as_greedy", sql=f"""
SELECT run_id, epoch, {q('avg(CAST(pass_5 = pass_1 AS DOUBLE))', 'same_share')} FROM perq GROUP BY run_id, epoch""", **_EVAL)
def _(spark, sf):
    return E.same_as_greedy(graded(spark, sf)).withColumn("same_share", rounded("same_share"))


@query("answer_transitions", uses=["eval_rollouts"], ctes=f"""{GRADED_SQL}, {PERQ_SQL},
t AS (SELECT run_id, question_id, epoch, greedy_answer, pass_1, lag(greedy_answer) OVER w AS b, lag(pass_1) OVER w AS rb
 FROM perq WINDOW w AS (PARTITION BY run_id, question_id ORDER BY epoch)),
c AS (SELECT *, coalesce(b IS NOT NULL AND b <> greedy_answer, false) AS changed FROM t)""", sql="""
SELECT run_id, question_id, epoch, greedy_answer, pass_1, changed, coalesce(rb = 0 AND pass_1 = 1, false) AS became_right,
 coalesce(rb = 1 AND pass_1 = 0, false) AS became_wrong,
 epoch - coalesce(max(CASE WHEN changed THEN epoch END) OVER w, min(epoch) OVER w) AS stuck_for
FROM c WINDOW w AS (PARTITION BY run_id, question_id ORDER BY epoch)""")
def _(spark, sf):
    return E.transitions(graded(spark, sf))


@query("sample_trend", sql="""
SELECT run_id, question_id, epoch, correct_in_5, correct_in_10, correct_in_5 - lag(correct_in_5) OVER w AS delta_5,
 correct_in_10 - lag(correct_in_10) OVER w AS delta_10
FROM perq WINDOW w AS (PARTITION BY run_id, question_id ORDER BY epoch)""", **_EVAL)
def _(spark, sf):
    return E.sample_trend(graded(spark, sf))


@query("baseline_vs_epoch", sql="""
SELECT run_id, question_id, epoch, pass_1 - base_1 AS delta_1, pass_10 - base_10 AS delta_10 FROM (
 SELECT *, max(CASE WHEN epoch = 0 THEN pass_1 END) OVER w AS base_1, max(CASE WHEN epoch = 0 THEN pass_10 END) OVER w AS base_10
 FROM perq WINDOW w AS (PARTITION BY run_id, question_id)) WHERE epoch <> 0 AND base_1 IS NOT NULL""", **_EVAL)
def _(spark, sf):
    return E.baseline_vs_epoch(graded(spark, sf))


@query("user_metric_batches", uses=["rollouts"], ctes=REWARDED_SQL, sql=f"""
SELECT run_id, step, count(reward) AS n, {q('sum(reward * reward)', 'squares')}, {q('max(reward)', 'best')} FROM rewarded GROUP BY run_id, step""")
def _(spark, sf):
    def partial(batch):
        rows = pa.table({**{c: batch.column(c) for c in ("run_id", "step", "reward")}})
        rows = rows.append_column("square", pc.multiply(rows["reward"], rows["reward"]))
        found = rows.group_by(["run_id", "step"]).aggregate([("reward", "count"), ("square", "sum"), ("reward", "max")])
        found = found.rename_columns({"reward_count": "n", "square_sum": "squares", "reward_max": "best"})
        return found.combine_chunks().to_batches()[0]

    parts = {"n": ("bigint", "sum"), "squares": ("double", "sum"), "best": ("double", "max")}
    found = hatches.batch_metric(rewarded(spark, sf), ["run_id", "step"], ["reward"], partial, parts)
    return found.select("run_id", "step", "n", rounded("squares"), rounded("best"))


# -------------------------------------------------------------------- joins

@query("join_answers", uses=["rollouts", "prompts"], sql="""
SELECT r.prompt_id, r.sample_idx, p.answer, p.prompt FROM rollouts r JOIN prompts p ON r.prompt_id = p.prompt_id""")
def _(spark, sf):
    r = T.rollouts(spark, sf).select("prompt_id", "sample_idx")
    return J.join_answers(r, T.prompts(spark, sf)).select("prompt_id", "sample_idx", "answer", "prompt")


@query("join_answers_check", uses=["rollouts"], ctes="known AS (SELECT DISTINCT l_orderkey AS prompt_id FROM lineitem)",
       sql="""SELECT count(*) AS rows, count(*) FILTER (WHERE k.prompt_id IS NULL) AS without_prompt
FROM rollouts r LEFT JOIN known k ON r.prompt_id = k.prompt_id""")
def _(spark, sf):
    known = T.read(spark, sf, "lineitem").select(F.col("l_orderkey").alias("prompt_id"))  # some orders have no line
    return J.unmatched(T.rollouts(spark, sf).select("prompt_id"), known, "prompt_id")


@query("attach_stored_logps", uses=["pair_logps"], ctes="""
stored AS (SELECT l_orderkey AS pair_id, count(*) AS n, -sum(l_tax * 10e0) - 1e-2 AS ref FROM lineitem GROUP BY l_orderkey)""", sql=f"""
SELECT a.pair_id, b.pair_id IS NOT NULL AS stored, {q('a.c - b.ref', 'ratio')} FROM pair_logps a LEFT JOIN stored b ON a.pair_id = b.pair_id""")
def _(spark, sf):
    """Two tables written apart, the second without some keys, joined bucket by bucket."""
    lines = T.read(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("pair_id")).agg(
        (-F.sum(F.col("l_tax") * 10) - 0.01).alias("ref"))
    rows = ColocatedTable(spark, scratch_path(spark, "rows"), ["pair_id"]).write(T.pair_logps(spark, sf).select("pair_id", "c"))
    refs = ColocatedTable(spark, scratch_path(spark, "refs"), ["pair_id"]).write(lines)
    return attach_stored(rows, refs).select("pair_id", "stored", rounded(F.col("c") - F.col("ref"), "ratio"))


@query("attach_ref_logps", uses=["pair_logps"], sql=f"""
SELECT a.pair_id, {q('a.c - b.c0', 'chosen_ratio')}, {q('a.r - b.r0', 'rejected_ratio')}
FROM pair_logps a JOIN pair_logps b ON a.pair_id = b.pair_id""")
def _(spark, sf):
    p = T.pair_logps(spark, sf)
    joined = J.attach_required(p.select("pair_id", "c", "r"), p.select("pair_id", "c0", "r0"), "pair_id")
    return joined.select("pair_id", rounded(F.col("c") - F.col("c0"), "chosen_ratio"),
                         rounded(F.col("r") - F.col("r0"), "rejected_ratio"))


@query("reward_extra_column", uses=["rollouts"], sql=f"""
SELECT {_ROW}, {q("CASE WHEN length(response) <= 20 + step % 7 THEN 1e0 ELSE 0e0 END", 'reward_budget')} FROM rollouts""")
def _(spark, sf):
    def budget(prompt, response, answer, step):
        return F.when(F.length(response) <= 20 + step % 7, 1.0).otherwise(0.0)

    spec = R.RewardSpec("budget", budget, extra=("step",))
    return R.score(T.rollouts(spark, sf), [spec]).select(*ROW, rounded("reward_budget"))


@query("user_metrics", uses=["rollouts"], ctes=REWARDED_SQL, sql=f"""
SELECT run_id, step, {q('avg(CASE WHEN reward > 1 THEN 1e0 ELSE 0e0 END)', 'good_share')}, count(DISTINCT prompt_id) AS prompts
FROM rewarded GROUP BY run_id, step""")
def _(spark, sf):
    metrics = {
        "good_share": F.avg(F.when(F.col("reward") > 1, 1.0).otherwise(0.0)), "prompts": F.countDistinct("prompt_id"),
    }
    found = U.compute_metrics(rewarded(spark, sf), ["run_id", "step"], metrics)
    return found.withColumn("good_share", rounded("good_share"))


@query("concat_columns", uses=["problems", "prompts"], sql="""
SELECT a.prompt_id, a.question, b.answer FROM problems a JOIN prompts b ON a.prompt_id = b.prompt_id""")
def _(spark, sf):
    return J.concat_columns(T.problems(spark, sf).select("prompt_id", "question"),
                            T.prompts(spark, sf).select("prompt_id", "answer"), "prompt_id")


# two samples per prompt with a stored score; a copy in the second position
# both samples of a group in one row, without a self-join
_SIDES = ", ".join(
    f"max({c}) FILTER (WHERE sample_idx = {i}) AS {side}_{c}" for i, side in enumerate("ab") for c in ("sample_idx", "response", "reward"))
_TWO = f"two AS (SELECT run_id, step, prompt_id, {_SIDES} FROM rewarded WHERE sample_idx < 2 GROUP BY ALL HAVING count(*) = 2)"


def _two(spark, sf):
    r = R.combine(R.score(T.rollouts(spark, sf), SPECS), SPECS)
    return r.where(F.col("sample_idx") < 2).select("run_id", "step", "prompt_id", "sample_idx", "response", "reward")


_GROUP = ["run_id", "step", "prompt_id"]
_PAIRED = """SELECT run_id, step, prompt_id, CASE WHEN {m} THEN a_sample_idx ELSE b_sample_idx END AS chosen_idx,
 CASE WHEN {m} THEN b_sample_idx ELSE a_sample_idx END AS rejected_idx,
 CASE WHEN {m} THEN a_response ELSE b_response END AS chosen, CASE WHEN {m} THEN b_response ELSE a_response END AS rejected
 FROM two"""


@query("pair_by_score", uses=["rollouts"], ctes=f"{REWARDED_SQL}, {_TWO}",
       sql=_PAIRED.format(m="a_reward >= b_reward"))
def _(spark, sf):
    return J.pair_by_score(_two(spark, sf), _GROUP).select(*_GROUP, "chosen_idx", "rejected_idx", "chosen", "rejected")


@query("pair_by_judge", uses=["rollouts", "judge_ranks"], ctes=f"{REWARDED_SQL}, {_TWO}",
       sql=_PAIRED.format(m="rank = 0") + " JOIN judge_ranks USING (prompt_id)")
def _(spark, sf):
    ranks = _two(spark, sf).select(*_GROUP).distinct().join(T.judge_ranks(spark, sf), "prompt_id")
    return J.pair_by_judge(_two(spark, sf), ranks, _GROUP).select(
        *_GROUP, "chosen_idx", "rejected_idx", "chosen", "rejected")


@query("model_vs_ref_select", uses=["duels"], sql=f"""
SELECT prompt_id, {q('CASE WHEN m THEN model_on_model ELSE model_on_ref END', 'chosen_model')},
 {q('CASE WHEN m THEN ref_on_model ELSE ref_on_ref END', 'chosen_ref')},
 {q('CASE WHEN m THEN model_on_ref ELSE model_on_model END', 'rejected_model')},
 {q('CASE WHEN m THEN ref_on_ref ELSE ref_on_model END', 'rejected_ref')}
FROM (SELECT *, model_score >= ref_score AS m FROM duels)""")
def _(spark, sf):
    d = T.duels(spark, sf)
    model = d.select("prompt_id", "model_on_model", "ref_on_model", "model_score")
    ref = d.select("prompt_id", "model_on_ref", "ref_on_ref", "ref_score")
    s = J.model_vs_ref(model, ref)
    return s.select("prompt_id", *[rounded(c) for c in ("chosen_model", "chosen_ref", "rejected_model", "rejected_ref")])


@query("rank_align", uses=["pair_logps"], ctes="""
a AS (SELECT step, c - r AS v, row_number() OVER (PARTITION BY step ORDER BY c - r, pair_id) AS k FROM pair_logps),
b AS (SELECT step, c0 - r0 AS v, row_number() OVER (PARTITION BY step ORDER BY c0 - r0, pair_id) AS k FROM pair_logps)""",
       sql=f"SELECT a.step, a.k - 1 AS rank, {q('a.v - b.v', 'delta')} FROM a JOIN b ON a.step = b.step AND a.k = b.k")
def _(spark, sf):
    p = T.pair_logps(spark, sf).select("pair_id", "step", (F.col("c") - F.col("r")).alias("a"),
                                       (F.col("c0") - F.col("r0")).alias("b"))
    return J.rank_align(p, ["step"], "pair_id", "a", "b").select("step", "rank", rounded("delta"))


@query("split_leakage_check", sql="""
SELECT (SELECT count(*) FROM documents d WHERE EXISTS (SELECT 1 FROM benchmark b WHERE b.text = d.text)) AS leaked,
 (SELECT count(*) FROM documents d WHERE NOT EXISTS (SELECT 1 FROM benchmark b WHERE b.text = d.text)) AS clean""")
def _(spark, sf):
    docs = T.read(spark, sf, "documents").select("text")
    return J.leakage(docs, T.read(spark, sf, "benchmark").select("text"), "text")


@query("split_leakage_clean", sql="""
SELECT doc_id FROM documents d WHERE NOT EXISTS (SELECT 1 FROM benchmark b WHERE b.text = d.text)""")
def _(spark, sf):
    docs = T.read(spark, sf, "documents").select("doc_id", "text")
    return J.without_leaked(docs, T.read(spark, sf, "benchmark").select("text"), "text").select("doc_id")
