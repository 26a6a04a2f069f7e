"""Queries: preference and policy audits, and run metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from rollforge.catalog.registry import q, query, rounded, sql_ls, sql_sigmoid
from rollforge.operators import joins as J
from rollforge.operators import policy as Y
from rollforge.operators import prefs as D
from rollforge.operators import runs as U
from rollforge.plans.storage import scratch_path
from rollforge.sources import tables as T

LOSSES = D.ROW_LOSSES


def _sp(x: str) -> str:
    return f"(-{sql_ls(f'-({x})')})"


def _loss_sql(loss: str, beta: float, e: float, a="a", b="b", h="h", mean_h="mh", tau=0.05) -> str:
    if loss in ("sppo_hard", "nca_pair", "discopop"):  # on the ratios to the reference, always
        a, b, h = "(c - c0)", "(r - r0)", "((c - c0) - (r - r0))"
    x = f"({h} * {beta}e0)"
    nx = f"(-{x})"
    if loss == "sigmoid":
        return f"-{sql_ls(x)} * {1 - e}e0 - {sql_ls(nx)} * {e}e0"
    if loss == "robust":
        return f"(-{sql_ls(x)} * {1 - e}e0 + {sql_ls(nx)} * {e}e0) / {1 - 2 * e}e0"
    if loss == "exo_pair":
        e = e or 1e-3
        return f"{sql_sigmoid(x)} * ({sql_ls(x)} - ln({1 - e}e0)) + {sql_sigmoid(nx)} * ({sql_ls(nx)} - ln({e}e0))"
    if loss == "hinge":
        return f"greatest(0e0, 1 - {x})"
    if loss == "ipo":
        return f"pow({mean_h} - {1 / (2 * beta)}e0, 2)"
    if loss == "sppo_hard":
        return f"pow({a} - {0.5 / beta}e0, 2) + pow({b} + {0.5 / beta}e0, 2)"
    if loss == "nca_pair":
        return (f"-{sql_ls(f'{a} * {beta}e0')} - {sql_ls(f'-({a}) * {beta}e0')} * 0.5e0"
                f" - {sql_ls(f'-({b}) * {beta}e0')} * 0.5e0")
    if loss == "apo_zero":
        return f"1 - {sql_sigmoid(f'{a} * {beta}e0')} + {sql_sigmoid(f'{b} * {beta}e0')}"
    if loss == "apo_down":
        return f"{sql_sigmoid(f'{a} * {beta}e0')} + 1 - {sql_sigmoid(f'({a} - ({b})) * {beta}e0')}"
    m = sql_sigmoid(f"{x} / {tau}e0")
    return f"-{sql_ls(x)} * (1 - {m}) + exp(-{x}) * {m}"


_RATIO = ("ratios AS (SELECT *, c - c0 AS a, r - r0 AS b, (c - c0) - (r - r0) AS h,"
          " (c / n_c - c0 / n_c) - (r / n_r - r0 / n_r) AS mh FROM pair_logps)")


def _audit(name: str, s: D.Settings, losses, ctes: str = _RATIO) -> None:
    cols = ", ".join(q(_loss_sql(x, s.beta, s.label_smoothing), f"loss_{x}") for x in losses)

    @query(name, uses=["pair_logps"], ctes=ctes, sql=f"SELECT pair_id, {cols} FROM ratios")
    def _(spark, sf):
        r = D.audit_rows(T.pair_logps(spark, sf), losses, s)
        return r.select("pair_id", *[rounded(f"loss_{x}") for x in losses])


_audit("audit_preference", D.Settings(0.1, 0.1), LOSSES)
_audit("audit_preference_plain", D.Settings(0.25, 0.0), LOSSES)
_audit("audit_preference_reference_free", D.Settings(0.1, 0.0, reference_free=True), ("sigmoid", "hinge", "sppo_hard"),
       "ratios AS (SELECT *, c AS a, r AS b, c - r AS h, c / n_c - r / n_r AS mh FROM pair_logps)")
_audit("audit_preference_js", D.Settings(0.1, 0.1, "js"), ("sigmoid", "hinge", "robust"),
       f"ratios AS (SELECT *, a - b - ({_sp('a')} - {_sp('b')}) AS h, 0 AS mh FROM (SELECT *, c - c0 AS a, r - r0 AS b FROM pair_logps))")
_audit("audit_preference_alpha", D.Settings(0.1, 0.1, "alpha", alpha=0.5), ("sigmoid", "hinge", "robust"),
       "ratios AS (SELECT *, (exp(least(b * -0.5e0, 88.7228e0)) - exp(least(a * -0.5e0, 88.7228e0))) / 0.5e0 AS h, 0 AS mh"
       " FROM (SELECT *, c - c0 AS a, r - r0 AS b FROM pair_logps))")


@query("audit_preference_means", uses=["pair_logps"], ctes=_RATIO, sql="SELECT step, " + ", ".join(
    q(f"avg({_loss_sql(x, 0.1, 0.1)})", f"loss_{x}") for x in LOSSES) + " FROM ratios GROUP BY step")
def _(spark, sf):
    names = [f"loss_{x}" for x in LOSSES]
    r = D.audit_rows(T.pair_logps(spark, sf), LOSSES, D.Settings(0.1, 0.1))
    return D.step_means(r, ["step"], names).select("step", *[rounded(n) for n in names])


_BCO_BASE = """base AS (SELECT step, avg(m) OVER (ORDER BY step) AS delta FROM
 (SELECT step, avg(v) AS m FROM (SELECT step, unnest([(c - c0) * 0.1e0, (r - r0) * 0.1e0]) AS v FROM pair_logps) GROUP BY step))"""


@query("audit_preference_bco", uses=["pair_logps"], ctes=_BCO_BASE, sql=f"""
SELECT pair_id, {q('delta', 'delta')}, {q(f"-{sql_ls('(c - c0) * 0.1e0 - delta')} - {sql_ls('delta - (r - r0) * 0.1e0')}", 'loss')}
FROM pair_logps p JOIN base USING (step)""")
def _(spark, sf):
    r = D.audit_running_baseline(T.pair_logps(spark, sf))
    return r.select("pair_id", rounded("delta"), rounded("loss_bco_pair", "loss"))


@query("audit_preference_sft", uses=["pair_logps"], ctes="n AS (SELECT step, -sum(c) / sum(n_c) AS loss FROM pair_logps GROUP BY step)",
       sql=f"SELECT pair_id, {q('loss', 'loss')} FROM pair_logps JOIN n USING (step)")
def _(spark, sf):
    return D.audit_sft(T.pair_logps(spark, sf)).select("pair_id", rounded("loss_sft", "loss"))


def _aot(loss: str, a: str, b: str) -> None:
    @query(f"audit_preference_{loss}", uses=["pair_logps"], ctes=f"""
x AS (SELECT step, {a} AS v, row_number() OVER (PARTITION BY step ORDER BY {a}, pair_id) AS k FROM pair_logps),
y AS (SELECT step, {b} AS v, row_number() OVER (PARTITION BY step ORDER BY {b}, pair_id) AS k FROM pair_logps)""", sql=f"""
SELECT x.step, x.k - 1 AS rank, {q(f"-{sql_ls('(x.v - y.v) * 0.1e0')} * 0.9e0 - {sql_ls('-(x.v - y.v) * 0.1e0')} * 0.1e0", 'loss')}
FROM x JOIN y ON x.step = y.step AND x.k = y.k""")
    def _(spark, sf):
        r = D.audit_aligned(T.pair_logps(spark, sf), loss, "pair_id", ["step"], D.Settings(0.1, 0.1))
        return r.select("step", "rank", rounded(f"loss_{loss}", "loss"))


_aot("aot", "c - r", "c0 - r0")
_aot("aot_pair", "c - c0", "r - r0")

_MIX = f"({_loss_sql('sigmoid', 0.1, 0.0)}) * 0.7e0 + ({_loss_sql('hinge', 0.1, 0.0)}) * 0.3e0"


@query("audit_preference_mix", uses=["pair_logps"], ctes=_RATIO, sql=f"""
SELECT pair_id, {q(f"({_MIX} + nll * 0.5e0) * least(1e0, exp(c / n_c + r / n_r))", 'loss')},
 {q('(c - c0) * 0.1e0', 'reward_chosen')} FROM ratios""")
def _(spark, sf):
    m = D.audit_mix(T.pair_logps(spark, sf), {"sigmoid": 0.7, "hinge": 0.3}, D.Settings(0.1), 0.5, True)
    return m.select("pair_id", rounded("loss"), rounded("reward_chosen"))


@query("audit_preference_mix_batch", uses=["pair_logps"], ctes=f"""{_RATIO}, {_BCO_BASE},
n AS (SELECT step, -sum(c) / sum(n_c) AS sft FROM pair_logps GROUP BY step)""", sql=f"""
SELECT pair_id, {q(f"({_loss_sql('sigmoid', 0.1, 0.0)}) * 0.5e0 + sft * 0.2e0 + (-{sql_ls('a * 0.1e0 - delta')} - {sql_ls('delta - b * 0.1e0')}) * 0.3e0", 'loss')}
FROM ratios JOIN base USING (step) JOIN n USING (step)""")
def _(spark, sf):
    m = D.audit_mix(T.pair_logps(spark, sf), {"sigmoid": 0.5, "sft": 0.2, "bco_pair": 0.3}, D.Settings(0.1))
    return m.select("pair_id", rounded("loss"))


@query("audit_preference_mix_aligned", uses=["pair_logps"], ctes=f"""{_RATIO},
ra AS (SELECT step, row_number() OVER (PARTITION BY step ORDER BY c - r, pair_id) AS k, c - r AS x FROM pair_logps),
rb AS (SELECT step, row_number() OVER (PARTITION BY step ORDER BY c0 - r0, pair_id) AS k, c0 - r0 AS y FROM pair_logps),
k AS (SELECT pair_id, row_number() OVER (PARTITION BY step ORDER BY pair_id) AS k FROM pair_logps)""", sql=f"""
SELECT pair_id, {q(f"({_loss_sql('hinge', 0.1, 0.0)}) * 0.6e0 - {sql_ls('(x - y) * 0.1e0')} * 0.4e0", 'loss')}
FROM ratios JOIN k USING (pair_id) JOIN ra USING (step, k) JOIN rb USING (step, k)""")
def _(spark, sf):
    m = D.audit_mix(T.pair_logps(spark, sf), {"hinge": 0.6, "aot": 0.4}, D.Settings(0.1))
    return m.select("pair_id", rounded("loss"))


@query("implicit_rewards", uses=["pair_logps"], sql=f"""
SELECT pair_id, {q('(c - c0) * 0.1e0', 'reward_chosen')}, {q('(r - r0) * 0.1e0', 'reward_rejected')} FROM pair_logps""")
def _(spark, sf):
    return D.implicit_rewards(T.pair_logps(spark, sf)).select(
        "pair_id", rounded("reward_chosen"), rounded("reward_rejected"))


@query("preference_metrics", uses=["pair_logps"], ctes="""
p AS (SELECT *, (c - c0) * 0.1e0 AS a, (r - r0) * 0.1e0 AS b FROM pair_logps)""", sql=f"""
SELECT step, {q('avg(a)', 'reward_chosen')}, {q('avg(b)', 'reward_rejected')}, {q('avg(CAST(a > b AS DOUBLE))', 'accuracy')},
 {q('avg(a - b)', 'margin')}, {q('avg(c)', 'logps_chosen')}, {q('avg(r)', 'logps_rejected')} FROM p GROUP BY step""")
def _(spark, sf):
    m = D.preference_metrics(T.pair_logps(spark, sf), ["step"])
    return m.select("step", *[rounded(c) for c in m.columns if c != "step"])


def _reward_sql() -> str:
    return "(logp - ref_logp) * 0.1e0"


@query("implicit_reward_baseline", uses=["unpaired_logps"], ctes=f"""
s AS (SELECT run_id, step, sum({_reward_sql()}) AS s, count(*) AS n FROM unpaired_logps GROUP BY run_id, step)""", sql=f"""
SELECT run_id, step, {q('sum(s) OVER w / sum(n) OVER w', 'per_row')}, {q('avg(s / n) OVER w', 'per_batch')} FROM s
WINDOW w AS (PARTITION BY run_id ORDER BY step)""")
def _(spark, sf):
    u = T.unpaired_logps(spark, sf).withColumn("reward", (F.col("logp") - F.col("ref_logp")) * 0.1)
    row = D.reward_baseline(u, "step", "reward", "per_row", ["run_id"]).withColumnRenamed("delta", "per_row")
    batch = D.reward_baseline(u, "step", "reward", "per_batch", ["run_id"]).withColumnRenamed("delta", "per_batch")
    return row.drop("n").join(batch.drop("n"), ["run_id", "step"]).select(
        "run_id", "step", rounded("per_row"), rounded("per_batch"))


def _free(loss: str, alpha: float) -> None:
    c, r = ("c", "r") if not alpha else tuple(f"((1 - exp({x} * -{alpha}e0)) / {alpha}e0)" for x in "cr")
    h = f"({c} - {r})" + (" - 5e0" if loss == "simpo" else "")
    value = {"hinge": f"greatest(0e0, 1 - ({h}) * 0.1e0)", "ipo": f"pow(({h}) - 5e0, 2)"}.get(
        loss, f"-{sql_ls(f'({h}) * 0.1e0')} * 0.9e0 - {sql_ls(f'-({h}) * 0.1e0')} * 0.1e0")
    name = "audit_reference_free" + ("" if loss == "sigmoid" else f"_{loss}") + ("_alpha" if alpha else "")

    @query(name, uses=["pair_logps"], sql=f"""
SELECT pair_id, {q(f"{value} + nll * 0.5e0", 'loss')}, {q(f'{c} * 0.1e0', 'reward_chosen')} FROM pair_logps""")
    def _(spark, sf):
        a = D.audit_reference_free(T.pair_logps(spark, sf), loss, 0.1, 0.1, 0.5, alpha, 0.5)
        return a.select("pair_id", rounded("loss"), rounded("reward_chosen"))


for _l in ("sigmoid", "hinge", "ipo", "simpo"):
    _free(_l, 0.0)
_free("sigmoid", 0.25)

_ODDS = f"""odds AS (SELECT *, {sql_ls('log_odds')} AS ratio FROM (SELECT *,
 (c - r) - (ln(1 - exp(c)) - ln(1 - exp(r))) AS log_odds FROM pair_logps))"""


@query("audit_odds_ratio", uses=["pair_logps"], ctes=_ODDS, sql=f"""
SELECT pair_id, {q('log_odds', 'log_odds')}, {q('ratio', 'ratio')}, {q('nll - ratio * 0.1e0', 'loss')} FROM odds""")
def _(spark, sf):
    return D.odds_ratio(T.pair_logps(spark, sf)).select("pair_id", rounded("log_odds"), rounded("ratio"), rounded("loss"))


@query("odds_ratio_summary", uses=["pair_logps"], ctes=_ODDS, sql=f"""
SELECT step, {q('avg(log_odds)', 'log_odds')}, {q('avg(ratio)', 'ratio')}, {q('avg(nll) - avg(ratio) * 0.1e0', 'loss')}
FROM odds GROUP BY step""")
def _(spark, sf):
    return D.odds_ratio_summary(T.pair_logps(spark, sf), ["step"]).select(
        "step", rounded("log_odds"), rounded("ratio"), rounded("loss"))


_KL = """kl AS (SELECT run_id, step, greatest(0e0, avg(kl_logp - kl_ref_logp)) AS kl FROM unpaired_logps GROUP BY run_id, step)"""


def _unpaired_query(loss: str) -> None:
    x, k = "(logp - ref_logp)", "kl"
    if loss == "kto":
        good, bad = f"1 - {sql_sigmoid(f'({x} - {k}) * 0.1e0')}", f"1 - {sql_sigmoid(f'({k} - {x}) * 0.1e0')}"
    else:
        good, bad = f"1 - {sql_sigmoid(f'{x} * 0.1e0')}", sql_sigmoid(f"{x} * 0.1e0")

    @query("audit_unpaired" if loss == "kto" else "audit_unpaired_apo", uses=["unpaired_logps"], ctes=_KL, sql=f"""
SELECT row_id, {q('kl', 'kl')}, {q(f'CASE WHEN label THEN ({good}) * 1.2e0 ELSE ({bad}) * 0.8e0 END', 'loss')}
FROM unpaired_logps JOIN kl USING (run_id, step)""")
    def _(spark, sf):
        a = D.audit_unpaired(T.unpaired_logps(spark, sf), ["run_id", "step"], loss, 0.1, 1.2, 0.8)
        return a.select("row_id", rounded("kl"), rounded("loss"))


for _l in ("kto", "apo_zero_unpaired"):
    _unpaired_query(_l)


def _side(expr: str, side: str) -> str:
    test = "label" if side == "chosen" else "NOT label"
    return f"CAST(sum(CASE WHEN {test} THEN CAST({expr} AS DECIMAL(28, 9)) END) AS DOUBLE) / count(CASE WHEN {test} THEN 1 END)"


@query("unpaired_metrics", uses=["unpaired_logps"], sql="SELECT run_id, step, count(CASE WHEN label THEN 1 END) AS count_chosen,"
       " count(CASE WHEN NOT label THEN 1 END) AS count_rejected, " + ", ".join(
           q(_side(e, side), f"{n}_{side}") for n, e in
           [("rewards", _reward_sql()), ("logps", "logp"), ("logits", "logits")] for side in ("chosen", "rejected"))
       + f", {q(f'''{_side(_reward_sql(), 'chosen')} - {_side(_reward_sql(), 'rejected')}''', 'margin')}"
       " FROM unpaired_logps GROUP BY run_id, step")
def _(spark, sf):
    m = D.unpaired_metrics(T.unpaired_logps(spark, sf), ["run_id", "step"])
    plain = ("run_id", "step", "count_chosen", "count_rejected")
    return m.select(*plain, *[rounded(c) for c in m.columns if c not in plain])


@query("class_balance", uses=["unpaired"], ctes="""
k AS (SELECT greatest(count(*) FILTER (WHERE label), 1) AS d, count(*) AS n FROM unpaired),
b AS (SELECT d, greatest(n - d, 1) AS u FROM k),
v AS (SELECT d, u, round(u * 1e0 / d, 2) AS des_low, round(u * 1e0 / d * 1.33e0, 2) AS des_high,
 round(d * 1e0 / u / 1.33e0, 2) AS und_low, round(d * 1e0 / u, 2) AS und_high FROM b)""", sql="""
SELECT d AS desirable, u AS undesirable, des_low, des_high, und_low, und_high,
 1e0 BETWEEN des_low AND des_high AS des_in_range, 1e0 BETWEEN und_low AND und_high AS und_in_range FROM v""")
def _(spark, sf):
    return D.class_balance(T.unpaired(spark, sf))


@query("audit_binary_classifier", uses=["unpaired_logps"], ctes=f"""
s AS (SELECT run_id, step, sum({_reward_sql()}) AS s, count(*) AS n FROM unpaired_logps GROUP BY run_id, step),
b AS (SELECT run_id, step, sum(s) OVER w / sum(n) OVER w AS delta FROM s WINDOW w AS (PARTITION BY run_id ORDER BY step))""", sql=f"""
SELECT row_id, {q('delta', 'delta')}, {q(f'''CASE WHEN label THEN -{sql_ls(f'{_reward_sql()} - delta')}
 ELSE -{sql_ls(f'delta - {_reward_sql()}')} END''', 'loss')} FROM unpaired_logps JOIN b USING (run_id, step)""")
def _(spark, sf):
    a = D.audit_binary_classifier(T.unpaired_logps(spark, sf), "step", keys=["run_id"])
    return a.select("row_id", rounded("delta"), rounded("loss"))


def _embeddings(spark, sf):
    return T.read(spark, sf, "embeddings").withColumn("desirable", F.col("label") < 5)


@query("density_ratio_weights")
def _(spark, sf):
    weights, _ = D.density_ratio_weights(_embeddings(spark, sf), "vec_id", "embedding", "desirable")
    return weights.select("vec_id", F.round("p", 4).alias("p"), F.round("weight", 4).alias("weight"))


@query("density_ratio_accuracy")
def _(spark, sf):
    return D.density_ratio_weights(_embeddings(spark, sf), "vec_id", "embedding", "desirable")[1]


_SCORES = "s AS (SELECT *, c + 4 AS score_chosen, r + 4 AS score_rejected FROM pair_logps)"


def _scores(spark, sf):
    return T.pair_logps(spark, sf).withColumns({"score_chosen": F.col("c") + 4, "score_rejected": F.col("r") + 4})


@query("audit_margin", uses=["pair_logps"], ctes=_SCORES, sql=f"""
SELECT step, {q(f"avg(-{sql_ls('score_chosen - score_rejected - margin')}) + avg(pow(score_chosen + score_rejected, 2)) * 0.01e0", 'loss')}
FROM s GROUP BY step""")
def _(spark, sf):
    return D.audit_margin(_scores(spark, sf), ["step"], 0.01).select("step", rounded("loss"))


@query("scored_pair_accuracy", uses=["pair_logps"], ctes=_SCORES, sql=f"""
SELECT step, {q('avg(CAST(score_chosen > score_rejected AS DOUBLE))', 'accuracy')} FROM s GROUP BY step""")
def _(spark, sf):
    return D.scored_pair_accuracy(_scores(spark, sf), ["step"]).select("step", rounded("accuracy"))


# two sequences per prompt, numbered by their id, with summed log-probs
_ONLINE = """sums AS (SELECT seq_id, max(seq_id // 2) AS prompt_id, max(seq_id % 2) AS sample_idx, max(step) AS step, max(score) AS score,
 round(sum(CASE WHEN mask = 1 THEN logp ELSE 0 END), 6) AS logp, round(sum(CASE WHEN mask = 1 THEN ref_logp ELSE 0 END), 6) AS ref,
 bool_or(token_id = 2) AS eos FROM token_rows GROUP BY seq_id),
prs AS (SELECT a.prompt_id, a.prompt_id % 20 AS batch, a.score >= b.score AS m, a.score AS sa, b.score AS sb, a.logp AS la, b.logp AS lb,
 a.ref AS ra, b.ref AS rb, a.eos AS ea, b.eos AS eb FROM sums a JOIN sums b ON a.prompt_id = b.prompt_id AND a.sample_idx = 0 AND b.sample_idx = 1),
o AS (SELECT prompt_id, batch, CASE WHEN m THEN sa ELSE sb END AS cs, CASE WHEN m THEN sb ELSE sa END AS rs,
 CASE WHEN m THEN la ELSE lb END AS cl, CASE WHEN m THEN lb ELSE la END AS rl, CASE WHEN m THEN ra ELSE rb END AS cr,
 CASE WHEN m THEN rb ELSE ra END AS rr, CASE WHEN m THEN ea ELSE eb END AS ce, CASE WHEN m THEN eb ELSE ea END AS re FROM prs)"""


def _online(spark, sf):
    s = Y.sequence_logps(T.sequences(spark, sf), "logps", name="logp")
    s = Y.sequence_logps(s, "ref_logps", name="ref")
    rows = s.select(F.expr("seq_id div 2").alias("prompt_id"), (F.col("seq_id") % 2).alias("sample_idx"), "score",
                    F.round("logp", 6).alias("logp"), F.round("ref", 6).alias("ref"),
                    F.array_contains("token_ids", F.lit(2).cast("bigint")).alias("eos"))
    return J.pair_by_score(rows, score="score").withColumn("batch", F.col("prompt_id") % 20)


def _online_query(loss: str) -> None:
    h = "((cl - rl) - (cr - rr))"
    value = f"-{sql_ls(f'{h} * 0.1e0')}" if loss == "sigmoid" else f"pow({h} - 5e0, 2)"

    @query("audit_online_pair" if loss == "sigmoid" else "audit_online_pair_ipo", uses=["token_rows"], ctes=_ONLINE,
           sql=f"SELECT prompt_id, {q(value, 'loss')} FROM o")
    def _(spark, sf):
        return D.audit_online_pair(_online(spark, sf), loss).select("prompt_id", rounded("loss"))


for _l in ("sigmoid", "ipo"):
    _online_query(_l)

_OKL = "(cl - cr + rl - rr)"


@query("online_pair_summary", uses=["token_rows"], ctes=_ONLINE, sql=f"""
SELECT batch, {q('avg(cs - rs)', 'scores_margin')}, {q('avg((cs + rs) / 2)', 'scores')},
 {q('avg((CAST(ce AS INT) + CAST(re AS INT)) / 2e0)', 'eos_rate')}, {q('avg(cl)', 'logps_chosen')}, {q('avg(rl)', 'logps_rejected')},
 {q(f'avg({_OKL} / 2)', 'kl')}, {q(f'avg({_OKL} * -0.05e0)', 'non_score_reward')},
 {q(f'avg((cs + rs) / 2 - {_OKL} * 0.05e0)', 'total_reward')}, {q('avg(-(cl + rl) / 2)', 'entropy')},
 {q('avg((cl - cr) * 0.1e0)', 'reward_chosen')}, {q('avg((rl - rr) * 0.1e0)', 'reward_rejected')},
 {q('avg((cl - cr) * 0.1e0 - (rl - rr) * 0.1e0)', 'margin')},
 {q('avg(CAST((cl - cr) * 0.1e0 > (rl - rr) * 0.1e0 AS DOUBLE))', 'accuracy')} FROM o GROUP BY batch""")
def _(spark, sf):
    m = D.online_pair_summary(_online(spark, sf), ["batch"])
    return m.select("batch", *[rounded(c) for c in m.columns if c != "batch"])


_DUEL = """sel AS (SELECT *, model_score >= ref_score AS m FROM duels),
d AS (SELECT *, CASE WHEN m THEN model_on_model ELSE model_on_ref END AS cm, CASE WHEN m THEN ref_on_model ELSE ref_on_ref END AS cr,
 CASE WHEN m THEN model_on_ref ELSE model_on_model END AS rm, CASE WHEN m THEN ref_on_ref ELSE ref_on_model END AS rr FROM sel),
x AS (SELECT *, (cm - cr) - (rm - rr) AS h FROM d)"""
_MODEL = ("prompt_id", "step", "model_on_model", "ref_on_model", "model_score", "model_eos")
_REF = ("prompt_id", "model_on_ref", "ref_on_ref", "ref_score", "ref_eos")


def _duel(spark, sf, loss="sigmoid"):
    d = T.duels(spark, sf)
    return D.audit_exploration(J.model_vs_ref(d.select(*_MODEL), d.select(*_REF)), loss, 0.1, 1e-2)


def _explore_query(loss: str) -> None:
    value = f"-{sql_ls('h * 0.1e0')}" if loss == "sigmoid" else "pow(h - 5e0, 2)"

    @query("audit_exploration" if loss == "sigmoid" else "audit_exploration_ipo", uses=["duels"], ctes=_DUEL, sql=f"""
SELECT prompt_id, {q(value, 'pair_loss')}, {q('model_on_ref * 1e-2', 'explore_loss')}, {q(f'{value} + model_on_ref * 1e-2', 'loss')} FROM x""")
    def _(spark, sf):
        return _duel(spark, sf, loss).select("prompt_id", rounded("pair_loss"), rounded("explore_loss"), rounded("loss"))


for _l in ("sigmoid", "ipo"):
    _explore_query(_l)


@query("explore_pair_summary", uses=["duels"], ctes=_DUEL, sql="SELECT step, " + ", ".join(q(e, n) for n, e in [
    ("pair_loss", f"avg(-{sql_ls('h * 0.1e0')})"), ("explore_loss", "avg(model_on_ref * 1e-2)"),
    ("model_scores", "avg(model_score)"), ("ref_scores", "avg(ref_score)"), ("scores_margin", "avg(model_score - ref_score)"),
    ("logps_chosen", "avg(cm + cr)"), ("logps_rejected", "avg(rm + rr)"), ("reward_chosen", "avg((cm - cr) * 0.1e0)"),
    ("reward_rejected", "avg((rm - rr) * 0.1e0)"),
    ("kl", "avg((model_on_model - ref_on_model + model_on_ref - ref_on_ref) / 2)"),
    ("entropy", "avg(-(model_on_model + model_on_ref) / 2)"), ("margin", "avg((cm - cr) * 0.1e0 - (rm - rr) * 0.1e0)"),
    ("accuracy", "avg(CAST((cm - cr) * 0.1e0 - (rm - rr) * 0.1e0 > 0 AS DOUBLE))"),
    ("model_eos", "avg(CAST(model_eos AS DOUBLE))"), ("ref_eos", "avg(CAST(ref_eos AS DOUBLE))")]) + " FROM x GROUP BY step")
def _(spark, sf):
    m = D.explore_pair_summary(_duel(spark, sf), ["step"])
    return m.select("step", *[rounded(c) for c in m.columns if c != "step"])


_GAME = """g AS (SELECT t.seq_id, max(t.step) AS step, max(j.prob) AS prob, sum(logp) AS lp, sum(ref_logp) AS rp,
 sum((logp - ref_logp) * logp) AS klp, max(score) AS model_score, max(score) / 2 AS mixture_score,
 bool_or(token_id = 2) AS model_eos, max(t.seq_id) % 3 <> 0 AS mixture_eos
 FROM token_rows t JOIN judge_ranks j ON t.seq_id = j.prompt_id GROUP BY t.seq_id)"""


def _game(spark, sf):
    s = T.sequences(spark, sf).select(
        "seq_id", "step", "logps", "ref_logps", F.col("score").alias("model_score"), (F.col("score") / 2).alias("mixture_score"),
        F.array_contains("token_ids", F.lit(2).cast("bigint")).alias("model_eos"), (F.col("seq_id") % 3 != 0).alias("mixture_eos"))
    j = T.judge_ranks(spark, sf).select(F.col("prompt_id").alias("seq_id"), "prob")
    return D.audit_game(s.join(j, "seq_id"))


@query("audit_game", uses=["token_rows", "judge_ranks"], ctes=_GAME,
       sql=f"SELECT seq_id, {q('0.1e0 * klp - (prob - 0.5e0) * lp', 'loss')} FROM g")
def _(spark, sf):
    return _game(spark, sf).select("seq_id", rounded("loss"))


@query("game_summary", uses=["token_rows", "judge_ranks"], ctes=_GAME, sql="SELECT step, " + ", ".join(q(e, n) for n, e in [
    ("score", "avg((prob - 0.5e0) * lp)"), ("kl", "avg(lp - rp)"), ("logps_chosen", "avg(lp)"), ("logps_rejected", "avg(rp)"),
    ("reward_chosen", "avg(model_score)"), ("reward_rejected", "avg(mixture_score)"), ("probability", "avg(prob)"),
    ("entropy", "avg(-lp)"), ("margin", "avg(lp - rp)"), ("accuracy", "avg(CAST(lp - rp > 0 AS DOUBLE))"),
    ("model_eos", "avg(CAST(model_eos AS DOUBLE))"), ("mixture_eos", "avg(CAST(mixture_eos AS DOUBLE))")]) + " FROM g GROUP BY step")
def _(spark, sf):
    m = D.game_summary(_game(spark, sf), ["step"])
    return m.select("step", *[rounded(c) for c in m.columns if c != "step"])


def _jsd(beta: float) -> None:
    if beta == 0:
        e = "exp(t) * (t - s)"
    elif beta == 1:
        e = "exp(s) * (s - t)"
    else:
        mix = f"ln(exp(s) * {1 - beta}e0 + exp(t) * {beta}e0)"
        e = f"{beta}e0 * exp(t) * (t - {mix}) + {1 - beta}e0 * exp(s) * (s - {mix})"

    @query({0.0: "generalized_jsd_forward", 1.0: "generalized_jsd_reverse"}.get(beta, "generalized_jsd"),
           uses=["distributions"], ctes="""
f AS (SELECT pos, token, max(CASE WHEN side = 'O' THEN logp END) AS s, max(CASE WHEN side = 'F' THEN logp END) AS t
 FROM distributions GROUP BY pos, token)""", sql=f"SELECT pos, {q(f'sum({e})', 'jsd')} FROM f GROUP BY pos")
    def _(spark, sf):
        return D.generalized_jsd(T.distributions(spark, sf), beta, "O", "F").select("pos", rounded("jsd"))


for _b in (0.5, 0.0, 1.0):
    _jsd(_b)

# ------------------------------------------------------------ policy audits

_K3 = "(exp(ref_logp - logp) - (ref_logp - logp) - 1)"
_B = "run_id, step"


@query("sequence_logps", uses=["token_rows"], sql=f"""
SELECT seq_id, {q('sum(CASE WHEN mask = 1 THEN logp ELSE 0 END)', 'total')}, {q('avg(CASE WHEN mask = 1 THEN logp END)', 'mean')}
FROM token_rows GROUP BY seq_id""")
def _(spark, sf):
    s = Y.sequence_logps(Y.sequence_logps(T.sequences(spark, sf), name="total"), average=True, name="mean")
    return s.select("seq_id", rounded("total"), rounded("mean"))


@query("sequence_logps_labels", uses=["token_rows"], sql=f"""
SELECT seq_id, {q('sum(CASE WHEN is_prompt = 0 THEN logp ELSE 0 END)', 'total')} FROM token_rows GROUP BY seq_id""")
def _(spark, sf):
    labels = F.zip_with("token_ids", "is_prompts", lambda t, p: F.when(p == 1, F.lit(-100).cast("bigint")).otherwise(t))
    s = T.sequences(spark, sf).withColumn("m", Y.label_mask(labels))
    return Y.sequence_logps(s, "logps", "m", name="total").select("seq_id", rounded("total"))


@query("shared_length_weighting", uses=["token_rows"], ctes="""
n AS (SELECT seq_id, count(*) AS n FROM token_rows GROUP BY seq_id),
k AS (SELECT a.seq_id, least(a.n, b.n) AS shared FROM n a JOIN n b ON a.seq_id // 2 = b.seq_id // 2 AND a.seq_id <> b.seq_id)""", sql=f"""
SELECT t.seq_id // 2 AS pair_id, {q('sum(CASE WHEN t.seq_id % 2 = 0 THEN logp * CASE WHEN pos < shared THEN 1 ELSE 0.3e0 END END)', 'chosen')},
 {q('sum(CASE WHEN t.seq_id % 2 = 1 THEN logp * CASE WHEN pos < shared THEN 1 ELSE 0.3e0 END END)', 'rejected')}
FROM token_rows t JOIN k ON t.seq_id = k.seq_id GROUP BY t.seq_id // 2""")
def _(spark, sf):
    s = T.sequences(spark, sf).select(F.expr("seq_id div 2").alias("pair_id"), (F.col("seq_id") % 2).alias("sample_idx"), "logps")
    both, _ = J.side_by_side(s, "pair_id")
    w = Y.shared_length_logps(both, "logps_a", "logps_b", 0.3)
    return w.select("pair_id", rounded("logps_a_sum", "chosen"), rounded("logps_b_sum", "rejected"))


@query("k3_kl", uses=["token_rows"], sql=f"""
SELECT seq_id, {q(f'sum(CASE WHEN mask = 1 THEN {_K3} ELSE 0 END)', 'kl')} FROM token_rows GROUP BY seq_id""")
def _(spark, sf):
    return Y.k3_kl(T.sequences(spark, sf)).select("seq_id", rounded("kl"))


_SETTINGS = {
    "audit_policy_ratio": dict(level="token", beta=0.04),
    "audit_policy_ratio_sequence": dict(level="sequence", eps_high=0.28),
    "audit_policy_ratio_bounded": dict(level="token", delta=1.05, ratio_cap=2.0),
}


def _policy_ctes(level="token", eps_low=0.2, eps_high=0.2, delta=None, beta=0.0, ratio_cap=None, keep="1") -> str:
    lr = "(logp - old_logp)" if level == "token" else (
        "(sum(CASE WHEN mask = 1 THEN logp - old_logp ELSE 0 END) OVER (PARTITION BY seq_id)"
        " / greatest(sum(mask) OVER (PARTITION BY seq_id), 1))")
    ratio = "ratio" if delta is None else f"least(ratio, {delta}e0)"
    loss = (f"-least({ratio} * advantage, least({1 + eps_high}e0, greatest({1 - eps_low}e0, ratio)) * advantage) * {keep}")
    if ratio_cap:
        loss = f"({loss}) * least(exp(old_logp - sampling_logp), {ratio_cap}e0)"
    if beta:
        loss = f"({loss}) + {beta}e0 * {_K3}"
    return f"""rt AS (SELECT *, exp(least(20e0, greatest(-20e0, {lr}))) AS ratio FROM token_rows),
tl AS (SELECT *, {loss} AS loss FROM rt),
pr AS (SELECT run_id, step, seq_id, sum(CASE WHEN mask = 1 THEN loss ELSE 0 END) AS loss_sum, CAST(sum(mask) AS DOUBLE) AS tokens,
 sum(CASE WHEN mask = 1 THEN loss ELSE 0 END) / greatest(sum(mask), 1) AS row_loss FROM tl GROUP BY run_id, step, seq_id)"""


def _policy_query(name: str, kw: dict) -> None:
    @query(name, uses=["token_rows"], ctes=_policy_ctes(**kw),
           sql=f"SELECT seq_id, {q('loss_sum', 'loss_sum')}, {q('row_loss', 'row_loss')}, {q('tokens', 'tokens')} FROM pr")
    def _(spark, sf):
        return Y.policy_rows(T.sequences(spark, sf), **kw).select(
            "seq_id", rounded("loss_sum"), rounded("row_loss"), rounded("tokens"))


for _name, _kw in _SETTINGS.items():
    _policy_query(_name, _kw)

_REDUCED = {
    "grpo": "avg(row_loss) / 2", "bnpo": "sum(loss_sum) / greatest(sum(tokens), 1) / 2",
    "dr_grpo": "sum(loss_sum) / (count(*) * 16) / 2", "dapo": "sum(loss_sum) / (greatest(sum(tokens), 1) / 4e0)",
}


@query("policy_loss_reduce", uses=["token_rows"], ctes=_policy_ctes(beta=0.04), sql="SELECT run_id, step, " + ", ".join(
    q(e, f"loss_{n}") for n, e in _REDUCED.items()) + " FROM pr GROUP BY run_id, step")
def _(spark, sf):
    rows = Y.policy_rows(T.sequences(spark, sf), beta=0.04).select("run_id", "step", "loss_sum", "row_loss", "tokens")
    reduced = Y.reduce_policy_loss(rows, Y.POLICY_LOSSES, max_completion=16, workers=4, accumulation=2)
    return reduced.select("run_id", "step", *[rounded(f"loss_{n}") for n in Y.POLICY_LOSSES])


@query("audit_sequence_ratio", uses=["token_rows"], ctes="""
s AS (SELECT seq_id, max(advantage) AS adv, exp(sum(CASE WHEN mask = 1 THEN logp - old_logp ELSE 0 END)) AS ratio FROM token_rows GROUP BY seq_id)""",
       sql=f"SELECT seq_id, {q('ratio', 'ratio')}, {q('-least(ratio * adv, least(1.2e0, greatest(0.8e0, ratio)) * adv)', 'loss')} FROM s")
def _(spark, sf):
    return Y.sequence_ratio(T.sequences(spark, sf)).select("seq_id", rounded("ratio"), rounded("loss"))


_M = "(SELECT * FROM token_rows WHERE mask = 1)"


@query("token_kl_entropy", uses=["token_rows"],
       sql=f"SELECT run_id, step, {q(f'avg({_K3})', 'kl')}, {q('avg(entropy)', 'entropy')} FROM {_M} GROUP BY run_id, step")
def _(spark, sf):
    return Y.token_kl_entropy(T.sequences(spark, sf)).select("run_id", "step", rounded("kl"), rounded("entropy"))


_CLIP = """c AS (SELECT run_id, step, seq_id % 4 AS worker, exp(logp - old_logp) < 0.95e0 AND advantage < 0 AS lo,
 exp(logp - old_logp) > 1.05e0 AND advantage > 0 AS hi FROM token_rows WHERE mask = 1)"""


@query("clip_fractions", uses=["token_rows"], ctes=_CLIP, sql=f"""
SELECT run_id, step, {q('avg(CAST(lo AS DOUBLE))', 'low')}, {q('avg(CAST(hi AS DOUBLE))', 'high')},
 {q('avg(CAST(lo OR hi AS DOUBLE))', 'either')} FROM c GROUP BY run_id, step""")
def _(spark, sf):
    m = Y.clip_fractions(T.sequences(spark, sf), eps_low=0.05, eps_high=0.05)
    return m.select("run_id", "step", *[rounded(c) for c in ("low", "high", "either")])


@query("clip_fractions_sharded", uses=["token_rows"], ctes=f"""{_CLIP}, w AS (SELECT run_id, step, worker, avg(CAST(lo AS DOUBLE)) AS lo,
 avg(CAST(hi AS DOUBLE)) AS hi, avg(CAST(lo OR hi AS DOUBLE)) AS ei FROM c GROUP BY run_id, step, worker)""", sql=f"""
SELECT run_id, step, {q('avg(lo)', 'low')}, {q('min(lo)', 'low_min')}, {q('avg(hi)', 'high')}, {q('max(hi)', 'high_max')},
 {q('avg(ei)', 'either')} FROM w GROUP BY run_id, step""")
def _(spark, sf):
    s = T.sequences(spark, sf).withColumn("worker", F.col("seq_id") % 4)
    m = Y.clip_fractions(s, shard="worker", eps_low=0.05, eps_high=0.05)
    return m.select("run_id", "step", *[rounded(c) for c in ("low", "low_min", "high", "high_max", "either")])


@query("sampling_mismatch", uses=["token_rows"], ctes=f"""
g AS (SELECT run_id, step, abs(old_logp - sampling_logp) AS gap, least(exp(old_logp - sampling_logp), 1.1e0) AS ratio FROM {_M})""", sql=f"""
SELECT run_id, step, {q('avg(gap)', 'gap_mean')}, {q('max(gap)', 'gap_max')}, {q('min(ratio)', 'ratio_min')},
 {q('avg(ratio)', 'ratio_mean')}, {q('max(ratio)', 'ratio_max')} FROM g GROUP BY run_id, step""")
def _(spark, sf):
    m = Y.sampling_mismatch(T.sequences(spark, sf), cap=1.1)
    return m.select("run_id", "step", *[rounded(c) for c in m.columns if c not in ("run_id", "step")])


@query("completion_length_stats", uses=["token_rows"], ctes="""
l AS (SELECT run_id, step, seq_id, sum(mask) AS len, bool_or(token_id = 2) AS done FROM token_rows GROUP BY run_id, step, seq_id)""", sql=f"""
SELECT run_id, step, {q('avg(len)', 'mean')}, {q('min(len)', 'min')}, {q('max(len)', 'max')},
 {q('coalesce(avg(CASE WHEN done THEN len END), 0)', 'done_mean')}, {q('coalesce(min(CASE WHEN done THEN len END), 0)', 'done_min')},
 {q('coalesce(max(CASE WHEN done THEN len END), 0)', 'done_max')}, {q('1 - avg(CAST(done AS DOUBLE))', 'clipped')} FROM l GROUP BY run_id, step""")
def _(spark, sf):
    m = Y.completion_length_stats(T.sequences(spark, sf))
    return m.select("run_id", "step", *[rounded(c) for c in m.columns if c not in ("run_id", "step")])


_TOP = f"""th AS (SELECT run_id, step, quantile_cont(entropy, 0.8e0) AS threshold FROM {_M} GROUP BY run_id, step),
em AS (SELECT t.*, CASE WHEN mask = 1 AND entropy >= threshold THEN 1 ELSE 0 END AS keep FROM token_rows t JOIN th USING (run_id, step))"""


@query("top_entropy_mask", uses=["token_rows"], ctes=_TOP, sql="""
SELECT seq_id, string_agg(CAST(keep AS VARCHAR), ',' ORDER BY pos) AS mask FROM em GROUP BY seq_id""")
def _(spark, sf):
    m = Y.top_entropy_mask(T.sequences(spark, sf).select("run_id", "step", "seq_id", "entropys", "masks"), 0.2)
    return m.select("seq_id", F.array_join(F.transform("entropy_mask", lambda x: x.cast("string")), ",").alias("mask"))


@query("audit_policy_ratio_entropy", uses=["token_rows"],
       ctes=_TOP + ", " + _policy_ctes(keep="keep").replace("FROM token_rows)", "FROM em)", 1),
       sql=f"SELECT seq_id, {q('loss_sum', 'loss_sum')} FROM pr")
def _(spark, sf):
    m = Y.top_entropy_mask(T.sequences(spark, sf), 0.2)
    return Y.policy_rows(m, keep_mask="entropy_mask").select("seq_id", rounded("loss_sum"))


def _whiten(shift: bool) -> None:
    back = "" if shift else " + m"

    @query("masked_whiten" if shift else "masked_whiten_keep_mean", uses=["token_rows"], ctes=f"""
w AS (SELECT run_id, step, avg(value) AS m, var_samp(value) AS v FROM {_M} GROUP BY run_id, step)""", sql=f"""
SELECT seq_id, pos, {q(f'CASE WHEN mask = 1 THEN (value - m) / sqrt(v + 1e-8){back} ELSE 0 END', 'value')}
FROM token_rows JOIN w USING (run_id, step)""")
    def _(spark, sf):
        s = T.sequences(spark, sf).select("run_id", "step", "seq_id", "values", "masks")
        m = Y.masked_whiten(s, "values", shift_mean=shift)
        return m.select("seq_id", F.posexplode("values_white").alias("pos", "value")).withColumn("value", rounded("value"))


for _flag in (True, False):
    _whiten(_flag)


def _token_reward_ctes(estimator: str) -> str:
    kl = "(logp - ref_logp)" if estimator == "k1" else _K3
    return f"""e AS (SELECT seq_id, coalesce(min(pos) FILTER (WHERE token_id = 0) - 1, max(pos)) AS last, count(*) AS n
 FROM token_rows GROUP BY seq_id),
tr AS (SELECT t.*, n, CASE WHEN pos <= last THEN -0.05e0 * {kl} ELSE 0 END
 + CASE WHEN pos = CASE WHEN last + 1 < n THEN last + 1 ELSE last END THEN score ELSE 0 END AS reward
 FROM token_rows t JOIN e USING (seq_id))"""


def _token_rewards_query(estimator: str) -> None:
    @query("token_rewards" if estimator == "k1" else "token_rewards_k3", uses=["token_rows"],
           ctes=_token_reward_ctes(estimator), sql=f"SELECT seq_id, pos, {q('reward', 'reward')} FROM tr")
    def _(spark, sf):
        r = Y.token_rewards(T.sequences(spark, sf), 0.05, estimator)
        # for posexplode Spark filters by the array's size where the orders are scanned, and computes all rewards for it
        tokens = r.select("seq_id", F.posexplode_outer("token_rewards").alias("pos", "reward")).where("pos IS NOT NULL")
        return tokens.withColumn("reward", rounded("reward"))


for _e in ("k1", "k3"):
    _token_rewards_query(_e)


@query("gae", uses=["token_rows"], ctes=_token_reward_ctes("k1") + """,
dl AS (SELECT seq_id, pos, value, reward + 0.9876543e0 * coalesce(lead(value) OVER (PARTITION BY seq_id ORDER BY pos), 0) - value AS d FROM tr),
ad AS (SELECT a.seq_id, a.pos, max(a.value) AS value, sum(b.d * pow(0.9876543e0 * 0.95e0, b.pos - a.pos)) AS adv
 FROM dl a JOIN dl b ON a.seq_id = b.seq_id AND b.pos >= a.pos GROUP BY a.seq_id, a.pos)""",
       sql=f"SELECT seq_id, pos, {q('adv', 'advantage')}, {q('adv + value', 'ret')} FROM ad")
def _(spark, sf):
    s = T.sequences(spark, sf).select("seq_id", "token_ids", "logps", "ref_logps", "score", "values")
    g = Y.gae(Y.token_rewards(s, 0.05), gamma=0.9876543, lam=0.95)
    return g.select("seq_id", F.posexplode(F.arrays_zip("advantages", "returns")).alias("pos", "t")).select(
        "seq_id", "pos", rounded("t.advantages", "advantage"), rounded("t.returns", "ret"))


@query("audit_value", uses=["token_rows"], ctes=f"""
v AS (SELECT run_id, step, pow(new_value - (value + entropy), 2) AS f1,
 pow(least(value + 0.2e0, greatest(value - 0.2e0, new_value)) - (value + entropy), 2) AS f2, logp - old_logp AS d,
 -(entropy - 1) * exp(logp - old_logp) AS p1, -(entropy - 1) * least(1.2e0, greatest(0.8e0, exp(logp - old_logp))) AS p2 FROM {_M})""", sql=f"""
SELECT run_id, step, {q('0.5e0 * avg(greatest(f1, f2))', 'value_loss')}, {q('avg(CAST(f2 > f1 AS DOUBLE))', 'value_clipped')},
 {q('avg(greatest(p1, p2))', 'policy_loss')}, {q('avg(CAST(p2 > p1 AS DOUBLE))', 'policy_clipped')},
 {q('0.5e0 * avg(d * d)', 'approx_kl')}, {q('avg(exp(d))', 'ratio')} FROM v GROUP BY run_id, step""")
def _(spark, sf):
    s = T.sequences(spark, sf).withColumns({
        "returns": F.zip_with("values", "entropys", lambda v, e: v + e),
        "token_advantages": F.transform("entropys", lambda e: e - 1)})
    m = Y.audit_value(s)
    return m.select("run_id", "step", *[rounded(c) for c in m.columns if c not in ("run_id", "step")])


@query("ppo_rollout_summary", uses=["token_rows"], ctes="""
r AS (SELECT run_id, step, seq_id, sum(CASE WHEN mask = 1 THEN logp - ref_logp ELSE 0 END) AS kl, max(score) AS score,
 -sum(CASE WHEN mask = 1 THEN logp ELSE 0 END) AS en, count(*) FILTER (WHERE token_id = 2) AS eos FROM token_rows GROUP BY run_id, step, seq_id)""", sql=f"""
SELECT run_id, step, {q('avg(kl)', 'kl')}, {q('avg(en)', 'entropy')}, {q('avg(kl * -0.05e0)', 'non_score_reward')},
 {q('avg(kl * -0.05e0) + avg(score)', 'total_reward')}, {q('avg(score)', 'score')}, sum(eos)::BIGINT AS eos_tokens FROM r GROUP BY run_id, step""")
def _(spark, sf):
    m = Y.rollout_summary(T.sequences(spark, sf))
    return m.select("run_id", "step", *[rounded(c) for c in ("kl", "entropy", "non_score_reward", "total_reward", "score")], "eos_tokens")


# -------------------------------------------------------------- run metrics

@query("append_metrics", uses=["metrics"], sql=f"""
SELECT run_id, event_id, 'value' AS name, {q('value', 'value')} FROM metrics UNION ALL
SELECT run_id, event_id, 'twice', {q('value * 2', 'value')} FROM metrics""")
def _(spark, sf):
    wide = T.metrics(spark, sf).select("run_id", "event_id", "value", (F.col("value") * 2).alias("twice"))
    path = scratch_path(spark, "metrics")
    for flush, names in enumerate([["value"], ["twice"], ["value"]]):  # the last repeats the first
        U.append_metrics(U.long_metrics(wide, ["run_id", "event_id"], names), path, flush % 2)
    return spark.read.parquet(path).select(F.col("run_id").cast("bigint").alias("run_id"), "event_id", "name", rounded("value"))


@query("flatten_metrics", uses=["metrics"], sql=f"""
SELECT event_id, 'memory/' || name AS name, {q('value', 'value')} FROM metrics""")
def _(spark, sf):
    m = T.metrics(spark, sf).select("event_id", F.create_map(F.lit("memory"), F.create_map("name", "value")).alias("logged"))
    return U.flatten_metrics(m, ["event_id"], "logged").withColumn("value", rounded("value"))


@query("tokens_seen", uses=["token_rows"], sql="""
SELECT run_id, step, CAST(sum(n) OVER (PARTITION BY run_id ORDER BY step) AS BIGINT) AS tokens_seen FROM
 (SELECT run_id, step, count(*) FILTER (WHERE token_id <> 0) AS n FROM token_rows GROUP BY run_id, step)""")
def _(spark, sf):
    s = T.sequences(spark, sf).select("run_id", "step", F.size(F.filter("token_ids", lambda x: x != 0)).alias("n"))
    return U.tokens_seen(s, ["run_id"], "step", "n")


@query("run_summary", uses=["metrics"], sql=f"""
SELECT run_id, {q("arg_max(value, event_id) FILTER (WHERE name = 'view')", 'loss_last')},
 {q("avg(value) FILTER (WHERE name = 'view')", 'loss_mean')}, {q("min(value) FILTER (WHERE name = 'view')", 'loss_min')},
 {q("avg(value) FILTER (WHERE name = 'click')", 'reward_mean')}, {q("max(value) FILTER (WHERE name = 'click')", 'reward_max')},
 {q("min(value) FILTER (WHERE name = 'click')", 'reward_min')} FROM metrics WHERE name IN ('view', 'click') GROUP BY run_id""")
def _(spark, sf):
    m = U.run_summary(T.metrics(spark, sf), "view", "click")
    return m.select("run_id", *[rounded(c) for c in m.columns if c != "run_id"])


@query("metric_flush_average", uses=["metrics"], sql=f"""
SELECT run_id, step // 10 AS interval, CASE WHEN step % 2 = 1 THEN 'eval_' ELSE '' END || name AS name,
 {q('avg(value)', 'value')}, count(value) AS n FROM metrics GROUP BY ALL""")
def _(spark, sf):
    m = T.metrics(spark, sf).withColumn("mode", F.when(F.col("step") % 2 == 1, "eval").otherwise("train"))
    return U.flush_average(m, 10, "mode").withColumn("value", rounded("value"))


@query("reward_histogram", uses=["metrics"], ctes="""
e AS (SELECT name, min(value) AS lo, max(value) AS hi FROM metrics GROUP BY name),
b AS (SELECT name, lo, hi, CASE WHEN hi = lo THEN 1 ELSE least(20, CAST(floor((value - lo) / (hi - lo) * 20) AS INT) + 1) END AS bin
 FROM metrics JOIN e USING (name))""", sql=f"""
SELECT name, bin, count(*) AS n, {q('min(lo + (bin - 1) * (hi - lo) / 20)', 'low')} FROM b GROUP BY name, bin""")
def _(spark, sf):
    h = U.histogram(T.metrics(spark, sf), ["name"], "value")
    return h.withColumn("low", rounded("low"))
