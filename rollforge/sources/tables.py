"""The job inputs, derived from the given star-schema, text and event tables.

Every table is a narrow projection or one keyed join of a whole given table,
with sequences and sample groups generated inside the row; nothing is numbered
by a global sort. ``SQL`` holds the same tables for the SQL check.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Rows of a scan that one task expands, sorts and folds.
ROWS_A_TASK = 200_000


def spread(df: DataFrame, rows: int = ROWS_A_TASK) -> DataFrame:
    """Deal out a scan that has fewer splits than the session has cores (one
    small file), or more than ``rows`` rows a split. The jobs blow rows up inside
    their task, so what a task holds goes by its rows, not by bytes of the file.
    A table of many small splits is returned as it is: no shuffle."""
    splits = df.rdd.getNumPartitions()
    wanted = max(df.sparkSession.sparkContext.defaultParallelism, math.ceil(df.count() / rows))
    return df.repartition(wanted) if splits < wanted else df


def read(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _orders(spark: SparkSession, sf: str) -> DataFrame:
    return spread(read(spark, sf, "orders").select("o_orderkey", "o_custkey"))


def documents(spark: SparkSession, sf: str) -> DataFrame:
    return spread(read(spark, sf, "documents").select("doc_id", "text"))


def read_split(spark: SparkSession, path: str, split: str) -> DataFrame:
    """One named split of a table partitioned by ``split``."""
    return spark.read.parquet(path).where(F.col("split") == split)


# Expressions valid in Spark and in the check engine. i = position in the row.
_SAMPLES = "1 + o_custkey % 13"
_VALUE = "CAST(((o_orderkey * 7 + i * 13 + o_custkey) % 5 + 1) * 1000 AS STRING)"
_TRUTH = "CAST((o_orderkey % 5 + 1) * 1000 AS STRING)"
_ROLLOUT = {
    "run_id": "'run' || CAST(o_orderkey % 3 AS STRING)",
    "step": "o_orderkey % 50",
    "epoch": "o_orderkey % 4",
    "prompt_id": "o_orderkey",
    "sample_idx": "CAST(i AS INT)",
    "prompt": "'How much is order ' || CAST(o_orderkey AS STRING) || ' of customer ' || CAST(o_custkey AS STRING) || '?'",
    "answer": _TRUTH,
}
_NL = "chr(10)"
_SHAPES = [
    f"'<think>' || {_NL} || 'x' || {_NL} || '</think>' || {_NL} || '<answer>' || {_NL} || v || {_NL} || '</answer>' || {_NL}",
    "'<answer>$' || substr(v, 1, 1) || ',' || substr(v, 2) || '</answer>'",
    "'<think>because a</think><answer>' || v || ' minutes</answer>'",
    "'The answer is ' || v",
    "'<answer>' || v",
    "'<answer>1</answer> wait <answer>' || substr(v, 1, 1) || ',' || substr(v, 2) || '</answer>'",
]
_RESPONSE = (
    "CASE (o_orderkey + 3 * i + o_custkey) % 6 "
    + " ".join(f"WHEN {k} THEN {s}" for k, s in enumerate(_SHAPES))
    + " END"
)

_TOKENS = "6 + o_custkey % 11"
_SEED = "(o_orderkey * 31 + o_custkey * 17 + i * 7)"
_PADS = "o_orderkey % 3"
_TOKEN = {
    "token_id": f"CASE WHEN i >= n - {_PADS} THEN 0 WHEN i = n - {_PADS} - 1 AND o_orderkey % 4 <> 0 THEN 2"
    f" ELSE {_SEED} % 97 + 4 END",
    "logp": f"-(({_SEED} % 89) / 10e0) - 5e-2",
    "old_logp": f"-(({_SEED} % 89) / 10e0) - 5e-2 + (({_SEED} % 21) - 10) / 1e2",
    "ref_logp": f"-(({_SEED} % 89) / 10e0) - 5e-2 + (({_SEED} % 31) - 15) / 5e1 + 1e-3",
    "sampling_logp": f"-(({_SEED} % 89) / 10e0) - 5e-2 + (({_SEED} % 11) - 5) / 4e1",
    "entropy": f"({_SEED} % 101) / 5e1",
    "value": f"({_SEED} % 41) / 4e1",
    "new_value": f"({_SEED} % 43) / 4e1",
    "is_prompt": "CASE WHEN i < 1 + o_orderkey % 2 THEN 1 ELSE 0 END",
}
_TOKEN["mask"] = f"CASE WHEN i >= 1 + o_orderkey % 2 AND i < n - {_PADS} THEN 1 ELSE 0 END"
TOKEN_TYPES = {"token_id": "BIGINT", "is_prompt": "INT", "mask": "INT"}
_SEQ = {
    "run_id": "'run' || CAST(o_orderkey % 3 AS STRING)",
    "step": "o_orderkey % 20",
    "seq_id": "o_orderkey",
    "prompt_id": "o_custkey",
    "advantage": "((o_custkey % 7) - 3) / 2e0",
    "score": "((o_orderkey * 3 + o_custkey) % 19) / 4e0",
}

_PAIR_LOGPS = {
    "pair_id": "o_orderkey",
    "step": "o_orderkey % 20",
    "c": "-(CAST(o_custkey % 89 AS DOUBLE) / 10e0) - 5e-2",
    "r": "-(CAST(o_custkey % 97 AS DOUBLE) / 10e0) - 5e-2",
    "c0": "-(CAST(o_orderkey % 83 AS DOUBLE) / 10e0) - 5e-2",
    "r0": "-(CAST(o_orderkey % 79 AS DOUBLE) / 10e0) - 5e-2",
    "margin": "CAST(o_orderkey % 5 AS DOUBLE) / 10e0",
    "n_c": "1 + o_custkey % 7",
    "n_r": "1 + o_orderkey % 9",
    "nll": "CAST(o_orderkey % 11 AS DOUBLE) / 4e0",
}


def _select(df: DataFrame, exprs: dict[str, str], *keep: str) -> DataFrame:
    return df.select(*keep, *[F.expr(e).alias(n) for n, e in exprs.items()])


def rollouts(spark: SparkSession, sf: str) -> DataFrame:
    """run_id, step, epoch, prompt_id, sample_idx, prompt, answer, response."""
    return rollouts_of(_orders(spark, sf)).drop("n")


def rollouts_of(orders: DataFrame, *keep: str) -> DataFrame:
    """The rollouts of an orders table or stream; stateless."""
    rows = orders.select(
        "o_orderkey", "o_custkey", *keep, F.explode(F.expr(f"sequence(0L, {_SAMPLES} - 1)")).alias("i"))
    return _select(
        rows.withColumn("v", F.expr(_VALUE)), {**_ROLLOUT, "response": _RESPONSE, "n": _SAMPLES}, *keep)


def prompts(spark: SparkSession, sf: str) -> DataFrame:
    orders = _orders(spark, sf)
    return _select(orders, {k: _ROLLOUT[k] for k in ("prompt_id", "prompt", "answer")})


_PROBLEM = {
    "prompt_id": "o_orderkey",
    "question": "'How much is order ' || CAST(o_orderkey AS STRING) || '?'",
    "solution": "CASE WHEN o_orderkey % 7 = 0 THEN ' ' || CAST(CAST(floor(o_totalprice) AS BIGINT) AS STRING) || ' '"
    f" ELSE 'Step 1: look it up' || {_NL} || '#### ' || CAST(CAST(floor(o_totalprice) AS BIGINT) AS STRING)"
    f" || {_NL} || 'end' END",
}


def problems(spark: SparkSession, sf: str) -> DataFrame:
    return _select(read(spark, sf, "orders"), _PROBLEM)


_EVAL = {
    "run_id": "'run' || CAST(o_orderkey % 3 AS STRING)",
    "question_id": "o_orderkey",
    "epoch": "CAST(e AS INT)",
    "decode": "CASE WHEN i = 0 THEN 'greedy' ELSE 'sample' END",
    "sample_idx": "CAST(CASE WHEN i = 0 THEN 0 ELSE i - 1 END AS INT)",
    "truth": "CAST(o_orderkey % 11 AS STRING)",
    # in the last epoch of one run nearly all samples go wrong, so that its greedy answers beat them
    "response": "CASE WHEN i > 0 AND e = 2 AND o_orderkey % 3 = 2 AND o_orderkey % 20 <> 0 THEN '<answer>none</answer>'"
    " ELSE '<answer>' || CAST((o_custkey + i * 3 + e * (o_orderkey % 4)) % 11 AS STRING) || ' units</answer>' END",
}
_EVAL_SAMPLES = "2 + o_custkey % 11"


def eval_rollouts(spark: SparkSession, sf: str) -> DataFrame:
    """A greedy response (i = 0) and 1 to 11 samples per question, 3 epochs."""
    orders = _orders(spark, sf)
    rows = orders.select("*", F.explode(F.expr(f"sequence(0L, {_EVAL_SAMPLES} - 1)")).alias("i"))
    return _select(rows.select("*", F.explode(F.expr("sequence(0L, 2L)")).alias("e")), _EVAL)


def token_rows(spark: SparkSession, sf: str) -> DataFrame:
    """One row per token."""
    orders = _orders(spark, sf).withColumn("n", F.expr(_TOKENS))
    rows = orders.select("*", F.explode(F.expr("sequence(0L, n - 1)")).alias("i"))
    exprs = {k: f"CAST({e} AS {TOKEN_TYPES.get(k, 'DOUBLE')})" for k, e in _TOKEN.items()}
    return _select(rows, {**_SEQ, "pos": "CAST(i AS INT)", **exprs})


def sequences(spark: SparkSession, sf: str) -> DataFrame:
    """One row per sequence; the token columns as arrays, built inside the row."""
    orders = _orders(spark, sf).withColumn("n", F.expr(_TOKENS))
    arrays = {
        f"{k}s": f"transform(sequence(0L, n - 1), i -> CAST({e} AS {TOKEN_TYPES.get(k, 'DOUBLE')}))"
        for k, e in _TOKEN.items()
    }
    return _select(orders, {**_SEQ, **arrays})


def pair_logps(spark: SparkSession, sf: str) -> DataFrame:
    return _select(_orders(spark, sf), _PAIR_LOGPS)


def pairs(spark: SparkSession, sf: str) -> DataFrame:
    """User turn, the reply to it, and the reply after that as the worse one."""
    turns = read(spark, sf, "conversations")
    asked = turns.where(F.col("role") == "user").select("conv_id", "turn", F.col("text").alias("prompt"))
    replies = turns.where(F.col("role") == "assistant")
    chosen = replies.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("chosen"))
    rejected = replies.select("conv_id", (F.col("turn") - 3).alias("turn"), F.col("text").alias("rejected"))
    return asked.join(chosen, ["conv_id", "turn"]).join(rejected, ["conv_id", "turn"], "left").select(
        (F.col("conv_id") * 1000000 + F.col("turn")).alias("pair_id"), "prompt", "chosen",
        F.coalesce("rejected", "prompt").alias("rejected"),
    )


def unpaired(spark: SparkSession, sf: str) -> DataFrame:
    """Whole documents as prompt head and completion, with a quality label."""
    docs = documents(spark, sf)
    labels = read(spark, sf, "labels").select("doc_id", "quality")
    return docs.join(labels, "doc_id").select(
        F.col("doc_id").alias("row_id"), F.substring("text", 1, 40).alias("prompt"),
        F.expr("substring(text, 41)").alias("completion"), (F.col("quality") == 1).alias("label"),
    )


def unpaired_logps(spark: SparkSession, sf: str) -> DataFrame:
    """Labelled rows with policy, reference and mismatched-pair log-probs."""
    return _select(_orders(spark, sf), _UNPAIRED_LOGPS)


_UNPAIRED_LOGPS = {
    "row_id": "o_orderkey",
    "run_id": "'run' || CAST(o_orderkey % 3 AS STRING)",
    "step": "o_orderkey % 20",
    "label": "o_custkey % 3 <> 0",
    "logp": _PAIR_LOGPS["c"],
    "ref_logp": _PAIR_LOGPS["c0"],
    "kl_logp": "-(CAST(o_custkey % 61 AS DOUBLE) / 10e0)",
    "kl_ref_logp": "-(CAST(o_orderkey % 59 AS DOUBLE) / 10e0) - 2e-1",
    "logits": "CAST(o_custkey % 13 AS DOUBLE) / 4e0",
}


def judge_ranks(spark: SparkSession, sf: str) -> DataFrame:
    return _select(_orders(spark, sf), _JUDGE)


_JUDGE = {
    "prompt_id": "o_orderkey",
    "rank": "o_custkey % 2",
    "prob": "CAST(o_custkey % 101 AS DOUBLE) / 100e0",
}

# Statistics of a model and a reference completion of one prompt.
_DUEL = {
    "prompt_id": "o_orderkey",
    "step": "o_orderkey % 20",
    "model_on_model": "-(CAST(o_custkey % 89 AS DOUBLE) / 10e0)",
    "model_on_ref": "-(CAST(o_custkey % 83 AS DOUBLE) / 10e0)",
    "ref_on_ref": "-(CAST(o_orderkey % 79 AS DOUBLE) / 10e0)",
    "ref_on_model": "-(CAST(o_orderkey % 73 AS DOUBLE) / 10e0)",
    "model_score": "CAST(o_custkey % 17 AS DOUBLE) / 4e0",
    "ref_score": "CAST(o_orderkey % 13 AS DOUBLE) / 4e0",
    "model_eos": "o_orderkey % 5 <> 0",
    "ref_eos": "o_orderkey % 7 <> 0",
}


def duels(spark: SparkSession, sf: str) -> DataFrame:
    return _select(_orders(spark, sf), _DUEL)


def steps(spark: SparkSession, sf: str) -> DataFrame:
    """Assistant turns as labelled solution steps; long form."""
    turns = read(spark, sf, "conversations").where(F.col("role") == "assistant")
    return turns.select("conv_id", "turn", F.col("text").alias("step_text"), (F.col("turn") % 4 != 3).alias("label"))


def metrics(spark: SparkSession, sf: str) -> DataFrame:
    events = read(spark, sf, "events")
    return events.select(
        F.col("user_id").alias("run_id"), F.expr("event_id div 50").alias("step"), "event_id", "ts",
        F.col("event_type").alias("name"), "value",
    )


def distributions(spark: SparkSession, sf: str) -> DataFrame:
    """Log-probabilities of ten tokens, two sides, per return flag."""
    counts = (
        read(spark, sf, "lineitem")
        .groupBy(F.col("l_returnflag").alias("pos"), F.col("l_linestatus").alias("side"),
                 (F.col("l_suppkey") % 10).alias("token"))
        .agg(F.count(F.lit(1)).cast("double").alias("n"))
    )
    totals = counts.groupBy("pos", "side").agg(F.sum("n").alias("total"))
    return counts.join(totals, ["pos", "side"]).select("pos", "side", "token", F.ln(F.col("n") / F.col("total")).alias("logp"))


# ---------------------------------------------------------------- SQL check

def _sql(exprs: dict[str, str]) -> str:
    return ", ".join(f"{e.replace('AS STRING', 'AS VARCHAR')} AS {n}" for n, e in exprs.items())


_TYPED = {k: f"CAST({e} AS {TOKEN_TYPES.get(k, 'DOUBLE')})" for k, e in _TOKEN.items()}

SQL: dict[str, str] = {
    "rollouts": f"SELECT {_sql({**_ROLLOUT, 'response': _RESPONSE})} FROM (SELECT *, "
    f"{_VALUE.replace('AS STRING', 'AS VARCHAR')} AS v FROM (SELECT o_orderkey, o_custkey, "
    f"unnest(range({_SAMPLES})) AS i FROM orders))",
    "prompts": f"SELECT {_sql({k: _ROLLOUT[k] for k in ('prompt_id', 'prompt', 'answer')})} FROM orders",
    "problems": f"SELECT {_sql(_PROBLEM)} FROM orders",
    "eval_rollouts": f"SELECT {_sql(_EVAL)} FROM (SELECT o_orderkey, o_custkey, unnest(range({_EVAL_SAMPLES})) AS i"
    " FROM orders) CROSS JOIN (SELECT unnest(range(3)) AS e)",
    "token_rows": f"SELECT {_sql({**_SEQ, 'pos': 'CAST(i AS INT)', **_TYPED})} FROM (SELECT o_orderkey, o_custkey,"
    f" {_TOKENS} AS n, unnest(range({_TOKENS})) AS i FROM orders)",
    "seqs": f"SELECT {_sql(_SEQ)} FROM orders",
    "pair_logps": f"SELECT {_sql(_PAIR_LOGPS)} FROM orders",
    "pairs": "SELECT a.conv_id * 1000000 + a.turn AS pair_id, a.text AS prompt, b.text AS chosen,"
    " coalesce(c.text, a.text) AS rejected FROM conversations a JOIN conversations b ON a.conv_id = b.conv_id"
    " AND b.turn = a.turn + 1 AND b.role = 'assistant' LEFT JOIN conversations c ON a.conv_id = c.conv_id"
    " AND c.turn = a.turn + 3 AND c.role = 'assistant' WHERE a.role = 'user'",
    "unpaired": "SELECT d.doc_id AS row_id, substr(d.text, 1, 40) AS prompt, substr(d.text, 41) AS completion,"
    " l.quality = 1 AS label FROM documents d JOIN labels l ON d.doc_id = l.doc_id",
    "unpaired_logps": f"SELECT {_sql(_UNPAIRED_LOGPS)} FROM orders",
    "judge_ranks": f"SELECT {_sql(_JUDGE)} FROM orders",
    "duels": f"SELECT {_sql(_DUEL)} FROM orders",
    "steps": "SELECT conv_id, turn, text AS step_text, turn % 4 <> 3 AS label FROM conversations WHERE role = 'assistant'",
    "metrics": "SELECT user_id AS run_id, event_id // 50 AS step, event_id, ts, event_type AS name, value FROM events",
    "distributions": "SELECT pos, side, token, ln(n / sum(n) OVER (PARTITION BY pos, side)) AS logp FROM (SELECT"
    " l_returnflag AS pos, l_linestatus AS side, l_suppkey % 10 AS token, CAST(count(*) AS DOUBLE) AS n FROM lineitem"
    " GROUP BY l_returnflag, l_linestatus, l_suppkey % 10)",
}

SPARK: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "rollouts": rollouts, "prompts": prompts, "problems": problems, "eval_rollouts": eval_rollouts,
    "token_rows": token_rows, "pair_logps": pair_logps, "pairs": pairs, "unpaired": unpaired,
    "unpaired_logps": unpaired_logps, "judge_ranks": judge_ranks, "duels": duels, "steps": steps,
    "metrics": metrics, "distributions": distributions,
}
