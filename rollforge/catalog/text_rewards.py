"""Queries: scans and text projections, and reward scoring."""

from __future__ import annotations

from pyspark.sql import functions as F

from rollforge.catalog.registry import q, query, rounded, sql_normal, sql_strip, sql_tagged, sql_words
from rollforge.functions import text as X
from rollforge.functions import tokens as K
from rollforge.operators import chat, hatches
from rollforge.operators import rewards as R
from rollforge.schemas import EOS_ID
from rollforge.sources import tables as T

ID = ("prompt_id", "sample_idx")


@query("extract_final_answer", uses=["problems"], sql=f"""
SELECT prompt_id, CASE WHEN regexp_matches(solution, '####\\s*[^\\n]+')
  THEN {sql_strip("regexp_extract(solution, '####\\s*([^\\n]+)', 1)")} ELSE {sql_strip('solution')} END AS answer
FROM problems""")
def _(spark, sf):
    return T.problems(spark, sf).select("prompt_id", X.final_answer(F.col("solution")).alias("answer"))


@query("extract_tagged_answer", uses=["rollouts"],
       sql=f"SELECT prompt_id, sample_idx, {sql_tagged('response')} AS given FROM rollouts")
def _(spark, sf):
    return T.rollouts(spark, sf).select(*ID, X.tagged_answer(F.col("response")).alias("given"))


@query("normalize_answer", uses=["rollouts"],
       sql=f"SELECT prompt_id, sample_idx, {sql_normal('given')} AS given FROM"
           f" (SELECT *, {sql_tagged('response')} AS given FROM rollouts)")
def _(spark, sf):
    return T.rollouts(spark, sf).select(
        *ID, X.normalize_answer(X.tagged_answer(F.col("response"))).alias("given"))


@query("format_flags", uses=["rollouts"], sql="""
SELECT prompt_id, sample_idx, contains(response, '<think>') AND contains(response, '</think>') AS has_think,
 contains(response, '<answer>') AND contains(response, '</answer>') AS has_answer FROM rollouts""")
def _(spark, sf):
    r = F.col("response")
    return T.rollouts(spark, sf).select(
        *ID, X.has(r, X.THINK_OPEN, X.THINK_CLOSE).alias("has_think"),
        X.has(r, X.ANSWER_OPEN, X.ANSWER_CLOSE).alias("has_answer"))


@query("project_columns", uses=["rollouts"], sql="SELECT prompt_id, sample_idx, answer FROM rollouts")
def _(spark, sf):
    return chat.keep_columns(T.rollouts(spark, sf), ["prompt_id", "sample_idx", "answer"])


_MSG = ("CASE role WHEN 'system' THEN '<|system|>' || chr(10) || text || chr(10) WHEN 'user' THEN '<|user|>'"
        " || chr(10) || text || chr(10) WHEN 'assistant' THEN '<|assistant|>' || chr(10) || text || chr(10) END")


@query("render_chat", sql=f"""
SELECT conv_id, md5(body || '<|assistant|>' || chr(10)) AS digest, CAST(length(body) + 14 AS BIGINT) AS chars
FROM (SELECT conv_id, string_agg({_MSG}, '' ORDER BY turn) AS body FROM conversations GROUP BY conv_id)""")
def _(spark, sf):
    rendered = chat.render(T.read(spark, sf, "conversations"))
    return rendered.select("conv_id", F.md5("text").alias("digest"),
                           F.length("text").cast("bigint").alias("chars"))


@query("fallback_prompt", sql="""
SELECT conv_id, md5('Be brief.' || chr(10) || 'Question: ' || arg_max(text, turn) || chr(10) || 'Answer:') AS digest
FROM conversations WHERE role = 'user' GROUP BY conv_id""")
def _(spark, sf):
    last = chat.last_user_turn(T.read(spark, sf, "conversations"))
    return last.select("conv_id", F.md5(X.fallback_prompt(F.lit("Be brief."), F.col("text"))).alias("digest"))


@query("last_user_turn", sql="""
SELECT conv_id, max(turn) AS turn, arg_max(text, turn) AS text FROM conversations WHERE role = 'user' GROUP BY conv_id""")
def _(spark, sf):
    return chat.last_user_turn(T.read(spark, sf, "conversations"))


@query("assistant_bootstrap", ctes="""
l AS (SELECT conv_id, max(turn) AS last_turn, arg_max(role, turn) AS last_role FROM conversations GROUP BY conv_id)""",
       sql="""
SELECT c.conv_id, count(*) FILTER (WHERE NOT (turn = last_turn AND last_role = 'assistant')) AS prompt_turns,
 sum(CASE WHEN turn = last_turn AND last_role = 'assistant' THEN 0 ELSE length(text) END)::BIGINT AS prompt_chars,
 coalesce(max(CASE WHEN turn = last_turn AND last_role = 'assistant' THEN text END), '') AS bootstrap
FROM conversations c JOIN l ON c.conv_id = l.conv_id GROUP BY c.conv_id""")
def _(spark, sf):
    turns = chat.split_bootstrap(T.read(spark, sf, "conversations"))
    return turns.groupBy("conv_id").agg(
        F.count(F.when(~F.col("is_bootstrap"), 1)).alias("prompt_turns"),
        F.sum(F.when(F.col("is_bootstrap"), 0).otherwise(F.length("text"))).alias("prompt_chars"),
        F.coalesce(F.max(F.when(F.col("is_bootstrap"), F.col("text"))), F.lit("")).alias("bootstrap"))


@query("extract_prompt", uses=["pairs"], ctes="""
w AS (SELECT pair_id, prompt || ' ' || chosen AS a, prompt || ' ' || rejected AS b FROM pairs),
ch AS (SELECT pair_id, unnest(range(1, least(length(a), length(b)) + 1)) AS i, a, b FROM w),
d AS (SELECT pair_id, min(i) AS first_diff FROM ch WHERE substr(a, i, 1) <> substr(b, i, 1) GROUP BY pair_id)""",
       sql="""
SELECT pair_id, substr(a, 1, n) AS prompt, md5(substr(a, n + 1)) AS chosen, md5(substr(b, n + 1)) AS rejected
FROM (SELECT w.*, CASE WHEN first_diff IS NULL THEN least(length(a), length(b)) ELSE first_diff - 1 END AS n
 FROM w LEFT JOIN d ON w.pair_id = d.pair_id)""")
def _(spark, sf):
    p = T.pairs(spark, sf).select(
        "pair_id", F.concat_ws(" ", "prompt", "chosen").alias("chosen"),
        F.concat_ws(" ", "prompt", "rejected").alias("rejected"))
    return chat.extract_prompt(p).select(
        "pair_id", "prompt", F.md5("chosen").alias("chosen"), F.md5("rejected").alias("rejected"))


@query("strip_leading_pad", uses=["rollouts"], sql="""
SELECT prompt_id, sample_idx, regexp_replace(regexp_replace(t, '^(<pad>)+', ''), '(<img>)+', '<img>', 'g') AS text
FROM (SELECT *, repeat('<pad>', CAST(prompt_id % 4 AS BIGINT)) || answer || repeat('<img>', CAST(prompt_id % 3 AS BIGINT))
 || '<pad>' AS t FROM rollouts)""")
def _(spark, sf):
    t = F.concat(F.expr("repeat('<pad>', cast(prompt_id % 4 as int))"), "answer",
                 F.expr("repeat('<img>', cast(prompt_id % 3 as int))"), F.lit("<pad>"))
    return T.rollouts(spark, sf).select(
        *ID, X.collapse_repeats(X.without_leading(t, "<pad>"), "<img>").alias("text"))


@query("format_rows", uses=["problems"], sql="""
SELECT prompt_id, CAST(0 AS INT) AS part, 'Q: ' || question AS text FROM problems UNION ALL
SELECT prompt_id, CAST(1 AS INT), 'A: ' || solution FROM problems""")
def _(spark, sf):
    return chat.format_rows(
        T.problems(spark, sf),
        lambda row: F.array(F.concat(F.lit("Q: "), row["question"]), F.concat(F.lit("A: "), row["solution"])),
        ["prompt_id"])


@query("format_rows_batches", uses=["problems"], sql="""
SELECT prompt_id, CAST(i - 1 AS INT) AS part, parts[i] AS text FROM (
 SELECT prompt_id, parts, unnest(range(1, len(parts) + 1)) AS i FROM (
  SELECT prompt_id, list_filter(list_prepend(question, string_split(solution, chr(10))), lambda x: x <> '') AS parts FROM problems))""")
def _(spark, sf):
    def lines(batch):
        pairs = zip(batch["question"], batch["solution"], strict=True)
        return [[line for line in [question, *solution.split("\n")] if line] for question, solution in pairs]

    return hatches.format_batches(T.problems(spark, sf), lines, ["question", "solution"], ["prompt_id"])


@query("reward_python", uses=["rollouts"], sql=f"""
SELECT prompt_id, sample_idx, {q("CASE WHEN response NOT LIKE '%<answer>%' THEN NULL ELSE least(len(string_split(response, ' ')), 3) / 4e0 END", 'reward_words')}
FROM rollouts""")
def _(spark, sf):
    def words(prompts, responses, answers):
        return [min(len(r.split(" ")), 3) / 4 if "<answer>" in r else None for r in responses]

    spec = R.RewardSpec("words", hatches.python_reward(words))
    return R.score(T.rollouts(spark, sf), [spec]).select("prompt_id", "sample_idx", rounded("reward_words"))


@query("double_bos_check", uses=["rollouts"], sql="""
SELECT count(*) AS rows, count(*) FILTER (WHERE starts_with(response, '<think>')) AS doubled FROM rollouts""")
def _(spark, sf):
    return chat.double_bos(T.rollouts(spark, sf), "response", "<think>")


# ------------------------------------------------------------------ rewards

def _sql_hit(test: str, points: str) -> str:
    return f"CASE WHEN {test} THEN {points} ELSE 0e0 END"


_GIVEN, _R = sql_tagged("response"), "response"
SQL_REWARD = {
    "correctness": _sql_hit(f"{sql_normal(_GIVEN)} = {sql_normal('answer')}", "2e0"),
    "correctness_strict": _sql_hit(f"{_GIVEN} = answer", "2e0"),
    "digit": _sql_hit(f"regexp_full_match({_GIVEN}, '[0-9]+')", "0.5e0"),
    "format_partial": "CASE WHEN contains(response, '<think>') AND contains(response, '</think>') AND"
                      " contains(response, '<answer>') AND contains(response, '</answer>') THEN 0.5e0"
                      " WHEN contains(response, '<answer>') AND contains(response, '</answer>') THEN 0.25e0 ELSE 0e0 END",
    "format_strict": _sql_hit("regexp_full_match(response, '<think>\\n.*?\\n</think>\\n<answer>\\n.*?\\n</answer>\\n')", "0.5e0"),
    "marks": " + ".join(_sql_hit(f"contains(response, '{t}')", "0.125e0") for t in X.TAGS),
    "marks_strict": " + ".join(
        _sql_hit(f"len(string_split(response, '{t}' || chr(10))) = 2", "0.125e0") for t in X.TAGS),
    "heuristic": f"least(len({sql_words('response')}) / 100e0, 1e0) * 0.1e0 + "
                 + _sql_hit("answer <> '' AND contains(lower(response), lower(answer))", "0.5e0") + " + "
                 + _sql_hit("contains(response, '<think>') AND contains(response, '<answer>')", "0.3e0") + " + "
                 + _sql_hit("regexp_matches(lower(response), 'because|therefore|thus|so')", "0.1e0"),
    "steps": "least(1e0, (length(response) - length(replace(response, chr(10), ''))) * 0.1e0)",
    "unique_chars": "CAST(len(list_distinct(string_split(response, ''))) AS DOUBLE)",
}
_FN = {
    "correctness": R.correctness, "correctness_strict": R.correctness_strict, "digit": R.digit,
    "format_partial": R.format_partial, "format_strict": R.format_strict, "marks": R.marks,
    "marks_strict": R.marks_strict, "heuristic": R.heuristic, "steps": R.steps, "unique_chars": R.unique_chars,
}


def _reward_query(name: str) -> None:
    @query(f"reward_{name}", uses=["rollouts"],
           sql=f"SELECT prompt_id, sample_idx, {q(SQL_REWARD[name], 'value')} FROM rollouts")
    def _(spark, sf):
        spec = R.RewardSpec(name, _FN[name])
        return R.score(T.rollouts(spark, sf), [spec]).select(*ID, rounded(f"reward_{name}").alias("value"))


for _name in _FN:
    _reward_query(_name)


@query("missing_stop_penalty", uses=["token_rows"], sql=f"""
SELECT seq_id, {q("max(score) - CASE WHEN bool_or(token_id = 2) THEN 0e0 ELSE 1e0 END", 'score')}
FROM token_rows GROUP BY seq_id""")
def _(spark, sf):
    return T.sequences(spark, sf).select(
        "seq_id", rounded(R.missing_stop_penalty(F.col("score"), F.col("token_ids"), EOS_ID, 1.0), "score"))


WEIGHTS = (1.0, 0.5, 2.0, 1.5)
# one function that applies only to tagged responses, so that values are missing
TAGGED_ONLY = R.RewardSpec(
    "tagged_digit",
    lambda prompt, response, answer: F.when(response.contains(X.ANSWER_OPEN), R.digit(prompt, response, answer)))
MIXED = [*R.weighted(R.STANDARD, WEIGHTS), TAGGED_ONLY]
SQL_MIXED = [
    *[(n, SQL_REWARD[f], w) for (n, f), w in zip(
        [("correctness", "correctness"), ("digit", "digit"), ("format", "format_partial"), ("marks", "marks")], WEIGHTS)],
    ("tagged_digit", f"CASE WHEN contains(response, '<answer>') THEN {SQL_REWARD['digit']} END", 1.0),
]
SCORED_SQL = "scored AS (SELECT *, " + ", ".join(f"{e} AS reward_{n}" for n, e, _ in SQL_MIXED) + " FROM rollouts)"
TOTAL_ZERO = "coalesce(" + " + ".join(f"reward_{n} * {w}e0" for n, _, w in SQL_MIXED) + ", 0e0)"
TOTAL_SKIP = " + ".join(f"coalesce(reward_{n}, 0e0) * {w}e0" for n, _, w in SQL_MIXED)


def scored(spark, sf):
    return R.score(T.rollouts(spark, sf), MIXED)


@query("combine_rewards", uses=["rollouts"], ctes=SCORED_SQL, sql=f"""
SELECT prompt_id, sample_idx, {q(TOTAL_ZERO, 'zero_total')}, {q(TOTAL_SKIP, 'skip')} FROM scored""")
def _(spark, sf):
    both = R.combine(R.combine(scored(spark, sf), MIXED, "zero_total", "zero_total"), MIXED, "skip", "skip")
    return both.select(*ID, rounded("zero_total"), rounded("skip"))


@query("combine_rewards_long", uses=["rollouts"], ctes=SCORED_SQL, sql=f"""
SELECT prompt_id, sample_idx, {q(TOTAL_SKIP, 'reward')} FROM scored""")
def _(spark, sf):
    long = R.long_rewards(scored(spark, sf), MIXED, ID)
    return R.combine_long(long, ID, {s.name: s.weight for s in MIXED}, "skip").select(*ID, rounded("reward"))


@query("clip_rewards", uses=["rollouts"], ctes=SCORED_SQL, sql=f"""
SELECT prompt_id, sample_idx, {q(f"greatest(0.5e0, least(3e0, {TOTAL_SKIP}))", 'reward')} FROM scored""")
def _(spark, sf):
    return R.clip(R.combine(scored(spark, sf), MIXED, "skip"), 0.5, 3.0).select(*ID, rounded("reward"))


@query("kl_penalised_reward", uses=["token_rows"], sql=f"""
SELECT seq_id, {q("max(score) - 0.1e0 * sum(CASE WHEN mask <> 0 THEN old_logp - ref_logp ELSE 0e0 END)", 'reward')}
FROM token_rows GROUP BY seq_id""")
def _(spark, sf):
    return T.sequences(spark, sf).select("seq_id", rounded(
        R.kl_penalised(F.col("score"), F.col("old_logps"), F.col("ref_logps"), F.col("masks"), 0.1), "reward"))


@query("unscored_rollouts", uses=["rollouts"],
       sql="SELECT prompt_id, sample_idx FROM rollouts WHERE NOT contains(response, '<answer>')")
def _(spark, sf):
    return R.unscored(R.score(T.rollouts(spark, sf), [TAGGED_ONLY]), [TAGGED_ONLY]).select(*ID)


_GRADES = (f"g AS (SELECT {_GIVEN} = answer AS strict, {sql_normal(_GIVEN)} = {sql_normal('answer')} AS lenient"
           " FROM rollouts)")


@query("grader_disagreement", uses=["rollouts"], ctes=_GRADES,
       sql="SELECT strict, lenient, count(*) AS n FROM g GROUP BY ALL")
def _(spark, sf):
    return R.grader_disagreement(T.rollouts(spark, sf))


@query("grader_false_negatives", uses=["rollouts"], ctes=_GRADES, sql=f"""
SELECT count(*) AS rows, count(*) FILTER (WHERE NOT strict AND lenient) AS false_negatives,
 {q("count(*) FILTER (WHERE NOT strict AND lenient) / CAST(count(*) AS DOUBLE)", 'rate')} FROM g""")
def _(spark, sf):
    return R.false_negative_rate(T.rollouts(spark, sf)).withColumn("rate", rounded("rate"))
