from __future__ import annotations

import re

import pandas as pd
import pytest
from pyspark.sql import functions as F

from rollforge.functions import text as X
from rollforge.operators import chat
from rollforge.operators import prep as P
from rollforge.operators import rewards as R


def column(spark, values, build):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r["o"] for r in rows.select("i", build(F.col("v")).alias("o")).orderBy("i").collect()]


def plain_normalise(text):
    """The rule in plain Python, to compare with."""
    text = re.sub(r"(\d),(\d)", r"\1\2", text.replace("$", "")).strip()
    number = re.match(r"\d+(?:\.\d+)?", text)
    return number.group(0) if number else text


NORMAL = ["$108", "$360,000", "1350 minutes", "40 minutes", "1,2,3", "-5 apples", ".5", "3.50", "1/2", "10%", "a1,234",
          " 75 miles per hour ", "", " 7　", "12\n13", "x\ny", "1,234,567.80 dollars", "٣٤ units"]


def test_normalise_equals_plain_rule(spark):
    assert column(spark, NORMAL, X.normalize_answer) == [plain_normalise(v) for v in NORMAL]


def test_strip_equals_python(spark):
    values = ["  a b  ", "\x1c\x1dq\x85", "\t\n\x0b\x0c\r z", "none", ""]
    assert column(spark, values, X.strip) == [v.strip() for v in values]


def test_tagged_answer(spark):
    values = ["<answer> 5 </answer>", "no tag ", "<answer>1</answer> then <answer>2</answer> end", "<answer>open", "a</answer>b"]
    assert column(spark, values, X.tagged_answer) == ["5", "no tag", "2", "open", "a"]


def test_final_answer(spark):
    values = ["steps\n#### 42\nend", " 7 ", "#### 1 #### 2", None, "#### "]
    assert column(spark, values, X.final_answer) == ["42", "7", "1 #### 2", "", ""]


def test_leading_common(spark):
    rows = spark.createDataFrame([("abcd", "abxy"), ("same", "same"), ("a", "abc"), ("", "z")], "a string, b string")
    out = [r[0] for r in rows.select(X.leading_common(F.col("a"), F.col("b"))).collect()]
    assert out == [2, 4, 1, 0]


def test_extract_prompt_rejoins(spark):
    pairs = spark.createDataFrame([(1, "Q: hi A: yes", "Q: hi A: no"), (2, "x", "x")], "pair_id int, chosen string, rejected string")
    out = {r["pair_id"]: r for r in chat.extract_prompt(pairs).collect()}
    assert (out[1]["prompt"], out[1]["chosen"], out[1]["rejected"]) == ("Q: hi A: ", "yes", "no")
    assert (out[2]["prompt"], out[2]["chosen"], out[2]["rejected"]) == ("x", "", "")


ROLLOUTS = [
    # response, answer, correctness, strict, digit, format, strict format, marks, strict marks
    ("<think>\nx\n</think>\n<answer>\n12\n</answer>\n", "12", 2.0, 2.0, 0.5, 0.5, 0.5, 0.5, 0.5),
    ("<think>a</think><answer>12 minutes</answer>", "12", 2.0, 0.0, 0.0, 0.5, 0.0, 0.5, 0.0),
    ("<answer>$1,200</answer>", "1200", 2.0, 0.0, 0.0, 0.25, 0.0, 0.25, 0.0),
    ("just 5", "5", 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0),
    ("<answer>5", "5", 2.0, 2.0, 0.5, 0.0, 0.0, 0.125, 0.0),
]


def test_reward_breakdown(spark):
    fns = [R.correctness, R.correctness_strict, R.digit, R.format_partial, R.format_strict, R.marks, R.marks_strict]
    specs = [R.RewardSpec(f.__name__, f) for f in fns]
    rows = spark.createDataFrame([(i, r[0], r[1]) for i, r in enumerate(ROLLOUTS)], "i int, response string, answer string")
    out = R.score(rows, specs).orderBy("i").collect()
    for got, want in zip(out, ROLLOUTS):
        assert [got[f"reward_{s.name}"] for s in specs] == list(want[2:])


def test_heuristic_and_word_boundary(spark):
    rows = spark.createDataFrame([("it is also 14 <think> <answer>", "4")], "response string, answer string")
    p, r, a = F.lit(None).cast("string"), F.col("response"), F.col("answer")
    loose, strict = rows.select(R.heuristic(p, r, a), R.heuristic(p, r, a, word_boundary=True)).first()
    assert loose == pytest.approx(0.006 + 0.5 + 0.3 + 0.1)
    assert strict == pytest.approx(0.006 + 0.5 + 0.3)


def test_missing_reward_policies(spark):
    specs = [R.RewardSpec("a", R.steps, 1.0), R.RewardSpec("b", R.steps, 2.0)]
    rows = spark.createDataFrame([(1, 1.0, 2.0), (2, None, 2.0), (3, float("nan"), 1.0), (4, float("inf"), 1.0), (5, None, None)],
                                 "i int, reward_a double, reward_b double")
    zero = {r["i"]: r["reward"] for r in R.combine(rows, specs, "zero_total").collect()}
    skip = {r["i"]: r["reward"] for r in R.combine(rows, specs, "skip").collect()}
    assert zero == {1: 5.0, 2: 0.0, 3: 0.0, 4: 10.0, 5: 0.0}
    assert (skip[1], skip[2], skip[3], skip[5]) == (5.0, 4.0, 2.0, 0.0)
    long = R.long_rewards(rows, specs, ["i"])
    for policy, want in (("zero_total", zero), ("skip", skip)):
        got = {r["i"]: r["reward"] for r in R.combine_long(long, ["i"], {"a": 1.0, "b": 2.0}, policy).collect()}
        assert got == want
    assert [r["i"] for r in R.unscored(rows, specs).collect()] == [5]


def test_weight_count_is_checked():
    with pytest.raises(ValueError):
        R.weighted(R.STANDARD, [1.0, 2.0])


def test_extra_column_reaches_reward(spark):
    spec = R.RewardSpec("bonus", lambda prompt, response, answer, level: F.col("level") * 2, extra=("level",))
    rows = spark.createDataFrame([("r", "a", 3)], "response string, answer string, level int")
    assert R.score(rows, [spec]).first()["reward_bonus"] == 6.0
    with pytest.raises(ValueError):
        R.score(rows.drop("level"), [spec])


def test_python_reward_and_tokenizer_hatches(spark):
    @F.pandas_udf("double")
    def length(response: pd.Series) -> pd.Series:
        return response.str.len().astype("float64")

    @F.pandas_udf("array<bigint>")
    def code_points(text: pd.Series) -> pd.Series:
        return text.map(lambda t: [ord(c) for c in t])

    rows = spark.createDataFrame([("abc", "x")], "response string, answer string")
    spec = R.RewardSpec("length", lambda prompt, response, answer: length(response))
    assert R.score(rows, [spec]).first()["reward_length"] == 3.0
    assert P.prep_texts(rows, "response", 2, code_points).first()["input_ids"] == [97, 98]


def test_render_splits_long_conversations(spark):
    rows = [(1, t, "user" if t % 2 == 0 else "assistant", f"m{t}") for t in range(10)] + [(2, 0, "system", "s")]
    turns = spark.createDataFrame(rows, "conv_id int, turn int, role string, text string")
    whole = {r["conv_id"]: r["text"] for r in chat.render(turns).collect()}
    parts = chat.render(turns, part_turns=3).orderBy("conv_id", "part").collect()
    joined = {c: "".join(r["text"] for r in parts if r["conv_id"] == c) for c in (1, 2)}
    assert joined == whole and len(parts) == 5
    assert whole[2] == "<|system|>\ns\n<|assistant|>\n"
    sparse = spark.createDataFrame([(1, t, "user", f"m{t}") for t in (0, 600, 1200)], turns.schema)
    assert chat.render(sparse).count() == 1 and chat.render(sparse, part_turns=3).count() == 1
