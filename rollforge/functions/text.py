"""Column builders for response and answer text."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: the tags that responses are expected to carry
THINK_OPEN, THINK_CLOSE = "<think>", "</think>"
ANSWER_OPEN, ANSWER_CLOSE = "<answer>", "</answer>"
TAGS = (THINK_OPEN, THINK_CLOSE, ANSWER_OPEN, ANSWER_CLOSE)

# fixed values: the characters that count as whitespace around an answer
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
_SPACE = f"[{WHITESPACE}]"


def strip(text: Column) -> Column:
    """Trim by a character list: no regular expression in the hot path."""
    return F.btrim(text, F.lit(WHITESPACE))


def final_answer(solution: Column) -> Column:
    """Text after the first ``####`` up to the line end, else the whole text."""
    marked = F.regexp_extract(solution, r"(?U)####\s*([^\n]+)", 1)
    found = solution.rlike(r"(?U)####\s*[^\n]+")
    return F.coalesce(F.when(found, strip(marked)).otherwise(strip(solution)), F.lit(""))


def tagged_answer(response: Column) -> Column:
    """Text between the last opening answer tag and the next closing one."""
    tail = F.substring_index(response, ANSWER_OPEN, -1)
    return strip(F.substring_index(tail, ANSWER_CLOSE, 1))


def normalize_answer(text: Column) -> Column:
    """Drop ``$``, join ``digit,digit``, keep a leading number if there is one."""
    plain = F.replace(text, F.lit("$"), F.lit(""))
    grouped = F.regexp_replace(plain, r"(?U)(\d),(\d)", "$1$2")
    joined = strip(F.when(text.contains(","), grouped).otherwise(plain))
    return F.regexp_replace(joined, r"(?Us)\A(\d+(?:\.\d+)?).*\z", "$1")


def has(text: Column, *parts: str) -> Column:
    found = text.contains(parts[0])
    for p in parts[1:]:
        found = found & text.contains(p)
    return found


def word_count(text: Column) -> Column:
    return F.size(F.filter(F.split(text, rf"{_SPACE}+"), lambda w: w != ""))


def occurrences(text: Column, part: str) -> Column:
    """Non-overlapping occurrences of a literal."""
    return ((F.length(text) - F.length(F.replace(text, F.lit(part), F.lit("")))) / len(part)).cast("int")


def leading_common(a: Column, b: Column) -> Column:
    """Number of leading characters two texts share."""
    same = F.zip_with(F.split(a, ""), F.split(b, ""), lambda x, y: x.eqNullSafe(y))
    first = F.array_position(same, False)
    return F.when(first == 0, F.length(a).cast("bigint")).otherwise(first - 1)


def cut(text: Column, limit: int) -> Column:
    """First ``limit`` characters for a printed preview, marked when shortened."""
    return F.when(F.length(text) > limit, F.concat(F.substring(text, 1, limit), F.lit("..."))).otherwise(text)


def without_leading(text: Column, marker: str) -> Column:
    return F.regexp_replace(text, rf"\A(\Q{marker}\E)+", "")


def collapse_repeats(text: Column, marker: str) -> Column:
    return F.regexp_replace(text, rf"(\Q{marker}\E)+", marker.replace("\\", "\\\\").replace("$", "\\$"))


# fixed values: two literals per role, before and after the content
CHAT_TEMPLATE: Mapping[str, tuple[str, str]] = {
    "system": ("<|system|>\n", "\n"),
    "user": ("<|user|>\n", "\n"),
    "assistant": ("<|assistant|>\n", "\n"),
}
GENERATION_PROMPT = "<|assistant|>\n"


def render_message(
    role: Column, content: Column, template: Mapping[str, tuple[str, str]] = CHAT_TEMPLATE
) -> Column:
    rendered = F.lit(None).cast("string")
    for name, (before, after) in template.items():
        rendered = F.when(role == name, F.concat(F.lit(before), content, F.lit(after))).otherwise(rendered)
    return rendered


def fallback_prompt(system: Column, question: Column) -> Column:
    """Prompt used when there is no chat template."""
    return F.concat(system, F.lit("\nQuestion: "), question, F.lit("\nAnswer:"))
