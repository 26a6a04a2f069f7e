"""Registry of named queries and the SQL each is checked against."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rollforge.sources.tables import SQL

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
CHECKS: dict[str, str] = {}

DIGITS = 6


def query(name: str, sql: str | None = None, uses: Sequence[str] = (), ctes: str = "") -> Callable[[Query], Query]:
    """Register ``name``; ``uses`` names the derived input tables of the SQL."""

    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = fn
        if sql is not None:
            parts = [f"{t} AS ({SQL[t]})" for t in uses]
            if ctes:
                parts.append(ctes)
            CHECKS[name] = (f"WITH {', '.join(parts)} " if parts else "") + sql
        return fn

    return register


def rounded(value: Column | str, name: str | None = None) -> Column:
    """Value rounded for comparison, negative zero folded into zero."""
    col = F.col(value) if isinstance(value, str) else value
    r = F.round(col, DIGITS)
    out = F.when(r == 0, 0.0).otherwise(r)
    return out.alias(name or value) if (name or isinstance(value, str)) else out


def q(expr: str, name: str | None = None) -> str:
    """SQL twin of ``rounded``."""
    r = f"round(CAST({expr} AS DOUBLE), {DIGITS})"
    out = f"CASE WHEN {r} = 0 THEN 0e0 ELSE {r} END"
    return f"{out} AS {name}" if name else f"({out})"


# SQL twins of the text and numeric Column builders

def sql_strip(e: str) -> str:
    return f"regexp_replace({e}, '^\\s+|\\s+$', '', 'g')"


def sql_tagged(e: str) -> str:
    return sql_strip(f"split_part(string_split({e}, '<answer>')[-1], '</answer>', 1)")


def sql_normal(e: str) -> str:
    j = sql_strip(f"regexp_replace(replace({e}, '$', ''), '(\\d),(\\d)', '\\1\\2', 'g')")
    n = f"regexp_extract({j}, '^(\\d+(?:\\.\\d+)?)', 1)"
    return f"(CASE WHEN {n} <> '' THEN {n} ELSE {j} END)"


def sql_ls(x: str) -> str:
    return f"(CASE WHEN ({x}) >= 0 THEN -ln(1 + exp(-({x}))) ELSE ({x}) - ln(1 + exp({x})) END)"


def sql_sigmoid(x: str) -> str:
    return f"(1 / (1 + exp(-({x}))))"


def sql_words(e: str) -> str:
    return f"list_filter(regexp_split_to_array({e}, '\\s+'), lambda w: w <> '')"


def sql_tokens(e: str) -> str:
    return (
        f"list_transform({sql_words(e)}, lambda w: 4 + CAST('0x' || substr(md5(w), 1, 8) AS BIGINT) % 1000003)"
    )


def sql_ids(e: str) -> str:
    return f"array_to_string({e}, ',')"
