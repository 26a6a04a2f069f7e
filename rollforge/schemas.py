"""Input checks: a job that misses a column fails before it runs."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import types as T

TOKEN_IDS = T.ArrayType(T.LongType())
MESSAGE = T.StructType([T.StructField("role", T.StringType()), T.StructField("content", T.StringType())])
RECORD = T.StructType([T.StructField(c, T.StringType()) for c in ("prompt", "answer", "instruction", "input")])

EOS_ID = 2
BOS_ID = 1
PAD_ID = 0
IGNORED_LABEL = -100


def require(df: DataFrame, columns: Iterable[str], job: str) -> DataFrame:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"{job}: missing columns {missing}; found {df.columns}")
    return df


def one_of(value: str, allowed: Iterable[str], what: str) -> str:
    allowed = list(allowed)
    if value not in allowed:
        raise ValueError(f"unknown {what} {value!r}; expected one of {allowed}")
    return value
