"""User functions over Arrow batches, where Columns cannot say it.

A function is called once per batch and gets whole columns, never single rows.
What it gives back is checked against what was declared, and an error names the
function. Every result stays where its rows are; only figures are shuffled.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollforge.schemas import one_of, require

MERGES = {"sum": F.sum, "min": F.min, "max": F.max}
ARROW_TYPES = {"bigint": pa.int64(), "double": pa.float64(), "string": pa.string(), "boolean": pa.bool_()}


def _checked(values: object, kind: pa.DataType, n: int, what: str) -> pa.Array:
    try:
        array = values if isinstance(values, pa.Array) else pa.array(values, kind)
    except (pa.ArrowInvalid, pa.ArrowTypeError, TypeError) as e:
        raise ValueError(f"{what}: not {kind}: {e}") from e
    if len(array) != n:
        raise ValueError(f"{what}: {len(array)} values for {n} rows")
    if array.type != kind:
        raise ValueError(f"{what}: {array.type} instead of {kind}")
    return array


def python_reward(fn: Callable[..., Sequence[float | None]]) -> Callable[..., Column]:
    """A reward function from ``fn(prompts, responses, answers, **extra)`` over
    lists to one float or None per response, for ``RewardSpec``."""
    name = getattr(fn, "__name__", "reward")

    def reward(prompt: Column, response: Column, answer: Column, **extra: Column) -> Column:
        names = list(extra)

        @F.arrow_udf(T.DoubleType())
        def call(prompts: pa.Array, responses: pa.Array, answers: pa.Array, *rest: pa.Array) -> pa.Array:
            given = {k: v.to_pylist() for k, v in zip(names, rest, strict=True)}
            found = fn(prompts.to_pylist(), responses.to_pylist(), answers.to_pylist(), **given)
            return _checked(found, pa.float64(), len(responses), f"reward {name}")

        return call(prompt, response, answer, *extra.values())

    return reward


def format_batches(
    df: DataFrame, formatter: Callable[[dict[str, list]], Sequence[Sequence[str]]], columns: Sequence[str], keep: Sequence[str]
) -> DataFrame:
    """One row to many texts: keep, part, text. ``formatter`` gets a batch of
    ``columns`` as lists and gives a list of texts per row; a row without texts
    (an empty list or None) gives no rows."""
    require(df, [*columns, *keep], "format_batches")
    columns, name = list(columns), getattr(formatter, "__name__", "formatter")

    @F.arrow_udf(T.ArrayType(T.StringType()))
    def call(*arrays: pa.Array) -> pa.Array:
        given = {c: a.to_pylist() for c, a in zip(columns, arrays, strict=True)}
        return _checked(formatter(given), pa.list_(pa.string()), len(arrays[0]), f"formatter {name}")

    return df.select(*keep, F.posexplode(call(*[F.col(c) for c in columns])).alias("part", "text"))


def batch_metric(
    df: DataFrame, keys: Sequence[str], columns: Sequence[str], partial: Callable[[pa.RecordBatch], pa.RecordBatch],
    parts: Mapping[str, tuple[str, str]],
) -> DataFrame:
    """Figures per ``keys`` from partial ones: keys, then the names in ``parts``.

    ``partial`` gets a batch of (keys, columns) and gives rows of (keys, names),
    several per key if it likes; ``parts`` names each figure's type (bigint,
    double, string or boolean) and how partial ones are merged (sum, min or
    max). So no group is ever in one call, however large it is. Other figures,
    such as means, follow from merged ones.
    """
    keys, columns = list(keys), list(columns)
    require(df, [*keys, *columns], "batch_metric")
    for kind, merge in parts.values():
        one_of(kind, ARROW_TYPES, "type")
        one_of(merge, MERGES, "merge")
    schema = T.StructType([df.schema[k] for k in keys] + [T.StructField(n, T.StructType.fromDDL(f"x {t}")[0].dataType) for n, (t, _) in parts.items()])
    names = schema.fieldNames()
    kinds = {n: ARROW_TYPES[t] for n, (t, _) in parts.items()}

    def call(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = partial(batch)
            if set(found.schema.names) != set(names):
                raise ValueError(f"metric: columns {found.schema.names} instead of {names}")
            for n, kind in kinds.items():
                _checked(found.column(n), kind, found.num_rows, f"metric {n}")
            yield found.select(names)

    merged = df.select(*keys, *columns).mapInArrow(call, schema).groupBy(*keys)
    return merged.agg(*[MERGES[merge](n).alias(n) for n, (_, merge) in parts.items()])
