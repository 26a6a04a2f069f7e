"""JSON instruction records: scan, parse and write.

Arrays of objects are read by many tasks a file: Spark's text reader deals a
file out in splits, with ``}`` as the line end. Whether a ``}`` ends a record
depends on the quotes and braces before it, so a first pass sums these up per
split for both cases (a split may begin inside a string or not), and a second
one, which knows how its split begins, cuts the records.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollforge.plans.skew import fits_broadcast
from rollforge.plans.storage import materialize

ESCAPE = re.compile(r"\\.", re.S)
STRING = re.compile(r'"(?:[^"\\]|\\.)*(?:"|\Z)', re.S)
STRING_END = re.compile(r'(?:[^"\\]|\\.)*"', re.S)


def step(segment: str, inside: bool) -> tuple[bool, int]:
    """Whether a segment and the ``}`` behind it end inside a string, and by how
    much they change the depth of braces."""
    plain = segment if "\\" not in segment else ESCAPE.sub("", segment)
    ends_inside = inside ^ bool(plain.count('"') & 1)
    if inside:
        found = STRING_END.match(segment)
        segment = segment[found.end():] if found else ""
    bare = STRING.sub("", segment) if '"' in segment else segment
    return ends_inside, bare.count("{") - (not ends_inside)


def runs_of(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[tuple, list[str]]]:
    """Texts of consecutive rows that agree in their first ``width`` columns."""
    for batch in batches:
        keys = list(zip(*[batch.column(i).to_pylist() for i in range(width)], strict=True))
        texts = batch.column(width).to_pylist()
        first = 0
        for i in range(1, len(keys) + 1):
            if i == len(keys) or keys[i] != keys[first]:
                yield keys[first], texts[first:i]
                first = i


def summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per split, for a start outside and inside a string: whether it ends inside, and its change of depth."""
    held: dict[tuple, list[tuple[bool, int]]] = {}
    for key, texts in runs_of(batches, 2):
        state = held.setdefault(key, [(False, 0), (True, 0)])
        for text in texts:
            for i, (inside, depth) in enumerate(state):
                inside, change = step(text, inside)
                state[i] = inside, depth + change
    rows = [(*key, a, b, c, d) for key, ((a, b), (c, d)) in held.items()]
    columns = list(zip(*rows, strict=True)) if rows else [()] * 6
    kinds = [pa.string(), pa.int64(), pa.bool_(), pa.int64(), pa.bool_(), pa.int64()]
    names = ["file", "start", "ends_0", "depth_0", "ends_1", "depth_1"]
    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)


def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records of splits (file, start, begins inside, begins at depth, text).

    ``part`` is null for a whole record, 0 for the end of one that began in an
    earlier split, 1 for one that the split does not end.
    """
    key: tuple | None = None
    inside, depth, done, open_part, parts = False, 0, 0, False, []

    def leftover() -> list[tuple]:
        text = "".join(parts)
        if not open_part and "{" not in text:
            return []
        return [(key[0], key[1], key[1] + done, 0 if open_part else 1, text)]

    def rows(out: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*out, strict=True)) if out else [()] * 5
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.string()]
        names = ["file", "start", "ord", "part", "record"]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    for found, texts in runs_of(batches, 4):
        out: list[tuple] = []
        if found != key:
            if key is not None:
                out += leftover()
            key, (inside, depth), done, parts = found, found[2:], 0, []
            open_part = inside or depth > 0
        for text in texts:
            inside, change = step(text, inside)
            depth += change
            if depth < 0 and not inside:  # no } is there: the rest of the file behind its last one
                depth, parts = 0, []
                continue
            parts += [text, "}"]
            if depth > 0 or inside:
                continue
            record = "".join(parts)
            if open_part:
                out.append((key[0], key[1], key[1], 0, record))
                open_part = False
            else:
                done += 1
                out.append((key[0], key[1], key[1] + done, None, record))
            parts = []
        yield rows(out)
    if key is not None:
        yield rows(leftover())


def scan_arrays(spark: SparkSession, path: str, recursive: bool = False, pattern: str = "*.json") -> DataFrame:
    """file, ord, record: the text of every object of arrays (or of objects one
    after the other), however a file is dealt out to tasks."""
    reader = spark.read.option("lineSep", "}").option("pathGlobFilter", pattern)
    if recursive:
        reader = reader.option("recursiveFileLookup", True)
    lines = reader.text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.col("value")
    )
    found = materialize(lines.mapInArrow(
        summaries, "file string, start long, ends_0 boolean, depth_0 long, ends_1 boolean, depth_1 long"
    ), "split_summaries")
    # one row a split; a file's splits are summed in order
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    odd = F.sum((F.col("ends_0")).cast("int")).over(before)
    begun = found.withColumn("inside", F.coalesce(odd % 2 == 1, F.lit(False)))
    change = F.when(F.col("inside"), F.col("depth_1")).otherwise(F.col("depth_0"))
    states = materialize(begun.withColumn("depth", F.coalesce(F.sum(change).over(before), F.lit(0).cast("bigint"))).select(
        "file", "start", "inside", "depth"
    ), "split_states")
    columns = ["file", "start", "inside", "depth", "value"]
    if fits_broadcast(states):
        lines = lines.join(F.broadcast(states), ["file", "start"]).select(*columns)
    else:
        numbered = lines.withColumn("line", F.monotonically_increasing_id()).join(states, ["file", "start"])
        lines = numbered.repartition("file", "start").sortWithinPartitions("file", "start", "line").select(*columns)
    parts = materialize(
        lines.mapInArrow(cut, "file string, start long, ord long, part int, record string"), "record_parts"
    )
    whole = parts.where("part is null").select("file", "ord", "record")
    # at most two parts a split: a record that is cut has one that begins it and one or more that go on
    torn = parts.where("part is not null")
    order = Window.partitionBy("file").orderBy("start", "part").rowsBetween(Window.unboundedPreceding, 0)
    torn = torn.withColumn("of", F.sum("part").over(order)).groupBy("file", "of").agg(
        F.min("ord").alias("ord"), F.array_join(F.sort_array(F.collect_list(F.struct("start", "part", "record")))["record"], "").alias("record")
    )
    return whole.unionByName(torn.select("file", "ord", "record"))


def scan(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    lines: bool = False,
    recursive: bool = False,
    pattern: str = "*.json",
) -> DataFrame:
    """Records of one file or of every file of a folder that fits ``pattern``, missing fields
    as ''. ``file`` and ``ord`` keep the order inside a file.

    Files hold an array of objects each; ``lines`` reads one object per line.
    Large files of both kinds are split over tasks. An object that is no valid
    JSON has empty fields.
    """
    if lines:
        reader = spark.read.schema(schema).option("pathGlobFilter", pattern)
        if recursive:
            reader = reader.option("recursiveFileLookup", True)
        rows = reader.json(path).select(
            F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("ord"), "*"
        )
    else:
        found = scan_arrays(spark, path, recursive, pattern)
        begin = F.substring_index("record", "{", 1)  # what separates records
        text = F.expr("substring(record, length(__begin) + 1)")
        rows = found.withColumn("__begin", begin).withColumn("__json", F.from_json(text, schema)).select("file", "ord", "__json.*")
    return rows.select(
        "file", "ord",
        *[
            F.coalesce(F.col(f.name), F.lit("")).alias(f.name) if isinstance(f.dataType, T.StringType) else F.col(f.name)
            for f in schema.fields
        ],
    )


def parse_column(df: DataFrame, column: str, ddl: str) -> DataFrame:
    """Fields of a JSON text column as columns."""
    parsed = df.withColumn("__json", F.from_json(column, ddl))
    return parsed.select(*[c for c in df.columns if c != column], "__json.*")


def write_lines(df: DataFrame, path: str) -> None:
    """One UTF-8 JSON object per line, one file per partition."""
    df.write.json(path)


def write_arrays(df: DataFrame, path: str, key: str, rows_per_file: int, columns: Sequence[str]) -> None:
    """Files with one JSON array each, of blocks of consecutive integer keys.

    Records are streamed to the file one by one, in key order; only the first
    and the last of a block look different. A file appears when the job commits,
    so lost and repeated tasks leave each record once.
    """
    block = F.expr(f"{key} div {int(rows_per_file)}")
    rows = df.select(block.alias("block"), F.col(key).alias("__key"), F.to_json(F.struct(*columns)).alias("record"))
    order = Window.partitionBy("block").orderBy("__key", "record")
    placed = rows.select(
        "block", "__key", "record", F.lag("block").over(order).isNull().alias("first"), F.lead("block").over(order).isNull().alias("last")
    )
    line = F.concat(F.when(F.col("first"), "[").otherwise(""), F.col("record"), F.when(F.col("last"), "]").otherwise(","))
    placed.sortWithinPartitions("block", "__key", "record").select("block", line.alias("value")).write.partitionBy("block").option(
        "compression", "none"
    ).text(path)
