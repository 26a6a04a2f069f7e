"""Removal of repeated byte strings with a sparse, distributed suffix array.

A window is any string of ``length`` bytes; one that also starts elsewhere is
removed. Sorting every suffix would move hundreds of bytes per byte of text, so
suffixes are sorted at anchors only: the place of the least k-gram hash in the
first ``reach`` places of a window. An anchor's place in a window depends on the
window alone, so equal windows have equal strings around their anchors, and the
array of anchor suffixes decides every window.

1. Anchors whose inner string (common to all their windows) occurs once are
   unique; if all occurrences of an inner string agree in all their windows,
   these are repeated. Both are decided by counting 64-bit hashes.
2. One suffix for each other class of equal surroundings is sorted: tasks sort
   runs, cut them by splitters into front-coded pieces (the prefix shared with
   the previous suffix is not sent), and the pieces of a range are merged by a
   loser tree that compares suffixes only behind the prefixes it knows to be
   shared. Neighbours that share the inner string form a cluster, in which
   windows are compared.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollforge.llm.common import attach, table
from rollforge.llm.textscan import BYTE_CODE, U64, RangeHash, buffers, mixed, pieces
from rollforge.plans.storage import materialize

LENGTH = 400
PIECE = 1 << 19
INDEX_BITS = 24
# Suffixes of a run that a task sorts, and of a range that a task merges, about.
RUN = 20_000
# Splitters are taken from so many sampled suffixes.
SAMPLED = 4000
# Inner strings with more classes are decided by counting single windows.
CLUSTER = 20_000


@dataclass(frozen=True)
class Shape:
    """Sizes that follow from the window length."""

    length: int

    @property
    def gram(self) -> int:
        return max(1, self.length // 12)

    @property
    def reach(self) -> int:
        return max(1, min(self.length * 5 // 8, self.length - self.gram + 1))

    @property
    def inner(self) -> int:
        """Bytes from an anchor on that are in all of its windows."""
        return self.length - self.reach + 1


def anchors_of(raw: np.ndarray, at: np.ndarray, shape: Shape) -> tuple[np.ndarray, ...]:
    """(text, first window, windows, anchor's offset from the first, inner
    hash, hash of all) for the anchors of several texts, in bytes of ``raw``."""
    n, k, w = len(raw), shape.gram, shape.reach
    hashes = RangeHash(BYTE_CODE[raw])
    with np.errstate(over="ignore"):
        grams = mixed((hashes.sums[k:] - hashes.sums[:-k]) * hashes.lift[: n - k + 1])
    low = U64((1 << INDEX_BITS) - 1)
    least = (grams & ~low) | np.arange(len(grams), dtype=U64)
    del grams
    span = 1
    while span * 2 <= w:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if w > span:
        least = np.minimum(least[: len(least) - (w - span)], least[w - span:])
    counts = np.maximum(0, np.diff(at) - shape.length + 1)
    text = np.repeat(np.arange(len(counts)), counts)
    start = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts) + np.repeat(at[:-1], counts)
    place = (least[start] & low).astype(np.int64)
    if not len(start):
        none = np.zeros(0, dtype=np.int64)
        return none, none, none, none, none.astype(U64), none.astype(U64)
    new = np.ones(len(start), dtype=bool)
    new[1:] = (place[1:] != place[:-1]) | (text[1:] != text[:-1])
    head = np.flatnonzero(new)
    windows = np.diff(np.concatenate((head, [len(start)])))
    anchor, first, owner = place[head], start[head], text[head]
    with np.errstate(over="ignore"):
        inner = hashes.of(anchor, anchor + shape.inner)
        whole = hashes.of(first, first + windows - 1 + shape.length)
        whole = mixed(whole + (anchor - first).astype(U64) * U64(0x9E3779B97F4A7C15))
    return owner, first, windows, anchor - first, inner, whole


def parts_of(at: np.ndarray, length: int) -> Iterator[tuple[int, int, int, int]]:
    """(first text, end, first byte, end byte): several texts of ``PIECE`` bytes
    together, or a part of a longer text with the bytes its windows reach."""
    for a, b in pieces(at, PIECE):
        if b - a > 1 or at[b] - at[a] <= 2 * PIECE:
            yield a, b, int(at[a]), int(at[b])
        else:
            for s in range(int(at[a]), int(at[b]), PIECE):
                yield a, b, s, min(int(at[b]), s + PIECE + length - 1)


ANCHOR_ROWS = "key binary, first int, windows int, offset int, inner long, whole long"


def anchor_rows(texts: DataFrame, shape: Shape) -> DataFrame:
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, at = buffers(batch.column(1))
            for a, b, s, e in parts_of(at, shape.length):
                if e - s < shape.length:
                    continue
                local = np.clip(at[a: b + 1], s, e) - s
                owner, first, windows, offset, inner, whole = anchors_of(raw[s:e], local, shape)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(owner + a)),
                        pa.array((first + s - at[owner + a]).astype(np.int32)), pa.array(windows.astype(np.int32)),
                        pa.array(offset.astype(np.int32)), pa.array(inner.view(np.int64)), pa.array(whole.view(np.int64)),
                    ],
                    names=["key", "first", "windows", "offset", "inner", "whole"],
                )

    long = texts.where(F.octet_length("text") >= shape.length).select("key", "text")
    return long.mapInArrow(scan, ANCHOR_ROWS)


SUFFIX_ROWS = "key binary, first int, windows int, offset int, many boolean, large boolean, body binary"


def cut_suffixes(texts: DataFrame, asked: DataFrame, shape: Shape) -> DataFrame:
    """The bytes from the first window to the last one's end for the anchors
    that ``asked`` lists by text (key, wanted)."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([
            ("key", pa.binary()), ("first", pa.int32()), ("windows", pa.int32()), ("offset", pa.int32()),
            ("many", pa.bool_()), ("large", pa.bool_()), ("body", pa.binary()),
        ])
        for batch in batches:
            raw, at = buffers(batch.column(1))
            out: list[dict] = []
            for i, (key, wanted) in enumerate(zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True)):
                for w in wanted:
                    s = int(at[i]) + w["first"]
                    out.append({**w, "key": key, "body": raw[s: s + w["windows"] - 1 + shape.length].tobytes()})
                if len(out) >= RUN:
                    yield pa.RecordBatch.from_pylist(out, schema=schema)
                    out = []
            yield pa.RecordBatch.from_pylist(out, schema=schema)

    return texts.join(asked, "key").select("key", "text", "wanted").mapInArrow(scan, SUFFIX_ROWS)


def shared(a: bytes, b: bytes, known: int = 0) -> int:
    """Length of the common prefix of ``a`` and ``b``, of which ``known`` bytes
    are known to be common and not looked at."""
    most = min(len(a), len(b))
    step = 16
    while known < most:
        end = min(most, known + step)
        if a[known:end] == b[known:end]:
            known = end
            step *= 2
        elif end - known == 1:
            return known
        else:
            step = max(1, (end - known) // 2)
    return known


class LoserTree:
    """Merge of sorted, front-coded runs. Each head knows how many bytes it
    shares with the last suffix put out; of two heads the one that shares more
    comes first, and only heads that share equally much are compared, behind
    those bytes."""

    def __init__(self, runs: list[Iterator[tuple[int, bytes, tuple]]]) -> None:
        """A run yields (bytes shared with its previous suffix, the rest, payload)."""
        self.runs = runs
        self.size = 1
        while self.size < len(runs):
            self.size *= 2
        self.suffix: list[bytes | None] = [None] * self.size
        self.known = [0] * self.size
        self.payload: list[tuple] = [()] * self.size
        self.loser = [-1] * self.size
        for r in range(len(runs)):
            self._advance(r)
        self.winner = self._build(1)

    def _advance(self, r: int) -> None:
        got = next(self.runs[r], None)
        if got is None:
            self.suffix[r] = None
            return
        known, rest, self.payload[r] = got
        self.suffix[r] = (self.suffix[r] or b"")[:known] + rest
        self.known[r] = known

    def _build(self, node: int) -> int:
        if node >= self.size:
            return node - self.size
        return self._play(node, self._build(2 * node), self._build(2 * node + 1))

    def _play(self, node: int, a: int, b: int) -> int:
        """The winner; the loser stays at the node, knowing what it shares with the winner."""
        x, y = self.suffix[a], self.suffix[b]
        if y is None:
            first = True
        elif x is None:
            first = False
        elif self.known[a] != self.known[b]:
            first = self.known[a] > self.known[b]
        else:
            common = shared(x, y, self.known[a])
            first = x[common:] <= y[common:] if common == min(len(x), len(y)) else x[common] < y[common]
            self.known[b if first else a] = common
        self.loser[node] = b if first else a
        return a if first else b

    def __iter__(self) -> Iterator[tuple[int, bytes, tuple]]:
        """(bytes shared with the previous suffix, suffix, payload) in order."""
        while self.suffix[self.winner] is not None:
            w = self.winner
            yield self.known[w], self.suffix[w], self.payload[w]
            self._advance(w)
            node = (w + self.size) // 2
            while node:
                w = self._play(node, w, self.loser[node])
                node //= 2
            self.winner = w


RUN_ROWS = "part int, run long, seq int, known int, rest binary, head binary, key binary, first int, windows int, many boolean"


def sorted_runs(suffixes: DataFrame, splitters: list[bytes], shape: Shape) -> DataFrame:
    """Front-coded pieces of sorted runs, by range of the inner string."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        number = 0

        def run() -> pa.RecordBatch:
            held.sort()
            out, last, before = [], -1, b""
            for seq, (suffix, head, key, first, windows, many) in enumerate(held):
                part = bisect_right(splitters, suffix[: shape.inner])
                known = shared(before, suffix) if part == last else 0
                out.append((part, name, seq, known, suffix[known:], head, key, first, windows, many))
                last, before = part, suffix
            kinds = [pa.int32(), pa.int64(), pa.int32(), pa.int32(), *[pa.binary()] * 3, pa.int32(), pa.int32(), pa.bool_()]
            columns = list(zip(*out, strict=True)) if out else [()] * len(kinds)
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=[x.split()[0] for x in RUN_ROWS.split(", ")]
            )

        for batch in batches:
            rows = batch.to_pydict()
            for key, first, windows, offset, many, body in zip(
                *[rows[c] for c in ("key", "first", "windows", "offset", "many", "body")], strict=True
            ):
                held.append((body[offset:], body[:offset], key, first, windows, many))
                if len(held) >= RUN:
                    name = TaskContext.get().partitionId() * 1_000_000 + number
                    yield run()
                    held, number = [], number + 1
        name = TaskContext.get().partitionId() * 1_000_000 + number
        yield run()

    return suffixes.mapInArrow(scan, RUN_ROWS)


def repeated_windows(cluster_of: list[int], bodies: list[bytes], windows: list[int], shape: Shape) -> np.ndarray:
    """Flags for all windows of all bodies (one after the other): whether the
    window occurs in another body of its cluster."""
    sizes = np.fromiter(map(len, bodies), dtype=np.int64, count=len(bodies))
    raw = np.frombuffer(b"".join(bodies), dtype=np.uint8)
    count = np.array(windows, dtype=np.int64)
    base = np.cumsum(sizes) - sizes
    start = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(base, count)
    hashes = RangeHash(BYTE_CODE[raw])
    with np.errstate(over="ignore"):
        cluster = mixed(np.repeat(np.array(cluster_of, dtype=U64), count) + U64(1))
        name = mixed(hashes.of(start, start + shape.length) ^ cluster)
    _, back, n = np.unique(name, return_inverse=True, return_counts=True)
    return n[back] > 1


SPAN_ROWS = "key binary, first int, windows int"


def merge_runs(runs: DataFrame, shape: Shape) -> DataFrame:
    """(key, first, windows): ranges of repeated windows of the suffixes whose
    class is single, from the merged order of each range."""

    def ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[int, list[tuple]]]:
        """The runs of one range after the other."""
        now, held = None, {}
        for batch in batches:
            rows = batch.to_pydict()
            for part, run, _, known, rest, *payload in zip(*rows.values(), strict=True):
                if part != now and held:
                    yield held
                    held = {}
                now = part
                held.setdefault(run, []).append((known, rest, tuple(payload)))
        if held:
            yield held

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in ranges(batches):
            group: list[tuple] = []
            waiting: list[tuple[int, bytes, tuple]] = []
            number = 0
            for known, suffix, payload in LoserTree([iter(r) for r in held.values()]):
                if known < shape.inner:
                    if len(group) > 1:
                        waiting += [(number, *g) for g in group]
                        number += 1
                    group = []
                    if len(waiting) > RUN // 4:
                        yield decide(waiting)
                        waiting = []
                group.append((suffix, payload))
            if len(group) > 1:
                waiting += [(number, *g) for g in group]
            yield decide(waiting)

    def decide(waiting: list[tuple[int, bytes, tuple]]) -> pa.RecordBatch:
        keys, firsts, counts = [], [], []
        if waiting:
            bodies = [payload[0] + suffix for _, suffix, payload in waiting]
            windows = [payload[3] for _, _, payload in waiting]
            flags = repeated_windows([c for c, _, _ in waiting], bodies, windows, shape)
            at = 0
            for _, _, (_, key, first, n, many) in waiting:
                if not many:
                    edge = np.flatnonzero(np.diff(np.concatenate(([0], flags[at: at + n].astype(np.int8), [0]))))
                    for s, e in zip(edge[::2], edge[1::2], strict=True):
                        keys.append(key)
                        firsts.append(first + int(s))
                        counts.append(int(e - s))
                at += n
        return pa.RecordBatch.from_arrays(
            [pa.array(keys, pa.binary()), pa.array(firsts, pa.int32()), pa.array(counts, pa.int32())],
            names=["key", "first", "windows"],
        )

    placed = runs.repartition("part").sortWithinPartitions("part", "run", "seq")
    return placed.mapInArrow(scan, SPAN_ROWS)


def counted_windows(suffixes: DataFrame, shape: Shape) -> DataFrame:
    """What ``merge_runs`` gives, by counting the 128-bit hash of each window:
    for inner strings with too many classes for one task."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pydict()
            for i in range(0, batch.num_rows, 2000):
                part = {c: v[i: i + 2000] for c, v in rows.items()}
                n = np.array(part["windows"], dtype=np.int64)
                names = [
                    hashlib.blake2b(body[s: s + shape.length], digest_size=16).digest()
                    for body, k in zip(part["body"], part["windows"], strict=True) for s in range(k)
                ]
                of = np.repeat(np.arange(len(n)), n)
                within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(names, pa.binary()), pa.array([part["key"][j] for j in of], pa.binary()),
                        pa.array((np.array(part["first"])[of] + within).astype(np.int32)),
                        pa.array(np.array(part["many"], dtype=bool)[of]),
                    ],
                    names=["name", "key", "first", "many"],
                )

    windows = suffixes.mapInArrow(scan, "name binary, key binary, first int, many boolean")
    often = windows.groupBy("name").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("name")
    found = windows.where(~F.col("many")).join(often, "name", "left_semi")
    return found.select("key", "first", F.lit(1).cast("int").alias("windows"))


def repeated_spans(texts: DataFrame, shape: Shape, cluster: int = CLUSTER) -> DataFrame:
    """(key, first, windows) that cover every repeated window of ``texts`` (key, text)."""
    anchors = materialize(anchor_rows(texts, shape), "anchors")
    inner = anchors.groupBy("inner").agg(
        F.count(F.lit(1)).alias("n"), F.min("whole").alias("low"), F.max("whole").alias("high")
    ).where("n > 1").select("inner", "n", (F.col("low") == F.col("high")).alias("same"))
    inner = materialize(inner, "repeated_strings")
    again = materialize(attach(anchors, inner, ["inner"], "n").drop("n"), "repeated_anchors")
    mixed_up = again.where(~F.col("same")).drop("same")
    classes = mixed_up.groupBy("inner", "whole").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("key", "first", "windows", "offset")).alias("one")
    )
    classes = materialize(classes, "suffix_classes")
    all_same = again.where("same").select("key", "first", "windows")
    by_class = attach(mixed_up, classes.where("n > 1").select("inner", "whole", "n"), ["inner", "whole"], "n")
    spans = all_same.unionByName(by_class.select("key", "first", "windows"))

    # inner strings with a single class member are to be decided; the others of the string are its partners
    open_ = classes.groupBy("inner").agg(F.min("n").alias("least"), F.count(F.lit(1)).alias("classes")).where("least = 1")
    wanted = classes.join(open_.select("inner", "classes"), "inner").select(
        "one.key", F.struct(
            "one.first", "one.windows", "one.offset", (F.col("n") > 1).alias("many"),
            (F.col("classes") > cluster).alias("large"),
        ).alias("wanted"),
    )
    # a text's own anchors: not more than its bytes
    asked = wanted.groupBy("key").agg(F.collect_list("wanted").alias("wanted"))
    cut = materialize(cut_suffixes(texts, asked.hint("shuffle_hash"), shape), "cut_suffixes")
    # rows that repeat with id and text share a key, and their suffixes are in many rows: one of them is enough
    suffixes = cut.where(~F.col("many")).unionByName(cut.where("many").dropDuplicates(["key", "first"]))
    suffixes = materialize(suffixes, "suffixes")
    small, large = suffixes.where(~F.col("large")), suffixes.where("large")
    prefix = F.expr(f"substring(body, offset + 1, {shape.inner})")
    count = small.count()
    share = min(1.0, SAMPLED / max(1, count))
    sample = [
        bytes(r[0]) for r in small.where(F.pmod(F.xxhash64("key", "first"), F.lit(1 << 20)) < int(share * (1 << 20)))
        .select(prefix).collect()
    ]  # about SAMPLED of them
    ranges = max(1, count // RUN)
    sample.sort()
    splitters = sorted({sample[len(sample) * i // ranges] for i in range(1, ranges)}) if sample else []
    merged = merge_runs(sorted_runs(small, splitters, shape), shape)
    return spans.unionByName(merged).unionByName(counted_windows(large, shape))


def remove_repeats(
    docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text: str = "text", cluster: int = CLUSTER
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_removed, n_spans,
    kept_sha256, spans (array of removed byte ranges), kept (binary).

    Every byte of a ``length``-byte string that also starts anywhere else in
    the given texts is removed; overlapping occurrences count. Null is empty;
    texts shorter than ``length`` lose nothing. A repeated row is another text,
    so both lose everything from ``length`` bytes on. Ids may be null. An empty
    table gives no rows; other columns are ignored. Kept bytes need not be
    valid UTF-8, as cuts fall between bytes.
    """
    shape = Shape(length)
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    key = F.unhex(F.md5(F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("~")), F.lit(":"), body)))
    texts = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), key.alias("key"), body.alias("text"))
    spans = repeated_spans(texts.select("key", "text"), shape, cluster)
    by_text = materialize(
        spans.groupBy("key").agg(F.collect_set(F.struct("first", "windows")).alias("found")), "repeated_spans"
    )

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, at = buffers(batch.column(1))
            removed, count, digest, ranges, kept = [], [], [], [], []
            lists = batch.column(2)
            flat = lists.flatten()
            first = flat.field("first").to_numpy(zero_copy_only=False).astype(np.int64)
            n = flat.field("windows").to_numpy(zero_copy_only=False).astype(np.int64)
            sizes = [len(x) if x.is_valid else 0 for x in lists]
            done = 0
            for i, size in enumerate(sizes):
                piece = raw[at[i]: at[i + 1]]
                cuts: list[tuple[int, int]] = []
                if size:
                    s, e = first[done: done + size], first[done: done + size] + n[done: done + size] - 1 + length
                    order = np.argsort(s, kind="stable")
                    s, e = s[order], np.maximum.accumulate(e[order])
                    head = np.concatenate(([True], s[1:] > e[:-1]))
                    cuts = list(zip(s[head].tolist(), e[np.concatenate((head[1:], [True]))].tolist(), strict=True))
                    done += size
                left, parts = 0, []
                for s0, e0 in cuts:
                    parts.append(piece[left:s0].tobytes())
                    left = e0
                parts.append(piece[left:].tobytes())
                rest = b"".join(parts)
                removed.append(len(piece) - len(rest))
                count.append(len(cuts))
                digest.append(hashlib.sha256(rest).hexdigest())
                ranges.append([{"first": a, "end": b} for a, b in cuts])
                kept.append(rest)
            span = pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), pa.array(np.diff(at)), pa.array(removed, pa.int64()), pa.array(count, pa.int64()),
                    pa.array(digest, pa.string()), pa.array(ranges, span), pa.array(kept, pa.binary()),
                ],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans", "kept"],
            )

    joined = texts.join(by_text.hint("shuffle_hash"), "key", "left").select("doc_id", "text", "found")
    return joined.mapInArrow(
        scan, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, "
        "spans array<struct<first:long,end:long>>, kept binary",
    )


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents")).drop("spans", "kept")
