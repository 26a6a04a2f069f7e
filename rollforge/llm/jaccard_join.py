"""N-gram Jaccard self-join by set-relation skipping.

Sets are the distinct word shingles of a text. In an order with frequent
shingles last, two sets that reach the similarity share one of their first
shingles (their prefixes), so the inverted lists of prefix shingles hold every
link.

Relations between sets spare most comparisons. Equal sets are one set. In each
list, sets are first compared with a leader only; what links to it takes its
component from it. Then only sets of different components in one list are
compared, by blocks ordered by size, which are skipped when no sizes or list
positions in them can reach the similarity, and pairs are skipped when parity
bitmaps, which grow with their sets, show that too many shingles differ. Pairs that remain are compared
exactly, so no component is split.

Links are then counted inside the components, by parts that can link by size.
In a part one set leads: every set's difference from it is computed once, and
how many shingles two others share follows from their differences, by bounds
first and exactly where these leave it open. No pair is ever a row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollforge.llm.common import attach, table
from rollforge.llm.graph import star_components
from rollforge.llm.textscan import U64, buffers, find_words, lower_ascii, mixed, pieces
from rollforge.plans.storage import materialize

WORDS = 5
PERCENT = 75
BITS = 1024
# Shingles in so many texts of a block of so many shingles count as frequent.
FREQUENT, BLOCK_SHINGLES = 8, 4_000_000
# The most frequent ones, so many at most, are sent to every task; the order decides costs, not results.
SENT_FREQUENT = 500_000
# Rows of a list that are compared in one group; longer lists are split into pairs of parts.
LIST_PART = 4000
SKIP_BLOCK = 256
# Pairs whose narrow bitmaps are compared at once.
PAIR_BLOCK = SKIP_BLOCK * SKIP_BLOCK
# Before all sets of different components are compared, each is with so many next ones.
NEXT = 8
# Lists up to this length are read beside others that begin with the same set, by so many of its shingles.
SHORT_LIST = 64
PLACE_SHINGLES = 4096
# 64-bit words of bitmaps compared at once, and pairs of a group after which repeats are dropped.
WIDE_WORDS = 1 << 20
HELD_PAIRS = 1 << 20
# Up to so many texts (16 bytes each) are looked up by broadcast, more by shuffle.
SENT_KEYS = 200_000
# Sets of a component whose links are counted in one group; larger ones are split into pairs of parts.
COMPONENT_PART = 256
CHUNK_COLUMNS = 4096
LOWER = lower_ascii()


def word_bytes() -> np.ndarray:
    flags = np.ones(256, dtype=np.int8)
    flags[[32, 9, 10, 11, 12, 13]] = 0
    return flags


INSIDE = word_bytes()


def shingles(raw: np.ndarray, at: np.ndarray, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """(text, hash) of the distinct shingles of several texts, sorted by both.
    A text with fewer words has one shingle of all of them."""
    found = find_words(raw, at, INSIDE, LOWER)
    n = len(found.code)
    count = np.diff(found.bounds)
    grams = found.code.copy()
    with np.errstate(over="ignore"):
        grams = grams[: max(0, n - words + 1)]
        for i in range(1, words):
            grams = mixed(grams) + found.code[i: i + len(grams)]
        grams = mixed(grams)
    inside = np.repeat(found.bounds[1:], count)[: len(grams)] - np.arange(len(grams)) >= words
    owner = np.repeat(np.arange(len(count)), count)
    first = np.flatnonzero(inside)
    texts, hashes = [owner[: len(grams)][first]], [grams[first]]
    short = np.flatnonzero((count > 0) & (count < words))
    if len(short):
        with np.errstate(over="ignore"):
            whole = mixed(count[short].astype(U64) * U64(0x9E3779B97F4A7C15))
            for i in range(words - 1):
                more = count[short] > i
                at_word = np.minimum(found.bounds[short] + i, n - 1)
                whole = np.where(more, mixed(whole) + found.code[at_word], whole)
        texts.append(short)
        hashes.append(mixed(whole))
    text, value = np.concatenate(texts), np.concatenate(hashes)
    if len(short):
        order = np.argsort(text, kind="stable")
        text, value = text[order], value[order]
    # text by text, in place: far cheaper than one sort by two keys
    starts = np.searchsorted(text, np.arange(len(count) + 1)).tolist()
    for a, b in zip(starts[:-1], starts[1:], strict=True):
        if b - a > 1:
            value[a:b].sort()
    new = np.ones(len(text), dtype=bool)
    new[1:] = (text[1:] != text[:-1]) | (value[1:] != value[:-1])
    return text[new], value[new]


def digests(bounds: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit sums per set, which name the set; 0 for the empty one."""
    out = []
    with np.errstate(over="ignore"):
        for salt in (0x243F6A8885A308D3, 0x13198A2E03707344):
            sums = np.concatenate(([U64(0)], np.cumsum(mixed(value ^ U64(salt)), dtype=U64)))
            out.append((sums[bounds[1:]] - sums[bounds[:-1]]).view(np.int64))
    return out[0], out[1]


def bitmaps(bounds: np.ndarray, value: np.ndarray) -> tuple[pa.Array, pa.Array]:
    """Parity of the number of shingles per bit, by set, packed: with ``BITS``
    bits, and with two bits per shingle at least (``BITS`` times a power of 2).
    Halves of a bitmap, xored, are the bitmap with half the bits."""
    size = np.diff(bounds)
    rows = 1 << np.ceil(np.log2(np.maximum(2 * size / BITS, 1))).astype(np.int64)
    first = np.cumsum(rows) - rows
    bit = ((value >> U64(17)) & np.repeat(rows * BITS - 1, size).astype(U64)).astype(np.int64)
    odd = np.bincount(np.repeat(first * BITS, size) + bit, minlength=int(rows.sum()) * BITS) & 1
    odd = odd.astype(np.uint8).reshape(-1, BITS)
    narrow = (np.add.reduceat(odd.astype(np.int32), first, axis=0) & 1).astype(np.uint8) if len(size) else odd
    return binary(np.packbits(narrow, axis=1), np.ones(len(size))), binary(np.packbits(odd, axis=1), rows)


def binary(rows: np.ndarray, counts: np.ndarray) -> pa.Array:
    """Bytes as a binary column, so many rows to a value."""
    offsets = (np.concatenate(([0], np.cumsum(counts))) * BITS // 8).astype(np.int32)
    return pa.Array.from_buffers(
        pa.binary(), len(counts), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(rows))]
    )


def differing(a: bytes, b: bytes) -> int:
    """Bits in which two bitmaps differ, the longer one folded to the shorter."""
    if len(a) < len(b):
        a, b = b, a
    x, y = np.frombuffer(a, dtype=U64), np.frombuffer(b, dtype=U64)
    if len(a) > len(b):
        x = np.bitwise_xor.reduce(x.reshape(-1, len(y)), axis=0)
    return int(np.bitwise_count(x ^ y).sum())


def batch_sets(column: pa.Array, words: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first text, end, bounds of its sets, their sorted hashes) of a text column."""
    raw, at = buffers(column)
    for a, b in pieces(at):
        text, value = shingles(raw[at[a]: at[b]], at[a: b + 1] - at[a], words)
        yield a, b, np.searchsorted(text, np.arange(b - a + 1)), value


SET_ROWS = "doc_id long, text_key binary, size long, d1 long, d2 long, bitmap binary, wide binary"


def set_rows(docs: DataFrame, words: int) -> DataFrame:
    """Per document its set's size, name and bitmap. Rows without a bitmap hold
    frequent shingles instead: d1 is the shingle, size its texts in a block."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        names = ["doc_id", "text_key", "size", "d1", "d2", "bitmap", "wide"]

        def frequent() -> pa.RecordBatch:
            value, n = np.unique(np.concatenate(held), return_counts=True)
            value, n = value[n >= FREQUENT], n[n >= FREQUENT]
            none = pa.nulls(len(value), pa.binary())
            return pa.RecordBatch.from_arrays(
                [pa.nulls(len(value), pa.int64()), none, pa.array(n), pa.array(value.view(np.int64)),
                 pa.array(np.zeros(len(value), dtype=np.int64)), none, none], names=names,
            )

        for batch in batches:
            for a, b, bounds, value in batch_sets(batch.column(2), words):
                d1, d2 = digests(bounds, value)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a), pa.array(np.diff(bounds)),
                     pa.array(d1), pa.array(d2), *bitmaps(bounds, value)], names=names,
                )
                held.append(value)
                if sum(map(len, held)) >= BLOCK_SHINGLES:
                    yield frequent()
                    held.clear()
        if held:
            yield frequent()

    return docs.select("doc_id", "text_key", "text").mapInArrow(scan, SET_ROWS)


def prefix_size(size: np.ndarray, percent: int) -> np.ndarray:
    """How many first shingles hold one in common with any set that links."""
    return size - (percent * size + 99) // 100 + 1


def prefix_rows(docs: DataFrame, words: int, percent: int, frequent: np.ndarray, texts: np.ndarray) -> DataFrame:
    """(token, d1, size, pos) of the prefixes of the sets of ``docs``, each set
    once per block of texts. ``frequent`` is sorted; ``texts`` orders it. Half of
    a set's name is enough here: sets that shared it would all be compared."""
    sent = docs.sparkSession.sparkContext.broadcast((frequent, texts))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common, weight = sent.value
        seen: set[tuple[int, int]] = set()
        for batch in batches:
            for _, _, bounds, value in batch_sets(batch.column(0), words):
                d1, d2 = digests(bounds, value)
                size = np.diff(bounds)
                keep = np.zeros(len(size), dtype=bool)
                for i, name in enumerate(zip(d1.tolist(), d2.tolist(), strict=True)):
                    if size[i] and name not in seen:
                        seen.add(name)
                        keep[i] = True
                if len(seen) > 200_000:
                    seen.clear()
                owner = np.repeat(np.arange(len(size)), size)
                mine = keep[owner]
                owner, value = owner[mine], value[mine]
                if not len(value):
                    continue
                order = np.zeros(len(value), dtype=np.int64)
                if len(common):
                    place = np.minimum(np.searchsorted(common, value), len(common) - 1)
                    order = np.where(common[place] == value, weight[place], 0)
                if order.any():
                    # values rise within their set already
                    value = value[np.argsort(owner * (order.max() + 1) + order, kind="stable")]
                first = np.concatenate(([0], np.cumsum(np.bincount(owner, minlength=len(size)))))
                pos = np.arange(len(value)) - first[owner]
                take = pos < prefix_size(size, percent)[owner]
                owner = owner[take]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(value[take].view(np.int64)), pa.array(d1[owner]),
                     pa.array(size[owner].astype(np.int32)), pa.array(pos[take].astype(np.int32))],
                    names=["token", "d1", "size", "pos"],
                )

    return docs.select("text").mapInArrow(scan, "token long, d1 long, size int, pos int")


LIST_ROWS = "kind int, token long, d1 long, size int, pos int, leader long"


def read_lists(prefixes: DataFrame, percent: int) -> DataFrame:
    """One pass over the lists, sorted by (token, size, set): kind 0 pairs each
    set with its leader, the smallest set of the list that its size allows to
    link; kind 1 repeats the rows of lists of three sets or more."""
    names = ["kind", "token", "d1", "size", "pos", "leader"]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # of the list that the last batch ended in: its last rows (3 at most), its leader, its length
        tail: np.ndarray | None = None
        leader: tuple[int, int] | None = None
        length = 0
        for batch in batches:
            rows = np.stack([c.to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns])
            if not rows.shape[1]:
                continue
            old = 0
            if tail is not None and tail[0, -1] == rows[0, 0]:
                old = tail.shape[1]
                rows = np.concatenate([tail, rows], axis=1)
            else:
                leader, length = None, 0
            same = np.zeros(rows.shape[1], dtype=bool)
            same[1:] = (rows[:2, 1:] == rows[:2, :-1]).all(axis=0)
            same[:old] = False
            old_length = length
            rows = rows[:, ~same]
            token, size = rows[0], rows[2]
            starts = np.concatenate(([0], np.flatnonzero(np.diff(token)) + 1))
            ends = np.concatenate((starts[1:], [len(token)]))
            group = np.repeat(np.arange(len(starts)), ends - starts)
            # leaders: a set leads until one too large for it comes, which leads from there
            lead = np.full(len(token), -1, dtype=np.int64)
            now = starts.copy()
            lead_size = size[now].copy()
            lead_name = rows[1, now].copy()
            if old and leader is not None:
                lead_size[0], lead_name[0] = leader[1], leader[0]
                now[0] = -2
            pair = np.zeros(len(token), dtype=np.int64)
            todo = np.arange(len(token))
            todo = todo[todo >= old] if old else todo
            while len(todo):
                fits = 100 * lead_size[group[todo]] >= percent * size[todo]
                ok = todo[fits]
                lead[ok] = now[group[ok]]
                pair[ok] = lead_name[group[ok]]
                todo = todo[~fits]
                if len(todo):
                    heads = todo[np.concatenate(([True], np.diff(group[todo]) > 0))]
                    now[group[heads]] = heads
                    lead_size[group[heads]] = size[heads]
                    lead_name[group[heads]] = rows[1, heads]
            new = np.arange(len(token)) >= old
            paired = new & (lead != np.arange(len(token))) & (lead != -1)
            yield batch_of(0, rows[:, paired], pair[paired])
            total = ends - starts
            total[0] += max(0, old_length - old)
            long = total[group] >= 3
            # rows of the list carried over were not repeated yet if it was short
            if old and old_length >= 3:
                long[:old] = False
            last = starts[-1]
            carried = np.zeros(len(token), dtype=bool)
            if total[-1] < 3:
                carried[last:] = True
            yield batch_of(1, rows[:, long & ~carried], None)
            length = int(total[-1])
            tail = rows[:, max(last, len(token) - 3):]
            leader = (int(lead_name[-1]), int(lead_size[-1]))

    def batch_of(kind: int, rows: np.ndarray, pair: np.ndarray | None) -> pa.RecordBatch:
        n = rows.shape[1]
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(n, kind, dtype=np.int32)), pa.array(rows[0]), pa.array(rows[1]),
             *[pa.array(r.astype(np.int32)) for r in rows[2:]],
             pa.array(pair) if pair is not None else pa.nulls(n, pa.int64())], names=names,
        )

    listed = prefixes.repartition("token").sortWithinPartitions("token", "size", "d1")
    return listed.mapInArrow(scan, LIST_ROWS)


class Bits:
    """Bitmaps of the sets of one group of lists, for bounds on pairs of them."""

    def __init__(self, wide: list[bytes], size: np.ndarray, percent: int) -> None:
        self.wide = [np.frombuffer(w, dtype=U64) for w in wide]
        self.width = np.array([len(w) for w in self.wide])
        self.narrow = self.folded(np.arange(len(wide)), BITS // 64)
        self.size, self.percent = size, percent

    def folded(self, sets: np.ndarray, words: int) -> np.ndarray:
        out = np.zeros((len(sets), words), dtype=U64)
        width = self.width[sets]
        for wide in np.unique(width).tolist():
            step = max(1, WIDE_WORDS // wide)
            mine = np.flatnonzero(width == wide)
            for at in np.split(mine, range(step, len(mine), step)):
                bits = np.concatenate([self.wide[i] for i in sets[at].tolist()])
                out[at] = np.bitwise_xor.reduce(bits.reshape(len(at), -1, words), axis=1)
        return out

    def few(self, differ: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        p = self.percent
        return (100 + p) * differ.astype(np.int64) <= (100 - p) * (self.size[x] + self.size[y])

    def may_link(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Which of the pairs have few enough bits that differ, by narrow bitmaps."""
        differ = np.zeros(len(x), dtype=np.int64)
        for first in range(0, len(x), PAIR_BLOCK):
            some = slice(first, first + PAIR_BLOCK)
            differ[some] = np.bitwise_count(self.narrow[x[some]] ^ self.narrow[y[some]]).sum(axis=1, dtype=np.int64)
        return self.few(differ, x, y)

    def still_may(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """The same by the widest bitmaps that both sets of a pair have."""
        keep = np.ones(len(x), dtype=bool)
        both = np.minimum(self.width[x], self.width[y])
        for words in np.unique(both[both > BITS // 64]).tolist():
            mine = np.flatnonzero(both == words)
            for at in np.split(mine, range(WIDE_WORDS // words, len(mine), WIDE_WORDS // words)):
                some, place = np.unique(np.concatenate([x[at], y[at]]), return_inverse=True)
                bits = self.folded(some, words)
                differ = np.bitwise_count(bits[place[: len(at)]] ^ bits[place[len(at):]]).sum(axis=1, dtype=np.int64)
                keep[at] = self.few(differ, x[at], y[at])
        return keep


def next_pairs(sets: np.ndarray, ends: np.ndarray, label: np.ndarray, bits: Bits) -> np.ndarray:
    """For each place of the lists its first pair, of its set and one of the ``NEXT``
    ones, that may link and differs in label: a column for each different pair.
    ``sets`` are all lists, one after the other, ``ends`` the end of each place's
    list. All lists move together, and a pair that many hold is compared once."""
    n = len(label)
    out = [np.zeros(0, dtype=np.int64)]
    left = np.arange(len(sets))
    for step in range(1, NEXT + 1):
        left = left[left + step < ends[left]]
        x, y = sets[left], sets[left + step]
        apart = np.flatnonzero(label[x] != label[y])
        pairs, place = np.unique(x[apart] * n + y[apart], return_inverse=True)
        x, y = np.divmod(pairs, n)
        fits = bits.may_link(x, y)
        fits[fits] = bits.still_may(x[fits], y[fits])
        out.append(pairs[fits])
        left = np.delete(left, apart[fits[place]])
    return np.stack(np.divmod(np.unique(np.concatenate(out)), n))


def cross_pairs(lists: DataFrame, percent: int, every: bool, sets: DataFrame | None = None) -> DataFrame:
    """(a, b) of sets of different components that may link, by list or pair of
    list parts. ``lists``: place, token, part, other, own, sid, label, size, pos,
    and bitmap unless ``sets`` (sid, bitmap) has it. Lists of one place are mostly
    of the same sets: a set comes there once, with its bitmap, and a pair is given
    once. Without ``every``, a set is only paired with the next few in size order:
    one pair at most by list."""
    key = ["place", "part", "other"]
    once = ["label", "size", *([] if sets is not None else ["bitmap"])]
    placed = lists.repartition("sid").groupBy("sid", *key).agg(
        *[F.first(c).alias(c) for c in once], F.collect_list(F.struct("token", "pos", "own")).alias("rows")
    )
    placed = placed.join(sets, "sid") if sets is not None else placed
    placed = placed.select(*key, "sid", "label", "size", "bitmap", "rows").repartition(*key).sortWithinPartitions(*key)

    def compare(
        sets: np.ndarray, pos: np.ndarray, own: np.ndarray, split: bool, label: np.ndarray, bits: Bits
    ) -> Iterator[np.ndarray]:
        size, label = bits.size[sets], label[sets]
        n = len(size)
        for i in range(0, n, SKIP_BLOCK):
            a = slice(i, min(n, i + SKIP_BLOCK))
            for j in range(i, n, SKIP_BLOCK):
                b = slice(j, min(n, j + SKIP_BLOCK))
                # sizes rise along the list: this and all later blocks are too large
                if 100 * size[a].max() < percent * size[b].min():
                    break
                # shingles before the common one beyond the other's position are in one set only
                room = min(
                    size[a].max() - max(0, pos[a].min() - pos[b].max()), size[b].max() - max(0, pos[b].min() - pos[a].max())
                )
                if (100 + percent) * room < percent * (size[a].min() + size[b].min()):
                    continue
                x, y = np.nonzero(
                    (label[a][:, None] != label[b][None, :])
                    & (100 * np.minimum(size[a][:, None], size[b][None, :])
                       >= percent * np.maximum(size[a][:, None], size[b][None, :]))
                )
                x, y = x + i, y + j
                keep = x < y
                if split:
                    keep &= own[x] != own[y]
                x, y = x[keep], y[keep]
                # shared shingles: those before both positions, this one, those after both
                most = np.minimum(pos[x], pos[y]) + np.minimum(size[x] - pos[x], size[y] - pos[y])
                keep = (100 + percent) * most >= percent * (size[x] + size[y])
                x, y = sets[x[keep]], sets[y[keep]]
                yield np.stack([x, y])[:, bits.may_link(x, y)]

    def pairs_of(held: list[pa.RecordBatch]) -> np.ndarray:
        """Pairs of sids, least first, of all lists of one group, or of whole groups unless ``every``."""
        rows = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
        sid, label, size = (rows.column(c).to_numpy().astype(np.int64) for c in ("sid", "label", "size"))
        if len(sid) < 2 or label.min() == label.max():
            return np.zeros((2, 0), dtype=np.int64)
        bits = Bits(rows.column("bitmap").to_pylist(), size, percent)
        listed = rows.column("rows")
        token, pos, own = (listed.flatten().field(c).to_numpy().astype(np.int64) for c in ("token", "pos", "own"))
        sets = np.repeat(np.arange(len(sid)), listed.value_lengths().to_numpy())
        group = np.zeros(len(sid), dtype=np.int64)
        group[1:] = np.cumsum(changes(rows))
        split = rows.column("part")[0] != rows.column("other")[0]
        by = np.lexsort((sid[sets], size[sets], token, group[sets]))
        token, pos, own, sets = token[by], pos[by], own[by], sets[by]
        cuts = np.flatnonzero((np.diff(token) != 0) | (np.diff(group[sets]) != 0)) + 1
        cuts = np.concatenate(([0], cuts, [len(token)]))
        if every:
            x, y = every_pair(cuts, sets, pos, own, split, label, bits)
        else:
            x, y = next_pairs(sets, np.repeat(cuts[1:], np.diff(cuts)), label, bits)
        return np.stack([np.minimum(sid[x], sid[y]), np.maximum(sid[x], sid[y])])

    def every_pair(
        cuts: np.ndarray, sets: np.ndarray, pos: np.ndarray, own: np.ndarray, split: bool, label: np.ndarray, bits: Bits
    ) -> tuple[np.ndarray, np.ndarray]:
        out = [np.zeros(0, dtype=np.int64)]
        waiting = 0
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            mine = slice(a, b)
            for x, y in compare(sets[mine], pos[mine], own[mine], split, label, bits):
                out.append(np.minimum(x, y) * len(label) + np.maximum(x, y))
                waiting += len(x)
            if waiting > HELD_PAIRS:
                out, waiting = [np.unique(np.concatenate(out))], 0
        x, y = np.divmod(np.unique(np.concatenate(out)), len(label))
        keep = bits.still_may(x, y)
        return x[keep], y[keep]

    def changes(rows: pa.RecordBatch) -> np.ndarray:
        """Which rows but the first begin a group."""
        keys = np.stack([rows.column(c).to_numpy().astype(np.int64) for c in key])
        return (np.diff(keys) != 0).any(axis=0)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []  # of the group that the last batch ended in
        for batch in batches:
            if not batch.num_rows:
                continue
            cuts = np.flatnonzero(changes(batch)) + 1
            if held and any(held[-1].column(c)[-1] != batch.column(c)[0] for c in key):
                cuts = np.concatenate(([0], cuts))
            if len(cuts) and not every:
                cuts = cuts[-1:]  # the whole groups up to there are read together
            found, first = [], 0
            for cut in cuts.tolist():
                found.append(pairs_of([*held, batch.slice(first, cut - first)]))
                held, first = [], cut
            held.append(batch.slice(first))
            yield batch_of(found)
        if held:
            yield batch_of([pairs_of(held)])

    def batch_of(found: list[np.ndarray]) -> pa.RecordBatch:
        both = np.concatenate([np.zeros((2, 0), dtype=np.int64), *found], axis=1)
        return pa.RecordBatch.from_arrays([pa.array(both[0]), pa.array(both[1])], names=["a", "b"])

    return placed.mapInArrow(scan, "a long, b long")


def link_counts(values: list[np.ndarray], side: np.ndarray, percent: int) -> np.ndarray:
    """Links of each of the sets ``values`` (sorted hashes), derived from their
    differences from a leader; with two sides, only links between them."""
    lead = values[len(values) // 2]
    size = np.array([len(v) for v in values])
    flat, owner = np.concatenate(values), np.repeat(np.arange(len(values)), size)
    place = np.minimum(np.searchsorted(lead, flat), len(lead) - 1)
    held = lead[place] == flat
    lacks = len(lead) - np.bincount(owner[held], minlength=len(values))
    adds = size - (len(lead) - lacks)
    least = len(lead) - lacks[:, None] - lacks[None, :]
    most = least + np.minimum(lacks[:, None], lacks[None, :]) + np.minimum(adds[:, None], adds[None, :])
    need = percent * (size[:, None] + size[None, :])
    asked = side[:, None] != side[None, :] if side.any() and not side.all() else ~np.eye(len(values), dtype=bool)
    links = asked & ((100 + percent) * least >= need)
    is_open = asked & ~links & ((100 + percent) * most >= need)
    rows = np.flatnonzero(is_open.any(axis=1))
    if len(rows):
        number = np.full(len(values), -1)
        number[rows] = np.arange(len(rows))
        # what several sets lack of the leader, then what several add to it
        absent = np.ones((len(rows), len(lead)), dtype=bool)
        mine = held & (number[owner] >= 0)
        absent[number[owner[mine]], place[mine]] = False
        row, column = np.nonzero(absent[:, absent.sum(axis=0) > 1])
        other = ~held & (number[owner] >= 0)
        _, code, n = np.unique(flat[other], return_inverse=True, return_counts=True)
        several = n[code] > 1
        new = np.cumsum(n > 1) - 1
        width = int(column.max()) + 1 if len(column) else 0
        row = np.concatenate([row, number[owner[other]][several]])
        column = np.concatenate([column, width + new[code[several]]])
        by = np.argsort(column, kind="stable")
        row, column = row[by], column[by]
        common = np.zeros((len(rows), len(rows)))
        at = 0
        while at < len(column):
            end = int(np.searchsorted(column, column[at] + CHUNK_COLUMNS))
            some = np.zeros((len(rows), int(column[end - 1] - column[at]) + 1), dtype=np.float32)
            some[row[at:end], column[at:end] - column[at]] = 1
            common += some @ some.T
            at = end
        exact = least[np.ix_(rows, rows)] + common.astype(np.int64)
        links[np.ix_(rows, rows)] |= is_open[np.ix_(rows, rows)] & ((100 + percent) * exact >= need[np.ix_(rows, rows)])
    return links.sum(axis=1)


class Corpus:
    """Texts (text_key, doc_id, text) and their distinct sets (sid, d1, size,
    wide bitmap, and the key and id of one text)."""

    def __init__(self, texts: DataFrame, sets: DataFrame, words: int, percent: int) -> None:
        self.texts, self.sets, self.words, self.percent = texts, sets, words, percent

    def likely(self, pairs: DataFrame) -> DataFrame:
        """The ``pairs`` (a, b: sids) whose bitmaps leave enough in common."""
        p = self.percent
        one = self.sets.select(F.col("sid").alias("a"), F.col("size").alias("size_a"), F.col("wide").alias("bits_a"))
        two = self.sets.select(F.col("sid").alias("b"), F.col("size").alias("size_b"), F.col("wide").alias("bits_b"))
        names = pairs.columns

        def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                total = batch.column("size_a").to_numpy() + batch.column("size_b").to_numpy()
                both = zip(batch.column("bits_a").to_pylist(), batch.column("bits_b").to_pylist(), strict=True)
                differ = np.fromiter((differing(a, b) for a, b in both), dtype=np.int64, count=len(total))
                yield batch.select(names).filter(pa.array((100 + p) * differ <= (100 - p) * total))

        sized = pairs.join(one, "a").join(two, "b").select(*names, "size_a", "size_b", "bits_a", "bits_b")
        return materialize(sized.mapInArrow(scan, ", ".join(f"{c} long" for c in names)), "likely")

    def texts_of(self, sids: DataFrame) -> DataFrame:
        """(sid, text): one text of each set of ``sids``."""
        keys = materialize(self.sets.join(sids, "sid", "left_semi").select("sid", "text_key", "one"), "asked_sets")
        asked = F.broadcast(keys) if keys.count() <= SENT_KEYS else keys.hint("shuffle_hash")
        same = self.texts["doc_id"].eqNullSafe(asked["one"]) & (self.texts["text_key"] == asked["text_key"])
        found = self.texts.join(asked, same).select("sid", "text")
        return materialize(found.groupBy("sid").agg(F.first("text").alias("text")), "asked_texts")

    def links(self, pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) whose sets link, compared exactly."""
        words, percent = self.words, self.percent
        texts = self.texts_of(pairs.select(F.explode(F.array("a", "b")).alias("sid")).distinct())

        def hashes(text: str) -> np.ndarray:
            raw = np.frombuffer(text.encode(), dtype=np.uint8)
            return shingles(raw, np.array([0, len(raw)]), words)[1]

        def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            last, second = None, None
            for batch in batches:
                keep = np.zeros(batch.num_rows, dtype=bool)
                ends = batch.column("b").to_numpy()
                for i in range(batch.num_rows):
                    if ends[i] != last:
                        last, second = ends[i], hashes(batch.column("text_b")[i].as_py())
                    first = hashes(batch.column("text_a")[i].as_py())
                    common = len(np.intersect1d(first, second, assume_unique=True))
                    keep[i] = 100 * common >= percent * (len(first) + len(second) - common)
                yield batch.select(["a", "b"]).filter(pa.array(keep))

        one = texts.select(F.col("sid").alias("a"), F.col("text").alias("text_a"))
        two = texts.select(F.col("sid").alias("b"), F.col("text").alias("text_b"))
        both = pairs.select("a", "b").join(one, "a").join(two.hint("merge"), "b").select("a", "b", "text_a", "text_b")
        return materialize(both.mapInArrow(scan, "a long, b long"), "links")

    def degrees(self, labels: DataFrame) -> DataFrame:
        """(sid, n_links): how many sets each set links to, for components
        (node, label) of all sets that link."""
        words, percent = self.words, self.percent
        members = labels.select(F.col("node").alias("sid"), "label").unionByName(
            labels.select(F.col("label").alias("sid"), "label").distinct()
        )
        counts = members.groupBy("label").agg(F.count(F.lit(1)).alias("n"))
        # sets whose classes are not neighbours differ too much in size
        step = max(float(np.log(100 / percent)), 0.01) * 1.0001
        level = F.when(F.col("n") > COMPONENT_PART, F.floor(F.log("size") / step)).otherwise(0).cast("int")
        members = members.join(counts, "label").join(self.sets.select("sid", "size"), "sid")
        members = materialize(members.select("sid", "label", "n", level.alias("level")), "members")
        two = members.where("n = 2").select("sid", F.lit(1).cast("bigint").alias("n_links"))
        members = members.where("n > 2")
        levels = members.groupBy("label", "level").agg(F.count(F.lit(1)).alias("n"))
        levels = materialize(
            levels.select("label", "level", F.ceil(F.col("n") / COMPONENT_PART).cast("int").alias("parts")), "levels"
        )
        here = members.join(levels, ["label", "level"]).withColumn(
            "own", F.pmod(F.xxhash64("sid"), F.col("parts")).cast("int")
        )
        near = levels.select("label", F.col("level").alias("with_level"), F.col("parts").alias("with_parts"))
        both = here.join(near, "label").where(F.abs(F.col("with_level") - F.col("level")) <= 1)
        both = both.withColumn("with", F.explode(F.expr("sequence(0, with_parts - 1)")))
        mine, other = F.struct("level", "own"), F.struct(F.col("with_level").alias("level"), F.col("with").alias("own"))
        placed = both.select(
            "sid", "label", F.least(mine, other).alias("one"), F.greatest(mine, other).alias("two"),
            F.when(mine > other, 1).otherwise(0).alias("side"),
        ).select(
            "label", F.col("one.level").alias("level"), F.col("one.own").alias("part"),
            F.col("two.level").alias("other_level"), F.col("two.own").alias("other"), "side", "sid",
        )
        key = ["label", "level", "part", "other_level", "other"]
        texts = self.texts_of(members.select("sid"))
        placed = placed.join(texts, "sid").select(*key, "side", "sid", "text")
        placed = placed.repartition(*key).sortWithinPartitions(*key, "side", "sid")

        def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            now: tuple | None = None
            values: list[np.ndarray] = []
            side: list[int] = []
            sid: list[int] = []
            out: list[tuple[list[int], np.ndarray]] = []

            def count() -> None:
                # a part pair with rows of one part only has no links to count
                if len(values) > 1 and (now[1:3] == now[3:] or 0 < sum(side) < len(side)):
                    out.append((sid.copy(), link_counts(values, np.array(side), percent)))
                for held in (values, side, sid):
                    held.clear()

            def found() -> pa.RecordBatch:
                sids = np.array([i for s, _ in out for i in s], dtype=np.int64)
                n = np.concatenate([n for _, n in out] or [np.zeros(0)]).astype(np.int64)
                out.clear()
                return pa.RecordBatch.from_arrays([pa.array(sids), pa.array(n)], names=["sid", "n_links"])

            for batch in batches:
                keys = list(zip(*(batch.column(c).to_pylist() for c in key), strict=True))
                sides, sids = batch.column("side").to_pylist(), batch.column("sid").to_pylist()
                for a, b, bounds, value in batch_sets(batch.column("text"), words):
                    for i in range(a, b):
                        if keys[i] != now:
                            count()
                            now = keys[i]
                        values.append(value[bounds[i - a]: bounds[i - a + 1]])
                        side.append(sides[i])
                        sid.append(sids[i])
                yield found()
            count()
            yield found()

        counted = placed.mapInArrow(scan, "sid long, n_links long").groupBy("sid").agg(F.sum("n_links").alias("n_links"))
        return materialize(two.unionByName(counted), "degrees")


def link_components(
    docs: DataFrame, words: int = WORDS, percent: int = PERCENT, id_col: str = "doc_id", text: str = "text",
    list_part: int = LIST_PART, count_links: bool = True,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, text_key, n_shingles, component_id,
    group (number of the component, null without shingles) and, unless
    ``count_links`` is off, n_links (all other sets that its set links to).

    Null, empty and wordless texts have no shingles and link with nothing, so
    their component is their own id. Equal texts are one set. A null id is
    never a component's id unless all ids in it are null. Repeated rows are
    rows like others; an empty table gives no rows; other columns are ignored.
    """
    key = F.unhex(F.md5(F.coalesce(F.col(text), F.lit(""))))
    texts = docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"), key.alias("text_key"), F.col(text).cast("string").alias("text")
    )
    scanned = materialize(set_rows(texts, words), "sets")
    rows = scanned.where(F.col("bitmap").isNotNull())
    frequent = (
        scanned.where(F.col("bitmap").isNull()).groupBy(F.col("d1").alias("token")).agg(F.sum("size").alias("n"))
        .orderBy(F.desc("n"), "token").limit(SENT_FREQUENT).toPandas().sort_values("token", key=lambda c: c.to_numpy().view(U64))
    )
    sets = rows.where("size > 0").groupBy("d1", "d2").agg(
        F.max("size").alias("size"), F.min("wide").alias("wide"),
        F.min(F.struct("text_key", F.col("doc_id").alias("one"))).alias("text"),
        F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("docs"),
    ).select("*", "text.*").drop("text")
    sets = materialize(sets.withColumn("sid", F.monotonically_increasing_id()), "distinct_sets")
    corpus = Corpus(texts, sets, words, percent)

    prefixes = prefix_rows(
        texts, words, percent, frequent["token"].to_numpy(dtype=np.int64).view(U64), frequent["n"].to_numpy(dtype=np.int64)
    )
    lists = materialize(read_lists(prefixes, percent), "lists")
    names = sets.select("d1", "sid")
    led = lists.where("kind = 0").groupBy("d1", "leader").agg(F.count(F.lit(1)).alias("shared"))
    led = led.join(names.withColumnRenamed("sid", "a"), "d1").join(
        names.select(F.col("d1").alias("leader"), F.col("sid").alias("b")), "leader"
    )
    led = corpus.likely(led.where("a <> b").select("a", "b", "shared"))
    # first the leader of most lists, which joins nearly all copies; then leaders that don't share it
    best = led.groupBy("a").agg(F.max(F.struct("shared", "b")).alias("best")).select("a", "best.b")
    first = corpus.links(best)

    def labelled(pairs: DataFrame, end: str) -> DataFrame:
        named = first.select(F.col("a").alias(end), F.col("b").alias(f"label_{end}"))
        return pairs.join(named, end, "left").withColumn(f"label_{end}", F.coalesce(f"label_{end}", end))

    others = labelled(labelled(led.select("a", "b").join(best, ["a", "b"], "left_anti"), "a"), "b")
    first = first.unionByName(corpus.links(others.where("label_a <> label_b").select("a", "b")))
    labels = star_components(first)

    long = lists.where("kind = 1").select("token", "d1", "size", "pos").join(names, "d1")
    long = materialize(long.select("token", "sid", "size", "pos"), "long_lists")

    def crossing(labels: DataFrame, every: bool) -> DataFrame:
        """Likely pairs of different components that have a list in common."""
        named = long.join(labels.withColumnRenamed("node", "sid"), "sid", "left")
        named = named.withColumn("label", F.coalesce("label", "sid"))
        split = named.groupBy("token").agg(
            F.count(F.lit(1)).alias("n"), F.min("label").alias("low"), F.max("label").alias("high"),
            F.min(F.struct("sid", "size")).alias("head"),
        ).where("low < high")
        parts = F.ceil(F.col("n") / list_part).cast("int")
        # a large set begins many lists; they are read in several places
        share = F.pmod(F.xxhash64("token"), 1 + F.floor(F.col("head.size") / PLACE_SHINGLES))
        place = F.when(F.col("n") <= SHORT_LIST, F.xxhash64("head.sid", share)).otherwise(F.col("token"))
        placed = (
            named.join(split.select("token", parts.alias("parts"), place.alias("place")), "token")
            .withColumn("own", F.pmod(F.xxhash64("sid"), F.col("parts")).cast("int"))
            .withColumn("with", F.explode(F.expr("sequence(0, parts - 1)")))
            .withColumn("part", F.least("own", "with")).withColumn("other", F.greatest("own", "with"))
            .select("place", "token", "part", "other", "own", "sid", "label", "size", "pos")
        )
        bitmaps_of = sets.select("sid", F.col("wide").alias("bitmap"))
        return materialize(cross_pairs(placed, percent, every, bitmaps_of).distinct(), "cross_pairs")

    def joined(labels: DataFrame, links: DataFrame) -> DataFrame:
        return star_components(labels.select(F.col("node").alias("a"), F.col("label").alias("b")).unionByName(links))

    near = corpus.links(crossing(labels, every=False))
    labels = joined(labels, near)
    labels = joined(labels, corpus.links(crossing(labels, every=True)))
    whole = sets.join(labels.withColumnRenamed("node", "sid"), "sid", "left").withColumn(
        "label", F.coalesce("label", "sid")
    )
    least = whole.groupBy("label").agg(F.min("least").alias("component_id"))
    if count_links:
        whole = whole.join(corpus.degrees(labels), "sid", "left").withColumn("n_links", F.coalesce("n_links", F.lit(0)))
    counted = ["n_links"] if count_links else []
    found = whole.join(least, "label").select(
        "d1", "d2", "docs", "component_id", F.col("label").alias("group"), *counted
    )
    found = materialize(found, "components")
    out = ["doc_id", "text_key", F.col("size").alias("n_shingles"), "component_id", "group", *counted]
    linked = attach(rows.where("size > 0").drop("bitmap", "wide"), found, ["d1", "d2"], "docs").select(*out)
    alone = rows.where("size = 0").withColumns({
        "component_id": F.col("doc_id"), "group": F.lit(None).cast("bigint"), "n_links": F.lit(0).cast("bigint"),
    })
    return linked.unionByName(alone.select(*out))


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_components(table(spark, sf_dir, "documents")).drop("text_key", "group")
