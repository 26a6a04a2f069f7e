"""Token-sequence preparation. Input rows hold whole texts or whole token
arrays; truncation and padding stay inside the row."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollforge.functions import tokens as K
from rollforge.plans.packing import best_fit_plan
from rollforge.plans.skew import attach_stats, hash_position
from rollforge.plans.storage import materialize
from rollforge.schemas import BOS_ID, EOS_ID, IGNORED_LABEL, PAD_ID, one_of, require

Tokenizer = Callable[[Column], Column]
# Tokens sent to every task that encodes texts.
HEAD_TOKENS = 500_000
# Text, or ids, that a task's Python takes apart at once.
SLICE_BYTES = 4 << 20


# ------------------------------------------------------------ vocabulary ids

def build_vocab(df: DataFrame, text: str = "text", seed: int = 7) -> DataFrame:
    """token, n, token_id: dense ids in seeded hash order after the special ids."""
    counts = materialize(count_words(df, text).groupBy("token").agg(F.sum("n").alias("n")), "vocab")
    placed = hash_position(counts, "token", seed)
    return materialize(placed.select("token", "n", (F.col("position") + K.FIRST_FREE_ID).alias("token_id")), "vocab_ids")


def _words_of(column: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Words of all texts of a batch, and where each text's words begin (one more than texts)."""
    lists = pc.ascii_split_whitespace(pc.fill_null(column.cast(pa.large_string()), ""))
    words, starts = lists.flatten(), lists.offsets.to_numpy() - lists.offsets[0].as_py()
    some = pc.greater(pc.binary_length(words), 0)
    before = np.zeros(len(words) + 1, dtype=np.int64)
    np.cumsum(some.to_numpy(zero_copy_only=False), out=before[1:])
    return words.filter(some), before[starts]


def _slices(batch: pa.RecordBatch, sizes: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows, each up to the row that brings it to ``SLICE_BYTES`` by
    ``sizes``: what is made of a run goes by its bytes, not by the rows of a batch."""
    before = np.cumsum(sizes, dtype=np.int64) - sizes
    start = 0
    while start < len(before):
        stop = int(np.searchsorted(before, before[start] + SLICE_BYTES))
        yield batch.slice(start, stop - start)
        start = stop


def _by_text(batches: Iterator[pa.RecordBatch], at: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield from _slices(batch, pc.fill_null(pc.binary_length(batch.column(at)), 0).to_numpy(zero_copy_only=False))


def count_words(df: DataFrame, text: str) -> DataFrame:
    """token, n: each batch's different words with their counts (partial sums)."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _by_text(batches, 0):
            found = pc.value_counts(_words_of(batch.column(0))[0])
            yield pa.RecordBatch.from_arrays(
                [found.field("values").cast(pa.string()), found.field("counts")], names=["token", "n"]
            )

    return df.select(text).mapInArrow(scan, "token string, n long")


def encode(df: DataFrame, vocab: DataFrame, key: str, text: str = "text", head_tokens: int = HEAD_TOKENS) -> DataFrame:
    """Token-id array per row: key, input_ids; a text without words gets an
    empty array, a word that ``vocab`` lacks a null.

    The ``head_tokens`` most frequent tokens are looked up where the text is
    read. Only words beyond them, rare ones by definition, are joined to the
    vocabulary by shuffle and put back in their places.
    """
    vocab = vocab.select("token", "n", "token_id")
    total = vocab.count()
    head = vocab if total <= head_tokens else vocab.orderBy(F.desc("n"), "token").limit(head_tokens)
    rows = head.select("token", "token_id").toArrow()
    tokens = rows.column("token").combine_chunks().cast(pa.large_string())
    codes = rows.column("token_id").combine_chunks()
    key_type = df.schema[key].dataType

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _by_text(batches, 1):
            words, starts = _words_of(batch.column(1))
            coded = words.dictionary_encode()
            known = pc.index_in(coded.dictionary, value_set=tokens)
            found = codes.take(known).take(coded.indices)
            missing = np.flatnonzero(found.is_null().to_numpy(zero_copy_only=False)) if found.null_count else np.zeros(0, int)
            offsets = pa.array(starts.astype(np.int32))
            row = np.searchsorted(starts, missing, side="right") - 1
            # rare words by row: places and texts
            firsts = np.searchsorted(row, np.arange(len(starts))).astype(np.int32)
            rare = pa.StructArray.from_arrays(
                [pa.array((missing - starts[row]).astype(np.int32)), words.take(pa.array(missing)).cast(pa.string())], ["pos", "token"]
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.ListArray.from_arrays(offsets, found), pa.ListArray.from_arrays(pa.array(firsts), rare)],
                names=["key", "ids", "rare"],
            )

    schema = T.StructType([
        T.StructField("key", key_type), T.StructField("ids", T.ArrayType(T.LongType())),
        T.StructField("rare", T.ArrayType(T.StructType([T.StructField("pos", T.IntegerType()), T.StructField("token", T.StringType())]))),
    ])
    coded = df.select(F.col(key).alias("key"), F.col(text)).mapInArrow(look_up, schema)
    if total <= head_tokens:
        return coded.select(F.col("key").alias(key), F.col("ids").alias("input_ids"))

    coded = materialize(coded.withColumn("row", F.monotonically_increasing_id()), "head_coded")
    asked = coded.where(F.size("rare") > 0).select("row", F.explode("rare").alias("r")).select("row", "r.pos", "r.token")
    found = asked.join(vocab.select("token", "token_id"), "token")
    rare = found.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("pos", "token_id"))).alias("found"))

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in _slices(whole, pc.list_value_length(whole.column(1)).to_numpy(zero_copy_only=False) * 8):
                lists, places = batch.column(1), batch.column(2)
                ids, starts = lists.flatten(), lists.offsets.to_numpy() - lists.offsets[0].as_py()
                put, each = places.flatten(), pc.fill_null(pc.list_value_length(places), 0)
                at = np.repeat(starts[:-1], each) + pc.struct_field(put, "pos").to_numpy(zero_copy_only=False)
                known, values = ids.is_valid().to_numpy(zero_copy_only=False).copy(), pc.fill_null(ids, 0).to_numpy().copy()
                values[at], known[at] = pc.struct_field(put, "token_id").to_numpy(zero_copy_only=False), True
                filled = pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(values, pa.int64(), mask=~known))
                yield pa.RecordBatch.from_arrays([batch.column(0), filled], names=["key", "ids"])

    joined = coded.join(rare, "row", "left").select("key", "ids", "found")
    return joined.mapInArrow(fill, T.StructType(schema.fields[:2])).select(F.col("key").alias(key), F.col("ids").alias("input_ids"))


# ------------------------------------------------------------------- pairs

def prep_pairs(
    pairs: DataFrame,
    tokenize: Tokenizer = K.hash_tokens,
    max_prompt: int | None = None,
    max_completion: int | None = None,
    add_special: bool = False,
) -> DataFrame:
    """Prompt keeps its last, completions plus EOS their first tokens."""
    require(pairs, ["prompt", "chosen", "rejected"], "prep_pairs")
    prompt = tokenize(F.col("prompt"))
    if add_special:
        prompt = F.concat(K.ids(BOS_ID), prompt, K.ids(EOS_ID))
    done = {c: F.concat(tokenize(F.col(c)), K.ids(EOS_ID)) for c in ("chosen", "rejected")}
    keep = [c for c in pairs.columns if c not in ("prompt", "chosen", "rejected")]
    whole = pairs.select(*keep, prompt.alias("p"), done["chosen"].alias("c"), done["rejected"].alias("r"))
    return whole.select(
        *keep, K.last_n(F.col("p"), max_prompt).alias("prompt_ids"),
        K.first_n(F.col("c"), max_completion).alias("chosen_ids"),
        K.first_n(F.col("r"), max_completion).alias("rejected_ids"),
    )


def prep_pairs_joint(
    pairs: DataFrame, max_length: int, max_prompt: int, mode: str = "keep_end", tokenize: Tokenizer = K.hash_tokens
) -> DataFrame:
    """Shorten the prompt when prompt plus longer response is too long, then the
    responses if that was not enough; labels ignore the prompt."""
    one_of(mode, ["keep_start", "keep_end"], "truncation mode")
    keep = [c for c in pairs.columns if c not in ("prompt", "chosen", "rejected")]
    whole = pairs.select(
        *keep, K.ensure_bos(tokenize(F.col("prompt"))).alias("p"), K.ensure_eos(tokenize(F.col("chosen"))).alias("c"),
        K.ensure_eos(tokenize(F.col("rejected"))).alias("r"),
    ).withColumn("longer", F.greatest(F.size("c"), F.size("r")))
    cut = K.first_n if mode == "keep_start" else K.last_n
    fitted = whole.withColumn(
        "p", F.when(F.size("p") + F.col("longer") > max_length, cut(F.col("p"), max_prompt)).otherwise(F.col("p"))
    )
    too_long = F.size("p") + F.col("longer") > max_length
    for c in ("c", "r"):
        fitted = fitted.withColumn(
            f"{c}2", F.when(too_long, K.first_n(F.col(c), max_length - max_prompt)).otherwise(F.col(c)))
    return fitted.select(
        *keep, F.col("p").alias("prompt_ids"),
        F.concat("p", "c2").alias("chosen_ids"), K.masked_labels(F.col("p"), F.col("c2")).alias("chosen_labels"),
        F.concat("p", "r2").alias("rejected_ids"), K.masked_labels(F.col("p"), F.col("r2")).alias("rejected_labels"),
    )


def length_filter(prepared: DataFrame, max_length: int) -> DataFrame:
    return prepared.where((F.size("chosen_ids") <= max_length) & (F.size("rejected_ids") <= max_length))


def length_filter_report(prepared: DataFrame, max_length: int) -> DataFrame:
    fits = (F.size("chosen_ids") <= max_length) & (F.size("rejected_ids") <= max_length)
    return prepared.agg(
        F.count(F.when(fits, 1)).alias("kept"), F.count(F.when(~fits, 1)).alias("dropped")
    )


# ------------------------------------------------------------------- steps

def prep_steps(
    steps: DataFrame,
    prompts: DataFrame,
    key: str,
    separator: Sequence[int],
    max_length: int,
    max_prompt: int | None = None,
    max_completion: int | None = None,
    last_step_only: bool = False,
    tokenize: Tokenizer = K.hash_tokens,
) -> DataFrame:
    """Step-labelled completions to ids and labels, one row per sequence.

    A step's label stands at its last token, so a step without tokens (no words
    and an empty ``separator``) has none. With ``max_completion`` a step sends
    no more than its first ``max_completion`` tokens to the shuffle. Keys
    without a prompt or without steps give no row.
    """
    kept = steps
    label = F.col("label").cast("bigint")
    if last_step_only:
        ends = steps.groupBy(key).agg(F.max("turn").alias("__last"), F.count(F.lit(1)).alias("__n"))
        kept = attach_stats(kept, ends, [key], n="__n")
        label = F.when(F.col("turn") == F.col("__last"), label).otherwise(F.lit(IGNORED_LABEL).cast("bigint"))
    ids = F.concat(tokenize(F.col("step_text")), K.ids(*separator))
    per_step = kept.select(key, "turn", ids.alias("ids"), label.alias("label")).select(
        key, "turn", K.first_n(F.col("ids"), max_completion).alias("ids"),
        K.first_n(
            F.when(F.size("ids") > 0, F.concat(K.repeat(IGNORED_LABEL, F.size("ids") - 1), F.array("label")))
            .otherwise(K.ids()), max_completion,
        ).alias("labels"),
    )
    joined = per_step.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("turn", "ids", "labels"))).alias("s"))
    prompt = K.last_n(F.concat(K.ids(BOS_ID), tokenize(F.col("prompt"))), max_prompt)
    both = prompts.select(key, prompt.alias("p")).join(joined, key)
    ids = K.first_n(F.flatten("s.ids"), max_completion)
    labels = K.first_n(F.flatten("s.labels"), max_completion)
    return both.select(
        key, K.first_n(F.concat("p", ids), max_length).alias("input_ids"),
        K.first_n(K.masked_labels(F.col("p"), labels), max_length).alias("labels"),
    )


def prep_texts(df: DataFrame, text: str, max_length: int | None, tokenize: Tokenizer = K.hash_tokens) -> DataFrame:
    keep = [c for c in df.columns if c != text]
    return df.select(*keep, tokenize(F.col(text)).alias("input_ids")).withColumn(
        "input_ids", K.first_n(F.col("input_ids"), max_length))


def truncate_total(df: DataFrame, prompt: str, completion: str, max_length: int, mode: str = "keep_start") -> DataFrame:
    """Prompt plus completion cut to ``max_length``; the loss mask covers the
    completion."""
    one_of(mode, ["keep_start", "keep_end"], "truncation mode")
    cut = K.first_n if mode == "keep_start" else K.last_n
    whole = df.withColumn("__ids", F.concat(prompt, completion)).withColumn(
        "__mask", F.concat(K.repeat(0, F.size(prompt)), K.repeat(1, F.size(completion))))
    return whole.select(
        *df.columns, cut(F.col("__ids"), max_length).alias("input_ids"), cut(F.col("__mask"), max_length).alias("loss_mask")
    )


def pad_sequences(
    df: DataFrame, ids: str, keys: Sequence[str] = (), side: str = "left", length: int | None = None, pad: int = PAD_ID
) -> DataFrame:
    """Pad to a fixed length or to the longest sequence of the batch ``keys``
    (of the table, without keys)."""
    one_of(side, ["left", "right"], "side")
    if length is not None:
        rows, target = df, F.lit(length)
    elif not keys:
        longest = df.agg(F.coalesce(F.max(F.size(ids)), F.lit(0))).first()[0]
        rows, target = df, F.lit(longest)
    else:
        longest = df.groupBy(*keys).agg(F.max(F.size(ids)).alias("__longest"), F.count(F.lit(1)).alias("__n"))
        rows, target = attach_stats(df, longest, keys, n="__n"), F.col("__longest")
    padded = rows.withColumn(ids, K.pad_to(F.col(ids), target, side, pad))
    return padded.withColumn("attention_mask", K.non_pad_mask(F.col(ids), pad)).drop("__longest", "__n")


def completion_masks(df: DataFrame, ids: str, keep: int, keys: Sequence[str], pad: int = PAD_ID) -> DataFrame:
    """Mask of the last ``keep`` tokens, from the left padding of each row and
    the largest left padding of its batch."""
    pads = K.left_pads(F.col(ids), keep, pad)
    widest = df.groupBy(*keys).agg(F.max(pads).alias("__widest"), F.count(F.lit(1)).alias("__n"))
    rows = attach_stats(df, widest, keys, n="__n")
    tail = K.last_n(F.col(ids), keep)
    return rows.withColumn("completion_mask", K.completion_mask(tail, pads, F.col("__widest"), pad)).drop("__widest", "__n")


# ----------------------------------------------------------------- packing

def shard_of(key: Column, shards: int) -> Column:
    return F.conv(F.substring(F.md5(key.cast("string")), 1, 8), 16, 10).cast("bigint") % shards


def shard_count(df: DataFrame, shard_rows: int) -> int:
    """Shards so that one holds about ``shard_rows`` sequences."""
    return max(1, -(-df.count() // shard_rows))


def pack_wrapped(df: DataFrame, key: str, ids: str, block: int, shards: int) -> DataFrame:
    """Concatenate the sequences of a shard in key order and cut every ``block``
    tokens. A shard has a bounded number of sequences; token pieces are cut
    inside the row, and at most ``block`` pieces meet in a block. Blocks are
    inside shards, so that gathering them needs no second shuffle."""
    sharded = df.select(key, ids).withColumn("shard", shard_of(F.col(key), shards))
    w = Window.partitionBy("shard").orderBy(key).rowsBetween(Window.unboundedPreceding, -1)
    length = F.size(ids).cast("bigint")
    placed = sharded.withColumn("__start", F.coalesce(F.sum(length).over(w), F.lit(0).cast("bigint")))
    placed = placed.where(length > 0)
    first = F.expr(f"__start div {block}")
    end = F.expr(f"(__start + size({ids}) - 1) div {block}")
    pieces = placed.withColumn("block", F.explode(F.sequence(first, end)))
    low = F.greatest(F.col("block") * block - F.col("__start"), F.lit(0))
    high = F.least((F.col("block") + 1) * block - F.col("__start"), F.size(ids).cast("bigint"))
    pieces = pieces.select(
        "shard", "block", "__start", low.alias("low"),
        F.slice(F.col(ids), (low + 1).cast("int"), (high - low).cast("int")).alias("piece"))
    return pieces.groupBy("shard", "block").agg(
        F.flatten(F.sort_array(F.collect_list(F.struct((F.col("__start") + F.col("low")).alias("at"), "piece")))["piece"]).alias("input_ids")
    )


PLAN = "n int, placements array<struct<first_rank:bigint,count:bigint,per_block:bigint,first_block:bigint,used:int>>"


def pack_best_fit(df: DataFrame, key: str, ids: str, block: int, seed: int = 7) -> DataFrame:
    """Best-fit-decreasing packing of all sequences: block, input_ids.

    Sequences stay in one piece unless longer than a block; empty ones are in no
    block. The plan is made from the histogram of lengths (at most ``block``
    counts); sequences of one length are dealt out by their rank in seeded hash
    order of ``key:first token``, so the result does not depend on partitions.
    Repeated keys must not have pieces at the same place.
    """
    pieces = df.select(
        F.col(key).cast("string").alias("__key"), F.col(ids).alias("__ids"),
        F.explode(F.sequence(F.lit(0), F.greatest(F.size(ids) - 1, F.lit(0)), F.lit(block))).alias("low"),
    )
    pieces = pieces.select(
        F.concat_ws(":", "__key", "low").alias("__piece"), F.slice("__ids", F.col("low") + 1, F.lit(block)).alias("piece")
    ).withColumn("n", F.size("piece")).where("n > 0")
    ranked = materialize(hash_position(pieces, "__piece", seed, groups=["n"], name="rank"), "ranked_pieces")
    histogram = [tuple(r) for r in ranked.groupBy("n").agg(F.count(F.lit(1)).alias("c")).collect()]
    by_length: dict[int, list[tuple[int, ...]]] = {}
    for placed in best_fit_plan(histogram, block):
        by_length.setdefault(placed.length, []).append(placed[1:])
    plan = df.sparkSession.createDataFrame(list(by_length.items()), PLAN)
    own = F.filter("placements", lambda p: (F.col("rank") >= p["first_rank"]) & (F.col("rank") < p["first_rank"] + p["count"]))
    found = ranked.join(F.broadcast(plan), "n").withColumn("p", F.element_at(own, 1)).withColumn("j", F.col("rank") - F.col("p.first_rank"))
    spots = found.select(
        (F.col("p.first_block") + F.expr("j div p.per_block")).alias("block"),
        (F.col("p.used") + F.expr("j % p.per_block") * F.col("n")).alias("offset"), "piece",
    )
    return spots.groupBy("block").agg(  # at most ``block`` tokens
        F.flatten(F.sort_array(F.collect_list(F.struct("offset", "piece")))["piece"]).alias("input_ids"))


# ----------------------------------------------------------- set operations

def unpair(pairs: DataFrame) -> DataFrame:
    """One pair to a true (chosen) and a false (rejected) row, in one scan."""
    keep = [c for c in pairs.columns if c not in ("chosen", "rejected")]
    sides = F.array(
        F.struct(F.col("chosen").alias("completion"), F.lit(True).alias("label")),
        F.struct(F.col("rejected").alias("completion"), F.lit(False).alias("label")),
    )
    return pairs.select(*keep, F.explode(sides).alias("s")).select(*keep, "s.completion", "s.label")


def stack_pairs(prepared: DataFrame, keys: Sequence[str], pad: int = PAD_ID) -> DataFrame:
    """Chosen and rejected rows of a batch under each other, the prompt in both,
    completions padded to the longest of the batch."""
    keep = [c for c in prepared.columns if c not in ("chosen_ids", "rejected_ids")]
    sides = F.array(
        F.struct(F.lit("chosen").alias("side"), F.col("chosen_ids").alias("completion_ids")),
        F.struct(F.lit("rejected").alias("side"), F.col("rejected_ids").alias("completion_ids")),
    )
    rows = prepared.select(*keep, F.explode(sides).alias("s")).select(*keep, "s.side", "s.completion_ids")
    return pad_sequences(rows, "completion_ids", keys, side="right", pad=pad)


def label_partition(df: DataFrame, label: str = "label") -> tuple[DataFrame, DataFrame]:
    """Desirable and undesirable rows; both are pushed-down filters of one table."""
    return df.where(F.col(label)), df.where(~F.col(label))
