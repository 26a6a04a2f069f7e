"""Column builders over token-id arrays (one row = one sequence)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rollforge.functions import numeric as N
from rollforge.schemas import BOS_ID, EOS_ID, IGNORED_LABEL, PAD_ID

FIRST_FREE_ID = 4
HASH_IDS = 1_000_003


def ids(*values: int) -> Column:
    return F.array(*[F.lit(v).cast("bigint") for v in values]).cast("array<bigint>")


def words(text: Column) -> Column:
    return F.filter(F.split(text, r"\s+"), lambda w: w != "")


def hash_tokens(text: Column) -> Column:
    """Default tokenizer: whitespace words, id from the word's own digest.

    Needs no vocabulary table and no join, so preparation stays in the scan
    stage; a ``pandas_udf('array<bigint>')`` can be passed in its place.
    """
    return F.transform(
        words(text),
        lambda w: F.lit(FIRST_FREE_ID) + F.conv(F.substring(F.md5(w), 1, 8), 16, 10).cast("bigint") % HASH_IDS,
    )


def first_n(a: Column, n: int | None) -> Column:
    return a if n is None else F.slice(a, 1, n)


def last_n(a: Column, n: int | None) -> Column:
    return a if n is None else F.slice(a, F.greatest(F.lit(1), F.size(a) - (n - 1)), F.lit(n))


def repeat(value: int, n: Column) -> Column:
    return F.when(n > 0, F.array_repeat(F.lit(value).cast("bigint"), n.cast("int"))).otherwise(
        F.array().cast("array<bigint>")
    )


def ensure_bos(a: Column, bos: int = BOS_ID) -> Column:
    return F.when((F.size(a) > 0) & (F.get(a, F.lit(0)) == bos), a).otherwise(F.concat(ids(bos), a))


def ensure_eos(a: Column, eos: int = EOS_ID) -> Column:
    return F.when((F.size(a) > 0) & (F.get(a, F.size(a) - 1) == eos), a).otherwise(F.concat(a, ids(eos)))


def masked_labels(prompt: Column, completion: Column) -> Column:
    return F.concat(repeat(IGNORED_LABEL, F.size(prompt)), completion)


def pad_to(a: Column, n: Column, side: str, pad: int = PAD_ID) -> Column:
    fill = repeat(pad, n - F.size(a))
    return F.concat(fill, a) if side == "left" else F.concat(a, fill)


def pads_last(a: Column, pad: int = PAD_ID) -> Column:
    """Move padding to the right, order kept."""
    kept = F.filter(a, lambda x: x != pad)
    return F.concat(kept, repeat(pad, F.size(a) - F.size(kept)))


def non_pad_mask(a: Column, pad: int = PAD_ID) -> Column:
    return F.transform(a, lambda x: (x != pad).cast("int"))


def count_real(a: Column, eos: int = EOS_ID, pad: int = PAD_ID) -> Column:
    """Tokens that are neither end-of-sequence nor padding."""
    return F.size(F.filter(a, lambda x: (x != eos) & (x != pad)))


def until_stop(a: Column, eos: int = EOS_ID) -> Column:
    """Tokens up to and including the first end-of-sequence token."""
    at = F.array_position(a, F.lit(eos).cast("bigint"))
    return F.when(at > 0, F.slice(a, F.lit(1), at.cast("int"))).otherwise(a)


def stop_mask(a: Column, eos: int = EOS_ID, drop_unfinished: bool = False) -> Column:
    """1 up to the first stop token, else 0; optionally 0 for unfinished rows."""
    at = F.array_position(a, F.lit(eos).cast("bigint"))
    unfinished = F.lit(0 if drop_unfinished else 1)
    return F.transform(a, lambda x, i: F.when(at == 0, unfinished).otherwise((i < at).cast("int")))


def left_pads(a: Column, keep: int, pad: int = PAD_ID) -> Column:
    """Padding tokens in the prompt part, i.e. all but the last ``keep`` tokens."""
    return F.size(F.filter(F.slice(a, F.lit(1), F.greatest(F.size(a) - keep, F.lit(0))), lambda x: x == pad))


def completion_mask(completion: Column, pads: Column, max_pads: Column, pad: int = PAD_ID) -> Column:
    """0 on prompt tokens that slid into the window and on padding, else 1."""
    return F.transform(completion, lambda x, i: ((i >= max_pads - pads) & (x != pad)).cast("int"))


def as_text(a: Column) -> Column:
    return F.array_join(F.transform(a, lambda x: x.cast("string")), ",")


def positions(a: Column) -> Column:
    """Running position inside the sequence."""
    return F.transform(a, lambda x, i: i.cast("bigint"))


def next_tokens(a: Column) -> Column:
    """Label of each position: the token after it, NULL at the end."""
    return N.bound({"a": a}, lambda row: F.transform(row["a"], lambda x, i: F.get(row["a"], i + 1)))
