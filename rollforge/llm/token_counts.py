"""Token counts of texts with a BPE tokenizer, by the whole-token shortcut.

Merges only ever build vocabulary strings, so a text may be cut wherever no
vocabulary string has the two characters next to each other: before a space
mark that follows another character, and between ASCII punctuation or line
ends and other characters. Offline, once per worker, those cuts are checked
against the vocabulary, and it is proved which vocabulary strings that are one
pre-token encode alone as one token. Pre-tokens among these count directly;
only the others are merged, each distinct one once while it is remembered.
"""

from __future__ import annotations

import re
import string
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from rollforge.llm.common import table

MODEL = "piece_bpe_32k.model"
LIMIT = 4096
MARK = "▁"
PUNCTUATION = string.punctuation + "\n\t"
COARSE = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")
FINE = re.compile(f"{MARK}*[^{MARK}{re.escape(PUNCTUATION)}]+|{MARK}*[{re.escape(PUNCTUATION)}]+|{MARK}+")
# A line end is in no vocabulary string, so it separates a pre-token from the mark that a model adds.
GUARD = "\n"
# Distinct merged pre-tokens that a worker remembers at a time.
REMEMBERED = 400_000
# Pre-tokens of several texts that are looked up together.
GROUP = 200_000


class Counter:
    """Counts of the tokens that ``sentencepiece`` gives, for one model."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        model = self.model
        pieces = [
            model.id_to_piece(i) for i in range(model.get_piece_size())
            if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))
        ]
        self.splits = self._splits(pieces)
        # others than punctuation that some vocabulary string has beside it: texts with them are cut coarsely
        near = {
            x for p in pieces for a, b in zip(p, p[1:]) for x, y in ((a, b), (b, a))
            if y in PUNCTUATION and x not in PUNCTUATION and x != MARK
        }
        guarded = not any(GUARD in p for p in pieces)
        self.near = re.compile(f"[{re.escape(''.join(sorted(near)))}]") if near else re.compile(r"(?!)")
        self.fine = FINE if guarded and not any(x.isalnum() and x.isascii() for x in near) else COARSE
        self.guard = len(self.model.encode(GUARD))
        self.whole = self._prove([p for p in pieces if self.fine.fullmatch(p)])
        self.known = dict.fromkeys(self.whole, 1)

    def _splits(self, pieces: list[str]) -> bool:
        """Whether spaces are kept as marks one to one with one mark in front,
        and no vocabulary string has a mark after another character."""
        inner = any(re.search(f"[^{MARK}]{MARK}", p) for p in pieces)
        probe = "a  b éﬁ　 "
        return not inner and self.model.normalize(probe) == MARK + probe.replace(" ", MARK)

    def _alone(self, parts: list[str]) -> list[int]:
        """Tokens of each pre-token as the model merges it by itself."""
        asked = [p[1:] if p[0] == MARK else GUARD + p for p in parts]
        ids = self.model.encode(asked, num_threads=1)
        return [len(i) if p[0] == MARK else len(i) - self.guard for p, i in zip(parts, ids, strict=True)]

    def _prove(self, strings: list[str]) -> frozenset[str]:
        """The strings that alone encode as one token."""
        whole = {s for s, n in zip(strings, self._alone(strings), strict=True) if n == 1}
        if len(self.model.encode("a ")) == len(self.model.encode("a")) + 1:
            whole.add(MARK)  # a lone mark: the empty text, which would stand for it, has no tokens
        return frozenset(whole)

    def count(self, texts: list[str]) -> list[int]:
        if not self.splits:
            return [len(i) for i in self.model.encode(texts, num_threads=1)]
        out: list[int] = []
        group: list[list[str]] = []
        size = 0
        for text in texts:
            marked = text.replace(" ", MARK)
            cut = COARSE if self.near.search(marked) else self.fine
            group.append(cut.findall(MARK + marked) if text else [])
            size += len(group[-1])
            if size > GROUP:
                out += self._sums(group)
                group, size = [], 0
        return out + self._sums(group)

    def _sums(self, group: list[list[str]]) -> list[int]:
        known = self.known
        todo = {p for parts in group for p in parts if p not in known}
        if len(known) + len(todo) > REMEMBERED:
            known.clear()
            known.update(dict.fromkeys(self.whole, 1))
            todo = {p for parts in group for p in parts if p not in known}
        if todo:
            new = list(todo)
            known.update(zip(new, self._alone(new), strict=True))
        return [sum(map(known.__getitem__, parts)) for parts in group]


@cache
def counter(path: str) -> Counter:
    return Counter(path)


def count_tokens(
    docs: DataFrame, path: str, limit: int = LIMIT, id_col: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_tokens, over_limit.

    Counts are those of the model at ``path`` (a file that every executor has)
    for the whole text, without special tokens. A null text is empty and has no
    tokens. Repeated rows and null ids are rows like others; an empty table
    gives no rows; other columns are ignored.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = counter(path)
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            sizes = np.fromiter((len(t.encode()) for t in texts), dtype=np.int64, count=len(texts))
            tokens = np.array(model.count(texts), dtype=np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes), pa.array(tokens), pa.array(tokens > limit)],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    rows = docs.selectExpr(f"cast(`{id_col}` as bigint) as doc_id", f"`{text}` as text")
    return rows.mapInArrow(scan, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path(MODEL))
