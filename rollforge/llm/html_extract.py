"""Main text of web pages by templates deduced from equivalence classes.

Tokens (a start tag or a text run, with the elements around it) of one host
that occur equally often on every page have the same occurrence vector and form
an equivalence class. Vectors are never held: each is a count of pages and an
exclusive-or of hashes of (page, occurrences), so one partial aggregate per
host and token finds the classes, whatever share of the pages a host has. A
class is valid if its tokens come in one order on all its pages and all its
instances lie in one gap of the class around it; valid classes, nested in that
way, are the host's template. What is left between template tokens are slots:
slots of the main region are the text, menus, adverts and the like are not.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollforge.llm.common import table
from rollforge.llm.html_scan import Run, scan, stamp, text_stamp
from rollforge.llm.textscan import mixed
from rollforge.plans.skew import attach_stats
from rollforge.plans.storage import materialize

# A class needs so many different pages, this share of the host's different pages, and so many tokens.
MIN_PAGES = 10
SUPPORT = 0.2
MIN_TOKENS = 3
ROOT = -1


def host_of(url: str) -> str:
    return rf"lower(coalesce(regexp_extract({url}, '://([^/?#]*)', 1), ''))"


def container_sizes(runs: Sequence[Run]) -> Counter:
    """Characters outside links by the innermost container of a run; pages with
    an article or main element need none."""
    sizes: Counter = Counter()
    if any(r.region and not r.skipped for r in runs):
        return sizes
    for r in runs:
        if not r.skipped and r.containers:
            sizes[r.containers[-1]] += len(r.text) - r.links
    return sizes


def main_text(runs: Sequence[Run], template: set[int], container: int | None) -> str:
    """The slots of the main region, in page order.

    The region is the article element, else main, else the container that holds
    most text on the host (on the page, if the page lacks it).
    """
    slots = [r for r in runs if not r.skipped and r.token not in template]
    region = max((r.region for r in slots), default=0)
    if region:
        return " ".join(r.text for r in slots if r.region == region)
    slots = [r for r in slots if r.links < len(r.text)]
    if container is None or not any(container in r.containers for r in slots):
        sizes = container_sizes(slots)
        container = max(sizes, key=lambda c: (sizes[c], -c)) if sizes else None
    return " ".join(r.text for r in slots if container is None or container in r.containers)


PAGE_TOKENS = "host string, content long, tokens binary, places array<long>, sizes array<long>"


def page_tokens(pages: DataFrame) -> DataFrame:
    """One row per page (host, html): its tokens in order, what identifies its
    content (the longest run), and the sizes of its containers."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            content, tokens, places, sizes = [], [], [], []
            for value in batch.column(1):
                found, runs = scan(value.as_py() or "")
                longest = max(runs, key=lambda r: len(r.text), default=None)
                content.append(text_stamp(0, longest.text) if longest else 0)
                tokens.append(np.array(found, dtype=np.int64).tobytes())
                held = container_sizes(runs)
                places.append(list(held))
                sizes.append(list(held.values()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(content, pa.int64()), pa.array(tokens, pa.binary()),
                 pa.array(places, pa.list_(pa.int64())), pa.array(sizes, pa.list_(pa.int64()))],
                names=["host", "content", "tokens", "places", "sizes"],
            )

    return pages.select("host", "html").mapInArrow(read, PAGE_TOKENS)


def token_vectors(pages: DataFrame) -> DataFrame:
    """Occurrence vectors of all tokens, summed per batch: host, token, pages, vector."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hosts = batch.column(0).dictionary_encode()
            host = hosts.indices.to_numpy(zero_copy_only=False)
            rows = mixed(batch.column(1).to_numpy().astype(np.uint64))
            parts = []
            for i, raw in enumerate(batch.column(2)):
                token, n = np.unique(np.frombuffer(raw.as_buffer(), dtype=np.int64), return_counts=True)
                parts.append((np.full(len(token), host[i]), token, mixed(rows[i] ^ mixed(n.astype(np.uint64)))))
            if not parts:
                continue
            of, token, sign = (np.concatenate(x) for x in zip(*parts, strict=True))
            order = np.lexsort((token, of))
            of, token, sign = of[order], token[order], sign[order]
            first = np.flatnonzero(np.append(True, (np.diff(of) != 0) | (np.diff(token) != 0))) if len(of) else np.zeros(0, int)
            if not len(first):
                continue
            yield pa.RecordBatch.from_arrays(
                [hosts.dictionary.take(pa.array(of[first])), pa.array(token[first]),
                 pa.array(np.diff(np.append(first, len(of)))),
                 pa.array(np.bitwise_xor.reduceat(sign, first).view(np.int64))],
                names=["host", "token", "pages", "vector"],
            )

    return pages.select("host", "row", "tokens").mapInArrow(count, "host string, token long, pages long, vector long")


def arrangement(tokens: Sequence[int], classes: Sequence[Sequence[int]]) -> dict[int, tuple[bool, int, int, int]]:
    """How the classes lie on one page: for each class that occurs whether its
    tokens come in one order, that order, and the class and gap around it."""
    owner = {t: c for c, members in enumerate(classes) for t in members}
    sequence = [(owner[t], t) for t in tokens if t in owner]
    seen: dict[int, list[int]] = {}
    for c, t in sequence:
        seen.setdefault(c, []).append(t)
    out: dict[int, tuple[bool, int, int, int]] = {}
    for c, found in seen.items():
        m = len(classes[c])
        period = found[:m]
        ordered = len(found) % m == 0 and len(set(period)) == m and found == period * (len(found) // m)
        out[c] = (ordered, stamp(*period), ROOT, 0)
    place: Counter = Counter()
    around: dict[int, set[tuple[int, int]]] = {}
    stack: list[list[int]] = []  # class and tokens of its open instance so far
    for c, _ in sequence:
        m = len(classes[c])
        if place[c] % m:
            while stack and stack[-1][0] != c:  # an instance that the class around it cuts
                cut = stack.pop()[0]
                out[cut] = (False, *out[cut][1:])
            if stack:
                stack[-1][1] += 1
        else:
            around.setdefault(c, set()).add((stack[-1][0], stack[-1][1]) if stack else (ROOT, 0))
            stack.append([c, 1])
        place[c] += 1
        if place[c] % m == 0 and stack and stack[-1][0] == c:
            stack.pop()
    for c, slots in around.items():
        ok, order, _, _ = out[c]
        parent, gap = min(slots)
        out[c] = (ok and len(slots) == 1, order, parent, gap)
    return out


def arrangements(pages: DataFrame) -> DataFrame:
    """``arrangement`` of pages (host, tokens, classes), summed per batch: what
    differs between pages has two values in it."""

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held: dict[tuple[str, int], set[tuple[bool, int, int, int]]] = {}
            known: dict[str, list] = {}
            for host, raw, classes in zip(*batch.columns, strict=True):
                name = host.as_py()
                if name not in known:
                    known[name] = classes.as_py()
                tokens = np.frombuffer(raw.as_buffer(), dtype=np.int64).tolist()
                for c, found in arrangement(tokens, known[name]).items():
                    held.setdefault((name, c), set()).add(found)
            rows = [(*key, *found) for key, all_found in held.items() for found in all_found]
            columns = list(zip(*rows, strict=True)) if rows else [()] * 6
            kinds = [pa.string(), pa.int32(), pa.bool_(), pa.int64(), pa.int32(), pa.int32()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                names=["host", "class", "ordered", "order", "parent", "gap"],
            )

    return pages.select("host", "tokens", "classes").mapInArrow(
        judge, "host string, class int, ordered boolean, order long, parent int, gap int"
    )


def templates(
    scanned: DataFrame, min_pages: int = MIN_PAGES, support: float = SUPPORT, min_tokens: int = MIN_TOKENS
) -> DataFrame:
    """The valid classes of every host: host, class, parent, gap, tokens.

    ``scanned`` (written) has host, row, content and tokens. Pages with the same
    content count once, so that copies of an article make no template of it. A
    token that ``support`` of the pages have is on at least that share, so a
    host has at most 1 / ``support`` times the tokens of its mean page in
    classes.
    """
    first = scanned.groupBy("host", "content").agg(F.min("row").alias("row"))
    pages = materialize(scanned.join(first.select("row").hint("shuffle_hash"), "row", "left_semi"), "different_pages")
    sizes = pages.groupBy("host").agg(F.count(F.lit(1)).alias("n_pages")).where(F.col("n_pages") >= min_pages)
    vectors = token_vectors(pages).groupBy("host", "token").agg(
        F.sum("pages").alias("pages"), F.bit_xor("vector").alias("vector")
    ).where(F.col("pages") >= min_pages)
    enough = vectors.join(sizes, "host").where(F.col("pages") >= F.col("n_pages") * support)
    classes = (
        enough.groupBy("host", "pages", "vector").agg(F.array_sort(F.collect_list("token")).alias("members"))
        .where(F.size("members") >= min_tokens)
    )
    by_host = materialize(
        classes.groupBy("host").agg(F.array_sort(F.collect_list("members")).alias("classes"), F.sum("pages").alias("n")), "classes"
    )
    marked = attach_stats(pages.select("host", "tokens"), by_host, ["host"]).where("classes is not null")
    judged = arrangements(marked).groupBy("host", "class").agg(
        F.min("ordered").alias("ordered"), F.min("order").alias("a"), F.max("order").alias("b"),
        F.min(F.struct("parent", "gap")).alias("low"), F.max(F.struct("parent", "gap")).alias("high"),
    ).where("ordered and a = b and low = high")
    members = by_host.select("host", F.posexplode("classes").alias("class", "tokens"))
    return judged.join(members, ["host", "class"]).select("host", "class", "low.parent", "low.gap", "tokens")


def extract(
    pages: DataFrame, id_col: str = "page_id", url: str = "url", html: str = "html", min_pages: int = MIN_PAGES,
    support: float = SUPPORT,
) -> DataFrame:
    """One row per row of ``pages``: page_id, url, text, n_chars.

    Null and empty pages, and pages without text, give the empty text; pages
    without url form one host. Repeated rows are rows like others. Hosts with
    fewer than ``min_pages`` different pages have no template: there only
    elements and their names tell text from the rest. Text runs are dropped as
    template only in a class that has a start tag too. Blocks are joined by one
    space, white space inside them is one space. Other columns are ignored; an
    empty table gives no rows.
    """
    asked = pages.select(
        F.col(id_col).alias("page_id"), F.col(url).alias("url"), F.col(html).alias("html"), F.expr(host_of(f"`{url}`")).alias("host")
    )
    scanned = materialize(page_tokens(asked).withColumn("row", F.monotonically_increasing_id()), "page_tokens")
    texts = templates(scanned, min_pages, support).where(
        F.exists("tokens", lambda t: t % 2 == 0) & F.exists("tokens", lambda t: t % 2 == 1)
    ).groupBy("host").agg(
        F.flatten(F.collect_list(F.filter("tokens", lambda t: t % 2 == 1))).alias("texts")
    )
    held = (
        scanned.select("host", F.explode(F.arrays_zip("places", "sizes")).alias("c"))
        .groupBy("host", "c.places").agg(F.sum("c.sizes").alias("size"))
        .groupBy("host").agg(F.max_by("places", F.struct("size", -F.col("places"))).alias("container"))
    )
    n = scanned.groupBy("host").agg(F.count(F.lit(1)).alias("n"))
    known = n.join(texts, "host", "left").join(held, "host", "left").where("texts is not null or container is not null")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for value, texts, container in zip(*batch.columns[2:], strict=True):
                out.append(main_text(scan(value.as_py() or "")[1], set(texts.as_py() or ()), container.as_py()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(out, pa.string())], names=["page_id", "url", "text"]
            )

    id_type = dict(asked.dtypes)["page_id"]
    marked = attach_stats(asked, known, ["host"]).select("page_id", "url", "html", "texts", "container")
    found = marked.mapInArrow(read, f"page_id {id_type}, url string, text string")
    return found.withColumn("n_chars", F.length("text").cast("bigint"))


def op13_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))
