"""One pass over an HTML page: its tokens in page order and its text runs.

A token is a start tag or a text run together with the elements around it. A
run is the text between two block boundaries; inline markup does not cut it.
"""

from __future__ import annotations

import html
import re
from dataclasses import dataclass
from functools import lru_cache

import xxhash

# Names of HTML elements and of the roles they commonly mark.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp template svg math".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small"
    " span strike strong sub sup time tt u var wbr".split()
)
# Start tags that end an open p, and elements that end an open one of the same kind.
ENDS_P = frozenset(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header"
    " hr main menu nav ol p pre section table ul".split()
)
SIBLINGS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr",), "td": ("td", "th"), "th": ("td", "th"),
            "option": ("option",)}
LISTS = frozenset("ul ol dl table menu select".split())
SKIPPED = frozenset("head nav footer aside form button select dialog menu".split())
CONTAINERS = frozenset("body div section td center table blockquote".split())
BOILERPLATE = frozenset(
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner cookie cookies"
    " consent gdpr notice notices popup modal overlay newsletter subscribe subscription nav navbar navigation menu"
    " breadcrumb breadcrumbs footer sidebar widget widgets comment comments disqus replies respond share sharing"
    " social related recommended pagination pager toolbar login signup search copyright contentinfo complementary"
    " alert masthead".split()
)
HEADERS = frozenset(["header"])
TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^>\"'])*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)", re.S,
)
NAMES = re.compile(r"(?<![\w-])(class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)", re.I)
HIDDEN = re.compile(r"(?<![\w-])hidden(?![\w-])|aria-hidden\s*=\s*[\"']?true|display\s*:\s*none", re.I)
WORD = re.compile(r"[a-z]+")
MASK = (1 << 63) - 1


def stamp(*parts: object) -> int:
    """63-bit hash that is the same in every process."""
    return xxhash.xxh64_intdigest(repr(parts).encode("utf-8", "surrogatepass")) & MASK


def text_stamp(path: int, text: str) -> int:
    """Token of a text run in the element ``path``; odd."""
    return xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass"), path) & MASK | 1


@lru_cache(maxsize=1 << 16)
def path_stamp(parent: int, kind: int) -> int:
    """Token of a start tag in the element ``parent``; even."""
    return stamp(parent, kind) & ~1


@lru_cache(maxsize=64)
def end_of(tag: str) -> re.Pattern[str]:
    return re.compile(f"</{re.escape(tag)}(?![a-zA-Z0-9])[^>]*(?:>|\\Z)", re.I)


@lru_cache(maxsize=1 << 16)
def element(tag: str, attributes: str) -> tuple[int, bool, bool]:
    """Hash of the kind of element (tag and names without digits), whether it
    marks boilerplate, and whether it marks a header."""
    names = sorted({w for _, value in NAMES.findall(attributes) for w in WORD.findall(value.lower())})
    skip = tag in SKIPPED or not BOILERPLATE.isdisjoint(names) or bool(HIDDEN.search(attributes))
    if tag in ("body", "html"):
        skip = False
    return stamp(tag, names), skip, tag == "header" or (tag not in ("article", "main") and not HEADERS.isdisjoint(names))


@dataclass(slots=True)
class Run:
    text: str
    token: int
    skipped: bool
    region: int  # 2: article, 1: main, 0: neither
    links: int  # characters that belong to links
    containers: tuple[int, ...]


class Open:
    """An open element."""

    __slots__ = ("tag", "path", "skipped", "region", "link", "left_out")

    def __init__(self, tag: str, path: int, skipped: bool, region: int, link: bool, left_out: bool) -> None:
        self.tag, self.path, self.skipped, self.region = tag, path, skipped, region
        self.link, self.left_out = link, left_out  # of inline elements


def scan(page: str) -> tuple[list[int], list[Run]]:
    """Tokens (even: start tag, odd: text run) and text runs of a page.

    Unclosed elements end with their parents or where HTML ends them; a cut
    page ends all. Text of scripts, styles and the like is no run.
    """
    root = Open("", 0, False, 0, False, False)
    stack, tokens, runs = [root], [], []
    pending: list[str] = []
    links = 0
    end = len(page)
    at = 0

    def flush() -> None:
        nonlocal links
        if not pending:
            return
        text = " ".join("".join(pending).split())
        pending.clear()
        if text:
            block = next(e for e in reversed(stack) if e.tag not in INLINE)
            token = text_stamp(block.path, text)
            tokens.append(token)
            around = () if block.region else tuple(e.path for e in stack if e.tag in CONTAINERS)
            runs.append(Run(text, token, block.skipped, block.region, min(links, len(text)), around))
        links = 0

    def close(names: tuple[str, ...], stops: frozenset[str]) -> None:
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag in names:
                del stack[i:]
                return
            if stack[i].tag in stops:
                return

    def add(raw: str) -> None:
        nonlocal links
        top = stack[-1]
        if top.left_out:
            return
        text = html.unescape(raw) if "&" in raw else raw
        pending.append(text)
        if top.link:
            links += len(text.strip())

    while at < end:
        begin = page.find("<", at)
        if begin < 0:
            add(page[at:])
            break
        if begin > at:
            add(page[at:begin])
        found = TAG.match(page, begin)
        if found is None:
            add("<")
            at = begin + 1
            continue
        at = found.end()
        tag = found[2] or found[5]
        if tag is None:
            continue  # comment, doctype or processing instruction
        tag = tag.lower()
        if found[1] or found[4]:
            if tag in INLINE:
                close((tag,), ENDS_P | LISTS | {"li", "td", "th"})
            elif tag == "br":
                flush()
            else:
                flush()
                close((tag,), frozenset())
            continue
        attributes = found[3] or found[6] or ""
        if tag in RAW:
            close_at = end_of(tag).search(page, at)
            at = close_at.end() if close_at else end
            continue
        if tag in VOID:
            if tag not in INLINE:
                flush()
            continue
        kind, skip, header = element(tag, attributes)
        if tag not in INLINE:
            flush()
            if tag in ENDS_P:
                close(("p",), CONTAINERS | {"li", "article", "main"})
            if tag in SIBLINGS:
                close(SIBLINGS[tag], LISTS)
        parent = stack[-1]
        region = 2 if tag == "article" else max(parent.region, 1) if tag == "main" else parent.region
        skipped = parent.skipped or skip or (header and not region)
        path = parent.path
        if tag not in INLINE:
            path = path_stamp(parent.path, kind)
            tokens.append(path)
        inline = tag in INLINE
        link, left_out = inline and (tag == "a" or parent.link), inline and (skip or parent.left_out)
        stack.append(Open(tag, path, skipped, region, link, left_out))
    flush()
    return tokens, runs
