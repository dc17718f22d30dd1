"""Fields of web pages: selectors, links, visible text, blocks, charsets.

Pages are parsed by the standard library in Arrow batches, once for all the
fields that a query wants; cheap native predicates run first.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from functools import lru_cache
from html.parser import HTMLParser
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from tesserae.functions.text import nz

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = frozenset(("script", "style", "noscript", "template", "head"))

# What pages say that deny access, and how short such pages are.
BLOCK_SIGNATURES = [
    "you have been blocked", "attention required", "cf-error-details", "performance &amp; security by cloudflare", "performance & security by cloudflare",
    "cloudflare ray id", "just a moment", "checking your browser before accessing", "verify you are human", "verifying you are human",
    "please enable javascript and cookies to continue", "please turn javascript on and reload the page", "please stand by, while we are checking your browser",
    "access denied", "request unsuccessful. incapsula incident", "the requested url was rejected", "this website is using a security service to protect itself",
]
BLOCK_CHARS = 3000
META_CHARSET, HEADER_CHARSET = r"""(?i)<meta[^>]+charset\s*=\s*["']?\s*([A-Za-z0-9_.:-]+)""", r"(?i)charset\s*=\s*[\"']?([A-Za-z0-9_.:-]+)"


class Node:
    """An element: tag, attributes, parent, children (nodes and strings)."""

    __slots__ = ("attrs", "children", "parent", "tag")

    def __init__(self, tag: str, attrs: dict[str, str], parent: Node | None):
        self.tag, self.attrs, self.parent, self.children = tag, attrs, parent, []

    def all(self) -> Iterator[Node]:
        stack = [self]
        while stack:
            node = stack.pop()
            yield node
            stack += [c for c in reversed(node.children) if isinstance(c, Node)]

    def strings(self, hidden: bool = False) -> Iterator[str]:
        stack: list = [self]
        while stack:
            node = stack.pop()
            if isinstance(node, str):
                yield node
            elif hidden or node.tag not in HIDDEN:
                stack += reversed(node.children)

    def text(self) -> str:
        return " ".join(x for x in (s.strip() for s in self.strings()) if x)


class Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("", {}, None)

    def handle_starttag(self, tag, attrs):
        node = Node(tag, {k: v or "" for k, v in attrs}, self.at)
        self.at.children.append(node)
        if tag not in VOID:
            self.at = node

    def handle_startendtag(self, tag, attrs):
        self.at.children.append(Node(tag, {k: v or "" for k, v in attrs}, self.at))

    def handle_endtag(self, tag):
        node = self.at
        while node.parent is not None and node.tag != tag:
            node = node.parent
        if node.parent is not None:
            self.at = node.parent

    def handle_data(self, data):
        self.at.children.append(data)


def parse(html: str | None) -> Node:
    builder = Builder()
    try:
        builder.feed(html or "")
        builder.close()
    except (AssertionError, ValueError):  # what was read before stands
        pass
    return builder.root


SIMPLE = re.compile(r"""(\*|[A-Za-z][\w-]*)|\#([\w-]+)|\.([\w-]+)|\[\s*([\w:-]+)\s*(?:([~|^$*]?=)\s*(?:"([^"]*)"|'([^']*)'|([^\]\s]+)))?\s*\]|:(not|has)\(((?:[^()]|\([^()]*\))*)\)|:(first-child|last-child)""")


@lru_cache(4096)
def compiled(selector: str) -> tuple | None:
    """Alternatives of (combinator, tests) chains; None if the selector can't be read."""
    out = []
    for part in re.split(r",(?![^(\[]*[)\]])", selector):
        chain, pos, part, joint = [], 0, part.strip(), " "
        while pos < len(part):
            tests = []
            while m := SIMPLE.match(part, pos):
                tests.append(m.groups())
                pos = m.end()
            if not tests:
                return None
            chain.append((joint, tests))
            if m := re.compile(r"\s*([>+~])\s*|\s+").match(part, pos):
                joint, pos = m[1] or " ", m.end()
            elif pos < len(part):
                return None
        if not chain:
            return None
        out.append(chain)
    return tuple(out)


def passes(node: Node, tests: list) -> bool:
    for tag, ident, cls, attr, op, q1, q2, q3, pseudo, inner, place in tests:
        if tag and tag != "*" and node.tag != tag.lower() or ident and node.attrs.get("id") != ident or cls and cls not in node.attrs.get("class", "").split():
            return False
        if attr:
            have, want = node.attrs.get(attr.lower()), next((q for q in (q1, q2, q3) if q is not None), "")
            if have is None or op == "=" and have != want or op == "^=" and not (want and have.startswith(want)) or op == "$=" and not (want and have.endswith(want)):
                return False
            if op == "*=" and not (want and want in have) or op == "~=" and want not in have.split() or op == "|=" and have != want and not have.startswith(f"{want}-"):
                return False
        if pseudo == "not" and (chains := compiled(inner)) and any(matches(node, c) for c in chains):
            return False
        if pseudo == "has" and not ((chains := compiled(inner)) and any(matches(x, c) for x in node.all() if x is not node for c in chains)):
            return False
        if place and node.parent is not None:
            peers = [c for c in node.parent.children if isinstance(c, Node)]
            if peers[0 if place == "first-child" else -1] is not node:
                return False
    return bool(node.tag)


def matches(node: Node, chain: list) -> bool:
    joint, tests = chain[-1]
    if not passes(node, tests):
        return False
    if len(chain) == 1:
        return True
    rest, parent = chain[:-1], node.parent
    if joint in "+~":
        before = [c for c in parent.children if isinstance(c, Node)] if parent is not None else []
        before = before[: next((k for k, c in enumerate(before) if c is node), 0)]
        return any(matches(x, rest) for x in (before[-1:] if joint == "+" else before))
    while parent is not None:
        if matches(parent, rest):
            return True
        if joint == ">":
            return False
        parent = parent.parent
    return False


def select(root: Node, selector: str) -> list[Node]:
    chains = compiled(selector)
    return [n for n in root.all() if any(matches(n, c) for c in chains)] if chains else []


def first_match(root: Node, selectors: Sequence[str], attr: str | None = None, regex: str | None = None, required: bool = False) -> str:
    """The first selector that yields text (or an attribute) wins; a regex takes its group, or all of it unless required."""
    for selector in selectors:
        for node in select(root, selector):
            value = (node.attrs.get(attr, "") if attr else node.text()).strip()
            if value and regex:
                m = re.search(regex, value)
                value = (m[1] if m.re.groups else m[0]) if m else "" if required else value
            if value:
                return value
    return ""


def links(root: Node, url: str, selector: str = "a") -> list[str]:
    """Absolute addresses of anchors in order, each once, by the page's base if it has one."""
    base = next((n.attrs["href"] for n in root.all() if n.tag == "base" and n.attrs.get("href")), None)
    start = urljoin(url, base) if base else url
    found = (n.attrs["href"].strip(" \t\r\n\"'\\") for n in select(root, selector) if n.attrs.get("href"))
    out = []
    for href in found:
        try:
            out.append(urljoin(start, href))
        except ValueError:
            continue
    return list(dict.fromkeys(out))


def owner(node: Node, items: set[int]) -> Node | None:
    """The nearest ancestor that is one of the item blocks, told by identity."""
    while (node := node.parent) is not None:
        if id(node) in items:
            return node
    return None


def listing(root: Node, url: str, item: str, title: Sequence[str], date: Sequence[str], anchors: str = "a") -> list[tuple[str, str, str]]:
    """(address, title, date as written) of each link, from the item block that holds it; ``''`` where there is none.

    A link that several blocks hold keeps the first one's.
    """
    items = {id(n) for n in select(root, item)} if item else set()
    out: dict[str, tuple[str, str, str]] = {}
    for a in select(root, anchors):
        if not (href := a.attrs.get("href")):
            continue
        try:
            [address] = links(parse_anchor(root, href), url)
        except ValueError:
            continue
        block = owner(a, items)
        if address not in out:
            out[address] = (address, " ".join(first_match(block, title).split()) if block else "", first_match(block, date).strip() if block else "")
    return list(out.values())


def parse_anchor(root: Node, href: str) -> Node:
    """A page with the base of ``root`` and one anchor."""
    page = Node("", {}, None)
    page.children += [n for n in root.all() if n.tag == "base"][:1] + [Node("a", {"href": href}, page)]
    return page


def article(root: Node) -> str:
    """The block that holds most paragraph text: an approximation for pages without selectors."""
    weight: dict[int, tuple[int, Node]] = {}
    for p in root.all():
        if p.tag == "p" and p.parent is not None:
            n, _ = weight.get(id(p.parent), (0, None))
            weight[id(p.parent)] = (n + len(p.text()), p.parent)
    if not weight:
        return root.text()
    best = max(weight.values(), key=lambda x: x[0])[1]
    return "\n".join(t for t in (c.text() for c in best.children if isinstance(c, Node) and c.tag in ("p", "h2", "h3", "blockquote", "ul", "ol")) if t)


def fields(pages: DataFrame, html: str = "html", url: str = "url", **chains: Sequence[str]) -> DataFrame:
    """``pages`` with a string column for each chain of selectors, all from one parse; null where there is no page."""
    names = list(chains)

    @F.pandas_udf(", ".join(f"{n} string" for n in names))
    def run(html: pd.Series) -> pd.DataFrame:
        roots = [None if x is None else parse(x) for x in html]
        return pd.DataFrame({n: [None if r is None else first_match(r, chains[n]) for r in roots] for n in names}, dtype=object)

    return pages.withColumn("_f", run(F.col(html))).select(*pages.columns, *[F.col(f"_f.{n}").alias(n) for n in names])


@F.pandas_udf(ArrayType(StringType()))
def page_links(html: pd.Series, url: pd.Series) -> pd.Series:
    return pd.Series([links(parse(h), u or "") for h, u in zip(html, url, strict=True)])


@F.pandas_udf(StringType())
def visible_text(html: pd.Series) -> pd.Series:
    return pd.Series([parse(h).text() for h in html], dtype=object)


@F.pandas_udf(StringType())
def article_text(html: pd.Series) -> pd.Series:
    return pd.Series([article(parse(h)) for h in html], dtype=object)


def listing_meta(pages: DataFrame, item: str, title: Sequence[str], date: Sequence[str], anchors: str = "a", html: str = "html", url: str = "url") -> DataFrame:
    """``pages`` without ``html``, a row for each link: ord, link, title and date_raw of its item block."""

    @F.pandas_udf("array<struct<link:string,title:string,date_raw:string>>")
    def run(html: pd.Series, url: pd.Series) -> pd.Series:
        names = ("link", "title", "date_raw")
        return pd.Series([[dict(zip(names, x, strict=True)) for x in listing(parse(h), u or "", item, title, date, anchors)] for h, u in zip(html, url, strict=True)])

    other = [c for c in pages.columns if c != html]
    return pages.select(*other, F.posexplode(run(html, url)).alias("ord", "_x")).select(*other, "ord", "_x.*")


def decoded(data: Column, override: Column | None = None, header: Column | None = None) -> Column:
    """The text of a page's bytes by ``charset``; an unknown charset gives way to the next, and bad bytes are replaced."""
    head = F.decode(F.substring(data, 1, 4096), "ISO-8859-1")
    none = F.lit("")

    @F.pandas_udf("string")
    def run(data: pd.Series, *names: pd.Series) -> pd.Series:
        out = []
        for raw, *given in zip(data, *names, strict=True):
            text = None
            for name in (*given, "utf-8"):
                try:
                    text = None if raw is None else bytes(raw).decode(name, "replace") if name else text
                except LookupError:
                    continue
                if raw is None or name:
                    break
            out.append(text)
        return pd.Series(out, dtype=object)

    meta = F.regexp_extract(head, META_CHARSET, 1)
    return run(data, nz(override) if override is not None else none, F.regexp_extract(nz(header), HEADER_CHARSET, 1) if header is not None else none, meta)


def signed(html: Column, extra: Sequence[str] = ()) -> Column:
    """Whether a page holds a phrase of those that deny access."""
    low, out = F.lower(nz(html)), F.lit(False)
    for phrase in [*BLOCK_SIGNATURES, *(x.lower() for x in extra)]:
        out |= F.contains(low, F.lit(phrase))
    return out


def blocked(pages: DataFrame, html: str = "html", extra: Sequence[str] = ()) -> DataFrame:
    """The pages that deny access: signed and short.  Only signed ones are parsed."""
    found = pages.where(signed(F.col(html), extra)).withColumn("_text", visible_text(html))
    return found.where(F.length("_text") <= BLOCK_CHARS).drop("_text")


def charset(html: Column, override: Column | None = None, header: Column | None = None) -> Column:
    """The stated override, else that of the header, else of the page's first 4096 characters, else utf-8."""
    meta = F.regexp_extract(F.substring(nz(html), 1, 4096), META_CHARSET, 1)
    head = F.regexp_extract(nz(header), HEADER_CHARSET, 1) if header is not None else F.lit("")
    given = nz(override) if override is not None else F.lit("")
    return F.lower(F.when(given != "", given).when(head != "", head).when(meta != "", meta).otherwise("utf-8"))


def file_kind(data: Column) -> Column:
    """By its first bytes: pdf, zip (as newer word files are), ole (as older ones), else other."""
    return F.when(F.hex(F.substring(data, 1, 1024)).contains("255044462D"), "pdf").when(F.hex(F.substring(data, 1, 4)) == "504B0304", "zip").when(F.hex(F.substring(data, 1, 8)) == "D0CF11E0A1B11AE1", "ole").otherwise("other")


def wants_document(url: Column, content_type: Column, ending: str = "pdf") -> Column:
    return F.lower(nz(content_type)).contains(ending) | nz(url).rlike(rf"(?i)\.{ending}($|[/?#])")


def keep_if(hay: Column, pattern: str, negate: bool = False) -> Column:
    return nz(hay).rlike(pattern.replace("(?P<", "(?<")) != F.lit(negate)


@F.udtf(returnType=StructType([StructField("ord", IntegerType()), StructField("url", StringType())]))
class ExtractLinks:
    """``extract_links(html, base)`` for SQL."""

    def eval(self, html: str, base: str):
        yield from enumerate(links(parse(html), base or ""))
