"""Main text of web pages by deducing the template that the pages of a host share.

Tokens of a page are its tags, told apart by their path in the document, and its blocks of text.  Tokens with the same
occurrence vector over a host's pages form an equivalence class; a class of several tokens that occurs in most pages is
part of the template.  Between the template's tokens lie the slots, and the text of the slots that are not menus,
notices and the like is the article.
"""

from __future__ import annotations

import html
import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shared import written
from tidemark.llm.words import text_parts

LEAST_PAGES = 4
LEAST_SUPPORT = 0.5
LEAST_TOKENS = 3
MOST_REPEATED = 0.5
LEAST_SLOT = 0.2

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(script|style|noscript|template|svg|iframe|textarea|select|object|canvas|math)\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*>.*?"
    r"(?:</\1\s*>|\Z)"
    r"|<(/?)([A-Za-z][A-Za-z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>"
    r"|<(/?)([A-Za-z][A-Za-z0-9:-]*)([^>]*)(?:>|\Z)"
    r"|<[!?/][^>]*(?:>|\Z)"
    r"|[^<]+|<", re.S | re.I)
ATTRIBUTE = re.compile(r"\b(class|id|role|hidden|aria-hidden|style)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
NAME = re.compile(r"[a-z0-9]+")
# Fixed values of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike "
    "strong sub sup time tt u var wbr img br".split())
CLOSED_BY = {
    "p": frozenset("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
                   "header hr main nav ol p pre section table ul".split()),
    "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]), "tr": frozenset(["tr"]),
    "td": frozenset(["td", "th", "tr"]), "th": frozenset(["td", "th", "tr"]), "option": frozenset(["option"]),
    "head": frozenset(["body"]),
}
HEADINGS = frozenset(["h1", "h2", "h3", "h4", "h5", "h6"])
# Names of regions that are not the article.
OUTSIDE = frozenset("head title nav header footer aside form button menu dialog fieldset legend label input".split())
OUTSIDE_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense banner sponsor sponsored sponsors promo promoted promotion "
    "sidebar aside nav navbar navigation menu menubar breadcrumb breadcrumbs header masthead footer cookie cookies consent gdpr "
    "notice notices popup modal overlay newsletter subscribe subscription signup share sharing social related recommended "
    "recommendations comment comments reply replies respond disqus form login search widget pagination pager toolbar copyright "
    "legal disclaimer alert alerts contentinfo complementary hidden skip tags".split())
INSIDE_NAMES = frozenset("article content post entry story main maincontent articlebody".split())


class Element:
    __slots__ = ("tag", "role", "outside", "inside", "link")

    def __init__(self, tag: str, role: int, outside: bool, inside: bool, link: bool):
        self.tag, self.role, self.outside, self.inside, self.link = tag, role, outside, inside, link


def number(text: str, seed: int = 0) -> int:
    return xxhash.xxh3_64_intdigest(text, seed=seed)


def read_attributes(tag: str, attributes: str) -> tuple[str, bool, bool]:
    """What tells the element's role, whether it opens a region outside of the article, and whether it opens an article."""
    outside, inside, names = tag in OUTSIDE, tag in ("article", "main"), ""
    if attributes and ("=" in attributes or "hidden" in attributes):
        for m in ATTRIBUTE.finditer(attributes):
            key, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
            if key == "hidden" or key == "aria-hidden" and value == "true":
                outside = True
            elif key == "style":
                outside |= "display:none" in value.replace(" ", "")
            else:
                names += f"{key}={value} "
                words = NAME.findall(value)
                outside |= tag not in ("body", "html") and not OUTSIDE_NAMES.isdisjoint(words)
                inside |= not INSIDE_NAMES.isdisjoint(words)
    return names, outside, inside


def parse(page: str):
    """Tags and blocks in page order: (token number, None) for a tag, (token number, (text, outside, inside, link share, heading))
    for a block.  A block is the text between two block tags, references decoded and white space joined."""
    stack: list[Element] = [Element("", 0, False, False, False)]
    pieces: list[str] = []
    linked = 0
    out = []

    def block() -> None:
        nonlocal linked
        if pieces:
            text = " ".join("".join(pieces).split())
            if text:
                top = stack[-1]
                share = linked / max(1, sum(map(len, pieces)))
                heading = any(e.tag in HEADINGS for e in stack[-3:])
                out.append((number(text, top.role), (text, top.outside, top.inside, share, heading)))
            pieces.clear()
        linked = 0

    def close(depth: int) -> None:
        while len(stack) > depth:
            element = stack[-1]
            if element.tag not in INLINE:
                block()
            stack.pop()
            out.append((element.role ^ 0x5851F42D4C957F2D, None))

    for m in TOKEN.finditer(page):
        whole = m.group()
        tag = m[3] or m[6]
        if tag is None:
            if whole[0] != "<" or whole == "<":
                text = html.unescape(whole) if "&" in whole else whole
                pieces.append(text)
                if stack[-1].link:
                    linked += len(text)
            continue
        tag, ending, attributes = tag.lower(), m[2] or m[5], m[4] or m[7] or ""
        if ending:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].tag == tag:
                    close(depth)
                    break
            continue
        if tag == "br" or tag == "wbr":
            pieces.append(" " if tag == "br" else "")
            continue
        if tag not in INLINE:
            for depth in range(len(stack) - 1, 0, -1):
                if tag in CLOSED_BY.get(stack[depth].tag, ()):
                    close(depth)
                    break
                if stack[depth].tag not in INLINE and stack[depth].tag not in CLOSED_BY:
                    break
            block()
        parent = stack[-1]
        names, outside, inside = read_attributes(tag, attributes)
        role = number(f"{tag} {names}", parent.role)
        out.append((role, None))
        if tag not in VOID and not attributes.endswith("/"):
            stack.append(Element(tag, role, outside or parent.outside, inside or parent.inside, tag == "a" or parent.link))
    close(1)
    block()
    return out


HOST = r"^\s*(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)"


TOKEN_SCHEMA = "host string, token long, pages long, times long, vector long"


def _tokens(batches):
    """Per host and token: pages with it, occurrences, and the occurrence vector as the xor of a number of (page, count)."""
    for batch in batches:
        for rows, texts in text_parts(pa.array(np.arange(batch.num_rows)), batch.column("html"), 1 << 23):
            ids, names_of = batch.column("page").to_pylist(), batch.column("host").to_pylist()
            hosts, host_of_row, tokens, times, marks = {}, [], [], [], []
            for row, raw in zip(rows, texts, strict=True):
                counts: dict[int, int] = {}
                for token, _ in parse(raw.decode("utf-8", "replace")):
                    counts[token] = counts.get(token, 0) + 1
                page = number(str(ids[row]))
                host = hosts.setdefault(names_of[row], len(hosts))
                host_of_row += [host] * len(counts)
                tokens += counts
                times += counts.values()
                marks += [page] * len(counts)
            if not tokens:
                continue
            token, n = np.array(tokens, np.uint64), np.array(times, np.uint64)
            mark = np.array(marks, np.uint64) ^ (n * np.uint64(0x9E3779B97F4A7C15))
            mark = (mark ^ (mark >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
            mark ^= mark >> np.uint64(32)
            host = np.array(host_of_row)
            order = np.lexsort((token, host))
            token, n, mark, host = token[order], n[order], mark[order], host[order]
            first = np.flatnonzero(np.concatenate([[True], (token[1:] != token[:-1]) | (host[1:] != host[:-1])]))
            names = np.array(list(hosts), dtype=object)
            yield pa.RecordBatch.from_arrays([
                pa.array(names[host[first]], pa.string()), pa.array(token[first].view(np.int64)),
                pa.array(np.diff(np.append(first, len(token)))), pa.array(np.add.reduceat(n, first).astype(np.int64)),
                pa.array(np.bitwise_xor.reduceat(mark, first).view(np.int64)),
            ], ["host", "token", "pages", "times", "vector"])


def _added(counts: DataFrame) -> DataFrame:
    """One row for each host and token."""
    return counts.groupBy("host", "token").agg(
        F.sum("pages").alias("pages"), F.sum("times").alias("times"), F.bit_xor("vector").alias("vector"))


def templates(counts: DataFrame) -> DataFrame:
    """(host, template): the numbers of the tokens of a host's template, from counts per (host, token), with the host's pages as n.

    A class is the tokens of a host with equal occurrence vectors.  It is valid if it has ``LEAST_TOKENS`` tokens and occurs in
    at least half of the host's pages, ``LEAST_PAGES`` or more; the paths in the tokens nest valid classes in each other.
    """
    frequent = counts.where((F.col("pages") >= LEAST_PAGES) & (F.col("pages") >= F.col("n") * LEAST_SUPPORT))
    classes = frequent.groupBy("host", "pages", "times", "vector").agg(F.collect_list("token").alias("tokens"))
    valid = classes.where((F.size("tokens") >= LEAST_TOKENS) & (F.col("times") == F.col("pages")))
    return valid.groupBy("host").agg(F.flatten(F.collect_list("tokens")).alias("template"))


def article(page: str, template: frozenset[int]) -> str:
    """The text of the article's slots, one line for each block."""
    slots: dict[int, list] = {}
    slot, blocks = 0, []
    for token, text in parse(page):
        if text is None:
            if token in template:
                slot = token
        elif not text[1]:
            blocks.append((slot, text, token in template))
            slots.setdefault(slot, []).append(text)
    if any(b[1][2] for b in blocks):
        chosen = [b for b in blocks if b[1][2]]
    else:
        # No element says that it is the article: the slots with most of the text that is not in links, and headings.
        amount = {s: sum(len(t[0]) * (1 - t[3]) for t in texts) for s, texts in slots.items()}
        most = max(amount.values(), default=0)
        chosen = [b for b in blocks if b[1][3] < 0.5 and (amount[b[0]] >= LEAST_SLOT * most or b[1][4])]
    # Text of the template is a notice between the article's blocks, unless the pages are copies of each other.
    total = sum(len(b[1][0]) for b in chosen)
    repeated = sum(len(b[1][0]) for b in chosen if b[2])
    if repeated < MOST_REPEATED * total:
        chosen = [b for b in chosen if not b[2]]
    return "\n".join(b[1][0] for b in chosen)


def _articles(default: list[int]):
    def articles(batches):
        shared = frozenset(t & 0xFFFFFFFFFFFFFFFF for t in default)
        last, own = None, shared
        for batch in batches:
            ids, urls = batch.column("page").to_pylist(), batch.column("url").to_pylist()
            hosts = batch.column("host").to_pylist()
            for rows, pages in text_parts(pa.array(np.arange(batch.num_rows)), batch.column("html"), 1 << 23):
                texts = []
                for row, raw in zip(rows, pages, strict=True):
                    host = hosts[row]
                    if host != last:
                        given = batch.column("template")[row].as_py()
                        last, own = host, shared if given is None else frozenset(t & 0xFFFFFFFFFFFFFFFF for t in given)
                    texts.append(article(raw.decode("utf-8", "replace"), own))
                yield pa.RecordBatch.from_arrays([
                    pa.array([ids[r] for r in rows], pa.int64()), pa.array([urls[r] for r in rows], pa.string()),
                    pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64()),
                ], ["page_id", "url", "text", "n_chars"])
    return articles


def page_texts(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Per page: page_id, url, text (blocks of the article, one per line) and n_chars.

    Tokens are counted per host before the shuffle; a host's template has at most about twice the tokens of one of its pages, as
    each is in half of them.  Pages get the template of their host by a join, which splits a host with many pages.
    Hosts with too few pages for a template of their own use the one of all pages together.

    In a page, each template token opens a slot.  Blocks inside menus, headers, footers, asides, forms and regions named as
    notices, adverts, comments and the like are never the article.  If elements say that they are the article or main
    content, their blocks are taken, else headings and the slots with most text outside of links.  Blocks whose text is in the
    template are left out, unless they are half of what was taken: then the pages are copies.

    Null html counts as empty and gives an empty text.  Null urls share the empty host.  Rows of a repeated or null id
    each give a row.
    """
    host = F.lower(F.regexp_extract(F.coalesce(F.col(url_col), F.lit("")), HOST, 1))
    rows = pages.select(F.col(id_col).cast("long").alias("page"), F.col(url_col).alias("url"), F.col(html_col).alias("html"),
                        host.alias("host"))
    counts = written(_added(rows.mapInArrow(_tokens, TOKEN_SCHEMA)), "tokens")
    found = templates(counts.join(rows.groupBy("host").agg(F.count("*").alias("n")), "host"))
    everywhere = _added(counts.withColumn("host", F.lit(""))).withColumn("n", F.lit(rows.count()))
    first = templates(everywhere).first()
    own = found.select(F.col("host").alias("of"), "template")
    joined = rows.join(own, F.col("host") == F.col("of"), "left")
    schema = "page_id long, url string, text string, n_chars long"
    return joined.select("page", "url", "html", "host", "template").mapInArrow(_articles(first[1] if first else []), schema)


def op2_page_text(spark, sf_dir: str) -> DataFrame:
    return page_texts(spark.read.parquet(f"{sf_dir}/pages.parquet"))
