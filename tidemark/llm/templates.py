"""Main text of web pages by deducing the template of their host.

Tokens of a page are its tags, told apart by the tags around them, and its runs of text between tags. Tokens of a host
that occur equally often in the same pages - equal occurrence vectors - form an equivalence class. A class is valid
for the template if it is large and frequent enough, holds tags, keeps its order in a page, and lies whole within one
gap of the class that every page has. What is left between template tokens are slots.

The main text is what the slots of the article hold, or of the page's body if nothing marks an article. Template
elements that say what they are (menus, headers, footers, sidebars, notices, adverts, forms, reader comments, by tag,
class, id or role) end the article. Text of the template itself goes too, unless it makes up most of it: then the
pages are copies of each other, and what they share is their article. A host with few pages has no template; there
the tags alone decide.

An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import html as entities
import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.frames import map_texts
from tidemark.llm.urls import host_of
from tidemark.operators.joins import spread_join
from tidemark.operators.sizing import measured_small
from tidemark.session import stage

#: A token of the template stands in so many pages of its host, and in so large a share of them.
PAGES = 5
SHARE = 0.5
CLASS_SIZE = 2
#: Pages whose article (or whole body, if no article is marked) is template text to more than this share are copies.
COPIED = 0.5
COPIED_UNMARKED = 0.9

# Names of HTML and of the usual parts of a page: fixed values.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike"
    " strong sub sup time tt u var wbr img".split()
)
CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
    "th": {"td", "th"}, "option": {"option"}, "thead": {"tr", "td", "th"}, "tbody": {"thead", "tr", "td", "th"},
}
ENDS_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5"
    " h6 header hgroup hr main menu nav ol p pre search section summary table ul".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
ASIDE_TAGS = frozenset(
    "head nav header footer aside form button select option datalist dialog menu template svg canvas audio video object"
    " script style textarea title noscript iframe xmp noembed noframes".split()
)
ASIDE_ROLES = frozenset(
    "navigation banner contentinfo complementary search form menu menubar dialog alertdialog alert toolbar".split()
)
ASIDE_WORDS = frozenset(
    "ad ads adbox adsense advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments"
    " commentlist consent cookie cookies copyright disclaimer disqus footer gdpr header login masthead menu modal nav navbar"
    " navigation newsletter notice notices notification overlay pager pagination popup promo promoted promotion related"
    " replies reply respond share sharing sidebar signup social sponsor sponsored subscribe subscription toolbar"
    " topbar widget widgets".split()
)
#: Words that make a class tell what its element has or lacks, or its state, before and after the part's name.
HAS_WORDS = frozenset("has no not with without hide show".split())
STATE_WORDS = frozenset("layout page site closed open off on enabled disabled none".split())

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>?|</([a-zA-Z][^\s/>]*)[^>]*>?|<([a-zA-Z][^\s/>]*)((?:[^>=]+|=\s*(?:\"[^\"]*\"|'[^']*')?)*)(?:>|\Z)",
    re.S,
)
ATTRIBUTE = re.compile(r"([^\s=\"'/>]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>][^\s>]*))")
VALUE = re.compile(r"=\s*(?:\"[^\"]*\"|'[^']*'|[^\s>]+)")
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|\d+")


@dataclass
class Element:
    tag: str
    path: int
    aside: bool
    article: bool
    main: bool
    own_header: bool
    heading: bool
    named: int = 0
    article_named: int = 0


@dataclass
class Run:
    """A run of text between two tags and where it stands."""

    text: str
    block: int
    token: int
    aside: bool
    article: bool
    main: bool
    named: int = 0
    template: bool = False


@dataclass
class Page:
    tokens: list[tuple[int, bool]] = field(default_factory=list)
    runs: list[tuple[int, Run]] = field(default_factory=list)


def _hash(*parts) -> int:
    """A stable 64-bit hash of numbers and strings."""
    raw = hashlib.blake2b("\0".join(map(str, parts)).encode(), digest_size=8).digest()
    return int.from_bytes(raw, "little", signed=True)


def _known(cache: dict, *parts) -> int:
    if parts not in cache:
        cache[parts] = _hash(*parts)
    return cache[parts]


def _is_aside(tag: str, attributes: dict[str, str]) -> bool:
    if tag in ASIDE_TAGS or attributes.get("role", "").lower() in ASIDE_ROLES or "hidden" in attributes:
        return True
    return tag == "article" and _named(attributes) and "comment" in attributes.get("class", "").lower()


def _named(attributes: dict[str, str]) -> set[str]:
    """The words of ASIDE_WORDS by which a class or the id calls its element, not what it has or lacks."""
    out = set()
    for name in f"{attributes.get('class', '')} {attributes.get('id', '')}".split():
        words = [w.lower() for w in WORD.findall(name)]
        for i, w in enumerate(words):
            if w in HAS_WORDS or words[-1] in STATE_WORDS:
                break
            if w in ASIDE_WORDS:
                out.add(w)
    return out


def parse(page: str, cache: dict) -> Page:
    """Tags and text runs of a page in order. Any input parses: unclosed, misplaced and cut tags included.

    An element that its class or id names as a part of a page is set aside, but not if it holds the page's main or
    article: of several the ones in the fewest elements so named, and articles (of the main, if there is one) only if
    they have more text than what is left without them.

    Elements so named are numbered, and ``named`` is the innermost one's number, 0 for none, so that deep nesting costs no
    more than its tags.
    """
    out = Page()
    names = _Named()
    mains: list[int] = []
    articles: list[tuple[bool, int]] = []
    open_: list[Element] = [Element("", 0, False, False, False, False, False)]
    open_at: dict[str, list[int]] = {}
    block = at = 0

    def text(piece: str) -> None:
        top = open_[-1]
        value = " ".join(entities.unescape(piece).split())
        if not value and not piece:
            return
        token = _hash(top.path, value) if value else 0
        if value:
            out.tokens.append((token, True))
        # Headings in an article's own header belong to the article.
        aside = top.aside and not top.heading
        named = top.article_named if top.heading else top.named
        out.runs.append((len(out.tokens) - 1, Run(entities.unescape(piece), block, token, aside, top.article, top.main, named)))

    def close(to: int) -> None:
        nonlocal block
        for e in open_[to:]:
            open_at[e.tag].pop()
            if e.tag not in INLINE:
                block += 1
        del open_[to:]

    while at < len(page):
        lt = page.find("<", at)
        match = TOKEN.match(page, lt) if lt >= 0 else None
        if lt >= 0 and not match:
            following = page.find("<", lt + 1)
            following = len(page) if following < 0 else following
            text(page[at:following])
            at = following
            continue
        if lt < 0:
            text(page[at:])
            break
        if lt > at:
            text(page[at:lt])
        at = match.end()
        end, tag = (match.group(1) or "").lower(), (match.group(2) or "").lower()
        if end:
            if open_at.get(end):
                close(open_at[end][-1])
            elif end not in INLINE:
                block += 1
            out.tokens.append((_known(cache, open_[-1].path, "/", end), False))
        elif tag:
            attributes = {m[0].lower(): entities.unescape(m[1] or m[2] or m[3]) for m in ATTRIBUTE.findall(match.group(3))}
            if re.search(r"(?:^|\s)hidden(?:\s|$)", VALUE.sub("", match.group(3))):
                attributes.setdefault("hidden", "")
            if tag in ENDS_P:
                _close_within(open_at, close, {"p"}, {"button", "td", "th", "caption", "table"})
            if tag in CLOSES:
                _close_within(open_at, close, CLOSES[tag], {"ul", "ol", "dl", "table", "select"})
            if tag not in INLINE:
                block += 1
            top = open_[-1]
            path = _known(cache, top.path, tag, attributes.get("class"), attributes.get("id"))
            out.tokens.append((path, False))
            aside = top.aside or _is_aside(tag, attributes)
            article = top.article or (tag == "article" and not aside)
            is_main = tag == "main" or attributes.get("role", "").lower() == "main"
            main = top.main or is_main
            words = set() if is_main or tag in ("html", "body", "article") else _named(attributes)
            named = names.within(top.named) if words else top.named
            if is_main and not aside:
                mains.append(top.named)
            elif tag == "article" and not (aside or top.article):
                articles.append((top.main, top.named))
            # An article's own header is set aside but for its headings.
            is_header = tag == "header" or (words == {"header"} and tag not in ASIDE_TAGS)
            at_top = not top.aside and (not top.named or top.named == top.article_named)
            own_header = top.own_header or (is_header and top.article and at_top)
            around = top.article_named if top.article else top.named
            heading = top.heading or (own_header and tag in HEADINGS)
            if tag in RAW and not match.group(0).endswith("/>"):
                stop = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>?", re.I).search(page, at)
                at = stop.end() if stop else len(page)
                block += tag not in INLINE
            elif tag not in VOID and not match.group(3).rstrip().endswith("/"):
                open_at.setdefault(tag, []).append(len(open_))
                open_.append(Element(tag, path, aside, article, main, own_header, heading, named, around))
    held = names.fewest(mains, {0})
    free = names.all_in(held)
    extra = names.fewest([n for in_main, n in articles if in_main or not mains], held)
    if len(extra) > len(held):
        runs = [r for _, r in out.runs if not r.aside and (r.main or not mains)]
        size = lambda rs: sum(len(r.text.strip()) for r in rs)
        rest = size(r for r in runs if free[r.named])
        more = names.all_in(extra)
        if size(r for r in runs if r.article and more[r.named] and not free[r.named]) > rest:
            free = more
    for _, run in out.runs:
        run.aside = run.aside or not free[run.named]
    return out


class _Named:
    """The elements named as a part of a page, by number, each with the one around it; 0 is the page."""

    def __init__(self):
        self.around = [0]

    def within(self, outer: int) -> int:
        self.around.append(outer)
        return len(self.around) - 1

    def all_in(self, held: set[int]) -> list[bool]:
        """For each number whether it and all around it are in ``held``."""
        out = [True]
        for n in range(1, len(self.around)):
            out.append(n in held and out[self.around[n]])
        return out

    def fewest(self, found: list[int], held: set[int]) -> set[int]:
        """``held`` and what is around those of ``found`` that are in the fewest others."""
        depth = [0]
        for n in range(1, len(self.around)):
            depth.append(0 if n in held else depth[self.around[n]] + 1)
        least = min((depth[n] for n in found), default=0)
        out = set(held)
        for n in (n for n in found if depth[n] == least):
            while n not in out:
                out.add(n)
                n = self.around[n]
        return out


def _close_within(open_at: dict[str, list[int]], close, tags: set[str], limits: set[str]) -> None:
    """Close the innermost open element of ``tags``, unless one of ``limits`` is open within it."""
    last = lambda names: max((open_at[n][-1] for n in names if open_at.get(n)), default=0)
    at = last(tags)
    if at > last(limits):
        close(at)


def tokens(pages: DataFrame) -> DataFrame:
    """(host, page, token, is_text, n, at): per page its distinct tokens, how often and where first (0 to 1)."""

    def work(batch: pa.RecordBatch):
        rows = []
        for host, page, source in zip(*(batch.column(c).to_pylist() for c in ("host", "page", "html"))):
            found = parse(source, cache).tokens
            seen: dict[int, list] = {}
            for i, (token, is_text) in enumerate(found):
                seen.setdefault(token, [is_text, 0, i / len(found)])[1] += 1
            rows += [(host, page, token, *v) for token, v in seen.items()]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    cache: dict = {}
    names = ["host", "page", "token", "is_text", "n", "at"]
    types = [pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.float64()]
    schema = "host string, page long, token long, is_text boolean, n long, at double"
    return map_texts(pages.select("host", "page", "html"), work, schema, "html")


def host_templates(pages: DataFrame) -> DataFrame:
    """(host, classes): the valid equivalence classes of each host with at least PAGES pages.

    A token's occurrence vector is told by how many pages have it, how often in all, and two sums of a hash over
    (page, times): order does not matter, so tasks add up theirs first. ``classes`` is an array of arrays of (token, is_text, at)
    in page order. A host's template has at most 1 / SHARE times the tokens of a mean page.
    """
    part = F.xxhash64("page", "n")
    vectors = tokens(pages).groupBy("host", "token", "is_text").agg(
        F.count("*").alias("support"),
        F.sum("n").alias("total"),
        F.sum(F.shiftrightunsigned(part, 33)).alias("v1"),
        F.sum(part.bitwiseAND(F.lit(0x7FFFFFFF))).alias("v2"),
        F.avg("at").alias("at"),
    )
    totals = pages.groupBy("host").agg(F.count("*").alias("pages")).withColumnRenamed("host", "total_host")
    often = vectors.filter(F.col("support") >= PAGES).join(totals, F.col("host") == F.col("total_host"))
    often = often.filter(F.col("support") >= F.lit(SHARE) * F.col("pages"))
    member = F.struct("at", "token", "is_text")
    classes = often.groupBy("host", "support", "total", "v1", "v2").agg(F.sort_array(F.collect_list(member)).alias("c"))
    classes = classes.filter((F.size("c") >= CLASS_SIZE) & F.exists("c", lambda t: ~t["is_text"]))
    ordered = F.sort_array(F.collect_list(F.struct((-F.col("support")).alias("less"), "total", "v1", "c")))
    return classes.groupBy("host").agg(F.transform(ordered, lambda x: x["c"]).alias("classes"))


def template_places(found: list[tuple[int, bool]], classes: list[list[int]]) -> set[int]:
    """Places of the template's tokens among a page's tokens: of the classes that are in order and nested there.

    The first class is the most frequent; the others must lie within one gap of it.
    """
    where: dict[int, list[int]] = {}
    for i, (token, _) in enumerate(found):
        where.setdefault(token, []).append(i)
    outer, out = None, set()
    for members in classes:
        places = [where.get(t, []) for t in members]
        if not all(places) or len({len(p) for p in places}) > 1:
            continue
        rounds = np.array(places).T
        if (np.diff(rounds.ravel()) <= 0).any():
            kept = _ordered(places)
            if len(kept) < CLASS_SIZE:
                continue
            rounds = np.array([kept])
        if outer is None:
            outer = np.sort(rounds.ravel())
        elif any(len(set(np.searchsorted(outer, r).tolist())) > 1 for r in rounds):
            continue
        out.update(rounds.ravel().tolist())
    return out


def _ordered(places: list[list[int]]) -> list[int]:
    """Of tokens that occur once each, those in the class's order; none if they repeat."""
    if any(len(p) > 1 for p in places):
        return []
    kept, last = [], -1
    for (p,) in places:
        if p > last:
            kept.append(p)
            last = p
    return kept


def main_text(source: str, classes: list[list[int]], cache: dict) -> str:
    """The main text of one page, given its host's template."""
    page = parse(source, cache)
    places = template_places(page.tokens, classes) if classes else set()
    for at, run in page.runs:
        run.template = run.token != 0 and at in places
    runs = [run for _, run in page.runs if not run.aside]
    marked = [r for r in runs if r.article], [r for r in runs if r.main]
    inside, copied = next(((m, COPIED) for m in marked if any(r.text.strip() for r in m)), (runs, COPIED_UNMARKED))
    size = sum(len(r.text) for r in inside)
    fixed = sum(len(r.text) for r in inside if r.template)
    if fixed <= copied * size:
        inside = [r for r in inside if not r.template]
    blocks: dict[int, list[str]] = {}
    for run in inside:
        blocks.setdefault(run.block, []).append(run.text)
    return " ".join(t for t in (" ".join("".join(b).split()) for b in blocks.values()) if t)


def main_texts(pages: DataFrame, id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(id, url, text) per row of ``pages``: the page's main text, empty if there is none.

    A null html is empty; rows with a null url, or one without a host, share a host of their own. Repeated rows are pages
    each. The templates are broadcast if measured to be small, else pages and templates meet in a join that spreads
    a host with very many pages.
    """
    rows = pages.select(F.col(id).alias("page_id"), F.col(url).alias("url"), F.coalesce(F.col(html), F.lit("")).alias("html"))
    rows = rows.withColumn("host", host_of(F.col("url")))
    narrow = rows.select("host", F.xxhash64("page_id", "url").alias("page"), "html")
    classes = F.transform("classes", lambda c: F.transform(c, lambda t: t["token"])).alias("classes")
    found = stage(host_templates(narrow).select(F.col("host").alias("t_host"), classes))
    size = found.select(F.explode(F.flatten("classes")))
    joined = spread_join(rows, found, [("host", "t_host")], "left", small=measured_small(size))

    def work(batch: pa.RecordBatch):
        texts = [main_text(s, c or [], cache) for s, c in zip(*(batch.column(n).to_pylist() for n in ("html", "classes")))]
        yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts)], names)

    cache: dict = {}
    names = ["page_id", "url", "text"]
    schema = rows.select("page_id", "url", F.lit("").alias("text")).schema
    return map_texts(joined.select("page_id", "url", "html", "classes"), work, schema, "html")
