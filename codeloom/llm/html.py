"""Main text of web pages by equivalence classes of template tokens (operator 1).

A token is a block-level element, a text block or the whole text of a container, each with its path: a running hash of
tag, class and id of every container down from the root. Its occurrence vector says how often each page of a host holds
it. Tokens with equal vectors form a class; a class is valid if it holds more than one token, or occurs in a good part
of the pages, and if the token above it is valid too (a join of the tokens with themselves by the path above). The valid
tokens of a host are its template; what lies between them are the slots. Vectors are as long as a host has pages, so
they are never collected: they are summed as hashes, combined before the shuffle, and equal sums are equal vectors.

A text block that is on every page that holds its container is part of the template and goes, unless it is a heading of
text that stays. A container whose text
is the same on most of its pages is steady and does not count as a main slot. The main text is all that is left below
the article and main elements of a page, or else below the lowest container that holds all of its main slots, outside
of what is marked as a menu, sidebar, form, advert and the like. Pages of a host without a template, such as its only
page, are judged by the same rules on their own.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from html import unescape
from itertools import takewhile

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codeloom.llm.shared import saved

#: A class of one token must occur in so many percent of the host's pages.
FREQUENT_PERCENT = 20
#: Text is part of the template only if so many different pages agree.
FIXED_PAGES = 3
#: Hosts whose templates are sent to every executor, a few hundred bytes each.
BROADCAST_HOSTS = 50_000

PIECE = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:[^>=]++|=\s*\"[^\"]*\"|=\s*'[^']*'|=)*+)(?:>|\Z)|[^<]+|<", re.S
)
ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
NAME_PART = re.compile(r"[a-z]+")

RAW = frozenset("script style noscript template iframe textarea title svg select xmp annotation annotation-xml".split())
#: Raw elements that end the block they stand in.
RAW_BLOCKS = frozenset("title xmp".split())
CONTAINERS = frozenset(
    "html body main article section div nav header footer aside form ul ol dl table tbody thead tfoot tr td th details dialog "
    "menu fieldset figure center blockquote".split()
)
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img input ins kbd label mark q s samp small span strike strong "
    "sub sup time tt u var wbr object ruby rb rp rt math semantics maction merror mfenced mfrac mi mmultiscripts mn mo mover mpadded mphantom "
    "mprescripts mroot mrow ms mspace msqrt mstyle msub msubsup msup mtable mtd mtext mtr munder munderover".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
DROPPED_TAGS = frozenset("head nav footer aside form dialog menu button".split())
DROPPED_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion sidebar nav navbar navigation menu breadcrumb "
    "breadcrumbs footer cookie cookies consent gdpr notice notices alert newsletter subscribe subscription signup login share sharing social "
    "related recommended recommendations comment comments disqus respond replies popup modal overlay widget toolbar pagination pager skip".split()
)
DROPPED_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar toolbar".split())
PARTS = frozenset("blockquote ul ol dl table tbody thead tfoot tr th figure details center section".split())
#: Words in class names that say what a container has beside or below its text, not what it is.
MODIFIERS = frozenset("has with no without show hide is not".split())
#: Words in class names that say of what kind or where a part is: the word before them names it.
NEUTRAL_NAMES = frozenset(
    "area article articles bar block body bottom box button buttons col column container content entry form frame group header holder icon icons "
    "inline inner item items label left link links list main middle outer panel part post posts right row section side slot story text thread "
    "title top unit wrap wrapper".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: An article element counts so many times its prose against the rest of the page.
ARTICLE_WEIGHT = 16


class Container:
    __slots__ = ("parent", "tag", "path", "dropped", "named", "main", "article", "prose", "linked")

    def __init__(self, parent, tag, path, dropped, named, main, article):
        self.parent, self.tag, self.path, self.dropped, self.named, self.main, self.article = parent, tag, path, dropped, named, main, article
        self.prose = self.linked = 0


def attributes(source: str) -> dict[str, str]:
    return {m[1].lower(): m[2] or m[3] or m[4] or "" for m in ATTRIBUTE.finditer(source)} if source.strip() else {}


def is_dropped(tag: str, attrs: dict[str, str], inside_main: bool) -> bool:
    """By tag, role or a hidden state: what holds for all that is below."""
    if tag in DROPPED_TAGS or tag == "header" and not inside_main:
        return True
    if not attrs or exempt(tag, attrs):
        return False
    if "hidden" in attrs or attrs.get("aria-hidden") == "true" or "display:none" in attrs.get("style", "").replace(" ", ""):
        return True
    return attrs.get("role", "").lower() in DROPPED_ROLES


def is_named(tag: str, attrs: dict[str, str], inside_main: bool) -> int:
    """By class or id: 2 if one of them is such a name, 1 if it is a part of one, else 0.

    In an article the part must be what the name ends with ("post-comments", "ad-slot"); a part before another noun
    ("login-guide", "share-price") gives -1, to be decided by the links.
    """
    if not attrs or exempt(tag, attrs):
        return 0
    whole = f"{attrs.get('class', '')} {attrs.get('id', '')}".lower().split()
    if not DROPPED_NAMES.isdisjoint(whole):
        return 2
    found = 0
    for name in whole:
        parts = list(takewhile(lambda part: part not in MODIFIERS, NAME_PART.findall(name)))
        if not inside_main:
            if not DROPPED_NAMES.isdisjoint(parts) or "header" in parts:
                return 1
        elif not DROPPED_NAMES.isdisjoint(parts):
            while len(parts) > 1 and parts[-1] in NEUTRAL_NAMES:
                parts.pop()
            if parts[-1] in DROPPED_NAMES:
                return 1
            found = -1
    return found


def exempt(tag: str, attrs: dict[str, str]) -> bool:
    return tag in ("html", "body", "article", "main") and attrs.get("role", "main") in ("main", "article") and not comment(attrs)


def comment(attrs: dict[str, str]) -> bool:
    names = NAME_PART.findall(f"{attrs.get('class', '')} {attrs.get('id', '')}".lower())
    return "comment" in names or "comments" in names or attrs.get("role") == "comment"


def hashed(*parts: object) -> int:
    return int.from_bytes(hashlib.blake2b("\0".join(map(str, parts)).encode("utf-8", "surrogatepass"), digest_size=8).digest(), "big", signed=True)


def label_of(tag: str, attrs: dict[str, str]) -> str:
    name = tag + "".join("." + c for c in sorted(attrs.get("class", "").split()))
    return name + ("#" + re.sub(r"\d+", "0", attrs["id"]) if attrs.get("id") else "")


def totals(nodes: list[Container]) -> tuple[list[int], list[int]]:
    """Prose and linked characters of and below each container; dropped and named parts are not added to those above."""
    prose, linked = [n.prose for n in nodes], [n.linked for n in nodes]
    for i in range(len(nodes) - 1, 0, -1):
        n = nodes[i]
        if not n.dropped and not n.named:
            prose[n.parent] += prose[i]
            linked[n.parent] += linked[i]
    return prose, linked


def settle(nodes: list[Container]) -> None:
    """Drops what is named, except for containers that hold the article or the main slot; then all below what is dropped."""
    for n in nodes[1:]:
        n.dropped = n.dropped or nodes[n.parent].dropped
    if any(n.named for n in nodes):
        prose, linked = totals(nodes)
        for i, n in enumerate(nodes):
            if n.named < 0:
                n.named = 1 if 2 * linked[i] > prose[i] else 0
        prose, linked = totals(nodes)
        score = [max(0, p - 2 * q) if not n.dropped else 0 for n, p, q in zip(nodes, prose, linked)]
        articles = [i for i, n in enumerate(nodes) if n.article and not n.named and not n.dropped and prose[i]]
        if articles:
            # The longest one and all main elements; shorter articles in a related part or in comments go with it.
            longest = max(articles, key=lambda i: (prose[i], -i))
            kept = [i for i in articles if i == longest or nodes[i].article == "main"]
        else:
            best = max((i for i, n in enumerate(nodes) if n.named), key=lambda i: (score[i], -i))
            weak = nodes[best].named == 1 and score[best] > 4 * score[0]
            kept = [best] if weak or score[best] and not score[0] and prose[best] > nodes[best].prose else []
        spared = set()
        for i in kept:
            while i > 0:
                if nodes[i].named:
                    spared.add(nodes[i].path)
                i = nodes[i].parent
        for n in nodes:
            if n.named and n.path in spared:
                n.named = 0
    for n in nodes[1:]:
        n.dropped = n.dropped or n.named > 0 or nodes[n.parent].dropped


def outline(source: str) -> tuple[list[Container], list[tuple[int, str, str]], dict[tuple[int, str], int]]:
    """Containers in page order, blocks (container, text, label of its element), counts of other elements in containers."""
    nodes = [Container(-1, "", 0, False, 0, False, "")]
    blocks: list[tuple[int, str, str]] = []
    others: dict[tuple[int, str], int] = {}
    element = ""
    stack, words, links, linked = [0], [], 0, 0
    hidden: list[str] = []  # dropped elements that are no containers

    def flush() -> None:
        nonlocal words, linked
        if words:
            text = " ".join(unescape("".join(words)).split())
            if text:
                node = nodes[stack[-1]]
                blocks.append((stack[-1], text, element))
                node.prose += len(text)
                node.linked += min(linked, len(text))
            words = []
        linked = 0

    at, end = 0, len(source)
    while at < end:
        m = PIECE.match(source, at)
        at = m.end()
        tag = m[2]
        if tag is None:
            piece = m[0]
            if not hidden and (piece[0] != "<" or piece == "<"):
                words.append(piece)
                if links:
                    linked += len(piece.strip())
            continue
        tag = tag.lower()
        if m[1]:
            if hidden:
                if hidden[-1] == tag:
                    hidden.pop()
                continue
            if tag == "a":
                links = max(0, links - 1)
            if tag in INLINE:
                continue
            flush()
            element = ""
            if tag in CONTAINERS:
                for depth in range(len(stack) - 1, 0, -1):
                    if nodes[stack[depth]].tag == tag:
                        del stack[depth:]
                        break
            continue
        if tag in RAW:
            if tag in RAW_BLOCKS:
                flush()
            close = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>?", re.I).search(source, at)
            at = close.end() if close else end
            continue
        closed = m[3].endswith("/") and tag not in CONTAINERS
        if hidden:
            if tag == hidden[-1] and not closed and tag not in VOID:
                hidden.append(tag)
            continue
        if tag == "br":
            words.append(" ")
            continue
        if tag == "a":
            links += 1
        above = nodes[stack[-1]]
        if tag in CONTAINERS:
            flush()
            element = ""
            attrs = attributes(m[3])
            article = "main" if tag == "main" or attrs.get("role") == "main" else tag if tag == "article" else ""
            nodes.append(
                Container(
                    stack[-1], tag, hashed(above.path, label_of(tag, attrs)), is_dropped(tag, attrs, above.main), is_named(tag, attrs, above.main),
                    above.main or article != "", article,
                )
            )
            stack.append(len(nodes) - 1)
            continue
        attrs = attributes(m[3])
        if tag not in INLINE:
            flush()
            element = label_of(tag, attrs)
            others[stack[-1], element] = others.get((stack[-1], element), 0) + 1
        if tag not in VOID and not closed and (tag in DROPPED_TAGS or attrs and (is_dropped(tag, attrs, above.main) or is_named(tag, attrs, above.main) > 0)):
            hidden.append(tag)
    flush()
    settle(nodes)
    return nodes, blocks, others


def tokens_of(source: str) -> tuple[int, list[tuple[int, int, int, str]]]:
    """Hash of the page's texts, and its tokens (path, path above, times, kind): tags, texts, slots (texts of containers)."""
    nodes, blocks, others = outline(source)
    found: dict[tuple[int, int, str], int] = {}
    for n in nodes[1:]:
        token = (n.path, nodes[n.parent].path, "tag")
        found[token] = found.get(token, 0) + 1
    for (i, element), times in others.items():
        token = (hashed(nodes[i].path, element), nodes[i].path, "tag")
        found[token] = found.get(token, 0) + times
    slots: dict[int, list[str]] = {}
    for i, text, element in blocks:
        if not nodes[i].dropped:
            path = nodes[i].path
            token = (text_token(path, element, text), path, "text")
            found[token] = found.get(token, 0) + 1
            slots.setdefault(path, []).append(text)
    for path, texts in slots.items():
        found[hashed(path, "slot", *texts), path, "slot"] = 1
    # The root is a token of every page, so that what is outside of all elements has a path above.
    found[0, 0, "root"] = 1
    return hashed(*[t for v in slots.values() for t in v]), [(p, above, times, kind) for (p, above, kind), times in found.items()]


def text_token(path: int, element: str, text: str) -> int:
    return hashed(path, "text", element, text)


def region(nodes: list[Container], steady: set[int]) -> list[int]:
    """The containers whose text is the main text: articles and main elements, else the one that holds all main slots."""
    prose, linked = totals(nodes)
    named = [i for i, n in enumerate(nodes) if n.article and not n.dropped and prose[i]]
    if named:
        outermost = []
        for i in named:
            at = nodes[i].parent
            while at >= 0 and not nodes[at].article:
                at = nodes[at].parent
            if at < 0:
                outermost.append(i)
        score = sum(max(0, prose[i] - 2 * linked[i]) for i in outermost)
        rest = max(0, prose[0] - 2 * linked[0]) - score
        if any(nodes[i].article == "main" for i in named) or ARTICLE_WEIGHT * score > rest:
            return outermost
    slots = [i for i, n in enumerate(nodes) if not n.dropped and n.prose > 2 * n.linked and n.path not in steady]
    if not slots:
        return [0] if not steady else []
    chain: list[int] = []
    for i in slots:
        above = []
        while i >= 0:
            above.append(i)
            i = nodes[i].parent
        above.reverse()
        if not chain:
            chain = above
        else:
            same = 0
            while same < min(len(chain), len(above)) and chain[same] == above[same]:
                same += 1
            chain = chain[:same]
    at = chain[-1]
    # A quote, list, table or section is a part of a text, as are the headings beside it.
    while nodes[at].tag in PARTS and nodes[at].parent > 0:
        at = nodes[at].parent
    return [at]


def main_text(source: str | None, steady: list[int] | None, fixed: list[int]) -> str:
    """All blocks of the main region that are not dropped and not part of the template."""
    if not source:
        return ""
    nodes, blocks, _ = outline(source)
    roots = set(region(nodes, set(steady or [])))
    cut = set(fixed)
    prose, linked = totals(nodes)
    inside, gone = [False] * len(nodes), [False] * len(nodes)
    for i, n in enumerate(nodes):
        above = n.parent
        inside[i] = i in roots or above >= 0 and inside[above]
        # Links only, and not in the midst of prose: a menu without a name.
        menu = i > 0 and not n.main and prose[i] > 0 and 10 * linked[i] >= 9 * prose[i] and nodes[above].prose <= 2 * nodes[above].linked
        gone[i] = n.dropped or menu or above >= 0 and gone[above]
    part = [(i, text, element, bool(cut) and text_token(nodes[i].path, element, text) in cut) for i, text, element in blocks if inside[i]]
    # From the end, as a fixed heading stays if what it heads does.
    kept: list[str] = []
    below = None
    varying = [k for k, (i, _, _, fixed) in enumerate(part) if not fixed and not gone[i]]
    for k in range(len(part) - 1, -1, -1):
        i, text, element, fixed = part[k]
        stays = not gone[i] and (not fixed or below is not None and heads(nodes, part[k], below, varying[0] < k))
        if stays:
            kept.append(text)
        below = part[k] if stays else None
    return "\n\n".join(reversed(kept))


def heads(nodes: list[Container], heading: tuple[int, str, str, bool], below: tuple[int, str, str, bool], inner: bool) -> bool:
    """Is a text of the template a heading of the article, such as "Method" on a host of recipes? It must be a heading element, the
    next block must stay, be no article of its own and lie in the same container or below it; and text that is no template
    must be before it (`inner`), or, in an article, what it heads is no heading."""
    i, _, element, _ = heading
    if level_of(element) is None:
        return False
    at = below[0]
    while at > i and not nodes[at].article:
        at = nodes[at].parent
    return at == i and (inner or nodes[i].main and level_of(below[2]) is None)


def level_of(element: str) -> str | None:
    tag = re.split(r"[.#]", element, maxsplit=1)[0]
    return tag if tag in HEADINGS else None


def host_of(url):
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)", 1)


def templates(pages: DataFrame, url: str, html: str, frequent_percent: int, fixed_pages: int) -> DataFrame:
    """Per host: `steady`, paths of containers with the same text on most pages, and `fixed`, text tokens of the template.

    Both are parts of frequent containers, so the lists are as long as a few pages have parts.
    """

    def tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for host, source in zip(*[batch.column(c).to_pylist() for c in range(2)]):
                page, found = tokens_of(source or "")
                out += [(host, page, *token) for token in found]
            cols = list(zip(*out)) if out else [[]] * 6
            kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=names)

    names = ["host", "page", "path", "above", "times", "kind"]
    source = pages.select(host_of(F.col(url)).alias("host"), F.col(html).alias("html"))
    found = source.mapInArrow(tokens, "host string, page long, path long, above long, times long, kind string")
    # Decimal sums do not overflow; the sum of the hashes is the occurrence vector's name.
    name = F.sum(F.xxhash64("page", "times").cast("decimal(20,0)"))
    p = F.col("page").bitwiseAND(F.lit(0xFFFF))
    token = found.groupBy("host", "path", "above", "kind").agg(
        F.count(F.lit(1)).alias("pages"), name.alias("vector"), F.min(p).alias("a"), F.max(p).alias("b"), F.sum(p).alias("s"), F.sum(p * p).alias("q"),
    )
    # Copies of a page agree by themselves: the sum of (p - a)(b - p) is above zero if there are three different ones.
    several = F.col("q") < (F.col("a") + F.col("b")) * F.col("s") - F.col("pages") * F.col("a") * F.col("b")
    token = token.where((F.col("kind").isin("tag", "root")) | (F.col("pages") >= fixed_pages))
    token = saved(token.select("host", "path", "above", "kind", "pages", "vector", several.alias("several")), "tokens")
    all_pages = token.where("kind = 'root'").select("host", F.col("pages").alias("all_pages"))
    classes = token.groupBy("host", "pages", "vector").agg(F.count(F.lit(1)).alias("members"))
    valid = (
        token.join(classes, ["host", "pages", "vector"]).join(all_pages, "host")
        .where((F.col("members") > 1) | (F.col("pages") * 100 >= F.col("all_pages") * frequent_percent))
    )
    around = valid.where(F.col("kind").isin("tag", "root") & (F.col("pages") * 100 >= F.col("all_pages") * frequent_percent)).select(
        "host", F.col("path").alias("above"), F.col("pages").alias("around")
    )
    # Nested: the token above is in the template too.
    nested = valid.where("kind in ('text', 'slot') and several").where(F.col("pages") >= fixed_pages).join(around, ["host", "above"])
    part = nested.select(
        "host", F.when((F.col("kind") == "text") & (F.col("pages") == F.col("around")), F.col("path")).alias("fixed"),
        F.when((F.col("kind") == "slot") & (2 * F.col("pages") > F.col("around")), F.col("above")).alias("steady"),
    ).where("fixed is not null or steady is not null")
    return part.groupBy("host").agg(F.sort_array(F.collect_set("steady")).alias("steady"), F.sort_array(F.collect_set("fixed")).alias("fixed"))


def extract_pages(
    pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html", frequent_percent: int = FREQUENT_PERCENT,
    fixed_pages: int = FIXED_PAGES,
) -> DataFrame:
    """Key, url, text and n_chars (code points) of every page.

    All blocks of the main region in page order, joined by two line feeds; in a block, character references are decoded and
    white space is one space. A null or empty page, or one without prose, has an empty text. Pages with a null url or
    without a host form one host. Rows with equal keys are extracted one by one; other columns are ignored.
    """
    lean = pages.select(F.col(key).alias("key"), F.col(url).alias("url"), F.col(html).alias("html"))
    template = saved(templates(lean, "url", "html", frequent_percent, fixed_pages), "templates")
    if template.count() <= BROADCAST_HOSTS:  # else the pages are shuffled by host
        template = F.broadcast(template)
    rows = lean.withColumn("host", host_of(F.col("url"))).join(template, "host", "left")
    kinds = {c: lean.schema[c].dataType.simpleString() for c in ("key", "url")}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(h, m, f or []) for h, m, f in zip(*[batch.column(c).to_pylist() for c in (2, 3, 4)])]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())], names=["key", "url", "text"])

    out = rows.select("key", "url", "html", "steady", "fixed").mapInArrow(run, f"key {kinds['key']}, url {kinds['url']}, text string")
    return out.select(F.col("key").alias(key), F.col("url").alias(url), "text", F.length("text").cast("long").alias("n_chars"))
