"""HTML extraction with a site style tree.

The DOMs of a host's pages are merged into one tree whose nodes are paths of
tags with their class and id words. A node's importance comes from entropies
over the host's pages: how its presentation (the sequence of its children)
varies, and how its content is spread: a text found on all pages has none. Then
each page loses the branches of low importance, next to those whose tag, role
or class says that they are menus, headers, footers, adverts and the like. Words
of a class or id do not count for an element that holds an article or main, after
"no", "has" or "with", in an id that is a slug or on a heading or paragraph, and
not at all where they would leave a page without text.

The tree is an aggregation by (host, path, feature), combined before the
shuffle; a host with most pages is many keys. Pages are parsed where they lie
and never shuffled: only the paths to remove are broadcast, or joined where
there are more than ``BROADCAST_ROWS``.
"""

from __future__ import annotations

import html as entities
import re

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.store import stored, tables
from tidemark.llm.words import chunks, out_schema

#: Nodes below this importance go, on hosts where at least so many pages have them.
IMPORTANCE, LEAST_PAGES = 0.2, 4
#: Share of the content's importance in a node's; the rest is its presentation's.
CONTENT_SHARE = 0.9
BROADCAST_ROWS = 500_000
#: Levels of the style tree, since a text counts for every level above it. What lies deeper goes with its ancestors only; text is taken at any depth.
TREE_DEPTH = 200

# Fixed values of HTML.
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
RAW = {"script", "style", "title", "textarea", "iframe", "xmp", "noembed", "noframes"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd", "label", "mark", "q",
          "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr", "ruby", "rt", "rp"}
CLOSES = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
#: Block elements that end an open paragraph.
ENDS_P = {"address", "article", "aside", "blockquote", "details", "div", "dl", "fieldset", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6",
          "header", "hr", "main", "menu", "nav", "ol", "pre", "section", "table", "ul"}
#: How far an element that closes its like may reach out.
SCOPE = {"ul", "ol", "dl", "table", "div", "section", "article", "aside", "nav", "main", "body", "td", "th", "form", "blockquote", "header", "footer"}

# What is not the article.
NOISE_TAGS = {"head", "nav", "aside", "footer", "form", "button", "select", "input", "textarea", "dialog", "menu", "template", "noscript", "iframe", "object",
              "embed", "svg", "canvas", "audio", "video", "script", "style", "title", "map", "fieldset", "xmp", "noembed", "noframes"}
NOISE_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "alert", "alertdialog", "dialog", "form", "menu", "menubar", "toolbar"}
NOISE_WORDS = {"ad", "ads", "adsense", "advert", "advertisement", "advertising", "adverts", "sponsor", "sponsored", "promo", "promotion", "banner",
               "nav", "navbar", "navigation", "menu", "breadcrumb", "breadcrumbs", "sidebar", "widget", "footer", "masthead", "topbar", "toolbar",
               "cookie", "cookies", "consent", "gdpr", "notice", "alert", "popup", "modal", "overlay", "newsletter", "subscribe", "subscription", "signup",
               "login", "register", "search", "share", "sharing", "social", "related", "recommended", "recommendations", "comment", "comments", "commentlist",
               "disqus", "replies", "respond", "pagination", "pager", "form", "skip"}
HEADER_WORDS = {"header"}
#: Words after one of these, in one class or id, say what else the page has or lacks.
ABOUT = {"no", "not", "non", "has", "have", "with", "without"}
#: An id names noise if it has no words but noise words and these; others are slugs of headings and sections.
PLACES = {"main", "site", "page", "post", "top", "bottom", "left", "right", "primary", "secondary", "inner", "outer", "area", "block", "box", "bar", "section",
          "container", "wrapper", "wrap", "content", "list", "item", "col", "column", "row", "header", "global", "mobile", "desktop", "the", "id", "div"}
#: On these an id is an anchor.
ANCHORED = {"p", "h1", "h2", "h3", "h4", "h5", "h6", "blockquote", "pre"}

_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+(?:>|\Z)|</([a-zA-Z][^\s/>]*+)[^>]*+(?:>|\Z)
|<([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)(?:>|\Z)|<([a-zA-Z][^\s/>]*+)([^>]*+)(?:>|\Z)""", re.S | re.X)
_ATTRIBUTE = re.compile(r"""(?<![\w-])(class|id|role|hidden|aria-hidden)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?(?=[\s/]|\Z)""", re.I)
_NAME = re.compile(r"[a-z]+")


def _split(label: str) -> list[str]:
    return _NAME.findall(re.sub(r"(?<=[a-z])(?=[A-Z])", "-", label).lower())


def evidence(tag: str, classes: str, id_: str) -> set[str]:
    """Words of the class and id that can say what the element is."""
    out: set[str] = set()
    for token in classes.split():
        for word in _split(token):
            if word in ABOUT:
                break
            out.add(word)
    names = _split(id_) if tag not in ANCHORED else []
    if names and not ABOUT & {*names} and {*names} <= NOISE_WORDS | HEADER_WORDS | PLACES:
        out.update(names)
    return out


class Node:
    __slots__ = ("parent", "tag", "path", "noise", "article", "hard", "soft", "named", "spared", "in_article", "bare", "children", "texts", "depth", "in_tree")

    def __init__(self, parent: "Node | None", tag: str, attributes: str):
        named = {k.lower(): v.strip("\"'") for k, v in _ATTRIBUTE.findall(attributes)} if attributes else {}
        labels = re.sub(r"(?<=[a-z])(?=[A-Z])", "-", named.get("class", "") + " " + named.get("id", ""))
        words = sorted({*_NAME.findall(labels.lower())})
        self.parent, self.tag, self.children, self.texts = parent, tag, [], []
        signature = ".".join([tag, *words])
        self.path = xxhash.xxh3_64_intdigest(signature, parent.path if parent else 0)
        self.in_article = parent is not None and (parent.in_article or parent.tag == "article")
        words = evidence(tag, named.get("class", ""), named.get("id", "")) if named else ()
        #: Noise by tag, role or hiding, its own or inherited.
        self.hard = (parent is not None and parent.hard) or tag in NOISE_TAGS or named.get("role", "").lower() in NOISE_ROLES or "hidden" in named or named.get("aria-hidden") == "true"
        #: Noise by its own words; a header's word or tag counts outside articles only, see ``decide``.
        self.soft = self.named = self.spared = False
        if tag == "article":
            self.soft = not {"comment", "comments", "related", "ad", "promo"}.isdisjoint(words)
        elif tag not in ("html", "body", "main"):
            self.soft, self.named = not NOISE_WORDS.isdisjoint(words), tag == "header" or not HEADER_WORDS.isdisjoint(words)
        if tag in ("article", "main") and not self.hard and not self.soft:
            # What holds an article or main is not judged by its words. An article in another one is a comment or the like.
            up = None if self.in_article else parent
            while up is not None and not up.spared:
                up.spared = True
                up = up.parent
        self.depth = parent.depth + 1 if parent else 0
        #: The nearest element, itself or above, that is a node of the style tree.
        self.in_tree = self if self.depth <= TREE_DEPTH else parent.in_tree
        if parent is not None:
            parent.children.append(signature)

    def decide(self, by_words: bool = True) -> None:
        """Sets ``noise``, ``article`` and ``bare``, once the page's elements are known; the parent's before."""
        parent, tag = self.parent, self.tag
        inside = parent is not None and parent.article
        self.noise = self.hard or (parent is not None and parent.noise)
        if not self.noise and not self.spared:
            self.noise = (by_words and self.soft) or (self.named and not inside and (by_words or tag == "header"))
        self.article = not self.noise and (inside or tag in ("article", "main"))
        #: A plain paragraph or heading of an article, or the article itself: no template part.
        self.bare = self.article and (tag in ("article", "main", "p", "h1", "h2", "h3", "h4", "h5", "h6", "blockquote", "pre") or tag in INLINE)


def parse(html: str) -> list[tuple[Node | None, str]]:
    """The page's texts in order with the element that holds each; (None, "") is a block's edge."""
    root = Node(None, "#", "")
    stack, nodes, runs, at = [root], [root], [], 0
    #: Places in the stack of each tag's open elements, and of those that are not inline: no end tag has to search the stack.
    places: dict[str, list[int]] = {}
    blocks: list[int] = []

    def text(raw: str) -> None:
        if raw:
            runs.append((stack[-1], raw))

    def push(node: Node) -> None:
        places.setdefault(node.tag, []).append(len(stack))
        if node.tag not in INLINE:
            blocks.append(len(stack))
        stack.append(node)

    def pop(to: int) -> None:
        while len(stack) > to:
            tag = stack.pop().tag
            places[tag].pop()
            if tag not in INLINE:
                blocks.pop()

    def last(tags) -> int:
        return max((places[t][-1] for t in tags if places.get(t)), default=0)

    def close(names, scope) -> None:
        i = last(names)
        if i and i >= last(scope):
            pop(i)
            runs.append((None, ""))

    while at < len(html):
        start = html.find("<", at)
        if start < 0:
            text(html[at:])
            break
        m = _TOKEN.match(html, start)
        if not m:  # a sign like any other
            text(html[at:start + 1])
            at = start + 1
            continue
        text(html[at:start])
        at = m.end()
        if m[1]:
            tag = m[1].lower()
            if tag not in INLINE:
                runs.append((None, ""))
            i = last((tag,))
            if i and not (tag in INLINE and blocks and blocks[-1] > i):  # not a stray inline end tag
                pop(i)
            continue
        tag = (m[2] or m[4] or "").lower()
        if not tag:
            continue
        attributes = m[3] if m[2] else m[5]
        if tag in CLOSES:
            close(CLOSES[tag], SCOPE - CLOSES[tag] if tag != "p" else SCOPE)
        elif tag in ENDS_P:
            close({"p"}, SCOPE)
        if tag not in INLINE:
            runs.append((None, ""))
        node = Node(stack[-1], tag, attributes)
        nodes.append(node)
        if tag in RAW:
            end = re.compile(rf"</{tag}(?=[\s/>]|\Z)", re.I).search(html, at)
            at = end.start() if end else len(html)
            if end:
                at = html.find(">", at) + 1 or len(html)
        elif tag not in VOID and not attributes.endswith("/"):
            push(node)
    for node in nodes:
        node.decide()
    if any(node.soft or node.named for node in nodes) and not any(n is not None and not n.noise and raw.strip() for n, raw in runs):
        for node in nodes:  # words would leave nothing: then they say nothing
            node.decide(by_words=False)
    return runs


def plain(raw: str) -> str:
    return entities.unescape(raw) if "&" in raw else raw


def main_text(runs, low=frozenset()) -> str:
    """Kept texts, white space as one space. ``low``: paths to leave out, unless that leaves nothing."""
    articles = any(n is not None and n.article and raw.strip() for n, raw in runs)
    gone: dict[Node, bool] = {}

    def dropped(node: Node) -> bool:
        chain = []
        while node is not None and node not in gone:
            chain.append(node)
            node = node.parent
        out = node is not None and gone[node]
        for n in reversed(chain):
            out = gone[n] = out or (not n.bare and n.path in low)
        return out

    for prune in ((True, False) if low else (False,)):
        parts = []
        for node, raw in runs:
            if node is None:
                parts.append(" ")
            elif not node.noise and (node.article or not articles) and not (prune and dropped(node)):
                parts.append(plain(raw))
        out = " ".join("".join(parts).split())
        if out:
            return out
    return ""


def style_features(runs) -> set[tuple[int, int, int]]:
    """(path, kind, feature) of one page: kind 0 the presentation of each element, kind 1 the texts in it."""
    found, seen = set(), {}
    for node, raw in runs:
        if node is None:
            continue
        words = raw.split()
        feature = xxhash.xxh3_64_intdigest(" ".join(words)) if words else None
        node = node.in_tree
        while node is not None and node.tag not in ("#", "html", "body"):
            if node not in seen:
                seen[node] = None
                children = [c for i, c in enumerate(node.children) if not i or c != node.children[i - 1]]
                found.add((node.path, 0, xxhash.xxh3_64_intdigest(" ".join(children))))
            if feature is not None:
                found.add((node.path, 1, feature))
            node = node.parent
    return found


_HOST = re.compile(r"://([^/?#]*)")


def host_key(url: str | None) -> int:
    m = _HOST.search(url or "")
    return xxhash.xxh3_64_intdigest(m[1].lower() if m else "")


def _signed(values) -> pa.Array:
    return pa.array(np.array(values, np.uint64).view(np.int64))


def low_importance(pages: DataFrame, url_col: str, html_col: str, importance: float = IMPORTANCE, least_pages: int = LEAST_PAGES) -> DataFrame:
    """``host``, ``path`` (hashes) of the style tree's nodes below ``importance``."""
    def rows(batches):
        for batch in chunks(batches, "_html"):
            out = ([], [], [], [])
            for url, html in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                host = host_key(url)
                for path, kind, feature in style_features(parse(html or "")):
                    for column, value in zip(out, (host, path, kind, feature)):
                        column.append(value)
            yield pa.RecordBatch.from_arrays([_signed(out[0]), _signed(out[1]), pa.array(out[2], pa.int32()), _signed(out[3])], names=["host", "path", "kind", "feature"])

    found = pages.select(F.col(f"`{url_col}`").alias("_url"), F.col(f"`{html_col}`").alias("_html")).mapInArrow(rows, "host long, path long, kind int, feature long")
    counts = found.groupBy("host", "path", "kind", "feature").agg(F.count("*").alias("k"))
    # A page has one presentation feature a node at least, so their sum is the pages (elements of several looks count more).
    sums = counts.groupBy("host", "path").agg(
        F.sum(F.when(F.col("kind") == 0, F.col("k"))).alias("m"),
        F.sum(F.when(F.col("kind") == 0, F.col("k") * F.ln("k"))).alias("looks"),
        F.avg(F.when(F.col("kind") == 1, F.ln("k"))).alias("spread"))
    m = F.greatest(F.col("m").cast("double"), F.lit(2.0))
    presentation = (F.ln(m) - F.col("looks") / m) / F.ln(m)
    content = 1 - F.coalesce("spread", F.lit(0.0)) / F.ln(m)
    worth = CONTENT_SHARE * content + (1 - CONTENT_SHARE) * presentation
    return sums.where(F.col("m") >= least_pages).where(worth < importance).select("host", "path")


def extract(pages: DataFrame, url_col: str = "url", html_col: str = "html", **options) -> DataFrame:
    """``pages`` without the html, plus ``text`` and ``n_chars`` (code points).

    Elements nest to any depth; the style tree has the upper ``TREE_DEPTH`` levels.
    Text is that of the page's articles, or of the whole body where it has none.
    A null or empty html, or one without such text, gives an empty text; a null
    url is a host of its own. If every branch of a page is of low importance,
    none is removed. One row out for each row in, repeated rows too; columns
    named like an added one are replaced. An empty table gives an empty result.
    """
    low = stored(low_importance(pages, url_col, html_col, **options), "style")
    added = [c for c in ("text", "n_chars") if c in pages.columns and c not in (url_col, html_col)]
    pages = pages.drop(*added)
    few = low.count() <= BROADCAST_ROWS
    spark = pages.sparkSession
    if few:
        paths: dict[int, set[int]] = {}
        for r in low.collect():
            paths.setdefault(r.host % (1 << 64), set()).add(r.path % (1 << 64))
        shared = spark.sparkContext.broadcast(paths)
    else:
        key = _host_column(url_col)
        pages = pages.withColumn("_host", key).join(low.groupBy(F.col("host").alias("_host")).agg(F.collect_set("path").alias("_low")), "_host", "left").drop("_host")
    passed = [f for f in pages.schema.fields if f.name not in (html_col, "_low")]

    def rows(batches):
        for batch in chunks(batches, html_col):
            column = {c: batch.column(i) for i, c in enumerate(batch.schema.names)}
            texts = []
            lows = None if few else column["_low"].to_pylist()
            for i, (url, html) in enumerate(zip(column[url_col].to_pylist(), column[html_col].to_pylist())):
                own = shared.value.get(host_key(url), frozenset()) if few else {p % (1 << 64) for p in lows[i] or ()}
                texts.append(main_text(parse(html), own) if html else "")
            yield pa.RecordBatch.from_arrays([*(column[f.name] for f in passed), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                                             names=[*(f.name for f in passed), "text", "n_chars"])

    return pages.mapInArrow(rows, out_schema("text string, n_chars long", passed))


def _host_column(url_col: str):
    @F.pandas_udf("long")
    def key(urls: pd.Series) -> pd.Series:
        return pd.Series(np.array([host_key(u) for u in urls], np.uint64).view(np.int64))

    return key(F.col(f"`{url_col}`"))


def op2(spark, sf_dir: str) -> DataFrame:
    return extract(tables(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


QUERIES = {"op2_html_extract": op2}
ORACLES = {}
