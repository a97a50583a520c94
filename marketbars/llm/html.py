"""HTML extraction by equivalence-class template deduction over pages of one host.

Pages of a host are compared in groups, and in every group the pages of one layout:
those that share at least half (``LAYOUT_SHARE``) of their tag paths. Each is cut into
tokens: opening tags by their path of names and classes, and text blocks by path
and text. A token's occurrence vector says how often it occurs on each page.
Tokens that share a vector form an equivalence class; the classes that
occur once on nearly every page (``TEMPLATE_SHARE``), kept if their tokens keep
their order, are the template, and classes of a larger count that is equal on
nearly all pages nest in it as repeated parts. What
lies between template tokens are the slots. The slot path that holds most text
outside menus, notices and other furniture is the article. Repeated parts below
it are furniture, whatever their names, if they hold its smaller part
(``MINOR_SHARE``) and are no paragraphs, headings, lists or tables; a part whose
count differs between pages, or that occurs once, counts as text unless its name
says otherwise. All remaining slots make the main text. Text blocks that belong to the template itself (equal on
nearly all pages whose articles differ) are furniture too.

Names tell furniture as far as these go: a tag of ``FURNITURE_TAGS``, a hidden one
(by its own ``hidden`` attribute or its style) and one of a furniture role always;
a class or id that is a listed name, outside the article; a class or id that only
holds a listed word, and any listed name inside the article, where the tag belongs
to the template too (an equal count on nearly all of at least ``TEMPLATE_PAGES``
pages) and holds the smaller part of the text. Headings and paragraphs never go by
a word of their names.

A group holds one host's pages, about ``GROUP_PAGES`` of them: hosts with more
are split by a hash of the page. Small hosts make small groups, down to one page,
where only the first two tell furniture from text. Pages shuffle
once. The table of page counts per host is written first, so that Spark knows its
size when it chooses the join.

Defined cases: null and empty pages have empty text. Broken markup is read as far
as it goes: unclosed and stray tags are tolerated. Null URLs are one host. Repeated
rows are pages of their own. An empty table gives an empty result. Extra columns
are not read.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter, defaultdict
from dataclasses import dataclass, replace

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketbars.shared import stored

GROUP_PAGES = 64
#: Pages, and share of them, on which a token must recur to be part of a template.
TEMPLATE_PAGES = 8
TEMPLATE_SHARE = 0.9
#: Share of common tag paths from which two pages are of one layout.
LAYOUT_SHARE = 0.5
#: Share of the article's text that a part of the template holds at most to be furniture.
MINOR_SHARE = 0.25

#: Tag names by their role in HTML.
RAW = ("script", "style", "noscript", "template", "textarea", "svg", "iframe", "object", "select",
       "title", "math", "canvas", "audio", "video")
VOID = frozenset(("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta",
                  "param", "source", "track", "wbr"))
INLINE = frozenset((
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em",
    "font", "i", "ins", "kbd", "label", "mark", "q", "s", "samp", "small", "span", "strike",
    "strong", "sub", "sup", "time", "tt", "u", "var", "br", "wbr", "img"))
FURNITURE_TAGS = frozenset(("nav", "footer", "aside", "form", "menu", "dialog", "button", "head"))
FURNITURE_ROLES = frozenset((
    "navigation", "banner", "contentinfo", "complementary", "search", "form", "menu", "dialog",
    "alert", "alertdialog"))
ARTICLE_TAGS = frozenset(("article", "main"))
TEXT_TAGS = frozenset(("p", "h1", "h2", "h3", "h4", "h5", "h6", "li", "ul", "ol", "dl", "dt", "dd",
                       "blockquote", "pre", "figure", "figcaption", "table", "tbody", "tr", "td", "th"))
HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
#: Words of class and id names that mark furniture.
FURNITURE_WORDS = frozenset((
    "ad", "ads", "adv", "advert", "adverts", "advertisement", "advertising", "banner", "breadcrumb",
    "breadcrumbs", "comment", "comments", "cookie", "cookies", "consent", "disclaimer", "disqus",
    "footer", "form", "gdpr", "header", "login", "masthead", "menu", "modal", "nav", "navbar",
    "navigation", "newsletter", "notice", "notification", "pagination", "pager", "popup", "promo",
    "related", "replies", "respond", "search", "share", "sharing", "sidebar", "signup", "social",
    "sponsor", "sponsored", "subscribe", "toolbar", "topbar", "widget"))

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<![^>]*>|<\?[^>]*>|<(/?)([a-zA-Z][\w:-]*)"
                    r"((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S)
_ATTRIBUTE = re.compile(r"([^\s=\"'>/]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_WORD = re.compile(r"[a-z]+")
_NOT_SHOWN = re.compile(r"display\s*:\s*none", re.I)
_RAW_END = {name: re.compile(rf"</{name}\s*>", re.I) for name in RAW}
#: Opening one of the former closes an open one of the latter.
_CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
           "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}


@dataclass(frozen=True)
class Block:
    """A run of text between block-level tags: its path and whether furniture holds it.

    ``named`` are the paths of its elements that a listed word makes furniture if
    they belong to the template.
    """

    path: tuple[str, ...]
    text: str
    furniture: bool
    named: tuple[tuple[str, ...], ...] = ()


def _attributes(text: str) -> dict[str, str]:
    """Attributes by lower-case name; the first of a name counts."""
    found: dict[str, str] = {}
    for name, *values in _ATTRIBUTE.findall(text):
        found.setdefault(name.lower(), next((v for v in values if v), ""))
    return found


def _names(attributes: dict[str, str]) -> list[str]:
    """Class and id names."""
    return f"{attributes.get('class', '')} {attributes.get('id', '')}".lower().split()


def _furniture(name: str, attributes: dict[str, str], in_article: bool) -> bool:
    """Whether a tag is furniture by itself: outside the article also by a whole listed name."""
    if name in FURNITURE_TAGS or (name == "header" and not in_article):
        return True
    if "hidden" in attributes or _NOT_SHOWN.search(attributes.get("style", "")):
        return True
    if attributes.get("role", "").lower() in FURNITURE_ROLES:
        return True
    return not in_article and name not in ARTICLE_TAGS and name not in ("body", "html") and any(
        n in FURNITURE_WORDS for n in _names(attributes))


def _named(name: str, attributes: dict[str, str]) -> list[str]:
    """Class and id names of a tag that hold a listed word."""
    if name in ARTICLE_TAGS or name in ("body", "html") or name in HEADINGS or name == "p":
        return []
    return [n for n in _names(attributes) if any(w in FURNITURE_WORDS for w in _WORD.findall(n))]


def _role(name: str, attributes: dict[str, str], named: list[str]) -> str:
    """A tag's name with its classes and listed names: what tells tags of different use apart."""
    classes = attributes.get("class", "").lower()
    return ".".join([name, *([classes] if classes else []), *(f"#{n}" for n in named if n not in classes.split())])


def parse(page: str | None) -> tuple[list[Block], list[tuple]]:
    """A page's text blocks, and its tokens in page order: (path,) of tags, (path, text) of blocks."""
    blocks: list[Block] = []
    tokens: list[tuple] = []
    stack: list[tuple[str, str, bool, bool]] = []
    parts: list[str] = []
    inline_furniture: list[str] = []

    def close_block() -> None:
        text = " ".join(entities.unescape("".join(parts)).split())
        parts.clear()
        if text:
            path = tuple(s[1] for s in stack)
            blocks.append(Block(path, text, any(s[2] for s in stack), tuple(
                path[:d] for d, s in enumerate(stack, 1) if s[3])))
            tokens.append((blocks[-1].path, text))

    page = page or ""
    at = 0
    while at < len(page):
        found = _TOKEN.search(page, at)
        if not found:
            parts.append(page[at:])
            break
        if not inline_furniture:
            parts.append(page[at:found.start()])
        at = found.end()
        name = (found[2] or "").lower()
        if not name:
            continue
        attributes = found[3] or ""
        if name in _RAW_END:
            if not found[1]:
                end = _RAW_END[name].search(page, at)
                at = end.end() if end else len(page)
            continue
        if name in INLINE:
            if name in ("br", "wbr", "img"):
                parts.append(" " if name == "br" else "")
            elif inline_furniture:
                if found[1] and inline_furniture[-1] == name:
                    inline_furniture.pop()
                elif not found[1] and inline_furniture[-1] == name:
                    inline_furniture.append(name)
            elif not found[1] and attributes and not attributes.rstrip().endswith("/") \
                    and name == "span" and _furniture(
                        name, _attributes(attributes), any(s[0] in ARTICLE_TAGS for s in stack)):
                inline_furniture.append(name)
            continue
        inline_furniture.clear()
        close_block()
        if found[1]:
            names = [s[0] for s in stack]
            if name in names:
                del stack[len(names) - 1 - names[::-1].index(name):]
            continue
        closes = _CLOSES.get(name, set())
        if stack and (stack[-1][0] == "p" or stack[-1][0] in closes):
            stack.pop()
        in_article = any(s[0] in ARTICLE_TAGS for s in stack)
        known = _attributes(attributes)
        named = _named(name, known)
        role = _role(name, known, named)
        tokens.append(((*(s[1] for s in stack), role),))
        if name not in VOID and not attributes.rstrip().endswith("/"):
            stack.append((name, role, _furniture(name, known, in_article), bool(named)))
    close_block()
    return blocks, tokens


def _classes(tokens: list[list[tuple]]) -> tuple[dict[tuple[int, ...], list], dict]:
    """Equivalence classes, by occurrence vector over the pages, and every token's places."""
    places: dict[tuple, list[list[int]]] = defaultdict(lambda: [[] for _ in tokens])
    for k, page in enumerate(tokens):
        for place, token in enumerate(page):
            places[token][k].append(place)
    classes: dict[tuple[int, ...], list] = defaultdict(list)
    for token, found in places.items():
        classes[tuple(map(len, found))].append(token)
    return classes, places


def _regular(vector: tuple[int, ...]) -> int:
    """The count that a class has on nearly all pages; else 0."""
    count, times = Counter(vector).most_common(1)[0] if vector else (0, 0)
    return count if times >= TEMPLATE_SHARE * len(vector) else 0


def _ordered(class_tokens: list, places: dict) -> list:
    """The tokens of a class that keep one order in their occurrences on nearly all pages."""
    kept: list = []
    for token in sorted(class_tokens, key=lambda t: next(f for f in places[t] if f)[0]):
        if kept:
            kinds = [all(a < b and (i + 1 == len(x) or b < x[i + 1])
                         for i, (a, b) in enumerate(zip(x, y, strict=True)))
                     for x, y in zip(places[kept[-1]], places[token], strict=True)
                     if x and len(x) == len(y)]
            if sum(kinds) < TEMPLATE_SHARE * len(kinds):
                continue
        kept.append(token)
    return kept


def _template(classes: dict, places: dict) -> set:
    """Tag paths of the classes that occur once on nearly every page, kept if they keep one order."""
    once = [t for v, found in classes.items() if _regular(v) == 1 for t in found]
    return {t[0] for t in _ordered(once, places) if len(t) == 1}


def _repeated(classes: dict, places: dict, container: tuple[str, ...]) -> set:
    """Roots of the parts that the template repeats a fixed number of times below the container.

    A class of larger equal counts, ordered, is one part; its first tag, if no
    text tag, is the root that the other tokens nest in.
    """
    depth, roots = len(container), set()
    for vector, found in classes.items():
        if _regular(vector) < 2:
            continue
        for token in _ordered(found, places):
            path = token[0]
            if len(token) > 1 or len(path) <= depth or path[:depth] != container:
                continue
            if any(r.split(".")[0] in TEXT_TAGS for r in path[depth:]):
                continue
            if not any(path[:len(r)] == r for r in roots):
                roots.add(path)
    return roots


def _minor(parsed: list, container: tuple[str, ...], paths: set) -> set:
    """Of furniture paths, those whose slots hold the smaller part of the container's text."""
    inside: Counter = Counter()
    total = 0
    for blocks, _ in parsed:
        for b in blocks:
            if b.furniture or b.path[:len(container)] != container:
                continue
            total += len(b.text)
            for depth in range(len(container) + 1, len(b.path) + 1):
                if b.path[:depth] in paths:
                    inside[b.path[:depth]] += len(b.text)
    return {p for p in paths if inside[p] <= MINOR_SHARE * total}


def _container(parsed: list, template: set) -> tuple[str, ...]:
    """The template path whose slots hold most of the group's text outside furniture."""
    mass: Counter = Counter()
    for blocks, _ in parsed:
        for block in blocks:
            if block.furniture:
                continue
            home = ()
            for depth in range(len(block.path), 0, -1):
                if block.path[:depth] in template:
                    home = block.path[:depth]
                    break
            mass[home] += len(block.text)
    if not mass:
        return ()
    best = max(sorted(mass), key=mass.get)
    while best and best[-1].split(".")[0] in TEXT_TAGS:
        best = best[:-1]
    # Within an article or main element, that element; else up to where a heading joins.
    for depth in range(1, len(best) + 1):
        if best[depth - 1].split(".")[0] in ARTICLE_TAGS:
            return best[:depth]
    headings = {b.path[:-1] for blocks, _ in parsed for b in blocks
                if not b.furniture and b.path and b.path[-1].split(".")[0] == "h1"}
    for depth in range(len(best), 0, -1):
        if any(h[:depth] == best[:depth] for h in headings):
            return best[:depth]
    return best


def _without(parsed: list, paths: set) -> list:
    """Pages whose blocks below ``paths`` count as furniture."""
    return [([replace(b, furniture=b.furniture or any(
        b.path[:d] in paths for d in range(1, len(b.path) + 1))) for b in blocks], tokens)
        for blocks, tokens in parsed] if paths else parsed


def _layouts(parsed: list) -> list[list[int]]:
    """Numbers of the pages of each layout: pages whose tag paths are mostly the same.

    Paths of paragraphs, lists and tables, which come with the text, do not count.
    """
    heads: list[set] = []
    members: list[list[int]] = []
    for k, (_, tokens) in enumerate(parsed):
        paths = {t[0] for t in tokens if len(t) == 1 and not any(
            r.split(".")[0] in TEXT_TAGS for r in t[0])}
        shares = [len(h & paths) / len(h | paths) if h | paths else 1.0 for h in heads]
        best = max(range(len(shares)), key=shares.__getitem__, default=None)
        if best is None or shares[best] < LAYOUT_SHARE:
            heads.append(paths)
            members.append([k])
        else:
            members[best].append(k)
    return members


def extract(pages: list[str | None]) -> list[str]:
    """Main texts of pages of one host; each layout has its own template."""
    parsed = [parse(p) for p in pages]
    texts = [""] * len(parsed)
    for layout in _layouts(parsed):
        for k, text in zip(layout, _extract([parsed[k] for k in layout]), strict=True):
            texts[k] = text
    return texts


def _extract(parsed: list) -> list[str]:
    """Main texts of parsed pages of one layout."""
    whole = [k for k, (_, tokens) in enumerate(parsed) if tokens]
    classes, places = _classes([parsed[k][1] for k in whole])
    container = _container(parsed, _template(classes, places))
    if len(whole) >= TEMPLATE_PAGES:
        regular = {t[0] for v, found in classes.items() if _regular(v) for t in found}
        named = {p for blocks, _ in parsed for b in blocks for p in b.named if p in regular}
        parts = named | _repeated(classes, places, container)
        parsed = _without(parsed, _minor(parsed, container, parts))
    depth = len(container)

    def slots(blocks: list[Block]) -> list[Block]:
        found = [b for b in blocks if not b.furniture and b.path[:depth] == container]
        if not found:  # a page of another shape: its own best container
            own = _container([(blocks, ())], {b.path[:d] for b in blocks for d in range(len(b.path) + 1)
                                              if b.path[d - 1:d] and b.path[d - 1].split(".")[0] in ARTICLE_TAGS})
            found = [b for b in blocks if not b.furniture and b.path[:len(own)] == own]
        return found

    chosen = [slots(blocks) for blocks, _ in parsed]
    constant = _template_texts(chosen, whole)
    return ["\n\n".join(b.text for b in found if (b.path, b.text) not in constant)
            for found in chosen]


def _template_texts(chosen: list[list[Block]], whole: list[int]) -> set:
    """Text blocks found once on nearly all pages although the rest of the pages differs."""
    if len(whole) < TEMPLATE_PAGES:
        return set()
    on = Counter(t for k in whole for t in {(b.path, b.text) for b in chosen[k]})
    constant = {t for t, n in on.items() if n >= TEMPLATE_SHARE * len(whole)}
    if not constant:
        return constant
    rest = {tuple(b.text for b in chosen[k] if (b.path, b.text) not in constant) for k in whole}
    return constant if len(rest - {()}) >= TEMPLATE_SHARE * len(whole) else set()


def main_texts(pages: DataFrame, group_pages: int = GROUP_PAGES, page_id: str = "page_id",
               url: str = "url", html: str = "html") -> DataFrame:
    """Per page: its id, URL and main text."""
    host = F.coalesce(F.regexp_extract(F.lower(F.col(url)), r"^(?:[a-z][a-z0-9+.-]*:)?//([^/?#]*)", 1),
                      F.lit(""))
    rows = pages.select(F.col(page_id), F.col(url), F.col(html), host.alias("host"))
    sizes = stored(rows.groupBy("host").agg(
        F.ceil(F.count(F.lit(1)) / group_pages).alias("groups")), "hosts")
    rows = rows.join(sizes, "host")
    rows = rows.withColumn("group", F.expr(f"pmod(xxhash64(`{page_id}`, `{url}`), groups)")).drop("groups")
    result = T.StructType([pages.schema[page_id], pages.schema[url], T.StructField("text", T.StringType())])

    def take(group: pa.Table) -> pa.Table:
        texts = extract(group.column(html).to_pylist())
        return pa.table([group.column(page_id), group.column(url), pa.array(texts, pa.string())],
                        names=result.names)

    return rows.groupBy("host", "group").applyInArrow(take, result)
