"""Main text of web pages by tree scoring.

A page becomes a tree. Every paragraph earns points for its length and its commas and passes them to its ancestors,
less the further up; a container's points are discounted by the share of its text that stands in links. The best
container, or the article or main element around it, all other articles and all siblings that are not mostly links are
kept, however short, without menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles and reader comments.
What these are is said by tags, and by names in class, id and role, which are judged as a whole (``no-sidebar`` is no sidebar)
and don't count where they would leave nothing of the page.

Character references are decoded, white space inside a block (``<br>`` too) becomes one space, and blocks are joined in page
order by one line feed. Null or empty pages and pages without text give the empty string. Rows are independent:
repeated ones give the same text, a null ``page_id`` or ``url`` is kept, extra columns are ignored. The work grows with the
page's length, also for pages of nothing but tags that are never closed.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbsight.llm.common import Emitter, values

#: A quote counts only where a value begins; one that nothing closes is a mark like others.
TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)
|<(/?)([a-zA-Z][^\s/>]*)((?>[^>=]+|=\s*(?:"[^"]*"|'[^']*'|[^\s"'>][^\s>]*|["'])?)*+)(>|\Z)""", re.S | re.X)
ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]*))?""")
WORD = re.compile(r"[a-z]+")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Their content is text up to the end tag, never markup.
RAW = frozenset("script style textarea title noscript iframe noembed noframes xmp".split())
BLOCK = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset
figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre section
summary table tbody td tfoot th thead tr ul""".split())
DROPPED = frozenset("""head script style noscript template iframe object svg math canvas audio video nav aside footer
form button select textarea datalist menu dialog title noembed noframes""".split())
#: Start tags that end an open element of the same kind, unless one of the bounds stands between.
ENDS = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
        "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}),
        "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"})}
ENDS |= {x: ({"thead", "tbody", "tfoot", "tr", "td", "th"}, {"table"}) for x in ("thead", "tbody", "tfoot")}

#: Words of class, id or role that mark what is not the article.
ASIDE = frozenset("""ad ads advert adverts advertisement advertising sponsor sponsored promo promoted promotion sidebar
sidebars menu nav navbar navigation breadcrumb breadcrumbs footer masthead cookie cookies consent gdpr notice notices
alert alerts popup modal overlay newsletter subscribe subscription signup share sharing social related recommended
comment comments commentlist respond reply replies disqus complementary contentinfo search pagination pager widget
toolbar banner hidden""".split())
#: A name with one of these says what is or isn't there besides, or speaks of something else.
BESIDES = frozenset("no not non has have with without of".split())
#: What else the name of an aside within an article may say.
PLAIN = frozenset("""site page main top bottom left right inner outer wrap wrapper container box block list area section post
posts article articles entry blog story link links bar item items panel slot unit text global primary secondary header
title form button buttons btn icon icons holder group column row cell content body view module""".split())
#: Within an article names count for these; a paragraph, a heading or an item is part of it whatever its name.
NAMED = frozenset("div section ul ol dl table figure details center address fieldset".split())
BONUS = {"article": 25.0, "main": 20.0, "section": 5.0, "div": 5.0, "td": 3.0, "blockquote": 3.0, "ul": -3.0,
         "ol": -3.0, "dl": -3.0, "address": -3.0, "form": -3.0, "html": -10.0, "body": -5.0}
LEVELS = 5
#: What holds an article as a whole.
ARTICLE = frozenset("article main".split())
#: Share of its text in links from which on what stands beside the article is a menu.
LINKED = 0.5
#: What can hold an article. Lists and tables belong to what stands around them, text in a cell too.
CONTAINER = frozenset("#root html body article main section div center figure details".split())
CELL = frozenset("td th".split())


def _names_aside(value: str, in_article: bool) -> bool:
    """Whether one of the names in a class, id or role is that of an aside; a name is judged as a whole."""
    for name in value.lower().split():
        words = set(WORD.findall(name))
        if words & BESIDES or not words & (ASIDE if in_article else ASIDE | {"header"}):
            continue
        if not in_article or all(w in ASIDE or w in PLAIN or len(w) == 1 for w in words):
            return True
    return False


def _is_dropped(tag: str, attributes: str, in_article: bool) -> bool:
    """What is never part of an article: by its tag, or because it is not shown."""
    if tag in DROPPED:
        return True
    if tag == "header":
        return not in_article
    if not attributes.strip() or tag in ("html", "body", "article", "main"):
        return False
    for name, value in ATTRIBUTE.findall(attributes):
        name = name.lower()
        if name == "hidden" or name == "aria-hidden" and "true" in value.lower():
            return True
        if name == "style" and re.search(r"display\s*:\s*none", value, re.I):
            return True
    return False


def _is_named_aside(tag: str, attributes: str, in_article: bool) -> bool:
    if tag in ("html", "body", "article", "main") or in_article and tag not in NAMED:
        return False
    return any(_names_aside(value.strip("\"'"), in_article) for name, value in ATTRIBUTE.findall(attributes)
               if name.lower() in ("class", "id", "role"))


class Page:
    """Elements in page order, the texts between the tags, and what each element holds."""

    def __init__(self, source: str) -> None:
        self.tag, self.parent, self.dropped, self.in_article = ["#root"], [0], [False], [False]
        self.named = [False]  # in an element whose name is that of an aside
        self.block_of, self.holder = [0], [0]  # the block around, the container or cell around
        self.texts: list[tuple[int, int, str]] = []  # element, block number, text
        self.open, self.block = [0], 0
        self.places: dict[str, list[int]] = {}  # of open elements by tag, so that no tag has to be looked for
        self.open_blocks: list[int] = []
        self._read(source)
        self._settle_names()

    def _close(self, place: int) -> None:
        """End the open elements from a place of the stack on."""
        while len(self.open) > place:
            tag = self.tag[self.open.pop()]
            self.places[tag].pop()
            if tag in BLOCK:
                self.open_blocks.pop()

    def _last(self, tag: str) -> int:
        places = self.places.get(tag)
        return places[-1] if places else 0

    def _start(self, tag: str, attributes: str) -> None:
        if tag in BLOCK:
            self._end_p()
        if tag in ENDS:
            closes, bounds = ENDS[tag]
            bound = max(map(self._last, bounds))
            if tag.startswith("t"):  # cells and rows end together
                ended = [next(p for p in self.places[name] if p > bound) for name in closes if self._last(name) > bound]
                if ended:
                    self._close(min(ended))
            elif (place := max(map(self._last, closes))) > bound:
                self._close(place)
        top = self.open[-1]
        inside = self.in_article[top]
        number = len(self.tag)
        self.tag.append(tag)
        self.parent.append(top)
        self.dropped.append(self.dropped[top] or _is_dropped(tag, attributes, inside))
        self.named.append(self.named[top] or bool(attributes) and _is_named_aside(tag, attributes, inside))
        self.in_article.append(inside or tag in ARTICLE)
        self.block_of.append(number if tag in BLOCK else self.block_of[top])
        self.holder.append(top if self.tag[top] in CONTAINER or self.tag[top] in CELL else self.holder[top])
        if tag not in VOID:
            self.places.setdefault(tag, []).append(len(self.open))
            if tag in BLOCK:
                self.open_blocks.append(len(self.open))
            self.open.append(number)

    def _end_p(self) -> None:
        """An open paragraph ends where a block begins, unless a container lies between."""
        if self.open_blocks and self.tag[self.open[self.open_blocks[-1]]] == "p":
            self._close(self.open_blocks[-1])

    def _end(self, tag: str) -> None:
        place = self._last(tag)
        # An inline end tag doesn't end a block.
        if place and (tag in BLOCK or not self.open_blocks or place > self.open_blocks[-1]):
            self._close(place)

    def _settle_names(self) -> None:
        """Names are no more than a hint: they don't count where they would leave nothing, or only asides, of the page.

        If there is no article outside of named elements but there is one inside, names of what holds an article don't
        count; if no text is left outside of them, no name does.
        """
        shown = [i for i, _, text in self.texts if text.strip()]
        articles = {i for i in shown if self.in_article[i]}
        if all(self.named[i] for i in shown):
            self.named = [False] * len(self.tag)
        elif articles and all(self.named[i] for i in articles):
            holds = [False] * len(self.tag)
            for i in range(len(self.tag) - 1, 0, -1):
                holds[i] = holds[i] or self.tag[i] in ARTICLE
                holds[self.parent[i]] = holds[self.parent[i]] or holds[i]
            named, clear = self.named, [True] * len(self.tag)  # what is named around holds an article
            for i in range(1, len(self.tag)):
                begins = named[i] and not named[self.parent[i]]
                clear[i] = clear[self.parent[i]] and (holds[i] or not begins)
            self.named = [named[i] and not (clear[i] and (holds[i] or self.in_article[i])) for i in range(len(self.tag))]
        self.texts = [t for t in self.texts if not self.named[t[0]]]

    def _text(self, text: str) -> None:
        if not self.dropped[self.open[-1]]:
            self.texts.append((self.open[-1], self.block, html.unescape(text)))

    def _read(self, source: str) -> None:
        at, n = 0, len(source)
        while at < n:
            match = TAG.search(source, at)
            if match is None:
                rest = source[at:]
                cut = re.search(r"<[a-zA-Z/!?][^<]*\Z", rest)  # a tag that the page's end cuts off
                self._text(rest[:cut.start()] if cut else rest)
                return
            if match.start() > at:
                self._text(source[at:match.start()])
            at = match.end()
            tag = match[2]
            if not tag or not match[4]:
                continue
            tag = tag.lower()
            self.block += tag in BLOCK
            if tag == "br":
                self._text(" ")
            elif match[1]:
                self._end(tag)
            else:
                self._start(tag, match[3])
                if tag in RAW:
                    end = re.compile(rf"</{tag}(?=[\s/>])", re.I).search(source, at)
                    stop = end.start() if end else n
                    self._text(source[at:stop])
                    at = stop

    def best(self) -> set[int]:
        """The best container and the siblings that belong to it."""
        n = len(self.tag)
        letters, linked = [0] * n, [0] * n
        own, commas, in_link = [0] * n, [0] * n, self._inside("a")
        for element, _, text in self.texts:
            size = len(" ".join(text.split()))
            letters[element] += size
            linked[element] += size if in_link[element] else 0
            element = self.block_of[element]
            own[element] += size
            commas[element] += sum(map(text.count, ",،、，"))
        for i in range(n - 1, 0, -1):
            letters[self.parent[i]] += letters[i]
            linked[self.parent[i]] += linked[i]
        points = [0.0] * n
        for i in range(n):
            if own[i]:
                earned = 1 + commas[i] + min(own[i] / 100, 3)
                ancestor, level = i, 0
                if self.tag[i] in CONTAINER:
                    points[i] += earned  # text that stands in the container itself
                while ancestor and level < LEVELS:
                    ancestor = self.holder[ancestor]
                    level += 1
                    points[ancestor] += earned / (1 if level == 1 else 2 * (level - 1))
        density = [b / a if a else 0.0 for a, b in zip(letters, linked)]
        score = [(p + BONUS.get(t, 0.0)) * (1 - d) if p else 0.0
                 for p, t, d in zip(points, self.tag, density)]
        best = max(range(n), key=lambda i: (score[i], -i))
        if not points[best]:
            return {0}
        around = best
        while around and self.tag[around] not in ARTICLE:
            around = self.parent[around]
        best = around or best
        chosen = {best}
        for i in range(1, n):
            beside = self.parent[i] == self.parent[best] or around and self.tag[i] in ARTICLE
            if best and beside and letters[i] and density[i] < LINKED:
                chosen.add(i)  # of several articles all, wherever they stand
        return chosen

    def _inside(self, tag: str) -> list[bool]:
        inside = [False] * len(self.tag)
        for i in range(1, len(self.tag)):
            inside[i] = self.tag[i] == tag or inside[self.parent[i]]
        return inside

    def text(self) -> str:
        chosen = self.best()
        kept = [0 in chosen] * len(self.tag)
        for i in range(1, len(self.tag)):
            kept[i] = kept[self.parent[i]] or i in chosen
        blocks: list[str] = []
        current, parts = None, []
        for element, block, text in self.texts:
            if kept[element]:
                if block != current:
                    blocks.append("".join(parts))
                    current, parts = block, []
                parts.append(text)
        blocks.append("".join(parts))
        return "\n".join(x for x in (" ".join(b.split()) for b in blocks) if x)


def main_text(source: str | None) -> str:
    return Page(source).text() if source else ""


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url and the main text of each page."""
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = Emitter(schema)
        for batch in batches:
            for page_id, url, source in zip(*(values(batch, c) for c in ("page_id", "url", "html"))):
                text = main_text(source)
                out.add((page_id, url, text), len(text))
                yield from out.ready()
        yield from out.rest()

    return pages.select(F.col("page_id").cast("long"), "url", "html").mapInArrow(
        run, "page_id long, url string, text string")
