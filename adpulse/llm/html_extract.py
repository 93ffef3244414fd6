"""Main-text extraction by the maximum-scoring subsequence of a page's tokens.

A page is a sequence of words and tags.  Words score positive and tags
negative; a word's score depends on where it stands (running text, link text,
a container that is named or marked as boilerplate, or outside: not in the article
or main elements, or before the first h1, of a page where these hold or precede
most running words), a tag's on its name.
A container is marked by a whole class, id or role or by the part that says
what it names ("main-menu", "ad-box", not "has-sidebar" or "search-results"),
and never if it encloses the page's main, article or h1.  A header named after
the article ("entry-header"), or one with a heading inside an article or main
element, belongs to the content.  A boilerplate container is one token whatever
is in it, scored by whether it stands inside an article or main element.
One linear scan finds the contiguous run of tokens with the largest sum, which
is the content region; the text of the region, without the boilerplate
containers inside it, is the result.

The scores come from labelled pages: each token kind gets the logarithm of how
much more often it occurs inside than outside the content, words held at zero
or above, tags at zero or below.  Words in boilerplate containers never reach
the result, and words and tags in them score 0.
``labelled_pages`` writes the labelled pages by rule (menus, adverts, notices,
forms, articles with boxes inside, stray lines, comments, footers in varying
order); ``fit_scores`` also accepts others.

Scripts, styles, titles and other unseen elements, comments and markup never
count.  Character references are decoded, white space inside a block becomes
one space, blocks are joined in page order by one space.

A null or empty page and a page without any positive run give an empty text.
Broken markup is read as browsers do: stray ``<`` are text, an unfinished tag
at the end is dropped, unclosed elements end with their parents.  The time a page
takes grows with its length, whatever its markup.  Rows are independent, so ties, repeats and empty tables need no care.  Columns other
than those asked for pass through or are not read.
"""

from __future__ import annotations

import bisect
import functools
import html as html_lib
import math
import random
import re
from collections import Counter
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values of HTML: elements by their role.
UNSEEN = {"script", "style", "title", "noscript", "template", "textarea", "iframe", "object", "svg", "math", "select",
          "canvas", "audio", "video", "datalist", "noframes", "xmp"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i",
          "img", "ins", "kbd", "label", "mark", "nobr", "q", "s", "samp", "small", "span", "strike", "strong", "sub",
          "sup", "time", "tt", "u", "var", "wbr"}
EMPTY = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
BOILERPLATE = {"nav", "footer", "aside", "header", "form", "menu", "dialog", "button", "head"}
MARKS = {"ad", "ads", "advert", "adverts", "advertisement", "advertising", "adbox", "banner", "breadcrumb",
         "breadcrumbs", "comment", "comments", "commentlist", "consent", "cookie", "cookies", "disqus", "footer",
         "gdpr", "header", "masthead", "menu", "modal", "nav", "navbar", "navigation", "newsletter", "notice",
         "notices", "notification", "paywall", "popup", "promo", "promoted", "promotion", "related", "replies", "reply",
         "respond", "responses", "share", "sharing", "sidebar", "sidebars", "skyscraper", "social", "sponsor",
         "sponsored", "subscribe", "subscription", "teaser", "toolbar", "widget", "widgets", "complementary",
         "contentinfo", "search", "alert", "warning"}

_NAME = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)")
_TO_END = re.compile(r"(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>")
_QUOTE_OR_END = re.compile("[\"'>]")
_ATTRIBUTE = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_UNSHOWN = re.compile(r"display\s*:\s*none", re.I)
#: First parts of names that say how a page is laid out or what it has or lacks, not what an element is.
LAYOUT = {"has", "with", "without", "no", "not", "layout", "is", "hide", "show"}
#: Last parts of names that leave the part before them to say what an element is.
GENERIC = {"area", "articles", "bar", "block", "body", "bottom", "box", "button", "buttons", "center", "col", "column",
           "container", "content", "entries", "form", "group", "head", "heading", "holder", "icon", "icons", "image",
           "inner", "item", "items", "label", "left", "link", "links", "list", "main", "message", "outer", "overlay",
           "panel", "placeholder", "posts", "primary", "region", "right", "row", "secondary", "section", "signup", "slot",
           "stories", "text", "title", "top", "unit", "wrap", "wrapper"}
#: What an article's own header is named after.
HEADLINE = {"article", "content", "entry", "headline", "post", "story", "title"}


def _tag_ends(page: str, begin: int) -> Callable[[int], int]:
    """For the place after a tag's name, the place after the first ``>`` outside quotes, or -1;
    all places from ``begin`` on are settled in one pass, from the last quote to the first."""
    places = [m.start() for m in _QUOTE_OR_END.finditer(page, begin)]
    ends = [-1] * (len(places) + 1)
    following: dict[str, int] = {}
    for i in range(len(places) - 1, -1, -1):
        mark = page[places[i]]
        if mark == ">":
            ends[i] = places[i] + 1
        else:
            if mark in following:
                ends[i] = ends[following[mark] + 1]
            following[mark] = i
    return lambda at: ends[bisect.bisect_left(places, at)]


def tokens(page: str) -> Iterator[tuple[str, str, str]]:
    """("text", "", decoded text), ("open" or "close", name, attributes) of a page, without unseen elements."""
    at, n, text = 0, len(page), []
    last, ends = page.rfind(">"), None

    def flush():
        if text:
            out = html_lib.unescape("".join(text))
            text.clear()
            return [("text", "", out)]
        return []
    while at < n:
        lt = page.find("<", at)
        if lt < 0:
            text.append(page[at:])
            break
        if lt > at:
            text.append(page[at:lt])
        following = page[lt + 1:lt + 2]
        if page.startswith("<!--", lt):
            end = page.find("-->", lt + 4)
            at = n if end < 0 else end + 3
            continue
        if following in ("!", "?") and following:
            end = page.find(">", lt)
            at = n if end < 0 else end + 1
            continue
        if not (following.isalpha() or following == "/"):
            text.append("<")
            at = lt + 1
            continue
        if lt > last:  # an unfinished tag at the end
            break
        tag = _NAME.match(page, lt)
        if not tag:
            text.append("<")
            at = lt + 1
            continue
        yield from flush()
        if ends is None:
            closed = _TO_END.match(page, tag.end())
            at = closed.end() if closed else -1
            if not closed:  # a quote stays open; the next tags are not searched to the page's end again
                ends = _tag_ends(page, lt)
        else:
            at = ends(tag.end())
        if at < 0:
            at = page.find(">", tag.end()) + 1
        name, attributes = tag[2].lower(), page[tag.end():at - 1]
        if not tag[1] and name in UNSEEN:
            if attributes.endswith("/") and name in ("svg", "math"):
                continue
            closing = re.compile(rf"</{name}\b", re.I).search(page, at)
            at = page.find(">", closing.end()) + 1 if closing else 0
            if not at:
                break
            continue
        yield ("close" if tag[1] else "open"), name, attributes
    yield from flush()


def _attributes(attributes: str) -> dict[str, str]:
    """Attributes by lower-case name; the first of a name counts."""
    out: dict[str, str] = {}
    for m in _ATTRIBUTE.finditer(attributes):
        out.setdefault(m[1].lower(), m[2] or m[3] or m[4] or "")
    return out


def _heads_article(parts: list[str]) -> bool:
    return len(parts) > 1 and parts[-1] in ("header", "masthead") and parts[-2] in HEADLINE


def _names_boilerplate(name: str) -> bool:
    """True if the whole name, or the part that says what it names, is a kind of boilerplate."""
    parts = [p.lower() for p in _PARTS.findall(name)]
    if not parts or parts[0] in LAYOUT:
        return False
    if "".join(parts) in MARKS:
        return True
    if _heads_article(parts):
        return False
    while len(parts) > 1 and parts[-1] in GENERIC:
        parts.pop()
    return parts[-1] in MARKS


@functools.lru_cache(4096)
def marked(attributes: str) -> bool:
    """True if class, id or role name a kind of boilerplate, or the element is hidden."""
    if not attributes or attributes.isspace():
        return False
    own = _attributes(attributes)
    if "hidden" in own or own.get("aria-hidden", "").lower() == "true" or _UNSHOWN.search(own.get("style", "")):
        return True
    return any(_names_boilerplate(name) for key in ("class", "id", "role") for name in own.get(key, "").split())


@functools.lru_cache(4096)
def _article_header(attributes: str) -> bool:
    """True if class or id name the header of an article."""
    own = _attributes(attributes)
    return any(_heads_article([p.lower() for p in _PARTS.findall(name)])
               for key in ("class", "id") for name in own.get(key, "").split())


class _Places:
    """Where the scan stands: open containers, of which some are boilerplate, and links.
    A container is told by the number of the tag that opens it; those in ``spared`` are no boilerplate."""

    def __init__(self, spared: Iterable[int] = (), outside: bool = False, heading: int = 0):
        self.open: list[tuple[str, bool, int]] = []
        self.names: Counter[str] = Counter()
        self.bad: list[int] = []
        self.headers = self.links = self.tags = 0
        self.spared, self.outside, self.heading = frozenset(spared), outside, heading

    def see(self, kind: str, name: str, attributes: str) -> None:
        self.tags += 1
        if name == "a":
            self.links = 1 if kind == "open" and "href" in _attributes(attributes) else 0
        elif kind == "open" and name not in EMPTY and (name not in INLINE or name == "span" and marked(attributes)):
            if name in ("p", "li", "td", "th", "tr", "dt", "dd", "option") and self.open and self.open[-1][0] == name:
                self._pop()
            bad = name in BOILERPLATE and not (name == "header" and _article_header(attributes))
            bad = (bad or marked(attributes) and name not in ("body", "html")) and self.tags not in self.spared
            self.open.append((name, bad, self.tags))
            self.names[name] += 1
            if bad:
                self.bad.append(self.tags)
                self.headers += name == "header"
        elif kind == "close" and self.names[name]:
            while self._pop() != name:
                pass

    def _pop(self) -> str:
        name, bad, _ = self.open.pop()
        self.names[name] -= 1
        if bad:
            self.bad.pop()
            self.headers -= name == "header"
        return name

    def in_article(self) -> bool:
        return self.names["article"] + self.names["main"] > 0

    def word(self) -> str:
        if self.bad:
            return "boilerplate"
        if self.links:
            return "link"
        return "outside" if self.tags < self.heading or self.outside and not self.in_article() else "running"

    def read(self, kind: str, name: str, value: str) -> str:
        """What a token counts as: words by where they stand, a boilerplate container as one, other tags by name."""
        if kind == "text":
            return "word:" + self.word()
        inside, within = bool(self.bad), self.in_article()
        self.see(kind, name, value)
        if inside:
            return "tag in boilerplate"
        if self.bad:
            return "box in article" if within else "box"
        return "tag:" + name


def _survey(page: Iterable[tuple[str, str, str]]) -> tuple[set[int], bool, int]:
    """Containers that are no boilerplate whatever they are called, whether article and main elements hold most
    running words, and the tag number of the first h1 if most running words follow it (else 0).
    The containers are those that enclose the page's first main, first article of another name or first h1, if
    their class, id or role marks them, forms around these, and headers with an h1 or h2 inside an article or
    main element."""
    places, left, spared = _Places(), {"main", "article", "h1"}, set()
    running = inside = before = heading = 0
    for kind, name, value in page:
        if kind == "text":
            if places.word() == "running":
                n = len(value.split())
                running += n
                inside += n if places.in_article() else 0
            continue
        if kind == "open" and name in ("main", "article", "h1", "h2"):
            new = name in left and not marked(value)
            if new:
                left.remove(name)
                spared |= {number for x, bad, number in places.open if bad and (x not in BOILERPLATE or x == "form")}
            if name in ("h1", "h2") and len(places.bad) == places.headers and places.in_article():
                for number in reversed(places.bad):
                    if number in spared:
                        break
                    spared.add(number)
            if new and name == "h1" and spared.issuperset(places.bad):
                heading, before = places.tags + 1, running
        places.see(kind, name, value)
    return spared, 2 * inside > running, heading if 2 * before < running else 0


def labelled_pages(n: int = 200, seed: int = 5) -> Iterator[list[tuple[str, bool]]]:
    """Pages as lists of (fragment, is content), written by rule."""
    rng = random.Random(seed)

    def words(low, high):
        return " ".join("".join(rng.choices("aeionrst", k=rng.randint(2, 9))) for _ in range(rng.randint(low, high)))

    def links(low, high):
        return "".join(f'<li><a href="/{words(1, 1)}">{words(1, 3)}</a></li>' for _ in range(rng.randint(low, high)))

    def menu():
        return rng.choice(("<nav><ul>{}</ul></nav>", '<div class="menu"><ul>{}</ul></div>', "<ul>{}</ul>")).format(links(4, 12))

    def side():
        return rng.choice(('<aside><h3>{}</h3><ul>{}</ul></aside>', '<div id="sidebar"><h4>{}</h4><ul>{}</ul></div>')
                          ).format(words(1, 3), links(3, 9))

    def box():
        kind = rng.choice(("ad", "cookie-notice", "newsletter", "promo", "share"))
        return f'<div class="{kind}">{words(4, 25)}</div>'

    def stray():
        # Running text outside the content, under names that say nothing.
        return rng.choice(('<div class="strip">{}</div>', '<div class="tagline"><p>{}</p></div>', "<p>{}</p>",
                           '<section class="latest"><h3>{}</h3></section>')).format(words(2, 12))

    def form():
        return f'<form><label>{words(1, 3)}</label><input name="q"><button>{words(1, 2)}</button></form>'

    def comments():
        return '<section id="comments">' + "".join(
            f'<div class="comment"><p>{words(5, 40)}</p></div>' for _ in range(rng.randint(1, 6))) + "</section>"

    def article():
        out = [f"<h1>{words(3, 10)}</h1>"]
        for _ in range(rng.randint(1, 12)):
            out.append(rng.choices((f"<p>{words(10, 120)}</p>", f"<h2>{words(2, 7)}</h2>",
                                    f"<ul><li>{words(4, 20)}</li><li>{words(4, 20)}</li></ul>",
                                    f"<blockquote>{words(8, 40)}</blockquote>",
                                    f'<p>{words(8, 30)} <a href="#">{words(1, 3)}</a> {words(4, 20)}</p>',
                                    box(), side(), f"<ul>{links(3, 9)}</ul>"),
                                   (8, 2, 1, 1, 2, 1.5, 0.3, 0.2))[0])
        return "".join(out)
    for _ in range(n):
        around = rng.choice((("<article>", "</article>"), ("<main>", "</main>"), ("<div>", "</div>")))
        before = [menu(), *rng.sample((box(), side(), form(), stray(), f"<header><p>{words(2, 8)}</p></header>"), rng.randint(0, 3))]
        after = [*rng.sample((box(), side(), comments(), form(), stray()), rng.randint(0, 3)), f"<footer>{words(3, 15)}</footer>"]
        yield [("<body>" + "".join(before) + around[0], False), (article(), True), (around[1] + "".join(after) + "</body>", False)]


def fit_scores(pages: Iterable[list[tuple[str, bool]]]) -> dict[str, float]:
    """Score of each token kind: its log odds of standing in the content, of the sign that its kind may have."""
    inside, outside = Counter(), Counter()
    for page in pages:
        found = [(token, content) for fragment, content in page for token in tokens(fragment)]
        places = _Places(*_survey(token for token, _ in found))
        for (kind, name, value), content in found:
            (inside if content else outside)[places.read(kind, name, value)] += len(value.split()) if kind == "text" else 1
    odds = {k: math.log((inside[k] + 0.5) / (outside[k] + 0.5)) for k in inside | outside}
    held = {k: max(v, 0.0) if k.startswith("word:") else min(v, 0.0) for k, v in odds.items()}
    return held | {"word:boilerplate": 0.0, "tag in boilerplate": 0.0}


@functools.cache
def default_scores() -> dict[str, float]:
    return fit_scores(labelled_pages())


#: Tags that no labelled page has.
_OTHER_TAG = -0.1


def main_text(page: str | None, scores: dict[str, float] | None = None) -> str:
    """The text of the best contiguous content region of a page."""
    scores = default_scores() if scores is None else scores
    page_tokens = list(tokens(page or ""))
    places, pieces = _Places(*_survey(page_tokens)), []
    # A maximum-scoring run by one scan: its sum so far, where it began, and the best one seen.
    run = best = 0.0
    begin = 0
    found = (0, 0)
    for kind, name, value in page_tokens:
        counts_as = places.read(kind, name, value)
        if kind == "text":
            step = scores.get(counts_as, 0.0) * len(value.split())
            pieces.append(value if counts_as != "word:boilerplate" else "")
        else:
            step = scores.get(counts_as, _OTHER_TAG)
            pieces.append("" if name in INLINE else None if name != "br" else " ")
        run += step
        if run <= 0:
            run, begin = 0.0, len(pieces)
        elif run > best:
            best, found = run, (begin, len(pieces))
    blocks, block = [], []
    for piece in [*pieces[slice(*found)], None]:
        if piece is None:
            if words := "".join(block).split():
                blocks.append(" ".join(words))
            block = []
        else:
            block.append(piece)
    return " ".join(blocks)


def extract(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` of every page."""
    scores = default_scores()

    def run(batches):
        for batch in batches:
            texts = [main_text(h, scores) for h in batch.column("html").to_pylist()]
            yield pa.record_batch([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())],
                                  names=["page_id", "url", "text"])
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.col("html").cast("string").alias("html"))
    return (rows.mapInArrow(run, "page_id long, url string, text string")
            .withColumn("n_chars", F.length("text").cast("long")))
