"""The main text of a web page by tree scoring."""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common

# HTML's element names by their role here.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe template xmp noembed noframes svg annotation annotation-xml".split())
NEVER = frozenset("nav footer aside button select dialog menu object canvas audio video head".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var math mfrac mi mn mo mover mpadded mphantom mroot mrow ms mspace msqrt mstyle msub msubsup msup mtext munder munderover semantics".split())
PARAGRAPH = frozenset("p pre blockquote li td th dd dt h1 h2 h3 h4 h5 h6 figcaption caption address summary".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: An opening tag of these ends an open paragraph.
ENDS_P = frozenset("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
#: Each of these is ended by the next of its group inside the same list or table.
SIBLINGS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr",), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
SCOPE = frozenset("ul ol dl table select".split())
#: Parts of class and id names that mark what is not the article, as pages use them (the list that readability tools are known for, in its general form).
UNLIKELY = frozenset(
    "ad ads advert advertisement adverts adsense alert banner breadcrumb breadcrumbs byline consent cookie cookies copyright dialog discussion disqus footer form gdpr header login masthead menu modal nav navbar navigation "
    "newsletter notice outbrain pager pagination popup promo recommend recommended related replies respond search share sharing shoutbox sidebar signup skip social sponsor sponsored subscribe taboola toolbar widget".split()
)
#: Those that mark readers' comments, which may well be longer than the article.
COMMENTS = frozenset("comment comments commentlist disqus replies respond shoutbox".split())
#: Those that are as often the anchor of a section of the article, where an id has them.
TOPICS = frozenset("alert banner byline dialog discussion form header login masthead notice recommend recommended related search share sharing skip social toolbar widget".split())
#: Behind one of these a name tells of the layout, not of the element's own part in it.
LAYOUT = frozenset("has have with without no not hide show".split())
LIKELY = frozenset("article articlebody body content entry hentry main page post story text".split())
ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split())

_NAMED = re.compile(r"/?([a-zA-Z][^\s/>]*)")
_STOP = re.compile("""[>"']""")
_ATTRIBUTE = re.compile(r"""([a-zA-Z-]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_NAME = re.compile(r"[a-z]+")
#: How an element's own marks speak against it: not, as an anchor may, as what isn't the article, as comments.
FREE, ANCHOR, APART, READERS = range(4)
#: A paragraph of prose has this many characters outside of links.
PROSE = 80
_SPACE = re.compile(r"\s+")
_ENDS = {name: re.compile(rf"</{name}\b[^>]*>", re.I) for name in RAW}
#: Elements open at once at most; deeper ones count as parts of the deepest, as in browsers.
DEPTH = 512
#: A list of links is a menu if its items are shorter than this on the average.
MENU_ITEM = 25


def tags(source: str) -> Iterator[tuple[str, str, str, str]]:
    """(text before it, "/" or nothing, name, attributes) of every tag, the last one nameless; in one pass, whatever is broken.

    A quote counts after an equals sign and needs a partner; a tag without an end
    is text, and so is all that follows it. What isn't found once is not
    searched again. Raw elements are passed over whole.
    """
    at = text = 0
    more = {">": True, '"': True, "'": True}

    def end(i: int) -> int:
        """Where the tag ends that began before i; -1 if it doesn't."""
        while more[">"]:
            m = _STOP.search(source, i)
            if not m:
                break
            i = m.start()
            c = source[i]
            if c == ">":
                return i
            i += 1
            if more[c] and source[max(0, i - 3) : i - 1].rstrip().endswith("="):
                close = source.find(c, i)
                if close < 0:
                    more[c] = False
                else:
                    i = close + 1
        more[">"] = False
        return -1

    while (at := source.find("<", at)) >= 0:
        if source.startswith("<!--", at):
            close = source.find("-->", at + 4)
            yield source[text:at], "", "", ""
            at = text = len(source) if close < 0 else close + 3
            continue
        m = _NAMED.match(source, at + 1)
        if not m and source[at + 1 : at + 2] not in ("!", "?", "/"):
            at += 1  # a sign of its own
            continue
        close = end(m.end() if m else at + 1)
        if close < 0:
            break
        yield source[text:at], "/" if source[at + 1] == "/" else "", m[1].lower() if m else "", source[m.end() : close] if m else ""
        at = text = close + 1
        if m and source[m.start()] != "/" and m[1].lower() in RAW:
            found = _ENDS[m[1].lower()].search(source, at)
            at = text = found.end() if found else len(source)
    yield source[text:], "", "", ""


def _own_words(names: str) -> set[str]:
    """Parts of class or id names, without those that only tell of the layout."""
    out = set()
    for name in names.split():
        for part in _NAME.findall(name):
            if part in LAYOUT:
                break
            out.add(part)
    return out


class Page:
    """A light tree of a page: of each element its tag, parent, weight and whether it can hold the article."""

    def __init__(self, source: str):
        self.tags, self.parents, self.weights, self.live, self.marks = [""], [0], [0.0], [True], [FREE]
        self.blocks: list[tuple[int, str, int]] = []  # element, text, characters in links
        self._open = [0]
        self._many: Counter[str] = Counter()  # open elements by name
        self._deep: Counter[str] = Counter()  # those beyond DEPTH
        self._text: list[str] = []
        self._linked = 0
        for text, closes, name, attributes in tags(source):
            self._add(text)
            if name in RAW or not name:
                continue
            if closes:
                self._close(name)
            else:
                self._start(name, attributes)
        self._flush()
        self._reject()

    def _add(self, text: str) -> None:
        if text and self.live[self._open[-1]]:
            text = html.unescape(text)
            self._text.append(text)
            if self._many["a"]:
                self._linked += len(text)

    def _flush(self) -> None:
        text = _SPACE.sub(" ", "".join(self._text)).strip()
        if text:
            at = len(self._open) - 1
            while self.tags[self._open[at]] in INLINE:
                at -= 1
            self.blocks.append((self._open[at], text, self._linked))
        self._text, self._linked = [], 0

    def _cut(self, at: int) -> None:
        """Elements from this place of the open ones on are closed."""
        for x in self._open[at:]:
            self._many[self.tags[x]] -= 1
        del self._open[at:]

    def _start(self, name: str, attributes: str) -> None:
        if name == "br":
            self._text.append(" ")
        if name in VOID:
            if name == "hr":
                self._flush()
            return
        if name not in INLINE:
            self._flush()
        if name in ENDS_P:
            self._end(("p",), ENDS_P - {"p"})
        if name in SIBLINGS:
            self._end(SIBLINGS[name], SCOPE)
        if len(self._open) >= DEPTH:
            self._deep[name] += 1
            return
        parent = self._open[-1]
        live, mark, weight = self._judge(name, attributes)
        self._many[name] += 1
        self.tags.append(name)
        self.parents.append(parent)
        self.weights.append(weight)
        self.live.append(self.live[parent] and live)
        self.marks.append(mark)
        self._open.append(len(self.tags) - 1)

    def _judge(self, name: str, attributes: str) -> tuple[bool, int, float]:
        """Whether it can hold text at all, what its names say against it, and its weight."""
        weight = {"article": 15.0, "main": 15.0, "section": 3.0, "div": 5.0, "blockquote": 3.0, "td": 3.0, "pre": 3.0, "header": 0.0}.get(name, 0.0)
        if name in NEVER or name == "header" and not (self._many["article"] or self._many["main"]):
            return False, FREE, weight
        mark = APART if name == "form" else FREE
        if not attributes.strip():
            return True, mark, weight
        found = {k.lower(): v.strip("\"'").lower() for k, v in _ATTRIBUTE.findall(attributes)}
        if "hidden" in found or found.get("aria-hidden") == "true" or found.get("role") in ROLES or re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", found.get("style", "")):
            return False, FREE, weight
        classes, anchor = _own_words(found.get("class", "")), _own_words(found.get("id", ""))
        good = (classes | anchor) & LIKELY
        return True, max(mark, self._mark(name, classes, anchor, good)), weight + 10.0 * bool(good)

    def _mark(self, name: str, classes: set[str], anchor: set[str], good: set[str]) -> int:
        bad = UNLIKELY | COMMENTS
        if name in ("html", "body", "main", "form"):
            return FREE
        if name in PARAGRAPH and name != "td":  # their ids are anchors, and a byline is a line of the article
            return READERS if classes & COMMENTS else APART if classes & bad - (TOPICS - {"alert", "banner", "notice"}) else FREE
        if (classes | anchor) & COMMENTS:
            return READERS
        if name == "article":
            return FREE
        of_class, of_id = classes & bad, anchor & bad
        if not (of_class or of_id) or good and of_class | of_id <= {"header", "byline", "share", "page"}:
            return FREE
        return APART if of_class or of_id - TOPICS else ANCHOR

    def _reject(self) -> None:
        """Decides on the elements whose names speak against them, and leaves out the text of those that go.

        One stays if the page's main element or its longest article is inside.
        It also stays if it has more text and more blocks of prose outside of
        links than all of the page that no name speaks against or that was taken
        before, those with most prose first, unless it is comments; and where an
        id only may be an anchor, if it reads as a section of prose. What stays
        holds all around it.
        Rejected text counts for nothing afterwards.
        """
        if not any(self.marks):
            return
        n = len(self.tags)
        under = [0] * n  # the nearest marked element from there up
        for x in range(1, n):
            under[x] = x if self.marks[x] else under[self.parents[x]]
        own = [0] * n  # characters outside of links: by the nearest marked element
        whole = [0] * n  # and by element, all below it
        prose, linked = Counter(), Counter()
        for node, text, links in self.blocks:
            plain = max(0, len(text) - links)
            own[under[node]] += plain
            whole[node] += plain
            prose[under[node]] += plain >= PROSE
            linked[under[node]] += min(links, len(text))
        for x in range(n - 1, 0, -1):
            whole[self.parents[x]] += whole[x]
        frames = [x for x in range(1, n) if self.tags[x] == "main" and self.live[x]]
        articles = [x for x in range(1, n) if self.tags[x] == "article" and self.live[x] and not any(self.marks[y] == READERS for y in self._line(x))]
        frames += [max(articles, key=lambda x: (whole[x], -x))] if articles else []
        inside = {y for x in frames for y in self._line(x)}
        marked = sorted((x for x in range(1, n) if self.marks[x] and self.live[x]), key=lambda x: (-prose[x], -own[x], x))
        free, told = own[0], prose[0]
        for x in marked:
            mark = self.marks[x]
            if x in inside or mark != READERS and own[x] > free and prose[x] > told or mark == ANCHOR and prose[x] > 1 and 3 * linked[x] < own[x]:
                inside.update(self._line(x))
                free, told = free + own[x], told + prose[x]
        for x in marked:
            self.live[x] = x in inside
        for x in range(1, n):
            self.live[x] = self.live[x] and self.live[self.parents[x]]
        self.blocks = [b for b in self.blocks if self.live[b[0]]]

    def _end(self, names: tuple[str, ...], scope: frozenset[str]) -> None:
        """Close the nearest open element of these names, unless one of scope is nearer."""
        if not any(self._many[n] for n in names):
            return
        for i in range(len(self._open) - 1, 0, -1):
            tag = self.tags[self._open[i]]
            if tag in names:
                self._flush()
                self._cut(i)
                return
            if tag in scope:
                return

    def _close(self, name: str) -> None:
        if name == "br":
            self._text.append(" ")
        if self._deep[name]:
            self._deep[name] -= 1
            if name not in INLINE:
                self._flush()
            return
        if not self._many[name]:
            return
        for i in range(len(self._open) - 1, 0, -1):
            if self.tags[self._open[i]] == name:
                if name not in INLINE or any(self.tags[x] not in INLINE for x in self._open[i:]):
                    self._flush()
                self._cut(i)
                return

    def article(self) -> str:
        """Blocks of what is taken whole around the best container, and of its siblings that pass, in page order, one a line.

        A paragraph earns a point, one for each comma and up to three for its
        length; all of them go to its parent, half to the grandparent and less
        to further ancestors. A container's sum and weight are discounted by its
        link density.
        """
        points: dict[int, float] = {}
        chars: dict[int, list[int]] = {}
        for node, text, linked in self.blocks:
            own = 1 + text.count(",") + min(len(text) / 100, 3)
            own *= 1 - min(1.0, linked / len(text))
            up = self.parents[node] if self.tags[node] in PARAGRAPH else node
            level = 0
            while True:
                points[up] = points.get(up, self.weights[up]) + own / (1, 2)[level] if level < 2 else points.get(up, self.weights[up]) + own / (3 * level)
                if not up:
                    break
                up, level = self.parents[up], level + 1
            up = node
            while True:
                sums = chars.setdefault(up, [0, 0])
                sums[0] += len(text)
                sums[1] += min(linked, len(text))
                if not up:
                    break
                up = self.parents[up]
        density = {n: b / a for n, (a, b) in chars.items()}
        score = {n: p * (1 - density[n]) for n, p in points.items()}
        best = max(score, key=lambda n: (score[n], -n), default=None)
        if best is None or density[best] >= 1:
            return ""
        whole = self._whole(best)
        chosen = {whole}
        sizes: Counter[int] = Counter()
        for node, text, _ in self.blocks:
            sizes[node] += len(text)
        if whole:
            for n in density:
                if n != whole and self.parents[n] == self.parents[whole] and self.live[n]:
                    headline = self.tags[n] in HEADINGS and self.tags[self.parents[n]] not in ("", "html", "body") and density[n] < 0.5
                    if headline or score.get(n, 0.0) >= max(10.0, 0.2 * score[best]) or self.tags[n] == "p" and density[n] < 0.25 and sizes[n] > 80:
                        chosen.add(n)
        menus = self._menus(density, whole, chosen)
        out = []
        for node, text, _ in self.blocks:
            inside, menu = not whole, False
            for up in self._line(node):
                menu = menu or up in menus
                inside = inside or up in chosen
            if inside and not menu:
                out.append(text)
        return "\n".join(out)

    def _menus(self, density: dict[int, float], whole: int, chosen: set[int]) -> set[int]:
        """Containers of links outside of the article whose items are as short as those of menus, unless the text leads up to them."""
        n_blocks: Counter[int] = Counter()
        chars: Counter[int] = Counter()
        for node, text, _ in self.blocks:
            for up in self._line(node):
                n_blocks[up] += 1
                chars[up] += len(text)
        told = self._told()
        found = set()
        for n, share in density.items():
            if self.tags[n] in ("ul", "ol", "div", "table", "td", "section") and share > 0.7 and n not in chosen and chars[n] < MENU_ITEM * n_blocks[n]:
                if n not in told and not any(self.tags[x] == "article" and whole in self._line(x) for x in self._line(n)):
                    found.add(n)
        return found

    def _told(self) -> set[int]:
        """Elements, and all above them inside the same container, that follow prose or a lower heading of that container: lists of an article's own links."""
        begun: set[int] = set()  # containers in which the text has begun
        out: set[int] = set()
        for node, text, linked in self.blocks:
            for up in self._line(node):
                if self.parents[up] in begun:
                    out.add(up)
            if self.tags[node] in HEADINGS - {"h1"} and 2 * linked < len(text) or self.tags[node] not in HEADINGS and len(text) - linked >= PROSE:
                begun.add(self.parents[node] if self.tags[node] in PARAGRAPH else node)
        return out

    def _whole(self, best: int) -> int:
        """The outermost article or main around the container; else its parent if nothing in that was rejected; else itself."""
        marked = [n for n in self._line(best) if self.tags[n] in ("article", "main")]
        if marked:
            return marked[-1]
        top = self.parents[best]
        under = [n == top for n in range(len(self.tags))]
        for n in range(top + 1, len(self.tags)):
            under[n] = under[self.parents[n]]
            if under[n] and not self.live[n] and self.tags[n] != "head":
                return best
        return top

    def _line(self, node: int) -> Iterator[int]:
        while node:
            yield node
            node = self.parents[node]


def extracted(source: str | None) -> str:
    """The main text of a page. Forms are left out, unless the page's text stands inside one, as on pages that are a form whole."""
    return Page(source).article() if source else ""


def _extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    common.alone("main text", lambda: None)
    for b in common.slices(batches, 64):
        texts = [extracted(h) for h in b.column("html").to_pylist()]
        yield pa.record_batch([b.column("_row"), pa.array(texts, pa.string())], ["_row", "text"])


def main_text(pages: DataFrame, *keep: str) -> DataFrame:
    """The columns keep of every row of pages with text, the main text of its html.

    The text is empty for null or empty html and for pages of links only.
    Repeated rows get equal texts, an empty table gives no rows, and a kept
    column called text is replaced. A page is read once, tag by tag, in time
    that grows with its length, also where quotes, tags or comments lack their
    end; open elements that HTML closes by itself are closed, others end with
    the page, and beyond DEPTH open ones no more are opened.
    """
    common.ship(pages.sparkSession)
    keep = tuple(c for c in keep if c != "text")
    rows = pages.select(F.struct(*(F.col(f"`{c}`") for c in keep)).alias("_row"), "html")
    out = T.StructType(list(rows.select("_row").schema.fields)).add("text", "string")
    return rows.mapInArrow(_extracted, out).select(*(F.col(f"_row.`{c}`").alias(c) for c in keep), "text")
