"""One HTML page as text blocks with the branch of the document tree each one hangs on (inside tasks)."""

from __future__ import annotations

import re
from html.parser import HTMLParser

#: Fixed values of HTML: elements without an end tag, elements inside a line, and what a start tag closes.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q rp rt ruby s samp small span strike strong "
                   "sub sup time tt u var wbr br img script style noscript template button label select textarea input svg iframe object "
                   "canvas audio video math map".split())
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",),
          "thead": ("tr", "td", "th"), "tbody": ("thead", "tbody", "tr", "td", "th"), "tfoot": ("tbody", "tr", "td", "th")}
SCOPES = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("table", "tr"), "th": ("table", "tr"),
          "thead": ("table",), "tbody": ("table",), "tfoot": ("table",), "option": ("select",)}
ENDS_PARAGRAPH = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
                           "header hgroup hr main menu nav ol p pre search section table ul li".split())
#: Branches that never hold main text, by element, role, and word in a class or id.
NO_TEXT = frozenset("script style noscript template head title nav footer aside form button select option textarea input label iframe object svg "
                    "math canvas audio video map dialog menu search fieldset datalist".split())
NO_ROLE = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar toolbar form status tablist".split())
NO_CLASS = frozenset("ad ads adv advert adverts advertisement advertising adsense adslot adbox sponsor sponsored sponsors promo promos promotion banner nav navbar "
                     "navigation menu menus breadcrumb breadcrumbs sidebar sidebars aside footer foot masthead topbar cookie cookies consent gdpr notice "
                     "notices notification popup modal overlay newsletter subscribe subscription signup share sharing social related recommended "
                     "recommendations comment comments commentlist disqus discussion reply replies respond pagination pager search searchbox login "
                     "toolbar widget widgets skip alert alerts paywall feedback copyright subnav topnav sidenav megamenu popover lightbox "
                     "disclaimer leaderboard skyscraper".split())
#: Outside of the article a header is the site's.
OUTSIDE = NO_CLASS | {"header"}
#: Words that take out even an article element: what readers say about the article is marked up as one.
COMMENTS = frozenset("comment comments commentlist reply replies".split())
#: Words that say nothing beside a word of that list: sidebar-primary is a sidebar, content-sidebar-wrap need not be one.
NEUTRAL = frozenset("area bar block box bottom btn button buttons col column container group inner item items left link links list outer page post posts "
                    "primary right secondary section site thread top wrap wrapper".split())
#: Elements in which an article's own text flows: inside an article no name takes them out.
FLOW = frozenset("h1 h2 h3 h4 h5 h6 p li td th dt dd blockquote section pre figure figcaption".split())
#: First words of class names that say how a page is laid out, not what a branch is.
LAYOUT = frozenset("has with no without is hide show".split())
MAIN_CLASS = frozenset("article articlebody post entry story content maincontent main".split())
#: Elements without main text of their own that may yet be wrapped around an article.
WRAPPERS = frozenset("nav form header fieldset".split())
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
_DIGITS = re.compile(r"\d+")
_BLANK = re.compile(r"\s+")
_INVISIBLE = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)

#: How surely a branch is the article: an article element, a main element, either of them in a branch that its name would take
#: out, a class that says so, nothing, or a name that takes the branch out. Only the surest blocks of a page are kept.
ARTICLE, MAIN, NAMED, ANY, OUT = 5, 4, 1, 0, -1
HELD = 2


def _words(*names: str | None) -> list[str]:
    """The words of class names and ids, and neighbours run together, so that side-bar and sideBar read as sidebar."""
    out = []
    for name in " ".join(n for n in names if n).split():
        found = [w.lower() for w in _WORD.findall(name)]
        if found and found[0] not in LAYOUT:
            out += found + [a + b for a, b in zip(found, found[1:])]
    return out


def _out(out_words: frozenset[str], *names: str | None) -> bool | None:
    """True where a class or id says no more than that a branch is not main text, None where it says so among other words."""
    doubt = False
    for name in " ".join(n for n in names if n).split():
        found = [w.lower() for w in _WORD.findall(name)]
        if not found or found[0] in LAYOUT:
            continue
        listed = {i for i, w in enumerate(found) if w in out_words}
        listed |= {j for i, (a, b) in enumerate(zip(found, found[1:])) if a + b in out_words for j in (i, i + 1)}
        if listed:
            if all(i in listed or w in NEUTRAL or w.isdigit() for i, w in enumerate(found)):
                return True
            doubt = True
    return None if doubt else False


class _Element:
    __slots__ = ("tag", "path", "dropped", "level", "inline", "held", "article", "children")

    def __init__(self, tag, path, dropped, level, inline, held, article=None):
        self.tag, self.path, self.dropped, self.level, self.inline, self.held = tag, path, dropped, level, inline, held
        self.article = article  # the outermost article element around it: its path and its number on the page
        self.children: list[str] = []


class _Reader(HTMLParser):
    """Keeps the open elements; text collects until a block starts or ends."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.open = [_Element("", "", False, ANY, False, False)]
        self.text: list[str] = []
        self.blocks: list[tuple[str, int, str, tuple[str, int] | None]] = []
        self.articles = 0
        self.nodes: list[tuple[str, str]] = []

    def flush(self):
        if self.text:
            text = _BLANK.sub(" ", "".join(self.text)).strip()
            self.text = []
            if text:
                at = self.block()
                if not at.dropped:
                    self.blocks.append((at.path, at.level, text, at.article))

    def close_to(self, i):
        if any(not e.inline for e in self.open[i:]):
            self.flush()
        for e in self.open[i:]:
            if not e.inline and not e.dropped:
                runs = [c for n, c in enumerate(e.children) if n == 0 or c != e.children[n - 1]]
                self.nodes.append((e.path, ",".join(runs)))
        del self.open[i:]

    def close_implied(self, tag):
        if tag in ENDS_PARAGRAPH:
            for i in range(len(self.open) - 1, 0, -1):
                if self.open[i].tag == "p":
                    self.close_to(i)
                    break
                if not self.open[i].inline:
                    break
        if tag in CLOSES:
            for i in range(len(self.open) - 1, 0, -1):
                if self.open[i].tag in SCOPES[tag]:
                    break
                if self.open[i].tag in CLOSES[tag]:
                    self.close_to(i)
                    break

    def handle_starttag(self, tag, attrs):
        if tag in VOID:
            if tag == "br":
                self.text.append(" ")
            elif tag not in INLINE:
                self.close_implied(tag)
                self.flush()
            return
        self.close_implied(tag)
        inline = tag in INLINE
        if not inline:
            self.flush()
        parent = self.open[-1]
        named = dict(attrs)
        names = named.get("class"), named.get("id")
        words = _words(*names)
        level = self._level(tag, named, words)
        # No name takes out the article, what it flows in, or the page; but an article element may be a reader's comment, and one that is
        # named as a teaser, say, comes behind all others.
        out, behind = False, False
        if tag == "article" and words:
            behind = _out(NO_CLASS, *names) is True
            if _out(COMMENTS, *names) is True:
                level, out = ANY, True
        elif words and level < MAIN and tag not in ("html", "body") and not (parent.level > ANY and tag in FLOW):
            out = _out(NO_CLASS if parent.level > ANY else OUTSIDE, *names)
        # The mark leaves a branch to its entropy, with a higher bar.
        label = tag + ("." + _DIGITS.sub("", "-".join(words[:3])) if words else "") + ("?" if out is None else "")
        up = self.block()
        path = up.path if inline else f"{up.path}/{label}"
        dropped, held = self._dropped(tag, named), parent.held or out is True or behind
        if parent.dropped and not dropped:
            # An article stays the article where an unclosed menu, a page-wide form or a header holds it.
            outer = [e.tag for e, above in zip(self.open[1:], self.open) if e.dropped and not above.dropped]
            dropped = not (level >= MAIN and outer[-1] in WRAPPERS)
        if dropped:
            level = parent.level
        elif level >= MAIN:
            level = max(parent.level, level - HELD if held else level)
        elif out is True or parent.level == OUT:
            level = OUT
        else:
            level = max(parent.level, level)
        if not inline:
            up.children.append(label)
        article = parent.article
        if article is None and tag == "article" and level > ANY:
            self.articles += 1
            article = (path, self.articles)
        self.open.append(_Element(tag, path, dropped, level, inline, held, article))

    def block(self) -> _Element:
        return next(e for e in reversed(self.open) if not e.inline)

    def _dropped(self, tag, named) -> bool:
        if tag in NO_TEXT or "hidden" in named or (named.get("aria-hidden") or "").lower() == "true":
            return True
        if (named.get("role") or "").lower() in NO_ROLE or _INVISIBLE.search(named.get("style") or ""):
            return True
        return tag == "header" and self.open[-1].level <= ANY

    @staticmethod
    def _level(tag, named, words) -> int:
        if tag == "article" or (named.get("itemprop") or "").lower() == "articlebody":
            return ARTICLE
        if tag == "main" or (named.get("role") or "").lower() in ("main", "article"):
            return MAIN
        return NAMED if tag in ("div", "section", "td") and not MAIN_CLASS.isdisjoint(words) else ANY

    def handle_endtag(self, tag):
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].tag == tag:
                self.close_to(i)
                return
            if tag in INLINE and not self.open[i].inline:
                break  # an inline end tag does not close a block
        if tag == "p":
            self.flush()

    def handle_data(self, data):
        e = self.open[-1]
        if not e.dropped and not (e.inline and e.level == OUT and self.block().level > OUT):
            self.text.append(data)


def parse(html: str | None) -> tuple[list[tuple[str, int, str, tuple[str, int] | None]], list[tuple[str, str]]]:
    """Blocks (path, level, text, outermost article) in page order and nodes (path, runs of children); empty for a null page."""
    reader = _Reader()
    reader.feed(html or "")
    reader.close()
    reader.close_to(1)
    reader.flush()
    return reader.blocks, reader.nodes
