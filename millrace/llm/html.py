"""Main text of web pages by tag-path ratios.

A page is read into blocks of text, each with its path of tags from the root. For every
path, text without links and punctuation are counted per block; both ratios are smoothed
over the tree of paths, fused, and the paths above a share of the best are content. The
element that holds most of their text is the content node; all below it stays, whatever its path.
Parts of a page that say what they are by their tag or role (navigation, footer, fields and
so on) never become blocks, nor do forms that are short or made of fields. Parts that say so by name
are left out if the whole name is such a word, unless they hold a main part or nothing else is left;
a name that merely contains the word weighs less. Tags and names that are used of parts of an article
as well (an aside in it, the header of a section, a widget) decide only outside the content node.
"""

from __future__ import annotations

import html as entities
import math
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StringType

# HTML's elements by what they mean for text.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe template xmp noembed noframes svg".split())
MATH = frozenset(
    "math mrow mi mo mn ms mtext mspace mfrac msqrt mroot mstyle merror mpadded mphantom menclose mfenced msub msup msubsup "
    "munder mover munderover mmultiscripts mprescripts none mtable mtr mlabeledtr mtd maction semantics annotation annotation-xml".split()
)
APART = frozenset("mfrac mroot msub msup msubsup munder mover munderover mmultiscripts mtr mlabeledtr mtable".split())  # 1 2 is not 12
INLINE = MATH | frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr img br".split()
)
CELLS = frozenset("td th".split())  # cells of a row are one block
LEFT_OUT = frozenset(
    "head nav footer aside button select annotation annotation-xml datalist object canvas video audio dialog menu map frameset applet".split()
)
ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar toolbar".split())
# Words of class and id.
SIDE_WORDS = frozenset(
    "nav navbar navigation menu menus submenu breadcrumb breadcrumbs pagination pager topbar toolbar masthead footer foot "
    "sidebar sidebars rail aside widget widgets related recommended recommendations trending popular teaser teasers "
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored sponsors promo promos promotion banner banners "
    "cookie cookies consent gdpr notice notices notification notifications alert alerts disclaimer popup modal overlay paywall "
    "share sharing social follow newsletter subscribe subscription signup login signin search form "
    "comment comments commentlist reply replies respond disqus feedback".split()
)
HEADER_WORDS = frozenset("header head".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
LEAVES = HEADINGS | frozenset("p li dt dd pre blockquote figcaption caption td th tr".split())  # elements of text, not parts of a page
SOFT_WORDS = frozenset("widget widgets rail overlay modal".split())  # decide only outside the content node
QUOTES = frozenset("blockquote figure".split())  # their footer says who spoke
LISTS = frozenset("ul ol dl menu dir table thead tbody tfoot".split())
MAIN_TAGS = frozenset("article main".split())
MAIN_WORDS = frozenset("article main content post entry story maincontent".split())
PUNCTUATION = re.compile(r"[.,;:!?…。、，；：！？؟،]")

# What a start tag closes when it is open, up to the nearest of the elements behind it.
BLOCK_LIST = ("ul", "ol", "menu", "dir")
CLOSES = {
    "li": (("li",), BLOCK_LIST), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr",), ("table",)), "td": (("td", "th"), ("tr", "table")), "th": (("td", "th"), ("tr", "table")),
    "tbody": (("thead", "tbody", "tfoot"), ("table",)), "tfoot": (("thead", "tbody", "tfoot"), ("table",)),
    "option": (("option",), ("select",)),
}

MAIN_WEIGHT, SIDE_WEIGHT, LEAST_SHARE, FADING = 10.0, 0.3, 0.2, 0.5
# Shares of the unlinked text from which main parts weigh more: by their tag, or with those by name.
TAG_SHARE, NAME_SHARE = 1 / 3, 1 / 2
SIDE_SHARE = 1 / 3  # a part with more of the page's unlinked text is no side part, whatever its name contains

# A form is kept if it has so many characters outside links, or half of the page's, and so many for each field.
FORM_TEXT, FIELD_TEXT = 250, 40
NODE_SHARE = 0.8  # of the chosen text that the content node holds
LINK_SHARE = 0.5  # of the text of a soft part that may be links
# How an element is left out: not at all, weighing less, as a form, by its name, outside the content node
# (by its name or by its tag), for good.
KEPT, WEAK, FORM, NAMED, SOFT, SOFT_TAG, GONE = range(7)
# What made a path a main part: nothing, its tag or role, the name of a part, the name of one block.
NONE, TAG, NAME, LEAF = range(4)

MARKUP = re.compile(
    r"<!--(?:>|->|.*?(?:--!?>|\Z))"
    # a quote opens a value only after an equals sign; any other is part of a name, and the tag ends at its >
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+'|[^\s>\"'][^\s>]*+|))*+)(?:>|\Z)"
    r"|<[!?/][^>]*(?:>|\Z)",
    re.S,
)
ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>][^\s>]*))")
WORDS = re.compile(r"[a-z]+|[A-Z]+(?![a-z])|[A-Z][a-z]*")
# What ends an svg, or shows that it was never closed: elements of a page, outside foreignObject.
SVG = re.compile(
    r"</svg(?=[\s/>]|\Z)[^>]*(?:>|\Z)|<foreignObject(?=[\s/>])"
    r"|</?(?:p|div|h[1-6]|ul|ol|li|dl|dt|dd|table|tbody|tr|td|th|pre|blockquote|section|article|main|aside|nav|header|footer|form"
    r"|button|label|span|b|i|em|strong|code|center|figure|hr|br|img|body|html)(?=[\s/>])",
    re.I,
)
FOREIGN_END = re.compile(r"</foreignObject\s*>", re.I)
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


def _part(tag: str, attributes: str, in_main: bool, soft: bool) -> tuple[int, int, bool]:
    """How an element is left out, what makes it a main part, and whether what holds it is to stay.

    ``soft`` elements are left out by their tag only outside the content node.
    """
    left_out = tag in LEFT_OUT or (tag == "header" and not in_main)
    if left_out and not soft:
        return GONE, NONE, False
    if left_out and (not attributes or attributes.isspace()):
        return SOFT_TAG, NONE, False
    if not attributes or attributes.isspace():
        main = tag in MAIN_TAGS
        return FORM if tag == "form" else KEPT, TAG if main else NONE, main
    found = {m[1].lower(): entities.unescape(m[2] or m[3] or m[4] or "") for m in ATTRIBUTE.finditer(attributes)}
    if re.search(r"(?:^|\s)hidden(?:\s|=|/|$)", ATTRIBUTE.sub(" ", attributes)) or "hidden" in found:
        return GONE, NONE, False
    if found.get("aria-hidden", "").lower() == "true" or HIDDEN.search(found.get("style", "")):
        return GONE, NONE, False
    role = found.get("role", "").lower()
    if role in ROLES:
        return GONE, NONE, False
    if tag in ("html", "body"):
        return KEPT, NONE, False
    if left_out:
        names = set(f"{found.get('class', '')} {found.get('id', '')}".lower().split())
        return (GONE if names & SIDE_WORDS else SOFT_TAG), NONE, False
    form = tag == "form" or role == "form"
    of_class, of_id = found.get("class", ""), found.get("id", "")
    whole = set(f"{of_class} {of_id}".lower().split())
    if form:
        return NAMED if whole & SIDE_WORDS - {"form"} else FORM, NONE, False
    named = {w.lower() for w in WORDS.findall(f"{of_class} {of_id}")}
    if tag == "main" or role == "main":
        return KEPT, TAG, True
    if tag == "article" or role == "article":  # "comments-open" is said of an article, "comment" says what it is
        if whole & SIDE_WORDS:
            return NAMED, TAG, False
        return KEPT, TAG, not named & SIDE_WORDS or bool(named & MAIN_WORDS)
    main = NONE if tag in INLINE or not named & MAIN_WORDS else LEAF if tag in LEAVES else NAME
    if tag in INLINE or tag in HEADINGS:
        return KEPT, main, False
    header = HEADER_WORDS if not in_main and not main else frozenset()
    if whole & SIDE_WORDS or whole & header:
        return (NAMED if whole & (SIDE_WORDS | header) - SOFT_WORDS else SOFT), main, False
    if tag in LEAVES:
        return KEPT, main, False
    if tag == "section" or in_main:  # an id made of words is the address of what is said there
        named = {w.lower() for w in WORDS.findall(of_class)}
    return (WEAK if named & SIDE_WORDS or named & header else KEPT), main, False


Block = tuple[int, str, int, int, int]  # path, text, characters in links, the nearest of names or -1, element


class _Page:
    """Blocks of a page in order."""

    def __init__(self) -> None:
        self.parent, self.child = [-1], {}  # the tree of paths; 0 is the root
        self.main_path, self.weak_path = [NONE], [False]
        # the tree of elements: the one around, the tag, what makes it a main part by itself; 0 is the page
        self.around, self.tags, self.marks = [-1], [""], [NONE]
        # elements left out by name and forms: the one around it, whether it holds a main part, fields of a form or None, how
        self.names: list[list] = []
        self.blocks: list[Block] = []
        # open elements: tag, path, gone, main part, link, nearest of names, element
        self.open: list[tuple[str, int, bool, int, bool, int, int]] = [("", 0, False, NONE, False, -1, 0)]
        self.count: dict[str, int] = {}
        self.text: list[str] = []
        self.linked = 0

    def flush(self) -> None:
        if self.text:
            text = " ".join(entities.unescape("".join(self.text)).split())
            if text:
                top = self.open[-1]
                self.blocks.append((top[1], text, min(self.linked, len(text)), top[5], top[6]))
            self.text, self.linked = [], 0

    def add(self, raw: str) -> None:
        top = self.open[-1]
        if not top[2]:
            self.text.append(raw)
            if top[4]:
                self.linked += len(raw)

    def start(self, tag: str, attributes: str) -> None:
        if tag == "br" or tag in CELLS or (tag in MATH and self.open[-1][0] in APART):
            self.add(" ")
        elif tag not in INLINE:
            self.flush()
        if tag in CLOSES:
            which, until = CLOSES[tag]
            self.close(which, until)
        if tag not in INLINE and self.count.get("p"):
            self.close(("p",), ("article", "section", "td", "th", "button", "table", "blockquote", "li", "div"))
        if tag in ("input", "select", "button"):
            self.field(attributes)
        if tag in VOID or (tag in MATH and attributes.endswith("/")):
            return
        _, path, out, main, link, name, element = self.open[-1]
        how = here = KEPT
        if not out and not (tag == "footer" and self.quoted()):
            how, here, holds = _part(tag, attributes, bool(main), self.soft(tag))
            # the tag says more than a name, a part more than a block
            out, main = how == GONE, min(main, here) if main and here else main or here
            if tag == "label" and self.form() >= 0:
                how, out = GONE, True
            if holds:
                self.stay(name)
            if how in (FORM, NAMED, SOFT, SOFT_TAG):
                self.flush()
                self.names.append([name, False, 0 if how == FORM else None, how])
                name = len(self.names) - 1
        if tag not in INLINE and tag not in CELLS and not out:
            key = (path, tag, main, how)
            if key not in self.child:
                self.child[key] = len(self.parent)
                self.parent.append(path)
                self.main_path.append(main)
                # None: a main element is never part of a weak one
                self.weak_path.append(None if tag == "main" else how in (WEAK, FORM, NAMED, SOFT, SOFT_TAG))
            path = self.child[key]
            self.around.append(element)
            self.tags.append(tag)
            self.marks.append(here)
            element = len(self.around) - 1
        self.open.append((tag, path, out, main, link or tag == "a", name, element))
        self.count[tag] = self.count.get(tag, 0) + 1

    def soft(self, tag: str) -> bool:
        """Whether a tag that says what a part is may be used of a part of the article here."""
        if tag == "aside":
            return bool(self.count.get("article"))
        if tag == "header":
            return bool(self.count.get("section"))
        return tag == "object"

    def quoted(self) -> bool:
        """Whether a quotation or figure is the nearest part around."""
        for tag, *_ in reversed(self.open):
            if tag in QUOTES or tag in ("article", "section", "main", "aside", "div", "body"):
                return tag in QUOTES
        return False

    def stay(self, name: int) -> None:
        """Elements left out by name that hold a main part are to stay."""
        while name >= 0 and not self.names[name][1]:
            self.names[name][1] = True
            name = self.names[name][0]

    def form(self) -> int:
        """The nearest form around, or -1."""
        name = self.open[-1][5]
        while name >= 0 and self.names[name][2] is None:
            name = self.names[name][0]
        return name

    def field(self, attributes: str) -> None:
        form = self.form()
        if form >= 0 and not re.search(r"type\s*=\s*[\"']?hidden", attributes, re.I):
            self.names[form][2] += 1

    def staying(self, by_name: bool) -> list[bool]:
        """Which of names stay, the page last: forms that are neither short nor made of fields and, unless ``by_name``, what is left out by name."""
        held = [0] * (len(self.names) + 1)
        for _, text, link, name, _ in self.blocks:
            held[name] += len(text) - link
        whole, stay = sum(held), [True] * len(held)
        for i in range(len(self.names) - 1, -1, -1):
            around, main, fields, how = self.names[i]
            if fields is None:
                stay[i] = main or not (by_name or how == SOFT_TAG)
            else:
                stay[i] = main or (held[i] >= FIELD_TEXT * fields and 0 < min(FORM_TEXT, whole / 2) <= held[i])
            if stay[i]:
                held[around] += held[i]
        for i, (around, *_) in enumerate(self.names):
            stay[i] = stay[i] and stay[around]
        return stay

    def soft_parts(self, stay: list[bool]) -> list[bool]:
        """Which of names would stay inside the content node: soft ones that are not mostly links."""
        held, linked = [0] * len(stay), [0] * len(stay)
        for _, text, link, name, _ in self.blocks:
            while name >= 0:
                held[name] += len(text)
                linked[name] += link
                name = self.names[name][0]
        kept = list(stay)
        for i, (around, *_, how) in enumerate(self.names):
            kept[i] = kept[around] and (stay[i] or (how in (SOFT, SOFT_TAG) and linked[i] < LINK_SHARE * held[i]))
        return kept

    def close(self, which: tuple[str, ...], until: tuple[str, ...]) -> None:
        """Close the nearest open element of ``which`` unless one of ``until`` is nearer."""
        if not any(self.count.get(t) for t in which):
            return
        for i in range(len(self.open) - 1, 0, -1):
            tag = self.open[i][0]
            if tag in which:
                self.cut(i)
                return
            if tag in until:
                return

    def cut(self, i: int) -> None:
        if self.open[-1][5] != self.open[i - 1][5]:
            self.flush()
        for tag, *_ in self.open[i:]:
            self.count[tag] -= 1
        del self.open[i:]

    def end(self, tag: str) -> None:
        if tag not in INLINE and tag not in CELLS:
            self.flush()
        elif tag in CELLS:
            self.add(" ")
        if self.count.get(tag):
            i = len(self.open) - 1
            while self.open[i][0] != tag:
                # an inline end tag does not close blocks
                if tag in INLINE and self.open[i][0] not in INLINE:
                    return
                i -= 1
            self.cut(i)


def _after_svg(page: str, at: int, last: int) -> int:
    """Where an svg ends; ``last`` is the last end of a foreignObject."""
    while m := SVG.search(page, at):
        if m[0][:5].lower() == "</svg":
            return m.end()
        if m[0].lower() != "<foreignobject":
            return m.start()
        at = FOREIGN_END.search(page, m.end()).end() if m.end() <= last else m.end()
    return len(page)


def read(page: str) -> _Page:
    """The blocks of a page."""
    found, at, end, last = _Page(), 0, len(page), None
    while at < end:
        m = MARKUP.search(page, at)
        if m is None:
            found.add(page[at:])
            break
        if m.start() > at:
            found.add(page[at : m.start()])
        at = m.end()
        if not m[2]:
            continue
        tag, closing, attributes = m[2].lower(), m[1], m[3]
        if closing:
            found.end(tag)
        elif tag == "svg":
            if not attributes.endswith("/"):
                if last is None:
                    last = max((f.start() for f in FOREIGN_END.finditer(page)), default=-1)
                at = _after_svg(page, at, last)
        elif tag in RAW:
            if tag == "textarea":
                found.field(attributes)
            stop = re.compile(f"</{tag}(?=[\\s/>]|\\Z)[^>]*(?:>|\\Z)", re.I).search(page, at)
            at = stop.end() if stop else end
        else:
            found.start(tag, attributes)
    found.flush()
    return found


def _smooth(values: list[float], parent: list[int]) -> list[float]:
    """Each value, or a neighbour's faded with the steps between them in the tree, whichever is more."""
    out = list(values)
    for i in range(len(out) - 1, 0, -1):
        out[parent[i]] = max(out[parent[i]], out[i] * FADING)
    for i in range(1, len(out)):
        out[i] = max(out[i], out[parent[i]] * FADING)
    return out


def _weak(found: _Page, blocks: list[Block]) -> list[bool]:
    """Which paths weigh less: below a name that contains a side word, without much of the text."""
    held = [0] * len(found.parent)
    for path, text, link, *_ in blocks:
        held[path] += len(text) - link
    for i in range(len(held) - 1, 0, -1):
        held[found.parent[i]] += held[i]
    weak = [False] * len(held)
    for i in range(1, len(held)):
        own = found.weak_path[i]
        weak[i] = own is not None and (weak[found.parent[i]] or (own and held[i] < SIDE_SHARE * held[0]))
    return weak


def _main(found: _Page, blocks: list[Block], weak: list[bool]) -> bool:
    """Whether main parts hold enough of the unlinked text to weigh more.

    Blocks that are marked by themselves, and a named part of a single block, do not count.
    """
    top, held, count = list(range(len(found.parent))), [0] * len(found.parent), [0] * len(found.parent)
    for i in range(1, len(top)):
        if found.main_path[i] == found.main_path[found.parent[i]] != NONE:
            top[i] = top[found.parent[i]]
    whole = 0
    for path, text, link, *_ in blocks:
        if not weak[path]:
            whole += len(text) - link
            held[top[path]] += len(text) - link
            count[top[path]] += 1
    tags = sum(h for h, m in zip(held, found.main_path) if m == TAG)
    names = sum(h for h, m, c in zip(held, found.main_path, count) if m == NAME and c > 1)
    return bool(tags + names) and (tags >= TAG_SHARE * whole or tags + names >= NAME_SHARE * whole)


def _scores(found: _Page, all_blocks: list[Block], weak: list[bool]) -> tuple[list[float], float]:
    """The fused ratio of every path, and the share of the best that content paths reach."""
    n = len(found.parent)
    heavy = _main(found, all_blocks, weak)
    blocks, length, linked, marks = [0] * n, [0] * n, [0] * n, [0] * n
    for path, text, link, *_ in all_blocks:
        blocks[path] += 1
        length[path] += len(text)
        linked[path] += link
        marks[path] += len(PUNCTUATION.findall(text))
    text_ratio = _smooth([(t - k) / b if b else 0.0 for t, k, b in zip(length, linked, blocks)], found.parent)
    mark_ratio = _smooth([m / b if b else 0.0 for m, b in zip(marks, blocks)], found.parent)
    fused = []
    for i in range(n):
        share = linked[i] / length[i] if length[i] else 0.0
        weight = (MAIN_WEIGHT if heavy and found.main_path[i] else 1.0) * (SIDE_WEIGHT if weak[i] else 1.0)
        # no punctuation anywhere still leaves the text ratio
        fused.append(weight * (1 - share) ** 2 * math.log1p(text_ratio[i]) * math.log1p(0.5 + mark_ratio[i]))
    # a block that is marked by itself does not set the bound for others
    bound = [f for f, b, m in zip(fused, blocks, found.main_path) if b and not (heavy and m == LEAF)]
    return fused, LEAST_SHARE * max(bound)


def _content_node(found: _Page, chosen: list[Block]) -> tuple[int, bool]:
    """The element that holds most of the chosen text, or -1, and whether it is marked as a main part.

    Of all that do, it is the innermost that is an article by its tag, else by its name; without either the
    innermost that is more than a piece of text or a list, and less than the whole page.
    """
    held = [0] * len(found.around)
    for _, text, link, _, element in chosen:
        held[element] += len(text) - link
    for i in range(len(held) - 1, 0, -1):
        held[found.around[i]] += held[i]
    most = [0]
    for i in range(1, len(held)):
        if found.around[i] == most[-1] and held[i] >= NODE_SHARE * held[0] > 0:
            most.append(i)
    for mark in (TAG, NAME):
        marked = [i for i in most if found.marks[i] == mark]
        if marked:
            return marked[-1], True
    node = most[-1]
    while found.tags[node] in LEAVES or found.tags[node] in LISTS:
        node = found.around[node]
    return (-1 if found.tags[node] in ("", "html", "body", "form") else node), False


def _content(found: _Page, by_name: bool) -> list[str]:
    """The texts of the blocks whose path reaches a share of the best, and of those below the content node."""
    stay = found.staying(by_name)
    blocks = [b for b in found.blocks if stay[b[3]]]
    if not blocks:
        return []
    weak = _weak(found, blocks)
    fused, least = _scores(found, blocks, weak)

    def reaches(block: Block) -> bool:
        return stay[block[3]] and fused[block[0]] >= least and fused[block[0]] > 0

    node, marked = _content_node(found, [b for b in blocks if reaches(b)])
    inside = [i == node for i in range(len(found.around))]
    for i in range(1, len(inside)):
        inside[i] = inside[i] or inside[found.around[i]]
    soft = found.soft_parts(stay)

    def below(block: Block) -> bool:
        path, text, link, name, element = block
        if not inside[element] or not soft[name]:
            return False
        # a part that only its name makes doubtful has to reach the bound; a menu without a name is links alone
        return not (stay[name] and weak[path]) and (marked or link < len(text))

    return [b[1] for b in found.blocks if reaches(b) or below(b)]


def main_text(page: str | None) -> str:
    """The blocks of the content, in page order, joined by two line feeds.

    What is left out by name counts only if nothing else is found.
    """
    if not page:
        return ""
    found = read(page)
    return "\n\n".join(_content(found, True) or _content(found, False))


@F.pandas_udf(StringType())
def main_text_of(pages: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for part in pages:
        yield pd.Series([main_text(p) for p in part], dtype=object)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars for every page.

    A null or empty page, or one without content, has the empty text. Repeated rows get
    equal texts; other columns are left out.
    """
    found = pages.select("page_id", "url", main_text_of("html").alias("text"))
    return found.withColumn("n_chars", F.length("text").cast("long"))
