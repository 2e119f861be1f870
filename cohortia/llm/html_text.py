"""Main text of web pages by composite text density.

A page becomes a tree of elements. Elements that are never part of an article
(menus, headers, footers, side bars, forms, scripts) are cut off first, and so
are those whose whole class names say advert, side bar or reader comments. For
every node that is left, with its characters C, tags T (formulas count as one),
link characters L and link tags K:

    density = C / T * log_b(C / L * T / K),  b = ln(C / (C - L) * L + page's L / C * C + e)

so text in few tags counts for much and text in links for little. A node's sum
is that of its children's densities, and the largest sum marks the article. The
lowest density on the path from the body to it is the threshold for what else
belongs to the article: below an ``article`` or ``main`` element that encloses
the node all of it, elsewhere the largest-sum subtrees of the nodes that reach
the threshold. Beside an ``article`` element, its neighbours below ``main`` that
reach the threshold or hold no links belong to it too, and so do neighbouring
``article`` elements that reach it and the heading right before it. Of a header
within an article only the headings count.

Reader comments may have names that tell nothing. Neighbours of one tag that each
name an author and a date are taken for comments, unless the largest sum lies in them.

Class names that are everyday words too (share, notice, header), and ids, cut an
element off only if its density stays below that threshold as well. Ids below
an article or main element are anchors and say nothing, nor do names of headings.

Each page is read on its own in one pass over its characters; there is no
shuffle, and memory is bounded by the longest page.
"""

from __future__ import annotations

import html
import math
import re

import pyarrow as pa
from pyspark.sql import DataFrame

# Names of elements, roles and classes.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe noembed noframes noscript xmp template svg".split())
HEAD = frozenset("base basefont bgsound link meta title style script noscript template".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre search "
    "section summary table tbody td tfoot th thead tr ul".split()
)
CLOSES_P = BLOCK - frozenset("body caption dd dt html legend option tbody td tfoot th thead tr".split()) | {"dd", "dt"}
SCOPE = frozenset("body button caption html object table td th".split())
#: A start tag closes an open element of the first set, unless one of the second is nearer.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select"}),
    "tr": ({"tr"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"thead", "tbody", "tfoot"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot"}, {"table"}),
}
OFF_TAGS = frozenset(
    "head nav header footer aside form script style textarea title iframe noembed noframes noscript xmp template svg "
    "annotation annotation-xml button select option input dialog menu search object canvas audio video map datalist".split()
)
OFF_ROLES = frozenset(
    "navigation banner contentinfo complementary search dialog alertdialog alert menu menubar form toolbar tooltip".split()
)
#: Class names that no part of an article has.
OFF_CLASSES = frozenset(
    "ad ads adv advert adverts advertisement adsense adsbygoogle sponsor sponsored nav navbar breadcrumb breadcrumbs "
    "topbar footer sidebar cookie cookies gdpr newsletter comments disqus".split()
)
#: Names that parts of an article may have too: these count only on thin elements.
DOUBTFUL = frozenset(
    "promo promotion navigation menu header masthead aside consent notice notices notification popup modal overlay "
    "subscribe subscription signup login comment respond replies social share sharing related recommended pagination "
    "pager toolbar widget skip".split()
)
#: What longer names, such as cookie-banner or related-posts, consist of besides.
BESIDES = frozenset(
    "site main page top bottom left right primary secondary global list area box bar banner container wrapper wrap "
    "slot block links link buttons icons posts articles thread google".split()
)
#: Times that a threshold is taken anew after thick elements of doubtful names have come back; the last settles all.
ROUNDS = 8
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Names of what a comment says of its author and its time, and the elements that hold one comment.
AUTHOR = frozenset("author user username commenter avatar byline vcard nickname poster".split())
DATE = frozenset("date time datetime timestamp posted published ago".split())
COMMENTS = frozenset("li div article section dd".split())
#: Elements that hold an article; no class name cuts them off, or what contains them.
HOLDERS = frozenset({"html", "body", "main", "article"})

TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*)([^>"']*(?:"[^"]*"[^>"']*|'[^']*'[^>"']*)*)>""")
PLAIN_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)([^>]*)>")
ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
WORDS = re.compile(r"[a-z0-9]+")


def _hint(name: str) -> int:
    """Of a name whose words are all known: 2 if one is of a part that is off, else 1 if one is doubtful; else 0."""
    words = WORDS.findall(name)
    if not all(w in OFF_CLASSES or w in DOUBTFUL or w in BESIDES for w in words):
        return 0
    return 2 if any(w in OFF_CLASSES for w in words) else int(any(w in DOUBTFUL for w in words))


class Tree:
    """Elements and texts of a page, numbered in page order; 0 is the root."""

    def __init__(self):
        self.tag, self.parent, self.off = ["#root"], [-1], [False]
        self.hint = [0]  # by its names: 0 says nothing, 1 may be off, 2 is off
        self.within = [False]  # below article or main
        self.titles = [False]  # in the header of an article, where headings alone count
        self.marks = [0]  # 1: names an author, 2: names a date
        self.parts: list[tuple[int, str]] = []  # (element, text), or (element, "") where a block begins or ends
        self.open = [0]
        self.places: dict[str, list[int]] = {"#root": [0]}  # where in open each tag stands
        self.blocks: list[int] = []  # and all block elements

    def start(self, name: str, attributes: str) -> None:
        if "head" in self._open_tags() and name not in HEAD and name not in ("html", "head"):
            self._close_to("head")
        if name in ("html", "body") and name in self._open_tags():
            return
        if name in CLOSES_P:
            self._close("p", SCOPE)
        if name in CLOSES:
            closed, limit = CLOSES[name]
            for old in closed:
                self._close(old, limit | SCOPE - {"td", "th"} if name not in ("td", "th") else limit)
        node = len(self.tag)
        self.tag.append(name)
        self.parent.append(self.open[-1])
        up = self.open[-1]
        self.within.append(self.within[up] or self.tag[up] in ("article", "main"))
        title = name == "header" and self.within[node]
        self.titles.append((title or self.titles[up]) and name not in HEADINGS)
        off, hint, mark = name in OFF_TAGS and not title, 0, 2 * (name == "time")
        if attributes and not off:
            off, hint, named = self._told(name, attributes, self.within[node])
            mark |= named
        self.off.append(off)
        self.hint.append(0 if title else hint)
        self.marks.append(mark)
        if name in BLOCK:
            self.parts.append((node, ""))
        elif name == "br":
            self.parts.append((self.open[-1], " "))
        if name not in VOID:
            self.places.setdefault(name, []).append(len(self.open))
            if name in BLOCK:
                self.blocks.append(len(self.open))
            self.open.append(node)

    def _last(self, name: str) -> int:
        """Where the newest open element of this tag stands; -1 if there is none."""
        places = self.places.get(name)
        return places[-1] if places else -1

    def end(self, name: str) -> None:
        if name in ("html", "body"):
            return
        place = self._last(name)
        if place >= 0 and (name in BLOCK or not self.blocks or self.blocks[-1] < place):
            self._pop_to(self.open[place])

    def text(self, data: str) -> None:
        if data and not self.titles[self.open[-1]]:
            self.parts.append((self.open[-1], data))

    def _open_tags(self) -> set[str]:
        return {self.tag[node] for node in self.open[:4]}

    def _told(self, name: str, attributes: str, within: bool) -> tuple[bool, int, int]:
        """Whether attributes hide the element or give it another part, what its names hint, and its marks."""
        given = {m[0].lower(): m[1] or m[2] or m[3] for m in ATTRIBUTE.findall(attributes)}
        if "hidden" in given or given.get("aria-hidden", "").lower() == "true":
            return True, 0, 0
        if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", given.get("style", ""), re.I):
            return True, 0, 0
        if given.get("role", "").lower() in OFF_ROLES:
            return True, 0, 0
        classes = given.get("class", "").lower()
        told = {*WORDS.findall(classes), given.get("itemprop", "").lower(), given.get("rel", "").lower()}
        mark = int(not told.isdisjoint(AUTHOR)) | 2 * int(not told.isdisjoint(DATE))
        if name in HOLDERS or name in HEADINGS:
            return False, 0, mark
        hint = max(map(_hint, classes.split()), default=0)
        return False, hint or int(not within and _hint(given.get("id", "").lower()) > 0), mark

    def _close(self, name: str, limit) -> None:
        """Close the newest element of this tag, if no element of the limit was opened in it."""
        place = self._last(name)
        if place >= 0 and all(self._last(tag) <= place for tag in limit):
            self._pop_to(self.open[place])

    def _close_to(self, name: str) -> None:
        for node in self.open:
            if self.tag[node] == name:
                return self._pop_to(node)
        return None

    def _pop_to(self, node: int) -> None:
        while True:
            closed = self.open.pop()
            self.places[self.tag[closed]].pop()
            if self.tag[closed] in BLOCK:
                self.blocks.pop()
                self.parts.append((closed, ""))
            if closed == node:
                return


def parse(page: str) -> Tree:
    """Elements by their tags; what a cut-off page leaves open ends with it."""
    tree, at, size = Tree(), 0, len(page)
    while at < size:
        begin = page.find("<", at)
        if begin < 0:
            tree.text(html.unescape(page[at:]))
            break
        if page.startswith("<!--", begin):
            tree.text(html.unescape(page[at:begin]))
            end = begin + 5 if page.startswith(">", begin + 4) else page.find("-->", begin + 4) + 3
            at = end if end > 2 else size
            continue
        following = page[begin + 1 : begin + 3]
        if following[:1] in ("!", "?") or following[:1] == "/" and not following[1:].isalpha():
            tree.text(html.unescape(page[at:begin]))
            at = page.find(">", begin) + 1 or size
            continue
        if following and not (following[:1].isascii() and following[:1].isalpha() or following[:1] == "/"):
            tree.text(html.unescape(page[at : begin + 1]))
            at = begin + 1
            continue
        tree.text(html.unescape(page[at:begin]))
        match = TAG.match(page, begin) or PLAIN_TAG.match(page, begin)
        if not match:  # the page ends inside a tag
            break
        at, name = match.end(), match[2].lower()
        if match[1]:
            tree.end(name)
            continue
        tree.start(name, match[3])
        if name in RAW and not match[3].endswith("/"):
            ending = re.compile(f"</{re.escape(name)}(?=[\\s/>])", re.I).search(page, at)
            if not ending:
                break
            at = ending.start()
    return tree


def _cut_off(tree: Tree, cuts: list[bool]) -> list[bool]:
    """Elements in a part that is off, or that a name cuts off; names do not cut off what holds an article."""
    holds = [tag in ("main", "article") for tag in tree.tag]
    for node in range(len(tree.tag) - 1, 0, -1):
        holds[tree.parent[node]] |= holds[node]
    off = [False] * len(tree.tag)
    for node in range(1, len(tree.tag)):
        own = tree.off[node] or cuts[node] and not holds[node]
        off[node] = own or off[tree.parent[node]]
    return off


def parts_off(tree: Tree) -> list[bool]:
    """Elements that do not belong to the article, whatever their density, and thin ones of doubtful names.

    Where a page has an article or main element, names alone decide outside of it. Elsewhere,
    where names would cut off all text, they do not cut off what the largest sum lies in.
    """
    marked = any(tag in ("article", "main") and not tree.off[v] for v, tag in enumerate(tree.tag))
    cuts = [hint > 0 for hint in tree.hint]
    off = _cut_off(tree, cuts)
    if not any(cuts):
        return off
    bare = _cut_off(tree, [False] * len(cuts))
    whole, _, _ = densities(tree, _cut_off(tree, [hint == 2 for hint in tree.hint]))
    for turn in range(ROUNDS):
        dense, total, chars = densities(tree, off)
        if chars[0] or marked:
            threshold = min(dense[v] for v in _path(tree, off, total))
            kept = [v for v, cut in enumerate(cuts) if cut and tree.hint[v] == 1 and whole[v] and whole[v] >= threshold and (tree.within[v] or not marked)]
            if turn < ROUNDS - 1:  # what lies in them meets the threshold of the next turn
                kept = [v for v in kept if not off[tree.parent[v]]]
        else:
            kept = [v for v in _path(tree, bare, densities(tree, bare)[1]) if cuts[v]]
        if not kept:
            break
        for v in kept:
            cuts[v] = False
        off = _cut_off(tree, cuts)
    return off


def densities(tree: Tree, off: list[bool]) -> tuple[list[float], list[float], list[int]]:
    """Density of each node, the sum of its children's, and its characters."""
    n = len(tree.tag)
    chars, tags, link_chars, link_tags = [0] * n, [0] * n, [0] * n, [0] * n
    linked, formula = [False] * n, [False] * n
    for node in range(1, n):
        linked[node] = tree.tag[node] == "a" or linked[tree.parent[node]]
        formula[node] = tree.tag[tree.parent[node]] == "math" or formula[tree.parent[node]]
    for node, text in tree.parts:
        if not off[node]:
            length = len(text.strip())
            chars[node] += length
            link_chars[node] += length * linked[node]
    for node in range(n - 1, 0, -1):
        if not off[node]:
            up = tree.parent[node]
            chars[up] += chars[node]
            link_chars[up] += link_chars[node]
            tags[up] += tags[node] + (not formula[node])
            link_tags[up] += link_tags[node] + (tree.tag[node] == "a")
    page_links = link_chars[0] / max(chars[0], 1)

    def density(node: int) -> float:
        c, t, l, k = chars[node], max(tags[node], 1), link_chars[node], link_tags[node]
        if not c:
            return 0.0
        base = math.log(c / max(c - l, 1) * l + page_links * c + math.e)
        return c / t * math.log(max(c / max(l, 1) * t / max(k, 1), 1.0)) / max(math.log(base), 1.0)

    dense, total = [0.0] * n, [0.0] * n
    for node in range(n - 1, 0, -1):
        if not off[node]:
            dense[node] = density(node)
            total[tree.parent[node]] += dense[node]
    dense[0] = density(0)
    return dense, total, chars


def _path(tree: Tree, off: list[bool], total: list[float]) -> list[int]:
    """The node of the largest sum and what it lies in, up to the root."""
    best = max(_candidates(tree, off), key=lambda v: (total[v], -v))
    path = []
    while best >= 0:
        path.append(best)
        best = tree.parent[best]
    return path


def threads(tree: Tree, off: list[bool]) -> list[int]:
    """Comments whose names tell nothing, and the heading right before the first of them."""
    marks = [0 if off[v] else mark for v, mark in enumerate(tree.marks)]
    for node in range(len(marks) - 1, 0, -1):
        marks[tree.parent[node]] |= marks[node]
    alike: dict[tuple[int, str], list[int]] = {}
    for node in range(1, len(marks)):
        if marks[node] == 3 and tree.tag[node] in COMMENTS:
            alike.setdefault((tree.parent[node], tree.tag[node]), []).append(node)
    runs = [run for run in alike.values() if len(run) > 1]
    if not runs:
        return []
    article = set(_path(tree, off, densities(tree, off)[1]))
    before = _before(tree)
    found = []
    for run in runs:
        if article.isdisjoint(run):
            first = run[0] if before[run[0]] else tree.parent[run[0]]
            heading = before[first]
            found += run + [heading] * (tree.tag[heading] in HEADINGS and heading not in article)
    return found


def _before(tree: Tree) -> list[int]:
    """The element right before each one in the same parent; 0 if there is none."""
    last, before = [0] * len(tree.tag), [0] * len(tree.tag)
    for node in range(1, len(tree.tag)):
        up = tree.parent[node]
        before[node], last[up] = last[up], node
    return before


def _beside(tree: Tree, off: list[bool], path: list[int], holder: int, dense: list[float]) -> list[int]:
    """What belongs to the article beside the article element that holds the largest sum."""
    threshold = min(dense[v] for v in path)
    above = path[path.index(holder) + 1 :]
    mains = [i for i, v in enumerate(above) if tree.tag[v] == "main"]
    inside, above, own = set(above[: mains[0] + 1] if mains else []), set(above), set(path)
    linked, titled = [tag == "a" for tag in tree.tag], False
    for node in range(len(linked) - 1, 0, -1):
        linked[tree.parent[node]] |= linked[node]
    for node in range(holder + 1, len(linked)):
        if tree.parent[node] < holder:
            break
        titled |= tree.tag[node] == "h1" and not off[node]
    found = []
    for node in range(1, len(linked)):
        up = tree.parent[node]
        if off[node] or node in own or up not in above:
            continue
        enough = dense[node] >= threshold
        article = tree.tag[node] == "article" and up == tree.parent[holder]
        if up in inside and (enough or not linked[node]) or article and enough:
            found.append(node)
    heading = _before(tree)[holder]
    if tree.tag[heading] in HEADINGS and not off[heading] and not titled:
        found.append(heading)
    return found


def _candidates(tree: Tree, off: list[bool]) -> list[int]:
    return [v for v in range(len(tree.tag)) if not off[v] and (v == 0 or tree.tag[v] in BLOCK)]


def article_nodes(tree: Tree, off: list[bool]) -> list[bool]:
    """Elements that belong to the article."""
    n = len(tree.tag)
    dense, total, chars = densities(tree, off)
    path = _path(tree, off, total)
    holder = next((v for v in path if tree.tag[v] in ("article", "main")), None)
    chosen = [False] * n
    if holder is not None:
        chosen[holder] = True
        if tree.tag[holder] == "article":
            for v in _beside(tree, off, path, holder, dense):
                chosen[v] = True
    else:
        threshold = min(dense[v] for v in path)
        largest = list(range(n))
        for v in range(n - 1, 0, -1):
            up = tree.parent[v]
            if not off[v] and tree.tag[v] in BLOCK and total[largest[v]] > total[largest[up]]:
                largest[up] = largest[v]
        for v in _candidates(tree, off):
            if dense[v] >= threshold and chars[v]:
                chosen[largest[v]] = True
    for v in range(1, n):
        chosen[v] = (chosen[v] or chosen[tree.parent[v]]) and not off[v]
    return chosen


def main_text(page: str | None) -> str:
    """Blocks of the article, each with single spaces, joined by an empty line."""
    if not page:
        return ""
    tree = parse(page)
    off = parts_off(tree)
    comments = threads(tree, off)
    if comments:
        for v in comments:
            off[v] = True
        for v in range(1, len(off)):
            off[v] |= off[tree.parent[v]]
    chosen = article_nodes(tree, off)
    blocks: list[list[str]] = [[]]
    for node, text in tree.parts:
        if not text:
            blocks.append([])
        elif chosen[node]:
            blocks[-1].append(text)
    joined = (" ".join("".join(block).split()) for block in blocks)
    return "\n\n".join(block for block in joined if block)


def extract(pages: DataFrame, id_col="page_id", url_col="url", html_col="html") -> DataFrame:
    """page_id, url and text of every page; text is empty where a page has none.

    A null or empty page has an empty text. Null ids and urls stay null, rows
    that repeat are extracted each for itself, and other columns are ignored,
    whatever their names.
    """
    narrow = pages.select(
        pages[id_col].alias("page_id"), pages[url_col].alias("url"), pages[html_col].cast("string").alias("html")
    )
    kinds = dict(narrow.dtypes)

    def run(batches):
        for batch in batches:
            texts = pa.array([main_text(page.as_py()) for page in batch.column(2)], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), texts], names=["page_id", "url", "text"])

    return narrow.mapInArrow(run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string")
