"""Main text of web pages by composite text density over the page's nodes."""

from __future__ import annotations

import html
import re
from bisect import bisect_right
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.common import appended, pick, table

# Fixed values of the HTML standard: names of elements.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe xmp".split())
INLINE = frozenset("""a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q s samp small span
 strike strong sub sup time tt u var wbr label ruby rt rp""".split())
SKIPPED = frozenset("""head script style noscript template iframe svg math canvas object embed audio video map nav
 footer aside button select option textarea input fieldset dialog menu title""".split())
CLOSED_BY_BLOCK = frozenset("""address article aside blockquote details div dl fieldset figcaption figure footer form
 h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul""".split())
CLOSES = {  # an opening tag of the key ends an open element of the values, up to the nearest of its containers
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table", "thead", "tbody", "tfoot"}), "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"}),
    "thead": ({"thead", "tbody", "tfoot", "tr", "td", "th"}, {"table"}),
    "tbody": ({"thead", "tbody", "tfoot", "tr", "td", "th"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot", "tr", "td", "th"}, {"table"}),
}
# Words of class, id and role attributes that name parts outside an article's text.
BOILERPLATE = frozenset("""ad ads adbox advert adverts advertisement advertising sponsor sponsored promo promotion banner
 nav navbar navigation menu menubar breadcrumb breadcrumbs pagination pager sidebar aside widget widgets footer masthead
 cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup login
 share sharing social related recommended recommendations trending popular comment comments disqus respond reply replies
 toolbar tooltip skip complementary contentinfo search searchform""".split())
HEADERLIKE = frozenset(("header", "topbar", "siteheader"))
KEPT = frozenset("article main content post entry story body text".split())
# Words after which the next one names what is elsewhere or missing, and those of parts that hold much text of their own.
ABSENT = frozenset("has no with without for".split())
STRONG = frozenset("""comment comments commentlist commentbox commentform commentsection disqus respond reply replies guestbook
 cookie cookies consent gdpr""".split())
# Words that name readers' parts, or a section of an article's own (which begins with a heading).
READERS = frozenset("discussion discussions review reviews responses feedback thread threads talkback".split())
# Words of class attributes that sign and date a reader's text.
SIGNED = frozenset("author byline username user avatar posted date datetime timestamp vcard commenter published".split())
ITEMS = frozenset("li div article section tr dl".split())  # what readers' texts come in
TEXT_TAGS = frozenset("p section article main blockquote pre figure figcaption details address".split())
SENTENCE_END = frozenset(".!?…:;。！？\u0964\"'”»)")
RIGHTS = re.compile(r"\s*(?:©|\(c\)|&copy;|&#169;|copyright\b|all rights reserved)", re.I)
FEW_WORDS = 8  # text of fewer words that ends no sentence is kept beside the article only if it is dense
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 header".split())
KEEP, DOUBT, DOUBT_STRONG, DROP = range(4)

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\x22']|\x22[^\x22]*\x22|'[^']*')*+)(>|\Z)|"
                   r"<(?=[a-zA-Z/])[^>]*(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"([a-zA-Z][\w:-]*)\s*=\s*(?:\x22([^\x22]*)\x22|'([^']*)'|([^\s\x22'>]+))|([a-zA-Z][\w:-]*)")
NAMES = re.compile(r"[a-z]+")
SPACE = re.compile(r"\s+")


@dataclass(slots=True, eq=False)
class Node:
    """An element; ``parts`` holds its texts and elements in page order."""

    tag: str
    up: Node | None = None
    dropped: bool = False
    doubt: int = KEEP
    in_article: bool = False
    readers: bool = False  # named like readers' parts, which an article's own section may be, too
    signed: bool = False  # names, or holds, an author or a date
    thread: bool = False  # holds several signed parts of one kind
    parts: list = field(default_factory=list)
    chars: int = 0
    tags: int = 0
    link_chars: int = 0
    link_tags: int = 0
    density: float = 0.0
    density_sum: float = 0.0


def attributes(raw: str) -> dict[str, str]:
    out = {}
    for m in ATTRIBUTE.finditer(raw):
        name = (m[1] or m[5]).lower()
        out.setdefault(name, html.unescape(m[2] or m[3] or m[4] or ""))
    return out


def boilerplate(tag: str, raw: str, in_article: bool) -> int:
    """DROP for elements that never hold an article's text, by name or as hidden ones; DOUBT for those that the words of
    their class, id and role speak against, and for forms (see ``judge``)."""
    if tag in SKIPPED:
        return DROP
    if tag == "header":
        return KEEP if in_article else DROP
    doubt = DOUBT if tag == "form" else KEEP
    if tag in ("html", "body", "main") or "=" not in raw and "hidden" not in raw:
        return doubt
    own = attributes(raw)
    if "hidden" in own or own.get("aria-hidden") == "true" or "display:none" in own.get("style", "").replace(" ", "").lower():
        return DROP
    for name in ("class", "id", "role"):
        for token in own.get(name, "").split():
            words = NAMES.findall(re.sub(r"([a-z])([A-Z])", r"\1 \2", token).lower())
            words = [w for before, w in zip(["", *words], words) if before not in ABSENT]
            if not words or KEPT & set(words) and not BOILERPLATE & {words[0], words[-1]}:
                continue
            if STRONG & set(words):
                return DOUBT_STRONG
            if tag == "article":  # only readers' texts are told by the words of an article
                continue
            if BOILERPLATE & set(words) or (HEADERLIKE & set(words) and not in_article):
                doubt = DOUBT
    return doubt


@dataclass(slots=True)
class Held:
    """What an element holds, links' texts apart: characters (``text``, without parts of strong doubt), characters of
    links, characters outside doubted parts and headings (``sure``; ``sure_article``: in an article), landmarks."""

    text: int = 0
    links: int = 0
    sure: int = 0
    sure_article: int = 0
    main: bool = False
    article: bool = False
    h1: bool = False


def held(root: Node) -> dict[Node, Held]:
    out: dict[Node, Held] = {}
    for n in nodes_bottom_up(root):
        h = out[n] = Held()
        for p in n.parts:
            if isinstance(p, str):
                h.text += len(SPACE.sub("", p))
                h.sure += len(SPACE.sub("", p))
            elif not p.dropped:
                c = out[p]
                h.links += c.links
                if p.doubt != DOUBT_STRONG:
                    h.text += c.text
                    h.main |= c.main or p.tag == "main" and c.text > 0
                    h.article |= c.article or p.tag == "article" and c.text > 0
                    h.h1 |= c.h1 or p.tag == "h1"
                if p.doubt == KEEP:
                    h.sure += c.sure
                    h.sure_article += c.sure_article
        if n.tag == "a":
            h.links, h.text, h.sure, h.sure_article = h.links + h.text, 0, 0, 0
        elif n.tag in HEADINGS:
            h.sure = h.sure_article = 0
        elif n.tag in ("article", "main") or n.in_article:
            h.sure_article = h.sure
    return out


def judge(root: Node) -> None:
    """Drop the doubted elements, but for those that hold the page's text.

    Such are elements with most of the page's text (links and parts of strong doubt apart),
    unless an article elsewhere has text, and with the page's only article, main or first
    heading.  A part of strong doubt (readers' comments, cookie notices), or one of several
    with a smaller share each, is only let through where nothing else has text.
    """
    of = held(root)
    if not any(n.doubt for n in of):
        return
    total = of[root].text
    for most in (None, DOUBT, DOUBT_STRONG):  # by the rules; then anything doubted; then anything
        sure, article = of[root].sure, of[root].sure_article
        h1 = any(n.tag == "h1" for n in reachable(root))
        out, work = [], [root]
        while work:
            n = work.pop()
            for p in n.parts:
                if not isinstance(p, Node) or p.dropped:
                    continue
                if p.doubt:
                    h = of[p]
                    if most is None:
                        dense = h.text >= h.links
                        good = p.doubt == DOUBT and (
                            dense and 2 * h.text > total and (p.in_article or not article)
                            or not article and (h.main or h.article and (h.text > sure or not h1) or h.h1 and h.text > sure))
                    else:
                        good = p.doubt <= most and h.text >= h.links
                    if not good:
                        out.append(p)
                        continue
                    sure += h.sure
                work.append(p)
        if sure or most == DOUBT_STRONG:
            break
    for p in out:
        p.dropped = True


def reachable(root: Node):
    """The elements outside dropped and doubted ones."""
    work = [root]
    while work:
        n = work.pop()
        yield n
        work.extend(p for p in n.parts if isinstance(p, Node) and not p.dropped and not p.doubt)


def named(raw: str, words: frozenset) -> bool:
    """Does a word of the class or id attribute belong to ``words``."""
    if "=" not in raw:
        return False
    own = attributes(raw)
    return any(w in words for name in ("class", "id", "itemprop", "rel")
               for w in NAMES.findall(re.sub(r"([a-z])([A-Z])", r"\1 \2", own.get(name, "")).lower()))


class Open:
    """The open elements of a page: a stack that knows where each tag is, so no search walks the depth."""

    def __init__(self, root: Node):
        self.nodes = [root]
        self.places: dict[str, list[int]] = {}
        self.blocks: list[int] = []  # places of elements that are not inline
        self.articles = 0

    def push(self, node: Node) -> None:
        at = len(self.nodes)
        self.nodes.append(node)
        self.places.setdefault(node.tag, []).append(at)
        if node.tag not in INLINE:
            self.blocks.append(at)
        self.articles += node.tag in ("article", "main")

    def cut(self, at: int) -> None:
        """Close the element at this place and all in it."""
        while len(self.nodes) > at:
            node = self.nodes.pop()
            self.places[node.tag].pop()
            if node.tag not in INLINE:
                self.blocks.pop()
            self.articles -= node.tag in ("article", "main")

    def last(self, tag: str) -> int:
        """Place of the innermost open element of a tag, 0 for none."""
        own = self.places.get(tag)
        return own[-1] if own else 0

    def ended_by(self, tag: str) -> int:
        """Place of the outermost element that the opening tag ends, 0 for none."""
        if tag not in CLOSES:  # a block ends a paragraph that only inline elements keep open
            at = self.blocks[-1] if self.blocks else 0
            return at if at and self.nodes[at].tag == "p" else 0
        closing, until = CLOSES[tag]
        limit = max(self.last(t) for t in (*until, "body"))
        found = []
        for t in closing:
            own = self.places.get(t, ())
            k = bisect_right(own, limit)
            if k < len(own):
                found.append(own[k])
        return min(found, default=0)


def parsed(page: str) -> Node:
    """The tree of a page, however its tags are nested; unclosed elements end with their container or the page."""
    root = Node("html")
    opened, has_body = Open(root), False
    at, end = 0, len(page)
    while at < end:
        m = TOKEN.search(page, at)
        stop = m.start() if m else end
        if stop > at:
            opened.nodes[-1].parts.append(page[at:stop])
        if not m:
            break
        at = m.end()
        tag = (m[2] or "").lower()
        if not tag or (not m[4] and m.end() == end):  # a comment, a declaration, or a tag that the page's end cuts
            continue
        if m[1]:
            if place := opened.last(tag):
                opened.cut(place)
            continue
        if tag in ("html", "body"):
            if tag == "body" and not has_body:
                has_body = True
                opened.cut(1)
                child = Node("body", root)
                root.parts.append(child)
                opened.push(child)
            continue
        if (tag in CLOSED_BY_BLOCK or tag in CLOSES) and (place := opened.ended_by(tag)):
            opened.cut(place)
        node = opened.nodes[-1]
        child = Node(tag, node)
        child.in_article = opened.articles > 0
        child.doubt = DROP if node.dropped else boilerplate(tag, m[3], child.in_article)
        child.dropped = child.doubt == DROP
        if not child.dropped:
            child.signed = tag == "time" or named(m[3], SIGNED)
            if child.doubt != DOUBT_STRONG and tag not in ("main", "p") and named(m[3], READERS):
                child.doubt, child.readers = DOUBT_STRONG, True
        node.parts.append(child)
        if tag in RAW:
            close = re.compile(rf"</{re.escape(tag)}\s*[^>]*(?:>|\Z)", re.I).search(page, at)
            at = close.end() if close else end
            continue
        if tag in VOID or m[3].rstrip().endswith("/") and tag in ("path", "circle", "rect", "use"):
            continue
        opened.push(child)
    return root


def threads(root: Node) -> None:
    """Mark elements with several signed parts of one kind; sections of an article's own lose the doubt of their name."""
    for n in nodes_bottom_up(root):
        own = [p for p in n.parts if isinstance(p, Node) and not p.dropped]
        kinds: dict[str, list[int]] = {}
        for p in own:
            n.signed |= p.signed
            if p.tag in ITEMS:
                kinds.setdefault(p.tag, []).append(p.signed)
        n.thread = any(len(k) > 1 and 3 * sum(k) >= 2 * len(k) for k in kinds.values()) or any(p.thread for p in own)
        if n.readers and not n.thread and own and own[0].tag in HEADINGS and n.in_article:
            n.doubt = KEEP


def nodes_bottom_up(root: Node) -> list[Node]:
    """Every kept element, children before their parents, without recursion."""
    out, work = [], [root]
    while work:
        n = work.pop()
        out.append(n)
        work.extend(p for p in n.parts if isinstance(p, Node) and not p.dropped)
    return out[::-1]


def measure(root: Node) -> None:
    """Characters, tags and links of every kept element; link-adjusted characters a tag; sums over children."""
    for n in nodes_bottom_up(root):
        for p in n.parts:
            if isinstance(p, str):
                n.chars += len(SPACE.sub("", p))
            elif not p.dropped:
                n.chars += p.chars
                n.tags += p.tags + 1
                n.link_chars += p.chars if p.tag == "a" else p.link_chars
                n.link_tags += p.link_tags + (p.tag == "a")
                n.density_sum += p.density
        own = n.chars if n.tag == "a" else n.link_chars
        n.density = max(n.chars - own, 0) / max(n.tags - n.link_tags, 1)
        if not any(isinstance(p, Node) and not p.dropped for p in n.parts):
            n.density_sum = n.density


def main_node(root: Node) -> Node | None:
    """The element to take the text from; what does not belong to it is dropped in it.

    The element whose children's densities have the largest sum is in the text (of equal
    ones the last in page order, inner before outer).  From it the text is widened along the
    path to the body, or to the outermost article or main element on the path; each part
    beside the path is judged on its own (``beside``), its threshold the least density on
    the path.  Articles next to the outermost one belong to the text, too.
    """
    body = next((p for p in root.parts if isinstance(p, Node) and p.tag == "body"), root)
    nodes = [n for n in nodes_bottom_up(body) if n.chars and n.tag not in INLINE]
    if not nodes:
        return None
    best = nodes[0]
    for n in nodes:
        if n.density_sum >= best.density_sum:
            best = n
    path = [best]
    while path[-1] is not body:
        path.append(path[-1].up)
    threshold = min(n.density for n in path)
    top = len(path) - 1
    holders = [k for k, n in enumerate(path) if n.tag in ("article", "main")]
    if holders:
        top = holders[-1]
    own = set(path)
    for n in path[:top + 1]:
        text = False
        for p in n.parts:  # readers' texts without a telling name come after the article's
            if isinstance(p, Node) and text and p.thread and p not in own and p.tag not in ("article", "main", "table"):
                p.dropped |= 2 * p.chars <= path[top].chars
            text |= p in own if isinstance(p, Node) else bool(p.strip())
            text |= isinstance(p, Node) and not p.dropped and p.chars > 0
    if not holders:
        for below, n in zip(path, path[1:]):
            beside(n, below, threshold)
        return body
    holder = path[top]
    if holder.tag == "article" and holder is not body:
        around = holder.up
        more = [p for p in around.parts if p is holder or isinstance(p, Node) and not p.dropped and p.tag == "article"
                and p.chars and 2 * p.link_chars < p.chars]
        if len(more) > 1:
            return Node("div", around.up, parts=more)
    return holder


def beside(n: Node, below: Node, threshold: float) -> None:
    """Drop the parts of ``n`` beside its child ``below`` that are no text of the article's.

    An element stays if it is a heading, as dense as the path's least dense element, or text
    rather than links: a text element, or one with a sentence.  Texts and inline elements that
    stand directly in ``n`` are judged run by run.
    """
    run: list = []

    def judged():
        if not run:
            return
        text = "".join(p if isinstance(p, str) else plain(p) for p in run)
        links = sum(p.chars if p.tag == "a" else p.link_chars for p in run if isinstance(p, Node))
        chars = len(SPACE.sub("", text))
        keep = 2 * links < chars and not RIGHTS.match(text) and says(text)
        for p in run:
            if isinstance(p, Node):
                p.dropped |= not keep
            elif not keep:
                gone.add(id(p))
        run.clear()

    gone: set[int] = set()
    for p in n.parts:
        if isinstance(p, str) or p.tag in INLINE and p is not below:
            if isinstance(p, str) or not p.dropped:
                run.append(p)
            continue
        judged()
        if p is below or p.dropped or not p.chars or p.tag in HEADINGS:
            continue
        text = plain(p)
        keep = (2 * p.link_chars < p.chars and not (RIGHTS.match(text) and len(text.split()) < 4 * FEW_WORDS)
                and (p.density >= threshold or p.tag in TEXT_TAGS or says(text)))
        p.dropped = not keep
    judged()
    n.parts = [p for p in n.parts if not isinstance(p, str) or id(p) not in gone]


def says(text: str) -> bool:
    """Has a text a sentence, or words enough for one."""
    text = text.strip()
    words = text.split()
    return len(words) >= FEW_WORDS or len(words) > 2 and text[-1] in SENTENCE_END


def plain(node: Node) -> str:
    """The raw text of an element's kept parts."""
    out, work = [], [node]
    while work:
        x = work.pop()
        if isinstance(x, str):
            out.append(x)
        elif not x.dropped or x is node:
            if x.tag not in INLINE:
                out.append(" ")
            work.extend(reversed(x.parts))
    return "".join(out)


def blocks(node: Node) -> list[str]:
    """The texts of a subtree's blocks in page order, character references decoded, white space made single."""
    out: list[str] = []
    run: list[str] = []

    def flush():
        text = SPACE.sub(" ", html.unescape("".join(run))).strip()
        if text:
            out.append(text)
        run.clear()

    work: list = [node]
    while work:
        x = work.pop()
        if x is None:
            flush()
        elif isinstance(x, str):
            run.append(x)
        elif not x.dropped or x is node:
            if x.tag == "br":
                run.append("\n")
            elif x.tag in INLINE:
                work.extend(reversed(x.parts))
            else:
                flush()
                work.append(None)
                work.extend(reversed(x.parts))
    flush()
    return out


def extract(page: str | None) -> str:
    """Main text of a page; null, empty and textless pages give an empty text."""
    if not page:
        return ""
    root = parsed(page)
    threads(root)
    judge(root)
    measure(root)
    node = main_node(root)
    return " ".join(blocks(node)) if node is not None else ""


def main_text(pages: DataFrame, html_col: str = "html", out_col: str = "text") -> DataFrame:
    """``pages`` with ``out_col``: the main text of each page's whole HTML; every row and other column stays."""
    def setup():
        return lambda column: [pa.array([extract(h) for h in column.to_pylist()], pa.string())]

    return appended(pages, html_col, [(out_col, "string")], setup)


def op1_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query op1 over the whole ``pages`` table."""
    pages = pick(table(spark, sf_dir, "pages"), page_id="page_id", url="url", html="html")
    return main_text(pages).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
