"""Main text of web pages by composite text density.

A page becomes a tree in one pass.  Every node gets its characters per tag, adjusted by the
share of link characters and link tags (composite density), and the sum of its children's
densities: the main text is the subtree whose sum is greatest.  The least density on the path
from that node up to the body is the threshold; where the page names no article, other nodes that
reach it add their own greatest subtree, so a text in several parts is found whole.  Menus,
footers, forms and the like are told by tag, role, class or id and never count; inside an article,
a class or id tells only where it names nothing else, or where most of the element is links.
"""

from __future__ import annotations

import bisect
import html
import math
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import by_value

by_value(__name__)

TAG = re.compile(r"<!--(?:(?!-->).)*+(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']|\"[^\"]*+\"|'[^']*+')*+)>"
                 r"|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"([a-zA-Z-]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
#: Elements whose content is text without markup.
RAW = frozenset("script style textarea title xmp noembed noframes iframe".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset("""address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset
 figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre section
 summary table tbody td tfoot th thead tr ul""".split())
#: An opening tag ends these open elements, up to the given ones.
ENDS = ({t: ({"p"}, frozenset("body div article section td li blockquote main button".split()))
         for t in BLOCK - frozenset("br html body caption option td th tr tbody thead tfoot".split())}
        | {"li": ({"p", "li"}, frozenset(("ul", "ol", "menu"))), "option": ({"option"}, frozenset(("select",))),
           "dt": ({"p", "dt", "dd"}, frozenset(("dl",))), "dd": ({"p", "dt", "dd"}, frozenset(("dl",))),
           "tr": ({"p", "tr", "td", "th"}, frozenset(("table",))), "td": ({"p", "td", "th"}, frozenset(("tr", "table"))),
           "th": ({"p", "td", "th"}, frozenset(("tr", "table")))})
#: Never main text: by tag, by role, and by a word of class or id.
AWAY = frozenset("""head script style noscript template nav footer aside form button select option input textarea label iframe
 object embed svg canvas dialog menu title""".split())
AWAY_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog form menu menubar".split())
AWAY_WORDS = frozenset("""ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner
 sidebar side menu nav navbar navigation breadcrumb breadcrumbs footer header masthead topbar toolbar cookie cookies consent
 gdpr notice alert popup modal overlay newsletter subscribe subscription signup login related recommended share sharing
 social comment comments commentlist respond reply replies disqus discussion pagination pager widget copyright skip""".split())
#: Words of these that name a part clearly also inside an article, and words that may stand beside them.
CLEAR = frozenset("""ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo sidebar nav navbar
 navigation breadcrumb breadcrumbs cookie cookies consent gdpr popup modal newsletter subscribe subscription signup login share
 sharing social comment comments commentlist respond reply replies disqus pagination pager widget skip""".split())
BESIDE = frozenset("""article area bar block bottom box button buttons container content entry form icons inner item left link
 links list main media page panel post posts right section site thread title top wrap wrapper""".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
STAYS, GOES, GOES_AS_LINKS = range(3)
MAIN = frozenset(("article", "main"))
NOT_SHOWN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


def away(tag: str, attributes: str, inside_main: bool) -> int:
    """Whether an element is no part of the main text, whatever is in it, or if most of it is links."""
    if tag in AWAY or (tag == "header" and not inside_main):
        return GOES
    if not attributes.strip() or tag in MAIN or tag in ("html", "body"):
        return STAYS
    found = STAYS
    for name, *values in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), "".join(values)
        if name == "hidden" or (name == "aria-hidden" and value == "true"):
            return GOES
        if name == "role" and value.lower() in AWAY_ROLES:
            return GOES
        if name in ("class", "id"):
            for part in re.sub(r"(?<=[a-z])(?=[A-Z])", "-", value).lower().split():
                words = set(re.split(r"[^a-z]+", part)) - {""}
                if AWAY_WORDS.isdisjoint(words):
                    continue
                if not inside_main or (tag not in HEADINGS and not CLEAR.isdisjoint(words) and words <= CLEAR | BESIDE):
                    return GOES
                found = GOES_AS_LINKS
        if name == "style" and NOT_SHOWN.search(value):
            return GOES
    return found


class Page:
    """The tree of a page: nodes in page order, each with its parent, and what they hold."""

    def __init__(self, source: str):
        self.tag, self.parent, self.gone, self.main = ["#"], [-1], [False], [False]
        #: (node, text), or (node, None) where a block begins or ends.
        self.parts: list[tuple[int, str | None]] = []
        self.body = 0
        self.doubted: list[int] = []  # nodes that go if most of them is links
        #: Places of the open elements of a tag, and of open blocks.
        self.places: dict[str, list[int]] = {}
        self.blocks: list[int] = []
        self.read(source)
        if self.doubted:
            self.settle()

    def read(self, source: str) -> None:
        opened, at, raw_ends = [0], 0, {}
        for_text = self.parts.append
        while at < len(source):
            m = TAG.search(source, at)
            start = m.start() if m else len(source)
            if start > at and not self.gone[opened[-1]]:
                for_text((opened[-1], source[at:start]))
            if not m:
                break
            at = m.end()
            name = m[2] or m[5]
            if not name:
                continue
            name, closing, attributes = name.lower(), m[1] or m[4], (m[3] or m[6] or "")
            if closing:
                self.close(opened, name)
                continue
            if name == "body" and self.body:
                continue
            self.imply(opened, name)
            up = opened[-1]
            node = len(self.tag)
            self.tag.append(name)
            self.parent.append(up)
            self.main.append(self.main[up] or name in MAIN)
            how = GOES if self.gone[up] else away(name, attributes, self.main[up])
            self.gone.append(how == GOES)
            if how == GOES_AS_LINKS:
                self.doubted.append(node)
            if name == "body":
                self.body = node
            if name in BLOCK:
                for_text((up, None))
            if name in RAW:
                end = raw_ends.get(name) or raw_ends.setdefault(name, re.compile(rf"</{name}(?=[\s/>])", re.I))
                e = end.search(source, at)
                at = e.start() if e else len(source)
            if name not in VOID and not (attributes.endswith("/") and name not in BLOCK):
                self.places.setdefault(name, []).append(len(opened))
                if name in BLOCK:
                    self.blocks.append(len(opened))
                opened.append(node)

    def cut(self, opened: list[int], k: int) -> None:
        """Ends the open elements from place ``k`` on."""
        for node in opened[k:]:
            self.places[self.tag[node]].pop()
        del opened[k:]
        del self.blocks[bisect.bisect_left(self.blocks, k):]

    def close(self, opened: list[int], name: str) -> None:
        places = self.places.get(name)
        # an inline element doesn't end the blocks inside it
        if places and (name in BLOCK or not self.blocks or self.blocks[-1] < places[-1]):
            self.cut(opened, places[-1])
        if name in BLOCK:
            self.parts.append((opened[-1], None))

    def imply(self, opened: list[int], name: str) -> None:
        if name == "a":  # a link ends the one before, unless a block stands open inside it
            self.close(opened, name)
            return
        ends, until = ENDS.get(name, ((), ()))
        if not ends:
            return
        stop = max((p[-1] for t in until if (p := self.places.get(t))), default=0)
        cuts = [p[k] for t in ends if (p := self.places.get(t)) and (k := bisect.bisect_right(p, stop)) < len(p)]
        if cuts:
            k = min(cuts)
            self.parts.append((self.parent[opened[k]], None))
            self.cut(opened, k)

    def settle(self) -> None:
        """Doubted nodes that hold more link text than other text go, and all in them."""
        n = len(self.tag)
        chars, links = [0] * n, [0] * n
        for node, part in self.parts:
            if part is not None:
                chars[node] += len(part.strip())
        for k in range(n - 1, 0, -1):
            if self.tag[k] == "a":
                links[k] = chars[k]
            chars[self.parent[k]] += chars[k]
            links[self.parent[k]] += links[k]
        for k in self.doubted:
            self.gone[k] = links[k] * 2 > chars[k]
        for k in range(1, n):
            self.gone[k] = self.gone[k] or self.gone[self.parent[k]]

    def text(self) -> str:
        chosen = self.choose()
        inside = [False] * len(self.tag)
        for n in range(len(self.tag)):
            inside[n] = not self.gone[n] and (n in chosen or (n > 0 and inside[self.parent[n]]))
        blocks, block = [], []
        for node, part in self.parts:
            if part is None:
                if block:
                    blocks.append("".join(block))
                    block = []
            elif inside[node]:
                block.append(part)
        blocks.append("".join(block))
        shown = (" ".join((html.unescape(b) if "&" in b else b).split()) for b in blocks)
        return "\n".join(b for b in shown if b)

    def choose(self) -> set[int]:
        """Nodes whose subtrees are the main text."""
        n = len(self.tag)
        chars, own, tags, link_chars, link_tags = [0] * n, [0] * n, [0] * n, [0] * n, [0] * n
        for node, part in self.parts:
            if part is not None and not self.gone[node]:
                own[node] += len(part.strip())
        for k in range(n - 1, -1, -1):
            chars[k] += own[k]
            if self.tag[k] == "a":
                link_chars[k], link_tags[k] = chars[k], link_tags[k] + 1
            if k and not self.gone[k]:
                up = self.parent[k]
                chars[up] += chars[k]
                tags[up] += tags[k] + 1
                link_chars[up] += link_chars[k]
                link_tags[up] += link_tags[k]
        if not chars[0]:
            return set()
        share = link_chars[self.body] / max(1, chars[self.body])

        def density(k: int) -> float:
            c, t, lc, lt = chars[k], max(1, tags[k]), max(1, link_chars[k]), max(1, link_tags[k])
            if not c:
                return 0.0
            base = math.log(c / max(1, c - lc) * lc + share * c + math.e)
            return c / t * max(0.0, math.log(c / lc * t / lt)) / math.log(max(base, 1.0001))

        dense = [0.0 if self.gone[k] else density(k) for k in range(n)]
        sums = [float(own[k]) for k in range(n)]  # text right in a node is a child of one tag
        for k in range(n - 1, 0, -1):
            sums[self.parent[k]] += dense[k]
        root = self.body
        alive = [k for k in range(n) if not self.gone[k] and k >= root]
        best = max(alive, key=lambda k: (sums[k], -k), default=root)
        named = [k for k in alive if self.tag[k] in MAIN]
        k, least, article = best, math.inf, None
        while k >= 0:
            least = min(least, dense[k])
            if self.tag[k] in MAIN:
                article = k
            k = self.parent[k] if k != root else -1
        if article is None and named and chars[top := max(named, key=lambda k: chars[k])] * 4 >= chars[root]:
            article = top
        if article is not None:
            # articles beside it are part of the page's text too, unless they are mostly links
            inside, beside = [False] * n, {article}
            for k in alive:
                up = self.parent[k]
                inside[k] = k != root and (inside[up] or self.tag[up] in MAIN)
                if self.tag[k] in MAIN and not inside[k] and 0 < chars[k] and link_chars[k] * 2 <= chars[k]:
                    beside.add(k)
            return beside
        greatest = list(range(n))  # of each subtree
        for k in range(n - 1, 0, -1):
            up = self.parent[k]
            if not self.gone[k] and sums[greatest[k]] > sums[greatest[up]]:
                greatest[up] = greatest[k]
        return {best} | {greatest[k] for k in alive if k != root and dense[k] >= least and link_chars[k] * 2 <= chars[k]}


def main_text(source: str | None) -> str:
    return Page(source).text() if source and "<" in source else " ".join(html.unescape(source or "").split())


def extract_text(pages: DataFrame) -> DataFrame:
    """``pages`` without html, with text and n_chars (code points).

    Null or empty html, and pages without text: empty text, 0.  Source without any tag: its own
    text, one block.  Broken, cut-off and deeply nested markup: read as far as it goes, no node is
    dropped for depth.  Repeated rows: read each.  Empty table: empty result.  Other columns stay;
    text and n_chars of ``pages`` give way."""
    keep = [c for c in pages.columns if c not in ("html", "text", "n_chars")]

    def run(batches):
        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                batch = whole.slice(at, 500)
                texts = [main_text(x) for x in batch.column("html").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c) for c in keep), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                    [*keep, "text", "n_chars"])

    return pages.select(*keep, F.coalesce("html", F.lit("")).alias("html")).mapInArrow(
        run, T.StructType([pages.schema[c] for c in keep] + [T.StructField("text", T.StringType()),
                                                             T.StructField("n_chars", T.LongType())]))
