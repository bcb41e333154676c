"""Main-text extraction by a tree-structured graphical model over the blocks of a page.

A page is parsed into a tree of blocks. Each block is content or not; features of a block (tag,
class words, text and link lengths, what it lies in) give its own potential, and parent and
child are tied by a potential over their two labels. Sum-product messages, up to the root and
down again, give every block's exact marginal. The weights are trained by gradient ascent on
labelled pages: those whose own markup names the article. In half of them the telling markup is
hidden, so that pages without it are extracted from what remains.
"""

from __future__ import annotations

import html as entities
import math
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pumpguard.llm.common import first_by_unit, shipped_by_value, unit_hash

shipped_by_value(__name__)

#: Labelled pages that are learned from at most, taken by a hash.
MAX_FIT_PAGES = 120
STEPS, RATE, SHRINK = 30, 0.5, 0.02

# What HTML says of its elements, and words that class and id names are made of.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label "
                   "mark q rp rt ruby s samp small span strike strong sub sup time tt u var br "
                   "img wbr picture input nobr".split())
RAW = frozenset("script style noscript template textarea title iframe svg math object xmp "
                "select noframes".split())
CLOSES_P = frozenset("address article aside blockquote details div dl fieldset figcaption figure "
                     "footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section "
                     "table ul".split())
SAME_CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"),
               "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
STOPS_AT = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",),
            "td": ("table",), "th": ("table",), "p": ("article", "section", "div", "td", "li", "body")}
AGAINST_TAGS = frozenset("nav header footer aside form menu dialog button head fieldset".split())
FOR_TAGS = frozenset(("article", "main"))
AGAINST_WORDS = frozenset("ad ads advert adverts advertisement banner breadcrumb breadcrumbs "
                          "byline comment comments consent cookie cookies disqus footer form gdpr "
                          "header login masthead menu modal nav navbar navigation newsletter notice "
                          "notices pager pagination popup promo promoted promotion recommended "
                          "related replies reply respond search share sharing sidebar signup "
                          "skyscraper social sponsor sponsored subscribe tags teaser toolbar "
                          "widget widgets".split())
FOR_WORDS = frozenset("article body content entry main post story text".split())
#: Names that tell a state of the page ('has-sidebar', 'comments-open'), not what the block is; of
#: an article or main element also its subjects ('tag-search').
STATE = re.compile(r"(?:has|with|without|no)[-_]|.*[-_](?:open|opened|closed|enabled|disabled)$")
SUBJECT = re.compile(r"(?:tag|category)[-_]")
#: Elements whose names speak of the whole page.
WHOLE = frozenset(("html", "body"))
#: What is believed before any page is seen; training moves away from it only with evidence.
PRIOR = {"bias": -0.5, "against": -5.0, "under against": -5.0, "for": 1.5, "under for": 2.0,
         "linked": -2.0, "long": 1.0, "sentence": 0.5, "tag p": 1.0, "hidden": -4.0}
PRIOR_EDGE = ((0.0, 0.0), (0.0, 1.0))

#: One attribute: quotes count behind '=' only, and an unclosed one is part of the value.
_VALUE = r"""(?:"[^"]*"|'[^']*'|(?!["'])[^\s>]+)"""
MARKUP = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
                    r"|<(/?)([a-zA-Z][^\s/>]*)((?>[\s/]+|[^\s/>=]+(?:\s*=\s*" + _VALUE + r"?)?|=)*+)(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"([^\s/>=]+)(?:\s*=\s*(" + _VALUE + "))?")
#: Elements that a slash closes; it does not close a script or style.
FOREIGN = frozenset(("svg", "math"))
NAME_WORD = re.compile(r"[a-z]+")
SPACE = re.compile(r"\s+")


def name_weight(tag: str, names: str) -> int:
    """Names that speak for content less those that speak against it. A name is against with one
    word of that kind ('main-nav'); names of states and of the whole page say nothing."""
    if tag in WHOLE:
        return 0
    weight = 0
    for name in names.split():
        if STATE.match(name) or tag in FOR_TAGS and SUBJECT.match(name):
            continue
        words = NAME_WORD.findall(name)
        if not AGAINST_WORDS.isdisjoint(words):
            weight -= 1
        elif not FOR_WORDS.isdisjoint(words):
            weight += 1
    return weight


class Page:
    """The blocks of a page: tags, parents (a parent comes before its children), what their
    names weigh, and ``pieces``, the texts in page order as (block, text, linked characters)."""

    def __init__(self, text: str):
        self.tags, self.parents, self.names, self.hidden = ["#page"], [-1], [0], [False]
        self.pieces: list[tuple[int, str, int]] = []
        self._stack, self._buffer, self._linked, self._links = [0], [], 0, 0
        at = 0
        while at < len(text):
            m = MARKUP.search(text, at)
            if m is None:
                self._text(text[at:])
                break
            if m.start() > at:
                self._text(text[at:m.start()])
            at = m.end()
            if m.group(2):
                tag = m.group(2).lower()
                if m.group(1):
                    self._close(tag)
                else:
                    self._open(tag, m.group(3))
                    if tag in RAW and not (tag in FOREIGN and m.group(3).endswith("/")):
                        end = re.compile(f"</{re.escape(tag)}(?=[\\s/>])[^>]*>", re.I).search(text, at)
                        at = end.end() if end else len(text)
        self._flush()

    def _text(self, raw: str) -> None:
        plain = entities.unescape(raw) if "&" in raw else raw
        self._buffer.append(plain)
        if self._links:
            self._linked += len(plain)

    def _flush(self) -> None:
        whole = SPACE.sub(" ", "".join(self._buffer)).strip()
        if whole:
            self.pieces.append((self._stack[-1], whole, self._linked))
        self._buffer, self._linked = [], 0

    def _open(self, tag: str, raw: str) -> None:
        if tag in RAW:
            return
        if tag in INLINE:
            if tag in ("br", "img"):
                self._buffer.append(" " if tag == "br" else "")
            elif tag == "a":
                self._links = 1
            return
        self._flush()
        if tag in CLOSES_P:
            self._pop("p", STOPS_AT["p"])
        for other in SAME_CLOSES.get(tag, ()):
            self._pop(other, STOPS_AT.get(tag, ()))
        if tag in VOID:
            return
        given = {k.lower(): v[1:-1] if v[:1] in ("'", '"') else v for k, v in ATTRIBUTE.findall(raw)} if raw else {}
        words = f"{given.get('class', '')} {given.get('id', '')} {given.get('role', '')}"
        self._links = 0
        self.tags.append(tag)
        self.parents.append(self._stack[-1])
        self.names.append(name_weight(tag, words.lower()))
        self.hidden.append("hidden" in given or "none" in given.get("style", "").replace(" ", "")
                           .partition("display:")[2][:4])
        self._stack.append(len(self.tags) - 1)

    def _close(self, tag: str) -> None:
        if tag in INLINE:
            if tag == "a":
                self._links = 0
        elif tag not in RAW:
            self._flush()
            self._pop(tag, ())

    def _pop(self, tag: str, stops: tuple[str, ...]) -> None:
        for depth in range(len(self._stack) - 1, 0, -1):
            name = self.tags[self._stack[depth]]
            if name == tag:
                del self._stack[depth:]
                self._links = 0
                return
            if name in stops:
                return


def _against(page: Page, i: int) -> bool:
    return page.tags[i] in AGAINST_TAGS or page.names[i] < 0


OUTSIDE, INSIDE, PART, BEFORE, HIDDEN = range(5)


def markup_states(page: Page) -> list[int]:
    """Where every block lies: outside or inside an article or main element, in a part of it that
    is no content, in such a part that lies outside (an article or main in there ends it), or
    in what is hidden."""
    states: list[int] = []
    for i, tag in enumerate(page.tags):
        now = states[page.parents[i]] if i else OUTSIDE
        if page.hidden[i] or now == HIDDEN:
            now = HIDDEN
        elif now != PART:
            if _against(page, i):
                now = PART if now == INSIDE else BEFORE
            elif tag in FOR_TAGS:
                now = INSIDE
        states.append(now)
    return states


def block_features(page: Page, blind: bool = False) -> list[list[str]]:
    """The features of every block; ``blind``: as if tags and names said nothing."""
    chars, linked, ends = ([0] * len(page.tags) for _ in range(3))
    for block, text, links in page.pieces:
        chars[block] += len(text)
        linked[block] += links
        ends[block] += text[-1] in ".!?:;\"'”»…"
    out: list[list[str]] = []
    states = markup_states(page)
    for i, tag in enumerate(page.tags):
        ended = not blind and states[i] == INSIDE and states[page.parents[i]] == BEFORE
        up = out[page.parents[i]] if i else []
        plain = blind and tag in (AGAINST_TAGS | FOR_TAGS) - {"head"}
        found = ["bias", "tag " + ("div" if plain else tag)]
        if not blind or tag == "head":
            against = _against(page, i)
            if against:
                found.append("against")
            elif tag in FOR_TAGS or page.names[i] > 0:
                found.append("for")
        if page.hidden[i]:
            found.append("hidden")
        if not ended and ("against" in up or "under against" in up or "hidden" in up):
            found.append("under against")
        elif "for" in up or "under for" in up:
            found.append("under for")
        if chars[i]:
            found.append("text")
            if 2 * linked[i] > chars[i]:
                found.append("linked")
            else:
                found += ["long"] * (chars[i] >= 80) + ["sentence"] * (ends[i] > 0)
        out.append(found)
    return out


def markup_labels(page: Page) -> list[int] | None:
    """What the page's own markup says: 1 for blocks of an article or main element that are not
    in a part of it that is no content; None if it has no such element."""
    labels = [int(state == INSIDE) for state in markup_states(page)]
    return labels if any(t in FOR_TAGS for t in page.tags) else None


def marginals(parents: list[int], own: list[float], edge) -> tuple[list[float], list]:
    """Exact P(content) of every block by messages up and down, and for each block but the root
    the joint of (parent, block) labels. ``own``: log potential of content against not."""
    n = len(parents)
    tie = [[math.exp(x) for x in row] for row in edge]
    lit = []
    for x in own:  # scaled so that the larger is one
        lit.append([1.0, math.exp(x)] if x < 0 else [math.exp(-x), 1.0])
    up = [list(x) for x in lit]       # the block's own potential times what its children say
    said = [[1.0, 1.0] for _ in range(n)]  # what block i says to its parent
    for i in range(n - 1, 0, -1):
        m = [tie[a][0] * up[i][0] + tie[a][1] * up[i][1] for a in (0, 1)]
        s = m[0] + m[1]
        said[i] = [m[0] / s, m[1] / s]
        p = up[parents[i]]
        p[0], p[1] = p[0] * said[i][0], p[1] * said[i][1]
        s = p[0] + p[1]
        p[0], p[1] = p[0] / s, p[1] / s
    belief, joint = [None] * n, [None] * n
    for i in range(n):
        if i == 0:
            b = up[0]
        else:
            above = belief[parents[i]]
            rest = [above[a] / said[i][a] if said[i][a] else 0.0 for a in (0, 1)]
            both = [[rest[a] * tie[a][c] * up[i][c] for c in (0, 1)] for a in (0, 1)]
            s = sum(map(sum, both))
            joint[i] = [[x / s for x in row] for row in both]
            b = [joint[i][0][0] + joint[i][1][0], joint[i][0][1] + joint[i][1][1]]
        s = b[0] + b[1]
        belief[i] = [b[0] / s, b[1] / s]
    return [b[1] for b in belief], joint


def train(pages: list[tuple[list[int], list[list[str]], list[int]]]):
    """(weights, edge) by gradient ascent from the prior, on (parents, features, labels)."""
    weights, edge = dict(PRIOR), [list(r) for r in PRIOR_EDGE]
    blocks = sum(len(p[0]) for p in pages)
    for _ in range(STEPS if blocks else 0):
        up: dict[str, float] = {}
        tie = [[0.0, 0.0], [0.0, 0.0]]
        for parents, feats, labels in pages:
            own = [sum(weights.get(f, 0.0) for f in fs) for fs in feats]
            p, joint = marginals(parents, own, edge)
            for i, fs in enumerate(feats):
                gap = labels[i] - p[i]
                for f in fs:
                    up[f] = up.get(f, 0.0) + gap
                if i:
                    for a in (0, 1):
                        for c in (0, 1):
                            tie[a][c] += (labels[parents[i]] == a and labels[i] == c) - joint[i][a][c]
        scale = RATE * 20 / blocks
        for f, g in up.items():
            w = weights.get(f, 0.0)
            weights[f] = w + scale * g - RATE * SHRINK * (w - PRIOR.get(f, 0.0))
        for a in (0, 1):
            for c in (0, 1):
                edge[a][c] += scale * tie[a][c] - RATE * SHRINK * (edge[a][c] - PRIOR_EDGE[a][c])
    return weights, edge


def content(text: str, weights: dict[str, float], edge) -> str:
    page = Page(text)
    if not page.pieces:
        return ""
    own = [sum(weights.get(f, 0.0) for f in fs) for fs in block_features(page)]
    p, _ = marginals(page.parents, own, edge)
    return " ".join(t for block, t, _ in page.pieces if p[block] >= 0.5)


NODES = "parents array<int>, features array<array<string>>, labels array<int>"


def _labelled(batches):
    for batch in batches:
        out = []
        for blind, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            page = Page(text or "")
            labels = markup_labels(page)
            if labels:
                out.append({"parents": page.parents, "features": block_features(page, blind),
                            "labels": labels})
        kind = pa.struct([("parents", pa.list_(pa.int32())),
                          ("features", pa.list_(pa.list_(pa.string()))),
                          ("labels", pa.list_(pa.int32()))])
        yield pa.RecordBatch.from_arrays(pa.array(out, kind).flatten(),
                                         names=["parents", "features", "labels"])


def _contents(weights, edge):
    def run(batches):
        for batch in batches:
            texts = [content(t.as_py() or "", weights, edge) for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()),
                 pa.array(list(map(len, texts)), pa.int64())],
                names=["page_id", "url", "text", "n_chars"])
    return run


def fit(pages: DataFrame, max_pages: int = MAX_FIT_PAGES):
    """(weights, edge) from at most ``max_pages`` different pages whose markup names the article;
    every other one of them is shown without its telling markup. Marks are sampled, and only the
    pages of the sampled marks are read with their text."""
    told = (pages.filter(F.regexp_like("html", F.lit("(?i)<(article|main)[\\s>]")))
            .select(unit_hash("html", F.sha2("html", 256)).alias("_u"), "html"))
    marks = [r["_u"] for r in first_by_unit(told.select("_u").distinct(), "_u", [], max_pages)
             .collect()]                                             # max_pages numbers
    if not marks:
        return train([])
    sample = (told.filter(F.col("_u").isin(marks)).groupBy("_u").agg(F.min("html").alias("html"))
              .orderBy("_u")
              .select((F.floor(F.col("_u") * (1 << 20)) % 2 == 0).alias("blind"), "html"))
    nodes = sample.mapInArrow(_labelled, NODES).collect()
    return train([(list(r["parents"]), [list(f) for f in r["features"]], list(r["labels"]))
                  for r in nodes])


def extract(pages: DataFrame, max_fit_pages: int = MAX_FIT_PAGES, id_col: str = "page_id",
            url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per page: page_id, url, text, n_chars (code points).

    Null and empty pages have empty text; so have pages without content blocks. Pages of any
    length are parsed whole; unclosed, crossed and unknown elements are closed as browsers
    roughly do. Without labelled pages the prior weights decide. Repeated rows and null ids are
    kept. No rows: no rows. Other columns are not read.
    """
    slim = pages.select(F.col(id_col).cast("long").alias("page_id"),
                        F.col(url_col).cast("string").alias("url"),
                        F.col(html_col).cast("string").alias("html"))
    weights, edge = fit(slim, max_fit_pages)
    return slim.mapInArrow(_contents(weights, edge),
                           "page_id long, url string, text string, n_chars long")
