"""Main text of web pages by a site style tree.

The pages of one host are merged into one tree: elements with the same path
(tags, classes and ids from the root) are one node.  Two entropies say how
important a node is.  Presentation: how evenly the pages of the node differ in
the sequence of its children.  Content: how little its texts repeat over those
pages.  A branch's importance joins its own presentation with the content of
all leaves below it.  Nodes seen on fewer than ``MIN_PAGES`` pages count as
important, and so do unmarked text elements inside an article, since mirrored
articles also repeat.

A page is read once into its own tree.  What decides on a branch is its
importance, lowered to nothing where the branch declares itself to be something
else (menus, headers, footers, asides, forms, adverts, notices, reader
comments; by tag, role, or a class or id that says so as a whole).  Branches
under ``LOW`` are removed, from the root down, but never one that holds the
article, nor, on a page that marks no article, one that holds most of its text
(unless its tag declares it).  Of what is left, the article is chosen among the marked candidates
(``article``, ``main``, role main) and the text outside of them by the text each
holds, weighed by the importance of its branches and without links: a teaser
does not stand in for an unmarked article beside it.

The statistics are sums per (host, path, feature), made in parts before the
shuffle, so a host may hold any share of the pages.  The table of branches, a
row per host with those that no low branch holds already, is stored first;
Spark broadcasts it only if it is small, and else splits the join at a hot host.

Blocks end at block elements; white space inside a block becomes one space,
blocks are joined by a line feed.  Null or empty html gives an empty text.  A
null or odd url has an empty host, whose pages share a tree.  Paths deeper than
``MAX_DEPTH`` are merged with the path at that depth for the statistics.
Repeated rows and null ids give one row each; extra columns are ignored.
"""

from __future__ import annotations

import html
import re
from collections import Counter

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticksmith.llm.common import map_batches, prepare, stored

LOW = 0.3
#: branches below this importance lower the weight of the text they hold
WEIGHED = 0.7
GAMMA = 0.9
MIN_PAGES = 4
MAX_DEPTH = 48
#: share of a page's text that no branch may take with it unless it is marked by its tag
MOST = 0.5
#: a candidate stays beside the best one with at least this part of its weight
BESIDE = 0.5

#: quoted values are followed over angle brackets up to a length, so that one quote left open costs no more than that
TAG = re.compile(
    r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+(?:>|\Z)|</([a-zA-Z][^\s/>]*+)[^>]*+(?:>|\Z)|<([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]{0,4000}+"|'[^']{0,4000}+'){0,400}+)>|<([a-zA-Z][^\s/>]*+)([^>]*+)(?:>|\Z)""",
    re.S,
)
ATTRIBUTE = re.compile(r"""([a-zA-Z][\w:-]*)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))|\b(hidden)\b""")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul caption option".split()
)
#: text elements; without class or id they are never a template's part inside an article
TEXT = frozenset("p h1 h2 h3 h4 h5 h6 li ul ol dl dt dd blockquote pre table thead tbody tfoot tr td th figure figcaption caption".split())
#: elements that a new one of the same group closes
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",), "tbody": ("tbody", "thead", "tr", "td", "th")}
CLOSES_P = BLOCK - frozenset("body html head option td th tr tbody thead tfoot caption dd dt li summary legend figcaption".split()) | {"p"}
#: an open element of this kind ends the search for what a new one closes
SCOPES = frozenset("table ul ol dl body html article section div td th select".split())
NOISE_TAGS = frozenset("head nav footer aside form button select input textarea script style noscript template iframe svg canvas object audio video dialog menu search map applet".split())
NOISE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar toolbar".split())
NOISE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices notification newsletter subscribe subscription signup sidebar menu nav navbar navigation breadcrumb breadcrumbs footer comment comments respond disqus share sharing social related recommended popup modal overlay toolbar pagination pager skip login widget".split()
)
#: parts of a compound name that say nothing by themselves
NEUTRAL_WORDS = frozenset(
    "site page main top bottom left right global primary secondary header area block box container wrapper wrap section bar list link links item items inner outer content article post entry main-menu mobile desktop sticky fixed side wp js the 1 2 3 4 5".split()
)
ARTICLE = frozenset(("article", "main"))
#: elements that can hold a page as a whole; a class takes them with it less easily than a tag does
STRONG = frozenset("head script style noscript template iframe svg canvas object audio video select textarea button map applet".split())


def site(url: str | None) -> str:
    m = re.match(r"\s*[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", url or "")
    return m[1].lower() if m else ""


class Node:
    """An element: its place in the tree, what it declares, and the text and articles below it."""

    __slots__ = ("tag", "path", "parent", "noise", "article", "inside", "doubt", "aside", "block", "children", "text", "holds")

    def __init__(self, tag, path, parent, noise=0, article=False):
        self.tag, self.path, self.parent, self.noise, self.article = tag, path, parent, noise, article
        self.inside = article or parent is not None and parent.inside
        #: in a branch that declares itself noise
        self.doubt = bool(noise) or parent is not None and parent.doubt
        self.block = self if tag in BLOCK or parent is None else parent.block
        #: the nearest element inside of the same block that declares itself noise
        self.aside = None if tag in BLOCK else self if noise else parent and parent.aside
        self.children, self.text, self.holds = [], 0, False


def attributes(source: str) -> dict[str, str]:
    if not source or not source.strip(" /"):
        return {}
    out = {}
    for m in ATTRIBUTE.finditer(source):
        if m[5]:
            out.setdefault("hidden", "")
        else:
            out.setdefault(m[1].lower(), html.unescape(m[2] or m[3] or m[4] or ""))
    return out


def noise_name(name: str) -> bool:
    """Whether a class or id says as a whole that it names noise."""
    if name in NOISE_WORDS:
        return True
    words = set(re.split(r"[_-]+", name)) - {""}
    return bool(words & NOISE_WORDS) and words <= NOISE_WORDS | NEUTRAL_WORDS


#: how an element declares itself to be something other than the article
BY_NAME, BY_TAG, HIDDEN = 1, 2, 3


def declared(tag: str, at: dict[str, str], inside: bool) -> int:
    if tag in STRONG:
        return HIDDEN
    if tag in NOISE_TAGS or tag == "header" and not inside:
        return BY_TAG
    if not at or tag in ("html", "body"):
        return 0
    if "hidden" in at or at.get("aria-hidden") == "true" or re.search(r"display\s*:\s*none", at.get("style", "")):
        return HIDDEN
    if at.get("role", "").lower() in NOISE_ROLES:
        return BY_TAG
    names = f"{at.get('class', '')} {at.get('id', '')}".lower().split()
    return BY_NAME if any(map(noise_name, names)) or not inside and "header" in names else 0


class Page:
    """A page's blocks and nodes; ``low`` holds the importance of its host's branches that are below the limit."""

    def __init__(self, source: str | None, low: dict[str, float] | None = None):
        #: element, text, characters of it outside of links
        self.blocks: list[tuple[Node, str, int]] = []
        self.nodes: list[Node] = []
        self.low = low or {}
        self.root = Node("", "", None)
        self.stack = [self.root]
        #: open elements by tag since the last element of a kind that bounds a search
        self.in_block, self.in_scope, self.opened = [Counter()], [Counter()], Counter()
        self.parts: list[tuple[Node | None, str, bool]] = []
        if source:
            self._read(source)
        self._flush()
        self._sum()

    def _flush(self):
        """End the block at hand; what declared itself noise inside of it is a block of its own."""
        parts, self.parts = self.parts, []
        holder = self.stack[-1].block
        for aside in dict.fromkeys(p[0] for p in parts):
            text = " ".join("".join(t for a, t, _ in parts if a is aside).split())
            if text:
                own = len("".join("".join(t for a, t, linked in parts if a is aside and not linked).split()))
                (aside or holder).text += own
                self.blocks.append((aside or holder, text, own))

    def _text(self, text: str):
        self.parts.append((self.stack[-1].aside, text, self.opened["a"] > 0))

    def _push(self, node: Node):
        tag = node.tag
        self.opened[tag] += 1
        self.in_block[-1][tag] += 1
        self.in_scope[-1][tag] += 1
        if tag in BLOCK:
            self.in_block.append(Counter())
        if tag in SCOPES:
            self.in_scope.append(Counter())
        self.stack.append(node)

    def _pop(self):
        tag = self.stack.pop().tag
        if tag in BLOCK:
            self.in_block.pop()
        if tag in SCOPES:
            self.in_scope.pop()
        self.opened[tag] -= 1
        self.in_block[-1][tag] -= 1
        self.in_scope[-1][tag] -= 1

    def _pop_to(self, tags) -> None:
        while self.stack[-1].tag not in tags:
            self._pop()
        self._pop()

    def _imply(self, tag: str) -> None:
        """Close what a new element closes, up to the next element that bounds the search."""
        tags = (*CLOSES.get(tag, ()), "p") if tag in CLOSES_P else CLOSES.get(tag, ())
        if not tags:
            return
        here = self.in_scope[-1]
        if any(here[t] > 0 for t in tags):
            self._pop_to(tags)
        elif len(self.in_scope) > 1 and any(t in SCOPES and self.in_scope[-2][t] > 0 for t in tags):
            bound = next(n.tag for n in reversed(self.stack) if n.tag in SCOPES)
            if bound in tags:
                self._pop_to((bound,))

    def _open(self, tag: str, source: str):
        self._imply(tag)
        top = self.stack[-1]
        at = attributes(source)
        marks = sorted({*at.get("class", "").lower().split(), *(f"#{i}" for i in at.get("id", "").lower().split())})
        name = ".".join([tag, *(re.sub(r"\d+", "0", m.replace("/", "")) for m in marks)])
        path = f"{top.path}/{name}" if top.path.count("/") < MAX_DEPTH else top.path
        noise = declared(tag, at, top.inside)
        node = Node(tag, path, top, noise, (tag in ARTICLE or at.get("role", "").lower() == "main") and not noise)
        if not top.children or top.children[-1] != name:
            top.children.append(name)
        self.nodes.append(node)
        self._push(node)

    def _read(self, source: str):
        at = 0
        while at < len(source):
            m = TAG.search(source, at)
            end = m.start() if m else len(source)
            if end > at:
                self._text(html.unescape(source[at:end]))
            if not m:
                break
            at = m.end()
            closing, tag = m[1], m[2] or m[4]
            if tag:
                tag = tag.lower()
                if tag in BLOCK:
                    self._flush()
                if tag == "br":
                    self._text(" ")
                if tag in VOID:
                    continue
                if tag in RAW:
                    close = re.compile(rf"</{tag}\b[^>]*+>", re.I).search(source, at)
                    at = close.end() if close else len(source)
                    continue
                self._open(tag, m[3] if m[2] else m[5])
            elif closing:
                closing = closing.lower()
                if closing in BLOCK:
                    self._flush()
                if (self.opened if closing in BLOCK else self.in_block[-1])[closing] > 0:
                    self._pop_to((closing,))

    def _sum(self):
        """Text and articles below each element, children before parents.

        An article in a branch that declares itself noise counts where the page has no other."""
        certain = any(n.article and not n.doubt for n in self.nodes)
        for n in reversed(self.nodes):
            n.holds |= n.article and not (certain and n.doubt)
            if n.noise != HIDDEN:
                n.parent.text += n.text
                n.parent.holds |= n.holds

    def _gone(self, n: Node) -> bool:
        """Whether an element goes with all below it, by its importance and what it declares."""
        if n.noise == HIDDEN:
            return True
        importance = 0.0 if n.noise else self.low.get(n.path, 1.0)
        return importance < LOW and not n.holds and (n.noise == BY_TAG or self.root.holds or n.text <= MOST * self.root.text)

    def text(self) -> str:
        """The blocks of the chosen article."""
        gone: dict[Node, bool] = {self.root: False}
        owner: dict[Node, Node | None] = {self.root: None}
        weight: dict[Node, float] = {self.root: 1.0}
        for n in self.nodes:
            gone[n] = gone[n.parent] or self._gone(n)
            owner[n] = owner[n.parent] or (n if n.article else None)
            weight[n] = min(weight[n.parent], self.low.get(n.path, 1.0))
        kept = [b for b in self.blocks if not gone[b[0]]]
        score: dict[Node | None, float] = {None: 0.0}
        for n, _, own in kept:
            score[owner[n]] = score.get(owner[n], 0.0) + own * weight[n]
        best = max(score.values())
        if score[None] == best:
            chosen = {None} if best or len(score) == 1 else set(score)
        else:
            chosen = {a for a, x in score.items() if a is not None and x >= BESIDE * best}
        return "\n".join(t for n, t, _ in kept if owner[n] in chosen)


def page_features(page: Page):
    """(path, kind, feature): one presentation per node of the page and its distinct texts; declared noise aside."""
    styles: dict[str, list[str]] = {}
    shown = {page.root}
    for n in page.nodes:
        if n.parent in shown and (not n.noise or n.holds):
            shown.add(n)
            styles.setdefault(n.path, []).append(" ".join(n.children))
    for path, found in styles.items():
        yield path, 0, xxhash.xxh64_intdigest("|".join(dict.fromkeys(found))) >> 1
    for path, text in {(n.path, t) for n, t, _ in page.blocks if n in shown}:
        yield path, 1, xxhash.xxh64_intdigest(text) >> 1


def style_tree(pages: DataFrame) -> DataFrame:
    """host, path, kind, feature, n: on how many pages of the host a node shows a feature."""

    def make():
        def step(batch: pa.RecordBatch):
            counts: dict[tuple, int] = {}
            for url, source in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                host = site(url)
                for f in page_features(Page(source)):
                    counts[host, *f] = counts.get((host, *f), 0) + 1
            yield {c: [k[i] for k in counts] for i, c in enumerate(("host", "path", "kind", "feature"))} | {"n": list(counts.values())}

        return step

    parts = map_batches(pages.select("url", "html"), make, "host string, path string, kind int, feature long, n long")
    return parts.groupBy("host", "path", "kind", "feature").agg(F.sum("n").alias("n"))


def low_branches(tree: DataFrame, low: float = LOW, weighed: float = WEIGHED) -> DataFrame:
    """host, paths (path -> importance): the branches whose importance is below ``weighed``, without those a low one holds."""
    log = F.log(F.col("n").cast("double"))
    nodes = tree.groupBy("host", "path").agg(
        F.sum(F.when(F.col("kind") == 0, F.col("n"))).alias("pages"), F.sum(F.when(F.col("kind") == 0, F.col("n") * log)).alias("styles"),
        F.count(F.when(F.col("kind") == 1, 1)).alias("texts"), F.sum(F.when(F.col("kind") == 1, log)).alias("repeats"),
    )
    nodes = nodes.where("pages is not null")
    size = F.log(F.col("pages").cast("double"))
    one = F.col("pages") < 2
    presentation = F.when(one, 1.0).otherwise((size - F.col("styles") / F.col("pages")) / size)
    content = F.when(one, 1.0).otherwise(F.greatest(F.lit(0.0), 1 - F.col("repeats") / F.col("texts") / size))
    nodes = stored(nodes.select("host", "path", "pages", "texts", presentation.alias("presentation"), content.alias("content")), "pages-nodes")
    # a leaf's content counts for all its ancestors; there are as many rows as a site's template has paths
    steps = F.split("path", "/")
    above = nodes.where("texts > 0").select("host", "texts", "content", F.explode(F.transform(F.sequence(F.lit(2), F.size(steps)), lambda k: F.array_join(F.slice(steps, F.lit(1), k), "/"))).alias("path"))
    below = above.groupBy("host", "path").agg((F.sum(F.col("texts") * F.col("content")) / F.sum("texts")).alias("leaves"))
    joined = nodes.join(below, ["host", "path"])
    importance = (1 - GAMMA) * F.col("presentation") + GAMMA * F.col("leaves")
    last = F.element_at(steps, -1)
    in_article = F.exists(steps, lambda s: F.split(s, "\\.")[0].isin(*ARTICLE))
    plain = last.isin(*sorted(TEXT)) & in_article
    chosen = joined.where((F.col("pages") >= MIN_PAGES) & (importance < weighed) & ~plain & ~last.isin("html", "body", "article", "main"))
    chosen = stored(chosen.select("host", "path", importance.alias("importance")), "pages-low")
    holders = chosen.where(F.col("importance") < low).select("host", F.col("path").alias("above"))
    over = F.transform(F.sequence(F.lit(1), F.size(steps) - 1), lambda k: F.array_join(F.slice(steps, F.lit(1), k), "/"))
    held = chosen.select("host", "path", F.explode(over).alias("above")).join(holders, ["host", "above"], "left_semi").select("host", "path").distinct()
    left = chosen.join(held, ["host", "path"], "left_anti")
    return left.groupBy("host").agg(F.map_from_entries(F.collect_list(F.struct("path", "importance"))).alias("paths"))


def main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every row."""
    prepare(pages.sparkSession)
    branches = stored(low_branches(style_tree(pages)), "pages-branches")
    hosts = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^\s*[a-zA-Z][a-zA-Z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html", hosts.alias("__host"))
    rows = rows.join(branches.withColumnRenamed("host", "__host"), "__host", "left").select("page_id", "url", "html", "paths")

    def make():
        def step(batch: pa.RecordBatch):
            cols = [batch.column(k).to_pylist() for k in (2, 3)]
            texts = []
            for source, paths in zip(*cols):
                texts.append(Page(source, dict(paths or ())).text())
            yield {"page_id": batch.column(0), "url": batch.column(1), "text": texts, "n_chars": [len(t) for t in texts]}

        return step

    return map_batches(rows, make, "page_id long, url string, text string, n_chars long")
