"""Main text of web pages by host consensus.

Every page scores its own containers. Their paths, generalised to tags and classes
without numbers, are votes, summed per host in Spark. Each page is then read again
and its text taken from the containers on the paths its host agreed on, with the
article they lie in, or the headings and leads around them.
"""

from __future__ import annotations

import hashlib
import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillforge.session import stage

# Fixed values of HTML: elements by what they do to the text.
RAW = "script|style|noscript|template|textarea|title|iframe|xmp|noembed|noframes"
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table "
    "tbody td tfoot th thead tr ul".split()
)
#: Elements that a page's text can lie in.
CONTAINERS = frozenset("article body center div fieldset main section table tbody td tr".split())
#: Elements that hold a stretch of an article's prose.
PROSE = frozenset("blockquote dd dt figcaption figure h1 h2 h3 h4 h5 h6 li ol p pre td th ul".split())
#: What closes an open p, li, and so on, without an end tag.
CLOSED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
#: Elements that such an implied end does not reach out of.
SCOPE = frozenset("ul ol dl table select article aside blockquote div section main nav form body".split())
NOT_TEXT = frozenset("aside button canvas datalist dialog footer form head input math menu meter nav object output progress search select svg video audio map".split())
NOT_ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split())
NOT_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored sponsors promo promotion promoted banner sidebar sidenav menu menus nav "
    "navbar navigation breadcrumb breadcrumbs footer header masthead topbar cookie cookies consent gdpr notice notices alert modal popup overlay "
    "newsletter subscribe subscription signup login share sharing social related recommended recommendations comment comments respond replies "
    "disqus search toolbar widget widgets pagination pager skip disclaimer copyright form".split()
)

ATTRIBUTES = r"(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+"
TOKEN = re.compile(
    rf"<!--(?:-?>|(?s:.*?)(?:--!?>|\Z))|<(?P<raw>{RAW})(?=[\s/>]){ATTRIBUTES}>(?s:.*?)(?:</(?P=raw)(?=[\s/>])[^>]*+>|\Z)"
    rf"|<(?P<end>/?)(?P<tag>[a-z][^\s/>]*+)(?P<attributes>{ATTRIBUTES})>|<(?P<end2>/?)(?P<tag2>[a-z][^\s/>]*+)[^>]*+>|<[!?/][^>]*+>|<[a-z/!?](?s:.*)\Z",
    re.IGNORECASE,
)
ATTRIBUTE = re.compile(r"([^\s=\"'/>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
NAME_PARTS = re.compile(r"[a-z]+|[A-Z][a-z]*|[A-Z]+(?![a-z])")
#: Attributes that can matter, and elements that depend on where they stand.
NAMED = re.compile(r"class|id|role|hidden|style", re.IGNORECASE)
LANDMARKS = frozenset({"header"})
#: Elements that are one article with all they hold.
WHOLE = frozenset({"article", "main"})
#: A path beside the best one wins too with so large a part of its vote, and of the whole host's (so at most 20 win).
BESIDE_BEST, OF_HOST = 1 / 3, 1 / 20
#: A longer path goes on from its digest.
LONGEST_PATH = 1000
HIDDEN_STYLE = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.IGNORECASE)


@dataclass(slots=True)
class Node:
    """An element. ``drop``: 2 its tag is never text, 1 its names say so; ``doubtful``: they do, but it holds most of the page."""

    tag: str
    parent: int
    path: str
    drop: int = 0
    link: bool = False
    runs: list[tuple[int, int]] = field(default_factory=list)
    chars: int = 0
    links: int = 0
    score: float = 0.0
    doubtful: bool = False


def describe(tag: str, attributes: str, in_article: bool) -> tuple[str, int]:
    """Generalised step of the path and ``drop``."""
    if not attributes or attributes.isspace():
        names: dict[str, str] = {}
    else:
        names = {m[1].lower(): html.unescape(m[2] or m[3] or m[4] or "") for m in ATTRIBUTE.finditer(attributes)}
    drop = 2 if tag in NOT_TEXT else 0
    if tag == "header" and not in_article:
        drop = 2
    classes = names.get("class", "").split()
    step = ".".join([tag, *sorted({re.sub(r"\d+", "#", c) for c in classes})])
    if not drop and names and tag not in {"html", "body", "main", "article"}:
        hidden = "hidden" in names or names.get("aria-hidden", "").lower() == "true" or HIDDEN_STYLE.search(names.get("style", ""))
        # An id on a paragraph of an article is an anchor to it more likely than a name for what it is.
        named = classes if in_article and tag in PROSE else [*classes, names.get("id", "")]
        words = {p.lower() for c in named for p in NAME_PARTS.findall(c)}
        if hidden or names.get("role", "").lower() in NOT_ROLES:
            drop = 2
        elif words & NOT_NAMES:
            drop = 1
    return step, drop


def read_page(text: str) -> tuple[list[Node], list[tuple[int, str, int]]]:
    """(elements, runs of text): a run is (element, text, block), blocks counted in page order."""
    nodes, runs, stack, block, at = [Node("", -1, "")], [], [0], 0, 0
    # Places in the stack of the open elements: by tag, of those that bound implied ends, and of blocks.
    places: dict[str, list[int]] = {}
    scopes, open_blocks = [0], [0]
    containers = CONTAINERS | NOT_TEXT

    def leave(to: int) -> None:
        while len(stack) > to:
            places[nodes[stack.pop()].tag].pop()
        while scopes[-1] >= to:
            scopes.pop()
        while open_blocks[-1] >= to:
            open_blocks.pop()

    for m in TOKEN.finditer(text):
        start = m.start()
        if start > at:
            piece = text[at:start]
            runs.append((stack[-1], html.unescape(piece) if "&" in piece else piece, block))
        at = m.end()
        _, end, tag, attributes, end2, tag2 = m.groups()
        tag = tag or tag2
        if not tag:
            continue
        tag = tag.lower()
        is_block = tag in BLOCKS
        if is_block:
            block += 1
        elif tag == "br":
            runs.append((stack[-1], " ", block))
        if end or end2:
            if own := places.get(tag):
                # An inline end tag does not close blocks.
                if is_block or open_blocks[-1] < own[-1]:
                    leave(own[-1])
            continue
        if tag in VOID:
            continue
        if is_block:
            # A block ends an open p, with the inline elements in it; li, td and so on end the one before.
            if (own := places.get("p")) and own[-1] > scopes[-1]:
                leave(own[-1])
            for before in CLOSED_BY.get(tag, ()):
                if (own := places.get(before)) and own[-1] > scopes[-1]:
                    leave(own[-1])
        parent = nodes[stack[-1]]
        if attributes and NAMED.search(attributes) or tag in LANDMARKS:
            step, drop = describe(tag, attributes or "", bool(places.get("article") or places.get("main")))
        else:
            step, drop = tag, 2 if tag in NOT_TEXT else 0
        path = parent.path
        if tag in containers:
            path = f"{path if len(path) < LONGEST_PATH else hashlib.md5(path.encode()).hexdigest()}>{step}"
        places.setdefault(tag, []).append(len(stack))
        if tag in SCOPE:
            scopes.append(len(stack))
        if is_block:
            open_blocks.append(len(stack))
        nodes.append(Node(tag, stack[-1], path, drop, parent.link or tag == "a"))
        stack.append(len(nodes) - 1)
    if at < len(text):
        runs.append((stack[-1], html.unescape(text[at:]), block))
    return nodes, runs


def judge(nodes: list[Node], runs: list[tuple[int, str, int]]) -> None:
    """Set chars, links and score, and settle which elements are dropped.

    An element that only its names speak against stays if it holds most of the page's text.
    """
    for k, piece, _ in runs:
        nodes[k].chars += (n := len(piece.strip()))
        nodes[k].links += n * nodes[k].link
    total = [n.chars for n in nodes]
    for k in range(len(nodes) - 1, 0, -1):
        total[nodes[k].parent] += total[k] if nodes[k].drop < 2 else 0
    for k, node in enumerate(nodes):
        if node.drop == 1 and 2 * total[k] > total[0]:
            node.drop, node.doubtful = 0, True
        if k and nodes[node.parent].drop:
            node.drop = 2
    for k in range(len(nodes) - 1, 0, -1):
        node, parent = nodes[k], nodes[nodes[k].parent]
        if node.drop:
            continue
        node.score += max(0, node.chars - 2 * node.links)
        if node.tag in CONTAINERS:
            # Part of what a container holds counts for the one around it.
            parent.score += 0.6 * node.score
            node.score *= (1.5 if node.tag in WHOLE else 1.0) * (0.25 if node.doubtful else 1.0)
        else:
            parent.score += node.score
            parent.chars += node.chars
            parent.links += node.links


def best_paths(nodes: list[Node], most: int | None = None) -> list[tuple[str, float]]:
    """The scored paths of a page, best first, and their shares of its vote."""
    scores: dict[str, float] = {}
    for node in nodes:
        if node.tag in CONTAINERS and not node.drop and node.score > 0:
            scores[node.path] = scores.get(node.path, 0.0) + node.score
    top = sorted(scores.items(), key=lambda x: (-x[1], x[0]))[:most]
    whole = sum(s for _, s in top)
    return [(p, s / whole) for p, s in top]


def text_on(paths: list[str] | None, nodes: list[Node], runs: list[tuple[int, str, int]]) -> str:
    """Text of the elements on the paths and of what belongs to them, one line per block; of all elements without paths.

    An article or main element around one of them is taken whole. Of other elements around them, what lies
    in no container of its own, such as a heading or a lead, is taken if it is not mostly links.
    """
    chosen = set(paths or ())
    roots = {k for k, n in enumerate(nodes) if n.tag in CONTAINERS and not n.drop and n.path in chosen}
    around: set[int] = set()
    for k in sorted(roots):
        seen: list[int] = []
        while k and k not in around and nodes[k].tag not in WHOLE:
            seen.append(k)
            k = nodes[k].parent
        if k and nodes[k].tag in WHOLE:
            roots.add(k)
        else:
            around.update(seen)
    within, holder = [paths is None], [0]
    for k, node in enumerate(nodes[1:], 1):
        within.append(within[node.parent] or k in roots)
        holder.append(k if node.tag in CONTAINERS else holder[node.parent])
    beside = {k for k in around if nodes[k].tag in CONTAINERS and 3 * nodes[k].links <= nodes[k].chars}
    blocks: dict[int, list[str]] = {}
    for k, piece, block in runs:
        if (within[k] or holder[k] in beside) and not nodes[k].drop:
            blocks.setdefault(block, []).append(piece)
    lines = (" ".join("".join(parts).split()) for parts in blocks.values())
    return "\n".join(line for line in lines if line)


def host_of(url: str | None) -> str | None:
    found = re.match(r"\s*(?:[a-z][a-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]+)", url or "", re.IGNORECASE)
    return found[1].lower() if found else None


def votes(pages: DataFrame) -> DataFrame:
    """host, path, vote of every page that has a host and text."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # Summed per batch: a batch of one host gives few rows.
            summed: dict[tuple[str, str], float] = {}
            for url, page in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if (host := host_of(url)) and page:
                    nodes, runs = read_page(page)
                    judge(nodes, runs)
                    for path, vote in best_paths(nodes):
                        summed[host, path] = summed.get((host, path), 0.0) + vote
            keys = list(summed)
            yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.string()), pa.array(list(summed.values()), pa.float64())], ["host", "path", "vote"])

    return pages.select("url", "html").mapInArrow(read, "host string, path string, vote double")


def winning_paths(pages: DataFrame) -> DataFrame:
    """host and its paths: that with most votes (the smaller path on a tie, votes compared to six places), and those beside it
    that hold much of the host's text too. Containers around the best path, which share its votes, are not beside it."""
    summed = stage(votes(pages).groupBy("host", "path").agg(F.round(F.sum("vote"), 6).alias("vote")))
    best = F.max_by(F.struct("path", "vote"), F.struct("vote", F.hash("path"), "path")).alias("best")
    of_host = summed.groupBy("host").agg(best, F.sum("vote").alias("whole"))
    compared = summed.join(of_host, "host")
    large = (F.col("vote") >= BESIDE_BEST * F.col("best.vote")) & (F.col("vote") >= OF_HOST * F.col("whole"))
    around = F.startswith("best.path", F.concat("path", F.lit(">")))
    return compared.where((F.col("path") == F.col("best.path")) | large & ~around).groupBy("host").agg(F.collect_list("path").alias("paths"))


def extract_main_text(pages: DataFrame) -> DataFrame:
    """Main text of every row of ``pages`` (page_id, url, html): page_id, url, text, n_chars.

    Null html and pages without text give an empty text. A page without a host, or without any
    container on its host's paths, is read by its own best path; a page without containers gives
    all its text. Repeated rows are read each on its own, pages of any length whole. Other columns are ignored.
    """
    winners = stage(winning_paths(pages))
    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))
    rows = rows.withColumn("host", F.lower(F.regexp_extract("url", r"^\s*(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]+)", 1)))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for page, paths in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                nodes, runs = read_page(page or "")
                judge(nodes, runs)
                if not any(n.path in (paths or ()) and n.tag in CONTAINERS and n.score > 0 and not n.drop for n in nodes):
                    paths = [p for p, _ in best_paths(nodes, 1)] or None
                texts.append(text_on(paths, nodes, runs))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], ["page_id", "url", "text", "n_chars"])

    return rows.join(winners, "host", "left").select("page_id", "url", "html", "paths").mapInArrow(read, "page_id long, url string, text string, n_chars long")
