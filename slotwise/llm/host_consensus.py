"""Main text of web pages by a vote of all pages of a host.

Every page scores its containers: text in their own blocks counts, link text counts against them, a part goes up to the
parent. It votes, with that score, for the generalised path of its best container: tags and classes from the body down,
digits made alike. Spark adds the votes by host and path; each page is then extracted again with its host's winning path.
A page that lacks the path falls back to its own best container.

Text: character references decoded, white space inside a block as one blank, trimmed, blocks joined by an empty line.
Menus, headers, footers, sidebars, notices, adverts, forms, comments, scripts and styles are left out by tag, role and
class words. Class and id words are judged when the whole page is read: words behind with-, no-, has- and the like say
nothing; a container that holds the page's main part, or most of the page's text while no main part stands elsewhere,
stays; inside an article a word of a compound name counts only where most of the text is links.

Cases: null or empty html, and a page without text, give an empty text; a null url is a host of its own; unclosed tags
end where their parent ends; unclosed comments, scripts and styles run to the end; ties of votes go to the smaller path;
repeated rows stay; extra columns are not read.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotwise.llm.textops import documents
from slotwise.session import scratch_path

#: Hosts whose winning paths may be sent to every worker; beyond that pages are joined by host.
BROADCAST_HOSTS = 50_000
LINK_PENALTY = 3
PARENT_SHARE = 0.5

# Element names and class words.
BLOCKS = set(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hr html legend li main nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
CONTAINERS = set("article aside blockquote body center details div dl fieldset figure footer form header html main nav ol section table td ul".split())
DROPPED_TAGS = set("aside button dialog footer form head iframe nav noscript object select svg template textarea".split())
DROPPED_ROLES = set("navigation banner contentinfo complementary search dialog alert form".split())
DROPPED_WORDS = set(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice "
    "nav navbar navigation menu breadcrumb breadcrumbs masthead footer sidebar widget comment comments disqus respond share "
    "sharing social related newsletter subscribe popup modal signup login toolbar pagination pager skip".split()
)
HEADER_WORDS = set("header topbar".split())
MAIN_WORDS = set("article body content entry main post story text".split())
MODIFIERS = set("with without no not has have hide hidden is".split())
#: A container holds most of a page's or of its own text beyond this share.
LARGER_SHARE = 0.5

_NAME = re.compile(r"(/?)([a-zA-Z][\w:-]*)")
_RAW = re.compile(r"(script|style)\b", re.I)
_RAW_END = {name: re.compile(rf"</{name}\s*>", re.I) for name in ("script", "style")}
_SPECIAL = re.compile(r"[>\"']")
_ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_WORD = re.compile(r"[^a-z0-9]+")
_DIGITS = re.compile(r"\d+")


@dataclass(slots=True)
class Node:
    tag: str
    step: str
    parent: Node | None
    dropped: bool
    article: bool
    favoured: bool
    suspect: bool = False
    compound: bool = False
    score: float = 0.0
    chars: int = 0
    linked: int = 0
    #: Nearest container and nearest suspect above; whether something favoured lies between here and that suspect.
    holder: Node | None = None
    watcher: Node | None = None
    shaded: bool = False
    holds_main: bool = False
    #: Steps of the winning path that lead here, -1 off the path; inside what is extracted.
    on_path: int = -1
    inside: bool = False

    def __post_init__(self):
        up = self.parent
        if up is not None:
            self.holder = up if up.tag in CONTAINERS else up.holder
            self.watcher = up if up.suspect else up.watcher
            self.shaded = not up.suspect and (up.favoured or up.shaded)


def path_of(node: Node) -> str:
    """Steps from the page down to a node; a step holds no blank."""
    steps = []
    while node is not None:
        steps.append(node.step)
        node = node.parent
    return " ".join(reversed(steps))


def _next_special(page: str, here: int) -> int:
    found = _SPECIAL.search(page, here)
    return found.start() if found else len(page)


def tokens(page: str) -> Iterator[tuple[int, int, str, str, str]]:
    """Start, end, slash, lower-case name and attributes of every tag; comments, declarations, scripts and styles have no name.

    One walk over the page: where a tag does not end, the quotes and brackets tried are remembered and not tried again.
    """
    dead: set[int] = set()
    missing: set[str] = set()
    looked, first = 0, -1
    at = page.find("<")
    while at >= 0:
        end, slash, name, attributes = -1, "", "", ""
        if page.startswith("<!--", at):
            end = page.find("-->", at + 4)
            end = len(page) if end < 0 else end + 3
        elif (raw := _RAW.match(page, at + 1)) and ">" not in missing:
            end = page.find(">", raw.end())
            if end < 0:
                missing.add(">")
            else:
                close = _RAW_END[raw[1].lower()].search(page, end + 1)
                end = close.end() if close else len(page)
        elif page[at + 1 : at + 2] in ("!", "?") and ">" not in missing:
            end = page.find(">", at + 2) + 1 or -1
            if end < 0:
                missing.add(">")
        elif (m := _NAME.match(page, at + 1)) and ">" not in missing:
            if not looked <= m.end() <= first:
                looked, first = m.end(), _next_special(page, m.end())
            special, tried = first, []
            while special < len(page) and special not in dead:
                tried.append(special)
                mark = page[special]
                if mark == ">":
                    end, slash, name, attributes = special + 1, m[1], m[2].lower(), page[m.end() : special]
                    break
                close = page.find(mark, special + 1) if mark not in missing else -1
                if close < 0:
                    missing.add(mark)
                    break
                special = _next_special(page, close + 1)
            if end < 0:
                dead.update(tried)
        if end >= 0:
            yield at, end, slash, name, attributes
        at = page.find("<", max(end, at + 1))


def _attributes(text: str) -> dict[str, str]:
    return {m[1].lower(): (m[2] or m[3] or m[4] or "").lower() for m in _ATTRIBUTE.finditer(text)} if "=" in text else {}


def _names(names: list[str]) -> tuple[set[str], set[str]]:
    """Words of class and id names up to a modifier, and the names that are one word."""
    words, single = set(), set()
    for name in names:
        parts = [w for w in _WORD.split(name) if w]
        if len(parts) == 1:
            single.add(parts[0])
        for word in parts:
            if word in MODIFIERS and len(parts) > 1:
                break
            words.add(word)
    return words, single


def _node(tag: str, attributes: str, parent: Node | None) -> Node:
    held = _attributes(attributes)
    classes = sorted(held.get("class", "").split())
    words, single = _names([*classes, *held.get("id", "").split()])
    inside = bool(parent and parent.article)
    article = tag in ("article", "main") or inside
    dropped = bool(parent and parent.dropped) or tag in DROPPED_TAGS or held.get("role", "") in DROPPED_ROLES
    if tag not in ("html", "body", "main", "article"):
        dropped |= not article and tag == "header"
    judged = DROPPED_WORDS if article else DROPPED_WORDS | HEADER_WORDS
    suspect = tag not in ("html", "body") and bool(words & judged)
    step = _DIGITS.sub("#", ".".join([tag, *classes]))
    favoured = tag in ("article", "main") or bool(words & MAIN_WORDS)
    return Node(tag, step, parent, dropped, article, favoured, suspect, inside and not single & judged)


def _drop_suspects(nodes: list[Node], owners: list[Node], sizes: list[tuple[int, int]]) -> None:
    """Settle the containers that class words name, by what they hold; ``nodes`` has parents before their children."""
    for node, (chars, linked) in zip(owners, sizes, strict=True):
        node.chars, node.linked = node.chars + chars, node.linked + linked
    for node in reversed(nodes[1:]):
        node.parent.chars, node.parent.linked = node.parent.chars + node.chars, node.parent.linked + node.linked
    # Suspects that hold a main part by tag; text of outermost main parts, by nearest suspect around them.
    held: dict[int | None, int] = {}
    for node in reversed(nodes):
        main = not (node.dropped or node.suspect) and node.favoured and node.chars > 0
        if main and not node.shaded:
            held[id(node.watcher) if node.watcher else None] = held.get(id(node.watcher) if node.watcher else None, 0) + node.chars
        if node.parent is not None:
            node.parent.holds_main |= node.holds_main or main and node.tag in ("article", "main")
    clean, whole = held.get(None, 0), nodes[0].chars
    for node in nodes:
        if node.parent is not None and node.parent.dropped:
            node.dropped = True
        if node.dropped or not node.suspect or node.tag in ("article", "main"):
            continue
        main = node.holds_main or held.get(id(node), 0) > clean
        larger = node.chars > LARGER_SHARE * whole and not clean
        prose = node.compound and node.linked <= LARGER_SHARE * node.chars
        node.dropped = not (main or larger or prose)


def parse(page: str) -> tuple[list[str], list[Node], list[Node]]:
    """Blocks of text in page order, the node each lies in, and all nodes, parents before their children."""
    root = Node("html", "html", None, False, False, False)
    stack, every, blocks, owners = [root], [root], [], []
    #: Places in the stack of every open tag, and of all containers.
    opened: dict[str, list[int]] = {}
    containers = [0]
    sizes: list[tuple[int, int]] = []
    parts: list[str] = []
    links = linked = 0

    def close() -> None:
        nonlocal linked
        text = " ".join(html.unescape("".join(parts)).split())
        parts.clear()
        if text and not stack[-1].dropped:
            owner = stack[containers[-1]]
            blocks.append(text)
            owners.append(stack[-1])
            sizes.append((len(text), min(linked, len(text))))
            owner.score += max(0, len(text) - LINK_PENALTY * linked)
        linked = 0

    def leave(place: int) -> None:
        for node in reversed(stack[place:]):
            opened[node.tag].pop()
            if node.tag in CONTAINERS:
                containers.pop()
        del stack[place:]

    at = 0
    for start, end, slash, tag, attributes in tokens(page):
        if start > at:
            parts.append(page[at:start])
            linked += (start - at) * (links > 0)
        at = end
        if not tag:
            continue
        if tag == "a":
            links = max(0, links + (-1 if slash else 1))
        if tag == "br":
            parts.append(" ")
        if tag not in BLOCKS and tag not in DROPPED_TAGS:
            continue
        close()
        links = 0
        if slash:
            place = opened[tag][-1] if opened.get(tag) else 0
            if place > (0 if tag in CONTAINERS or tag in DROPPED_TAGS else containers[-1]):
                leave(place)
            continue
        if tag == "hr" or attributes.endswith("/"):
            continue
        if tag in ("html", "body") and opened.get(tag):
            continue
        while len(stack) > 1 and (stack[-1].tag in ("p", "h1", "h2", "h3", "h4", "h5", "h6") or stack[-1].tag == tag == "li" or stack[-1].tag == "head" and tag == "body"):
            leave(len(stack) - 1)
        if tag != "html":
            opened.setdefault(tag, []).append(len(stack))
            if tag in CONTAINERS:
                containers.append(len(stack))
            stack.append(_node(tag, attributes, stack[-1]))
            every.append(stack[-1])
    if at < len(page):
        parts.append(page[at:].split("<", 1)[0] if re.match(r"[^<]*<[a-zA-Z/!]", page[at:]) else page[at:])
    close()
    _drop_suspects(every, owners, sizes)
    held = [k for k, n in enumerate(owners) if not n.dropped]
    for n in every:
        n.score *= not n.dropped
    return [blocks[k] for k in held], [owners[k] for k in held], every


def best_container(every: list[Node]) -> Node | None:
    """The container with the highest score after a part of each went up to its parent."""
    nodes = [n for n in every if n.tag in CONTAINERS]
    total = {id(n): n.score * (1.5 if n.favoured else 1.0) for n in nodes}
    for n in nodes:
        if n.holder is not None:
            total[id(n.holder)] += PARENT_SHARE * n.score
    some = [n for n in nodes if not n.dropped and total[id(n)] > 0]
    most = max((total[id(n)] for n in some), default=0.0)
    equal = [n for n in some if total[id(n)] == most]
    return max(equal, key=path_of) if len(equal) > 1 else equal[0] if equal else None


def vote(page: str | None) -> tuple[str | None, float]:
    best = best_container(parse(page or "")[2])
    return (path_of(best), best.score) if best else (None, 0.0)


def extract(page: str | None, path: str | None) -> str:
    """Blocks inside the containers at ``path``, or inside the page's own best container."""
    blocks, owners, nodes = parse(page or "")
    steps = path.split(" ") if path else []
    chosen = False
    for n in nodes:
        before = n.parent.on_path if n.parent else 0
        if 0 <= before < len(steps) and steps[before] == n.step:
            n.on_path = before + 1
        n.inside = n.on_path == len(steps) > 0 and n.tag in CONTAINERS and not n.dropped
        chosen |= n.inside
    if not chosen and (best := best_container(nodes)):
        best.inside = True
    for n in nodes[1:]:
        n.inside |= n.parent.inside
    return "\n\n".join(b for b, n in zip(blocks, owners, strict=True) if n.inside)


def _rows(batches: Iterable[pa.RecordBatch], size: int = 256) -> Iterator[list[dict]]:
    for batch in batches:
        for at in range(0, batch.num_rows, size):
            yield batch.slice(at, size).to_pylist()


def winning_paths(pages: DataFrame) -> DataFrame:
    """The path with most votes of every host; votes are added before the shuffle."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _rows(batches):
            votes = [(r["host"], *vote(r["html"])) for r in rows]
            yield pa.RecordBatch.from_arrays(
                [pa.array([v[k] for v in votes], t) for k, t in enumerate((pa.string(), pa.string(), pa.float64()))],
                ["host", "path", "votes"],
            )

    votes = pages.select("host", "html").mapInArrow(run, "host string, path string, votes double").where("path is not null")
    votes = votes.groupBy("host", "path").agg(F.sum(F.log1p("votes")).alias("votes"))
    best = F.min(F.struct((-F.round("votes", 6)).alias("votes"), "path")).getField("path")
    return votes.groupBy("host").agg(best.alias("path"))


def main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every page."""
    spark = pages.sparkSession
    host = F.coalesce(F.lower(F.regexp_extract("url", r"^[A-Za-z][\w+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))
    pages = documents(pages, "page_id", "url", "html").withColumn("host", host)
    path = scratch_path(spark, "paths")
    winning_paths(pages).write.parquet(path)
    winners = spark.read.parquet(path)
    if winners.count() <= BROADCAST_HOSTS:
        winners = F.broadcast(winners)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _rows(batches):
            texts = [extract(r["html"], r["path"]) for r in rows]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([r["page_id"] for r in rows], pa.int64()),
                    pa.array([r["url"] for r in rows], pa.string()),
                    pa.array(texts, pa.string()),
                    pa.array([len(t) for t in texts], pa.int64()),
                ],
                ["page_id", "url", "text", "n_chars"],
            )

    joined = pages.join(winners, "host", "left").select("page_id", "url", "html", "path")
    return joined.mapInArrow(run, "page_id long, url string, text string, n_chars long")
