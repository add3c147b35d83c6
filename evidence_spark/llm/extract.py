"""Main text of web pages by consensus host paths.

1. Each page is cut into blocks of text, without scripts, styles and other boilerplate elements. Every container around the blocks is
   scored: the text it holds outside links, less a tenth per level between. The best one's generalised path (tags and classes, numbers
   replaced) is the page's vote.
2. Votes are counted per host in Spark; each host has one winning path.
3. Each page is read again and its text taken from the containers at its host's winning path. A page without text there uses its own best. So does
   a page of another template: its own best path lies beside the winning one, holds more unlinked text, and another page of the host voted for it too.

Reading is linear in the page: containers are linked nodes, open elements are found by tag, and a tag that never ends takes the rest of the page.
"""

from __future__ import annotations

import html as entities
import re
import zlib
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evidence_spark.llm.urls import host_of
from evidence_spark.session import cut, small

MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<(?P<raw>script|style|noscript|template|textarea|title|iframe|svg|select)\b[^>]*+>.*?(?:</(?P=raw)\s*>|\Z)|<[!?][^>]*+>?"
    r"|<(?P<close>/?)(?P<tag>[a-zA-Z][^\s/>]*+)(?P<attrs>(?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+'|))*+)>|</?[a-zA-Z].*\Z", re.S | re.I)
ATTRIBUTE = re.compile(r"([a-zA-Z-]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
BLOCKS = set("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol "
             "p pre search section summary table tbody td tfoot th thead tr ul head".split())
CONTAINERS = {"html", "body", "div", "section", "article", "main", "td", "center"}
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that never hold article text. Forms and class-marked elements are dropped unless they hold most of the page.
DROPPED = set("head nav footer aside button object canvas video audio dialog menu label search".split())
#: First or last word of a class, id or role that marks boilerplate, and words before it that say it is absent or elsewhere.
WORDS = set("ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion cookie cookies consent gdpr notice notices notification alert popup modal overlay newsletter subscribe "
            "subscription signup paywall nav navbar navigation menu breadcrumb breadcrumbs sidebar aside complementary widget widgets footer contentinfo share sharing social related recommended comment comments disqus "
            "reply replies respond discussion pagination pager login search form skip hidden copyright".split())
#: Words of discussions, which are often longer than what they discuss; and the share of a page's unlinked text above which marks are not
#: believed, the larger one for discussions and beside an article or main element with text.
DISCUSSION = set("comment comments disqus reply replies respond discussion".split())
MOST, ALMOST_ALL = 0.5, 0.9
TOP = {"header", "masthead", "topbar", "toolbar"}
ABSENT = {"no", "with", "has", "without", "not"}
#: What an opening tag closes that has no end tag of its own, and where the search for it stops.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPE = {"li": {"ul", "ol"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table"}, "th": {"table"}}
DECAY, ARTICLE = 0.9, 1.5


@dataclass(slots=True, eq=False)
class Node:
    """A container: its generalised path is its parent's, a slash and its name."""
    parent: Node | None
    name: str
    length: int  # of the path
    check: int
    level: int

    @classmethod
    def under(cls, parent: Node | None, name: str) -> Node:
        step = ("/" + name).encode("utf-8", "surrogatepass")
        if parent is None:
            return cls(None, name, len(name) + 1, zlib.crc32(step), 0)
        return cls(parent, name, parent.length + len(name) + 1, zlib.crc32(step, parent.check), parent.level + 1)

    def path(self) -> str:
        names, node = [], self
        while node is not None:
            names.append(node.name)
            node = node.parent
        return "/" + "/".join(reversed(names))


@dataclass
class Block:
    text: str
    node: Node | None  # the innermost container
    linked: int

    @property
    def unlinked(self) -> int:
        return len(self.text) - self.linked


@dataclass(slots=True)
class Element:
    tag: str
    node: Node | None = None
    dropped: bool = False
    never: bool = False  # dropped whatever it holds
    mark: int = -1  # the innermost form or class-marked element around its text
    linked: bool = False
    inside: bool = False  # an article or main element, or in one


OUTSIDE = Element("")


@dataclass
class Reader:
    by_class: bool = True
    kept: frozenset[int] = frozenset()  # marks that are not believed
    total: int = 0  # unlinked text, dropped by marks or not
    shares: list[float] = field(default_factory=list)  # of each mark: the share that it must exceed
    around: list[int] = field(default_factory=list)  # of each mark: the mark around it
    held: list[int] = field(default_factory=list)  # of each mark: its unlinked text, after ``finish`` with that of the marks in it
    articles: int = 0  # unlinked text in article and main elements
    beside: list[int] = field(default_factory=list)  # of each mark: how much of that it holds
    within: list[bool] = field(default_factory=list)  # of each mark: whether it is in such an element
    stack: list[Element] = field(default_factory=list)
    places: dict[str, list[int]] = field(default_factory=dict)  # of each tag: where it is on the stack
    containers: list[int] = field(default_factory=list)  # where containers are on the stack
    walls: list[int] = field(default_factory=list)  # where block elements are on the stack
    blocks: list[Block] = field(default_factory=list)
    buffer: list[str] = field(default_factory=list)
    linked: int = 0

    @property
    def top(self) -> Element:
        return self.stack[-1] if self.stack else OUTSIDE

    def flush(self) -> None:
        if self.buffer:
            text = " ".join(entities.unescape("".join(self.buffer)).split())
            if text:
                self.blocks.append(Block(text, self.top.node, min(self.linked, len(text))))
            self.buffer.clear()
        self.linked = 0

    def finish(self) -> None:
        """Text of inner marks counts for the marks around them; these are older."""
        self.flush()
        for k in range(len(self.held) - 1, -1, -1):
            if (outer := self.around[k]) >= 0:
                self.held[outer] += self.held[k]
                self.beside[outer] += self.beside[k]

    def data(self, text: str) -> None:
        top = self.top
        if not text or top.never:
            return
        n = len(text.strip())
        if not top.linked:
            self.total += n
            article = n if top.inside else 0
            self.articles += article
            if top.mark >= 0:
                self.held[top.mark] += n
                self.beside[top.mark] += article
        if not top.dropped:
            self.buffer.append(text)
            if top.linked:
                self.linked += n

    def never(self, tag: str, attrs: dict[str, str]) -> bool:
        if tag in DROPPED or "hidden" in attrs or re.search(r"display\s*:\s*none", attrs.get("style", "")):
            return True
        return tag == "header" and not self.inside(tag)

    def inside(self, tag: str) -> bool:
        return tag in ("article", "main") or self.top.inside

    def marked(self, tag: str, attrs: dict[str, str]) -> float | None:
        """The share of the page that a form or class-marked element must exceed to stay; none for other elements."""
        if tag == "form":
            return MOST
        if not self.by_class or tag in ("html", "body", "main"):
            return None
        inside, share = self.inside(tag), None
        for name in f"{attrs.get('class', '')} {attrs.get('id', '')} {attrs.get('role', '')}".lower().split():
            parts = [p for p in re.split(r"[^a-z]+", name) if p]
            if parts and not ABSENT & set(parts) and (parts[0] in WORDS or parts[-1] in WORDS or not inside and (parts[0] in TOP or parts[-1] in TOP)):
                share = max(share or 0.0, ALMOST_ALL if DISCUSSION & {parts[0], parts[-1]} else MOST)
        return share

    def share(self, mark: int) -> float:
        """The share of the page that a mark's element must exceed to stay, now that the page is read."""
        return ALMOST_ALL if not self.within[mark] and self.articles > self.beside[mark] else self.shares[mark]

    def open(self, tag: str, raw: str) -> None:
        if tag in BLOCKS:
            self.flush()
            self.pop({"p"}, {"td", "th", "button", "table"})
        if tag in CLOSES:
            self.pop(CLOSES[tag], SCOPE.get(tag, set()))
        above = self.top
        if tag in VOID:
            if tag == "br" and not above.dropped:
                self.buffer.append(" ")
            return
        attrs = {k.lower(): a or b or c for k, a, b, c in ATTRIBUTE.findall(raw)} if raw else {}
        never = above.never or self.never(tag, attrs)
        new = Element(tag, above.node, above.dropped or never, never, above.mark, above.linked or tag == "a", self.inside(tag))
        if not never and (share := self.marked(tag, attrs)) is not None:
            new.mark = len(self.held)
            new.dropped = new.dropped or new.mark not in self.kept
            self.shares.append(share)
            self.around.append(above.mark)
            self.held.append(0)
            self.beside.append(0)
            self.within.append(above.inside)
        at = len(self.stack)
        if tag in CONTAINERS and not new.dropped:
            classes = sorted(re.sub(r"\d+", "#", c) for c in attrs.get("class", "").split())
            new.node = Node.under(above.node, ".".join([tag, *classes]))
            self.containers.append(at)
        if tag in BLOCKS:
            self.walls.append(at)
        self.places.setdefault(tag, []).append(at)
        self.stack.append(new)

    def last(self, tag: str) -> int:
        found = self.places.get(tag)
        return found[-1] if found else -1

    def cut(self, at: int) -> None:
        """Everything from place ``at`` on is closed."""
        for k in range(len(self.stack) - 1, at - 1, -1):
            self.places[self.stack.pop().tag].pop()
        for where in (self.containers, self.walls):
            while where and where[-1] >= at:
                where.pop()

    def pop(self, tags: set[str], stop: set[str]) -> None:
        at = max(self.last(t) for t in tags)
        wall = max((self.last(t) for t in stop), default=-1)
        if "p" in tags and self.containers:
            wall = max(wall, self.containers[-1])
        if at >= 0 and at >= wall:
            self.cut(at)

    def close(self, tag: str) -> None:
        if tag in BLOCKS:
            self.flush()
        at = self.last(tag)
        # a stray inline end tag never closes a block
        if at >= 0 and (tag in BLOCKS or not self.walls or at > self.walls[-1]):
            self.cut(at)


def read_page(page: str, by_class: bool = True, kept: frozenset[int] = frozenset()) -> Reader:
    reader, at = Reader(by_class, kept), 0
    for m in MARKUP.finditer(page):
        reader.data(page[at: m.start()])
        at = m.end()
        if tag := m["tag"]:
            tag = tag.lower()
            if m["close"]:
                reader.close(tag)
            else:
                reader.open(tag, m["attrs"])
    reader.data(page[at:])
    reader.finish()
    return reader


def read_blocks(page: str, by_class: bool = True) -> list[Block]:
    """The text blocks of a page outside boilerplate elements, in order, each with the container around it. Pages are read
    again if a form or class-marked element turns out to hold most of their unlinked text; that element then stays."""
    reader = read_page(page, by_class)
    kept = frozenset(k for k, n in enumerate(reader.held) if n > reader.share(k) * reader.total)
    return read_page(page, by_class, kept).blocks if kept else reader.blocks


def page_blocks(page: str) -> list[Block]:
    """As ``read_blocks``; if class names alone make a page empty, they are not believed."""
    return read_blocks(page) or read_blocks(page, by_class=False)


def outwards(blocks: list[Block]) -> list[Node]:
    """The containers around the blocks, each once, inner ones before those around them."""
    seen: dict[int, Node] = {}
    for b in blocks:
        node = b.node
        while node is not None and id(node) not in seen:
            seen[id(node)] = node
            node = node.parent
    return sorted(seen.values(), key=lambda n: -n.level)


def best_container(blocks: list[Block]) -> tuple[str, float] | None:
    """Path and score of the best container: text outside links counts fully for the innermost container, a tenth less for each one further
    out; articles and main elements count half more. Ties go to the outer container. Text in no container counts for the empty path."""
    nodes = outwards(blocks)
    own: dict[int, float] = {}
    for b in blocks:
        own[id(b.node)] = own.get(id(b.node), 0.0) + b.unlinked
    scores: dict[tuple[int, int], list] = {}  # of each path: its score and one of its containers
    if id(None) in own:
        scores[0, 0] = [own[id(None)], None]
    for node in nodes:
        score = own.get(id(node), 0.0)
        if node.parent is not None:
            own[id(node.parent)] = own.get(id(node.parent), 0.0) + score * DECAY
        scores.setdefault((node.length, node.check), [0.0, node])[0] += score
    if not scores:
        return None
    for found in scores.values():
        if found[1] is not None and found[1].name.partition(".")[0] in ("article", "main"):
            found[0] *= ARTICLE
    most = max((f[0], -length) for (length, _), f in scores.items())
    return max(node.path() if node else "" for (length, _), (score, node) in scores.items() if (score, -length) == most), most[0]


def blocks_at(blocks: list[Block], path: str) -> list[Block]:
    """The blocks inside containers at ``path``; for the empty path those in no container."""
    length, check = len(path), zlib.crc32(path.encode("utf-8", "surrogatepass"))
    within: dict[int, bool] = {id(None): False}
    for node in reversed(outwards(blocks)):
        within[id(node)] = within[id(node.parent)] or (node.length == length and node.check == check and node.path() == path)
    return [b for b in blocks if within[id(b.node)] or not path and b.node is None]


def text_of(blocks: list[Block]) -> str:
    return "\n".join(b.text for b in blocks)


def text_at(blocks: list[Block], path: str | None) -> str:
    """The blocks inside containers at ``path``, or, where there are none, inside the page's own best container."""
    found = blocks_at(blocks, path) if path is not None else []
    if not found and (best := best_container(blocks)):
        found = blocks_at(blocks, best[0])
    return text_of(found)


def texts_at(blocks: list[Block], path: str | None) -> tuple[str, str | None, str | None]:
    """As ``text_at``, and, if the page's own best container lies beside ``path`` and holds more unlinked text, its path and text."""
    best = best_container(blocks)
    found = blocks_at(blocks, path) if path is not None else []
    if best is None or not found:
        return text_of(blocks_at(blocks, best[0])) if best else "", None, None
    own = best[0]
    if own.startswith(path) and own[len(path):len(path) + 1] in ("", "/") or path.startswith(own) and path[len(own):len(own) + 1] == "/":
        return text_of(found), None, None
    other = blocks_at(blocks, own)
    if sum(b.unlinked for b in other) > sum(b.unlinked for b in found):
        return text_of(found), own, text_of(other)
    return text_of(found), None, None


def vote_paths(pages: DataFrame) -> DataFrame:
    """(host, path, votes, score): the paths that the pages of a host vote for."""
    def run(frames):
        import pyarrow as pa

        for frame in frames:
            best = [best_container(page_blocks(h.as_py() or "")) for h in frame.column("html")]
            kept = [k for k, b in enumerate(best) if b]
            yield pa.RecordBatch.from_arrays([frame.column("host").take(pa.array(kept, pa.int64())), pa.array([best[k][0] for k in kept], pa.string()), pa.array([best[k][1] for k in kept], pa.float64())], ["host", "path", "score"])

    votes = pages.select(host_of(F.col("url")).alias("host"), "html").mapInArrow(run, "host string, path string, score double")
    return votes.groupBy("host", "path").agg(F.count(F.lit(1)).alias("votes"), F.sum("score").alias("score"))


def winning_paths(votes: DataFrame) -> DataFrame:
    """(host, path): the path with most votes of each host; ties go to the larger summed score, then to the smaller path."""
    most = votes.groupBy("host").agg(F.max(F.struct("votes", F.round("score").alias("score"))).alias("_most"))
    tied = votes.join(small(most), "host").where((F.col("votes") == F.col("_most.votes")) & (F.round("score") == F.col("_most.score")))
    return tied.groupBy("host").agg(F.min("path").alias("path"))


def extract_pages(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every page.

    Null and empty html give an empty text. Pages without a host vote and are read together under the empty host. Repeated rows are
    extracted each; other columns are not read; an empty table gives no rows. Paths are broadcast while few, else joined by shuffle.
    """
    votes = cut(vote_paths(pages))
    won = cut(winning_paths(votes).select(F.col("host").alias("_won"), F.col("path").alias("_path")))
    shared = votes.where("votes > 1").select(F.col("host").alias("_of"), F.col("path").alias("_shared"))
    rows = pages.select("page_id", "url", "html", host_of(F.col("url")).alias("_host"))
    joined = rows.join(small(won), F.col("_host") == F.col("_won"), "left").select("page_id", "url", "html", "_host", "_path")
    kind = pages.schema["page_id"].dataType.simpleString()

    def run(frames):
        import pyarrow as pa

        for frame in frames:
            texts = [texts_at(page_blocks(h.as_py() or ""), p) for h, p in zip(frame.column("html"), frame.column("_path").to_pylist(), strict=True)]
            columns = [pa.array([t[k] for t in texts], pa.string()) for k in range(3)]
            yield pa.RecordBatch.from_arrays([frame.column("page_id"), frame.column("url"), frame.column("_host"), *columns], ["page_id", "url", "_host", "_text", "_own", "_other"])

    read = joined.mapInArrow(run, f"page_id {kind}, url string, _host string, _text string, _own string, _other string")
    # another template of the host: its path has the votes of at least two pages
    agreed = read.join(small(shared), (F.col("_host") == F.col("_of")) & (F.col("_own") == F.col("_shared")), "left")
    text = F.when(F.col("_shared").isNotNull(), F.col("_other")).otherwise(F.col("_text"))
    return agreed.select("page_id", "url", text.alias("text")).withColumn("n_chars", F.length("text").cast("long"))
