"""Main text of web pages by consensus host paths.

Pages of one host share a template.  Every page scores its containers by how much of its
running text they hold, and votes for the generalised path of the best: tags and classes from
the root down, digits taken out.  Spark adds up the votes of each host; the winning path then says on
all pages of the host which container is the article, and the pages are extracted again from
that container.  A page without it uses its own best container.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from staylens.functions.workspace import stored

INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q ruby rt rp "
    "s samp small span strike strong sub sup time tt u var wbr canvas object "
    "math mi mn mo ms mtext mspace mrow mfrac msqrt mroot msub msup msubsup munder mover munderover mstyle mpadded mtable mtr "
    "mtd semantics annotation".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())  # no parts of their own, whatever their classes say
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CONTAINERS = frozenset("body main article section div td center blockquote".split())
DROPPED = frozenset(
    "head script style template svg iframe nav aside footer form button select "
    "textarea input option datalist dialog menu audio video".split()
)
# class and id words of parts that are not the article, unless the element holds it
PARTS = frozenset(
    "ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promotion sidebar menu nav "
    "navbar navigation breadcrumb breadcrumbs cookie cookies consent gdpr notice notices notification alert popup modal "
    "overlay comment comments disqus respond discussion replies share sharing social related recommended footer masthead "
    "topbar newsletter subscribe subscription signup login widget toolbar pagination pager search skip".split()
)
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar form".split())
KEPT = frozenset(("html", "body", "main", "article"))  # whatever their classes say
CLOSES_PARAGRAPH = frozenset(
    "address article aside blockquote center details dialog div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 "
    "h6 header hr main menu nav ol p pre section table ul".split()
)
CLOSED_BY = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "td": ("td", "th"), "th": ("td", "th"), "tr": ("tr", "td", "th"), "option": ("option",)}
BARRIERS = frozenset(("ul", "ol", "dl", "table", "html", "body"))
LABEL = re.compile(r"[\W\d_]+")
SAYS_WHAT_ELSE_IS_THERE = re.compile(r"(?<![a-z])(?:has|with|without|no)[^a-z\s]\S*")  # "with-sidebar" is no sidebar


def _named_as_part(named: dict) -> bool:
    words = SAYS_WHAT_ELSE_IS_THERE.sub(" ", f"{named.get('class') or ''} {named.get('id') or ''}".lower())
    return not PARTS.isdisjoint(re.split(r"[^a-z]+", words))


def _joined(parts: list[tuple[str, bool, int]]) -> tuple[str, int]:
    """Text of a block, and how many characters of it are links."""
    text = " ".join("".join(x[0] for x in parts).split())
    return text, min(sum(len(x[0]) for x in parts if x[1]), len(text))


def _worth(parts: list[tuple[str, bool, int]]) -> int:
    text, links = _joined(parts)
    return max(len(text) - 3 * links, 0)


def _with_inner(own: list[int], parents: list[int]) -> list[int]:
    """Sums over each node and all below it; a node's number is above its parent's."""
    out = list(own)
    for n in range(len(out) - 1, -1, -1):
        if parents[n] >= 0:
            out[parents[n]] += out[n]
    return out


def _from_outer(marked: list[bool], parents: list[int]) -> list[bool]:
    """Whether a node or one above it is marked."""
    out = list(marked)
    for n, parent in enumerate(parents):
        out[n] = out[n] or (parent >= 0 and out[parent])
    return out


class Page(HTMLParser):
    """Text blocks of a page, each with the innermost container around it.

    Tags of ``DROPPED`` go with all they hold.  What only its class, id or role, or its being a
    page's ``header``, marks as no part of the article is a suspect: it goes when the whole
    page is read and it holds neither the article nor most of the running text.

    Containers, suspects and paths are trees of numbers with their parents, so that time and
    memory grow with the number of elements, however deep they nest.
    """

    def __init__(self, html: str):
        super().__init__(convert_charrefs=True)
        self.open: list[tuple[str, int, bool, int, int]] = []  # tag, container, dropped, suspect, path, of the innermost ones
        self.count: Counter[str] = Counter()  # open elements by tag
        self.labels: list[tuple[int, str, int]] = [(-1, "", 0)]  # of each path: the path around it, tag and classes, length
        self.numbers: dict[tuple[int, str], int] = {}
        self.outer: list[int] = [-1]  # container around each container; the page is container 0
        self.path_of: list[int] = [0]
        self.inside: list[int] = []  # container of each block
        self.blocks: list[str] = []
        self.linked: list[int] = []
        self._text: list[tuple[str, bool, int]] = []  # data, in a link, suspect around it
        self._read: list[tuple[int, list]] = []  # of every block: container, text
        self._around = 0
        self._suspects: list[int] = []  # suspect around each suspect
        self._within: list[int] = [-1]  # suspect around every container
        self._articles: dict[int, bool] = {}  # article and main by number: is it main
        self.feed(html)
        self.close()
        self._cut()
        gone = self._gone()
        self.kept = [w < 0 or not gone[w] for w in self._within]
        for around, parts in self._read:
            text, links = _joined([x for x in parts if x[2] < 0 or not gone[x[2]]])
            if text:
                self.inside.append(around)
                self.blocks.append(text)
                self.linked.append(links)

    def _cut(self) -> None:
        if self._text:
            self._read.append((self._around, self._text))
            self._text = []

    def _gone(self) -> list[bool]:
        """Of each suspect, whether it goes: it or one around it has no main, no large article and not most of the running text.

        Comments and teasers may be articles too: those that are named as such, and those with
        less than half the running text of the largest one, save no suspect.
        """
        if not self._suspects:
            return []
        total, held, mass = 0, [0] * len(self._suspects), [0] * len(self.outer)
        for around, parts in self._read:
            worth = _worth(parts)
            total += worth
            mass[around] += worth
            apart = {x[2] for x in parts}
            for k in apart:
                if k >= 0:
                    held[k] += worth if len(apart) == 1 else _worth([x for x in parts if x[2] == k])
        held, mass = _with_inner(held, self._suspects), _with_inner(mass, self.outer)
        least = max((mass[n] for n, main in self._articles.items() if not main), default=0) / 2
        saved = [False] * len(held)
        for n, main in self._articles.items():
            k = self._within[n] if main or mass[n] >= least else -1
            while k >= 0 and not saved[k]:
                saved[k], k = True, self._suspects[k]
        return _from_outer([not s and m <= total / 2 for s, m in zip(saved, held, strict=True)], self._suspects)

    def _push(self, tag: str, attrs: list) -> None:
        named = dict(attrs)
        container, dropped, suspect, path = self.open[-1][1:] if self.open else (0, False, -1, 0)
        dropped = dropped or tag in DROPPED
        if not dropped and tag not in KEPT and tag not in HEADINGS:
            suspected = _named_as_part(named) or (named.get("role") or "").lower() in ROLES
            # a page's header goes, an article's own stays
            if suspected or (tag == "header" and not (self.count["article"] or self.count["main"])):
                self._suspects.append(suspect)
                suspect = len(self._suspects) - 1
        classes = sorted({c for c in (LABEL.sub("", x) for x in (named.get("class") or "").lower().split()) if c})
        label = ".".join([tag, *classes])
        if (path, label) not in self.numbers:
            self.numbers[path, label] = len(self.labels)
            self.labels.append((path, label, len(label) + (self.labels[path][2] + 1 if path else 0)))
        path = self.numbers[path, label]
        if tag in CONTAINERS and not dropped:
            self.outer.append(container)
            self.path_of.append(path)
            self._within.append(suspect)
            container = len(self.outer) - 1
            if tag == "main" or (tag == "article" and not _named_as_part(named)):
                self._articles[container] = tag == "main"
        self.count[tag] += 1
        self.open.append((tag, container, dropped, suspect, path))

    def _pop(self, upto: int) -> None:
        while len(self.open) > upto:
            self.count[self.open.pop()[0]] -= 1

    def _note(self) -> None:
        self._around = self.open[-1][1] if self.open else 0

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag == "br":
            self._text.append((" ", False, -1))
        if tag in INLINE:
            if tag not in VOID:
                self._push(tag, attrs)
            return
        self._cut()
        closing = CLOSED_BY.get(tag, ("p",) if tag in CLOSES_PARAGRAPH else ())
        if any(self.count[c] for c in closing):
            for k in range(len(self.open) - 1, -1, -1):
                if self.open[k][0] in closing:
                    self._pop(k)
                    if tag != "tr":
                        break
                elif self.open[k][0] in BARRIERS or (closing == ("p",) and self.open[k][0] in CONTAINERS):
                    break
        if tag not in VOID:
            self._push(tag, attrs)
        self._note()

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID and tag in ("svg", "math"):
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        if tag not in INLINE:
            self._cut()
        if self.count[tag]:
            for k in range(len(self.open) - 1, -1, -1):
                if self.open[k][0] == tag:
                    self._pop(k)
                    break
                if tag in INLINE and self.open[k][0] not in INLINE:
                    break  # an inline end tag closes nothing outside its block
        if tag not in INLINE:
            self._note()

    def handle_data(self, data: str) -> None:
        if self.open and self.open[-1][2]:
            return
        self._text.append((data, self.count["a"] > 0, self.open[-1][3] if self.open else -1))

    def path(self, number: int) -> str:
        """Tags and classes from the root down."""
        out = []
        while number > 0:
            number, label, _ = self.labels[number]
            out.append(label)
        return ">".join(reversed(out))

    def _best(self) -> tuple[int, float] | None:
        worth = [max(len(text) - 3 * linked, 0) for text, linked in zip(self.blocks, self.linked, strict=True)]
        total = sum(worth)
        if not total:
            return None
        mass, blocks = [0] * len(self.outer), [0] * len(self.outer)
        for n, w in zip(self.inside, worth, strict=True):
            mass[n] += w
            blocks[n] += 1
        held: dict[int, list[int]] = {}
        # containers of one path do not hold each other
        for path, kept, m, n in zip(self.path_of, self.kept, _with_inner(mass, self.outer), _with_inner(blocks, self.outer), strict=True):
            if kept and n:
                both = held.setdefault(path, [0, 0])
                both[0] += m
                both[1] += n
        found = {}
        for path, (m, n) in held.items():
            _, label, length = self.labels[path]
            if 2 * m >= total:
                found[path] = (m / total + 0.1 * (label.partition(".")[0] in ("article", "main")), n, length)
        most = max(found.values())
        path = max((p for p, f in found.items() if f == most), key=self.path)
        return path, most[0]

    def best(self) -> tuple[str, float] | None:
        """The container path that the page votes for, and its score.

        The score is the share of the running text, of half or more, and a bonus for ``article``
        and ``main``, so that these win over a whole page.  Of equal scores the path with more
        blocks wins, and of equal blocks the inner one: no depth makes up for text left out.
        """
        found = self._best()
        return found and (self.path(found[0]), found[1])

    def text(self, path: str | None) -> str:
        """Blocks inside elements with that path, one a line; of the page's own best path if it has none."""
        number = None
        if path is not None:
            number = 0
            for label in path.split(">") if path else ():
                number = self.numbers.get((number, label))
                if number is None:
                    break
        chosen = [kept and p == number for p, kept in zip(self.path_of, self.kept, strict=True)]
        if not any(chosen):
            own = self._best()
            if own is None:  # nothing but links
                return "\n".join(self.blocks)
            chosen = [kept and p == own[0] for p, kept in zip(self.path_of, self.kept, strict=True)]
        chosen = _from_outer(chosen, self.outer)
        return "\n".join(b for b, around in zip(self.blocks, self.inside, strict=True) if chosen[around])


def _votes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for host, html in zip(batch.column("host").to_pylist(), batch.column("html"), strict=True):
            found = Page(html.as_py()).best()
            if found:
                rows.append((host, *found))
        columns = list(zip(*rows, strict=True)) or [[]] * 3
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, (pa.string(), pa.string(), pa.float64()), strict=True)],
            names=["host", "path", "score"],
        )


def host_paths(pages: DataFrame) -> DataFrame:
    """Winning container path of each host: ``host``, ``path``.  ``pages`` has ``host`` and ``html``."""
    votes = pages.select("host", "html").mapInArrow(_votes, "host string, path string, score double")
    # whole numbers add up to the same sum in any order; of equal votes the outer path leaves nothing out
    total = votes.groupBy("host", "path").agg(F.sum(F.round(F.col("score") * 1000).cast("bigint")).alias("votes"))
    return total.groupBy("host").agg(F.max_by("path", F.struct("votes", -F.length("path"), "path")).alias("path"))


@F.arrow_udf(returnType=StringType())
def main_text(html: pa.Array, path: pa.Array) -> pa.Array:
    """Main text of each page, from the container path given or else the page's own best."""
    return pa.array([Page(h.as_py()).text(p.as_py()) for h, p in zip(html, path, strict=True)], pa.string())


def extract(pages: DataFrame) -> DataFrame:
    """Main text of every page: ``page_id``, ``url``, ``text``, ``n_chars``, ``path``.

    NULL html counts as empty and gives the empty text.  Pages without a host in their url
    vote together.  Rows that repeat vote and are extracted each.  Other columns are not read.  A
    page is read whole in one task, in time and memory that grow with its length.
    """
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"), host.alias("host"))
    # stored, so that the planner knows its size: while it is small no page is moved to meet it, beyond that a host
    # with very many pages is a skewed key of the join's left side, which adaptive execution splits
    out = rows.join(stored(host_paths(rows), "host-paths"), "host", "left")
    out = out.withColumn("text", main_text(F.col("html"), F.col("path")))
    return out.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"), "path")
